"""Change feed between layers: a run reads and writes only the days that
changed; alerts keep what they are about from the rule to silver."""

import os

from pyspark.sql import functions as F

from ledgerloom.plans import lakehouse as L
from ledgerloom.operators.rules_profile import profile_alerts
from ledgerloom.operators.rules_txn import fraud_detection
from ledgerloom.plans.ingest import ingest_accounts, normalize_alerts
from ledgerloom.plans.silver import ALERT_RENAMES, silver_alerts
from ledgerloom.sources.documents import flatten
from ledgerloom.sources.tables import PartitionedTable
from ledgerloom.sources.versions import VersionedTable, folder_marks, refresh_all, refresh_from_folders
from ledgerloom.streaming.file_stream import start_ingest_stream

AS_OF = "2024-01-31"
ATM = "TransactionID,AccountNumber,CustomerID,Amount,TransactionTime,TransactionStatus,ATMID\n"
UPI = "TransactionID,AccountNumber,CustomerID,Amount,TransactionTime,Status\n"
ACCOUNTS = ("AccountNumber,CustomerID,Balance,AccountOpenDate,AccountType,AccountStatus,BankName,KYC_Done\n"
            "A1,C1,100,2020-01-01,SAV,Closed,First Bank,true\nA2,C1,50,2015-01-01,CUR,Active,Second Bank,no\n")


def land(path, text):
    with open(path, "w") as f:
        f.write(text)


def run(spark, base):
    start_ingest_stream(spark, f"{base}/inbox", f"{base}/stores", f"{base}/ckpt", as_of=AS_OF).awaitTermination()
    bronze = L.write_bronze(spark, L.read_stores(spark, f"{base}/stores"), f"{base}/bronze", as_of=AS_OF,
                            stores_root=f"{base}/stores")
    return L.write_silver(spark, bronze, f"{base}/silver", as_of=AS_OF, bronze_root=f"{base}/bronze")


def writes(spark, base):
    return {(layer, name): {p[0]: w for p, w in L.daily_table(spark, f"{base}/{layer}", name).manifest().live.items()}
            for layer, name in (("bronze", "atm"), ("bronze", "upi"), ("silver", "atm"), ("silver", "upi"),
                                ("silver", "transactions"))}


def rows(df):
    return sorted(tuple(map(str, r)) for r in df.select(*sorted(df.columns)).collect())


def test_only_changed_days_are_written(spark, scratch):
    os.makedirs(f"{scratch}/inbox")
    land(f"{scratch}/inbox/account_m.csv", ACCOUNTS)
    land(f"{scratch}/inbox/atm_1.csv", ATM + "T1,A1,C1,60000,2024-01-02 10:00:00,Success,M1\nT2,A2,C1,20,2024-01-03 11:00:00,Failed,M1\n")
    land(f"{scratch}/inbox/upi_1.csv", UPI + "U1,A2,C1,5,2024-01-02 12:00:00,Success\n")
    silver = run(spark, scratch)
    first = writes(spark, scratch)
    assert set(first["silver", "transactions"]) == {"2024-01-02", "2024-01-03"}
    alerts = {r.type: r for r in silver["alerts"].collect()}
    assert alerts["ACCOUNT_CLOSED"].BankName == "First Bank" and alerts["ACCOUNT_CLOSED"].KYC_Done is True
    assert str(alerts["ACCOUNT_CLOSED"].AccountOpenDate) == "2020-01-01"
    assert alerts["KYC_NOT_DONE"].KYC_Done is False and alerts["KYC_NOT_DONE"].Balance == 50.0
    assert alerts["STALE_ACCOUNT"].BankName is None and alerts["STALE_ACCOUNT"].payload_age_years > 9
    assert alerts["HIGH_VALUE"].payload_ATMID == "M1" and alerts["HIGH_VALUE"].payload_Amount == 60000.0

    # Nothing new: nothing is written.
    run(spark, scratch)
    assert writes(spark, scratch) == first

    # One new day, and a late row for an old day of the other channel.
    land(f"{scratch}/inbox/atm_2.csv", ATM + "T3,A1,C1,30,2024-01-05 10:00:00,Success,M1\n")
    land(f"{scratch}/inbox/upi_2.csv", UPI + "U2,A1,C1,7,2024-01-02 09:00:00,Success\n")
    silver = run(spark, scratch)
    second = writes(spark, scratch)
    for table, new in {("bronze", "atm"): {"2024-01-05"}, ("silver", "atm"): {"2024-01-05"},
                       ("bronze", "upi"): {"2024-01-02"}, ("silver", "upi"): {"2024-01-02"},
                       ("silver", "transactions"): {"2024-01-02", "2024-01-05"}}.items():
        assert {d for d in second[table] if second[table][d] != first[table].get(d)} == new, table
    stores = L.read_stores(spark, f"{scratch}/stores")
    whole = L.write_silver(spark, L.write_bronze(spark, stores, f"{scratch}/b2", as_of=AS_OF), f"{scratch}/s2", as_of=AS_OF)
    for name in ("atm", "upi", "transactions", "alerts", "flag_alerts"):
        assert rows(silver[name]) == rows(whole[name]), name
    assert silver["transactions"].count() == 5


def test_folders_emptied_null_and_first(spark, scratch):
    store = PartitionedTable(spark, f"{scratch}/store", ["d"], f"{scratch}/stage")
    store.create(spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "k int, d string"))
    marks = folder_marks(store)
    assert set(marks) == {("a",), (None,), ("b",)} and folder_marks(store) == marks
    target = VersionedTable(spark, f"{scratch}/target", ["d"])
    built = lambda df: df.withColumn("k2", F.col("k") * 10)     # noqa: E731
    assert refresh_from_folders(target, store, built) is None
    assert refresh_from_folders(target, store, built) == []
    touched = spark.createDataFrame([("a",), (None,)], "d string")
    store.replace(spark.createDataFrame([(9, None)], "k int, d string"), touched, "r1")     # a is emptied
    assert set(refresh_from_folders(target, store, built)) == {("a",), (None,)}
    assert rows(target.read()) == [("None", "9", "90"), ("b", "3", "30")]


def test_several_sources(spark, scratch):
    a, b, t = (VersionedTable(spark, f"{scratch}/{n}", ["d"]) for n in "abt")
    df = lambda *r: spark.createDataFrame(list(r), "k int, d string")       # noqa: E731
    a.create(df((1, "x"), (2, "y")))
    b.create(df((3, "x")))
    both = lambda s: s["a"].unionByName(s["b"])         # noqa: E731
    assert refresh_all(t, {"a": a, "b": b}, both) is None
    b.replace(df((4, "z")), df((0, "x"), (0, "z")).select("d"), "r")        # x goes from b, z comes
    a.replace(df((5, "x")), df((0, "x")).select("d"), "r")
    assert sorted(refresh_all(t, {"a": a, "b": b}, both)) == [("x",), ("z",)]
    assert rows(t.read()) == [("x", "5"), ("y", "2"), ("z", "4")]
    assert refresh_all(t, {"a": a, "b": b}, both) == []


def test_payload_of_each_kind(spark):
    acc = spark.createDataFrame(
        [("A1", "C1", "no", "Failed", "Dormant", "5,000", "2015-01-01", "First")],
        "AccountNumber string, CustomerID string, KYC_Done string, KYC_DocumentVerificationStatus string, "
        "AccountStatus string, Balance string, AccountOpenDate string, BankName string").withColumn("file_name", F.lit("f"))
    income = spark.createDataFrame([("C1", 100.0)], "CustomerID string, AnnualIncome double")
    alerts = ingest_accounts(acc, income, as_of=AS_OF)["alerts"]
    got = {r.type: r.payload for r in alerts.collect()}
    assert got["KYC_NOT_DONE"].BankName == "First" and got["KYC_NOT_DONE"].Balance == 5000.0
    assert got["KYC_NOT_DONE"].income is None and got["KYC_NOT_DONE"].IFSC_Code is None
    assert (got["BALANCE_INCOME_MISMATCH"].Balance, got["BALANCE_INCOME_MISMATCH"].income) == (5000.0, 100.0)
    assert got["BALANCE_INCOME_MISMATCH"].BankName is None
    silver = silver_alerts(flatten(alerts), as_of=AS_OF)
    assert set(ALERT_RENAMES.values()) <= set(silver.columns) and silver.count() == alerts.count()
    empty = profile_alerts(acc.drop("file_name").limit(0), income, as_of=AS_OF)
    assert empty.count() == 0 and "payload" in empty.columns


def test_payload_of_transactions(spark):
    good = spark.createDataFrame(
        [("f", "T1", "A1", None, 60000.0, "2024-01-01 10:00:00", "L1"), ("f", None, None, None, 50000.0, None, None)],
        "file_name string, TransactionID string, AccountNumber string, CustomerID string, Amount double, t string, Location string"
    ).withColumn("Timestamp", F.col("t").cast("timestamp")).drop("t")
    alerts = normalize_alerts(fraud_detection(good))
    got = {r.payload.TransactionID: r for r in alerts.filter("type = 'HIGH_VALUE'").collect()}
    assert got["T1"].payload.Timestamp == "2024-01-01T10:00:00+00:00" and got["T1"].payload.GeoLocation is None
    assert got[None].payload.Amount == 50000.0 and got[None].AccountNumber == "UNKNOWN"
    drain = alerts.filter("type = 'BALANCE_DRAIN'").collect()
    assert all(r.payload is None for r in drain)
