"""Sources and sinks: delimiter/header detection, surplus fields, snapshot
versions, partition-level merge."""

import os


from ledgerloom.sources.files import detect_delimiter, read_delimited, route
from ledgerloom.sources.tables import PartitionedTable, SnapshotTable
from ledgerloom.sources import documents as D


def write(path, text):
    with open(path, "w") as f:
        f.write(text)


def test_detect_delimiter():
    assert detect_delimiter("a;b;c") == ";"
    assert detect_delimiter("a|b") == "|"
    assert detect_delimiter("a\tb") == "\t"
    assert detect_delimiter("single") == ","
    assert detect_delimiter(None) == ","


def test_read_delimited_mixed_files(spark, scratch):
    write(f"{scratch}/atm_1.csv", " TransactionID ,Amount,AccountNumber\nT1,00123,AC001\nT2,5,AC002,extra\n")
    write(f"{scratch}/upi_1.csv", "TransactionID;Amount;GeoLocation\nU1;7;\"12.5,77.5\"\n")
    write(f"{scratch}/empty_account.csv", "")
    df = route(read_delimited(spark, [f"{scratch}/atm_1.csv", f"{scratch}/upi_1.csv",
                                      f"{scratch}/empty_account.csv"]))
    got = {r.TransactionID: r for r in df.collect()}
    assert got["T1"].Amount == "00123" and got["T1"].AccountNumber == "AC001"   # no inference
    assert got["T2"]._corrupt_record is not None                                 # surplus field
    assert got["U1"].GeoLocation == "12.5,77.5" and got["U1"].source_type == "UPI"
    assert got["T1"].source_type == "ATM" and got["T1"].is_csv


def test_snapshot_versions(spark, scratch):
    t = SnapshotTable(spark, f"{scratch}/tbl")
    assert not t.exists()
    t.write(spark.createDataFrame([(1, "a")], "k int, v string"))
    t.merge(spark.createDataFrame([(1, "b"), (2, "c")], "k int, v string"), ["k"])
    assert t.version() == 2
    assert sorted(tuple(r) for r in t.read().collect()) == [(1, "b"), (2, "c")]
    assert sorted(tuple(r) for r in t.read(1).collect()) == [(1, "a")]
    t.write(spark.createDataFrame([(1, 2.5)], "k int, x double"))  # schema replaced
    assert t.read().columns == ["k", "x"]


def test_partitioned_merge_touches_only_source_partitions(spark, scratch):
    t = PartitionedTable(spark, f"{scratch}/fact", ["Month"], f"{scratch}/stage")
    t.create(spark.createDataFrame([("a", 1, 1.0), ("b", 2, 2.0)], "id string, Month int, v double"))
    before = sorted(os.listdir(f"{scratch}/fact/Month=1"))
    t.merge(spark.createDataFrame([("b", 2, 20.0), ("c", 2, 3.0)], "id string, Month int, v double"),
            ["id"], "run1")
    assert sorted(tuple(r) for r in t.read().select("id", "Month", "v").collect()) == [
        ("a", 1, 1.0), ("b", 2, 20.0), ("c", 2, 3.0)]
    assert sorted(os.listdir(f"{scratch}/fact/Month=1")) == before   # untouched partition kept


def test_flatten_and_stringify(spark):
    df = spark.createDataFrame([("id1", ("x", 2.0, ("deep",)), [1, 2], "sys")],
                               "id string, Account struct<Name:string,Bal:double,Sub:struct<Z:string>>, "
                               "tags array<int>, _rid string")
    b = D.bronze(df, numeric_fields=["Account_Bal"])
    assert b.columns == ["id", "Account_Name", "Account_Bal", "Account_Sub_Z", "tags"]
    r = b.first()
    assert (r.Account_Bal, r.Account_Sub_Z, r.tags) == ("2.0", "deep", "[1,2]")
