"""The chain re-run: a second gold build over unchanged stores closes no
customer version and leaves the fact as it was."""

import os

from pyspark.sql import functions as F

from ledgerloom.plans import lakehouse as L
from ledgerloom.streaming.file_stream import start_ingest_stream


def write(path, text):
    with open(path, "w") as f:
        f.write(text)


def test_gold_rerun_is_stable(spark, scratch):
    inbox, stores, gold = f"{scratch}/inbox", f"{scratch}/stores", f"{scratch}/gold"
    os.makedirs(inbox)
    write(f"{inbox}/account_m.csv", "AccountNumber,CustomerID,Balance,AccountOpenDate,AccountType\n"
                                    "A1,C1,100,2020-01-01,SAV\nA2,C1,50,2021-01-01,CUR\nA3,C2,5,2019-01-01,SAV\n")
    write(f"{inbox}/atm_1.csv", "TransactionID,AccountNumber,CustomerID,Amount,TransactionTime,TransactionStatus\n"
                                "T1,A1,C1,10,2024-01-02 10:00:00,Success\nT2,A3,C2,20,2024-01-03 11:00:00,Failed\n")
    write(f"{inbox}/upi_1.csv", "TransactionID,AccountNumber,CustomerID,Amount,TransactionTime,Status\n"
                                "U1,A2,C1,5,2024-01-02 12:00:00,Success\n")
    start_ingest_stream(spark, inbox, stores, f"{scratch}/ckpt", as_of="2024-01-31").awaitTermination()
    silver = L.build_silver(L.read_stores(spark, stores), as_of="2024-01-31")
    L.write_gold(spark, silver, gold, "run1", as_of="2024-01-31")
    first = L.read_gold(spark, gold)
    assert first["fact_transactions"].count() == 3
    assert first["fact_transactions"].filter(F.col("CustomerSK").isNull()).count() == 0
    # collect now: the second run replaces the fact's partition files
    f1 = sorted(tuple(r) for r in first["fact_transactions"].select("TransactionID", "Amount").collect())
    cur_c, cur_a = L.current_dimensions(spark, gold)
    L.write_gold(spark, silver, gold, "run2", as_of="2024-01-31")
    second = L.read_gold(spark, gold)
    dim = second["dim_customer"]
    assert dim.count() == 2 and dim.filter(~F.col("CurrentFlag")).count() == 0
    assert sorted(r.AccountSK for r in second["dim_account"].collect()) == [1, 2, 3]
    f2 = sorted(tuple(r) for r in second["fact_transactions"].select("TransactionID", "Amount").collect())
    assert f1 == f2
    c360 = {r.CustomerID: r for r in second["customer360"].collect()}
    assert c360["C1"].Num_Accounts == 2 and c360["C2"].Failed_Transactions == 1
