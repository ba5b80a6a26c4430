"""SCD2 / SCD1 / upsert / fact merge cases."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.operators.merge import latest_per_key, scd1_merge, scd2_merge, scd2_rejects, upsert

S = "CustomerID string, Tier string, Bal double"


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_scd2_cases(spark):
    v1 = spark.createDataFrame([("c1", "G", 1.0), ("c2", None, 2.0), ("c3", "S", 3.0), ("c4", "S", 4.0)], S)
    v2 = spark.createDataFrame([("c1", "G", 1.0),      # unchanged
                                ("c2", "P", 2.0),      # NULL -> value
                                ("c3", None, 3.0),     # value -> NULL
                                ("c5", "N", 5.0),      # new
                                (None, "X", 9.0)],     # NULL key: left out
                               S)                      # c4 vanished: stays current
    d1 = scd2_merge(None, v1, "CustomerID", ["Tier", "Bal"], "2024-01-01 00:00:00", "SK")
    assert rows(d1, "SK", "CustomerID") == [(1, "c1"), (2, "c2"), (3, "c3"), (4, "c4")]
    d2 = scd2_merge(d1, v2, "CustomerID", ["Tier", "Bal"], "2024-02-01 00:00:00", "SK")
    got = rows(d2, "SK", "CustomerID", "Tier", "CurrentFlag", "EffectiveTo")
    t2 = dt.datetime(2024, 2, 1)
    assert got == sorted([
        (1, "c1", "G", True, None), (2, "c2", None, False, t2), (3, "c3", "S", False, t2),
        (4, "c4", "S", True, None), (5, "c2", "P", True, None), (6, "c3", None, True, None),
        (7, "c5", "N", True, None)])
    # re-running with the same source changes nothing but adds no rows either
    d3 = scd2_merge(d2, v2, "CustomerID", ["Tier", "Bal"], "2024-03-01 00:00:00", "SK")
    assert d3.count() == d2.count()
    assert scd2_rejects(v2, "CustomerID").count() == 1


def test_scd1_keeps_keys(spark):
    dim = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "SK long, k string, attr string")
    src = spark.createDataFrame([("b", "Y"), ("c", "z")], "k string, attr string")
    assert rows(scd1_merge(dim, src, "k", "SK"), "SK", "k", "attr") == [(1, "a", "x"), (2, "b", "Y"), (3, "c", "z")]


def test_upsert_last_wins(spark):
    tgt = spark.createDataFrame([("k1", 1, "old"), ("k2", 1, "keep")], "k string, seq int, v string")
    src = spark.createDataFrame([("k1", 2, "mid"), ("k1", 3, "new"), ("k3", 1, "ins")], "k string, seq int, v string")
    assert rows(upsert(tgt, src, ["k"], order=["seq"]), "k", "v") == [("k1", "new"), ("k2", "keep"), ("k3", "ins")]
    # a hot key with many versions: still one row, the last one
    hot = spark.range(5000).select(F.lit("h").alias("k"), F.col("id").cast("int").alias("seq"),
                                   F.col("id").cast("string").alias("v"))
    assert rows(latest_per_key(hot, ["k"], ["seq"]), "k", "v") == [("h", "4999")]


def test_fact_merge_rerun_is_idempotent(spark):
    from ledgerloom.plans.fact import fact_merge
    f = spark.createDataFrame([("t1", 1.0), ("t2", 2.0)], "TransactionID string, Amount double")
    assert rows(fact_merge(fact_merge(None, f), f), "TransactionID", "Amount") == [("t1", 1.0), ("t2", 2.0)]
