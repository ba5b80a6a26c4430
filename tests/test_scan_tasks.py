"""Window tasks of the rules are as many as their rows need, whatever the session's shuffle partitions are."""
from pyspark.sql import functions as F

from ledgerloom.operators import rules_txn as R
from ledgerloom.operators import scan


def test_tasks_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(scan, "TASK_ROWS", 100)
    monkeypatch.setattr(scan, "DEFAULT_HOT_ROWS", 400)
    df = spark.range(3000).select(
        F.concat(F.lit("f"), F.col("id") % 1).alias("file_name"), F.format_string("T%05d", "id").alias("TransactionID"),
        F.lit("A").alias("AccountNumber"),
        F.when(F.col("id") < 900, "HOT").otherwise(F.concat(F.lit("C"), F.col("id") % 70)).alias("CustomerID"),
        F.lit(10.0).alias("Amount"), F.timestamp_seconds(1_700_000_000 + F.col("id") * 7).alias("Timestamp"),
        F.concat(F.lit("L"), F.col("id") % 3).alias("Location"))
    p, groups = R._prepare_with_hot(df, "file_name", None)
    assert groups.tasks == 30 and [r["_key"] for r in groups.hot.collect()] == ["HOT"]
    small = R.forward_window_counts(p.filter("_key <> 'HOT'"), 600)
    assert small.rdd.getNumPartitions() == 21
    got = {r.alert_id: (r.partner_TransactionID, r.metric) for r in R.geo_switch(df, 600).collect()}
    monkeypatch.undo()
    want = {r.alert_id: (r.partner_TransactionID, r.metric) for r in R.geo_switch(df, 600).collect()}
    assert got == want and len(got) > 2000
