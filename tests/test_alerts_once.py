"""The counters of a batch read the alerts that are kept, so the rules run once."""
from pyspark.sql import functions as F

from ledgerloom.plans.ingest import ingest_transactions


def test_counters_read_the_kept_alerts(spark, capsys):
    raw = spark.range(30).select(
        F.concat(F.lit("atm_"), F.col("id") % 2, F.lit(".csv")).alias("file_name"),
        F.format_string("T%d", "id").alias("TransactionID"), F.lit("A").alias("AccountNumber"),
        F.lit("60000").alias("Amount"), F.lit("2024-01-15 10:00:00").alias("TransactionTime"))
    out = ingest_transactions(raw)
    kept = out["alerts"].persist()
    try:
        out["counters"].explain()
        assert "InMemoryTableScan" in capsys.readouterr().out
        got = {r.file_name: (r.rows_parsed, r.alerts_generated) for r in out["counters"].collect()}
        want = {r.file_name: r["count"] for r in kept.groupBy("file_name").count().collect()}
        assert got == {f: (15, n) for f, n in want.items()} and set(want) == {"atm_0.csv", "atm_1.csv"}
    finally:
        kept.unpersist()
