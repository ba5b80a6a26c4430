"""A batch of the stream parses its files and folds the rows of the rules once."""
from pyspark.sql import functions as F

from ledgerloom.plans.ingest import ingest_transactions


def test_rows_are_checked_and_folded_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(x):
        seen.add(1)
        return "60000"
    raw = spark.range(0, 30, 1, 2).select(
        F.lit("atm_0.csv").alias("file_name"), F.format_string("T%d", "id").alias("TransactionID"),
        F.lit("A").alias("AccountNumber"), counted("id").alias("Amount"), F.lit("2024-01-15 10:00:00").alias("TransactionTime"))
    kept = []
    try:
        out = ingest_transactions(raw, kept)
        row, = out["counters"].collect()
        assert (row.rows_parsed, row.valid, row.alerts_generated) == (30, 30, 30 + 21 + 1)      # high value, velocity, drain
        assert out["quarantine"].count() == 0 and out["valid"].count() == 30
        assert len(kept) == 2 and seen.value == 30
    finally:
        for k in kept:
            k.unpersist()
