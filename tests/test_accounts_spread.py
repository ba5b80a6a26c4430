"""Accounts of one small split are checked by several tasks."""
from pyspark.sql import functions as F

from ledgerloom.plans.ingest import ingest_accounts


def test_accounts_of_one_split_are_dealt(spark):
    raw = spark.range(0, 4000, 1, 1).select(
        F.format_string("AC%05d", "id").alias("AccountNumber"), F.format_string("C%05d", "id").alias("CustomerID"),
        F.lit("10").alias("Balance"), F.lit("2010-01-01").alias("AccountOpenDate"), F.lit("no").alias("KYC_Done"),
        F.lit("ok").alias("KYC_DocumentVerificationStatus"), F.lit("Active").alias("AccountStatus"),
        F.lit("account_a.csv").alias("file_name"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1k")
    try:
        out = ingest_accounts(raw, as_of="2024-01-31")
        assert out["documents"].rdd.getNumPartitions() >= 4
        assert out["documents"].count() == 4000 and out["alerts"].count() == 8000       # KYC_NOT_DONE and STALE_ACCOUNT
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")
