"""Reports from mergeable state (L1, L3, L4): partial aggregates of the fact,
stored per partition of it.

``refresh_reports`` reads only the months of the fact that changed since the
state was built and replaces only theirs; the reports then add up partial sums,
without a scan of the fact. ``daily`` has a row per (day, channel),
``customers`` one per (month, customer).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.versions import VersionedTable, refresh

PARTITION = ("Year", "Month")


def daily_state(fact: DataFrame) -> DataFrame:
    failed = F.col("TransactionStatus").isNotNull() & (F.lower("TransactionStatus") != "success")
    return fact.groupBy(*PARTITION, "DateKey", "Channel").agg(
        F.count(F.lit(1)).alias("rows"), F.count("Amount").alias("amounts"), F.sum("Amount").alias("net"),
        F.sum(F.abs("Amount")).alias("volume"), F.count_if(failed).alias("failed"))


def customer_state(fact: DataFrame) -> DataFrame:
    a = F.col("Amount")
    return fact.groupBy(*PARTITION, "CustomerSK").agg(
        F.sum(F.when(a < 0, -a).otherwise(F.lit(0.0))).alias("spend"),
        F.sum(F.when(a > 0, a).otherwise(F.lit(0.0))).alias("income"), F.count(F.lit(1)).alias("rows"))


STATES = {"daily": daily_state, "customers": customer_state}


def state_table(spark: SparkSession, root: str, name: str) -> VersionedTable:
    return VersionedTable(spark, f"{root.rstrip('/')}/{name}", PARTITION)


def refresh_reports(spark: SparkSession, fact: VersionedTable, root: str) -> dict[str, list | None]:
    """All states up to the fact's current version; the partitions done by state."""
    return {name: refresh(state_table(spark, root, name), fact, build) for name, build in STATES.items()}


def spend_income(customers: DataFrame) -> DataFrame:
    """L1 from ``customers``."""
    return customers.groupBy("CustomerSK").agg(
        F.sum("spend").alias("Spend"), F.sum("income").alias("Income"), F.sum("rows").alias("Transactions"))


def channel_kpi(daily: DataFrame) -> DataFrame:
    """L3 from ``daily``."""
    return daily.groupBy("Channel").agg(
        F.sum("rows").alias("Transactions"), F.sum("volume").alias("Volume"),
        F.round(F.try_divide(F.sum("net"), F.sum("amounts")), 6).alias("AvgAmount"),
        F.round(F.sum("failed") / F.sum("rows"), 6).alias("FailureRate"))


def trend(daily: DataFrame, grain: str = "DateKey") -> DataFrame:
    """L4 from ``daily``: by ``DateKey`` or ``YearMonth`` (the calendar's, which follows from the key)."""
    d = daily.withColumn("YearMonth", F.concat_ws("-", F.substring(F.col("DateKey").cast("string"), 1, 4),
                                                  F.substring(F.col("DateKey").cast("string"), 5, 2)))
    return d.groupBy(grain).agg(F.sum("rows").alias("Transactions"), F.sum("net").alias("NetAmount"),
                                F.sum("volume").alias("Volume"))
