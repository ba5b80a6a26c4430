"""Reports over the star schema (L1-L7). The README names these measures
without query text; the definitions here are ours. Every report is one
partial aggregate over the fact (dimension lookups broadcast only the
calendar, whose size is bounded by the date span)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C


def spend_income(fact: DataFrame) -> DataFrame:
    """L1: Spend (sum of |Amount| of debits) and Income per customer key."""
    a = F.col("Amount")
    return fact.groupBy("CustomerSK").agg(
        F.sum(F.when(a < 0, -a).otherwise(F.lit(0.0))).alias("Spend"),
        F.sum(F.when(a > 0, a).otherwise(F.lit(0.0))).alias("Income"),
        F.count(F.lit(1)).alias("Transactions"))


def risk_by_segment(customers: DataFrame, segment: str = "KYC_Tier") -> DataFrame:
    """L2: RiskScore per segment (average, max, customers)."""
    return customers.groupBy(segment).agg(
        F.round(F.avg("RiskScore"), 6).alias("AvgRiskScore"),
        F.max("RiskScore").alias("MaxRiskScore"),
        F.count(F.lit(1)).alias("Customers"))


def channel_kpi(fact: DataFrame) -> DataFrame:
    """L3: ATM vs UPI: count, volume, average amount, failure rate."""
    failed = F.col("TransactionStatus").isNotNull() & (F.lower("TransactionStatus") != "success")
    return fact.groupBy("Channel").agg(
        F.count(F.lit(1)).alias("Transactions"),
        F.sum(F.abs("Amount")).alias("Volume"),
        F.round(F.avg("Amount"), 6).alias("AvgAmount"),
        F.round(F.count_if(failed) / F.count(F.lit(1)), 6).alias("FailureRate"))


def trend(fact: DataFrame, dim_date: DataFrame, grain: str = "DateKey") -> DataFrame:
    """L4: daily (``DateKey``) or monthly (``YearMonth``) trend."""
    cal = F.broadcast(dim_date.select("DateKey", "YearMonth"))
    f = fact.join(cal, "DateKey", "left")
    return f.groupBy(grain).agg(
        F.count(F.lit(1)).alias("Transactions"),
        F.sum("Amount").alias("NetAmount"),
        F.sum(F.abs("Amount")).alias("Volume"))


def customer360_view(dim_customer: DataFrame) -> DataFrame:
    """Current customer versions."""
    return dim_customer.filter(F.col("CurrentFlag")).drop("EffectiveTo", "CurrentFlag")


def alert_patterns(alerts: DataFrame, type_col: str = "type", severity_col: str = "AlertSeverity",
                   ts_col: str = "created_at") -> DataFrame:
    """Alerts by type, severity and day."""
    day = F.to_date(F.try_to_timestamp(F.col(ts_col).cast("string")))
    return alerts.groupBy(F.col(type_col).alias("type"), F.col(severity_col).alias("severity"),
                          day.alias("day")).agg(F.count(F.lit(1)).alias("alerts"))


def with_ingest_columns(df: DataFrame, as_of=None, source: str | None = None) -> DataFrame:
    """Ingestion date/time columns on bronze rows."""
    ts = C.as_of_ts(as_of)
    cols = {"ingest_ts": ts, "ingest_date": F.to_date(ts)}
    if source is not None:
        cols["ingest_source"] = F.lit(source)
    return df.withColumns(cols)
