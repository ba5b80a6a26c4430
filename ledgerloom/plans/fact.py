"""Transaction fact.

All dimension lookups are first resolved at account grain - account ->
customer -> CustomerSK, account -> AccountSK - so the (large) transaction
table meets one pre-joined account table in a single shuffle join, and the
calendar (one row per day, bounded by the date span) is broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.scan import global_row_number
from ..operators.merge import upsert
from ..operators.rules_flags import transaction_ts
from .customer360 import account_customer_map

# Fact columns, in order.
FACT_COLUMNS = ("TransactionID", "CustomerSK", "AccountSK", "DateKey", "TxnDateTime",
                "Transaction_Date", "Transaction_Time", "Year", "Month", "Amount", "Channel",
                "TransactionType", "TransactionStatus")

# Order inside one (account, date, time): the reference orders by a constant;
# these columns make the numbering - and so TransactionID - repeatable (Q17).
NUMBER_ORDER = ("Amount", "Channel", "Transaction_Type", "Transaction_Status", "Location_ID")


def keyed_transactions(txn: DataFrame) -> DataFrame:
    """Row number inside (account, date, time), TransactionID hash,
    rebuilt timestamp, DateKey, Year, Month. The numbering uses the grouped
    distributed row number, so a hot (account, second) is split too."""
    grp = ["AccountNumber", "Transaction_Date", "Transaction_Time"]
    t = global_row_number(txn, [c for c in NUMBER_ORDER if c in txn.columns], "txn_row_number",
                          group=grp)
    return t.withColumns({
        "TransactionID": F.sha2(F.concat_ws(
            "|", F.col("AccountNumber").cast("string"), F.col("Transaction_Date").cast("string"),
            F.col("Transaction_Time").cast("string"), F.col("txn_row_number").cast("string")), 256),
        "TxnDateTime": transaction_ts(),
        "DateKey": F.date_format("Transaction_Date", "yyyyMMdd").cast("int"),
        "Year": F.year("Transaction_Date"),
        "Month": F.month("Transaction_Date"),
    })


def account_keys(silver_account: DataFrame, dim_customer: DataFrame,
                 dim_account: DataFrame) -> DataFrame:
    """K14-K17 at account grain: AccountNumber -> (CustomerSK, AccountSK).
    Current customer versions only (Q19: not the version valid at
    transaction time)."""
    cur = dim_customer.filter(F.col("CurrentFlag")).select("CustomerID", "CustomerSK")
    amap = account_customer_map(silver_account.withColumn(
        "AccountNumber", F.col("AccountNumber").cast("string")))
    return (amap.join(cur, "CustomerID", "left")
            .join(dim_account.select("AccountNumber", "AccountSK"), "AccountNumber", "full_outer")
            .select("AccountNumber", "CustomerSK", "AccountSK"))


def fact_transactions(txn: DataFrame, silver_account: DataFrame, dim_customer: DataFrame,
                      dim_account: DataFrame) -> DataFrame:
    """The 13-column fact. The DateKey follows from the date; the
    calendar lookup (K18) changes no row and is a check of its own,
    ``missing_dates``."""
    t = keyed_transactions(txn)
    keys = account_keys(silver_account, dim_customer, dim_account)
    f = t.join(keys, "AccountNumber", "left")
    return f.select(
        "TransactionID", "CustomerSK", "AccountSK", "DateKey", "TxnDateTime", "Transaction_Date",
        "Transaction_Time", "Year", "Month", "Amount", "Channel",
        F.col("Transaction_Type").alias("TransactionType"),
        F.col("Transaction_Status").alias("TransactionStatus"))


def fact_merge(target: DataFrame | None, source: DataFrame) -> DataFrame:
    """Update-all / insert-all on TransactionID (create when absent)."""
    if target is None:
        return source
    return upsert(target, source, ["TransactionID"])


def missing_dates(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """DateKeys of the fact that the calendar lacks, with their rows."""
    used = fact.groupBy("DateKey").agg(F.count(F.lit(1)).alias("rows"))
    return used.join(dim_date.select("DateKey"), "DateKey", "left_anti")


def key_coverage(fact: DataFrame) -> DataFrame:
    """Rows and rows missing each surrogate key."""
    return fact.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("CustomerSK").isNull()).alias("missing_customer_sk"),
        F.count_if(F.col("AccountSK").isNull()).alias("missing_account_sk"),
        F.count_if(F.col("DateKey").isNull()).alias("missing_date_key"),
        F.countDistinct("TransactionID").alias("distinct_ids"))
