"""Row validation (D1-D6) as column expressions.

Each validator adds the cleaned typed columns and an ``errors`` array (empty
when the row is valid). The reference's error texts are kept. Splitting
valid from invalid rows is two filters over one annotated frame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C

# Error texts.
E_TXN_ID = "Missing TransactionID"
E_AMOUNT = "Invalid or non-positive Amount"
E_TS = "Invalid Timestamp"
E_ACC = "Missing AccountNumber"
E_CUST = "Missing CustomerID"
E_BALANCE = "Invalid Balance"
E_OPEN = "Invalid AccountOpenDate"
E_DOB = "Invalid DOB"
E_INCOME = "Invalid AnnualIncome"
E_CORRUPT = "Malformed row"


def _col_or_null(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def _errors(df: DataFrame, *checks: tuple[Column, str]) -> DataFrame:
    """Adds ``errors`` (texts of the failed checks, in order) and
    ``is_valid`` (no check failed). Filters use the boolean: building the
    array for every row only to test its size costs several times more."""
    # array_except drops the NULL slots and keeps order (texts are distinct);
    # unlike a lambda filter it stays inside whole-stage codegen.
    arr = F.array(*[F.when(bad, F.lit(msg)) for bad, msg in checks])
    ok = None
    for bad, _ in checks:
        good = ~F.coalesce(bad, F.lit(False))
        ok = good if ok is None else ok & good
    # The always-true partition-id term makes ``is_valid`` a computed column
    # Catalyst cannot inline: otherwise a filter on it is rewritten into the
    # whole parse expression and pushed to the scan, where (filters have no
    # common-subexpression elimination) each row is parsed several times.
    ok = ok & (F.spark_partition_id() >= 0)
    return df.withColumns({"errors": F.array_except(arr, F.array(F.lit(None).cast("string"))),
                           "is_valid": ok})


def _corrupt(df: DataFrame, corrupt_col: str | None):
    if corrupt_col and corrupt_col in df.columns:
        return [(F.col(corrupt_col).isNotNull(), E_CORRUPT)]
    return []


def validate_transactions(df: DataFrame, corrupt_col: str | None = "_corrupt_record") -> DataFrame:
    """TransactionID present, Amount (TransactionAmount, else Amount)
    parses and is > 0 (NaN/Inf rejected), time (TransactionTime, else
    Timestamp) parses. Adds trimmed text columns, ``Amount`` double,
    ``Timestamp`` timestamp and ``errors``."""
    # Cleaned text first, in its own projection: the parsers below refer to
    # it many times, and staging keeps the generated code small.
    staged = df.withColumns({
        "TransactionID": C.blank_to_null(_col_or_null(df, "TransactionID")),
        "AccountNumber": C.blank_to_null(_col_or_null(df, "AccountNumber")),
        "CustomerID": C.blank_to_null(_col_or_null(df, "CustomerID")),
        "_amt_text": C.first_non_empty(_col_or_null(df, "TransactionAmount"), _col_or_null(df, "Amount")),
        "_ts_text": C.first_non_empty(_col_or_null(df, "TransactionTime"), _col_or_null(df, "Timestamp")),
    })
    out = staged.withColumns({
        "Amount": C.to_float(F.col("_amt_text")),
        "Timestamp": C.parse_ts(F.col("_ts_text"), clean=True),
    }).drop("_amt_text", "_ts_text")
    return _errors(
        out, *_corrupt(df, corrupt_col),
        (F.col("TransactionID").isNull(), E_TXN_ID),
        (F.col("Amount").isNull() | (F.col("Amount") <= 0), E_AMOUNT),
        (F.col("Timestamp").isNull(), E_TS))


def validate_accounts(df: DataFrame, corrupt_col: str | None = "_corrupt_record") -> DataFrame:
    """AccountNumber and CustomerID present, Balance parses,
    AccountOpenDate parses."""
    staged = df.withColumns({
        "AccountNumber": C.blank_to_null(_col_or_null(df, "AccountNumber")),
        "CustomerID": C.blank_to_null(_col_or_null(df, "CustomerID")),
        "_open_text": C.blank_to_null(_col_or_null(df, "AccountOpenDate")),
    })
    out = staged.withColumns({
        "_balance": C.to_float(_col_or_null(df, "Balance")),
        "_open_ts": C.parse_ts(F.col("_open_text"), clean=True),
    }).drop("_open_text")
    return _errors(
        out, *_corrupt(df, corrupt_col),
        (F.col("AccountNumber").isNull(), E_ACC),
        (F.col("CustomerID").isNull(), E_CUST),
        (F.col("_balance").isNull(), E_BALANCE),
        (F.col("_open_ts").isNull(), E_OPEN)).drop("_balance", "_open_ts")


def validate_customers(df: DataFrame, corrupt_col: str | None = "_corrupt_record") -> DataFrame:
    """D3: CustomerID present, DOB parses, AnnualIncome parses."""
    staged = df.withColumns({
        "CustomerID": C.blank_to_null(_col_or_null(df, "CustomerID")),
        "_dob_text": C.blank_to_null(_col_or_null(df, "DOB")),
    })
    out = staged.withColumns({
        "_dob": C.parse_ts(F.col("_dob_text"), clean=True),
        "_income": C.to_float(_col_or_null(df, "AnnualIncome")),
    }).drop("_dob_text")
    return _errors(
        out, *_corrupt(df, corrupt_col),
        (F.col("CustomerID").isNull(), E_CUST),
        (F.col("_dob").isNull(), E_DOB),
        (F.col("_income").isNull(), E_INCOME)).drop("_dob", "_income")


def valid_rows(annotated: DataFrame) -> DataFrame:
    """Rows without errors."""
    return annotated.filter(F.col("is_valid"))


def invalid_rows(annotated: DataFrame) -> DataFrame:
    """Rows with at least one error (the quarantine set)."""
    return annotated.filter(~F.col("is_valid"))


def file_counters(annotated: DataFrame, alerts: DataFrame | None = None,
                  file_col: str = "file_name") -> DataFrame:
    """Per-file rows_parsed / valid / invalid / quarantined / alerts.

    One partial aggregate per input; alerts are counted per file separately
    and joined on the (small) per-file result."""
    counts = annotated.groupBy(file_col).agg(
        F.count(F.lit(1)).alias("rows_parsed"),
        F.count_if(F.col("is_valid")).alias("valid"),
        F.count_if(~F.col("is_valid")).alias("invalid"))
    counts = counts.withColumn("quarantined", F.col("invalid"))
    if alerts is None:
        return counts.withColumn("alerts_generated", F.lit(0).cast("long"))
    a = alerts.groupBy(file_col).agg(F.count(F.lit(1)).alias("alerts_generated"))
    return (counts.join(a, file_col, "left")
            .withColumn("alerts_generated", F.coalesce("alerts_generated", F.lit(0)).cast("long")))


def message_ok(body: Column) -> Column:
    """A queue message is JSON with non-empty file_url and file_name."""
    parsed = F.from_json(body, "file_url string, file_name string")
    return (F.coalesce(F.length(parsed["file_url"]), F.lit(0)) > 0) & \
           (F.coalesce(F.length(parsed["file_name"]), F.lit(0)) > 0)
