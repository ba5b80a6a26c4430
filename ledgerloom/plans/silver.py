"""Silver layer (H1-H17): rename, type, derive, de-duplicate.

Each function is ``DataFrame -> DataFrame`` over the flattened bronze shape;
absent optional columns are skipped the way the notebooks' presence guards
skip them. Full-row de-duplication of the channels goes by row hashes
(``operators.distinct``), that of the smaller tables is one shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators.distinct import distinct_rows
from ..schemas import drop_present, rename_present

# Rename maps of the silver notebooks.
ACCOUNT_RENAMES = {
    "Account_AccountHolderName": "AccountHolderName",
    "Account_AccountOpenDate": "AccountOpenDate",
    "Account_AccountStatus": "AccountStatus",
    "Account_AccountType": "AccountType",
    "Account_Balance": "Balance",
    "Account_BankName": "BankName",
}
ATM_RENAMES = {
    "ATMID": "ATM_ID",
    "ATM_Bank": "ATM_BankName",
    "TransactionType": "Transaction_Type",
    "TransactionStatus": "Transaction_Status",
}
ALERT_RENAMES = {
    "payload_AccountHolderName": "AccountHolderName",
    "payload_AccountOpenDate": "AccountOpenDate",
    "payload_AccountStatus": "AccountStatus",
    "payload_AccountType": "AccountType",
    "payload_Balance": "Balance",
    "payload_BankName": "BankName",
    "payload_BranchName": "BranchName",
    "payload_Currency": "Currency",
    "payload_IFSC_Code": "IFSC_Code",
    "payload_KYC_DocID": "KYC_DocID",
    "payload_KYC_DocumentVerificationStatus": "KYC_VerificationStatus",
    "payload_KYC_Done": "KYC_Done",
}


def _to_date(c):
    return F.col(c).cast("string").try_cast("date")


def _with_if(df: DataFrame, present: str, cols: dict) -> DataFrame:
    return df.withColumns(cols) if present in df.columns else df


def silver_account(bronze: DataFrame, as_of=None, distinct: bool = True) -> DataFrame:
    """H3: account profile documents -> typed account rows with customer age."""
    df = rename_present(bronze, ACCOUNT_RENAMES)
    df = _with_if(df, "AccountOpenDate", {"AccountOpenDate": _to_date("AccountOpenDate")})
    if "Customer_DOB" in df.columns:
        df = df.withColumn("Customer_DOB", _to_date("Customer_DOB"))
        df = df.withColumn("Customer_Age", C.age_years("Customer_DOB", as_of))
    df = drop_present(df, "Customer_CustomerID")
    df = _with_if(df, "Balance", {"Balance": C.to_float("Balance")})
    df = _with_if(df, "Customer_AnnualIncome",
                  {"Customer_AnnualIncome": C.to_float("Customer_AnnualIncome")})
    return df.dropDuplicates() if distinct else df


def _split_ts(df: DataFrame, src: str) -> DataFrame:
    """Date and time from the validated ``Timestamp`` where there is one (it
    accepts more layouts than the raw text's ISO form), else from the text."""
    if dict(df.dtypes).get("Timestamp") == "timestamp":
        src = "Timestamp"
    d, t = C.split_timestamp(src)
    return df.withColumns({"Transaction_Date": d, "Transaction_Time": t})


def silver_atm(bronze: DataFrame, distinct: bool = True) -> DataFrame:
    """H4: ATM rows -> date/time split, renames, numeric casts, BalanceChange."""
    df = rename_present(bronze, {"TransactionTime": "Transaction_Timestamp"})
    src = "Transaction_Timestamp" if "Transaction_Timestamp" in df.columns else "Timestamp"
    df = _split_ts(df, src)
    df = drop_present(df, "Transaction_Timestamp", "Timestamp", "Transaction_TS")
    df = rename_present(df, ATM_RENAMES)
    df = df.withColumns({c: C.to_float(c) for c in ("Amount", "BalanceAfter", "BalanceBefore")
                         if c in df.columns})
    if "BalanceAfter" in df.columns and "BalanceBefore" in df.columns:
        df = df.withColumn("BalanceChange", F.col("BalanceAfter") - F.col("BalanceBefore"))
    return distinct_rows(df) if distinct else df


def silver_upi(bronze: DataFrame, distinct: bool = True) -> DataFrame:
    """H5: UPI rows -> date/time split, geo split, numeric casts."""
    src = "TransactionTime" if "TransactionTime" in bronze.columns else "Timestamp"
    df = _split_ts(bronze, src)
    if "GeoLocation" in df.columns:
        df = df.withColumns({"Geo_Lat": C.geo_part("GeoLocation", 0),
                             "Geo_Long": C.geo_part("GeoLocation", 1)}).drop("GeoLocation")
    df = df.withColumns({c: C.to_float(c) for c in ("Amount", "BalanceBefore", "BalanceAfter")
                         if c in df.columns})
    df = drop_present(df, "Timestamp", "TransactionTime", "Transaction_TS")
    return distinct_rows(df) if distinct else df


def silver_alerts(bronze: DataFrame, as_of=None, reason_col: str = "reason",
                  distinct: bool = True) -> DataFrame:
    """H6: alert documents -> renames, dates, KYC boolean, severity, run date."""
    df = rename_present(bronze, ALERT_RENAMES)
    df = _with_if(df, "AccountOpenDate", {"AccountOpenDate": _to_date("AccountOpenDate")})
    df = _with_if(df, "KYC_Done", {"KYC_Done": C.truthy_status("KYC_Done")})
    df = df.withColumns({"AlertSeverity": C.severity(reason_col),
                         "AlertDate": C.as_of_date(as_of)})
    df = drop_present(df, "id")
    return df.dropDuplicates() if distinct else df


def silver_kyc(bronze: DataFrame, as_of=None, distinct: bool = True) -> DataFrame:
    """H7: KYC documents -> dates, validity, document age, IsVerified."""
    df = bronze.withColumns({c: _to_date(c) for c in ("IssueDate", "ExpiryDate")
                             if c in bronze.columns})
    df = _with_if(df, "ExpiryDate", {"DocumentValidityStatus": C.validity("ExpiryDate", as_of)})
    df = _with_if(df, "IssueDate", {"DocumentAgeYears": C.age_years("IssueDate", as_of)})
    df = _with_if(df, "VerificationStatus",
                  {"IsVerified": C.truthy_status("VerificationStatus")})
    df = drop_present(df, "DocumentFile")
    return df.dropDuplicates() if distinct else df


def keyed_distinct(df: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """One row per key. The winner is the row first in ``order`` (all
    columns by default), so re-runs pick the same row. A window partitioned
    by the key would put a hot key's rows in one task; instead the winner is
    chosen by ``min_by`` with partial aggregation."""
    other = [c for c in df.columns if c not in keys]
    if not other:
        return df.dropDuplicates(keys)
    order = order or other
    rank = F.struct(*[x for c in order for x in (F.col(c).isNull(), F.col(c))])
    win = F.min_by(F.struct(*[F.col(c) for c in other]), rank).alias("_w")
    return df.groupBy(*keys).agg(win).select(*keys, "_w.*").select(*df.columns)


def _opt(df: DataFrame, name: str):
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def union_channels(silver_atm_df: DataFrame, silver_upi_df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """I1 + I2: project both channels onto the unified transaction shape
    (optional source columns that are absent become NULL). ``keep`` names
    columns of both that are carried along."""
    atm = silver_atm_df.select(
        "AccountNumber", "Transaction_Date", "Transaction_Time", "Amount",
        F.lit("ATM").alias("Channel"), _opt(silver_atm_df, "ATM_ID").alias("Location_ID"),
        _opt(silver_atm_df, "Transaction_Type").alias("Transaction_Type"),
        _opt(silver_atm_df, "Transaction_Status").alias("Transaction_Status"), *keep)
    upi = silver_upi_df.select(
        "AccountNumber", "Transaction_Date", "Transaction_Time", "Amount",
        F.lit("UPI").alias("Channel"), _opt(silver_upi_df, "Payer_UPI_ID").alias("Location_ID"),
        _opt(silver_upi_df, "TransactionType").alias("Transaction_Type"),
        _opt(silver_upi_df, "Status").alias("Transaction_Status"), *keep)
    return atm.unionByName(upi)
