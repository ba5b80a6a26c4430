"""Explicit schemas for raw inputs and the align-to-schema step.

Raw ingestion files are read as all-string tables: inference would turn
account number ``00123`` into 123 and ``true`` into a boolean.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def all_strings(names: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


# Header fields read by the ingestion rules, per source.
ATM_FIELDS = ("TransactionID", "AccountNumber", "CustomerID", "Amount", "TransactionAmount",
              "TransactionTime", "Timestamp", "Location", "ATMID", "ATM_Bank",
              "TransactionType", "TransactionStatus", "BalanceBefore", "BalanceAfter")
UPI_FIELDS = ("TransactionID", "AccountNumber", "CustomerID", "Amount", "TransactionAmount",
              "TransactionTime", "Timestamp", "Location", "GeoLocation", "Payer_UPI_ID",
              "TransactionType", "Status", "BalanceBefore", "BalanceAfter")
ACCOUNT_FIELDS = ("AccountNumber", "CustomerID", "AccountHolderName", "BankName", "BranchName",
                  "IFSC_Code", "AccountType", "AccountStatus", "AccountOpenDate", "Balance",
                  "Currency", "KYC_Done", "KYC_DocID", "KYC_DocumentVerificationStatus")
CUSTOMER_FIELDS = ("CustomerID", "FirstName", "LastName", "DOB", "Gender", "Email", "Phone",
                   "Address", "City", "State", "ZipCode", "KYC_Status", "KYC_Tier",
                   "Occupation", "AnnualIncome")
KYC_FIELDS = ("CustomerID", "DocID", "VerificationStatus", "IssueDate", "ExpiryDate", "DocumentFile")

# Account sub-document fields (E1) and customer sub-document fields.
ACCOUNT_DOC_FIELDS = ("AccountHolderName", "BankName", "BranchName", "IFSC_Code", "AccountType",
                      "AccountStatus", "AccountOpenDate", "Balance", "Currency", "KYC_Done",
                      "KYC_DocID", "KYC_DocumentVerificationStatus")
CUSTOMER_DOC_FIELDS = ("CustomerID", "FirstName", "LastName", "DOB", "Gender", "Email", "Phone",
                       "Address", "City", "State", "ZipCode", "KYC_Status", "KYC_Tier",
                       "Occupation", "AnnualIncome")

# Payload of the alerts about one record (E5): a high-value transaction's row,
# or what a profile rule looked at.
TXN_PAYLOAD_FIELDS = tuple(dict.fromkeys(ATM_FIELDS + UPI_FIELDS))
PROFILE_PAYLOAD_EXTRA = ("income", "age_years")

TRANSACTIONS_SCHEMA = T.StructType([
    T.StructField("AccountNumber", T.StringType()),
    T.StructField("Transaction_Date", T.DateType()),
    T.StructField("Transaction_Time", T.StringType()),
    T.StructField("Amount", T.DoubleType()),
    T.StructField("Channel", T.StringType()),
    T.StructField("Location_ID", T.StringType()),
    T.StructField("Transaction_Type", T.StringType()),
    T.StructField("Transaction_Status", T.StringType()),
])


def rename_present(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """H1: rename only the columns that exist."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def drop_present(df: DataFrame, *cols: str) -> DataFrame:
    """H2: drop only the columns that exist."""
    return df.drop(*[c for c in cols if c in df.columns])


def align(df: DataFrame, schema: T.StructType | Mapping[str, T.DataType | str],
          keep_extra: bool = False) -> DataFrame:
    """Project onto a schema: absent columns become typed NULLs, present ones
    are cast, so presence guards (``if c in df.columns``) become one select."""
    fields = (list(schema.items()) if isinstance(schema, Mapping)
              else [(f.name, f.dataType) for f in schema.fields])
    have = set(df.columns)
    cols = [(F.col(n).cast(t) if n in have else F.lit(None).cast(t)).alias(n) for n, t in fields]
    if keep_extra:
        names = {n for n, _ in fields}
        cols += [F.col(c) for c in df.columns if c not in names]
    return df.select(*cols)
