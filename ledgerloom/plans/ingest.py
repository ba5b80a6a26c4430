"""Per-file ingestion (3.1 of the survey) and profile documents.

One batch holds rows of many files (``file_name``/``source_type`` columns).
Each transaction batch is annotated once (validation), then split into valid
rows, quarantined rows and alerts; counters per file feed the audit table.
Account and customer rows become profile documents merged by key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import rules_profile, rules_txn
from ..operators.merge import latest_per_key, one_per_key
from ..operators.validate import (file_counters, invalid_rows, valid_rows, validate_accounts,
                                  validate_customers, validate_transactions)
from ..schemas import ACCOUNT_DOC_FIELDS, CUSTOMER_DOC_FIELDS

# Audit statuses.
STATUS_COMPLETED = "COMPLETED"
STATUS_UNKNOWN = "UNKNOWN_SOURCE"
STATUS_REJECTED = "REJECTED_EXTENSION"
STATUS_FAILED = "PROCESSOR_FAILED"


def _text(df: DataFrame, name: str):
    return C.strip(F.col(name)) if name in df.columns else F.lit(None).cast("string")


def account_documents(valid_accounts: DataFrame) -> DataFrame:
    """Account document: id = AccountNumber, ``Account`` struct with
    Balance (default 0.0) and ISO open date."""
    fields = []
    for f in ACCOUNT_DOC_FIELDS:
        if f == "Balance":
            fields.append(C.default_zero(C.to_float(F.col("Balance"))).alias(f))
        elif f == "AccountOpenDate":
            fields.append(C.iso_utc(C.parse_ts(F.col(f))).alias(f))
        else:
            fields.append(_text(valid_accounts, f).alias(f))
    return valid_accounts.select(
        F.col("AccountNumber").alias("id"), "AccountNumber", "CustomerID",
        F.struct(*fields).alias("Account"))


def customer_subdocuments(valid_customers: DataFrame) -> DataFrame:
    """``Customer`` struct per row: DOB as ISO text, AnnualIncome
    default 0.0."""
    fields = []
    for f in CUSTOMER_DOC_FIELDS:
        if f == "DOB":
            fields.append(C.iso_utc(C.parse_ts(_text(valid_customers, f))).alias(f))
        elif f == "AnnualIncome":
            fields.append(C.default_zero(C.to_float(_text(valid_customers, f))).alias(f))
        else:
            fields.append(_text(valid_customers, f).alias(f))
    return valid_customers.select("CustomerID", F.struct(*fields).alias("Customer"))


def merge_accounts_into_profiles(profiles: DataFrame | None, accounts: DataFrame) -> DataFrame:
    """Account documents upserted by id, one per id (of several rows of an
    account the greatest); the ``Customer`` part of an existing document is
    kept (Q11: the reference would drop it)."""
    acc = one_per_key(accounts, ["id"]).withColumn("Customer", F.lit(None).cast(_customer_type(profiles, accounts)))
    if profiles is None:
        return acc
    kept = profiles.join(acc.select("id"), "id", "left_anti")
    carried = (acc.alias("a").join(profiles.select("id", "Customer").alias("p"), "id", "left")
               .select("id", "AccountNumber", "CustomerID", "Account", F.col("p.Customer").alias("Customer")))
    return kept.unionByName(carried)


CUSTOMER_DOC_TYPE = "struct<" + ",".join(
    f"{f}:{'double' if f == 'AnnualIncome' else 'string'}" for f in CUSTOMER_DOC_FIELDS) + ">"


ACCOUNT_DOC_TYPE = "struct<" + ",".join(
    f"{f}:{'double' if f == 'Balance' else 'string'}" for f in ACCOUNT_DOC_FIELDS) + ">"
PROFILE_DDL = (f"id string, AccountNumber string, CustomerID string, Account {ACCOUNT_DOC_TYPE}, "
               f"Customer {CUSTOMER_DOC_TYPE}")


def empty_profiles(spark) -> DataFrame:
    return spark.createDataFrame([], PROFILE_DDL)


def _customer_type(profiles, accounts):
    if profiles is not None and "Customer" in profiles.columns:
        return profiles.schema["Customer"].dataType
    return CUSTOMER_DOC_TYPE


def merge_customer_profiles(profiles: DataFrame, customers: DataFrame,
                            order: list[str] | None = None) -> DataFrame:
    """Every profile document of a customer gets the new ``Customer``
    part; a customer without documents gets ``CUSTOMER_<id>`` (C14). Several
    rows of one customer: the last in ``order`` wins."""
    subs = customer_subdocuments(customers)
    subs = latest_per_key(subs, ["CustomerID"], order or ["Customer"])
    # Left join (AQE can split a customer with very many documents; a full
    # outer join could not be split) plus customers without any document.
    updated = (profiles.alias("p").join(subs.alias("c"), "CustomerID", "left")
               .select(F.col("p.id").alias("id"), F.col("p.AccountNumber").alias("AccountNumber"),
                       "CustomerID", F.col("p.Account").alias("Account"),
                       F.coalesce(F.col("c.Customer"), F.col("p.Customer")).alias("Customer")))
    known = profiles.select("CustomerID").distinct()
    standalone = (subs.join(known, "CustomerID", "left_anti")
                  .select(C.surrogate_id(F.lit(None).cast("string"), F.col("CustomerID")).alias("id"),
                          F.lit(None).cast("string").alias("AccountNumber"), "CustomerID",
                          F.lit(None).cast(profiles.schema["Account"].dataType).alias("Account"),
                          "Customer"))
    return updated.unionByName(standalone)


def normalize_alerts(alerts: DataFrame) -> DataFrame:
    """E5: one alert document shape (id = alert_id, AccountNumber default
    UNKNOWN). Alerts about one record keep it as ``payload``, a struct."""
    return alerts.select(
        F.col("alert_id").alias("id"), "alert_id", "type", "reason",
        F.col("created_at") if "created_at" in alerts.columns else F.lit(None).cast("string").alias("created_at"),
        F.coalesce(F.col("AccountNumber"), F.lit("UNKNOWN")).alias("AccountNumber"),
        *[c for c in alerts.columns if c not in ("alert_id", "type", "reason", "created_at", "AccountNumber")])


def ingest_transactions(raw: DataFrame, kept: list[DataFrame] | None = None, **rule_params) -> dict[str, DataFrame]:
    """ATM/UPI files: validated rows, quarantine, alerts, per-file counters.
    With ``kept``, the checked rows and the folded ones of the rules are kept,
    so that files are parsed and rows folded once; they are added to it, for
    the caller to release, also after an error."""
    def keep(df: DataFrame) -> DataFrame:
        if kept is not None:
            kept.append(df.persist())
        return df

    annotated = keep(validate_transactions(raw))
    good = valid_rows(annotated)
    # The counters read the alerts that are stored: kept in memory, they are raised once.
    alerts = normalize_alerts(rules_txn.fraud_detection(good, keep=keep, **rule_params))
    counters = file_counters(annotated, alerts)
    return {"valid": good, "quarantine": invalid_rows(annotated), "alerts": alerts, "counters": counters}


def ingest_accounts(raw: DataFrame, customers: DataFrame | None = None, as_of=None) -> dict[str, DataFrame]:
    """ACCOUNT files: documents, profile alerts (income from ``customers``:
    CustomerID, AnnualIncome), quarantine, counters."""
    # A small file holds many accounts whose parsing costs far more than their
    # bytes: rows are dealt to all cores, in turn, so that no split has them all.
    annotated = validate_accounts(raw.hint("rebalance"))
    good = valid_rows(annotated)
    docs = account_documents(good)
    flat = docs.select("AccountNumber", "CustomerID", "Account.*")
    alerts = rules_profile.profile_alerts(flat, customers, as_of=as_of)
    if "file_name" in good.columns:
        alerts = alerts.join(good.select("AccountNumber", "file_name").dropDuplicates(["AccountNumber"]),
                             "AccountNumber", "left")
    return {"documents": docs, "quarantine": invalid_rows(annotated), "alerts": alerts,
            "counters": file_counters(annotated, alerts if "file_name" in alerts.columns else None)}


def ingest_customers(raw: DataFrame) -> dict[str, DataFrame]:
    annotated = validate_customers(raw)
    return {"customers": valid_rows(annotated), "quarantine": invalid_rows(annotated),
            "counters": file_counters(annotated)}
