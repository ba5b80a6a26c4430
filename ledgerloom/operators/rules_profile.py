"""Account profile rules (G1-G7): one pass over account rows, 0-6 alerts each.

All six conditions are evaluated in one projection and fanned out with
``explode(filter(array(...)))`` - no per-rule scans or unions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..schemas import ACCOUNT_DOC_FIELDS, PROFILE_PAYLOAD_EXTRA

STALE_ACCOUNT_YEARS = 5
STALE_ACCOUNT_BALANCE_THRESHOLD = 100.0
INCOME_MULTIPLE = 10.0

# Trigger words of the KYC and status rules.
KYC_NOT_DONE_WORDS = ("NO", "FALSE", "0", "N")
DORMANT_WORDS = ("DORMANT", "INACTIVE")


def customer_lookup(profiles: DataFrame, order_col: str = "id") -> DataFrame:
    """One customer document per CustomerID (documents that carry a
    customer part; the one with the smallest document id wins)."""
    has = profiles.filter(F.col("Customer").isNotNull())
    return (has.groupBy("CustomerID")
            .agg(F.min_by(F.col("Customer"), F.col(order_col)).alias("Customer")))


def profile_alerts(accounts: DataFrame, customers: DataFrame | None = None,
                   income_col: str = "AnnualIncome", as_of=None,
                   stale_years: int = STALE_ACCOUNT_YEARS,
                   stale_balance: float = STALE_ACCOUNT_BALANCE_THRESHOLD,
                   income_multiple: float = INCOME_MULTIPLE) -> DataFrame:
    """G1-G7 over account rows (AccountNumber, CustomerID, KYC_Done,
    KYC_DocumentVerificationStatus, AccountStatus, Balance, AccountOpenDate).

    Income comes from ``customers`` (CustomerID, AnnualIncome; one row per
    customer - E3) when given, else from ``income_col`` on the account row.
    Without a known customer the income rule cannot fire.

    ``payload`` holds what the rule looked at: the account (``ACCOUNT_DOC_FIELDS``;
    absent ones NULL) for the KYC and status rules, ``Balance`` and ``income`` for
    the mismatch, ``Balance`` and ``age_years`` for the stale account."""
    a = accounts
    if customers is not None:
        a = a.join(customers.select("CustomerID", F.col("AnnualIncome").alias("_income_src")),
                   "CustomerID", "left")
        known = F.col("_income_src").isNotNull()
        income = C.default_zero(C.to_float(F.col("_income_src")))
    else:
        known = F.col(income_col).isNotNull() if income_col in a.columns else F.lit(False)
        income = C.default_zero(C.to_float(F.col(income_col))) if income_col in a.columns else F.lit(0.0)

    def s(name):
        return F.upper(F.coalesce(F.col(name).cast("string"), F.lit("")))

    bal = C.default_zero(C.to_float(F.col("Balance")))
    opened = C.parse_ts(F.col("AccountOpenDate"))
    days = F.floor((F.unix_micros(C.as_of_ts(as_of)) - F.unix_micros(opened)) / F.lit(86400e6))
    stale = opened.isNotNull() & (days / 365 >= stale_years) & (bal < stale_balance)

    def alert(kind, cond, reason):
        return F.when(cond, F.struct(F.lit(kind).alias("type"), reason.alias("reason")))

    fmt = C.float_text
    rules = F.array(
        alert("KYC_NOT_DONE", s("KYC_Done").isin(*KYC_NOT_DONE_WORDS), F.lit("KYC is not completed")),
        alert("KYC_VERIFICATION_FAILED", s("KYC_DocumentVerificationStatus") == "FAILED",
              F.lit("KYC verification failed")),
        alert("ACCOUNT_DORMANT", s("AccountStatus").isin(*DORMANT_WORDS),
              F.lit("Account is dormant or inactive")),
        alert("ACCOUNT_CLOSED", s("AccountStatus") == "CLOSED", F.lit("Account is closed")),
        alert("BALANCE_INCOME_MISMATCH", known & (income > 0) & (bal > income * income_multiple),
              F.concat(F.lit("Balance "), fmt(bal), F.lit(" greatly exceeds declared income "),
                       fmt(income))),
        alert("STALE_ACCOUNT", stale, F.lit("Account is very old and balance is too low")),
    )
    record = {f: F.col(f).cast("string") if f in a.columns else F.lit(None).cast("string") for f in ACCOUNT_DOC_FIELDS}
    record |= {"Balance": bal, "income": income, "age_years": days / 365}
    out = a.select("AccountNumber", "CustomerID", F.struct(*[c.alias(n) for n, c in record.items()]).alias("_r"),
                   F.explode(F.filter(rules, lambda x: x.isNotNull())).alias("_a"))
    return out.select(
        F.concat(F.lit("ALERT_"), F.col("_a.type"), F.lit("_"), F.col("AccountNumber")).alias("alert_id"),
        F.col("_a.type").alias("type"), "AccountNumber", "CustomerID",
        F.col("_a.reason").alias("reason"), _payload())


def _payload():
    """The fields of ``_r`` that an alert of ``_a.type`` carries."""
    whole = ~F.col("_a.type").isin("BALANCE_INCOME_MISMATCH", "STALE_ACCOUNT")
    shown = {"income": F.col("_a.type") == "BALANCE_INCOME_MISMATCH", "age_years": F.col("_a.type") == "STALE_ACCOUNT",
             "Balance": F.lit(True)}
    return F.struct(*[F.when(shown.get(f, whole), F.col(f"_r.{f}")).alias(f)
                      for f in (*ACCOUNT_DOC_FIELDS, *PROFILE_PAYLOAD_EXTRA)]).alias("payload")
