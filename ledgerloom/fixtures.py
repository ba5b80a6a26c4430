"""Adapters that shape the driver tables into banking inputs (FIXTURES.md §2).

The same SQL text runs in Spark (tables passed as DataFrame parameters) and in
DuckDB (inlined as CTEs in the oracle), so both sides start from identical rows.
Placeholders in braces name either a base table or an earlier fixture.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from .session import prepare

# The fixture definitions, in dependency order.
FIXTURE_SQL: dict[str, str] = {
    "fx_event": """
select event_id, user_id, event_type, date_trunc('second', ts) as ts,
       cast(floor(value * 100) as bigint) as amt,
       cast(regexp_extract(props, '([0-9]+)', 1) as int) as k,
       case when event_type in ('click','view','purchase') then 'ATM' else 'UPI' end as channel
from {events}""",
    "fx_txn_raw": """
select concat(lower(channel), '_', cast(cast(floor((extract(day from ts) - 1) / 10) as int) as string), '.csv') as file_name,
       case when event_id % 97 = 0 then '' else concat(' T', lpad(cast(event_id as string), 8, '0'), ' ') end as TransactionID,
       concat('AC', lpad(cast(user_id as string), 6, '0')) as AccountNumber,
       case when user_id % 10 = 9 then '' else concat('C', lpad(cast(cast(floor(user_id / 2) as bigint) as string), 6, '0')) end as CustomerID,
       case when event_id % 2 = 1 then '' when event_id % 89 = 0 then 'abc' when event_id % 83 = 0 then '-5'
            when amt >= 1000 then concat(cast(cast(floor(amt / 1000) as bigint) as string), ',', lpad(cast(amt % 1000 as string), 3, '0'))
            else cast(amt as string) end as TransactionAmount,
       cast(amt as string) as Amount,
       case when event_id % 79 = 0 then 'not a date' else cast(ts as string) end as TransactionTime,
       case when k % 5 = 4 then null else concat('L', cast(k % 5 as string)) end as Location,
       case when k % 7 = 0 then concat('12.', cast(k as string)) else concat('12.', cast(k as string), ',77.', cast(k as string)) end as GeoLocation,
       channel as Channel, event_type as TransactionType,
       case event_type when 'error' then 'Failed' when 'signup' then 'Declined' else 'Success' end as Status,
       '1000000' as BalanceBefore, cast(1000000 - amt as string) as BalanceAfter
from {fx_event}""",
    "fx_transactions": """
select concat('AC', lpad(cast(user_id as string), 6, '0')) as AccountNumber,
       cast(ts as date) as Transaction_Date, substring(cast(ts as string), 12, 8) as Transaction_Time,
       cast(case when event_type in ('click','view') then -amt else amt end as double) as Amount,
       channel as Channel, concat('L', cast(k % 5 as string)) as Location_ID, event_type as Transaction_Type,
       case event_type when 'error' then 'Failed' when 'signup' then 'Declined' else 'Success' end as Transaction_Status
from {fx_event}""",
    "fx_account": """
select concat('AC', lpad(cast(c_custkey as string), 6, '0')) as AccountNumber,
       concat('C', lpad(cast(cast(floor(c_custkey / 2) as bigint) as string), 6, '0')) as CustomerID,
       c_name as AccountHolderName, c_mktsegment as AccountType,
       case c_custkey % 11 when 0 then 'Dormant' when 1 then 'closed' when 2 then 'INACTIVE' else 'Active' end as AccountStatus,
       date '2015-01-01' + cast(c_custkey % 3000 as int) as AccountOpenDate,
       cast(floor(c_acctbal) as double) as Balance,
       case c_custkey % 7 when 0 then 'no' when 1 then 'N' when 2 then null else 'Yes' end as KYC_Done,
       case c_custkey % 9 when 0 then 'Failed' when 1 then null else 'Verified' end as KYC_DocumentVerificationStatus,
       cast(case when c_custkey % 13 = 0 then 0 else (c_custkey % 50) * 10 + 100 end as double) as AnnualIncome,
       date '1950-02-28' + cast((c_custkey * 37) % 20000 as int) as DOB,
       case when c_custkey % 5 = 0 then null else concat('City', cast(c_nationkey as string)) end as City
from {customer}""",
    "fx_kyc": """
select concat('C', lpad(cast(cast(floor(o_custkey / 2) as bigint) as string), 6, '0')) as CustomerID,
       concat('DOC', cast(o_orderkey as string)) as DocID,
       case o_orderstatus when 'F' then 'Verified' when 'O' then 'TRUE' else 'Pending' end as VerificationStatus,
       cast(o_orderdate as date) as IssueDate,
       case when o_orderkey % 7 = 0 then null else cast(o_orderdate as date) + 9000 end as ExpiryDate
from {orders}""",
    "fx_dim_v1": """
select concat('C', lpad(cast(c_custkey as string), 6, '0')) as CustomerID, c_name as FirstName,
       case when c_custkey % 6 = 0 then null else c_mktsegment end as KYC_Tier, cast(floor(c_acctbal) as double) as Total_Balance
from {customer} where c_custkey % 19 <> 0""",
    "fx_dim_v2": """
select concat('C', lpad(cast(c_custkey as string), 6, '0')) as CustomerID, c_name as FirstName,
       case when c_custkey % 6 = 0 and c_custkey % 4 = 0 then 'GOLD' when c_custkey % 6 = 0 then null
            when c_custkey % 14 = 1 then null else c_mktsegment end as KYC_Tier,
       cast(floor(c_acctbal) + case when c_custkey % 10 = 0 then 1 else 0 end as double) as Total_Balance
from {customer} where c_custkey % 17 <> 0""",
}

FIXTURE_DEPS: dict[str, tuple[str, ...]] = {
    "fx_event": ("events",),
    "fx_txn_raw": ("fx_event",),
    "fx_transactions": ("fx_event",),
    "fx_account": ("customer",),
    "fx_kyc": ("orders",),
    "fx_dim_v1": ("customer",),
    "fx_dim_v2": ("customer",),
}

# Fixture parameters (FIXTURES.md §3): thresholds lowered to the sparse test
# traffic; the library defaults stay the reference values.
AS_OF = "2024-01-31"
HIGH_VALUE = 20000.0
VELOCITY_COUNT = 3
VELOCITY_WINDOW_SEC = 24 * 3600
GEO_WINDOW_SEC = 6 * 3600
DRAIN_AMOUNT = 20000.0
DRAIN_WINDOW_SEC = 48 * 3600


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Build one fixture view as a Spark DataFrame over the driver tables."""
    prepare(spark)
    deps = {}
    for d in FIXTURE_DEPS[name]:
        deps[d] = fixture(spark, sf_dir, d) if d.startswith("fx_") else table(spark, sf_dir, d)
    return spark.sql(FIXTURE_SQL[name], **deps)


def _closure(names) -> list[str]:
    out: list[str] = []

    def visit(n):
        for d in FIXTURE_DEPS[n]:
            if d.startswith("fx_"):
                visit(d)
        if n not in out:
            out.append(n)
    for n in names:
        visit(n)
    return out


@lru_cache(maxsize=None)
def _plain(name: str) -> str:
    return FIXTURE_SQL[name].format(**{d: d for d in FIXTURE_DEPS[name]})


def with_fixtures(names: tuple[str, ...] | list[str], body: str) -> str:
    """DuckDB text: the needed fixtures as CTEs in front of ``body``.

    A body that starts with its own ``with`` has its CTEs appended to the
    fixture CTEs."""
    ctes = ",\n".join(f"{n} as ({_plain(n)})" for n in _closure(names))
    body = body.strip()
    if re.match(r"(?is)^with\s", body):
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"
