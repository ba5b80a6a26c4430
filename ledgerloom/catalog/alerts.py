"""Validation and alert rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..fixtures import AS_OF, fixture, with_fixtures
from ..operators import rules_flags, rules_profile, rules_txn
from ..operators.scan import global_row_number, systematic_sample
from ..operators.validate import file_counters, invalid_rows, valid_rows, validate_transactions
from . import export, register
from .inputs import transactions

NUM_RE = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"

# Validation written directly in SQL: first non-empty of the two amount and
# time columns, commas removed, numeric text only, a fixed time layout.
def valid_sql(source: str = "fx_txn_raw") -> str:
    return VALID_SQL_TEMPLATE.replace("from fx_txn_raw))", f"from {source}))")


VALID_SQL_TEMPLATE = VALID_SQL = f"""v as (
  select file_name, nullif(trim(TransactionID), '') as TransactionID,
         nullif(trim(AccountNumber), '') as AccountNumber, nullif(trim(CustomerID), '') as CustomerID,
         Location,
         case when regexp_full_match(amt_s, '{NUM_RE}') then try_cast(amt_s as double) end as Amount,
         try_strptime(coalesce(nullif(trim(TransactionTime), ''), nullif(trim("Timestamp"), '')),
                      '%Y-%m-%d %H:%M:%S') as ts
  from (select *, cast(null as varchar) as "Timestamp",
               trim(replace(coalesce(nullif(trim(TransactionAmount), ''), nullif(trim(Amount), '')), ',', ''))
                 as amt_s
        from fx_txn_raw)),
ve as (select *, concat_ws(',',
          case when TransactionID is null then 'Missing TransactionID' end,
          case when Amount is null or Amount <= 0 then 'Invalid or non-positive Amount' end,
          case when ts is null then 'Invalid Timestamp' end) as errors from v),
valid as (select *, coalesce(CustomerID, AccountNumber, 'UNKNOWN') as grp from ve where errors = '')"""


def _iso(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%dT%H:%M:%S') || '+00:00'"


def _valid(spark, sf):
    return valid_rows(validate_transactions(fixture(spark, sf, "fx_txn_raw")))


_ALERT_OUT = ("alert_id", "type", "reason", "created_at", "file_name", "group_key",
              "AccountNumber", "TransactionID", "metric")


def _alert_export(df):
    return export(df.select(*_ALERT_OUT))


@register("validate_transactions", with_fixtures(("fx_txn_raw",), f"""
with {VALID_SQL}
select file_name, TransactionID, AccountNumber, CustomerID, Amount,
       strftime(ts, '%Y-%m-%d %H:%M:%S') as "Timestamp", errors from ve"""))
def q_validate_transactions(spark, sf):
    v = validate_transactions(fixture(spark, sf, "fx_txn_raw"))
    return export(v.select("file_name", "TransactionID", "AccountNumber", "CustomerID", "Amount",
                           "Timestamp", "errors"))


@register("quarantine_rows", with_fixtures(("fx_txn_raw",), f"""
with {VALID_SQL}
select file_name, TransactionID, errors from ve where errors <> ''"""))
def q_quarantine_rows(spark, sf):
    bad = invalid_rows(validate_transactions(fixture(spark, sf, "fx_txn_raw")))
    return export(bad.select("file_name", "TransactionID", "errors"))


@register("ingest_audit_counters", with_fixtures(("fx_txn_raw",), f"""
with {VALID_SQL},
hv as (select file_name, count(*) as n from valid where Amount >= {fx.HIGH_VALUE} group by file_name)
select e.file_name, count(*) as rows_parsed, count(*) filter (where errors = '') as valid,
       count(*) filter (where errors <> '') as invalid, count(*) filter (where errors <> '') as quarantined,
       coalesce(max(hv.n), 0) as alerts_generated
from ve e left join hv on e.file_name = hv.file_name group by e.file_name"""))
def q_ingest_audit_counters(spark, sf):
    annotated = validate_transactions(fixture(spark, sf, "fx_txn_raw"))
    alerts = rules_txn.high_value(valid_rows(annotated), fx.HIGH_VALUE)
    return file_counters(annotated, alerts)


@register("alerts_high_value", with_fixtures(("fx_txn_raw",), f"""
with {VALID_SQL}
select 'ALERT_HIGHVALUE_' || TransactionID as alert_id, 'HIGH_VALUE' as type,
       'Transaction amount ' || cast(Amount as varchar) || ' exceeds threshold {fx.HIGH_VALUE}' as reason,
       {_iso('ts')} as created_at, file_name, grp as group_key,
       coalesce(AccountNumber, 'UNKNOWN') as AccountNumber, TransactionID, Amount as metric
from valid where Amount >= {fx.HIGH_VALUE}"""))
def q_alerts_high_value(spark, sf):
    return _alert_export(rules_txn.high_value(_valid(spark, sf), fx.HIGH_VALUE))


_VEL_SQL = f"""with {VALID_SQL},
c as (select a.*, (select count(*) from valid b
                   where b.file_name = a.file_name and b.grp = a.grp
                     and (b.ts > a.ts or (b.ts = a.ts and b.TransactionID >= a.TransactionID))
                     and b.ts <= a.ts + interval {fx.VELOCITY_WINDOW_SEC} second) as n
      from valid a)
select 'ALERT_VELOCITY_' || grp || '_' || {_iso('ts')} as alert_id, 'VELOCITY_ATTACK' as type,
       cast(n as varchar) || ' transactions within {fx.VELOCITY_WINDOW_SEC // 60} minutes' as reason,
       {_iso('ts')} as created_at, file_name, grp as group_key,
       coalesce(AccountNumber, 'UNKNOWN') as AccountNumber, TransactionID, cast(n as double) as metric
from c where n >= {fx.VELOCITY_COUNT}"""


@register("alerts_velocity", with_fixtures(("fx_txn_raw",), _VEL_SQL))
def q_alerts_velocity(spark, sf):
    return _alert_export(rules_txn.velocity(_valid(spark, sf), fx.VELOCITY_COUNT,
                                            fx.VELOCITY_WINDOW_SEC))


ORACLES_GEO = f"""
with {VALID_SQL},
pairs as (select a.file_name, a.grp, a.ts, a.TransactionID, a.AccountNumber, a.Location, count(*) as n,
                 arg_max(coalesce(b.Location, 'None'), (b.ts, b.TransactionID)) as loc2
          from valid a join valid b
            on a.file_name = b.file_name and a.grp = b.grp
           and (b.ts > a.ts or (b.ts = a.ts and b.TransactionID > a.TransactionID))
           and b.ts <= a.ts + interval {fx.GEO_WINDOW_SEC} second
           and a.Location is distinct from b.Location
          group by all),
g as (select *, 'ALERT_GEO_' || grp || '_' || {_iso('ts')} as aid from pairs),
gk as (select *, sum(n) over (partition by aid) as total,
              row_number() over (partition by aid order by TransactionID desc) as k from g)
select aid as alert_id, 'GEO_LOCATION_SWITCH' as type,
       'Transaction from ' || coalesce(Location, 'None') || ' → ' || loc2 || ' within {fx.GEO_WINDOW_SEC // 60} minutes' as reason,
       {_iso('ts')} as created_at, file_name, grp as group_key,
       coalesce(AccountNumber, 'UNKNOWN') as AccountNumber, TransactionID, cast(total as double) as metric
from gk where k = 1"""


@register("alerts_geo_switch", with_fixtures(("fx_txn_raw",), ORACLES_GEO))
def q_alerts_geo_switch(spark, sf):
    return _alert_export(rules_txn.geo_switch(_valid(spark, sf), fx.GEO_WINDOW_SEC))


ORACLES_DRAIN = f"""
with {VALID_SQL},
r as (select *, min(ts) over (partition by file_name, grp) as st,
             sum(Amount) over (partition by file_name, grp order by ts, TransactionID
                               rows between unbounded preceding and current row) as run
      from valid),
h as (select *, row_number() over (partition by file_name, grp order by ts, TransactionID) as k
      from r where ts <= st + interval {fx.DRAIN_WINDOW_SEC} second and run >= {fx.DRAIN_AMOUNT})
select 'ALERT_BALANCE_DRAIN_' || grp || '_' || {_iso('ts')} as alert_id, 'BALANCE_DRAIN' as type,
       'Total withdrawals ' || cast(run as varchar) || ' in {fx.DRAIN_WINDOW_SEC // 60} minutes' as reason,
       {_iso('ts')} as created_at, file_name, grp as group_key,
       coalesce(AccountNumber, 'UNKNOWN') as AccountNumber, TransactionID, run as metric
from h where k = 1"""


@register("alerts_balance_drain", with_fixtures(("fx_txn_raw",), ORACLES_DRAIN))
def q_alerts_balance_drain(spark, sf):
    return _alert_export(rules_txn.balance_drain(_valid(spark, sf), fx.DRAIN_AMOUNT,
                                                 fx.DRAIN_WINDOW_SEC))


@register("alerts_collapsed", with_fixtures(("fx_txn_raw",), f"""
{_VEL_SQL.replace("select 'ALERT_VELOCITY_'", ", o as (select 'ALERT_VELOCITY_'", 1)}
),
q as (select *, row_number() over (partition by alert_id order by created_at desc, TransactionID desc) as k from o)
select alert_id, type, reason, created_at, file_name, group_key, AccountNumber, TransactionID, metric
from q where k = 1"""))
def q_alerts_collapsed(spark, sf):
    return _alert_export(rules_txn.velocity(_valid(spark, sf), fx.VELOCITY_COUNT,
                                            fx.VELOCITY_WINDOW_SEC, collapse=True))


_PROFILE_SQL = f"""with
p as (select AccountNumber, CustomerID, coalesce(Balance, 0.0) as bal, coalesce(AnnualIncome, 0.0) as inc,
             AnnualIncome is not null as known,
             upper(coalesce(KYC_Done, '')) as kd, upper(coalesce(KYC_DocumentVerificationStatus, '')) as kv,
             upper(coalesce(AccountStatus, '')) as st,
             floor(date_diff('day', cast(AccountOpenDate as date), date '{AS_OF}')) as days
      from fx_account),
a as (
  select AccountNumber, CustomerID, 'KYC_NOT_DONE' as type, 'KYC is not completed' as reason from p
   where kd in ('NO', 'FALSE', '0', 'N')
  union all
  select AccountNumber, CustomerID, 'KYC_VERIFICATION_FAILED', 'KYC verification failed' from p where kv = 'FAILED'
  union all
  select AccountNumber, CustomerID, 'ACCOUNT_DORMANT', 'Account is dormant or inactive' from p
   where st in ('DORMANT', 'INACTIVE')
  union all
  select AccountNumber, CustomerID, 'ACCOUNT_CLOSED', 'Account is closed' from p where st = 'CLOSED'
  union all
  select AccountNumber, CustomerID, 'BALANCE_INCOME_MISMATCH',
         'Balance ' || cast(bal as varchar) || ' greatly exceeds declared income ' || cast(inc as varchar)
    from p where known and inc > 0 and bal > inc * 10
  union all
  select AccountNumber, CustomerID, 'STALE_ACCOUNT', 'Account is very old and balance is too low' from p
   where days / 365 >= 5 and bal < 100)
select 'ALERT_' || type || '_' || AccountNumber as alert_id, type, AccountNumber, CustomerID, reason from a"""


@register("alerts_profile", with_fixtures(("fx_account",), _PROFILE_SQL))
def q_alerts_profile(spark, sf):
    a = rules_profile.profile_alerts(fixture(spark, sf, "fx_account"), as_of=AS_OF)
    return a.select("alert_id", "type", "AccountNumber", "CustomerID", "reason")


@register("alerts_profile_counts", with_fixtures(("fx_account",), _PROFILE_SQL.rsplit("select 'ALERT_'", 1)[0]
                                                 + "select type, count(*) as n from a group by type"))
def q_alerts_profile_counts(spark, sf):
    a = rules_profile.profile_alerts(fixture(spark, sf, "fx_account"), as_of=AS_OF)
    return a.groupBy("type").agg(F.count(F.lit(1)).alias("n"))


_ORDER_SQL = ("AccountNumber nulls first, Transaction_TS nulls first, Amount nulls first, "
              "Channel nulls first, Transaction_Type nulls first, Transaction_Status nulls first, "
              "Location_ID nulls first")
_FLAGS_SQL = f"""with
t as (select *, try_strptime(cast(Transaction_Date as varchar) || ' ' || Transaction_Time, '%Y-%m-%d %H:%M:%S')
               as Transaction_TS from fx_transactions),
f as (select *, abs(Amount) as AbsAmount,
             case when abs(Amount) > 10000 then 1 else 0 end as FLAG_HIGH_AMOUNT,
             case when lower(Transaction_Status) in ('failed', 'declined', 'rejected') then 1 else 0 end
               as FLAG_STATUS_FAIL,
             case when Channel = 'ATM' and abs(Amount) > 5000 then 1 else 0 end as FLAG_ATM_LARGE_WITHDRAW,
             case when Channel = 'UPI' and Amount > 8000 then 1 else 0 end as FLAG_UPI_ANOMALY,
             row_number() over (order by {_ORDER_SQL}) as RowNum
      from t),
g as (select *, case when RowNum % 3 = 0 then 1 else 0 end as FLAG_FORCE from f),
h as (select *, FLAG_HIGH_AMOUNT + FLAG_STATUS_FAIL + FLAG_ATM_LARGE_WITHDRAW + FLAG_UPI_ANOMALY + FLAG_FORCE
               as Flags_Count from g)"""


@register("flag_alerts", with_fixtures(("fx_transactions",), _FLAGS_SQL + """
select AccountNumber || '_' || strftime(Transaction_TS, '%Y-%m-%d %H:%M:%S') as AlertID, RowNum,
       Flags_Count, FLAG_HIGH_AMOUNT, FLAG_STATUS_FAIL, FLAG_ATM_LARGE_WITHDRAW, FLAG_UPI_ANOMALY, FLAG_FORCE,
       'HIGH' as FraudSeverity, AbsAmount
from h where Flags_Count > 0"""))
def q_flag_alerts(spark, sf):
    a = rules_flags.flag_alerts(transactions(spark, sf), as_of=AS_OF)
    return export(a.select("AlertID", "RowNum", "Flags_Count", "FLAG_HIGH_AMOUNT", "FLAG_STATUS_FAIL",
                           "FLAG_ATM_LARGE_WITHDRAW", "FLAG_UPI_ANOMALY", "FLAG_FORCE",
                           "FraudSeverity", "AbsAmount"))


@register("flag_counts", with_fixtures(("fx_transactions",), _FLAGS_SQL + """
select cast(sum(FLAG_HIGH_AMOUNT) as bigint) as high_amount, cast(sum(FLAG_STATUS_FAIL) as bigint) as status_fail,
       cast(sum(FLAG_ATM_LARGE_WITHDRAW) as bigint) as atm_large, cast(sum(FLAG_UPI_ANOMALY) as bigint) as upi_anomaly,
       cast(sum(FLAG_FORCE) as bigint) as forced, count(*) filter (where Flags_Count > 0) as high_rows from h"""))
def q_flag_counts(spark, sf):
    t = rules_flags.flag_transactions(transactions(spark, sf))
    return t.agg(F.sum("FLAG_HIGH_AMOUNT").alias("high_amount"), F.sum("FLAG_STATUS_FAIL").alias("status_fail"),
                 F.sum("FLAG_ATM_LARGE_WITHDRAW").alias("atm_large"),
                 F.sum("FLAG_UPI_ANOMALY").alias("upi_anomaly"), F.sum("FLAG_FORCE").alias("forced"),
                 F.count_if(F.col("Flags_Count") > 0).alias("high_rows"))


@register("systematic_sample", with_fixtures(("fx_transactions",), f"""
with t as (select *, try_strptime(cast(Transaction_Date as varchar) || ' ' || Transaction_Time,
                                  '%Y-%m-%d %H:%M:%S') as Transaction_TS from fx_transactions),
n as (select *, row_number() over (order by {_ORDER_SQL}) as row_number from t)
select AccountNumber, Transaction_Time, Amount, row_number from n where row_number % 7 = 0"""))
def q_systematic_sample(spark, sf):
    t = transactions(spark, sf).withColumn("Transaction_TS", rules_flags.transaction_ts())
    s = systematic_sample(t, 7, list(rules_flags.ORDER))
    return s.select("AccountNumber", "Transaction_Time", "Amount", "row_number")


@register("global_row_number", with_fixtures(("fx_txn_raw",), """
select file_name, TransactionID, AccountNumber,
       row_number() over (partition by file_name order by AccountNumber, TransactionID, TransactionTime) as rn
from fx_txn_raw"""))
def q_global_row_number(spark, sf):
    raw = fixture(spark, sf, "fx_txn_raw")
    r = global_row_number(raw, ["AccountNumber", "TransactionID", "TransactionTime"], "rn",
                          group=["file_name"])
    return r.select("file_name", "TransactionID", "AccountNumber", "rn")


@register("global_row_number_frequent", with_fixtures(("fx_txn_raw",), """
with k as (select case when cast(substring(AccountNumber, 3, 10) as int) % 3 = 0 then 'HOT' else AccountNumber end as k
           from fx_txn_raw),
n as (select k, row_number() over (order by k nulls first) as rn from k)
select k, min(rn) as first_rn, max(rn) as last_rn, count(*) as rows, count(distinct rn) as numbers from n group by k"""))
def q_global_row_number_frequent(spark, sf):
    """A third of the rows equal in the order column, in buckets of few rows."""
    raw = fixture(spark, sf, "fx_txn_raw")
    hot = F.when(F.substring("AccountNumber", 3, 10).cast("int") % 3 == 0, F.lit("HOT"))
    r = global_row_number(raw.withColumn("k", hot.otherwise(F.col("AccountNumber"))), ["k"], "rn", bucket_rows=200)
    return r.groupBy("k").agg(F.min("rn").alias("first_rn"), F.max("rn").alias("last_rn"),
                              F.count(F.lit(1)).alias("rows"), F.count_distinct("rn").alias("numbers"))


# ---- the same rules with one customer holding a third of the accounts ------
# The hot threshold is lowered so that the hot customer takes the
# range-partitioned scan path on the whole table (the default threshold,
# 2M rows, is above the test data). Results must not change.

HOT_ROWS = 500
_HOT_SQL = """fx_hot as (select * replace (case when cast(substring(AccountNumber, 3, 10) as int) % 3 = 0
                                               then 'C_HOT' else CustomerID end as CustomerID) from fx_txn_raw)"""


def _valid_hot(spark, sf):
    raw = fixture(spark, sf, "fx_txn_raw")
    hot = F.when(F.substring("AccountNumber", 3, 10).cast("int") % 3 == 0, F.lit("C_HOT"))
    return valid_rows(validate_transactions(raw.withColumn("CustomerID", hot.otherwise(F.col("CustomerID")))))


def _hot(sql: str) -> str:
    return sql.replace("with " + VALID_SQL, f"with {_HOT_SQL}, " + valid_sql("fx_hot"), 1)


@register("alerts_velocity_hot_key", with_fixtures(("fx_txn_raw",), _hot(_VEL_SQL)))
def q_alerts_velocity_hot_key(spark, sf):
    return _alert_export(rules_txn.velocity(_valid_hot(spark, sf), fx.VELOCITY_COUNT,
                                            fx.VELOCITY_WINDOW_SEC, hot_rows=HOT_ROWS))


@register("alerts_geo_switch_hot_key", with_fixtures(("fx_txn_raw",), _hot(ORACLES_GEO)))
def q_alerts_geo_switch_hot_key(spark, sf):
    return _alert_export(rules_txn.geo_switch(_valid_hot(spark, sf), fx.GEO_WINDOW_SEC, hot_rows=HOT_ROWS))


@register("alerts_balance_drain_hot_key", with_fixtures(("fx_txn_raw",), _hot(ORACLES_DRAIN)))
def q_alerts_balance_drain_hot_key(spark, sf):
    return _alert_export(rules_txn.balance_drain(_valid_hot(spark, sf), fx.DRAIN_AMOUNT,
                                                 fx.DRAIN_WINDOW_SEC, hot_rows=HOT_ROWS))


# ---- one customer holding a third of the rows, all inside the window -------
# The default threshold keeps it an ordinary group: the window path must be
# linear, and its results are the same as everywhere.

_DENSE_TIME = "'2024-01-15 10:00:' || lpad(cast(cast(substring(AccountNumber, 3, 10) as int) % 60 as {}), 2, '0')"
_DENSE_SQL = f"""fx_hot as (select * replace (
    case when cast(substring(AccountNumber, 3, 10) as int) % 3 = 0 then 'C_HOT' else CustomerID end as CustomerID,
    case when cast(substring(AccountNumber, 3, 10) as int) % 3 = 0 and TransactionTime <> 'not a date'
         then {_DENSE_TIME.format('varchar')} else TransactionTime end as TransactionTime) from fx_txn_raw)"""


def _dense(sql: str) -> str:
    return sql.replace("with " + VALID_SQL, f"with {_DENSE_SQL}, " + valid_sql("fx_hot"), 1)


def _valid_dense(spark, sf):
    raw = fixture(spark, sf, "fx_txn_raw")
    hot = F.substring("AccountNumber", 3, 10).cast("int") % 3 == 0
    return valid_rows(validate_transactions(raw.withColumns({
        "CustomerID": F.when(hot, F.lit("C_HOT")).otherwise(F.col("CustomerID")),
        "TransactionTime": F.when(hot & (F.col("TransactionTime") != "not a date"), F.expr(_DENSE_TIME.format("string")))
        .otherwise(F.col("TransactionTime"))})))


@register("alerts_velocity_dense", with_fixtures(("fx_txn_raw",), _dense(_VEL_SQL)))
def q_alerts_velocity_dense(spark, sf):
    return _alert_export(rules_txn.velocity(_valid_dense(spark, sf), fx.VELOCITY_COUNT, fx.VELOCITY_WINDOW_SEC))


@register("alerts_geo_dense", with_fixtures(("fx_txn_raw",), _dense(ORACLES_GEO)))
def q_alerts_geo_dense(spark, sf):
    return _alert_export(rules_txn.geo_switch(_valid_dense(spark, sf), fx.GEO_WINDOW_SEC))
