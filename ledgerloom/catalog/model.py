"""Dimensional model and merges."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import fixture, with_fixtures
from ..operators.merge import latest_per_key, scd2_merge, upsert
from ..operators.validate import validate_transactions
from ..plans import dims, fact
from ..plans.silver import keyed_distinct
from . import export, register
from .inputs import ACC_SQL, accounts, transactions

AS_OF_1 = "2024-01-01 00:00:00"
AS_OF_2 = "2024-01-31 00:00:00"
COMPARE = ("FirstName", "KYC_Tier", "Total_Balance")


def _dim_v1(spark, sf):
    return scd2_merge(None, fixture(spark, sf, "fx_dim_v1"), "CustomerID", COMPARE, AS_OF_1, "CustomerSK")


def _dim_v2(spark, sf):
    return scd2_merge(_dim_v1(spark, sf), fixture(spark, sf, "fx_dim_v2"), "CustomerID", COMPARE,
                      AS_OF_2, "CustomerSK")


_D1_SQL = f"""d1 as (select row_number() over (order by CustomerID) as CustomerSK, CustomerID, FirstName,
                 KYC_Tier, Total_Balance, timestamp '{AS_OF_1}' as EffectiveFrom,
                 cast(null as timestamp) as EffectiveTo, true as CurrentFlag
          from fx_dim_v1 where CustomerID is not null)"""

_D2_SQL = f"""with {_D1_SQL},
chg as (select d.CustomerID from d1 d join fx_dim_v2 s on d.CustomerID = s.CustomerID
        where d.FirstName is distinct from s.FirstName or d.KYC_Tier is distinct from s.KYC_Tier
           or d.Total_Balance is distinct from s.Total_Balance),
kept as (select CustomerSK, CustomerID, FirstName, KYC_Tier, Total_Balance, EffectiveFrom,
                case when CustomerID in (select CustomerID from chg) then timestamp '{AS_OF_2}'
                     else EffectiveTo end as EffectiveTo,
                CustomerID not in (select CustomerID from chg) as CurrentFlag
         from d1),
ins as (select * from fx_dim_v2 s where CustomerID is not null
        and CustomerID not in (select CustomerID from kept where CurrentFlag)),
new as (select (select max(CustomerSK) from d1) + row_number() over (order by CustomerID) as CustomerSK,
               CustomerID, FirstName, KYC_Tier, Total_Balance, timestamp '{AS_OF_2}' as EffectiveFrom,
               cast(null as timestamp) as EffectiveTo, true as CurrentFlag from ins),
d2 as (select * from kept union all select * from new)"""

_DIM_OUT = """CustomerSK, CustomerID, FirstName, KYC_Tier, Total_Balance,
       strftime(EffectiveFrom, '%Y-%m-%d %H:%M:%S') as EffectiveFrom,
       strftime(EffectiveTo, '%Y-%m-%d %H:%M:%S') as EffectiveTo, CurrentFlag"""


@register("scd2_first_load", with_fixtures(("fx_dim_v1",), f"with {_D1_SQL} select {_DIM_OUT} from d1"))
def q_scd2_first_load(spark, sf):
    return export(_dim_v1(spark, sf))


@register("scd2_second_load", with_fixtures(("fx_dim_v1", "fx_dim_v2"), f"{_D2_SQL} select {_DIM_OUT} from d2"))
def q_scd2_second_load(spark, sf):
    return export(_dim_v2(spark, sf))


@register("scd2_active", with_fixtures(("fx_dim_v1", "fx_dim_v2"), f"""{_D2_SQL}
select count(*) as total_rows, count(*) filter (where CurrentFlag) as active_rows,
       count(*) filter (where not CurrentFlag) as closed_rows,
       count(*) filter (where EffectiveFrom = timestamp '{AS_OF_2}') as new_versions from d2"""))
def q_scd2_active(spark, sf):
    d = _dim_v2(spark, sf)
    return d.agg(F.count(F.lit(1)).alias("total_rows"), F.count_if("CurrentFlag").alias("active_rows"),
                 F.count_if(~F.col("CurrentFlag")).alias("closed_rows"),
                 F.count_if(F.col("EffectiveFrom") == F.lit(AS_OF_2).cast("timestamp")).alias("new_versions"))


_DA_ROWS = """select distinct AccountNumber, AccountOpenDate, AccountStatus, AccountType, Balance,
       cast(null as varchar) as BankName, cast(null as varchar) as BranchName, cast(null as varchar) as Currency,
       cast(null as varchar) as IFSC_Code, Account_KYC_Done as Is_KYC_Done from acc"""
_DA_OUT = """AccountSK, AccountNumber, cast(AccountOpenDate as varchar) as AccountOpenDate, AccountStatus,
       AccountType, Balance, BankName, BranchName, Currency, IFSC_Code, Is_KYC_Done"""


@register("dim_account", with_fixtures(("fx_account",), f"""with {ACC_SQL},
r as ({_DA_ROWS})
select row_number() over (order by AccountNumber) as {_DA_OUT} from r"""))
def q_dim_account(spark, sf):
    return export(dims.dim_account(accounts(spark, sf)))


def _acct_num():
    return F.substring("AccountNumber", 3, 10).cast("int")


@register("dim_account_scd1", with_fixtures(("fx_account",), f"""with {ACC_SQL},
r as ({_DA_ROWS}),
d1 as (select row_number() over (order by AccountNumber) as AccountSK, * from r
       where cast(substring(AccountNumber, 3, 10) as int) % 4 <> 0),
src as (select AccountNumber, AccountOpenDate, upper(AccountStatus) as AccountStatus, AccountType, Balance + 1 as Balance,
               BankName, BranchName, Currency, IFSC_Code, Is_KYC_Done from r
        where cast(substring(AccountNumber, 3, 10) as int) % 5 <> 0),
m as (select d.AccountSK, s.* from d1 d join src s on d.AccountNumber = s.AccountNumber
      union all select * from d1 where AccountNumber not in (select AccountNumber from src)
      union all select (select max(AccountSK) from d1) + row_number() over (order by AccountNumber), *
                from src where AccountNumber not in (select AccountNumber from d1))
select {_DA_OUT} from m"""))
def q_dim_account_scd1(spark, sf):
    acc = accounts(spark, sf)
    d1 = dims.dim_account(acc.filter(_acct_num() % 4 != 0))
    changed = acc.filter(_acct_num() % 5 != 0).withColumns({
        "AccountStatus": F.upper("AccountStatus"), "Balance": F.col("Balance") + 1})
    return export(dims.dim_account(changed, current=d1))


@register("dim_date", with_fixtures(("fx_transactions",), """
with t as (select min(Transaction_Date) as lo, max(Transaction_Date) as hi from fx_transactions),
d as (select cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as Date from t)
select cast(Date as varchar) as Date, cast(year(Date) as int) as Year, cast(month(Date) as int) as Month,
       cast(day(Date) as int) as Day, cast(quarter(Date) as int) as Quarter, cast(weekofyear(Date) as int) as WeekOfYear,
       dayname(Date) as DayName, monthname(Date) as MonthName, strftime(Date, '%a') as ShortDayName,
       strftime(Date, '%b') as ShortMonthName, 'Q' || quarter(Date) as QuarterName,
       strftime(Date, '%Y-%m') as YearMonth, cast(dayofyear(Date) as int) as DayOfYear,
       cast(dayofweek(Date) + 1 as int) as DayOfWeek, cast(weekofyear(Date) as int) as ISOWeek,
       cast(strftime(Date, '%Y%m%d') as int) as DateKey,
       cast(year(Date - interval 3 month) as int) as FiscalYear,
       cast(quarter(Date - interval 3 month) as int) as FiscalQuarter,
       cast(month(Date - interval 3 month) as int) as FiscalMonth
from d"""))
def q_dim_date(spark, sf):
    return export(dims.dim_date(transactions(spark, sf)))


def _fact(spark, sf):
    txn, acc = transactions(spark, sf), accounts(spark, sf)
    return fact.fact_transactions(txn, acc, _dim_v1(spark, sf), dims.dim_account(acc))


_FACT_SQL = f"""with {ACC_SQL}, {_D1_SQL},
da as (select row_number() over (order by AccountNumber) as AccountSK, AccountNumber
       from (select distinct AccountNumber from acc)),
amap as (select AccountNumber, min(CustomerID) as CustomerID from acc group by AccountNumber),
t as (select *, row_number() over (partition by AccountNumber, Transaction_Date, Transaction_Time
                                   order by Amount, Channel, Transaction_Type, Transaction_Status, Location_ID) as rn
      from fx_transactions),
f as (select sha256(concat_ws('|', t.AccountNumber, cast(Transaction_Date as varchar), Transaction_Time,
                              cast(rn as varchar))) as TransactionID,
             d1.CustomerSK, da.AccountSK, cast(strftime(Transaction_Date, '%Y%m%d') as int) as DateKey,
             strftime(try_strptime(cast(Transaction_Date as varchar) || ' ' || Transaction_Time,
                                   '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') as TxnDateTime,
             cast(Transaction_Date as varchar) as Transaction_Date, Transaction_Time,
             cast(year(Transaction_Date) as int) as Year, cast(month(Transaction_Date) as int) as Month,
             Amount, Channel, Transaction_Type as TransactionType, Transaction_Status as TransactionStatus
      from t left join amap on t.AccountNumber = amap.AccountNumber
             left join d1 on amap.CustomerID = d1.CustomerID
             left join da on t.AccountNumber = da.AccountNumber)"""


@register("fact_transactions", with_fixtures(("fx_transactions", "fx_account", "fx_dim_v1"),
                                             _FACT_SQL + " select * from f"))
def q_fact_transactions(spark, sf):
    return export(_fact(spark, sf))


@register("fact_merge_rerun", with_fixtures(("fx_transactions", "fx_account", "fx_dim_v1"), _FACT_SQL + """
select TransactionID, CustomerSK, AccountSK, DateKey, Transaction_Date,
       case when cast(substring(Transaction_Date, 9, 2) as int) >= 10 then Amount * 2 else Amount end as Amount
from f"""))
def q_fact_merge_rerun(spark, sf):
    f = _fact(spark, sf)
    day = F.dayofmonth("Transaction_Date")
    target = f.filter(day <= 20)
    source = f.filter(day >= 10).withColumn("Amount", F.col("Amount") * 2)
    m = fact.fact_merge(target, source)
    return export(m.select("TransactionID", "CustomerSK", "AccountSK", "DateKey", "Transaction_Date", "Amount"))


@register("fact_key_coverage", with_fixtures(("fx_transactions", "fx_account", "fx_dim_v1"), _FACT_SQL + """
select count(*) as "rows", count(*) filter (where CustomerSK is null) as missing_customer_sk,
       count(*) filter (where AccountSK is null) as missing_account_sk,
       count(*) filter (where DateKey is null) as missing_date_key,
       count(distinct TransactionID) as distinct_ids from f"""))
def q_fact_key_coverage(spark, sf):
    return fact.key_coverage(_fact(spark, sf))


@register("keyed_distinct", with_fixtures(("fx_kyc",), """
select k.CustomerID, k.DocID, k.VerificationStatus, cast(k.IssueDate as varchar) as IssueDate,
       cast(k.ExpiryDate as varchar) as ExpiryDate
from fx_kyc k join (select CustomerID, min(DocID) as d from fx_kyc group by CustomerID) m
  on k.CustomerID = m.CustomerID and k.DocID = m.d"""))
def q_keyed_distinct(spark, sf):
    return export(keyed_distinct(fixture(spark, sf, "fx_kyc"), ["CustomerID"]))


@register("upsert_last_wins", with_fixtures(("fx_txn_raw",), """
with v as (select file_name, trim(TransactionID) as TransactionID, AccountNumber,
                  try_cast(Amount as double) as Amount,
                  try_strptime(TransactionTime, '%Y-%m-%d %H:%M:%S') as ts
           from fx_txn_raw),
ok as (select * from v where TransactionID <> '' and ts is not null),
src as (select * from ok where file_name not like '%\\_0.csv' escape '\\'),
tgt as (select * from ok where file_name like '%\\_0.csv' escape '\\'),
pick as (select AccountNumber, arg_max(TransactionID, (ts, TransactionID)) as TransactionID from src group by 1
         union all
         select AccountNumber, arg_max(TransactionID, (ts, TransactionID)) from tgt
         where AccountNumber not in (select AccountNumber from src) group by 1)
select AccountNumber, TransactionID from pick"""))
def q_upsert_last_wins(spark, sf):
    raw = fixture(spark, sf, "fx_txn_raw")
    v = validate_transactions(raw)
    ok = v.filter(F.col("TransactionID").isNotNull() & F.col("Timestamp").isNotNull()).select(
        "file_name", "AccountNumber", "TransactionID", "Timestamp")
    first = F.col("file_name").endswith("_0.csv")
    target = latest_per_key(ok.filter(first), ["AccountNumber"], ["Timestamp", "TransactionID"])
    out = upsert(target, ok.filter(~first), ["AccountNumber"], order=["Timestamp", "TransactionID"])
    return out.select("AccountNumber", "TransactionID")


@register("fact_partitioned_merge", with_fixtures(("fx_transactions", "fx_account", "fx_dim_v1"), _FACT_SQL + """
select TransactionID, cast(Year as int) as Year, cast(Month as int) as Month,
       case when cast(substring(Transaction_Date, 9, 2) as int) >= 10 then Amount * 2 else Amount end as Amount
from f"""))
def q_fact_partitioned_merge(spark, sf):
    import uuid
    from ..session import checkpoint_dir
    from ..sources.tables import PartitionedTable
    base = f"{checkpoint_dir(spark)}/ledgerloom-fact-{uuid.uuid4().hex}"
    t = PartitionedTable(spark, f"{base}/fact", ["Year", "Month"], f"{base}/_staging")
    f = _fact(spark, sf)
    day = F.dayofmonth("Transaction_Date")
    t.merge(f.filter(day <= 20), ["TransactionID"], "run1", ["Amount"], moves=False)   # B5: create
    t.merge(f.filter(day >= 10).withColumn("Amount", F.col("Amount") * 2), ["TransactionID"], "run2", ["Amount"], moves=False)
    return t.read().select("TransactionID", "Year", "Month", "Amount")


@register("ctas_fact", with_fixtures(("fx_transactions", "fx_account", "fx_dim_v1"), _FACT_SQL + """
select TransactionID, CustomerSK, AccountSK, DateKey, Amount, Channel, cast(Year as int) as Year,
       cast(Month as int) as Month, n as table_rows
from f, (select count(*) as n from f)"""))
def q_ctas_fact(spark, sf):
    import uuid
    from ..session import checkpoint_dir
    from ..sources.tables import count_and_preview, create_table_as_select
    tag = uuid.uuid4().hex[:12]
    name = f"ledgerloom_fact_{tag}"
    table = create_table_as_select(spark, name, _fact(spark, sf), ["Year", "Month"],
                                   path=f"{checkpoint_dir(spark)}/ledgerloom-ctas-{tag}")   # B13
    rows, _ = count_and_preview(table)                                                    # B14
    return table.select("TransactionID", "CustomerSK", "AccountSK", "DateKey", "Amount", "Channel",
                        "Year", "Month").withColumn("table_rows", F.lit(rows.first().rows))


# ---- merges on the cases a plain MERGE gets wrong ---------------------------

def _merge_table(spark, partition_by):
    import uuid
    from ..session import checkpoint_dir
    from ..sources.tables import PartitionedTable
    base = f"{checkpoint_dir(spark)}/ledgerloom-merge-{uuid.uuid4().hex}"
    return PartitionedTable(spark, f"{base}/table", partition_by, f"{base}/_staging")


def _orders(spark, sf):
    from ..fixtures import table
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"),
        F.nullif("o_orderstatus", F.lit("P")).alias("s"), F.round(F.col("o_totalprice"), 0).cast("long").alias("v"))


_ORDERS = """o as (select o_orderkey as k, o_custkey as c, nullif(o_orderstatus, 'P') as s,
                         cast(round(o_totalprice, 0) as bigint) as v from orders)"""


@register("merge_null_partition", f"""with {_ORDERS}
select k, s, case when k % 4 = 0 then v + 1 else v end as v from o""")
def q_merge_null_partition(spark, sf):
    """Rows with a NULL partition value survive a merge that brings such a row."""
    o, t = _orders(spark, sf).drop("c"), _merge_table(spark, ["s"])
    t.merge(o.filter("k % 2 = 0"), ["k"], "1", ["v"])
    t.merge(o.filter("k % 2 = 1").unionByName(o.filter("k % 4 = 0").withColumn("v", F.col("v") + 1)), ["k"], "2", ["v"])
    return t.read().select("k", "s", "v")


@register("merge_pinned_reader", f"""with {_ORDERS}
select 'before' as seen, k, s, v from o where k % 2 = 0
union all select 'after', k, case when k % 4 = 0 then 'moved' else s end, case when k % 4 = 0 then v + 1 else v end from o
union all select 'changed', null, s, null from (select distinct s from o union select 'moved')""")
def q_merge_pinned_reader(spark, sf):
    """A reader of the version before a merge that moves keys sees its rows whole."""
    import uuid
    from ..session import checkpoint_dir
    from ..sources.versions import VersionedTable
    o = _orders(spark, sf).drop("c")
    t = VersionedTable(spark, f"{checkpoint_dir(spark)}/ledgerloom-versions-{uuid.uuid4().hex}", ["s"])
    t.merge(o.filter("k % 2 = 0"), ["k"], "1", ["v"])
    pinned = t.read().select(F.lit("before").alias("seen"), "k", "s", "v")
    moved = o.filter("k % 4 = 0").withColumns({"v": F.col("v") + 1, "s": F.lit("moved")})
    t.merge(o.filter("k % 2 = 1").unionByName(moved), ["k"], "2", ["v"])
    changed = t.partition_frame(t.changed_since(1), t.read().schema).select(
        F.lit("changed").alias("seen"), F.lit(None).cast("long").alias("k"), "s", F.lit(None).cast("long").alias("v"))
    return pinned.union(t.read().select(F.lit("after").alias("seen"), "k", "s", "v")).union(changed)


@register("merge_null_key_rerun", f"""with {_ORDERS},
n as (select case when k % 5 = 0 then null else k end as k, c, max(v) as v from o group by 1, 2)
select k, c, v from n""")
def q_merge_null_key_rerun(spark, sf):
    """A run repeated on rows with NULL keys inserts nothing twice."""
    o, t = _orders(spark, sf).drop("s"), _merge_table(spark, ["b"])
    rows = o.withColumns({"k": F.when(F.col("k") % 5 != 0, F.col("k")), "b": F.col("c") % 8})
    t.merge(rows, ["k", "c"], "1", ["v"])
    t.merge(rows, ["k", "c"], "2", ["v"])
    return t.read().select("k", "c", "v")


@register("merge_first_load_duplicates", f"""with {_ORDERS},
l as (select c, max(k) as k from o where k % 3 <> 0 group by c),
a as (select c, max(k) as k from o group by c)
select 'snapshot' as kind, a.c, a.k from a
union all select 'partitioned', l.c, l.k from l""")
def q_merge_first_load_duplicates(spark, sf):
    """One row per key, the last in order, on the first load too."""
    import uuid
    from ..session import checkpoint_dir
    from ..sources.tables import SnapshotTable
    o = _orders(spark, sf).select("c", "k", (F.col("c") % 4).alias("b"))
    t = _merge_table(spark, ["b"])
    t.merge(o.filter("k % 3 <> 0"), ["c"], "1", ["k"])
    snap = SnapshotTable(spark, f"{checkpoint_dir(spark)}/ledgerloom-merge-{uuid.uuid4().hex}")
    snap.merge(o.filter("k % 3 <> 0"), ["c"], ["k"])
    snap.merge(o, ["c"], ["k"])
    return (snap.read().select(F.lit("snapshot").alias("kind"), "c", "k")
            .unionByName(t.read().select(F.lit("partitioned").alias("kind"), "c", "k")))


@register("merge_moved_key", f"""with {_ORDERS}
select k, case when k % 10 = 0 or coalesce(s, '-') = 'F' then 'moved' else coalesce(s, '-') end as s, v from o""")
def q_merge_moved_key(spark, sf):
    """A key whose partition value changes leaves no old row; a partition all of
    whose rows move away is gone."""
    o, t = _orders(spark, sf).drop("c").fillna("-", ["s"]), _merge_table(spark, ["s"])
    t.merge(o, ["k"], "1", ["v"])
    t.merge(o.filter("k % 10 = 0 or s = 'F'").withColumn("s", F.lit("moved")), ["k"], "2", ["v"])
    return t.read().select("k", "s", "v")
