"""Reports (L1-L7)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..fixtures import AS_OF, fixture, with_fixtures
from ..operators import rules_txn
from ..plans import customer360 as c360
from ..plans import dims, report_state, reports
from ..plans.silver import silver_alerts
from ..session import checkpoint_dir
from ..sources.versions import VersionedTable
from . import export, register
from .alerts import VALID_SQL, _valid
from .c360 import _C360_SQL
from .inputs import accounts, kyc, transactions
from .model import _D2_SQL, _FACT_SQL, _dim_v2, _fact

_FACT_FX = ("fx_transactions", "fx_account", "fx_dim_v1")


@register("report_spend_income", with_fixtures(_FACT_FX, _FACT_SQL + """
select CustomerSK, sum(case when Amount < 0 then -Amount else 0.0 end) as Spend,
       sum(case when Amount > 0 then Amount else 0.0 end) as Income, count(*) as Transactions
from f group by CustomerSK"""))
def q_report_spend_income(spark, sf):
    return export(reports.spend_income(_fact(spark, sf)))


@register("report_channel_kpi", with_fixtures(_FACT_FX, _FACT_SQL + """
select Channel, count(*) as Transactions, sum(abs(Amount)) as Volume, round(avg(Amount), 6) as AvgAmount,
       round(count(*) filter (where TransactionStatus is not null and lower(TransactionStatus) <> 'success')
             / count(*), 6) as FailureRate
from f group by Channel"""))
def q_report_channel_kpi(spark, sf):
    return export(reports.channel_kpi(_fact(spark, sf)))


@register("report_trend_daily", with_fixtures(_FACT_FX, _FACT_SQL + """
select DateKey, count(*) as Transactions, sum(Amount) as NetAmount, sum(abs(Amount)) as Volume
from f group by DateKey"""))
def q_report_trend_daily(spark, sf):
    f = _fact(spark, sf)
    return export(reports.trend(f, dims.dim_date(transactions(spark, sf)), "DateKey"))


@register("report_trend_monthly", with_fixtures(_FACT_FX, _FACT_SQL + """
select strftime(strptime(cast(DateKey as varchar), '%Y%m%d'), '%Y-%m') as YearMonth, count(*) as Transactions,
       sum(Amount) as NetAmount, sum(abs(Amount)) as Volume
from f group by 1"""))
def q_report_trend_monthly(spark, sf):
    f = _fact(spark, sf)
    return export(reports.trend(f, dims.dim_date(transactions(spark, sf)), "YearMonth"))


@register("report_state_refresh", with_fixtures(_FACT_FX, _FACT_SQL + """,
g as (select * replace (case when cast(substring(Transaction_Date, 9, 2) as int) >= 10 then Amount * 2 else Amount end
                        as Amount) from f)
select 'channel' as report, Channel as grp, count(*) as Transactions, sum(abs(Amount)) as a, round(avg(Amount), 6) as b
from g group by Channel
union all
select 'month', strftime(strptime(cast(DateKey as varchar), '%Y%m%d'), '%Y-%m'), count(*), sum(Amount), sum(abs(Amount))
from g group by 2
union all select 'day', cast(DateKey as varchar), count(*), sum(Amount), sum(abs(Amount)) from g group by 2
union all
select 'customer', cast(CustomerSK as varchar), count(*), sum(case when Amount < 0 then -Amount else 0.0 end),
       sum(case when Amount > 0 then Amount else 0.0 end) from g group by 2"""))
def q_report_state_refresh(spark, sf):
    """Reports from state kept over two merges of the fact, the second into some of its days."""
    base = f"{checkpoint_dir(spark)}/ledgerloom-state-{uuid.uuid4().hex}"
    fact, rows = VersionedTable(spark, f"{base}/fact", ["Year", "Month"]), _fact(spark, sf)
    day = F.dayofmonth("Transaction_Date")
    for run, part in (("1", rows.filter(day <= 20)), ("2", rows.filter(day >= 10).withColumn("Amount", F.col("Amount") * 2))):
        fact.merge(part, ["TransactionID"], run, ["Amount"], moves=False)
        report_state.refresh_reports(spark, fact, f"{base}/state")
    daily, customers = (report_state.state_table(spark, f"{base}/state", n).read() for n in ("daily", "customers"))

    def out(report, df, grp, a, b):
        return df.select(F.lit(report).alias("report"), F.col(grp).cast("string").alias("grp"), "Transactions",
                         F.col(a).alias("a"), F.col(b).alias("b"))
    return export(out("channel", report_state.channel_kpi(daily), "Channel", "Volume", "AvgAmount")
                  .union(out("month", report_state.trend(daily, "YearMonth"), "YearMonth", "NetAmount", "Volume"))
                  .union(out("day", report_state.trend(daily), "DateKey", "NetAmount", "Volume"))
                  .union(out("customer", report_state.spend_income(customers), "CustomerSK", "Spend", "Income")))


@register("report_risk_by_segment", with_fixtures(
    ("fx_transactions", "fx_account", "fx_kyc"),
    _C360_SQL.rsplit("select CustomerID, FirstName", 1)[0] + """,
r as (select City, case when raw_score > 100 then 100.0 else raw_score end as RiskScore from s)
select City, round(avg(RiskScore), 6) as AvgRiskScore, round(max(RiskScore), 6) as MaxRiskScore,
       count(*) as Customers from r group by City"""))
def q_report_risk_by_segment(spark, sf):
    c = c360.customer360(transactions(spark, sf), accounts(spark, sf), kyc(spark, sf), as_of=AS_OF,
                         account_list=False)
    return export(reports.risk_by_segment(c, "City"))


@register("report_customer360", with_fixtures(("fx_dim_v1", "fx_dim_v2"), f"""{_D2_SQL}
select CustomerSK, CustomerID, FirstName, KYC_Tier, Total_Balance,
       strftime(EffectiveFrom, '%Y-%m-%d %H:%M:%S') as EffectiveFrom from d2 where CurrentFlag"""))
def q_report_customer360(spark, sf):
    return export(reports.customer360_view(_dim_v2(spark, sf)))


@register("report_alert_patterns", with_fixtures(("fx_txn_raw",), f"""with {VALID_SQL},
c as (select a.*, (select count(*) from valid b
                   where b.file_name = a.file_name and b.grp = a.grp and b.ts >= a.ts
                     and b.ts <= a.ts + interval {fx.VELOCITY_WINDOW_SEC} second) as n
      from valid a),
al as (select 'VELOCITY_ATTACK' as type, cast(n as varchar) || ' transactions' as reason, ts from c
       where n >= {fx.VELOCITY_COUNT}
       union all
       select 'HIGH_VALUE', 'Transaction amount', ts from valid where Amount >= {fx.HIGH_VALUE})
select type, case when lower(reason) like '%mismatch%' then 'HIGH'
                  when lower(reason) like '%unverified%' then 'MEDIUM' else 'LOW' end as severity,
       cast(cast(ts as date) as varchar) as day, count(*) as alerts
from al group by all"""))
def q_report_alert_patterns(spark, sf):
    v = _valid(spark, sf)
    a = (rules_txn.high_value(v, fx.HIGH_VALUE)
         .unionByName(rules_txn.velocity(v, fx.VELOCITY_COUNT, fx.VELOCITY_WINDOW_SEC),
                      allowMissingColumns=True))
    silver = silver_alerts(a.drop("anchor_ts"), as_of=AS_OF)
    return export(reports.alert_patterns(silver))


@register("bronze_ingest_columns", with_fixtures(("fx_txn_raw",), f"""
select file_name, TransactionID, '{AS_OF} 00:00:00' as ingest_ts, '{AS_OF}' as ingest_date,
       'fx_txn_raw' as ingest_source from fx_txn_raw"""))
def q_bronze_ingest_columns(spark, sf):
    raw = fixture(spark, sf, "fx_txn_raw").select("file_name", "TransactionID")
    return export(reports.with_ingest_columns(raw, as_of=f"{AS_OF} 00:00:00", source="fx_txn_raw"))
