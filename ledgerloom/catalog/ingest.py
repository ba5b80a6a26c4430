"""Ingestion, cleaning, routing, documents, silver channels (A1-A13, B1-B11,
C1-C14, D2-D7, E1-E5, H4-H6, I1-I2)."""

from __future__ import annotations

import uuid
from itertools import accumulate

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..fixtures import AS_OF, fixture, with_fixtures
from ..functions import columns as C
from ..operators import rules_profile
from ..operators.validate import valid_rows, validate_accounts, validate_customers, validate_transactions
from ..plans import ingest
from ..plans.silver import silver_alerts, silver_atm, silver_upi, union_channels
from ..session import checkpoint_dir
from ..sources import documents as D
from ..sources import shapes
from ..sources.files import list_files
from ..streaming.file_stream import read_audit, start_ingest_stream
from . import export, register
from .alerts import NUM_RE, VALID_SQL


@register("clean_scalars", with_fixtures(("fx_txn_raw",), f"""
with s as (select *, trim(replace(coalesce(nullif(trim(TransactionAmount), ''), nullif(trim(Amount), '')), ',', ''))
                  as amt_s,
                  try_strptime(nullif(trim(TransactionTime), ''), '%Y-%m-%d %H:%M:%S') as ts
           from fx_txn_raw)
select trim(TransactionID) as txn_id, nullif(trim(TransactionID), '') as txn_id_or_null,
       case when regexp_full_match(amt_s, '{NUM_RE}') then try_cast(amt_s as double) end as amount,
       case when regexp_full_match(trim(replace(TransactionAmount, ',', '')), '{NUM_RE}')
            then try_cast(trim(replace(TransactionAmount, ',', '')) as double) end as amount_primary,
       strftime(ts, '%Y-%m-%d %H:%M:%S') as ts, strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' as ts_iso,
       coalesce(try_cast(BalanceAfter as double), 0.0) as balance_after
from s"""))
def q_clean_scalars(spark, sf):
    raw = fixture(spark, sf, "fx_txn_raw")
    ts = C.parse_ts("TransactionTime")
    return export(raw.select(
        C.strip("TransactionID").alias("txn_id"), C.blank_to_null("TransactionID").alias("txn_id_or_null"),
        C.to_float(C.first_non_empty("TransactionAmount", "Amount")).alias("amount"),
        C.to_float("TransactionAmount").alias("amount_primary"),
        ts.alias("ts"), C.iso_utc(ts).alias("ts_iso"),
        C.default_zero(C.to_float("BalanceAfter")).alias("balance_after")))


@register("clean_flags", with_fixtures(("fx_account",), """
select AccountNumber,
       case when lower(trim(KYC_Done)) in ('yes', 'true', '1', 'y') then true
            when lower(trim(KYC_Done)) in ('no', 'false', '0', 'n') then false end as kyc_done,
       coalesce(lower(KYC_DocumentVerificationStatus) in ('verified', 'true'), false) as verified,
       case when KYC_DocumentVerificationStatus is null then 'CUSTOMER_' || CustomerID
            else AccountNumber end as doc_id
from fx_account"""))
def q_clean_flags(spark, sf):
    a = fixture(spark, sf, "fx_account")
    return a.select("AccountNumber", C.to_bool("KYC_Done").alias("kyc_done"),
                    C.truthy_status("KYC_DocumentVerificationStatus").alias("verified"),
                    C.surrogate_id(F.when(F.col("KYC_DocumentVerificationStatus").isNotNull(),
                                          F.col("AccountNumber")), F.col("CustomerID")).alias("doc_id"))


_ROUTE_NAMES = """
n as (select distinct file_name from fx_txn_raw),
v as (select file_name as name from n
      union all select upper(file_name) from n
      union all select replace(file_name, '.csv', '.txt') from n
      union all select 'customer_' || file_name from n
      union all select 'Account_master_' || replace(replace(file_name, 'atm', 'x'), 'upi', 'y') from n
      union all select 'CUSTOMER_master_' || replace(replace(file_name, 'atm', 'x'), 'upi', 'y') from n
      union all select 'login_' || replace(replace(file_name, 'atm', 'x'), 'upi', 'y') from n)"""


@register("route_source_type", with_fixtures(("fx_txn_raw",), f"""with {_ROUTE_NAMES}
select name as file_name,
       case when lower(name) like '%atm%' then 'ATM' when lower(name) like '%upi%' then 'UPI'
            when lower(name) like '%account%' then 'ACCOUNT' when lower(name) like '%customer%' then 'CUSTOMER'
            else 'UNKNOWN' end as source_type,
       name like '%.csv' as is_csv
from v"""))
def q_route_source_type(spark, sf):
    n = fixture(spark, sf, "fx_txn_raw").select("file_name").distinct()
    x = F.replace(F.replace("file_name", F.lit("atm"), F.lit("x")), F.lit("upi"), F.lit("y"))
    names = (n.select(F.col("file_name").alias("name"))
             .unionByName(n.select(F.upper("file_name").alias("name")))
             .unionByName(n.select(F.replace("file_name", F.lit(".csv"), F.lit(".txt")).alias("name")))
             .unionByName(n.select(F.concat(F.lit("customer_"), "file_name").alias("name")))
             .unionByName(n.select(F.concat(F.lit("Account_master_"), x).alias("name")))
             .unionByName(n.select(F.concat(F.lit("CUSTOMER_master_"), x).alias("name")))
             .unionByName(n.select(F.concat(F.lit("login_"), x).alias("name"))))
    # A10: names arrive as URLs; the last path segment is the file name.
    urls = names.select(F.concat(F.lit("https://store.example/landing/"), "name").alias("url"))
    fname = C.file_name_of(F.col("url"))
    return urls.select(fname.alias("file_name"), C.source_type(fname).alias("source_type"),
                       C.is_csv_name(fname).alias("is_csv"))


def _account_text(spark, sf):
    a = fixture(spark, sf, "fx_account")
    return a.select(*[F.col(c).cast("string").alias(c) for c in a.columns])


@register("validate_accounts", with_fixtures(("fx_account",), """
select AccountNumber, concat_ws(',',
         case when AccountNumber is null then 'Missing AccountNumber' end,
         case when CustomerID is null then 'Missing CustomerID' end,
         case when Balance is null then 'Invalid Balance' end,
         case when AccountOpenDate is null then 'Invalid AccountOpenDate' end) as errors
from fx_account"""))
def q_validate_accounts(spark, sf):
    return export(validate_accounts(_account_text(spark, sf)).select("AccountNumber", "errors"))


@register("validate_customers", with_fixtures(("fx_account",), """
select CustomerID, AccountNumber, concat_ws(',',
         case when CustomerID is null then 'Missing CustomerID' end,
         case when DOB is null then 'Invalid DOB' end,
         case when AnnualIncome is null then 'Invalid AnnualIncome' end) as errors
from fx_account"""))
def q_validate_customers(spark, sf):
    return export(validate_customers(_account_text(spark, sf)).select("CustomerID", "AccountNumber", "errors"))


@register("flatten_documents", with_fixtures(("fx_account",), """
select AccountNumber as id, AccountNumber, CustomerID,
       AccountHolderName as Account_AccountHolderName, AccountType as Account_AccountType,
       AccountStatus as Account_AccountStatus,
       strftime(AccountOpenDate, '%Y-%m-%dT%H:%M:%S') || '+00:00' as Account_AccountOpenDate,
       cast(Balance as varchar) as Account_Balance, KYC_Done as Account_KYC_Done,
       KYC_DocumentVerificationStatus as Account_KYC_DocumentVerificationStatus
from fx_account"""))
def q_flatten_documents(spark, sf):
    docs = ingest.account_documents(valid_rows(validate_accounts(_account_text(spark, sf))))
    b = D.bronze(docs, numeric_fields=["Account_Balance"])
    return b.select("id", "AccountNumber", "CustomerID", "Account_AccountHolderName", "Account_AccountType",
                    "Account_AccountStatus", "Account_AccountOpenDate", "Account_Balance",
                    "Account_KYC_Done", "Account_KYC_DocumentVerificationStatus")


@register("merge_customer_profiles", with_fixtures(("fx_account", "fx_dim_v2"), """
with p as (select AccountNumber as id, AccountNumber, CustomerID from fx_account
           where cast(substring(AccountNumber, 3, 10) as int) % 3 <> 0),
c as (select CustomerID, FirstName, KYC_Tier from fx_dim_v2)
select coalesce(p.id, 'CUSTOMER_' || c.CustomerID) as id, p.AccountNumber,
       coalesce(p.CustomerID, c.CustomerID) as CustomerID, c.FirstName, c.KYC_Tier,
       case when c.CustomerID is not null then 0.0 end as AnnualIncome
from p full outer join c on p.CustomerID = c.CustomerID"""))
def q_merge_customer_profiles(spark, sf):
    acc = _account_text(spark, sf).filter(F.substring("AccountNumber", 3, 10).cast("int") % 3 != 0)
    docs = ingest.merge_accounts_into_profiles(None, ingest.account_documents(acc))
    cust = fixture(spark, sf, "fx_dim_v2").select("CustomerID", "FirstName", "KYC_Tier")
    m = ingest.merge_customer_profiles(docs, cust)
    return m.select("id", "AccountNumber", "CustomerID", F.col("Customer.FirstName").alias("FirstName"),
                    F.col("Customer.KYC_Tier").alias("KYC_Tier"),
                    F.col("Customer.AnnualIncome").alias("AnnualIncome"))


def _atm_bronze(raw):
    return raw.filter(F.col("Channel") == "ATM").select(
        "TransactionID", "AccountNumber", "CustomerID", "Amount", "TransactionTime",
        F.col("Location").alias("ATMID"), "TransactionType", F.col("Status").alias("TransactionStatus"),
        "BalanceBefore", "BalanceAfter")


def _upi_bronze(raw):
    return raw.filter(F.col("Channel") == "UPI").select(
        "TransactionID", "AccountNumber", "CustomerID", "Amount", "TransactionTime", "GeoLocation",
        F.col("Location").alias("Payer_UPI_ID"), "TransactionType", "Status", "BalanceBefore", "BalanceAfter")


_SILVER_TXN_SQL = """
atm as (select distinct TransactionID, AccountNumber, CustomerID, try_cast(Amount as double) as Amount,
               Location as ATM_ID, TransactionType as Transaction_Type, Status as Transaction_Status,
               try_cast(BalanceBefore as double) as BalanceBefore, try_cast(BalanceAfter as double) as BalanceAfter,
               try_cast(BalanceAfter as double) - try_cast(BalanceBefore as double) as BalanceChange,
               cast(try_strptime(TransactionTime, '%Y-%m-%d %H:%M:%S') as date) as Transaction_Date,
               strftime(try_strptime(TransactionTime, '%Y-%m-%d %H:%M:%S'), '%H:%M:%S') as Transaction_Time
        from fx_txn_raw where Channel = 'ATM'),
upi as (select distinct TransactionID, AccountNumber, CustomerID, try_cast(Amount as double) as Amount,
               split_part(GeoLocation, ',', 1) as Geo_Lat,
               case when GeoLocation like '%,%' then split_part(GeoLocation, ',', 2) end as Geo_Long,
               Location as Payer_UPI_ID, TransactionType, Status,
               try_cast(BalanceBefore as double) as BalanceBefore, try_cast(BalanceAfter as double) as BalanceAfter,
               cast(try_strptime(TransactionTime, '%Y-%m-%d %H:%M:%S') as date) as Transaction_Date,
               strftime(try_strptime(TransactionTime, '%Y-%m-%d %H:%M:%S'), '%H:%M:%S') as Transaction_Time
        from fx_txn_raw where Channel = 'UPI')"""


@register("silver_atm", with_fixtures(("fx_txn_raw",), f"""with {_SILVER_TXN_SQL}
select TransactionID, AccountNumber, CustomerID, Amount, ATM_ID, Transaction_Type, Transaction_Status,
       BalanceBefore, BalanceAfter, BalanceChange, cast(Transaction_Date as varchar) as Transaction_Date,
       Transaction_Time from atm"""))
def q_silver_atm(spark, sf):
    return export(silver_atm(_atm_bronze(fixture(spark, sf, "fx_txn_raw"))))


@register("silver_upi", with_fixtures(("fx_txn_raw",), f"""with {_SILVER_TXN_SQL}
select TransactionID, AccountNumber, CustomerID, Amount, Geo_Lat, Geo_Long, Payer_UPI_ID, TransactionType,
       Status, BalanceBefore, BalanceAfter, cast(Transaction_Date as varchar) as Transaction_Date,
       Transaction_Time from upi"""))
def q_silver_upi(spark, sf):
    return export(silver_upi(_upi_bronze(fixture(spark, sf, "fx_txn_raw"))))


@register("union_channels", with_fixtures(("fx_txn_raw",), f"""with {_SILVER_TXN_SQL},
u as (select AccountNumber, Transaction_Date, Transaction_Time, Amount, 'ATM' as Channel, ATM_ID as Location_ID,
             Transaction_Type, Transaction_Status from atm
      union all
      select AccountNumber, Transaction_Date, Transaction_Time, Amount, 'UPI', Payer_UPI_ID, TransactionType,
             Status from upi)
select AccountNumber, cast(Transaction_Date as varchar) as Transaction_Date, Transaction_Time, Amount, Channel,
       Location_ID, Transaction_Type, Transaction_Status from u"""))
def q_union_channels(spark, sf):
    raw = fixture(spark, sf, "fx_txn_raw")
    return export(union_channels(silver_atm(_atm_bronze(raw)), silver_upi(_upi_bronze(raw))))


@register("silver_alerts", with_fixtures(("fx_account",), f"""
with a as (
  select AccountNumber, 'KYC_NOT_DONE' as type from fx_account where upper(coalesce(KYC_Done, '')) in ('NO', 'FALSE', '0', 'N')
  union all select AccountNumber, 'KYC_VERIFICATION_FAILED' from fx_account
   where upper(coalesce(KYC_DocumentVerificationStatus, '')) = 'FAILED'
  union all select AccountNumber, 'ACCOUNT_DORMANT' from fx_account where upper(coalesce(AccountStatus, '')) in ('DORMANT', 'INACTIVE')
  union all select AccountNumber, 'ACCOUNT_CLOSED' from fx_account where upper(coalesce(AccountStatus, '')) = 'CLOSED'
  union all select AccountNumber, 'BALANCE_INCOME_MISMATCH' from fx_account
   where coalesce(AnnualIncome, 0) > 0 and coalesce(Balance, 0) > coalesce(AnnualIncome, 0) * 10
  union all select AccountNumber, 'STALE_ACCOUNT' from fx_account
   where date_diff('day', AccountOpenDate, date '{AS_OF}') / 365 >= 5 and coalesce(Balance, 0) < 100)
select 'ALERT_' || type || '_' || AccountNumber as alert_id, type, AccountNumber,
       case when lower(type) like '%mismatch%' then 'HIGH' when lower(type) like '%unverified%' then 'MEDIUM'
            else 'LOW' end as AlertSeverity, '{AS_OF}' as AlertDate
from a"""))
def q_silver_alerts(spark, sf):
    a = rules_profile.profile_alerts(fixture(spark, sf, "fx_account"), as_of=AS_OF)
    docs = ingest.normalize_alerts(a.select("alert_id", "type", "reason", "AccountNumber"))
    s = silver_alerts(docs, as_of=AS_OF, reason_col="type")
    return export(s.select("alert_id", "type", "AccountNumber", "AlertSeverity", "AlertDate"))


_RICH_ACCOUNT = """'Bank ' || AccountType as BankName, 'Branch ' || City as BranchName,
       'IF' || substring(AccountNumber, 3, 10) as IFSC_Code, 'DOC' || CustomerID as KYC_DocID,
       case when cast(substring(AccountNumber, 3, 10) as int) % 3 = 0 then 'INR' else 'EUR' end as Currency"""
_RICH_KYC = """case when AccountStatus <> 'Active' and cast(substring(AccountNumber, 3, 10) as int) % 2 = 0
       then 'True' else KYC_Done end"""


@register("silver_alerts_payload", with_fixtures(("fx_account", "fx_txn_raw"), f"""with {VALID_SQL},
inc as (select CustomerID, max(AnnualIncome) as inc from fx_account group by CustomerID),
acc as (select * replace ({_RICH_KYC} as KYC_Done), {_RICH_ACCOUNT} from fx_account
        where CustomerID is not null and Balance is not null and AccountOpenDate is not null),
x as (select acc.*, inc.inc, date_diff('day', AccountOpenDate, date '{AS_OF}') / 365 as age
      from acc join inc on acc.CustomerID = inc.CustomerID),
r as (select *, 'KYC_NOT_DONE' as type, true as w from x where upper(KYC_Done) in ('NO', 'FALSE', '0', 'N')
      union all select *, 'KYC_VERIFICATION_FAILED', true from x where upper(KYC_DocumentVerificationStatus) = 'FAILED'
      union all select *, 'ACCOUNT_DORMANT', true from x where upper(AccountStatus) in ('DORMANT', 'INACTIVE')
      union all select *, 'ACCOUNT_CLOSED', true from x where upper(AccountStatus) = 'CLOSED'
      union all select *, 'BALANCE_INCOME_MISMATCH', false from x where inc > 0 and Balance > inc * 10
      union all select *, 'STALE_ACCOUNT', false from x where age >= 5 and Balance < 100)
select 'ALERT_' || type || '_' || AccountNumber as alert_id, type, AccountNumber,
       case when w then AccountHolderName end as AccountHolderName, case when w then BankName end as BankName,
       case when w then BranchName end as BranchName, case when w then IFSC_Code end as IFSC_Code,
       case when w then AccountType end as AccountType, case when w then AccountStatus end as AccountStatus,
       case when w then cast(AccountOpenDate as varchar) end as AccountOpenDate, Balance,
       case when w then Currency end as Currency,
       w and lower(coalesce(KYC_Done, '')) in ('verified', 'true') as KYC_Done,
       case when w then KYC_DocID end as KYC_DocID,
       case when w then KYC_DocumentVerificationStatus end as KYC_VerificationStatus,
       case when type = 'BALANCE_INCOME_MISMATCH' then inc end as income,
       case when type = 'STALE_ACCOUNT' then round(age, 6) end as age_years,
       cast(null as varchar) as txn, cast(null as double) as txn_amount, cast(null as varchar) as txn_time,
       cast(null as varchar) as txn_raw_time, cast(null as varchar) as txn_location,
       'LOW' as AlertSeverity
from r
union all
select 'ALERT_HIGHVALUE_' || TransactionID, 'HIGH_VALUE', coalesce(AccountNumber, 'UNKNOWN'), null, null, null, null,
       null, null, null, null, null, false, null, null, null, null, TransactionID, Amount,
       strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00', strftime(ts, '%Y-%m-%d %H:%M:%S'), Location, 'LOW'
from valid where Amount >= {fx.HIGH_VALUE}"""))
def q_silver_alerts_payload(spark, sf):
    """Alerts with what they are about, from both ingestion paths: stored as
    structs, flattened in bronze, the twelve account fields renamed in silver."""
    from ..operators.rules_txn import high_value
    from ..plans.lakehouse import alert_documents
    from ..sources.documents import flatten
    acc = fixture(spark, sf, "fx_account")
    income = acc.groupBy("CustomerID").agg(F.max("AnnualIncome").alias("AnnualIncome"))
    rich = spark.sql(f"select *, {_RICH_ACCOUNT} from {{acc}}", acc=acc.withColumn("KYC_Done", F.expr(_RICH_KYC)))
    text = rich.select(*[F.col(c).cast("string").alias(c) for c in rich.columns])
    good = valid_rows(validate_transactions(fixture(spark, sf, "fx_txn_raw")))
    docs = alert_documents(ingest.normalize_alerts(high_value(good, fx.HIGH_VALUE)),
                           ingest.ingest_accounts(text.withColumn("file_name", F.lit("account_master.csv")), income,
                                                  as_of=AS_OF)["alerts"])
    s = silver_alerts(flatten(docs), as_of=AS_OF)
    return export(s.select(
        "alert_id", "type", "AccountNumber", "AccountHolderName", "BankName", "BranchName", "IFSC_Code", "AccountType",
        "AccountStatus", F.col("AccountOpenDate").cast("string").alias("AccountOpenDate"), "Balance", "Currency", "KYC_Done",
        "KYC_DocID", "KYC_VerificationStatus", F.col("payload_income").alias("income"),
        F.round("payload_age_years", 6).alias("age_years"), F.col("payload_TransactionID").alias("txn"),
        F.col("payload_Amount").alias("txn_amount"), F.col("payload_Timestamp").alias("txn_time"),
        F.col("payload_TransactionTime").alias("txn_raw_time"), F.col("payload_Location").alias("txn_location"),
        "AlertSeverity"))


_LAND_ROWS = 200_000        # rows a landed file, so that no task sorts more


def _dealt(raw, file_rows: int = _LAND_ROWS):
    """Rows by landed file: a name's rows are dealt in turn to as many tasks as
    they need, whatever the splits they are read in (a split of a few MB of a
    columnar table can hold millions of rows). A row per name is collected."""
    name = F.coalesce("file_name", F.lit(""))
    sizes = raw.groupBy(name.alias("name")).count().collect()
    if not sizes:
        return raw
    files = [(r["name"], -(-r["count"] // file_rows)) for r in sizes]
    firsts = accumulate((n for _, n in files), initial=0)
    place = F.create_map(*[F.lit(x) for (f, n), first in zip(files, firsts)
                           for x in (f, first)])[name] + F.pmod(
        F.monotonically_increasing_id(), F.create_map(*[F.lit(x) for f in files for x in f])[name])
    return (raw.withColumn("_file", place.cast("int")).repartitionById(sum(n for _, n in files), "_file").drop("_file"))


def _land_files(raw, landing: str) -> None:
    """Test input of the stream: the rows of each ``file_name`` land as CSV
    part files named after it (``atm_0-part00000.csv``...). Rows are written
    by as many tasks as the data needs - a large name is split, never sent
    to one task, and a large split of the input is dealt to many."""
    spark = raw.sparkSession
    stage = f"{landing}/_stage"
    _dealt(raw).write.mode("overwrite").option("header", True).partitionBy("file_name").csv(stage)
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(stage)
    fs = root.getFileSystem(conf)
    inbox = f"{landing}/inbox"
    fs.mkdirs(jvm.org.apache.hadoop.fs.Path(inbox))
    for part_dir in fs.listStatus(root):
        name = part_dir.getPath().getName()
        if not name.startswith("file_name="):
            continue
        stem = name.split("=", 1)[1].removesuffix(".csv")
        parts = sorted((s.getPath() for s in fs.listStatus(part_dir.getPath())
                        if s.getPath().getName().endswith(".csv")), key=lambda x: x.getName())
        for i, p in enumerate(parts):
            fs.rename(p, jvm.org.apache.hadoop.fs.Path(f"{inbox}/{stem}-part{i:05d}.csv"))


@register("stream_ingest_available_now", with_fixtures(("fx_txn_raw",), f"""with {VALID_SQL}
select file_name, upper(split_part(file_name, '_', 1)) as source_type, 'COMPLETED' as status,
       count(*) as rows_parsed, count(*) filter (where errors = '') as valid,
       count(*) filter (where errors <> '') as invalid
from ve group by file_name"""))
def q_stream_ingest(spark, sf):
    base = f"{checkpoint_dir(spark)}/ledgerloom-stream-{uuid.uuid4().hex}"
    raw = fixture(spark, sf, "fx_txn_raw")
    _land_files(raw, base)
    params = dict(high_value_threshold=fx.HIGH_VALUE, velocity_count=fx.VELOCITY_COUNT,
                  velocity_window_sec=fx.VELOCITY_WINDOW_SEC, geo_window_sec=fx.GEO_WINDOW_SEC,
                  drain_threshold=fx.DRAIN_AMOUNT, drain_window_sec=fx.DRAIN_WINDOW_SEC)
    q = start_ingest_stream(spark, f"{base}/inbox", f"{base}/out", f"{base}/checkpoint",
                            as_of=AS_OF, rule_params=params)
    q.awaitTermination()
    assert list_files(spark, f"{base}/inbox")
    audit = read_audit(spark, f"{base}/out").withColumn(
        "file_name", F.concat(F.regexp_replace("file_name", "-part[0-9]+[.]csv$", ""), F.lit(".csv")))
    return audit.groupBy("file_name", "source_type", "status").agg(
        *[F.sum(c).alias(c) for c in ("rows_parsed", "valid", "invalid")])


def _scratch(spark, kind: str) -> str:
    """A fresh folder under the session's shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/ledgerloom-{kind}-{uuid.uuid4().hex}"


_ACCOUNT_TYPES = {"AccountNumber": "string", "CustomerID": "string", "AccountHolderName": "string",
                  "AccountType": "string", "AccountStatus": "string", "AccountOpenDate": "date",
                  "Balance": "double", "KYC_Done": "string", "AnnualIncome": "double", "DOB": "date",
                  "City": "string"}


@register("csv_roundtrip_typed", with_fixtures(("fx_account",), """
select AccountNumber, CustomerID, AccountHolderName, AccountType, AccountStatus,
       cast(AccountOpenDate as varchar) as AccountOpenDate, Balance, KYC_Done, AnnualIncome,
       cast(DOB as varchar) as DOB, City, 'account_master.csv' as source_file
from fx_account"""))
def q_csv_roundtrip_typed(spark, sf):
    from ..schemas import align
    from ..sources.files import read_delimited
    from ..sources.tables import write_csv
    base = _scratch(spark, "csv")
    acc = _account_text(spark, sf).select(*_ACCOUNT_TYPES)
    write_csv(acc, f"{base}/account_master.csv", sep=";")           # B1: a directory of part files
    back = read_delimited(spark, list_files(spark, f"{base}/account_master.csv"))   # A1-A3
    typed = align(back, _ACCOUNT_TYPES)                               # H18 + explicit types
    return export(typed.withColumn("source_file", F.lit("account_master.csv")))


@register("snapshot_roundtrip", with_fixtures(("fx_account", "fx_dim_v1"), """
select CustomerID, FirstName, KYC_Tier, Total_Balance, 2 as version, n1 as v1_rows
from fx_dim_v1, (select count(*) as n1 from fx_account)"""))
def q_snapshot_roundtrip(spark, sf):
    from ..sources.tables import SnapshotTable
    t = SnapshotTable(spark, _scratch(spark, "snapshot"))
    assert not t.exists()                                             # A12
    t.write(fixture(spark, sf, "fx_account"))                         # B3
    v = t.write(fixture(spark, sf, "fx_dim_v1"))                      # B4: schema replaced
    n1 = t.read(1).count()                                            # A6: older version
    return t.read().withColumns({"version": F.lit(v), "v1_rows": F.lit(n1).cast("long")})


@register("documents_json_scan", with_fixtures(("fx_account",), """
select AccountNumber as id, AccountNumber, CustomerID, AccountHolderName as Account_AccountHolderName,
       strftime(AccountOpenDate, '%Y-%m-%dT%H:%M:%S') || '+00:00' as Account_AccountOpenDate,
       cast(Balance as varchar) as Account_Balance, KYC_Done as Account_KYC_Done
from fx_account"""))
def q_documents_json_scan(spark, sf):
    base = _scratch(spark, "docs")
    docs = ingest.account_documents(valid_rows(validate_accounts(_account_text(spark, sf))))
    docs.withColumn("_ts", F.lit(1)).write.mode("overwrite").json(base)   # store adds _ts
    scanned = D.read_documents(spark, base, docs.schema.add("_ts", "long"))    # A4
    b = D.bronze(scanned, numeric_fields=["Account_Balance"])                 # C8-C11
    return b.select("id", "AccountNumber", "CustomerID", "Account_AccountHolderName",
                    "Account_AccountOpenDate", "Account_Balance", "Account_KYC_Done")


@register("documents_varying_fields", with_fixtures(("fx_account",), """
with a as (select *, cast(substring(AccountNumber, 3, 10) as int) as n from fx_account)
select AccountNumber as id, case when n % 5 = 0 then AccountHolderName end as Contact,
       case when n % 5 <> 0 then AccountHolderName end as Contact_Name,
       case when n % 5 <> 0 and n % 3 = 0 then AccountType end as Contact_Type_Kind,
       case when n % 5 <> 0 and n % 3 <> 0 then AccountType end as Contact_Type,
       case when n % 7 = 0 then cast(Balance as varchar) end as Account_Balance,
       case when n % 11 = 0 then KYC_Done end as Account_KYC_Done,
       case when n % 11 <> 0 then '["' || CustomerID || '"]' end as Holders, cast(null as varchar) as corrupt
from a
union all
select null, null, null, null, null, null, null, null, 'broken ' || AccountNumber from a where n % 13 = 0"""))
def q_documents_varying_fields(spark, sf):
    base, n = _scratch(spark, "varying"), F.substring("AccountNumber", 3, 10).cast("int")

    def some(name, condition, alias=None):
        return F.when(condition, F.col(name)).alias(alias or name)      # absent fields are not written
    account = F.struct(some("Balance", n % 7 == 0), some("KYC_Done", n % 11 == 0)).alias("Account")
    holders = F.when(n % 11 != 0, F.array("CustomerID")).alias("Holders")
    kind = F.struct(F.col("AccountType").alias("Kind"))
    plain = [F.col("AccountNumber").alias("id"), account, holders, F.lit(1).alias("_ts")]
    name = F.col("AccountHolderName").alias("Name")
    line = (F.when(n % 5 == 0, F.to_json(F.struct(*plain, F.col("AccountHolderName").alias("Contact"))))
            .when(n % 3 == 0, F.to_json(F.struct(*plain, F.struct(name, kind.alias("Type")).alias("Contact"))))
            .otherwise(F.to_json(F.struct(*plain, F.struct(name, F.col("AccountType").alias("Type")).alias("Contact")))))
    rows = fixture(spark, sf, "fx_account")
    broken = rows.filter(n % 13 == 0).select(F.concat(F.lit("broken "), "AccountNumber").alias("line"))
    rows.select(line.alias("line")).union(broken).write.mode("overwrite").text(base)
    b = shapes.bronze_documents(spark, base, numeric_fields=["Account_Balance"])
    return b.select("id", "Contact", "Contact_Name", "Contact_Type_Kind", "Contact_Type", "Account_Balance",
                    "Account_KYC_Done", "Holders", F.col(shapes.CORRUPT).alias("corrupt"))


def _land_as(df, landing: str, stem: str, extension: str = ".csv", sep: str = ",") -> None:
    """Land ``df`` as part files named ``<stem>-partNNNNN<extension>`` in the inbox."""
    spark = df.sparkSession
    stage = f"{landing}/_stage_{stem}"
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(stage)
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(stage).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    inbox = jvm.org.apache.hadoop.fs.Path(f"{landing}/inbox")
    fs.mkdirs(inbox)
    parts = sorted((s.getPath() for s in fs.listStatus(jvm.org.apache.hadoop.fs.Path(stage))
                    if s.getPath().getName().endswith(".csv")), key=lambda x: x.getName())
    for i, p in enumerate(parts):
        fs.rename(p, jvm.org.apache.hadoop.fs.Path(f"{landing}/inbox/{stem}-part{i:05d}{extension}"))


@register("lakehouse_end_to_end", with_fixtures(("fx_txn_raw",), f"""with {VALID_SQL}
select upper(split_part(file_name, '_', 1)) as Channel, count(*) as txns, sum(Amount) as amount,
       count(*) as with_customer_sk, count(*) as with_account_sk
from valid group by 1"""))
def q_lakehouse_end_to_end(spark, sf):
    """Files land -> stream ingestion -> stores -> silver -> 360 -> dims -> fact."""
    from ..plans import lakehouse as L
    base = _scratch(spark, "lakehouse")
    _land_files(fixture(spark, sf, "fx_txn_raw"), base)
    acc = _account_text(spark, sf)
    _land_as(acc.select("AccountNumber", "CustomerID", "AccountHolderName", "AccountType", "AccountStatus",
                        "AccountOpenDate", "Balance", "KYC_Done", "KYC_DocumentVerificationStatus"),
             base, "account_master")
    _land_as(acc.select("CustomerID", "DOB", "AnnualIncome", "City"), base, "customer_master")
    params = dict(high_value_threshold=fx.HIGH_VALUE, velocity_count=fx.VELOCITY_COUNT,
                  velocity_window_sec=fx.VELOCITY_WINDOW_SEC, geo_window_sec=fx.GEO_WINDOW_SEC,
                  drain_threshold=fx.DRAIN_AMOUNT, drain_window_sec=fx.DRAIN_WINDOW_SEC)
    start_ingest_stream(spark, f"{base}/inbox", f"{base}/stores", f"{base}/checkpoint",
                        as_of=AS_OF, rule_params=params).awaitTermination()
    bronze = L.write_bronze(spark, L.read_stores(spark, f"{base}/stores"), f"{base}/bronze", as_of=AS_OF,
                            stores_root=f"{base}/stores")
    silver = L.write_silver(spark, bronze, f"{base}/silver", as_of=AS_OF, bronze_root=f"{base}/bronze")
    L.write_gold(spark, silver, f"{base}/gold", "run1", as_of=AS_OF)
    return L.channel_summary(L.read_gold(spark, f"{base}/gold")["fact_transactions"])


@register("lakehouse_layers", with_fixtures(("fx_txn_raw", "fx_account"), f"""with {VALID_SQL},
t as (select count(*) as n, count(*) filter (where file_name like 'atm%') as atm, sum(Amount) as a,
             sum(Amount) filter (where file_name like 'atm%') as atm_a,
             count(distinct TransactionID) filter (where Amount >= {fx.HIGH_VALUE}) as high from valid),
p as (select count(distinct AccountNumber) as n, count(distinct CustomerID) as c from fx_account
      where CustomerID is not null and Balance is not null and AccountOpenDate is not null)
select 'bronze' as layer, 'atm' as name, atm as n, atm_a as amount from t
union all select 'bronze', 'alerts', high, null from t
union all select 'bronze', 'ingested today', n, null from p
union all select 'silver', 'upi', n - atm, a - atm_a from t
union all select 'silver', 'alerts', high, null from t
union all select 'silver', 'transactions', n, a from t
union all select 'silver', 'account', n, null from p
union all select 'gold', 'customer360', c, null from p
union all select 'gold', 'fact_transactions', n, a from t
union all select 'gold', 'fact with both keys', n, null from t
union all select 'gold', 'missing dates', 0, null"""))
def q_lakehouse_layers(spark, sf):
    """Every layer of the chain as stored: rows, sums, keys, ingestion columns."""
    from ..operators.rules_txn import high_value
    from ..plans import fact, lakehouse as L
    base = _scratch(spark, "layers")
    good = valid_rows(validate_transactions(fixture(spark, sf, "fx_txn_raw")))
    acc = _account_text(spark, sf).withColumn("file_name", F.lit("account_master.csv"))
    docs = ingest.ingest_accounts(acc, as_of=AS_OF)["documents"]
    alerts = ingest.normalize_alerts(high_value(good, fx.HIGH_VALUE))
    rows = good.drop("errors", "is_valid")
    stores = {"profiles": ingest.merge_accounts_into_profiles(None, docs), "alerts": alerts,
              "atm": rows.filter(F.col("file_name").startswith("atm")),
              "upi": rows.filter(F.col("file_name").startswith("upi"))}
    bronze = L.write_bronze(spark, stores, f"{base}/bronze", as_of=AS_OF)
    silver = L.write_silver(spark, bronze, f"{base}/silver", as_of=AS_OF)
    L.write_gold(spark, silver, f"{base}/gold", "run1", as_of=AS_OF)
    gold = L.read_gold(spark, f"{base}/gold")
    f = gold["fact_transactions"]

    def row(layer, name, df, amount=None):
        a = F.sum("Amount") if amount else F.lit(None).cast("double")
        return df.agg(F.count(F.lit(1)).alias("n"), a.alias("amount")).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("name"), "n", "amount")

    parts = [row("bronze", "atm", bronze["atm"], True), row("bronze", "alerts", bronze["alerts"]),
             row("bronze", "ingested today", bronze["accounts"].filter(
                 (F.col("ingest_date") == F.lit(AS_OF).cast("date")) & (F.col("ingest_source") == "accounts"))),
             row("silver", "upi", silver["upi"], True), row("silver", "alerts", silver["alerts"]),
             row("silver", "transactions", silver["transactions"], True), row("silver", "account", silver["account"]),
             row("gold", "customer360", gold["customer360"]), row("gold", "fact_transactions", f, True),
             row("gold", "fact with both keys", f.filter("CustomerSK is not null and AccountSK is not null")),
             row("gold", "missing dates", fact.missing_dates(f, gold["dim_date"]))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_SECOND_RUN_DAY = 20        # the second run adds the days of the month after it


@register("lakehouse_second_run", with_fixtures(("fx_txn_raw", "fx_account", "fx_kyc"), f"""with {VALID_SQL},
t as (select valid.AccountNumber, ts as Transaction_TS, valid.Amount, upper(split_part(valid.file_name, '_', 1)) as Channel,
             r.TransactionType as Transaction_Type, case when r.Channel = 'UPI' then r.Status end as Transaction_Status
      from valid join fx_txn_raw r on trim(r.TransactionID) = valid.TransactionID),
f as (select *, row_number() over (order by AccountNumber nulls first, Transaction_TS nulls first, Amount nulls first,
               Channel nulls first, Transaction_Type nulls first, Transaction_Status nulls first) as RowNum from t),
g as (select *, case when abs(Amount) > 10000 then 1 else 0 end
                + case when lower(Transaction_Status) in ('failed', 'declined', 'rejected') then 1 else 0 end
                + case when Channel = 'ATM' and abs(Amount) > 5000 then 1 else 0 end
                + case when Channel = 'UPI' and Amount > 8000 then 1 else 0 end
                + case when RowNum % 3 = 0 then 1 else 0 end as Flags_Count from f),
p as (select *, cast(substring(AccountNumber, 3, 10) as int) as k from fx_account
      where CustomerID is not null and Balance is not null and AccountOpenDate is not null),
changed as (select distinct CustomerID from p
            where k % 10 = 0 or AccountNumber in (select AccountNumber from t where day(Transaction_TS) > {_SECOND_RUN_DAY})),
c as (select count(distinct CustomerID) as n from p)
select 'bronze' as layer, 'days of the second run' as name,
       count(distinct cast(Transaction_TS as date)) filter (where day(Transaction_TS) > {_SECOND_RUN_DAY}) as n,
       cast(null as double) as amount from t where Channel = 'ATM'
union all select 'silver', 'atm', count(*), sum(Amount) from t where Channel = 'ATM'
union all select 'silver', 'kyc', count(*), sum(case when lower(VerificationStatus) in ('verified', 'true') then 1.0 else 0.0 end)
          from (select distinct * from fx_kyc)
union all select 'silver', 'flag_alerts', count(*), sum(Flags_Count) from g where Flags_Count > 0
union all select 'silver', 'flag alert numbers', cast(sum(RowNum) as bigint), null from g where Flags_Count > 0
union all select 'gold', 'customer versions', n + (select count(*) from changed), null from c
union all select 'gold', 'current customers', n, null from c
union all select 'gold', 'closed customers', count(*), null from changed
union all select 'gold', 'accounts', count(*), sum(Balance + case when k % 10 = 0 then 1 else 0 end) from p
union all select 'gold', 'account keys', cast(count(*) * (count(*) + 1) // 2 as bigint), null from p
union all select 'gold', 'rejected customers', 0, null
union all select 'gold', 'account conflicts', 0, null
union all select 'gold', 'facts of current customers', count(*), sum(Amount) from t"""))
def q_lakehouse_second_run(spark, sf):
    """The chain run twice: new days of transactions and changed balances come
    between the runs. Stored flag alerts, KYC, dimensions and rejects compared."""
    from ..plans import lakehouse as L
    from ..sources.tables import PartitionedTable
    base = _scratch(spark, "second")
    good = valid_rows(validate_transactions(fixture(spark, sf, "fx_txn_raw"))).drop("errors", "is_valid")
    good = good.withColumn("day", F.to_date("Timestamp"))
    kyc = fixture(spark, sf, "fx_kyc")
    acc = _account_text(spark, sf).withColumn("file_name", F.lit("account_master.csv"))
    tenth = F.substring("AccountNumber", 3, 10).cast("int") % 10 == 0
    raised = acc.withColumn("Balance", F.when(tenth, (F.col("Balance").cast("double") + 1).cast("string"))
                            .otherwise(F.col("Balance")))
    stores = {n: PartitionedTable(spark, f"{base}/stores/{n}", ["day"], f"{base}/stores/_staging/{n}") for n in L.DAILY}
    early = F.dayofmonth("day") <= _SECOND_RUN_DAY
    for run, rows, accounts in (("run1", good.filter(early), acc), ("run2", good.filter(~early), raised)):
        for name, store in stores.items():
            store.merge(rows.filter(F.col("file_name").startswith(name)), ["TransactionID", "AccountNumber"], run)
        docs = ingest.ingest_accounts(accounts, as_of=AS_OF)["documents"]
        now = {"profiles": ingest.merge_accounts_into_profiles(None, docs), **{n: s.read() for n, s in stores.items()}}
        bronze = L.write_bronze(spark, now, f"{base}/bronze", kyc, AS_OF, stores_root=f"{base}/stores")
        silver = L.write_silver(spark, bronze, f"{base}/silver", AS_OF, bronze_root=f"{base}/bronze")
        L.write_gold(spark, silver, f"{base}/gold", run, as_of=AS_OF)
    gold = L.read_gold(spark, f"{base}/gold")
    beside = {n: L.SnapshotTable(spark, f"{base}/gold/{n}").read() for n in ("rejected_customers", "account_conflicts")}
    days = L.daily_table(spark, f"{base}/bronze", "atm")
    changed = days.partition_frame(days.changed_since(1) or [], days.manifest().schema)
    dim, keys = gold["dim_customer"], gold["dim_account"]
    facts = gold["fact_transactions"].join(dim.filter("CurrentFlag").select("CustomerSK"), "CustomerSK", "left_semi")

    def row(layer, name, df, n=None, amount=None):
        return df.agg((F.count(F.lit(1)) if n is None else F.sum(n)).cast("long").alias("n"),
                      (F.lit(None) if amount is None else F.sum(amount)).cast("double").alias("amount")).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("name"), "n", "amount")

    parts = [row("bronze", "days of the second run", changed), row("silver", "atm", silver["atm"], amount="Amount"),
             row("silver", "kyc", silver["kyc"], amount=F.col("IsVerified").cast("int")),
             row("silver", "flag_alerts", silver["flag_alerts"], amount="Flags_Count"),
             row("silver", "flag alert numbers", silver["flag_alerts"], n="RowNum"),
             row("gold", "customer versions", dim), row("gold", "current customers", dim.filter("CurrentFlag")),
             row("gold", "closed customers", dim.filter("not CurrentFlag")),
             row("gold", "accounts", keys, amount="Balance"), row("gold", "account keys", keys, n="AccountSK"),
             row("gold", "rejected customers", beside["rejected_customers"]),
             row("gold", "account conflicts", beside["account_conflicts"]),
             row("gold", "facts of current customers", facts, amount="Amount")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---- delimited files as they really come -------------------------------------

@register("csv_quoted_fields", """
select c_custkey as id, 'He said "' || c_name || '", ok' || chr(10) || c_mktsegment as "note, long",
       case when c_custkey % 3 = 0 then null else '"' || c_mktsegment || '"' end as tail
from customer""")
def q_csv_quoted_fields(spark, sf):
    """Quoted delimiters, doubled quotes and line breaks inside quotes, in
    values and in header names, come back whole."""
    from ..sources.files import read_delimited
    base = _scratch(spark, "quoted")
    c = fx.table(spark, sf, "customer")
    quote = F.lit('"')
    rows = c.select(F.col("c_custkey").alias("id"),
                    F.concat(F.lit('He said "'), "c_name", F.lit('", ok\n'), "c_mktsegment").alias("note, long"),
                    F.when(F.col("c_custkey") % 3 != 0, F.concat(quote, "c_mktsegment", quote)).alias("tail"))
    (rows.write.option("header", True).option("quoteAll", True).option("escape", '"')
     .option("nullValue", None).csv(f"{base}/quoted.csv"))
    back = read_delimited(spark, list_files(spark, f"{base}/quoted.csv"), multiline=True)
    return back.select(F.col("id").cast("long").alias("id"), "note, long", C.blank_to_null("tail").alias("tail"))


_MALFORMED_SQL = f"""with
m as (select *, cast(substring(AccountNumber, 3, 10) as int) % 7 as u,
             try_strptime(nullif(trim(TransactionTime), ''), '%Y-%m-%d %H:%M:%S') as ts from fx_txn_raw),
e as (select *, u <> 0 and nullif(trim(TransactionID), '') is not null and ts is not null
                and regexp_full_match(trim(Amount), '{NUM_RE}') and cast(Amount as double) > 0 as ok from m)"""


@register("ingest_malformed_counters", with_fixtures(("fx_txn_raw",), _MALFORMED_SQL + """
select count(*) as rows_parsed, count(*) filter (where ok) as valid, count(*) filter (where not ok) as invalid,
       count(*) filter (where not ok) as quarantined, count(*) filter (where ok) as valid_narrow,
       count(*) filter (where u = 0) as malformed, count(*) filter (where ok and u = 1) as short_kept
from e"""))
def q_ingest_malformed_counters(spark, sf):
    """Rows with surplus fields are malformed and short rows are kept, in every
    sink alike: the counters, the quarantine and a narrow read agree."""
    from ..operators.validate import file_counters, invalid_rows, validate_transactions
    from ..sources.files import read_delimited
    base = _scratch(spark, "malformed")
    u = F.substring("AccountNumber", 3, 10).cast("int") % 7
    time = F.coalesce("TransactionTime", F.lit(""))
    tail = F.when(u == 0, F.concat(time, F.lit(",L1,surplus"))).when(u == 1, time).otherwise(F.concat(time, F.lit(",L1")))
    names = ["TransactionID", "AccountNumber", "CustomerID", "Amount"]
    line = F.concat_ws(",", *[F.coalesce(F.col(c), F.lit("")) for c in names], tail)
    rows = fixture(spark, sf, "fx_txn_raw").select(line.alias(",".join([*names, "TransactionTime", "Location"])))
    rows.write.option("header", True).option("sep", "\u0001").csv(f"{base}/atm_bad.csv")   # whole lines
    raw = read_delimited(spark, list_files(spark, f"{base}/atm_bad.csv"))
    checked = validate_transactions(raw)
    one = F.lit(1)
    counters = file_counters(checked).agg(*[F.sum(c).alias(c) for c in ("rows_parsed", "valid", "invalid")])
    quarantine = invalid_rows(checked).agg(
        F.count(one).alias("quarantined"), F.count_if(F.array_contains("errors", "Malformed row")).alias("malformed"))
    narrow = valid_rows(checked).select("TransactionID", "Location").agg(
        F.count(one).alias("valid_narrow"), F.count_if(F.col("Location").isNull()).alias("short_kept"))
    # Three one-row frames side by side.
    tag = F.lit(1).alias("_one")
    out = counters.select("*", tag).join(quarantine.select("*", tag), "_one").join(narrow.select("*", tag), "_one")
    return out.drop("_one")


@register("stream_file_statuses", with_fixtures(("fx_txn_raw",), f"""with {VALID_SQL}
select 'upi' as stem, 'COMPLETED' as status, count(*) as rows_parsed, count(*) filter (where errors = '') as valid,
       false as has_error from ve where file_name like 'upi%'
union all select 'account_bad', 'PROCESSOR_FAILED', null, null, true
union all select 'customer_master', 'COMPLETED', (select count(*) from customer), (select count(*) from customer), false
union all select 'ledger_x', 'UNKNOWN_SOURCE', null, null, false
union all select 'notes', 'REJECTED_EXTENSION', null, null, false"""))
def q_stream_file_statuses(spark, sf):
    """One status per file; a file that cannot be processed (its header names
    a column twice) does not keep the others of its batch from the stores."""
    base = _scratch(spark, "statuses")
    raw = fixture(spark, sf, "fx_txn_raw").filter(F.col("file_name").startswith("upi"))
    _land_as(raw.drop("file_name"), base, "upi")
    cust = fx.table(spark, sf, "customer").select(
        F.concat(F.lit("C"), F.col("c_custkey")).alias("CustomerID"), F.lit("1990-01-01").alias("DOB"),
        F.lit("100").alias("AnnualIncome"))
    _land_as(cust, base, "customer_master")
    _land_as(cust, base, "ledger_x")
    _land_as(cust, base, "notes", ".txt")
    _land_as(cust.select(F.col("CustomerID").alias("AccountNumber,AccountNumber")), base, "account_bad", sep="\u0001")
    start_ingest_stream(spark, f"{base}/inbox", f"{base}/out", f"{base}/checkpoint", as_of=AS_OF).awaitTermination()
    audit = read_audit(spark, f"{base}/out").withColumn("stem", F.regexp_replace("file_name", "-part[0-9]+[.][a-z]+$", ""))
    return audit.groupBy("stem", "status").agg(F.sum("rows_parsed").alias("rows_parsed"), F.sum("valid").alias("valid"),
                                               F.bool_or(F.coalesce(F.length("error") > 0, F.lit(False))).alias("has_error"))


@register("stream_store_contents", with_fixtures(("fx_txn_raw", "fx_account"), f"""with {VALID_SQL},
p as (select count(distinct AccountNumber) as n, round(sum(Balance), 2) as amount from fx_account
      where CustomerID is not null and Balance is not null and AccountOpenDate is not null)
select split_part(file_name, '_', 1) as store, count(*) as n, round(sum(Amount), 2) as amount from valid group by 1
union all select 'high value alerts', count(distinct TransactionID), null from valid where Amount >= {fx.HIGH_VALUE}
union all select 'profiles', n, amount from p"""))
def q_stream_store_contents(spark, sf):
    """The stores after a stream over all files, each landed twice: a
    transaction, an alert or a profile document stands in them once."""
    base = _scratch(spark, "contents")
    raw = fixture(spark, sf, "fx_txn_raw")
    again = raw.withColumn("file_name", F.regexp_replace("file_name", "[.]csv$", "_again.csv"))
    _land_files(raw.union(again), base)
    acc = _account_text(spark, sf).select("AccountNumber", "CustomerID", "AccountOpenDate", "Balance", "KYC_Done")
    _land_as(acc, base, "account_master")
    _land_as(acc, base, "account_again")
    start_ingest_stream(spark, f"{base}/inbox", f"{base}/out", f"{base}/checkpoint", as_of=AS_OF,
                        rule_params=dict(high_value_threshold=fx.HIGH_VALUE)).awaitTermination()

    def store(name, df, amount):
        return df.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(amount), 2).alias("amount")).select(
            F.lit(name).alias("store"), "n", "amount")

    out = f"{base}/out"
    alerts = spark.read.parquet(f"{out}/alerts").filter("type = 'HIGH_VALUE'")
    return (store("atm", spark.read.parquet(f"{out}/atm"), F.col("Amount"))
            .union(store("upi", spark.read.parquet(f"{out}/upi"), F.col("Amount")))
            .union(store("high value alerts", alerts, F.lit(None).cast("double")))
            .union(store("profiles", spark.read.parquet(f"{out}/profiles"), F.col("Account.Balance"))))


@register("alerts_profile_lookup", with_fixtures(("fx_account",), """
with c as (select CustomerID, max(AnnualIncome) as inc from fx_account
           where CustomerID is not null and DOB is not null and AnnualIncome is not null
             and cast(substring(CustomerID, 2, 10) as int) % 2 = 0 group by CustomerID)
select a.AccountNumber, a.CustomerID, 'BALANCE_INCOME_MISMATCH' as type
from fx_account a join c on a.CustomerID = c.CustomerID
where a.Balance is not null and a.AccountOpenDate is not null and c.inc > 0 and a.Balance > c.inc * 10"""))
def q_alerts_profile_lookup(spark, sf):
    """The income rule reads the stored customer document, not the account row."""
    from ..operators.rules_profile import customer_lookup
    acc = _account_text(spark, sf)
    known = acc.filter(F.substring("CustomerID", 2, 10).cast("int") % 2 == 0)
    best = known.groupBy("CustomerID").agg(F.max(F.col("AnnualIncome").cast("double")).cast("string").alias("AnnualIncome"),
                                           F.max("DOB").alias("DOB")).withColumn("file_name", F.lit("customer_master.csv"))
    customers = ingest.ingest_customers(best)["customers"]
    profiles = ingest.merge_customer_profiles(ingest.empty_profiles(spark), customers)
    income = customer_lookup(profiles).select("CustomerID", F.col("Customer.AnnualIncome").alias("AnnualIncome"))
    alerts = ingest.ingest_accounts(acc.drop("AnnualIncome").withColumn("file_name", F.lit("account_master.csv")), income, as_of=AS_OF)["alerts"]
    return alerts.filter("type = 'BALANCE_INCOME_MISMATCH'").select("AccountNumber", "CustomerID", "type")


@register("message_gate", """
select o_orderkey, case o_orderkey % 4 when 0 then false when 1 then false when 2 then false else true end as ok
from orders""")
def q_message_gate(spark, sf):
    """Messages without a file url or name, or that are no JSON, are refused."""
    from ..operators.validate import message_ok
    o = fx.table(spark, sf, "orders").select("o_orderkey")
    name = F.concat(F.lit("atm_"), F.col("o_orderkey"), F.lit(".csv"))
    body = (F.when(F.col("o_orderkey") % 4 == 0, F.lit("no json"))
            .when(F.col("o_orderkey") % 4 == 1, F.to_json(F.struct(name.alias("file_name"))))
            .when(F.col("o_orderkey") % 4 == 2, F.to_json(F.struct(name.alias("file_name"), F.lit("").alias("file_url"))))
            .otherwise(F.to_json(F.struct(name.alias("file_name"), F.concat(F.lit("https://x/"), name).alias("file_url")))))
    return o.select("o_orderkey", F.coalesce(message_ok(body), F.lit(False)).alias("ok"))
