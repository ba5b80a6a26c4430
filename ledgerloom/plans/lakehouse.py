"""The whole chain, as the notebooks run it: ingestion stores -> bronze ->
silver -> unified transactions -> Customer 360 -> dimensions -> fact.

Each layer is written and the next one reads it back, so no part is computed
twice and every table of a run carries the same run time: ``write_bronze`` and
``write_silver``, ``write_gold`` (360, dimensions, and the
fact partitioned by Year/Month with atomic touched-partition merges, so a re-run
only rewrites the months its transactions fall in, and the report state only
reads those). Transactions are the large tables: bronze, silver and unified
ones are versioned by day, and a run reads and writes only the days that changed
in the layer before (``stores_root``, ``bronze_root``). Tables of a row per
account, document or alert are snapshots, for their ages and dates follow the
run's date. ``build_silver`` and
``build_gold`` give the DataFrames alone; numbering inside them runs jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import documents as D
from ..operators.merge import scd2_rejects
from ..operators.rules_flags import flag_alerts
from ..sources.tables import PartitionedTable, SnapshotTable
from ..sources.versions import VersionedTable, refresh, refresh_all, refresh_from_folders
from . import dims, fact
from .customer360 import account_map_conflicts, customer360
from .report_state import refresh_reports
from .reports import with_ingest_columns
from .silver import silver_account, silver_alerts, silver_atm, silver_kyc, silver_upi, union_channels

KYC_EMPTY = "CustomerID string, VerificationStatus string, IssueDate date, ExpiryDate date"


def read_stores(spark: SparkSession, stores_root: str) -> dict[str, DataFrame]:
    """The ingestion stores written by ``streaming.file_stream``."""
    root = stores_root.rstrip("/")
    out = {"profiles": spark.read.parquet(f"{root}/profiles").drop("bucket"),
           "atm": spark.read.parquet(f"{root}/atm"),
           "upi": spark.read.parquet(f"{root}/upi")}
    for name, by in (("alerts", "day"), ("profile_alerts", "bucket")):     # raised or not
        table = PartitionedTable(spark, f"{root}/{name}", [by], f"{root}/_staging/{name}")
        if table.exists():
            rows = table.read().drop(by)
            out["alerts"] = alert_documents(out["alerts"], rows) if "alerts" in out else rows
    return out


def alert_documents(*kinds: DataFrame) -> DataFrame:
    """Transaction and profile alerts as one table; ``payload`` then has the
    fields of both, NULL where an alert's kind has none of them."""
    out = kinds[0]
    for more in kinds[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out


def build_silver(stores: dict[str, DataFrame], kyc: DataFrame | None = None, as_of=None) -> dict[str, DataFrame]:
    """Bronze shape of the profile documents, then the silver tables."""
    bronze_accounts = D.bronze(stores["profiles"], numeric_fields=["Account_Balance", "Customer_AnnualIncome"])
    spark = stores["atm"].sparkSession
    kyc_df = kyc if kyc is not None else spark.createDataFrame([], KYC_EMPTY)
    out = {
        "account": silver_account(bronze_accounts, as_of),
        "atm": silver_atm(stores["atm"]),
        "upi": silver_upi(stores["upi"]),
        "kyc": silver_kyc(kyc_df, as_of),
    }
    out["transactions"] = union_channels(out["atm"], out["upi"])
    return out


def build_gold(silver: dict[str, DataFrame], as_of=None,
               dim_customer_current: DataFrame | None = None,
               dim_account_current: DataFrame | None = None) -> dict[str, DataFrame]:
    """Customer 360, DimCustomer (SCD2 against the current version), DimAccount,
    DimDate and the fact."""
    txn, acc = silver["transactions"], silver["account"]
    c360 = customer360(txn, acc, silver["kyc"], as_of=as_of)
    dim_c = dims.dim_customer(dim_customer_current, c360, as_of)
    dim_a = dims.dim_account(acc, dim_account_current)
    dim_d = dims.dim_date(txn)
    return {"customer360": c360, "dim_customer": dim_c, "dim_account": dim_a, "dim_date": dim_d,
            "fact_transactions": fact.fact_transactions(txn, acc, dim_c, dim_a)}


BRONZE = ("accounts", "atm", "upi", "alerts", "kyc")
SILVER = ("account", "atm", "upi", "alerts", "kyc", "transactions", "flag_alerts")


def _write(spark: SparkSession, root: str, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    out = {}
    for name, df in tables.items():
        table = SnapshotTable(spark, f"{root.rstrip('/')}/{name}")
        table.write(df)
        out[name] = table.read()
    return out


DAILY = ("atm", "upi")                  # the two channels, and "transactions", by day


def daily_table(spark: SparkSession, root: str, name: str) -> VersionedTable:
    return VersionedTable(spark, f"{root.rstrip('/')}/{name}", ["day"])


def _by_day(df: DataFrame) -> DataFrame:
    return df if "day" in df.columns else df.withColumn("day", F.to_date("Timestamp"))


def write_bronze(spark: SparkSession, stores: dict[str, DataFrame], root: str, kyc: DataFrame | None = None,
                 as_of=None, stores_root: str | None = None) -> dict[str, DataFrame]:
    """Flattened store documents, transactions and alerts with the ingestion
    columns (L7), written; returns the tables read back. With ``stores_root``,
    the folder ``stores`` were read from, only days of transactions whose files
    changed since the last run are read and written; else all are."""
    accounts = D.bronze(stores["profiles"], numeric_fields=["Account_Balance", "Customer_AnnualIncome"])
    tables = {"accounts": accounts, "kyc": kyc if kyc is not None else spark.createDataFrame([], KYC_EMPTY)}
    if stores.get("alerts") is not None:
        tables["alerts"] = D.flatten(stores["alerts"])              # payload_* columns
    out = _write(spark, root, {n: with_ingest_columns(df, as_of, n) for n, df in tables.items()})
    for name in DAILY:
        table = daily_table(spark, root, name)

        def build(rows, name=name):
            return with_ingest_columns(_by_day(rows), as_of, name)
        if stores_root is None:
            table.create(build(stores[name]))
        else:
            store = PartitionedTable(spark, f"{stores_root.rstrip('/')}/{name}", ["day"], "")
            refresh_from_folders(table, store, build)
        out[name] = table.read().drop("day")
    return out


INGEST_COLUMNS = ("ingest_ts", "ingest_date", "ingest_source")


def write_silver(spark: SparkSession, bronze: dict[str, DataFrame], root: str, as_of=None,
                 bronze_root: str | None = None) -> dict[str, DataFrame]:
    """Silver tables, unified transactions and flag alerts (J10), written;
    each is built from tables already stored. With ``bronze_root``, the folder
    of the bronze tables, only changed days of transactions are read and
    written (equal rows agree on their time, so the distinct of a day is whole)."""
    b = {n: df.drop(*INGEST_COLUMNS) for n, df in bronze.items()}
    first = {"account": silver_account(b["accounts"], as_of), "kyc": silver_kyc(b["kyc"], as_of)}
    if "alerts" in b:
        first["alerts"] = silver_alerts(b["alerts"], as_of)
    out = _write(spark, root, first)
    shape = {"atm": silver_atm, "upi": silver_upi}
    tables = {n: daily_table(spark, root, n) for n in DAILY}
    for name, table in tables.items():
        if bronze_root is None:
            table.create(shape[name](_by_day(b[name])))
        else:
            refresh(table, daily_table(spark, bronze_root, name),
                    lambda rows, f=shape[name]: f(rows.drop(*INGEST_COLUMNS)))
        out[name] = table.read().drop("day")
    unified = daily_table(spark, root, "transactions")
    refresh_all(unified, tables, lambda rows: union_channels(rows["atm"], rows["upi"], keep=["day"]))
    out["transactions"] = unified.read().drop("day")
    out |= _write(spark, root, {"flag_alerts": flag_alerts(out["transactions"], as_of)})
    return out


def write_gold(spark: SparkSession, silver: dict[str, DataFrame], gold_root: str, run_id: str, as_of=None) -> None:
    """Customer 360, then the dimensions from it, then the fact from them,
    each from stored tables; rows left out and accounts with several customers
    are stored beside them (Q6, Q18)."""
    root = gold_root.rstrip("/")
    txn, acc = silver["transactions"], silver["account"]
    dim_c, dim_a = current_dimensions(spark, root)
    out = _write(spark, root, {"customer360": customer360(txn, acc, silver["kyc"], as_of=as_of)})
    out |= _write(spark, root, {
        "dim_customer": dims.dim_customer(dim_c, out["customer360"], as_of),
        "dim_account": dims.dim_account(acc, dim_a), "dim_date": dims.dim_date(txn),
        "rejected_customers": scd2_rejects(out["customer360"], "CustomerID"),
        "account_conflicts": account_map_conflicts(acc)})
    rows = fact.fact_transactions(txn, acc, out["dim_customer"], out["dim_account"])
    table = fact_table(spark, root)
    table.merge(rows, ["TransactionID"], run_id, moves=False)
    refresh_reports(spark, table, f"{root}/report_state")


def fact_table(spark: SparkSession, gold_root: str) -> VersionedTable:
    return VersionedTable(spark, f"{gold_root.rstrip('/')}/fact_transactions", ["Year", "Month"])


def read_gold(spark: SparkSession, gold_root: str) -> dict[str, DataFrame]:
    root = gold_root.rstrip("/")
    out = {n: SnapshotTable(spark, f"{root}/{n}").read()
           for n in ("customer360", "dim_customer", "dim_account", "dim_date")}
    out["fact_transactions"] = fact_table(spark, root).read()
    return out


def current_dimensions(spark: SparkSession, gold_root: str) -> tuple[DataFrame | None, DataFrame | None]:
    """Current DimCustomer and DimAccount for the next run (None before the first)."""
    root = gold_root.rstrip("/")
    return (SnapshotTable(spark, f"{root}/dim_customer").read_or_none(),
            SnapshotTable(spark, f"{root}/dim_account").read_or_none())


def channel_summary(fact_df: DataFrame) -> DataFrame:
    return fact_df.groupBy("Channel").agg(
        F.count(F.lit(1)).alias("txns"), F.sum("Amount").alias("amount"),
        F.count_if(F.col("CustomerSK").isNotNull()).alias("with_customer_sk"),
        F.count_if(F.col("AccountSK").isNotNull()).alias("with_account_sk"))
