"""Arrival-driven ingestion (A13) with Structured Streaming.

The stream tracks file arrival only: a ``binaryFile`` source with just the
``path``/``length`` columns selected (file contents are not read by the
stream). Each micro-batch hands the new file names to the batch ingestion,
which reads the files with per-file header/delimiter detection, routes them by
name, validates, raises alerts, merges into the stores and appends one audit
row per file. The checkpoint makes every file processed once; with
``availableNow`` the query stops when the backlog is done. The rules are
per file, so no state store is needed.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..plans.ingest import (STATUS_COMPLETED, STATUS_FAILED, STATUS_REJECTED, STATUS_UNKNOWN,
                            ingest_accounts, ingest_customers, ingest_transactions)
from ..session import materialize
from ..sources.files import read_delimited
from ..sources.tables import PartitionedTable, SnapshotTable, replace_partitions

AUDIT_COLUMNS = ("file_name", "source_type", "status", "rows_parsed", "valid", "invalid",
                 "quarantined", "alerts_generated", "batch_id", "completed_at", "error")
PROBES_AT_ONCE = 8


class StoreError(RuntimeError):
    """A store could not be read: no file is at fault, the batch is replayed."""


def _release(cached) -> None:
    for c in cached:
        c.unpersist()


def _at_fault(files: list[str], error_of) -> dict[str, Exception]:
    """{file: error} of the files that fail on their own, by halving the groups
    that fail, the groups of a level side by side: about 2 log2(n) probes for
    each bad file among n. ``error_of(group)`` gives the group's error or None."""
    errors: dict[str, Exception] = {}
    probe = inheritable_thread_target(SparkSession.active())(error_of)      # jobs keep the batch's tags
    groups = [files[:len(files) // 2], files[len(files) // 2:]]
    with ThreadPoolExecutor(PROBES_AT_ONCE) as pool:
        while groups:
            found = list(pool.map(probe, groups))
            failing = [(g, e) for g, e in zip(groups, found) if e is not None]
            errors |= {g[0]: e for g, e in failing if len(g) == 1}
            groups = [h for g, _ in failing if len(g) > 1 for h in (g[:len(g) // 2], g[len(g) // 2:])]
    return errors


class IngestSink:
    """``foreachBatch`` target: stores under ``out_root``.

    Transaction and alert stores are partitioned by day. Profile documents are
    partitioned by a hash bucket of their CustomerID (they are looked up by
    customer), profile alerts by a bucket of their account. A batch rewrites
    only the partitions that hold rows it changes. ``buckets`` is a property of
    the stores fixed when they are created (later sinks read it back); choose
    it so that one bucket of the final store fits a task's share.

    Reading and the rules come first, the stores after: a file whose
    processing fails is marked PROCESSOR_FAILED and the other files of the
    batch go on, while an error of the stores, also of the lookup that the
    account rules make in them, is raised, so the batch is replayed. Replays change nothing: merges are by key, audit and quarantine
    rows are written to partitions of their batch."""

    def __init__(self, out_root: str, as_of=None, rule_params: dict | None = None, buckets: int = 64):
        self.root = out_root.rstrip("/")
        self.as_of = as_of
        self.rule_params = rule_params or {}
        self.buckets = buckets
        self._known_buckets: int | None = None

    def _bucket(self, spark: SparkSession, col: str):
        if self._known_buckets is None:
            marks = SnapshotTable(spark, f"{self.root}/_buckets", keep=1)
            if not marks.exists():
                marks.write(spark.range(self.buckets, self.buckets + 1).withColumnRenamed("id", "buckets"))
            self._known_buckets = marks.read().first()["buckets"]
        return F.pmod(F.xxhash64(F.col(col)), F.lit(self._known_buckets)).cast("int")

    def store(self, spark: SparkSession, name: str, by: str) -> PartitionedTable:
        return PartitionedTable(spark, f"{self.root}/{name}", [by], f"{self.root}/_staging/{name}")

    def _held_in(self, spark: SparkSession, ids: DataFrame) -> DataFrame:
        """Buckets that hold documents with these ids now; the key index of the
        store names those that may, and only their ids are read."""
        held = self.store(spark, "profiles", "bucket").may_hold(ids, ["id"]).select("id", "bucket")
        return held.join(ids.select("id").distinct(), "id", "left_semi").select("bucket")

    def merge_profiles(self, spark: SparkSession, touched: DataFrame, build, run_id: str) -> None:
        """Read only the touched buckets, rebuild their documents with
        ``build(current_or_None)`` and replace exactly those buckets."""
        table = self.store(spark, "profiles", "bucket")
        if not table.exists():
            table.create(build(None).withColumn("bucket", self._bucket(spark, "CustomerID")), ["id"])
            return
        cur = table.read().join(F.broadcast(touched.distinct()), "bucket", "left_semi").drop("bucket")
        table.replace(build(cur).withColumn("bucket", self._bucket(spark, "CustomerID")), touched.distinct(), run_id,
                      ["id"])

    def read_profiles(self, spark: SparkSession, touched: DataFrame | None = None) -> DataFrame | None:
        t = self.store(spark, "profiles", "bucket")
        if not t.exists():
            return None
        rows = t.read()
        if touched is not None:
            rows = rows.join(F.broadcast(touched.distinct()), "bucket", "left_semi")
        return rows.drop("bucket")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # The new file paths: bounded by the trigger's file limit.
        paths = [r.path for r in batch.select("path").distinct().collect()]
        if not paths:
            return
        names = spark.createDataFrame([(p, p.rsplit("/", 1)[-1]) for p in paths], "path string, file_name string")
        routed = names.withColumns({"source_type": C.source_type(F.col("file_name")),
                                    "is_csv": C.is_csv_name(F.col("file_name"))})
        cached: list[DataFrame] = []
        try:
            self._ingest(spark, batch_id, routed, cached)
        finally:
            _release(cached)

    def _ingest(self, spark: SparkSession, batch_id: int, routed: DataFrame, cached: list) -> None:
        audits = []
        rejected = routed.filter(~F.col("is_csv")).withColumn("status", F.lit(STATUS_REJECTED))
        unknown = routed.filter(F.col("is_csv") & (F.col("source_type") == "UNKNOWN")).withColumn(
            "status", F.lit(STATUS_UNKNOWN))
        for df in (rejected, unknown):
            audits.append(df.select("file_name", "source_type", "status"))
        by_type: dict[str, list[str]] = {}
        for r in routed.filter("is_csv").collect():
            by_type.setdefault(r.source_type, []).append(r.path)
        # All transaction files of the batch in one pass: the rules are per file anyway.
        steps = [(["ATM", "UPI"], self._transactions), (["ACCOUNT"], self._accounts),
                 (["CUSTOMER"], self._customers)]
        for types, step in steps:
            files = [p for t in types for p in by_type.get(t, [])]
            if not files:
                continue
            process, save = step(spark, batch_id)
            out, counters, errors = self._processed(files, process, cached)
            if errors:
                audits.append(self._failed(spark, errors))
            if out is not None:
                save(out)
                audits.append(spark.createDataFrame(counters, out["counters"].schema).withColumns({
                    "source_type": C.source_type(F.col("file_name")), "status": F.lit(STATUS_COMPLETED)}))
        audit = None
        for a in audits:
            a = a.withColumns({"batch_id": F.lit(batch_id), "completed_at": C.as_of_ts(self.as_of)})
            audit = a if audit is None else audit.unionByName(a, allowMissingColumns=True)
        if audit is not None:
            replace_partitions(
                audit.select(*[F.col(c) if c in audit.columns else F.lit(None).cast("string").alias(c)
                               for c in AUDIT_COLUMNS]), f"{self.root}/audit", ["batch_id"])

    @staticmethod
    def _processed(files: list[str], process, cached: list):
        """(outputs, counters, {file: error}) of the files that can be
        processed. The counters (one row per file) are computed here, which
        reads every row and runs every rule; if that fails, the files at fault
        are found by halving and the good ones are processed together (D6)."""
        def run(some: list[str]):
            out = process(some)
            cached.extend(out.get("kept", ()))
            if "alerts" in out:
                cached.append(out["alerts"].persist())
            return out, out["counters"].collect()

        def error_of(some: list[str]):
            out = {}
            try:
                out = process(some)
                out["counters"].collect()
            except StoreError:
                raise
            except Exception as e:
                return e
            finally:
                _release(out.get("kept", ()))

        try:
            return *run(files), {}
        except StoreError:
            raise
        except Exception as first:
            errors = {files[0]: first} if len(files) == 1 else _at_fault(files, error_of)
            good = [f for f in files if f not in errors]
            if not errors:
                raise                               # no file is at fault: the batch is replayed
            return (*run(good), errors) if good else (None, [], errors)

    def _failed(self, spark: SparkSession, errors: dict[str, Exception]) -> DataFrame:
        rows = [(p.rsplit("/", 1)[-1], str(e)) for p, e in errors.items()]
        df = spark.createDataFrame(rows, "file_name string, error string")
        return df.withColumns({"source_type": C.source_type(F.col("file_name")),
                               "status": F.lit(STATUS_FAILED)})

    def _quarantine(self, rows: DataFrame, batch_id: int) -> None:
        replace_partitions(rows.withColumn("batch_id", F.lit(batch_id)), f"{self.root}/quarantine",
                           ["source_type", "batch_id"])

    def _transactions(self, spark: SparkSession, batch_id: int):
        def process(files):
            raw = read_delimited(spark, files, multiline=True)
            kept: list[DataFrame] = []              # sizing the rules' groups reads them already
            try:
                out = ingest_transactions(raw.withColumn("source_type", C.source_type(F.col("file_name"))), kept,
                                          **self.rule_params)
            except Exception:
                _release(kept)
                raise
            return out | {"kept": kept}

        def save(out):
            valid = (out["valid"].drop("errors", "is_valid", "_corrupt_record")
                     .withColumns({"batch_id": F.lit(batch_id), "day": F.to_date("Timestamp")}))
            for stype in ("ATM", "UPI"):
                part = valid.filter(F.col("source_type") == stype).drop("source_type")
                self.store(spark, stype.lower(), "day").merge(part, ["TransactionID", "AccountNumber"], f"b{batch_id}",
                                                              ["Timestamp", "file_name", "Amount"])
            alerts = out["alerts"].withColumn("day", F.to_date(F.try_to_timestamp("created_at")))
            self.store(spark, "alerts", "day").merge(alerts, ["alert_id"], f"b{batch_id}", ["anchor_ts", "TransactionID"])
            self._quarantine(out["quarantine"], batch_id)
        return process, save

    def _accounts(self, spark: SparkSession, batch_id: int):
        from ..operators.rules_profile import customer_lookup
        from ..plans.ingest import merge_accounts_into_profiles
        self._bucket(spark, "CustomerID")           # the stores' number of buckets is fixed before probes run side by side

        def process(files):
            raw = read_delimited(spark, files, multiline=True)
            return ingest_accounts(raw, incomes(raw) if "CustomerID" in raw.columns else None, as_of=self.as_of)

        def incomes(raw):
            """Income of the files' customers as stored, looked up in their
            buckets. The buckets are found first (an error there is a file's),
            then the store is read (an error here is the store's)."""
            bucket = self._bucket(spark, "CustomerID").alias("bucket")
            own = materialize(raw.select(C.blank_to_null("CustomerID").alias("CustomerID")).distinct())
            try:
                current = self.read_profiles(spark, own.select(bucket))
                if current is None:
                    return None
                known = customer_lookup(current.join(own, "CustomerID", "left_semi"))
                return materialize(known.select("CustomerID", F.col("Customer.AnnualIncome").alias("AnnualIncome")))
            except Exception as e:
                raise StoreError("profiles could not be read") from e

        def save(out):
            docs = out["documents"]
            touched = docs.select(self._bucket(spark, "CustomerID").alias("bucket"))
            if self.store(spark, "profiles", "bucket").exists():
                touched = touched.union(self._held_in(spark, docs))     # an account may change its customer
            self.merge_profiles(spark, touched, lambda cur: merge_accounts_into_profiles(cur, docs), f"a{batch_id}")
            alerts = out["alerts"].withColumn("bucket", self._bucket(spark, "AccountNumber"))
            self.store(spark, "profile_alerts", "bucket").merge(alerts, ["alert_id"], f"b{batch_id}", moves=False)
            self._quarantine(out["quarantine"].withColumn("source_type", F.lit("ACCOUNT")), batch_id)
        return process, save

    def _customers(self, spark: SparkSession, batch_id: int):
        from ..plans.ingest import empty_profiles, merge_customer_profiles

        def process(files):
            return ingest_customers(read_delimited(spark, files, multiline=True))

        def save(out):
            customers = out["customers"]
            # All documents of a customer, and the standalone one of a customer without any, share a bucket.
            touched = customers.select(self._bucket(spark, "CustomerID").alias("bucket"))
            self.merge_profiles(
                spark, touched,
                lambda cur: merge_customer_profiles(cur if cur is not None else empty_profiles(spark), customers),
                f"c{batch_id}")
            self._quarantine(out["quarantine"].withColumn("source_type", F.lit("CUSTOMER")), batch_id)
        return process, save


def start_ingest_stream(spark: SparkSession, landing_dir: str, out_root: str, checkpoint: str,
                        as_of=None, rule_params: dict | None = None,
                        max_files_per_trigger: int = 1000, available_now: bool = True, buckets: int = 64):
    """Start the arrival-driven ingestion; returns the ``StreamingQuery``."""
    arrivals = (spark.readStream.format("binaryFile")
                .schema("path string, modificationTime timestamp, length long, content binary")
                .option("maxFilesPerTrigger", max_files_per_trigger)
                .option("recursiveFileLookup", "true")
                .load(landing_dir).select("path", "length"))
    w = (arrivals.writeStream.foreachBatch(IngestSink(out_root, as_of, rule_params, buckets))
         .option("checkpointLocation", checkpoint)
         .queryName(f"ingest_{uuid.uuid4().hex[:8]}"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def read_audit(spark: SparkSession, out_root: str) -> DataFrame:
    return spark.read.parquet(f"{out_root.rstrip('/')}/audit")
