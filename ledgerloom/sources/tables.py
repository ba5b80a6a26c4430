"""Parquet tables with versioned snapshots and partition-level merges
(A5, A6, A12, B1-B8, B10, B11, B13, B14).

``SnapshotTable``: each write produces ``<root>/v=<n>/`` and then adds the
pointer file ``<root>/_CURRENT.<n>``; the highest pointer names the current
version, so readers see the old or the new version, never none or a
half-written one, and a merge can read version n while writing n+1
(overwriting a parquet path that is being read fails). ``keep`` versions are
retained. A single writer per table is assumed.

``PartitionedTable``: a ``partitionBy`` table (the fact by Year/Month). A
merge rewrites only the partitions its source touches: the touched
partitions of the target are merged with the source into a staged copy,
which then replaces exactly those partitions (dynamic partition overwrite).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.merge import one_per_key, same_key, upsert
from .key_index import KeyIndex

POINTER = "_CURRENT"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


class SnapshotTable:
    def __init__(self, spark: SparkSession, root: str, keep: int = 5):
        self.spark, self.root, self.keep = spark, root.rstrip("/"), keep

    def _versions(self) -> list[int]:
        fs, p = _fs(self.spark, self.root)
        if not fs.exists(p):
            return []
        names = (s.getPath().getName() for s in fs.listStatus(p))
        return sorted(int(n.removeprefix(POINTER + ".")) for n in names if n.startswith(POINTER + "."))

    def version(self) -> int | None:
        return max(self._versions(), default=None)

    def _commit(self, version: int) -> None:
        """Creating an empty file is atomic; older versions beyond ``keep`` go
        afterwards, pointer first."""
        fs, p = _fs(self.spark, f"{self.root}/{POINTER}.{version:06d}")
        fs.create(p, True).close()
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for old in self._versions()[:-self.keep]:
            fs.delete(path(f"{self.root}/{POINTER}.{old:06d}"), False)
            fs.delete(path(self.path(old)), True)

    def exists(self) -> bool:
        """The table has a committed version."""
        return self.version() is not None

    def path(self, version: int | None = None) -> str:
        v = self.version() if version is None else version
        return f"{self.root}/v={v:06d}"

    def read(self, version: int | None = None) -> DataFrame:
        """The current (or a given) version."""
        if version is None and not self.exists():
            raise FileNotFoundError(f"no committed version under {self.root}")
        return self.spark.read.parquet(self.path(version))

    def read_or_none(self) -> DataFrame | None:
        return self.read() if self.exists() else None

    def write(self, df: DataFrame, partition_by: Sequence[str] = ()) -> int:
        """A new version (its schema may differ from the last one)."""
        v = (self.version() or 0) + 1
        w = df.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(self.path(v))
        self._commit(v)
        return v

    def merge(self, source: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> int:
        """Upsert into the next version (created when absent), one row
        per key: the last of the source in ``order``."""
        cur = self.read_or_none()
        return self.write(one_per_key(source, keys, order) if cur is None else upsert(cur, source, keys, order))


class PartitionedTable:
    def __init__(self, spark: SparkSession, root: str, partition_by: Sequence[str],
                 staging_root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.partition_by = list(partition_by)
        self.staging_root = staging_root.rstrip("/")

    def exists(self) -> bool:
        """The table holds a partition (an empty batch leaves none)."""
        fs, p = _fs(self.spark, self.root)
        return fs.exists(p) and any("=" in s.getPath().getName() for s in fs.listStatus(p))

    def read(self, schema=None) -> DataFrame:
        """The table; with ``schema``, a table holding no file yet (created
        from an empty batch) reads as empty instead of failing inference."""
        r = self.spark.read
        return (r.schema(schema) if schema is not None else r).parquet(self.root)

    def create(self, df: DataFrame, keys: Sequence[str] = ()) -> None:
        """Partitioned write; with ``keys``, also their index."""
        df.write.mode("overwrite").partitionBy(*self.partition_by).parquet(self.root)
        if keys and self.exists():
            self.index(keys).replace(self.read(df.schema))

    def index(self, keys: Sequence[str]) -> KeyIndex:
        return KeyIndex(self.spark, self.root, self.partition_by, keys)

    def may_hold(self, source: DataFrame, keys: Sequence[str], schema=None) -> DataFrame:
        """The table's partitions that may hold a key of ``source``, found by
        the key index (built now if the table has none); no other is opened."""
        index = self.index(keys)
        table = self.read(schema)
        if not index.exists():
            index.replace(table)
        return self._in(table, index.candidates(source))

    def _in(self, target: DataFrame, touched: DataFrame) -> DataFrame:
        """Rows of the touched partitions, whose values (a row per partition)
        become literals, so that the others are pruned while planning."""
        rows, wanted = touched.distinct().collect(), F.lit(False)
        if len(self.partition_by) == 1:
            c = self.partition_by[0]
            wanted = F.col(c).isin([r[c] for r in rows if r[c] is not None])
            if any(r[c] is None for r in rows):
                wanted = wanted | F.col(c).isNull()
        else:
            for r in rows:
                one = F.lit(True)
                for c in self.partition_by:
                    one = one & (F.col(c).isNull() if r[c] is None else F.col(c) == F.lit(r[c]))
                wanted = wanted | one
        return target.filter(wanted)

    def merge(self, source: DataFrame, keys: Sequence[str], run_id: str, order: Sequence[str] | None = None,
              moves: bool = True) -> None:
        """One row per key, the last in ``order``, NULL-safe in keys and
        partition values; only touched partitions are rewritten. These are the
        source's and, as a key may ``move``, those that hold its keys now: the
        key index names the partitions that may, and only their key columns are
        read. ``moves=False`` is for keys that fix their partition; no index is
        kept for them."""
        keys = list(keys)
        if not self.exists():
            self.create(one_per_key(source, keys, order), keys if moves else ())
            return
        own = not (source.storageLevel.useMemory or source.storageLevel.useDisk)
        if own:                                     # its keys, partitions and rows are read by several jobs
            source = source.persist()
        try:
            self._merge(source, keys, run_id, order, moves)
        finally:
            if own:
                source.unpersist()

    def _merge(self, source: DataFrame, keys: list[str], run_id: str, order: Sequence[str] | None, moves: bool) -> None:
        table = self.read(source.schema)
        touched = source.select(*self.partition_by).distinct()
        if moves:
            near = self.may_hold(source, keys, source.schema)
            held = near.select(*dict.fromkeys([*keys, *self.partition_by])).alias("t").join(
                source.select(*keys).distinct().alias("s"), same_key("t", "s", keys), "left_semi")
            touched = touched.union(held.select(*self.partition_by)).distinct()
        self.replace(upsert(self._in(table, touched), source, keys, order), touched, run_id, keys if moves else ())

    def replace(self, rows: DataFrame, touched: DataFrame, run_id: str, keys: Sequence[str] = ()) -> None:
        """Replace exactly the touched partitions by ``rows``, staged first; a
        touched partition without rows goes. With ``keys`` their index is kept
        up: filters of the new rows are there before the rows are."""
        stage = f"{self.staging_root}/{run_id}"
        rows.write.mode("overwrite").partitionBy(*self.partition_by).parquet(stage)
        staged = self.spark.read.schema(rows.schema).parquet(stage)
        cols = self.partition_by
        index = self.index(keys) if keys else None
        filters = index.filters(staged).persist() if index is not None and index.exists() else None     # built once, written twice
        if filters is not None:
            index.add(staged, filters)
        gone = touched.alias("t").join(staged.select(*cols).distinct().alias("s"), same_key("t", "s", cols), "left_anti").collect()
        (staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*self.partition_by).parquet(self.root))
        for row in gone:                            # a row per emptied partition
            self._remove(row)
        if filters is not None:
            index.replace(staged, filters)
            filters.unpersist()
        elif index is not None:
            index.replace(self.read(rows.schema))
        fs, p = _fs(self.spark, stage)
        fs.delete(p, True)

    def _remove(self, row) -> None:
        """Delete the folder of a partition all of whose rows moved away."""
        escape = self.spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
        parts = [escape.getPartitionPathString(c, None if row[c] is None else str(row[c])) for c in self.partition_by]
        fs, p = _fs(self.spark, "/".join([self.root, *parts]))
        if fs.exists(p):
            fs.delete(p, True)


# ---- plain sinks -----------------------------------------------------------

def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """B1: CSV with header, overwrite."""
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """B10/B11 safe under replay: a batch writes its own partitions, so writing
    it again replaces its rows instead of adding them."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def create_table_as_select(spark: SparkSession, name: str, df: DataFrame,
                           partition_by: Sequence[str] = (), path: str | None = None) -> DataFrame:
    """A catalog table from a DataFrame (CTAS); with ``path`` the data
    lives there (external table), else in the session's warehouse."""
    w = df.write.mode("overwrite").format("parquet")
    if path:
        w = w.option("path", path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)
    return spark.table(name)


def count_and_preview(df: DataFrame, n: int = 20) -> tuple[DataFrame, DataFrame]:
    """Row count (one aggregate) and a preview limited to ``n`` rows."""
    return df.agg(F.count(F.lit(1)).alias("rows")), df.limit(n)
