"""Partitioned tables whose merges are atomic (K20, B8) and that tell what
changed (B3, I2, K11).

A write puts its partitions into a folder of its own, ``data/_write=<n>-<tag>``,
and touches no other file. The manifest of version n, a small snapshot table,
then names for each live partition the write that holds it; its pointer file is
created last. A reader takes one manifest, so it sees all of a merge or none of
it, and a reader of an older version keeps its files until that version is
given up (``keep`` versions stay). Rows are written once, without a staged copy.

Manifests hold a row per partition, like the list of partitions that Spark's
own file index keeps on the driver. A single writer per table is assumed; what
a failed write left behind goes with the next one.

``changed_since`` compares two manifests: the partitions written or emptied
between them, without opening a file. A table built from another one records in
its own manifest (``note``) which version it was built from; one built from a
plainly partitioned table (``refresh_from_folders``) a mark for each of its
partitions, made of the names of the files in it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.merge import one_per_key
from .tables import PartitionedTable, SnapshotTable, _fs

WRITE = "_write"
MANIFEST = "kind string, folder string, parts array<string>, schema string, note string"
Part = tuple[str | None, ...]


class Manifest(NamedTuple):
    live: dict[Part, str]           # partition values as text -> write folder
    schema: T.StructType
    note: str | None


class VersionedTable(PartitionedTable):
    def __init__(self, spark: SparkSession, root: str, partition_by: Sequence[str], keep: int = 5):
        super().__init__(spark, root, partition_by, staging_root="")
        self.keep = keep
        self.manifests = SnapshotTable(spark, f"{self.root}/_manifest", keep)

    def version(self) -> int | None:
        return self.manifests.version()

    def exists(self) -> bool:
        """A first write is committed (an empty one counts)."""
        return self.version() is not None

    def manifest(self, version: int | None = None) -> Manifest:
        rows = self.spark.read.schema(MANIFEST).parquet(
            self.manifests.path(self.version() if version is None else version)).collect()
        head = next(r for r in rows if r.kind == "table")
        return Manifest({tuple(r.parts): r.folder for r in rows if r.kind == "partition"},
                        T.StructType.fromJson(json.loads(head.schema)), head.note)

    def note(self) -> str | None:
        return self.manifest().note if self.exists() else None

    def read(self, schema=None, version: int | None = None) -> DataFrame:
        """The table as of a version (the current one by default), with the
        columns and types it was last written with; ``schema`` is for callers
        that know it better."""
        if version is None and not self.exists():
            raise FileNotFoundError(f"no committed version under {self.root}")
        m = self.manifest(version)
        return self._open(m, m.live, schema)

    def read_partitions(self, parts: Iterable[Part], version: int | None = None) -> DataFrame:
        """Only the named partitions, as far as they are there."""
        m = self.manifest(version)
        return self._open(m, [p for p in parts if p in m.live])

    def changed_since(self, since: int | None, until: int | None = None) -> list[Part] | None:
        """Partitions that differ between two versions, emptied ones too; None
        where ``since`` is unknown or given up, so that all may have changed."""
        if since is None or since not in self.manifests._versions():
            return None
        old, new = self.manifest(since).live, self.manifest(until).live
        return sorted((p for p in {*old, *new} if old.get(p) != new.get(p)), key=lambda p: [(v is not None, v or "") for v in p])

    def partition_frame(self, parts: Iterable[Part], schema: T.StructType) -> DataFrame:
        """Partition values as typed rows, as ``replace`` takes them."""
        text = T.StructType([T.StructField(c, T.StringType()) for c in self.partition_by])
        return self.spark.createDataFrame(list(parts), text).select(
            *[F.col(c).cast(schema[c].dataType).alias(c) for c in self.partition_by])

    def create(self, df: DataFrame, keys: Sequence[str] = (), note: str | None = None) -> None:
        """A version that holds exactly ``df``; with ``keys``, also their index."""
        self._commit(df, None, keys, note)

    def replace(self, rows: DataFrame, touched: DataFrame, run_id: str, keys: Sequence[str] = (),
                note: str | None = None) -> None:
        """The next version: the touched partitions hold exactly ``rows``, all
        others stay. With ``keys`` their index is kept up."""
        self._commit(rows, self._values(touched), keys, note, run_id)

    def _values(self, df: DataFrame) -> set[Part]:
        """Partition values as folder names show them (an empty text is NULL there)."""
        text = [F.nullif(F.col(f"`{c}`").cast("string"), F.lit("")).alias(f"p{i}") for i, c in enumerate(self.partition_by)]
        return {tuple(r) for r in df.select(*text).distinct().collect()}

    def _folder(self, part: Part, write: str) -> str:
        escape = self.spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
        names = [escape.getPartitionPathString(c, v) for c, v in zip(self.partition_by, part)]
        return "/".join([f"{self.root}/data/{WRITE}={write}", *names])

    def _open(self, m: Manifest, parts: Iterable[Part], schema=None) -> DataFrame:
        schema = m.schema if schema is None else schema
        folders = [self._folder(p, m.live[p]) for p in parts]
        if not folders:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).option("basePath", f"{self.root}/data").parquet(*folders)
        return rows.select(*[f"`{f.name}`" for f in schema.fields])

    def _commit(self, rows: DataFrame, touched: set[Part] | None, keys: Sequence[str], note: str | None,
                tag: str = "") -> None:
        old = self.manifest() if self.exists() else None
        number = (self.version() or 0) + 1
        self._sweep(number)
        write = f"{number:06d}-{tag or uuid.uuid4().hex[:8]}"
        path = f"{self.root}/data/{WRITE}={write}"
        rows.write.mode("overwrite").partitionBy(*self.partition_by).parquet(path)
        written = self.spark.read.schema(rows.schema).option("basePath", path).parquet(path)
        fresh = self._values(written)
        live = {} if old is None or touched is None else {p: w for p, w in old.live.items() if p not in touched}
        live |= {p: write for p in fresh}
        index = self.index(keys) if keys else None
        filters = index.filters(written).persist() if index is not None and index.exists() else None    # built once, written twice
        if filters is not None:
            index.add(written, filters)             # filters are there before the rows are
        head = ("table", None, None, rows.schema.json(), note)
        entries = [head, *(("partition", w, list(p), None, None) for p, w in live.items())]
        given_up = self.manifests._versions()[:-self.keep + 1] if self.keep > 1 else self.manifests._versions()
        outdated = {(p, w) for v in given_up for p, w in self.manifest(v).live.items()}
        self.manifests.write(self.spark.createDataFrame(entries, MANIFEST))
        if filters is not None:
            index.replace(written, filters)
            filters.unpersist()
        elif index is not None and fresh:
            index.replace(self.read())
        if outdated:
            kept = {(p, w) for v in self.manifests._versions() for p, w in self.manifest(v).live.items()}
            for p, w in outdated - kept:
                fs, folder = _fs(self.spark, self._folder(p, w))
                fs.delete(folder, True)

    def _sweep(self, number: int) -> None:
        """Folders of writes that failed: their number was never committed."""
        fs, data = _fs(self.spark, f"{self.root}/data")
        if fs.exists(data):
            for s in fs.listStatus(data):
                name = s.getPath().getName().removeprefix(f"{WRITE}=")
                if int(name.split("-")[0]) >= number:
                    fs.delete(s.getPath(), True)


def refresh(target: VersionedTable, source: VersionedTable, build, keys: Sequence[str] = ()) -> list[Part] | None:
    """Bring ``target`` up to ``source``, both partitioned alike: only source
    partitions changed since the version ``target`` was built from are read,
    and only theirs are replaced. ``build`` maps source rows to target rows and
    keeps a row's partition. Returns the partitions done, None for all."""
    now, note = source.version(), target.note()
    changed = None if note is None else source.changed_since(int(note), now)
    if changed is None:
        target.create(build(source.read(version=now)), keys, note=str(now))
    elif changed:
        rows = build(source.read_partitions(changed, now))
        target.replace(rows, target.partition_frame(changed, rows.schema), "refresh", keys, note=str(now))
    return changed


def refresh_all(target: VersionedTable, sources: dict[str, VersionedTable], build) -> list[Part] | None:
    """``refresh`` from several sources, all partitioned like ``target``:
    ``build`` maps their rows (by name) to target rows. A partition is done
    again where it changed in any of them."""
    now, note = {n: s.version() for n, s in sources.items()}, target.note()
    since = {} if note is None else json.loads(note)
    feeds = [s.changed_since(since.get(n), now[n]) for n, s in sources.items()]
    if any(f is None for f in feeds):
        target.create(build({n: s.read(version=now[n]) for n, s in sources.items()}), note=json.dumps(now))
        return None
    changed = [p for i, f in enumerate(feeds) for p in f if not any(p in g for g in feeds[:i])]
    if changed:
        rows = build({n: s.read_partitions(changed, now[n]) for n, s in sources.items()})
        target.replace(rows, target.partition_frame(changed, rows.schema), "refresh", note=json.dumps(now))
    return changed


def folder_marks(source: PartitionedTable) -> dict[Part, str]:
    """A text for each partition of a plainly partitioned table that changes
    when its files do: their number and the sum of hashes of their paths, sizes
    and times. Files are listed, not opened; a row per partition comes back."""
    files = (source.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(source.root)
             .withColumn("mark", F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")))
    parts = [F.col(f"`{c}`").cast("string").alias(f"p{i}") for i, c in enumerate(source.partition_by)]
    rows = files.groupBy(*parts).agg(F.concat_ws(":", F.count(F.lit(1)).cast("string"),
                                                 F.sum("mark").cast("string")).alias("mark")).collect()
    return {tuple(r)[:-1]: r.mark for r in rows}


def refresh_from_folders(target: VersionedTable, source: PartitionedTable, build) -> list[Part] | None:
    """``refresh`` from a table without versions, partitioned like ``target``:
    the partitions whose mark is not the one noted are read and replaced. Marks
    are taken before rows are read, so what is written meanwhile is done again
    by the next run."""
    marks, note = folder_marks(source), target.note()
    noted = json.dumps([[list(p), m] for p, m in marks.items()])
    if note is None:
        target.create(build(source.read()), note=noted)
        return None
    old = {tuple(p): m for p, m in json.loads(note)}
    changed = [p for p in dict.fromkeys([*old, *marks]) if old.get(p) != marks.get(p)]
    if changed:
        table = source.read()
        rows = build(source._in(table, target.partition_frame(changed, table.schema)))
        target.replace(rows, target.partition_frame(changed, rows.schema), "refresh", note=noted)
    return changed
