"""Key index of a partitioned table (A7, B9, B12): a filter of the keys of each
partition, stored beside it, so that a merge or a lookup opens only partitions
that may hold one of its keys.

The filter is a blocked Bloom filter made of built-in bitmaps: a partition of n
keys has a power of two of slices of 32,768 bits, at least 32 bits a key; a
key's hash names one slice and ``PROBES`` of its bits. A key that is there is
always found; one that is not passes with a chance near 1e-6. Filters live in
the hidden folder ``_keys`` of the table, partitioned like it, about 4 bytes a
key, and are written with the partitions they describe.

A batch adds the filters of its new partitions before the table changes and
drops the outdated ones after it, so a failure in between leaves filters that
find too much, never too little.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE_BITS = 32_768             # size of a built-in bitmap
BITS_PER_KEY = 32
PROBES = 12
TASK_KEYS = 200_000             # keys whose filters a task builds


def key_hash(keys: Sequence[str]) -> Column:
    """64 bits of a key; NULL has a hash like any value."""
    return F.xxhash64(*[F.struct(F.col(f"`{k}`").isNull(), F.col(f"`{k}`").cast("string")) for k in keys])


def _probe(h: Column, i: int) -> Column:
    """Bit position i of a hash in its slice: from bits 34-48 on, in odd steps from bits 49-63."""
    first = F.shiftrightunsigned(h, 34).bitwiseAND(F.lit(SLICE_BITS - 1))
    step = F.shiftrightunsigned(h, 49).bitwiseOR(F.lit(1))
    return (first + i * step) % SLICE_BITS


def _is_set(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return byte.bitwiseAND(F.pow(F.lit(2), position % 8).cast("int")) != 0


class KeyIndex:
    def __init__(self, spark: SparkSession, root: str, partition_by: Sequence[str], keys: Sequence[str]):
        self.spark, self.keys, self.partition_by = spark, list(keys), list(partition_by)
        self.path = f"{root.rstrip('/')}/_keys/{'-'.join(keys)}"

    def exists(self) -> bool:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

    def filters(self, rows: DataFrame) -> DataFrame:
        """(slices, slice, bits, partition columns) of the rows' keys, which
        are of a stored table (they are counted first). Hashes are dealt by
        slice, ``TASK_KEYS`` to a task however few partitions there are; the
        sizes, a row per partition, are broadcast. Copies of a key fold."""
        parts = self.partition_by
        d = rows.select(*parts, key_hash(self.keys).alias("h"))
        slices = F.pow(F.lit(2), F.ceil(F.log2(F.greatest(F.lit(1.0), F.count(F.lit(1)) * BITS_PER_KEY / SLICE_BITS))))
        sizes = d.groupBy(*parts).agg(slices.cast("long").alias("slices"))
        same = F.lit(True)
        for c in parts:
            same = same & F.col(f"d.{c}").eqNullSafe(F.col(f"s.{c}"))
        sized = d.alias("d").join(F.broadcast(sizes).alias("s"), same).select(
            "slices", F.col("h").bitwiseAND(F.col("slices") - 1).alias("slice"), *[F.col(f"d.{c}").alias(c) for c in parts], "h")
        group = ["slices", "slice", *parts]
        dealt = sized.repartition(max(1, -(-rows.count() // TASK_KEYS)), *group).distinct()

        size, probes = SLICE_BITS, PROBES

        def build(keys: pa.Table) -> pa.Table:
            """A slice with the positions (``_probe``) of its hashes set, laid
            out as by Spark's own bitmap functions. Needs nothing of this
            module, which workers may not have."""
            h = keys.column("h").to_numpy().view(np.uint64)
            first, step = (h >> np.uint64(34)) & np.uint64(size - 1), (h >> np.uint64(49)) | np.uint64(1)
            bits = np.zeros(size, np.bool_)
            for i in range(probes):
                bits[(first + np.uint64(i) * step) % np.uint64(size)] = True
            packed = np.packbits(bits, bitorder="little").tobytes()
            return keys.slice(0, 1).select(group).append_column("bits", pa.array([packed], pa.binary()))

        schema = T.StructType([*(dealt.schema[c] for c in group), T.StructField("bits", T.BinaryType())])
        return dealt.groupBy(*group).applyInArrow(build, schema).select("slices", "slice", "bits", *parts)

    def add(self, rows: DataFrame, filters: DataFrame | None = None) -> None:
        """Filters of the rows (given where they are built already), besides those there are."""
        filters = self.filters(rows) if filters is None else filters
        filters.write.mode("append").partitionBy(*self.partition_by).parquet(self.path)

    def replace(self, rows: DataFrame, filters: DataFrame | None = None) -> None:
        """The filters of exactly the rows' partitions."""
        filters = self.filters(rows) if filters is None else filters
        (filters.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*self.partition_by).parquet(self.path))

    def candidates(self, source: DataFrame) -> DataFrame:
        """Partition values of the partitions that may hold a key of ``source``."""
        kinds = [f"`{c}` {source.schema[c].dataType.simpleString()}" for c in self.partition_by if c in source.columns]
        reader = self.spark.read
        if len(kinds) == len(self.partition_by):
            reader = reader.schema(", ".join(["slices long", "slice long", "bits binary", *kinds]))
        index = reader.parquet(self.path)
        # Numbers of slices are powers of two: a few dozen at most.
        sizes = sorted(r["slices"] for r in index.select("slices").distinct().collect())
        if not sizes:
            return index.select(*self.partition_by).limit(0)
        wanted = source.select(key_hash(self.keys).alias("h")).distinct().select(
            "h", F.explode(F.array(*[F.lit(n).cast("long") for n in sizes])).alias("slices"))
        wanted = wanted.withColumn("slice", F.col("h").bitwiseAND(F.col("slices") - 1))
        # A slice is done with its first key found; a key that is not there mostly fails its first probes.
        hit = reduce(Column.__and__, [_is_set(F.col("i.bits"), _probe(F.col("w.h"), k)) for k in range(PROBES)])
        at = (F.col("i.slices") == F.col("w.slices")) & (F.col("i.slice") == F.col("w.slice"))
        found = index.alias("i").join(wanted.alias("w"), at & hit, "left_semi")
        return found.select(*self.partition_by).distinct()
