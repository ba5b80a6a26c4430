"""Buckets of a total order by repeatable split values.

``repartitionByRange`` draws its borders anew in every job, so whoever needs
the partition of a row twice has to write the rows down in between. Here the
borders are values: a sample of the order columns, chosen by a hash of the
row, gives quantiles; a row's bucket is found by comparing it with them, so
any job, retry or layout finds the same bucket and nothing is written.

Buckets are in the order of their rows. A value so frequent that it fills
several borders has several buckets, and its rows are dealt among them by a
hash of the whole row (which of them comes first is open, as they are equal in
every order column).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, VariantType

MOST_BUCKETS = 4096
SAMPLE_PER_BUCKET = 32          # sampled rows a border; a bucket's size is within half and twice its share
BUCKET_ROWS = 100_000           # fewer rows need no more buckets


def row_hash(df: DataFrame, *salt: Column) -> Column:
    """Hash of a row's values: of those that hash as they are, or of their JSON."""
    parts = [F.col(f"`{f.name}`") if isinstance(f.dataType, AtomicType) and f.dataType != VariantType()
             else F.to_json(F.struct(F.col(f"`{f.name}`"))) for f in df.schema]
    return F.xxhash64(*salt, *parts)


def _key(order: Sequence[str]) -> Column:
    """The order columns as one value; structs compare field by field, NULL first."""
    return F.struct(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(order)])


def _rank(borders: Column, n: int, key: Column, equal: bool) -> Column:
    """How many of ``n`` ascending borders are below ``key`` (or equal to it):
    a binary search, one comparison for each bit of ``n``."""
    def step(found: Column, width: Column) -> Column:
        border = F.get(borders, found + width - 1)              # NULL past the end
        return F.when(border <= key if equal else border < key, found + width).otherwise(found)
    return F.aggregate(F.array(*[F.lit(1 << k) for k in reversed(range(n.bit_length()))]), F.lit(0), step)


@dataclass
class Splits:
    """``buckets`` buckets over ``order``; ``borders``: the ascending border
    values, an array of constants; ``repeated``: some occur more than once."""
    order: list[str]
    buckets: int
    borders: Column | None = None
    repeated: bool = False

    def assign(self, df: DataFrame, bucket: str, frequent: str) -> DataFrame:
        """``df`` with its bucket number and whether the row's value has
        several buckets."""
        if self.buckets == 1:
            return df.withColumns({bucket: F.lit(0), frequent: F.lit(False)})
        key, low, n = f"{bucket}_key", f"{bucket}_low", self.buckets - 1
        d = df.withColumn(key, _key(self.order))
        d = d.withColumn(bucket, _rank(self.borders, n, F.col(key), True))
        if not self.repeated:
            return d.withColumn(frequent, F.lit(False)).drop(key)
        d = d.withColumn(low, _rank(self.borders, n, F.col(key), False))
        own = F.col(bucket) - F.col(low)
        spread = F.when(own > 0, F.col(low) + 1 + F.pmod(row_hash(df), own).cast("int")).otherwise(F.col(bucket))
        return d.withColumns({bucket: spread, frequent: own > 1}).drop(key, low)


def _constant(value: str | None, kind: str) -> str:
    """SQL of a constant from its text in hexadecimal."""
    if value is None:
        return f"cast(null as {kind})"
    return f"unhex('{value}')" if kind == "binary" else f"cast(cast(unhex('{value}') as string) as {kind})"


def find_splits(df: DataFrame, order: Sequence[str], buckets: int, total: int | None = None,
                bucket_rows: int = BUCKET_ROWS) -> Splits:
    """Borders for about ``buckets`` buckets of equally many rows, at most
    ``MOST_BUCKETS``. The order columns hold plain values (no arrays, structs
    or maps). Reads them, and all columns for the hash that draws the sample;
    ``SAMPLE_PER_BUCKET`` values a bucket are gathered, the borders collected."""
    order = list(order)
    total = df.count() if total is None else total
    buckets = max(1, min(buckets, MOST_BUCKETS, -(-total // bucket_rows)))
    if buckets == 1:
        return Splits(order, 1)
    limit = min((1 << 63) - 1, (SAMPLE_PER_BUCKET * buckets << 63) // total)
    drawn = df.filter(F.shiftrightunsigned(row_hash(df, F.lit("splits")), 1) <= limit).select(_key(order).alias("key"))
    kinds = [df.schema[c].dataType.simpleString() for c in order]
    text = [F.hex(F.col("b")[f"k{i}"] if kind == "binary" else F.col("b")[f"k{i}"].cast("string")) for i, kind in enumerate(kinds)]
    found = (drawn.agg(F.sort_array(F.collect_list("key")).alias("a")).filter(F.size("a") > 0)
             .select(F.posexplode(F.transform(F.sequence(F.lit(1), F.lit(buckets - 1)), lambda j: F.get(
                 "a", F.floor(j * F.size("a") / buckets).cast("int")))).alias("j", "b"))
             .select("j", *[t.alias(f"k{i}") for i, t in enumerate(text)]).collect())    # at most MOST_BUCKETS rows
    if not found:
        return Splits(order, 1)
    values = [tuple(r)[1:] for r in sorted(found)]
    one = ", ".join("named_struct(" + ", ".join(f"'k{i}', {_constant(v, k)}" for i, (v, k) in enumerate(zip(b, kinds))) + ")"
                    for b in values)
    return Splits(order, buckets, F.expr(f"array({one})"), len(set(values)) < len(values))
