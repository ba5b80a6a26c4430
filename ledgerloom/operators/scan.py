"""Ordered scans that survive hot keys (W5 and the running frames of F2-F4).

``Window.partitionBy(key)`` sends every row of a key to one task, so a key
holding a third of the data becomes one third of the job in a single task.
The scans here instead:

1. range-partition on (group, order) - a hot group spreads over many
   partitions because the order columns split it;
2. write the partitioned rows to the checkpoint folder, fixing each row's
   partition id even if executors are lost and tasks re-run;
3. compute running values inside each (partition, group) slice - bounded by
   the partition size, never by the group size;
4. carry values across partition borders: per (partition, group) totals are
   one row per slice, and after the running combine only the first group of
   each partition can need a carry, so the broadcast carry table has at most
   one row per partition (a proven bound, independent of the data size).

``order`` must be a total order within the group (add tie-breaks).
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .splits import BUCKET_ROWS, find_splits

BUCKETS_PER_PARTITION = 4       # buckets a shuffle partition, so that partitions come out even
_COMBINE = {"sum": F.sum, "min": F.min, "max": F.max}
_MERGE = {"sum": lambda a, b: a + b, "min": F.least, "max": F.greatest}


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def _partitions(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def _range_scan(df: DataFrame, group: Sequence[str], order: Sequence[str],
                aggs: dict[str, tuple[str, str, bool]],
                num_partitions: int | None = None) -> DataFrame:
    """The range-partitioned scan (steps 1-4 above)."""
    group, order = list(group), list(order)
    n = _partitions(df, num_partitions)
    ranged = df.repartitionByRange(n, *_cols(group + order)).withColumn(
        "_pid", F.spark_partition_id())
    ranged = materialize(ranged)

    slice_w = Window.partitionBy("_pid", *group).orderBy(*_cols(order))
    by_slice = ranged.repartition(n, "_pid", *group)       # else few tasks get many slices each
    local = {}
    for name, (fn, col, inclusive) in aggs.items():
        frame = slice_w.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
        local[name] = _COMBINE[fn](F.col(col)).over(frame)
    scanned = by_slice.withColumns(local)

    # One row per (partition, group) slice with the slice totals.
    slices = ranged.groupBy("_pid", *group).agg(
        *[_COMBINE[fn](F.col(col)).alias(name) for name, (fn, col, _) in aggs.items()])
    # Combine totals of earlier partitions of the same group. A group has at
    # most one slice per partition, so this window's groups are bounded by
    # the partition count.
    before = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    carry = slices.select(
        "_pid", *group,
        *[_COMBINE[fn](F.col(name)).over(before).alias(f"_carry_{name}")
          for name, (fn, _, _) in aggs.items()])
    first = next(iter(aggs))
    # Only a partition's first group can continue from earlier partitions.
    carry = carry.filter(F.col(f"_carry_{first}").isNotNull())

    carry = carry.select(F.col("_pid").alias("_cpid"),
                         *[F.col(g).alias(f"_cg{i}") for i, g in enumerate(group)],
                         *[c for c in carry.columns if c.startswith("_carry_")])
    cond = [F.col("_pid") == F.col("_cpid")] + [
        F.col(g).eqNullSafe(F.col(f"_cg{i}")) for i, g in enumerate(group)]
    joined = scanned.join(F.broadcast(carry), cond, "left").drop(
        "_cpid", *[f"_cg{i}" for i in range(len(group))])
    out = {}
    for name, (fn, _, inclusive) in aggs.items():
        c, cur = F.col(f"_carry_{name}"), F.col(name)
        merged = F.when(c.isNull(), cur).when(cur.isNull(), c).otherwise(_MERGE[fn](c, cur))
        if fn == "sum" and not inclusive:
            merged = F.coalesce(merged, F.lit(0))
        out[name] = merged
    return joined.withColumns(out).drop("_pid", *[f"_carry_{k}" for k in aggs])


# Larger groups than this are hot: a window task may hold one such group.
DEFAULT_HOT_ROWS = 100_000
# Groups larger than total/MAX_HOT_GROUPS are hot too, so at most this many
# groups can be hot: the broadcast hot list is bounded (about 100k keys, a
# few MB), while an ordinary group stays below max(100k, total/100k) rows -
# about 1e7 rows per window task even at 1e12 rows in total.
MAX_HOT_GROUPS = 100_000
# Rows a window task gets, so that its memory does not grow with the input;
# small inputs are dealt to all cores.
TASK_ROWS = 40_000
LEAST_TASK_ROWS = 10_000


class Groups(NamedTuple):
    """Hot groups (None: there are none) and the number of tasks for all rows."""
    hot: DataFrame | None
    tasks: int


def size_groups(df: DataFrame, group: Sequence[str], weight: str | None = None,
                hot_rows: int | None = None) -> Groups:
    """Hot groups, whose row count exceeds ``max(hot_rows, total / MAX_HOT_GROUPS)``,
    and how many tasks the rows need. Sizes come from a partial aggregate; one
    row (largest group, total, rows without their weight) is read on the
    driver to choose the plan."""
    w = F.col(weight) if weight else F.lit(1)
    sizes = df.groupBy(*group).agg(F.sum(w).alias("_gsize"), F.count(F.lit(1)).alias("_grows"))
    largest, total, rows = sizes.agg(F.max("_gsize"), F.sum("_gsize"), F.sum("_grows")).first()
    if largest is None:
        return Groups(None, 1)
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = max(-(-rows // TASK_ROWS), min(cores, -(-rows // LEAST_TASK_ROWS)))
    threshold = max(DEFAULT_HOT_ROWS if hot_rows is None else hot_rows,
                    -(-int(total) // MAX_HOT_GROUPS))
    if largest <= threshold:
        return Groups(None, tasks)
    return Groups(sizes.filter(F.col("_gsize") > threshold).select(*group), tasks)


def hot_groups(df: DataFrame, group: Sequence[str], weight: str | None = None,
               hot_rows: int | None = None) -> DataFrame | None:
    """The hot groups of ``size_groups``."""
    return size_groups(df, group, weight, hot_rows).hot


def split_hot(df: DataFrame, hot: DataFrame, group: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows of ordinary groups, rows of hot groups); the hot list has at most
    MAX_HOT_GROUPS rows, so it is broadcast. Keys match NULL-safely."""
    h = hot.select(*[F.col(g).alias(f"_hg{i}") for i, g in enumerate(group)])
    cond = [F.col(g).eqNullSafe(F.col(f"_hg{i}")) for i, g in enumerate(group)]
    cold = df.join(F.broadcast(h), cond, "left_anti")
    hot_rows = df.join(F.broadcast(h), cond, "left_semi")
    return cold, hot_rows


def _window_scan(df: DataFrame, group: Sequence[str], order: Sequence[str],
                 aggs: dict[str, tuple[str, str, bool]], num_partitions: int | None = None) -> DataFrame:
    if num_partitions:
        df = df.repartition(num_partitions, *group)
    w = Window.partitionBy(*group).orderBy(*_cols(order))
    cols = {}
    for name, (fn, col, inclusive) in aggs.items():
        v = _COMBINE[fn](F.col(col)).over(w.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1))
        cols[name] = F.coalesce(v, F.lit(0)) if fn == "sum" and not inclusive else v
    return df.withColumns(cols)


AUTO = "auto"


def segmented_scan(df: DataFrame, group: Sequence[str], order: Sequence[str],
                   aggs: dict[str, tuple[str, str, bool]],
                   num_partitions: int | None = None, hot_rows: int | None = None,
                   hot: DataFrame | None | str = AUTO) -> DataFrame:
    """Running aggregates within each group, in ``order``.

    ``aggs`` maps output name -> (fn, column, inclusive) with fn one of
    sum/min/max; inclusive=False excludes the current row (NULL before the
    first row of a group, 0 for sums).

    Ordinary groups use a window partitioned by the group (one shuffle; each
    group is below the hot threshold, so no task gets an outsized share);
    hot groups - and the whole frame when there is no group - go through the
    range-partitioned scan. ``hot`` may pass a hot-group list already computed
    for these groups (None: there are none), and then ``num_partitions`` the
    number of tasks; by default both come from the sizes.
    """
    group = list(group)
    if not group:
        return _range_scan(df, group, order, aggs, num_partitions)
    if isinstance(hot, str):
        hot, tasks = size_groups(df, group, None, hot_rows)
        num_partitions = num_partitions or tasks
    if hot is None:
        return _window_scan(df, group, order, aggs, num_partitions)
    cold, hot_df = split_hot(df, hot, group)
    return _window_scan(cold, group, order, aggs, num_partitions).unionByName(
        _range_scan(hot_df, group, order, aggs, num_partitions))


def global_row_number(df: DataFrame, order: Sequence[str], out: str = "row_number",
                      group: Sequence[str] = (), num_partitions: int | None = None,
                      hot_rows: int | None = None, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Dense 1-based row numbers over a total order, without
    ``Exchange SinglePartition``; with ``group`` it numbers within groups
    (same result as ``row_number`` over ``partitionBy(group)``) without
    putting a hot group in one task.

    Without a group: repeatable splits (``splits.py``) give each row a bucket,
    the buckets are counted, and a row's number is the rows in earlier buckets
    plus its place in its own, found by one shuffle of the rows by bucket.
    Nothing is written. Copies of a row whose value fills several buckets are
    folded first and unfolded with consecutive numbers. The rows must be the
    same whenever ``df`` is computed; rows equal in every order column are
    numbered in no stated order."""
    if group:
        d = df.withColumn("_one", F.lit(1))
        r = segmented_scan(d, group, order, {out: ("sum", "_one", True)}, num_partitions, hot_rows)
        return r.drop("_one").withColumn(out, F.col(out).cast("long"))
    names = [f"`{c}`" for c in df.columns if c != out]
    splits = find_splits(df, order, BUCKETS_PER_PARTITION * _partitions(df, num_partitions), bucket_rows=bucket_rows)
    d = splits.assign(df, "_bucket", "_frequent")
    # Maps cannot be grouped by; rows that hold some are dealt by their hash alone.
    fold = splits.repeated and not any(x in f.dataType.simpleString() for f in df.schema for x in ("map<", "variant"))
    if fold:
        some = d.filter("_frequent").groupBy(*names, "_bucket").agg(F.count(F.lit(1)).alias("_copies"))
        d = d.filter("not _frequent").select(*names, "_bucket", F.lit(1).cast("long").alias("_copies")).unionByName(some)
    else:
        d = d.select(*names, "_bucket", F.lit(1).cast("long").alias("_copies"))
    counts = {} if splits.buckets == 1 else {r["_bucket"]: r["n"] for r in d.groupBy("_bucket").agg(F.sum("_copies").alias("n")).collect()}
    before = list(accumulate((counts.get(b, 0) for b in range(splits.buckets)), initial=0))[:-1]    # one number a bucket
    offsets = df.sparkSession.createDataFrame([(before,)], "b array<bigint>").scalar()
    own = Window.partitionBy("_bucket").orderBy(*_cols(order))
    if not fold:
        place = F.row_number().over(own)
        return d.withColumn(out, (F.get(offsets, F.col("_bucket")) + place).cast("long")).select(*names, out)
    last = F.get(offsets, F.col("_bucket")) + F.sum("_copies").over(own.rowsBetween(Window.unboundedPreceding, 0))
    return d.withColumn("_last", last).select(
        *names, F.explode(F.sequence(F.col("_last") - F.col("_copies") + 1, F.col("_last"))).alias(out))


def systematic_sample(df: DataFrame, k: int, order: Sequence[str], out: str = "row_number",
                      offset: int = 0) -> DataFrame:
    """J8 re-aimed: every k-th row of a total order (``row_number % k == offset``)."""
    return global_row_number(df, order, out).filter((F.col(out) % k) == offset)


def assign_surrogate_keys(df: DataFrame, business_key: Sequence[str], out: str,
                          start_after: Column | int = 0,
                          num_partitions: int | None = None) -> DataFrame:
    """K5/K6: dense keys ordered by the business key, starting after
    ``start_after`` (the current maximum key; 0 for an empty table)."""
    r = global_row_number(df, list(business_key), out, num_partitions=num_partitions)
    base = start_after if isinstance(start_after, Column) else F.lit(start_after)
    return r.withColumn(out, (F.col(out) + base).cast("long"))
