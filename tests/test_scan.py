"""W5 and segmented scans against single-partition windows (metamorphic:
same answer for 1, 3 and 17 partitions and for a forced hot-group path)."""

import math
import os
import random
from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerloom.operators.scan import (global_row_number, hot_groups, segmented_scan,
                                       systematic_sample)
from ledgerloom.operators.splits import find_splits


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice(["hot"] * 6 + ["a", "b", None]), rnd.randrange(50), i, float(rnd.randrange(-5, 9)))
            for i in range(600)]
    return spark.createDataFrame(rows, "g string, t int, id int, v double")


@pytest.mark.parametrize("parts", [1, 3, 17])
def test_global_row_number_dense(data, parts):
    got = global_row_number(data, ["t", "id"], "rn", num_partitions=parts)
    want = data.withColumn("rn", F.row_number().over(Window.orderBy("t", "id")))
    assert sorted(got.select("id", "rn").collect()) == sorted(want.select("id", "rn").collect())


@pytest.mark.parametrize("hot_rows", [None, 1])
@pytest.mark.parametrize("parts", [2, 9])
def test_segmented_scan_matches_window(data, hot_rows, parts):
    got = segmented_scan(data, ["g"], ["t", "id"], {
        "run": ("sum", "v", True), "before": ("sum", "v", False),
        "lo": ("min", "t", True), "hi": ("max", "v", False)}, num_partitions=parts, hot_rows=hot_rows)
    w = Window.partitionBy("g").orderBy("t", "id")
    want = data.select(
        "id", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("run"),
        F.coalesce(F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("before"),
        F.min("t").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("lo"),
        F.max("v").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("hi"))
    assert sorted(got.select("id", "run", "before", "lo", "hi").collect()) == sorted(want.collect())


def test_grouped_row_number_with_hot_group(data):
    got = global_row_number(data, ["t", "id"], "rn", group=["g"], hot_rows=10)
    want = data.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("t", "id")))
    assert sorted(got.select("id", "rn").collect()) == sorted(want.select("id", "rn").collect())


def test_hot_groups_bound(data):
    hot = hot_groups(data, ["g"], hot_rows=10)
    assert {r.g for r in hot.collect()} <= {"hot", "a", "b", None}
    assert hot_groups(data, ["g"], hot_rows=10_000) is None


def test_systematic_sample(data):
    s = systematic_sample(data, 7, ["t", "id"]).collect()
    assert len(s) == 600 // 7 and all(r.row_number % 7 == 0 for r in s)


def _numbers(spark, df, order, **options):
    def written():
        root = spark.sparkContext.getCheckpointDir().removeprefix("file:")
        return sum(len(files) for _, _, files in os.walk(root))
    before = written()
    out = global_row_number(df, order, "rn", **options)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "checkpoint" not in plan.lower() and out.count() >= 0
    assert "SinglePartition, ENSURE" not in plan or df.count() <= options["bucket_rows"]
    assert written() == before                      # no copy of the rows
    return out


@pytest.mark.parametrize("rows_a_bucket", [10, 100, 100_000])
def test_numbers_by_splits(spark, rows_a_bucket):
    """Ordered, dense, the same on any layout; one tree and two levels of trees."""
    rng = random.Random(5)
    rows = [(rng.choice([None, "a", "b", "ab", "é"]), rng.choice([None, -1.5, 0.0, 2.0, float("nan")]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "s string, x double, i long")
    got = {}
    for n in (1, 7):
        r = _numbers(spark, df.repartition(n), ["s", "x", "i"], num_partitions=64, bucket_rows=rows_a_bucket).collect()
        got[n] = sorted((r.rn, r.s, str(r.x), r.i) for r in r)
    assert got[1] == got[7] and [r[0] for r in got[1]] == list(range(1, 3001))

    def key(r):                                     # NULL first, NaN last
        x = r[1]
        return r[0] is not None, (r[0] or "").encode(), x is not None, math.inf if x != x else x or 0.0, r[2]
    assert [(s, x, i) for _, s, x, i in got[1]] == [(s, str(x), i) for s, x, i in sorted(rows, key=key)]


def test_numbers_of_a_frequent_value(spark):
    """A third of the rows equal in every order column, half of those copies of one row."""
    rows = [(i % 700, f"row {i}") for i in range(2000)] + [(333, f"same {i}") for i in range(500)] + [(333, "copy")] * 500
    df = spark.createDataFrame(rows, "k long, v string").repartition(5)
    out = _numbers(spark, df, ["k"], num_partitions=8, bucket_rows=50)
    got = out.collect()
    assert sorted(r.rn for r in got) == list(range(1, 3001))
    assert Counter((r.k, r.v) for r in got) == Counter(rows)
    assert [r.k for r in sorted(got, key=lambda r: r.rn)] == sorted(k for k, _ in rows)
    splits = find_splits(df, ["k"], 32, bucket_rows=50)
    sizes = splits.assign(df, "b", "f").filter("k = 333 and v like 'same%'").groupBy("b").count().collect()
    assert splits.repeated and len(sizes) > 5 and max(r["count"] for r in sizes) < 150


def test_numbers_of_nothing(spark):
    none = spark.createDataFrame([], "k long, v string")
    assert global_row_number(none, ["k"], "rn").collect() == []
