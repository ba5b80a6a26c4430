"""Full-row distinct by row hashes equals ``dropDuplicates``."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import distinct
from ledgerloom.operators.distinct import distinct_rows

T = "k int, s string, d double, a array<int>, `_row_hash` string, `x.y` string"
ROWS = [(1, "a", 1.0, [1], "h", "p"), (1, "a", 1.0, [1], "h", "p"), (1, "a", 1.0, [1, 2], "h", "p"),
        (2, None, 0.0, None, None, None), (2, None, -0.0, None, None, None), (2, "", 0.0, None, None, None),
        (3, "n", float("nan"), [], "", "q"), (3, "n", float("nan"), [], "", "q"), (4, "é" * 50_000, 2.0, [3], "h", "p"),
        (None, None, None, None, None, None), (None, None, None, None, None, None)]


def bag(df):
    return Counter(str(tuple(0.0 if v == 0 and isinstance(v, float) else v for v in r)) for r in df.collect())


@pytest.mark.parametrize("most", [1_000_000, 1])
def test_same_rows(spark, most):
    df = spark.createDataFrame(ROWS, T)
    got = distinct_rows(df, most)
    assert got.columns == df.columns and got.dtypes == df.dtypes
    assert bag(got) == bag(df.dropDuplicates()) and got.count() == 7


def test_nothing_repeated_and_empty(spark):
    df = spark.createDataFrame(ROWS, T)
    assert distinct_rows(df.limit(0)).count() == 0
    single = df.filter("k = 4")
    assert distinct_rows(single) is single


def test_collisions_lose_no_row(spark, monkeypatch):
    monkeypatch.setattr(distinct.F, "xxhash64", lambda *c: F.lit(7).cast("long"))
    df = spark.createDataFrame(ROWS, T)
    assert bag(distinct_rows(df)) == bag(df.dropDuplicates())


def test_a_third_of_the_rows_are_copies(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("id"),
                                    F.lit("wide").alias("w"))
    got = distinct_rows(df)
    assert got.count() == 20_001 and got.filter("id = -1").count() == 1
    assert "Exchange" not in got.filter("id >= 0")._jdf.queryExecution().executedPlan().toString().split("Union")[0]
