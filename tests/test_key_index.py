"""Key index: what is there is found, what is far away is not opened."""
import os

from pyspark.sql import functions as F

from ledgerloom.sources.key_index import KeyIndex
from ledgerloom.sources.tables import PartitionedTable

SCHEMA = "id string, v long, day string"


def rows(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def table(spark, scratch):
    return PartitionedTable(spark, f"{scratch}/t", ["day"], f"{scratch}/stage")


def content(t):
    return sorted((r.id is not None, r.id or "", r.v, str(r.day)) for r in t.read().collect())


def test_filters_find_their_keys(spark, scratch):
    """Every key in its partition; few others, in small and in sliced partitions."""
    d = spark.range(9000).select(F.concat(F.lit("k"), "id").alias("id"),
                                 F.when(F.col("id") < 40, "small").when(F.col("id") < 60, None).otherwise("large").alias("day"))
    index = KeyIndex(spark, f"{scratch}/t", ["day"], ["id"])
    index.replace(d)
    sizes = {r.day: r.slices for r in spark.read.parquet(index.path).groupBy("day").agg(F.max("slices").alias("slices")).collect()}
    assert sizes == {"small": 1, None: 1, "large": 16}

    def found(df):
        return {r.day for r in index.candidates(df.select("id", F.lit("x").alias("day"))).collect()}
    for day in ("small", None, "large"):
        own = d.filter(F.col("day").eqNullSafe(F.lit(day)))
        assert found(own) >= {day} and all(found(own.filter(F.col("id") == r.id)) == {day} for r in own.limit(3).collect())
    assert found(spark.range(2000).select(F.concat(F.lit("other"), "id").alias("id"))) == set()


def test_merge_opens_candidate_partitions_only(spark, scratch):
    t = table(spark, scratch)
    t.merge(rows(spark, [(f"k{d}-{i}", i, f"d{d}") for d in range(6) for i in range(50)] + [("n", 1, None), (None, 2, "d1")]),
            ["id"], "b0")
    for name in os.listdir(f"{scratch}/t/day=d5"):              # a partition that must not be opened
        if name.endswith(".parquet"):
            with open(f"{scratch}/t/day=d5/{name}", "wb") as f:
                f.write(b"broken")
    for name in os.listdir(f"{scratch}/t/day=d5"):
        if name.endswith(".crc"):
            os.remove(f"{scratch}/t/day=d5/{name}")
    # One key moves from d2 to a new day, one from the NULL day, a NULL key changes in place.
    t.merge(rows(spark, [("k2-7", 700, "d9"), ("n", 10, "d0"), (None, 20, "d1"), ("new", 1, "d9")]), ["id"], "b1")
    good = spark.read.schema(SCHEMA).parquet(f"{scratch}/t").filter("day <> 'd5' or day is null").collect()
    got = {(r.id, r.day): r.v for r in good}
    assert got[("k2-7", "d9")] == 700 and ("k2-7", "d2") not in got
    assert got[("n", "d0")] == 10 and ("n", None) not in got and got[(None, "d1")] == 20 and len(got) == 253
    assert not os.path.exists(f"{scratch}/stage/b1")            # staged copies go


def test_index_follows_the_table(spark, scratch):
    """Merges in a row, one replayed; a table without an index gets one."""
    t = table(spark, scratch)
    want = {"k0": (-1, "d0"), "k90": (-2, "d3")}
    t.create(rows(spark, [(i, v, d) for i, (v, d) in want.items()]))
    for k in range(5):
        batch = [(f"k{(7 * i + k) % 40}", 100 * k + i, f"d{(i + k) % 4}") for i in range(25)]
        for _ in range(2 if k == 3 else 1):
            t.merge(rows(spark, batch), ["id"], f"b{k}")
        want |= {i: (v, d) for i, v, d in sorted(batch, key=lambda r: (r[0], r[1]))}
    assert content(t) == sorted((True, i, v, d) for i, (v, d) in want.items())
