"""Key filters of few partitions are built by many tasks, bit by bit as Spark's bitmaps."""
from pyspark.sql import functions as F

from ledgerloom.sources import key_index
from ledgerloom.sources.key_index import KeyIndex


def test_one_partition_is_built_by_many_tasks(spark, scratch, monkeypatch):
    monkeypatch.setattr(key_index, "TASK_KEYS", 2000)
    spark.range(20_000).select("id", F.when(F.col("id") < 19_000, "a").alias("p")).write.parquet(f"{scratch}/rows")
    rows = spark.read.parquet(f"{scratch}/rows")
    index = KeyIndex(spark, f"{scratch}/t", ["p"], ["id"])
    filters = index.filters(rows.union(rows))                       # copies of a key change nothing
    assert filters.rdd.getNumPartitions() == 20
    got = {(r.p, r.slices, r.slice): bytes(r.bits) for r in filters.collect()}
    h = key_index.key_hash(["id"])
    first = F.shiftrightunsigned(h, 34).bitwiseAND(F.lit(32_767))
    step = F.shiftrightunsigned(h, 49).bitwiseOR(F.lit(1))
    for p, n, slices in (("a", 38_000, 64), (None, 2000, 2)):
        want = (rows.filter(F.col("p").eqNullSafe(F.lit(p)))
                .select(h.bitwiseAND(F.lit(slices - 1)).alias("slice"), F.explode(F.transform(
                    F.sequence(F.lit(0), F.lit(11)), lambda i: (first + i * step) % 32_768)).alias("at"))
                .groupBy("slice").agg(F.bitmap_construct_agg("at").alias("bits")).collect())
        assert {k[2]: b for k, b in got.items() if k[0] == p} == {r.slice: bytes(r.bits) for r in want}
        assert {k[1] for k in got if k[0] == p} == {slices}, n
