"""A merge computes its source once, though several jobs read it."""
import pytest
from pyspark.sql import functions as F

from ledgerloom.sources.tables import PartitionedTable
from ledgerloom.sources.versions import VersionedTable


@pytest.mark.parametrize("kind", ["plain", "versioned"])
def test_source_of_a_merge_is_computed_once(spark, scratch, kind):
    t = (PartitionedTable(spark, f"{scratch}/t", ["p"], f"{scratch}/_staging") if kind == "plain"
         else VersionedTable(spark, f"{scratch}/t", ["p"]))
    rows = spark.range(40).select("id", (F.col("id") % 4).cast("int").alias("p"), F.lit(0).alias("v"))
    t.merge(rows, ["id"], "r1")
    seen = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def counted(x):
        seen.add(1)
        return 1
    source = spark.range(30, 50, 1, 2).select("id", F.lit(1).alias("p"), counted("id").alias("v"))
    t.merge(source, ["id"], "r2")
    assert seen.value == 20
    got = {r.id: (r.p, r.v) for r in t.read().collect()}
    assert got == {i: (i % 4, 0) for i in range(30)} | {i: (1, 1) for i in range(30, 50)}
    assert not source.storageLevel.useMemory
    kept = source.persist()                         # a caller's cache stays
    t.merge(kept, ["id"], "r3")
    assert kept.storageLevel.useMemory and t.read().count() == 50
    kept.unpersist()
