"""The stream's test input is landed by tasks of a fixed number of rows."""
import glob

from pyspark.sql import functions as F

from ledgerloom.catalog.ingest import _dealt, _land_files


def _raw(spark, n):
    return spark.range(0, n, 1, 1).select(
        F.when(F.col("id") % 10 == 9, None).when(F.col("id") % 10 < 7, "atm_0.csv").otherwise("upi_1.csv").alias("file_name"),
        F.format_string("T%05d", "id").alias("TransactionID"))


def test_one_split_is_dealt_to_many_tasks(spark):
    raw = _raw(spark, 5000)
    parts = _dealt(raw, 1000).select("*", F.spark_partition_id().alias("p")).cache()
    sizes = parts.groupBy("p").agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.coalesce("file_name", F.lit(""))).alias("names")).collect()
    assert len(sizes) == 4 + 1 + 1 and max(r.n for r in sizes) <= 1000 and all(r.names == 1 for r in sizes)
    assert parts.drop("p").exceptAll(raw).isEmpty() and raw.exceptAll(parts.drop("p")).isEmpty()
    parts.unpersist()
    assert _dealt(raw.limit(0)).count() == 0


def test_landed_rows_are_all_there(spark, scratch):
    _land_files(_raw(spark, 50), scratch)
    landed = sorted(f.rsplit("/", 1)[-1] for f in glob.glob(f"{scratch}/inbox/*.csv"))
    assert [f.split("-part")[0] for f in landed] == ["__HIVE_DEFAULT_PARTITION__", "atm_0", "upi_1"]
    lines = [line for f in glob.glob(f"{scratch}/inbox/*.csv") for line in open(f).read().split()]
    assert sorted(x for x in lines if x != "TransactionID") == [f"T{i:05d}" for i in range(50)]
