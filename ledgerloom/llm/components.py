"""Connected components of a link table, by alternating large-star and
small-star steps. Each step is a minimum per node (map-side combined) and a
join, so neither a hub node nor a large component lands in one task, and
nothing but one count and one checksum per round reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link the larger neighbours of each node to the least of it and its neighbours."""
    around = _both(edges)
    least = around.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return (around.filter(F.col("v") > F.col("u")).join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    near = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return near.union(own).filter("u <> v").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) for every node of a link that is not its component's
    least; ``component`` is the least id reachable. Links to oneself, doubled
    and NULL ones are ignored. Empty table: no rows."""
    edges = links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v").distinct()
    edges, before = written(edges, "links"), None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now[0] == 0 or now == before:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
        before = now
        edges = written(_small_star(_large_star(edges)), "links")
