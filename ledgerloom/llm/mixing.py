"""Mixing sources to target weights (8).

Sizes are summed per source with map-side partial sums; the small table of
sources gets its targets by filling up to caps (``targets``); the rate of a
source is target / size, and each document is emitted floor(rate) times plus
one more with probability equal to the fraction, decided by a hash of seed
and document, so reruns and retried tasks agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import as_rows, free_name, words

#: Above so many sources the table of rates is joined, not broadcast.
BROADCAST_SOURCES = 100_000
CYCLE = (5.0, 2.0, 1.0)


def word_count(text: Column) -> Column:
    """Words of a text (NULL: 0)."""
    return F.size(words(text)).cast("long")


def source_sizes(docs: DataFrame, size: Column, source_col: str = "source") -> DataFrame:
    """(source, source_size) over all documents."""
    return docs.groupBy(F.col(source_col).alias("source")).agg(
        F.sum(size).cast("long").alias("source_size"))


def targets(sizes: DataFrame, weights: DataFrame | None = None, share: float = 1.0,
            most: float = 3.0) -> DataFrame:
    """(source, source_size, weight, target) from (source, source_size).

    ``share`` of all sizes is shared by weight; no target exceeds ``most``
    times its source's size, and the excess is shared again by weight among
    the others until none is above. That limit is a water level: the target is
    min(cap, weight * level). Sources are ordered by cap / weight; if the first
    k are full, the level is (total - their caps) / (weight of the rest), and
    the first source whose own cap / weight reaches that level ends the full
    ones. ``weights`` (source, weight) may be given; without it the sources by
    code point, NULL last, weigh 5, 2, 1 in turn. A source of size 0 has target
    0. The windows run over the table of sources, one row each.
    """
    if weights is None:
        rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
        cycle = F.array(*map(F.lit, CYCLE))
        t = sizes.withColumn("weight", F.element_at(cycle, (rank % len(CYCLE) + 1).cast("int")))
    else:
        w = weights.select(F.col("source").alias("_s"), F.col("weight").cast("double"))
        t = sizes.join(w, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s") \
            .withColumn("weight", F.coalesce("weight", F.lit(0.0)))
    t = t.withColumn("cap", F.lit(most) * F.col("source_size"))
    fill = F.when(F.col("weight") > 0, F.col("cap") / F.col("weight")).otherwise(F.lit(float("inf")))
    t = t.withColumn("fill", fill)
    order = [F.col("fill").asc(), F.col("source").asc_nulls_last()]
    all_rows = Window.partitionBy()
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    total = F.lit(share) * F.sum("source_size").over(all_rows)
    t = t.withColumns({
        "level": (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        / F.nullif(F.sum("weight").over(onward), F.lit(0.0))})
    t = t.withColumn("place", F.row_number().over(Window.orderBy(*order)))
    t = t.withColumn("open", F.min(F.when(F.col("fill") >= F.col("level"), F.struct("place", "level")))
                     .over(all_rows))
    level = F.col("open.level")
    return t.select("source", "source_size", "weight",
                    F.when(F.col("source_size") == 0, 0.0).when(F.col("weight") == 0, 0.0)
                    .when(level.isNull(), F.col("cap"))
                    .otherwise(F.least(F.col("cap"), F.col("weight") * level)).alias("target"))


def copies(docs: DataFrame, size: Column, id_col: str = "doc_id", source_col: str = "source",
           weights: DataFrame | None = None, share: float = 1.0, most: float = 3.0,
           seed: int = 8, prefix: str = "mix_") -> DataFrame:
    """``docs`` with its columns and, prefixed, size, source_size, target,
    rate and copies (how often the mix takes the row).

    A NULL source is a source of its own. A NULL id hashes like any value;
    rows with one id decide alike. Empty texts have size 0 and get copies like
    the rest. Empty table: no rows. Columns named like the prefixed ones are
    replaced.
    """
    table = targets(source_sizes(docs, size, source_col), weights, share, most)
    key = free_name(docs, "mixed_source")
    table = table.select(F.col("source").alias(key), F.col("source_size").alias(prefix + "source_size"),
                         F.col("target").alias(prefix + "target"))
    small = table.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    names = [prefix + n for n in ("size", "source_size", "target", "rate", "copies")]
    d = docs.drop(*names).withColumn(prefix + "size", size)
    d = d.join(F.broadcast(table) if small else table,
               F.col(source_col).eqNullSafe(F.col(key))).drop(key)
    rate = F.when(F.col(prefix + "source_size") > 0, F.col(prefix + "target") / F.col(prefix + "source_size")) \
        .otherwise(0.0)
    d = d.withColumn(prefix + "rate", rate)
    # 52 bits of a digest of seed and id: uniform in [0, 1).
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")).cast("binary"))
    draw = F.conv(F.substring(h, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
    whole = F.floor(prefix + "rate")
    extra = (draw < F.col(prefix + "rate") - whole).cast("int")
    return d.withColumn(prefix + "copies", (whole + extra).cast("int"))


def mix(docs: DataFrame, size: Column, **options) -> DataFrame:
    """The mix itself: the columns of ``docs``, whatever their names, each row
    as often as taken. NULL sources, NULL ids, empty texts and repeated rows as
    in ``copies``; a row of size 0 is emitted like the others of its source,
    none where the source has size 0. Very long texts count whole. Empty table:
    no rows."""
    own = as_rows(docs, F.col(options.pop("id_col", "doc_id")).alias("doc_id"),
                  F.col(options.pop("source_col", "source")).alias("source"), size.alias("size"))
    taken = copies(own, F.col("size"), **options).filter("mix_copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("mix_copies")))).select("row.*")
