"""Full-row distinct of wide tables (H16) without a shuffle of the rows.

``dropDuplicates`` shuffles every row whole, although most tables hold few
copies. Here a hash of each row is counted first (8 bytes a row, aggregated
map-side); only rows whose hash occurs again can have a copy, and only they go
through ``dropDuplicates``. The others are passed on where they were read. Rows
of equal hash are compared whole, so a collision costs a comparison, no row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

MOST_REPEATED = 1_000_000       # hashes that are broadcast, 8 bytes each


def distinct_rows(df: DataFrame, most: int = MOST_REPEATED) -> DataFrame:
    """The rows of ``df``, each once; NULLs, NaNs and zeros of either sign are
    alike, as in ``dropDuplicates``. ``df`` is read up to three times, so it
    should come from a stored table. Counting the hashes is a job of its own:
    without any repeated hash ``df`` is returned as it is, and where more than
    ``most`` are repeated (they would not be broadcast) plain
    ``dropDuplicates`` does the work."""
    if not df.columns:
        return df.dropDuplicates()
    h = "_row_hash"
    while h in df.columns:
        h += "_"
    hashed = df.withColumn(h, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    repeated = materialize(hashed.groupBy(h).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(h))
    n = repeated.count()
    if n == 0:
        return df
    if n > most:
        return df.dropDuplicates()
    few = F.broadcast(repeated)
    once = hashed.join(few, h, "left_anti").drop(h)
    return once.unionByName(hashed.join(few, h, "left_semi").drop(h).dropDuplicates())
