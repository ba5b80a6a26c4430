"""Records of delimited files whose quoted fields hold line breaks (A2), from
splits of the file side by side.

Whether a line begins inside quotes depends on all lines before it. Each line
is therefore read both ways: ends it inside quotes if it begins outside, and if
it begins inside? That is a function on two states. The functions of a split's
lines are composed, then those of a file's splits (one row each), which tells
every line the state it begins in. Quotes count where a field begins or ends,
so one inside a plain field changes nothing, and a closing quote puts things
right whatever came before.

Lines that are a record by themselves pass through. Only lines of records with
breaks are gathered, by the line where their record begins.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LINE = ("path", "block")


def without_quoted(line: Column, sep: str) -> Column:
    """A line without its complete quoted fields; possessive, so that long
    fields are passed in a loop."""
    s = re.escape(sep)
    return F.regexp_replace(line, rf'(^|{s})"[^"]*+(?:""[^"]*+)*+"(?={s}|\r?$)', "$1")


def ends_inside(line: Column, sep: str) -> Column:
    """A quoted field is open at the end of a line that begins outside quotes."""
    return F.when(line.contains('"'), without_quoted(line, sep).rlike(rf'(?:^|{re.escape(sep)})"')).otherwise(False)


def lines(spark: SparkSession, files: list[str], encoding: str = "UTF-8") -> DataFrame:
    """path, name, block (where its split begins), at (order in the split), value."""
    return (spark.read.option("lineSep", "\n").option("encoding", encoding).text(files)
            .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("name"),
                    F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value"))


def files_with_breaks(spark: SparkSession, files: list[str], sep: str, encoding: str = "UTF-8") -> set[str]:
    """Names of the paths that have a line which ends inside quotes."""
    open_ = lines(spark, files, encoding).filter(ends_inside(F.col("value"), sep))
    return {r["path"] for r in open_.select("path").distinct().collect()}         # one row per file at most


def _begins(df: DataFrame, keys: tuple[str, ...], order: str, first: Column, out: str) -> DataFrame:
    """``df`` with the state each row begins in: ``first`` for the first row of
    its ``keys``, then each row's function (columns from_out, from_in). The
    state is what the last constant function gave, turned by every function
    since that swaps the states."""
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    swap, fixed = F.col("from_out") & ~F.col("from_in"), F.col("from_out") == F.col("from_in")
    up_to = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    d = df.withColumn("_swaps", F.sum(swap.cast("long")).over(up_to))
    last = F.last(F.when(fixed, F.struct(F.col("from_out").alias("state"), F.col("_swaps").alias("swaps"))), ignorenulls=True).over(before)
    d = d.withColumns({"_last": last, "_before": F.coalesce(F.lag("_swaps").over(Window.partitionBy(*keys).orderBy(order)), F.lit(0))})
    turned = (F.col("_before") - F.coalesce(F.col("_last.swaps"), F.lit(0))) % 2 == 1
    return d.withColumn(out, F.coalesce(F.col("_last.state"), first) != turned).drop("_swaps", "_last", "_before")


def records(spark: SparkSession, files: list[str], sep: str, encoding: str = "UTF-8") -> DataFrame:
    """path, name and record (its whole text) of every record after the header
    line of each file; blank ones are left out. Line breaks inside quotes are
    kept as they are. A quote that never closes makes the rest of its file one
    record."""
    value = F.col("value")
    d = lines(spark, files, encoding).withColumns(
        {"from_out": ends_inside(value, sep), "from_in": ends_inside(F.concat(F.lit('"'), value), sep)})
    # Of a split: its function, by running through it from both states.
    ran = _begins(_begins(d, LINE, "at", F.lit(False), "s0"), LINE, "at", F.lit(True), "s1")
    after = {f"e{k}": F.when(F.col(f"s{k}"), F.col("from_in")).otherwise(F.col("from_out")) for k in (0, 1)}
    ran = ran.withColumns(after)
    blocks = ran.groupBy(*LINE).agg(
        F.max_by("e0", "at").alias("from_out"), F.max_by("e1", "at").alias("from_in"),
        F.max(F.when(~F.col("s0"), F.col("at"))).alias("start0"), F.max(F.when(~F.col("s1"), F.col("at"))).alias("start1"))
    blocks = _begins(blocks, ("path",), "block", F.lit(False), "inside")          # one row a split
    start = F.when(F.col("inside"), F.col("start1")).otherwise(F.col("start0"))
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(*LINE, "inside", F.last(F.when(start.isNotNull(), F.struct("block", start.alias("at"))), ignorenulls=True)
                           .over(earlier).alias("carried"))
    d = ran.join(blocks, list(LINE)).withColumns(
        {"begins": F.when(F.col("inside"), F.col("s1")).otherwise(F.col("s0")),
         "ends": F.when(F.col("inside"), F.col("e1")).otherwise(F.col("e0"))})
    in_block = Window.partitionBy(*LINE).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    own = F.last(F.when(~F.col("begins"), F.struct("block", "at")), ignorenulls=True).over(in_block)
    d = d.withColumns({"record_at": F.coalesce(own, F.col("carried")),
                       "line": F.row_number().over(Window.partitionBy(*LINE).orderBy("at"))})
    d = d.filter((F.col("block") > 0) | (F.col("line") > 1))
    single = d.filter(~F.col("begins") & ~F.col("ends")).select("path", "name", value.alias("record"))
    broken = d.filter(F.col("begins") | F.col("ends")).groupBy("path", "name", "record_at").agg(
        F.array_sort(F.collect_list(F.struct("block", "at", "value"))).alias("parts")).select(
        "path", "name", F.array_join(F.transform("parts", lambda p: p["value"]), "\n").alias("record"))
    return single.unionByName(broken).select("path", "name", F.regexp_replace("record", r"\r$", "").alias("record")) \
        .filter(F.trim("record") != "")
