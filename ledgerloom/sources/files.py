"""Delimited text sources (A1-A3, A8-A10, C6) and file listing.

Ingestion files arrive with a header whose field set and order vary
(``TransactionAmount`` or ``Amount``...), and possibly another delimiter.
Only the first line of each file is read on the driver (through the Hadoop
file system, concurrently, no Spark job); files are grouped by (delimiter,
header) and each group is one distributed ``spark.read.csv`` with an
all-string schema built from that header, so inference never turns ``00123``
into 123. Rows with more
fields than the header are kept and marked in ``_corrupt_record``, whichever
columns are read later; rows with fewer fields get NULLs and are not marked.
Doubled quotes inside a quoted field stand for one quote.
"""

from __future__ import annotations

import csv
from collections import defaultdict
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C
from ..schemas import all_strings
from .quoted import files_with_breaks, records

# Delimiters considered, comma is the fallback.
DELIMITERS = (",", ";", "\t", "|")
CORRUPT = "_corrupt_record"


def detect_delimiter(first_line: str | None) -> str:
    """A2: the candidate that occurs most often in the header line."""
    if not first_line:
        return ","
    counts = {d: first_line.count(d) for d in DELIMITERS}
    best = max(DELIMITERS, key=lambda d: counts[d])
    return best if counts[best] > 0 else ","


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def first_line(spark: SparkSession, path: str, encoding: str = "UTF-8") -> str | None:
    """A3: the first line of a file, read through the Hadoop file system."""
    jvm = spark.sparkContext._jvm
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, encoding))
        line = reader.readLine()
        return None if line is None else line.lstrip("﻿")
    finally:
        stream.close()


def _qualified(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    return fs.makeQualified(p).toString()


def list_files(spark: SparkSession, root: str) -> list[str]:
    """Files directly under ``root`` (or ``root`` itself when it is a file)."""
    fs, p = _fs(spark, root)
    if fs.getFileStatus(p).isFile():
        return [str(p)]
    return sorted(str(s.getPath()) for s in fs.listStatus(p)
                  if s.isFile() and not s.getPath().getName().startswith(("_", ".")))


def split_header(line: str, sep: str) -> list[str]:
    """Header names, unquoted and trimmed; a quoted name may hold the delimiter."""
    return [h.strip() for h in next(csv.reader([line], delimiter=sep, skipinitialspace=True))]


def _surplus(raw: Column, sep: str, fields: int) -> Column:
    """A marked row has more fields than the header: separators outside quotes."""
    bare = F.regexp_replace(raw, r'"[^"]*+(?:""[^"]*+)*+"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))) >= fields


def _from_records(found: DataFrame, header: Sequence[str], sep: str) -> DataFrame:
    """Rows of whole records, parsed as the reader parses lines."""
    schema = all_strings(header)
    row = F.from_csv("record", ", ".join(f"`{f.name.replace('`', '``')}` string" for f in schema),
                     {"sep": sep, "escape": '"', "mode": "PERMISSIVE"})
    raw = F.col("record")
    return found.select(row.alias("row"), F.when(_surplus(raw, sep, len(header)), raw).alias(CORRUPT), "name", "path").select(
        "row.*", CORRUPT, F.col("name").alias("file_name"), F.col("path").alias("file_path"))


def read_delimited(spark: SparkSession, paths: Iterable[str], sep: str | None = None,
                   encoding: str = "UTF-8", multiline: bool = False) -> DataFrame:
    """A1-A3: read header-bearing delimited files as all-string rows plus
    ``file_name``, ``file_path`` and ``_corrupt_record``. Empty files give
    no rows. ``multiline`` keeps line breaks inside quotes: files that have
    some (one scan of the lines with quotes tells) are put together from their
    splits (``quoted.py``), the others are read as without it."""
    groups: dict[tuple[str, tuple[str, ...]], list[str]] = defaultdict(list)
    paths = list(paths)
    # Header reads are latency-bound (one open per file); issue them
    # concurrently - object stores answer in tens of milliseconds each.
    with ThreadPoolExecutor(max_workers=min(32, max(1, len(paths)))) as pool:
        heads = list(pool.map(lambda p: first_line(spark, p, encoding), paths))
    for path, line in zip(paths, heads):
        if not line:
            continue
        d = sep or detect_delimiter(line)
        groups[(d, tuple(split_header(line, d)))].append(path)
    frames = []
    for (d, header), files in groups.items():
        schema = all_strings(header).add(T.StructField(CORRUPT, T.StringType(), True))
        if multiline and (broken := files_with_breaks(spark, files, d, encoding)):
            frames.append(_from_records(records(spark, sorted(broken), d, encoding), header, d))
            done = {_qualified(spark, b) for b in broken}
            files = [f for f in files if _qualified(spark, f) not in done]
            if not files:
                continue
        df = (spark.read.schema(schema)
              .option("header", True).option("sep", d).option("encoding", encoding)
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
              .option("columnPruning", False).option("escape", '"')
              .csv(files))
        raw = F.col(CORRUPT)
        df = df.withColumn(CORRUPT, F.when(_surplus(raw, d, len(header)), raw))
        frames.append(df.select("*", F.col("_metadata.file_name").alias("file_name"),
                                F.col("_metadata.file_path").alias("file_path")))
    if not frames:
        empty = all_strings(["file_name", "file_path", CORRUPT])
        return spark.createDataFrame([], empty)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def route(df: DataFrame, file_col: str = "file_name") -> DataFrame:
    """Source type from the file name, and the extension gate."""
    return df.withColumns({
        "source_type": C.source_type(F.col(file_col)),
        "is_csv": C.is_csv_name(F.col(file_col)),
    })
