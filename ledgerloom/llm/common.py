"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: A word: a maximal run of code points other than blank, tab, line feed,
#: vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
WHITE = " \t\n\x0b\x0c\r"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder the cluster names in
    ``spark.checkpoint.dir``; every executor can reach it."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back. Like a
    reliable checkpoint it cuts the lineage and survives lost executors, and
    it is columnar and compressed."""
    path = shared_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_HELD: dict[str, Callable[[], None]] = {}


def claim(owner: str, release: Callable[[], None]) -> None:
    """Called in a Python worker by an operator that remembers things from task
    to task: what other operators remember there is released, so a worker that
    serves many stages holds the memory of one."""
    others = [name for name in _HELD if name != owner]
    for name in others:
        _HELD.pop(name)()
    if others:
        gc.collect()
        give_back()
    _HELD[owner] = release


def give_back() -> None:
    """Freed memory of a Python worker back to the system: workers live on
    between tasks, and the C library keeps what numpy frees."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)          # GNU systems have it
    if trim is not None:
        trim(0)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores before it, so that ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def as_rows(df: DataFrame, *columns: Column) -> DataFrame:
    """``columns`` beside the whole row as one struct ``row``, so that no column
    an operator adds can clash with those of ``df``."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *columns)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once: bound as the variable of
    a one-element ``transform``, so Catalyst cannot copy a costly expression
    into each use (or into each step of a nested lambda)."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text as an array (NULL text: empty array). The text is
    cut on single white-space characters, which needs no regular expression
    backtracking, and the empty strings between them are removed."""
    flat = F.translate(F.coalesce(text, F.lit("")), WHITE[1:], " " * (len(WHITE) - 1))
    return F.array_remove(F.split(flat, " "), "")
