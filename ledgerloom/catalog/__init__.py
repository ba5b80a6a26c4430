"""Registered queries: each pairs a Spark callable ``(spark, sf_dir) ->
DataFrame`` with an independent DuckDB SQL twin (or none, for operators SQL
cannot express, which are checked against brute force in the tests).

Every query reads the driver tables through the fixture adapters, so its
work grows with the data; none runs on made-up input alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def export(df: DataFrame) -> DataFrame:
    """Comparable output: dates/timestamps as ISO text, string arrays joined
    with commas, doubles rounded to 6 places (sums of whole amounts are exact
    already; ratios are rounded on both sides)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(t, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), ",")
        elif isinstance(t, (T.DoubleType, T.FloatType)):
            c = F.round(c, 6)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def load_all() -> None:
    """Import every catalog module (each registers its queries)."""
    from . import c360, alerts, model, ingest, reports  # noqa: F401
