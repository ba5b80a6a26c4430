"""Document sources and flattening.

Documents (profiles, alerts, transactions) are JSON lines with an explicit
schema - a distributed scan, never a driver-side list of items.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Store-maintained fields dropped on read.
SYSTEM_FIELDS = ("_rid", "_self", "_etag", "_attachments", "_ts")


def read_documents(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A4: full scan of a document collection stored as JSON lines."""
    return spark.read.schema(schema).json(path)


def drop_system_fields(df: DataFrame) -> DataFrame:
    """C9."""
    return df.drop(*[c for c in SYSTEM_FIELDS if c in df.columns])


def _walk(dtype: T.DataType, path: list[str], sep: str) -> list[tuple[str, Column]]:
    if isinstance(dtype, T.StructType):
        out = []
        for f in dtype.fields:
            out += _walk(f.dataType, path + [f.name], sep)
        return out
    col = F.col(".".join(f"`{p}`" for p in path))
    return [(sep.join(path), col)]


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Nested struct fields become ``parent_child`` columns; arrays and
    maps are kept whole."""
    cols = []
    for f in df.schema.fields:
        cols += [c.alias(name) for name, c in _walk(f.dataType, [f.name], sep)]
    return df.select(*cols)


def cast_numeric(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Tolerant numeric cast of the named columns that exist."""
    from ..functions.columns import to_float
    return df.withColumns({n: to_float(F.col(n)) for n in names if n in df.columns})


def stringify(df: DataFrame) -> DataFrame:
    """C11: every value as text, NULL kept; arrays/maps/structs as JSON."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            c = F.to_json(c)
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            from ..functions.columns import iso_utc
            c = iso_utc(c)
        else:
            c = c.cast("string")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def bronze(df: DataFrame, numeric_fields: Iterable[str] = ()) -> DataFrame:
    """Bronze shape of a document collection: system fields dropped,
    flattened, numeric fields normalised, then all text."""
    flat = flatten(drop_system_fields(df))
    return stringify(cast_numeric(flat, numeric_fields))
