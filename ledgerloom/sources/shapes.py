"""Documents of unknown shape (A4, C8): the fields are found in the data.

Every line is parsed to a variant. One aggregate merges the shapes of all
documents (partial per task, then one small text); where a field holds an
object in some documents and something else in others, a further aggregate over
just those fields finds the objects' fields. Each leaf then becomes a text
column, so a field that a single document has is not lost and no schema is given.

Results: blank lines are no documents; a line that is no JSON object (broken
text, an array, a number, repeated keys) keeps its text in ``_corrupt_record``,
a column that is always there, with all other columns NULL. JSON null and a
missing field are NULL; an empty object has no columns; arrays stay whole as
JSON text. A field that is sometimes an object has a column of its own beside
its children, NULL where it is an object (none if it is NULL everywhere else). Paths whose flat names are equal
(``a_b`` and ``b`` in ``a``; also ``A`` and ``a`` unless
``spark.sql.caseSensitive`` is set) share one column: the first value of the
paths in the order of their length and names. Documents without any field, or no
documents, give only ``_corrupt_record``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .documents import SYSTEM_FIELDS, cast_numeric

CORRUPT = "_corrupt_record"
OBJECT = "OBJECT<"
Path = tuple[str, ...]


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(text, doc): a row per line that is not blank; ``doc`` is the document as
    a variant, NULL where the line is no JSON object."""
    lines = spark.read.text(path).select(F.col("value").alias("text")).filter(F.trim("text") != "")
    parsed = lines.withColumn("doc", F.try_parse_json("text"))
    return parsed.withColumn("doc", F.when(_is_object(F.col("doc")), F.col("doc")))


def _is_object(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value).startswith(OBJECT), F.lit(False))


def _get(path: Path, kind: str) -> Column:
    """The value at a path. Paths of the variant functions know no escapes, so
    a key that has both quotes is looked up in a map."""
    doc, at = F.col("doc"), "$"
    for k in path:
        if "'" in k and '"' in k:
            doc, at = F.try_variant_get(doc, at, "map<string,variant>")[F.lit(k)], "$"
        else:
            at += f'["{k}"]' if "'" in k else f"['{k}']"
    return F.try_variant_get(doc, at, kind)


def _part(path: Path) -> Column:
    return _get(path, "variant") if path else F.col("doc")


def _merged(shape: str | None) -> T.DataType:
    """The type that a merged shape's text names."""
    if shape is None:
        return T.StructType([])
    text = re.sub(r"`(?:[^`]|``)*`|OBJECT<", lambda m: "STRUCT<" if m.group() == OBJECT else m.group(), shape)
    return T.StructType.fromDDL(f"shape {text}")["shape"].dataType


def _walk(kind: T.DataType, path: Path, leaves: dict[Path, bool], mixed: list[Path]) -> None:
    if isinstance(kind, T.StructType):
        for f in kind.fields:
            if not path and f.name in SYSTEM_FIELDS:
                continue
            _walk(f.dataType, (*path, f.name), leaves, mixed)
    elif isinstance(kind, T.VariantType):
        leaves[path] = True
        mixed.append(path)
    else:
        leaves[path] = False


def leaf_paths(docs: DataFrame, max_columns: int = 10_000) -> dict[Path, bool]:
    """Paths of all leaves of all documents; True for those that may hold an
    object in some documents. One job, and one more per level at which kinds
    differ. More than ``max_columns`` leaves is an error: such keys are data."""
    leaves: dict[Path, bool] = {}
    pending: list[Path] = [()]
    while pending:
        shapes = docs.agg(*[F.schema_of_variant_agg(F.when(_is_object(_part(p)), _part(p))).alias(f"s{i}")
                            for i, p in enumerate(pending)]).first()
        mixed: list[Path] = []
        for path, shape in zip(pending, shapes):
            # Without any object the merged shape is VOID: the field has no children.
            kind = _merged(shape)
            if isinstance(kind, T.StructType):
                _walk(kind, path, leaves, mixed)
        pending = mixed
        if len(leaves) > max_columns:
            raise ValueError(f"{len(leaves)} fields, more than max_columns={max_columns}: are keys data?")
    return leaves


def flatten_documents(docs: DataFrame, leaves: dict[Path, bool] | None = None, sep: str = "_") -> DataFrame:
    """One text column per leaf, named by its path, and ``_corrupt_record``."""
    leaves = leaf_paths(docs) if leaves is None else leaves
    exact = docs.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    columns: dict[str, list[Path]] = {}
    for path in sorted(leaves, key=lambda p: (len(p), p)):
        name = sep.join(path)
        columns.setdefault(name if exact else name.lower(), []).append(path)
    corrupt = F.when(F.col("doc").isNull(), F.col("text"))
    out = []
    for key, paths in columns.items():
        values = []
        for path in paths:
            value = _get(path, "string")
            values.append(F.when(~_is_object(_part(path)), value) if leaves[path] else value)
        if key == CORRUPT:
            corrupt = F.coalesce(corrupt, *values)
            continue
        out.append(F.coalesce(*values).alias(sep.join(paths[0])))
    return docs.select(*out, corrupt.alias(CORRUPT))


def bronze_documents(spark: SparkSession, path: str | list[str], numeric_fields=(), sep: str = "_") -> DataFrame:
    """Bronze shape of a collection of unknown shape: system fields dropped,
    flattened, named numeric fields normalised (NULL where they are no number),
    all text."""
    flat = flatten_documents(read_lines(spark, path), sep=sep)
    names = [n for n in numeric_fields if n in flat.columns]
    return cast_numeric(flat, names).withColumns({n: F.col(n).cast("string") for n in names})
