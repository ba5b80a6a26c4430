"""Keyed merges as pure DataFrame functions.

Without a table format that supports MERGE, a merge produces the next
snapshot of the table: ``sources.snapshot`` writes it as a new version and
switches the pointer last, so readers never see a half-written table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from .scan import global_row_number


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last write wins: one row per key, the one last in ``order``.
    ``max_by`` aggregates partially, so a hot key never lands whole in one
    task."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    return (df.groupBy(*keys)
            .agg(F.max_by(F.struct(*rest), F.struct(*[F.col(c) for c in order])).alias("_r"))
            .select(*keys, "_r.*").select(*df.columns))


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the last in ``order``; without it the greatest over
    all other columns, so the choice is repeatable. NULL keys are one key."""
    return latest_per_key(df, keys, list(order) if order else [c for c in df.columns if c not in set(keys)])


def same_key(left: str, right: str, keys: Sequence[str]) -> Column:
    """NULL-safe equality on every key column of two aliased frames."""
    out = F.lit(True)
    for k in keys:
        out = out & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return out


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           order: Sequence[str] | None = None) -> DataFrame:
    """Update-all / insert-all on ``keys``, NULL-safe. The source is
    first reduced to one row per key (the last in ``order``): a bulk upsert of
    several versions of one key ends with the last."""
    keys = list(keys)
    src = one_per_key(source, keys, order)
    src = src.select(*target.columns) if set(target.columns) <= set(src.columns) else src
    kept = target.alias("t").join(src.select(*keys).alias("s"), same_key("t", "s", keys), "left_anti")
    return kept.unionByName(src, allowMissingColumns=True)


def changed(cols: Sequence[str], left: str = "t", right: str = "s") -> Column:
    """K2: any tracked column differs, NULL-safely."""
    conds = [~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in cols]
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return out


def scd2_merge(dim: DataFrame | None, source: DataFrame, key: str, compare_cols: Sequence[str],
               as_of=None, sk_col: str = "CustomerSK",
               extra_cols: Sequence[str] = ()) -> DataFrame:
    """SCD2 in one join (K1-K6).

    * current rows whose tracked columns changed are closed
      (``CurrentFlag = false``, ``EffectiveTo = as_of``);
    * a new version is inserted for changed and for new keys, with surrogate
      keys continuing after the current maximum, numbered by business key;
    * keys missing from the source stay current (Q7); history passes through;
    * source rows with a NULL business key are left out (Q6: they would be
      re-inserted on every run) - see ``scd2_rejects``.

    ``dim=None`` is the first load. ``as_of`` is taken once, so a closed
    version's EffectiveTo equals its successor's EffectiveFrom.
    """
    ts = C.as_of_ts(as_of)
    cols = [key, *compare_cols, *extra_cols]
    src = source.filter(F.col(key).isNotNull()).select(*cols)
    out_cols = [sk_col, *cols, "EffectiveFrom", "EffectiveTo", "CurrentFlag"]
    fresh = {"EffectiveFrom": ts, "EffectiveTo": F.lit(None).cast("timestamp"),
             "CurrentFlag": F.lit(True)}
    if dim is None:
        return global_row_number(src, [key], sk_col).withColumns(fresh).select(*out_cols)
    history = dim.filter(~F.col("CurrentFlag"))
    current = dim.filter(F.col("CurrentFlag"))

    j = current.alias("t").join(src.alias("s"), F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer")
    is_changed = F.col(f"t.{key}").isNotNull() & F.col(f"s.{key}").isNotNull() & changed(
        list(compare_cols) + list(extra_cols))
    j = j.withColumn("_changed", is_changed)

    kept = (j.filter(F.col(f"t.{key}").isNotNull())
            .select(*[F.col(f"t.{c}").alias(c) for c in [sk_col, *cols, "EffectiveFrom"]],
                    F.when(F.col("_changed"), ts).otherwise(F.col("t.EffectiveTo")).alias("EffectiveTo"),
                    F.when(F.col("_changed"), F.lit(False)).otherwise(F.col("t.CurrentFlag"))
                    .alias("CurrentFlag")))
    inserts = (j.filter(F.col(f"s.{key}").isNotNull()
                        & (F.col(f"t.{key}").isNull() | F.col("_changed")))
               .select(*[F.col(f"s.{c}").alias(c) for c in cols]))
    max_sk = dim.agg(F.coalesce(F.max(sk_col), F.lit(0)).cast("long")).scalar()
    new = (global_row_number(inserts, [key], sk_col)
           .withColumn(sk_col, F.col(sk_col) + max_sk).withColumns(fresh))
    return (history.select(*out_cols).unionByName(kept.select(*out_cols))
            .unionByName(new.select(*out_cols)))


def scd2_rejects(source: DataFrame, key: str) -> DataFrame:
    """Q6: source rows the SCD2 merge leaves out (NULL business key)."""
    return source.filter(F.col(key).isNull())


def scd1_merge(dim: DataFrame, source: DataFrame, key: str, sk_col: str) -> DataFrame:
    """K8: overwrite attributes of known keys, keep their surrogate keys;
    new keys get keys after the current maximum."""
    attrs = [c for c in source.columns if c != sk_col]
    matched = (dim.select(sk_col, key).join(source.select(*attrs), key, "inner"))
    untouched = dim.join(source.select(key), key, "left_anti")
    fresh = source.select(*attrs).join(dim.select(key), key, "left_anti")
    max_sk = dim.agg(F.coalesce(F.max(sk_col), F.lit(0)).cast("long")).scalar()
    fresh = global_row_number(fresh, [key], sk_col).withColumn(sk_col, F.col(sk_col) + max_sk)
    cols = [sk_col, *attrs]
    return (untouched.select(*cols).unionByName(matched.select(*cols))
            .unionByName(fresh.select(*cols)))
