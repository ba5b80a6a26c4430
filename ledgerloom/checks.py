"""Spark-vs-DuckDB result comparison used by the tests and ``tools/check.py``.

Rows are compared as multisets after a canonical rendering of each value:
floats rounded to 6 places, dates and timestamps as ISO text, arrays as
tuples, NaN as NULL. Column order is ignored (columns sorted by name).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canon(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return None
        r = round(v, 6)
        return 0.0 if r == 0 else r
    if isinstance(v, decimal.Decimal):
        return canon(float(v))
    if isinstance(v, int):
        return v
    if isinstance(v, dt.datetime):
        if v.tzinfo is not None:
            v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(canon(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, canon(x)) for k, x in v.items()))
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], Counter(tuple(canon(r[i]) for i in order) for r in rows)


def compare(spark_df, duck_con, sql: str, show: int = 5) -> dict:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = duck_con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    sc, s = _rows(s_cols, s_rows)
    dc, d = _rows(d_cols, d_rows)
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "schema_match": sc == dc, "values_match": sc == dc and s == d}
    if not out["values_match"]:
        out["spark_cols"], out["oracle_cols"] = sc, dc
        out["only_spark"] = list((s - d).items())[:show]
        out["only_oracle"] = list((d - s).items())[:show]
    return out
