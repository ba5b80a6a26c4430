"""Every file of the store contents' stream is landed twice, ATM and UPI alike."""
import datetime as dt

import duckdb
from pyspark.sql import functions as F

from ledgerloom.catalog import ORACLES, ingest
from ledgerloom.checks import compare
from ledgerloom.streaming.file_stream import read_audit


def _tables(spark, folder):
    """60 events: clicks (ATM) and errors (UPI) of three files each, one
    without a time (no file name) and two without a user."""
    rows = [(i, None if i == 40 else dt.datetime(2024, 1, 1 + i % 30, i % 24), None if i in (7, 8) else i % 6,
             "error" if i % 3 == 0 else "click", 150.0 * i, f'{{"k": {i}}}') for i in range(1, 61)]
    (spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string")
     .coalesce(1).write.parquet(f"{folder}/events.parquet"))
    cust = [(i, f"Name {i}", "BUILDING", None if i == 5 else 10.5 * i, i % 4) for i in range(12)]
    (spark.createDataFrame(cust, "c_custkey long, c_name string, c_mktsegment string, c_acctbal double, c_nationkey int")
     .coalesce(1).write.parquet(f"{folder}/customer.parquet"))


def test_every_file_is_landed_twice_and_stands_once(spark, scratch, monkeypatch):
    _tables(spark, scratch)
    monkeypatch.setattr(ingest, "_scratch", lambda spark, kind: f"{scratch}/{kind}")
    out = ingest.q_stream_store_contents(spark, scratch).collect()
    audit = read_audit(spark, f"{scratch}/contents/out").filter("source_type in ('ATM', 'UPI')")
    landed = {(r.source_type, r.again): (r.files, r.rows) for r in audit.groupBy(
        "source_type", F.col("file_name").contains("again").alias("again")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("rows_parsed").alias("rows")).collect()}
    assert landed == {("ATM", False): (3, 39), ("ATM", True): (3, 39), ("UPI", False): (3, 20), ("UPI", True): (3, 20)}
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in ("events", "customer"):
        con.execute(f"create view {t} as select * from read_parquet('{scratch}/{t}.parquet/*.parquet')")
    r = compare(spark.createDataFrame(out), con, ORACLES["stream_store_contents"])
    assert r["values_match"], r
