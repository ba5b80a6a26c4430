"""Versioned tables: all or none of a merge, what changed, what goes."""
import glob
import os

import pytest

from ledgerloom.plans import report_state as R
from ledgerloom.plans import reports
from ledgerloom.sources.versions import VersionedTable, refresh

SCHEMA = "id string, v long, day string"


def rows(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def content(df):
    return sorted(((r.id or "", r.v, str(r.day)) for r in df.collect()))


def spoil(folder):
    """Files that fail if they are opened."""
    names = glob.glob(f"{folder}/*.parquet")
    assert names
    for name in names:
        with open(name, "wb") as f:
            f.write(b"broken")
        crc = os.path.join(os.path.dirname(name), f".{os.path.basename(name)}.crc")
        if os.path.exists(crc):
            os.remove(crc)


@pytest.fixture()
def table(spark, scratch):
    return VersionedTable(spark, f"{scratch}/t", ["day"], keep=3)


def test_a_pinned_reader_sees_old_rows_whole(spark, table):
    first = [("a", 1, "2024-01-01"), ("b", 2, "x y/z=%"), ("c", 3, None), ("d", 4, "2024-01-01")]
    table.merge(rows(spark, first), ["id"], "r1")
    pinned = table.read()                                   # planned before the merge, run after it
    # a moves, b changes, c's partition is emptied, an empty text is the NULL partition
    table.merge(rows(spark, [("a", 10, "d9"), ("b", 20, "x y/z=%"), ("c", 30, "d9"), ("n", 5, "")]), ["id"], "r2")
    assert content(pinned) == content(table.read(version=1)) == sorted((i, v, str(d)) for i, v, d in first)
    assert content(table.read()) == [("a", 10, "d9"), ("b", 20, "x y/z=%"), ("c", 30, "d9"), ("d", 4, "2024-01-01"),
                                     ("n", 5, "None")]
    assert table.read().schema.simpleString() == "struct<id:string,v:bigint,day:string>"    # no guessed dates
    assert table.changed_since(1) == [(None,), ("2024-01-01",), ("d9",), ("x y/z=%",)]
    assert table.changed_since(2) == [] and table.changed_since(7) is None


def test_a_failed_write_changes_nothing(spark, scratch, table):
    table.merge(rows(spark, [("a", 1, "d1"), ("b", 2, "d2")]), ["id"], "r1")
    bad = rows(spark, [("a", 2, "d1")]).selectExpr("id", "if(v > 0, raise_error('x'), v) as v", "day").selectExpr(
        "id", "cast(v as long) as v", "day")
    with pytest.raises(Exception):
        table.merge(bad, ["id"], "r2")
    os.makedirs(f"{scratch}/t/data/_write=000002-left/day=d1", exist_ok=True)
    assert content(table.read()) == [("a", 1, "d1"), ("b", 2, "d2")] and table.version() == 1
    table.merge(rows(spark, [("a", 3, "d2")]), ["id"], "r3")
    assert content(table.read()) == [("a", 3, "d2"), ("b", 2, "d2")]
    assert not os.path.exists(f"{scratch}/t/data/_write=000002-left")


def test_old_versions_go(spark, scratch, table):
    for n in range(6):
        table.merge(rows(spark, [("a", n, "d1"), (f"k{n}", n, f"e{n}")]), ["id"], f"r{n}", moves=False)
    assert content(table.read()) == sorted([("a", 5, "d1"), *((f"k{n}", n, f"e{n}") for n in range(6))])
    held = sorted(os.path.relpath(p, f"{scratch}/t/data") for p in glob.glob(f"{scratch}/t/data/*/day=*"))
    assert [p for p in held if p.endswith("d1")] == [f"_write=00000{n}-r{n - 1}/day=d1" for n in (4, 5, 6)]
    assert len([p for p in held if "day=e" in p]) == 6
    assert table.manifests._versions() == [4, 5, 6] and content(table.read(version=4))[0] == ("a", 3, "d1")


def test_a_merge_opens_candidate_partitions_only(spark, scratch, table):
    table.merge(rows(spark, [(f"k{d}-{i}", i, f"d{d}") for d in range(4) for i in range(20)]), ["id"], "b0")
    spoil(f"{scratch}/t/data/_write=000001-*/day=d3")
    table.merge(rows(spark, [("k2-7", 700, "d9")]), ["id"], "b1")
    got = content(table.read_partitions([("d2",), ("d9",), ("none",)]))
    assert len(got) == 20 and ("k2-7", 700, "d9") in got


def test_empty_tables(spark, table):
    table.merge(rows(spark, []), ["id"], "r0")
    assert table.exists() and table.read().count() == 0 and table.read().columns == ["id", "v", "day"]
    table.merge(rows(spark, [("a", 1, "d1")]), ["id"], "r1")
    table.merge(rows(spark, []), ["id"], "r2")
    assert content(table.read()) == [("a", 1, "d1")] and table.changed_since(2) == []


FACT = ("TransactionID string, Year int, Month int, DateKey int, Channel string, CustomerSK long, Amount double, "
        "TransactionStatus string")


def fact_rows(spark, months, factor=1.0):
    data = [(f"t{m}-{i}", 2024, m, 20240000 + 100 * m + 1 + i % 3, "ATM" if i % 2 else "UPI", i % 4 or None,
             None if i == 5 else factor * (i - 4), "Failed" if i % 3 == 0 else "Success") for m in months for i in range(12)]
    return spark.createDataFrame(data, FACT)


def test_reports_from_state_read_changed_months_only(spark, scratch):
    fact = VersionedTable(spark, f"{scratch}/fact", ["Year", "Month"])
    fact.merge(fact_rows(spark, [1, 2, 3]), ["TransactionID"], "m1", moves=False)

    def state():
        return {n: R.state_table(spark, f"{scratch}/state", n).read() for n in R.STATES}

    def same(got, want):
        def key(r):
            return [(v is not None, v) for v in r]
        assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)

    assert R.refresh_reports(spark, fact, f"{scratch}/state") == {"daily": None, "customers": None}
    fact.merge(fact_rows(spark, [3, 4], 2.0), ["TransactionID"], "m2", moves=False)
    whole = spark.createDataFrame(fact.read().collect(), fact.read().schema)
    for m in (1, 2):
        spoil(f"{scratch}/fact/data/_write=000001-*/Year=2024/Month={m}")
    months = [("2024", "3"), ("2024", "4")]
    assert R.refresh_reports(spark, fact, f"{scratch}/state") == {"daily": months, "customers": months}
    assert R.refresh_reports(spark, fact, f"{scratch}/state") == {"daily": [], "customers": []}
    s = state()
    same(R.spend_income(s["customers"]), reports.spend_income(whole))
    same(R.channel_kpi(s["daily"]), reports.channel_kpi(whole))
    calendar = whole.selectExpr("DateKey", "format_string('%d-%02d', Year, Month) as YearMonth").distinct()
    for grain in ("DateKey", "YearMonth"):
        same(R.trend(s["daily"], grain), reports.trend(whole, calendar, grain))


def test_refresh_rebuilds_when_its_version_is_gone(spark, scratch):
    source = VersionedTable(spark, f"{scratch}/s", ["day"], keep=1)
    target = VersionedTable(spark, f"{scratch}/g", ["day"])
    source.merge(rows(spark, [("a", 1, "d1"), ("b", 2, "d2")]), ["id"], "r1")
    assert refresh(target, source, lambda d: d) is None
    source.replace(rows(spark, []), rows(spark, [("b", 2, "d2")]).select("day"), "r2")      # d2 is emptied
    source.merge(rows(spark, [("c", 3, "d3")]), ["id"], "r3")
    assert refresh(target, source, lambda d: d) is None
    assert content(target.read()) == [("a", 1, "d1"), ("c", 3, "d3")] and target.note() == "3"
