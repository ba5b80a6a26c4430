"""F1-F6 against a plain-Python model written from the rule text, on
hand-made rows with ties, window edges, NULL locations, copies and one hot
key. Every rule runs twice: window path and forced hot-group (range scan)
path; both must equal the model."""

import datetime as dt
import random
from collections import defaultdict

import pytest

from ledgerloom.operators import rules_txn as R

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)
SCHEMA = ("file_name string, TransactionID string, AccountNumber string, CustomerID string, "
          "Amount double, Timestamp timestamp, Location string")


def iso(t):
    return t.strftime("%Y-%m-%dT%H:%M:%S") + "+00:00"


def key_of(r):
    return (r[3] or "").strip() or (r[2] or "").strip() or "UNKNOWN"


def groups(rows):
    g = defaultdict(list)
    for r in rows:
        g[(r[0], key_of(r))].append(r)
    for k in g:
        g[k].sort(key=lambda r: (r[5], r[1]))
    return g


def model_velocity(rows, n, w):
    out = set()
    for (f, k), items in groups(rows).items():
        for i, a in enumerate(items):
            c = sum(1 for b in items[i:] if (b[5] - a[5]).total_seconds() <= w)
            if c >= n:
                out.add((f"ALERT_VELOCITY_{k}_{iso(a[5])}", a[1], float(c)))
    return out


def model_geo(rows, w):
    """Pairs per alert id; the kept alert is the last anchor (by time, id)
    with its last partner, as the store's last write."""
    pairs, kept = defaultdict(int), {}
    for (f, k), items in groups(rows).items():
        for i, a in enumerate(items):
            for b in items[i + 1:]:
                if (b[5] - a[5]).total_seconds() <= w and a[6] != b[6]:
                    aid = f"ALERT_GEO_{k}_{iso(a[5])}"
                    pairs[aid] += 1
                    if aid not in kept or (a[5], a[1]) >= kept[aid][0]:
                        kept[aid] = ((a[5], a[1]), b[1], f"Transaction from {a[6]} \u2192 {b[6]} within 1 minutes")
    return {(aid, float(n), kept[aid][1], kept[aid][2]) for aid, n in pairs.items()}


def model_drain(rows, thr, w):
    out = set()
    for (f, k), items in groups(rows).items():
        total, start = 0.0, items[0][5]
        for r in items:
            total += r[4]
            if (r[5] - start).total_seconds() <= w and total >= thr:
                out.add((f"ALERT_BALANCE_DRAIN_{k}_{iso(r[5])}", total))
                break
    return out


def make_rows(seed=7, n=400):
    rnd = random.Random(seed)
    rows, used = [], set()
    for i in range(n):
        hot = rnd.random() < 0.4
        cust = "C_HOT" if hot else rnd.choice(["C1", "C2", "", None, " "])
        acc = rnd.choice(["A1", "A2", "", None]) if not hot else "AH"
        t = T0 + dt.timedelta(seconds=rnd.randrange(0, 900, 15))  # many ties
        f = rnd.choice(["atm_1.csv", "upi_1.csv"])
        tid = f"T{i:05d}"
        loc = rnd.choice(["L1", "L2", None])
        rows.append((f, tid, acc, cust, float(rnd.randrange(1, 40) * 1000), t, loc))
        used.add(tid)
    return rows


@pytest.fixture(scope="module")
def rows(spark):
    data = make_rows()
    return data, spark.createDataFrame(data, SCHEMA)


@pytest.mark.parametrize("hot_rows", [None, 1])
def test_velocity_matches_model(rows, hot_rows):
    data, df = rows
    got = {(r.alert_id, r.TransactionID, r.metric)
           for r in R.velocity(df, 4, 120, hot_rows=hot_rows).collect()}
    assert got == model_velocity(data, 4, 120)


@pytest.mark.parametrize("hot_rows", [None, 1])
def test_geo_matches_model(rows, hot_rows):
    data, df = rows
    got = {(r.alert_id, r.metric, r.partner_TransactionID, r.reason)
           for r in R.geo_switch(df, 60, hot_rows=hot_rows).collect()}
    assert got == model_geo(data, 60)


@pytest.mark.parametrize("hot_rows", [None, 1])
def test_drain_matches_model(rows, hot_rows):
    data, df = rows
    got = {(r.alert_id, r.metric) for r in R.balance_drain(df, 90000.0, 300, hot_rows=hot_rows).collect()}
    assert got == model_drain(data, 90000.0, 300)


def test_window_edges(spark):
    # 10 rows spaced 13.33 s over 120 s, then one at +121 s.
    base = [("f.csv", f"T{i}", "A", "C", 1.0, T0 + dt.timedelta(seconds=s), "L")
            for i, s in enumerate([0, 13, 26, 40, 53, 66, 80, 93, 106, 120])]
    df = spark.createDataFrame(base, SCHEMA)
    hits = R.velocity(df, 10, 120).collect()
    assert [(h.TransactionID, h.metric) for h in hits] == [("T0", 10.0)]
    late = base[:-1] + [("f.csv", "T9", "A", "C", 1.0, T0 + dt.timedelta(seconds=121), "L")]
    assert R.velocity(spark.createDataFrame(late, SCHEMA), 10, 120).count() == 0


def test_copies_are_weighted(spark):
    t = T0 + dt.timedelta(seconds=5)
    copy = ("f.csv", "T1", "A", "C", 40000.0, t, "L1")
    data = [copy, copy, copy, ("f.csv", "T2", "A", "C", 1.0, t + dt.timedelta(seconds=1), "L2")]
    df = spark.createDataFrame(data, SCHEMA)
    geo = R.geo_switch(df, 60).collect()
    assert [(g.alert_id, g.metric, g.partner_TransactionID) for g in geo] == [(f"ALERT_GEO_C_{iso(t)}", 3.0, "T2")]
    drain = R.balance_drain(df, 100000.0, 60).collect()
    assert [(d.TransactionID, d.metric) for d in drain] == [("T1", 120000.0)]
    vel = R.velocity(df, 4, 60).collect()
    assert [(v.TransactionID, v.metric) for v in vel] == [("T1", 4.0)]


def test_high_value_and_keys(spark):
    data = [("f.csv", "T1", "A1", " ", 50000.0, None, None),
            ("f.csv", "T2", None, None, 49999.0, T0, None)]
    got = R.high_value(spark.createDataFrame(data, SCHEMA)).collect()
    assert [(g.alert_id, g.group_key, g.reason) for g in got] == [
        ("ALERT_HIGHVALUE_T1", "A1", "Transaction amount 50000.0 exceeds threshold 50000.0")]


def test_collapse_keeps_last(spark):
    t = T0
    data = [("f.csv", "T1", "A", "C", 1.0, t, "L"), ("f.csv", "T2", "A", "C", 1.0, t, "L")]
    v = R.velocity(spark.createDataFrame(data, SCHEMA), 1, 60, collapse=True).collect()
    assert [(x.alert_id, x.TransactionID, x.metric) for x in v] == [(f"ALERT_VELOCITY_C_{iso(t)}", "T2", 1.0)]
