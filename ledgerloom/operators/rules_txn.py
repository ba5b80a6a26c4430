"""Transaction fraud rules (F1-F6) over validated rows of one or many files.

The scope of every rule is one file, so the group is (file_name, key) with
key = CustomerID, else AccountNumber, else "UNKNOWN" (F5). Rows are ordered
by (time, TransactionID, row hash): the hash only orders rows that agree on
time and id.

Windowed rules size the (file, key) groups first. Ordinary groups - below
``max(100k rows, total / 100k)`` - use windows partitioned by the group, over
as many tasks as the rows need, so no task holds more than its share and such
a group; hot groups take the range-partitioned scans of
``operators.scan``, which split a group over many tasks. Counting rows in a
forward time window there uses *probe rows*: each row i adds a probe at
``t_i + W`` sorted after the data rows of that instant; the running count of
data rows before the probe minus the running count before row i is the number
of rows in ``[row i, t_i + W]``. No pair of rows is ever materialised.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..schemas import TXN_PAYLOAD_FIELDS
from .scan import Groups, _range_scan, segmented_scan, size_groups, split_hot

# Reference thresholds (defaults of the rule functions).
HIGH_VALUE_THRESHOLD = 50000.0
VELOCITY_WINDOW_SEC = 2 * 60
VELOCITY_TXN_COUNT = 10
GEO_WINDOW_SEC = 10 * 60
DRAIN_WINDOW_SEC = 10 * 60
DRAIN_THRESHOLD = 100000.0
# Running sums are exact decimals up to this a row (decimal(22,6) holds it); what is above is summed as double.
MOST_AMOUNT = 1e15

ALERT_COLUMNS = ("alert_id", "type", "reason", "created_at", "file_name", "group_key",
                 "AccountNumber", "CustomerID", "TransactionID", "anchor_ts", "metric")


def group_key() -> Column:
    """CustomerID, else AccountNumber, else UNKNOWN (empty falls through)."""
    return F.coalesce(C.blank_to_null("CustomerID"), C.blank_to_null("AccountNumber"),
                      F.lit("UNKNOWN"))


RULE_COLUMNS = ("TransactionID", "AccountNumber", "CustomerID", "Amount", "Timestamp", "Location")


def prepare(rows: DataFrame, file_col: str = "file_name") -> DataFrame:
    """Common input of the time rules: rows with a parsed time (Q26), exact
    copies folded into one row with a multiplicity ``_mult`` (a group of
    copies is aggregated map-side, never sent whole to one task), group key,
    epoch micros and a tie-break hash."""
    cols = [F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c)
            for c in RULE_COLUMNS]
    f = F.col(file_col) if file_col in rows.columns else F.lit(None).cast("string")
    base = rows.filter(F.col("Timestamp").isNotNull()).select(f.alias(file_col), *cols)
    folded = base.groupBy(*base.columns).agg(F.count(F.lit(1)).alias("_mult"))
    return folded.withColumns({
        "_file": F.coalesce(F.col(file_col), F.lit("")),
        "_key": group_key(),
        "_t": F.unix_micros("Timestamp"),
        "_tid": F.coalesce(F.col("TransactionID"), F.lit("")),
        "_h": F.xxhash64(*[F.col(c) for c in base.columns]),
    })


_GROUP = ["_file", "_key"]
_ORDER = ["_t", "_kind", "_tid", "_h"]
_ROW_KEY = [*_GROUP, "_t", "_tid", "_h"]        # names a folded row


def _prepare_with_hot(rows: DataFrame, file_col: str, hot_rows: int | None, keep: Callable = lambda p: p):
    """Folded rows and the sizes of their (file, key) groups: one sizing job
    that all windowed rules of a batch can share. ``keep`` may persist the
    folded rows before they are sized."""
    p = keep(prepare(rows, file_col))
    return p, size_groups(p, _GROUP, "_mult", hot_rows)


def _fmt_num(c: Column) -> Column:
    """Python-like text of a float (``12.0``, ``1234.5``, ``12500000.0``)."""
    return C.float_text(c)


def _minutes(sec: int) -> str:
    return str(sec // 60) if sec % 60 == 0 else str(sec / 60)


def _alert(kind: str, alert_id: Column, reason: Column, df: DataFrame, metric: Column,
           file_col: str, extra: dict[str, Column] | None = None) -> DataFrame:
    return df.select(*[c.alias(n) for n, c in (extra or {}).items()],
        alert_id.alias("alert_id"), F.lit(kind).alias("type"), reason.alias("reason"),
        C.iso_utc("Timestamp").alias("created_at"),
        F.col(file_col).alias("file_name"), F.col("_key").alias("group_key"),
        F.coalesce(F.col("AccountNumber"), F.lit("UNKNOWN")).alias("AccountNumber"),
        F.col("CustomerID"), F.col("TransactionID"),
        F.col("Timestamp").alias("anchor_ts"), metric.cast("double").alias("metric"))


def high_value(rows: DataFrame, threshold: float = HIGH_VALUE_THRESHOLD,
               file_col: str = "file_name") -> DataFrame:
    """Amount >= threshold; one alert per transaction. Needs no time. The
    alert's ``payload`` is the transaction's row (``TXN_PAYLOAD_FIELDS``)."""
    base = rows if file_col in rows.columns else rows.withColumn(file_col, F.lit(None).cast("string"))
    hits = base.filter(F.coalesce(F.col("Amount"), F.lit(0.0)) >= threshold).withColumn(
        "_key", group_key())
    reason = F.concat(F.lit("Transaction amount "), _fmt_num(F.col("Amount")),
                      F.lit(f" exceeds threshold {float(threshold)}"))
    aid = F.concat(F.lit("ALERT_HIGHVALUE_"), F.coalesce(F.col("TransactionID"), F.lit("None")))
    return _alert("HIGH_VALUE", aid, reason, hits, F.col("Amount"), file_col, {"payload": _transaction(hits)})


def _transaction(df: DataFrame) -> Column:
    """E5: a transaction's row as a struct of one type for all sources."""
    def field(f: str) -> Column:
        if f not in df.columns:
            return F.lit(None).cast("double" if f == "Amount" else "string")
        if dict(df.dtypes)[f] == "timestamp":
            return C.iso_utc(f)
        return F.col(f).cast("double" if f == "Amount" else "string")
    return F.struct(*[field(f).alias(f) for f in TXN_PAYLOAD_FIELDS])


def _with_probes(p: DataFrame, window_sec: int, extra_group: list[str] = ()) -> DataFrame:
    """Data rows (kind 0, weight = copies) plus one probe per row at t + W
    (kind 1, weight 0); ``_t0`` is the time of the row itself. Probes sort after
    data rows of the same instant, so a row exactly W later is inside the
    window."""
    keep = _GROUP + list(extra_group) + ["_t", "_tid", "_h"]
    data = p.select(*keep, F.col("_t").alias("_t0"), F.col("_mult").alias("_w")).withColumn("_kind", F.lit(0))
    probe = (p.select(*keep, F.col("_t").alias("_t0"))
             .withColumn("_t", F.col("_t") + F.lit(window_sec * 1_000_000))
             .withColumns({"_kind": F.lit(1), "_w": F.lit(0).cast("long")}))
    return data.unionByName(probe)


def _window_probes(df: DataFrame, groups: dict[str, list[str]], window_sec: int,
                   last: Column | None = None) -> DataFrame:
    """Ordinary groups, linear: each row stands at its own time and, as a
    probe without weight, at t + W; the running weight before the probe minus
    that before the row is the row's forward count in the group. ``groups``
    maps an output name to a grouping that refines ``_GROUP``, so all running
    sums and the final pairing of row and probe use one shuffle. ``last``
    (a struct of the row) adds ``_last``, the greatest one up to t + W."""
    rest = [c for c in df.columns if c not in _GROUP]
    row = F.struct(*rest)
    stands = F.explode(F.array(
        F.struct(F.col("_t").alias("at"), F.lit(0).alias("kind"), F.col("_mult").alias("w")),
        F.struct((F.col("_t") + F.lit(window_sec * 1_000_000)).alias("at"), F.lit(1).alias("kind"),
                 F.lit(0).cast("long").alias("w"))))
    carried = sorted({c for g in groups.values() for c in g if c not in _GROUP})
    u = df.select(*_GROUP, *carried, "_t", "_tid", "_h", row.alias("_row"), stands.alias("_p"),
                  *([last.alias("_own")] if last is not None else []))
    order = ["_p.at", "_p.kind", "_tid", "_h"]
    sums = {f"_b_{out}": F.sum("_p.w").over(
        Window.partitionBy(*g).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
        for out, g in groups.items()}
    if last is not None:
        sums["_max"] = F.max(F.when(F.col("_p.kind") == 0, F.col("_own"))).over(
            Window.partitionBy(*_GROUP).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    u = u.withColumns(sums)
    probe, own = F.col("_p.kind") == 1, F.col("_p.kind") == 0
    counts = [(F.coalesce(F.max(F.when(probe, F.col(f"_b_{out}"))), F.lit(0))
               - F.coalesce(F.max(F.when(own, F.col(f"_b_{out}"))), F.lit(0))).alias(out) for out in groups]
    found = u.groupBy(*_GROUP, "_t", "_tid", "_h").agg(
        F.any_value("_row").alias("_row"), *counts,
        *([F.max(F.when(probe, F.col("_max"))).alias("_last")] if last is not None else []))
    return found.select(*_GROUP, "_row.*", *groups, *(["_last"] if last is not None else []))


def _probe_counts(p: DataFrame, group: list[str], window_sec: int, out: str, tasks: int) -> DataFrame:
    """Hot groups: (group, time, id, hash, count) by probes over the
    range-partitioned scan, dealt to ``tasks`` by ``_ROW_KEY``."""
    extra = [g for g in group if g not in _GROUP]
    u = _with_probes(p, window_sec, extra)
    s = _range_scan(u, group, _ORDER, {"_before": ("sum", "_w", False)}, tasks)
    # Row and probe meet by (group, time, id, hash): the hash spreads a hot group over all tasks.
    s = s.drop("_t").withColumnRenamed("_t0", "_t").repartition(tasks, *_ROW_KEY)
    return s.groupBy(*_ROW_KEY).agg(
        (F.max(F.when(F.col("_kind") == 1, F.col("_before"))) - F.max(F.when(F.col("_kind") == 0, F.col("_before"))))
        .alias(out))


def forward_window_counts(p: DataFrame, window_sec: int, extra_groups: list[list[str]] = ([],),
                          outs: list[str] = ("_n",), hot_rows: int | None = None,
                          groups: Groups | None = None) -> DataFrame:
    """For every (folded) row and each grouping ``_GROUP + extra``: rows of
    its group from its first copy up to time t + W, in order, the row's own
    copies included.

    One hot-group check on ``_GROUP`` serves all groupings (a sub-group is
    never larger than its group); all ordinary-group windows share one
    shuffle, as every grouping refines ``_GROUP``."""
    hot, tasks = groups or size_groups(p, _GROUP, "_mult", hot_rows)
    cold, hot_p = (p, None) if hot is None else split_hot(p, hot, _GROUP)
    cold = _window_probes(cold.repartition(tasks, *_GROUP),
                          {out: _GROUP + list(extra) for extra, out in zip(extra_groups, outs)}, window_sec)
    if hot_p is None:
        return cold
    hot_out = hot_p.repartition(tasks, *_ROW_KEY)
    for extra, out in zip(extra_groups, outs):
        g = _GROUP + list(extra)
        counted = _probe_counts(hot_p.select(*g, "_t", "_tid", "_h", "_mult"), g, window_sec, out, tasks)
        hot_out = hot_out.join(counted, _ROW_KEY)
    return cold.unionByName(hot_out)


def velocity(rows: DataFrame, min_count: int = VELOCITY_TXN_COUNT,
             window_sec: int = VELOCITY_WINDOW_SEC, file_col: str = "file_name",
             collapse: bool = False, hot_rows: int | None = None,
             prepared: tuple[DataFrame, Groups] | None = None) -> DataFrame:
    """for each row (anchor), the rows from it up to W later; alert when
    that count reaches ``min_count``. Alert ids carry the key and anchor time,
    so anchors at one instant share an id (``collapse`` keeps the last).
    ``prepared`` = (folded rows, group sizes) shared by several rules."""
    p, groups = prepared or _prepare_with_hot(rows, file_col, hot_rows)
    counted = forward_window_counts(p, window_sec, groups=groups)
    hits = counted.filter(F.col("_n") >= min_count)
    aid = F.concat(F.lit("ALERT_VELOCITY_"), F.col("_key"), F.lit("_"), C.iso_utc("Timestamp"))
    reason = F.concat(F.col("_n").cast("string"),
                      F.lit(f" transactions within {_minutes(window_sec)} minutes"))
    out = _alert("VELOCITY_ATTACK", aid, reason, hits, F.col("_n"), file_col)
    return collapse_by_id(out) if collapse else out


_ROW = ["_t", "_tid", "_h", "_locnull", "_loc", "Location", "Timestamp", "TransactionID"]
_LOC_GROUP = ["_locnull", "_loc"]


def _row_struct() -> Column:
    return F.struct(*[F.col(c) for c in _ROW])


def _same_loc(a: Column, b: Column) -> Column:
    return a["_locnull"].eqNullSafe(b["_locnull"]) & a["_loc"].eqNullSafe(b["_loc"])


def _run_start(prev: Column, pd_name: str) -> dict:
    """A row starts a run of equal locations when the previous row of its
    group (``prev``) is absent or elsewhere; the run's 'previous other
    location' row is then ``prev``."""
    me = _row_struct()
    starts = prev.isNull() | ~_same_loc(prev, me)
    return {pd_name: F.when(starts & prev.isNotNull(), prev)}


def _partner(last: Column) -> Column:
    """Last row in the anchor's window at another location: the window's last
    row if it is elsewhere, else the row before that row's location run."""
    me = _row_struct()
    cand = F.when(~_same_loc(last, me), last.dropFields("_pd")).otherwise(last["_pd"])
    after = F.struct(cand["_t"], cand["_tid"], cand["_h"]) > F.struct("_t", "_tid", "_h")
    return F.when(cand.isNotNull() & after, cand)


def _partner_window(df: DataFrame, window_sec: int) -> DataFrame:
    w = Window.partitionBy(*_GROUP).orderBy("_t", "_tid", "_h")
    d = df.withColumn("_prev", F.lag(_row_struct()).over(w))
    d = d.withColumns(_run_start(F.col("_prev"), "_pd_start"))
    d = d.withColumn("_pd", F.last("_pd_start", ignorenulls=True).over(
        w.rowsBetween(Window.unboundedPreceding, 0)))
    d = _window_probes(d.drop("_prev", "_pd_start"), {"_n_all": _GROUP, "_n_same": _GROUP + _LOC_GROUP}, window_sec,
                       last=_row_struct().withField("_pd", F.col("_pd")))
    return d.withColumn("_partner", _partner(F.col("_last"))).drop("_pd", "_last")


def _partner_scan(hot_p: DataFrame, window_sec: int, tasks: int) -> DataFrame:
    """Hot groups: ``_n_all`` and ``_partner`` with range-partitioned scans -
    the previous row (exclusive running max of the row struct), the run's
    previous-other-location row carried forward, then one scan over data and
    probe rows (t + W) that yields both the count of rows before each element
    and, for probes, the window's last row (exclusive running max)."""
    d = hot_p.withColumns({"_kind": F.lit(0), "_row": _row_struct()})
    d = _range_scan(d, _GROUP, _ORDER, {"_prev": ("max", "_row", False)}, tasks)
    d = d.withColumns(_run_start(F.col("_prev"), "_pd_start"))
    d = d.withColumn("_pd_key", F.when(F.col("_pd_start").isNotNull(),
                                       F.struct(F.col("_t").alias("k1"), F.col("_tid").alias("k2"),
                                                F.col("_h").alias("k3"), F.col("_pd_start").alias("pd"))))
    d = _range_scan(d, _GROUP, _ORDER, {"_pd_run": ("max", "_pd_key", True)}, tasks)
    d = d.withColumn("_rowpd", _row_struct().withField("_pd", F.col("_pd_run")["pd"]))
    keep = [*_GROUP, "_t", "_tid", "_h", F.col("_t").alias("_t0")]
    data = d.select(*keep, F.lit(0).alias("_kind"), "_rowpd", F.col("_mult").alias("_w"))
    probe = (d.select(*keep).withColumn("_t", F.col("_t") + F.lit(window_sec * 1_000_000))
             .withColumns({"_kind": F.lit(1), "_w": F.lit(0).cast("long"),
                           "_rowpd": F.lit(None).cast(data.schema["_rowpd"].dataType)}))
    s = _range_scan(data.unionByName(probe), _GROUP, _ORDER,
                    {"_before": ("sum", "_w", False), "_last": ("max", "_rowpd", False)}, tasks)
    probed = F.col("_kind") == 1
    counts = s.drop("_t").withColumnRenamed("_t0", "_t").repartition(tasks, *_ROW_KEY).groupBy(*_ROW_KEY).agg(
        (F.max(F.when(probed, F.col("_before"))) - F.max(F.when(~probed, F.col("_before")))).alias("_n_all"),
        F.max(F.when(probed, F.col("_last"))).alias("_last"))
    j = hot_p.repartition(tasks, *_ROW_KEY).join(counts, _ROW_KEY)
    return j.withColumn("_partner", _partner(F.col("_last"))).drop("_last")


def geo_switch(rows: DataFrame, window_sec: int = GEO_WINDOW_SEC,
               file_col: str = "file_name", hot_rows: int | None = None,
               prepared: tuple[DataFrame, Groups] | None = None) -> DataFrame:
    """an anchor row pairs with every later row of its group within W
    whose Location differs (NULL differs from a value, equals NULL).

    Output is one alert per alert id (key + anchor time) - the rows the
    reference's store keeps after its upserts collapse same-id alerts: the
    last anchor of that instant with its last partner, and the number of
    pairs of all anchors of that instant as ``metric``. Pairs are counted,
    never built: pairs(i) = rows after i in window - rows after i in window
    at i's location."""
    p, (hot, tasks) = prepared or _prepare_with_hot(rows, file_col, hot_rows)
    p = p.withColumns({
        "_locnull": F.col("Location").isNull(),
        "_loc": F.coalesce(F.col("Location"), F.lit("")),
    })
    cold, hot_p = (p, None) if hot is None else split_hot(p, hot, _GROUP)
    j = _partner_window(cold.repartition(tasks, *_GROUP), window_sec)
    if hot_p is not None:
        g = _GROUP + _LOC_GROUP
        same = _probe_counts(hot_p.select(*g, "_t", "_tid", "_h", "_mult"), g, window_sec, "_n_same", tasks)
        h = hot_p.repartition(tasks, *_ROW_KEY).join(same, _ROW_KEY)
        j = j.unionByName(_partner_scan(h, window_sec, tasks))
    j = j.withColumn("_pairs", (F.col("_n_all") - F.col("_n_same")) * F.col("_mult"))
    hits = j.filter(F.col("_pairs") > 0)
    aid = F.concat(F.lit("ALERT_GEO_"), F.col("_key"), F.lit("_"), C.iso_utc("Timestamp"))
    loc_text = lambda c: F.coalesce(c, F.lit("None"))
    reason = F.concat(F.lit("Transaction from "), loc_text(F.col("Location")), F.lit(" \u2192 "),
                      loc_text(F.col("_partner.Location")),
                      F.lit(f" within {_minutes(window_sec)} minutes"))
    anchors = _alert("GEO_LOCATION_SWITCH", aid, reason, hits, F.col("_pairs"), file_col, extra={
        "_order": F.struct("_t", "_tid", "_h"),
        "partner_TransactionID": F.col("_partner.TransactionID"),
        "partner_location": F.col("_partner.Location"),
        "partner_ts": F.col("_partner.Timestamp")})
    # Anchors at one instant share an id: sum their pairs, keep the last anchor.
    rest = [c for c in anchors.columns if c not in ("alert_id", "metric", "_order")]
    last = F.max_by(F.struct(*rest), F.col("_order"))
    return (anchors.groupBy("alert_id")
            .agg(last.alias("_a"), F.sum("metric").alias("metric"))
            .select("alert_id", "_a.*", "metric"))


def balance_drain(rows: DataFrame, threshold: float = DRAIN_THRESHOLD,
                  window_sec: int = DRAIN_WINDOW_SEC, file_col: str = "file_name",
                  hot_rows: int | None = None,
                  prepared: tuple[DataFrame, Groups] | None = None) -> DataFrame:
    """running sum of Amount from the group's first row; the first row
    within W of that first row whose running sum reaches the threshold raises
    one alert per group (the window is anchored, not sliding: Q16)."""
    p, (hot, tasks) = prepared or _prepare_with_hot(rows, file_col, hot_rows)
    # Money is summed as decimal: the sum does not depend on the order of addition.
    whole = F.coalesce(F.col("Amount"), F.lit(0.0))
    p = p.withColumns({"_kind": F.lit(0), "_amt": F.least(whole, F.lit(MOST_AMOUNT)).cast("decimal(22,6)"),
                       "_over": F.greatest(whole - F.lit(MOST_AMOUNT), F.lit(0.0))})
    p = p.withColumns({"_wamt": (F.col("_amt") * F.col("_mult")).cast("decimal(28,6)"),
                       "_wover": F.col("_over") * F.col("_mult")})
    s = segmented_scan(p, _GROUP, _ORDER, {"_run": ("sum", "_wamt", True),
                                           "_over_before": ("sum", "_wover", False),
                                           "_start": ("min", "_t", True)}, tasks, hot=hot)
    hits = s.filter((F.col("_t") - F.col("_start") <= window_sec * 1_000_000)
                    & (F.col("_run").cast("double") + F.col("_over_before") + F.col("_wover") >= threshold))
    # Copies are consecutive: find the first copy whose running sum reaches
    # the threshold (amounts of validated rows are positive).
    amt, excl = F.col("_amt"), F.col("_run") - F.col("_wamt")
    least = F.lit(threshold).cast("decimal(22,6)")
    nth = F.when(excl + amt >= least, F.lit(1)).otherwise(F.ceil((least - excl) / amt)).cast("long")
    before, each = excl.cast("double") + F.col("_over_before"), amt.cast("double") + F.col("_over")
    nth_over = F.when(before + each >= threshold, F.lit(1)).otherwise(F.ceil((F.lit(threshold) - before) / each)).cast("long")
    hits = hits.withColumn("_run", F.when(F.col("_over_before") + F.col("_over") > 0, before + each * nth_over)
                           .otherwise((excl + amt * nth).cast("double")))
    first = hits.groupBy(*_GROUP).agg(
        F.min_by(F.struct(*[c for c in hits.columns if c not in _GROUP]),
                 F.struct(*[c for c in _ORDER if c != "_kind"])).alias("_r"))
    first = first.select(*_GROUP, "_r.*")
    aid = F.concat(F.lit("ALERT_BALANCE_DRAIN_"), F.col("_key"), F.lit("_"),
                   C.iso_utc("Timestamp"))
    reason = F.concat(F.lit("Total withdrawals "), _fmt_num(F.col("_run")),
                      F.lit(f" in {_minutes(window_sec)} minutes"))
    return _alert("BALANCE_DRAIN", aid, reason, first, F.col("_run"), file_col)


def collapse_by_id(alerts: DataFrame, order: list[str] = ("anchor_ts", "TransactionID")) -> DataFrame:
    """the alert store keeps the last alert written per id."""
    rest = [c for c in alerts.columns if c != "alert_id"]
    return (alerts.groupBy("alert_id")
            .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_a"))
            .select("alert_id", "_a.*"))


def fraud_detection(rows: DataFrame, high_value_threshold: float = HIGH_VALUE_THRESHOLD,
                    velocity_count: int = VELOCITY_TXN_COUNT,
                    velocity_window_sec: int = VELOCITY_WINDOW_SEC,
                    geo_window_sec: int = GEO_WINDOW_SEC,
                    drain_threshold: float = DRAIN_THRESHOLD,
                    drain_window_sec: int = DRAIN_WINDOW_SEC,
                    file_col: str = "file_name", hot_rows: int | None = None,
                    keep: Callable = lambda p: p) -> DataFrame:
    """All four rules, one alert schema (E5; only alerts about one transaction
    have a payload). The windowed rules share one
    folding of the rows and one hot-group sizing; a ``keep`` that persists
    makes the folding run once for all of them."""
    shared = _prepare_with_hot(rows, file_col, hot_rows, keep)
    return (high_value(rows, high_value_threshold, file_col)
            .unionByName(velocity(rows, velocity_count, velocity_window_sec, file_col, prepared=shared),
                         allowMissingColumns=True)
            .unionByName(geo_switch(rows, geo_window_sec, file_col, prepared=shared),
                         allowMissingColumns=True)
            .unionByName(balance_drain(rows, drain_threshold, drain_window_sec, file_col, prepared=shared),
                         allowMissingColumns=True))
