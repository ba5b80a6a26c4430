"""Conversation structure repair (13): depth-first branch and bound.

A conversation is repaired by the cheapest edits after which the initials of
its roles read ``(s?(ua)+)?``: Keep (0), Rerole to user or assistant (3),
Delete (4; the only choice for blank rows and repeats), Insert an empty user or
assistant row (3); a row whose text is cut off costs 3 more unless deleted. Of
equally cheap repairs the one whose edits' initials are least in ASCII counts.

Search (``solve``): nodes are (row, state of the pattern). Suffix lower bounds,
the least cost of any completion from a node, come from one backward pass. A
stack holds prefixes (node, cost, audit), the most promising child on top. A
prefix goes if its cost plus bound exceeds the incumbent's cost, if it equals
it with a greater audit, or if the node's dominance table has a prefix that is
as good; an empty stack proves the incumbent. Prefixes of one cost at one node
never extend each other (an insert costs), so comparing them is comparing the
whole audits.

A state's next role is fixed, except that a first row may also be ``s``, so an
audit tells the whole repair.

Spark: rows are dealt by conversation, sorted, and streamed through the search
one conversation at a time. Conversations of more than ``SEGMENT_ROWS`` rows
are cut into segments of so many rows that are worked on side by side:
(1) each segment's least costs from every state to every state, (2) the least
cost from each border to the end, chained over segments, (3) each segment's
best repair from every state, given the cost beyond its end, (4) the states at
the borders and the audits, chained forward, (5) the edits applied. Inserts at
a border belong to the later segment, so audits of one segment never extend
each other and the chain of best choices is the best chain. Only the digest
reads a long conversation in order, as a stream; only its audit is kept whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.scan import global_row_number
from .common import WHITE, written

SEGMENT_ROWS = 2000
KEEP, REROLE, DELETE, INSERT, CUT = 0, 3, 4, 3, 3
FINE, BLANK, REPEAT, TRUNCATED = range(4)
#: States of the pattern: nothing yet, after s, after u, after a.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
FAR = 1 << 60
#: Cost beyond the end of a conversation: it may end before its first row or after an assistant.
END = [0, FAR, FAR, 0]
LEGAL = {"su", "ua", "au"}


# ---- search ----------------------------------------------------------------

def row_edits(initial: str, fault: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, state after, cost) of the edits of one row."""
    out = [("D", state, DELETE)]
    if fault in (FINE, TRUNCATED):
        more = CUT if fault == TRUNCATED else 0
        if (state, initial) in KEPT:
            out.append(("K", KEPT[state, initial], KEEP + more))
        out.append(("R", NEXT[state], REROLE + more))
    return out


def bounds(rows: list[tuple[str, int]], beyond: list[int], last: bool) -> list[list[int]]:
    """[row][state]: least cost from there to the end. ``beyond`` has the cost
    after the end by state; rows may be inserted at the end if it is the
    conversation's (``last``)."""
    def with_inserts(h: list[int]) -> list[int]:
        for _ in range(3):
            h = [min(h[q], INSERT + h[NEXT[q]]) for q in STATES]
        return h

    h = with_inserts(list(beyond)) if last else list(beyond)
    out = [h]
    for initial, fault in reversed(rows):
        h = with_inserts([min(c + h[to] for _, to, c in row_edits(initial, fault, q)) for q in STATES])
        out.append(h)
    return out[::-1]


def solve(rows: list[tuple[str, int]], entry: int = START, beyond: list[int] = END,
          last: bool = True) -> tuple[int, str, int]:
    """(cost with what is beyond, audit, state at the end) of the best repair
    of rows (role initial, fault) from state ``entry``."""
    h, n = bounds(rows, beyond, last), len(rows)
    best: tuple[int, str, int] = (FAR, "", entry)
    seen: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, entry, 0, "")]
    while stack:
        i, q, cost, audit = stack.pop()
        if (total := cost + h[i][q]) > best[0] or total >= FAR:
            continue
        if total == best[0] and audit > best[1][:len(audit)]:
            continue
        if (i, q) in seen and seen[i, q] <= (cost, audit):
            continue
        seen[i, q] = (cost, audit)
        if i == n and (cost + beyond[q], audit) < best[:2]:
            best = (cost + beyond[q], audit, q)
        edits = [("I", i, NEXT[q], INSERT)] if i < n or last else []
        if i < n:
            edits += [(letter, i + 1, to, c) for letter, to, c in row_edits(*rows[i], q)]
        edits.sort(key=lambda e: (cost + e[3] + h[e[1]][e[2]], e[0]), reverse=True)
        stack += [(j, to, cost + c, audit + letter) for letter, j, to, c in edits]
    return best


def apply(audit: str, entry: int, rows: list[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """(role, text, edit) of the repaired rows (role, text)."""
    state, left = entry, iter(rows)
    for letter in audit:
        if letter == "I":
            state = NEXT[state]
            yield ROLE[state], "", letter
            continue
        role, text = next(left)
        if letter == "K":
            state = KEPT[state, role[:1]]
            yield role, text, letter
        elif letter == "R":
            state = NEXT[state]
            yield ROLE[state], text, letter


# ---- rows ------------------------------------------------------------------

def tail_fault(text: Column) -> Column:
    """BLANK, TRUNCATED (the last character that is not white space ends no
    sentence) or FINE."""
    body = F.rtrim(text, F.lit(WHITE))
    return F.when(F.length(body) == 0, BLANK).when(~F.substring(body, -1, 1).isin(".", "!", "?"), TRUNCATED).otherwise(FINE)


def damage(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """(conv, turn, role, text, gone): rows damaged by crc32(`conv:turn`) % 20.
    0 drops the row (``gone``), 1 empties the text, 2 removes its [.!?], 3
    repeats the row, 4 sets the role to user. NULLs are one space."""
    conv, turn = F.col(id_col), F.col(turn_col)
    space = F.lit(" ")
    kind = F.crc32(F.concat(F.coalesce(conv.cast("string"), space), F.lit(":"),
                            F.coalesce(turn.cast("string"), space)).cast("binary")) % 20
    d = rows.select(conv.alias("conv"), turn.alias("turn"), F.coalesce(F.col(role_col), space).alias("role"),
                    F.coalesce(F.col(text_col), space).alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind").isin(0, 1), "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    d = d.select("conv", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                 text.alias("text"), (F.col("kind") == 0).alias("gone"), "kind")
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return d.withColumn("copy", F.explode(copies)).drop("kind", "copy")


ORDER = ("turn", "role", "text")        # turns, NULL first; rows of one turn by role and text


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """(key, rows) of consecutive rows with equal first ``keys`` columns."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if rows and row[:keys] != key:
                yield key, rows
                rows = []
            key = row[:keys]
            rows.append(row[keys:])
    if rows:
        yield key, rows


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 512) -> Iterator[pa.RecordBatch]:
    def batch(some):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some, strict=True), schema, strict=True)],
                                          schema=schema)
    some = []
    for row in rows:
        some.append(row)
        if len(some) == size:
            yield batch(some)
            some = []
    if some:
        yield batch(some)


def _streamed(df: DataFrame, deal: list[str], sort: list[Column], keys: int, each: Callable, schema: str) -> DataFrame:
    """``each(key, rows)`` gives output rows for the rows of a key, which are
    dealt by the columns ``deal`` and come in the order ``sort``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches((row for key, rows in _groups(batches, keys) for row in each(key, rows)), arrow)
    return df.repartition(*deal).sortWithinPartitions(*sort).mapInArrow(run, schema)


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal")
REPORT = ", ".join(f"{c} long" for c in (*COUNTS, "cost")) + ", audit string, repaired_sha256 string"
TURNS = "place long, role string, text string, edit string"


def _faults(rows: list[tuple[str, str, int]]) -> list[int]:
    """First fault of each row (role, text, fault of its tail)."""
    seen, out = set(), []
    for role, text, tail in rows:
        out.append(BLANK if tail == BLANK else REPEAT if (role, text) in seen else tail)
        seen.add((role, text))
    return out


def _gaps(turns: list[int]) -> int:
    return max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0


def _whole(each_turn: bool):
    """Works on a whole conversation: rows (turn, role, text, tail, gone)."""
    def each(key: tuple, rows: list[tuple]) -> Iterator[tuple]:
        rows = [r[:4] for r in rows if not r[4]]
        faults = _faults([r[1:4] for r in rows])
        cost, audit, _ = solve([(r[1][:1], f) for r, f in zip(rows, faults, strict=True)])
        turns = list(apply(audit, START, [r[1:3] for r in rows]))
        if each_turn:
            yield from ((*key, place, *t) for place, t in enumerate(turns))
            return
        illegal = sum(a[1][:1] + b[1][:1] not in LEGAL for a, b in zip(rows, rows[1:], strict=False))
        digest = hashlib.sha256("\n".join(f"{role}:{text}" for role, text, _ in turns).encode())
        yield (*key, _gaps([r[0] for r in rows if r[0] is not None]), *(faults.count(f) for f in (BLANK, REPEAT, TRUNCATED)),
               illegal, cost, audit, digest.hexdigest())
    return each


# ---- long conversations ----------------------------------------------------

def _same(left: str, right: str, *keys: str) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return out


SEGMENT = ("costs array<array<bigint>>, least long, most long, kinds long, first long, final long, blank long, "
           "duplicate long, truncated long, illegal long, head string, tail string")


def _segment(key: tuple, rows: list[tuple]) -> Iterator[tuple]:
    """Step 1: rows (pos, initial, fault, turn, last) of one segment."""
    own, last = [(r[1], r[2]) for r in rows], rows[0][4]
    by_exit = [bounds(own, [0 if q == x else FAR for q in STATES], last)[0] for x in STATES]
    turns = [r[3] for r in rows if r[3] is not None]
    faults = [r[2] for r in rows]
    yield (*key, [[min(by_exit[x][q], FAR) for x in STATES] for q in STATES], min(turns, default=None), max(turns, default=None),
           len(set(turns)), turns[0] if turns else None, turns[-1] if turns else None,
           *(faults.count(f) for f in (BLANK, REPEAT, TRUNCATED)),
           sum(a[1] + b[1] not in LEGAL for a, b in zip(rows, rows[1:], strict=False)), rows[0][1], rows[-1][1])


def _backward(key: tuple, rows: list[tuple]) -> Iterator[tuple]:
    """Step 2: (segment, costs) in order -> cost beyond each segment's end, by state."""
    beyond, out = END, []
    for segment, costs in reversed(rows):
        out.append((*key, segment, beyond))
        beyond = [min(FAR, min(c + b for c, b in zip(costs[q], beyond, strict=True))) for q in STATES]
    yield from reversed(out)


def _choices(key: tuple, rows: list[tuple]) -> Iterator[tuple]:
    """Step 3: the best repair of a segment from each state it can be entered in."""
    found = [solve([(r[1], r[2]) for r in rows], q, rows[0][5], rows[0][4]) for q in STATES]
    yield (*key, [f[0] for f in found], [f[1] for f in found], [f[2] for f in found])


def _forward(key: tuple, rows: list[tuple]) -> Iterator[tuple]:
    """Step 4: (segment, costs, audits, exits) in order -> state and audit of each segment."""
    state = START
    for segment, costs, audits, exits in rows:
        yield (*key, segment, state, audits[state], costs[state])
        state = exits[state]


def _applied(key: tuple, rows: list[tuple]) -> Iterator[tuple]:
    """Step 5: rows (pos, role, text, entry, audit) of a segment."""
    turns = apply(rows[0][4], rows[0][3], [r[1:3] for r in rows])
    yield from ((*key, place, *t) for place, t in enumerate(turns))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conversation, sha256) of streamed repaired rows (conv, role, text)."""
    conv, digest = None, None
    for batch in batches:
        for key, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            line = f"{role}:{text}".encode()
            if digest is None or key != conv:
                if digest is not None:
                    yield conv, digest.hexdigest()
                conv, digest = key, hashlib.sha256(line)
            else:
                digest.update(b"\n" + line)
    if digest is not None:
        yield conv, digest.hexdigest()


def _in_segments(rows: DataFrame, sizes: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """(repaired rows with segment, report) of long conversations, from rows
    (conv, turn, role, text, tail) and sizes (conv, n)."""
    numbered = global_row_number(rows.drop("gone"), list(ORDER), "pos", group=["conv"])
    numbered = numbered.withColumns({"pos": F.col("pos") - 1,
                                     "digest": F.md5(F.concat(F.hex("role"), F.lit(":"), F.md5("text")))})
    # Numbering is costly and must not be done twice with different outcomes.
    numbered = written(numbered, "conversation-rows")
    first = numbered.groupBy("conv", "digest").agg(F.min("pos").alias("first"))
    r = numbered.alias("r").join(first.alias("f"), _same("r", "f", "conv", "digest")).join(sizes.alias("z"), _same("r", "z", "conv"))
    fault = F.when(F.col("tail") == BLANK, BLANK).when(F.col("pos") > F.col("first"), REPEAT).otherwise(F.col("tail"))
    r = r.select("r.conv", F.floor(F.col("pos") / SEGMENT_ROWS).alias("segment"), "pos", F.substring("role", 1, 1).alias("initial"),
                 fault.alias("fault"), "turn",
                 (F.floor(F.col("pos") / SEGMENT_ROWS) == F.floor((F.col("n") - 1) / SEGMENT_ROWS)).alias("last"))
    lean = written(r, "conversation-faults")
    segment, in_order = ["conv", "segment"], [F.col("conv"), F.col("segment")]
    by_pos = [*in_order, F.col("pos")]
    one = written(_streamed(lean, segment, by_pos, 2, _segment, f"conv {kind}, segment long, {SEGMENT}"), "conversation-segments")
    beyond = _streamed(one.select("conv", "segment", "costs"), ["conv"], in_order, 1, _backward,
                       f"conv {kind}, segment long, beyond array<bigint>")
    lean = lean.alias("r").join(beyond.alias("b"), _same("r", "b", *segment)).select("r.*", "beyond")
    choices = _streamed(lean, segment, by_pos, 2, _choices,
                        f"conv {kind}, segment long, costs array<bigint>, audits array<string>, exits array<int>")
    chosen = written(_streamed(choices, ["conv"], in_order, 1, _forward,
                               f"conv {kind}, segment long, entry int, audit string, cost long"), "conversation-choices")
    edits = numbered.withColumn("segment", F.floor(F.col("pos") / SEGMENT_ROWS)).alias("r").join(
        chosen.alias("c"), _same("r", "c", *segment)).select("r.conv", "r.segment", "pos", "role", "text", "entry", "audit")
    turns = written(_streamed(edits, segment, by_pos, 2, _applied, f"conv {kind}, segment long, {TURNS}"), "conversation-turns")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = list(_digests(batches))                  # one per conversation of more than a segment
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa_kind), pa.array([r[1] for r in rows])],
                                             ["conv", "repaired_sha256"])

    from pyspark.sql.pandas.types import to_arrow_type
    pa_kind = to_arrow_type(turns.schema["conv"].dataType)
    hashed = turns.repartition("conv").sortWithinPartitions("conv", "segment", "place").select("conv", "role", "text").mapInArrow(
        digest, f"conv {kind}, repaired_sha256 string")
    audits = chosen.groupBy("conv").agg(
        F.array_sort(F.collect_list(F.struct("segment", "audit", "cost"))).alias("parts")).select(
        "conv", F.col("parts")[0]["cost"].alias("cost"), F.array_join(F.transform("parts", lambda p: p["audit"]), "").alias("audit"))
    # Borders: the rows before and after one are a pair too, and a turn may stand on both sides.
    before = one.select("conv", (F.col("segment") + 1).alias("segment"), F.col("tail").alias("before"), F.col("final").alias("before_turn"))
    pairs = one.alias("o").join(before.alias("p"), _same("o", "p", *segment), "left")
    border = F.col("before").isNotNull() & ~F.concat("before", "head").isin(*LEGAL)
    sums = pairs.groupBy("o.conv").agg(
        (F.max("most") - F.min("least") + 1 - (F.sum("kinds") - F.count_if(F.col("first") == F.col("before_turn")))).alias("gaps"),
        *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")),
        (F.sum("illegal") + F.count_if(border)).alias("illegal"))
    report = sums.alias("s").join(audits.alias("a"), _same("s", "a", "conv")).join(
        hashed.alias("h"), _same("s", "h", "conv"), "left").select(
        "s.conv", F.coalesce("gaps", F.lit(0)).alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
    return turns, report


def _prepared(rows: DataFrame) -> tuple[DataFrame, DataFrame | None, DataFrame | None, str]:
    """(ordinary rows, rows of long conversations, their sizes, type of conv)."""
    rows = rows.select("conv", "turn", "role", "text", tail_fault(F.col("text")).alias("tail"), "gone")
    sizes = rows.groupBy("conv").agg(F.count_if(~F.col("gone")).alias("n")).filter(F.col("n") > SEGMENT_ROWS)
    kind = rows.schema["conv"].dataType.simpleString()
    if sizes.isEmpty():
        return rows, None, None, kind
    sizes = written(sizes, "conversation-sizes")
    on = _same("r", "z", "conv")
    return (rows.alias("r").join(sizes.alias("z"), on, "left_anti"),
            rows.alias("r").join(sizes.alias("z"), on, "left_semi").filter(~F.col("gone")), sizes, kind)


def _ordered() -> list[Column]:
    return [F.col("conv"), *(F.col(c).asc_nulls_first() for c in ORDER)]


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (conv, turn, role, text, gone; see
    ``damage``): conv, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256 (of the repaired rows, each ``role:text``, joined by line
    feeds).

    Rows that are gone count for nothing but their conversation's presence; a
    conversation without other rows has zeros, an empty audit and the digest of
    the empty text. Role and text must not be NULL (``damage`` makes them one
    space, which no pattern allows to be kept: such rows are reroled or
    deleted; so are rows of an empty role). A NULL conv is a conversation. NULL
    turns come first and make no gap; rows of one turn are taken by role, then
    text, so repeated rows stand together. Long texts and conversations are
    worked on whole. Empty table: no rows. Other columns are not read.
    """
    short, long, sizes, kind = _prepared(rows)
    out = _streamed(short, ["conv"], _ordered(), 1, _whole(False), f"conv {kind}, {REPORT}")
    if long is None:
        return out
    return out.unionByName(_in_segments(long, sizes, kind)[1])


def repaired(rows: DataFrame) -> DataFrame:
    """The repaired conversations: conv, segment, place (within the segment),
    role, text and edit (K, R or I) of every row they have. NULLs, ties and
    long conversations as in ``repair``."""
    short, long, sizes, kind = _prepared(rows)
    out = _streamed(short, ["conv"], _ordered(), 1, _whole(True), f"conv {kind}, {TURNS}").withColumn(
        "segment", F.lit(0).cast("long"))
    if long is not None:
        out = out.unionByName(_in_segments(long, sizes, kind)[0])
    return out.select("conv", "segment", "place", "role", "text", "edit")
