"""Conversation repair against plain Python and against trying every repair."""
import hashlib
import itertools
import random
import re
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import conversations as C

WHITE = " \t\n\x0b\x0c\r"
PATTERN = re.compile(r"(s?(ua)+)?")


def damaged(rows):
    """{conv: [(turn, role, text)]} after damage, by the contract's words."""
    out = {}
    for conv, turn, role, text in rows:
        own = out.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        own += [(turn, role, text)] * (2 if kind == 3 else 1)
    for own in out.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    return out


def faults_of(rows):
    out, seen = [], set()
    for _, role, text in rows:
        body = text.rstrip(WHITE)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def best_by_suffixes(rows, faults):
    """(cost, audit) by comparing whole suffixes; the state is the string of initials so far, folded."""
    def step(state, c):
        return {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}[state].get(c)

    @lru_cache(None)
    def best(i, state, inserted):
        found = [(0, "")] if i == len(rows) and state in ("", "a") else []
        options = [("I", r, 3, i, inserted + 1) for r in "ua" if inserted < 3]
        if i < len(rows):
            f, role = faults[i], rows[i][1]
            options.append(("D", None, 4, i + 1, 0))
            if f not in ("blank", "duplicate"):
                more = 3 if f == "truncated" else 0
                options += [("K", role[:1] or "-", more, i + 1, 0), ("R", "u", 3 + more, i + 1, 0), ("R", "a", 3 + more, i + 1, 0)]
        for letter, c, cost, j, k in options:
            to = state if c is None else step(state, c)
            if to is not None and (rest := best(j, to, k)):
                found.append((cost + rest[0], letter + rest[1]))
        return min(found, default=None)
    return best(0, "", 0)


def best_by_trying(rows, faults):
    """Every choice per row and up to two inserts at every place."""
    best = None
    inserts = [[], ["u"], ["a"], ["u", "a"], ["a", "u"]]
    per_row = []
    for (_, role, _), f in zip(rows, faults):
        own = [("D", "", 4)]
        if f not in ("blank", "duplicate"):
            m = 3 if f == "truncated" else 0
            own += [("K", role[:1] or "-", m), ("R", "u", 3 + m), ("R", "a", 3 + m)]
        per_row.append(own)
    for choice in itertools.product(*per_row):
        for gaps in itertools.product(inserts, repeat=len(rows) + 1):
            letters = roles = ""
            cost = 0
            for k, g in enumerate(gaps):
                letters, roles, cost = letters + "I" * len(g), roles + "".join(g), cost + 3 * len(g)
                if k < len(rows):
                    letters, roles, cost = letters + choice[k][0], roles + choice[k][1], cost + choice[k][2]
            if PATTERN.fullmatch(roles) and (best is None or (cost, letters) < best):
                best = (cost, letters)
    return best


def report(rows):
    """The contract's row of one conversation, and its repaired rows."""
    faults = faults_of(rows)
    cost, audit = best_by_suffixes(tuple(rows), tuple(faults))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    out, left, state = [], list(rows), ""
    for letter in audit:
        if letter != "I":
            _, role, text = left.pop(0)
        if letter in "RI":
            role = "assistant" if state == "u" else "user"
        if letter != "D":
            out.append((role, "" if letter == "I" else text))
            state = role[:1]
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest), out


TEXTS = ["Fine.", "Cut off", "", " \n\t", "What?", "No end ", "Yes! \n", "ended.\x0b", "x" * 3000 + "."]


def conversations(seed, n, longest):
    rng = random.Random(seed)
    out = []
    for conv in range(n):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant"]) if rng.random() < 0.3 else ["user", "assistant"][turn % 2]
            role = rng.choice(["system", None, "", "tool", "User", "unknown"]) if rng.random() < 0.12 else role
            text = None if rng.random() < 0.05 else rng.choice(TEXTS) + (str(rng.random()) + "." if rng.random() < 0.6 else "")
            t = None if rng.random() < 0.05 else turn + rng.choice([0, 0, 0, 1, 5])
            out.append((conv if conv else None, t, role, text))
    return out


def test_search_finds_the_best_of_all_repairs():
    rng = random.Random(1)
    for _ in range(60):
        rows = [(0, rng.choice(["user", "assistant", "system", "tool"]), str(k)) for k in range(rng.randint(0, 3))]
        faults = [rng.choice(["", "", "blank", "truncated"]) for _ in rows]
        number = {"": C.FINE, "blank": C.BLANK, "truncated": C.TRUNCATED}
        got = C.solve([(r[1][:1], number[f]) for r, f in zip(rows, faults)])
        assert got[:2] == best_by_trying(rows, faults) == best_by_suffixes(tuple(rows), tuple(faults))


def test_search_equals_suffix_comparison():
    rng = random.Random(2)
    number = {"": C.FINE, "blank": C.BLANK, "duplicate": C.REPEAT, "truncated": C.TRUNCATED}
    for _ in range(400):
        rows = [(0, rng.choice(["user", "assistant", "system", "", " "]), str(k)) for k in range(rng.randint(0, 30))]
        faults = [rng.choice(["", "", "", "blank", "duplicate", "truncated"]) for _ in rows]
        got = C.solve([(r[1][:1], number[f]) for r, f in zip(rows, faults)])
        assert got[:2] == best_by_suffixes(tuple(rows), tuple(faults))


def test_long_search_is_linear():
    rows = [(("user", "assistant", "system")[k % 3][:1], (C.FINE, C.TRUNCATED, C.REPEAT)[k % 7 % 3]) for k in range(C.SEGMENT_ROWS)]
    cost, audit, state = C.solve(rows)
    assert sum(x != "I" for x in audit) == len(rows) and state in (C.START, C.ASSISTANT) and cost < 4 * len(rows)


@pytest.mark.parametrize("segment", [2000, 4, 1])
def test_repair(spark, segment, monkeypatch):
    monkeypatch.setattr(C, "SEGMENT_ROWS", segment)
    rows = conversations(3, 90, 25) + [(500, 0, "user", "Hi.")] * 3 + [(501, None, None, None)] * 2
    rows += [(600 + 9 * i, 0, "user", "Hi.") for i in range(90)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns(
        {c: F.lit(7) for c in ("conv", "gone", "kind", "copy", "pos", "segment", "tail")}).repartition(5)
    bad = C.damage(df)
    got = {r.conv: tuple(r)[1:] for r in C.repair(bad).collect()}
    want = damaged(rows)
    assert got == {conv: report(own)[0] for conv, own in want.items()}
    assert any(not own for own in want.values())                # one that lost every row
    turns = {}
    for r in sorted(C.repaired(bad).collect(), key=lambda r: (r.segment, r.place)):
        turns.setdefault(r.conv, []).append((r.role, r.text))
    assert turns == {conv: out for conv, own in want.items() if (out := report(own)[1])}


def test_nothing(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert C.repair(C.damage(none)).collect() == []
    assert C.repaired(C.damage(none)).collect() == []
