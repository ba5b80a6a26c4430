"""Ranked lexical search against a plain loop over all documents."""
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from ledgerloom.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def terms_of(text):
    return TERM.findall((text or "").translate(UPPER))


def brute(docs, items, k=10):
    """[(item, rank, doc_id, score)] with the k best rows of every item row."""
    bags = [(i, Counter(terms_of(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n, total = len(bags), sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for i, b in bags:
            m = 100 - 90 + (90 * b.total() * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * b[t]) // (1000 * b[t] + 8 * m))
                    for t in set(terms_of(text)) if b[t])
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scores)[:k])]
    return out


def rows(df):
    return sorted(((r[0], r.rank, r.doc_id, r.score) for r in df.collect()), key=str)


def test_terms():
    some = ["A-b_c1 É x.y\x7fz\x80 İI", "", " \t", "a" * 50, "漢字,🙂ok"]
    assert [[t.decode() for t in lexical.terms(s.encode())] for s in some] == [terms_of(s) for s in some]


@pytest.mark.parametrize("small", [False, True])
def test_search(spark, odd, odd_rows, small, monkeypatch):
    if small:                                                   # many shards, many intervals, several blocks
        for name, value in (("SHARD_DOCS", 9), ("LEAF_DOCS", 1), ("LEAF_POSTINGS", 1), ("BLOCK_CHARS", 300)):
            monkeypatch.setattr(lexical, name, value)
    items = [(1, "the of and"), (1, "thation ering onst"), (2, None), (3, ""), (None, "漢字 x1 the the THE"), (4, "absent"),
             (5, " ".join(["word", "à", "für", "don't", "more"])), (6, "the")]
    queries = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "7 as rank", "7 as score", "7 as row")
    got = rows(lexical.search(lexical.build_index(odd), queries))
    assert got == sorted(brute([(r[0], r[1]) for r in odd_rows], items), key=str) and len(got) > 40


def test_intervals_equal_all_scores():
    """Random shards with many equal impacts: best-first search against scoring every document."""
    rng = np.random.default_rng(3)
    fewer = 0
    for case in range(60):
        n, t = int(rng.integers(1, 700)), int(rng.integers(1, 12))
        lists = [np.flatnonzero(rng.random(n) < rng.random()) for _ in range(t)]
        lists = [x if len(x) else np.array([0]) for x in lists]
        tfs = [rng.zipf(1.7, len(x)).clip(1, 60) if case % 2 else np.ones(len(x), int) for x in lists]
        length = rng.integers(10, 400, n) if case % 3 else np.full(n, 90)
        ids = sorted(rng.choice(10**6, n, replace=False).tolist())
        weights = rng.integers(1, 9000, t)
        p = lexical.Postings(ids, lists, tfs, length)
        score = np.zeros(n, np.int64)
        for x, f, w in zip(lists, tfs, weights, strict=True):
            score[x] += w * ((10**9 * f.astype(np.int64)) // (1000 * f + 8 * length[x]))
        want = [(int(score[i]), ids[i]) for i in sorted(range(n), key=lambda i: (-score[i], ids[i]))[:10] if score[i] > 0]
        best = lexical.Best(10)
        scored = p.search(np.arange(t), weights, best)
        assert best.entries() == want
        fewer += scored < n
    assert fewer > 5


def test_range_maxima():
    rng = np.random.default_rng(5)
    p = lexical.Postings(list(range(40)), [np.arange(40), np.arange(0, 40, 3)], [rng.integers(1, 9, 40), rng.integers(1, 9, 14)],
                         np.full(40, 50))
    for s in (0, 1):
        lo, hi = int(p.starts[s]), int(p.ends[s])
        for a in range(lo, hi):
            for b in range(a + 1, hi + 1):
                got = int(p.greatest(np.array([a]), np.array([b]))[0])
                assert a <= got < b and p.impact[got] == p.impact[a:b].max()


def test_random_corpora(spark):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(40)] + ["the"] * 30
    docs = [(rng.randint(0, 300), " ".join(rng.choice(words) for _ in range(rng.randint(0, 40)))) for _ in range(400)]
    docs += [(1000 + i, docs[5][1]) for i in range(150)]        # a group of copies: ties beyond k
    items = [(i, " ".join(rng.sample(words, 6))) for i in range(12)] + [(99, docs[5][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = rows(lexical.search(lexical.build_index(df), spark.createDataFrame(items, "item_id long, text string")))
    assert got == sorted(brute(docs, items), key=str)


def test_nothing(spark, odd, none):
    items = spark.createDataFrame([(1, "the")], "item_id long, text string")
    assert lexical.search(lexical.build_index(none), items).collect() == []
    assert lexical.search(lexical.build_index(odd), items.limit(0)).collect() == []
