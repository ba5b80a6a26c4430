"""Rows that repeat an id, as copies or with other vectors, crowd no neighbour out."""
import numpy as np
import pytest

from ledgerloom.llm import ann


def table(spark, rows):
    return spark.createDataFrame([(int(i), [float(c) for c in x]) for i, x in rows], "vec_id long, embedding array<double>") \
        .repartition(3)


def brute(rows, query, k=5):
    own = next(x for i, x in rows if i == query)
    best = {}
    for i, x in rows:
        if i != query:
            best[i] = max(best.get(i, -2.0), float(np.dot(own, x) / np.linalg.norm(own) / np.linalg.norm(x)))
    return [(n + 1, i, pytest.approx(s)) for n, (i, s) in enumerate(sorted(best.items(), key=lambda p: (-p[1], p[0]))[:k])]


@pytest.mark.parametrize("spread", [0.0, 1e-3])
def test_an_id_ten_times_beside_ten_neighbours(spark, spread):
    rng = np.random.default_rng(1)
    base = rng.normal(size=16)
    rows = [(0, base)] + [(100, base + 0.01 + spread * rng.normal(size=16)) for _ in range(10)]
    rows += [(k, base + 0.1 * k * rng.normal(size=16)) for k in range(1, 11)]
    v = table(spark, rows)
    for found in (ann.search, ann.exact):
        got = found(v.filter("vec_id = 0"), v).orderBy("rank").collect()
        assert [(r.rank, r.vec_id, r.score) for r in got] == brute(rows, 0)


@pytest.mark.parametrize("prune", [1, 2_048])
def test_repeats_in_many_blocks(spark, monkeypatch, prune):
    """All leaves are visited, so the forest must find what brute force finds."""
    monkeypatch.setattr(ann, "BLOCK", 16)
    monkeypatch.setattr(ann, "PRUNE", prune)
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8)) for i in range(300)]
    for i in (1, 2, 3, 150):
        rows += [(i, rows[0][1] + 0.2 * rng.normal(size=8)) for _ in range(40)] + [rows[i]] * 40
    v = table(spark, rows)
    got = ann.search(v.filter("vec_id in (0, 7)").dropDuplicates(["vec_id"]), v, leaf=32, visits=1e6) \
        .orderBy("query_id", "rank").collect()
    for query in (0, 7):
        assert [(r.rank, r.vec_id, r.score) for r in got if r.query_id == query] == brute(rows, query)
