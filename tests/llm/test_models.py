"""Near-duplicates, language models, language ID, nearest neighbours and the
pipeline against brute force, exact sums and held-out accuracy."""
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.llm import ann, kneser_ney, langid, minhash
from ledgerloom.llm.components import components

SF = "/root/testdata/sf0.001"


def shingles(text, k):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) or frozenset([tuple(w)])


def brute_groups(rows, k, percent):
    sets = [(i, shingles(t, k)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = find(sets[a][0]), find(sets[b][0])
                root[max(p, q)] = min(p, q)
    return {i: find(i) for i in root}


def near_copies(n, seed=2):
    """Chains of edited copies, so that some members are far from the least id."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows, base = [], [rng.choice(words) for _ in range(80)]
    for i in range(n):
        if i % 40 == 0:
            base = [rng.choice(words) for _ in range(rng.choice([12, 40, 80]))]
        base = list(base)
        for _ in range(rng.choice([0, 1, 1, 2])):
            base[rng.randrange(len(base))] = rng.choice(words)
        rows.append((n - i if i % 3 else i + 10_000, " ".join(base)))
    return rows


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates(spark, odd, odd_rows, k):
    rows = [(r[0], r[1]) for r in odd_rows] + near_copies(240)
    d = odd.select("doc_id", "text", "key").unionByName(
        spark.createDataFrame(near_copies(240), "doc_id long, text string"), allowMissingColumns=True)
    got = minhash.near_duplicates(d, k=k).collect()
    want = brute_groups(rows, k, 80)
    assert len(got) == len(rows)
    sizes = Counter((i, len(shingles(t, k))) for i, t in rows)
    assert Counter((r.doc_id, r.n_shingles) for r in got) == sizes
    for r in got:
        assert r.component_id == want.get(r.doc_id) and r.kept == (r.doc_id is None or r.doc_id == r.component_id)


def test_blocks_link_what_stars_miss(spark, monkeypatch):
    """A bucket's least id that is near nobody must not hide links of the others."""
    monkeypatch.setattr(minhash, "BLOCK", 4)
    rows = near_copies(120, seed=9)
    got = {r.doc_id: r.component_id for r in
           minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=2).collect()}
    assert got == brute_groups(rows, 2, 80)


def test_estimate_follows_similarity(spark):
    rng, out = np.random.default_rng(1), []
    for share in (0.5, 0.8, 0.95):
        for _ in range(20):
            both = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
            n = int(400 * (1 - share) / 2 / share)
            sets = [np.concatenate((both, rng.integers(0, 1 << 63, n, dtype=np.uint64))) for _ in range(2)]
            a, b = (minhash.signature(minhash.minima(s)).tolist() for s in sets)
            out.append((share, 400 / (400 + 2 * n), a, b))
    d = spark.createDataFrame(out, "share double, j double, a array<long>, b array<long>")
    for r in d.select("j", minhash.estimate(minhash._different(F.col("a"), F.col("b"))).alias("e")).collect():
        assert abs(r.e - r.j) < minhash.MARGIN


def test_one_per_group(odd, odd_rows, none):
    out = minhash.one_per_group(odd, k=5)
    want = brute_groups([(r[0], r[1]) for r in odd_rows], 5, 80)
    assert out.columns == odd.columns
    assert sorted(r.doc_id for r in out.collect() if r.doc_id is not None) == sorted({v for v in want.values()})
    assert out.filter("doc_id is null").count() == sum(r[0] is None for r in odd_rows)
    assert minhash.near_duplicates(none).count() == 0 and minhash.one_per_group(none).count() == 0


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(1, 50)]
    edges += [(rng.randrange(2000, 2200), rng.randrange(2000, 2200)) for _ in range(150)] + [(7, 7), (None, 3)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None:
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root if find(x) != x}


def tokens_of(text):
    return [*(text or "").encode().lower().split(), b"</s>"]


def brute_kneser_ney(train):
    c = Counter(w for x in train for w in x)
    pairs = Counter(p for x in train for p in zip([b"<s>", *x[:-1]], x, strict=True))
    follow, kinds, before = Counter(), defaultdict(lambda: [0, 0, 0]), Counter()
    for (h, w), n in pairs.items():
        follow[h] += n
        kinds[h][min(n, 3) - 1] += 1
        before[w] += 1

    def freq(values):
        return np.bincount(np.minimum(list(values) or [0], 5), minlength=6)
    d, low = langid.discounts(freq(pairs.values())), langid.discounts(freq(before.values()))
    left = sum(low[min(n, 3)] for n in before.values()) / max(len(pairs), 1) if pairs else 1.0

    def p(h, w):
        p1 = max(before[w] - low[min(before[w], 3)], 0) / max(len(pairs), 1) + left / (len(c) + 1)
        if not follow[h]:
            return p1
        n = pairs[h, w]
        return max(n - d[min(n, 3)], 0) / follow[h] + sum(a * b for a, b in zip(d[1:], kinds[h], strict=True)) / follow[h] * p1
    return c, p


@pytest.mark.parametrize("shards", [1, 5])
def test_kneser_ney(odd, odd_rows, shards):
    model = kneser_ney.train(odd.filter("doc_id is null or doc_id % 3 <> 0"), shards=shards)
    train = [tokens_of(r[1]) for r in odd_rows if r[0] is None or r[0] % 3]
    c, p = brute_kneser_ney(train)
    n, v = sum(c.values()), len(c)
    got = Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6))
                  for r in kneser_ney.score(odd, model).collect())
    want = Counter()
    for i, t, *_ in odd_rows:
        x = tokens_of(t)
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in x)
        own = sum(math.log10(p(h, w)) for h, w in zip([b"<s>", *x[:-1]], x, strict=True))
        want[i, len(x), sum(c[w] > 0 for w in x), n, round(base, 6), round(own, 6)] += 1
    assert got == want
    for h in (b"the", b"<s>", b"unseen"):
        assert sum(p(h, w) for w in c) + p(h, b"never seen") == pytest.approx(1)


def test_kneser_ney_without_rows(spark, odd, none):
    model = kneser_ney.train(none)
    rows = kneser_ney.score(odd, model).collect()
    assert {(r.train_tokens, r.n_known, r.score, r.base_score) for r in rows} == {(0, 0, 0.0, 0.0)}
    assert kneser_ney.score(none, model).count() == 0


def test_language_probabilities_sum_to_one():
    text = langid.normalise("The thation of the ering and the onst, edth the thation.")
    key, n = np.unique(langid.grams(text), return_counts=True)
    model = langid.fit(["en", "xx"], [(key, n), (key[::2], n[::2])])
    letters = np.unique(key & np.uint64(0xFFFF))
    for context in ("   ", "the", "zzz", "ati"):
        k = np.zeros(len(letters) + 1, np.uint64)
        for ch in context:
            k = (k << np.uint64(16)) | np.uint64(ord(ch))
        k = (k << np.uint64(16)) | np.append(letters, np.uint64(0x4E00))
        assert np.exp(model.log_probability(k)).sum(axis=0) == pytest.approx([1, 1])


def test_language_id_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(docs.filter(~langid.held_out(docs)))
    rows = langid.predict(docs, model, keep=("lang",)).filter(langid.held_out(docs)).collect()
    assert len(rows) > 200 and sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows) and sum(r.rejected for r in rows) <= 0.02 * len(rows)
    other = spark.createDataFrame([(1, "Съешь же ещё этих мягких французских булок да выпей чаю " * 5), (2, "qzxj wvkp " * 40)],
                                  "doc_id long, text string")
    assert all(r.rejected for r in langid.predict(other, model).collect())


def test_language_id_odd_rows(odd, odd_rows, none):
    model = langid.train(odd)
    rows = langid.predict(odd, model).collect()
    assert len(rows) == len(odd_rows)
    und = Counter(r.doc_id for r in rows if r.lang_pred == "und")
    assert und == Counter(i for i, t, *_ in odd_rows if not any(ch.isalpha() for ch in t or ""))
    assert all(r.rejected and r.score == 0 for r in rows if r.lang_pred == "und")
    assert langid.predict(none, model).count() == 0
    nothing = langid.train(none)
    assert {r.lang_pred for r in langid.predict(odd, nothing).collect()} == {"und"}
    kept = langid.filter_language(odd, model)
    assert kept.columns == odd.columns and kept.count() == sum(not r.rejected for r in rows)


def test_nearest_neighbours_recall(spark):
    v = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    q = v.filter("vec_id % 50 = 0")
    got = ann.search(q, v).collect()
    want = {(r.query_id, r.vec_id): r.score for r in ann.exact(q, v).collect()}
    assert Counter(r.query_id for r in got) == Counter({k[0]: 5 for k in want})
    hits = sum((r.query_id, r.vec_id) in want for r in got)
    assert hits >= 0.9 * len(want)
    assert all(want.get((r.query_id, r.vec_id), r.score) == r.score for r in got)


def test_nearest_neighbours_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (1, [2.0, 0.0], 1), (2, [1.0, 0.1], 1), (3, None, 1), (4, [0.0, 0.0], 1), (5, [nan, 1.0], 1),
            (6, [inf, 1.0], 1), (7, [None, 1.0], 1), (8, [1.0], 1), (None, [1.0, 0.0], 1), (9, [-1.0, 0.0], 1),
            (1, [2.0, 0.0], 1), (10, [3.0, 0.0], 1)]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score long")
    got = ann.search(v.filter("vec_id % 50 = 0"), v).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in got] == [(0, 1, 1), (0, 2, 10), (0, 3, 2), (0, 4, 9)]
    assert got[0].score == 1.0 and got[3].score == -1.0
    assert ann.search(v.limit(0), v).count() == 0 and ann.search(v, v.limit(0)).count() == 0
    assert ann.search(v.filter("vec_id in (3, 4)"), v).count() == 0


def test_nearest_neighbours_common_vector(spark, monkeypatch):
    """A vector that fills a third of the rows is split over blocks and answers by smallest id."""
    monkeypatch.setattr(ann, "BLOCK", 64)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 8))
    x[::3] = x[0]
    v = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    got = ann.search(v.filter("vec_id = 300"), v, leaf=32).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [0, 3, 6, 9, 12] and all(r.score == pytest.approx(1) for r in got)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, kept = docs.columns, docs
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "quality_rules", "near_dedup", "mix_sources",
                                                      "pack_sequences"]
    for name, stage in corpus_pipeline.STAGES[:3]:
        before, kept = kept, stage(spark, kept, SF).cache()
        assert kept.columns == names and kept.exceptAll(before).count() == 0
        if name == "near_dedup":
            rows = [(r.doc_id, r.text) for r in before.collect()]
            want = {v for v in brute_groups(rows, 5, 80).values()}
            assert {r.doc_id for r in kept.collect()} == want
    mixed = corpus_pipeline.mix_sources(spark, kept, SF).cache()
    assert mixed.columns == names and mixed.join(kept, "doc_id", "left_anti").count() == 0
    pieces = corpus_pipeline.pack_sequences(spark, mixed, SF)
    assert pieces.select("doc_id").distinct().count() == mixed.select("doc_id").distinct().count()
    assert pieces.filter("start = 0").count() == mixed.count()


def test_pipeline_odd_rows(spark, odd, none):
    for docs in (odd, none):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF).cache()
            docs.count()


def test_held_out_folds(odd, odd_rows):
    got = Counter((r.doc_id, r.a, r.b) for r in odd.select(
        "doc_id", langid.held_out(odd).alias("a"), kneser_ney.held_out().alias("b")).collect())
    crc = lambda i: zlib.crc32(("" if i is None else str(i)).encode())
    assert got == Counter((i, crc(i) % 4 == 2, crc(i) % 10 == 0) for i, *_ in odd_rows)
