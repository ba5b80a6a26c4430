"""The pipeline's stages on odd rows with clashing columns: kept rows and values against plain Python."""
import re
import unicodedata
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline as P
from ledgerloom.llm import langid, mixing, quality


@pytest.mark.parametrize("name", ["language_id", "quality_rules", "near_dedup", "mix_sources"])
def test_columns_come_back(spark, odd, name):
    out = dict(P.STAGES)[name](spark, odd, "")
    assert out.columns == odd.columns and out.schema.simpleString() == odd.schema.simpleString()
    before = Counter(map(str, odd.collect()))
    assert set(map(str, out.collect())) <= set(before)


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rejected(text):
    """Whether a rule rejects the text, each restated in plain Python."""
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    places = {}
    for i in range(len(words) - 7):
        places.setdefault(tuple(words[i:i + 8]), []).append(i)
    covered = {i + j for at in places.values() if len(at) > 1 for i in at for j in range(8)}
    n, chars = len(words), sum(map(len, words))
    symbols = sum(c in quality.SYMBOLS for c in text or "")
    letters = sum(unicodedata.category(c)[0] == "L" for c in text or "")
    return (n < 20 or 100 * len(covered) > 30 * n or 100 * symbols > 10 * n or chars < 2 * n or chars > 12 * n
            or bool(lines) and 100 * (len(lines) - len(set(lines))) > 50 * len(lines)
            or 100 * sum(a == b for a, b in zip(words, words[1:])) > 50 * n or 100 * letters < 40 * chars)


def test_quality_keeps_what_plain_rules_keep(spark, odd, odd_rows):
    want = Counter((r[0], r[1]) for r in odd_rows if not rejected(r[1]))
    assert Counter((r.doc_id, r.text) for r in P.quality_rules(spark, odd, "").collect()) == want and want


def test_rules_are_ordered_alike_on_any_layout(spark, odd):
    order = [[r.name for r, _, _ in quality.order_rules(odd.repartition(n), rows=30)] for n in (1, 5)]
    assert order[0] == order[1] and len(order[0]) == len(quality.RULES)


def test_mix_takes_floor_or_one_more(spark, odd, odd_rows):
    words = lambda t: len(WORD.findall(t or ""))
    sizes = Counter()
    for _, text, _, source, _ in odd_rows:
        sizes[source] += words(text)
    table = {r.source: r for r in mixing.targets(mixing.source_sizes(odd, mixing.word_count(odd["text"]))).collect()}
    assert {s: r.source_size for s, r in table.items()} == dict(sizes)
    taken = Counter((r.doc_id, r.text, r.source) for r in P.mix_sources(spark, odd, "").collect())
    rows = Counter((r[0], r[1], r[3]) for r in odd_rows)
    assert set(taken) <= set(rows)
    for key, n in rows.items():
        rate = table[key[2]].target / sizes[key[2]] if sizes[key[2]] else 0
        assert n * int(rate) <= taken[key] <= n * (int(rate) + 1)


def test_language_verdicts_agree(spark, odd):
    """The stage keeps the rows that the scores reject not."""
    model = langid.train(odd.filter(~langid.held_out(odd)))
    scored = langid.predict(odd, model)
    want = Counter(r.doc_id for r in scored.collect() if not r.rejected)
    assert Counter(r.doc_id for r in langid.filter_language(odd, model).collect()) == want and want


def test_sample_limit():
    """No language is too large to be drawn from, small ones are drawn whole."""
    assert langid.sample_limit(2500, 10) == langid.sample_limit(2500, 2500) == (1 << 63) - 1
    for n in (10**4, 10**8, 10**12, 10**15):
        assert abs((langid.sample_limit(2500, n) + 1) / 2**63 * n - 2500) < 1e-3


def plain_score(counts, text, order=langid.ORDER):
    """Modified Kneser-Ney log-probability of a text's characters, one at a time."""
    def discount(table, c):
        d = langid.discounts(np.bincount(np.minimum(list(table.values()), 5), minlength=6))
        return d[min(c, 3)]

    tables = {order: counts}
    for k in range(order - 1, 0, -1):
        tables[k] = Counter(g[1:] for g in tables[k + 1])
    letters = len(tables[1]) + 1

    def p(gram):
        k = len(gram)
        if not k:
            return 1 / letters
        table = tables[k]
        own = {g: c for g, c in table.items() if g[:-1] == gram[:-1]}
        lower = p(gram[1:])
        if not own:
            return lower
        total = sum(own.values())
        free = sum(discount(table, c) for c in own.values()) / total
        c = own.get(gram, 0)
        return (max(c - discount(table, c), 0) / total if c else 0) + free * lower
    return p


def test_scores_against_plain_kneser_ney():
    texts = ["the theme of the thesis then", "a then the them that", "there"]
    codes = [[*(ord(x) for x in t)] for t in texts]
    keys = np.concatenate([langid.grams(langid.normalise(t)) for t in texts])
    k, c = np.unique(keys, return_counts=True)
    model = langid.fit(["x"], [(k, c)])
    assert codes
    counts = Counter()
    for t in texts:
        padded = [int(langid._SPACE)] * (langid.ORDER - 1) + [int(x) for x in langid.normalise(t)]
        counts.update(tuple(padded[i:i + langid.ORDER]) for i in range(len(padded) - langid.ORDER + 1))
    p = plain_score(counts, None)
    probe = langid.normalise("then that theory xe")
    padded = [int(langid._SPACE)] * (langid.ORDER - 1) + [int(x) for x in probe]
    want = [np.log(p(tuple(padded[i:i + langid.ORDER]))) for i in range(len(probe))]
    got = model.log_probability(langid.grams(probe))[:, 0]
    assert np.allclose(got, want)
