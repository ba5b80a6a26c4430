"""Licences, quality rules, WARC derivatives and mixing against plain Python and SQL."""
import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerloom.checks import compare, duck
from ledgerloom.llm import licences, mixing, quality, queries, warc

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    r = compare(queries.QUERIES[name](spark, SF), duck(SF), queries.ORACLES[name])
    assert r["values_match"], r


def test_licences(spark, odd, odd_rows, none):
    apache = ("Licensed under the Apache License, Version 2.0 (the \"License\");\nYou may not use this file except in "
              "compliance with the License. You may obtain a copy of the License at\nhttp://x")
    texts = {1: apache, 2: "x. Released under the MIT License.\nall rights RESERVED.", 3: "MIT License", 4: None, 5: "",
             6: "Licensed under CC BY-NC 4.0.\n" * 3, 7: "Permission is hereby granted, free of charge, to any person "
             "obtaining a copy of this software; The above copyright notice and this permission notice shall be included "
             "in all copies. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND."}
    d = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.licence, r.n_licence_sentences, r.licences) for r in licences.scan(d).collect()}
    assert got == {1: ("Apache-2.0", 3, "Apache-2.0"), 2: ("MIT", 2, "MIT,Proprietary"), 3: ("none", 0, ""),
                   4: ("none", 0, ""), 5: ("none", 0, ""), 6: ("CC-BY-NC-4.0", 3, "CC-BY-NC-4.0"), 7: ("MIT", 3, "MIT")}
    assert licences.scan(odd).count() == len(odd_rows) and licences.scan(none).count() == 0


def plain_measures(t):
    w = WORD.findall(t or "")
    lines = [x for x in (t or "").split("\n") if WORD.search(x)]
    seen = defaultdict(list)
    for i in range(len(w) - 7):
        seen[tuple(w[i:i + 8])].append(i)
    places = {p + k for v in seen.values() if len(v) > 1 for p in v for k in range(8)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(places)


def test_quality_measures(odd, odd_rows, none):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = quality.cascade(odd, columns=names, prefix="q_", order=quality.RULES)
    assert Counter(tuple(r[f"q_{n}"] for n in names) for r in got.collect()) == Counter(
        plain_measures(t) for _, t, *_ in odd_rows)
    assert quality.cascade(none).count() == 0


def test_quality_order_changes_nothing_but_the_name(odd):
    one = quality.cascade(odd, order=quality.RULES).groupBy("doc_id", "quality_kept").count()
    two = quality.cascade(odd, order=quality.RULES[::-1]).groupBy("doc_id", "quality_kept").count()
    assert one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0
    kept = quality.filter_quality(odd)
    assert kept.columns == odd.columns and kept.count() == quality.cascade(odd).filter("quality_kept").count()


def test_rules_are_ordered_by_rejection_per_cost(odd):
    found = quality.order_rules(odd)
    gain = [hits / cost for _, cost, hits in found]
    assert {r.name for r, _, _ in found} == {r.name for r in quality.RULES} and gain == sorted(gain, reverse=True)


def test_warc_links_and_lengths(spark, none):
    html = ('<html lang="de"><title>A &amp; B</title><script>var x="</p>"</script><p>One  two<br>three&nbsp;&copy;</p>'
            '<a href="/x">link</a><style>p{}</style><!-- no --><p>end<script>open')
    pages = spark.createDataFrame([(1, "http://a/", html), (2, None, None), (None, "u", ""), (1, "http://a/", html)],
                                  "page_id long, url string, html string")
    resp = warc.responses(pages)
    rows = warc.derive(resp).collect()
    assert len(rows) == 8
    ids = {r.record_id for r in resp.collect()}
    for r in rows:
        assert r.refers_to in ids and f"WARC-Refers-To: {r.refers_to}\r\n" in r.header
        assert f"Content-Length: {len(r.block.encode())}\r\n" in r.header
    text = next(r.block for r in rows if r.id == 1 and r.warc_type == "conversion")
    assert text == "A & B\nOne two\nthree ©\nlink\nend"
    meta = next(r.block for r in rows if r.id == 1 and r.warc_type == "metadata")
    assert "outlink: /x\r\n" in meta and "title: A & B\r\n" in meta and "lang: de\r\n" in meta
    assert "source-Content-Type: text/html; charset=utf-8\r\n" in meta
    empty = [r for r in rows if r.id == 2 and r.warc_type == "conversion"][0]
    assert empty.block == ""
    assert warc.derive(warc.responses(pages.limit(0))).count() == 0


def test_write_warc(spark, scratch):
    pages = spark.createDataFrame([(1, "http://a/", "<p>x</p>"), (2, "http://b/", "<p>y</p>")],
                                  "page_id long, url string, html string")
    warc.write_warc(warc.derive(warc.responses(pages)).coalesce(1), f"{scratch}/w")
    data = "".join(r.value for r in spark.read.text(f"{scratch}/w", wholetext=True).collect())
    pos = n = 0
    while pos < len(data):                                       # read it as a WARC reader does
        head, _, rest = data[pos:].partition("\r\n\r\n")
        size = int(re.search(r"Content-Length: (\d+)", head)[1])
        assert head.startswith("WARC/1.1\r\n") and rest[size:size + 4] == "\r\n\r\n"
        pos += len(head) + 4 + size + 4
        n += 1
    assert n == 4


def fill(sizes, weights, most=3.0):
    """Water filling, one round at a time."""
    target, open_, left = {s: 0.0 for s in sizes}, {s for s in sizes if sizes[s] > 0}, float(sum(sizes.values()))
    while open_:
        level = left / sum(weights[s] for s in open_)
        full = {s for s in open_ if weights[s] * level >= most * sizes[s]}
        if not full:
            return target | {s: weights[s] * level for s in open_}
        for s in full:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= full
    return target


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 10, "c": 10, "d": 10}, {"a": 1, "b": 100, "c": 3, None: 50},
                                   {"a": 0, "b": 5}, {"a": 1, "b": 1, "c": 1000, "d": 0, "é": 7}, {"a": 0}, {"z": 4}])
def test_targets(spark, sizes):
    d = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = fill(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)})
    for r in mixing.targets(d).collect():
        assert r.target == pytest.approx(want[r.source], abs=1e-9)
        assert r.target <= 3 * r.source_size


def test_mix(odd, odd_rows, none):
    size = mixing.word_count(F.col("text"))
    rows = mixing.copies(odd, size).collect()
    assert len(rows) == len(odd_rows)
    for r in rows:
        n = len(WORD.findall(r.text or ""))
        assert r.mix_size == n and math.floor(r.mix_rate) <= r.mix_copies <= math.floor(r.mix_rate) + 1 <= 4
        assert r.mix_copies <= 3
    out = mixing.mix(odd, size)
    assert out.columns == odd.columns and out.count() == sum(r.mix_copies for r in rows)
    again = mixing.mix(odd.repartition(5), size)
    assert out.exceptAll(again).count() == 0 and again.exceptAll(out).count() == 0
    assert mixing.mix(none, size).count() == 0
