"""Documents of unknown shape: every field of any document is found."""
import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerloom.sources import shapes


def land(scratch, lines, name="docs.jsonl"):
    path = f"{scratch}/{name}"
    with open(path, "w", encoding="utf-8") as f:
        f.write("".join(line + "\n" for line in lines))
    return path


def rows(df):
    return [{k: v for k, v in r.asDict().items() if v is not None} for r in df.collect()]


def test_fields_that_only_some_documents_have(spark, scratch):
    path = land(scratch, [
        '{"a":1,"b":{"x":1.5,"we ird.k":true},"t":null,"_ts":5}',
        '{"a":"s","b":{"y":[1,2]},"q\'u`o":{"z":"2024-01-01"}}', "", "   ",
        '{"b":3,"e":{},"l":[{"a":1}],"OBJECT<x":{"1a":2,"select":3}}',
        '{"b":{"x":{"deep":{"er":"v"}}}}',
        '{"\'\\"":3,"br]ack":1,"":{"k":1},"x:y":{"c>d":3}}'])
    df = shapes.bronze_documents(spark, path)
    assert rows(df) == [
        {"a": "1", "b_x": "1.5", "b_we ird.k": "true"}, {"a": "s", "b_y": "[1,2]", "q'u`o_z": "2024-01-01"},
        {"b": "3", "l": '[{"a":1}]', "OBJECT<x_1a": "2", "OBJECT<x_select": "3"},
        {"b_x_deep_er": "v"}, {"'\"": "3", "br]ack": "1", "_k": "1", "x:y_c>d": "3"}]
    assert "t" in df.columns and "e" not in df.columns and "_ts" not in df.columns
    assert {t for _, t in df.dtypes} == {"string"}


def test_what_is_no_document_is_kept(spark, scratch):
    lines = ["nope", "[1]", "7", '{"a":1,"a":2}', '{"a":']
    df = shapes.bronze_documents(spark, land(scratch, ['{"a":1}', *lines]))
    assert rows(df) == [{"a": "1"}, *({shapes.CORRUPT: x} for x in lines)]
    assert shapes.bronze_documents(spark, land(scratch, lines, "no.jsonl")).columns == [shapes.CORRUPT]
    empty = shapes.bronze_documents(spark, land(scratch, [], "empty.jsonl"))
    assert empty.columns == [shapes.CORRUPT] and empty.count() == 0


def test_equal_names_share_a_column(spark, scratch):
    df = shapes.bronze_documents(spark, land(scratch, [
        '{"a_b":1,"a":{"b":2}}', '{"a":{"b":3}}', '{"A_B":4}', '{"Amount":5}', '{"amount":"6"}']))
    assert rows(df) == [{"A_B": "1"}, {"A_B": "3"}, {"A_B": "4"}, {"Amount": "5"}, {"Amount": "6"}]


def test_numbers_and_bounds(spark, scratch):
    path = land(scratch, ['{"m":{"v":" 1,200.50 "}}', '{"m":{"v":3}}', '{"m":{"v":"x"}}', '{"m":{"v":[1]}}'])
    assert [r.m_v for r in shapes.bronze_documents(spark, path, ["m_v", "absent"]).collect()] == ["1200.5", "3.0", None, None]
    with pytest.raises(ValueError, match="max_columns=2"):
        shapes.leaf_paths(shapes.read_lines(spark, land(scratch, ['{"a":1,"b":2,"c":3}'], "wide.jsonl")), 2)


def flat(doc, above=()):
    """Plain leaves of a document: {path: value}, objects walked into."""
    out = {}
    for k, v in doc.items():
        out |= flat(v, (*above, k)) if isinstance(v, dict) else {(*above, k): v}
    return out


def branches(doc, above=()):
    for k, v in doc.items():
        if isinstance(v, dict):
            yield (*above, k)
            yield from branches(v, (*above, k))


KEYS = st.sampled_from(["a", "b", "c d", "e'f"])
VALUES = st.recursive(st.none() | st.booleans() | st.integers(-99, 99) | st.sampled_from(["", "x", "1"]),
                      lambda v: st.dictionaries(KEYS, v, max_size=3), max_leaves=6)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.dictionaries(KEYS, VALUES, max_size=3), min_size=1, max_size=12))
def test_any_documents_against_plain_python(spark, scratch, docs):
    path = land(scratch, [json.dumps(d) for d in docs])
    text = {True: "true", False: "false"}
    want = []
    for d in docs:
        want.append({"/".join(p): text[v] if isinstance(v, bool) else str(v)
                     for p, v in flat(d).items() if v is not None})
    lines = shapes.read_lines(spark, path)
    got = shapes.flatten_documents(lines, sep="/")
    assert rows(got) == want
    leaves = {p for d in docs for p in flat(d)}
    filled = {p for d in docs for p, v in flat(d).items() if v is not None}
    objects = {p for d in docs for p in branches(d)}
    assert set(got.columns) - {shapes.CORRUPT} == {"/".join(p) for p in leaves - (objects - filled)}
