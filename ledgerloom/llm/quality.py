"""Quality rules (2): a short-circuit cascade, DataFrame functions only.

Each rule is a boolean expression over a text's measures. On a bounded sample
the cost (the words and characters of a row times what each takes) and the
selectivity (share rejected) of every rule are estimated; rules run in the order of rejection per cost, nested in one CASE
whose later branches are not evaluated once one rejects. The order changes
only the time and which rule is named; ``kept`` is the same in every order.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, VariantType

from .common import WHITE, as_rows, free_name, let, words

SYMBOLS = "#*$%&|<>"
SAMPLE_ROWS = 1000          # size of the sample that orders the rules


def word_hashes(text: Column) -> Column:
    """64-bit hashes of the words, in order."""
    return F.transform(words(text), lambda w: F.xxhash64(w))


def word_chars(text: Column) -> Column:
    return F.char_length(F.translate(F.coalesce(text, F.lit("")), WHITE, "")).cast("long")


def count_of(text: Column, characters: str) -> Column:
    """How many of a text's code points are among ``characters``."""
    t = F.coalesce(text, F.lit(""))
    return (F.char_length(t) - F.char_length(F.translate(t, characters, ""))).cast("long")


def _lines(text: Column) -> Column:
    """Lines that hold a word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda s: F.translate(s, WHITE, "") != "")


def dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return let(_lines(text), lambda a: (F.size(a) - F.size(F.array_distinct(a))).cast("long"))


def dup_line_percent(text: Column) -> Column:
    return let(_lines(text), lambda a: F.when(F.size(a) > 0, 100.0 * (
        F.size(a) - F.size(F.array_distinct(a))) / F.size(a)).otherwise(0.0))


def _covered(hashes: Column, width: int) -> Column:
    """Positions covered by windows that occur more than once: windows sorted
    by (hash, place); those with an equal neighbour, by place again; each adds
    its distance to the one before, ``width`` at most. n log n, no pairs."""
    by_hash = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def places(s: Column) -> Column:
        own = F.transform(s, lambda e, k: F.when(
            (e["h"] == F.get(s, k - 1)["h"]) | (e["h"] == F.get(s, k + 1)["h"]), e["i"]))
        return F.sort_array(F.filter(own, lambda i: i.isNotNull()))

    def total(p: Column) -> Column:
        steps = F.transform(p, lambda i, k: F.when(k == 0, F.lit(width)).otherwise(
            F.least(F.lit(width), i - F.get(p, k - 1))))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    return let(by_hash, lambda s: let(places(s), total))


def repeat_words(hashes: Column, width: int = 8) -> Column:
    """Words inside ``width``-word windows found twice or more, the first
    included. ``hashes`` must be cheap to copy (a column, not an expression)."""
    windows = F.transform(F.sequence(F.lit(1), F.size(hashes) - (width - 1)),
                          lambda i: F.xxhash64(F.slice(hashes, i, width)))
    covered = let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0))
                  .otherwise(_covered(h, width)))
    return F.when(F.size(hashes) < width, F.lit(0)).otherwise(covered).cast("long")


def run_words(hashes: Column) -> Column:
    """Words equal to the word before them."""
    same = F.filter(hashes, lambda h, i: (i > 0) & (h == F.get(hashes, i - 1)))
    return F.size(same).cast("long")


def measures(text: Column) -> dict[str, Callable[[Column], Column]]:
    """Name -> expression of every measure the rules use, given the column of
    word hashes."""
    return {
        "n_words": lambda h: F.size(h).cast("long"),
        "word_chars": lambda h: word_chars(text),
        "n_symbols": lambda h: count_of(text, SYMBOLS),
        "n_dup_lines": lambda h: dup_lines(text),
        "n_repeat_words": lambda h: repeat_words(h),
        "n_run_words": lambda h: run_words(h),
        "dup_line_percent": lambda h: dup_line_percent(text),
        "n_letters": lambda h: F.char_length(F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\p{L}]+", "")).cast("long"),
    }


@dataclass(frozen=True)
class Rule:
    """``rejects(m)``: boolean Column over measures ``m[name]``; ``per_word``
    and ``per_char``: nanoseconds that its measures take for a word and for a
    character of a text (measured once; constants, so that the order of the
    rules, and with it the rule named, is the same on every run and machine)."""
    name: str
    rejects: Callable[[dict[str, Column]], Column]
    per_word: float = 0.0
    per_char: float = 0.0


RULES: tuple[Rule, ...] = (
    Rule("few_words", lambda m: m["n_words"] < 20, 0.1),
    Rule("repeated_passages", lambda m: 100 * m["n_repeat_words"] > 30 * m["n_words"], 1450),
    Rule("symbols", lambda m: 100 * m["n_symbols"] > 10 * m["n_words"], 0, 70),
    Rule("word_length", lambda m: (m["word_chars"] < 2 * m["n_words"]) | (m["word_chars"] > 12 * m["n_words"]), 0, 50),
    Rule("repeated_lines", lambda m: m["dup_line_percent"] > 50.0, 0, 60),
    Rule("repeated_words", lambda m: 100 * m["n_run_words"] > 50 * m["n_words"], 130),
    Rule("few_letters", lambda m: 100 * m["n_letters"] < 40 * m["word_chars"], 0, 105),
)
BASE = ("few_words", "repeated_passages")


def _expressions(text: Column, hashes: Column) -> dict[str, Column]:
    return {k: f(hashes) for k, f in measures(text).items()}


def order_rules(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text",
                rows: int = SAMPLE_ROWS) -> list[tuple[Rule, float, float]]:
    """(rule, nanoseconds a row, share rejected), most rejection per cost first.

    Both are estimated on a sample of about ``rows`` rows with their whole
    texts, chosen by a hash of the row, in one aggregate; nothing but its sums
    leaves the executors. The sample orders the rules and decides nothing else.
    An empty sample keeps the given order."""
    total = docs.count()
    plain = [F.col(f"`{f.name}`") for f in docs.schema if isinstance(f.dataType, AtomicType) and f.dataType != VariantType()]
    draw = F.shiftrightunsigned(F.xxhash64(F.lit("rule sample"), *plain), 1)
    limit = min((1 << 63) - 1, (rows << 63) // max(total, 1))
    text = F.col("text")
    sample = docs.filter(draw <= limit).select(F.col(text_col).alias("text"))
    m = {k: F.col("m")[k] for k in measures(text)}
    found = sample.select(
        F.coalesce(F.char_length(text), F.lit(0)).alias("chars"),
        let(word_hashes(text), lambda h: F.struct(*[c.alias(k) for k, c in _expressions(text, h).items()])).alias("m")).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(r.per_word * m["n_words"] + r.per_char * F.col("chars")).alias(f"cost_{k}") for k, r in enumerate(rules)],
        *[F.count_if(r.rejects(m)).alias(f"hits_{k}") for k, r in enumerate(rules)]).first()
    if not (n := found["n"]):
        return [(r, 0.0, 0.0) for r in rules]
    out = [(r, max(found[f"cost_{k}"] / n, 1.0), found[f"hits_{k}"] / n) for k, r in enumerate(rules)]
    return sorted(out, key=lambda x: (-x[2] / x[1], x[0].name))


def cascade(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text", prefix: str = "quality_",
            order: Sequence[Rule] | None = None, columns: Sequence[str] = ()) -> DataFrame:
    """``docs`` plus ``<prefix>failed`` (the rule that rejected the row, NULL
    if none) and ``<prefix>kept``; ``columns`` names measures to add as well
    (they are then computed for every row, and the rules use them).

    NULL or empty text has 0 words and is rejected by ``few_words``. NULL ids,
    ties and repeated rows are judged row by row; very long texts whole. Empty
    table: no rows. Columns named like the added ones are replaced.
    """
    ordered = list(order) if order is not None else [r for r, _, _ in order_rules(docs, rules, text_col)]
    text = F.col(text_col)

    def judge(m: dict[str, Column]) -> Column:
        failed = F.lit(None).cast("string")
        for r in reversed(ordered):
            failed = F.when(r.rejects(m), F.lit(r.name)).otherwise(failed)
        return failed.alias("failed")

    def verdict(h: Column) -> Column:
        m = _expressions(text, h)
        if not columns:
            return F.struct(judge(m))
        return let(F.struct(*[m[c].alias(c) for c in columns]), lambda s: F.struct(
            *[s[c].alias(c) for c in columns], judge(m | {c: s[c] for c in columns})))

    # Word hashes and measures are bound by ``let``: a filter on the verdict
    # may be pushed below the projection without evaluating them again.
    found = free_name(docs, prefix + "found")
    d = docs.withColumn(found, let(word_hashes(text), verdict))
    return d.withColumns({**{prefix + c: F.col(found)[c] for c in columns}, prefix + "failed": F.col(found)["failed"],
                          prefix + "kept": F.col(found)["failed"].isNull()}).drop(found)


def filter_quality(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that pass every rule, with the columns of ``docs``,
    whatever their names. NULL and empty texts go (too few words); NULL ids,
    ties and repeated rows are judged row by row, very long texts whole. Empty
    table: no rows."""
    text_col = options.pop("text_col", "text")
    if options.get("order") is None:
        options["order"] = [r for r, _, _ in order_rules(docs, options.get("rules", RULES), text_col)]
    judged = cascade(as_rows(docs, F.col(text_col).alias("text")), **options)
    return judged.filter("quality_kept").select("row.*")
