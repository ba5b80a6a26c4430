"""Language identification (7): interpolated Kneser-Ney character models.

One modified Kneser-Ney model of ``ORDER`` characters per language is fitted
on a bounded sample of labelled rows; the n-grams of all languages share sorted
hash arrays (key -> log-probability in each language). Every text is scored
whole, in one pass without shuffle: the language with the lowest cross-entropy
per character wins, and a text is rejected when that cross-entropy is above
what held-back labelled texts of the language show for its length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import claim

ORDER = 4                   # 16 bits a character: a 4-gram is one 64-bit key
BITS = 16
SAMPLE = 2500               # labelled texts a language the model is fitted on (expected; the bound of the sample)
HELD_BACK = 5               # every so many sampled texts one is held back for calibration
DEVIATIONS = 30.0           # median absolute deviations above its median at which a language rejects
LEAST_REACH = 6.0           # in units of _width; a language of near copies hardly deviates
FEW, FEW_REACH = 20, 12.0   # with fewer held-back texts than this, the least reach is this
SHARPNESS = 12.0            # of the score: softmax of -cross-entropy (nats a character)
UNKNOWN = "und"
_SPACE = 32
_OTHER = 0xFFFD             # letters beyond the 16-bit range
_U = np.uint64


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code point -> lower-case letter, or a blank for anything else."""
    out = np.full(1 << BITS, _SPACE, np.uint16)
    for cp in range(1 << BITS):
        c = chr(cp)
        if c.isalpha():
            low = c.lower()
            out[cp] = ord(low) if len(low) == 1 and ord(low) < 1 << BITS else cp
    return out


def normalise(text: str) -> np.ndarray:
    """Lower-case letters with single blanks between words and one at the end;
    empty if the text has no letter."""
    cp = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    c = _letters()[np.minimum(cp, (1 << BITS) - 1)]
    high = cp >= 1 << BITS
    if high.any():
        for i in np.flatnonzero(high):
            c[i] = _OTHER if chr(cp[i]).isalpha() else _SPACE
    c = np.append(c, np.uint16(_SPACE))
    blank = c == _SPACE
    c = c[~(blank & np.concatenate(([True], blank[:-1])))]
    return c


def grams(c: np.ndarray) -> np.ndarray:
    """The key of the n-gram that ends at each character (blanks before the first)."""
    padded = np.concatenate((np.full(ORDER - 1, _SPACE, np.uint64), c.astype(np.uint64)))
    key = np.zeros(len(c), np.uint64)
    for j in range(ORDER):
        key = (key << _U(BITS)) | padded[j:j + len(c)]
    return key


def _suffix(key: np.ndarray, k: int) -> np.ndarray:
    """The last k characters of a key."""
    return key & _U((1 << (BITS * k)) - 1) if k < ORDER else key


@dataclass
class Model:
    languages: list[str]
    keys: dict[int, np.ndarray] = field(default_factory=dict)       # order -> sorted keys
    logp: dict[int, np.ndarray] = field(default_factory=dict)       # order -> [key, language]
    contexts: dict[int, np.ndarray] = field(default_factory=dict)   # order -> sorted contexts
    backoff: dict[int, np.ndarray] = field(default_factory=dict)    # order -> [context, language]
    floor: np.ndarray | None = None                                 # log-probability of an unseen character
    centre: np.ndarray | None = None                                # calibration, by language
    reach: np.ndarray | None = None

    @staticmethod
    def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(keys, wanted)
        at[at == len(keys)] = 0
        return at, keys[at] == wanted

    def log_probability(self, key: np.ndarray, top: int = ORDER) -> np.ndarray:
        """[key, language] natural log-probability of the last character given
        those before, by the longest n-gram any language knows, with the
        back-off weights of the longer contexts."""
        out = np.zeros((len(key), len(self.languages)))
        rest = np.arange(len(key))
        for k in range(top, 0, -1):
            wanted = _suffix(key[rest], k)
            at, found = self._find(self.keys[k], wanted)
            out[rest[found]] += self.logp[k][at[found]]
            rest, wanted = rest[~found], wanted[~found]
            if k == 1:
                out[rest] += self.floor
            elif len(rest):
                at, found = self._find(self.contexts[k], wanted >> _U(BITS))
                out[rest[found]] += self.backoff[k][at[found]]
        return out


def discounts(freq: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts of counts 0, 1, 2 and 3 or more, from the
    numbers of n-grams with count 1 to 4 (``freq[1:5]``). Where these do not
    allow the estimate: 0.5, 1, 1.5."""
    out, n = np.array([0.0, 0.5, 1.0, 1.5]), np.asarray(freq, float)
    if n[1] > 0 and n[2] > 0:
        y = n[1] / (n[1] + 2 * n[2])
        for i in (1, 2, 3):
            if n[i] > 0 and 0 < (d := i - (i + 1) * y * n[i + 1] / n[i]) < i:
                out[i] = d
    return out


def fit(languages: list[str], counts: list[tuple[np.ndarray, np.ndarray]]) -> Model:
    """Model of (keys, counts) of the highest order, one pair per language."""
    model = Model(languages)
    per: list[dict[int, tuple[np.ndarray, np.ndarray]]] = []
    for keys, c in counts:
        order = np.argsort(keys)
        tables = {ORDER: (keys[order], c[order])}
        for k in range(ORDER - 1, 0, -1):               # continuation counts: distinct characters before
            tables[k] = np.unique(_suffix(tables[k + 1][0], k), return_counts=True)
        per.append(tables)
    letters = len(np.unique(np.concatenate([t[1][0] for t in per]))) + 1
    n_lang = len(languages)
    model.floor = np.zeros(n_lang)
    for k in range(1, ORDER + 1):
        keys = np.unique(np.concatenate([t[k][0] for t in per]))
        context_all = np.unique(keys >> _U(BITS))
        logp, backoff = np.zeros((len(keys), n_lang)), np.zeros((len(context_all), n_lang))
        lower = model.log_probability(_suffix(keys, k - 1), k - 1) if k > 1 else np.full((len(keys), n_lang), -np.log(letters))
        for j, tables in enumerate(per):
            own, c = tables[k]
            d = discounts(np.bincount(np.minimum(c, 5), minlength=6))
            ctx, first = np.unique(own >> _U(BITS), return_inverse=True)
            total = np.bincount(first, c, len(ctx))
            taken = np.bincount(first, d[np.minimum(c, 3)], len(ctx))
            weight = taken / total                       # what interpolation gives to the lower order
            at = np.searchsorted(context_all, ctx)
            backoff[at, j] = np.log(weight)
            at = np.searchsorted(ctx, keys >> _U(BITS))
            at[at == len(ctx)] = 0
            known = ctx[at] == keys >> _U(BITS)
            p = np.exp(lower[:, j]) * np.where(known, weight[at], 1.0)
            i = np.searchsorted(keys, own)
            p[i] += np.maximum(c - d[np.minimum(c, 3)], 0) / total[first]
            logp[:, j] = np.log(p)
        model.keys[k], model.logp[k] = keys, logp
        model.contexts[k], model.backoff[k] = context_all, backoff
        if k == 1:
            model.floor = backoff[0] - np.log(letters)
    return model


def _width(n: np.ndarray) -> np.ndarray:
    """How a text's cross-entropy spreads with its length."""
    return np.sqrt(1.0 / np.maximum(n, 1) + 1.0 / 1000)


def entropies(model: Model, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(characters, cross-entropy in nats a character [text, language]) of whole texts."""
    parts = [normalise(t) if t else np.empty(0, np.uint16) for t in texts]
    parts = [c if len(c) > 1 or (len(c) and c[0] != _SPACE) else c[:0] for c in parts]
    n = np.array([len(c) for c in parts], np.int64)
    out = np.zeros((len(texts), len(model.languages)))
    if not n.sum() or not model.languages:
        return n, out
    logp = model.log_probability(np.concatenate([grams(c) for c in parts if len(c)]))
    starts = np.cumsum(n[n > 0]) - n[n > 0]
    out[n > 0] = -np.add.reduceat(logp, starts) / n[n > 0][:, None]
    return n, out


def _chunks(texts: list, most: int = 300_000) -> Iterator[list]:
    """Runs of texts of about ``most`` characters together; a longer text alone."""
    run, size = [], 0
    for t in texts:
        run.append(t)
        size += len(t or "")
        if size >= most:
            yield run
            run, size = [], 0
    if run:
        yield run


def calibrate(model: Model, lang: np.ndarray, n: np.ndarray, h: np.ndarray) -> None:
    """Set centre and reach from held-back texts: their labels, characters and
    cross-entropies. Both are medians, so wrong labels and junk must be near
    half of a language's texts to move them far, where a high quantile follows
    a few in a thousand. Languages with few texts take those of all."""
    if not len(h):
        # Nothing to measure: what is less likely than letters drawn evenly is rejected.
        model.centre, model.reach = np.full(len(model.languages), np.log(len(model.keys[1]) + 1)), np.zeros(len(model.languages))
        return
    at = np.array([model.languages.index(x) for x in lang])
    own = [at == j if (at == j).sum() >= 5 else np.ones(len(h), bool) for j in range(len(model.languages))]
    model.centre = np.array([np.median(h[o]) for o in own])
    z = (h - model.centre[at]) / _width(n)
    own = [at == j if (at == j).sum() >= FEW else np.ones(len(h), bool) for j in range(len(model.languages))]
    middle = [np.median(z[o]) for o in own]
    spread = [DEVIATIONS * np.median(np.abs(z[o] - m)) for o, m in zip(own, middle)]
    model.reach = np.array([m + max(s, LEAST_REACH if o.sum() >= FEW else FEW_REACH) for o, m, s in zip(own, middle, spread)])


def sample_limit(sample: int, n: int) -> int:
    """Greatest 63-bit hash that is drawn so that of ``n`` rows about ``sample`` are."""
    return max(0, min((1 << 63) - 1, (sample << 63) // n - 1))


def train(labelled: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> Model:
    """Fit and calibrate on about ``sample`` rows a language, chosen by a hash
    of the id. Rows with NULL text or language are left out; every language
    with a sampled text that has a letter is fitted. The sampled texts
    are counted whole in Spark; the n-gram table they give is bounded by the
    sample and the alphabet, and is the only thing collected besides one
    cross-entropy for each held-back text."""
    d = labelled.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"),
                        F.col(lang_col).cast("string").alias("lang")).filter("lang is not null")
    sizes = {r["lang"]: r["count"] for r in d.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([])
    # 63 bits, so that no language is too large to be drawn from.
    draw = F.shiftrightunsigned(F.xxhash64(F.lit("language sample"), F.coalesce("id", F.lit(""))), 1)
    share = F.lit(None)
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, F.lit(sample_limit(sample, n))).otherwise(share)
    chosen = d.filter((draw <= share) & F.col("text").isNotNull())
    held = F.pmod(F.xxhash64(F.lit("held back"), F.coalesce("id", F.lit(""))), F.lit(HELD_BACK)) == 0

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by: dict[str, list[np.ndarray]] = {}
            for text, lang in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                by.setdefault(lang, []).append(grams(normalise(text)))
            for lang, parts in by.items():
                key, c = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(key), pa.string()), pa.array(key.view(np.int64)), pa.array(c, pa.int64())], ["lang", "key", "c"])

    def counted(rows: DataFrame) -> list[np.ndarray]:
        table = (rows.mapInArrow(count, "lang string, key long, c long")
                 .groupBy("lang", "key").agg(F.sum("c").alias("c")).toArrow())
        return [table.column(i).to_numpy() for i in range(3)]

    lang, key, c = counted(chosen.filter(~held))
    # A rare language may have all its texts held back: it is fitted on them instead.
    rare = [x for x in languages if not (lang == x).any()]
    if rare:
        lang, key, c = (np.concatenate(p) for p in zip((lang, key, c), counted(chosen.filter(held & F.col("lang").isin(rare)))))
        held = held & ~F.col("lang").isin(rare)
    languages = [x for x in languages if (lang == x).any()]
    if not languages:
        return Model([])
    model = fit(languages, [(key[lang == x].view(np.uint64), c[lang == x]) for x in languages])

    # Calibration: how far above their mean held-back texts of a language lie.
    shared = labelled.sparkSession.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            langs = batch.column(2).to_pylist()
            parts = [entropies(m, some) for some in _chunks(batch.column(1).to_pylist())]
            n, h = map(np.concatenate, zip(*parts or [entropies(m, [])], strict=True))
            ok = [i for i in range(len(langs)) if n[i] and langs[i] in m.languages]
            own = [h[i, m.languages.index(langs[i])] for i in ok]
            yield pa.RecordBatch.from_arrays([pa.array([langs[i] for i in ok], pa.string()), pa.array(n[ok]),
                                              pa.array(own, pa.float64())], ["lang", "n", "h"])

    back = chosen.filter(held).mapInArrow(measure, "lang string, n long, h double").toArrow()
    lang, n, h = (back.column(i).to_numpy() for i in range(3))
    calibrate(model, lang, n, h)
    return model


def _judged(m: Model, texts: list[str | None]) -> tuple[np.ndarray, ...]:
    """Per text: characters, least cross-entropy, its language's place (one
    past the languages: none), score, rejected."""
    n, h = entropies(m, texts)
    if not m.languages:
        return n, np.zeros(len(n)), np.zeros(len(n), int), np.zeros(len(n)), np.ones(len(n), bool)
    best = h.argmin(axis=1)
    low = h[np.arange(len(h)), best]
    score = 1.0 / np.exp(-SHARPNESS * (h - low[:, None])).sum(axis=1)
    none = n == 0
    rejected = none | (low > m.centre[best] + m.reach[best] * _width(n))
    return n, low, np.where(none, len(m.languages), best), np.where(none, 0.0, score), rejected


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
            keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, *keep, lang_pred, score, n_letters_and_gaps as n_chars,
    cross_entropy, rejected) per row.

    NULL text, or one without a letter: 'und', score 0, rejected. A tie goes to
    the language first by name. NULL ids and repeated rows give a row each; very
    long texts are scored whole. Empty table: no rows. A model without
    languages answers 'und' throughout. Columns in ``keep`` pass through;
    others are not read."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    others = [F.col(f"`{c}`").alias(f"keep_{i}") for i, c in enumerate(keep)]
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *others)
    n_keep = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("langid", int)
        m = shared.value
        names = np.array([*m.languages, UNKNOWN], object)
        for batch in batches:
            parts = [_judged(m, texts) for texts in _chunks(batch.column(1).to_pylist())]
            n, low, best, score, rejected = map(np.concatenate, zip(*parts or [_judged(m, [])], strict=True))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(batch.column(2 + i) for i in range(n_keep)),
                 pa.array(names[best].tolist(), pa.string()), pa.array(score.astype(float)), pa.array(n),
                 pa.array(low.astype(float)), pa.array(rejected)],
                ["id", *(f"keep_{i}" for i in range(n_keep)), "lang_pred", "score", "n_chars", "cross_entropy", "rejected"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in d.schema if f.name != "text")
    out = d.mapInArrow(run, f"{kinds}, lang_pred string, score double, n_chars long, cross_entropy double, rejected boolean")
    return out.select(F.col("id").alias(id_col), *[F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)],
                      "lang_pred", "score", "n_chars", "cross_entropy", "rejected")


def held_out(docs: DataFrame, id_col: str = "doc_id", fold: int = 2, folds: int = 4):
    """The fold by crc32 of the id as text (NULL: as empty text)."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % folds == fold


def filter_language(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` the model does not reject, with their columns,
    whatever their names. NULL texts and those without a letter go; a model
    without languages rejects all. NULL ids, ties and repeated rows are judged
    row by row, very long texts whole. Empty table: no rows. Only the text goes
    to Python, once, and only the verdict comes back."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        claim("langid", int)
        m = shared.value
        for texts in batches:
            out = [_judged(m, some)[-1] for some in _chunks(texts.to_pylist())]
            yield pa.array(np.concatenate(out or [np.zeros(0, bool)]))
    return docs.filter(~F.arrow_udf(judge, "boolean")(F.col(text_col)))
