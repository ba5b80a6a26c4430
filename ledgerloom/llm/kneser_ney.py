"""Language-model scoring (6): interpolated modified Kneser-Ney bigrams.

Counting, in Spark: each task folds its texts' bigrams, a few million tokens
at a time, and sends the distinct ones to shards by a hash of the pair, so a
frequent word is spread over all shards; each shard adds up its pairs and
writes sorted hash arrays (pair hash, count) to the shared folder. What the
shards know of each word (its count, the distinct words before it, how many
different words follow it once, twice, more often) is summed up the same way
into sorted word arrays. Only one manifest row per shard and the counts of
counts reach the driver. The model grows with the corpus; nothing is pruned.

Scoring: workers map the arrays into memory (page cache, not heap) and look
up whole batches in sorted order; texts are not shuffled.

Probability of w after h, with c counts, N1+ numbers of distinct neighbours:
  p(w|h) = (c(hw) - D(c(hw))) / c(h) + g(h) * p(w),
  p(w)   = (N1+(.w) - D'(N1+(.w))) / N1+(..) + g' / (V + 1),
where g and g' are what the discounts free; after an unseen h, p(w).
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import claim, give_back, shared_folder, written
from .langid import discounts
from .minhash import WordHashes, _splitmix

_U = np.uint64
START, END = _U(0x5354415254), _U(0x454E44)     # hashes of the text's start and end
FOLD_TOKENS = 1_000_000         # tokens a task folds at once
SHARD_BYTES = 24 << 20          # bytes of text a shard
SCORE_TOKENS = 400_000          # tokens looked up at once
FULL = 255                      # counts from here on stand in a list of their own
_WORDS = WordHashes()


def _claim(keep_words: bool = False) -> None:
    """At the start and end of a task: other operators' caches, this one's
    words where they are not needed, and freed memory go."""
    claim("kneser_ney", _WORDS.clear)
    if not keep_words:
        _WORDS.clear()
    give_back()


def token_hashes(text: bytes | None) -> np.ndarray:
    """Hashes of the words (A-Z in lower case) and of the end."""
    words = (text or b"").lower().split()
    out = np.empty(len(words) + 1, np.uint64)
    out[:-1] = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    out[-1] = END
    return out


def _joined(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(word before, word) of every token of the texts."""
    after = np.concatenate(parts)
    before = np.empty_like(after)
    before[1:] = after[:-1]
    before[np.concatenate(([0], np.cumsum([len(p) for p in parts])[:-1]))] = START
    return before, after


def pair_hash(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    return _splitmix(before * _U(0x9E3779B97F4A7C15) + _splitmix(after + _U(0x632BE59BD9B4E019)))


def _range_of(key: np.ndarray, shards: int) -> np.ndarray:
    """Shard of a hash: equal ranges of the upper 32 bits, so shards are in key order."""
    return (((key >> _U(32)) * _U(shards)) >> _U(32)).astype(np.int32)


def _sums(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted distinct keys and the sums of their values."""
    if not len(key):
        return (key, *(np.zeros(0, np.int64) for _ in values))
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return (key[first], *(np.add.reduceat(v[order].astype(np.int64), first) for v in values))


def _planes(a: np.ndarray) -> bytes:
    """An array byte plane by byte plane: the upper planes of small numbers are
    zeros, which the shuffle's compression removes."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()


def _from_planes(raw, kind, n: int, at: int = 0) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n).T).view(kind).ravel()


def _steps(a: np.ndarray) -> np.ndarray:
    """Differences of a sorted unsigned array, the first from zero."""
    return np.diff(a, prepend=a.dtype.type(0))


def _open(uri: str):
    """(file system, path) of a folder of the shared storage."""
    from pyarrow import fs
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def _save(folder: str, arrays: dict[str, np.ndarray]) -> str:
    """Write arrays to the shared folder under a name no other attempt uses."""
    store, path = _open(folder)
    store.create_dir(path, recursive=True)
    name = uuid.uuid4().hex
    for part, a in arrays.items():
        with store.open_output_stream(f"{path}/{name}.{part}") as out:
            out.write(np.ascontiguousarray(a).data)
    return name


def _map(folder: str, name: str, part: str, kind, own: str) -> np.ndarray:
    """Map a shard's array into memory; from storage that is not mounted the
    file is first fetched to the worker's own folder ``own``."""
    from pyarrow import fs
    store, path = _open(folder)
    file = f"{path}/{name}.{part}"
    if not isinstance(store, fs.LocalFileSystem):
        local = os.path.join(own, f"{name}.{part}")
        fs.copy_files(file, local, source_filesystem=store, destination_filesystem=fs.LocalFileSystem())
        file = local
    if not os.path.getsize(file):
        return np.zeros(0, kind)
    return np.asarray(np.memmap(file, kind, "r"))


#: A word's count may pass 2^32 in one shard; its distinct neighbours there cannot, as each is a pair of the shard.
COUNT_KINDS = (np.uint64, *[np.uint32] * 4)
WORD_PARTS = (("words", np.uint64), ("c", np.uint64), ("before", np.uint32), ("once", np.uint32),
              ("twice", np.uint32), ("more", np.uint32))


@dataclass
class Model:
    """Manifest of the arrays and the corpus-wide numbers; a row per shard."""
    folder: str
    shards: int
    pairs: dict[int, str] = field(default_factory=dict)
    words: dict[int, str] = field(default_factory=dict)
    tokens: int = 0             # N
    vocabulary: int = 0         # V
    kinds: int = 0              # N1+(..), distinct pairs
    cut: np.ndarray | None = None           # discounts of pairs
    cut_low: np.ndarray | None = None       # discounts of N1+(.w)
    left_low: float = 1.0                   # g'


def train(docs: DataFrame, shards: int | None = None, text_col: str = "text") -> Model:
    """Count the whole texts of ``docs`` and write the model to the shared folder.

    NULL or empty texts count as an end. Repeated rows count again. Without
    rows the model gives every token probability 1 / (0 + 1)."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "kneser-ney")
    d = docs.select(F.col(text_col).cast("binary").alias("text"))
    if shards is None:
        size = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        shards = max(8, -(-size // SHARD_BYTES))
    model = Model(folder, shards)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[np.ndarray] = []
        held = 0

        def flush():
            before, after = _joined(parts)
            key = pair_hash(before, after)
            _, at, c = np.unique(key, return_index=True, return_counts=True)
            key, before, after = key[at], before[at], after[at]     # in key order, so in shard order
            edges = np.searchsorted(_range_of(key, shards), np.arange(shards + 1))
            for s in range(shards):
                lo, hi = edges[s], edges[s + 1]
                if lo == hi:
                    continue
                known, place = np.unique(np.concatenate((before[lo:hi], after[lo:hi])), return_inverse=True)
                place = place.astype(np.uint32)
                b, a = place[:hi - lo], place[hi - lo:]
                order = np.argsort(b, kind="stable")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s], pa.int32()), *(pa.array([_planes(x)], pa.binary()) for x in (
                        _steps(known), _steps(b[order]), a[order], c[lo:hi].astype(np.uint32)[order]))],
                    ["shard", "words", "before", "after", "c"])

        _claim(keep_words=True)
        for batch in batches:
            for text in batch.column(0):
                h = token_hashes(text.as_py())
                parts.append(h)
                held += len(h)
                if held >= FOLD_TOKENS:
                    yield from flush()
                    parts, held = [], 0
        if parts:
            yield from flush()
        parts = []
        _claim(keep_words=True)

    folded = d.mapInArrow(fold, "shard int, words binary, before binary, after binary, c binary")

    def buf(x, kind):
        raw = x.as_buffer()
        return _from_planes(raw, kind, raw.size // np.dtype(kind).itemsize)

    def add_pairs(group: pa.Table) -> pa.Table:
        _claim()
        sizes = [x.as_buffer().size // 4 for x in group.column("c")]
        before, after = (np.empty(sum(sizes), np.uint64) for _ in range(2))
        c, at = np.empty(sum(sizes), np.uint32), 0
        for size, words, b, a, n in zip(sizes, *(group.column(i) for i in range(1, 5)), strict=True):
            known = np.cumsum(buf(words, np.uint64), dtype=np.uint64)
            before[at:at + size] = known[np.cumsum(buf(b, np.uint32), dtype=np.uint32)]
            after[at:at + size] = known[buf(a, np.uint32)]
            c[at:at + size] = buf(n, np.uint32)
            at += size
        key = pair_hash(before, after)
        order = np.argsort(key)
        key = key[order]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        c = np.add.reduceat(c[order].astype(np.uint64), first)
        key, order = key[first], order[first]
        before, after = before[order], after[order]
        del order, first
        big = np.flatnonzero(c >= FULL)
        name = _save(folder, {"keys": key, "small": np.minimum(c, FULL).astype(np.uint8),
                              "place": big.astype(np.uint64), "count": c[big]})
        freq, kinds = np.bincount(np.minimum(c, 5).astype(np.int64), minlength=6)[1:5], len(key)
        del key
        # What this shard knows of each word, dealt to the word shards: its
        # count and the distinct words before it; how many follow it once, twice, more often.
        w, place = np.unique(np.concatenate((after, before)), return_inverse=True)
        a, b = place[:len(after)], place[len(after):]
        del before, after, place
        cols = [np.bincount(a, c, len(w)), np.bincount(a, minlength=len(w)),
                *(np.bincount(b[some], minlength=len(w)) for some in (c == 1, c == 2, c > 2))]
        edges = np.searchsorted(_range_of(w, shards), np.arange(shards + 1))
        rows = [(-1, name, int(group.column("shard")[0].as_py()), *map(int, freq), kinds, None)]
        for s in range(shards):
            lo, hi = edges[s], edges[s + 1]
            if lo < hi:
                blob = b"".join([_planes(_steps(w[lo:hi])), *(_planes(x[lo:hi].astype(k)) for x, k in zip(cols, COUNT_KINDS, strict=True))])
                rows.append((s, None, 0, 0, 0, 0, 0, int(hi - lo), blob))
        return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (
            pa.int32(), pa.string(), pa.int32(), *[pa.int64()] * 5, pa.binary()), strict=True)],
            names=["word_shard", "name", "shard", "n1", "n2", "n3", "n4", "n", "blob"])

    counted = written(folded.groupBy("shard").applyInArrow(
        add_pairs, "word_shard int, name string, shard int, n1 long, n2 long, n3 long, n4 long, n long, blob binary"),
        "pair-counts")
    freq = np.zeros(6, np.int64)
    for r in counted.filter("word_shard = -1").select("name", "shard", "n1", "n2", "n3", "n4", "n").collect():
        model.pairs[r["shard"]] = r["name"]
        freq[1:5] += np.array([r["n1"], r["n2"], r["n3"], r["n4"]])
        model.kinds += r["n"]

    def add_words(group: pa.Table) -> pa.Table:
        _claim()
        w, cols = [], [[] for _ in range(5)]
        for n, blob in zip(group.column("n").to_pylist(), group.column("blob"), strict=True):
            raw = blob.as_buffer()
            w.append(np.cumsum(_from_planes(raw, np.uint64, n), dtype=np.uint64))
            at = 8 * n
            for col, kind in zip(cols, COUNT_KINDS, strict=True):
                col.append(_from_planes(raw, kind, n, at))
                at += n * np.dtype(kind).itemsize
        w, *cols = _sums(np.concatenate(w), *map(np.concatenate, cols))
        name = _save(folder, {part: x.astype(kind) for (part, kind), x in zip(WORD_PARTS, (w, *cols), strict=True)})
        seen = cols[1][cols[1] > 0]
        low = np.bincount(np.minimum(seen, 5), minlength=6)[1:6]
        return pa.table({"shard": pa.array([group.column("word_shard")[0].as_py()], pa.int32()), "name": [name],
                         "tokens": [int(cols[0].sum())], "v": [int((cols[0] > 0).sum())],
                         **{f"n{i + 1}": [int(x)] for i, x in enumerate(low)}})

    found = written(counted.filter("word_shard >= 0").select("word_shard", "n", "blob").groupBy("word_shard").applyInArrow(
        add_words, "shard int, name string, tokens long, v long, n1 long, n2 long, n3 long, n4 long, n5 long"), "word-counts")
    low = np.zeros(6, np.int64)
    for r in found.collect():
        model.words[r["shard"]] = r["name"]
        model.tokens += r["tokens"]
        model.vocabulary += r["v"]
        low[1:] += np.array([r[f"n{i}"] for i in range(1, 6)])
    model.cut, model.cut_low = discounts(freq), discounts(low)
    if model.kinds:
        freed = low[1] * model.cut_low[1] + low[2] * model.cut_low[2] + low[3:].sum() * model.cut_low[3]
        model.left_low = float(freed) / model.kinds
    return model


class Arrays:
    """The model's arrays as a worker process sees them."""

    def __init__(self, model: Model):
        self.model = model
        self.own = tempfile.mkdtemp(prefix="kneser-ney-")       # stays empty where the shared folder is mounted
        self.pairs: dict[int, tuple] = {}
        self.words: dict[int, tuple] = {}

    def close(self) -> None:
        self.pairs.clear()
        self.words.clear()
        shutil.rmtree(self.own, ignore_errors=True)

    def _each(self, keys: np.ndarray) -> Iterator[tuple[int, int, int]]:
        edges = np.searchsorted(_range_of(keys, self.model.shards), np.arange(self.model.shards + 1))
        for s in np.flatnonzero(np.diff(edges)):
            yield int(s), int(edges[s]), int(edges[s + 1])

    def pair_counts(self, keys: np.ndarray) -> np.ndarray:
        """Counts of sorted distinct pair hashes (0: unseen)."""
        out = np.zeros(len(keys), np.float64)
        for s, lo, hi in self._each(keys):
            if s not in self.model.pairs:
                continue
            if s not in self.pairs:
                self.pairs[s] = tuple(_map(self.model.folder, self.model.pairs[s], p, k, self.own) for p, k in (
                    ("keys", np.uint64), ("small", np.uint8), ("place", np.uint64), ("count", np.uint64)))
            have, small, place, count = self.pairs[s]
            at = np.minimum(np.searchsorted(have, keys[lo:hi]), len(have) - 1)
            c = np.where(have[at] == keys[lo:hi], small[at], 0).astype(np.float64)
            big = np.flatnonzero(c == FULL)
            if len(big):
                c[big] = count[np.searchsorted(place, at[big].astype(np.uint64))]
            out[lo:hi] = c
        return out

    def word_stats(self, words: np.ndarray) -> np.ndarray:
        """[5, word]: c, distinct words before, words that follow once, twice, more often."""
        out = np.zeros((5, len(words)))
        for s, lo, hi in self._each(words):
            if s not in self.model.words:
                continue
            if s not in self.words:
                self.words[s] = tuple(_map(self.model.folder, self.model.words[s], p, k, self.own) for p, k in WORD_PARTS)
            have, *cols = self.words[s]
            at = np.minimum(np.searchsorted(have, words[lo:hi]), len(have) - 1)
            hit = have[at] == words[lo:hi]
            for i, col in enumerate(cols):
                out[i, lo:hi] = np.where(hit, col[at], 0)
        return out

    def score(self, parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: known tokens, base score and model score (log10)."""
        m = self.model
        before, after = _joined(parts)
        words, place = np.unique(np.concatenate((before, after)), return_inverse=True)
        b, a = place[:len(before)], place[len(before):]
        c, distinct, once, twice, more = self.word_stats(words)
        # Each word's occurrences are followed by one token; the start is followed once a text.
        ends = np.searchsorted(words, END)
        follows = np.where(words == START, c[ends] if ends < len(words) else 0, np.where(words == END, 0, c))
        d, low = m.cut, m.cut_low
        p1 = np.maximum(distinct - low[np.minimum(distinct, 3).astype(int)], 0) / max(m.kinds, 1)
        p1 += m.left_low / (m.vocabulary + 1)
        key, back = np.unique(pair_hash(before, after), return_inverse=True)
        n = self.pair_counts(key)[back]
        h = follows[b]
        with np.errstate(divide="ignore", invalid="ignore"):
            g = np.where(follows > 0, (d[1] * once + d[2] * twice + d[3] * more) / follows, 1.0)
            p = np.where(h > 0, np.maximum(n - d[np.minimum(n, 3).astype(int)], 0) / h, 0.0)
        p += g[b] * p1[a]
        base = np.log10((c[a] + 0.1) / (m.tokens + 0.1 * (m.vocabulary + 1)))
        starts = np.concatenate(([0], np.cumsum([len(x) for x in parts])[:-1]))
        return (np.add.reduceat((c[a] > 0).astype(np.int64), starts), np.add.reduceat(base, starts),
                np.add.reduceat(np.log10(p), starts))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score, perplexity) per row.

    A text's tokens are its words and one end, so NULL and empty texts have
    one. NULL ids and repeated rows give a row each; very long texts are
    scored whole. Empty table: no rows. Other columns are not read.
    perplexity = 10 ** (-score / n_tokens)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _claim(keep_words=True)
        arrays = Arrays(shared.value)
        try:
            for batch in batches:
                texts, done = batch.column(1).to_pylist(), 0
                while done < len(texts):
                    parts, held = [], 0
                    while done + len(parts) < len(texts) and held < SCORE_TOKENS:
                        parts.append(token_hashes(texts[done + len(parts)]))
                        held += len(parts[-1])
                    known, base, own = arrays.score(parts)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(done, len(parts)), pa.array([len(x) for x in parts], pa.int64()),
                         pa.array(known), pa.array(base), pa.array(own)], ["id", "n_tokens", "n_known", "base_score", "score"])
                    done += len(parts)
        finally:
            arrays.close()
            _claim(keep_words=True)

    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    out = d.mapInArrow(run, f"id {d.schema['id'].dataType.simpleString()}, n_tokens long, n_known long, "
                            "base_score double, score double")
    return out.select(F.col("id").alias(id_col), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
                      "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))


def held_out(id_col: str = "doc_id", folds: int = 10) -> Column:
    """The fold 0 by crc32 of the id as text (NULL: as empty text)."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % folds == 0
