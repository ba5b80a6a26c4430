"""Ranked lexical search (12): range-maximum tables and best-first intervals.

Index: documents are cut into shards in reading order (at most ``SHARD_DOCS``
documents or ``SHARD_TERMS`` terms, one document at least). A shard is one row:
its documents by id, their lengths, its terms and, term by term, the posting
list (place of the document in the shard, occurrences). The index does not
depend on queries; it is written to the shared folder.

Search: numbers over all shards (documents, terms, document frequencies) give
each term's weight and each posting's impact. In a shard the posting lists of
the queries' terms stand one after another, with one sparse table over them:
level j has, at place i, the place of the greatest impact among i .. i+2^j-1,
so two entries answer any range of one list. For a query, an interval of
documents is bounded by the sum over its terms of weight x greatest impact in
the interval. Intervals leave a priority queue in order of their bounds; one
that cannot reach the k-th score found so far ends the shard. Else it is split
at the document that holds the greatest single contribution: that document is
scored, and the intervals on both sides are bounded anew. Intervals of few
documents or postings are scored outright, and so are the rest when splits
have been many for the shard's size (many equal maxima), which keeps the work
linear in the postings. The k best carry over from shard to shard of a task,
so later shards are cut off earlier; the tasks' k best per query are ranked in
two steps.
"""

from __future__ import annotations

import heapq
import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import written

SHARD_DOCS = 4096               # below 1 << 16, as places are kept in 16 bits
SHARD_TERMS = 1 << 20           # terms with repeats
LEAF_DOCS, LEAF_POSTINGS = 64, 512
BLOCK_CHARS = 2 << 20           # characters of query texts handled at once
SCALE = 1_000_000_000
SALTS = 32

_FOLD = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()

INDEX = ("n_docs int, total long, doc_ids array<long>, lengths array<long>, terms array<binary>, df array<int>, "
         "places binary, tfs binary")


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a text: runs of ASCII letters, digits and non-ASCII
    characters, A-Z in lower case; none for NULL."""
    return (text or b"").translate(_FOLD).split()


# ---- index -----------------------------------------------------------------

class _Shard:
    def __init__(self):
        self.number = defaultdict()                 # term -> its number in the shard
        self.number.default_factory = self.number.__len__
        self.ids, self.lengths, self.held, self.counts, self.total = [], [], [], [], 0

    def add(self, doc_id, words: list[bytes]) -> None:
        found, counts = np.unique(np.fromiter(map(self.number.__getitem__, words), np.int32, len(words)),
                                  return_counts=True)
        self.ids.append(doc_id)
        self.lengths.append(len(words))
        self.held.append(found)
        self.counts.append(counts)
        self.total += len(words)

    def full(self) -> bool:
        return len(self.ids) >= SHARD_DOCS or self.total >= SHARD_TERMS

    def row(self) -> pa.RecordBatch:
        order = sorted(range(len(self.ids)), key=lambda i: (self.ids[i] is None, self.ids[i] or 0))
        held = np.concatenate([self.held[i] for i in order])
        counts = np.concatenate([self.counts[i] for i in order])
        place = np.repeat(np.arange(len(order)), [len(self.held[i]) for i in order])
        by_term = np.argsort(held, kind="stable")   # within a term by place
        cols = [[len(order)], [self.total], [[self.ids[i] for i in order]], [[self.lengths[i] for i in order]],
                [list(self.number)], [np.bincount(held, minlength=len(self.number)).astype(np.int32)],
                [place[by_term].astype("<u2").tobytes()], [counts[by_term].astype("<u4").tobytes()]]
        kinds = [pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.binary()),
                 pa.list_(pa.int32()), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                          [c.split()[0] for c in INDEX.split(", ")])


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The shards of ``docs``, written and read back. Documents without a term
    (NULL, empty or only other characters) are left out. Ids are integers;
    NULL ids come last in ties; rows with one id are documents of their own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = _Shard()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = terms(text.as_py())
                if words:
                    shard.add(doc_id, words)
                    if shard.full():
                        yield shard.row()
                        shard = _Shard()
        if shard.ids:
            yield shard.row()

    kept = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return written(kept.mapInArrow(run, INDEX), "lexical-index")


# ---- one shard -------------------------------------------------------------

class Best:
    """The k best (score, document) of a query: higher scores first, then
    smaller ids, NULL ids last."""

    def __init__(self, k: int):
        self.k, self.heap = k, []                   # least wanted on top

    def offer(self, score: int, doc_id: int | None) -> None:
        entry = (score, doc_id is not None, -(doc_id or 0))
        if len(self.heap) < self.k:
            heapq.heappush(self.heap, entry)
        elif entry > self.heap[0]:
            heapq.heapreplace(self.heap, entry)

    def least(self) -> int:
        """A score below this cannot enter."""
        return self.heap[0][0] if len(self.heap) == self.k else 1

    def entries(self) -> list[tuple[int, int | None]]:
        return [(s, -minus if known else None) for s, known, minus in sorted(self.heap, reverse=True)]


class Postings:
    """The posting lists of some terms in one shard, one after another, with
    impacts and the sparse table of their maxima."""

    def __init__(self, ids: list, lists: list[np.ndarray], tfs: list[np.ndarray], length_part: np.ndarray):
        self.ids, self.n = ids, len(ids)
        self.doc = np.concatenate(lists).astype(np.int64)
        tf = np.concatenate(tfs).astype(np.int64)
        self.impact = (SCALE * tf) // (1000 * tf + 8 * length_part[self.doc])
        sizes = np.array([len(x) for x in lists], np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.key = np.repeat(np.arange(len(lists)), sizes) * self.n + self.doc      # ascending
        self.level_of = np.zeros(int(sizes.max()) + 1, np.int64)                   # floor(log2(length))
        for j in range(1, int(sizes.max()).bit_length()):
            self.level_of[1 << j:] = j
        table = [np.arange(len(self.doc), dtype=np.int32)]
        for j in range(int(self.level_of[-1])):     # ranges over a list's end are never asked for
            a = table[-1]
            b = np.concatenate((a[1 << j:], a[-1:].repeat(min(1 << j, len(a)))))
            table.append(np.where(self.impact[a] >= self.impact[b], a, b))
        self.table = np.stack(table)

    def greatest(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Place of the greatest impact in each range a .. b-1 (none empty)."""
        j = self.level_of[b - a]
        x, y = self.table[j, a], self.table[j, b - (1 << j)]
        return np.where(self.impact[x] >= self.impact[y], x, y)

    def search(self, slots: np.ndarray, weights: np.ndarray, best: Best) -> int:
        """Offer every document that may be among the best for the terms at
        ``slots``; returns how many documents were scored."""
        waiting, scored, splits, number = [], 0, 4 * self.n // LEAF_DOCS + 8, 0

        def push(lo: int, hi: int, slots, weights, a, b) -> None:
            nonlocal number
            some = a < b
            if not some.any():
                return
            if not some.all():
                slots, weights, a, b = slots[some], weights[some], a[some], b[some]
            top = self.greatest(a, b)
            parts = weights * self.impact[top]
            bound = int(parts.sum())
            if bound >= best.least():
                number += 1
                heapq.heappush(waiting, (-bound, number, lo, hi, slots, weights, a, b, int(top[parts.argmax()])))

        push(0, self.n, slots, weights, self.starts[slots], self.ends[slots])
        while waiting:
            minus, _, lo, hi, slots, weights, a, b, top = heapq.heappop(waiting)
            if -minus < best.least():
                break
            if hi - lo <= LEAF_DOCS or int((b - a).sum()) <= LEAF_POSTINGS or not splits:
                scored += self._score_all(lo, hi, weights, a, b, best)
                continue
            splits -= 1
            d = int(self.doc[top])
            at = np.searchsorted(self.key, slots * self.n + d)                      # first posting from d on
            holds = (at < b) & (self.doc[np.minimum(at, len(self.doc) - 1)] == d)
            best.offer(int((weights[holds] * self.impact[at[holds]]).sum()), self.ids[d])
            scored += 1
            push(lo, d, slots, weights, a, at)
            push(d + 1, hi, slots, weights, at + holds, b)
        return scored

    def _score_all(self, lo: int, hi: int, weights, a, b, best: Best) -> int:
        sizes = b - a
        before = np.cumsum(sizes) - sizes
        at = np.arange(int(sizes.sum())) + np.repeat(a - before, sizes)
        score = np.zeros(hi - lo, np.int64)
        np.add.at(score, self.doc[at] - lo, np.repeat(weights, sizes) * self.impact[at])
        for i in np.argsort(-score, kind="stable")[:best.k].tolist():               # ties: smaller ids first
            if score[i] < best.least():
                break
            best.offer(int(score[i]), self.ids[lo + i])
        return hi - lo


# ---- search ----------------------------------------------------------------

def _document_frequencies(index: DataFrame, known: list[bytes]) -> dict[int, int]:
    """Documents that hold each of the block's terms; reads two columns."""
    wanted = index.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value_set, sums = pa.array(wanted.value, pa.binary()), np.zeros(len(wanted.value), np.int64)
        for batch in batches:
            at = pc.index_in(batch.column(0).flatten(), value_set=value_set)
            hit = np.asarray(at.is_valid())
            np.add.at(sums, np.asarray(at.drop_null()), np.asarray(batch.column(1).flatten())[hit])
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(sums[some])], ["term", "df"])

    rows = index.select("terms", "df").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    return {r["term"]: r["df"] for r in rows.collect()}             # at most the terms of one block of queries


def _search_block(index: DataFrame, queries: list[list[bytes]], n: int, total: int, k: int) -> DataFrame:
    """(query, score, doc_id): every task's k best for each query of a block."""
    known = sorted({t for q in queries for t in q})
    df = _document_frequencies(index, known)
    weight = {i: math.floor(1000 * math.log((2 * n + 2) / (2 * c + 1))) for i, c in df.items()}
    number = {t: i for i, t in enumerate(known)}
    asked = [sorted(number[t] for t in q if weight.get(number[t], 0) > 0) for q in queries]
    task = index.sparkSession.sparkContext.broadcast((known, weight, asked))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, weight, asked = task.value
        value_set = pa.array(known, pa.binary())
        best = [Best(k) for _ in asked]
        weights = np.array([weight.get(i, 0) for i in range(len(known))], np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                ids, lengths, held, counts, places, tfs = (batch.column(c)[row] for c in range(6))
                at = pc.index_in(held.values, value_set=value_set)
                hit = np.flatnonzero(np.asarray(at.is_valid()))
                if not hit.size:
                    continue
                ends = np.cumsum(np.asarray(counts.values), dtype=np.int64)
                starts = ends - np.asarray(counts.values)
                place, tf = np.frombuffer(places.as_py(), "<u2"), np.frombuffer(tfs.as_py(), "<u4")
                part = 10 + (90 * np.asarray(lengths.values) * n) // total
                shard = Postings(ids.as_py(), [place[starts[i]:ends[i]] for i in hit],
                                 [tf[starts[i]:ends[i]] for i in hit], part)
                slot = np.full(len(known), -1)
                slot[np.asarray(at.drop_null())] = np.arange(len(hit))
                for q, own in enumerate(asked):
                    slots = slot[own]
                    if (there := slots >= 0).any():
                        slots, w = slots[there], weights[own][there]
                        order = np.argsort(slots)
                        shard.search(slots[order], w[order], best[q])
        rows = [(q, s, d) for q, b in enumerate(best) for s, d in b.entries()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[c] for r in rows], pa.int64()) for c in range(3)], ["query", "score", "doc_id"])

    return index.select("doc_ids", "lengths", "terms", "df", "places", "tfs").mapInArrow(
        run, "query long, score long, doc_id long")


def search(index: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "item_id",
           text_col: str = "text") -> DataFrame:
    """(id, rank, doc_id, score): the k highest-scoring documents of each row
    of ``queries`` with a score above 0, ties to smaller ids, NULL ids last.

    Every query row is ranked by itself, also if its id is NULL or repeats;
    one without a term, or whose terms no document holds, gives no row. Its
    terms count once each. Queries are taken in blocks of about ``BLOCK_CHARS``
    characters, so what is broadcast does not grow with their number. Empty
    index or no queries: no rows. Other columns are not read.
    """
    spark: SparkSession = index.sparkSession
    n, total = index.agg(F.sum("n_docs"), F.sum("total")).first()
    asked = queries.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    chars, rows = asked.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)), F.count(F.lit(1))).first()
    kind = asked.schema["id"].dataType.simpleString()
    out_schema = f"id {kind}, rank int, doc_id long, score long"
    if not n or not rows:
        return spark.createDataFrame([], out_schema).withColumnRenamed("id", id_col)
    blocks = -(-chars // BLOCK_CHARS)
    numbered = written(asked.withColumns({
        "row": F.monotonically_increasing_id(),
        "block": F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(max(blocks, 1)))}), "lexical-queries")
    found = None
    for block in range(max(blocks, 1)):
        own = numbered.filter(F.col("block") == block).select("row", "text").collect()     # one block's texts
        some = _search_block(index, [sorted(set(terms(r["text"]))) for r in own], n, total, k)
        rows_of = spark.createDataFrame([(i, r["row"]) for i, r in enumerate(own)], "query long, row long")
        some = some.join(F.broadcast(rows_of), "query").drop("query")
        found = some if found is None else found.unionByName(some)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    best = found.withColumn("salt", F.pmod(F.xxhash64("doc_id", F.spark_partition_id()), F.lit(SALTS)))
    for keys in (["row", "salt"], ["row"]):
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= k)
    return best.join(numbered.select("row", "id"), "row").select(F.col("id").alias(id_col), "rank", "doc_id", "score")
