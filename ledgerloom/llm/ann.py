"""Approximate nearest neighbours (10): a forest of random-projection trees.

Hyperplanes are fitted on a bounded sample; every vector is dealt to its leaf in
every tree. A query walks all trees through one shared priority queue (the
widest margin first) until it has its leaves; leaves and the queries that
visit them meet in one shuffle, in blocks, so neither a full leaf nor a popular
one lands whole in one task; each block ranks its candidates exactly, and the
best of all blocks are merged per query. Each query also ranks a small part
of the sample first, and blocks send on only what is no worse than its k-th.
Copies of a row are folded first, and wherever the best k are taken, they are
the best k ids.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

TREES = 8
LEAF = 256                  # rows a leaf aims at
SAMPLE = 16_384             # vectors the hyperplanes are fitted on (the bound)
PRUNE = 2_048               # of these, vectors of distinct ids that bound a query's k-th score from below
VISITS = 1.25               # leaves visited by a query, over all trees, per leaf of one tree
LEAST_VISITS = 16
BLOCK = 4_096               # rows, or queries, of a leaf in one group


def _matrix(column: pa.Array, dim: int | None) -> tuple[np.ndarray, np.ndarray]:
    """(vectors in double precision, places) of the valid rows of a list column:
    not NULL, of length ``dim`` (None: any one length), finite and not zero."""
    if len(column) == 0:
        return np.zeros((0, dim or 0)), np.zeros(0, int)
    lengths = np.array([-1 if x is None else x for x in pa.compute.list_value_length(column).to_pylist()])
    if dim is None:
        there = lengths[lengths > 0]
        dim = int(np.bincount(there).argmax()) if len(there) else 0
    at = np.flatnonzero((lengths == dim) & (dim > 0))
    if not len(at):
        return np.zeros((0, dim)), at
    flat = column.take(pa.array(at)).flatten().cast(pa.float64())
    x = flat.to_numpy(zero_copy_only=False).reshape(len(at), dim)       # NULL components become NaN
    ok = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
    return x[ok], at[ok]


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True) if len(x) else x


def cosines(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Cosines of pairs of rows, each summed in the same order wherever it is computed."""
    return (q * x).sum(axis=1) / (np.sqrt((q * q).sum(axis=1)) * np.sqrt((x * x).sum(axis=1)))


@dataclass
class Forest:
    """Complete binary trees: node i has children 2i+1 and 2i+2."""
    dim: int
    depth: int
    normals: np.ndarray         # [tree, node, dim]
    offsets: np.ndarray         # [tree, node]
    visits: int
    prune: np.ndarray           # sample vectors that bound scores
    prune_ids: np.ndarray

    @property
    def leaves(self) -> int:
        return 1 << self.depth

    def leaf_of(self, unit: np.ndarray, tree: int) -> np.ndarray:
        node = np.zeros(len(unit), np.int64)
        for _ in range(self.depth):
            side = np.einsum("ij,ij->i", unit, self.normals[tree][node]) > self.offsets[tree][node]
            node = 2 * node + 1 + side
        return node - (self.leaves - 1)

    def walk(self, unit: np.ndarray) -> list[tuple[int, int]]:
        """(tree, leaf) of the leaves one query visits: all trees share one
        queue; a node's priority is the least margin on the way to it."""
        margin = self.normals @ unit - self.offsets
        queue = [(-np.inf, t, 0) for t in range(len(margin))]
        heapq.heapify(queue)
        out = []
        while queue and len(out) < self.visits:
            cost, t, node = heapq.heappop(queue)
            while node < self.leaves - 1:
                m = margin[t, node]
                near, far = (2 * node + 2, 2 * node + 1) if m > 0 else (2 * node + 1, 2 * node + 2)
                heapq.heappush(queue, (max(cost, abs(m)), t, far))
                node = near
            out.append((t, node - (self.leaves - 1)))
        return out


def fit(vectors: DataFrame, rows: int, id_col: str, vec_col: str, trees: int = TREES, leaf: int = LEAF,
        sample: int = SAMPLE, visits: float = VISITS, seed: int = 10) -> Forest | None:
    """Forest on about ``sample`` vectors chosen by a hash of the row; the sample
    is collected to the driver (16,384 vectors by default, 8 MB at 64
    dimensions). None without a valid vector."""
    share = min(1.0, sample / max(rows, 1))
    draw = F.pmod(F.xxhash64(F.lit("forest"), F.col(id_col), F.col(vec_col)), F.lit(1_000_000))
    got = vectors.filter(draw < int(share * 1_000_000) + 1).select(id_col, vec_col).limit(2 * sample).toArrow()
    column = got.column(vec_col).combine_chunks() if got.num_rows else pa.array([], pa.list_(pa.float64()))
    x, at = _matrix(column, None)
    if not len(x):
        return None
    ids = np.asarray(got.column(id_col).combine_chunks().take(pa.array(at)))
    order = np.lexsort((*x.T, ids))
    x, ids = x[order], ids[order]
    depth = 0
    while (rows >> (depth + 1)) >= leaf // 2 and (len(x) >> (depth + 1)) >= 16:
        depth += 1
    rng, unit = np.random.default_rng(seed), _unit(x)
    nodes, dim = (1 << depth) - 1, x.shape[1]
    normals = rng.normal(size=(trees, nodes, dim))
    normals /= np.linalg.norm(normals, axis=2, keepdims=True)
    offsets = np.zeros((trees, nodes))
    for t in range(trees):
        node = np.zeros(len(unit), np.int64)
        for level in range(depth):
            p = np.einsum("ij,ij->i", unit, normals[t][node])
            for k in range((1 << level) - 1, (1 << level + 1) - 1):
                if (node == k).any():
                    offsets[t, k] = np.median(p[node == k])
            node = 2 * node + 1 + (p > offsets[t][node])
    first = np.unique(ids, return_index=True)[1]            # one row an id: the k-th bounds k ids
    some = first[rng.permutation(len(first))[:PRUNE]]
    return Forest(dim, depth, normals, offsets, max(LEAST_VISITS, round(visits * (1 << depth))), x[some], ids[some])


def _packed(x: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in np.ascontiguousarray(x)], pa.binary())


def search(queries: DataFrame, vectors: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
           **options) -> DataFrame:
    """(query_id, rank from 1, id, score): for each query row the ``k`` rows of
    ``vectors`` with the largest cosine found, nearest first, ties to the
    smaller id; a row with the query's own id is no candidate.

    Vectors that are NULL, zero, hold NULL or non-finite components, or are of
    another length than most of the sample take no part, nor do NULL ids. Rows
    with one id count once, by the vector nearest to the query. Fewer than k candidates: all of them. Empty tables:
    no rows. Other columns are not read.
    """
    v = vectors.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"))
    q = queries.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"))
    v = written(v.distinct(), "vectors")
    kind = v.schema["id"].dataType.simpleString()
    rows, n_queries = v.count(), q.count()
    spark = vectors.sparkSession
    forest = fit(v, rows, "id", "vec", **options)
    schema = f"query_id {kind}, rank int, {id_col} {kind}, score double"
    if forest is None:
        return spark.createDataFrame([], schema)
    shared = spark.sparkContext.broadcast(forest)
    trees = len(forest.normals)
    per_leaf = n_queries * min(forest.visits, trees * forest.leaves) / (trees * forest.leaves)
    query_blocks = max(1, -(-int(per_leaf) // BLOCK))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = shared.value
        for batch in batches:
            x, at = _matrix(batch.column(1), f.dim)
            unit, ids, packed = _unit(x), batch.column(0).take(pa.array(at, pa.int64())), _packed(x)
            for t in range(trees):
                leaf = f.leaf_of(unit, t)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), t, np.int32)), pa.array(leaf.astype(np.int32)),
                                                  ids, packed], ["tree", "leaf", "id", "vec"])

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The best k of the prune sample: candidates that every query starts with."""
        f = shared.value
        for batch in batches:
            x, at = _matrix(batch.column(1), f.dim)
            ids = batch.column(0).take(pa.array(at, pa.int64()))
            for n, own in enumerate(np.asarray(ids)):
                s = cosines(x[n][None, :], f.prune)
                other = np.flatnonzero(f.prune_ids != own)
                top = other[np.lexsort((f.prune_ids[other], -s[other]))[:k]]
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(np.full(len(top), n))), pa.array(f.prune_ids[top], ids.type), pa.array(s[top])],
                    ["query_id", "id", "score"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = shared.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                some = batch.slice(lo, 64)
                x, at = _matrix(some.column(1), f.dim)
                unit, ids = _unit(x), some.column(0).take(pa.array(at, pa.int64()))
                known = np.asarray(ids)
                s = unit @ _unit(f.prune).T
                s[known[:, None] == f.prune_ids[None, :]] = -np.inf
                bound = np.sort(s, axis=1)[:, -k] if s.shape[1] >= k else np.full(len(x), -np.inf)
                where = [f.walk(u) for u in unit]
                take = np.repeat(np.arange(len(x)), [len(w) for w in where])
                tree, leaf = np.array([p for w in where for p in w], np.int32).reshape(-1, 2).T
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tree), pa.array(leaf), ids.take(pa.array(take)), _packed(x).take(pa.array(take)),
                     pa.array(bound[take])], ["tree", "leaf", "id", "vec", "bound"])

    asked = q.mapInArrow(ask, f"tree int, leaf int, id {kind}, vec binary, bound double")
    dealt = v.mapInArrow(deal, f"tree int, leaf int, id {kind}, vec binary")
    # Leaves are as full as the sample foretold unless vectors repeat: count them, a row per leaf.
    sizes = dealt.groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("rows"))
    sizes = written(sizes.select("tree", "leaf", F.ceil(F.col("rows") / F.lit(BLOCK)).cast("int").alias("blocks")), "leaf-sizes")
    keys = ["tree", "leaf", "block", "part"]
    dealt = dealt.join(F.broadcast(sizes), ["tree", "leaf"]).select(
        "tree", "leaf", F.pmod(F.xxhash64("id", "vec"), "blocks").cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("part"), "id", "vec")
    asked = asked.join(F.broadcast(sizes), ["tree", "leaf"]).select(
        "tree", "leaf", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.pmod(F.xxhash64("id"), F.lit(query_blocks)).cast("int").alias("part"), "id", "vec", "bound")

    def rank(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            none = pa.array([], left.schema.field("id").type)
            return pa.table({"query_id": none, "id": none, "score": pa.array([], pa.float64())})

        def rows_of(t):
            return np.array([np.frombuffer(b.as_buffer(), np.float64) for b in t.column("vec")])

        ids, x = np.asarray(left.column("id")), rows_of(left)
        asks, y, bound = np.asarray(right.column("id")), rows_of(right), np.asarray(right.column("bound"))
        s = _unit(y) @ _unit(x).T
        s[asks[:, None] == ids[None, :]] = -np.inf
        names, name = np.unique(ids, return_inverse=True)
        per_id = s
        if len(names) < len(ids):                           # an id with several vectors counts by its nearest
            by = np.argsort(name, kind="stable")
            per_id = np.maximum.reduceat(s[:, by], np.searchsorted(name[by], np.arange(len(names))), axis=1)
        if len(names) > k:
            bound = np.maximum(bound, -np.partition(-per_id, k - 1, axis=1)[:, k - 1])
        i, j = np.nonzero((s >= bound[:, None] - 1e-9) & np.isfinite(s))
        exact = cosines(y[i], x[j])
        order = np.lexsort((ids[j], -exact, i))             # a query's best k here, ties to the smaller id
        i, j, exact = i[order], j[order], exact[order]
        if len(names) < len(ids):
            first = np.sort(np.unique(i * len(names) + name[j], return_index=True)[1])
            i, j, exact = i[first], j[first], exact[first]
        place = np.arange(len(i)) - np.searchsorted(i, i)
        top = place < k
        return pa.table({"query_id": right.column("id").take(pa.array(i[top])),
                         "id": left.column("id").take(pa.array(j[top])), "score": pa.array(exact[top])})

    scored = f"query_id {kind}, id {kind}, score double"
    found = dealt.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(rank, scored).union(
        q.mapInArrow(sampled, scored))
    best = found.groupBy("query_id", "id").agg(F.max("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("id")))
    return best.withColumn("rank", place.cast("int")).filter(F.col("rank") <= k).select(
        "query_id", "rank", F.col("id").alias(id_col), "score")


def exact(queries: DataFrame, vectors: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
          block: int = 1024) -> DataFrame:
    """The same result by brute force, for measuring recall: all vectors, in
    blocks, against a query set small enough to be broadcast."""
    got = queries.select(id_col, vec_col).toArrow()
    y, at = _matrix(got.column(vec_col).combine_chunks(), None)
    asks = np.asarray(got.column(id_col).combine_chunks().take(pa.array(at)))
    shared = queries.sparkSession.sparkContext.broadcast((y, asks))
    kind = vectors.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        y, asks = shared.value
        for batch in batches:
            for lo in range(0, batch.num_rows, block):
                some = batch.slice(lo, block)
                x, at = _matrix(some.column(1), y.shape[1])
                ids = np.asarray(some.column(0).take(pa.array(at, pa.int64())))
                for n in range(len(y)):
                    s = cosines(y[n][None, :], x)
                    s[ids == asks[n]] = -np.inf
                    top = np.lexsort((ids, -s))
                    top = top[np.sort(np.unique(ids[top], return_index=True)[1])[:k]]
                    top = top[np.isfinite(s[top])]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(top), asks[n])), pa.array(ids[top]),
                                                      pa.array(s[top])], ["query_id", "id", "score"])

    found = vectors.select(id_col, vec_col).mapInArrow(run, f"query_id {kind}, id {kind}, score double") \
        .groupBy("query_id", "id").agg(F.max("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("id")))
    return found.withColumn("rank", place.cast("int")).filter(F.col("rank") <= k).select(
        "query_id", "rank", F.col("id").alias(id_col), "score")
