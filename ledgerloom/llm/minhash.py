"""Near duplicates by b-bit MinHash (5).

1. One pass over the documents hashes each text's distinct shingles, takes
   ``BANDS * ROWS`` minima, hashes them band by band, keeps only the low
   ``BITS`` bits of each minimum packed into longs, and adds a 128-bit digest
   of the set. The texts are not shuffled.
2. Documents with equal sets are one class, represented by the least id.
3. Representatives that share a band meet in a bucket. Each bucket compares
   its members with its least id (a star, never all pairs): sizes must allow
   the similarity and the collision-corrected estimate (bit counts of the
   packed signatures) be within ``MARGIN`` of it. Buckets whose members are
   still apart are compared in blocks, by signature; each block passes on a
   forest, at most one pair per member. The components are the clusters.
4. The full shingle sets of clustered documents, read again, meet per cluster
   in blocks of bounded size; a search along exact links of the similarity
   asked for passes on its tree, at most one link per member.
5. Components of these confirmed links (``components.py``).

A pair with similarity s meets in no band with chance (1 - s**ROWS)**BANDS, 5e-7
at 0.8, and its estimate is more than ``MARGIN`` (five standard errors) low with
chance 3e-7; whatever meets is decided exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_rows, claim, written
from .components import components

BANDS, ROWS, BITS = 48, 6, 2
HASHES = BANDS * ROWS
PER_LONG = 64 // BITS
LONGS = HASHES // PER_LONG
MARGIN = 0.14
BLOCK = 1000                    # members of a bucket compared at once
BLOCK_SHINGLES = 200_000        # shingles of a cluster compared at once
_WORDS_KEPT = 500_000           # remembered word hashes per worker process
_U = np.uint64
_LOW = 0x5555555555555555       # the low bit of each 2-bit field


def _splitmix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class WordHashes(dict):
    """word -> 64-bit hash, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        import xxhash
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) >= _WORDS_KEPT:
            self.clear()
        if len(word) <= 64:
            self[word] = h
        return h


_WORDS = WordHashes()


def _claim() -> None:
    claim("minhash", _WORDS.clear)


def shingle_set(text: bytes | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's k-word shingles (A-Z in
    lower case); fewer than k words: the whole sequence as one."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    n = len(h) - k + 1
    if n < 1:
        k, n = len(h), 1
    s = np.full(n, k, np.uint64)
    for j in range(k):
        s = s * _U(0x9E3779B97F4A7C15) + h[j:j + n]
    return np.unique(_splitmix(s))


_MULTIPLIERS = (np.random.default_rng(5).integers(0, 1 << 32, HASHES, dtype=np.uint64) | _U(1)).astype(np.uint32)


def minima(s: np.ndarray) -> np.ndarray:
    """The least value of each of the hash functions over a set."""
    x = (s >> _U(32)).astype(np.uint32) ^ s.astype(np.uint32)
    low = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 2048):
        np.minimum(low, np.multiply.outer(_MULTIPLIERS, x[i:i + 2048]).min(axis=1), out=low)
    return low


def band_keys(low: np.ndarray) -> np.ndarray:
    rows = low.reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for j in range(ROWS):
        key = _splitmix(key * _U(0x9E3779B97F4A7C15) + rows[:, j])
    return key.view(np.int64)


def signature(low: np.ndarray) -> np.ndarray:
    """The low bits of each (mixed) minimum, packed into longs."""
    x = low * np.uint32(0x85EBCA6B)
    bits = ((x >> np.uint32(16)) & np.uint32((1 << BITS) - 1)).astype(np.uint64).reshape(LONGS, PER_LONG)
    return (bits << (np.arange(PER_LONG, dtype=np.uint64) * _U(BITS))).sum(axis=1, dtype=np.uint64).view(np.int64)


def estimate(different: Column) -> Column:
    """Similarity from the number of differing fields: of two different minima
    a share 2**-BITS agrees by chance."""
    c = 1.0 / (1 << BITS)
    return (1.0 - different / float(HASHES) - c) / (1.0 - c)


def _different(a: Column, b: Column) -> Column:
    fields = F.zip_with(a, b, lambda x, y: F.bit_count(
        (x.bitwiseXOR(y).bitwiseOR(F.shiftrightunsigned(x.bitwiseXOR(y), 1))).bitwiseAND(F.lit(_LOW))))
    return F.aggregate(fields, F.lit(0), lambda t, x: t + x)


def features(docs: DataFrame, k: int) -> DataFrame:
    """(id, n, hi, lo, bands, sig) per row, written; bands empty without words."""
    import xxhash

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _claim()
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                some = batch.slice(lo, 1024)
                n, digests, bands, sigs = [], [], [], []
                for text in some.column(1).cast(pa.binary()).to_pylist():
                    s = shingle_set(text, k)
                    n.append(len(s))
                    d = xxhash.xxh3_128_digest(s.tobytes())
                    digests.append((int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True)))
                    low = minima(s) if len(s) else None
                    bands.append(band_keys(low) if len(s) else [])
                    sigs.append(signature(low) if len(s) else [])
                hi, lo_ = zip(*digests, strict=True)
                longs = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(n, pa.int64()), pa.array(hi, pa.int64()), pa.array(lo_, pa.int64()),
                     pa.array(bands, longs), pa.array(sigs, longs)], ["id", "n", "hi", "lo", "bands", "sig"])

    kind = docs.schema["id"].dataType.simpleString()
    return written(docs.mapInArrow(
        run, f"id {kind}, n long, hi long, lo long, bands array<long>, sig array<long>"), "minhash")


def shingle_sets(docs: DataFrame, k: int) -> DataFrame:
    """(id, shingles) with the full sets, packed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _claim()
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                some = batch.slice(lo, 1024)
                sets = [shingle_set(t, k).tobytes() for t in some.column(1).cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(sets, pa.binary())], ["id", "shingles"])

    return docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, shingles binary")


#: Bits of the filter that keeps texts from being shuffled when they are in no
#: candidate pair: 2**26 bits, 8 MB broadcast at most, whatever the input.
FILTER_BITS = 1 << 26


def _probably_in(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id's bit is set in a bitmap of the hashes of
    ``ids``: all that are in ``ids`` and few others. The bitmap has a fixed
    size; with many ids it only lets more rows through."""
    bit = F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS))
    maps = ids.select(bit.alias("bit")).groupBy(F.expr("bitmap_bucket_number(bit)").alias("bucket")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(bit))").alias("map"))
    d = docs.withColumn("bit", bit).withColumn("bucket", F.expr("bitmap_bucket_number(bit)")) \
        .withColumn("place", F.expr("bitmap_bit_position(bit)"))
    byte = F.conv(F.hex(F.substring("map", (F.col("place") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    on = byte.bitwiseAND(F.pow(F.lit(2), F.col("place") % 8).cast("int")) > 0
    return d.join(F.broadcast(maps), "bucket").filter(on).drop("bit", "bucket", "place", "map")


def _near(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sizes and signatures allow the similarity."""
    f = reps.select("id", "n", "sig")
    fa = f.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("sig").alias("siga"))
    fb = f.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("sig").alias("sigb"))
    j = pairs.join(fa, "a").join(fb, "b")
    return j.filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")).filter(
        estimate(_different(F.col("siga"), F.col("sigb"))) >= percent / 100 - MARGIN).select("a", "b").distinct()


def _dealt(rows: DataFrame, key: str, blocks: Column) -> DataFrame:
    """Rows of each key dealt into blocks by a hash of the id, and each pair of
    blocks (x <= y) one group, so that no task holds a large key."""
    d = rows.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    d = d.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return d.withColumns({"x": F.least("block", "other"), "y": F.greatest("block", "other")}).drop(
        "blocks", "block", "other")


def _across(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that join the components (comp) of bucket members (key, id,
    n, sig, comp, size) whose sizes and signatures allow the similarity: of all
    such pairs of a group, a forest over its components."""
    d = _dealt(rows, "key", F.ceil(F.col("size") / F.lit(BLOCK)).cast("int")).select("key", "x", "y", "id", "n", "sig", "comp")
    least, c = percent / 100 - MARGIN, 1.0 / (1 << BITS)
    most = int((1 - (least * (1 - c) + c)) * HASHES) + 1         # fields that may differ

    def run(group: pa.Table) -> pa.Table:
        ids, n = group.column("id"), group.column("n").to_numpy()
        label = np.unique(np.array([str(x) for x in group.column("comp").to_pylist()]), return_inverse=True)[1]
        sig = np.array(group.column("sig").to_pylist(), np.int64).view(np.uint64)
        left, right = [], []
        for i in range(len(n)):
            rest = np.flatnonzero(label != label[i])
            if not len(rest):
                break
            rest = rest[100 * np.minimum(n[rest], n[i]) >= percent * np.maximum(n[rest], n[i])]
            x = sig[rest] ^ sig[i]
            near = rest[np.bitwise_count((x | (x >> _U(1))) & _U(_LOW)).sum(axis=1) <= most]
            for joined, first in zip(*np.unique(label[near], return_index=True), strict=True):
                left.append(i)
                right.append(int(near[first]))
                label[label == joined] = label[i]
        return pa.table({"a": ids.take(pa.array(left, pa.int64())), "b": ids.take(pa.array(right, pa.int64()))})

    kind = rows.schema["id"].dataType.simpleString()
    return d.groupBy("key", "x", "y").applyInArrow(run, f"a {kind}, b {kind}")


def linked(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Tree edges of a search along exact links (100 * intersection >= percent
    * union) through a list of sets: one intersection count with all sets at
    once, by an inverted index, per set visited; it ends when all are reached."""
    n = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), n)
    every = np.concatenate(sets)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    unique, start = np.unique(every, return_index=True)
    end = np.append(start[1:], len(every))
    seen, edges = np.zeros(len(sets), bool), []
    for root in range(len(sets)):
        if seen[root]:
            continue
        seen[root] = True
        stack = [root]
        while stack and not seen.all():
            i = stack.pop()
            at = np.searchsorted(unique, sets[i])
            lo, size = start[at], end[at] - start[at]
            place = np.repeat(lo - np.cumsum(size) + size, size) + np.arange(size.sum())
            both = np.bincount(owner[place], minlength=len(sets))
            for j in np.flatnonzero((100 * both >= percent * (n + n[i] - both)) & ~seen):
                seen[j] = True
                edges.append((i, int(j)))
                stack.append(int(j))
    return edges


def _confirm(clusters: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Exact links (a, b) within clusters (id, n, cluster), a tree for each
    group of blocks. Only the texts of clustered documents are read again and
    shuffled."""
    ids = clusters.select("id")
    wanted = _probably_in(docs, ids).join(ids, "id", "left_semi")
    sets = shingle_sets(wanted, k).join(clusters, "id")
    totals = clusters.groupBy("cluster").agg(F.sum("n").alias("total"))
    # Clusters are small but for a few: their totals decide the number of blocks.
    sets = sets.join(totals, "cluster")
    d = _dealt(sets, "cluster", F.ceil(F.col("total") / F.lit(BLOCK_SHINGLES)).cast("int")).select("cluster", "x", "y", "id", "shingles")

    def run(group: pa.Table) -> pa.Table:
        rows = [np.frombuffer(v.as_buffer(), np.uint64) for v in group.column("shingles")]
        edges = linked(rows, percent) if len(rows) > 1 else []
        ids = group.column("id")
        return pa.table({"a": ids.take(pa.array([e[0] for e in edges], pa.int64())),
                         "b": ids.take(pa.array([e[1] for e in edges], pa.int64()))})

    kind = docs.schema["id"].dataType.simpleString()
    return written(d.groupBy("cluster", "x", "y").applyInArrow(run, f"a {kind}, b {kind}"), "near-links")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_shingles, component_id (least id reachable
    by links of similarity ``percent`` or more, itself included), kept (the
    row's id is that id).

    NULL or empty text (no words): n_shingles 0, linked with nothing. Fewer
    than k words: the whole sequence is the only shingle. NULL ids: component
    NULL, kept, no links. Rows with one id are one document; its rows share a
    component. Texts are taken whole. Empty table: no rows. Other columns are
    not read.
    """
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    f = features(d, k)
    full = f.filter("n > 0 and id is not null")
    classes = full.groupBy("hi", "lo").agg(F.min("id").alias("rep"))
    of_class = written(full.select("id", "hi", "lo").join(classes, ["hi", "lo"]).select("id", "rep").distinct(),
                       "set-classes")
    own = of_class.filter("id = rep").select("id").distinct()
    reps = written(full.select("id", "n", "bands", "sig").join(own, "id", "left_semi"), "representatives")

    rows = reps.select("id", F.explode("bands").alias("key"))
    centres = rows.groupBy("key").agg(F.min("id").alias("centre"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    shared = written(rows.join(centres, "key"), "shared-buckets")
    stars = shared.filter("id <> centre").select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct()
    near = written(_near(stars, reps, percent), "near-pairs")

    comp = components(near)
    members = shared.filter("size > 2").join(comp, "id", "left").select(
        "key", "id", "size", F.coalesce("component", "id").alias("comp"))
    mixed = members.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x <> y").select("key")
    apart = members.join(mixed, "key", "left_semi").join(reps.select("id", "n", "sig"), "id")
    comp = components(comp.select(F.col("id").alias("a"), F.col("component").alias("b")).union(_across(apart, percent)))
    heads = comp.select(F.col("component").alias("id"), "component").distinct()
    clusters = written(comp.union(heads).join(reps.groupBy("id").agg(F.max("n").alias("n")), "id")
                       .select("id", "n", F.col("component").alias("cluster")), "near-clusters")
    links = _confirm(clusters, d, k, percent)

    # An id whose rows have different texts stands in several classes and links them.
    by_id = of_class.groupBy("id").agg(F.min("rep").alias("least"), F.count(F.lit(1)).alias("classes"))
    bridges = of_class.join(by_id.filter("classes > 1"), "id").select(F.col("least").alias("a"), F.col("rep").alias("b"))
    comp = components(links.union(bridges)).select(F.col("id").alias("least"), "component")
    out = f.select("id", "n").join(by_id, "id", "left").join(comp, "least", "left")
    component = F.coalesce("component", "least", "id")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def one_per_group(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near duplicates, the one with
    the least id; of rows that share a kept id one stays, the least when
    written as JSON. NULL ids stay. NULL and empty texts are like nothing and
    stay; very long texts are compared whole. Empty table: no rows. Any column
    names are allowed and all values come back."""
    kept = near_duplicates(docs, k, percent, id_col, text_col).filter("kept")
    ids = kept.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.count(F.lit(1)).alias("n"))
    joined = as_rows(docs, F.col(id_col).alias("key")).join(ids, F.col("key") == F.col("id"))
    single = joined.filter("n = 1").select("row.*")
    # Equal rows of one id are folded by the aggregate.
    first = joined.filter("n > 1").groupBy("id").agg(F.min_by("row", F.to_json("row")).alias("row")).select("row.*")
    nulls = docs.filter(F.col(id_col).isNull())
    return single.unionByName(first).unionByName(nulls)
