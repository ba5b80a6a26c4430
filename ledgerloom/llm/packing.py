"""Packing (3): concatenate and cut.

All documents in table order form one long row of tokens, cut into windows of
``window`` tokens. Two passes:

1. each partition encodes its documents and writes, per document, the ids and
   the tokens before it in its partition (a running sum); the written table
   fixes order and partition numbers even if executors are lost;
2. the token totals of the partitions (one row each) are summed up in order,
   which gives each partition's global offset; each document is then cut where
   it crosses a window border, and each part is a boundary record.

Only the last window can be short; it is padded. No document passes a shuffle.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import tokens
from .common import written

PIECES = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def encode(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """Pass 1: (id, part, before, n, ids, width) with ids packed little-endian
    in 2 bytes where the vocabulary allows, else 4, and ``end_id`` last."""
    spark = docs.sparkSession
    top = max(tokens.load(tokenizer).get_vocab_size(with_added_tokens=True) - 1, end_id)
    width = 2 if top < 1 << 16 else 4
    whole = spark.sparkContext.broadcast(tokens.whole_tokens(tokenizer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        packed = tokens.encoder(tokenizer, whole.value, width).packed
        end = end_id.to_bytes(width, "little")
        before = 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):     # bounded output batches
                some = batch.slice(lo, 512)
                ids = [packed(t or "") + end for t in some.column(1).to_pylist()]
                n = np.array([len(x) // width for x in ids], np.int64)
                at = before + np.cumsum(n) - n
                before += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(np.full(len(n), part, np.int32)), pa.array(at), pa.array(n),
                     pa.array(ids, pa.binary())], ["id", "part", "before", "n", "ids"])

    kept = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = kept.schema["id"].dataType.simpleString()
    out = kept.mapInArrow(run, f"id {kind}, part int, before long, n long, ids binary")
    return written(out.withColumn("width", F.lit(width)), "packing-ids")


def pack(docs: DataFrame, tokenizer: str, window: int = 2048, end_id: int = 1, id_col: str = "doc_id",
         text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: id, start (ids of its document before it), length,
    ids_crc32, doc_tokens, sequence_id, offset (its place in the sequence) and
    pad (padding after the piece, which only the very last piece can have);
    ``with_ids`` adds the ids as an int array, the packed sequences themselves.

    NULL or empty text: the end id alone, so each row gives at least one
    piece. NULL ids, ties and repeated rows are packed like any row. Very long
    texts span many windows. Empty table: no rows. Other columns are not read.
    """
    ids = encode(docs, tokenizer, end_id, id_col, text_col)
    totals = ids.groupBy("part").agg(F.max(F.col("before") + F.col("n")).alias("total"))
    # One row per partition of the input.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"),
                            F.sum("total").over(Window.partitionBy()).alias("everything"))
    placed = ids.join(F.broadcast(offsets), "part").select(
        "id", "ids", "width", (F.col("base") + F.col("before")).alias("at"), "everything")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                some = batch.slice(lo, 512)
                take, rows, arrays = [], [], []
                for i, (blob, width, at, everything) in enumerate(zip(
                        *(some.column(k).to_pylist() for k in (1, 2, 3, 4)), strict=True)):
                    a = np.frombuffer(blob, "<u2" if width == 2 else "<u4").astype("<u4")
                    start = 0
                    while start < len(a):
                        offset = (at + start) % window
                        length = min(len(a) - start, window - offset)
                        piece = a[start:start + length]
                        last = at + start + length == everything
                        take.append(i)
                        rows.append((start, length, zlib.crc32(piece.tobytes()), len(a), (at + start) // window,
                                     offset, -(offset + length) % window if last else 0))
                        if with_ids:
                            arrays.append(piece.astype(np.int32))
                        start += length
                cols = list(zip(*rows, strict=True)) or [()] * 7
                out = [some.column(0).take(pa.array(take, pa.int64())), *(pa.array(c, pa.int64()) for c in cols)]
                names = ["id", *PIECES[1:], "pad"]
                if with_ids:
                    out.append(pa.array(arrays, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names)

    kind = placed.schema["id"].dataType.simpleString()
    longs = ", ".join(f"{c} long" for c in (*PIECES[1:], "pad"))
    schema = f"id {kind}, {longs}" + (", ids array<int>" if with_ids else "")
    return placed.mapInArrow(cut, schema).withColumnRenamed("id", id_col)
