"""Token ids as length-delimited binary records (11).

A dataset is a folder:

* ``part-*.rec``: frames one after another. A frame is the payload's length
  (8 bytes), the masked checksum of those 8 bytes (4), the payload, and the
  payload's masked checksum (4), all little-endian; the checksum is CRC-32C.
  A payload is the document's id (8 bytes), the width of a token id in bytes
  (1), 1 if the document's id is NULL (1), 6 zero bytes, then the token ids.
* ``index``: Parquet, one row per record: file, record (its place in the
  file), at (offset of its frame), size (of its payload), before (token ids
  before it in its file). Shuffled reads go by it, record by record.
* ``files``: Parquet, one row per file: file, name, base (token ids before
  the file), records, tokens.

Files hold ascending ids, and so do the files in order. Each task streams its
range of ids to a file of its own, under a name no other attempt uses; the
index is written by Spark's committer and names the files of the attempts that
count, so lost executors and repeated tasks leave at worst files nobody reads.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import tokens
from .common import shared_folder

POLYNOMIAL = 0x82F63B78         # CRC-32C, reflected
MASK = 0xA282EAD8
BLOCK = 256                     # bytes whose checksum is found by one table look-up each
HEAD, HEAD_BYTES = "<qBB6x", 16
WRITE_BYTES = 4 << 20           # frames gathered before they go to the file
SPAN_BYTES = 8 << 20            # bytes of a file read at once


class BrokenRecord(ValueError):
    """A frame whose length or checksum is wrong."""


# ---- checksums -------------------------------------------------------------

@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, list[list[int]]]:
    """(one byte, [place in a block, byte], BLOCK zero bytes by register byte)."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, (one >> 1) ^ np.uint32(POLYNOMIAL), one >> 1)

    def step(r):
        return (r >> 8) ^ one[r & 255]

    places = np.empty((BLOCK, 256), np.uint32)
    places[-1] = one
    for j in range(BLOCK - 2, -1, -1):
        places[j] = step(places[j + 1])
    shift = []
    for k in range(4):
        r = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
        for _ in range(BLOCK):
            r = step(r)
        shift.append(r.tolist())
    return one, places.ravel(), shift


def crc32c(messages: list[bytes]) -> np.ndarray:
    """CRC-32C of each message. The checksum is linear: a block's register is
    the exclusive or of one table entry per byte, and a register is carried
    over a block by four more, so the bytes go through numpy at once."""
    one, places, (s0, s1, s2, s3) = _tables()
    out = np.zeros(len(messages), np.uint32)
    long = [i for i, m in enumerate(messages) if len(m) >= 4]
    for i, m in enumerate(messages):
        if len(m) < 4:
            r = 0xFFFFFFFF
            for b in m:
                r = (r >> 8) ^ int(one[(r ^ b) & 255])
            out[i] = r ^ 0xFFFFFFFF
    blocks = [-(-len(messages[i]) // BLOCK) for i in long]
    buffer = np.zeros((sum(blocks), BLOCK), np.uint8)
    flat, at = buffer.ravel(), 0
    for i, n in zip(long, blocks, strict=True):     # zeros in front leave an empty register as it is
        m = np.frombuffer(messages[i], np.uint8)
        at += n * BLOCK
        flat[at - len(m):at] = m
        flat[at - len(m):at - len(m) + 4] ^= 255    # the register starts with all bits set
    index = buffer + (np.arange(BLOCK, dtype=np.int32) << 8)
    registers = np.bitwise_xor.reduce(places.take(index), axis=1).tolist() if len(buffer) else []
    at = 0
    for i, n in zip(long, blocks, strict=True):
        r = registers[at]
        for x in registers[at + 1:at + n]:
            r = s0[r & 255] ^ s1[(r >> 8) & 255] ^ s2[(r >> 16) & 255] ^ s3[r >> 24] ^ x
        at += n
        out[i] = r ^ 0xFFFFFFFF
    return out


def masked(crc: np.ndarray) -> np.ndarray:
    """Turned by 15 bits plus a constant, so that a checksum of data that holds
    checksums stays a good one."""
    c = crc.astype(np.uint32)
    return ((c >> np.uint32(15)) | (c << np.uint32(17))) + np.uint32(MASK)


def frames(payloads: list[bytes]) -> list[bytes]:
    """Each payload with its lengths and masked checksums around it."""
    lengths = [len(p).to_bytes(8, "little") for p in payloads]
    first, last = masked(crc32c(lengths)).astype("<u4").tobytes(), masked(crc32c(payloads)).astype("<u4").tobytes()
    return [b"".join((n, first[4 * i:4 * i + 4], p, last[4 * i:4 * i + 4]))
            for i, (n, p) in enumerate(zip(lengths, payloads, strict=True))]


def payloads(data: bytes) -> list[bytes]:
    """The payloads of whole frames; raises ``BrokenRecord`` on any fault."""
    out, heads, sums, at = [], [], [], 0
    while at < len(data):
        if at + 12 > len(data):
            raise BrokenRecord(f"frame at {at} is cut")
        size = int.from_bytes(data[at:at + 8], "little")
        if at + 16 + size > len(data):
            raise BrokenRecord(f"frame at {at} is longer than its file")
        heads.append(data[at:at + 8])
        out.append(data[at + 12:at + 12 + size])
        sums += [data[at + 8:at + 12], data[at + 12 + size:at + 16 + size]]
        at += 16 + size
    want = np.frombuffer(b"".join(sums), "<u4").reshape(-1, 2)
    for kind, some, column in (("length", heads, 0), ("payload", out, 1)):
        if (bad := np.flatnonzero(masked(crc32c(some)) != want[:, column])).size:
            raise BrokenRecord(f"{kind} of frame {bad[0]} does not fit its checksum")
    return out


def _store(uri: str):
    """(file system, path) of a folder the executors share."""
    from pyarrow import fs
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


# ---- writing ---------------------------------------------------------------

def write_records(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 0, files: int | None = None,
                  id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text (no special tokens, ``end_id`` last) and write the
    dataset under ``folder``, in ascending order of the integer id.

    ``files`` is the number of ranges (default: the session's shuffle
    partitions; choose it so that a file suits one reader). NULL ids come
    first; rows with one id stand together in no stated order, spread over
    files if they are many. NULL or empty text: the end id alone. Very long
    texts are one record. Empty table: no file and empty index. Other columns
    are not read.
    """
    spark = docs.sparkSession
    top = max(tokens.load(tokenizer).get_vocab_size(with_added_tokens=True) - 1, end_id)
    width = 2 if top < 1 << 16 else 4
    whole = spark.sparkContext.broadcast(tokens.whole_tokens(tokenizer))
    parts = files or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        number = TaskContext.get().partitionId()
        packed = tokens.encoder(tokenizer, whole.value, width).packed
        end = end_id.to_bytes(width, "little")
        store, root = _store(folder)
        name = f"part-{number:06d}-{uuid.uuid4().hex}.rec"
        out, record, at, before, waiting, held = None, 0, 0, 0, [], 0
        try:
            for batch in batches:
                for lo in range(0, batch.num_rows, 512):
                    some = batch.slice(lo, 512)
                    ids = [packed(t or "") + end for t in some.column(1).to_pylist()]
                    framed = frames([struct.pack(HEAD, i or 0, width, i is None) + x
                                     for i, x in zip(some.column(0).to_pylist(), ids, strict=True)])
                    if out is None:
                        store.create_dir(root, recursive=True)
                        out = store.open_output_stream(f"{root}/{name}")
                    waiting += framed
                    sizes = np.array([len(f) for f in framed], np.int64)
                    n = np.array([len(x) // width for x in ids], np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(n), number, np.int32)), pa.array([name] * len(n)),
                         pa.array(record + np.arange(len(n))), pa.array(at + np.cumsum(sizes) - sizes),
                         pa.array(sizes - 16), pa.array(before + np.cumsum(n) - n), pa.array(n)],
                        ["file", "name", "record", "at", "size", "before", "n"])
                    record, at, before = record + len(n), at + int(sizes.sum()), before + int(n.sum())
                    held += int(sizes.sum())
                    if held >= WRITE_BYTES:
                        out.write(b"".join(waiting))
                        waiting, held = [], 0
            if out is not None:
                out.write(b"".join(waiting))
                out.close()
        except BaseException:
            if out is not None:             # this attempt's file counts for nothing
                out.close()
                store.delete_file(f"{root}/{name}")
            raise

    # Rows with one id are dealt by their text, equal rows by a seeded draw: no id fills a file alone.
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    ranged = d.repartitionByRange(parts, *order, F.rand(11)).sortWithinPartitions(F.col("id").asc_nulls_first())
    rows = ranged.mapInArrow(run, "file int, name string, record long, at long, size long, before long, n long")
    rows.write.option("compression", "zstd").parquet(f"{folder}/index")
    index = spark.read.schema(rows.schema).parquet(f"{folder}/index")
    totals = index.groupBy("file", "name").agg(F.count(F.lit(1)).alias("records"), F.sum("n").alias("tokens"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)     # one row per file
    totals.select("file", "name", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("base"),
                  "records", "tokens").coalesce(1).write.parquet(f"{folder}/files")


# ---- reading ---------------------------------------------------------------

INDEX = "file int, name string, record long, at long, size long, before long, n long"
FILES = "file int, name string, base long, records long, tokens long"


def index(spark: SparkSession, folder: str) -> DataFrame:
    """The offset index, with ``start``: token ids of all records before."""
    files = spark.read.schema(FILES).parquet(f"{folder}/files").select("file", "base")     # one row per file
    return spark.read.schema(INDEX).parquet(f"{folder}/index").join(F.broadcast(files), "file").select(
        "file", "name", "record", "at", "size", (F.col("base") + F.col("before")).alias("start"))


def _decoder(folder: str, with_ids: bool):
    kinds = [pa.int64()] * 4 + [pa.int32(), pa.int64()] + [pa.list_(pa.int32())] * with_ids
    names = ["id", "start", "n_tokens", "ids_crc32", "file", "record", "ids"][:len(kinds)]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    def records_of(span: dict, data: bytes) -> Iterator[tuple]:
        found, start = payloads(data), span["start"]
        if len(found) != span["records"]:
            raise BrokenRecord(f"{span['name']}: {len(found)} records, the index has {span['records']}")
        for k, p in enumerate(found):
            i, width, null = struct.unpack_from(HEAD, p)
            ids = np.frombuffer(p, "<u2" if width == 2 else "<u4", offset=HEAD_BYTES).astype("<u4")
            row = (None if null else i, start, len(ids), zlib.crc32(ids), span["file"], span["record"] + k)
            yield (*row, ids.astype(np.int32)) if with_ids else row
            start += len(ids)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        name, source, rows = None, None, []
        try:
            for batch in batches:
                for span in batch.to_pylist():
                    if span["name"] != name:
                        if source is not None:
                            source.close()
                        name, source = span["name"], store.open_input_file(f"{root}/{span['name']}")
                    for row in records_of(span, source.read_at(span["end"] - span["at"], span["at"])):
                        rows.append(row)
                        if len(rows) == 512:
                            yield batch_of(rows)
                            rows = []
            if rows:
                yield batch_of(rows)
        finally:
            if source is not None:
                source.close()
    return decode, ("id long, start long, n_tokens long, ids_crc32 long, file int, record long"
                    + (", ids array<int>" if with_ids else ""))


def read_records(spark: SparkSession, folder: str, with_ids: bool = False,
                 partitions: int | None = None) -> DataFrame:
    """Every record, read in spans of whole frames and checked: id, start
    (token ids of all documents before), n_tokens, ids_crc32 (of the ids as
    little-endian unsigned 32-bit integers), file, record, and the ids.
    ``partitions`` is stated, as the rows that name the spans are far smaller
    than what they stand for."""
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    spans = index(spark, folder).groupBy("file", "name", F.floor(F.col("at") / SPAN_BYTES).alias("span")).agg(
        F.min("record").alias("record"), F.min("at").alias("at"), F.max(F.col("at") + F.col("size") + 16).alias("end"),
        F.min("start").alias("start"), F.count(F.lit(1)).alias("records"))
    decode, schema = _decoder(folder, with_ids)
    return spans.repartition(parts, "file", "span").mapInArrow(decode, schema)


def shuffled(spark: SparkSession, folder: str, seed: int, with_ids: bool = True,
             partitions: int | None = None) -> DataFrame:
    """Every record once, in an order drawn by ``seed``: the index is dealt and
    sorted by a hash, then each task reads its records by their offsets. Only
    index rows are shuffled. ``epoch_order`` is the hash."""
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    draw = F.xxhash64(F.lit(seed), F.col("file"), F.col("record"))
    one = index(spark, folder).select("file", "name", "record", "at", (F.col("at") + F.col("size") + 16).alias("end"),
                                      "start", F.lit(1).cast("long").alias("records"), draw.alias("draw"))
    one = one.repartitionByRange(parts, "draw").sortWithinPartitions("draw").drop("draw")
    decode, schema = _decoder(folder, with_ids)
    return one.mapInArrow(decode, schema).withColumn("epoch_order", draw)


def new_folder(spark: SparkSession) -> str:
    return os.path.join(shared_folder(spark, "records"), "set")
