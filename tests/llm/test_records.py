"""Binary records against the tokenizer library and a byte-by-byte checksum."""
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import records, tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


def crc_by_bits(data):
    r = 0xFFFFFFFF
    for b in data:
        r ^= b
        for _ in range(8):
            r = (r >> 1) ^ (records.POLYNOMIAL if r & 1 else 0)
    return r ^ 0xFFFFFFFF


def test_checksums():
    assert records.crc32c([b"123456789", b"", b"\0" * 32, b"\xff" * 32]).tolist() == [
        0xE3069283, 0, 0x8A9136AA, 0x62A8AB43]                  # published check values
    rng = random.Random(2)
    some = [rng.randbytes(n) for n in (*range(12), 255, 256, 257, 511, 512, 5000)]
    assert records.crc32c(some).tolist() == [crc_by_bits(m) for m in some]


def test_frames_and_faults():
    some = [b"", b"a", b"x" * 1000]
    data = b"".join(records.frames(some))
    assert records.payloads(data) == some
    size, = struct.unpack_from("<Q", data, 16)
    crc, = struct.unpack_from("<I", data, 24)
    c = crc_by_bits(data[16:24])
    assert size == 1 and crc == (((c >> 15) | (c << 17)) + records.MASK) & 0xFFFFFFFF
    for broken in (data[:-1], data[:20] + b"\1" + data[21:], data[:-500] + b"y" + data[-499:], data + b"12345"):
        with pytest.raises(records.BrokenRecord):
            records.payloads(broken)


def expected(rows):
    out = []
    for i, text, *_ in rows:
        ids = [*tokens.load(PATH).encode(text or "", add_special_tokens=False).ids, 0]
        out.append((i, tuple(ids)))
    return out


@pytest.mark.parametrize("files", [1, 5])
def test_round_trip(spark, odd, odd_rows, files, monkeypatch):
    monkeypatch.setattr(records, "SPAN_BYTES", 4096)            # many spans a file
    folder = records.new_folder(spark)
    records.write_records(odd, PATH, folder, files=files)
    rows = records.read_records(spark, folder, with_ids=True).collect()
    rows.sort(key=lambda r: (r.file, r.record))
    place = 0
    for r in rows:
        assert r.start == place and r.n_tokens == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        place += r.n_tokens
    ids = [r.id for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))        # ascending, NULL first
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(((r.id, tuple(r.ids)) for r in rows), key=key) == sorted(expected(odd_rows), key=key)

    mixed = records.shuffled(spark, folder, seed=1, partitions=3).collect()
    other = [r.start for r in records.shuffled(spark, folder, seed=2, partitions=3).collect()]
    assert [r.start for r in mixed] != other != sorted(other)
    assert sorted((r.start, r.ids_crc32) for r in mixed) == sorted((r.start, r.ids_crc32) for r in rows)
    assert [r.epoch_order for r in mixed] == sorted(r.epoch_order for r in mixed)


def test_repeated_id_is_spread(spark):
    folder = records.new_folder(spark)
    docs = spark.range(400).select(F.lit(7).alias("doc_id"), F.lit("one text").alias("text"))
    records.write_records(docs, PATH, folder, files=4)
    per_file = [r["count"] for r in records.read_records(spark, folder).groupBy("file").count().collect()]
    assert sum(per_file) == 400 and max(per_file) < 250


def test_nothing(spark, none):
    folder = records.new_folder(spark)
    records.write_records(none, PATH, folder)
    assert records.read_records(spark, folder).collect() == []
    assert records.shuffled(spark, folder, seed=1).collect() == []
