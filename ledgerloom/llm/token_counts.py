"""Token counts (9): whole-token shortcut.

Offline, each vocabulary string is encoded alone; those that come back as one
token are proved whole. Texts are cut into pre-tokens, proved ones count one,
and only the rest is merged (``tokens.py``). No shuffle: one pass over the
documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 512, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of each row's whole text.

    ``tokenizer`` is the path of a ``.json`` (tokenizers) or ``.model``
    (sentencepiece) file, present on every executor. Counts are the library's
    own: no begin, end or added special tokens, special strings inside texts
    by the library's default, no truncation or padding.

    NULL text: 0 bytes, 0 tokens. Empty text: 0 and 0. NULL ids and repeated
    rows pass through, one output row per input row. Empty table: no rows.
    Other columns are not read, so their names cannot clash.
    """
    spark = docs.sparkSession
    piece_model = tokenizer.endswith(".model")
    whole = spark.sparkContext.broadcast({} if piece_model else tokens.whole_tokens(tokenizer))

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if piece_model:
            import sentencepiece
            sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer)

            def count(text):
                return len(sp.encode(text, num_threads=1))
        else:
            count = tokens.encoder(tokenizer, whole.value, 0).count
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            sizes = pa.array([len(t.encode()) for t in texts], pa.int64())
            n = pa.array([count(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, n], ["id", "n_bytes", "n_tokens"])

    kept = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = kept.schema["id"].dataType.simpleString()
    out = kept.mapInArrow(counts, f"id {kind}, n_bytes long, n_tokens long")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens",
                      (F.col("n_tokens") > limit).alias("over_limit"))
