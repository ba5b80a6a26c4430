import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])
EXTRA = ("id", "n", "key", "part", "size", "score", "_one", "mix_size", "quality_kept", "n_tokens", "words",
         "_id", "_rows", "row", "_row", "_mix_source", "_mix_size", "_mix_rate", "_mix_copies", "_mix_copy", "mixed_source",
         "_quality_found", "_quality_kept", "quality_found", "quality_failed", "mix_copies", "hashes", "found", "col")


def sentences(rng, n, words):
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """NULLs in every column, empty and very long texts, ties, repeated rows."""
    rng = random.Random(4)
    words = ["the", "of", "and", "thation", "ering", "onst.", "Edth,", "à", "für", "niño", "don't", "x1", "漢字"]
    long = sentences(rng, 30_000, words)
    base = sentences(rng, 60, words)
    rows = [(1, base, "en", "a", 1), (1, base, "en", "a", 1), (2, base, "en", None, 1), (3, None, "de", "b", None),
            (4, "", None, "b", 0), (None, base + " more", "fr", "c", 3), (5, long, "en", "c", 9), (6, " \n\t ", "es", "a", 4),
            (7, "word", "es", "", 4), (8, "a b", None, None, None), (9, base.upper(), "en", "a", 2),
            (None, None, None, None, None), (10, "### $$$ !!! 123", "en", "d", 5),
            (11, "\n".join([base] * 4), "en", "a", 5), (12, "the " * 300, "en", "a", 5)]
    rows += [(100 + i, sentences(rng, rng.randint(20, 90), words), rng.choice(["en", "de"]), rng.choice("abcd"), 1)
             for i in range(60)]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The odd rows with extra columns whose names clash with those the operators use."""
    from pyspark.sql import functions as F
    d = spark.createDataFrame(odd_rows, DOCS)
    return d.withColumns({c: F.lit(7) for c in EXTRA}).repartition(3, "n_chars").cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)
