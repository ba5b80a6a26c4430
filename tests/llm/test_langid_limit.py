"""The rejection limit and the languages fitted: wrong labels, few texts, rare languages."""
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import langid

FOREIGN = {"it": "Nel mezzo del cammin di nostra vita mi ritrovai per una selva oscura che la diritta via era smarrita",
           "nl": "De snelle bruine vos springt over de luie hond en gaat daarna weer naar huis om te slapen",
           "pl": "Wszyscy ludzie rodza sie wolni i rowni pod wzgledem swej godnosci i swych praw",
           "fi": "Kaikki ihmiset syntyvat vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan",
           "ru": "Съешь же ещё этих мягких французских булок да выпей чаю"}


def foreign(spark):
    return spark.createDataFrame([(i, t * 2) for i, t in enumerate(FOREIGN.values())], "doc_id long, text string")


@pytest.mark.parametrize("wrong", [0, 1, 4])
def test_wrong_labels_do_not_move_the_limit(spark, wrong):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    pick = F.crc32(F.concat(F.lit("wrong"), F.col("doc_id").cast("string")).cast("binary")) % 100 < wrong
    other = F.when(F.col("lang") == "en", "de").otherwise("en")
    labelled = docs.filter(~langid.held_out(docs)).withColumn("lang", F.when(pick, other).otherwise(F.col("lang")))
    model = langid.train(labelled)
    assert all(r.rejected for r in langid.predict(foreign(spark), model).collect())
    rows = langid.predict(docs.filter(langid.held_out(docs)), model).filter("lang_pred != 'und'").collect()
    assert sum(r.rejected for r in rows) <= 0.01 * len(rows)


def test_every_language_is_fitted(spark):
    rows = [(i, chr(0x4E00 + 50 * i) * 3 + " " + chr(0x4E01 + 50 * i) * 30, f"l{i:02d}") for i in range(30)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == [r[2] for r in rows]


@pytest.mark.parametrize("n", [1, 12, 60])
def test_few_texts_reject_another_script(spark, n):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("lang = 'en'").orderBy("doc_id").limit(n)
    model = langid.train(docs)
    got = {r.doc_id: r.rejected for r in langid.predict(foreign(spark), model).collect()}
    assert got[4]
