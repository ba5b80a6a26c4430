"""Registered queries of the training-data operators, with DuckDB twins where
SQL can express them. Each reads its whole table and returns the full result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (ann, conversations, kneser_ney, langid, lexical, licences, minhash, mixing, packing, quality, records,
               token_counts, warc)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
TOKENIZER = "byte_bpe_50k.json"


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sql(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# 1 ------------------------------------------------------------------ licences
def _licence_sql() -> str:
    known = ", ".join(f"({_sql(k)}, {_sql(v)})" for k, v in licences.SENTENCES.items())

    def holds(wanted):
        return "sentence_ids like " + _sql("%" + "%".join(f"<{i}>" for i in wanted) + "%")

    first = " ".join(f"when {holds(w)} then {_sql(n)}" for n, _, w in licences.RULES)
    kind = " ".join(f"when {holds(w)} then {_sql(c)}" for _, c, w in licences.RULES)
    held = ", ".join(f"case when {holds(w)} then {_sql(n)} end" for n, _, w in licences.RULES)
    longest, least = 2 * max(map(len, licences.SENTENCES)) + 16, min(map(len, licences.SENTENCES))
    return f"""
with known(s, i) as (values {known}),
cut as (select doc_id, string_split_regex(coalesce(text, ''), '[\\n\\r]+|[.!?;]+[ \\t]+') ss from documents),
each as (select doc_id, k, ss[k] s from (select doc_id, ss, unnest(range(1, len(ss) + 1)) k from cut)),
norm as (select doc_id, k, regexp_replace(regexp_replace(lower(s), '[^a-z0-9./+-]+', ' ', 'g'),
                                          '^[ .]+|[ .]+$', '', 'g') s
         from each where length(s) between {least} and {longest}),
hit as (select doc_id, string_agg('<' || i || '>', '' order by k) sentence_ids, count(*) n
        from norm join known using (s) group by doc_id),
d as (select doc_id, coalesce(sentence_ids, '') sentence_ids, coalesce(n, 0) n_licence_sentences
      from documents left join hit using (doc_id)),
h as (select *, list_filter([{held}], lambda x: x is not null) held from d)
select doc_id, sentence_ids, n_licence_sentences, case {first} else 'none' end licence,
       case {kind} else 'none' end licence_class, len(held) n_rules,
       array_to_string(list_filter(held, lambda x, k: list_position(held, x) = k), ',') licences
from h"""


@register("op1_licence_scan", _licence_sql())
def op1_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


# 2 ------------------------------------------------------------- quality rules
_QUALITY_SQL = r"""
with w as (
  select doc_id, coalesce(text, '') text,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) ls
  from documents),
g as (select doc_id, i, array_to_string(ws[i:i + 7], ' ') g
      from (select doc_id, ws, unnest(range(1, len(ws) - 6)) i from w)),
twice as (select doc_id, g from g group by doc_id, g having count(*) > 1),
places as (select distinct g.doc_id, g.i + k.k p from g join twice using (doc_id, g), range(8) k(k)),
rep as (select doc_id, count(*) n from places group by doc_id),
m as (
  select w.doc_id, len(ws) n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) n_symbols,
         len(ls) - len(list_distinct(ls)) n_dup_lines, len(ls) n_lines, coalesce(rep.n, 0) n_repeat_words,
         length(regexp_replace(text, '[^\p{L}]+', '', 'g')) n_letters,
         len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) n_run_words
  from w left join rep using (doc_id)),
b as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not (base_failed or 100 * n_symbols > 10 * n_words or word_chars < 2 * n_words or word_chars > 12 * n_words
            or (n_lines > 0 and 100.0 * n_dup_lines / n_lines > 50) or 100 * n_run_words > 50 * n_words
            or 100 * n_letters < 40 * word_chars) kept
from b"""


@register("op2_quality_rules", _QUALITY_SQL)
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality.cascade(docs, columns=names, prefix="q_")
    m = {n: F.col(f"q_{n}") for n in names}
    base = [r.rejects(m) for r in quality.RULES if r.name in quality.BASE]
    return judged.select("doc_id", *[F.col(f"q_{n}").alias(n) for n in names],
                         (base[0] | base[1]).alias("base_failed"), F.col("q_kept").alias("kept"))


# 3 ------------------------------------------------------------------- packing
@register("op3_packing")
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, public_tokenizers.path(TOKENIZER)).select(*packing.PIECES)


# 4 ---------------------------------------------------------------------- WARC
def _warc_sql() -> str:
    entities = "x"
    for a, b in warc.ENTITIES:
        entities = f"replace({entities}, {_sql(a)}, {_sql(b)})"

    def unescape(x):
        return entities.replace("replace(x,", f"replace({x},", 1) if entities.startswith("replace(x,") \
            else entities.replace("(x,", f"({x},", 1)

    text = shown = f"regexp_replace(html, {_sql(warc.HIDDEN)}, ' ', 'g')"
    value = r"""(?:"[^"]*"|''[^'']*''|[^\s"''>][^\s>]*)"""
    for w in warc.WHITE:
        text = f"replace({text}, chr({ord(w)}), ' ')"
    text = f"regexp_replace(regexp_replace({text}, {_sql(warc.BREAKS)}, chr(10), 'g'), {_sql(warc.TAGS)}, '', 'g')"
    text = f"replace(regexp_replace({unescape(text)}, ' {{2,}}', ' ', 'g'), ' ' || chr(10), chr(10))"
    text = f"trim(regexp_replace({text}, '\\n[ \\n]+', chr(10), 'g'), ' ' || chr(10))"
    title = unescape("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title', 1)")
    crlf = "chr(13) || chr(10)"

    def uuid(x):
        return (f"'<urn:uuid:' || substr({x}, 1, 8) || '-' || substr({x}, 9, 4) || '-8' || substr({x}, 14, 3) "
                f"|| '-a' || substr({x}, 18, 3) || '-' || substr({x}, 21, 12) || '>'")

    return f"""
with p as (select page_id, coalesce(url, '') url, coalesce(html, '') html from pages),
r as (select *, 'sha256:' || sha256(html) source_digest, strlen(html) size from p),
i as (select *, sha256('response' || chr(0) || coalesce(page_id::varchar, '') || chr(0) || url || chr(0)
                       || source_digest) h from r),
t as (select *, {uuid('h')} refers_to, {text} plain,
             'source-digest: ' || source_digest || {crlf} || 'source-length: ' || size || {crlf}
             || 'title: ' || trim(regexp_replace({title}, '\\s+', ' ', 'g')) || {crlf}
             || 'lang: ' || regexp_extract(html, '(?i)<html[^>]*\\blang=["'']?([A-Za-z-]+)', 1) || {crlf}
             || 'source-Content-Type: text/html; charset=utf-8' || {crlf}
             || 'source-Content-Length: ' || size || {crlf}
             || array_to_string(list_transform(
                  regexp_extract_all({shown}, '(?i)<a(?:[\\s/]+[^\\s/>=<]+(?:\\s*=\\s*{value})?)*?[\\s/]+href\\s*=\\s*({value})', 1),
                  lambda l: 'outlink: ' || case when l[1] in ('"', '''') then l[2:-2] else l end || {crlf}), '') fields from i),
b as (select page_id, refers_to, source_digest, url, 'metadata' warc_type, fields block from t
      union all select page_id, refers_to, source_digest, url, 'conversion', plain from t),
d as (select *, 'sha256:' || sha256(block) payload_digest from b),
k as (select *, sha256(warc_type || chr(0) || refers_to || chr(0) || payload_digest) h from d),
e as (select *, {uuid('h')} record_id,
             case warc_type when 'metadata' then 'application/warc-fields'
                  else 'text/plain; charset=utf-8' end content_type from k)
select page_id, warc_type, record_id, refers_to, url target_uri, content_type, payload_digest, source_digest,
       'WARC/1.1' || {crlf} || 'WARC-Type: ' || warc_type || {crlf} || 'WARC-Target-URI: ' || url || {crlf}
       || 'WARC-Date: 1970-01-01T00:00:00Z' || {crlf} || 'WARC-Record-ID: ' || record_id || {crlf}
       || 'WARC-Refers-To: ' || refers_to || {crlf} || 'WARC-Refers-To-Target-URI: ' || url || {crlf}
       || 'WARC-Refers-To-Date: 1970-01-01T00:00:00Z' || {crlf}
       || 'WARC-Source-Payload-Digest: ' || source_digest || {crlf}
       || 'WARC-Block-Digest: ' || payload_digest || {crlf} || 'Content-Type: ' || content_type || {crlf}
       || 'Content-Length: ' || strlen(block) || {crlf} AS header, block
from e"""


@register("op4_warc_derivatives", _warc_sql())
def op4_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.derive(warc.responses(table(spark, sf_dir, "pages")))
    return records.select(F.col("id").alias("page_id"), "warc_type", "record_id", "refers_to", "target_uri",
                          "content_type", "payload_digest", "source_digest", "header", "block")


# 5 -------------------------------------------------------- near duplicates
_NEAR_SQL = r"""
with recursive w as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                             'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') ws from documents),
s as (select distinct doc_id, g from (
        select doc_id, unnest(case when len(ws) < 2 then ws
               else list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) end) g from w)),
n as (select doc_id, count(*) n from s group by doc_id),
p as (select a.doc_id x, b.doc_id y, count(*) c from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
l as (select x, y from p join n nx on nx.doc_id = x join n ny on ny.doc_id = y where 100 * c >= 80 * (nx.n + ny.n - c)),
e as (select x, y from l union all select y, x from l),
r(x, y) as (select doc_id, doc_id from documents union select r.x, e.y from r join e on r.y = e.x),
c as (select x doc_id, min(y) component_id from r group by x)
select doc_id, coalesce(n, 0) n_shingles, component_id, doc_id = component_id kept
from documents join c using (doc_id) left join n using (doc_id)"""


@register("op5_minhash_near_dedup", _NEAR_SQL)
def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), k=2, percent=80)


# 6 ------------------------------------------------------------------ LM scoring
@register("op6_lm_scoring")
def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = kneser_ney.train(docs.filter(~kneser_ney.held_out()))
    return kneser_ney.score(docs, model).select(
        "doc_id", kneser_ney.held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score",
        "score", "perplexity")


# 7 ---------------------------------------------------------------- language ID
@register("op7_language_id")
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.filter(~langid.held_out(docs)))
    return langid.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", langid.held_out(docs).alias("held_out"), "lang_pred", "score", "n_chars", "cross_entropy", "rejected")


# 8 -------------------------------------------------------------------- mixing
_MIXING_SQL = r"""
with d as (select doc_id, source, len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                                                  lambda x: x <> '')) size from documents),
s as (select source, sum(size)::double s, row_number() over (order by source nulls last) - 1 k from d group by source),
w as (select *, case k % 3 when 0 then 5.0::double when 1 then 2.0::double else 1.0::double end w from s),
c as (select *, 3 * s cap, 3 * s / w fill, row_number() over (order by 3 * s / w, source nulls last) n from w),
l as (select *, (sum(s) over () - coalesce(sum(cap) over (order by n rows between unbounded preceding and 1 preceding), 0))
              / sum(w) over (order by n rows between current row and unbounded following) lvl from c),
t as (select source, s, case when s = 0 then 0 else least(cap, w * (select lvl from l where fill >= lvl order by n limit 1)) end target from l),
r as (select d.*, t.s, t.target, case when t.s > 0 then t.target / t.s else 0 end rate,
             ('0x' || substr(md5('8:' || d.doc_id), 1, 13))::bigint / 4503599627370496.0::double draw
      from d join t on d.source is not distinct from t.source)
select doc_id, size, s::bigint source_size, target,
       (size * (floor(rate) + case when draw < rate - floor(rate) then 1 else 0 end))::bigint taken from r"""


@register("op8_mixing", _MIXING_SQL)
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    taken = mixing.copies(docs, mixing.word_count(F.col("text")))
    return taken.select("doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
                        F.col("mix_target").alias("target"),
                        (F.col("mix_size") * F.col("mix_copies")).alias("taken"))


# 9 -------------------------------------------------------------- token counts
@register("op9_token_counts")
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


# 10 ------------------------------------------------------- nearest neighbours
@register("op10_ann_forest")
def op10_ann_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.search(vectors.filter(F.col("vec_id") % 50 == 0), vectors)


# 11 ------------------------------------------------------------ binary records
@register("op11_binary_records")
def op11_binary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = records.new_folder(spark)
    records.write_records(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), folder)
    return records.read_records(spark, folder).select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


# 12 ----------------------------------------------------------- lexical search
_LEXICAL_SQL = r"""
with d as (select row_number() over () r, doc_id, regexp_extract_all(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') ts from documents),
s as (select count(*) n, sum(len(ts))::bigint l from d where len(ts) > 0),
p as (select r, t, count(*) tf from (select r, unnest(ts) t from d) group by r, t),
w as (select t, floor(1000 * ln((2 * any_value(n) + 2)::double / (2 * count(*) + 1)))::bigint w from p, s group by t),
m as (select r, doc_id, 100 - 90 + (90 * len(ts) * n) // l m from d, s where len(ts) > 0),
q as (select row_number() over () qr, item_id, list_distinct(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) ts from benchmark),
x as (select qr, item_id, unnest(ts) t from q),
f as (select qr, item_id, doc_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint score
      from x join p using (t) join w using (t) join m using (r) group by all),
k as (select *, row_number() over (partition by qr order by score desc, doc_id) rank from f where score > 0)
select item_id, rank::int rank, doc_id, score from k where rank <= 10"""


@register("op12_lexical_search", _LEXICAL_SQL)
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(lexical.build_index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


# 13 ----------------------------------------------------- conversation repair
@register("op13_conversation_repair")
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversations.damage(table(spark, sf_dir, "conversations"))
    return conversations.repair(rows).withColumnRenamed("conv", "conv_id")
