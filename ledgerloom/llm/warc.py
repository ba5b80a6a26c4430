"""WARC derivatives (4): from response records to linked metadata and
plain-text conversion records, row by row with DataFrame functions.

``responses`` makes response records of pages; ``derive`` makes, for each
response, one 'metadata' and one 'conversion' record that refer to it and keep
its target, date, source headers and digests; ``write_warc`` writes records as
WARC 1.1 text. Record ids are computed from the content, so a retried task
writes the same records.
"""

from __future__ import annotations

import re
from functools import reduce
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let

CRLF = "\r\n"
#: Blocks whose content is not text; an open one ends with the page.
HIDDEN = (r"(?is)<(?:!--.*?(?:-->|\z)|script\b.*?(?:</script[^>]*>|\z)|style\b.*?(?:</style[^>]*>|\z)"
          r"|noscript\b.*?(?:</noscript[^>]*>|\z)|template\b.*?(?:</template[^>]*>|\z))")
#: White space that becomes a blank.
WHITE = ("\t", "\n", "\x0b", "\f", "\r")
#: Tags that end a line of text.
BREAKS = (r"(?i)</?(?:p|div|br|hr|li|ul|ol|dl|dt|dd|tr|table|thead|tbody|h[1-6]|title|article|section|header|footer"
          r"|nav|aside|main|blockquote|pre|form|figure|figcaption|option)(?:[\s/][^<>]*)?>")
TAGS = r"<[/!?]?[A-Za-z][^<>]*>"
# Common references; &amp; is decoded last.
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"),
            ("&copy;", "©"), ("&reg;", "®"), ("&middot;", "·"), ("&mdash;", "—"), ("&ndash;", "–"),
            ("&hellip;", "…"), ("&laquo;", "«"), ("&raquo;", "»"), ("&euro;", "€"), ("&amp;", "&"))


#: A reference that ENTITIES lacks.
RARE = (r"&(?!(?:" + "|".join(re.escape(e[1:-1]) for e, _ in ENTITIES)
        + r");)(?:#[0-9]|#[xX][0-9A-Fa-f]|[A-Za-z][A-Za-z0-9]*;)")
REFERENCE = r"^(?:#[0-9]+;?|#[xX][0-9A-Fa-f]+;?|[A-Za-z][A-Za-z0-9]*;)"
#: The first href of a link; other attributes are passed whole, so no value or longer name is taken for it.
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+)"""
#: Attributes before it are passed by a possessive group, which Java's matcher repeats in a loop, not by recursion.
HREF = (r"(?i)<a(?=[\s/])(?:[\s/]*+(?!href\s*+=)[^\s/>=<]++(?:\s*+=\s*+" + _VALUE + r")?+)*+[\s/]*+href\s*+=\s*+("
        + _VALUE + r"|(?=>))")


def _blank(text: str) -> str:
    """White space and no-break spaces of references become blanks, as those of the page do."""
    return " " if text in (*WHITE, "\xa0") else text


def _table() -> str:
    """name; or number (8 hexadecimal digits) and text of references: the
    common names, all other names of HTML, and the numbers that do not stand
    for their own code point or that UTF-32 would drop."""
    names = {e[1:]: t for e, t in ENTITIES if e[1] != "#"}
    names |= {n: _blank(t) for n, t in html5.items() if n.endswith(";") and n not in names}
    numbers = {n: _blank(chr(n)) for n in (9, 10, 11, 12, 13, 0xA0, 0xFEFF)} | {0: "�"}
    for n in range(0x80, 0xA0):
        numbers[n] = bytes([n]).decode("cp1252", "ignore") or chr(n)
    return "\x01".join(f"{k}\x02{v}" for k, v in {**names, **{f"{n:08X}": t for n, t in numbers.items()}}.items())


TABLE = _table()


def references(text: Column) -> Column:
    """Every numeric and named reference of HTML decoded, once, from left to right."""
    table = F.str_to_map(F.lit(TABLE), F.lit("\x01"), F.lit("\x02"))

    def numeric(ref: Column) -> Column:
        digits = F.regexp_extract(ref, r"^#[xX]?0*([0-9A-Fa-f]*)", 1)
        code = F.when(F.length(digits) > 8, "FFFFFFFF").when(ref.rlike("^#[xX]"), F.lpad(F.upper(digits), 8, "0")) \
            .otherwise(F.lpad(F.hex(F.concat(F.lit("0"), digits).try_cast("bigint")), 8, "0"))
        return let(code, lambda c: F.coalesce(
            table[c], F.when((c > "0010FFFF") | c.between("0000D800", "0000DFFF"), "�")
            .otherwise(F.decode(F.unhex(c), "UTF-32"))))

    def decoded(part: Column) -> Column:
        return let(F.regexp_extract(part, REFERENCE, 0), lambda ref: F.concat(
            F.coalesce(F.when(ref.startswith("#"), numeric(ref)).otherwise(table[ref]), F.concat(F.lit("&"), ref)),
            F.substring(part, F.length(ref) + 1, F.length(part))))

    return F.array_join(F.transform(F.split(text, "&"), lambda part, k: F.when(k == 0, part).otherwise(decoded(part))), "")


def unescape(text: Column, page: Column) -> Column:
    """References decoded. Most pages hold common ones only, which needs no cutting."""
    common = reduce(lambda c, e: F.replace(c, F.lit(e[0]), F.lit(e[1])), ENTITIES, text)
    return F.when(page.rlike(RARE), references(text)).otherwise(common)


def shown(html: Column) -> Column:
    """The page without comments, scripts, styles, noscript and template blocks."""
    return F.regexp_replace(F.coalesce(html, F.lit("")), HIDDEN, " ")


def plain_text(html: Column, body: Column) -> Column:
    """Visible text of ``body`` (the page's ``shown`` part): block tags as line
    ends, other tags out, references decoded, blanks and empty lines folded."""
    t = body
    t = reduce(lambda c, w: F.replace(c, F.lit(w), F.lit(" ")), WHITE, t)
    t = unescape(F.regexp_replace(F.regexp_replace(t, BREAKS, "\n"), TAGS, ""), html)
    t = F.replace(F.regexp_replace(t, r" {2,}", " "), F.lit(" \n"), F.lit("\n"))
    return F.btrim(F.regexp_replace(t, r"\n[ \n]+", "\n"), F.lit(" \n"))


def digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text.cast("binary"), 256))


def record_id(*parts: Column) -> Column:
    """A urn:uuid computed from the parts (version and variant bits of a name-based UUID set)."""
    h = F.sha2(F.concat_ws("\u0000", *parts).cast("binary"), 256)
    return F.concat(F.lit("<urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-8"),
                    F.substring(h, 14, 3), F.lit("-a"), F.substring(h, 18, 3), F.lit("-"),
                    F.substring(h, 21, 12), F.lit(">"))


def responses(pages: DataFrame, date: str = "1970-01-01T00:00:00Z", id_col: str = "page_id",
              url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Response records of pages: id, record_id, target_uri, date, http_headers,
    payload, payload_digest."""
    pages = pages.select(F.col(id_col).alias("id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"),
                         F.coalesce(F.col(html_col), F.lit("")).alias("html"),
                         digest(F.coalesce(F.col(html_col), F.lit(""))).alias("payload_digest"))
    id_, url, html = F.col("id"), F.col("url"), F.col("html")
    length = F.octet_length(html).cast("string")
    head = F.concat(F.lit("HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=utf-8" + CRLF
                          + "Content-Length: "), length, F.lit(CRLF))
    own = record_id(F.lit("response"), F.coalesce(id_.cast("string"), F.lit("")), url, F.col("payload_digest"))
    return pages.select("id", own.alias("record_id"), url.alias("target_uri"), F.lit(date).alias("date"),
                        head.alias("http_headers"), html.alias("payload"), "payload_digest")


def _header(kind: str, target: Column, date: Column, extra: list[tuple[str, Column]], content_type: str,
            block: Column) -> Column:
    lines = [F.lit("WARC/1.1"), F.lit(f"WARC-Type: {kind}"), F.concat(F.lit("WARC-Target-URI: "), target),
             F.concat(F.lit("WARC-Date: "), date), *[F.concat(F.lit(f"{k}: "), v) for k, v in extra],
             F.concat(F.lit("WARC-Block-Digest: "), F.col("payload_digest")), F.lit(f"Content-Type: {content_type}"),
             F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))]
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF))


def derive(response: DataFrame) -> DataFrame:
    """Two rows per response: (id, warc_type, record_id, refers_to, target_uri,
    date, content_type, payload_digest, source_digest, header, block).

    'metadata' holds application/warc-fields: the response's HTTP headers, one
    field each, prefixed ``source-``; its payload digest and length; title,
    language and the outlinks of the page (the href of each <a>, in double,
    single or no quotes, as written; none from comments, scripts and the like). 'conversion' holds the plain text.
    References are decoded in text and title: all names of HTML, which need
    their ';' (one cut off stays as it is), and numbers, decimal and hex.
    Both name the response in WARC-Refers-To and repeat its target and date,
    and the conversion's header also carries the source's digest.

    NULL or empty payload: both records, with empty text and no links. NULL
    ids or targets become empty fields. Repeated rows give equal records. Very
    long payloads are converted whole. Empty table: no rows.
    """
    html = F.col("payload")
    title = F.regexp_replace(unescape(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title", 1), html), r"\s+", " ")
    lang = F.regexp_extract(html, r"(?i)<html[^>]*\blang=[\"']?([A-Za-z-]+)", 1)
    links = F.transform(F.regexp_extract_all("shown", F.lit(HREF), 1), lambda v: F.when(
        F.substring(v, 1, 1).isin('"', "'"), F.substring(v, F.lit(2), F.length(v) - 2)).otherwise(v))
    fields = F.filter(F.split("http_headers", CRLF), lambda s: s.contains(":"))
    staged = response.withColumn("shown", shown(html)).select("id", "record_id", "target_uri", "date", F.col("payload_digest").alias("source_digest"),
                             F.octet_length(html).cast("string").alias("size"), title.alias("title"),
                             lang.alias("lang"), links.alias("links"), fields.alias("fields"),
                             plain_text(html, F.col("shown")).alias("text"))
    lines = F.concat(
        F.array(F.concat(F.lit("source-digest: "), F.col("source_digest")),
                F.concat(F.lit("source-length: "), F.col("size")),
                F.concat(F.lit("title: "), F.trim("title")), F.concat(F.lit("lang: "), F.col("lang"))),
        F.transform("fields", lambda s: F.concat(F.lit("source-"), s)),
        F.transform("links", lambda s: F.concat(F.lit("outlink: "), s)))
    both = staged.select(
        "id", F.col("record_id").alias("refers_to"), "target_uri", "date", "source_digest",
        F.explode(F.array(
            F.struct(F.lit("metadata").alias("warc_type"), F.lit("application/warc-fields").alias("content_type"),
                     F.concat(F.array_join(lines, CRLF), F.lit(CRLF)).alias("block")),
            F.struct(F.lit("conversion").alias("warc_type"), F.lit("text/plain; charset=utf-8").alias("content_type"),
                     F.col("text").alias("block")))).alias("r")) \
        .select("id", "refers_to", "target_uri", "date", "source_digest", "r.*")
    out = both.withColumn("payload_digest", digest(F.col("block"))).withColumn(
        "record_id", record_id(F.col("warc_type"), F.col("refers_to"), F.col("payload_digest")))
    extra = [("WARC-Record-ID", F.col("record_id")), ("WARC-Refers-To", F.col("refers_to")),
             ("WARC-Refers-To-Target-URI", F.col("target_uri")), ("WARC-Refers-To-Date", F.col("date")),
             ("WARC-Source-Payload-Digest", F.col("source_digest"))]
    header = F.when(F.col("warc_type") == "metadata", _header(
        "metadata", F.col("target_uri"), F.col("date"), extra, "application/warc-fields", F.col("block"))) \
        .otherwise(_header("conversion", F.col("target_uri"), F.col("date"), extra,
                           "text/plain; charset=utf-8", F.col("block")))
    return out.select("id", "warc_type", "record_id", "refers_to", "target_uri", "date", "content_type",
                      "payload_digest", "source_digest", header.alias("header"), "block")


def write_warc(records: DataFrame, path: str) -> None:
    """Write records (columns header, block) as WARC files, one a partition:
    header, an empty line, the block, two line ends."""
    (records.select(F.concat("header", F.lit(CRLF), "block").alias("value"))
     .write.option("lineSep", CRLF + CRLF).text(path))
