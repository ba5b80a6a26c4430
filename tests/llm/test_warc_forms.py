"""Links and references in every form that HTML allows."""
import html
from html.entities import html5

from ledgerloom.llm import warc


def blocks(spark, pages):
    d = spark.createDataFrame([(k, "http://a/", v) for k, v in enumerate(pages)], "page_id long, url string, html string")
    rows = warc.derive(warc.responses(d)).collect()
    return {kind: [r.block for r in sorted(rows, key=lambda r: r.id) if r.warc_type == kind]
            for kind in ("metadata", "conversion")}


def test_links_of_every_form(spark):
    forms = {'<a href="/d">x</a>': ["/d"], "<a href='/s'>x</a>": ["/s"], "<a href=/u>x</a>": ["/u"],
             '<a href = "/b">x</a>': ["/b"], "<A\nclass=c HREF\n=\n'/m n'>x</A>": ["/m n"], "<a href=/u/ >x": ["/u/"],
             '<a title="a>b" href="/t">x</a>': ["/t"], '<a data-href="/no" href="/yes">x</a>': ["/yes"],
             "<a title='href=/no' href=/y?a=b&c=\"d\">x</a>": ['/y?a=b&c="d"'], '<a class="x"href="/near">x</a>': ["/near"],
             "<a href=''>x</a><a href=>y</a>": ["", ""], "<abbr href=/no>x</abbr><a name=n>y</a>": [],
             "<a href='/it\"s'>x</a>": ['/it"s'], "<a href='/1'>x</a> <a href=/2>y</a><a disabled href=\"/3\">z</a>":
             ["/1", "/2", "/3"], "<a/href=/slash>x</a>": ["/slash"], "<a x=abchref=/no>y</a>": []}
    got = blocks(spark, forms)["metadata"]
    assert [[x[9:] for x in b.split("\r\n") if x.startswith("outlink: ")] for b in got] == list(forms.values())


def test_references_of_every_form(spark):
    pages = ["it&#8217;s caf&eacute; &#x27;q&#X27; &#39;", "&amp;lt; &#38;lt; &amp;#8217; &#x26;amp;", "&#128512;&#x1F600;",
             "&#0; &#xD800; &#1114112; &#99999999999999999999; &#x000000000041;", "&#150;&#x80; &unknown; & b &; &# &#x; &#8217",
             "&lang;&NotEqualTilde;&CounterClockwiseContourIntegral; &ETH;&eth;", "A &lt;b&gt; &copy; &hellip; &mdash;"]
    got = blocks(spark, [f"<title>{p}</title>" for p in pages])
    for page, text, meta in zip(pages, got["conversion"], got["metadata"]):
        assert text == html.unescape(page).strip() and f"\r\ntitle: {text}\r\n" in meta
    assert blocks(spark, ["a&#160;&#9;&#10;b&nbsp;&Tab;c&eacute;"])["conversion"] == ["a b cé"]


def test_every_named_reference(spark):
    names = [n for n, t in sorted(html5.items()) if n.endswith(";") and t.strip("\t\n\xa0")]
    page = "".join(f"<p>x&{n}x" for n in names)
    assert blocks(spark, [page])["conversion"] == ["\n".join(f"x{html5[n]}x" for n in names)]


def test_links_that_are_not_shown(spark):
    page = ("<a href=/1>x</a><!-- <a href=/no>x</a> --><script>'<a href=\"/no\">'</script><style><a href=/no></style>"
            "<template><a href=/no></template><a <a href=/2>x</a><a href title=t href=/3>")
    got = blocks(spark, [page])["metadata"][0]
    assert [x[9:] for x in got.split("\r\n") if x.startswith("outlink: ")] == ["/1", "/2", "/3"]


def test_long_tags(spark):
    words = " ".join(["word"] * 1_000_000)
    many = " ".join(f"a{k}=v" for k in range(100_000))
    got = blocks(spark, [f"<p>before<a {words}", f"<a {many} href=/far>x</a>", "<a " * 30_000, f"<a title='{words}' href='/t'>"])
    links = [[x[9:] for x in b.split("\r\n") if x.startswith("outlink: ")] for b in got["metadata"]]
    assert links == [[], ["/far"], [], ["/t"]] and len(got["conversion"]) == 4
