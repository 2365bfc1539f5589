"""Page text functions on literal cases and against the standard library's URL resolution."""

import html
import re
import unicodedata
from urllib.parse import urljoin

from pyspark.sql import functions as F

from tidewater.functions import text as TX
from tidewater.functions import urls as U
from tidewater.operators import pages as P

SF = "/root/testdata/sf0.001"


CASES = [
    ("<p>a &amp;lt; b</p>", "a &lt; b"), ("<div>x<script>var s='</p>';</script>y</div>", "x y"),
    ("<p>&#233;t&#xE9; caf&eacute; &notit; &hellip;</p>", "été café ¬it; …"), ("<!-- c --><p> spaced \n text </p><noscript>hidden</noscript>", "spaced \n text"),
    ('<a title="x>y">link</a>', "link"), ("<p>plain</p>", "plain"), ("no markup at all", "no markup at all"), ("", ""),
    ("&#99999999999999999999;|&#x110000;|&#xD800;|&#0;|&#150;", "\ufffd|\ufffd|\ufffd|\ufffd|–"), ("a < b <", "a < b <"),
    ("<p>open <b>never closed", "open never closed"), ("<script>no end <p>x", ""), ("x<!-- no end <p>y", "x"), ("<p title=it's>t", "t"),
    ("<STYLE>p{}</STYLE>z", "z"), ("<script>a</scripty></script >b", "b"),
]


def test_html_text_cases(spark):
    df = spark.createDataFrame([(h, t) for h, t in CASES] + [(None, None)], "h string, t string")
    for r in df.withColumn("got", TX.html_text(F.col("h"))).collect():
        got = r.got if r.got is None else " ".join(x for x in r.got.split(" ") if x)
        want = r.t if r.t is None else " ".join(x for x in r.t.split(" ") if x)
        assert got == want, r.h


def test_html_text_of_generated_pages(spark):
    """Every word of a page's article is in its text, in order, and no markup is left."""
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    for r in pages.select("html", TX.html_text(F.col("html")).alias("t")).collect():
        article = html.unescape(re.sub(r"<[^>]+>", " ", r.html.split("<article>")[1].split("</article>")[0])).split()
        words = r.t.split()
        at = next(k for k in range(len(words)) if words[k:k + len(article)] == article)
        assert at > 0 and "track(" not in r.t and "<p" not in r.t


CLEAN = [("a\tb\n\nc", "a b c"), ("x\u00a0\u2003y", "x y"), ("zero\u200bwidth", "zerowidth"), ("ctl\x07char", "ctlchar"),
         (" lead and trail ", "lead and trail"), ("emoji \U0001F600 ok", "emoji \U0001F600 ok"), ("a\x1cb", "a b"),
         ("line\u2028sep", "line sep"), ("", ""), ("mixed \t\x00\x01 end", "mixed  end"), ("soft\u00adhyphen", "softhyphen")]


def test_clean_text_on_every_code_point(spark):
    """All 1,114,112 code points but the surrogates, which no UTF-8 text holds."""
    codes = spark.range(0x110000).where("id < 55296 OR id > 57343").select(F.col("id").alias("c"))
    text = F.decode(F.unhex(F.concat(F.lit("00000061"), F.lpad(F.hex("c"), 8, "0"), F.lit("00000062"))), "UTF-32")
    got = {r.c: r.t for r in codes.select("c", TX.clean_text(text).alias("t")).collect()}
    assert len(got) == 0x110000 - 2048

    def plain(t):
        return "".join(c for c in re.sub(r"\s+", " ", t) if c.isprintable()).strip()

    wrong = [hex(c) for c, t in got.items() if t != plain(f"a{chr(c)}b")]
    assert not wrong, (len(wrong), wrong[:20])


def test_clean_text_cases(spark):
    df = spark.createDataFrame([(c, w) for c, w in CLEAN], "t string, w string")
    for r in df.withColumn("got", TX.clean_text(F.col("t"))).collect():
        assert r.got == r.w, r.t


def test_clean_documents_keep_their_words(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for r in docs.select("text", TX.clean_text(F.col("text")).alias("c")).collect():
        assert "  " not in r.c and r.c == r.c.strip()
        assert not any(unicodedata.category(ch)[0] == "C" for ch in r.c)
        assert r.c.split(" ") == [w for w in ("".join(ch for ch in w if unicodedata.category(ch)[0] != "C") for w in r.text.split()) if w] or not r.c


BASES = ["https://wiki.example.com:8080/a/b/page.html?x=1#top", "http://h.org", "http://h.org/", "http://h.org/one", "https://h.org/d/e/f/?q=/a/../b"]
HREFS = ["/root", "rel", "../up", "./same", "?q=2", "#frag", "//cdn.example.net/x", "http://o.org/p", "sub/dir/", "", "..", ".", "./././x", "../../../../../x",
         "/a/../b", "/a/./b/.", "/a/..", "r?x=/q/../z", "r#/../f", "a/b/../../c", "./", "../", "a//b", "/a//b/../c", "?", "#", "x;p=1", "..x", "x..", "a/../../.."]


def test_url_join_matches_urllib(spark):
    pairs = [(b, h) for b in BASES for h in HREFS]
    df = spark.createDataFrame(pairs, "b string, h string").withColumn("u", U.url_join(F.col("b"), F.col("h")))
    wrong = [(r.b, r.h, r.u, urljoin(r.b, r.h)) for r in df.collect() if r.u != urljoin(r.b, r.h)]
    assert not wrong, wrong
    assert spark.range(1).select(U.url_host(F.lit(BASES[0])).alias("h")).first().h == "wiki.example.com:8080"
    assert spark.range(1).select(U.url_host(F.lit("no-scheme")).alias("h")).first().h == "unknown"


def test_main_area_is_whole(spark):
    cases = [('<body><div id="content"><div>T</div><p>Body</p></div>x</body>', '<div id="content"><div>T</div><p>Body</p></div>'),
             ("<body><p>no end", "<body><p>no end"), ("<p>bare</p>", "<p>bare</p>"), ("", None), (None, None),
             ('<section class="a page-content"><section>i</section>o</section>z', '<section class="a page-content"><section>i</section>o</section>'),
             ("<div><article><p>x</div>y", "<article><p>x"), ("<article>1</article><main>2</main>", "<article>1</article>")]
    df = spark.createDataFrame(cases, "h string, w string").withColumn("got", P.page_body(F.col("h")))
    for r in df.collect():
        assert r.got == r.w, r.h


PAGE = """<html><head><title>  AT&amp;T wiki </title>
<meta name="author" content="Ada"><meta content="cat-1" name="category">
<meta name="keywords" content="alpha, beta,, gamma"></head>
<body><div id="page-id">P-42</div><span class="revision">r7</span>
<div class="tags"><a href="/t/x">delta, eps</a><a href="/t/y">zeta</a></div>
<main><h1>Main</h1><p>Body text</p><a href="doc.pdf">pdf</a><a href="/x#f">x</a><a href="/x#f">dup</a>
<a href="mailto:a@b.c">m</a></main></body></html>"""


def test_page_metadata_and_links(spark):
    df = spark.createDataFrame([(1, "https://w.example.com/wiki/Home", PAGE)], "page_id int, url string, html string")
    m = P.page_metadata(df).first()
    assert m.title == "AT&T wiki" and m.author == "Ada" and m.category == "cat-1"
    assert m.wiki_page_id == "P-42" and m.revision == "r7"
    assert m.tags == ["alpha", "beta", "gamma", "delta", "eps", "zeta"]
    links = df.select(P.page_links(F.col("html"), F.col("url")).alias("l")).first().l
    assert links == ["https://w.example.com/t/x", "https://w.example.com/t/y", "https://w.example.com/x#f"]
    body = df.select(P.page_body(F.col("html")).alias("b")).first().b
    assert body.startswith("<main>") and body.endswith("</main>")


def test_title_falls_back_to_h1(spark):
    df = spark.createDataFrame([("<html><title></title><h1> Head </h1></html>",), ("<p>none</p>",)], "h string")
    assert [r.t for r in df.select(P.page_title(F.col("h")).alias("t")).collect()] == ["Head", None]


def test_clean_items_sniff(spark):
    items = spark.createDataFrame(
        [("<p>Hello <b>world</b></p>", "<b>T</b>", None), ("plain <b> kept", "x", "2023-01-01")],
        "content string, title string, crawl_timestamp string")
    out = P.clean_items(items, "2024-02-01T00:00:00+00:00").collect()
    assert out[0].content == "Hello world" and out[0].title == "T"
    assert out[0].crawl_timestamp == "2024-02-01T00:00:00+00:00"
    assert out[1].content == "plain <b> kept" and out[1].crawl_timestamp == "2023-01-01"


def test_page_readers_share_workers_and_hold_slices(spark, monkeypatch):
    """A page's parts come from one worker, its texts from a second; strings are made a slice at a time."""
    import pyarrow as pa

    pages = spark.createDataFrame([(1, "http://a/", "<title>T</title><main>x</main>")], "page_id int, url string, html string")
    evals = lambda df: df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython")  # noqa: E731, SLF001
    items = P.crawl_items(pages)
    assert evals(items) == 1
    clean = P.clean_items(items.select("page_id", "url", "title", "content"), "2024-01-01")
    assert evals(clean) == 2
    monkeypatch.setattr(TX, "SLICE_ROWS", 3)
    texts = pa.array(["a", None, "", "é"] * 4)
    assert TX.map_slices(lambda t: t and t * 2, pa.string(), texts).to_pylist() == ["aa", None, "", "éé"] * 4
    assert TX.map_slices(str, pa.string(), texts.slice(0, 0)).to_pylist() == []
