import re
import time

from pyspark.sql import functions as F

from tidewater.llm import webpages as W

SCHEMA = "page_id bigint, url string, html string"


def text(source, template=frozenset()):
    return W.Page(source, template).text()


def test_article_of_a_plain_page():
    page = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var a="</p><p>no</p>";</script></head>
    <body><header><h1>Site</h1></header><nav><ul><li><a href=/x>Menu</a></li></ul></nav><!-- ad --><div class="ad">Buy</div>
    <article><header><h1>Head &eacute;&#233;&#xE9; &copy</h1></header><p>One<b> two\n\tthree</b>&nbsp;four<p>Five <i>si</i>x
    <form><p>mail</p></form><ul><li>a<li>b</ul><blockquote>q</blockquote><div id="comments"><p>first!</p></div></article>
    <aside>side</aside><footer>&copy; me</footer></body></html>"""
    assert text(page) == "Head ééé ©\nOne two three four\nFive six\na\nb\nq"


def test_declared_parts():
    for part in ('<div class="cookie-notice">x</div>', '<div id="sidebarLeft">x</div>', '<section class="post-comments">x</section>',
                 '<div role="navigation">x</div>', '<div hidden>x</div>', '<p style="display: none">x</p>', '<div aria-hidden=true>x</div>',
                 '<ul class="menu main">x</ul>', '<noscript>x</noscript>', '<textarea>x</textarea>', '<svg><text>x</text></svg>',
                 '<button>x</button>', '<iframe>x</iframe>', '<select><option>x</select>', '<div class=adBanner>x</div>'):
        assert text(f"<body><p>a</p>{part}<p>b</p></body>") == "a\nb", part
    assert text('<div class="shadow adapt">kept</div><div class="article-header">kept too</div>') == "kept\nkept too"
    assert text('<div class="article-share">x</div><article><div class="header">in</div></article>') == "in"


def test_an_article_keeps_sections_with_telling_names():
    """Inside an article one word of a name is not enough; formulas are text."""
    for name in ('id="related-work"', 'id="side-effects"', 'class="binary-search"', 'class="ad-hoc methods"', 'id="advertisingHistory"'):
        assert text(f"<article><p>a</p><section {name}><p>kept</p></section></article>") == "a\nkept", name
        assert text(f"<main><p>a</p><section {name}><p>kept</p></section></main>") == "a\nkept", name
    for name in ('class="related-posts"', 'id="user-comments"', 'class="share-buttons"', 'class="newsletter-signup"', 'class="ad-slot-3"',
                 'class="comment-list"', 'class="sidebar right"'):
        assert text(f"<article><p>a</p><section {name}><p>x</p></section></article>") == "a", name
    assert text("<article><p>The area is <math><mi>a</mi><mo>=</mo><mn>2</mn></math>.</p></article>") == "The area is a=2."


def test_many_articles_and_adverts_take_linear_time():
    page = "".join(f'<article><p>story {i:05d} of this page</p></article><div class="ad"><p>buy {i}</p></div>' for i in range(20_000))
    started = time.time()
    got = text(f"<body>{page}</body>").split("\n")
    assert len(got) == 20_000 and not any("buy" in t for t in got) and time.time() - started < 20


def test_named_wrappers_of_the_article_stay():
    story = "<h1>Head</h1><p>One two three four five six seven</p>"
    told = "Head\nOne two three four five six seven"
    for page in (f'<div class="content-sidebar-wrap"><article>{story}</article></div>',
                 f'<div class="page no-sidebar"><main>{story}</main></div><div class="sidebar">x</div>',
                 f'<article class="post has-comments category-promotion">{story}<div id="comments"><p>first</p></div></article>',
                 f'<form id="aspnetForm"><div class="menu">x</div><div>{story}</div></form>',
                 f'<main><div class="content-sidebar-wrap"><article>{story}<form><p>mail</p></form></article></div></main>',
                 f'<article><div class="entry no-sidebar">{story}</div></article><div class="ad">{"buy " * 30}</div>',
                 f'<article>{story}</article><div class="related"><div class="ad"><article>x</article></div></div>'):
        assert text(f"<body>{page}</body>") == told, page


def test_regions():
    assert text("<p>out</p><main><p>in</p></main>") == "in"
    assert text("<main><p>lead</p><article><p>in</p></article></main>") == "in"
    assert text("<article></article><p>body</p>") == "body"
    assert text("<article><p>one</p></article><div>x</div><article><p>two</p></article>") == "one\ntwo"


def test_a_small_article_does_not_displace_the_story():
    story, told = "<p>One two three four</p><p>five six</p>", "One two three four\nfive six"
    card = '<article class="card"><p>teaser</p></article>'
    assert text(f"<main><h1>Head</h1>{story}{card}</main>") == f"Head\n{told}\nteaser"
    assert text(f"<main><h1>Head</h1><article>{story}</article></main>") == f"Head\n{told}"
    assert text(f"<p>x</p><main>{story}{card}</main>") == f"{told}\nteaser"
    assert text(f"<div>{story}</div>{card}") == f"{told}\nteaser"
    assert text(f"<div>{story}</div><main>x</main>") == f"{told}\nx"
    assert text(f"<p>x</p><article>{story}</article>") == told


def test_bad_markup_never_fails():
    cases = {"": "", "plain": "plain", "a < b > c": "a < b > c", "<p>x": "x", "<p>a</div></p>b": "a\nb", "x<": "x<", "x<a": "x",
             "<p title='a>b'>t": "t", "<p title=it's>t</p>": "t", "<script>never ends <p>x": "", "<!-- never ends <p>x": "",
             "&bogus; &#99999999999; &#xD800; &#0; &#150;": "&bogus; � � � –", "<b><p>1<p>2</b>3": "1\n23",
             "<table><tr><td>1<td>2<tr><td>3</table>": "1\n2\n3", "</p>x</html>y": "xy", "<br>a<br/>b": "a b",
             "<?xml ?>z<![CDATA[q]]>w": "zw", "<p>t<!-->u": "tu"}
    for source, expect in cases.items():
        assert text(source) == expect, source
    began = time.time()
    for source in ("<div>" * 30_000, "<a b='" * 20_000, "<" * 100_000, "<p>" * 50_000 + "</div>" * 50_000, "<!--" * 50_000, "&" * 200_000):
        text(source)
    assert time.time() - began < 30


def articles(spark, rows, **options):
    got = W.extract_articles(spark.createDataFrame(rows, SCHEMA), **options)
    return {r["page_id"]: r["text"] for r in got.select("page.page_id", "text").collect()}


def test_recurring_subtrees_go(spark):
    page = lambda k, host, extra="": (k, f"https://{host}/p{k}", f"<body><div class=top>Welcome <b>friend</b></div><h1>Title {k}</h1>"  # noqa: E731
                                      f"<p>Story {k}</p>{extra}<div class=end><p>All rights</p></div></body>")
    rows = [page(k, "Big.example:80") for k in range(40)] + [page(100 + k, "small.example") for k in range(3)]
    rows += [page(200 + k, "copies.example")[:2] + (page(200, "copies.example")[2],) for k in range(30)]
    rows += [(300, None, "<p>no url</p>"), (301, "https://big.example/", None), (302, "mailto:x", "<p>odd</p>")]
    got = articles(spark, rows)
    assert all(got[k] == f"Title {k}\nStory {k}" for k in range(40))
    assert got[100] == "Welcome friend\nTitle 100\nStory 100\nAll rights"  # too few pages to tell
    assert got[205] == "Welcome friend\nTitle 200\nStory 200\nAll rights"  # one page under many addresses
    assert (got[300], got[301], got[302]) == ("no url", "", "odd")


def test_the_site_name_as_heading_or_title(spark):
    shell = "<div class=top>Welcome <b>friend</b></div>"
    rows = [(k, f"http://name.example/{k}", f"<title>Site</title><header><h1>Site</h1></header>{shell}<p>Story {k}</p>") for k in range(30)]
    rows += [(100 + k, f"http://logo.example/{k}", f"<h1><a href=/>Site</a></h1>{shell}<p>Story {k}</p>") for k in range(30)]
    rows += [(200 + k, f"http://bare.example/{k}", f"{shell}<p>Story {k}</p>") for k in range(30)]
    rows += [(300 + k, f"http://few.example/{k}", f"{shell}<p>Story {k}</p>") for k in range(5)]
    rows += [(400 + k, f"http://same.example/{k}", f"<title>Site</title>{shell}<p>Story</p>") for k in range(30)]
    got = articles(spark, rows)
    for k in range(30):
        assert got[k] == got[100 + k] == got[200 + k] == f"Story {k}"
        assert got[400 + k] == "Welcome friend\nStory"
    assert got[301] == "Welcome friend\nStory 1"


def test_an_article_keeps_what_recurs_in_it(spark):
    rows = [(k, f"http://h.example/{k}", f"<div>shell</div><article><h1>T{k}</h1><p>Shared line</p><div class=box>Shared box</div><p>{k}</p></article>")
            for k in range(30)]
    got = articles(spark, rows)
    assert all(got[k] == f"T{k}\nShared line\n{k}" for k in range(30))


def test_query(spark, as_documents):
    rows = [(1, "http://a.b/", "<p>x &lt; y</p>"), (1, "http://a.b/", "<p>x &lt; y</p>"), (None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("text", F.lit("mine")).withColumn("host", F.lit(3))
    got = sorted(map(tuple, W.op8_webpages(spark, as_documents(df, "pages")).collect()), key=repr)
    assert got == sorted([(1, "http://a.b/", "x < y", 5)] * 2 + [(None, None, "", 0)], key=repr)
    assert W.op8_webpages(spark, as_documents(spark.createDataFrame([], SCHEMA), "pages")).count() == 0


def test_whole_table_against_the_markup(spark):
    """The tables' pages have one article of h1 and p elements; their text by plain patterns."""
    import html

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    got = {r["page_id"]: r["text"] for r in W.op8_webpages(spark, "/root/testdata/sf0.01").collect()}
    for r in pages:
        body = re.search(r"<article>(.*?)(</article>|$)", r["html"], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " " if "<br" in b else "", b)).split()) for b in re.split(r"</?(?:p|h1)>", body)]
        assert got[r["page_id"]] == "\n".join(b for b in blocks if b)
