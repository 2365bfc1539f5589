"""Page text, metadata, links and crawl queries over ``pages``, ``documents`` and a
part↔supplier graph from ``lineitem``."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions import text as TX
from tidewater.functions import urls as U
from tidewater.operators import links as L
from tidewater.operators import pages as P
from tidewater.plans.registry import query
from tidewater.tables import table

RUN_TS = "2024-02-01T00:00:00+00:00"
SEEDS = ["p1", "p2", "p3"]
DEPTH_LIMIT = 3

# ---- The oracles read the generated pages by their known build (one <article>, quoted hrefs,
# no '>' in attributes, a handful of references), not by the scanner's rules. ----
_SPACE = "[" + r"\s\x0b\x1c-\x1f\x85\p{Z}" + "]"
_REFERENCES = [("&quot;?", '"'), ("&copy;?", "©"), ("&middot;?", "·"), ("&lt;?", "<"), ("&gt;?", ">"), ("&#x27;", "''"), ("&amp;?", "&")]


def sql_decode(x: str) -> str:
    for pattern, char in _REFERENCES:
        x = f"regexp_replace({x}, '{pattern}', '{char}', 'g')"
    return x


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_SPACE}+|{_SPACE}+$', '', 'g')"


def sql_html_text(x: str) -> str:
    for block in ("<script>.*?</script>", "<style>.*?</style>", "<!--.*?-->"):
        x = f"regexp_replace({x}, '(?s){block}', '<i>', 'g')"
    pieces = (f"list_transform(string_split({x}, '<'), lambda p, i: CASE WHEN i = 1 THEN p "
              f"WHEN contains(p, '>') THEN substr(p, strpos(p, '>') + 1) ELSE '' END)")
    runs = f"list_transform({pieces}, lambda p: {sql_strip(sql_decode('p'))})"
    return f"array_to_string(list_filter({runs}, lambda p: p <> ''), ' ')"


def sql_clean_text(x: str) -> str:
    s = f"regexp_replace({x}, '{_SPACE}+', ' ', 'g')"
    s = f"regexp_replace({s}, '[{chr(92)}p{{Cc}}{chr(92)}p{{Cf}}{chr(92)}p{{Co}}{chr(92)}p{{Cs}}]', '', 'g')"
    return f"trim({s}, ' ')"


def sql_title(x: str) -> str:
    run = lambda tag: f"split_part(split_part({x}, '<{tag}>', 2), '<', 1)"
    return (f"CASE WHEN {run('title')} <> '' THEN {sql_strip(sql_decode(run('title')))} "
            f"WHEN {run('h1')} <> '' THEN {sql_strip(sql_decode(run('h1')))} END")


def sql_body(x: str) -> str:
    inner = f"split_part({x}, '<article>', 2)"
    return f"('<article>' || CASE WHEN contains({inner}, '</article>') THEN split_part({inner}, '</article>', 1) || '</article>' ELSE {inner} END)"


def sql_links(html: str, url: str) -> str:
    """The pages' hrefs are site-absolute paths: the origin is put before them."""
    hrefs = f"""regexp_extract_all({html}, 'href="([^"]*)"', 1)"""
    origin = f"array_to_string(string_split({url}, '/')[1:3], '/')"
    joined = f"list_transform({hrefs}, lambda h: {origin} || {sql_strip(sql_decode('h'))})"
    return f"list_filter({joined}, lambda x, i: list_position({joined}, x) = i)"


# ------------------------------------------------------------------------------------


@query("html_text", f"SELECT page_id, {sql_html_text('html')} AS text FROM pages")
def q_html_text(spark, sf_dir):
    return TX.with_html_text(table(spark, sf_dir, "pages"), "html", "text").select("page_id", "text")


@query("clean_text", f"SELECT doc_id, {sql_clean_text('text')} AS text FROM documents")
def q_clean_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", TX.clean_text(F.col("text")).alias("text"))


@query("scan_pages", "SELECT page_id, url, html FROM pages")
def q_scan_pages(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", "url", "html")


@query("page_body", f"""
SELECT page_id, {sql_body('html')} AS body_html,
       {sql_clean_text(sql_html_text(sql_body('html')))} AS body_text FROM pages""")
def q_page_body(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", P.page_body(F.col("html")).alias("body_html"))
    return TX.with_html_text(pages, "body_html", "body_text").select(
        "page_id", "body_html", TX.clean_text(F.col("body_text")).alias("body_text"))


def labelled_pages(spark, sf_dir):
    """The pages with the metadata that a wiki's pages carry put into their markup."""
    n = F.col("page_id").cast("string")
    k = lambda m: (F.col("page_id") % m).cast("string")
    head = F.concat(F.lit('<head><meta name="author" content="A&amp;'), k(7), F.lit('"><meta content="cat'), k(5),
                    F.lit('" name=category><meta name="keywords" content="k'), k(3), F.lit(', x,, y ">'))
    body = F.concat(F.lit('<article><span class="x revision">r'), n, F.lit("</span><div id=page-id> P"), n,
                    F.lit('</div><div class="tags"><div><a href="/t">t'), k(4), F.lit(', u</a></div><a href="/v">v</a></div>'))
    marked = F.replace(F.replace(F.col("html"), F.lit("<head>"), head), F.lit("<article>"), body)
    return table(spark, sf_dir, "pages").withColumn("html", marked)


@query("page_metadata", f"""
SELECT page_id, url, {sql_title('html')} AS title, ' P' || page_id AS wiki_page_id, 'r' || page_id AS revision,
       'A&' || page_id % 7 AS author, 'cat' || page_id % 5 AS category,
       ['k' || page_id % 3, 'x', 'y', 't' || page_id % 4, 'u', 'v'] AS tags FROM pages""")
def q_page_metadata(spark, sf_dir):
    return P.page_metadata(labelled_pages(spark, sf_dir))


@query("page_links", f"""
SELECT page_id, CAST(pos - 1 AS INTEGER) AS pos, link FROM (
  SELECT page_id, unnest({sql_links('html', 'url')}) AS link,
         generate_subscripts({sql_links('html', 'url')}, 1) AS pos FROM pages)""")
def q_page_links(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", F.posexplode(P.page_links(F.col("html"), F.col("url"))).alias("pos", "link"))


_ORIGIN = "array_to_string(string_split(url, '/')[1:3], '/')"
_BARE = "split_part(split_part(url, '#', 1), '?', 1)"
_FOLDER = f"substr({_BARE}, 1, length({_BARE}) - strpos(reverse({_BARE}), '/') + 1)"
_PARENT = f"regexp_replace({_FOLDER}, '[^/]+/$', '')"
#: Relative references and what they resolve to on a page, by the parts of its address.
RELATIVE = [
    ("up", "../img/x.html", f"{_PARENT} || 'img/x.html'"), ("here", "./", _FOLDER), ("beside", "other", f"{_FOLDER} || 'other'"),
    ("below", "a/./b/../c/", f"{_FOLDER} || 'a/c/'"), ("beyond", "../../../../../../../z", f"{_ORIGIN} || '/z'"),
    ("rooted", "/r/../s/./t?u=/v/../w", f"{_ORIGIN} || '/s/t?u=/v/../w'"), ("query", "?p=/a/../b", f"{_BARE} || '?p=/a/../b'"),
    ("fragment", "#s", "split_part(url, '#', 1) || '#s'"), ("network", "//cdn.example.net/y", "split_part(url, '/', 1) || '//cdn.example.net/y'"),
    ("absolute", "https://o.example.org/../p", "'https://o.example.org/../p'"), ("dots", "..", _PARENT), ("self", "", "url"),
]


@query("relative_links", " UNION ALL ".join(f"SELECT page_id, '{n}' AS kind, {sql} AS link FROM pages" for n, _, sql in RELATIVE))
def q_relative_links(spark, sf_dir):
    """Every form of reference, resolved against every page's address."""
    forms = F.array(*[F.struct(F.lit(n).alias("kind"), F.lit(h).alias("href")) for n, h, _ in RELATIVE])
    each = table(spark, sf_dir, "pages").select("page_id", "url", F.explode(forms).alias("f"))
    return each.select("page_id", F.col("f.kind").alias("kind"), U.url_join(F.col("url"), F.col("f.href")).alias("link"))


@query("links_out", f"SELECT page_id, CAST(len({sql_links('html', 'url')}) AS INTEGER) AS links_out FROM pages")
def q_links_out(spark, sf_dir):
    return L.links_out(table(spark, sf_dir, "pages"))


@query("host_stats", """
SELECT CASE WHEN contains(url, '//') THEN regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*:?//([^/?#]*)', 1)
            ELSE 'unknown' END AS host, count(*) AS requests
FROM pages GROUP BY ALL""")
def q_host_stats(spark, sf_dir):
    return P.host_stats(table(spark, sf_dir, "pages"))


@query("error_stats", """
SELECT CASE WHEN value < 50 THEN 'timeout' ELSE 'refused' END AS error_type, count(*) AS errors
FROM events WHERE event_type = 'error' GROUP BY ALL""")
def q_error_stats(spark, sf_dir):
    """Failed requests by kind of error; the error events stand for failed requests."""
    kind = F.when(F.col("value") < 50, "timeout").otherwise("refused")
    requests = table(spark, sf_dir, "events").select(F.when(F.col("event_type") == "error", kind).alias("error_type"))
    return P.error_stats(requests)


@query("crawl_items", f"""
SELECT page_id, url, {sql_title('html')} AS title, {sql_body('html')} AS content, 'wiki' AS source,
       'text/html' AS content_type, 0 AS depth, NULL::VARCHAR AS wiki_page_id, NULL::VARCHAR AS revision,
       NULL::VARCHAR AS author, NULL::VARCHAR AS category, CAST([] AS VARCHAR[]) AS tags,
       NULL::VARCHAR AS last_modified, CAST(len({sql_links('html', 'url')}) AS INTEGER) AS links_out
FROM pages""")
def q_crawl_items(spark, sf_dir):
    return P.crawl_items(table(spark, sf_dir, "pages"))


_HTML_HEADS = " OR ".join(f"contains(lower(substr(c, 1, 500)), '{m}')" for m in ("<html", "<!doctype", "<div", "<p>", "<span"))


@query("clean_pages", f"""
SELECT page_id, url,
       CASE WHEN t IS NOT NULL AND t <> '' THEN {sql_clean_text(sql_html_text('t'))} ELSE t END AS title,
       CASE WHEN c IS NOT NULL AND c <> '' THEN {sql_clean_text(
           f"CASE WHEN {_HTML_HEADS} THEN {sql_html_text('c')} ELSE c END")} ELSE c END AS content,
       '{RUN_TS}' AS crawl_timestamp
FROM (SELECT page_id, url, {sql_title('html')} AS t, {sql_body('html')} AS c FROM pages)""")
def q_clean_pages(spark, sf_dir):
    items = P.crawl_items(table(spark, sf_dir, "pages")).select("page_id", "url", "title", "content")
    return P.clean_items(items, RUN_TS)


def part_supplier_edges(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    p = F.concat(F.lit("p"), F.col("l_partkey").cast("string"))
    s = F.concat(F.lit("s"), F.col("l_suppkey").cast("string"))
    return li.select(p.alias("src"), s.alias("dst")).unionByName(li.select(s.alias("src"), p.alias("dst")))


def _reach_sql(depth: int) -> str:
    return f"""
WITH RECURSIVE e AS (SELECT DISTINCT 'p' || l_partkey AS src, 's' || l_suppkey AS dst FROM lineitem
                     UNION SELECT DISTINCT 's' || l_suppkey, 'p' || l_partkey FROM lineitem),
bfs(url, depth) AS (SELECT * FROM (VALUES {", ".join(f"('{s}', 0)" for s in SEEDS)}) t(url, depth)
                    UNION SELECT e.dst, b.depth + 1 FROM bfs b JOIN e ON e.src = b.url
                    WHERE b.depth < {depth})
SELECT url, CAST(min(depth) AS INTEGER) AS depth FROM bfs GROUP BY url"""


def _reach(spark, sf_dir, depth, **limits):
    seeds = spark.createDataFrame([(s,) for s in SEEDS], "url string")
    return L.crawl_frontier(part_supplier_edges(spark, sf_dir), seeds, depth, **limits)


@query("crawl_frontier", _reach_sql(DEPTH_LIMIT))
def q_crawl_frontier(spark, sf_dir):
    return _reach(spark, sf_dir, DEPTH_LIMIT)


@query("crawl_deep", _reach_sql(10))
def q_crawl_deep(spark, sf_dir):
    """The same walk to depth 10, a source of more than 20 edges dealt to several buckets."""
    return _reach(spark, sf_dir, 10, hot_edges=20)
