"""Crawled pages: title, main content, wiki metadata, tags, crawl items and cleaning.

A page is read once, by one vectorised function over ``functions.markup`` that returns all the
parts a job asks for; nothing is shuffled.
"""

from __future__ import annotations

import datetime as dt
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions import markup as M
from tidewater.functions import text as TX
from tidewater.functions import urls as U


def _nz(c: Column) -> Column:
    return F.when(c != "", c)


_STRINGS = pa.list_(pa.string())
_HEAD = pa.struct([*[(name, pa.string()) for name in ("title", "wiki_page_id", "revision", "author", "category")],
                   ("tags", _STRINGS), ("links", _STRINGS)])


def _head_reader(deny: str):
    @F.arrow_udf(", ".join(f"{f.name} {'array<string>' if f.type == _STRINGS else 'string'}" for f in _HEAD))
    def read(pages: pa.Array, urls: pa.Array) -> pa.Array:
        pattern = re.compile(deny)

        def head(page: str | None, url: str | None) -> dict:
            h = M.Head(page)
            values = (h.title, *(h.field(f) for f in h.FIELDS), h.tags, h.links(url, pattern, U.FOLLOW_SCHEMES))
            return dict(zip(_HEAD.names, values, strict=True))

        return TX.map_slices(head, _HEAD, pages, urls)

    return read


def page_head(page: Column, url: Column | None = None, deny: str = U.DENY_PATTERN) -> Column:
    """struct(title, wiki_page_id, revision, author, category, tags, links) of a page."""
    return _head_reader(deny)(page, url if url is not None else F.lit(None).cast("string"))


def page_title(page: Column) -> Column:
    """``<title>`` text, else the first ``<h1>`` text; decoded and stripped; NULL when neither has text."""
    return page_head(page)["title"]


@F.arrow_udf(T.StringType())
def _main_area(pages: pa.Array) -> pa.Array:
    return TX.map_slices(M.main_area, pa.string(), pages)


def page_body(page: Column) -> Column:
    """Source of the main content area if identifiable, else of the body; NULL for an empty page."""
    return _main_area(page)


def page_tags(page: Column) -> Column:
    """Keywords meta content plus link texts inside ``.tags``: split on commas, trimmed."""
    return page_head(page)["tags"]


def page_metadata(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """Title plus wiki metadata: page id, revision, author, category (meta element first), tags."""
    rest = [c for c in pages.columns if c != html_col]
    read = pages.select(*rest, page_head(F.col(html_col)).alias("_head"))
    return read.select(*rest, *[F.col("_head")[c].alias(c) for c in
                                ("title", "wiki_page_id", "revision", "author", "category", "tags")])


def page_links(page: Column, base_url: Column, deny: str = U.DENY_PATTERN) -> Column:
    """Absolute, unique (first occurrence order) link targets of ``<a>``/``<area>`` hrefs,
    without denied extensions or non-web schemes."""
    return page_head(page, base_url, deny)["links"]


def crawl_items(pages: DataFrame, depth: Column | int = 0, source: str = "wiki",
                last_modified: Column | None = None) -> DataFrame:
    """Crawl log rows: what the spider yields per fetched page."""
    read = pages.withColumns({"_head": page_head(F.col("html"), F.col("url")), "_content": page_body(F.col("html"))})
    head = lambda c: F.col("_head")[c].alias(c)
    return read.select(
        "page_id", "url", head("title"), F.col("_content").alias("content"),
        F.lit(source).alias("source"), F.lit("text/html").alias("content_type"),
        (F.lit(depth) if isinstance(depth, int) else depth).cast("int").alias("depth"),
        head("wiki_page_id"), head("revision"), head("author"), head("category"), head("tags"),
        (last_modified if last_modified is not None else F.lit(None).cast("string")).alias("last_modified"),
        F.size(F.col("_head")["links"]).alias("links_out"),
    )


def clean_items(items: DataFrame, run_ts: dt.datetime | str) -> DataFrame:
    """Item pipeline: HTML content is stripped (sniffed in its first 500 chars) then cleaned;
    titles are always stripped and cleaned; a missing crawl timestamp gets ``run_ts``."""
    content, title = F.col("content"), F.col("title")
    is_str, has_title = content.isNotNull() & (content != ""), title.isNotNull() & (title != "")
    is_html = is_str & TX.looks_like_html(content)
    # only what looks like HTML goes through the scanner
    staged = items.withColumns({"_text": TX.html_text(F.when(is_html, content)),
                                "_title": TX.html_text(F.when(has_title, title))})
    new_content = F.when(is_str, TX.clean_text(F.when(is_html, F.col("_text")).otherwise(content))).otherwise(content)
    new_title = F.when(has_title, TX.clean_text(F.col("_title"))).otherwise(title)
    ts = F.lit(run_ts if isinstance(run_ts, str) else run_ts.isoformat())
    stamp = (F.coalesce(_nz(F.col("crawl_timestamp")), ts) if "crawl_timestamp" in items.columns else ts)
    return staged.withColumns({"content": new_content, "title": new_title, "crawl_timestamp": stamp}) \
        .drop("_text", "_title")


def host_stats(requests: DataFrame, url_col: str = "url", status_col: str | None = None) -> DataFrame:
    """Requests (and failures when a status column is given) per host."""
    host = U.url_host(F.col(url_col)).alias("host")
    aggs = [F.count(F.lit(1)).alias("requests")]
    if status_col:
        aggs.append(F.count_if(F.col(status_col) != "ok").alias("failures"))
    return requests.groupBy(host).agg(*aggs)


def error_stats(requests: DataFrame, error_col: str = "error_type") -> DataFrame:
    return requests.filter(F.col(error_col).isNotNull()).groupBy(error_col).agg(
        F.count(F.lit(1)).alias("errors"))
