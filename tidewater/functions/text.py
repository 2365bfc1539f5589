"""Column functions for page text: HTML to visible text, entity decoding, text cleaning.

Cleaning, trimming and sniffing are built-in expressions. Markup and character references go
through vectorised functions over ``functions.markup``: neither a regular expression nor a
short table of names can read every page.
"""

from __future__ import annotations

import html
import sys
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.markup import visible_text

# Python's str.isspace() set, spelled for Java regex (\s alone is ASCII-only in Java).
WS_CLASS = r"[\t\n\x0B\f\r\x1c-\x1f\x85\p{Z}]"

# Markers that make the item pipeline treat content as HTML (in its first characters).
HTML_MARKERS = ["<html", "<!doctype", "<div", "<p>", "<span"]

# How much of a content is sniffed for markup.
SNIFF_CHARS = 500


# Rows that a task's Python holds as strings at a time.
SLICE_ROWS = 128

# Every character Python's str.isspace() accepts (the same set as WS_CLASS), for trim().
WS_CHARS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def _printable_ranges() -> str:
    """Python's printable characters beyond ASCII as ranges of a Java character class."""
    codes = [c for c in range(0x80, sys.maxunicode + 1) if chr(c).isprintable()]
    starts = [c for i, c in enumerate(codes) if i == 0 or codes[i - 1] != c - 1]
    ends = [c for i, c in enumerate(codes) if i + 1 == len(codes) or codes[i + 1] != c + 1]
    return "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in zip(starts, ends, strict=True))


# What the JVM takes for a control, format, private or unassigned character, except what Python prints:
# the two know different versions of Unicode. The ranges are looked at only for the few that are \p{C}.
NOT_PRINTABLE = rf"[\p{{C}}&&[^{_printable_ranges()}]]"


def map_slices(f: Callable, kind: pa.DataType, *columns: pa.Array) -> pa.Array:
    """``f`` of every row, as an array of ``kind``. Rows are Python objects ``SLICE_ROWS`` at a time, so a
    batch is held as Arrow alone. Functions that take whole batches share a worker; iterators each have theirs."""
    parts = []
    for lo in range(0, len(columns[0]), SLICE_ROWS):
        rows = zip(*(c.slice(lo, SLICE_ROWS).to_pylist() for c in columns), strict=True)
        parts.append(pa.array([f(*row) for row in rows], kind))
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


@F.arrow_udf(T.StringType())
def _decoded(texts: pa.Array) -> pa.Array:
    return map_slices(lambda t: None if t is None else html.unescape(t), pa.string(), texts)


@F.arrow_udf(T.StringType())
def _visible(pages: pa.Array) -> pa.Array:
    return map_slices(visible_text, pa.string(), pages)


def decode_entities(s: Column) -> Column:
    """Decode character references as HTML5 does: all names, invalid numbers to U+FFFD."""
    return _decoded(s)


def strip_ws(s: Column) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace (ends only)."""
    return F.trim(s, F.lit(WS_CHARS))


def html_text(page: Column) -> Column:
    """Visible text of HTML: every text run between markup, decoded and stripped, empty runs
    dropped, joined by one space; script/style/noscript content is skipped."""
    return _visible(page)


def with_html_text(df: DataFrame, src: str, dst: str) -> DataFrame:
    """``dst = html_text(src)``."""
    return df.withColumn(dst, html_text(F.col(src)))


def clean_text(text: Column) -> Column:
    """Collapse every whitespace run to one space, drop non-printable characters, strip.

    Non-printables are removed *after* the collapse, so two spaces can remain where a
    control character sat between them (same order as the upstream pipeline).
    """
    s = F.regexp_replace(text, rf"{WS_CLASS}+", " ")
    s = F.regexp_replace(s, NOT_PRINTABLE, "")
    return F.trim(s)


def looks_like_html(content: Column, sniff_chars: int = SNIFF_CHARS) -> Column:
    """Any of ``HTML_MARKERS`` within the first ``sniff_chars`` characters (lower-cased)."""
    head = F.lower(F.substring(content, 1, sniff_chars))
    cond = F.lit(False)
    for m in HTML_MARKERS:
        cond = cond | head.contains(m)
    return cond


def estimate_tokens(text: Column) -> Column:
    """Rough token count: characters // 4."""
    return F.floor(F.length(text) / 4).cast("bigint")
