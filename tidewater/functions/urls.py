"""URL column functions: host, join against a base URL, extension and domain filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Link targets the crawler never follows (pattern searched in the absolute URL).
DENY_PATTERN = r"\.(pdf|zip|gz|png|jpg|jpeg|gif|ico|svg|css|js)$"

# Schemes a link extractor keeps.
FOLLOW_SCHEMES = ("http", "https", "file")


def url_host(url: Column) -> Column:
    """Network location (host plus port, as ``urlparse().netloc``); 'unknown' without ``//``."""
    netloc = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*:?//([^/?#]*)", 1)
    return F.when(url.contains("//"), netloc).otherwise(F.lit("unknown"))


def url_scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1))


# Generic URI split: scheme, authority with slashes, path, query with mark, fragment with mark.
_PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?(#.*)?$"


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(url, r"(?s)" + _PARTS, group)


def remove_dot_segments(segments: Column) -> Column:
    """Path segments without ``.`` and ``..``; the root is never left, at any depth."""
    kept = F.aggregate(
        segments, F.array().cast("array<string>"),
        lambda done, s: F.when(s == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .when(s == ".", done).otherwise(F.concat(done, F.array(s))))
    ends_in_dots = F.element_at(segments, -1).isin(".", "..")
    return F.when(ends_in_dots, F.concat(kept, F.array(F.lit("")))).otherwise(kept)


def url_join(base: Column, href: Column) -> Column:
    """``urljoin(base, href)`` for web URLs: absolute, ``//net``, ``/path``, ``?q``, ``#f`` and
    relative references. Dot segments are resolved in the path alone, without a depth limit;
    query and fragment are left as they are."""
    b_scheme, b_net = _part(base, 1), _part(base, 2)
    b_path, b_query = _part(base, 3), _part(base, 4)
    path = _part(href, 3)
    # a mark with nothing behind it counts as absent
    query, fragment = (F.when(F.length(_part(href, g)) > 1, _part(href, g)).otherwise("") for g in (4, 5))
    tail = F.concat(query, fragment)
    origin = F.concat(b_scheme, F.lit(":"), b_net)
    folders = F.slice(F.split(b_path, "/"), 1, F.greatest(F.size(F.split(b_path, "/")) - 1, F.lit(0)))
    joined = F.concat(folders, F.split(path, "/"))
    n = F.size(joined)
    # empty segments inside a merged path vanish; the first and the last keep their meaning
    merged = F.filter(joined, lambda s, i: (s != "") | (i == 0) | (i == n - 1))
    rooted = F.split(path, "/")
    segments = remove_dot_segments(F.when(path.startswith("/"), rooted).otherwise(merged))
    text = F.array_join(segments, "/")
    resolved = F.when(text == "", F.lit("/")).when(text.startswith("/"), text).otherwise(F.concat(F.lit("/"), text))
    return (
        F.when(href == "", base)
        .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), href)
        .when(href.startswith("//"), F.concat(b_scheme, F.lit(":"), href))
        .when((path == "") & (query == ""), F.concat(origin, b_path, b_query, tail))
        .when(path == "", F.concat(origin, b_path, tail))
        .otherwise(F.concat(origin, resolved, tail))
    )


def denied(url: Column, pattern: str = DENY_PATTERN) -> Column:
    return url.rlike(pattern)


def in_domains(url: Column, domains: Sequence[str]) -> Column:
    """Host equals a domain or is a subdomain of it; an empty list allows every host."""
    if not domains:
        return F.lit(True)
    host = F.lower(F.regexp_replace(url_host(url), r":\d+$", ""))
    cond = F.lit(False)
    for d in domains:
        d = d.lower()
        cond = cond | (host == d) | host.endswith("." + d)
    return cond
