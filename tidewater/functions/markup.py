"""Markup reading for page jobs: a linear scanner and the small questions asked of it.

Plain Python over one page, run inside vectorised (Arrow) functions. It never fails: character
references follow HTML5 (``html.unescape``: all names, bad numbers become U+FFFD), tags may be
nested, stray or never closed. Every scan is linear in the page's length.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from urllib.parse import urljoin, urlsplit

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TEXT = frozenset(("script", "style"))
#: Elements whose content is never visible.
HIDDEN = frozenset(("script", "style", "noscript"))

# Main-content selectors, first match in document order.
MAIN_TAGS = ("main", "article")
MAIN_ID = "content"
MAIN_CLASSES = ("wiki-content", "page-content")

_OPEN_OR_CLOSE = re.compile(
    r"<(/?)([A-Za-z][^\s/>]*)"
    r"((?:[\s/]++|[^\s/>=]++(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?)?|=)*+)>")
_PAIR = re.compile(r"([^\s/>=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in RAW_TEXT}

Token = tuple[str, str, str, int, int]  # kind (text, open, close), name or text, attributes, start, end


def scan(page: str) -> Iterator[Token]:
    """Tokens of a page with their offsets; comments and declarations yield nothing."""
    at, n = 0, len(page)
    while at < n:
        left = page.find("<", at)
        left = n if left < 0 else left
        if left > at:
            yield "text", page[at:left], "", at, left
        if left == n:
            return
        m = _OPEN_OR_CLOSE.match(page, left)
        if m:
            at, tag = m.end(), m[2].lower()
            yield "close" if m[1] else "open", tag, m[3], left, at
            if tag in RAW_TEXT and not m[1]:
                end = _RAW_END[tag].search(page, at)
                at = end.start() if end else n
        elif page.startswith("<!--", left):
            end = page.find("-->", left + 2)
            at = end + 3 if end >= 0 else n
        elif page[left + 1:left + 2] in ("!", "?", "/") or page[left + 1:left + 2].isalpha():
            end = page.find(">", left)  # a declaration, or a tag that never ends
            at = end + 1 if end >= 0 else n
        else:
            yield "text", "<", "", left, left + 1
            at = left + 1


def attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _PAIR.finditer(raw):
        out.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
    return out


def visible_text(page: str | None) -> str | None:
    """Text runs outside hidden elements, decoded and stripped, joined by one space."""
    if page is None:
        return None
    parts, hidden = [], False
    for kind, value, _, _, _ in scan(page):
        if kind == "text":
            if not hidden and (run := html.unescape(value).strip()):
                parts.append(run)
        elif value in HIDDEN:
            hidden = kind == "open"
    return " ".join(parts)


def _is_main(tag: str, raw: str) -> bool:
    if tag in MAIN_TAGS:
        return True
    if not raw.strip():
        return False
    a = attributes(raw)
    return a.get("id") == MAIN_ID or any(c in a.get("class", "").split() for c in MAIN_CLASSES)


def _element(page: str, wanted) -> str | None:
    """Source of the first element for which ``wanted(tag, attributes)`` holds, nested ones included."""
    stack: list[str] = []
    begin = depth = -1
    for kind, tag, raw, start, end in scan(page):
        if kind == "open":
            if begin < 0 and wanted(tag, raw):
                if tag in VOID:
                    return page[start:end]
                begin, depth = start, len(stack)
            if tag not in VOID:
                stack.append(tag)
        elif kind == "close" and tag in stack:
            at = len(stack) - 1 - stack[::-1].index(tag)
            if 0 <= begin and at <= depth:
                return page[begin:end if at == depth else start]
            del stack[at:]
    return page[begin:] if begin >= 0 else None


def main_area(page: str | None) -> str | None:
    """Source of the main area, else of the body, else of a page without either; None if empty."""
    if not page:
        return None
    return _element(page, _is_main) or _element(page, lambda tag, _: tag == "body") or page


class Head:
    """Title, metadata, tags and links, from one scan."""

    FIELDS = ("page-id", "revision", "author", "category")

    def __init__(self, page: str | None):
        self.title: str | None = None
        self.meta: dict[str, str] = {}
        self.labelled: dict[str, str] = {}
        self.tags: list[str] = []
        self.hrefs: list[str] = []
        first: dict[str, str] = {}  # first text run of title and h1
        waiting: list[tuple[dict[str, str], str]] = []  # where the next text run goes
        tag_depth, open_link = 0, None
        stack: list[str] = []
        for kind, value, raw, _, _ in scan(page or ""):
            if kind == "text":
                for table, key in waiting:
                    table.setdefault(key, value)
                waiting = []
                if open_link is not None:
                    open_link += value
                continue
            waiting = []
            if kind == "close":
                if value == "a" and open_link is not None:
                    self._add_tags(html.unescape(open_link))
                    open_link = None
                if tag_depth and value in stack:
                    del stack[len(stack) - 1 - stack[::-1].index(value):]
                    if len(stack) < tag_depth:
                        tag_depth = 0
                elif value in stack:
                    del stack[len(stack) - 1 - stack[::-1].index(value):]
                continue
            if value not in VOID:
                stack.append(value)
            if value in ("title", "h1") and value not in first:
                waiting.append((first, value))
            if not raw.strip(" /"):
                continue
            a = attributes(raw)
            if value == "meta" and "content" in a:
                name = a.get("name", "")
                if name == "keywords":
                    self._add_tags(a["content"])
                elif name:
                    self.meta.setdefault(name, a["content"])
            if value in ("a", "area") and "href" in a:
                self.hrefs.append(a["href"].strip())
                if tag_depth and value == "a":
                    open_link = ""
            classes = a.get("class", "").split()
            if "tags" in classes and not tag_depth and value not in VOID:
                tag_depth = len(stack)
            if a.get("id") == "page-id" and "page-id" not in self.labelled:
                waiting.append((self.labelled, "page-id"))
            for c in ("revision", "author", "category"):
                if c in classes and c not in self.labelled:
                    waiting.append((self.labelled, c))
        for key in ("title", "h1"):
            if first.get(key):
                self.title = html.unescape(first[key]).strip()
                break

    def _add_tags(self, text: str) -> None:
        self.tags += [t for t in (piece.strip() for piece in text.split(",")) if t]

    def field(self, name: str) -> str | None:
        """From the meta element of that name, else from the element labelled so."""
        return self.meta.get(name) or html.unescape(self.labelled.get(name, "")) or None

    def links(self, base: str | None, deny: re.Pattern, schemes: tuple[str, ...]) -> list[str]:
        """Absolute targets, first occurrences in page order."""
        out: dict[str, None] = {}
        for href in self.hrefs:
            try:
                url = urljoin(base or "", href)
                scheme = urlsplit(url).scheme
            except ValueError:  # not a URL, e.g. an unclosed IPv6 bracket
                continue
            if scheme in schemes and not deny.search(url):
                out.setdefault(url)
        return list(out)
