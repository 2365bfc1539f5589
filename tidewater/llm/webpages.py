"""Main text of web pages by site template removal (operator 8).

Every element's subtree is hashed from its tag, class, id, text and its children's hashes. Spark
counts, per host, on how many differently titled pages a subtree occurs; a subtree that recurs on
at least ``MIN_TITLES`` titles and on ``MIN_SHARE`` of the host's titles belongs to the site's
template, and a second pass deletes it. Titles are counted, not pages, so that an article which
is served under many addresses is not taken for a template. A page's title is its ``title`` with
its first h1 outside dropped parts. Pages without either, and those whose title most texts of the
host bear (the site's name), count by their texts; an article of such a host that is served with
many different texts counts as many. Inside an ``article`` or ``main``
element, paragraphs, headings, lists items, quotes and the like are the author's and stay.

A site's menu can differ from page to page, so elements whose tag, role, class or id declares
them as menu, header, footer, sidebar, notice, advert, form or comments go as well; but one that
does so as a form or by class or id stays if it wraps the page's ``main`` or longest ``article``,
or more than half of its (or a bare page's) text that does not recur. The text is that of the ``article``
elements, if what does not recur in ``main`` or the body around them is not longer and has no h1
in ``main``; else that of ``main``, by the same rule; else the body's.

Scale: two scans of the pages. Between them travel (host, title, subtree) hashes, reduced by
partial aggregates, so a host with a third of all pages is spread by its subtrees. A host's
template has at most 1 / ``MIN_SHARE`` times as many subtrees as its pages have on average; that
list is joined to the pages on the host, where Spark may split a hot host's pages.

Defined results: null html is empty and has an empty text; a page without a host in its url has
no site and only its declared parts go; bad markup never fails (unclosed, stray and nested tags
are closed as browsers do, character references follow HTML5); very long pages take time in
proportion (n log n in their articles and declared elements); repeated rows get equal results; other
columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import itertools
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.scratch import Scratch
from tidewater.tables import table

MIN_TITLES = 10
MIN_SHARE = 0.3

# ------------------------------------------------------------------------------ element kinds
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not markup; all but textarea and title hold no reader's text.
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript plaintext".split())
BLOCK = frozenset("""address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre
section summary table tbody td tfoot th thead tr ul""".split()) - {"br"}
DROPPED = frozenset("""nav footer aside form script style noscript template svg iframe object applet canvas audio
video button select textarea input datalist dialog menu head title noembed noframes map""".split())
DROPPED_ROLES = frozenset("""navigation banner contentinfo complementary search form dialog alert alertdialog menu
menubar toolbar tablist""".split())
#: Words of class and id names that declare what is not the article.
DROPPED_NAMES = frozenset("""ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion
promoted banner cookie cookies consent gdpr notice notification popup modal overlay newsletter subscribe subscription
signup sidebar side menu nav navbar navigation breadcrumb breadcrumbs pagination pager footer header masthead topbar
comment comments disqus respond replies related recommended share sharing social widget toolbar login search
skiplink hidden""".split())
#: Words that say nothing of what an element is. Inside an article a name declares only if all its other
#: words are such: "related-posts" and "user-comments" do, "related-work" and "binary-search" do not.
FILLERS = frozenset("""a also all area article articles bar block body bottom box btn button buttons center col column container
content desktop email end entry feed field floating follow from global group holder icon icons in inline inner input item items
js latest layer left like link links list lists main may mid mobile module more new news our outer page pages panel
placeholder popular post posts primary reader readers region right row secondary section site slot social sticky story
stories tag tags text the title toggle top trending unit us user users view wrap wrapper you your""".split())
#: An element named as a heading stays inside an article, or if it is named as an article's.
HEADINGS = frozenset("header masthead".split())
ARTICLE_NAMES = frozenset("article post entry story".split())
#: Inside an article these are content, however often they recur.
CONTENT = frozenset("""p h1 h2 h3 h4 h5 h6 li blockquote pre dd dt td th tr tbody thead table figcaption figure ul ol dl
b i em strong a span code q cite sub sup small mark abbr time""".split())
#: Ending one of these does not end a block that was opened inside it.
FORMATTING = frozenset("a b big cite code em font i mark nobr q s small span strike strong sub sup tt u".split())
#: Opening one of the keys ends an open element named in the value, up to a scope boundary.
CLOSES_P = BLOCK - {"body", "html", "option", "optgroup", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "legend", "dd", "dt"}
IMPLIED = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
           "th": ("td", "th"), "option": ("option",), "optgroup": ("optgroup", "option"), "tbody": ("tbody", "thead", "tr", "td", "th"),
           "thead": ("tbody", "tr", "td", "th"), "tfoot": ("tbody", "thead", "tr", "td", "th")}
SCOPE = {"li": frozenset("ul ol menu dir".split()), "dd": frozenset(["dl"]), "dt": frozenset(["dl"])}
BOUNDARY = frozenset("table td th caption html template button object applet marquee".split())
TABLE_BOUNDARY = frozenset("table html template".split())

_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)((?:[\s/]++|[^\s/>=]++(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?)?|=)*+)>")
_ATTRIBUTE = re.compile(r"([^\s/>=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
_HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}

BREAK = None  # a block boundary among the pieces of text
DECLARED, MAIN, ARTICLE = range(3)  # kinds of ranges; declared: by a form or a name


def _attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(raw):
        out.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
    return out


def _declared(tag: str, attributes: dict[str, str], inside: bool) -> int:
    """Whether the element says that it is not part of the article: 0 no, 1 by a form or a name, 2 yes."""
    if tag in DROPPED and tag != "form" or (tag == "header" and not inside):
        return 2
    if not attributes or tag in ("html", "body", "main"):
        return tag == "form"
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or _HIDING.search(attributes.get("style", "")):
        return 2
    if attributes.get("role", "").lower() in DROPPED_ROLES:
        return 2
    if tag == "form":
        return 1
    names = f"{attributes.get('class', '')} {attributes.get('id', '')}".split()
    each = [{w.lower() for w in _WORD.findall(name)} for name in names]
    words = set().union(*each)
    if inside:
        each = [ws for ws in each if all(w in DROPPED_NAMES or w in FILLERS or w.isdigit() for w in ws)]
    declared = set().union(*each) & DROPPED_NAMES
    if declared <= HEADINGS and (inside or words & ARTICLE_NAMES):
        return 0  # an article's own heading
    return int(bool(declared))


def _size(text: str) -> int:
    """Words of a text; a long run without spaces counts as several."""
    words = text.split()
    return len(words) + sum(map(len, words)) // 8


class Page:
    """One pass over a page's markup.

    ``subtrees`` collects the hashes of all subtrees that may be deleted; subtrees whose hash is in
    ``template`` leave no text.
    """

    def __init__(self, source: str, template: frozenset[int] = frozenset()):
        self.template, self.subtrees = template, set()
        self.title = ""
        self.out: list[tuple[int, str | None]] = []  # (region, text or BREAK); regions: 0 body, 1 main, 2 article
        # open elements: [tag, first piece, hash parts, dropped, region, name]
        self.stack: list[list] = []
        self.headings: list[tuple[int, int, str]] = []  # (first piece, region, content) of the h1 elements
        self.ranges: list[tuple[int, int, int]] = []  # (first piece, end, kind) of closed elements
        self.open: dict[str, int] = {}
        self.dropped = 0  # open elements that are surely no part of the article
        self._run(source)
        while self.stack:
            self._close()

    # -- events
    def _text(self, raw: str) -> None:
        text = html.unescape(raw) if "&" in raw else raw
        if self.stack:
            self.stack[-1][2].append(" ".join(text.split()))
        if not self.dropped:
            self.out.append((self.stack[-1][4] if self.stack else 0, text))

    def _break(self) -> None:
        if not self.dropped:
            self.out.append((self.stack[-1][4] if self.stack else 0, BREAK))

    def _start(self, tag: str, raw: str) -> None:
        if tag in CLOSES_P and self.open.get("p"):
            self._end_implied(("p",), BOUNDARY)
        if tag in IMPLIED:
            self._end_implied(IMPLIED[tag], SCOPE.get(tag, TABLE_BOUNDARY))
        attributes = _attributes(raw) if raw.strip(" /\t\n\r\f") else {}
        region = self.stack[-1][4] if self.stack else 0
        if tag in BLOCK:
            self._break()
        if tag in VOID:
            if tag == "br" and not self.dropped:
                self.out.append((region, "\n"))
            elif tag == "hr":
                self._break()
            return
        gone = _declared(tag, attributes, region > 0)
        if gone < 2:
            region = max(region, 2 if tag == "article" else 1 if tag == "main" or attributes.get("role") == "main" else 0)
        self.dropped += gone == 2
        self.open[tag] = self.open.get(tag, 0) + 1
        self.stack.append([tag, len(self.out), [], gone, region, f"{tag}.{attributes.get('class', '')}#{attributes.get('id', '')}"])

    def _close(self) -> None:
        tag, first, parts, gone, region, name = self.stack.pop()
        self.open[tag] -= 1
        self.dropped -= gone == 2
        key = 0
        if any(parts):
            key = xxhash.xxh64_intdigest("\x1f".join([name, *parts]).encode("utf-8", "surrogatepass")) - (1 << 63)
            outer = self.stack[-1][4] if self.stack else 0
            if tag not in ("html", "body", "article", "main") and not (outer > 0 and tag in CONTENT):
                self.subtrees.add(key)
                if key in self.template:
                    del self.out[first:]
                    for marks in (self.ranges, self.headings):
                        while marks and marks[-1][0] >= first:
                            marks.pop()
        if gone < 2:
            self._mark(tag, first, gone)
        if tag == "h1":
            if any(parts) and len(self.out) > first:
                self.headings.append((first, region, " ".join(parts)))
        if self.stack:
            self.stack[-1][2].append(f"\x1e{key}" if key else "")
        if tag in BLOCK:
            self._break()

    def _mark(self, tag: str, first: int, gone: int) -> None:
        if len(self.out) > first:
            if tag in ("main", "article"):
                self.ranges.append((first, len(self.out), MAIN if tag == "main" else ARTICLE))
            if gone:
                self.ranges.append((first, len(self.out), DECLARED))

    def _end_implied(self, tags: tuple[str, ...], boundary: frozenset[str]) -> None:
        if not any(self.open.get(t) for t in tags):
            return
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] in boundary:
                return
            if self.stack[k][0] in tags:
                last = next((j for j in range(k - 1, -1, -1) if self.stack[j][0] not in tags), k - 1)
                while len(self.stack) > last + 1:
                    self._close()
                return

    def _end(self, tag: str) -> None:
        if tag == "br":
            self._start("br", "")
        if not self.open.get(tag):
            if tag == "p":
                self._break()
            return
        stop = BOUNDARY if tag not in BOUNDARY and tag not in ("html", "body") else frozenset()
        block = False  # whether a block stands open inside the element
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == tag:
                if block and tag in FORMATTING:  # the block goes on without it
                    _, first, parts, gone, _, _ = self.stack.pop(k)
                    self.open[tag] -= 1
                    self.dropped -= gone == 2
                    self._mark(tag, first, gone)
                    if k:
                        self.stack[k - 1][2] += parts
                    return
                while len(self.stack) > k:
                    self._close()
                return
            block |= self.stack[k][0] in BLOCK
            if self.stack[k][0] in stop:
                return

    # -- the scan
    def _run(self, source: str) -> None:
        at, n = 0, len(source)
        while at < n:
            left = source.find("<", at)
            if left < 0:
                self._text(source[at:])
                return
            if left > at:
                self._text(source[at:left])
            after = source[left + 1:left + 2]
            if after in ("!", "?") or (after == "/" and not source[left + 2:left + 3].isalpha()):
                if source.startswith("<!--", left):
                    end = source.find("-->", left + 2)
                    at = end + 3 if end >= 0 else n
                else:
                    end = source.find(">", left)
                    at = end + 1 if end >= 0 else n
                continue
            m = _TAG.match(source, left)
            if not m:
                if after.isalpha() or after == "/":  # a tag that never ends
                    end = source.find(">", left)
                    at = end + 1 if end >= 0 else n
                else:
                    self._text("<")
                    at = left + 1
                continue
            at, tag = m.end(), m[2].lower()
            if m[1]:
                self._end(tag)
            elif tag in RAW:
                end = _ENDS[tag].search(source, at)
                stop = end.start() if end else n
                if tag == "title" and not self.title:
                    self.title = " ".join(html.unescape(source[at:stop]).split())
                close = source.find(">", stop)
                at = close + 1 if end and close >= 0 else n
            else:
                self._start(tag, m[3])

    # -- results
    def _gone(self) -> list[tuple[int, int]]:
        """Ranges of pieces that a form or a name declares as no part of the article, in order.

        Such an element stays as a wrapper if it is or holds the page's main or longest article, or
        if it holds more than half of the text of that article (without one, of main or the page).
        """
        declared = sorted((r for r in self.ranges if r[2] == DECLARED), key=lambda r: (r[0], -r[1]))
        if not declared:
            return []
        sums = [0, *itertools.accumulate(0 if t is BREAK else _size(t) for _, t in self.out)]
        size = lambda r: sums[r[1]] - sums[r[0]]
        holds = lambda a, b: a[0] <= b[0] and b[1] <= a[1]
        longest = max((size(r) for r in self.ranges if r[2] == ARTICLE), default=0)
        articles = [r for r in self.ranges if r[2] == ARTICLE and size(r) == longest > 0]
        mains = [r for r in self.ranges if r[2] == MAIN and size(r)]
        around = mains or [(0, len(self.out), MAIN)]  # where there is no article
        # articles of the greatest length are as long as one another, so only their bounds are asked for
        inside = sorted(r[:2] for r in articles)
        starts, reach = [a for a, _ in inside], list(itertools.accumulate((b for _, b in inside), max))
        held = sorted(r[:2] for r in articles + mains)
        firsts, nearest = [a for a, _ in held], list(itertools.accumulate((b for _, b in reversed(held)), min))[::-1]
        gone: list[tuple[int, int]] = []
        for r in declared:
            if articles:
                before = bisect_right(starts, r[0])
                most = 2 * size(r) > longest and before > 0 and reach[before - 1] >= r[1]
            else:
                most = any(holds(b, r) and 2 * size(r) > size(b) for b in around)
            after = bisect_left(firsts, r[0])
            wraps = after < len(held) and nearest[after] <= r[1]
            if not most and not wraps and (not gone or r[0] >= gone[-1][1]):
                gone.append(r[:2])
        return gone

    def _kept(self) -> list[tuple[int, str | None]]:
        kept, at = [], 0
        for first, end in self._gone():
            kept += self.out[at:first]
            at = end
        return kept + self.out[at:] if at else self.out

    def _region(self, out: list[tuple[int, str | None]]) -> int:
        """The article, main or body (2, 1, 0): the innermost with at least as much text as around it.

        An h1 of main outside its articles makes main the region.
        """
        gone = self._gone()
        heading = any(region == 1 and not any(a <= at < b for a, b in gone) for at, region, _ in self.headings)
        sizes = [0, 0, 0]
        for region, t in out:
            if t is not BREAK:
                sizes[region] += _size(t)
        article, main, body = sizes[2], sizes[1], sizes[0]
        if not article + main or article + main < body:
            return 0
        return 2 if article and article >= main and not heading else 1

    def name(self) -> str:
        """Title and first h1 outside dropped parts; empty if there is neither."""
        gone = self._gone()
        heading = next((h for at, _, h in self.headings if not any(a <= at < b for a, b in gone)), "")
        return f"{self.title}{heading}" if self.title or heading else ""

    def text(self) -> str:
        """Blocks joined by line feeds, of the article, main or body."""
        out = self._kept()
        best = self._region(out)
        blocks, run = [], []
        for region, t in [*out, (best, BREAK)]:
            if t is BREAK:
                if run and (line := " ".join("".join(run).split())):
                    blocks.append(line)
                run = []
            elif region >= best:
                run.append(t)
            elif run:  # another region lies between
                run.append(" ")
        return "\n".join(blocks)


# ------------------------------------------------------------------------------------ Spark
def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def site_templates(pages: DataFrame, scratch: Scratch, min_titles: int = MIN_TITLES, min_share: float = MIN_SHARE) -> DataFrame:
    """(site, template): per host the hashes of its recurring subtrees, from (host, html)."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, titles, bodies, keys = [], [], [], []
            for host, source in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                page = Page(source.as_py() or "")
                body = page.text()
                title, body = (xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass")) - (1 << 63) for t in (page.name() or body, body))
                found = sorted(page.subtrees)
                hosts += [host] * (len(found) + 1)
                titles += [title] * (len(found) + 1)
                bodies += [body] * (len(found) + 1)
                keys += [None, *found]  # the null stands for the page itself
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(titles, pa.int64()),
                                              pa.array(bodies, pa.int64()), pa.array(keys, pa.int64())],
                                             ["host", "title", "body", "key"])

    seen = pages.where("host != ''").select("host", "html").mapInArrow(
        collect, "host string, title bigint, body bigint, key bigint")
    titled = scratch.save(seen.distinct().groupBy("host", "title", "key").agg(F.count(F.lit(1)).alias("texts")), "titled")
    # a title that most texts of a host bear is the site's: its pages count by their texts
    named = titled.where(F.col("key").isNull())
    all_texts = named.groupBy(F.col("host").alias("site")).agg(F.sum("texts").alias("all"))
    site_titles = named.where(F.col("texts") >= min_titles).join(all_texts, F.col("host") == F.col("site")).where(
        2 * F.col("texts") > F.col("all")).select("host", "title")
    more = titled.where("texts > 1").join(site_titles, ["host", "title"], "left_semi").select(
        "host", "key", (F.col("texts") - 1).alias("n"))
    counted = scratch.save(titled.select("host", "key", F.lit(1).cast("long").alias("n")).unionByName(more)
                           .groupBy("host", "key").agg(F.sum("n").alias("n")).where(
        (F.col("n") >= min_titles) | F.col("key").isNull()), "subtrees")
    totals = counted.where(F.col("key").isNull()).select(F.col("host").alias("site"), F.col("n").alias("titles"))
    recurring = counted.where(F.col("key").isNotNull()).join(totals, F.col("host") == F.col("site")).where(
        F.col("n") >= min_share * F.col("titles"))
    return scratch.save(recurring.groupBy("site").agg(F.collect_list("key").alias("template")), "templates")


def extract_articles(pages: DataFrame, url_col: str = "url", html_col: str = "html", min_titles: int = MIN_TITLES,
                     min_share: float = MIN_SHARE) -> DataFrame:
    """``pages`` as a struct column ``page`` and its main ``text``."""
    scratch = Scratch(pages.sparkSession, "webpages")
    named = pages.select(F.struct("*").alias("page"), host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
    templates = site_templates(named, scratch, min_titles, min_share)

    @F.pandas_udf("string")
    def article(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        known: dict[bytes, frozenset[int]] = {}
        for sources, keys in batches:
            out = []
            for source, key in zip(sources, keys, strict=True):
                template = frozenset()
                if key is not None:
                    raw = key.tobytes()
                    if raw not in known:
                        if len(known) > 1000:
                            known.clear()
                        known[raw] = frozenset(key.tolist())
                    template = known[raw]
                out.append(Page(source or "", template).text())
            yield pd.Series(out, dtype=object)

    joined = named.join(templates, F.col("host") == F.col("site"), "left")
    return joined.select("page", article(F.col("html"), F.col("template")).alias("text"))


def op8_webpages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract_articles(table(spark, sf_dir, "pages"))
    return found.select("page.page_id", "page.url", "text", F.length("text").cast("long").alias("n_chars"))
