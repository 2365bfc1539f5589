"""Personal data by fixed patterns and a semi-Markov conditional random field (operator 2).

Base spans (email, ip, card, phone) come from fixed patterns. A semi-Markov CRF then scores
whole candidate segments: features look at the entire span (digit count, group shape, Luhn sum,
address shape, what stands on either side), and a dynamic program over token positions with
bounded entity length chooses boundaries and types jointly. Its spans are added where they touch
no base span.

Only text around digits and ``@`` can hold an entity here, so the program runs on such zones; a
zone's neighbours are plain words, which always take the outside label with score 0, hence the
best labelling of the whole text is the best labelling of each zone.

The field is trained here, by stochastic gradient on the exact conditional log-likelihood
(segment forward-backward), on ``TRAIN_ZONES`` generated zones of labelled and of harmless
strings (dates, versions, prices, serial numbers). The weights are a few hundred numbers and go
to the tasks with the function.

Scale: one scan, no shuffle; a text is processed whole, in time linear in its length.

Defined results: null text is empty and has no spans; equal rows get equal results; an empty
table gives an empty result. ``redact`` returns exactly the columns of its input.
"""

from __future__ import annotations

import functools
import hashlib
import math
import random
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.tables import table

KINDS = ("email", "ip", "card", "phone")
MAX_TOKENS = 16  # of one entity
TRAIN_ZONES = 400
EPOCHS = 10
SEED = 20

# ---------------------------------------------------------------------------- base patterns
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_HINT = re.compile(r"[0-9@]")
_NON_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(2 * int(d) - 9 * (d > "4") for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed patterns: leftmost, non-overlapping within a kind."""
    out: list[tuple[int, int, int]] = []
    if not _HINT.search(text):
        return out
    done, at = 0, text.find("@")
    while at >= 0:
        # an address starts where its run of local characters does, or where the last one ended
        start = done + len(text[done:at].rstrip(_LOCAL))
        if start < at and (m := _DOMAIN.match(text, at)):
            out.append((0, start, m.end()))
            done = m.end()
        else:
            done = at + 1
        at = text.find("@", done)
    for m in _IP.finditer(text):
        if all(map(_small, m[0].split("."))):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = _NON_DIGIT.sub("", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_NON_DIGIT.sub("", m[0])) <= 15:
            out.append((3, m.start(), m.end()))
    return out


# ------------------------------------------------------------------------ candidate segments
_CHUNK = re.compile(r"\S+")
_TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|\s+|.", re.S)
_QUAD = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_ADDRESS = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
FEATURES = (
    "bias", "address", "at_sign", "quad", "quad_small", "digits_7_9", "digits_10", "digits_11_15", "digits_16_19",
    "digits_many", "luhn", "plus", "paren", "one_group", "spaces", "dashes", "dots", "groups_3_3_4", "groups_of_4",
    "date", "short_group", "joined_left", "joined_right", "opens_left", "two_spaces",
)
_FEATURE = {name: k for k, name in enumerate(FEATURES)}


def zones(text: str) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring chunks that hold digits or ``@``."""
    start = end = -1
    for m in _CHUNK.finditer(text):
        if not _HINT.search(m[0]) and not (m[0][0] == "+" or m[0][0] == "("):
            continue
        if start >= 0 and m.start() - end <= 2:
            end = m.end()
        else:
            if start >= 0:
                yield start, end
            start, end = m.span()
    if start >= 0:
        yield start, end


def span_features(kind: int, span: str, left: str, right: str) -> list[int] | None:
    """Features of a whole span as an entity of ``kind``; None where it cannot be one."""
    digits = _NON_DIGIT.sub("", span)
    on = ["bias"]
    if kind == 0:
        if span.count("@") != 1 or any(c.isspace() for c in span):
            return None
        on += ["at_sign"] + ["address"] * bool(_ADDRESS.fullmatch(span))
    elif "@" in span or any(c.isalpha() for c in span):
        return None
    elif kind == 1:
        if not _QUAD.fullmatch(span):
            return None
        on += ["quad"] + ["quad_small"] * all(map(_small, span.split(".")))
    else:
        n = len(digits)
        if n < (12 if kind == 2 else 7) or n > (24 if kind == 2 else 15):
            return None
        if not all(c in "0123456789 -().+" for c in span) or "+" in span[1:]:
            return None
        groups = [len(g) for g in re.findall(r"[0-9]+", span)]
        on.append("digits_7_9" if n < 10 else "digits_10" if n == 10 else "digits_11_15" if n < 16
                  else "digits_16_19" if n < 20 else "digits_many")
        on += ["luhn"] * luhn(digits) + ["plus"] * (span[0] == "+") + ["paren"] * ("(" in span and ")" in span)
        on += ["one_group"] * (len(groups) == 1) + ["spaces"] * (" " in span) + ["dashes"] * ("-" in span)
        on += ["dots"] * ("." in span) + ["groups_3_3_4"] * (groups[-3:] == [3, 3, 4])
        on += ["groups_of_4"] * (groups[:-1] == [4] * (len(groups) - 1) and len(groups) > 2)
        on += ["date"] * (groups[:3] in ([4, 2, 2], [2, 2, 4])) + ["short_group"] * (min(groups) == 1 and span[0] != "+")
        on += ["two_spaces"] * ("  " in span)
    on += ["joined_left"] * (left.isalnum() or left in tuple("._-+@/#$")) + ["opens_left"] * (left == "(")
    on += ["joined_right"] * (right[:1].isalnum() or right[:1] in tuple("@-/_%") or
                              (right[:1] in tuple(".,:") and right[1:2].isdigit()))
    return [_FEATURE[x] for x in on]


def lattice(text: str, start: int, end: int) -> tuple[list[int], list[list[tuple[int, int, list[int]]]]]:
    """Token bounds of a zone, and for each token position the candidate segments that end there."""
    bounds, classes = [], []
    for m in _TOKEN.finditer(text, start, end):
        bounds.append(m.start())
        classes.append("s" if m[0].isspace() else "d" if m[0].isdigit() else "a" if m[0].isalpha() else m[0])
    n = len(bounds)
    bounds.append(end)
    ends: list[list[tuple[int, int, list[int]]]] = [[] for _ in range(n + 1)]
    for i in range(n):
        if classes[i] == "s" or classes[i] in ").,-":
            continue
        amount = 0
        for j in range(i, min(n, i + MAX_TOKENS)):
            c = classes[j]
            if c not in ("d", "a", "s") and c not in "@.+-()_%":
                break
            amount += (bounds[j + 1] - bounds[j]) if c == "d" else 4 if c == "@" else 0
            if c not in ("d", "a") or amount < 4:
                continue
            span = text[bounds[i]:bounds[j + 1]]
            left, right = text[max(0, bounds[i] - 1):bounds[i]], text[bounds[j + 1]:bounds[j + 1] + 2]
            for kind in range(len(KINDS)):
                if (on := span_features(kind, span, left, right)) is not None:
                    ends[j + 1].append((i, kind, on))
    return bounds, ends


# ------------------------------------------------------------------------------- the field
class SemiCrf:
    """Weights by kind and feature, and transitions between labels (the last label is outside)."""

    OUT = len(KINDS)

    def __init__(self):
        self.weight = [[0.0] * len(FEATURES) for _ in KINDS]
        self.move = [[0.0] * (self.OUT + 1) for _ in range(self.OUT + 1)]

    def score(self, kind: int, on: list[int]) -> float:
        w = self.weight[kind]
        return sum(w[f] for f in on)

    def decode(self, ends) -> list[tuple[int, int, int]]:
        """Best (kind, first token, end token) segments: Viterbi over segment ends and labels."""
        out, n = self.OUT, len(ends) - 1
        best: list[list[float]] = [[-math.inf] * (out + 1) for _ in range(n + 1)]
        back: list[list[tuple[int, int] | None]] = [[None] * (out + 1) for _ in range(n + 1)]
        best[0][out] = 0.0
        for j in range(1, n + 1):
            for i, kind, gain in [(j - 1, out, 0.0), *((i, k, self.score(k, on)) for i, k, on in ends[j])]:
                for prev in range(out + 1):
                    s = best[i][prev] + self.move[prev][kind] + gain
                    if s > best[j][kind]:
                        best[j][kind], back[j][kind] = s, (i, prev)
        found, j, label = [], n, max(range(out + 1), key=lambda y: best[n][y])
        while j > 0:
            i, prev = back[j][label]
            if label != out:
                found.append((label, i, j))
            j, label = i, prev
        return found[::-1]

    def gradient(self, ends, gold: set[tuple[int, int, int]]):
        """Observed minus expected counts of features and moves, by segment forward-backward."""
        out, n = self.OUT, len(ends) - 1
        arcs = [[(j - 1, out, [], 0.0), *((i, k, on, self.score(k, on)) for i, k, on in ends[j])] if j else []
                for j in range(n + 1)]

        def add(values):
            top = max(values)
            return top + math.log(sum(math.exp(v - top) for v in values)) if top > -math.inf else top

        ahead = [[-math.inf] * (out + 1) for _ in range(n + 1)]
        ahead[0][out] = 0.0
        for j in range(1, n + 1):
            by: dict[int, list[float]] = {}
            for i, k, _, s in arcs[j]:
                by.setdefault(k, []).extend(ahead[i][p] + self.move[p][k] + s for p in range(out + 1))
            for k, values in by.items():
                ahead[j][k] = add(values)
        behind = [[[] for _ in range(out + 1)] for _ in range(n + 1)]
        closed = [[-math.inf] * (out + 1) for _ in range(n + 1)]
        closed[n] = [0.0] * (out + 1)
        for j in range(n, 0, -1):
            if j < n:
                closed[j] = [add(v) if v else -math.inf for v in behind[j]]
            for i, k, _, s in arcs[j]:
                for p in range(out + 1):
                    behind[i][p].append(self.move[p][k] + s + closed[j][k])
        total = add(ahead[n])
        for j in range(1, n + 1):
            for i, k, on, s in arcs[j]:
                seen = 0.0
                for p in range(out + 1):
                    share = math.exp(min(0.0, ahead[i][p] + self.move[p][k] + s + closed[j][k] - total))
                    seen += share
                    if share > 1e-9:
                        yield "move", p, k, -share
                for f in on:
                    yield "weight", k, f, -seen
        j, prev = 0, out
        starts = {i: (k, e) for k, i, e in gold}
        while j < n:
            k, e = starts.get(j, (out, j + 1))
            yield "move", prev, k, 1.0
            for i, kind, on in ends[e]:
                if (kind, i) == (k, j):
                    for f in on:
                        yield "weight", k, f, 1.0
            j, prev = e, k


def _luhn_number(r: random.Random, n: int, valid: bool) -> str:
    body = str(r.randint(3, 6)) + "".join(r.choice("0123456789") for _ in range(n - 2))
    for last in r.sample("0123456789", 10):
        if luhn(body + last) == valid:
            return body + last
    return body + "0"


def _example(r: random.Random) -> tuple[str, int | None]:
    d = lambda n: str(r.randint(1, 9)) + "".join(r.choice("0123456789") for _ in range(n - 1))
    word = lambda: "".join(r.choice("abcdeghilmnorstu") for _ in range(r.randint(2, 7)))
    kind = r.choice([0, 1, 2, 3, 3, None, None, None])
    if kind == 0:
        tail = "".join(f".{word()}" for _ in range(r.randint(0, 1)))
        return f"{word()}{r.choice(['', '.', '_', '-'])}{r.choice([word(), d(2)])}@{word()}{tail}.{r.choice(['com', 'org', 'de', 'net'])}", 0
    if kind == 1:
        return ".".join(str(r.randint(1, 255)) for _ in range(4)), 1
    if kind == 2:
        number = _luhn_number(r, 16, True)
        return r.choice(["", "", " ", "-"]).join(number[k:k + 4] for k in range(0, 16, 4)), 2
    if kind == 3:
        a, b, c = d(3), d(3), d(4)
        return r.choice([f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+{r.randint(1, 99)} {a} {b} {c}",
                         f"+{r.randint(1, 99)} {d(2)} {d(7)}", f"+1-{a}-{b}-{c}"]), 3
    return r.choice([
        f"20{r.randint(10, 29)}-{r.randint(1, 12):02}-{r.randint(1, 28):02}", f"{r.randint(1, 28):02}.{r.randint(1, 12):02}.20{r.randint(10, 29)}",
        f"{r.randint(0, 23):02}:{r.randint(0, 59):02}:{r.randint(0, 59):02}", f"{r.randint(0, 9)}.{r.randint(0, 20)}.{r.randint(0, 20)}",
        d(r.randint(4, 9)), d(10), d(r.randint(11, 15)), _luhn_number(r, 16, False), d(r.randint(20, 24)),
        f"{d(3)}.{r.randint(256, 999)}.{d(2)}.{d(3)}", f"${d(3)}.{d(2)}", f"{d(3)},{d(3)},{d(3)}", f"#{d(8)}", f"{d(4)}-{d(4)}",
        f"{word()}@{word()}", f"978-{d(1)}-{d(4)}-{d(4)}-{d(1)}", f"{d(5)}-{d(4)}", f"{d(2)} {d(3)} {d(3)}", f"{word()}{d(8)}",
        f"{d(3)}-{d(2)}-{d(4)}", f"{d(2)}x{d(4)}", f"{d(3)}/{d(7)}", f"{d(4)} {d(4)} {d(3)}", f"{d(3)}.{d(3)}.{d(4)}.{d(2)}.{d(1)}"]), None


@functools.lru_cache(maxsize=1)
def trained() -> SemiCrf:
    """The field, fitted on generated zones (AdaGrad steps on the log-likelihood)."""
    r, model = random.Random(SEED), SemiCrf()
    zones_, rate = [], 0.3
    for _ in range(TRAIN_ZONES):
        parts, gold, text = r.choices((1, 2, 3), (6, 2, 1))[0], [], ""
        for k in range(parts):
            piece, kind = _example(r)
            text += " " * (k > 0)
            if kind is not None:
                gold.append((kind, len(text), len(text) + len(piece)))
            text += piece
        text += r.choice(["", "", ".", ",", "!"])
        bounds, ends = lattice(text, 0, len(text))
        at = {b: i for i, b in enumerate(bounds)}
        marked = {(k, at[s], at[e]) for k, s, e in gold if s in at and e in at}
        if any(ends):
            zones_.append((ends, marked))
    sums = {"weight": [[1e-6] * len(FEATURES) for _ in KINDS], "move": [[1e-6] * (model.OUT + 1) for _ in range(model.OUT + 1)]}
    for _ in range(EPOCHS):
        r.shuffle(zones_)
        for ends, gold in zones_:
            steps: dict[tuple[str, int, int], float] = {}
            for name, a, b, g in model.gradient(ends, gold):
                steps[name, a, b] = steps.get((name, a, b), 0.0) + g
            for (name, a, b), g in steps.items():
                table_, seen = getattr(model, name), sums[name]
                g -= 1e-3 * table_[a][b]
                seen[a][b] += g * g
                table_[a][b] += rate * g / math.sqrt(seen[a][b])
    return model


def field_spans(text: str, model: SemiCrf) -> list[tuple[int, int, int]]:
    """(kind, start, end) that the field finds in a text."""
    found = []
    if not _HINT.search(text):
        return found
    for start, end in zones(text):
        bounds, ends = lattice(text, start, end)
        if any(ends):
            found += [(k, bounds[i], bounds[j]) for k, i, j in model.decode(ends)]
    return found


def all_spans(text: str, model: SemiCrf) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and those of the field that touch no base span; both by kind and start."""
    base = base_spans(text)
    ranges, added, k = sorted((s, e) for _, s, e in base), [], 0
    reach = 0  # how far the base spans that start before a field span go
    for kind, s, e in sorted(field_spans(text, model), key=lambda x: x[1]):
        while k < len(ranges) and ranges[k][0] < e:
            reach = max(reach, ranges[k][1])
            k += 1
        if reach <= s:
            added.append((kind, s, e))
    return sorted(base), sorted(added)


def _join(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


_RESULT = "base array<struct<kind:int,start:bigint,end:bigint>>, added array<struct<kind:int,start:bigint,end:bigint>>"


_SPANS = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))
OUT_CHARS = 1 << 19  # redacted texts that are handed on together; a longer one goes alone


def _finder(model: SemiCrf):
    @F.arrow_udf(_RESULT)
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        shape = lambda spans: [{"kind": k, "start": s, "end": e} for k, s, e in spans]
        for texts in batches:
            both = [all_spans(t.as_py() or "", model) for t in texts]
            yield pa.StructArray.from_arrays([pa.array([shape(b) for b, _ in both], _SPANS),
                                              pa.array([shape(a) for _, a in both], _SPANS)], ["base", "added"])

    return find


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base, added: arrays of (kind, start, end), kind an index of ``KINDS``."""
    found = docs.select(F.col(id_col).alias("doc_id"), _finder(trained())(F.col(text_col)).alias("found"))
    return found.select("doc_id", "found.base", "found.added")


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every found span replaced by its kind in brackets; a null text stays null."""
    model = trained()

    @F.arrow_udf("string")
    def clean(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from redactions(batches, model)

    return docs.withColumn(text_col, clean(F.col(text_col)))


def redactions(batches: Iterator[pa.Array], model: SemiCrf) -> Iterator[pa.Array]:
    """The texts redacted, about ``OUT_CHARS`` of them in an array, so that no whole batch is Python strings."""
    for texts in batches:
        out, held = [], 0
        for value in texts:
            text = value.as_py()
            out.append(None if text is None else redacted(text, model))
            held += len(text or "")
            if held >= OUT_CHARS:
                yield pa.array(out, pa.string())
                out, held = [], 0
        if out:
            yield pa.array(out, pa.string())


def redacted(text: str, model: SemiCrf) -> str:
    base, added = all_spans(text, model)
    if not base and not added:
        return text
    out, done = [], 0
    for s, e, kind in sorted((s, e, k) for k, s, e in base + added):
        if s >= done:
            out += [text[done:s], f"[{KINDS[kind].upper()}]"]
        done = max(done, e)
    return "".join([*out, text[done:]])


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents"))
    names = F.array(*[F.lit(k) for k in KINDS])
    join = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(join(F.col("base")), 256).alias("base_sha256"),
        join(F.array_sort(F.concat("base", "added"))).alias("spans"),
        F.size("added").cast("long").alias("n_added"))
