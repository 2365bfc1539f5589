import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewater.llm import spelling as S


def apart(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts, ratio=5):
    near = {w: [v for v in counts if apart(w, v)] for w in counts}
    best = {w: min(near[w], key=lambda v: (-counts[v], v), default=None) for w in counts}
    form = {w: b if b is not None and counts[b] >= ratio * counts[w] else None for w, b in best.items()}

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), counts[w], len(near[w]), counts[form[w]] if form[w] else 0) for w in counts)


def as_rows(df):
    return sorted((r["word"], r["form"] or "", r["root"], r["n"], r["n_near"], r["form_n"] or 0) for r in df.collect())


@pytest.mark.parametrize("block", [3, 2048])
def test_variants_against_all_pairs(spark, block):
    rnd = random.Random(5)
    counts = {}
    for alphabet in ("ab", "abcdé", "etaoinsr", "xyzwÿþ", "日本a𝄞"):
        for _ in range(90):
            w = "".join(rnd.choice(alphabet) for _ in range(rnd.choice([6, 6, 7, 7, 8])))
            counts[w] = rnd.choice([5, 5, 6, 25, 30, 150, 800, 5000])
    chain = ["planet", "planets", "planetss", "planetsss"]
    counts |= dict(zip(chain, [5000, 900, 50, 10], strict=True))
    vocabulary = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(5)
    assert as_rows(S.group_variants(vocabulary, block=block)) == brute(counts)


def test_distances_and_edits():
    codes = lambda *w: S._codes(w, len(w[0]))
    counts = lambda *w: S._letter_counts(codes(*w))
    i, j = S.close_pairs(counts("abcdef", "zzzzzz"), counts("abcdeg", "fedcba", "uvwxyz"))
    assert sorted(zip(i.tolist(), j.tolist(), strict=True)) == [(0, 0), (0, 1)]
    assert S.one_edit(codes("abcdef", "abcdef"), codes("abcdeg", "fedcba")).tolist() == [True, False]
    assert S.one_edit(codes("aabb", "aabb", "aabb"), codes("aaabb", "xaabb", "axabc")).tolist() == [True, True, False]
    assert not np.any(S.one_edit(codes("abcdef"), codes("abcdef")))


def test_memory_of_words_of_the_same_letters():
    rnd = random.Random(3)
    words = {"abcdefghijkm", "abcdefghijkmn"}
    while len(words) < 1500:
        words.add("".join(rnd.sample("abcdefghijkl", 12)))
    keys = {"cell": 1, "row": 0, "column": 0}
    home = pd.DataFrame({"word": sorted(words), "n": 5, **keys})
    visiting = pd.DataFrame({"visitor": sorted(words), "times": 5, "inside": True, **keys})
    tracemalloc.start()
    links = S._links(home, visiting)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # 2.2 million pairs of 12 letters all look close; they are never held at once
    assert peak < 60e6, peak
    linked = [("abcdefghijkm", "abcdefghijkmn"), ("abcdefghijkmn", "abcdefghijkm")]
    assert sorted(zip(links["word"], links["near"], strict=True)) == linked


def test_groups_do_not_grow_with_their_cells(spark, monkeypatch):
    # words of one cell in small blocks, so that each meets many
    words = ["".join("bcdfghjk"[(i >> 3 * k) & 7] for k in range(6)) for i in range(2000)]
    vocabulary = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    monkeypatch.setattr(S, "TASK_ROWS", 2000)
    home, visiting = S.block_pairs(vocabulary, block=50)
    rows = home.select("task").union(visiting.select("task")).groupBy("task").count().toPandas()["count"]
    assert rows.sum() == 2 * 2000 * 40 and rows.max() < 3 * 2000


def sent(node):
    """Names of the columns of each broadcast below a node of a plan of the JVM, as planned from estimated sizes."""
    if node.nodeName() == "AdaptiveSparkPlan":
        return sent(node.initialPlan())
    below = node.children()
    found = [x for i in range(below.size()) for x in sent(below.apply(i))]
    if node.nodeName() == "BroadcastExchange":
        found.append({node.output().apply(i).name() for i in range(node.output().size())})
    return found


@pytest.mark.parametrize("cells", [S.SENT_CELLS, 0])
def test_words_are_never_broadcast(spark, monkeypatch, cells):
    # chains of four, so that forms are followed for two rounds
    counts = {}
    for i in range(200):
        stem = "".join("bcdfghjk"[(i >> 3 * k) & 7] * 2 for k in range(3))
        counts |= {stem + end: n for end, n in zip(("", "e", "ea", "eao"), (5000, 900, 50, 10), strict=True)}
    plans = []
    planned = lambda df: plans.append(sent(df._jdf.queryExecution().executedPlan()))  # noqa: E731, SLF001

    class Watched(S.Scratch):
        def save(self, df, name):
            planned(df)
            return super().save(df, name)

    monkeypatch.setattr(S, "Scratch", Watched)
    monkeypatch.setattr(S, "SENT_CELLS", cells)
    found = S.group_variants(spark.createDataFrame(list(counts.items()), "word string, n long"), block=50)
    planned(found)
    assert as_rows(found) == brute(counts)
    assert len(plans) == 5  # words, forms, two rounds, the result
    assert [x for plan in plans for x in plan] == ([{"cell", "rows", "columns"}] * 2 if cells else [])


def plain(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def test_query(spark, make_docs, as_documents):
    rnd = random.Random(2)
    words = ["Garden", "garden", "Übergang", "ÜBERGANG", "kitchen", "kitchens", "río-grande", "planète", "wonderful", "short", "a1b", "×signal÷"]
    rows = [(i, " ".join(rnd.choice(words) for _ in range(40)), "en", "s") for i in range(400)]
    rows += [(400, "kitchen " * 5000, "en", "s"), (7, "kitchan! " * 9, None, None)] + [(None, "kitchem.", "en", "s")] * 6
    rows += [(500, None, "en", "s"), (501, "", "en", "s"), (502, "ß" * 300 + " KITCHENS", "en", "s")]
    docs = make_docs(rows).withColumn("run", F.lit("x")).withColumn("word", F.lit(1)).withColumn("n", F.lit(2))
    got = S.op13_spelling(spark, as_documents(docs.repartition(6)))
    want = plain([(i, t) for i, t, _, _ in rows])
    assert len(want) > 10 and as_rows(got) == brute(want)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_empty(spark, make_docs, as_documents):
    assert S.op13_spelling(spark, as_documents(make_docs([]))).count() == 0
    assert S.op13_spelling(spark, as_documents(make_docs([(1, "lonely words here", "en", "s")]))).count() == 0
