import random
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from tests.llm.plain import brute_classes
from tidewater.llm import neardup as N
from tidewater.llm.scratch import Scratch


def partition(ids, labels):
    by = defaultdict(set)
    for i, c in zip(ids, labels, strict=True):
        by[c].add(i)
    return {frozenset(v) for v in by.values()}


def prose(r, n):
    return [f"w{r.randrange(4000)}" for _ in range(n)]


def edited(r, words, times):
    out = list(words)
    for _ in range(times):
        out[r.randrange(len(out))] = f"x{r.randrange(10**9)}"
    return out


def planted():
    r = random.Random(11)
    texts = []
    for k in range(25):
        base = prose(r, 120 + 10 * k)
        texts.append(" ".join(base))
        texts += [" ".join(edited(r, base, r.randint(0, 6))) for _ in range(r.randint(0, 6))]
    hot = prose(r, 200)
    texts += [" ".join(edited(r, hot, r.randint(1, 7))) for _ in range(120)] + [" ".join(hot)] * 30
    passage = prose(r, 60)  # shared, but no near-duplicates
    texts += [" ".join(prose(r, 90) + passage + prose(r, 90)) for _ in range(30)]
    line = " ".join(prose(r, 12))
    texts += [f"{line}\n" * 40, f"{line}\t" * 40, f"{line} " * 39 + "end of it all"]
    texts += [None, None, "", "", "  ", "one", "one ", "one two", "a b c d e", "a b c d f"]
    return texts


def test_classes_equal_brute_force(make_docs, documents):
    texts = planted()
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)]
    got = {r["doc_id"]: r["class_id"] for r in N.duplicate_classes(make_docs(rows)).collect()}
    assert len(got) == len(texts)
    assert partition(got, got.values()) == partition(range(len(texts)), brute_classes(texts))
    assert all(min(k for k in got if got[k] == c) == c for c in set(got.values()))
    corpus = [t for _, t, _, _ in documents]
    got = {r["doc_id"]: r["class_id"] for r in N.duplicate_classes(make_docs([(i, t, None, None) for i, t in enumerate(corpus)])).collect()}
    assert partition(got, got.values()) == partition(range(len(corpus)), brute_classes(corpus))


def test_star_shaped_class_without_links_between_its_rays(make_docs):
    r = random.Random(4)
    base = prose(r, 400)
    texts = [" ".join(base)]
    for k in range(40):  # each ray is linked to the base; two rays hardly ever to one another
        ray = list(base)
        for j in range(7):
            ray[(k * 9 + j * 57) % 400] = f"y{k}-{j}"
        texts.append(" ".join(ray))
    texts = texts[::-1]
    labels = brute_classes(texts)
    assert len(set(labels)) == 1
    got = N.duplicate_classes(make_docs([(i, t, None, None) for i, t in enumerate(texts)])).collect()
    assert {x["class_id"] for x in got} == {0}


def test_many_near_copies_that_are_no_links(make_docs):
    """Copies with more and more edits: some linked to the base, the rest to nothing or to one another."""
    r = random.Random(9)
    base = prose(r, 150)
    texts = [" ".join(base)] + [" ".join(edited(r, base, 1 + k % 12)) for k in range(240)]
    cut = base[:90]  # linked to one another, not to the base: they lack the same words
    texts += [" ".join(cut)] + [" ".join(edited(r, cut, 1 + k % 2)) for k in range(20)]
    far = edited(r, base, 9)  # and these share what they add
    texts += [" ".join(edited(r, far, k % 3)) for k in range(12)]
    got = {x["doc_id"]: x["class_id"] for x in N.duplicate_classes(make_docs([(i, t, None, None) for i, t in enumerate(texts)])).collect()}
    assert partition(got, got.values()) == partition(range(len(texts)), brute_classes(texts))
    assert len(set(got.values())) > 50


def test_links_of_texts_that_repeat_differently(make_docs):
    """Set similarity 0.8 or more, but one text has some of its lines a hundred times."""
    r = random.Random(21)
    texts = []
    for k in range(30):
        base = prose(r, 84)  # 80 shingles
        extra = [f"z{k}"] * (5 if k % 2 else 100) + prose(r, 6)
        texts += [" ".join(base), " ".join(base + extra * 100)]
        texts.append(" ".join(base[:82] + extra * 100))
    labels = brute_classes(texts)
    assert len(set(labels)) == 30
    got = {x["doc_id"]: x["class_id"] for x in N.duplicate_classes(make_docs([(i, t, None, None) for i, t in enumerate(texts)])).collect()}
    assert partition(got, got.values()) == partition(range(len(texts)), labels)


def test_bands_of_set_similarity_beside_the_weighted_ones():
    """The pair of 80 shared shingles and 20 more that one text holds 100 times (weighted: 0.42)."""
    met, trials = 0, 200
    for k in range(trials):
        e = N._mix(np.arange(1, 101, dtype=np.uint64) + np.uint64(1000 * k))
        a = N.document_bands(e, np.r_[np.ones(80, np.int64), np.full(20, 100)])
        b = N.document_bands(e[:80], np.ones(80, np.int64))
        assert len(b) == N.BANDS and len(a) == 2 * N.BANDS
        met += any(x is not None and x == b[j % N.BANDS] for j, x in enumerate(a))
    assert met == trials


def test_keep_one_keeps_rows_whole(make_docs):
    t = " ".join(f"w{k}" for k in range(50))
    rows = [(5, t, "en", "s"), (3, t, "de", "b"), (3, t, "de", "b"), (9, t + " more", "en", None), (None, t, "en", "s"),
            (7, None, "en", "s"), (7, None, "en", "s"), (3, "other words of its own here", "en", "s")]
    docs = make_docs(rows).withColumn("row", F.lit("mine")).withColumn("key", F.lit(1)).withColumn("bands", F.lit(2))
    out = N.keep_one(docs)
    assert out.schema == docs.schema
    got = sorted(((r["doc_id"], r["text"], r["lang"]) for r in out.collect()), key=repr)
    assert got == sorted([(3, t, "de"), (3, rows[-1][1], "en"), (7, None, "en"), (7, None, "en")], key=repr)
    assert N.keep_one(make_docs([])).count() == 0 and N.duplicate_classes(make_docs([])).count() == 0


def test_a_third_of_the_ids_null_and_clashing_columns(make_docs):
    """Null or repeated ids are no hot key: texts come back by id and hash, each once."""
    import hashlib

    texts = [t for t in planted() if t]
    rows = [(None if i % 3 == 0 else i // 2, t, "en", "s") for i, t in enumerate(texts)]
    docs = make_docs(rows).withColumn("key", F.lit("x")).withColumn("rep", F.lit(1)).withColumn("bands", F.lit(None).cast("int"))
    got = N.duplicate_classes(docs).collect()
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    assert sorted(r["text_md5"] for r in got) == sorted(map(md5, texts))
    assert partition([r["text_md5"] for r in got], [r["class_row"] for r in got]) == partition(map(md5, texts), brute_classes(texts))
    named = docs.select("doc_id", "text")
    wanted = named.select("doc_id", F.md5("text").alias("text_md5"), F.lit("").alias("key"), F.monotonically_increasing_id().alias("rep"))
    plan = N._sets(named, wanted, N.SHINGLE)._jdf.queryExecution().optimizedPlan().toString()
    assert "text_md5#" in plan.split("Join Inner")[1].split("\n")[0]


def test_probminhash_estimates_probability_jaccard():
    rng = np.random.default_rng(2)
    elements = N._mix(np.arange(1, 61, dtype=np.uint64))
    x, y = rng.uniform(0.5, 4, 60), rng.uniform(0.5, 4, 60)
    x[40:50], y[50:] = 0, 0
    exact = sum(1 / sum(max(a / x[d], b / y[d]) for a, b in zip(x, y, strict=True)) for d in range(60) if x[d] and y[d])
    same = []
    for k in range(60):  # independent repetitions: other elements, same weights
        e = N._mix(elements + np.uint64(1000 * k))
        same.append((N.probminhash(e[x > 0], x[x > 0], 128) == N.probminhash(e[y > 0], y[y > 0], 128)).mean())
    assert abs(np.mean(same) - exact) < 0.02


def test_signature_does_not_depend_on_the_horizon():
    elements = N._mix(np.arange(1, 8, dtype=np.uint64))
    assert len(N.probminhash(elements, np.ones(7))) == N.BANDS * N.ROWS
    long = N._mix(np.arange(1, 30_000, dtype=np.uint64))
    a, b = N.probminhash(long, np.ones(len(long))), N.probminhash(long[:-1], np.ones(len(long) - 1))
    assert (a == b).mean() > 0.97
    single = N.probminhash(elements[:1], np.ones(1))
    assert (single == elements[0]).all()


def test_components_on_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, 200 + k) for k in range(300)] + [(900, 800), (800, 900)]
    got = {r["node"]: r["root"] for r in N.components(spark.createDataFrame(edges, "a bigint, b bigint"), Scratch(spark, "t"), "c").collect()}
    assert {got[k] for k in range(61)} == {0} and {got[k] for k in [100, *range(200, 500)]} == {100} and got[900] == 800
