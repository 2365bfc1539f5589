import hashlib
import random
import re

import xxhash
from pyspark.sql import functions as F

from tidewater.llm import fingerprints as P

RUN = re.compile(r"[^\x20\x09-\x0d]+")


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def chain(values):
    """Spark's xxhash64 of several longs: each hash seeds the next."""
    h = 42
    for v in values:
        h = xxhash.xxh64_intdigest((v % (1 << 64)).to_bytes(8, "little"), seed=h)
    return signed(h)


def brute(text, k=P.K, s=P.S):
    found = [u for run in RUN.findall(text) for u in ([run] if len(run) <= P.UNIT_CHARS else run)]
    units = [signed(xxhash.xxh64_intdigest(u.encode(), seed=42)) for u in found]
    inner = [chain(units[i:i + s]) for i in range(len(units) - s + 1)]
    span = k - s + 1
    offsets = [j * s for j in range(k // s)] + ([k - s] if k % s else [])
    found = [chain([inner[i + j] for j in offsets]) for i in range(len(inner) - span + 1)
             if min(inner[i], inner[i + span - 1]) == min(inner[i:i + span])] or inner or units
    return sorted({h >> 32 for h in found})


def hexes(fp):
    return "".join(f"{h & 0xFFFFFFFF:08x}" for h in fp)


def jaccard(a, b):
    a, b = set(a), set(b)
    return 1.0 if not a | b else len(a & b) / len(a | b)


def expected(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), [-ord(c) for c in r[1] or ""] + [1]))
    out = []
    for k, (doc, text) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        moved = len(text) // 3
        edited = text[:len(text) - moved] + following[:moved]
        fp, ed, nx = brute(text), brute(edited), brute(following)
        out.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), hexes(fp), hexes(ed), jaccard(fp, ed), jaccard(fp, nx)))
    return sorted(out, key=repr)


def run(spark, as_documents, make_docs, rows):
    docs = make_docs([(i, t, "en", "s") for i, t in rows]).withColumn("fp", F.lit("x")).withColumn("range", F.lit(1))
    return sorted(map(tuple, P.op9_fingerprints(spark, as_documents(docs)).collect()), key=repr)


def test_against_brute_force(spark, as_documents, make_docs):
    r = random.Random(8)
    bits = ["the", "of", "é", "😀😀", "x" * 60, "\n", " ", "a", "zz", "日本語日本語" * 9]
    rows = [(i * 7 % 1009, " ".join(r.choices(bits, k=r.randint(0, 40)))) for i in range(200)]
    assert run(spark, as_documents, make_docs, rows) == expected(rows)


def test_edges(spark, as_documents, make_docs):
    assert run(spark, as_documents, make_docs, []) == []
    for rows in ([(5, "only one document here")], [(None, "a"), (None, "b c d e f g")], [(None, "n"), (3, "x y z"), (1, None), (2, "")]):
        assert run(spark, as_documents, make_docs, rows) == expected(rows), rows
    assert run(spark, as_documents, make_docs, [(4, "same id b"), (4, "same id a"), (9, "w " * 30_000)]) == expected(
        [(4, "same id b"), (4, "same id a"), (9, "w " * 30_000)])


def test_every_range_boundary_is_closed(spark, as_documents, make_docs):
    rows = [(i, f"text {i} of many words that differ {i}") for i in range(0, 900, 3)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert run(spark, as_documents, make_docs, rows) == expected(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_choice_of_anchors_is_free_of_context(spark):
    words = [f"w{i}" for i in range(60)]
    frame = spark.createDataFrame([(0, " ".join(words)), (1, " ".join(["new", "start"] + words[5:] + ["end"]))], "i int, text string")
    a, b = (dict((x["hash"], x["start"]) for x in r["anchors"]) for r in P.syncmers(frame).orderBy("i").collect())
    inside = {h for h, at in a.items() if at >= 5}
    assert inside and inside <= set(b) and all(a[h] - b[h] == 3 for h in inside)


def test_short_unrelated_texts_are_told_apart(spark, as_documents, make_docs):
    """Every text with a word has a fingerprint, and unrelated ones are not alike."""
    for n in (1, 2, 4, 5, 6, 7):
        rows = [(i, " ".join(f"w{i}x{j}" for j in range(n))) for i in range(150)]
        for _, _, _, fp, ed, near_edited, near_next in run(spark, as_documents, make_docs, rows):
            assert fp and ed and near_next < 1 and near_edited <= 1


def test_one_character_in_an_unspaced_run(spark):
    r = random.Random(4)
    text = "".join(r.choices("日本語中国人大学生年月火水木金土一二三四五", k=1000))
    frame = spark.createDataFrame([(0, text), (1, text[:10] + "々" + text[10:])], "i int, text string")
    a, b = (set(P_.hash for P_ in row["anchors"]) for row in P.syncmers(frame).orderBy("i").collect())
    assert len(a) > 300 and len(a & b) >= 0.97 * len(a)


def test_plan_is_native(spark):
    plan = P.op9_fingerprints(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
