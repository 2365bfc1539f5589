import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tidewater.llm import manifest as M


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def tree(nodes):
    """(root, siblings to the left and right of each node, level by level)."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for k, p in enumerate(at):
            run = level[p // 8 * 8:p // 8 * 8 + 8]
            paths[k].append((run[:p % 8], run[p % 8 + 1:]))
            at[k] = p // 8
        level = [H(*level[k:k + 8]) for k in range(0, len(level), 8)]
    return level[0], paths


def up(h, path):
    for left, right in path:
        h = H(*left, h, *right)
    return h


def brute(rows):
    """rows: (doc_id, text, lang, source, n_chars)."""
    enc = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda d, t, lang, s, n: H(*map(enc, (d, s, lang, n, t)))
    lower = lambda t: t if t is None else "".join(c.lower() if c.isascii() else c for c in t)
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0], leaf(*r), r))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([x[1] for x in sorted(groups[g], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))]) for g in order}
    root, tops = tree([trees[g][0] for g in order])
    out = []
    for g, top in zip(order, tops, strict=True):
        members = sorted(groups[g], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        for (doc, h, r), path in zip(members, trees[g][1], strict=True):
            shown = leaf(r[0], lower(r[1]), *r[2:]) if doc is not None and zlib.crc32(str(doc).encode()) % 3 == 0 else h
            full = path + top
            folded = up(shown, full)
            out.append((doc, h, trees[g][0], root, H(*[x for left, right in full for x in left + right]), folded, folded == root))
    return sorted(out, key=repr)


NAMES = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def texts(n, seed=1):
    rnd = random.Random(seed)
    return [(i, rnd.choice(["Text É", "plain", "", None, "UPPER", "x" * 900]) and f"Doc {i} {rnd.random()}", rnd.choice(["en", "en", "en", "de"]), "s")
            for i in range(n)]


@pytest.mark.parametrize("block", [1, 7, 64, 100, 4096])
def test_against_a_plain_tree(spark, make_docs, block):
    rows = texts(700) + [(10_000, None, None, None), (10_001, "", "", ""), (10_002, "Ünï SOLO", "zz", "s"), (-5, "NEGATIVE", "en", "s")]
    rows += [(None, "null ID", "en", "s")] * 2 + [(3, "same ROW", "de", "s")] * 20
    docs = make_docs(rows).repartition(6)
    got = M.merkle_manifest(M.document_leaves(docs), block).select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2("siblings", 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))
    plain = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in docs.collect()]
    want = brute(plain)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert {w[-1] for w in want} == {True, False}


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 513])
def test_sizes(spark, make_docs, as_documents, n):
    rows = [(i, f"Text {i}", "en", "s") for i in range(n)] + ([(n, "T", "fr", "s")] if n == 9 else [])
    docs = make_docs(rows).withColumn("tree", F.lit("x")).withColumn("place", F.lit(1)).withColumn("hash", F.lit(None).cast("int"))
    got = M.op12_manifest(spark, as_documents(docs))
    assert got.columns == NAMES
    assert sorted(map(tuple, got.collect()), key=repr) == brute([(i, t, g, s, len(t)) for i, t, g, s in rows])


def test_empty(spark, make_docs, as_documents):
    assert M.op12_manifest(spark, as_documents(make_docs([]))).count() == 0


def test_the_octopus_asks_for_the_least():
    """What is asked for is enough, and without any one of it something cannot be derived."""
    rnd = random.Random(3)
    for n in (1, 5, 8, 20, 70, 600):
        leaves = [H(str(i)) for i in range(n)]
        root, paths = tree(leaves)
        levels, level = [leaves], leaves
        while len(level) > 1:
            level = [H(*level[k:k + 8]) for k in range(0, len(level), 8)]
            levels.append(level)
        for size in {1, min(n, 3), n}:
            own = rnd.sample(range(n), size)
            asked = M.missing_nodes(own, n)
            assert len(asked) == len(set(asked)) and (size < n or not asked)
            fetched = {(k, p): levels[k][p] for k, p in asked}
            runs, got = M.derive({p: leaves[p] for p in own}, fetched, n)
            assert got == root
            for p in own:
                assert M.path_parts(runs, p) == [("".join(a), "".join(b)) for a, b in paths[p]]
                assert M.fold(leaves[p], M.path_parts(runs, p)) == root
            for lost in asked:
                with pytest.raises(KeyError):
                    M.derive({p: leaves[p] for p in own}, {k: v for k, v in fetched.items() if k != lost}, n)
