"""Merkle manifest of a dataset with octopus multiproofs (operator 12).

Every row is a leaf: the SHA-256 of its columns. Leaves stand in order in one tree per group; runs
of ``ARITY`` nodes become their parent until one is left, and the groups' roots form the top tree in
the same way. To prove its leaves, a partition of leaves first finds the least set of node
coordinates that it cannot derive from its own leaves, level by level for all of them together
(the octopus); the coordinates of all partitions are fetched by one join; the partition then derives
the shared interiors once, up to the root, and expands the proof of each leaf from them.

Scale: the leaf hashes are written once, sorted by ranges and numbered within their group from
counts per range, so a group that holds a third of all rows is spread over all tasks. Trees grow a
level a job, each an eighth of the one before. A partition of leaves is a block of ``BLOCK`` places
of one tree. Only levels that some block asks for are read at the fetch; with blocks of whole
subtrees that is a handful of nodes a block. Nothing whole is collected: the driver sees the tallest
tree's size, the levels asked for and the root.

Defined results: leaves are ordered by id (null first), then by leaf hash, so repeated rows have
neighbouring places and equal leaves; a null group is a group of its own, before all others; null
values are hashed as ``-``, empty ones as ``0:``; very long texts are hashed where they are read; an
empty table gives an empty result. ``leaf_hash`` reads the named columns only, and the manifest takes
a frame of its own columns, so other columns have no effect.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.sizing import broadcast_if_small
from tidewater.llm.scratch import Scratch, with_row_numbers
from tidewater.tables import table

ARITY = 8
BLOCK = ARITY**4
TOP = "^"
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_HEX = 64  # characters of a hash
_ROW_BITS = 33  # monotonically_increasing_id keeps the row within its partition in these bits
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def encoded(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    s = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    return F.sha2(F.concat(*[encoded(v) for v in values]), 256)


def _above(n: int) -> int:
    return -(-n // ARITY)


# ---- places ----------------------------------------------------------------------------------

def _placed(rows: DataFrame, order: Sequence[Column], scratch: Scratch, name: str) -> tuple[DataFrame, DataFrame]:
    """(``rows`` with ``place``, its rank in its ``tree`` from 0; one row a tree with its size ``n``)."""
    ordered = with_row_numbers(rows.orderBy("tree", *order), scratch, f"{name}-ordered")
    ordered = ordered.withColumn("part", F.shiftright("row", _ROW_BITS))
    # a tree's rows are neighbours, so this has a row per tree and one more per sorted partition at most
    pieces = ordered.groupBy("tree", "part").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("rows"))
    w = Window.partitionBy("tree").orderBy("part")
    pieces = scratch.save(pieces.withColumn("before", F.sum("rows").over(w) - F.col("rows")), f"{name}-pieces")
    trees = scratch.save(pieces.groupBy("tree").agg(F.sum("rows").alias("n")), f"{name}-trees")
    place = (F.col("row") - F.col("first") + F.col("before")).alias("place")
    joined = ordered.join(broadcast_if_small(pieces.drop("rows")), ["tree", "part"])
    return joined.select(*rows.columns, place), trees


# ---- growing trees ---------------------------------------------------------------------------

def _grow(leaves: DataFrame, trees: DataFrame, scratch: Scratch, name: str) -> list[DataFrame]:
    """(tree, place, hash) of the nodes on each level, from the leaves (tree, place, leaf) of trees (tree, n) up."""
    levels = [leaves.select("tree", "place", F.col("leaf").alias("hash"))]
    tallest, here = trees.agg(F.max("n")).first()[0] or 0, F.col("n")
    while tallest > 1:
        # a tree of one node on this level has its root
        growing = trees.select("tree", here.alias("n")).where(F.col("n") > 1).select("tree")
        runs = levels[-1].join(broadcast_if_small(growing), "tree").groupBy("tree", F.floor(F.col("place") / ARITY).alias("place")).agg(
            F.array_sort(F.collect_list(F.struct("place", "hash"))).alias("run"))
        parent = F.sha2(F.array_join(F.col("run.hash"), ""), 256)
        levels.append(scratch.save(runs.select("tree", "place", parent.alias("hash")), f"{name}-{len(levels)}"))
        tallest, here = _above(tallest), F.ceil(here / ARITY).cast("long")
    return levels


def _roots(levels: list[DataFrame], trees: DataFrame) -> DataFrame:
    """(tree, n, root): a lone leaf itself, else the node of the level where one is left."""
    height = sum([(F.col("n") > ARITY**k).cast("int") for k in range(1, 21)], (F.col("n") > 1).cast("int"))
    tops = [nodes.where(F.col("place") == 0).select("tree", F.lit(k).alias("level"), F.col("hash").alias("root"))
            for k, nodes in enumerate(levels)]
    return trees.withColumn("level", height).join(reduce(DataFrame.unionByName, tops), ["tree", "level"]).select("tree", "n", "root")


# ---- octopus ---------------------------------------------------------------------------------

def missing_nodes(places: Sequence[int], n: int) -> list[tuple[int, int]]:
    """The least set of (level, place) that, with the leaves at ``places``, gives all proofs and the
    root of a tree of ``n`` leaves."""
    known, out, level = set(places), [], 0
    while n > 1:
        runs = {p // ARITY for p in known}
        out += [(level, p) for r in sorted(runs) for p in range(r * ARITY, min((r + 1) * ARITY, n)) if p not in known]
        known, level, n = runs, level + 1, _above(n)
    return out


def derive(leaves: dict[int, str], fetched: dict[tuple[int, int], str], n: int) -> tuple[list[dict[int, str]], str]:
    """Per level the joined hashes of each run that holds a known node, and the root."""
    known, levels, level = dict(leaves), [], 0
    while n > 1:
        runs = {}
        for r in {p // ARITY for p in known}:
            members = range(r * ARITY, min((r + 1) * ARITY, n))
            runs[r] = "".join([known[p] if p in known else fetched[level, p] for p in members])
        levels.append(runs)
        known = {r: sha256(joined.encode()).hexdigest() for r, joined in runs.items()}
        level, n = level + 1, _above(n)
    return levels, known.popitem()[1]


def path_parts(levels: list[dict[int, str]], place: int) -> list[tuple[str, str]]:
    """(hashes to the left, hashes to the right) of a node on each level up from ``place``."""
    out = []
    for runs in levels:
        joined, at = runs[place // ARITY], place % ARITY * _HEX
        out.append((joined[:at], joined[at + _HEX:]))
        place //= ARITY
    return out


def fold(leaf: str, parts: Sequence[tuple[str, str]]) -> str:
    """The root that a leaf and the siblings of its path give."""
    for left, right in parts:
        leaf = sha256((left + leaf + right).encode()).hexdigest()
    return leaf


REQUESTS = "tree string, block long, of string, level int, place long"


def _requests(block: pd.DataFrame) -> pd.DataFrame:
    """Coordinates that a block of leaves lacks, in its own tree and in the top tree."""
    tree, number = block["tree"].iloc[0], block["block"].iloc[0]
    own = missing_nodes(block["place"].tolist(), int(block["n"].iloc[0]))
    top = missing_nodes([int(block["top_place"].iloc[0])], int(block["top_n"].iloc[0]))
    out = [(tree, number, tree, level, p) for level, p in own] + [(tree, number, TOP, level, p) for level, p in top]
    return pd.DataFrame(out, columns=["tree", "block", "of", "level", "place"])


def _expand(block: pd.DataFrame, fetched: pd.DataFrame) -> pd.DataFrame:
    """Proof and folded root of every leaf of a block, from its leaves and the nodes fetched for it."""
    tree = block["tree"].iloc[0]
    got: dict[bool, dict[tuple[int, int], str]] = {True: {}, False: {}}
    for of, level, place, h in zip(fetched["of"], fetched["level"], fetched["node"], fetched["hash"], strict=True):
        got[of == tree][level, place] = h
    places, leaves, shown = block["place"].tolist(), block["leaf"].tolist(), block["shown"].tolist()
    levels, subroot = derive(dict(zip(places, leaves, strict=True)), got[True], int(block["n"].iloc[0]))
    top_place = int(block["top_place"].iloc[0])
    top_levels, root = derive({top_place: subroot}, got[False], int(block["top_n"].iloc[0]))
    top_parts = path_parts(top_levels, top_place)
    top_text = "".join([left + right for left, right in top_parts])
    # what lies above a run is shared by its leaves
    upper: dict[int, tuple[list, str]] = {}
    proofs, folded = [], []
    for place, leaf, given in zip(places, leaves, shown, strict=True):
        run = place // ARITY
        if run not in upper:
            parts = path_parts(levels[1:], run)
            upper[run] = ([*parts, *top_parts], "".join([left + right for left, right in parts]) + top_text)
        parts, text = upper[run]
        first = path_parts(levels[:1], place)
        proofs.append("".join([left + right for left, right in first]) + text)
        # an untouched leaf gives the root that the block derived with it
        folded.append(root if given == leaf else fold(given, [*first, *parts]))
    return pd.DataFrame({"id": block["id"], "leaf": leaves, "subroot": subroot, "siblings": proofs, "folded_root": folded})


def merkle_manifest(leaves: DataFrame, block: int = BLOCK) -> DataFrame:
    """(id, leaf, subroot, root, siblings, folded_root) for every row of ``leaves``.

    ``leaves`` has id, group (string), leaf (hash) and shown (the leaf to verify, often the same).
    ``siblings`` is the proof: the hashes beside the path, joined, level by level from the leaf to the
    root. ``folded_root`` is recomputed from ``shown`` and that proof alone.
    """
    scratch = Scratch(leaves.sparkSession, "manifest")
    tree = F.coalesce(F.concat(F.lit("="), F.col("group")), F.lit("-"))  # null sorts before all others
    bare = scratch.save(leaves.select("id", tree.alias("tree"), "leaf", "shown"), "leaves")
    placed, trees = _placed(bare, [F.col("id").asc_nulls_first(), F.col("leaf")], scratch, "leaves")
    placed = scratch.save(placed, "placed")
    nodes = _grow(placed, trees, scratch, "nodes")
    subroots = scratch.save(_roots(nodes, trees), "subroots")
    tops = subroots.select(F.lit(TOP).alias("tree"), F.col("tree").alias("of"), F.col("root").alias("leaf"))
    top_placed, top_size = _placed(tops, [F.col("of")], scratch, "tops")
    top_placed = scratch.save(top_placed, "top-placed")
    top_nodes = _grow(top_placed, top_size, scratch, "top-nodes")
    found = _roots(top_nodes, top_size).first()
    root, top_n = (found["root"], found["n"]) if found else (None, 0)

    of_tree = scratch.save(trees.join(top_placed.select(F.col("of").alias("tree"), F.col("place").alias("top_place")), "tree"),
                           "of-tree")
    blocked = placed.withColumn("block", F.floor(F.col("place") / block)).join(broadcast_if_small(of_tree), "tree")
    blocked = blocked.withColumn("top_n", F.lit(top_n).cast("long"))
    keys = ["tree", "block"]
    asked = scratch.save(blocked.select(*keys, "place", "n", "top_place", "top_n").groupBy(*keys)
                         .applyInPandas(_requests, REQUESTS), "requests")
    # the levels that blocks ask for, one number a level of either tree
    levels = [(r["top"], r["level"]) for r in asked.select((F.col("of") == TOP).alias("top"), "level").distinct().collect()]
    stored = [(top_nodes if top else nodes)[level].select(F.col("tree").alias("of"), F.lit(level).alias("level"), "place", "hash")
              for top, level in sorted(levels) or [(False, 0)]]
    # the one fetch; stored nodes are unique, and only those of the levels asked for are read
    fetched = asked.join(broadcast_if_small(reduce(DataFrame.unionByName, stored)), ["of", "level", "place"])
    mine = blocked.select(*keys, "id", "leaf", "shown", "place", "n", "top_place", "top_n").groupBy(*keys)
    given = fetched.select(F.col("tree").alias("for_tree"), F.col("block").alias("for_block"), "of", "level",
                           F.col("place").alias("node"), "hash").groupBy("for_tree", "for_block")
    proved = T.StructType([T.StructField("id", leaves.schema["id"].dataType),
                           *[T.StructField(c, T.StringType()) for c in ("leaf", "subroot", "siblings", "folded_root")]])
    return mine.cogroup(given).applyInPandas(lambda a, b: _expand(a, b), proved).withColumn("root", F.lit(root))


def document_leaves(docs: DataFrame, columns: Sequence[str] = COLUMNS, id_col: str = "doc_id", group_col: str = "lang",
                    text_col: str = "text", one_in: int = 3) -> DataFrame:
    """Leaves of ``docs``; where ``one_in`` divides the hash of the id, the shown leaf is of the text
    with A-Z lower-cased."""
    values = [F.col(c) for c in columns]
    changed = [F.translate(v, UPPER, LOWER) if c == text_col else v for c, v in zip(columns, values, strict=True)]
    tampered = F.crc32(F.col(id_col).cast("string").cast("binary")) % one_in == 0
    leaf = docs.select(F.col(id_col).alias("id"), F.col(group_col).cast("string").alias("group"), leaf_hash(*values).alias("leaf"),
                       F.when(tampered, leaf_hash(*changed)).alias("other"))
    return leaf.select("id", "group", "leaf", F.coalesce("other", "leaf").alias("shown"))


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    proved = merkle_manifest(document_leaves(docs))
    return proved.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2("siblings", 256).alias("proof_sha256"),
                         "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _tree_sql(name: str, rows: str, nodes: str, levels: int) -> str:
    """CTEs that carry ``rows`` (g, p, n, folded, proof, ...) up the trees of ``nodes`` (g, p, h, n), level by level."""
    out = [f"{name}0 AS (SELECT * FROM {rows})", f"{name}_nodes0 AS (SELECT g, p, h, n FROM {nodes})"]
    side = "substr(joined, 1, 64 * (x.p % 8)) || {} || substr(joined, 64 * (x.p % 8) + 65)"
    for k in range(levels):
        out.append(f"""{name}_runs{k} AS (SELECT g, p // 8 AS r, string_agg(h, '' ORDER BY p) AS joined, any_value(n) AS n
  FROM {name}_nodes{k} GROUP BY g, p // 8)""")
        out.append(f"""{name}_nodes{k + 1} AS (SELECT g, r AS p, CASE WHEN n > 1 THEN sha256(joined) ELSE joined END AS h,
  CAST(ceil(n / 8.0) AS BIGINT) AS n FROM {name}_runs{k})""")
        out.append(f"""{name}{k + 1} AS (SELECT x.* REPLACE (x.p // 8 AS p, CAST(ceil(x.n / 8.0) AS BIGINT) AS n,
  CASE WHEN x.n > 1 THEN sha256({side.format('folded')}) ELSE folded END AS folded,
  CASE WHEN x.n > 1 THEN proof || {side.format("''")} ELSE proof END AS proof)
  FROM {name}{k} x JOIN {name}_runs{k} y ON x.g = y.g AND x.p // 8 = y.r)""")
    return ",\n".join(out)


def _leaf_sql(text: str) -> str:
    parts = [f"CAST({text if c == 'text' else c} AS VARCHAR)" for c in COLUMNS]
    return "sha256(" + " || ".join(f"coalesce(CAST(strlen({p}) AS VARCHAR) || ':' || {p}, '-')" for p in parts) + ")"


#: Eight levels hold 16 million leaves a group, and three hold 512 groups.
OP12_SQL = f"""
WITH tab AS (SELECT list(v ORDER BY i) AS t FROM (
  SELECT i, list_reduce([CAST(i AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: xor(c >> 1, 3988292384 * (c & 1))) AS v
  FROM range(256) r(i))),
hashed AS (SELECT *, xor(4294967295, list_reduce(
    list_concat([4294967295], list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1),
                                             lambda i: CAST(ord(substr(CAST(doc_id AS VARCHAR), i, 1)) AS BIGINT))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS crc FROM documents, tab),
leaves AS (SELECT doc_id, coalesce('=' || lang, '-') AS g, {_leaf_sql('text')} AS h,
  CASE WHEN crc % 3 = 0 THEN {_leaf_sql(f"translate(text, '{UPPER}', '{LOWER}')")} ELSE {_leaf_sql('text')} END AS shown
  FROM hashed),
base AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS p, count(*) OVER (PARTITION BY g) AS n
         FROM leaves),
start AS (SELECT doc_id, h AS leaf, g, p, n, shown AS folded, '' AS proof FROM base),
{_tree_sql('a', 'start', 'base', 8)},
subroots AS (SELECT g AS lang, h, 'top' AS g, row_number() OVER (ORDER BY g) - 1 AS p, count(*) OVER () AS n FROM a_nodes8),
further AS (SELECT a.doc_id, a.leaf, s.h AS subroot, s.g, s.p, s.n, a.folded, a.proof FROM a8 a JOIN subroots s ON s.lang = a.g),
{_tree_sql('b', 'further', 'subroots', 3)}
SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = h AS verified
FROM b3 JOIN b_nodes3 ON TRUE
"""
