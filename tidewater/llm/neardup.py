"""Near-duplicate documents by ProbMinHash (operator 7).

A document is its set of ``SHINGLE``-word shingles, weighted by 1 + ln(occurrences). ProbMinHash
lets every shingle arrive at random registers as a Poisson process whose rate is the shingle's
weight; a register keeps the first arrival, and no arrival later than the last filled register is
generated. Two documents share a register's shingle with the probability of their probability
Jaccard similarity. Bands of registers make buckets; documents that meet in a bucket are
candidates, and a candidate pair is a link if the exact Jaccard similarity of the two shingle
sets is at least ``THRESHOLD``. A class is a connected component of links. Links count no
occurrences, so a document that repeats shingles has bands of flat weights besides, in the same
buckets; one that repeats none has the same signature either way.

Buckets are worked off without forming all their pairs. Every bucket picks a hub (the document
that shares most buckets), and each member is compared with it; a bucket in one class is then
done. In the others the members that are outside the largest class are held against the members
of other classes, by what they share of their differences from the hub: that decides a link
exactly, and most pairs fall to a comparison of sizes. Only links leave that join, so no link
between different classes of a bucket is lost and no pair is emitted for nothing.

Scale: copies (equal shingle sets) are one representative from the first aggregate on. Shuffled
are (representative, band, hash), pairs, and the texts of representatives that share a bucket,
once, to form their sets. A hub's pairs are joined to its set by an equi-join that Spark splits.
The largest group is only ever aggregated partially or streamed; nothing is collected.

Defined results: a text of fewer than ``SHINGLE`` words is one shingle of all its words; texts
without words are classed with equal texts; null texts are alone; a class is named by its
smallest doc_id (null if all are null); repeated rows are members of their own; an empty table
gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.scratch import Scratch, with_row_numbers
from tidewater.tables import table

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 25
ROWS = 5  # registers in a band
OUT_ROWS = 512  # rows whose bands a worker hands on together
OUT_ELEMENTS = 1 << 18  # elements of sets that it hands on together; a larger set goes alone

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0x100000001B3)
_BASE_INVERSE = pow(0x100000001B3, -1, 1 << 64)


# --------------------------------------------------------------------------------- shingles
@functools.lru_cache(maxsize=8)
def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(length, _BASE), np.full(length, np.uint64(_BASE_INVERSE))
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def _mix(x: np.ndarray) -> np.ndarray:
    """64-bit finalizer."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words (runs without ASCII white space), by prefix sums over the bytes."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    if not len(raw):
        return np.empty(0, np.uint64)
    inside = (raw != 32) & ((raw < 9) | (raw > 13))
    edge = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
    first, end = (edge == 1).nonzero()[0], (edge == -1).nonzero()[0]
    size = 1 << max(16, int(len(raw)).bit_length())
    up, down = _powers(size)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:len(raw)])))
    return _mix((sums[end] - sums[first]) * down[first] + (end - first).astype(np.uint64) * _GOLDEN)


def shingles(text: str, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes and how often each occurs."""
    words = word_hashes(text)
    if not len(words):
        return words, np.empty(0, np.int64)
    width = min(width, len(words))
    count = len(words) - width + 1
    total = np.full(count, np.uint64(width))
    for j in range(width):
        total = total * _GOLDEN + words[j:j + count]
    return np.unique(_mix(total), return_counts=True)


# ------------------------------------------------------------------------------- ProbMinHash
def probminhash(elements: np.ndarray, weights: np.ndarray, registers: int = BANDS * ROWS) -> np.ndarray:
    """The element of the earliest arrival at each register.

    An element's arrivals are a Poisson process of rate weight, each at a random register, all
    drawn from the element's hash. Only arrivals before ``horizon`` are looked at; it grows until
    every register is filled, so what comes later cannot be first anywhere.
    """
    horizon = registers * (np.log(registers) + 3.0) / weights.sum()
    while True:
        expected = float(weights.max()) * horizon
        draws = int(expected + 3 * np.sqrt(expected)) + 2
        while True:
            steps = np.arange(1, draws + 1, dtype=np.uint64) * _GOLDEN
            bits = _mix(elements[:, None] + steps[None, :])
            gaps = -np.log(((bits >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)
            times = np.cumsum(gaps, axis=1) / weights[:, None]
            if times[:, -1].min() >= horizon:
                break
            draws *= 2
        who, which = (times < horizon).nonzero()
        late_first = np.argsort(-times[who, which], kind="stable")
        who, which = who[late_first], which[late_first]
        at = (bits[who, which] & np.uint64(2047)) % np.uint64(registers)
        winner = np.full(registers, -1, np.int64)
        winner[at.astype(np.int64)] = who  # the last written, the earliest, stays
        if (winner >= 0).all():
            return elements[winner]
        horizon *= 2


def band_keys(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    rows = signature.reshape(bands, -1)
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for j in range(rows.shape[1]):
        key = _mix(key * _GOLDEN + rows[:, j])
    return key.view(np.int64)


def document_bands(elements: np.ndarray, count: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> list[int | None]:
    """Band keys by weighted shingles and, where any is repeated, those by flat weights that differ.

    The band of an item is its place modulo ``bands``; a flat key equal to the weighted one is null.
    """
    if not len(elements):
        return []
    weighted = band_keys(probminhash(elements, 1.0 + np.log(count), bands * rows), bands).tolist()
    if count.max() == 1:
        return weighted
    flat = band_keys(probminhash(elements, np.ones(len(elements)), bands * rows), bands).tolist()
    return weighted + [None if f == w else f for f, w in zip(flat, weighted, strict=True)]


def set_key(elements: np.ndarray, text: str) -> str:
    """Equal for equal shingle sets; for texts without words, for equal texts."""
    raw = elements.tobytes() if len(elements) else b"text:" + text.encode("utf-8", "surrogatepass")
    return hashlib.blake2b(raw, digest_size=16).hexdigest()


def signatures(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, width: int = SHINGLE) -> DataFrame:
    """doc_id, text_md5, key, bands from doc_id, text; key and bands are null for null text."""
    named = docs.select("doc_id", F.md5("text").alias("text_md5"), "text")
    kind = dict(named.dtypes)["doc_id"]

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(k, OUT_ROWS) for b in batches for k in range(0, b.num_rows, OUT_ROWS)):
            keys, found = [], []
            for value in batch.column(2):
                text = value.as_py()
                if text is None:
                    keys.append(None)
                    found.append(None)
                    continue
                elements, count = shingles(text, width)
                keys.append(set_key(elements, text))
                found.append(document_bands(elements, count, bands, rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(keys, pa.string()), pa.array(found, pa.list_(pa.int64()))],
                ["doc_id", "text_md5", "key", "bands"])

    return named.mapInArrow(sign, f"doc_id {kind}, text_md5 string, key string, bands array<bigint>")


# ------------------------------------------------------------------------------- components
def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, root) for the nodes of ``edges`` (a, b): the smallest node of each component.

    Every round a node takes the smallest root around it, then its root's root; rounds grow with
    the logarithm of a chain's length, and hubs are reduced before the shuffle.
    """
    both = scratch.save(edges.select("a", "b").union(edges.select("b", "a")).distinct(), f"{name}-edges")
    labels = scratch.save(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
                          .select("node", F.least("node", "b").alias("root")), f"{name}-0")
    turn, changed = 0, 1
    while changed:
        turn += 1
        near = (both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
                .agg(F.min("root").alias("near")))
        stepped = scratch.save(labels.join(near, "node").select(
            "node", "root", F.least("root", "near").alias("next")), f"{name}-{turn}-step")
        jump = stepped.select(F.col("node").alias("next"), F.col("next").alias("far"))
        moved = scratch.save(stepped.join(jump, "next", "left").select(
            "node", F.coalesce("far", "next").alias("root"), F.col("root").alias("old")), f"{name}-{turn}")
        changed = moved.where(F.col("root") != F.col("old")).count()
        scratch.drop(f"{name}-{turn}-step", f"{name}-{turn - 1}")
        labels = moved.select("node", "root")
    scratch.drop(f"{name}-edges")
    return labels


# --------------------------------------------------------------------------------- the search
def formed_sets(batches: Iterator[pa.RecordBatch], width: int = SHINGLE) -> Iterator[pa.RecordBatch]:
    """rep, n, elements from rep, key, text, where the text has that key.

    One text at a time is a Python string, and about ``OUT_ELEMENTS`` elements wait to be handed on.
    """
    for batch in batches:
        reps, sizes, sets, held = [], [], [], 0
        for rep, key, value in zip(*batch.columns, strict=True):
            text = value.as_py()
            elements, _ = shingles(text or "", width)
            if text is not None and set_key(elements, text) == key.as_py():
                reps.append(rep.as_py())
                sizes.append(len(elements))
                sets.append((elements >> np.uint64(32)).astype(np.uint32).view(np.int32))
                held += len(elements)
            if held >= OUT_ELEMENTS:
                yield _set_batch(reps, sizes, sets)
                reps, sizes, sets, held = [], [], [], 0
        if reps:
            yield _set_batch(reps, sizes, sets)


def _set_batch(reps: list[int], sizes: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(reps, pa.int64()), pa.array(sizes, pa.int32()),
                                       pa.array(sets, pa.list_(pa.int32()))], ["rep", "n", "elements"])


def _sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(rep, n, elements) for ``wanted`` (doc_id, text_md5, key, rep), formed again from their texts.

    A text is found by its id and its hash, so an id that many rows share, null above all, is no
    hot key. Elements are cut to 32 bits here, which for sets of some 100,000 elements can shift
    a similarity by about 1 in 100,000.
    """
    ids = wanted.select(F.col("doc_id").alias("of_id"), "text_md5", "key", "rep")
    hashed = docs.withColumn("text_md5", F.md5("text"))
    texts = hashed.join(ids, (hashed["text_md5"] == ids["text_md5"]) & hashed["doc_id"].eqNullSafe(F.col("of_id"))).select("rep", "key", "text")

    formed = texts.mapInArrow(lambda batches: formed_sets(batches, width), "rep bigint, n int, elements array<int>")
    return formed.dropDuplicates(["rep"])


def _similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (hub, rep) with j, the exact Jaccard similarity of their shingle sets."""
    one = sets.select(F.col("rep"), F.col("n").alias("n1"), F.col("elements").alias("e1"))
    two = sets.select(F.col("rep").alias("hub"), F.col("n").alias("n2"), F.col("elements").alias("e2"))
    shared = F.size(F.array_intersect("e1", "e2"))
    return (pairs.join(one, "rep").join(two, "hub")
            .select("hub", "rep", F.col("n1"), F.col("n2"), shared.alias("shared"))
            .select("hub", "rep", (F.col("shared") / (F.col("n1") + F.col("n2") - F.col("shared"))).alias("j")))


def duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                      bands: int = BANDS, rows: int = ROWS, width: int = SHINGLE) -> DataFrame:
    """One row per row of ``docs``: row, doc_id, text_md5, class_id, class_row.

    ``row`` is unique; ``class_row`` is the smallest row of the class.
    """
    scratch = Scratch(docs.sparkSession, "neardup")
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    signed = with_row_numbers(signatures(named, bands, rows, width), scratch, "signatures")
    owners = scratch.save(signed.where(F.col("key").isNotNull()).groupBy("key").agg(F.min("row").alias("rep")), "owners")
    reps = signed.join(owners.select(F.col("rep").alias("row")), "row", "left_semi")
    placed = (reps.select(F.col("row").alias("rep"), F.posexplode("bands").alias("place", "hash")).where("hash IS NOT NULL")
              .select("rep", (F.col("place") % bands).alias("band"), "hash"))
    shared = scratch.save(placed.groupBy("band", "hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
    met = scratch.save(placed.join(shared, ["band", "hash"]), "members")
    score = met.groupBy("rep").agg(F.sum("n").alias("score"))
    wanted = signed.join(score.select(F.col("rep").alias("row")), "row", "left_semi").select(
        "doc_id", "text_md5", "key", F.col("row").alias("rep"))
    sets = scratch.save(_sets(named, wanted, width), "sets")
    members = scratch.save(met.drop("n").join(score, "rep"), "scored")
    scratch.drop("buckets", "members")

    # one hub a bucket, compared with the bucket's other members
    hubs = scratch.save(members.groupBy("band", "hash").agg(F.max(F.struct("score", (-F.col("rep")).alias("r"))).alias("top"))
                        .select("band", "hash", (-F.col("top.r")).alias("hub")), "hubs")
    met_hub = scratch.save(members.select("band", "hash", "rep").join(hubs, ["band", "hash"]), "met_hub")
    pairs = met_hub.where("rep != hub").select("hub", "rep").distinct()
    links = scratch.save(_similar(pairs, sets).where(F.col("j") >= threshold).select(
        F.col("hub").alias("a"), F.col("rep").alias("b")), "links")
    roots = components(links, scratch, "roots")
    open_rows = _open(met_hub, roots, scratch)
    if not open_rows.isEmpty():
        more = scratch.save(_rest(open_rows, sets, threshold, scratch), "more_links")
        if not more.isEmpty():
            roots = components(links.union(more), scratch, "all_roots")

    # representatives to classes, rows to representatives
    rep_class = scratch.save(owners.join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left")
                             .select("key", F.coalesce("root", "rep").alias("class_row")), "classes")
    rows_out = scratch.save(signed.select("row", "doc_id", "text_md5", "key").join(rep_class, "key", "left")
                            .select("row", "doc_id", "text_md5", F.coalesce("class_row", "row").alias("class_row")), "rows")
    names = scratch.save(rows_out.groupBy("class_row").agg(F.min("doc_id").alias("class_id")), "names")
    scratch.drop("signatures", "sets", "scored")
    return rows_out.join(names, "class_row").select("row", "doc_id", "text_md5", "class_id", "class_row")


def _open(met_hub: DataFrame, roots: DataFrame, scratch: Scratch) -> DataFrame:
    """Members (band, hash, rep, hub, root) of the buckets that hold several classes."""
    rooted = met_hub.join(roots.withColumnRenamed("node", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    mixed = scratch.save(rooted.groupBy("band", "hash").agg(F.min("root").alias("low"), F.max("root").alias("high"))
                         .where("low != high").select("band", "hash"), "mixed")
    return scratch.save(rooted.join(mixed, ["band", "hash"]).select("band", "hash", "rep", "hub", "root"), "open")


def _differences(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (hub, rep) with the hub's size, how many elements the member lacks and adds, and which."""
    one = sets.select("rep", F.col("elements").alias("e1"))
    two = sets.select(F.col("rep").alias("hub"), F.col("n").alias("hub_n"), F.col("elements").alias("e2"))
    lacks, adds = F.array_except("e2", "e1"), F.array_except("e1", "e2")
    return (pairs.join(one, "rep").join(two, "hub")
            .select("hub", "rep", "hub_n", lacks.alias("lacks"), adds.alias("adds"))
            .select("hub", "rep", "hub_n", F.size("lacks").alias("lacks"), F.size("adds").alias("adds"),
                    F.concat("lacks", "adds").alias("diff")))


def _rest(open_rows: DataFrame, sets: DataFrame, threshold: float, scratch: Scratch) -> DataFrame:
    """The links (a, b) between different classes of a bucket, found exactly.

    Members a and b are told by how they differ from the bucket's hub h. With x the number of
    differences they share, |a and b| = |h| - lacks_a - lacks_b + x and
    |a or b| = |h| + adds_a + adds_b - x, so they are linked if and only if x reaches a bound that
    the sizes give. The bound is checked inside the join: first against the sizes alone, which
    rules out most pairs, then by intersecting the differences. Only links leave the join. One
    member of each pair is outside the bucket's largest class.
    """
    diffs = _differences(open_rows.select("hub", "rep").distinct(), sets)
    known = scratch.save(open_rows.join(diffs, ["hub", "rep"]), "known")
    sizes = known.groupBy("band", "hash", "root").agg(F.count(F.lit(1)).alias("n"))
    largest = scratch.save(sizes.groupBy("band", "hash").agg(F.max(F.struct("n", "root")).alias("top")).select(
        "band", "hash", F.col("top.root").alias("top")), "largest")
    outside = known.join(largest, ["band", "hash"]).where("root != top").select(
        "band", "hash", F.col("rep").alias("rep2"), F.col("root").alias("root2"), F.col("lacks").alias("lacks2"),
        F.col("adds").alias("adds2"), F.col("diff").alias("diff2"), "top")
    needed = ((F.lit(threshold) * (F.col("hub_n") + F.col("adds") + F.col("adds2")) - F.col("hub_n") + F.col("lacks")
               + F.col("lacks2")) / (1.0 + threshold)) - 1e-9
    fits = needed <= F.least("lacks", "lacks2") + F.least("adds", "adds2")
    shared = F.size(F.array_intersect("diff", "diff2"))
    once = (F.col("root") == F.col("top")) | (F.col("rep") < F.col("rep2"))
    met = known.join(outside, (known["band"] == outside["band"]) & (known["hash"] == outside["hash"])
                     & (F.col("root") != F.col("root2")) & once & fits & F.when(fits, shared >= needed).otherwise(False))
    return met.select(F.least("rep", "rep2").alias("a"), F.greatest("rep", "rep2").alias("b")).distinct()


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each class: that of the smallest id, nulls last; same columns."""
    classes = duplicate_classes(docs, id_col, text_col, **options)
    kept = classes.groupBy("class_row").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "text_md5")).alias("k")).select(
        F.col("k.doc_id").alias("kept_id"), F.col("k.text_md5").alias("kept_md5"),
        F.col("k.row").alias("kept_row"))
    # null texts are alone, however many rows share an id: they all stay
    with_text = kept.where(F.col("kept_md5").isNotNull()).groupBy("kept_id", "kept_md5").agg(F.count(F.lit(1)).alias("times"))
    rows = docs.where(F.col(text_col).isNotNull()).select(
        F.struct("*").alias("doc"), F.col(id_col).alias("key"), F.md5(F.col(text_col)).alias("md5"))
    joined = rows.join(with_text, F.col("key").eqNullSafe(F.col("kept_id")) & (F.col("md5") == F.col("kept_md5")))
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("key", "md5").orderBy(F.lit(1)))
    return joined.withColumn("place", place).where(F.col("place") == 1).select("doc.*").unionByName(
        docs.where(F.col(text_col).isNull()))


def op7_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id")
