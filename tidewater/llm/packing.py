"""Best-fit packing by a grouping genetic algorithm (operator 6).

Documents become token ids and are cut into pieces of at most ``capacity``; full pieces are
sequences of their own. The rest is packed by a grouping genetic algorithm: an individual is a
set of bins; crossover injects whole well-filled bins of one parent into the other, removes the
bins that hold a document twice, and puts the displaced documents back by best fit. Islands
evolve apart and, between epochs, the best individual of each island moves to the next.

Scale: the pieces are dealt at random into shards of about ``SHARD_PIECES``; a shard is a problem
of its own, solved by ``ISLANDS`` islands as separate tasks, so neither a task's memory nor its
time grows with the corpus, and sharding costs at most one sequence a shard. Only piece lengths
travel: (row, length) out, (row, sequence, offset) back; migration is a shuffle of one
individual an island. Token ids stay where the text is read. Work stops early in a shard whose
sequence count has reached the lower bound ceil(tokens / capacity).

Defined results: null text is empty and becomes the closing id alone; rows that repeat an id are
pieces of their own; a capacity below 1 is refused; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import os
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.scratch import Scratch, with_row_numbers
from tidewater.tables import table

CAPACITY = 2048
CLOSING_ID = 0
SHARD_PIECES = 4096
ISLANDS = 3
POPULATION = 4
GENERATIONS = 5  # in each of the two epochs
VOCABULARY = "word_bpe_49k.json"
CACHE_BYTES = 32 << 20  # about, of each of a worker's word and part caches; one starts anew when full
LONGEST_CACHED = 48
SLICE_CHARS = 1 << 20  # texts encoded together; a longer one goes alone

#: The vocabulary's own split, for lowered texts of letters and signs below U+0180, where lower case
#: and composed forms do not depend on the surroundings: endings, letters, a digit, other signs.
_LETTERS, _NUMBERS = "a-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u017f", "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
_PART = re.compile(rf"'(?:s|t|re|ve|m|ll|d)|[{_LETTERS}]+|[{_NUMBERS}]|[^\s{_LETTERS}{_NUMBERS}]+")
_LATIN = re.compile(r"[\t\n\r -~\u00a1-\u017f]*")
#: The same for Arrow's functions: what keeps a text from being split as a whole (U+0130 has no single
#: lower case), and the parts that are set off by spaces, which leaves the runs of letters.
_NOT_PLAIN = r"[^\t\n\r -~\x{a1}-\x{17f}]|\x{130}|<\|"
_SIGNS = rf"('(?:s|t|re|ve|m|ll|d)|[{_NUMBERS}]|[^\s{_LETTERS}{_NUMBERS}]+)"



# ------------------------------------------------------------------------------- tokenizing
class WordTokenizer:
    """Ids of whole texts, from those of their distinct words.

    The vocabulary's rules never join characters across a space or a line feed, nor across the
    parts that its split makes, so a text's ids are those of its parts in order. Arrow splits the
    texts of Latin letters and signs into parts and numbers them; only distinct parts are looked up,
    and the ids of the texts are gathered from theirs. New parts go to the tokenizer as one string,
    whose ids are divided after each word-final token. Other texts go word by word.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.final = np.zeros(max(vocabulary.values()) + 1, bool)
        self.final[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {"": b""}
        self.held = {"words": 0, "parts": 0}

    def _keep(self, name: str, new: dict[str, bytes]) -> None:
        """Add to a cache, which starts anew beyond its bytes (strings, ids and their objects)."""
        cache = getattr(self, name)
        new = {w: b for w, b in new.items() if len(w) <= LONGEST_CACHED}
        size = sum(len(w) + len(b) for w, b in new.items()) + 150 * len(new)
        if self.held[name] + size > CACHE_BYTES:
            cache.clear()
            cache[""] = b""
            self.held[name] = 0
        cache.update(new)
        self.held[name] += size

    def _each(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype="<u4").tobytes() for x in found]

    def _new_parts(self, parts: list[str]) -> dict[str, bytes]:
        if not parts:
            return {}
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(parts)], add_special_tokens=False)[0].ids, dtype="<u4")
        ends = (self.final[ids].nonzero()[0] + 1) * 4
        if len(ends) != len(parts):  # some part has no word-final token, or several: narrowed down by halves
            half = len(parts) // 2
            return self._new_parts(parts[:half]) | self._new_parts(parts[half:]) if half > 20 else dict(zip(parts, self._each(parts), strict=True))
        raw, begins = ids.tobytes(), [0, *ends.tolist()]
        return {part: raw[i:j] for part, i, j in zip(parts, begins, begins[1:], strict=False)}

    def _of_parts(self, parts: list[str]) -> list[bytes]:
        """Ids of distinct parts."""
        found = list(map(self.parts.get, parts))
        new = self._new_parts([p for p, b in zip(parts, found, strict=True) if b is None])
        self._keep("parts", new)
        return [new[p] if b is None else b for p, b in zip(parts, found, strict=True)] if new else found

    def _latin(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words of ``_LATIN`` characters, part by part."""
        split = [_PART.findall(w.lower()) for w in words]
        distinct = list({p for parts in split for p in parts})
        known = dict(zip(distinct, self._of_parts(distinct), strict=True))
        return {w: b"".join([known[p] for p in parts]) for w, parts in zip(words, split, strict=True)}

    def _of_words(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words without spaces or line feeds."""
        found = list(map(self.words.get, words))
        missing = [w for w, b in zip(words, found, strict=True) if b is None]
        if missing:
            latin = [w for w in missing if _LATIN.fullmatch(w) and "<|" not in w]
            other = list(set(missing).difference(latin))
            new = self._latin(latin) | dict(zip(other, self._each(other), strict=True))
            self._keep("words", new)
            found = [new[w] if b is None else b for w, b in zip(words, found, strict=True)]
        return found

    def encode(self, texts: pa.Array) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text of a string array, nulls as empty."""
        ends = np.cumsum(pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False))
        first = 0
        while first < len(texts):
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + SLICE_CHARS, side="right")))
            yield from self._encode_slice(pc.fill_null(texts.slice(first, last - first).cast(pa.large_string()), ""))
            first = last

    def _encode_slice(self, texts: pa.Array) -> Iterator[bytes]:
        rare = pc.match_substring_regex(texts, _NOT_PLAIN)
        common = pc.utf8_lower(texts.filter(pc.invert(rare)))
        spaced = pc.replace_substring_regex(common, _SIGNS, r" \1 ")
        plain = self._gather(pc.ascii_split_whitespace(spaced), self._of_parts)
        if not pc.any(rare).as_py():
            return plain
        words = pc.split_pattern(pc.replace_substring(texts.filter(rare), "\n", " "), " ")
        other = self._gather(words, self._of_words)
        return (next(other if r else plain) for r in rare.to_pylist())

    @staticmethod
    def _gather(split: pa.Array, look_up) -> Iterator[bytes]:
        """The ids of texts split into pieces, from those of the distinct pieces."""
        numbered = split.flatten().dictionary_encode()
        ids = look_up(numbered.dictionary.to_pylist())
        lengths = np.fromiter(map(len, ids), np.int32, len(ids)) // 4
        pool, begins = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(lengths, dtype=np.int32) - lengths
        of = numbered.indices.to_numpy(zero_copy_only=False)
        counts = lengths[of]
        ends = np.cumsum(counts, dtype=np.int32)  # a slice is far from 2^31 ids, a text longer than that from fitting a row
        # a piece's ids lie together in the pool: from its begin one by one
        at = np.repeat(begins[of] - (ends - counts), counts)
        at += np.arange(len(at), dtype=np.int32)
        gathered = pool[at].tobytes()
        pieces = split.offsets.to_numpy() - split.offsets[0].as_py()
        bounds = (np.r_[np.int64(0), ends][pieces] * 4).tolist()
        return (gathered[a:b] for a, b in zip(bounds, bounds[1:], strict=False))

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        return next(self.encode(pa.array([text])))


@functools.lru_cache(maxsize=1)
def tokenizer_at(path: str) -> WordTokenizer:
    """One tokenizer a worker process: its caches outlive a task."""
    return WordTokenizer(path)


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                 vocabulary: str = VOCABULARY, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids, little-endian 32-bit) per piece.

    ``vocabulary`` is a file name of the public tokenizers, or a path with a slash in it.
    """
    if capacity < 1:
        raise ValueError("capacity must be at least 1")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    closing = np.array([CLOSING_ID], dtype="<u4").tobytes()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizer_at(vocabulary if "/" in vocabulary else vocabulary_path(vocabulary))
        for batch in batches:
            of, piece, start, length, crc, ids = [], [], [], [], [], []
            for r, own_ids in enumerate(tokenizer.encode(batch.column(1))):
                all_ids = own_ids + closing
                for k, at in enumerate(range(0, len(all_ids), 4 * capacity)):
                    part = all_ids[at:at + 4 * capacity]
                    of.append(r)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(part)
            cols = [batch.column(0).take(pa.array(of, pa.int64())), pa.array(piece, pa.int32()),
                    *(pa.array(c, pa.int64()) for c in (start, length, crc))]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(ids, pa.binary())] * with_ids, names)

    return rows.mapInArrow(cut, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
                                + ", ids binary" * with_ids)


# ----------------------------------------------------------------------- the genetic algorithm
def best_fit(sizes: np.ndarray, order: np.ndarray, bins: np.ndarray, fill: list[int], capacity: int) -> None:
    """Put the items ``order`` into the fullest bin that has room, else a new one; in place.

    ``bins`` gets each item's bin and ``fill`` grows with the bins.
    """
    if not len(order):
        return
    least = int(sizes[order].min())
    room = sorted((capacity - f, b) for b, f in enumerate(fill) if capacity - f >= least)
    for item, size in zip(order.tolist(), sizes[order].tolist(), strict=True):
        at = bisect_left(room, (size,))
        if at < len(room):
            left, b = room.pop(at)
            left -= size
        else:
            left, b = capacity - size, len(fill)
            fill.append(0)
        bins[item] = b
        fill[b] += size
        if left >= least:
            insort(room, (left, b))


def renumber(bins: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Bins numbered from 0 without gaps, and their fills."""
    _, dense = np.unique(bins, return_inverse=True)
    return dense.astype(np.int32), np.bincount(dense, weights=sizes).astype(np.int64).tolist()


def fitness(bins: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[int, float]:
    """Fewer bins first; among equals, unevenly filled ones (they leave usable room). Less is better."""
    fill = np.bincount(bins, weights=sizes)
    return len(fill), -float(np.square(fill / capacity).sum())


def seed_individual(sizes: np.ndarray, capacity: int, rng: np.random.Generator, noise: float) -> np.ndarray:
    """Best fit over the items by falling size, the order blurred by ``noise``."""
    bins, fill = np.zeros(len(sizes), np.int32), []
    key = sizes * (1.0 + noise * rng.random(len(sizes))) if noise else sizes.astype(float)
    best_fit(sizes, np.argsort(-key, kind="stable"), bins, fill, capacity)
    return bins


def crossover(one: np.ndarray, other: np.ndarray, sizes: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """Inject well-filled bins of ``one`` into ``other``."""
    fill = np.bincount(one, weights=sizes)
    full = np.argsort(-fill, kind="stable")[:max(1, int(len(fill) * rng.uniform(0.3, 0.9)))]
    chosen = np.zeros(len(fill), bool)
    chosen[full[rng.random(len(full)) < 0.7]] = True
    inside = chosen[one]
    # bins of the other parent that hold an injected item go; their other items are displaced
    hit = np.zeros(int(other.max()) + 1, bool)
    hit[other[inside]] = True
    displaced = (hit[other] & ~inside).nonzero()[0]
    child = np.where(inside, one, other + len(fill)).astype(np.int64)
    placed = np.ones(len(sizes), bool)
    placed[displaced] = False
    dense, filled = renumber(child[placed], sizes[placed])
    out = np.zeros(len(sizes), np.int32)
    out[placed] = dense
    best_fit(sizes, displaced[np.argsort(-sizes[displaced], kind="stable")], out, filled, capacity)
    return out


def mutate(bins: np.ndarray, sizes: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """Empty the worst-filled bins and a few others, and put their items back by best fit."""
    fill = np.bincount(bins, weights=sizes)
    out = rng.random(len(fill)) < 0.02
    out[np.argsort(fill, kind="stable")[:2]] = True
    loose = out[bins].nonzero()[0]
    stay = ~out[bins]
    dense, filled = renumber(bins[stay], sizes[stay])
    child = np.zeros(len(sizes), np.int32)
    child[stay] = dense
    order = loose[np.argsort(-sizes[loose] * (1 + 0.1 * rng.random(len(loose))), kind="stable")]
    best_fit(sizes, order, child, filled, capacity)
    return child


def evolve(population: list[np.ndarray], sizes: np.ndarray, capacity: int, rng: np.random.Generator,
           generations: int = GENERATIONS, size: int = POPULATION) -> list[np.ndarray]:
    """The population after some generations, best first; stops at the lower bound."""
    bound = -(-int(sizes.sum()) // capacity)
    ranked = sorted(((fitness(b, sizes, capacity), k, b) for k, b in enumerate(population)), key=lambda x: x[:2])
    if not ranked:
        for k in range(size):
            b = seed_individual(sizes, capacity, rng, 0.0 if k == 0 else 0.05 * k)
            ranked.append((fitness(b, sizes, capacity), k, b))
            if ranked[-1][0][0] <= bound:
                break
        ranked.sort(key=lambda x: x[:2])
    serial = len(ranked) + size
    for _ in range(generations):
        if ranked[0][0][0] <= bound:
            break
        for _ in range(size):
            a, b = sorted(rng.integers(0, len(ranked), 2))
            child = crossover(ranked[a][2], ranked[b][2], sizes, capacity, rng) if a != b else ranked[a][2]
            if a == b or rng.random() < 0.3:
                child = mutate(child, sizes, capacity, rng)
            ranked.append((fitness(child, sizes, capacity), serial, child))
            serial += 1
        ranked = sorted(ranked, key=lambda x: x[:2])[:size]
    return [b for _, _, b in ranked]


# ------------------------------------------------------------------------------------ Spark
def _epoch(shards: DataFrame, capacity: int, epoch: int) -> DataFrame:
    """Evolve every (shard, island): rows shard, island, sizes, population, elite, bins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for shard, island, raw, individuals in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                sizes = np.frombuffer(raw, "<i4").astype(np.int64)
                rng = np.random.default_rng([epoch, island, shard % (1 << 31)])
                grown = evolve([np.frombuffer(b, "<i4") for b in individuals or []], sizes, capacity, rng)
                packed = [b.astype("<i4").tobytes() for b in grown]
                out.append((shard, island, raw, packed, packed[0], *fitness(grown[0], sizes, capacity)))
            cols = list(zip(*out, strict=True)) or [[]] * 7
            types = [pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.binary()), pa.binary(), pa.int64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                                             ["shard", "island", "sizes", "population", "elite", "bins", "score"])

    return shards.select("shard", "island", "sizes", "population").mapInArrow(
        run, "shard bigint, island int, sizes binary, population array<binary>, elite binary, bins bigint, score double")


def assign_sequences(pieces: DataFrame, scratch: Scratch, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES,
                     islands: int = ISLANDS) -> DataFrame:
    """(row, sequence_id, offset) for a frame with unique ``row`` and ``length`` (1 to capacity).

    ``pieces`` should be a saved table: it is read more than once.
    """
    full = pieces.where(F.col("length") == capacity).select(
        "row", (-F.col("row") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    part = pieces.where(F.col("length") < capacity).select("row", "length")
    n_shards = max(1, -(-part.count() // shard_pieces))
    dealt = part.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(n_shards)).cast("long"))
    # rows and lengths of a shard in one order: about shard_pieces of them, whatever the input
    listed = scratch.save(dealt.groupBy("shard").agg(F.array_sort(F.collect_list(F.struct("row", "length"))).alias("items")), "shards")

    def packed_sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [np.array([x["length"] for x in v], "<i4").tobytes() for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.binary())], ["shard", "sizes"])

    start = (listed.mapInArrow(packed_sizes, "shard bigint, sizes binary")
             .select("shard", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"), "sizes",
                     F.lit(None).cast("array<binary>").alias("population")))
    spread = min(n_shards * islands, 4 * int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    first = scratch.save(_epoch(start.repartition(spread, "shard", "island"), capacity, 0), "epoch0")
    # the best of each island moves on to the next
    moved = first.select("shard", ((F.col("island") + 1) % islands).alias("island"), F.col("elite").alias("guest"))
    second = _epoch(first.join(moved, ["shard", "island"]).select(
        "shard", "island", "sizes", F.concat("population", F.array("guest")).alias("population")), capacity, 1)
    best = second.groupBy("shard").agg(F.min(F.struct("bins", "score", "island", "elite")).alias("best"))

    def spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, items, elite in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                bins = np.frombuffer(elite, "<i4").astype(np.int64)
                sizes = np.array([x["length"] for x in items], np.int64)
                order = np.argsort(bins, kind="stable")
                ends = np.cumsum(sizes[order])
                begins = ends - sizes[order]
                first_of = np.r_[True, bins[order][1:] != bins[order][:-1]]
                base = np.maximum.accumulate(np.where(first_of, begins, 0))
                rows = np.array([x["row"] for x in items], np.int64)[order]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows), pa.array(shard * (1 << 24) + bins[order]), pa.array(begins - base)],
                    ["row", "sequence_id", "offset"])

    placed = (listed.join(best, "shard").select("shard", "items", F.col("best.elite").alias("elite"))
              .mapInArrow(spelled, "row bigint, sequence_id bigint, offset bigint"))
    return full.unionByName(scratch.save(placed, "placed"))


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         vocabulary: str = VOCABULARY, with_ids: bool = False, shard_pieces: int = SHARD_PIECES,
         islands: int = ISLANDS) -> DataFrame:
    """The pieces of ``token_pieces`` with sequence_id and offset."""
    scratch = Scratch(docs.sparkSession, "packing")
    pieces = with_row_numbers(token_pieces(docs, id_col, text_col, capacity, vocabulary, with_ids), scratch, "pieces")
    placed = assign_sequences(pieces.select("row", "length"), scratch, capacity, shard_pieces, islands)
    scratch.drop("shards", "epoch0")
    return pieces.join(placed, "row").drop("row")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
