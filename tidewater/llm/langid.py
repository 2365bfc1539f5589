"""Language identification (operator 3).

Multinomial logistic regression on TF-IDF weighted character n-grams (hashed to ``DIM``
coordinates), trained by follow-the-regularised-leader (FTRL-proximal) with elastic-net
penalties, then calibrated by one temperature on rows that training did not see.

What is learned comes only from the text and non-null label of learnable rows (crc32 of the id,
modulo 4, is not 2). Document frequencies cover all learnable rows; the classifier is fitted on
at most ``PER_LABEL`` rows a label, chosen by hash.

Scale: one scan counts document frequencies (each task sends at most ``DIM`` pairs), one scan
reads the fitting sample, one scan predicts; no text is shuffled. To the driver come ``DIM``
frequencies and the sample's sparse counts. The model (``DIM`` x labels floats) is broadcast.

Defined results: a text that is null or has no letter is ``und`` with score 0, and so is every
text if there is nothing to learn from; a null id is neither held out nor learned from; equal
texts get equal predictions; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.tables import table

DIM = 1 << 15
ORDERS = 3  # n-grams of 1 to 3 characters
PER_LABEL = 800
CALIBRATION = 5  # every fifth row of the sample calibrates
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1
UNKNOWN = "und"


# --------------------------------------------------------------------------------- features
@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def ngram_counts(text: str | None, dim: int = DIM, orders: int = ORDERS) -> tuple[np.ndarray, np.ndarray] | None:
    """Sorted coordinates and counts of a text's n-grams; None if it has no letter.

    Letters are lowered; every run of other characters is one space; the text is padded.
    """
    if not text:
        return None
    chars = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = _letters()[chars]
    if not letter.any():
        return None
    line = np.full(len(chars) + 2, 32, dtype=np.uint64)
    line[1:-1][letter] = chars[letter]
    blank = line == 32
    line = line[np.append(True, ~(blank[1:] & blank[:-1]))]
    total, gram = np.zeros(dim, dtype=np.int64), None
    shift = np.uint64(64 - (dim.bit_length() - 1))
    for order in range(1, orders + 1):
        gram = line + np.uint64(order) if gram is None else gram[:-1] * np.uint64(0x100000001B3) + line[order - 1:]
        if not len(gram):
            break
        total += np.bincount(((gram + np.uint64(order)) * np.uint64(0x9E3779B97F4A7C15) >> shift).astype(np.int64), minlength=dim)
    at = total.nonzero()[0]
    return at, total[at]


# ------------------------------------------------------------------------------------ model
@dataclass
class LanguageModel:
    labels: list[str]
    idf: np.ndarray
    weights: np.ndarray  # dim x labels
    bias: np.ndarray
    temperature: float

    def vector(self, counts: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return tfidf(counts, self.idf)

    def probabilities(self, counts: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        at, value = self.vector(counts)
        return _softmax((value @ self.weights[at] + self.bias) / self.temperature)

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = ngram_counts(text, len(self.idf)) if self.labels else None
        if counts is None:
            return UNKNOWN, 0.0
        p = self.probabilities(counts)
        best = int(p.argmax())
        return self.labels[best], float(p[best])


def tfidf(counts: tuple[np.ndarray, np.ndarray], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at, n = counts
    value = (1.0 + np.log(n)) * idf[at]
    return at, value / (np.sqrt(value @ value) or 1.0)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max())
    return e / e.sum()


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, n_labels: int, dim: int,
             epochs: int = EPOCHS, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias after FTRL-proximal steps with elastic-net penalties on the weights."""
    z, n = np.zeros((dim + 1, n_labels)), np.zeros((dim + 1, n_labels))  # the last row is the bias
    l1 = np.full(dim + 1, L1)
    l1[dim] = 0.0

    def weights(at):
        near = np.abs(z[at]) <= l1[at, None]
        return np.where(near, 0.0, (np.sign(z[at]) * l1[at, None] - z[at]) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for r in order.permutation(len(rows)):
            at, value = np.append(rows[r][0], dim), np.append(rows[r][1], 1.0)
            w = weights(at)
            error = _softmax(value @ w)
            error[labels[r]] -= 1.0
            g = value[:, None] * error
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - step * w
            n[at] += g * g
    final = weights(np.arange(dim + 1))
    return final[:dim].astype(np.float32), final[dim]


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """Temperature of least log loss, by golden section over its logarithm."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        z = logits / np.exp(log_t)
        z = z - z.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(labels)), labels]))

    low, high, ratio = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


# ------------------------------------------------------------------------------------- Spark
def held_out(key: Column) -> Column:
    return F.crc32(key.cast("string").cast("binary")) % 4 == 2


def document_frequencies(texts: DataFrame, dim: int = DIM) -> tuple[int, np.ndarray]:
    """Rows with letters, and in how many of them each coordinate occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows = np.zeros(dim, dtype=np.int64), 0
        for batch in batches:
            for value in batch.column(0):
                got = ngram_counts(value.as_py(), dim)
                if got is not None:
                    seen[got[0]] += 1
                    rows += 1
        at = seen.nonzero()[0]
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(seen[at], rows))], ["at", "n"])

    sums = texts.mapInArrow(count, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n"))
    rows, df = 0, np.zeros(dim)
    for r in sums.collect():  # at most dim + 1 rows
        if r["at"] < 0:
            rows = r["n"]
        else:
            df[r["at"]] = r["n"]
    return rows, df


def fitting_sample(labelled: DataFrame, per_label: int = PER_LABEL, dim: int = DIM) -> list[tuple[int, str, tuple]]:
    """(hash, label, counts) of at most ``per_label`` distinct rows a label, smallest hashes first.

    ``labelled`` has doc_id, text and lang. A row's hash depends on its id and text.
    """
    keyed = labelled.withColumn("h", F.xxhash64("doc_id", "text"))
    numbers = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()  # one row a label
    if not numbers:
        return []
    # hashes are even over 64 bits: this share of them holds about a tenth more rows than wanted
    share = {r["lang"]: min(1.0, (1.1 * per_label + 50) / r["n"]) for r in numbers}
    top = {lang: int(-(1 << 63) + part * ((1 << 64) - 1)) for lang, part in share.items()}
    limit = F.create_map(*[x for lang, h in top.items() for x in (F.lit(lang), F.lit(min(h, (1 << 63) - 1)))])

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            out: list[tuple] = []
            for h, label, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                got = ngram_counts(text, dim) if h not in seen else None
                seen.add(h)
                if got is not None:
                    out.append((h, label, got[0].astype(np.int32).tobytes(), got[1].astype(np.int32).tobytes()))
            cols = list(zip(*out, strict=True)) or [[]] * 4
            types = [pa.int64(), pa.string(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["h", "lang", "at", "n"])

    got = keyed.where(F.col("h") <= limit[F.col("lang")]).select("h", "lang", "text").mapInArrow(
        counts, "h bigint, lang string, at binary, n binary")
    rows = {r["h"]: (r["h"], r["lang"], (np.frombuffer(r["at"], np.int32), np.frombuffer(r["n"], np.int32)))
            for r in got.toLocalIterator()}
    taken: dict[str, int] = {}
    sample = []
    for h in sorted(rows):
        taken[rows[h][1]] = taken.get(rows[h][1], 0) + 1
        if taken[rows[h][1]] <= per_label:
            sample.append(rows[h])
    return sample


def train(docs: DataFrame, per_label: int = PER_LABEL, dim: int = DIM) -> LanguageModel:
    """Fit on the learnable rows of a frame with doc_id, text and lang."""
    learnable = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    n, df = document_frequencies(learnable.select("text"), dim)
    idf = np.log((1.0 + n) / (1.0 + df)) + 1.0
    sample = fitting_sample(learnable, per_label, dim)
    labels = sorted({label for _, label, _ in sample})
    if not labels:
        return LanguageModel([], idf, np.zeros((dim, 0), np.float32), np.zeros(0), 1.0)
    place = {label: k for k, label in enumerate(labels)}
    rows = [tfidf(c, idf) for _, _, c in sample]
    target = np.array([place[label] for _, label, _ in sample])
    apart = np.arange(len(rows)) % CALIBRATION == CALIBRATION - 1
    fit = (~apart).nonzero()[0]
    weights, bias = fit_ftrl([rows[r] for r in fit], target[fit], len(labels), dim)
    logits = np.array([v @ weights[at] + bias for at, v in (rows[r] for r in apart.nonzero()[0])])
    return LanguageModel(labels, idf, weights, bias, fit_temperature(logits, target[apart]))


def predictions(batches: Iterator[pa.Array], model: LanguageModel) -> Iterator[pa.Array]:
    """Structs (lang, score) of texts, of which one at a time is a Python string."""
    for texts in batches:
        found = [model.predict(t.as_py()) for t in texts]
        yield pa.StructArray.from_arrays([pa.array([lang for lang, _ in found], pa.string()),
                                          pa.array([score for _, score in found], pa.float64())], ["lang", "score"])


def predict_column(spark: SparkSession, model: LanguageModel, text: Column) -> Column:
    """struct(lang, score) for a text column."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("lang string, score double")
    def predicted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from predictions(batches, shared.value)

    return predicted(text)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
             per_label: int = PER_LABEL) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row."""
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(label_col).alias("lang"))
    model = train(named, per_label)
    scored = named.select("doc_id", predict_column(docs.sparkSession, model, F.col("text")).alias("p"))
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
                         F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
                    least_score: float = 0.5, per_label: int = PER_LABEL) -> DataFrame:
    """The rows of ``docs`` whose language is known with at least ``least_score``; same columns."""
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(label_col).alias("lang"))
    model = train(named, per_label)
    rows = docs.select(F.struct("*").alias("doc"), predict_column(docs.sparkSession, model, F.col(text_col)).alias("p"))
    return rows.where((F.col("p.lang") != UNKNOWN) & (F.col("p.score") >= least_score)).select("doc.*")


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
