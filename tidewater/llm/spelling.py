"""Spelling variants of the words of a corpus by blocked Gram matrices (operator 13).

Words are counted, cut into blocks of one length and compared block by block: a NumPy product of
the blocks' letter-count matrices gives all squared distances at once. One inserted, deleted or
replaced letter moves the counts by a squared distance of at most 2 and the length by at most 1, so
only blocks of equal or adjacent length meet, and of each product only the pairs at most 2 apart
are looked at letter by letter.

Scale: text is read once, counted with partial aggregation, and only words (with their counts) go
further. A length is cut into cells by the number of letters from each of ``GROUPS``; an edit moves a
word to its own cell or to one of a few neighbours, so a word visits those (one way round, each pair
of cells meets once) and no others. Cells of more than ``BLOCK`` words are cut into blocks, and so are
the visitors of a cell; pairs of blocks are dealt to groups of about ``TASK_ROWS`` words and visitors, counted
as often as they meet another block, so that a group does not grow with its cells. Of a product a task holds
``PRODUCT_ROWS`` rows at a time, and of the pairs found in it ``EDIT_LETTERS`` letters. Tables kept on the way
are written in files of about ``FILE_ROWS`` words. Only the sizes of cells are broadcast, where a count finds at
most ``SENT_CELLS``; all other joins name the sort-merge join, as Spark sizes words by their compressed files,
however many rows an explode makes of them. A word has a bounded number of words
one letter away, so links stay in proportion to the vocabulary. A form has at least ``RATIO``
times the count of its word, so chains of forms are logarithmic in the largest count; they are
followed by doubling, a joined table a round.

Defined results: null text holds no words; a null id counts as the empty string in the hash of its
runs; repeated rows count as often as they occur; very long texts are split where they are read;
an empty table gives an empty result. Only the named columns of the input are read, so other
columns, whatever their names, have no effect.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.scratch import Scratch
from tidewater.tables import table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = r"[A-Za-zÀ-ÿ]"
MIN_CHARS = 6
MIN_COUNT = 5
RATIO = 5
#: Letters counted apart to cut a length into cells; all others form a group of their own.
GROUPS = ("eao", "itn", "srlu")
BLOCK = 2048
TASK_ROWS = 20_000
#: Rows of a product, and letters of the pairs found in it, that a task holds at a time.
PRODUCT_ROWS = 256
EDIT_LETTERS = 1 << 20
#: Words in a file of a kept table.
FILE_ROWS = 100_000
#: Cells whose sizes are broadcast, at about 80 bytes each; those of more cells are joined by a shuffle.
SENT_CELLS = 100_000
#: Letters are counted by code point modulo this; letters that share a count only lower distances.
DIM = 64


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, run): the maximal letter runs of at least ``min_chars`` code points, A-Z lower-cased."""
    found = F.regexp_extract_all(F.col(text_col), F.lit(f"{LETTERS}{{{min_chars},}}"), F.lit(0))
    run = F.col("run")
    # ``lower`` is the faster where there are no other letters
    lowered = F.when(F.octet_length(run) == F.length(run), F.lower(run)).otherwise(F.translate(run, UPPER, LOWER))
    return docs.select(F.col(id_col).alias("doc_id"), F.explode(found).alias("run")).select("doc_id", lowered.alias("run"))


def count_words(words: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): the words of column ``word`` that are long and frequent enough."""
    counted = words.where(F.length("word") >= min_chars).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= min_count)


def _codes(words: Iterable[str], length: int) -> np.ndarray:
    """Code points of words of one length, a row a word."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(-1, length)


def _letter_counts(codes: np.ndarray) -> np.ndarray:
    at = np.arange(len(codes))[:, None] * DIM + codes % DIM
    return np.bincount(at.ravel(), minlength=len(codes) * DIM).reshape(-1, DIM).astype(np.float32)


def close_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of two letter-count matrices at a squared distance of at most 2, from their Gram matrix."""
    squared = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    return np.nonzero(squared <= 2)


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row: is ``a`` (of ``b``'s length or one less) exactly one edit from ``b``?"""
    length = a.shape[1]
    if length == b.shape[1]:
        return (a != b).sum(1) == 1
    head = np.cumprod(a == b[:, :length], axis=1, dtype=np.uint8).sum(1)
    tail = np.cumprod((a == b[:, 1:])[:, ::-1], axis=1, dtype=np.uint8).sum(1)
    return head + tail >= length


def linked_pairs(a_codes: np.ndarray, a_counts: np.ndarray, b_codes: np.ndarray, b_counts: np.ndarray):
    """Rows of words ``a`` and ``b`` (of ``a``'s length or one more) one edit apart, a slice at a time.

    Words of the same letters all look close, so their number is no bound of the pairs to look at.
    """
    pairs = EDIT_LETTERS // b_codes.shape[1] + 1
    for start in range(0, len(a_codes), PRODUCT_ROWS):
        i, j = close_pairs(a_counts[start:start + PRODUCT_ROWS], b_counts)
        for k in range(0, len(i), pairs):
            x, y = i[k:k + pairs] + start, j[k:k + pairs]
            linked = one_edit(a_codes[x], b_codes[y])
            yield x[linked], y[linked]


LINKS = "word string, near string, near_n long"
NO_LINKS = pd.DataFrame({"word": pd.Series(dtype=str), "near": pd.Series(dtype=str), "near_n": pd.Series(dtype="int64")})


class _Words:
    """Words of a task: code points and letter counts as one matrix a length."""

    def __init__(self, words: pd.Series):
        self.words = words.to_numpy()
        self.lengths = words.str.len().to_numpy(dtype=np.int64)
        self.place = np.zeros(len(words), dtype=np.int64)
        self.codes, self.counts = {}, {}
        for length in np.unique(self.lengths).tolist():
            at = np.nonzero(self.lengths == length)[0]
            self.place[at] = np.arange(len(at))
            self.codes[length] = _codes(self.words[at], length)
            self.counts[length] = _letter_counts(self.codes[length])

    def by_length(self, at: np.ndarray):
        for length in np.unique(self.lengths[at]).tolist():
            some = at[self.lengths[at] == length]
            yield length, some, self.place[some]


def _links(at_home: pd.DataFrame, visiting: pd.DataFrame) -> pd.DataFrame:
    """Both directions of every link between the blocks of some cells and the blocks of their visitors."""
    keys = ["cell", "row", "column"]
    guests, out = visiting.groupby(keys).indices, []
    home, visitors = _Words(at_home["word"]), _Words(visiting["visitor"])
    n, times, inside = at_home["n"].to_numpy(), visiting["times"].to_numpy(), visiting["inside"].to_numpy()
    for key, at in at_home.groupby(keys).indices.items():
        if key not in guests:
            continue
        for length, own, place in home.by_length(at):
            for other, some, there in visitors.by_length(guests[key]):
                if not length - 1 <= other <= length:
                    continue
                for i, j in linked_pairs(visitors.codes[other][there], visitors.counts[other][there],
                                         home.codes[length][place], home.counts[length][place]):
                    u, v = some[i], own[j]
                    # the words of the cell itself visit it too: each pair of them is taken once
                    once = ~inside[u] | (visitors.words[u] < home.words[v])
                    u, v = u[once], v[once]
                    out += [(visitors.words[u], home.words[v], n[v]), (home.words[v], visitors.words[u], times[u])]
    if not out:
        return NO_LINKS
    return pd.DataFrame({c: np.concatenate([x[k] for x in out]) for k, c in enumerate(NO_LINKS.columns)})


#: Bits for each of a cell's numbers: its words' length and their letters in each of GROUPS.
_CELL_BITS = 15


def cell(word: Column) -> Column:
    """A long that is equal for words of equal length and equal counts in each of ``GROUPS``.

    Longer words than the bits allow may share it with others; they are told apart in the task.
    """
    numbers = [F.length(word), *[F.length(word) - F.length(F.translate(word, g, "")) for g in GROUPS]]
    shifts = range(_CELL_BITS * len(GROUPS), -1, -_CELL_BITS)
    parts = [F.shiftleft(x.cast("long"), s) for x, s in zip(numbers, shifts, strict=True)]
    return sum(parts[1:], parts[0])


def _visits() -> list[int]:
    """What to add to a word's cell for the cells where its near words may be at home: its own (0),
    those with a letter moved to a later group, and those of the next length. The word sees others
    from the other side."""
    length, *groups = [1 << s for s in range(_CELL_BITS * len(GROUPS), -1, -_CELL_BITS)]
    groups.append(0)  # all other letters are not counted
    moves = [groups[j] - groups[i] for i in range(len(groups)) for j in range(i + 1, len(groups))]
    return [0, *moves, *[length + g for g in groups]]


def block_pairs(vocabulary: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """The words of ``vocabulary`` at home and visiting, once for each block they meet, with the ``task`` of that pair of blocks."""
    here = vocabulary.select("word", "n", cell(F.col("word")).alias("cell"))
    step = F.explode(F.array(*[F.lit(v) for v in _visits()])).alias("step")
    there = here.select("word", "n", "cell", step)
    there = there.select("word", "n", (F.col("step") == 0).alias("inside"), (F.col("cell") + F.col("step")).alias("cell"))
    # a cell's visitors are the words of other cells: the counts of cells give them, without a word
    words = here.groupBy("cell").agg(F.count(F.lit(1)).alias("words"))
    visitors = words.select("words", "cell", step).select("words", (F.col("cell") + F.col("step")).alias("cell"))
    visitors = visitors.groupBy("cell").agg(F.sum("words").alias("visitors"))
    blocks = lambda name: F.ceil(F.col(name) / F.lit(block)).cast("int")
    counts = words.join(visitors.hint("merge"), "cell").withColumn("rows", blocks("words")).withColumn("columns", blocks("visitors"))
    sizes = counts.select("cell", "rows", "columns")
    # as many tasks as the rows below need, of ``TASK_ROWS`` each
    met = F.sum(F.col("words") * F.col("columns") + F.col("visitors") * F.col("rows"))
    cells, met = counts.agg(F.count(F.lit(1)), met).first()
    tasks = (met or 0) // TASK_ROWS + 1
    sizes = F.broadcast(sizes) if cells <= SENT_CELLS else sizes.hint("merge")
    spread = lambda own, other: (F.pmod(F.xxhash64("word"), F.col(own)).cast("int"),
                                 F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
    row, every_column = spread("rows", "columns")
    column, every_row = spread("columns", "rows")
    # every block of a cell meets every block of its visitors
    home = here.join(sizes, "cell").select("word", "n", "cell", row.alias("row"), every_column.alias("column"))
    visiting = there.join(sizes, "cell").select(F.col("word").alias("visitor"), F.col("n").alias("times"), "inside", "cell",
                                               column.alias("column"), every_row.alias("row"))
    task = F.pmod(F.xxhash64("cell", "row", "column"), F.lit(tasks)).cast("int")
    return home.withColumn("task", task), visiting.withColumn("task", task)


def near_words(vocabulary: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, near, near_n): the words of ``vocabulary`` (word, n; distinct) one edit apart, both ways."""
    home, visiting = block_pairs(vocabulary, block)
    return home.groupBy("task").cogroup(visiting.groupBy("task")).applyInPandas(lambda a, b: _links(a, b), LINKS)


def follow_forms(forms: DataFrame, scratch: Scratch, files: int) -> DataFrame:
    """(word, root): the end of the chain of forms from each word of ``forms`` (word, form; form non-null).

    ``forms`` is read again each round, so it should be a kept table; a round's table has ``files`` files.
    """
    steps, n = forms.select("word", F.col("form").alias("root")), 0
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("beyond")).hint("merge")
        if steps.join(further, "root", "left_semi").isEmpty():
            return steps
        n += 1
        jumped = steps.join(further, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"))
        steps = scratch.save(jumped.repartition(files), f"steps-{n}")


def group_variants(vocabulary: DataFrame, ratio: int = RATIO, block: int = BLOCK) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for every word of ``vocabulary`` (word, n; distinct).

    A word's form is its most frequent near word (ties: the smallest) if that is at least ``ratio``
    times as frequent; ``root`` follows forms to the last.
    """
    scratch = Scratch(vocabulary.sparkSession, "spelling")
    words = scratch.save(vocabulary.select("word", F.col("n").cast("long").alias("n")), "words")
    files = max(words.count() // FILE_ROWS + 1, vocabulary.sparkSession.sparkContext.defaultParallelism)
    best = near_words(words, block).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    enough = -F.col("best.less") >= F.col("n") * ratio
    found = words.join(best.hint("merge"), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n"))
    found = scratch.save(found.repartition(files), "forms")
    roots = follow_forms(found.where(F.col("form").isNotNull()), scratch, files)
    return found.join(roots.hint("merge"), "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def with_deletions(found: DataFrame, one_in: int = 199) -> DataFrame:
    """(word): the runs of (doc_id, run), one code point deleted where the hash of id and run says so."""
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    hashed = found.select("run", F.crc32(key.cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return hashed.select(F.when(F.col("h") % one_in == 0, cut).otherwise(F.col("run")).alias("word"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return group_variants(count_words(with_deletions(runs(docs)))).select("word", "form", "root", "n", "n_near", "form_n")


OP13_SQL = r"""
WITH RECURSIVE
tab AS (SELECT list(v ORDER BY i) AS t FROM (
  SELECT i, list_reduce([CAST(i AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: xor(c >> 1, 3988292384 * (c & 1))) AS v
  FROM range(256) r(i))),
occ AS (SELECT doc_id, run, count(*) AS m FROM (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY doc_id, run),
hexed AS (SELECT run, m, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS hx FROM occ),
hashed AS (SELECT run, m, xor(4294967295, list_reduce(
    list_concat([4294967295], list_transform(range(1, length(hx), 2), lambda i: CAST('0x' || substr(hx, i, 2) AS BIGINT))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h FROM hexed, tab),
words AS (SELECT word, CAST(sum(m) AS BIGINT) AS n FROM (
  SELECT m, CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
  FROM hashed) WHERE length(word) >= 6 GROUP BY word HAVING sum(m) >= 5),
dels AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
         FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT DISTINCT a.word, b.word AS near, b.n AS near_n FROM dels a JOIN dels b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT DISTINCT d.word, w.word, w.n FROM dels d JOIN words w ON w.word = d.rest
  UNION SELECT DISTINCT w.word, d.word, d.n FROM dels d JOIN words w ON w.word = d.rest),
ranked AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS k, count(*) OVER (PARTITION BY word) AS n_near
           FROM near),
forms AS (SELECT w.word, w.n, CAST(coalesce(r.n_near, 0) AS BIGINT) AS n_near,
                 CASE WHEN r.near_n >= 5 * w.n THEN r.near END AS form, CASE WHEN r.near_n >= 5 * w.n THEN r.near_n END AS form_n
          FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.k = 1),
chain AS (SELECT word, word AS at, 0 AS depth FROM forms
          UNION ALL SELECT c.word, f.form, c.depth + 1 FROM chain c JOIN forms f ON f.word = c.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, (SELECT arg_max(c.at, c.depth) FROM chain c WHERE c.word = f.word) AS root, f.n, f.n_near, f.form_n
FROM forms f
"""
