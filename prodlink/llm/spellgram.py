"""Operator 13 - spelling variants by blocked Gram matrices.

1. Words are counted over all texts: maximal runs of letters, A-Z lower-cased, each task counting before the shuffle.
   As the contract wants, one code point goes from a run where 199 divides the crc32 of ``<doc_id>:<run>``.
2. A word is a vector of letter counts. One inserted or deleted letter gives a squared distance of 1 and a
   length that differs by one, one replaced letter a squared distance of 2 at equal length. So near words lie in
   adjacent length blocks at a squared distance of at most 2.
3. Blocks are cut further by the counts of ``GROUPS`` fixed groups of letters (their sum is the length). A word
   attends the block of its own group counts, and for each group it has a letter of, the block with one letter
   less. Two near words attend a common block: the shorter one's own, or that of all they share. Blocks of more
   than ``CELL`` words are dealt into parts by hash, and every two parts meet in a cell.
4. In a cell one matrix product gives all squared distances at once (a column each for half the squared
   lengths). Pairs at 1 or 2 are verified letter by letter; a pair found in several blocks counts in one.
   Only each word's number of near words and its best one leave the cell.
5. A word's form is its most frequent near word, if at least ``FACTOR`` times as frequent; roots are found by
   doubling the way along the forms, whose counts grow by that factor at every step.

Edge cases: null and empty texts have no words; a null doc_id counts as empty in ``<doc_id>:``; repeated rows count
each; ties between near words go to the smallest in code-point order; extra columns are ignored;
an empty table gives an empty result; working memory follows the longest text and one cell.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, map_arrow, stored, table, whole_text

LEAST_LETTERS = 6
LEAST_TIMES = 5
DROP = 199               # contract: a run's letter goes where this divides its crc32
FACTOR = 5               # contract: a form is at least so many times as frequent
GROUPS = 6               # letter groups: code point mod GROUPS
CELL = 2048              # words of a part of a block
CELL_LETTERS = 32        # and letters of a part, for each of its words
STRIPE = 1 << 22         # distances held at once
COUNTED = 300_000        # distinct words a task counts before it passes them on

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_RUN = re.compile(f"[a-zÀ-ÿ]{{{LEAST_LETTERS},}}")
# Vectors have a place for each letter: a-z and U+00C0 to U+00FF, which are single bytes of Latin-1.
_PLACE = np.zeros(256, np.int64)
_PLACE[97:123] = np.arange(26)
_PLACE[192:256] = np.arange(26, 90)
LETTERS = 90


def shortened(run: str, seed: int) -> str:
    """The run, without one letter where the contract says so; ``seed`` is the crc32 of ``<doc_id>:``."""
    h = zlib.crc32(run.encode(), seed)
    return run if h % DROP else run[:h % len(run)] + run[h % len(run) + 1:]


def word_counts(docs: DataFrame, least_times: int = LEAST_TIMES) -> DataFrame:
    """word, n: words of at least LEAST_LETTERS letters that occur ``least_times`` times or more."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(total.keys()), pa.string()),
                                               pa.array(list(total.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for id_, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seed = zlib.crc32(f"{id_}:".encode())
                # A run that is shorter than a word cannot become one.
                runs = _RUN.findall(text.encode().translate(_LOWER).decode())
                total.update(runs)
                for word in set(runs):
                    if zlib.crc32(word.encode(), seed) % DROP == 0:
                        times = runs.count(word)
                        total[word] -= times
                        total[shortened(word, seed)] += times
                if len(total) > COUNTED:
                    yield rows()
                    total.clear()
        yield rows()

    counted = map_arrow(docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), whole_text().alias("t")),
                        run, "word string, n long")
    return (counted.filter(F.char_length("word") >= LEAST_LETTERS).groupBy("word").agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= least_times))


def attendances(words: DataFrame, groups: int = GROUPS) -> DataFrame:
    """block, whole (is it the word's own block?), word, n; ``block`` holds the group counts as text."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, off = _letters(batch.column(0).to_pylist())
            of = np.repeat(np.arange(batch.num_rows), np.diff(off))
            own = np.bincount(of * groups + code % groups, minlength=batch.num_rows * groups).reshape(-1, groups)
            word, group = np.nonzero(own)
            less = own[word]
            less[np.arange(len(word)), group] -= 1
            take = np.r_[np.arange(batch.num_rows), word]
            block = [",".join(map(str, x)) for x in np.concatenate([own, less]).tolist()]
            whole = np.arange(len(take)) < batch.num_rows
            yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(whole), batch.column(0).take(pa.array(take)),
                                              batch.column(1).take(pa.array(take))], names=["block", "whole", "word", "n"])

    return map_arrow(words.select("word", "n"), run, "block string, whole boolean, word string, n long")


def cells(rows: DataFrame, cell: int = CELL) -> DataFrame:
    """One row per cell: ``i``, ``j`` (the two parts that meet, equal for one) and their words."""
    parts = (rows.groupBy("block").agg(F.count(F.lit(1)).alias("size"), F.sum(F.char_length("word")).alias("letters"))
             .select("block", F.ceil(F.greatest(F.col("size") / cell, F.col("letters") / (cell * CELL_LETTERS))).cast("int").alias("parts")))
    dealt = (rows.join(parts, "block").withColumn("part", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))))
    return (dealt.groupBy("block", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"))
            .agg(F.collect_list(F.struct("word", "n", "whole", "part")).alias("words")))


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(letters of all words as Latin-1 bytes, offsets)."""
    return (np.frombuffer("".join(words).encode("latin-1"), np.uint8).astype(np.int64),
            np.r_[0, np.cumsum(list(map(len, words)))].astype(np.int64))


def near_pairs(words: list[str], whole: np.ndarray, part: np.ndarray, apart: bool,
               groups: int = GROUPS) -> tuple[np.ndarray, np.ndarray]:
    """Places of the near pairs that belong to a cell.

    ``apart``: only pairs between different parts. Of a pair with equal group counts only the block without
    a letter of the first group counts; pairs that both attend as ``whole`` never do.
    """
    n = len(words)
    code, off = _letters(words)
    size = np.diff(off)
    of = np.repeat(np.arange(n), size)
    count = np.bincount(of * LETTERS + _PLACE[code], minlength=n * LETTERS).reshape(n, LETTERS)
    vector = count[:, count.any(axis=0)]
    half = (vector * vector).sum(axis=1, keepdims=True) / 2
    exact = np.float32 if half.max() < 1 << 21 else np.float64  # whole numbers and halves below stay exact
    vector, half = vector.astype(exact), half.astype(exact)
    one = np.ones_like(half)
    left, right = np.hstack([vector, -half, one]), np.hstack([vector, one, -half]).T
    longest = int(size.max())
    front = np.zeros((n, longest + 1), np.uint8)      # letters from the left
    front[of, np.arange(len(code)) - off[of]] = code
    back = np.zeros((n, longest + 1), np.uint8)       # letters from the right
    back[of, off[of + 1] - 1 - np.arange(len(code))] = code
    own = np.bincount(of * groups + code % groups, minlength=n * groups).reshape(n, groups)
    found = []
    step = max(1, STRIPE // n)
    for i in range(0, n, step):
        # Minus half the squared distance; each pair once, from the later word's row.
        x, y = np.nonzero(left[i:i + step] @ right[:, :min(i + step, n)] > -1.25)
        x += i
        pick = (y < x) & ~(whole[x] & whole[y])
        if apart:
            pick &= part[x] != part[y]
        x, y = x[pick], y[pick]
        for k in range(0, len(x), 1 << 18):
            found.append(_verified(x[k:k + (1 << 18)], y[k:k + (1 << 18)], size, front, back, own, whole))
    return tuple(np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in (0, 1))


def _verified(x, y, size, front, back, own, whole) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that differ by exactly one letter and are not counted in another block."""
    swap = size[x] < size[y]
    x, y = np.where(swap, y, x), np.where(swap, x, y)       # x is the longer one, if any
    replaced = (size[x] == size[y])
    same_block = replaced & ~(whole[x] | whole[y])
    differ = front[x] != front[y]
    good = np.where(replaced, differ.sum(axis=1) == 1, False)
    # One letter more: the common beginning and the common end cover the shorter word.
    longer = np.flatnonzero((size[x] == size[y] + 1) & (whole[y] & ~whole[x]))
    if len(longer):
        begin = differ[longer].argmax(axis=1)
        end = (back[x[longer]] != back[y[longer]]).argmax(axis=1)
        good[longer] = begin + end >= size[y[longer]]
    good &= ~replaced | same_block
    x, y = x[good], y[good]
    return x, y


def _first_block(own: np.ndarray, block: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Pairs of equal group counts meet once for each group they have; true in the first group's block."""
    equal = (own[x] == own[y]).all(axis=1)
    first = (own[x] > 0).argmax(axis=1)
    return ~equal | (own[x, first] - block[first] == 1)


def near_words(words: DataFrame, groups: int = GROUPS, cell: int = CELL) -> DataFrame:
    """word, n_near, near, near_n: number of near words and the most frequent one; words without any have no row."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, i, j, rows in zip(*(c.to_pylist() for c in batch.columns[:3]), batch.column(3)):
                if len(rows) < 2:
                    continue
                fields = rows.values
                names = fields.field("word").to_pylist()
                n = fields.field("n").to_numpy()
                whole = fields.field("whole").to_numpy(zero_copy_only=False)
                part = fields.field("part").to_numpy()
                x, y = near_pairs(names, whole, part, i != j, groups)
                if not len(x):
                    continue
                code, off = _letters(names)
                of = np.repeat(np.arange(len(names)), np.diff(off))
                own = np.bincount(of * groups + code % groups, minlength=len(names) * groups).reshape(-1, groups)
                keep = _first_block(own, np.array(block.split(","), np.int64), x, y)
                x, y = np.r_[x[keep], y[keep]], np.r_[y[keep], x[keep]]
                rank = np.argsort(np.argsort(np.array(names, object), kind="stable"), kind="stable")
                order = np.lexsort((rank[y], -n[y], x))
                x, y = x[order], y[order]
                first = np.flatnonzero(np.r_[True, x[1:] != x[:-1]]) if len(x) else x
                word = pa.array(names, pa.string())
                yield pa.RecordBatch.from_arrays(
                    [word.take(pa.array(x[first])), pa.array(np.diff(np.r_[first, len(x)])),
                     word.take(pa.array(y[first])), pa.array(n[y[first]])], names=["word", "n_near", "near", "near_n"])

    met = map_arrow(cells(stored(attendances(words, groups), "blocks"), cell), run, "word string, n_near long, near string, near_n long")
    order = F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("w"))
    return met.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min_by("near", order).alias("near"),
                                   F.max("near_n").alias("near_n"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root for the rows (word, form): the last word on the way along the forms."""
    way = stored(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        further = way.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = stored(way.join(further, "root", "left")
                        .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "forms")
        discard(way)
        way = longer.drop("moved")
        if longer.filter("moved").isEmpty():
            return way


def spelling_groups(docs: DataFrame, groups: int = GROUPS, cell: int = CELL) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    words = stored(word_counts(docs), "words")
    near = (words.join(near_words(words, groups, cell), "word", "left")
            .withColumn("n_near", F.coalesce("n_near", F.lit(0).cast("long")))
            .withColumn("form", F.when(F.col("near_n") >= FACTOR * F.col("n"), F.col("near")))
            .withColumn("form_n", F.when(F.col("form").isNotNull(), F.col("near_n"))))
    rows = stored(near.select("word", "form", "n", "n_near", "form_n"), "near")
    discard(words)
    return (rows.join(roots(rows.filter("form IS NOT NULL")), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(table(spark, sf_dir, "documents"))
