"""Operator 11 - alignment of two tokenizers by an identity map.

Tokenizer A (byte-level BPE) reads a space and the text, tokenizer B (pieces) the text, before which it
puts that space itself; so both give tokens over the same bytes. Byte offsets where tokens of both
end cut them into groups, and the two tokens that end a group together are linked.

* ``identity_map`` holds for each id of A the id of B with the same bytes. Groups of one A and one B
  token are exactly its entries, and are counted in a vector as long as A's vocabulary, one per task.
* Only the links of irregular groups (several tokens on a side) are counted as (a, b) rows and
  shuffled, pre-aggregated by task. So the shuffle does not grow with the regular part of the texts.
* A document's links get their counts back from arrays as long as a vocabulary (regular links, and the highest
  count of each B id) and from the ``HEAD_SHARE`` most frequent irregular pairs, at most 2^17 by that
  definition; all other pairs, each of them rare, are joined.

Neither tokenizer merges across a space that has a word before and behind it, so a text's tokens are
those of its units (a word with its leading space); a Python worker aligns each unit once and keeps
about ``UNITS`` of them. A unit is any text between two such spaces, however long.

Edge cases: null and empty texts, and texts whose bytes either tokenizer does not give back (U+2581, which
B cannot tell from a space), have no tokens: zeros, and an empty ``groups``. Repeated rows and rows without an id are
documents of their own; extra columns are ignored; an empty table gives an empty result; working memory
follows the longest text.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, stored, table, whole_text
from .tokenids import PIECE_BPE, tokenizer_path

BYTE_BPE = "byte_bpe_50k.json"
UNITS = 500_000          # aligned units kept by one Python worker; forgotten together beyond that,
LONG_CHARS = 1 << 22     # or when units of over UNIT_CHARS characters add up to this
UNIT_CHARS = 64
HEAD_SHARE = 1 / (1 << 17)
BATCH_TEXT = 1 << 20     # characters of text aligned in one round

# A cut: a space between a character that is none and a plain ASCII one.
_CUT = re.compile(r"(?<=[^ ▁]) (?=[!-~])")
_PLAIN = re.compile("[ -~\n\xc0-\u024f]+")  # characters whose class is the same in every Unicode table
_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|"
            r"\s+(?!\S)|\s+")                 # fixed value: the split pattern of byte-level BPE
_BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
LINKS = "pair array<int>, times array<int>"
ROW = f"doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, {LINKS}"


def _byte_alphabet() -> dict[str, int]:
    """Character -> byte of byte-level BPE: printable Latin-1 characters stand for themselves, the
    other bytes for the characters from U+0100 on, in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Aligner:
    """Aligned units of the two tokenizers; files at the same place on every machine."""

    def __init__(self, path_a: str | None = None, path_b: str | None = None):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self._a = Tokenizer.from_file(path_a or tokenizer_path(BYTE_BPE))
        self._a.encode_special_tokens = True
        self._b = SentencePieceProcessor(model_file=path_b or tokenizer_path(PIECE_BPE))
        alphabet = _byte_alphabet()
        vocab = self._a.get_vocab()
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for piece, i in vocab.items():
            self.bytes_a[i] = bytes(alphabet[c] for c in piece) if all(c in alphabet for c in piece) else piece.encode()
        self.bytes_b = []
        for i in range(self._b.get_piece_size()):
            piece = self._b.id_to_piece(i)
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if self._b.is_byte(i)
                                else b"" if self._b.is_control(i) or self._b.is_unknown(i)
                                else piece.replace("▁", " ").encode())
        spanning = [p for p in self.bytes_b if b" " in p.lstrip(b" ")]
        if spanning:
            raise ValueError(f"pieces cross word borders, units cannot be aligned alone: {spanning[:3]}")
        self.len_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.len_b = np.array([len(x) for x in self.bytes_b], np.int64)
        self.same = self._identity()
        self._fast = self._ranked()
        self._written = [f"{i}{mark}" for mark in (",", "|", ";", "") for i in range(1 << 16)]
        self._forget()

    def _identity(self) -> np.ndarray:
        """For each id of A the id of B with the same bytes, or -1. Pieces go before single bytes of the
        same value, which the model only uses where no piece fits."""
        ids = {}
        for i in sorted(range(len(self.bytes_b)), key=lambda i: (self._b.is_byte(i), i)):
            if self.bytes_b[i]:
                ids.setdefault(self.bytes_b[i], i)
        return np.array([ids.get(x, -1) if x else -1 for x in self.bytes_a], np.int32)

    def _ranked(self):
        """A's vocabulary as ranks, where its merges come in the order of their ids; else None."""
        import tiktoken

        model = json.loads(self._a.to_str())
        vocab = model["model"]["vocab"]
        merges = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["model"]["merges"]]
        if merges != sorted(merges) or model["normalizer"] or model["pre_tokenizer"] != _BYTE_LEVEL:
            return None
        special = {t["id"] for t in model["added_tokens"]}
        ranks = {x: i for i, x in enumerate(self.bytes_a) if i not in special}
        return tiktoken.Encoding("ranked", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def _forget(self) -> None:
        self._known = _Numbers()
        self._text: list[str] = []                     # groups of a unit, in writing
        self._counts = np.zeros((0, 3), np.int64)      # n_a, n_b, n_groups (-1 where the bytes differ)
        self._at = np.zeros(1, np.int64)               # where a unit's pairs begin in the pool
        self._pool = np.zeros(0, np.int32)             # linked a << 16 | b, unit by unit

    def _encode_a(self, units: list[str]) -> list[list[int]]:
        """The library's ids; where letters, digits and spaces are beyond doubt, by the same vocabulary as ranks."""
        plain = [self._fast is not None and _PLAIN.fullmatch(u) is not None for u in units]
        rest = iter(self._a.encode_batch_fast([u for u, p in zip(units, plain) if not p], add_special_tokens=False))
        return [self._fast(u) if p else next(rest).ids for u, p in zip(units, plain)]

    def _learn(self, units: list[str]) -> None:
        """Align units that begin with their space, and add them to the table."""
        ids = (self._encode_a(units), self._b.encode([u[1:] for u in units], num_threads=1))
        raw = [u.encode() for u in units]
        good = self._same_bytes(raw, *ids)
        if not good.all():
            ids = tuple([x if g else [] for x, g in zip(side, good)] for side in ids)
        n_a, n_b = (np.array(list(map(len, side)), np.int64) for side in ids)
        a, b = (np.fromiter(chain.from_iterable(side), np.int64) for side in ids)
        _, last_a, last_b = np.intersect1d(np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b]),
                                           assume_unique=True, return_indices=True)
        # Every unit's end is a common one, so groups lie inside units.
        n_groups = np.bincount(np.searchsorted(np.cumsum(n_a), last_a, side="right"), minlength=len(units))
        # Writing: a group's A tokens, then its B tokens, each with the mark that follows it.
        mark_a, mark_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        mark_a[last_a] = 1
        mark_b[last_b] = 2
        mark_b[np.cumsum(n_b)[n_b > 0] - 1] = 3
        side = np.concatenate([2 * np.searchsorted(last_a, np.arange(len(a))), 2 * np.searchsorted(last_b, np.arange(len(b))) + 1])
        code = np.concatenate([mark_a << 16 | a, mark_b << 16 | b])[np.argsort(side, kind="stable")]
        written = list(map(self._written.__getitem__, code.tolist()))
        at = np.r_[0, np.cumsum(n_a + n_b)].tolist()
        self._text += ["".join(written[i:j]) for i, j in zip(at, at[1:])]
        self._counts = np.concatenate([self._counts, np.stack([n_a, n_b, np.where(good, n_groups, -1)], 1)])
        self._pool = np.concatenate([self._pool, (a[last_a] << 16 | b[last_b]).astype(np.uint32).view(np.int32)])
        self._at = np.concatenate([self._at, self._at[-1] + np.cumsum(n_groups)])

    def _same_bytes(self, units: list[bytes], a: list[list[int]], b: list[list[int]]) -> np.ndarray:
        """Do both tokenizers give back a unit's bytes? Units are looked at one by one only if not all do."""
        raw = b"".join(units)
        ends = np.cumsum(np.array(list(map(len, units))))
        ok = True
        for ids, table, lens in ((a, self.bytes_a, self.len_a), (b, self.bytes_b, self.len_b)):
            flat = list(chain.from_iterable(ids))
            own = np.cumsum(np.r_[0, lens[flat]])[np.cumsum(np.array(list(map(len, ids))))]
            ok = ok and np.array_equal(own, ends) and b"".join(map(table.__getitem__, flat)) == raw
        if ok:
            return np.ones(len(units), bool)
        return np.array([b"".join([self.bytes_a[i] for i in x]) == u == b"".join([self.bytes_b[i] for i in y])
                         for u, x, y in zip(units, a, b)], bool)

    def __call__(self, texts: list[str]) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
        """(groups, (n_a, n_b, n_groups), linked pairs a << 16 | b as signed 32 bits) of each text."""
        if len(self._known) > UNITS or sum(map(len, self._known.long)) > LONG_CHARS:
            self._forget()
        known = self._known
        places = [np.array(list(map(known.__getitem__, _CUT.split(t) if t else ())), np.int64) for t in texts]
        if known.new:
            self._learn([" " + u for u in known.new])
            known.new.clear()
        counts, starts, sizes, text = self._counts, self._at, np.diff(self._at), self._text.__getitem__
        for at in places:
            own = counts[at]
            if not len(at) or own[:, 2].min() < 0:
                yield "", np.zeros(3, np.int64), np.zeros(0, np.int32)
                continue
            size = sizes[at]
            before = np.cumsum(size) - size
            yield (";".join(map(text, at.tolist())), own.sum(axis=0),
                   self._pool[np.repeat(starts[at] - before, size) + np.arange(size.sum())])


class _Numbers(dict):
    """unit -> its number; unknown ones get the next and are listed in ``new``."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []
        self.long: list[str] = []

    def __missing__(self, unit: str) -> int:
        self.new.append(unit)
        if len(unit) > UNIT_CHARS:
            self.long.append(unit)
        number = self[unit] = len(self)
        return number


@cache
def aligner(path_a: str | None = None, path_b: str | None = None) -> Aligner:
    """One per Python worker, so aligned units stay known from task to task."""
    return Aligner(path_a, path_b)


def identity_map(path_a: str | None = None, path_b: str | None = None) -> np.ndarray:
    return aligner(path_a, path_b).same


def aligned_groups(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, groups (``a1,a2|b1;a3|b2,b3``), and its
    distinct links: ``pair`` (a << 16 | b as a signed 32-bit integer) with ``times``."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        align = aligner(path_a, path_b)
        for batch in batches:
            size = np.cumsum(np.r_[0, [len(x) for x in batch.column(1).to_pylist()]])
            i = 0
            while i < batch.num_rows:
                j = max(i + 1, int(np.searchsorted(size, size[i] + BATCH_TEXT, side="right")) - 1)
                done = list(align(batch.column(1)[i:j].to_pylist()))
                counts = np.array([c for _, c, _ in done], np.int64)
                links = [np.unique(p.view(np.uint32), return_counts=True) for _, _, p in done]
                off = pa.array(np.cumsum([0] + [len(p) for p, _ in links]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[i:j], *(pa.array(counts[:, k]) for k in (0, 1, 2, 2)),
                     pa.array([g for g, _, _ in done], pa.string()),
                     *(pa.ListArray.from_arrays(off, pa.array(np.concatenate([x[k] for x in links])
                                                              .astype(np.uint32).view(np.int32))) for k in (0, 1))],
                    names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pair", "times"])
                i = j

    return map_arrow(docs.select(F.col("doc_id").cast("long"), whole_text().alias("t")), run, ROW)


def _codes(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """(all values of a list column, offsets by row)."""
    off = column.offsets.to_numpy()
    return column.values.to_numpy()[off[0]:off[-1]], off - off[0]


def _split(pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    code = pair.view(np.uint32)
    return (code >> 16).astype(np.int64), (code & 0xFFFF).astype(np.int64)


def link_counts(aligned: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """a, b, n, regular: how many links of the corpus join each pair of ids.

    A regular link joins two tokens of the same bytes: an entry of the identity map. Only the others are
    emitted as pairs; a task's regular links leave it as one vector's entries.
    """

    def run(batches) -> Iterator[pa.RecordBatch]:
        same = identity_map(path_a, path_b).astype(np.int64)
        vector = np.zeros(len(same), np.int64)
        pairs, totals, held = [], [], 0
        names = ["a", "b", "n", "regular"]

        def merged() -> tuple[np.ndarray, np.ndarray]:
            code, where = np.unique(np.concatenate(pairs), return_inverse=True)
            return code, np.bincount(where, np.concatenate(totals)).astype(np.int64)

        def rows(code, n) -> pa.RecordBatch:
            a, b = _split(code)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(n), pa.array(np.zeros(len(a), bool))], names=names)

        for batch in batches:
            code, times = _codes(batch.column(0))[0], _codes(batch.column(1))[0]
            a, b = _split(code)
            regular = same[a] == b
            vector += np.bincount(a[regular], times[regular], len(same)).astype(np.int64)
            if not regular.all():
                pairs.append(code[~regular])
                totals.append(times[~regular].astype(np.int64))
                held += len(pairs[-1])
            if held > 1 << 20:
                code, n = merged()
                pairs, totals, held = [code], [n], len(code)
                if held > 1 << 19:
                    yield rows(code, n)
                    pairs, totals, held = [], [], 0
        if pairs:
            yield rows(*merged())
        a = np.flatnonzero(vector)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(same[a]), pa.array(vector[a]), pa.array(np.ones(len(a), bool))], names=names)

    counted = map_arrow(aligned.select("pair", "times"), run, "a long, b long, n long, regular boolean")
    return counted.groupBy("a", "b", "regular").agg(F.sum("n").alias("n")).select("a", "b", "n", "regular")


def scored_documents(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """``aligned`` with n_best (links whose count is the highest of their B id) and count_sum.

    ``counts`` is a stored table of ``link_counts``. To the driver go one count per id of A, one per id
    of B and the pairs with a share of HEAD_SHARE, all bounded by the vocabularies or that share.
    """
    spark = aligned.sparkSession
    best_of = {r.b: r.n for r in counts.groupBy("b").agg(F.max("n").alias("n")).collect()}
    total = counts.agg(F.sum("n")).first()[0] or 0
    head = counts.filter(F.col("regular") | (F.col("n") >= F.lit(total * HEAD_SHARE))).select("a", "b", "n").toPandas()
    best = np.zeros(1 << 16, np.int64)
    best[list(best_of)] = list(best_of.values())
    code = (head["a"].to_numpy(np.int64) << 16 | head["b"].to_numpy(np.int64)).astype(np.uint32)
    order = np.argsort(code)
    shared = spark.sparkContext.broadcast((code[order], head["n"].to_numpy(np.int64)[order], best))

    def run(batches) -> Iterator[pa.RecordBatch]:
        known, n_of, best = shared.value
        for batch in batches:
            pair, off = _codes(batch.column(1))
            times = _codes(batch.column(2))[0].astype(np.int64)
            code = pair.view(np.uint32)
            at = np.minimum(np.searchsorted(known, code), max(len(known) - 1, 0))
            found = known[at] == code if len(known) else np.zeros(len(code), bool)
            n = np.where(found, n_of[at], 0) if len(known) else np.zeros(len(code), np.int64)
            best_links = np.where(found & (n == best[code & 0xFFFF]), times, 0)
            sums = [np.diff(np.r_[0, np.cumsum(x)][off]) for x in (best_links, n * times)]
            row = np.searchsorted(off, np.flatnonzero(~found), side="right") - 1
            left = np.searchsorted(row, np.arange(batch.num_rows + 1))
            rest = [pa.ListArray.from_arrays(pa.array(left.astype(np.int32)), pa.array(x[~found].astype(np.int32)))
                    for x in (pair, times)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, sums), *rest],
                                             names=["row", "n_best", "count_sum", "pair", "times"])

    scored = map_arrow(aligned.select("row", "pair", "times"), run, f"row long, n_best long, count_sum long, {LINKS}")
    rest = (scored.select("row", F.explode(F.arrays_zip("pair", "times")).alias("x"))
            .select("row", F.col("x.pair").cast("long").bitwiseAND(0xFFFFFFFF).alias("pair"), F.col("x.times").alias("times")))
    tail = (counts.filter(~(F.col("regular") | (F.col("n") >= F.lit(total * HEAD_SHARE))))
            .select((F.shiftleft("a", 16) + F.col("b")).alias("pair"), "n", F.col("b").alias("_b")))
    bests = spark.createDataFrame([(int(b), int(n)) for b, n in best_of.items()], "_b long, best long")
    tail = tail.join(F.broadcast(bests), "_b")  # at most one row per id of B
    found = rest.join(tail, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("n") == F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("times") * F.col("n")).alias("more_sum"))
    zero = F.lit(0).cast("long")
    sums = scored.select("row", "n_best", "count_sum")
    return (aligned.drop("pair", "times").join(sums, "row").join(found, "row", "left")
            .withColumn("n_best", F.col("n_best") + F.coalesce("more_best", zero))
            .withColumn("count_sum", F.col("count_sum") + F.coalesce("more_sum", zero))
            .drop("more_best", "more_sum"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    aligned = stored(aligned_groups(table(spark, sf_dir, "documents"))
                     .withColumn("groups_sha256", digest).drop("groups")
                     .withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = stored(link_counts(aligned), "link-counts")
    return scored_documents(aligned, counts).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
