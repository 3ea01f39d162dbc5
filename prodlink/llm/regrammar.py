"""Operator 7 - token ids written as Re-Pair grammars, with random access.

Documents are dealt by ranges of doc_id and sorted, encoded, and closed into shards of about
``SHARD_IDS`` ids at a document's end. Each shard is compressed by Re-Pair: the frequent
adjacent pairs are replaced by nonterminals, again and again, until no pair is frequent.
Every round replaces all pairs within a factor of the most frequent one (a batch of the
one-pair step; overlapping occurrences resolve left to right), which keeps a round vectorised.

File format: a Parquet folder, one row per shard: ``part`` and ``shard`` (ascending doc_id
order), ``n_ids``, ``doc_id``, ``doc_len`` (ids per document, end id included), and the grammar:
``base`` (first nonterminal), ``rules`` (pairs of uint32), ``expansion`` (uint32 ids that each
rule stands for) and ``symbols`` (uint16 where they fit, else uint32; see ``width``). Spark's
committer writes it, so a lost executor leaves no half shard. ``decode_range`` expands only the
symbols that cover a wanted range, found by the expansion lengths.

Edge cases: null text counts as empty (its ids are the end id alone); a null doc_id comes
first; repeated rows are written each, side by side; extra columns are ignored; an
empty table gives an empty folder and an empty result. A shard never cuts a document, so
a task's memory follows the longest document.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import long_id, map_arrow, plain_id, shared_path, table, utf8_slices, whole_text
from .tokenids import with_end, word_bpe

END_ID = 2
SHARD_IDS = 1 << 20
MAX_RULES = 16_000      # with about 49,400 ids, symbols then fit into two bytes
LEAST_COUNT = 8         # a pair rarer than this is left alone
BATCH_FACTOR = 16       # pairs within this factor of the most frequent are replaced in one round
BATCH_LEAST = 512       # and at least this many pairs
SLICE = 1 << 20

FORMAT = ("part int, shard int, n_ids long, doc_id array<long>, doc_len array<long>, base long, "
          "width int, rules binary, expansion binary, symbols binary")


def compress(ids: np.ndarray) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """(base, rules [n, 2], expansion [n], symbols): Re-Pair of one shard."""
    seq = ids.astype(np.uint32)
    base = int(seq.max()) + 1 if len(seq) else 1
    rules = np.zeros((0, 2), np.uint32)
    while len(seq) > 1 and len(rules) < MAX_RULES:
        # One sort brings equal pairs together, each with its place: (left, right, place) in 64 bits.
        left, right, size, place = seq[:-1], seq[1:], int(seq.max()).bit_length(), len(seq).bit_length()
        names = None
        if 2 * size + place > 64:
            names, dense = np.unique(seq, return_inverse=True)
            left, right, size = dense[:-1], dense[1:], len(names).bit_length()
        ordered = left.astype(np.uint64) << np.uint64(size) | right.astype(np.uint64)
        ordered = np.sort(ordered << np.uint64(place) | np.arange(len(ordered), dtype=np.uint64))
        pair = ordered >> np.uint64(place)
        begin = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
        count = np.diff(np.append(begin, len(ordered)))
        often = np.flatnonzero(count >= LEAST_COUNT)
        if not len(often):
            break
        rank = often[np.argsort(-count[often], kind="stable")]
        near = int(np.searchsorted(-count[rank], -count[rank[0]] / BATCH_FACTOR, side="right"))
        rank = np.sort(rank[:min(max(near, BATCH_LEAST), MAX_RULES - len(rules))])
        chosen = pair[begin[rank]]
        chosen = np.stack([chosen >> np.uint64(size), chosen & np.uint64((1 << size) - 1)], axis=1).astype(np.int64)
        chosen = (chosen if names is None else names[chosen]).astype(np.uint32)
        # All occurrences of the chosen pairs, in order of place.
        groups = count[rank]
        first = np.repeat(begin[rank] - np.cumsum(groups) + groups, groups)
        rule = np.full(len(seq), -1, np.int32)
        rule[(ordered[first + np.arange(len(first))] & np.uint64((1 << place) - 1)).astype(np.int64)] = np.repeat(np.arange(len(rank)), groups)
        at = np.flatnonzero(rule >= 0)
        where = rule[at]
        # In a run of overlapping occurrences, every other one is replaced.
        run_start = np.r_[True, at[1:] != at[:-1] + 1]
        step = np.arange(len(at))
        even = (step - np.maximum.accumulate(np.where(run_start, step, 0))) % 2 == 0
        at, where = at[even], where[even]
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq[at] = (base + len(rules) + where).astype(np.uint32)
        seq = seq[keep]
        rules = np.concatenate([rules, chosen])
    expansion = np.ones(base + len(rules), np.int64)
    for i, (a, b) in enumerate(rules.tolist()):
        expansion[base + i] = expansion[a] + expansion[b]
    return base, rules, expansion[base:].astype(np.uint32), seq


def expand(symbols: np.ndarray, base: int, rules: np.ndarray) -> np.ndarray:
    """Replace nonterminals by their pairs until none is left."""
    seq = symbols.astype(np.uint32)
    while True:
        big = seq >= base
        if not big.any():
            return seq
        to = np.cumsum(1 + big) - 1 - big
        out = np.empty(int(to[-1] + 1 + big[-1]), np.uint32)
        small = ~big
        out[to[small]] = seq[small]
        pair = rules[seq[big] - base]
        out[to[big]], out[to[big] + 1] = pair[:, 0], pair[:, 1]
        seq = out


def expand_whole(symbols: np.ndarray, base: int, rules: np.ndarray, expansion: np.ndarray) -> np.ndarray:
    """``expand`` of a whole shard: each rule is expanded once, then all symbols are copied from there."""
    pool = np.concatenate([np.arange(base, dtype=np.uint32), expand(np.arange(base, base + len(rules)), base, rules)])
    size = np.ones(base + len(rules), np.int64)
    size[base:] = expansion
    begin = np.cumsum(size) - size
    symbols = symbols.astype(np.int64)
    size = size[symbols]
    after = np.cumsum(size)
    # Place in the pool: one further than before, but for a jump where a symbol begins.
    at = np.repeat(begin[symbols] - (after - size), size)
    at += np.arange(len(at))
    return pool[at]


def unpack(row: dict) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """The arrays of one stored shard."""
    kind = np.uint16 if row["width"] == 2 else np.uint32
    return (row["base"], np.frombuffer(row["rules"], "<u4").reshape(-1, 2), np.frombuffer(row["expansion"], "<u4"),
            np.frombuffer(row["symbols"], np.dtype(kind).newbyteorder("<")))


def decode_range(row: dict, start: int, length: int) -> np.ndarray:
    """Ids [start, start + length) of a stored shard; only the symbols that cover them are expanded."""
    base, rules, expansion, symbols = unpack(row)
    size = np.ones(len(symbols), np.int64)
    big = symbols >= base
    size[big] = expansion[symbols[big] - base]
    after = np.cumsum(size)
    a = int(np.searchsorted(after, start, side="right"))
    b = int(np.searchsorted(after, start + length, side="left")) + 1
    skip = start - int(after[a - 1] if a else 0)
    return expand(symbols[a:b], base, rules)[skip:skip + length]


def write_ids(docs: DataFrame, path: str, end_id: int = END_ID, tokenizer: str | None = None) -> None:
    """Encode all documents and write their shards, in ascending doc_id order, to the folder ``path``."""
    source = (docs.select(long_id().alias("id"), whole_text().alias("t"))
              .repartitionByRange("id").sortWithinPartitions("id", F.xxhash64("t")))

    def shards(batches) -> Iterator[pa.RecordBatch]:
        encode, part, number = word_bpe(tokenizer), TaskContext.get().partitionId(), 0
        ids, doc_ids, lens, held = [], [], [], 0

        def close():
            base, rules, expansion, symbols = compress(np.concatenate(ids))
            width = 2 if base + len(rules) <= 1 << 16 else 4
            kind = "<u2" if width == 2 else "<u4"
            return pa.RecordBatch.from_pylist([dict(
                part=part, shard=number, n_ids=held, doc_id=np.concatenate(doc_ids), doc_len=np.concatenate(lens),
                base=base, width=width, rules=rules.astype("<u4").tobytes(),
                expansion=expansion.astype("<u4").tobytes(), symbols=symbols.astype(kind).tobytes())], schema=arrow)

        for batch in batches:
            id_column = batch.column(0).to_numpy()
            for i, j, raw, off in utf8_slices(batch.column(1), SLICE):
                flat, at = with_end(*encode(raw, off), end_id)
                lo = 0
                while lo < j - i:
                    # Documents up to the one that fills the shard.
                    hi = int(np.searchsorted(at, at[lo] + SHARD_IDS - held, side="left"))
                    hi = min(max(hi, lo + 1), j - i)
                    ids.append(flat[at[lo]:at[hi]])
                    doc_ids.append(id_column[i + lo:i + hi])
                    lens.append(np.diff(at[lo:hi + 1]))
                    held += int(at[hi] - at[lo])
                    lo = hi
                    if held >= SHARD_IDS:
                        yield close()
                        number += 1
                        ids, doc_ids, lens, held = [], [], [], 0
        if held:
            yield close()

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string
    arrow = to_arrow_schema(_parse_datatype_string(FORMAT))
    map_arrow(source, shards, FORMAT).write.parquet(path)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FORMAT).parquet(path)


def read_documents(files: DataFrame) -> DataFrame:
    """Per document, from the files: id, part, shard, at (ids before it in its shard), n_tokens, ids_crc32."""

    def decode(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                row = batch.slice(r, 1).to_pylist()[0]
                ids = expand_whole(*(unpack(row)[i] for i in (3, 0, 1, 2))).astype("<u4")
                lens = np.array(row["doc_len"], np.int64)
                at = np.r_[0, np.cumsum(lens)]
                n = len(lens)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_id"], pa.int64()), pa.array(np.full(n, row["part"], np.int32)),
                     pa.array(np.full(n, row["shard"], np.int32)), pa.array(at[:-1]), pa.array(lens),
                     pa.array([zlib.crc32(ids[a:b]) for a, b in zip(at, at[1:])], pa.int64())],
                    names=["id", "part", "shard", "at", "n_tokens", "ids_crc32"])

    return map_arrow(files, decode, "id long, part int, shard int, at long, n_tokens long, ids_crc32 long")


def shard_starts(files: DataFrame) -> DataFrame:
    """(part, shard, shard_start): ids before each shard. Running sums run inside a part; over the
    parts there is one row each (as many as the writing job had tasks)."""
    sizes = files.select("part", "shard", "n_ids")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    parts = (sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
             .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start")))
    return (sizes.join(parts, "part")
            .select("part", "shard",
                    (F.col("part_start") + F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).alias("shard_start")))


def op7_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "token-ids")
    write_ids(table(spark, sf_dir, "documents"), path)
    files = read_files(spark, path)
    return (read_documents(files).join(shard_starts(files), ["part", "shard"])
            .select(plain_id("id").alias("doc_id"), (F.col("shard_start") + F.col("at")).alias("start"),
                    "n_tokens", "ids_crc32"))
