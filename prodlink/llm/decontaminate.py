"""Operator 9 - benchmark decontamination by a prefix-filtered set join.

Words are runs of ASCII letters and digits and of all other non-ASCII characters, after
lower-casing A-Z. A window is ``WINDOW`` consecutive words of an item (an item of fewer
words is one window). A window is the set of its ``SHINGLE``-word shingles with their places;
containment of the whole window is asked for, so the necessary prefix is one shingle: the
rarest in the corpus. The join goes

1. counts: how often each item shingle occurs in the corpus (one pass, partial sums per task);
2. every window is indexed under its rarest shingle only;
3. candidates: a document shingle equal to an indexed one proposes the window at one place
   (positional bound), which must lie inside the document (length bound);
4. verification: the words at that place are compared with the window's, one by one.

The index holds the windows of one block of items, ``BLOCK_WORDS`` words at most (a longer item
is a block of its own); it is broadcast. More items are joined block by block against all
documents, and the hits of a document are united. The text is never shuffled.

Edge cases: null texts and texts without words have no windows and no hits (n_words 0, not
contaminated); items without words are left out; a null item_id is written as ``null``; repeated
items with the same id count once; a null doc_id keeps its row and repeated document rows are
judged each; extra columns are ignored; an empty benchmark hits nothing.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER, UPPER, long_id, map_arrow, plain_id, stored, table, utf8_slices, whole_text

WINDOW = 13
SHINGLE = 5
BLOCK_WORDS = 1 << 19
SLICE = 1 << 20

_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE, _INVERSE = (np.uint64(x) for x in (0xD6E8FEB86659FD93, pow(0xD6E8FEB86659FD93, -1, 1 << 64)))
# Byte -> 0 for a separator, else the byte with A-Z in lower case. Bytes from 0x80 belong to non-ASCII characters.
_WORD = np.zeros(256, np.uint8)
for _b in range(256):
    if _b >= 0x80 or chr(_b).isalnum():
        _WORD[_b] = ord(chr(_b).lower()) if _b < 0x80 else _b

_powers: list[np.ndarray] = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]


def words_of(raw: np.ndarray, off: np.ndarray):
    """(lower-cased bytes, word starts, word ends, word hashes, documents' offsets into the words)."""
    n = len(raw)
    if len(_powers[0]) <= n:
        _powers[:] = [np.multiply.accumulate(np.r_[np.uint64(1), np.full(n + n // 8, b)]) for b in (_BASE, _INVERSE)]
    low = _WORD[raw]
    word = low != 0
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    starts = np.flatnonzero(word & (~np.r_[False, word[:-1]] | edge[:-1])) if n else np.zeros(0, np.int64)
    ends = np.flatnonzero(word & (~np.r_[word[1:], False] | edge[1:])) + 1 if n else starts
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * _powers[0][:n], out=prefix[1:])
    h = (prefix[ends] - prefix[starts]) * _powers[1][starts] * _MIX
    return low, starts, ends, (h ^ h >> np.uint64(29)) * _MIX, np.searchsorted(starts, off)


def shingles(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of ``size`` consecutive words from each place."""
    n = max(0, len(h) - size + 1)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * _BASE + h[k:k + n]
    return out ^ out >> np.uint64(31)


def _inside(at: np.ndarray, places: np.ndarray, size: int) -> np.ndarray:
    """Which places start ``size`` words that end in the same document?"""
    doc = np.searchsorted(at, places, side="right") - 1
    return places + size <= at[doc + 1]


class Windows:
    """The distinct windows of some items."""

    def __init__(self, items: list[tuple[str, str]]):
        owners: dict[tuple[bytes, ...], set[int]] = defaultdict(set)
        self.ids = sorted({i for i, _ in items})
        number = {x: k for k, x in enumerate(self.ids)}
        for item, text in items:
            raw = np.frombuffer(text.encode(), np.uint8)
            low, starts, ends, _, _ = words_of(raw, np.array([0, len(raw)]))
            words = [low[s:e].tobytes() for s, e in zip(starts, ends)]
            for k in range(max(1, len(words) - WINDOW + 1) if words else 0):
                owners[tuple(words[k:k + WINDOW])].add(number[item])
        self.words = list(owners)
        self.owners = [sorted(x) for x in owners.values()]
        # (shingle hash, place) of every window, by shingle size.
        self.shingles: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        for w, words in enumerate(self.words):
            joined = np.frombuffer(b" ".join(words), np.uint8)
            h = words_of(joined, np.array([0, len(joined)]))[3]
            size = min(SHINGLE, len(words))
            self.shingles[size] += [(int(x), w, k) for k, x in enumerate(shingles(h, size).tolist())]
        self.all_hashes = {size: np.unique(np.array([x for x, _, _ in rows], np.uint64))
                           for size, rows in self.shingles.items()}

    def index(self, counts: dict[int, int]) -> None:
        """Keep each window under its rarest shingle; equal counts go by the hash."""
        self.rarest: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for size, rows in self.shingles.items():
            best: dict[int, tuple[int, int, int]] = {}
            for x, w, k in rows:
                key = (counts.get(x, 0), x, k)
                if w not in best or key < best[w]:
                    best[w] = key
            keys = np.array([x for _, x, _ in best.values()], np.uint64)
            order = np.argsort(keys, kind="stable")
            self.rarest[size] = (keys[order], np.array(list(best), np.int64)[order],
                                 np.array([k for _, _, k in best.values()], np.int64)[order])
        del self.shingles, self.all_hashes

    def hits(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, dict[int, tuple[list[list[int]], set[int]]]]:
        """(words per document, {document: ([[first word, end word], ...], item numbers)})."""
        low, starts, ends, h, at = words_of(raw, off)
        found: dict[int, tuple[list[list[int]], set[int]]] = {}
        for size, (keys, windows, places) in self.rarest.items():
            s = shingles(h, size)
            lo = np.searchsorted(keys, s)
            lo[lo == len(keys)] = 0
            for q in np.flatnonzero(keys[lo] == s).tolist() if len(keys) else []:
                doc = int(np.searchsorted(at, q, side="right")) - 1
                k = int(lo[q])
                while k < len(keys) and keys[k] == s[q]:
                    w, begin = int(windows[k]), q - int(places[k])
                    words = self.words[w]
                    k += 1
                    if begin < at[doc] or begin + len(words) > at[doc + 1]:
                        continue
                    if all(low[starts[begin + x]:ends[begin + x]].tobytes() == word for x, word in enumerate(words)):
                        spans, items = found.setdefault(doc, ([], set()))
                        spans.append([begin - int(at[doc]), begin - int(at[doc]) + len(words)])
                        items.update(self.owners[w])
        return np.diff(at), found


def _union(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _blocks(benchmark: DataFrame) -> list[DataFrame]:
    """The items in blocks of at most BLOCK_WORDS words (a longer item alone makes a larger block)."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"),
                             whole_text().alias("t")).distinct()
    size = F.octet_length("t") / 2 + 1  # a word and its separator take two bytes at least
    total = items.agg(F.sum(size)).first()[0] or 0
    n = max(1, int(-(-total // BLOCK_WORDS)))
    return [items.filter(F.pmod(F.xxhash64("item"), F.lit(n)) == k) for k in range(n)]


def _hits_of_block(docs: DataFrame, windows: Windows) -> DataFrame:
    sc = docs.sparkSession.sparkContext
    sizes = sorted(windows.all_hashes)
    shared = sc.broadcast(windows)  # one block of items: bounded by BLOCK_WORDS

    def count(batches) -> Iterator[pa.RecordBatch]:
        known = shared.value.all_hashes
        sums = {size: np.zeros(len(known[size]), np.int64) for size in sizes}
        for batch in batches:
            for _, _, raw, off in utf8_slices(batch.column(0), SLICE):
                _, _, _, h, at = words_of(raw, off)
                for size in sizes:
                    s = shingles(h, size)
                    lo = np.searchsorted(known[size], s)
                    lo[lo == len(known[size])] = 0
                    hit = np.flatnonzero(known[size][lo] == s)
                    hit = hit[_inside(at, hit, size)]
                    sums[size] += np.bincount(lo[hit], minlength=len(known[size]))
        for size in sizes:
            some = np.flatnonzero(sums[size])
            yield pa.RecordBatch.from_arrays([pa.array(known[size][some].view(np.int64)), pa.array(sums[size][some])],
                                             names=["shingle", "n"])

    counted = (map_arrow(docs.select("t"), count, "shingle long, n long")
               .groupBy("shingle").agg(F.sum("n").alias("n")).collect()) if sizes else []
    windows.index({r["shingle"] & 0xFFFFFFFFFFFFFFFF: r["n"] for r in counted})  # at most one row per item shingle
    indexed = sc.broadcast(windows)

    def join(batches) -> Iterator[pa.RecordBatch]:
        index = indexed.value
        for batch in batches:
            n_words, spans, items = [], [], []
            for i, j, raw, off in utf8_slices(batch.column(batch.num_columns - 1), SLICE):
                n, found = index.hits(raw, off)
                n_words.append(n)
                for d in range(j - i):
                    s, o = found.get(d, ((), ()))
                    spans.append([{"a": a, "b": b} for a, b in _union(list(s))])
                    items.append([index.ids[x] for x in sorted(o)])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in range(batch.num_columns - 1)],
                 pa.array(np.concatenate(n_words) if n_words else np.zeros(0, np.int64), pa.int64()),
                 pa.array(spans, hit_type), pa.array(items, pa.list_(pa.string()))], names=names)

    hit_type = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
    schema = docs.drop("t").schema.add("n_words", "long")\
        .add("spans", T.ArrayType(T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])))\
        .add("items", T.ArrayType(T.StringType()))
    names = schema.names
    return map_arrow(docs.select(*[c for c in docs.columns if c != "t"], "t"), join, schema)


def _length(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["b"] - s["a"])


def _merged(spans: Column) -> Column:
    """Union of sorted spans [a, b)."""
    empty = F.array().cast("array<struct<a:bigint,b:bigint>>")
    def step(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        return F.when((F.size(done) > 0) & (s["a"] <= last["b"]),
                      F.concat(F.slice(done, 1, F.size(done) - 1),
                               F.array(F.struct(last["a"].alias("a"), F.greatest(last["b"], s["b"]).alias("b")))))\
            .otherwise(F.concat(done, F.array(s)))
    return F.aggregate(F.array_sort(spans), empty, step)


def find_hits(docs: DataFrame, benchmark: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of every document, n_words, n_hit, items (sorted ids), contaminated."""
    source = docs.select(*keep, whole_text().alias("t"))
    blocks = _blocks(benchmark)

    def windows(block: DataFrame) -> Windows:
        return Windows([(r["item"], r["t"]) for r in block.collect()])  # bounded by BLOCK_WORDS

    if len(blocks) == 1:
        out = _hits_of_block(source, windows(blocks[0]))
    else:
        # Rows get a number, fixed by storing them, and each block's hits are united under it.
        rows = stored(source.withColumn("_n", F.monotonically_increasing_id()), "numbered")
        # One block after another: its windows are gone before the next one's are made.
        hits = [stored(_hits_of_block(rows.select("_n", "t"), windows(b)), "block-hits") for b in blocks]
        every = hits[0]
        for h in hits[1:]:
            every = every.union(h)
        united = (every.groupBy("_n").agg(F.max("n_words").alias("n_words"),
                                          _merged(F.flatten(F.collect_list("spans"))).alias("spans"),
                                          F.array_distinct(F.flatten(F.collect_list("items"))).alias("items")))
        out = rows.drop("t").join(united, "_n").drop("_n")
    out = out.withColumn("n_hit", _length(F.col("spans"))).withColumn("items", F.array_sort("items")).drop("spans")
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(long_id().alias("id"), "text")
    return (find_hits(docs, table(spark, sf_dir, "benchmark"), ["id"])
            .select(plain_id("id").alias("doc_id"), "n_words", "n_hit",
                    F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), "contaminated"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: contaminated documents go."""
    cols = ["doc_id", "text", "lang", "source", "n_chars"]
    return find_hits(docs, table(spark, sf_dir, "benchmark"), cols).filter(~F.col("contaminated")).select(*cols)


OP9_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS words
        FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS i FROM b WHERE len(w) > 0)),
gram AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS words
         FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d JOIN (SELECT DISTINCT n FROM win) ON len(w) >= n)),
found AS (SELECT g.doc_id, g.i, g.n, win.item_id FROM gram g JOIN win ON win.n = g.n AND win.words = g.words),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM found) GROUP BY doc_id),
item AS (SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
         FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(item.n, 0) AS n_items, sha256(coalesce(item.ids, '')) AS items_sha256,
       coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN item ON item.doc_id = d.doc_id
"""
