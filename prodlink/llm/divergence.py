"""Operator 12 - quality rules by divergence from language references.

Two rules are plain: fewer than ``LEAST_WORDS`` words, or over half of the words in 3-word windows found twice
or more. Documents that pass them are compared with references:

* a histogram of character classes (``CLASSES``) and one of the language's ``COMMON`` most frequent words and
  all others, each against the same histogram of every language that has a reference; the distance is the square
  root of the Jensen-Shannon divergence in bits (0 to 1), and the nearest reference counts;
* a document is kept if both distances are within their bound. A short text strays further by chance, so a
  bound is ``BOUND + SLACK / sqrt(length)``: the length guard. At least LEAST_WORDS words are there anyway.

References are counted over all documents that pass the plain rules and name a language. A language gets one if it
has ``LEAST_SHARE`` of those documents' words (at most 1,000 languages by that definition). Words under
``WORD_SHARE`` of a language are no candidates, so at most 2,000 rows a language are ranked, and at most
COMMON + 9 numbers a language reach the driver and the tasks. A document that names a language without a reference is
not judged and kept, as are all where no language has one.

Edge cases: null and empty texts and texts without words fail the plain rules; rows without an id or language
and repeated rows each get a row; ties between words go by code point; extra columns are ignored; an
empty table gives an empty result; working memory follows the longest text.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import map_arrow, stored, table, utf8_slices, whole_text
from .superminhash import mix

LEAST_WORDS = 50
REPEATED = 0.5
COMMON = 64
LEAST_SHARE = 1 / 1000
WORD_SHARE = 1 / 2000
CHAR_BOUND, CHAR_SLACK = 0.2, 1.5     # against the number of characters
WORD_BOUND, WORD_SLACK = 0.28, 1.0    # against the number of words
COUNTED = 300_000                     # distinct words a task counts before it passes them on

# Character classes; every character is in one.
CLASSES = ("space", "lower", "upper", "digit", "mark", "other", "beyond")
MARKS = b".,;:!?'\"()-"
SYMBOLS = b"#*$%&|<>"  # contract: the symbols counted
_SPACE = [9, 10, 11, 12, 13, 32]


def _class_table() -> np.ndarray:
    """Byte -> class; bytes that continue a character have class 7, which is dropped."""
    t = np.full(256, 5, np.int64)
    t[_SPACE] = 0
    t[97:123], t[65:91], t[48:58] = 1, 2, 3
    t[list(MARKS)] = 4
    t[128:192], t[192:] = 7, 6
    return t


_CLASS = _class_table()
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_BASE = np.uint64(0xC2B2AE3D27D4EB4F)
_INVERSE = np.uint64(pow(0xC2B2AE3D27D4EB4F, -1, 1 << 64))
_powers: list[np.ndarray] = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]


def _sum_by(owner: np.ndarray, n: int, values: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(owner, values, n).astype(np.int64)


def repeated_words(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Words of each text that lie in a 3-word window found twice or more in it; ``at``: offsets of the texts."""
    n, docs = len(hashes), len(at) - 1
    hit = np.zeros(n, bool)
    if n >= 3:
        owner = np.repeat(np.arange(docs), np.diff(at))
        own = owner[:-2] == owner[2:]
        window = mix(mix(mix(hashes[:-2] + owner[:-2].astype(np.uint64)) + hashes[1:-1]) + hashes[2:])
        place = np.flatnonzero(own)
        order = place[np.argsort(window[place], kind="stable")]
        equal = (window[order[1:]] == window[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])
        twice = order[np.r_[False, equal] | np.r_[equal, False]] if len(order) else order
        for k in range(3):
            hit[twice + k] = True
    return np.diff(np.r_[0, np.cumsum(hit)][at])


def measures(raw: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """The plain counts of each text, its class histogram and whether it fails the plain rules."""
    n, docs = len(raw), len(off) - 1
    if len(_powers[0]) <= n:
        _powers[:] = [np.multiply.accumulate(np.r_[np.uint64(1), np.full(n + n // 8, b)]) for b in (_BASE, _INVERSE)]
    owner = np.repeat(np.arange(docs), np.diff(off))
    kind = _CLASS[raw]
    classes = np.bincount(owner * 8 + kind, minlength=docs * 8).reshape(docs, 8)[:, :7]
    word = kind != 0
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    starts = np.flatnonzero(word & (~np.r_[False, word[:-1]] | edge[:-1])) if n else np.zeros(0, np.int64)
    ends = np.flatnonzero(word & (~np.r_[word[1:], False] | edge[1:])) + 1 if n else starts
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _powers[0][:n], out=prefix[1:])
    hashes = mix((prefix[ends] - prefix[starts]) * _powers[1][starts] + (ends - starts).astype(np.uint64))
    at = np.searchsorted(starts, off)
    n_words, n_repeat = np.diff(at), repeated_words(hashes, at)
    return {"n_words": n_words, "word_chars": classes[:, 1:].sum(axis=1), "n_symbols": _sum_by(owner[_IS_SYMBOL[raw]], docs),
            "n_dup_lines": np.array([_repeated_lines(raw[a:b].tobytes()) for a, b in zip(off, off[1:])], np.int64),
            "n_repeat_words": n_repeat, "classes": classes,
            "base_failed": (n_words < LEAST_WORDS) | (n_repeat > REPEATED * n_words)}


def _repeated_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip()] if b"\n" in text else ()
    return len(lines) - len(set(lines))


def _words(raw: np.ndarray) -> list[bytes]:
    """Words of a text, A-Z lower-cased; bytes are split at exactly the six spaces of the contract."""
    return raw.tobytes().translate(_LOWER).split()


@dataclass
class References:
    languages: list[str]
    classes: np.ndarray          # languages x classes
    words: list[list[bytes]]     # a language's common words
    counts: list[np.ndarray]     # and their counts, all other words last


def reference_counts(docs: DataFrame) -> DataFrame:
    """lang, word (null for a class), class, n over all documents that pass the plain rules and name a language."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter[bytes]] = defaultdict(Counter)
        classes: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(len(CLASSES), np.int64))

        def rows() -> pa.RecordBatch:
            out = [(lang, w, None, n) for lang, c in words.items() for w, n in c.items()]
            out += [(lang, None, k, int(n)) for lang, c in classes.items() for k, n in enumerate(c)]
            types = (pa.string(), pa.string(), pa.int32(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)] if out
                                              else [pa.array([], t) for t in types], names=["lang", "word", "class", "n"])

        for batch in batches:
            langs = batch.column(0).to_pylist()
            for i, j, raw, off in utf8_slices(batch.column(1)):
                m = measures(raw, off)
                for k in np.flatnonzero(~m["base_failed"]):
                    lang = langs[i + k]
                    if lang is not None:
                        words[lang].update(_words(raw[off[k]:off[k + 1]]))
                        classes[lang] += m["classes"][k]
            if sum(map(len, words.values())) > COUNTED:
                yield rows()
                words.clear()
                classes.clear()
        yield rows()

    counted = map_arrow(docs.select(F.col("lang").cast("string"), whole_text().alias("t")), run,
                        "lang string, word string, class int, n long")
    return counted.groupBy("lang", "word", "class").agg(F.sum("n").alias("n"))


def references(docs: DataFrame) -> References:
    counts = stored(reference_counts(docs), "reference-counts")
    totals = counts.filter("word IS NOT NULL").groupBy("lang").agg(F.sum("n").alias("total"))
    every = totals.agg(F.sum("total")).first()[0] or 0
    large = totals.filter(F.col("total") >= F.lit(every * LEAST_SHARE))
    total = {r.lang: r.total for r in large.collect()}
    classes = {lang: np.zeros(len(CLASSES), np.int64) for lang in total}
    for r in counts.filter("word IS NULL").join(F.broadcast(large), "lang").collect():
        classes[r.lang][r["class"]] = r.n
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    common = (counts.filter("word IS NOT NULL").join(F.broadcast(large), "lang")
              .filter(F.col("n") >= F.col("total") * WORD_SHARE).withColumn("rank", rank).filter(F.col("rank") <= COMMON))
    words: dict[str, list[tuple[bytes, int]]] = {lang: [] for lang in total}
    for r in common.orderBy("lang", "rank").collect():
        words[r.lang].append((r.word.encode(), r.n))
    langs = sorted(total)
    return References(langs, np.array([classes[x] for x in langs], np.int64).reshape(len(langs), len(CLASSES)),
                      [[w for w, _ in words[x]] for x in langs],
                      [np.array([n for _, n in words[x]] + [total[x] - sum(n for _, n in words[x])], np.int64) for x in langs])


def jensen_shannon(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Distance of each row of counts ``p`` (with a positive sum) from the counts ``q``."""
    p, q = p / p.sum(axis=1, keepdims=True), q / q.sum()
    m = (p + q) / 2

    def part(x):
        return np.where(x > 0, x * np.log2(np.where(x > 0, x, 1) / np.where(m > 0, m, 1)), 0).sum(axis=1)

    return np.sqrt(np.maximum(part(p) + part(np.broadcast_to(q, p.shape)), 0) / 2)


def quality_measures(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, the plain counts, base_failed, char_distance, word_distance (null where not
    judged) and kept."""
    refs = docs.sparkSession.sparkContext.broadcast(references(docs))
    longs = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches) -> Iterator[pa.RecordBatch]:
        r = refs.value
        place = {w: i for i, w in enumerate(sorted({w for ws in r.words for w in ws}))}
        columns = [np.array([place[w] for w in ws], np.int64) for ws in r.words]
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for i, j, raw, off in utf8_slices(batch.column(2)):
                m = measures(raw, off)
                judged = np.array([(lang is None or lang in r.languages) and bool(r.languages) for lang in langs[i:j]], bool)
                judged &= ~m["base_failed"]
                near = np.full((2, j - i), np.nan)
                which = np.flatnonzero(judged)
                if len(which):
                    seen = np.zeros((len(which), len(place) + 1), np.int64)
                    for row, k in enumerate(which):
                        ids = list(filter(None.__ne__, map(place.get, _words(raw[off[k]:off[k + 1]]))))
                        seen[row, :-1] = np.bincount(ids, minlength=len(place)) if ids else 0
                    total = m["n_words"][which]
                    chars, words = [], []
                    for own, c, at in zip(r.classes, r.counts, columns):
                        hist = np.hstack([seen[:, at], (total - seen[:, at].sum(axis=1))[:, None]])
                        chars.append(jensen_shannon(m["classes"][which], own))
                        words.append(jensen_shannon(hist, c))
                    near[:, which] = np.min(chars, axis=0), np.min(words, axis=0)
                bound = (CHAR_BOUND + CHAR_SLACK / np.sqrt(np.maximum(m["classes"].sum(axis=1), 1)),
                         WORD_BOUND + WORD_SLACK / np.sqrt(np.maximum(m["n_words"], 1)))
                kept = ~m["base_failed"] & (~judged | (near[0] <= bound[0]) & (near[1] <= bound[1]))
                distances = [pa.array(x, pa.float64(), mask=~judged) for x in near]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[i:j], *(pa.array(m[c].astype(np.int64)) for c in longs), pa.array(m["base_failed"]),
                     *distances, pa.array(kept)],
                    names=["doc_id", *longs, "base_failed", "char_distance", "word_distance", "kept"])

    schema = (f"doc_id long, {', '.join(f'{c} long' for c in longs)}, base_failed boolean, "
              "char_distance double, word_distance double, kept boolean")
    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), whole_text().alias("t")), run, schema)


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_measures(table(spark, sf_dir, "documents")).drop("char_distance", "word_distance")


def _kind_sql(n: str) -> str:
    """Share of one side's count against the middle, as the term of its divergence in bits."""
    return f"CASE WHEN {n} > 0 THEN {n} * log2({n} / ((p + q) / 2)) ELSE 0 END"


OP12_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, ws[i] AS word, i FROM (
    SELECT r, ws, unnest(generate_series(1, len(ws))) AS i
    FROM (SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d) WHERE len(ws) > 0)),
win AS (SELECT r, i, a, b, c, count(*) OVER (PARTITION BY r, a, b, c) AS times FROM (
    SELECT r, i, word AS a, lead(word) OVER o AS b, lead(word, 2) OVER o AS c FROM w WINDOW o AS (PARTITION BY r ORDER BY i))
    WHERE c IS NOT NULL),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM win WHERE times > 1) GROUP BY r),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
size AS (SELECT r, count(*) AS n, sum(length(word)) AS chars FROM w GROUP BY r),
base AS (SELECT d.r, d.doc_id, d.lang, length(t) AS all_chars, coalesce(size.n, 0) AS n_words, coalesce(size.chars, 0) AS word_chars,
        length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines,
        coalesce(rep.n, 0) AS n_repeat_words,
        coalesce(size.n, 0) < {LEAST_WORDS} OR 100 * coalesce(rep.n, 0) > 50 * coalesce(size.n, 0) AS base_failed
    FROM d LEFT JOIN size ON size.r = d.r LEFT JOIN dup ON dup.r = d.r LEFT JOIN rep ON rep.r = d.r),
cls AS (SELECT r, c.kind, c.n FROM (SELECT r, unnest([
        {{'kind': 'space', 'n': length(t) - length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))}},
        {{'kind': 'lower', 'n': length(t) - length(regexp_replace(t, '[a-z]', '', 'g'))}},
        {{'kind': 'upper', 'n': length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))}},
        {{'kind': 'digit', 'n': length(t) - length(regexp_replace(t, '[0-9]', '', 'g'))}},
        {{'kind': 'mark', 'n': length(t) - length(regexp_replace(t, '[.,;:!?''"()\-]', '', 'g'))}},
        {{'kind': 'beyond', 'n': length(regexp_replace(t, '[\x00-\x7F]', '', 'g'))}},
        {{'kind': 'other', 'n': length(regexp_replace(regexp_replace(t, '[\x20\x09-\x0Da-zA-Z0-9.,;:!?''"()\-]', '', 'g'),
                                              '[^\x00-\x7F]', '', 'g'))}}]) AS c FROM d)),
low AS (SELECT r, translate(word, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS word, count(*) AS n FROM w GROUP BY ALL),
good AS (SELECT r, lang, n_words, all_chars FROM base WHERE NOT base_failed),
total AS (SELECT lang, sum(n_words) AS total FROM good WHERE lang IS NOT NULL GROUP BY lang),
langs AS (SELECT lang, total FROM total WHERE total >= (SELECT sum(total) FROM total) * {LEAST_SHARE}),
common AS (SELECT lang, word, n, total FROM (
    SELECT lang, word, n, total, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS k FROM (
        SELECT g.lang, low.word, sum(low.n) AS n, any_value(l.total) AS total FROM low JOIN good g ON g.r = low.r
        JOIN langs l ON l.lang = g.lang GROUP BY g.lang, low.word) WHERE n >= total * {WORD_SHARE}) WHERE k <= {COMMON}),
refs AS (SELECT lang, 'w' AS h, word AS k, n / total AS q FROM common
    UNION ALL SELECT l.lang, 'w', '', (l.total - coalesce(c.n, 0)) / l.total
        FROM langs l LEFT JOIN (SELECT lang, sum(n) AS n FROM common GROUP BY lang) c ON c.lang = l.lang
    UNION ALL SELECT lang, 'c', kind, n / sum(n) OVER (PARTITION BY lang) FROM (
        SELECT g.lang, cls.kind, sum(cls.n) AS n FROM cls JOIN good g ON g.r = cls.r JOIN langs l ON l.lang = g.lang
        GROUP BY g.lang, cls.kind)),
seen AS (SELECT g.r, c.lang, c.word AS k, low.n / g.n_words AS p FROM good g JOIN low ON low.r = g.r JOIN common c ON c.word = low.word),
doc AS (SELECT r, lang, 'w' AS h, k, p FROM seen
    UNION ALL SELECT g.r, l.lang, 'w', '', 1 - coalesce(s.p, 0) FROM good g CROSS JOIN langs l
        LEFT JOIN (SELECT r, lang, sum(p) AS p FROM seen GROUP BY r, lang) s ON s.r = g.r AND s.lang = l.lang
    UNION ALL SELECT g.r, l.lang, 'c', cls.kind, cls.n / g.all_chars FROM good g JOIN cls ON cls.r = g.r CROSS JOIN langs l),
pair AS (SELECT g.r, refs.lang, refs.h, coalesce(doc.p, 0) AS p, refs.q FROM good g CROSS JOIN refs
    LEFT JOIN doc ON doc.r = g.r AND doc.lang = refs.lang AND doc.h = refs.h AND doc.k = refs.k),
far AS (SELECT r, h, min(x) AS x FROM (SELECT r, lang, h, sqrt(greatest(sum({_kind_sql("p")}) + sum({_kind_sql("q")}), 0) / 2) AS x
    FROM pair GROUP BY r, lang, h) GROUP BY r, h),
out AS (SELECT g.r FROM good g JOIN far c ON c.r = g.r AND c.h = 'c' JOIN far f ON f.r = g.r AND f.h = 'w'
    WHERE (g.lang IS NULL OR g.lang IN (SELECT lang FROM langs))
      AND (c.x > {CHAR_BOUND} + {CHAR_SLACK} / sqrt(greatest(g.all_chars, 1)) OR f.x > {WORD_BOUND} + {WORD_SLACK} / sqrt(g.n_words)))
SELECT doc_id, n_words, CAST(word_chars AS BIGINT) AS word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND r NOT IN (SELECT r FROM out) AS kept
FROM base
"""
