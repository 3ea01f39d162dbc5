"""Operator 5 - language identification by interpolated Kneser-Ney character models.

Text is lower-cased; runs of non-letters become one space. Four-character windows of all learning
documents are counted per language inside the scan tasks and summed by Spark. The language
models (interpolated Kneser-Ney, lower orders from continuation counts) are Spark aggregates over all
these windows: continuation counts, context totals, discounts and probabilities of every order are
tables that grow with the corpus, and no window or language is left out. Log probabilities are whole
numbers of 1/``UNIT`` nat (an array by language), so sums do not depend on any order of work.

Scoring: windows that make up at least one in ``entries`` of a language (``ENTRIES`` per language,
``TOTAL_ENTRIES`` over all: a bound on their number) are broadcast with their final log probabilities and summed
up in the scan tasks. All other windows of a document, counted, are joined to the tables; those that
no language has are backed off there. The broadcast only saves work: results are the same without it.
A document gets the language with the lowest cross-entropy per character.

Rejection is calibrated on the same counts: the mean cross-entropy of language b's windows
under model a is known for all a, b, and a prediction a counts as rejected (column
``rejected``, ``und`` from ``identify(..., reject=True)``) if its cross-entropy lies above the middle
between a's own mean and the nearest other language's under a. With one language the
bound is its own mean plus one nat.

Edge cases: null texts and texts without a letter are ``und`` with score 0; null languages are not
learned from; a null doc_id counts as held out; without any learning row all are ``und``; repeated
rows are predicted alike; extra columns are ignored; very long texts are read in slices.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import held_out, map_arrow, stored, table, whole_text

ORDER = 4
ENTRIES = 1 << 17         # broadcast windows of a language; the others are joined
TOTAL_ENTRIES = 1 << 20   # and of all languages
UNIT = 1 << 20            # log probabilities are whole numbers of 1/UNIT nat
SLICE_CHARS = 1 << 20
FLUSH_WINDOWS = 1 << 22   # distinct windows that a task holds before it hands them on
SHARPNESS = 8.0           # the score is a softmax of -SHARPNESS * cross-entropy per character

_SPACE = 32
_BEYOND = np.uint32(0xD800), np.uint32(0xF900 - 0xD800)  # first of those places, and their number
_MIX = np.uint64(0x9E3779B97F4A7C15)


@cache
def _letters() -> np.ndarray:
    """Is this code point a letter? One flag per code point."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def windows(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(four-character windows as 4 x 16 bits, document offsets into them).

    Each document is read as three spaces, its letters with single spaces for other runs, and a
    final space; a window ends at each character behind the padding. Letters beyond 16 bits share
    the places of 16 bits that no letter has (surrogates and private use): never another letter's or the space's.
    """
    joined = "\0".join([t.replace("\0", " ") if "\0" in t else t for t in texts]).lower() + "\0"
    code = np.frombuffer(joined.encode("utf-32-le", "replace"), "<u4")
    letter = _letters()[code]
    stop = code == 0
    # A run of non-letters between letters is one space: its first character stands for it.
    gap = ~letter & ~stop
    gap[1:] &= letter[:-1]
    gap[0] = False
    # No text may start with a space of its own, nor end with two.
    reps = np.zeros(len(code), np.int64)
    reps[letter | gap] = 1
    reps[stop] = ORDER
    chars = np.where(letter, np.where(code > 0xFFFF, _BEYOND[0] + code % _BEYOND[1], code), _SPACE).astype(np.uint64)
    chars = np.r_[np.full(ORDER - 1, _SPACE, np.uint64), np.repeat(chars, reps)]
    packed = chars[:-3] << np.uint64(48) | chars[1:-2] << np.uint64(32) | chars[2:-1] << np.uint64(16) | chars[3:]
    # Windows that end in the padding behind a document: all of its ORDER spaces but the first.
    ends = np.cumsum(reps)[stop]
    real = np.ones(len(packed), bool)
    for k in range(1, ORDER):
        real[ends - k] = False
    # Nothing but a space: a document without letters has none, and double spaces say nothing.
    real &= packed & np.uint64(0xFFFFFFFF) != np.uint64(_SPACE << 16 | _SPACE)
    at = np.r_[0, np.cumsum(real)][np.r_[0, ends]]
    return packed[real], at


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    i = size = 0
    for j, t in enumerate(texts):
        if size and size + len(t) > SLICE_CHARS:
            yield i, j
            i, size = j, 0
        size += len(t) + 1
    if i < len(texts):
        yield i, len(texts)


def count_windows(docs: DataFrame) -> DataFrame:
    """(lang, window, n) over all learning rows: text and non-null lang, not held out."""
    rows = (docs.filter(~held_out() & F.col("lang").isNotNull())
            .select(F.col("lang").cast("string").alias("lang"), whole_text().alias("t")))

    def count(batches) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        size = 0

        def merged(lang: str) -> tuple[np.ndarray, np.ndarray]:
            keys = np.concatenate([k for k, _ in held[lang]])
            n = np.concatenate([c for _, c in held[lang]])
            order = np.argsort(keys, kind="stable")
            keys, n = keys[order], n[order]
            first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, int)
            return keys[first], np.add.reduceat(n, first) if len(first) else n

        def out() -> Iterator[pa.RecordBatch]:
            for lang in held:
                keys, n = merged(lang)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()),
                                                  pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))],
                                                 names=["lang", "window", "n"])

        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            texts = batch.column(1).to_pylist()
            for lang in dict.fromkeys(langs.tolist()):
                own = [texts[i] for i in np.flatnonzero(langs == lang)]
                for i, j in _slices(own):
                    seen = np.sort(windows(own[i:j])[0])
                    first = np.flatnonzero(np.r_[True, seen[1:] != seen[:-1]]) if len(seen) else np.zeros(0, int)
                    parts = held.setdefault(lang, [])
                    parts.append((seen[first], np.diff(np.r_[first, len(seen)])))
                    if len(parts) >= 16:
                        held[lang] = [merged(lang)]
            size = sum(len(k) for parts in held.values() for k, _ in parts)
            if size > FLUSH_WINDOWS:
                yield from out()
                held, size = {}, 0
        yield from out()

    return (map_arrow(rows, count, "lang string, window long, n long")
            .groupBy("lang", "window").agg(F.sum("n").alias("n")))


# ---- model in memory --------------------------------------------------------------------

def _hash(keys: np.ndarray) -> np.ndarray:
    """One-to-one, so sorted hashes stand for the windows themselves."""
    k = keys * _MIX
    return (k ^ k >> np.uint64(32)) * _MIX


class _Sums:
    """Sorted keys with values; missing keys are 0."""

    def __init__(self, keys: np.ndarray, values: np.ndarray | None = None):
        self.keys, inverse = np.unique(keys, return_inverse=True)
        self.values = np.bincount(inverse, values, minlength=len(self.keys)).astype(np.float64)

    def __getitem__(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys))
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.values[at], 0.0)


def _suffix(keys: np.ndarray, order: int) -> np.ndarray:
    return keys & np.uint64((1 << 16 * order) - 1)


class _KneserNey:
    """Interpolated Kneser-Ney probabilities of one language, by order."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, alphabet: int):
        self.alphabet = alphabet
        self.tables = {}
        for order in range(ORDER, 0, -1):
            table_ = _Sums(grams, counts)
            grams, counts = table_.keys, table_.values
            context = grams >> np.uint64(16)
            ones, twos = float((counts == 1).sum()), float((counts == 2).sum())
            discount = ones / (ones + 2 * twos) if ones and ones + 2 * twos else 0.5
            discount = min(max(discount, 0.05), 0.95)
            self.tables[order] = (table_, _Sums(context, counts), _Sums(context), discount)
            if order > 1:  # the next order counts in how many contexts its windows continue
                grams, counts = _suffix(grams, order - 1), np.ones(len(grams))

    def back_off(self, context: np.ndarray, order: int) -> np.ndarray:
        """Weight of the next lower order after ``context``."""
        _, total, kinds, discount = self.tables[order]
        n = total[context]
        return np.where(n > 0, discount * kinds[context] / np.maximum(n, 1), 1.0)

    def probability(self, grams: np.ndarray, order: int) -> np.ndarray:
        if order == 0:
            return np.full(len(grams), 1 / self.alphabet)
        table_, total, _, discount = self.tables[order]
        context = grams >> np.uint64(16)
        n = total[context]
        own = np.where(n > 0, np.maximum(table_[grams] - discount, 0) / np.maximum(n, 1), 0.0)
        return own + self.back_off(context, order) * self.probability(_suffix(grams, order - 1), order - 1)


@dataclass
class Model:
    langs: list[str]
    hashes: list[np.ndarray]       # by order, 1 first: sorted hashes of all languages' windows
    logs: list[np.ndarray]         # float32 [entries, languages]
    context_hashes: list[np.ndarray]
    back_offs: list[np.ndarray]    # log weights, float32 [contexts, languages]
    unknown: float
    reject_above: np.ndarray       # by language

    @staticmethod
    def _find(keys: np.ndarray, sorted_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(sorted_):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        h = _hash(keys)
        at = np.searchsorted(sorted_, h)
        at[at == len(sorted_)] = 0
        return at, sorted_[at] == h

    def log_probability(self, grams: np.ndarray, order: int = ORDER) -> np.ndarray:
        """[windows, languages]; windows no language has are backed off."""
        if order == 0:
            return np.full((len(grams), len(self.langs)), self.unknown, np.float32)
        at, hit = self._find(grams, self.hashes[order - 1])
        out = self.logs[order - 1][at] if len(self.hashes[order - 1]) else np.zeros((len(grams), len(self.langs)), np.float32)
        miss = np.flatnonzero(~hit)
        if len(miss):
            lower = self.log_probability(_suffix(grams[miss], order - 1), order - 1)
            at, hit = self._find(grams[miss] >> np.uint64(16), self.context_hashes[order - 1])
            if len(self.context_hashes[order - 1]):
                lower = lower + np.where(hit[:, None], self.back_offs[order - 1][at], np.float32(0))
            out[miss] = lower
        return out

    def cross_entropy(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """([documents, languages] nats per character, characters scored)."""
        sums, size = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts), np.int64)
        for i, j in _slices(texts):
            grams, at = windows(texts[i:j])
            size[i:j] = np.diff(at)
            full = np.flatnonzero(size[i:j])
            if len(full):
                sums[i + full] = np.add.reduceat(self.log_probability(grams), at[:-1][full], axis=0, dtype=np.float64)
        return -sums / np.maximum(size, 1)[:, None], size


def build(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """Model of all languages from their windows and counts, in memory: what the tables of ``fit`` are checked against."""
    langs = sorted(counts)
    alphabet = len(np.unique(np.concatenate([_suffix(counts[x][0], 1) for x in langs]))) + 1 if langs else 1
    parts = [_KneserNey(*counts[x], alphabet) for x in langs]
    hashes, logs, context_hashes, back_offs = [], [], [], []
    for order in range(1, ORDER + 1):
        keys = np.unique(np.concatenate([p.tables[order][0].keys for p in parts])) if parts else np.zeros(0, np.uint64)
        by = np.argsort(_hash(keys))
        hashes.append(_hash(keys)[by])
        logs.append(np.stack([np.log(p.probability(keys, order))[by] for p in parts], 1).astype(np.float32) if parts else np.zeros((0, 0), np.float32))
        contexts = np.unique(keys >> np.uint64(16))
        by = np.argsort(_hash(contexts))
        context_hashes.append(_hash(contexts)[by])
        back_offs.append(np.stack([np.log(p.back_off(contexts, order))[by] for p in parts], 1).astype(np.float32) if parts else np.zeros((0, 0), np.float32))
    model = Model(langs, hashes, logs, context_hashes, back_offs, float(-np.log(alphabet)), np.zeros(len(langs)))
    mean = np.array([[-np.average(model.log_probability(counts[b][0])[:, a], weights=counts[b][1]) for b in langs]
                     for a in range(len(langs))])
    for a in range(len(langs)):
        other = np.delete(mean[a], a)
        model.reject_above[a] = (mean[a, a] + other.min()) / 2 if len(other) else mean[a, a] + 1
    return model


# ---- model in tables --------------------------------------------------------------------

@dataclass
class Tables:
    langs: list[str]
    grams: dict[int, DataFrame]      # by order: gram, log (array by language)
    contexts: dict[int, DataFrame]   # by order: context, log of the weight of the next lower order
    unknown: int
    head: tuple[np.ndarray, np.ndarray]   # sorted windows, logs [windows, languages]
    reject_above: list[float]


def _tail(gram: Column, order: int) -> Column:
    return gram.bitwiseAND(F.lit((1 << 16 * order) - 1))


def _context(gram: Column) -> Column:
    return F.shiftrightunsigned(gram, 16)


def _by_language(entries: Column, size: int, value) -> Column:
    """Array over all languages from a list of structs with the language's number ``l``; absent ones are null in ``value``."""
    known = F.map_from_entries(F.transform(entries, lambda e: F.struct(e["l"], e)))
    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: value(F.try_element_at(known, i), i))


def _fixed(p: Column) -> Column:
    return F.transform(p, lambda x: F.round(F.log(x) * UNIT).cast("int"))


def _discount(ones: int, twos: int) -> float:
    return min(max(ones / (ones + 2 * twos) if ones else 0.5, 0.05), 0.95)


def fit(docs: DataFrame) -> Tables:
    """Tables of all orders over all learning documents; at most TOTAL_ENTRIES windows reach the driver."""
    spark = docs.sparkSession
    windows_ = stored(count_windows(docs), "windows")
    totals = {r["lang"]: r["n"] for r in windows_.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(totals)
    if not langs:
        return Tables([], {}, {}, 0, (np.zeros(0, np.uint64), np.zeros((0, 0), np.int64)), [])
    size = len(langs)
    numbers = F.broadcast(spark.createDataFrame([(x, k) for k, x in enumerate(langs)], "lang string, l int"))
    counts = {ORDER: windows_.join(numbers, "lang").select("l", F.col("window").alias("gram"), F.col("n").alias("c"))}
    for order in range(ORDER - 1, 0, -1):  # in how many contexts a gram continues
        counts[order] = stored(counts[order + 1].groupBy("l", _tail(F.col("gram"), order).alias("gram"))
                               .agg(F.count(F.lit(1)).alias("c")), f"continuations-{order}")
    discounts = {}
    for order in counts:
        seen = {r["l"]: r for r in counts[order].groupBy("l").agg(
            F.count_if(F.col("c") == 1).alias("ones"), F.count_if(F.col("c") == 2).alias("twos")).collect()}
        discounts[order] = [_discount(seen[k]["ones"], seen[k]["twos"]) for k in range(size)]
    alphabet = counts[1].select("gram").distinct().count() + 1

    grams, contexts, lower = {}, {}, None
    for order in range(1, ORDER + 1):
        discount = F.array(*map(F.lit, discounts[order]))
        context = stored(
            counts[order].groupBy("l", _context(F.col("gram")).alias("context"))
            .agg(F.sum("c").alias("total"), F.count(F.lit(1)).alias("kinds"))
            .groupBy("context").agg(F.collect_list(F.struct("l", "total", "kinds")).alias("e"))
            .select("context", _by_language(F.col("e"), size, lambda e, i: F.coalesce(e["total"], F.lit(0))).alias("total"),
                    _by_language(F.col("e"), size, lambda e, i: F.coalesce(
                        F.get(discount, i) * e["kinds"] / e["total"], F.lit(1.0))).alias("weight")), f"contexts-{order}")
        contexts[order] = context.select("context", _fixed(F.col("weight")).alias("log"))
        rows = (counts[order].groupBy("gram").agg(F.collect_list(F.struct("l", "c")).alias("e"))
                .withColumn("context", _context(F.col("gram"))).join(context, "context"))
        if order > 1:
            rows = rows.withColumn("tail", _tail(F.col("gram"), order - 1)).join(
                lower.select(F.col("gram").alias("tail"), F.col("p").alias("q")), "tail")
        else:
            rows = rows.withColumn("q", F.array_repeat(F.lit(1 / alphabet), size))
        p = _by_language(F.col("e"), size, lambda e, i: F.coalesce(
            F.try_divide(F.greatest(e["c"] - F.get(discount, i), F.lit(0.0)), F.get("total", i)), F.lit(0.0))
            + F.get("weight", i) * F.get("q", i))
        lower = stored(rows.select("gram", "e", p.alias("p")), f"grams-{order}")
        grams[order] = lower.select("gram", _fixed(F.col("p")).alias("log"))

    rows = lower.select("gram", "e", _fixed(F.col("p")).alias("log"))
    total = F.array(*[F.lit(totals[x]) for x in langs])
    entries = max(1, min(ENTRIES, TOTAL_ENTRIES // size))
    # A window of the head makes up 1/entries of a language at least, so there are at most `entries` a language.
    head = (rows.filter(F.exists("e", lambda e: e["c"] * entries >= F.get(total, e["l"])))
            .select("gram", "log").toPandas().sort_values("gram", key=lambda g: g.to_numpy().view(np.uint64)))
    logs = np.stack(head["log"].to_list()).astype(np.int32) if len(head) else np.zeros((0, size), np.int32)
    sums = {r["l"]: r for r in rows.select("log", F.explode("e").alias("e")).groupBy("e.l").agg(*[
        F.sum((F.col("e.c") * F.get("log", F.lit(k))).cast("decimal(38,0)")).alias(f"s{k}") for k in range(size)]).collect()}
    reject_above = []
    for a in range(size):
        mean = [-float(sums[b][f"s{a}"]) / UNIT / totals[langs[b]] for b in range(size)]
        other = mean[:a] + mean[a + 1:]
        reject_above.append((mean[a] + min(other)) / 2 if other else mean[a] + 1)
    return Tables(langs, grams, contexts, round(-np.log(alphabet) * UNIT), (head["gram"].to_numpy().view(np.uint64), logs), reject_above)


def _add(x: Column, y: Column) -> Column:
    return F.zip_with(x, y, lambda a, b: a + b)


def _log_probabilities(grams: DataFrame, model: Tables) -> DataFrame:
    """(window, log) of distinct windows; those that no language has are backed off."""
    none = F.array_repeat(F.lit(0), len(model.langs))
    found = stored(grams.join(model.grams[ORDER].withColumnRenamed("gram", "window"), "window", "left"), "found")
    rest, weights, logs = found.filter("log IS NULL").select("window"), {}, {}
    for order in range(ORDER, 0, -1):
        own = _tail(F.col("window"), order) if order < ORDER else F.col("window")
        rest = (rest.withColumn("context", _context(own))
                .join(model.contexts[order].withColumnRenamed("log", f"w{order}"), "context", "left").drop("context"))
        if order < ORDER:
            rest = (rest.withColumn("gram", own)
                    .join(model.grams[order].withColumnRenamed("log", f"p{order}"), "gram", "left").drop("gram"))
    log = F.array_repeat(F.lit(model.unknown), len(model.langs))
    for order in range(1, ORDER + 1):
        log = _add(F.coalesce(f"w{order}", none), log)
        if order < ORDER:
            log = F.coalesce(F.col(f"p{order}"), log)
    return found.filter("log IS NOT NULL").union(rest.select("window", log.alias("log")))


def identify(docs: DataFrame, model: Tables, keep: list[str], reject: bool = False) -> DataFrame:
    """Columns ``keep`` plus lang_pred, score, cross_entropy, rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(model.head)  # at most TOTAL_ENTRIES rows
    source = docs.select(*keep, whole_text().alias("_l_text"))
    size = len(model.langs)
    schema = (source.drop("_l_text").schema.add("_l_sums", T.ArrayType(T.LongType())).add("_l_size", "long")
              .add("_l_rest", T.ArrayType(T.LongType())).add("_l_times", T.ArrayType(T.IntegerType())))

    def run(batches) -> Iterator[pa.RecordBatch]:
        known, logs = shared.value
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            sums, chars = np.zeros((len(texts), size), np.int64), np.zeros(len(texts), np.int64)
            rest, times, ends = [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)], np.zeros(len(texts) + 1, np.int32)
            for i, j in _slices(texts):
                grams, at = windows(texts[i:j])
                chars[i:j] = np.diff(at)
                doc = np.repeat(np.arange(i, j), chars[i:j])
                place = np.searchsorted(known, grams)
                place[place == len(known)] = 0
                hit = known[place] == grams if len(known) else np.zeros(len(grams), bool)
                full = np.flatnonzero(chars[i:j])
                if len(full) and len(known):
                    sums[i + full] = np.add.reduceat(np.where(hit[:, None], logs[place], 0), at[:-1][full], axis=0, dtype=np.int64)
                other, owner = grams[~hit], doc[~hit]
                order = np.lexsort((other, owner))
                other, owner = other[order], owner[order]
                first = np.flatnonzero(np.r_[True, (other[1:] != other[:-1]) | (owner[1:] != owner[:-1])]) if len(other) else np.zeros(0, int)
                rest.append(other[first])
                times.append(np.diff(np.r_[first, len(other)]).astype(np.int32))
                ends[i + 1:j + 1] = ends[i] + np.searchsorted(owner[first], np.arange(i, j), side="right")
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in range(batch.num_columns - 1)],
                 pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * size), pa.array(sums.reshape(-1))),
                 pa.array(chars), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rest).view(np.int64))),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(times)))], names=schema.names)

    names = [F.col(c) for c in source.drop("_l_text").columns]
    if not size:
        return source.select(*names, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"),
                             F.lit(0.0).alias("cross_entropy"), F.lit(True).alias("rejected"))
    # Rows get a number, fixed by storing them without their texts.
    rows = stored(map_arrow(source, run, schema).withColumn("_l_row", F.monotonically_increasing_id()), "sums")
    rest = rows.select("_l_row", F.explode(F.arrays_zip("_l_rest", "_l_times")).alias("r")).select(
        "_l_row", F.col("r._l_rest").alias("window"), F.col("r._l_times").alias("n"))
    joined = (rest.join(_log_probabilities(rest.select("window").distinct(), model), "window").groupBy("_l_row")
              .agg(F.array(*[F.sum(F.col("n") * F.get("log", F.lit(k)).cast("long")) for k in range(size)]).alias("_l_more")))
    h = F.transform(F.coalesce(_add(F.col("_l_sums"), F.col("_l_more")), F.col("_l_sums")),
                    lambda x: -x / F.greatest(F.col("_l_size"), F.lit(1)) / UNIT)
    none = F.col("_l_size") == 0
    best = (F.array_position("_l_h", F.col("_l_low")) - 1).cast("int")
    bad = F.col("_l_low") > F.get(F.array(*map(F.lit, model.reject_above)), best)
    share = F.aggregate("_l_h", F.lit(0.0), lambda s, x: s + F.exp(-SHARPNESS * (x - F.col("_l_low"))))
    return (rows.drop("_l_rest", "_l_times").join(joined, "_l_row", "left").withColumn("_l_h", h)
            .withColumn("_l_low", F.array_min("_l_h"))
            .select(*names, F.when(none | (bad if reject else F.lit(False)), "und")
                    .otherwise(F.get(F.array(*map(F.lit, model.langs)), best)).alias("lang_pred"),
                    F.when(none, 0.0).otherwise(1 / share).alias("score"),
                    F.when(none, 0.0).otherwise(F.col("_l_low")).alias("cross_entropy"), (bad | none).alias("rejected")))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return (identify(docs, fit(docs), ["doc_id"])
            .select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected"))
