"""Operator 2 - quality classifier: supervised subword embeddings.

Every word, every repeat of the last or last but one word, and every byte 3-, 4- and 5-gram of
a document is hashed into one table of learned vectors; the vectors are averaged over the whole document and a softmax layer gives
the class probabilities. Training is plain stochastic gradient descent in numpy over a
bounded sample of labelled documents (``SAMPLE_DOCS``, the rows with the smallest id hash,
so it is the same sample under any partitioning). Scoring reads every whole text once and
never shuffles it.

With two classes the average and the softmax layer commute: logit = mean of E[f] . (w1 - w0),
so a scoring task needs one float per bucket (1 MB) instead of the whole table.

Edge cases: null text counts as empty; a text without any feature (empty) gets the model's
bias; null labels are ignored; without usable labels the score is 0.5, with one class only
it is that class's smoothed share; repeated rows are scored alike; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, map_arrow, table, utf8_slices, whole_text

SAMPLE_DOCS = 4000        # bound of the training sample (documents)
SAMPLE_BYTES = 64 << 20   # and of its text; the sample stops before the document that would pass it
SCORE_SLICE = 1 << 18     # bytes of text scored at once: some twenty arrays of 8 bytes for each
BUCKETS_LOG2 = 18
DIM = 8
EPOCHS = 3
RATE = 0.4
SEED = 7
KEEP_AT = 0.3             # a document is predicted good at this score or more

_GRAMS = (3, 4, 5)
_LAGS = (1, 2)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)
_BASE_INV = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    p = np.full(n, base, dtype=np.uint64)
    if n:
        p[0] = 1
    return np.multiply.accumulate(p)


class Featurizer:
    """Bucket numbers of all words and byte n-grams of a run of documents."""

    def __init__(self, buckets_log2: int = BUCKETS_LOG2):
        self.shift = np.uint64(64 - buckets_log2)
        self._pow = self._inv = np.zeros(0, np.uint64)

    def _tables(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._pow) < n:
            self._pow, self._inv = _powers(_BASE, 2 * n), _powers(_BASE_INV, 2 * n)
        return self._pow, self._inv

    def __call__(self, raw: np.ndarray, off: np.ndarray):
        """Yields (bucket array, document offsets into it): once for words, once per n-gram size."""
        n = len(raw)
        b = raw.astype(np.uint64)
        power, inverse = self._tables(n + 1)
        # Words: runs of bytes above the space, never across documents.
        letter = raw > 32
        first = np.zeros(n, bool)
        first[off[:-1][off[:-1] < n]] = True
        begins = letter.copy()
        begins[1:] &= ~letter[:-1] | first[1:]
        starts = np.flatnonzero(begins)
        stop = np.flatnonzero(~letter | first)
        at = np.searchsorted(stop, starts, side="right")
        ends = np.append(stop, n)[at]
        with np.errstate(over="ignore"):
            prefix = np.zeros(n + 1, np.uint64)
            np.cumsum((b + np.uint64(1)) * power[:n], out=prefix[1:])
            words = (prefix[ends] - prefix[starts]) * inverse[starts] * _MIX
            words = (words ^ (words >> np.uint64(29))) * _MIX
            at_word = np.searchsorted(starts, off)
            yield words >> self.shift, at_word
            # Word n-grams of one kind only: "the word before / two before again", which
            # hashed words cannot show after averaging.
            for lag in _LAGS:
                again = np.zeros(len(words), bool)
                again[lag:] = words[lag:] == words[:-lag]
                for back in range(lag):
                    head = at_word[:-1] + back
                    again[head[head < len(words)]] = False
                hit = np.flatnonzero(again)
                yield np.full(len(hit), lag, np.uint64), np.searchsorted(hit, at_word)
            gram = b
            for k in range(1, max(_GRAMS)):
                gram = gram[:-1] | (b[k:] << np.uint64(8 * k))
                size = k + 1
                if size not in _GRAMS or not len(gram):
                    continue
                # A gram belongs to the document it starts in and must end there.
                inside = np.ones(len(gram), bool)
                for back in range(1, size):
                    cut = off[1:-1] - back
                    inside[cut[(cut >= 0) & (cut < len(gram))]] = False
                if len(off) > 2:
                    # Documents shorter than the gram: their starts are cut as well.
                    short = np.flatnonzero(np.diff(off) < size)
                    for d in short:
                        inside[off[d]:min(off[d + 1], len(gram))] = False
                h = (gram + np.uint64(size)) * _MIX
                h = (h ^ (h >> np.uint64(31))) * _MIX >> self.shift
                kept = np.flatnonzero(inside)
                yield h[kept], np.searchsorted(kept, off)


@dataclass
class Model:
    """Averaged-embedding model reduced to a scalar per bucket."""

    scalars: np.ndarray
    bias: float

    def score(self, texts) -> np.ndarray:
        """Probability of label 1 for an Arrow string array."""
        out = np.empty(len(texts), np.float64)
        make = Featurizer(int(np.log2(len(self.scalars))))
        for i, j, raw, off in utf8_slices(texts, SCORE_SLICE):
            total, count = np.zeros(j - i), np.zeros(j - i)
            for buckets, at in make(raw, off):
                run = np.zeros(len(buckets) + 1)
                np.cumsum(self.scalars[buckets], out=run[1:], dtype=np.float64)
                total += run[at[1:]] - run[at[:-1]]
                count += np.diff(at)
            logit = total / np.maximum(count, 1) + self.bias
            out[i:j] = 1 / (1 + np.exp(-np.clip(logit, -500, 500)))
        return out


def train(texts, labels: np.ndarray, epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED) -> Model:
    """Stochastic gradient descent, one document at a time, linearly falling rate."""
    buckets = 1 << BUCKETS_LOG2
    n, positive = len(labels), float(np.sum(labels))
    if n == 0 or positive in (0.0, float(n)):
        share = (positive + 1) / (n + 2)
        return Model(np.zeros(buckets, np.float32), float(np.log(share / (1 - share))))
    make = Featurizer()
    docs = [raw for _, _, raw, _ in utf8_slices(texts, 0)]  # views on the texts: features are made anew in each epoch

    def features(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ids, count = np.unique(np.concatenate([h for h, _ in make(raw, np.array([0, len(raw)]))]), return_counts=True)
        return ids.astype(np.int64), (count / max(1, count.sum())).astype(np.float32)[:, None]

    rng = np.random.default_rng(seed)
    table_ = rng.uniform(-1 / DIM, 1 / DIM, (buckets, DIM)).astype(np.float32)
    weights = rng.uniform(-1, 1, (2, DIM)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    step, steps = 0, epochs * n
    for _ in range(epochs):
        for d in rng.permutation(n):
            ids, share = features(docs[d])
            lr = np.float32(rate * (1 - step / steps))
            step += 1
            mean = (table_[ids] * share).sum(axis=0) if len(ids) else np.zeros(DIM, np.float32)
            z = weights @ mean + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[int(labels[d])] -= 1
            back = weights.T @ p
            weights -= lr * np.outer(p, mean)
            bias -= lr * p
            # As is usual for averaged embeddings, the gradient is not divided by the number
            # of features (each would move by next to nothing in a long text): scaled by its square root.
            if len(ids):
                table_[ids] -= lr * np.float32(np.sqrt(len(ids))) * share * back
    return Model(table_ @ (weights[1] - weights[0]), float(bias[1] - bias[0]))


def training_sample(docs: DataFrame, labels: DataFrame, target: str, max_docs: int = SAMPLE_DOCS,
                    max_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """At most ``max_docs`` labelled, not held-out documents (smallest id hashes): text, label. Texts over a sixteenth of
    ``max_bytes`` (4 MB by default) are not learned from, so that no single one fills the sample; all are scored."""
    keys = (labels.filter(F.col(target).isin(0, 1) & ~held_out())
            .groupBy("doc_id").agg(F.max(target).cast("int").alias("label"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs))
    size = F.octet_length("text")
    # The join's small side has at most max_docs rows by construction.
    chosen = (docs.select("doc_id", whole_text().alias("text"))
              .join(F.broadcast(keys), "doc_id")
              .orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(max_docs))
    return chosen.filter(size <= max_bytes // 16)


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality") -> Model:
    """Fit on the bounded sample. At most SAMPLE_BYTES of text reach the driver."""
    rows = training_sample(docs, labels, target).toArrow()
    size = np.cumsum([len(t.as_py().encode()) for t in rows["text"]]) if rows.num_rows else np.zeros(0)
    rows = rows.slice(0, int(np.searchsorted(size, SAMPLE_BYTES, side="right")))
    texts = rows["text"].combine_chunks()
    texts = pa.concat_arrays(texts.chunks) if isinstance(texts, pa.ChunkedArray) else texts
    return train(texts, rows["label"].to_numpy().astype(np.int64))


def score(docs: DataFrame, model: Model, keep: list[str], out: str = "score") -> DataFrame:
    """Columns ``keep`` of every document plus its score; one narrow pass over the whole texts."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # 1 MB: one float per bucket
    source = docs.select(*keep, whole_text().alias("_q_text"))
    schema = source.drop("_q_text").schema.add(out, "double")

    def run(batches):
        m = shared.value
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            cols = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(m.score(texts))],
                                             names=[*batch.schema.names[:-1], out])

    return map_arrow(source, run, schema)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return (score(docs, model, ["doc_id"])
            .select("doc_id", held_out().alias("held_out"), "score",
                    (F.col("score") >= KEEP_AT).cast("int").alias("predicted")))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents scored under KEEP_AT go; the model is fitted on the stage's own input."""
    model = fit(docs, table(spark, sf_dir, "labels"))
    cols = ["doc_id", "text", "lang", "source", "n_chars"]
    return score(docs, model, cols, "_q_score").filter(F.col("_q_score") >= KEEP_AT).select(*cols)
