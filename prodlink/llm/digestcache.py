"""Operator 6 - token counts through a digest cache.

A stored table holds (content digest, tokenizer digest) -> counts. Documents are digested
(sha-256 of the text, null as empty; sha-256 of the tokenizer file), joined to the table, and only
distinct misses are encoded, by one chosen document per digest, and appended. The counts of
all documents are then read from the table.

The table is a Parquet folder that only grows; a failed job leaves nothing behind, and two
jobs that append the same digest do no harm, as reads take one row per digest. A miss is chosen
by (digest, doc_id), so a digest shared by a third of all rows sends one text, not a hot group.

Edge cases: null text counts as empty (0 bytes, 0 tokens); a null doc_id keeps its row; repeated
rows each get a row; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import long_id, map_arrow, plain_id, shared_path, stored, table, whole_text
from .tokenids import PIECE_BPE, piece_count, tokenizer_path

LIMIT = 4096
CACHE_SCHEMA = "content binary, tokenizer binary, n_bytes long, n_tokens long"


def tokenizer_digest(path: str) -> bytes:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).digest()


def content_digest(col: str = "text"):
    return F.unhex(F.sha2(whole_text(col).cast("binary"), 256))


def open_cache(spark: SparkSession, path: str) -> DataFrame:
    """The stored counts; creates an empty table at first use."""
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(path)
    return spark.read.schema(CACHE_SCHEMA).parquet(path)


def count_tokens(docs: DataFrame, cache_path: str, tokenizer: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens. ``tokenizer`` is a sentencepiece model file
    at the same place on every machine; by default the installed public one."""
    spark = docs.sparkSession
    version = tokenizer_digest(tokenizer or tokenizer_path(PIECE_BPE))
    ours = F.lit(version)
    known = open_cache(spark, cache_path).filter(F.col("tokenizer") == ours)
    keys = stored(docs.select(long_id().alias("id"), content_digest().alias("content")), "digests")
    missing = (keys.groupBy("content").agg(F.min("id").alias("id"))
               .join(known.select("content").distinct(), "content", "left_anti"))
    texts = (docs.select(long_id().alias("id"), whole_text().alias("t"), content_digest().alias("content"))
             .join(missing, ["id", "content"]).select("content", "t"))

    def encode(batches) -> Iterator[pa.RecordBatch]:
        count = piece_count(tokenizer)
        for batch in batches:
            texts_ = batch.column(1).to_pylist()
            n = len(texts_)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([version] * n, pa.binary()),
                 pa.array([len(t.encode()) for t in texts_], pa.int64()), pa.array(map(count, texts_), pa.int64())],
                names=["content", "tokenizer", "n_bytes", "n_tokens"])

    # Rows repeated whole were encoded each; the table takes a digest once.
    map_arrow(texts, encode, CACHE_SCHEMA).dropDuplicates(["content"]).write.mode("append").parquet(cache_path)
    counts = (spark.read.schema(CACHE_SCHEMA).parquet(cache_path).filter(F.col("tokenizer") == ours)
              .groupBy("content").agg(F.max("n_bytes").alias("n_bytes"), F.max("n_tokens").alias("n_tokens")))
    return keys.join(counts, "content").select(plain_id("id").alias("doc_id"), "n_bytes", "n_tokens")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts with an empty cache of its own, so that every distinct text of the table is encoded."""
    return (count_tokens(table(spark, sf_dir, "documents"), shared_path(spark, "token-cache"))
            .withColumn("over_limit", F.col("n_tokens") > LIMIT))
