"""Operator 1 - exact dedup by deterministic block naming (built-in functions only).

The normalised text is cut into blocks of ``BLOCK_BYTES``. Equal blocks get equal integer
names by sorting: blocks are dealt into buckets of about ``BUCKET_ROWS`` by hash, sorted inside
the bucket, and named (bucket, dense rank) - the comparison is of the bytes, so names never
collide. Then names of adjacent blocks are paired, distinct pairs are sorted into new
names, and so on until a document has one name. (level, name) is its identity.

Only the first step moves text, and it moves it once. A block or pair that makes up more than
1/HOT_KEYS of all rows is dealt over several salted buckets; its few salted names are then
merged by comparing the blocks themselves (at most 2 * HOT_KEYS rows, hence the broadcast).
Pair names are made from distinct pairs and joined back, where adaptive execution splits hot keys.

Edge cases: null text counts as empty, and all empty texts are one group; a null doc_id
is treated as one id below all others; of repeated rows (same id, same text) exactly one is kept;
columns other than doc_id and text are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from .common import LOWER, UPPER, long_id, lower_az, plain_id, stored, table, whole_text

BLOCK_BYTES = 4096
RUN = 64             # blocks cut from one copy of a stretch of text
BUCKET_ROWS = 1024   # rows of one sorted bucket, on average
HOT_KEYS = 4096      # a block is hot when it makes up more than 1/HOT_KEYS of all blocks
HOT_LEAST = 64       # and has more rows than this

_RANKS = 1 << 31     # names are bucket * _RANKS + rank


def normalised(col: str = "text") -> Column:
    return lower_az(whole_text(col))


def _bucket_names(buckets: int, hashed: list[str], order: list[str]) -> tuple[Column, Window]:
    return (F.pmod(F.xxhash64(*hashed), F.lit(buckets)),
            Window.partitionBy("bucket").orderBy(*order))


def _first_names(docs: DataFrame) -> DataFrame:
    """(id, v, n, pos, name): n blocks, one row and one integer name per block."""
    def cut(bytes_: Column, size: Column, step: int) -> Column:
        """Pieces of ``step`` bytes; at least one."""
        last = F.greatest(F.lit(1), F.ceil(size / step)).cast("int") - 1
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(bytes_, i * step + 1, F.lit(step)))

    # In two steps, as each cut copies what it is taken from. The outer form keeps the optimiser from
    # adding a filter that would cut every text once more.
    n = F.greatest(F.lit(1), F.ceil(F.octet_length("t") / BLOCK_BYTES)).cast("int")
    blocks = (docs.select(long_id().alias("id"), normalised().alias("t"))
              .select("id", F.xxhash64("t").alias("v"), n.alias("n"),
                      F.posexplode_outer(cut(F.col("t").cast("binary"), F.octet_length("t"), BLOCK_BYTES * RUN)).alias("run", "bytes"))
              .select("id", "v", "n", "run", F.posexplode_outer(cut(F.col("bytes"), F.octet_length("bytes"), BLOCK_BYTES)).alias("at", "block"))
              .select("id", "v", "n", (F.col("run") * RUN + F.col("at")).alias("pos"), "block", F.xxhash64("block").alias("h")))
    seen = Observation()
    frequent = stored(blocks.select("h").observe(seen, F.count(F.lit(1)).alias("rows"))
                      .groupBy("h").agg(F.count(F.lit(1)).alias("rows"))
                      .filter(F.col("rows") > HOT_LEAST), "block-counts")
    total = 0 if docs.isEmpty() else seen.get["rows"]  # an empty plan observes nothing
    most = max(HOT_LEAST, total // HOT_KEYS)
    # At most HOT_KEYS rows: each stands for more than 1/HOT_KEYS of all blocks.
    hot = F.broadcast(frequent.filter(F.col("rows") > most).withColumnRenamed("rows", "hot_rows"))
    salt = F.coalesce(1 + F.pmod(F.xxhash64("id", "v", "pos"), F.ceil(F.col("hot_rows") / most)), F.lit(0))
    bucket, w = _bucket_names(max(1, -(-total // BUCKET_ROWS)), ["h", "salt"], ["block", "salt"])
    key = F.struct("block", "salt")
    named = stored(blocks.join(hot, "h", "left").withColumn("salt", salt).withColumn("bucket", bucket)
                   .select("id", "v", "n", "pos", "bucket",
                           F.dense_rank().over(w).alias("rank"),
                           F.when((F.col("salt") > 0) & ~F.coalesce(F.lag(key).over(w) == key, F.lit(False)),
                                  F.col("block")).alias("salted_block"))
                   .select("id", "v", "n", "pos", (F.col("bucket") * _RANKS + F.col("rank")).alias("name"),
                           "salted_block"), "block-names")
    same = (named.filter(F.col("salted_block").isNotNull())
            .select("name", F.min("name").over(Window.partitionBy("salted_block")).alias("one_name")))
    return (named.drop("salted_block").join(F.broadcast(same), "name", "left")
            .select("id", "v", "n", "pos", F.coalesce("one_name", "name").alias("name")))


def block_identities(docs: DataFrame) -> DataFrame:
    """(id, v, level, name) once per distinct (document, text): equal (level, name) <=> equal normalised text.

    ``id`` is ``long_id(doc_id)``, ``v`` a hash of the text that tells apart rows sharing an id.
    """
    rows = stored(_first_names(docs), "names-0")
    longest = rows.agg(F.max("n")).first()[0] or 1
    done = rows.filter("n = 1").select("id", "v", F.lit(0).alias("level"), "name").distinct()
    level = 0
    while longest > 1:
        level += 1
        longest = -(-longest // 2)
        even = F.col("pos") % 2 == 0
        pairs = stored(rows.filter("n > 1")
                       .groupBy("id", "v", F.ceil(F.col("n") / 2).cast("int").alias("n"),
                                F.floor(F.col("pos") / 2).cast("int").alias("pos"))
                       .agg(F.max(F.when(even, F.col("name"))).alias("a"),
                            F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(0)).alias("b")), f"pairs-{level}")
        distinct = pairs.select("a", "b").distinct()
        count = pairs.count()
        bucket, w = _bucket_names(max(1, -(-count // BUCKET_ROWS)), ["a", "b"], ["a", "b"])
        names = stored(distinct.withColumn("bucket", bucket)
                       .select("a", "b", (F.col("bucket") * _RANKS + F.row_number().over(w)).alias("name")),
                       f"pair-names-{level}")
        rows = stored(pairs.join(names, ["a", "b"]).select("id", "v", "n", "pos", "name"), f"names-{level}")
        done = done.union(rows.filter("n = 1").select("id", "v", F.lit(level).alias("level"), "name"))
    return done


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    ids = block_identities(docs)
    rows = (docs.select(long_id().alias("id"), normalised().alias("t"))
            .select("id", F.xxhash64("t").alias("v"), F.unhex(F.sha2("t", 256)).alias("sha"))
            .join(ids, ["id", "v"])
            .withColumn("copy", F.row_number().over(Window.partitionBy("id", "v").orderBy("sha"))))
    groups = (rows.groupBy("level", "name")
              .agg(F.max("id").alias("keep"), F.count(F.lit(1)).alias("group_size")))
    return (rows.join(groups, ["level", "name"])
            .select(plain_id("id").alias("doc_id"), plain_id("keep").alias("keep_id"), "group_size",
                    ((F.col("id") == F.col("keep")) & (F.col("copy") == 1)).alias("kept"),
                    F.lower(F.hex("sha")).alias("text_sha256")))


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


OP1_SQL = f"""
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS norm FROM documents),
     g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.norm) AS text_sha256
FROM t JOIN g ON t.norm = g.norm
"""
