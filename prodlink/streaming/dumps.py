"""Incremental posts: new dump files are picked up as they land.

The source collects dated dump files by hand and re-runs everything. Here a
file-source stream reads each new ``*.txt`` dump once (the checkpoint records
which files were processed), applies the same per-post operators as the batch
path (flatten, flair filter, projection) and appends to a parquet table. The
link step is per post apart from its per-post arg-max, so it can run inside
``foreachBatch`` against a static catalog.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import enrich as N
from ..operators import posts as P
from ..operators.snapshot import read_snapshot
from ..sources.json_dump import parse_listing_documents


ANCHOR_OPTIONS = ("ord_col", "rules", "weights", "broadcast_rows", "broadcast_bytes")

STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_dump_stream(spark: SparkSession, root: str, glob: str = "*.txt",
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming (path, pos, post, collected) rows from dump files under ``root``; ``collected`` is the file's time.

    Without ``max_files_per_trigger`` all files present make one micro-batch. Every batch goes through the whole state,
    so batches of a fixed number of files would make the work grow with the square of the backlog.
    """
    reader = (spark.readStream.option("wholetext", True)
              .option("pathGlobFilter", glob).option("recursiveFileLookup", True))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = reader.text(root)
    return parse_listing_documents(df.select(F.col("_metadata.file_path").alias("path"), "value",
                                             F.col("_metadata.file_modification_time").alias("collected")), keep=("collected",))


def distinct_stream(children: DataFrame, remember: str = "90 days") -> DataFrame:
    """Streaming posts once: a post seen in an earlier dump, or twice in this one, does not come again.

    The identities seen are the query's state. A dump's age is its file's modification time: an identity is forgotten
    ``remember`` after the dump it came with, and dumps older than that against the newest are too late. The newest is
    that of earlier batches: within one batch no dump is too late, and a post comes once however far its dumps lie apart.
    """
    return (children.withColumn("identity", P.post_identity(F.col("post.id")))
            .withWatermark("collected", remember).dropDuplicatesWithinWatermark(["identity"]).drop("identity", "collected"))


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Queries started here keep their state in RocksDB (a checkpoint begun with another store stays with it): the
    identities of all posts seen need not fit the executors' heaps."""
    before = spark.conf.get(STATE_PROVIDER)
    spark.conf.set(STATE_PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(STATE_PROVIDER, before)


def run_posts_stream(spark: SparkSession, root: str, out: str, checkpoint: str,
                     flair: str = P.DEFAULT_FLAIR, distinct: bool = False, remember: str = "90 days") -> None:
    """Process every dump file present now (availableNow), appending posts to ``out``; with ``distinct`` each post
    once over all dumps (see ``distinct_stream``)."""
    children = read_dump_stream(spark, root)
    children = distinct_stream(children, remember) if distinct else children.drop("collected")
    posts = P.build_posts(children, flair)
    with _state_on_disk(spark):
        q = (posts.writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", checkpoint).outputMode("append")
             .trigger(availableNow=True).start())
    q.awaitTermination()


def run_link_stream(spark: SparkSession, root: str, catalog: DataFrame, out: str, checkpoint: str,
                    flair: str = P.DEFAULT_FLAIR, enrich: Callable[[DataFrame], DataFrame] | None = None, **link_kw) -> None:
    """Posts from new dumps linked to a static catalog in each micro-batch; ``enrich`` turns a batch's
    matches into what is written (see ``enrich_from_snapshot``)."""
    from ..operators.link import match_posts, prepare_anchors

    anchors = prepare_anchors(catalog, **{k: v for k, v in link_kw.items() if k in ANCHOR_OPTIONS})  # once
    rest = {k: v for k, v in link_kw.items() if k not in ANCHOR_OPTIONS}

    def link_batch(batch: DataFrame, batch_id: int) -> None:
        # foreachBatch is at-least-once: each batch overwrites its own folder,
        # so a batch replayed after a failure replaces its output, never doubles it.
        keyed = batch.withColumn("post_key", F.concat_ws(":", "path", F.col("pos").cast("string")))
        matches = match_posts(keyed, catalog, key="post_key", created="created_date", anchors=anchors, **rest)
        (enrich(matches) if enrich else matches).write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch_id={batch_id}")

    posts = P.build_posts(read_dump_stream(spark, root).drop("collected"), flair)
    q = (posts.writeStream.foreachBatch(link_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def enrich_from_snapshot(spark: SparkSession, path: str, as_of_year: int, key: str = "post_key") -> Callable[[DataFrame], DataFrame]:
    """The enrichment step of a stream: each batch's linked posts with the catalog snapshot as it is then."""
    def enrich(matches: DataFrame) -> DataFrame:
        return N.enrich_last(N.filter_matched(matches), read_snapshot(spark, path), as_of_year, key=key)
    return enrich
