"""Materialised small sides and their exact size (rows and bytes), the check before a broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_root

# Ceilings for a broadcast side. Both are checked on the materialised side:
# the exact row count and the summed JSON length of its rows (a byte proxy).
BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 64 * 1024 * 1024  # a hash table takes several times as much


def materialize(df: DataFrame) -> DataFrame:
    """Checkpoint a (small) side into the shared checkpoint folder: computed once,
    lineage cut. The temporary cache only serves the checkpoint write."""
    checkpoint_root(df.sparkSession)
    cached = df.persist()
    out = cached.checkpoint(eager=True)
    cached.unpersist()
    return out


def size_stats(df: DataFrame, *extra) -> dict:
    """Exact row count and approximate bytes (sum of JSON lengths), in one pass,
    plus any extra aggregate columns."""
    row = df.agg(F.count(F.lit(1)).alias("rows"),
                 F.coalesce(F.sum(F.length(F.to_json(F.struct("*")))), F.lit(0)).alias("bytes"),
                 *extra).first()
    return row.asDict()


def fits_broadcast(stats: dict, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    return stats["rows"] <= max_rows and stats["bytes"] <= max_bytes
