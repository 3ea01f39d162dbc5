"""The last-wins catalog as a stored table that new rows are merged into.

A folder holds ``base-<n>`` (one row per key) and ``delta-<n>`` folders (one row per key each), all Parquet.
A run that brings new rows writes one delta, whose cost follows the new rows alone; readers take of each key the row
with the largest ordinal over the newest base and the deltas after it, so rows may arrive in any order and twice.
``compact`` folds all into the next base. A folder counts once its job has left ``_SUCCESS``: a run
that dies leaves an ignored folder, and old ones are only deleted when the new base is complete.
One writer at a time.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .enrich import dedupe_last

_FOLDER = re.compile(r"(base|delta)-(\d+)")


def _folders(spark: SparkSession, path: str) -> tuple[list[tuple[int, str]], list[str]]:
    """((number, folder) of the newest base and the deltas after it, folders that are out of date)."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return [], []
    found = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        kind = _FOLDER.fullmatch(name)
        if kind and fs.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
            found.append((int(kind[2]), kind[1], f"{path.rstrip('/')}/{name}"))
    start = max((n for n, kind, _ in found if kind == "base"), default=0)
    live = sorted((n, f) for n, kind, f in found if n > start or (n == start and kind == "base"))
    return live, [f for n, kind, f in found if (n, f) not in live]


def _delete(spark: SparkSession, folders: list[str]) -> None:
    for folder in folders:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def add_rows(rows: DataFrame, path: str, ord_col: str = "cat_ord") -> None:
    """Merge new catalog rows into the snapshot at ``path`` (made at first use); no rows, no delta."""
    spark = rows.sparkSession
    last = dedupe_last(rows, ord_col)
    if not last.isEmpty():
        live, _ = _folders(spark, path)
        last.write.mode("overwrite").parquet(f"{path.rstrip('/')}/delta-{max((n for n, _ in live), default=0) + 1:09}")


def read_snapshot(spark: SparkSession, path: str, ord_col: str = "cat_ord") -> DataFrame:
    """The last-wins catalog: what ``dedupe_last`` gives over all rows ever added."""
    live, _ = _folders(spark, path)
    if not live:
        raise FileNotFoundError(f"no snapshot at {path}")
    rows = spark.read.parquet(*[folder for _, folder in live])
    kept = [c for c in rows.columns if c not in ("k_name", "k_brand")]
    return (rows.groupBy("k_name", "k_brand").agg(F.max_by(F.struct(*kept), F.col(ord_col)).alias("row"))
            .select("k_name", "k_brand", "row.*"))


def compact(spark: SparkSession, path: str, ord_col: str = "cat_ord") -> None:
    """Fold the deltas into a new base, then delete what it replaces."""
    live, stale = _folders(spark, path)
    if len(live) > 1:
        read_snapshot(spark, path, ord_col).write.mode("overwrite").parquet(f"{path.rstrip('/')}/base-{live[-1][0]:09}")
        live, stale = _folders(spark, path)
    _delete(spark, stale)
