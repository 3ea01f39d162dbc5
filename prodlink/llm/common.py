"""Helpers shared by the operators: table reads, shared scratch tables, Arrow text slices."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_root

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, as ``--py-files`` would."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(target))
    _shipped.add(sc.applicationId)


BATCH_ROWS = 500
_BATCH_ROWS_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Texts that are written inside go to the Python workers in batches of ``BATCH_ROWS`` rows at most (10,000 by
    default, tens of MB of text at once in the JVM and in each worker)."""
    before = spark.conf.get(_BATCH_ROWS_SETTING)
    spark.conf.set(_BATCH_ROWS_SETTING, min(int(before), BATCH_ROWS) if int(before) > 0 else BATCH_ROWS)
    try:
        yield
    finally:
        spark.conf.set(_BATCH_ROWS_SETTING, before)


def map_arrow(df: DataFrame, run, schema) -> DataFrame:
    """``mapInArrow`` with this package present on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

# Bytes of text handled by one round of numpy work inside a task. A longer document is a
# slice of its own, so working memory follows the longest document, not the batch.
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared folder that the session names (URLs are kept as they are)."""
    return f"{checkpoint_root(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, lineage cut, and
    safe against lost executors because the files do not live on them."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    # Shuffle files of the finished job go once the driver has collected its garbage.
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a table written by ``stored`` that nothing reads any more."""
    sc = df.sparkSession.sparkContext
    for file in df.inputFiles()[:1]:
        path = sc._jvm.org.apache.hadoop.fs.Path(file).getParent()
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def lower_az(col: Column) -> Column:
    """Lower-case A-Z only. Plain ASCII texts take the cheap built-in, which does the same there."""
    return F.when(F.octet_length(col) == F.length(col), F.lower(col)).otherwise(F.translate(col, UPPER, LOWER))


def whole_text(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


NULL_ID = -(1 << 63)


def long_id(col: str = "doc_id") -> Column:
    """The id as a never-null key: a null id becomes NULL_ID, below all others."""
    return F.coalesce(F.col(col).cast("long"), F.lit(NULL_ID))


def plain_id(col: str) -> Column:
    """Back from ``long_id``."""
    return F.nullif(F.col(col), F.lit(NULL_ID))


def held_out(col: str = "doc_id") -> Column:
    """True where crc32(doc_id as text) mod 5 is 0; a null id counts as held out."""
    return F.coalesce(F.crc32(F.col(col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def utf8_slices(texts, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut an Arrow string array into runs of rows of about ``max_bytes``.

    Yields (first row, end row, bytes as uint8, offsets with end-start+1 entries from 0).
    Nulls are expected to be gone. The bytes are a view on Arrow's own buffer.
    """
    import pyarrow as pa

    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    n = len(texts)
    if n == 0:
        return
    _, off_buf, data = texts.buffers()
    off = np.frombuffer(off_buf, dtype=np.int64)[texts.offset:texts.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = int(np.searchsorted(off, off[i] + max_bytes, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j, raw[off[i]:off[j]], (off[i:j + 1] - off[i]).astype(np.int64)
        i = j
