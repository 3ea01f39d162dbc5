"""Listing text source: one document per vendor folder, records separated by ``\\n-\\n``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RECORD_SEP = "\n-\n"


def source_of(path: Column) -> Column:
    """Vendor name = the file's parent folder (a ``key=`` prefix is dropped)."""
    folder = F.regexp_extract(path, r"([^/]+)/[^/]+$", 1)
    return F.regexp_replace(folder, r"^[A-Za-z_][A-Za-z0-9_]*=", "")


def read_listing_text(spark: SparkSession, root: str, pattern: str = "*/raw.txt") -> DataFrame:
    """(source, path, value): every matching file read whole; empty files yield nothing.

    Each file is one row, as in the source. Files are independent, so a large
    folder of vendors spreads over tasks; a single huge file should use
    ``read_listing_records`` instead.
    """
    df = (spark.read.option("ignoreMissingFiles", True)
          .text(f"{root.rstrip('/')}/{pattern}", wholetext=True))
    path = F.col("_metadata.file_path")
    return df.select(source_of(path).alias("source"), path.alias("path"), "value") \
        .where(F.col("value") != "")


def read_listing_records(spark: SparkSession, root: str, pattern: str = "*/raw.txt",
                         sep: str = RECORD_SEP) -> DataFrame:
    """(source, path, block, n, section) with the reader splitting records at ``sep``.

    Splittable: a very large file is cut into many input splits. Normalisation and comment
    removal then run per record. ``block`` is where the record's input split starts and ``n``
    increases inside a split, so (path, block, n) is the order of a file's records.
    """
    df = spark.read.text(f"{root.rstrip('/')}/{pattern}", lineSep=sep)
    path = F.col("_metadata.file_path")
    return df.select(source_of(path).alias("source"), path.alias("path"),
                     F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("n"), F.col("value").alias("section"))
