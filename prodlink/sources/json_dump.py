"""Forum listing dumps: one JSON document ``{data: {children: [{data: {...}}]}}`` per ``*.txt`` file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

POST_FIELDS = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("link_flair_text", T.StringType()),
    T.StructField("created_utc", T.DoubleType()),
    T.StructField("selftext", T.StringType()),
    T.StructField("permalink", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("is_video", T.BooleanType()),
    T.StructField("thumbnail", T.StringType()),
])

LISTING_SCHEMA = T.StructType([
    T.StructField("data", T.StructType([
        T.StructField("children", T.ArrayType(T.StructType([
            T.StructField("data", POST_FIELDS)]))),
    ])),
])


def read_listing_dumps(spark: SparkSession, root: str, glob: str = "*.txt") -> DataFrame:
    """(path, pos, post): children of every dump under ``root`` (recursively).

    Each file is one JSON document, read whole by one task, as the format requires; files are
    independent. A malformed file, one without ``data.children``, or one whose top level is not an
    object yields no rows. Duplicates across files are kept (UNION ALL semantics).
    """
    df = (spark.read.option("wholetext", True).option("pathGlobFilter", glob)
          .option("recursiveFileLookup", True).text(root))
    return parse_listing_documents(df.select(F.col("_metadata.file_path").alias("path"), "value"))


def parse_listing_documents(docs: DataFrame, value: str = "value", path: str = "path", keep: tuple[str, ...] = ()) -> DataFrame:
    """Same rows as ``read_listing_dumps`` for listing JSON already held in a
    string column (one document per row); unparsable documents, and those whose top level is not an
    object, yield nothing. ``keep`` names columns of a document that its posts get as well."""
    objects = docs.where(F.ltrim(F.translate(F.col(value), "\ufeff\t\r\n", "   ")).startswith("{"))
    parsed = objects.select(F.col(path).alias("path"), *keep, F.from_json(F.col(value), LISTING_SCHEMA).alias("doc"))
    return parsed.select("path", *keep, F.posexplode(F.col("doc.data.children")).alias("pos", "child")) \
        .select("path", "pos", F.col("child.data").alias("post"), *keep) \
        .where(F.col("post").isNotNull())
