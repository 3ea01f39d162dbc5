"""Lenient CSV scan and the stage CSV sinks.

Policy of the source's hand-written reader: header row names the columns,
quoted fields may span lines, CR is dropped, values are trimmed, every quote
character disappears, blank lines are skipped and rows whose arity differs
from the header are silently dropped. Here Spark's reader finds the records, and their fields are told
apart by the same quote rule on the raw record.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import js_trim

CORRUPT = "_corrupt_record"


# A record's fields, each behind its comma (one is put in front): runs without comma and quote, and quoted runs,
# in which every quote opens or closes; a last quote that nothing closes reaches to the end.
_FIELD = r',((?:[^,"]++|"[^"]*+(?:"|\z))*+)'


def _fields(record: Column) -> Column:
    """The fields of a raw record, quotes and CR dropped, trimmed."""
    cells = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(_FIELD), 1)
    return F.transform(cells, lambda c: js_trim(F.translate(c, '"\r', "")))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(path, n, fields): every record of the CSV files under ``path``, in file order within a file by ``n``.

    Spark's reader finds the records (quoted fields may span lines; blank lines are none): read with a schema of one
    column, a record of more columns comes back whole. A multiLine file is never split, so one task
    reads it front to back and ``monotonically_increasing_id`` follows its order.
    """
    schema = T.StructType([T.StructField("only", T.StringType()), T.StructField(CORRUPT, T.StringType())])
    raw = (spark.read.schema(schema).option("header", False).option("multiLine", True).option("recursiveFileLookup", True)
           .option("quote", '"').option("escape", '"').option("maxCharsPerColumn", -1)
           .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(path))
    one = F.array(js_trim(F.translate(F.coalesce("only", F.lit("")), '"\r', "")))
    return raw.select(F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("n"),
                      F.when(F.col(CORRUPT).isNull(), one).otherwise(_fields(F.col(CORRUPT))).alias("fields"))


def read_csv_lenient(spark: SparkSession, path: str, columns: list[str], fill_empty: bool = True,
                     ordinal: str | None = None) -> DataFrame:
    """Lenient scan: ``columns`` by the names in each file's own header row, whatever their order and
    whatever other columns the file has; a column the file lacks is empty, of columns with one name the last counts. A row's
    arity is compared with its file's header. An absent path gives an empty table.

    One scan: records come with their file and place, a file's first record is its header, and a window over the
    file hands it to the others. Nothing per file reaches the driver, and files of any headers share one plan. A
    file's records meet in one task, as they do in the reader.

    With ``ordinal`` adds (``path``, ``ordinal``) giving file order (last-wins needs it).
    """
    extra = ["path", ordinal] if ordinal else []
    schema = ", ".join(f"`{c}` string" for c in columns) + (f", path string, `{ordinal}` bigint" if ordinal else "")
    try:
        records = read_records(spark, path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)
    file = Window.partitionBy("path").orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    headed = records.select("path", "n", "fields", F.first("fields").over(file).alias("head"), F.first("n").over(file).alias("start"))
    rows = headed.where((F.col("n") > F.col("start")) & (F.size("fields") == F.size("head")))
    names = F.concat(F.array(F.regexp_replace(F.element_at("head", 1), r"\A\uFEFF", "")), F.slice("head", 2, F.size("head")))
    # Places counted from the end: of columns with one name the last is found first.
    named = rows.select("path", F.col("n").alias(ordinal or "n"), "fields", F.reverse(names).alias("names"))
    cells = []
    for c in columns:
        place = F.array_position("names", c)
        value = F.nullif(F.get("fields", (F.size("fields") - place).cast("int")), F.lit(""))
        cells.append(F.when(place > 0, value).alias(c))
    out = named.select(*cells, *extra)
    return out.na.fill("", subset=columns) if fill_empty else out


def write_stage_csv(df: DataFrame, path: str, partition_by: list[str] | None = None,
                    mode: str = "overwrite") -> bool:
    """Header + quoted fields; quotes inside values doubled. Nothing is written, and what an earlier run
    left stays, when there are no rows. With ``partition_by`` only the partitions present are replaced."""
    if df.isEmpty():
        return False
    w = (df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"')
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    if partition_by:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    w.csv(path)
    return True


def read_stage_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Read back a stage CSV written by ``write_stage_csv`` (partition folders become columns)."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return (spark.read.schema(schema).option("header", True).option("multiLine", True)
            .option("quote", '"').option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
