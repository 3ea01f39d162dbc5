"""Column helpers: dialect rules and idempotence."""

from pyspark.sql import functions as F

from prodlink.functions import text as T


def _one(spark, col, value, ddl="s string"):
    return spark.createDataFrame([(value,)], ddl).select(col.alias("o")).first().o


def test_to_fixed2_rounds_binary_value(spark):
    df = spark.createDataFrame([(8250,), (12650,), (15950,)], "j long")
    got = [r.o for r in df.select(T.to_fixed2(F.col("j").cast("double") * 0.0069).alias("o")).collect()]
    assert got == ["56.92", "87.28", "110.05"]


def test_js_trim_strips_unicode_space(spark):
    assert _one(spark, T.js_trim(F.col("s")), "  a b\n\t") == "a b"


def test_clean_text_is_idempotent(spark):
    df = spark.createDataFrame([('"x"',), ("UNKNOWN",), ("",), (" Unknown ",), (None,)], "s string")
    once = df.select(T.clean_text(F.col("s")).alias("s"))
    twice = once.select(T.clean_text(F.col("s")).alias("s"))
    assert [r.s for r in once.collect()] == [r.s for r in twice.collect()] == ["x", None, None, "Unknown", None]


def test_age_bucket(spark):
    df = spark.createDataFrame([("Jan-1999",), ("late Feb-1998",), ("mid May-1990",), ("Mar-2001",), ("UNKNOWN",), ("soon",)], "s string")
    got = [r.o for r in df.select(T.age_bucket(F.col("s"), 1999).alias("o")).collect()]
    assert got == ["New", "1 Year", "9 Years", "Pre-order", "Unknown", "Unknown"]


def test_epoch_to_iso_ignores_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert _one(spark, T.epoch_to_iso(F.col("x")), 1704067200.5, "x double") == "2024-01-01T00:00:00.500Z"
        assert _one(spark, T.epoch_to_iso(F.col("x")), 0.0, "x double") == ""
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_extract_scale(spark):
    df = spark.createDataFrame([("Scale: 1/12\nx",), ("Size: H10",), ("scale:  4:3",), (None,)], "s string")
    assert [r.o for r in df.select(T.extract_scale(F.col("s")).alias("o")).collect()] == ["1/12", None, "4:3", None]


def test_labels_to_json(spark):
    df = spark.createDataFrame([("a, b",), (" ",), ("x,,y",)], "s string")
    assert [r.o for r in df.select(T.labels_to_json(F.col("s")).alias("o")).collect()] == ['["a","b"]', "[]", '["x","y"]']
