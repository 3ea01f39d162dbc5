"""Enrichment: broadcast and shuffle paths agree, also with one hot key."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from prodlink.operators import enrich as N
from prodlink.operators.joins import fits_broadcast, size_stats
from prodlink.plans import derived as D


def _hot_matches(spark):
    m = N.filter_matched(D.enrich_matches_from_part(spark, SF_SMALL))
    # a third of the posts point at the same figure
    first = m.orderBy("post_id").first()
    return m.withColumn("figure_name", F.when(F.col("post_id") % 3 == 0, F.lit(first.figure_name))
                        .otherwise(F.col("figure_name"))) \
            .withColumn("brand", F.when(F.col("post_id") % 3 == 0, F.lit(first.brand)).otherwise(F.col("brand")))


def test_shuffle_path_equals_broadcast_path_with_hot_key(spark):
    matches = _hot_matches(spark)
    cat = D.enrich_catalog_from_part(spark, SF_SMALL)
    a = sorted(map(tuple, N.enrich_join(matches, cat, 1999).collect()), key=str)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        b = sorted(map(tuple, N.enrich_join(matches, cat, 1999).collect()), key=str)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert a == b and len(a) == matches.count()


def test_semi_anti_partition_the_matches(spark):
    matches = N.filter_matched(D.enrich_matches_from_part(spark, SF_SMALL))
    cat = D.enrich_catalog_from_part(spark, SF_SMALL)
    semi = N.enrich_split(matches, cat, "left_semi").count()
    anti = N.enrich_split(matches, cat, "left_anti").count()
    assert semi + anti == matches.count() and semi > 0 and anti > 0


def test_size_stats(spark):
    df = spark.createDataFrame([("a", 1), ("bb", 2)], "s string, n int")
    st = size_stats(df)
    assert st["rows"] == 2 and st["bytes"] > 0
    assert fits_broadcast(st) and not fits_broadcast(st, max_rows=1) and not fits_broadcast(st, max_bytes=1)
