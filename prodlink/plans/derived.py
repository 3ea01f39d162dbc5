"""Derived inputs: the source's data shapes rendered from the driver's tables.

Each builder reads the given parquet tables, so its size grows with them. The
same definitions exist as DuckDB SQL in ``plans/oracle.py``.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _s(c: Column | int) -> Column:
    return (c if isinstance(c, Column) else F.lit(c)).cast("string")


# ------------------------------------------------------------------ CAT

CAT_ROWS = 1_000_000  # ordinals kept for one item: six million words


def catalog_from_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CAT: one catalog row per six consecutive words of ``benchmark`` text (the last row of an item is
    filled up with ``end``); every 10th item's rows repeat with the next ordinal, as a second
    vendor's, so first-wins / last-wins are both exercised. Even ordinals are vendor 0, odd ones vendor 1."""
    b = table(spark, sf_dir, "benchmark")
    w = F.split(F.trim(F.regexp_replace("text", "[^A-Za-z0-9]+", " ")), " ")
    words = (b.select("item_id", w.alias("w"))
             .select("item_id", "w", F.explode(F.sequence(F.lit(0), F.floor((F.size("w") - 1) / 6).cast("int"))).alias("k"))
             .select("item_id", "k", *[F.coalesce(F.get("w", F.col("k") * 6 + i), F.lit("end")).alias(f"w{i + 1}")
                                       for i in range(6)]))
    # Every 10th item again with the odd ordinal (explode, not a union, so the projections above
    # are planned once).
    first = (F.col("item_id") * CAT_ROWS + F.col("k")) * 2
    ords = F.when(F.col("item_id") % 10 == 0, F.array(first, first + 1)).otherwise(F.array(first))
    n = words.select("*", F.explode(ords).alias("cat_ord"))
    i5, sp = F.col("item_id") % 5, F.lit(" ")
    w1, w2, w3, w4, w5, w6 = (F.col(f"w{i}") for i in range(1, 7))
    name = (F.when(i5 == 0, F.concat(w1, sp, w2))
            .when(i5 == 1, F.concat(w1, sp, w2, F.lit(" ("), w3, sp, w4, F.lit(")")))
            .when(i5 == 2, F.concat(w1, F.lit("-"), w2, F.lit(" Ver.2.5")))
            .when(i5 == 3, F.concat(w1, sp, w2, sp, w3))
            .otherwise(F.concat(w1, sp, w2, F.lit(" ("), w3, F.lit(") v2"))))
    return n.select(
        "cat_ord", name.alias("name"),
        F.concat(F.lit("Brand"), _s(F.col("item_id") % 5)).alias("brand"),
        F.concat(F.lit("Line"), _s(F.col("item_id") % 3)).alias("product_line"),
        F.when(F.col("item_id") % 4 == 0, F.lit("")).otherwise(F.concat(w5, sp, w6)).alias("series_title"),
        F.concat(F.lit("Mar-"), _s(F.lit(2017) + F.col("cat_ord") % 11)).alias("release_date"))


# ------------------------------------------------------------------ POST

LABEL_PHRASES = [" floppy arms", " a PAINT bleed", " snapped peg", " lost accessories", " it is bent", " stuck joint",
                 " box damage"]


def posts_from_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """POST: one post per document (title = first 80 chars of the text, body = whole text; behind it, by
    key, one of ``LABEL_PHRASES``, so that every default label occurs)."""
    d = table(spark, sf_dir, "documents")
    created = F.lit(1704067200) + F.col("doc_id") * 60
    return d.select(
        F.col("doc_id").alias("post_id"),
        F.replace(F.substring("text", 1, 80), F.lit("\n"), F.lit(" ")).alias("title"),
        F.concat("text", F.coalesce(F.get(F.array(*[F.lit(p) for p in LABEL_PHRASES]), F.col("doc_id").cast("int") % 29), F.lit("")))
        .alias("selftext"),
        F.col("source").alias("author"),
        created.cast("double").alias("created_utc"),
        F.concat(F.lit("/r/"), F.col("lang"), F.lit("/comments/"), _s(F.col("doc_id")), F.lit("/"))
        .alias("permalink"))


# ------------------------------------------------------------------ ENR

def enrich_matches_from_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ENR matches: one linked post per part, with blank / unknown / upper-case names."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    name = (F.when(k % 19 == 0, F.lit(""))
            .when(k % 11 == 0, F.concat(F.lit("nobody "), _s(k)))
            .when(k % 5 == 0, F.upper("p_name")).otherwise(F.col("p_name")))
    issues = F.when(k % 4 == 0, "loose_joints, warped_parts").when(k % 4 == 1, " broken_parts").otherwise("")
    link = F.when(k % 6 == 0, F.lit("")).otherwise(F.concat(F.lit("https://example.org/"), _s(k)))
    return p.select(k.alias("post_id"), name.alias("figure_name"), F.col("p_brand").alias("brand"),
                    F.col("p_type").alias("product_line"), issues.alias("detected_issues"),
                    link.alias("reddit_permalink"))


def enrich_catalog_from_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ENR catalog: one row per part; several parts share (name, brand), so last-wins matters."""
    p = table(spark, sf_dir, "part")
    k, size = F.col("p_partkey"), _s(F.col("p_size"))
    sculptor = (F.when(k % 9 == 0, "UNKNOWN").when(k % 10 == 0, "")
                .otherwise(F.concat(F.lit("S"), size, F.lit(" "))))
    release = F.when(k % 8 == 0, "UNKNOWN").otherwise(F.concat(F.lit("late Mar-"), _s(F.lit(1995) + k % 10)))
    spec = (F.when(k % 3 == 0, F.concat(F.lit("Scale: 1/"), size, F.lit("\nMaterial: PVC")))
            .when(k % 6 == 2, F.concat(F.lit("Scale:  1:"), size, F.lit(" ca.")))
            .when(k % 6 == 5, F.concat(F.lit("scale: non scale "), size, F.lit("\nSize: H1")))
            .otherwise(F.concat(F.lit("Size: H"), size)))
    series = (F.when(k % 7 == 0, F.lit("")).when(k % 7 == 1, F.concat(F.lit('"'), F.col("p_type"), F.lit('"')))
              .otherwise(F.col("p_type")))
    material = F.when(k % 3 == 0, F.lit("PVC")).otherwise(F.lit(""))
    return p.select(k.alias("cat_ord"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand"),
                    F.col("p_type").alias("product_line"), series.alias("series_title"),
                    sculptor.alias("sculptor"), release.alias("release_date"), spec.alias("spec"),
                    material.alias("material"))


def with_validation_faults(combined: DataFrame) -> DataFrame:
    """Inject record faults by key modulus for the validation queries."""
    k = F.col("post_id")
    return combined.select(
        "post_id",
        F.when(k % 23 == 0, F.lit("bad")).otherwise(F.col("mode")).alias("mode"),
        F.when(k % 37 == 0, F.lit(None).cast("string")).otherwise(F.col("figure_name")).alias("figure_name"),
        F.when(k % 41 == 0, F.lit("")).otherwise(F.col("brand")).alias("brand"),
        F.when(k % 29 == 0, F.lit('{"a": 1}')).when(k % 31 == 0, F.lit("not json"))
        .otherwise(F.col("issues")).alias("issues"))


# ------------------------------------------------------------------ LIST

LIST_BLOCK = 500  # sections per rendered listing file (bounded; file count grows with part)


def listing_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LIST: one listing section per part, with missing codes (key % 13) and brands (key % 17); every fourth has a series."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    tab = F.lit("\t")
    price = F.format_number(F.floor("p_retailprice").cast("bigint") * 10, 0)
    code = F.when(k % 13 == 0, F.lit("NOCODE")).otherwise(F.format_string("FIGURE-%012d", k))
    brand = F.when(k % 17 == 0, F.concat(F.lit("Maker"), tab, F.col("p_brand"))) \
        .otherwise(F.concat(F.lit("Brand"), tab, F.col("p_brand")))
    section = F.concat_ws(
        "\n", code, F.lit("About this item"),
        F.concat(F.lit("Release Date"), tab, F.lit("Mar-"), _s(F.lit(2017) + k % 11), tab,
                 F.lit("List Price"), tab, price, F.lit(" JPY")),
        brand, F.concat(F.lit("Product Line"), tab, F.col("p_type")),
        F.when(k % 4 == 0, F.concat(F.lit("Series Title  Saga of "), F.col("p_type"), F.lit(" "), _s(F.col("p_size")), F.lit(" "))),
        F.concat(F.lit("Character Name    "), F.col("p_name")),
        F.concat(F.lit("Sculptor"), tab, F.lit("S"), _s(F.col("p_size")), F.lit(" ")),
        F.concat(F.lit("Specifications"), tab, F.lit("Scale: 1/"), _s(F.col("p_size"))),
        F.lit("Material: PVC & ABS"), F.lit(""), F.lit("[Set Contents]"), F.lit("Main Body x1"),
        F.concat(F.lit("Details"), tab, F.lit("x")))
    source = F.concat(F.lit("vendor"), _s(F.expr(f"p_partkey div {LIST_BLOCK}")))
    return p.select("p_partkey", source.alias("source"), section.alias("section"))


def listing_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source, value): the sections of one source joined in key order with '\\n-\\n'.

    A group is at most LIST_BLOCK sections, so no document grows with the data.
    """
    s = listing_sections(spark, sf_dir)
    ordered = F.array_sort(F.collect_list(F.struct("p_partkey", "section")))
    return s.groupBy("source").agg(
        F.array_join(F.transform(ordered, lambda x: x["section"]), "\n-\n").alias("value"))


def write_listing_files(spark: SparkSession, sf_dir: str) -> str:
    """Render LIST as one text file per vendor folder under the scratch root."""
    from ..session import scratch_path
    root = scratch_path(spark, "listing")
    listing_documents(spark, sf_dir).write.partitionBy("source").text(root)
    return root


# ------------------------------------------------------------------ ENV

DUMP_BLOCK = 1000  # children per rendered dump file (bounded; file count grows with events)


def dump_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One child post per event, with flairs blanked (key % 7 = 0) or padded (key % 7 = 1)."""
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    from ..functions.text import ntz_epoch_seconds
    flair = (F.when(k % 7 == 0, F.lit(None).cast("string"))
             .when(k % 7 == 1, F.concat(F.lit(" "), F.col("event_type"), F.lit(" ")))
             .otherwise(F.col("event_type")))
    return e.select(
        F.expr(f"event_id div {DUMP_BLOCK}").alias("dump"), k.alias("event_id"),
        F.struct(_s(k).alias("id"), F.col("event_type").alias("title"),
                 F.concat(F.lit("u"), _s(F.col("user_id"))).alias("author"),
                 flair.alias("link_flair_text"), ntz_epoch_seconds(F.col("ts")).alias("created_utc"),
                 F.col("props").alias("selftext"),
                 F.concat(F.lit("/r/x/comments/"), _s(k), F.lit("/")).alias("permalink"),
                 F.lit("").alias("url"), (k % 2 == 0).alias("is_video"), F.lit("").alias("thumbnail"))
        .alias("data"))


def write_dump_files(spark: SparkSession, sf_dir: str, repeat_first: bool = True) -> str:
    """Render ENV: one listing JSON per block of events (children in key order), plus a
    malformed file, a file without ``data.children`` and (optionally) a second copy of
    dump 0 so duplicates across files are exercised."""
    from ..session import scratch_path
    root = scratch_path(spark, "dumps")
    dump_documents(spark, sf_dir, repeat_first).write.partitionBy("dump").text(root)
    return root


def document_dumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path, value): listing documents whose posts have whole ``documents`` texts as bodies (names and
    labels beyond the preview's 500 characters); one per block of document ids."""
    d = table(spark, sf_dir, "documents")
    k = F.col("doc_id")
    post = F.struct(_s(k).alias("id"), F.lit("").alias("title"), F.col("source").alias("author"),
                    F.lit("Quality Issues").alias("link_flair_text"),
                    (F.lit(1704067200) + k * 60).cast("double").alias("created_utc"), F.col("text").alias("selftext"),
                    F.concat(F.lit("/r/"), F.col("lang"), F.lit("/comments/"), _s(k), F.lit("/")).alias("permalink"))
    children = F.collect_list(F.struct(F.lit("t3").alias("kind"), post.alias("data")))
    listing = F.to_json(F.struct(F.lit("Listing").alias("kind"), F.struct(children.alias("children")).alias("data")))
    return (d.groupBy(F.expr(f"doc_id div {DUMP_BLOCK // 10}").alias("dump")).agg(listing.alias("value"))
            .select(_s(F.col("dump")).alias("path"), "value"))


def dump_documents(spark: SparkSession, sf_dir: str, repeat_first: bool = True) -> DataFrame:
    """(dump, value): the ENV listing documents as JSON text (see ``write_dump_files``)."""
    c = dump_children(spark, sf_dir)
    ordered = F.array_sort(F.collect_list(F.struct("event_id", "data")))
    listing = F.to_json(F.struct(F.lit("Listing").alias("kind"), F.struct(
        F.transform(ordered, lambda x: F.struct(F.lit("t3").alias("kind"), x["data"].alias("data")))
        .alias("children")).alias("data")))
    docs = c.groupBy("dump").agg(listing.alias("value"))
    if repeat_first:
        docs = docs.unionByName(docs.where("dump = 0").withColumn("dump", F.lit(-1).cast("long")))
    # a broken file, one without posts and one whose top level is an array ride on one existing event row (a pushed-down filter, no aggregate)
    extra = (c.where(F.col("event_id") == 0).select(
        F.explode(F.array(F.struct(F.lit(-2).cast("long").alias("dump"), F.lit('{"data": {"children": [{"data": ').alias("value")),
                          F.struct(F.lit(-3).cast("long").alias("dump"), F.lit('{"kind": "Listing", "other": 1}').alias("value")),
                          F.struct(F.lit(-4).cast("long").alias("dump"), F.lit('[{"data": {"children": [{"data": {"id": "x"}}]}}]').alias("value"))))
        .alias("x")).select("x.dump", "x.value"))
    return docs.unionByName(extra)


# ------------------------------------------------------------------ CSV

CSV_BLOCK = 250  # customers per rendered CSV file
CUSTOMER_COLUMNS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def write_customer_csv(spark: SparkSession, sf_dir: str) -> str:
    """Render ``customer`` as CSV text with faults by key modulus: short rows (11), long rows (13),
    quoted multi-line names (17), doubled quotes (23), blank lines (19), padded fields (29).
    By file: the columns in order, in reverse order, or with a further column in front."""
    from ..session import scratch_path
    root = scratch_path(spark, "customer_csv")
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    name = (F.when(k % 17 == 0, F.concat(F.lit('"'), F.col("c_name"), F.lit('\nsecond line"')))
            .when(k % 23 == 0, F.concat(F.lit('"'), F.col("c_name"), F.lit(' ""q"""')))
            .otherwise(F.col("c_name")))
    key = F.when(k % 29 == 0, F.concat(F.lit("  "), _s(k), F.lit(" "))).otherwise(_s(k))
    bucket = F.expr(f"c_custkey div {CSV_BLOCK}")
    cells = [key, name, _s(F.col("c_nationkey")), _s(F.col("c_acctbal")), F.col("c_mktsegment")]

    def by_layout(b: Column, plain: list, reverse: list, more: list) -> Column:
        return (F.when(b % 3 == 0, F.concat_ws(",", *plain)).when(b % 3 == 1, F.concat_ws(",", *reverse))
                .otherwise(F.concat_ws(",", *more)))

    full = by_layout(bucket, cells, cells[::-1], [F.lit("n"), *cells])
    short = by_layout(bucket, cells[:-1], cells[:0:-1], [F.lit("n"), *cells[:-1]])
    line = F.when(k % 11 == 0, short).when(k % 13 == 0, F.concat(full, F.lit(",x"))).otherwise(full)
    line = F.when(k % 19 == 0, F.concat(line, F.lit("\n"))).otherwise(line)
    rows = c.select(bucket.alias("bucket"), k.alias("ord"), line.alias("value"))
    header = rows.select("bucket").distinct().select(
        "bucket", F.lit(-1).cast("long").alias("ord"),
        by_layout(F.col("bucket"), *[[F.lit(n) for n in names] for names in (
            CUSTOMER_COLUMNS, CUSTOMER_COLUMNS[::-1], ["note", *CUSTOMER_COLUMNS])]).alias("value"))
    (rows.unionByName(header).repartition("bucket").sortWithinPartitions("bucket", "ord")
     .select("bucket", "value").write.partitionBy("bucket").text(root))
    return root
