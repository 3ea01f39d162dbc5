"""Folder-to-folder run of the four stages (what a user of the source runs today).

    python -m prodlink.cli --listings DIR --dumps DIR --out DIR [--catalog-csv FILE ...]
                           [--flair "Quality Issues"] [--as-of-year 2026] [--run-date 2026-04-12] [--distinct-posts]

Writes ``out/catalog`` (one folder per source), ``out/posts``, ``out/matches``
and ``out/combined/run_date=...`` as CSV with headers. Stages are chained as
DataFrames; the CSVs are exports, not hand-offs.
"""

from __future__ import annotations

import argparse
import datetime as dt
import os

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import enrich as N
from .operators import extract as X
from .operators import link as L
from .operators import posts as P
from .operators.catalog import union_catalogs
from .operators import report as R
from .session import scratch_path
from .sources import csv_lenient as SC
from .sources.json_dump import POST_FIELDS, read_listing_dumps
from .sources.listing import read_listing_records


def run_folders(spark: SparkSession, listings: str | None, dumps: str, out: str,
                catalog_csvs: list[str] | None = None, flair: str = P.DEFAULT_FLAIR,
                as_of_year: int | None = None, run_date: str | None = None,
                rate: float = X.JPY_TO_USD, seller: str = N.DEFAULT_SELLER,
                label_patterns: dict[str, str] | None = None,
                listing_pattern: str = "*/raw.txt", distinct_posts: bool = False) -> dict[str, int | bool]:
    """Run catalog -> posts -> matches -> combined; returns the counts of the stages, observed as they are stored.
    With ``distinct_posts`` a post that several dumps hold counts once.

    Next to the four exports, ``reports/run_date=*/`` holds the counts per source and per dump file and the
    validation report. An absent or unreadable input counts as empty, and a stage without rows
    writes nothing. Stages are stored once (Parquet under the shared folder) and read from there, so
    every dump is parsed and linked once.
    """
    today = dt.date.today()
    as_of_year = as_of_year or today.year
    run_date = run_date or today.isoformat()

    counts = R.StageCounts()

    def kept(df: DataFrame, name: str, **more: Column) -> DataFrame:
        path = scratch_path(spark, name)
        counts.watch(df, name, **more).write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    vendors: list[DataFrame] = []
    if listings:
        parsed = kept(X.parse_records(_listings(spark, listings, listing_pattern), rate), "sections")
        sections = X.count_parsed(parsed)
        catalog = X.catalog_of(parsed)
        SC.write_stage_csv(catalog.drop("pos"), os.path.join(out, "catalog"), ["source"])
        # catalog order: vendor folders by name, then the place in the file
        vendors.append(catalog.withColumn("cat_ord", F.struct("source", "pos.path", "pos.block", "pos.n", "pos.part")).drop("pos"))
    for path in catalog_csvs or []:
        rows = SC.read_csv_lenient(spark, path, X.CATALOG_COLUMNS, ordinal="pos")
        vendors.append(rows.withColumn("cat_ord", F.struct(
            F.lit("").alias("source"), "path", F.lit(0).cast("long").alias("block"), F.col("pos").alias("n"),
            F.lit(0).alias("part"))).drop("path", "pos"))
    if not vendors:
        raise ValueError("no catalog: give listing folders or catalog CSVs")
    merged = kept(union_catalogs(vendors), "catalog")

    children = kept(_or_none(spark, dumps), "children")
    if distinct_posts:
        children = kept(P.distinct_posts(children), "distinct")
    posts = kept(P.build_posts(children, flair).withColumn(
        "post_key", F.concat_ws(":", "path", F.col("pos").cast("string"))), "posts")
    SC.write_stage_csv(P.posts_csv_frame(posts), os.path.join(out, "posts"))

    matches = kept(L.match_posts(posts, merged, key="post_key", created="created_date",
                                 ord_col="link_ord", label_patterns=label_patterns), "matches",
                   matched=F.col("figure_name") != "", unmatched=F.col("figure_name") == "")
    SC.write_stage_csv(matches, os.path.join(out, "matches"))

    combined = kept(N.enrich_join(N.filter_matched(matches), merged, as_of_year, seller=seller,
                                  ord_col="link_ord", key="post_key"), "combined",
                    found_in_catalog=F.col("found"), missing_from_catalog=~F.col("found"))
    SC.write_stage_csv(combined.select("post_key", *N.COMBINED_COLUMNS).withColumn("run_date", F.lit(run_date)),
                       os.path.join(out, "combined"), ["run_date"])
    errors = kept(N.validate_records(combined, key="post_key"), "errors")

    reports = os.path.join(out, "reports", f"run_date={run_date}")
    source = F.coalesce("source", F.lit("")) if "source" in merged.columns else F.lit("")
    per_source = merged.groupBy(source.alias("source")).agg(F.count(F.lit(1)).alias("products"))
    if listings:  # sections, parsed and kept come from the listing sources alone
        per_source = per_source.join(sections, "source", "full").na.fill(0, ["products"])
    SC.write_stage_csv(per_source, f"{reports}/sources")
    SC.write_stage_csv(P.count_flair(children, flair), f"{reports}/dumps")
    SC.write_stage_csv(R.top_errors(errors, key="post_key"), f"{reports}/validation")

    result = counts.values()
    return result | {"passed": result["errors"] == 0}


def _listings(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """The listings' records; none where the path is absent."""
    try:
        return read_listing_records(spark, root, pattern)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "source string, path string, block long, n long, section string")


def _or_none(spark: SparkSession, dumps: str) -> DataFrame:
    """The dumps' children; none where the path is absent."""
    try:
        return read_listing_dumps(spark, dumps)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        schema = f"path string, pos int, post {POST_FIELDS.simpleString()}"
        return spark.createDataFrame([], schema)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("--listings")
    ap.add_argument("--dumps", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--catalog-csv", action="append", default=[])
    ap.add_argument("--flair", default=P.DEFAULT_FLAIR)
    ap.add_argument("--as-of-year", type=int)
    ap.add_argument("--run-date")
    ap.add_argument("--distinct-posts", action="store_true")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("prodlink").getOrCreate()
    print(run_folders(spark, a.listings, a.dumps, a.out, a.catalog_csv, a.flair, a.as_of_year, a.run_date,
                      distinct_posts=a.distinct_posts))


if __name__ == "__main__":
    main()
