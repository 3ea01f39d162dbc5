"""Stage 4: enrich linked posts from the catalog, validate, shape the combined table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import age_bucket, clean_text, extract_scale, labels_to_json

# Fixed values of the combined record.
DEFAULT_SELLER = "AmiAmi"
MODES = ["fix", "data"]
COMBINED_COLUMNS = ["mode", "figure_name", "brand", "product_line", "series_title", "sculptor",
                    "scale", "materials", "seller", "age", "authenticity", "issues",
                    "issue_description"]


def filter_matched(matches: DataFrame) -> DataFrame:
    """Posts that were linked: non-empty name and brand."""
    return matches.where((F.coalesce(F.col("figure_name"), F.lit("")) != "")
                         & (F.coalesce(F.col("brand"), F.lit("")) != ""))


def _key(name: Column, brand: Column) -> list[Column]:
    return [F.lower(name).alias("k_name"), F.lower(brand).alias("k_brand")]


def dedupe_last(catalog: DataFrame, ord_col: str = "cat_ord") -> DataFrame:
    """Last catalog row per (lower(name), lower(brand)) by ordinal wins.

    One row per key survives; the aggregate is partial map-side, so a key
    holding many rows never gathers them in one task.
    """
    keyed = catalog.select(*_key(F.col("name"), F.col("brand")), F.struct("*").alias("row"))
    return (keyed.groupBy("k_name", "k_brand")
            .agg(F.max_by("row", F.col(f"row.{ord_col}")).alias("row"))
            .select("k_name", "k_brand", "row.*"))


def enrich_join(matched: DataFrame, catalog: DataFrame, as_of_year: int,
                seller: str = DEFAULT_SELLER, ord_col: str = "cat_ord",
                key: str = "post_id") -> DataFrame:
    """Left join linked posts with the last-wins catalog; full record when found,
    minimal record otherwise. ``as_of_year`` replaces the wall clock.

    Adaptive execution knows the exact size of the deduplicated catalog from its shuffle and
    decides between broadcast, sort-merge and split skewed partitions; building the plan runs no job."""
    return enrich_last(matched, dedupe_last(catalog, ord_col), as_of_year, seller, key)


def enrich_last(matched: DataFrame, last: DataFrame, as_of_year: int, seller: str = DEFAULT_SELLER,
                key: str = "post_id") -> DataFrame:
    """``enrich_join`` with a catalog that holds each key once (``dedupe_last``, ``snapshot.read_snapshot``)."""
    last = last.select(
        "k_name", "k_brand", F.lit(True).alias("found"),
        F.col("name").alias("c_name"), F.col("brand").alias("c_brand"),
        F.col("product_line").alias("c_line"), F.col("series_title").alias("c_series"),
        F.col("sculptor").alias("c_sculptor"), F.col("material").alias("c_material"),
        F.col("spec").alias("c_spec"), F.col("release_date").alias("c_release"))
    left = matched.select(key, *_key(F.col("figure_name"), F.col("brand")), "figure_name", "brand",
                          "product_line", "detected_issues", "reddit_permalink")
    j = left.join(last, ["k_name", "k_brand"], "left")
    found = F.coalesce(F.col("found"), F.lit(False))
    null = F.lit(None).cast("string")

    def pick(full: Column, minimal: Column) -> Column:
        return F.when(found, full).otherwise(minimal)

    link = F.coalesce(F.col("reddit_permalink"), F.lit(""))
    return j.select(
        key, found.alias("found"),
        F.lit("data").alias("mode"),
        pick(clean_text(F.col("c_name")), F.col("figure_name")).alias("figure_name"),
        pick(clean_text(F.col("c_brand")), F.col("brand")).alias("brand"),
        pick(clean_text(F.col("c_line")), F.col("product_line")).alias("product_line"),
        pick(clean_text(F.col("c_series")), null).alias("series_title"),
        pick(clean_text(F.col("c_sculptor")), null).alias("sculptor"),
        pick(extract_scale(F.col("c_spec")), null).alias("scale"),
        pick(clean_text(F.col("c_material")), null).alias("materials"),
        pick(F.lit(seller), null).alias("seller"),
        pick(age_bucket(F.col("c_release"), as_of_year), F.lit("Unknown")).alias("age"),
        F.lit("true").alias("authenticity"),
        labels_to_json(F.col("detected_issues")).alias("issues"),
        F.when(link != "", F.concat(F.lit("Reddit report: "), link)).otherwise(null)
        .alias("issue_description"))


def enrich_split(matched: DataFrame, catalog: DataFrame, how: str) -> DataFrame:
    """``left_semi``: linked posts found in the catalog; ``left_anti``: missing."""
    keys = catalog.select(*_key(F.col("name"), F.col("brand"))).distinct()
    left = matched.select("*", *_key(F.col("figure_name"), F.col("brand")))
    return left.join(keys, ["k_name", "k_brand"], how).drop("k_name", "k_brand")


# ------------------------------------------------------------------ validation

def validation_errors(rec: DataFrame, key: str = "post_id") -> Column:
    """Messages for one combined record, in the source's check order."""
    row = F.concat(F.lit("Row "), F.col(key).cast("string"), F.lit(": "))
    issues = F.col("issues")
    has_issues = issues.isNotNull() & (issues != "")
    parsed = F.try_parse_json(issues)
    is_array = F.schema_of_variant(parsed).startswith("ARRAY")
    # The five message texts.
    checks = [
        (F.coalesce(F.col("figure_name"), F.lit("")) == "", "Missing figure_name"),
        (F.coalesce(F.col("brand"), F.lit("")) == "", "Missing brand"),
        (~F.coalesce(F.col("mode").isin(*MODES), F.lit(False)), "Invalid mode (must be 'fix' or 'data')"),
        (has_issues & parsed.isNull(), "Invalid JSON in issues field"),
        (has_issues & parsed.isNotNull() & ~is_array, "issues must be a JSON array"),
    ]
    return F.array_compact(F.array(*[F.when(c, F.concat(row, F.lit(m))) for c, m in checks]))


def validate_records(combined: DataFrame, key: str = "post_id") -> DataFrame:
    """One row per message: (key, err_ord, message). Non-blocking, like the source."""
    return combined.select(key, F.posexplode(validation_errors(combined, key)).alias("err_ord", "message"))
