"""Stage 2: dump children -> posts table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import epoch_to_iso, js_trim, text_preview

# Fixed value: the flair the source keeps.
DEFAULT_FLAIR = "Quality Issues"

# Column titles of the posts export.
POSTS_CSV_COLUMNS = [("id", "Post ID"), ("title", "Title"), ("author", "Author"), ("flair", "Flair"),
                     ("created_date", "Created Date"), ("preview", "Text (Preview)"),
                     ("permalink", "Permalink"), ("url", "URL")]


def filter_flair(children: DataFrame, flair: str = DEFAULT_FLAIR) -> DataFrame:
    """Keep posts whose trimmed flair equals ``flair`` (case-sensitive); no flair -> dropped."""
    return children.where(js_trim(F.col("post.link_flair_text")) == F.lit(flair))


def _or_default(c: Column, default) -> Column:
    """JS ``x || default``: null and '' (or 0 / false) fall back."""
    if isinstance(default, str):
        return F.when(F.coalesce(c, F.lit("")) == "", F.lit(default)).otherwise(c)
    return F.when(F.coalesce(c, F.lit(default)) == F.lit(default), F.lit(default)).otherwise(c)


def project_posts(children: DataFrame, preview_chars: int = 500) -> DataFrame:
    """Flatten with per-field defaults; ISO date; the whole body, and a newline-free preview for the export."""
    p = lambda f: F.col(f"post.{f}")
    created = F.coalesce(p("created_utc"), F.lit(0.0))
    return children.select(
        "path", "pos",
        _or_default(p("id"), "").alias("id"),
        _or_default(p("title"), "").alias("title"),
        _or_default(p("author"), "").alias("author"),
        _or_default(p("link_flair_text"), "No Flair").alias("flair"),
        created.alias("created_utc"),
        epoch_to_iso(created).alias("created_date"),
        _or_default(p("selftext"), "").alias("selftext"),
        text_preview(p("selftext"), preview_chars).alias("preview"),
        _or_default(p("permalink"), "").alias("permalink"),
        _or_default(p("url"), "").alias("url"),
        F.coalesce(p("is_video"), F.lit(False)).alias("is_video"),
        _or_default(p("thumbnail"), "").alias("thumbnail"))


def build_posts(children: DataFrame, flair: str = DEFAULT_FLAIR) -> DataFrame:
    return project_posts(filter_flair(children, flair))


def post_identity(post_id: Column) -> Column:
    """What makes two posts the same: the id; a post without one is only itself (file and place)."""
    own = F.concat_ws(":", F.col("path"), F.col("pos").cast("string"))
    return F.when(F.coalesce(post_id, F.lit("")) != "", F.struct(F.lit("id").alias("by"), post_id.alias("value"))) \
        .otherwise(F.struct(F.lit("place").alias("by"), own.alias("value")))


def distinct_posts(children: DataFrame, post_id: str = "post.id") -> DataFrame:
    """Each post once, as it stands first by (path, pos): listings collected on several days repeat posts.

    An option: the source keeps every copy. Copies meet within a task before the shuffle, so a post that is in every
    dump does not gather its copies in one task.
    """
    first = children.groupBy(post_identity(F.col(post_id)).alias("identity")).agg(
        F.min_by(F.struct(*children.columns), F.struct("path", "pos")).alias("row"))
    return first.select("row.*")


def posts_csv_frame(posts: DataFrame) -> DataFrame:
    """The 8 written columns under their CSV titles."""
    return posts.select(*[F.col(c).alias(t) for c, t in POSTS_CSV_COLUMNS])


def count_flair(children: DataFrame, flair: str = DEFAULT_FLAIR) -> DataFrame:
    """Per dump file: posts and posts carrying the flair."""
    hit = F.coalesce(js_trim(F.col("post.link_flair_text")) == F.lit(flair), F.lit(False))
    return children.groupBy("path").agg(F.count(F.lit(1)).alias("posts"), F.count_if(hit).alias("flair_posts"))
