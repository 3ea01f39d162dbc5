"""prodlink: product-report linking on Spark.

Stage functions (all lazy ``DataFrame -> DataFrame``):

* ``read_listing_text`` / ``build_catalog``        listing folders -> catalog
* ``read_listing_dumps`` / ``build_posts``         JSON dumps -> posts
* ``match_posts``                                  posts x catalog -> one link per post
* ``enrich_join`` / ``validate_records``           linked posts -> combined records
* ``run_folders``                                  the four stages folder to folder
"""

from .cli import run_folders
from .operators.enrich import enrich_join, filter_matched, validate_records
from .operators.extract import build_catalog, build_catalog_from_records
from .operators.link import detect_labels, match_posts
from .operators.posts import build_posts
from .sources.json_dump import read_listing_dumps
from .sources.listing import read_listing_records, read_listing_text

__all__ = ["build_catalog", "build_catalog_from_records", "build_posts", "detect_labels", "enrich_join",
           "filter_matched", "match_posts", "read_listing_dumps", "read_listing_records",
           "read_listing_text", "run_folders", "validate_records"]
