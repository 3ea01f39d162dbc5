"""Catalog-side set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_catalogs(catalogs: list[DataFrame], ord_col: str = "cat_ord") -> DataFrame:
    """UNION ALL of vendor catalogs, tagging each with its position ``src_ord``.

    The catalog order used for tie-breaking is ``link_ord``, the struct (src_ord, ord_col);
    ``ord_col`` may be any orderable type, the same in all catalogs.
    """
    tagged = [c.withColumn("src_ord", F.lit(i)) for i, c in enumerate(catalogs)]
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    return out.withColumn("link_ord", F.struct("src_ord", F.col(ord_col).alias("ord")))
