"""Documents to packed training sequences: quality, line dedup, near-dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's documents. All but the last return the columns of ``documents``; the last
returns one row per packed piece. Every stage works on all that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from prodlink.llm.common import stored, table
from prodlink.llm.decontaminate import decontamination_stage
from prodlink.llm.grouppack import packing_stage
from prodlink.llm.linejoin import line_dedup_stage
from prodlink.llm.neardup import near_dedup_stage
from prodlink.llm.subword import quality_stage

STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

# SQL expresses neither the classifier nor the packing; tests/llm/test_pipeline.py compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
