"""Operator 8 - chat formatting by multi-party perspective rotation.

Every participant of a conversation (each speaker but ``system``) gets the dialogue from their own
side: their turns as ``assistant``, all others as ``user`` with the speaker's name, system turns
as they are. The mask names the character ranges to learn from: text and end mark of the
participant's own turns.

A dialogue is rendered in parts of ``PART_TURNS`` turn numbers, so that a conversation of any
length stays a set of bounded rows; parts joined in order of (part, sub) are the whole dialogue, and each
part's mask counts from the part's first character. Should more than ``PART_ROWS`` rows share
one part (turn numbers that repeat), it is cut in its order into pieces of so many rows (``sub``, from 0).

Edge cases: turns come in the order of their number, then speaker, then text; a null number
comes last (part -1); a null speaker is called ``unknown``, a null text is empty; repeated rows
(all four columns) count once; a null conv_id is a conversation of its own; markers inside texts are
broken up (``<|`` becomes ``< |``); names are written with ``_`` for anything but letters a-z, digits, ``-``;
a conversation of system turns alone has no participant and no row; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import long_id, plain_id, stored, table

PART_TURNS = 512
PART_ROWS = 4096
SYSTEM = "system"

# The marks of the chat format.
START, END = "<|im_start|>", "<|im_end|>\n"


def _part(turn: Column) -> Column:
    return F.coalesce(F.floor(turn / PART_TURNS), F.lit(-1)).cast("long")


def _head(role: Column, perspective: Column) -> Column:
    name = F.regexp_replace(role, "[^A-Za-z0-9-]", "_")
    return F.concat(F.lit(START), F.when(role == SYSTEM, F.lit("system\n"))
                    .when(role == perspective, F.lit("assistant\n"))
                    .otherwise(F.concat(F.lit("user name="), name, F.lit("\n"))))


def _ranges(turns: DataFrame) -> DataFrame:
    """Rows of crowded parts with ``sub``: their place in the part's order, by the PART_ROWS.

    The rows are sorted over all tasks, so a part of any size is spread; a row's place is its place in its
    task and the rows of its part in the tasks before. The sorted table is stored, as places must not change.
    """
    order = ["conv", "part", F.col("turn").asc_nulls_last(), "role", "body"]
    placed = stored(turns.repartitionByRange(*order).sortWithinPartitions(*order)
                    .withColumn("_at", F.monotonically_increasing_id()), "crowded-parts")
    task = F.shiftrightunsigned("_at", 33)
    runs = placed.groupBy("conv", "part", task.alias("_task")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("conv", "part").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)  # a row per task
    runs = runs.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    return (placed.withColumn("_task", task).join(runs, ["conv", "part", "_task"])
            .withColumn("sub", F.floor((F.col("_at") - F.col("_first") + F.col("_before")) / PART_ROWS).cast("long"))
            .select(*turns.columns, "sub"))


def rotate(conversations: DataFrame) -> DataFrame:
    """One row per conversation, participant and part: conv_id, perspective, part, sub, n_turns, text,
    mask (array of [begin, end) character ranges)."""
    turns = (conversations.select(long_id("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"),
                                  F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("role"),
                                  F.replace(F.coalesce(F.col("text").cast("string"), F.lit("")),
                                            F.lit("<|"), F.lit("< |")).alias("body"))
             .distinct().withColumn("part", _part(F.col("turn"))))
    rows = turns.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("rows"))
    crowded = rows.filter(F.col("rows") > PART_ROWS).select("conv", "part")
    plain = turns.join(crowded, ["conv", "part"], "left_anti").withColumn("sub", F.lit(0).cast("long"))
    parts = (plain.unionByName(_ranges(turns.join(crowded, ["conv", "part"], "left_semi")))
             .groupBy("conv", "part", "sub")
             .agg(F.array_sort(F.collect_list(F.struct(F.col("turn").isNull().alias("late"), "turn", "role", "body"))).alias("said")))
    speakers = turns.filter(F.col("role") != SYSTEM).select("conv", F.col("role").alias("perspective")).distinct()
    who = F.col("perspective")
    pieces = parts.join(speakers, "conv").withColumn("pieces", F.transform("said", lambda s: F.struct(
        _head(s["role"], who).alias("head"), F.concat(s["body"], F.lit(END)).alias("tail"),
        ((s["role"] == who) & (s["role"] != SYSTEM)).alias("own"))))
    begin = F.struct(F.lit(0).cast("long").alias("at"),
                     F.array().cast("array<struct<begin:bigint,end:bigint>>").alias("mask"))

    def step(done: Column, p: Column) -> Column:
        a = done["at"] + F.length(p["head"])
        b = a + F.length(p["tail"])
        span = F.struct(a.alias("begin"), b.alias("end"))
        return F.struct(b.alias("at"), F.when(p["own"], F.concat(done["mask"], F.array(span)))
                        .otherwise(done["mask"]).alias("mask"))

    return pieces.select(
        plain_id("conv").alias("conv_id"), "perspective", "part", "sub", F.size("said").cast("long").alias("n_turns"),
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["tail"])), "").alias("text"),
        F.aggregate("pieces", begin, step, lambda done: done["mask"]).alias("mask"))


def op8_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mask as text, ``begin-end`` ranges joined by commas."""
    spans = F.transform("mask", lambda m: F.concat_ws("-", m["begin"].cast("string"), m["end"].cast("string")))
    return (rotate(table(spark, sf_dir, "conversations"))
            .select("conv_id", "perspective", "part", "sub", "n_turns", "text", F.array_join(spans, ",").alias("mask"),
                    F.aggregate("mask", F.lit(0).cast("long"), lambda n, m: n + m["end"] - m["begin"])
                    .alias("n_masked")))


OP8_SQL = f"""
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role,
                  replace(coalesce(text, ''), '<|', '< |') || '<|im_end|>' || chr(10) AS tail,
                  coalesce(turn // {PART_TURNS}, -1) AS part
           FROM conversations),
     cut AS (SELECT *, (row_number() OVER (PARTITION BY conv_id, part ORDER BY turn NULLS LAST, role, tail) - 1) // {PART_ROWS} AS sub FROM t),
     who AS (SELECT DISTINCT conv_id, role AS perspective FROM t WHERE role <> 'system'),
     seg AS (SELECT cut.*, perspective, role = perspective AS own,
                    '<|im_start|>' || CASE WHEN role = 'system' THEN 'system' WHEN role = perspective THEN 'assistant'
                        ELSE 'user name=' || regexp_replace(role, '[^A-Za-z0-9-]', '_', 'g') END || chr(10) AS head
             FROM cut JOIN who ON cut.conv_id IS NOT DISTINCT FROM who.conv_id),
     pos AS (SELECT *, sum(length(head) + length(tail)) OVER (PARTITION BY conv_id, perspective, part, sub
                        ORDER BY turn NULLS LAST, role, tail ROWS UNBOUNDED PRECEDING) AS stop FROM seg)
SELECT conv_id, perspective, CAST(part AS BIGINT) AS part, CAST(sub AS BIGINT) AS sub, count(*) AS n_turns,
       string_agg(head || tail, '' ORDER BY stop) AS text,
       coalesce(string_agg((stop - length(tail)) || '-' || stop, ',' ORDER BY stop) FILTER (own), '') AS mask,
       CAST(coalesce(sum(length(tail)) FILTER (own), 0) AS BIGINT) AS n_masked
FROM pos GROUP BY ALL
"""
