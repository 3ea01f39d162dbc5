"""Counts and reports: small aggregates over stage outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F


def count_matches(matches: DataFrame) -> DataFrame:
    matched = F.col("figure_name") != ""
    return matches.agg(F.count_if(matched).alias("matched"), F.count_if(~matched).alias("unmatched"))


def count_enriched(combined: DataFrame) -> DataFrame:
    return combined.agg(F.count_if(F.col("found")).alias("found_in_catalog"),
                        F.count_if(~F.col("found")).alias("missing_from_catalog"))


class StageCounts:
    """Counts of stages, taken by ``observe`` while their rows pass by: no stage is computed for its count.

    ``watch`` a table under a name, run one write (or any action) over what is made of it, then read ``values`` or ``table``.
    A stage that the action had no need of (what it was joined with was empty) is counted by itself.
    """

    def __init__(self) -> None:
        self._seen: dict[str, tuple[Observation, DataFrame, list[Column]]] = {}

    def watch(self, df: DataFrame, name: str, **counts: Column) -> DataFrame:
        """``df`` with its rows counted as ``name`` and, under their names, the rows that meet the conditions ``counts``."""
        exprs = [F.count(F.lit(1)).alias(name), *[F.count_if(c).alias(n) for n, c in counts.items()]]
        self._seen[name] = Observation(name), df, exprs
        return df.observe(self._seen[name][0], *exprs)

    def values(self) -> dict[str, int]:
        """stage -> count; waits for the actions that the watched tables are part of."""
        out = {}
        for seen, df, exprs in self._seen.values():
            out |= seen.get if seen._jo.getRow().length() else df.agg(*exprs).first().asDict()
        return out

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.values().items()), "stage string, n long")


def count_errors(errors: DataFrame) -> DataFrame:
    """Total messages, records with at least one (each has one message of order 0), and the pass verdict."""
    return errors.agg(F.count(F.lit(1)).alias("total_errors"),
                      F.count_if(F.col("err_ord") == 0).alias("records_with_errors"),
                      (F.count(F.lit(1)) == 0).alias("passed"))


def top_errors(errors: DataFrame, n: int = 10, key: str = "post_id") -> DataFrame:
    """First ``n`` messages by (key, err_ord) plus how many more there are; the limit is the feature.

    One pass: every task hands on its own first ``n`` rows only (a rank filter that Spark limits before the shuffle),
    and the total is observed on the way. The ``n`` rows of the report are fetched here.
    """
    counts = StageCounts()
    rank = F.row_number().over(Window.orderBy(key, "err_ord"))
    head = counts.watch(errors.select(key, "err_ord", "message"), "errors").withColumn("rank", rank).where(F.col("rank") <= n)
    rows = head.drop("rank").collect()
    more = max(counts.values()["errors"] - n, 0) if rows else 0
    return errors.sparkSession.createDataFrame(rows, errors.select(key, "err_ord", "message").schema) \
        .withColumn("more", F.lit(more).cast("long"))


def accuracy_by_category(outcomes: DataFrame, category: str = "category") -> DataFrame:
    """Count and percent of total per outcome category.

    The window over ``()`` runs on the already-aggregated rows (one per
    category), never on the outcome rows themselves.
    """
    counts = outcomes.groupBy(category).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(category, "n", (F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy())).alias("pct"))


def accuracy_rollup(outcomes: DataFrame, schemes: tuple[str, ...], category: str = "category") -> DataFrame:
    """Categories merged into coarser classes in several ways at once, with percent of total.

    ``schemes`` names class columns; the classes of one scheme may cut across another's. For each scheme there are rows per
    (class, category) and per class, and one row for all. ``level`` is the grouping id over (schemes..., category):
    a bit is set where the column is not grouped by, which tells a total from a row whose value is null.
    """
    sets = [x for s in schemes for x in ([s, category], [s])] + [[]]
    grouped = outcomes.groupingSets(sets, *schemes, category).agg(
        F.count(F.lit(1)).alias("n"), F.grouping_id(*schemes, category).cast("int").alias("level"))
    every = (1 << (len(schemes) + 1)) - 1
    total = F.max(F.when(F.col("level") == every, F.col("n"))).over(Window.partitionBy())
    return grouped.select(*schemes, category, "level", "n", (F.col("n") * 100.0 / total).alias("pct"))
