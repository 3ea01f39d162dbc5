"""Connected components of a link table by union-find on Spark: bounded state in every task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, stored

LINKS_AT_ONCE = 1 << 20   # links that one union-find of a task holds


def local_forest(links: DataFrame) -> DataFrame:
    """Union-find inside each task: its links replaced by (node, smallest node it is joined to)."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (p := parent.setdefault(x, x)) != x:
                parent[x] = x = parent.setdefault(p, p)
            return x

        def forest() -> Iterator[pa.RecordBatch]:
            nodes = np.fromiter(parent, np.int64, len(parent))
            roots = np.array([root(x) for x in nodes.tolist()], np.int64)
            own = nodes != roots
            yield pa.RecordBatch.from_arrays([pa.array(nodes[own]), pa.array(roots[own])], names=["a", "b"])

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                x, y = root(a), root(b)
                if x != y:
                    parent[max(x, y)] = min(x, y)
            if len(parent) > LINKS_AT_ONCE:
                yield from forest()
                parent.clear()
        if parent:
            yield from forest()

    return map_arrow(links.select("a", "b"), run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node with a link; component is the smallest node reachable.

    ``links`` has long columns a and b. Rounds of hooking: every node points to its smallest
    neighbour, its other smaller neighbours are linked to that one; done when each node points to one
    neighbour only. Then pointers are doubled until they end at roots. Every round is stored.
    """
    greater, smaller = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    edges = stored(local_forest(links).select(greater, smaller).filter("a <> b").distinct(), "links")
    while True:
        least = edges.groupBy("a").agg(F.min("b").alias("p"))
        total, nodes = edges.count(), least.count()
        if total == nodes:
            break
        moved = (edges.join(least, "a")
                 .select(F.explode(F.array(F.struct("a", F.col("p").alias("b")),
                                           F.struct(F.greatest("b", "p").alias("a"), F.least("b", "p").alias("b")))).alias("e"))
                 .select("e.*").filter("a <> b"))
        edges = stored(local_forest(moved).distinct(), "links")
    pointers = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    while True:
        up = pointers.select(F.col("node").alias("component"), F.col("component").alias("next"))
        if pointers.join(up, "component", "left_semi").isEmpty():
            return pointers
        pointers = stored(pointers.join(up, "component", "left")
                          .select("node", F.coalesce("next", "component").alias("component")), "pointers")
