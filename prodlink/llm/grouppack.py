"""Operator 3 - best-fit packing by a grouping genetic algorithm on islands.

Every document is encoded in place (its text is never shuffled) and cut into pieces of at most
``CAPACITY`` ids; full pieces are sequences of their own. The other pieces, slim rows, are
dealt into instances of about ``INSTANCE`` pieces. Each instance is evolved on ``ISLANDS``
islands, one Spark group each: individuals are groupings of pieces into bins; crossover
injects the well-filled bins of one parent into the other, removes the bins that now hold a
piece twice, and best-fits the displaced pieces, longest first; mutation empties the worst
bins in the same way. After each epoch every island's elite moves on to the next island
(as rows, through the shuffle). The best grouping of an instance over its islands wins.

Bins that stay under ``SETTLED`` of the capacity are opened again, and their pieces from all
instances are dealt into fewer instances, until one instance is left; so the loss is that of one
instance rather than of each. An instance stops as soon as it uses the least possible number of bins.

Groups are dealt by a hash of the piece's row, hence about INSTANCE rows whatever the data. An
instance holds no text, so its memory is bounded too.

Edge cases: null text counts as empty, and an empty document is one piece holding the end id
alone; a null doc_id keeps its rows; repeated rows are packed each; extra columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import long_id, map_arrow, plain_id, ship, small_batches, stored, table, utf8_slices, whole_text
from .tokenids import with_end, word_bpe

CAPACITY = 2048
END_ID = 0
INSTANCE = 4096      # pieces evolved together, on average
ISLANDS = 2          # populations per instance
EPOCHS = 2           # evolutions between which elites migrate
POPULATION = 4
GENERATIONS = 4
SETTLED = 0.985      # a bin filled at least so far is not opened again
ROUNDS = 6           # dealings at most; the last one is one instance if the loop has come so far
WELL_FILLED = 0.97   # bins that crossover injects
SLICE = 1 << 20

PIECES = "id long, piece int, start long, length long, ids_crc32 long"


def pieces_of(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, tokenizer: str | None = None) -> DataFrame:
    """One row per piece of every document: id, piece, start, length, ids_crc32."""

    def cut(batches) -> Iterator[pa.RecordBatch]:
        encode = word_bpe(tokenizer)
        for batch in batches:
            owner = batch.column(0).to_numpy()
            for i, j, raw, off in utf8_slices(batch.column(1), SLICE):
                ids, at = with_end(*encode(raw, off), end_id)
                ids = ids.astype("<u4")
                size = np.diff(at)
                number = -(-size // capacity)
                doc = np.repeat(np.arange(j - i), number)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(number) - number, number)
                start = piece * capacity
                length = np.minimum(size[doc] - start, capacity)
                begin = at[doc] + start
                yield pa.RecordBatch.from_arrays(
                    [pa.array(owner[i:j][doc], pa.int64()), pa.array(piece.astype(np.int32)), pa.array(start),
                     pa.array(length), pa.array([zlib.crc32(ids[a:a + n]) for a, n in zip(begin, length)], pa.int64())],
                    names=["id", "piece", "start", "length", "ids_crc32"])

    return map_arrow(docs.select(long_id().alias("id"), whole_text().alias("t")), cut, PIECES)


# ---- one instance -----------------------------------------------------------------------

def best_fit(order, length: list[int], room: list[int], bins: list[list[int]], capacity: int) -> None:
    """Put the pieces of ``order`` each into the fullest bin that takes it, or a new one. Extends ``bins``."""
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    for b, r in enumerate(room):
        free[r].append(b)
        mask |= 1 << r
    for p in order:
        n = length[p]
        above = mask >> n
        if above:
            r = n + (above & -above).bit_length() - 1
            b = free[r].pop()
            if not free[r]:
                mask ^= 1 << r
            bins[b].append(p)
        else:
            r, b = capacity, len(bins)
            bins.append([p])
            room.append(0)
        left = r - n
        room[b] = left
        free[left].append(b)
        mask |= 1 << left


def fitness(bins: list[list[int]], length: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins first, then unevenly filled bins (full ones, and room in few places)."""
    return -len(bins), sum((sum(length[p] for p in b) / capacity) ** 2 for b in bins)


def _refill(kept: list[list[int]], loose: list[int], length: list[int], capacity: int) -> list[list[int]]:
    bins = [list(b) for b in kept]
    room = [capacity - sum(length[p] for p in b) for b in bins]
    best_fit(sorted(loose, key=lambda p: -length[p]), length, room, bins, capacity)
    return bins


def crossover(a: list[list[int]], b: list[list[int]], length: list[int], capacity: int, rng: random.Random):
    """Inject whole well-filled bins of ``a`` into ``b``; bins of ``b`` with a piece twice go, the rest is best-fitted."""
    good = [x for x in a if sum(length[p] for p in x) >= WELL_FILLED * capacity]
    injected = rng.sample(good, rng.randint(1, len(good))) if good else []
    taken = {p for x in injected for p in x}
    kept, loose = list(injected), []
    for x in b:
        if taken.isdisjoint(x):
            kept.append(x)
        else:
            loose += [p for p in x if p not in taken]
    return _refill(kept, loose, length, capacity)


def mutate(bins: list[list[int]], length: list[int], capacity: int, rng: random.Random):
    """Open the worst-filled bins and a few others."""
    by_fill = sorted(bins, key=lambda b: sum(length[p] for p in b))
    worst = max(2, len(bins) // 20)
    cut = by_fill[:worst] + rng.sample(by_fill[worst:], min(worst, len(by_fill) - worst))
    gone = set(map(id, cut))
    return _refill([b for b in bins if id(b) not in gone], [p for b in cut for p in b], length, capacity)


def evolve(length: list[int], seeds: list[list[list[int]]], capacity: int, seed: int) -> list[list[int]]:
    """Best grouping after GENERATIONS, from the given groupings, best fit decreasing, and shuffled best fits."""
    rng = random.Random(seed)
    least = -(-sum(length) // capacity)
    score = lambda bins: fitness(bins, length, capacity)
    people = list(seeds) or [_refill([], list(range(len(length))), length, capacity)]
    if min(map(len, people)) <= least:
        return max(people, key=score)
    while len(people) < POPULATION:
        # Nearly decreasing order, so that individuals differ.
        order = sorted(range(len(length)), key=lambda p: -length[p] * rng.uniform(0.9, 1.1))
        bins: list[list[int]] = []
        best_fit(order, length, [], bins, capacity)
        people.append(bins)
    for _ in range(GENERATIONS):
        people.sort(key=score, reverse=True)
        if len(people[0]) <= least:
            break
        half = people[:max(2, POPULATION // 2)]
        children = []
        for _ in range(POPULATION // 2):
            a, b = rng.sample(half, 2)
            children += [crossover(a, b, length, capacity, rng), mutate(a, length, capacity, rng)]
        people = sorted(people + children, key=score, reverse=True)[:POPULATION]
    return max(people, key=score)


# ---- on Spark ---------------------------------------------------------------------------

_STATE = "instance int, island int, source int, uid long, length long, bin int"


def _groups(bins: pd.Series, n: int) -> list[list[int]]:
    out: dict[int, list[int]] = {}
    for p, b in zip(range(n), bins.tolist()):
        out.setdefault(b, []).append(p)
    return list(out.values())


def _epoch(capacity: int, epoch: int):
    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        instance, island = int(key[0]), int(key[1])
        parts = [g.sort_values("uid") for _, g in pdf.groupby("source")]
        first = parts[0]
        length = first["length"].tolist()
        seeds = [_groups(g["bin"], len(length)) for g in parts if g["bin"].iloc[0] >= 0]
        bins = evolve(length, seeds, capacity, zlib.crc32(f"{instance}/{island}/{epoch}".encode()))
        number = np.empty(len(length), np.int32)
        for b, members in enumerate(bins):
            number[members] = b
        # The elite stays, and moves to the next island as a guest.
        out = pd.DataFrame({"instance": np.int32(instance), "island": np.int32(island), "source": np.int32(0),
                            "uid": first["uid"].to_numpy(), "length": first["length"].to_numpy(), "bin": number})
        if epoch == EPOCHS - 1:
            return out
        return pd.concat([out, out.assign(island=np.int32((island + 1) % ISLANDS), source=np.int32(1))])
    return run


def _solve(pieces: DataFrame, instances: int, capacity: int) -> DataFrame:
    """(instance, uid, length, bin, fill, offset) of the best grouping of each instance."""
    dealt = pieces.select(F.pmod(F.xxhash64("uid"), F.lit(instances)).cast("int").alias("instance"),
                          F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"),
                          F.lit(0).alias("source"), "uid", "length", F.lit(-1).alias("bin"))
    for epoch in range(EPOCHS):
        dealt = dealt.groupBy("instance", "island").applyInPandas(_epoch(capacity, epoch), _STATE)
    dealt = stored(dealt, "groupings")
    bins = dealt.groupBy("instance", "island", "bin").agg(F.sum("length").alias("fill"))
    best = (bins.groupBy("instance", "island")
            .agg(F.count(F.lit(1)).alias("n"), F.sum(F.pow(F.col("fill") / capacity, 2)).alias("fit"))
            .groupBy("instance").agg(F.min_by("island", F.struct("n", -F.col("fit"), "island")).alias("island")))

    def place(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["bin", "length", "uid"], ascending=[True, False, True])
        after = pdf.groupby("bin")["length"].cumsum()
        return pdf.assign(offset=after - pdf["length"], fill=pdf.groupby("bin")["length"].transform("sum"))[
            ["instance", "uid", "length", "bin", "fill", "offset"]]

    return (dealt.join(best, ["instance", "island"]).groupBy("instance")
            .applyInPandas(place, "instance int, uid long, length long, bin int, fill long, offset long"))


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to every piece row."""
    spark = pieces.sparkSession
    ship(spark)
    # Stored once, so the row numbers are fixed from here on.
    with small_batches(spark):
        rows = stored(pieces.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    full = F.col("length") == capacity
    placed = [rows.filter(full).select("uid", (F.lit(1 << 62) + F.col("uid")).alias("sequence_id"),
                                       F.lit(0).cast("long").alias("offset"))]
    left = rows.filter(~full).select("uid", "length")
    n = left.count()
    for round_ in range(ROUNDS):
        instances = max(1, -(-n // INSTANCE))
        solved = stored(_solve(left, instances, capacity), f"packed-{round_}")
        last = instances == 1 or round_ == ROUNDS - 1
        settled = F.lit(True) if last else F.col("fill") >= SETTLED * capacity
        placed.append(solved.filter(settled).select(
            "uid", (F.lit(round_ << 58) + F.col("instance").cast("long") * (1 << 26) + F.col("bin")).alias("sequence_id"),
            "offset"))
        if last:
            break
        left = solved.filter(~settled).select("uid", "length")
        n, before = left.count(), n
        if n == 0:
            break
        if n > 0.9 * before:  # pieces that cannot fill bins: opening them again would not end
            placed.append(solved.filter(~settled).select(
                "uid", (F.lit(round_ << 58) + F.col("instance").cast("long") * (1 << 26) + F.col("bin")).alias("sequence_id"),
                "offset"))
            break
    where = placed[0]
    for more in placed[1:]:
        where = where.union(more)
    return rows.join(where, "uid").drop("uid")


def packed_documents(docs: DataFrame) -> DataFrame:
    return (pack(pieces_of(docs))
            .select(plain_id("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(table(spark, sf_dir, "documents"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every remaining document packed; one row per piece."""
    return packed_documents(docs)
