"""Operator 10 - near-duplicate groups by SuperMinHash.

1. One pass over the texts gives every document's set size, a digest of its set, and a SuperMinHash
   signature of ``PLACES`` places (``superminhash.py``), cut into bands of ``ROWS`` places.
2. Documents with equal sets are one class; only classes go on, so copies are never paired.
3. Classes that share a band meet in a bucket. First each is paired with the bucket's smallest node
   only; pairs whose signatures agree well enough are verified on the full shingle sets,
   and verified links are grouped by union-find (``components.py``).
4. Buckets whose members are not one component yet are gone through completely: every pair across
   components, again by signature, then on full sets. Small buckets are joined; large ones are
   compared in blocks of ``BLOCK`` x ``BLOCK`` members (one side without the bucket's largest component,
   as every pair across components has a member outside it), and give out verified links alone.

So no bucket is capped and no pair that shares a band is lost, but pairs inside a component are not
tried. At similarity 0.85 a pair shares no band once in a million (24 bands of 5 places).

Edge cases: null and empty texts and texts without words have no shingle and are linked with
nothing; fewer than five words are one shingle; rows that share a doc_id count as one document
(component-wise); rows with a null doc_id are told apart by their sets and rank below all ids,
a component led by one has a null component_id; extra columns are ignored; an empty
table gives an empty result; very long texts make a slice of their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, NULL_ID, UPPER, long_id, map_arrow, ship, stored, table, utf8_slices, whole_text
from .components import components
from .superminhash import mix, shingle_sets, signatures

PERCENT = 85          # linked at 100 * intersection >= PERCENT * union
BANDS, ROWS = 24, 5
PLACES = BANDS * ROWS
STAGE_PERCENT = 80    # and in the pipeline's stage
# Pairs whose share of equal places is so much below the threshold are not verified: at a similarity of 0.85 the share
# of 120 places spreads by less than 0.033, so a link falls under it about once in 100,000 (once in 15,000 at 0.8).
SPREAD = 0.14
SMALL_BUCKET = 64
BLOCK = 1024                  # members of a block of a large bucket
BLOCK_ELEMENTS = 1 << 21      # and shingles of their sets (16 MB)
BROADCAST_NODES = 2_000_000   # 16 MB of ids

_NULL_KEYS = -(1 << 62)       # keys below stand for rows without an id


def _keys(ids: np.ndarray, digests: list[bytes]) -> np.ndarray:
    """The id; rows without one get a key of their own set below all ids."""
    keys = ids.copy()
    for i in np.flatnonzero(ids == -(1 << 63)):
        keys[i] = -(1 << 63) + (int.from_bytes(digests[i][:8], "little") >> 2)
    return keys


def fingerprints(docs: DataFrame) -> DataFrame:
    """key, text (a hash of the text), n, digest, sig (a byte per place), bands; one row per document."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for i, j, raw, off in utf8_slices(batch.column(1)):
                elements, at = shingle_sets(raw, off)
                sig = signatures(elements, at, PLACES)
                digests = [hashlib.blake2b(elements[a:b], digest_size=16).digest() for a, b in zip(at, at[1:])]
                bands = np.zeros((j - i, BANDS), np.uint64)
                for k in range(ROWS):
                    bands = mix(bands + np.uint64(k + 1) + sig[:, k::ROWS])
                low = (sig & np.uint64(0xFF)).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_keys(ids[i:j], digests)), batch.column(2)[i:j], pa.array(np.diff(at)), pa.array(digests, pa.binary()),
                     pa.array([x.tobytes() for x in low], pa.binary()),
                     pa.ListArray.from_arrays(pa.array(np.arange(j - i + 1, dtype=np.int32) * BANDS),
                                              pa.array(bands.reshape(-1).view(np.int64)))],
                    names=["key", "text", "n", "digest", "sig", "bands"])

    return map_arrow(docs.select(long_id().alias("id"), whole_text().alias("t"), F.xxhash64(whole_text()).alias("h")), run,
                     "key long, text long, n long, digest binary, sig binary, bands array<long>")


def _sets_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, set): the shingle hashes of the given nodes, from their texts."""
    ids = nodes.select(F.when(F.col("node") < _NULL_KEYS, F.lit(-(1 << 63))).otherwise(F.col("node")).alias("id")).distinct()
    if nodes.count() <= BROADCAST_NODES:
        ids = F.broadcast(ids)
    texts = docs.select(long_id().alias("id"), whole_text().alias("t")).join(ids, "id")

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy()
            for i, j, raw, off in utf8_slices(batch.column(1)):
                elements, at = shingle_sets(raw, off)
                sets = [elements[a:b].tobytes() for a, b in zip(at, at[1:])]
                digests = [hashlib.blake2b(s, digest_size=16).digest() for s in sets]
                yield pa.RecordBatch.from_arrays([pa.array(_keys(own[i:j], digests)), pa.array(sets, pa.binary())],
                                                 names=["node", "set"])

    return map_arrow(texts, run, "node long, set binary")


def _agreeing(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sizes and signatures allow a link."""
    a = nodes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sig").alias("sa"))
    b = nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sig").alias("sb"))
    fits = (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, PLACES) for c in (2, 3))
            good = pa.array((x == y).mean(axis=1) >= percent / 100 - SPREAD)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(good), batch.column(1).filter(good)], names=["a", "b"])

    return map_arrow(pairs.join(a, "a").join(b, "b").filter(fits).select("a", "b", "sa", "sb"), run, "a long, b long")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets are similar enough."""
    both = (pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("x")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("set").alias("y")), "b").select("a", "b", "x", "y"))

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [_linked(_set_of(x.as_py()), _set_of(y.as_py()), percent) for x, y in zip(batch.column(2), batch.column(3))]
            keep = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    return map_arrow(both, run, "a long, b long")


def _set_of(value: bytes) -> np.ndarray:
    return np.frombuffer(value, np.uint64)


def _linked(p: np.ndarray, q: np.ndarray, percent: int) -> bool:
    """Are two sorted sets similar enough?"""
    if not len(p) or not len(q):
        return False
    at = np.searchsorted(p, q)
    at[at == len(p)] = 0
    common = int((p[at] == q).sum())
    return 100 * common >= percent * (len(p) + len(q) - common)


def _open_buckets(members: DataFrame) -> DataFrame:
    """Members of buckets that hold several components, with the bucket's size and largest component."""
    sizes = members.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("m"))
    open_ = (sizes.groupBy("bucket").agg(F.sum("m").alias("size"), F.count(F.lit(1)).alias("parts"),
                                         F.max_by("component", F.struct("m", "component")).alias("largest"))
             .filter("parts > 1").drop("parts"))
    return stored(members.join(open_, "bucket"), "open-buckets")


def _pairs_of_small(rows: DataFrame) -> DataFrame:
    """All pairs across components of buckets with SMALL_BUCKET members at most."""
    small = rows.filter(F.col("size") <= SMALL_BUCKET)
    x, y = (small.select("bucket", F.col("node").alias(n), F.col("component").alias(f"c{n}")) for n in "ab")
    return x.join(y, "bucket").filter("a < b and ca <> cb").select("a", "b").distinct()


def _links_of_large(rows: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Verified links across components of the larger buckets, one per node and component it links to.

    A block of members outside the largest component meets every block of the bucket; all its
    pairs are tried there (in the first bucket that the two share) and only links leave the task.
    """
    large = rows.filter(F.col("size") > SMALL_BUCKET).join(nodes, "node")
    weight = large.groupBy("bucket").agg(F.sum("n").alias("elements"))
    large = (large.join(weight, "bucket")
             .withColumn("blocks", F.ceil(F.greatest(F.col("size") / BLOCK, F.col("elements") / BLOCK_ELEMENTS)).cast("int"))
             .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
             .join(sets, "node"))
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    kept = ["bucket", "band", "node", "component", "n", "sig", "bands", "set"]
    left = (large.filter(F.col("component") != F.col("largest"))
            .select(*kept, F.col("block").alias("i"), F.explode(every).alias("j"), F.lit(True).alias("is_left")))
    right = large.select(*kept, F.explode(every).alias("i"), F.col("block").alias("j"), F.lit(False).alias("is_left"))
    used = (rows.filter((F.col("size") > SMALL_BUCKET) & (F.col("component") != F.col("largest")))
            .join(weight, "bucket").select("bucket", F.pmod(F.xxhash64("node"), F.ceil(F.greatest(
                F.col("size") / BLOCK, F.col("elements") / BLOCK_ELEMENTS)).cast("int")).cast("int").alias("i")).distinct())
    blocks = left.union(right.join(used, ["bucket", "i"], "left_semi").select(left.columns))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int]] = []
        one, two = pdf[pdf["is_left"]], pdf[~pdf["is_left"]]
        if len(one) and len(two):
            sig = np.frombuffer(b"".join(two["sig"]), np.uint8).reshape(-1, PLACES)
            bands = np.stack(two["bands"].to_numpy())
            n, component, node = (two[c].to_numpy() for c in ("n", "component", "node"))
            sets_ = [_set_of(x) for x in two["set"]]
            for x in one.itertuples(index=False):
                may = np.flatnonzero((component != x.component)
                                     & (100 * np.minimum(n, x.n) >= percent * np.maximum(n, x.n)))
                may = may[(bands[may] == x.bands).argmax(axis=1) == x.band]
                agree = (sig[may] == np.frombuffer(x.sig, np.uint8)).mean(axis=1)
                own, done = _set_of(x.set), set()
                for k in np.argsort(-agree, kind="stable"):
                    if agree[k] < percent / 100 - SPREAD:
                        break
                    y = may[k]
                    if component[y] not in done and _linked(own, sets_[y], percent):
                        done.add(component[y])
                        out.append((min(x.node, node[y]), max(x.node, node[y])))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return blocks.groupBy("bucket", "i", "j").applyInPandas(compare, "a long, b long").distinct()


def near_groups(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per document: key, text (a hash of it), digest, n, component; linked at 100 * intersection >= percent * union."""
    ship(docs.sparkSession)
    prints = stored(fingerprints(docs), "fingerprints")
    nodes = stored(prints.filter("n > 0").groupBy("digest")
                   .agg(F.min("key").alias("node"), F.first("n").alias("n"), F.first("sig").alias("sig"),
                        F.first("bands").alias("bands")), "classes")
    places = (nodes.select("node", F.posexplode("bands").alias("band", "h"))
              .select("node", "band", F.xxhash64("band", "h").alias("bucket")))
    shared = (places.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("pivot"))
              .filter("size > 1").drop("size"))
    members = stored(places.join(shared, "bucket"), "buckets")
    met = stored(members.select("node").distinct().join(nodes.drop("digest"), "node"), "met")
    sets = stored(_sets_of(docs, met.select("node").distinct()), "sets")
    stars = members.filter("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    links = stored(_verified(_agreeing(stars, met, percent), sets, percent), "star-links")
    first = components(links)
    rows = _open_buckets(members.join(first, "node", "left")
                         .select("bucket", "band", "node", F.coalesce("component", "node").alias("component")))
    more = stored(_verified(_agreeing(_pairs_of_small(rows), met, percent), sets, percent)
                  .union(_links_of_large(rows, met, sets, percent)).distinct(), "more-links")
    last = first if more.isEmpty() else components(
        more.union(first.select(F.col("node").alias("a"), F.col("component").alias("b"))))
    classes = (nodes.select("digest", "node").join(last, "node", "left")
               .select("digest", F.coalesce("component", "node").alias("component")))
    return (prints.select("key", "text", "digest", "n").join(classes, "digest", "left")
            .select("key", "text", "digest", "n", F.coalesce("component", "key").alias("component")))


def _id(col: str) -> Column:
    return F.when(F.col(col) >= _NULL_KEYS, F.col(col))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (near_groups(table(spark, sf_dir, "documents"))
            .select(_id("key").alias("doc_id"), F.col("n").alias("n_shingles"), _id("component").alias("component_id"),
                    (F.col("key") == F.col("component")).alias("kept")))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each group, linked at STAGE_PERCENT, the document with the smallest id stays; where only rows without an
    id lead a group, the one with the smallest hash of its text. Rows equal in id and text count once; documents
    without words all stay but for such repeats."""
    cols = ["doc_id", "text", "lang", "source", "n_chars"]
    groups = near_groups(docs, STAGE_PERCENT)
    # One leader a group; a minimum counts before the shuffle, however large a group is.
    leads = groups.filter("n > 0").groupBy("component").agg(F.min(F.struct("key", "text")).alias("lead")).select("lead.*")
    kept = leads.union(groups.filter("n = 0").select("key", "text").distinct())
    kept = kept.select(F.coalesce(_id("key"), F.lit(NULL_ID)).alias("_id"), F.col("text").alias("_text"))
    rows = docs.select(*cols).withColumn("_id", long_id()).withColumn("_text", F.xxhash64(whole_text())).join(kept, ["_id", "_text"])
    # Repeats are few: only their keys are gathered, and the least row of each key stays.
    order = F.struct("lang", "source", "n_chars")
    least = (rows.groupBy("_id", "_text").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("least")).filter("n > 1").drop("n"))
    many = rows.join(least, ["_id", "_text"]).filter(order.eqNullSafe(F.col("least"))).select(*cols).dropDuplicates()
    return rows.join(least, ["_id", "_text"], "left_anti").select(*cols).union(many)


OP10_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' ')))
                                 WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
link AS (SELECT x.doc_id AS a, y.doc_id AS b FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id < y.doc_id
         JOIN n nx ON nx.doc_id = x.doc_id JOIN n ny ON ny.doc_id = y.doc_id
         GROUP BY x.doc_id, y.doc_id, nx.n, ny.n HAVING 100 * count(*) >= {PERCENT} * (nx.n + ny.n - count(*))),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT DISTINCT a, a AS b FROM edge UNION SELECT r.a, e.b FROM reach r JOIN edge e ON e.a = r.b),
c AS (SELECT a AS doc_id, min(b) AS component FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.component, d.doc_id) AS component_id,
       coalesce(c.component, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.doc_id = d.doc_id
"""
