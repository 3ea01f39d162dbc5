"""Operator 4 - line dedup by an exact set-similarity join (built-in functions only).

A line is its lower-cased text and the set of its words (between white space). A line goes when an earlier line, by
(doc_id, place), has the same lower-cased text, or, if it has ``LEAST_WORDS`` distinct words or more, such a line has a
Jaccard similarity of ``4/5`` or more - whether that earlier line stays or not, so the result
does not depend on any order of work. Lines of white space alone are never touched.

1. Words (as they are spelled) are ordered by length, longest first, and by hash among those of one length. Any order
   keeps the join exact; long words are mostly rare ones, and no counts are needed for it.
2. Lines with equal text are one class, led by its earliest line; all its other lines go. Classes of fewer
   than ``LEAST_WORDS`` words take no part in what follows.
3. Neighbours: let similar lines of n and m words have o or more words in common, so that a = n - o and b = m - o have no
   counterpart. Each of these parts at most one pair of common words that follow one another, so of the first a + b + 1 such
   pairs one stands together in both lines, and begins at one of the first 2a + b + 1 places. As o >= 4(n + m)/9,
   these are 2n/5 + 1 places at most. So similar lines have two neighbouring words in common in their prefixes of
   2n/5 + 2 words. Two given words hardly ever stand together in unlike lines, so most pairs of neighbours are
   found in one line only and are dropped after one shuffle of (hash, line); what lines have in common grows little faster than the input,
   where lines that meet under a single word grow with the square of its occurrences.
4. Families of near-equal lines are settled first, so that they are never paired with themselves: under pairs that
   ``FAMILY_LINES`` other leaders of like length have, each meets the earliest of each of ``FAMILY_PARTS`` parts (by a hash of the place, so
   a family of edited lines has several to be near to, and few of its lines are left to meet all others). It is compared
   with the ``FAMILY_KEYS * FAMILY_PARTS`` of them that it has most pairs in common with, and done if one is similar. This only saves work.
5. The leaders that are left meet all earlier ones under their pairs, and go on only if they pass, inside the
   join, the length filter, the positional filter (what can stand before and after the pair) and a bitmap
   filter: 192 parities of the hashes of a line's words, where every differing parity is a word that one line
   has alone. Both sides of the join read one shuffle; what is settled is marked in it, by a rank beyond all.
6. Pairs that pass the suffix bound on their whole prefixes are verified on the words themselves. Only the lines in
   pairs are shuffled for that.

Edge cases: null texts stay null and have no lines; a null doc_id ranks first; rows are told apart by
doc_id and text, so rows that share a doc_id but not the text are documents of their own, the one with the smaller
hash of its text first; rows repeated whole count as one document and keep one another's lines; extra columns are
passed on untouched by ``dedup_lines``; empty tables stay empty.
"""

from __future__ import annotations

from contextlib import suppress
from functools import reduce
from operator import or_

from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import discard, long_id, stored, table, whole_text

LEAST_WORDS = 5
FAMILY_KEYS = 3
FAMILY_PARTS = 8
FAMILY_LINES = 4
SETTLED = 1 << 40                # added to the rank of a settled line's pairs
BROADCAST_ROWS = 2_000_000      # of ids, or of lists of removed places; beyond, the join shuffles
BROADCAST_BYTES = 128 << 20

MASKS = ["bits0", "bits1", "bits2"]

_HASH_BITS = 31   # of a word in a prefix; a clash only adds a candidate


_SPACES = "\t\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a" \
          "\u2028\u2029\u202f\u205f\u3000"


ID = "_ld_id"


def _with_ids(docs: DataFrame) -> DataFrame:
    """``docs`` with what tells its rows apart: doc_id (a null one below all) and, where rows of one doc_id have different
    texts, a hash of the text, else 0 (which costs next to nothing in shuffles)."""
    if ID in docs.columns:
        return docs
    text = F.xxhash64(whole_text())
    shared = stored(docs.select(long_id().alias("_ld_doc"), text.alias("h")).groupBy("_ld_doc")
                    .agg((F.min("h") != F.max("h")).alias("differ")).filter("differ").select("_ld_doc"), "shared-ids")
    joined = docs.withColumn("_ld_own", long_id()).join(_small(shared, 8), F.col("_ld_own") == F.col("_ld_doc"), "left")
    return joined.withColumn(ID, F.struct(F.col("_ld_own").alias("doc"), F.when(F.col("_ld_doc").isNull(), 0).otherwise(text).alias("text"))) \
        .drop("_ld_own", "_ld_doc")


def _odd(text: Column) -> Column:
    """Is there white space other than spaces and line ends? By searches for bytes, the wide characters' only in texts that have
    any: a regular expression takes several times as long."""
    def found(some: list[str]) -> Column:
        return reduce(or_, [text.contains(x) for x in some])

    wide = [x for x in _SPACES if ord(x) > 127]
    starts = sorted({x.encode()[:2] for x in wide})
    return found([x for x in _SPACES if ord(x) < 128]) | (F.octet_length(text) != F.length(text)) & reduce(or_, [
        F.contains(text.cast("binary"), F.lit(k)) & found([x for x in wide if x.encode()[:2] == k]) for k in starts])


def _spaced(text: Column, odd: Column | None = None) -> Column:
    """White space other than line ends as spaces. translate looks up every character, so only where there is any."""
    return F.when(_odd(text) if odd is None else odd, F.translate(text, _SPACES, " " * len(_SPACES))).otherwise(text)


def _split_words(line: Column) -> Column:
    return F.array_remove(F.split(_spaced(line), " "), "")


def _lines(docs: DataFrame, odd: Column | None = None) -> DataFrame:
    """(id, place, line, odd) with the line in lower case."""
    line, odd = F.col("line"), F.lit(False) if odd is None else odd
    return (docs.filter(F.col("text").isNotNull()).select(F.col(ID).alias("id"), odd.alias("odd"), F.lower(whole_text()).alias("t"))
            .select("id", "odd", F.posexplode_outer(F.split("t", "\n")).alias("place", "line"))
            .filter(line.between("!", "~") | line.rlike(f"[^ {_SPACES}]")))


def _same(line: Column) -> Column:
    return F.unhex(F.md5(line))


def _ordered_word(word: Column) -> Column:
    """A word as a number: longer words first (those of 128 bytes or more come last), words of one length by hash."""
    return F.shiftleft(F.bitwise_not(F.octet_length(word)).cast("long"), 56).bitwiseOR(
        F.xxhash64(word).bitwiseAND(F.lit((1 << 56) - 1)))


def _prefix_size(n: Column) -> Column:
    """Words of a prefix: with all its neighbours, 2n/5 + 1 pairs."""
    return F.floor(2 * n / 5).cast("int") + 2


def _parities(words: str) -> list[Column]:
    """Of the words' hashes, per bit number: one bit of each word, in one of three masks."""
    def of(some: Column) -> Column:  # shiftleft takes its distance modulo 64
        return F.aggregate(some, F.lit(0).cast("long"), lambda b, h: b.bitwiseXOR(F.call_function(
            "shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 33).cast("int"))))

    def third(k: int) -> Column:  # no second argument of the lambda: Spark would pass the word's index in it
        return F.filter(words, lambda h: F.pmod(h, F.lit(len(MASKS))) == k)

    return [of(third(k)).alias(name) for k, name in enumerate(MASKS)]


def _classes(docs: DataFrame) -> DataFrame:
    """Lines of equal text: line (a number), same (digest), lines, id and place of the leader, n words, parities, prefix (hashes
    of the first words in order)."""
    low = F.lit((1 << _HASH_BITS) - 1)
    words = F.array_distinct(F.transform(F.split(_spaced(F.col("line"), F.col("odd")), " "), _ordered_word))
    lines = (_lines(docs, _odd(F.col("text"))).select("id", "place", _same(F.col("line")).alias("same"),
                                 F.sort_array(F.array_remove(words, _ordered_word(F.lit("")))).alias("s"))
             .select("id", "place", "same", F.when(F.size("s") >= LEAST_WORDS, F.struct(
                 F.size("s").alias("n"), *_parities("s"), F.transform(
                     F.slice("s", 1, _prefix_size(F.size("s"))), lambda x: x.bitwiseAND(low).cast("int")).alias("prefix"))).alias("info")))
    return stored(lines.groupBy("same").agg(
        F.count(F.lit(1)).alias("lines"), F.min(F.struct("id", "place")).alias("lead"), F.first("info").alias("info"))
        .select(F.monotonically_increasing_id().alias("line"), "same", "lines", "lead.*", "info.*"), "classes")


def _small(df: DataFrame, bytes_a_row: int = 16) -> DataFrame:
    """The (stored) table, to be broadcast if its counted rows allow it."""
    n = df.count()
    return F.broadcast(df) if n <= BROADCAST_ROWS and n * bytes_a_row <= BROADCAST_BYTES else df


def _neighbours(classes: DataFrame, *cols: str, only: str = "spots") -> DataFrame:
    """(cols, at, word): the pairs of neighbours in the prefixes, each a hash; those at the places in the column ``only``, if
    there is one."""
    spots = F.col(only) if only in classes.columns else F.sequence(F.lit(0), F.size("prefix") - 2)
    pair = F.xxhash64(F.get("prefix", F.col("at")), F.get("prefix", F.col("at") + 1))
    return (classes.filter(F.col("n").isNotNull()).select(*cols, "prefix", F.explode_outer(spots).alias("at"))
            .filter(F.col("at").isNotNull()).select(*cols, "at", pair.alias("word")))


def _shared(classes: DataFrame) -> DataFrame:
    """The leaders that have a pair of neighbours in common with another one of like length, with the spots of such pairs, and
    those of pairs that FAMILY_LINES leaders of like length have before or after it in the order of lengths; stored."""
    # One sort of narrow rows; a join of the pairs with themselves takes two.
    by_length = Window.partitionBy("word").orderBy("n")
    n = F.col("n")

    def like(k: int) -> Column:
        return F.coalesce(5 * F.lag("n", k).over(by_length) >= 4 * n, F.lit(False)) \
            | F.coalesce(5 * n >= 4 * F.lead("n", k).over(by_length), F.lit(False))

    met = (_neighbours(classes, "line", "n").withColumns({"met": like(1), "family": like(FAMILY_LINES)}).filter("met")
           .select("line", "at", F.when(F.col("family"), F.col("at")).alias("often")))
    # Rows are shuffled, not lists: of one line, hardly any are in one task before.
    spots = stored(met.repartition(F.col("line")).groupBy("line")
                   .agg(F.collect_list("at").alias("spots"), F.collect_list("often").alias("often")), "spots")
    _tidy(classes.sparkSession)
    out = stored(classes.join(spots, "line"), "shared")
    discard(spots)
    return out


def _overlap(n: Column, m: Column) -> Column:
    """Words that similar lines of n and m words have in common at least."""
    return F.ceil(4 * (n + m) / 9)


def _like_lengths(n: Column, m: Column) -> Column:
    return (5 * n >= 4 * m) & (5 * m >= 4 * n)


def _family_pairs(classes: DataFrame) -> DataFrame:
    """Leaders with the earliest leaders of the parts of a common pair of neighbours: those they have most pairs in common with."""
    rows = _neighbours(classes, "id", "place", "n", only="often").drop("at")
    part = F.pmod(F.xxhash64("id", "place"), F.lit(FAMILY_PARTS))
    # The earliest of a part is a minimum, which counts before the shuffle.
    first = rows.groupBy("word", part).agg(F.min(F.struct("id", "place", "n")).alias("y")).select("word", "y")
    x, y = rows.alias("r"), first.alias("f")
    c = F.col
    before = (c("y.id") < c("r.id")) | ((c("y.id") == c("r.id")) & (c("y.place") < c("r.place")))
    pairs = (x.join(y, (c("r.word") == c("f.word")) & before & _like_lengths(c("r.n"), c("y.n")))
             .groupBy("r.id", "r.place", c("y.id").alias("id2"), c("y.place").alias("place2")).agg(F.count(F.lit(1)).alias("common")))
    likest = Window.partitionBy("id", "place").orderBy(F.desc("common"), "id2", "place2")
    return (pairs.filter("common > 1").withColumn("nth", F.row_number().over(likest)).filter(F.col("nth") <= FAMILY_KEYS * FAMILY_PARTS)
            .select("id", "place", "id2", "place2"))


def _prefix_pairs(classes: DataFrame, settled: DataFrame) -> DataFrame:
    """Unsettled leaders with all earlier leaders under a common pair of neighbours."""
    # One exchange for both sides of the join: an anti-join or a filter of one side would be pushed below it and make two.
    marked = classes.join(_small(settled.withColumn("after", F.lit(SETTLED))), ["id", "place"], "left")
    after = F.coalesce("after", F.lit(0).cast("long"))
    words = (_neighbours(marked.withColumn("after", after),
                         "id", "place", "n", *MASKS, "after")
             .select("id", "place", "n", *MASKS, (F.col("after") + F.col("at")).alias("rank"), "word")
             .repartition(F.col("word")))
    x = words.alias("x")
    y = words.alias("y")
    c = F.col
    before = (c("y.id") < c("x.id")) | ((c("y.id") == c("x.id")) & (c("y.place") < c("x.place")))
    n, m, at = c("x.n"), c("y.n"), F.pmod(c("y.rank"), F.lit(SETTLED))
    # What stands before and after the pair bounds the overlap; a settled x has no rest.
    position = F.least(c("x.rank"), at) + F.least(n - c("x.rank"), m - at) >= _overlap(n, m)
    spare = n + m - 2 * _overlap(n, m)  # words that only one of the two has, at most
    differ = sum((F.bit_count(c(f"x.{k}").bitwiseXOR(c(f"y.{k}"))) for k in MASKS), F.lit(0))
    return (x.join(y, (c("x.word") == c("y.word")) & before & _like_lengths(n, m) & position & (differ <= spare))
            .select("x.id", "x.place", c("y.id").alias("id2"), c("y.place").alias("place2")).distinct())


def _similar(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(id, place) of lines with a verified earlier partner; stored."""
    pairs = stored(pairs, "line-pairs")

    def ends_of(pairs: DataFrame) -> DataFrame:
        return stored(pairs.select("id", "place").union(pairs.select("id2", "place2")).distinct(), "line-ends")

    def with_ends(left: DataFrame, right: DataFrame, *cols: str) -> DataFrame:
        a = right.select("id", "place", *cols)
        b = right.select(F.col("id").alias("id2"), F.col("place").alias("place2"), *[F.col(x).alias(f"{x}2") for x in cols])
        return left.join(a, ["id", "place"]).join(b, ["id2", "place2"])

    # Suffix bound: of the two prefixes, the one that ends first in the order of words has all its shared
    # words in the other one, so only the rest of that line can add to the words the prefixes share.
    rest = F.greatest(F.col("n") - F.size("prefix"), F.col("n2") - F.size("prefix2"))
    clashes = F.size("prefix") - F.size(F.array_distinct("prefix"))  # hidden by equal hashes inside a line
    met = ends_of(pairs)
    prefixes = stored(classes.select("id", "place", "n", "prefix").join(_small(met), ["id", "place"], "left_semi"), "line-prefixes")
    near = stored(with_ends(pairs, prefixes, "n", "prefix")
                  .filter(F.size(F.array_intersect("prefix", "prefix2")) + clashes + rest >= _overlap(F.col("n"), F.col("n2")))
                  .select("id", "place", "id2", "place2"), "near-pairs")
    ends = ends_of(near)
    ids = _small(stored(ends.select("id").distinct(), "line-docs"), 8)
    words = stored(
        docs.filter(F.col("text").isNotNull()).select(F.col(ID).alias("id"), F.lower(whole_text()).alias("t"))
        .join(ids, "id").select("id", F.posexplode_outer(F.split("t", "\n")).alias("place", "line"))
        .join(_small(ends), ["id", "place"], "left_semi")
        .select("id", "place", F.array_distinct(_split_words(F.col("line"))).alias("words")), "line-words")
    common = F.size(F.array_intersect("words", "words2"))
    out = stored(with_ends(near, words, "words")
                 .filter(9 * common >= 4 * (F.size("words") + F.size("words2"))).select("id", "place").distinct(), "similar")
    for df in (words, ends, near, prefixes, met, pairs):
        discard(df)
    return out


def _tidy(spark: SparkSession) -> None:
    """The shuffle files of finished jobs go. (Events of a job hold them until they are handled, so the collection in
    ``stored``, right after its own job, comes too early for them.)"""
    with suppress(Py4JError):  # if the events take too long
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    spark.sparkContext._jvm.System.gc()


def repeated_lines(docs: DataFrame) -> DataFrame:
    """(id, place) of all lines to remove; ``id`` as ``_with_ids`` makes it."""
    docs = _with_ids(docs)
    classes = _classes(docs)
    longer = classes.filter(F.col("n").isNotNull())
    _tidy(docs.sparkSession)
    shared = _shared(longer)
    _tidy(docs.sparkSession)
    first = _similar(docs, shared, _family_pairs(shared))
    _tidy(docs.sparkSession)
    second = _similar(docs, shared, _prefix_pairs(shared, first))
    discard(shared)
    similar = first.union(second).withColumn("similar", F.lit(True))
    # Classes with something to remove: further lines of the class, or all when the leader goes.
    dirty = stored(classes.select("same", "lines", "id", "place").join(similar, ["id", "place"], "left")
                   .filter((F.col("lines") > 1) | F.col("similar"))
                   .select("same", F.col("id").alias("lead_id"), F.col("place").alias("lead_place"), "similar"), "dirty")
    discard(classes)
    return (_lines(docs).select("id", "place", _same(F.col("line")).alias("same"))
            .join(_small(dirty, 64), "same")
            .filter(F.coalesce("similar", F.lit(False)) | (F.col("id") != F.col("lead_id"))
                    | (F.col("place") != F.col("lead_place"))).select("id", "place").distinct())


def dedup_lines(docs: DataFrame, prefix: str = "_ld_") -> DataFrame:
    """The documents with repeated lines removed from ``text``, plus <prefix>lines and <prefix>removed."""
    names = [c for c in docs.columns if c != "text"]
    docs = _with_ids(docs)
    gone = stored(repeated_lines(docs).groupBy("id").agg(F.collect_list("place").alias("places")), "removed-lines")
    size = gone.agg(F.sum(24 + 4 * F.size("places")).alias("b"), F.count(F.lit(1)).alias("n")).first()
    if (size["b"] or 0) <= BROADCAST_BYTES and size["n"] <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    gone = gone.select(F.col("id").alias(f"{prefix}gone"), F.col("places").alias(f"{prefix}places"))
    all_lines = F.col(f"{prefix}all")  # a column of its own: inside the lambda, the text would be split for every line
    kept = F.array_sort(F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), F.col(f"{prefix}places")))
    changed = F.col(f"{prefix}places").isNotNull()
    text = F.when(changed, F.array_join(F.transform(kept, lambda i: F.get(all_lines, i)), "\n")).otherwise(F.col("text"))
    return (docs.join(gone, F.col(ID) == F.col(f"{prefix}gone"), "left").withColumn(f"{prefix}all", F.split("text", "\n"))
            .select(*names, text.alias("text"), F.coalesce(F.size(all_lines), F.lit(0)).cast("long").alias(f"{prefix}lines"),
                    F.when(changed, F.size(f"{prefix}places")).otherwise(F.lit(0)).cast("long").alias(f"{prefix}removed")))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
            .select("doc_id", F.col("_ld_lines").alias("n_lines"), F.col("_ld_removed").alias("n_removed"),
                    F.sha2(whole_text().cast("binary"), 256).alias("text_sha256")))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: repeated lines go, and with them a document that lost lines and has nothing but white space
    left: all of it stands in earlier ones. n_chars is that of the remaining text."""
    cols = ["doc_id", "text", "lang", "source", "n_chars"]
    lost = F.col("_ld_removed") > 0
    return (dedup_lines(docs.select(*cols)).filter(~lost | (F.trim(_spaced(F.translate("text", "\n", ""))) != ""))
            .withColumn("n_chars", F.when(lost, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*cols))


OP4_SQL = f"""
WITH l AS (SELECT doc_id AS id, unnest(string_split(text, chr(10))) AS line,
                  generate_subscripts(string_split(text, chr(10)), 1) AS place FROM documents),
     s AS (SELECT id, place, lower(line) AS same,
                  list_distinct(list_filter(string_split_regex(lower(line), '[ {_SPACES}]+'), lambda w: w <> '')) AS w FROM l),
     c AS (SELECT same, w, len(w) AS n, min((id, place)) AS lead FROM s WHERE len(w) > 0 GROUP BY ALL),
     t AS (SELECT lead, n, unnest(w) AS word FROM c WHERE n >= {LEAST_WORDS}),
     near AS (SELECT DISTINCT x.lead FROM t x JOIN t y ON x.word = y.word AND y.lead < x.lead
                     AND 5 * x.n >= 4 * y.n AND 5 * y.n >= 4 * x.n
              GROUP BY x.lead, y.lead, x.n, y.n HAVING 9 * count(*) >= 4 * (x.n + y.n)),
     gone AS (SELECT s.id, s.place FROM s JOIN c ON s.same = c.same
              WHERE (s.id, s.place) <> c.lead OR c.lead IN (SELECT lead FROM near)),
     kept AS (SELECT l.id, string_agg(l.line, chr(10) ORDER BY l.place) AS text FROM l ANTI JOIN gone USING (id, place) GROUP BY l.id),
     n AS (SELECT l.id, count(*) AS n_lines, count(gone.id) AS n_removed FROM l LEFT JOIN gone USING (id, place) GROUP BY l.id)
SELECT d.doc_id, coalesce(n.n_lines, 0) AS n_lines, coalesce(n.n_removed, 0) AS n_removed,
       sha256(coalesce(kept.text, '')) AS text_sha256
FROM documents d LEFT JOIN n ON d.doc_id = n.id LEFT JOIN kept ON d.doc_id = kept.id
"""
