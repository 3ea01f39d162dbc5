"""Entity linking: every post -> at most one catalog row, by scored keyword containment.

The source tests every (post, figure, keyword) triple with a regex. Here the
containment theta-join is rewritten as an equi-join on an *anchor token*:

* A keyword ``kw`` matches when ``B kw ('?s)? B`` (ASCII word boundaries) occurs
  in the lower-cased search text or in its hyphen-free copy.
* Inside a match, every maximal word run of ``kw`` is a whole word token of the
  text; only the keyword's final run may carry a plural ``s``. So for one chosen
  run ``t`` of ``kw``, a match implies that the text holds the token ``t`` (or ``t + 's'`` when ``t``
  ends the keyword). That is an equality, so candidates come from an equi-join.
* ``t`` is the run that stands at the fewest places of the posts (``token_frequencies``), so a word that is everywhere
  does not meet every keyword that has it, however long the word is.
* A candidate is settled at the place of its anchor: the words and the gaps around it must equal the
  keyword's (``verify_place``). No regex runs over the text, and the cost of a check is the keyword's length, not the text's.
* Keywords without any word character are anchored on their own text: in a
  match they are a whole gap between two words (optionally followed by an apostrophe and an s).

Plan of ``match_posts`` (broadcast path): scan -> search text -> words and gaps -> explode
(one base row per post kept) -> broadcast left hash join with the anchors -> check of the place
-> project to slim rows -> partial arg-max -> one exchange by key -> final arg-max. No text is
shuffled, no join back to the posts. The anchor table grows with the catalog, not with the posts; it is
checkpointed and measured (rows, bytes) before broadcasting, and ``position_join``, which shuffles
hashes of whole runs of words, takes over above the limits.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keywords import DEFAULT_RULES, KeywordRules, with_keywords
from ..functions.text import B, WORD, js_regex, regex_escape
from .joins import BROADCAST_BYTES, fits_broadcast, materialize, size_stats

# Issue label -> pattern (JS flavour, case-insensitive), in dictionary order.
ISSUE_PATTERNS = {
    "loose_joints": r"\b(loose|floppy|wobbly)\s*(joint|joints|limb|limbs|arm|arms|leg|legs)\b",
    "paint_defect": r"\b(paint\s*(defect|issue|problem|error|mistake|bleed|chipping|chip|scratched?|rub))\b",
    "broken_parts": r"\b(broken|cracked|snapped|damaged)\s*(part|piece|joint|peg|connector)\b",
    "missing_parts": r"\b(missing|lost)\s*(part|piece|accessory|accessories)\b",
    "warped_parts": r"\b(warped|bent|twisted|deformed)\b",
    "stiff_joints": r"\b(stiff|tight|stuck)\s*(joint|joints)\b",
    "packaging_damage": r"\b(box\s*damage|package\s*damage|shipping\s*damage)\b",
}

# Fixed value: prefix that turns a relative permalink into a link.
PERMALINK_PREFIX = "https://reddit.com"


@dataclass(frozen=True)
class MatchWeights:
    """Score = base by priority + keyword length + phrase bonus (source's fixed values)."""
    p1: int = 1000
    p2: int = 500
    p3: int = 300
    p4: int = 100
    phrase_bonus: int = 50
    min_keyword_len: int = 4


DEFAULT_WEIGHTS = MatchWeights()

# Words and other characters mixed: no word, gap or anchor is equal to it.
BASE_TERM = "a post"

# Anchor tables above this many rows (or BROADCAST_BYTES) are not broadcast.
BROADCAST_ANCHOR_ROWS = 2_000_000

SKETCH_SLOTS = 1 << 20  # of a filter (see ``word_filter``): a megabyte at most
_BITMAP = 1 << 15       # bits of one of Spark's bitmaps
LONG_KEYWORD = 8        # longer runs of words are only hashed where the first ones are a keyword's


# ---------------------------------------------------------------- columns

def search_text(title: Column, body: Column) -> Column:
    """lower(title + ' ' + body), body newlines as spaces: the whole post is searched."""
    body = F.replace(F.coalesce(body, F.lit("")), F.lit("\n"), F.lit(" "))
    return F.lower(F.concat_ws(" ", F.coalesce(title, F.lit("")), body))


def dehyphen(c: Column) -> Column:
    return F.replace(c, F.lit("-"), F.lit(""))


def word_tokens(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(f"{WORD}+"), 0)


def gap_runs(c: Column) -> Column:
    """What stands between the word tokens: before the first, between two, behind the last (one more than words)."""
    return F.split(c, f"{WORD}+", -1)


def match_score(priority: Column, keyword: Column, match_type: Column,
                w: MatchWeights = DEFAULT_WEIGHTS) -> Column:
    base = (F.when(priority == 1, w.p1).when(priority == 2, w.p2)
            .when(priority == 3, w.p3).when(priority == 4, w.p4).otherwise(0))
    bonus = F.when(match_type == "phrase", w.phrase_bonus).otherwise(0)
    return base + F.length(keyword) + bonus


def match_confidence(priority: Column, keyword_len: Column) -> Column:
    return (F.when(priority.isin(1, 2), "High")
            .when((priority == 3) & (keyword_len >= 12), "High")
            .when(priority == 3, "Medium")
            .when((priority == 4) & (keyword_len >= 8), "Medium")
            .otherwise("Low"))


def keyword_pattern(keyword: Column) -> Column:
    """``B kw ('?s)? B`` with the keyword's regex metacharacters escaped.

    Written literal-first so Java's regex engine can skip ahead with its
    literal-prefix search: the leading boundary becomes a fixed-length
    look-behind placed after the literal. If the keyword starts with a word
    character, the character before it must not be one; otherwise it must be.
    """
    esc = regex_escape(keyword)
    starts_word = keyword.rlike(f"\\A{WORD}")
    lead = F.when(starts_word, F.concat(F.lit(f"(?<!{WORD}"), esc, F.lit(")"))) \
        .otherwise(F.concat(F.lit(f"(?<={WORD}"), esc, F.lit(")")))
    return F.concat(esc, lead, F.lit("(?:'?s)?"), F.lit(B))


def _leading_group(body: str) -> tuple[list[str], int] | None:
    """Top-level alternatives of the group that opens ``body`` and the index of
    its closing parenthesis; None if ``body`` does not open with a group."""
    if not body.startswith("("):
        return None
    depth, alts, cur, i = 0, [], [], 0
    while True:
        i += 1
        if i >= len(body):
            return None
        ch = body[i]
        if ch == "\\":
            cur.append(body[i:i + 2])
            i += 1
            continue
        if ch == "(":
            depth += 1
        elif ch == ")":
            if depth == 0:
                alts.append("".join(cur))
                return alts, i
            depth -= 1
        elif ch == "|" and depth == 0:
            alts.append("".join(cur))
            cur = []
            continue
        cur.append(ch)


def _has_top_level_bar(body: str) -> bool:
    depth, in_class, i = 0, False, 0
    while i < len(body):
        ch = body[i]
        if ch == "\\":
            i += 2
            continue
        if in_class:
            in_class = ch != "]"
        elif ch == "[":
            in_class = True
        elif ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
        elif ch == "|" and depth == 0:
            return True
        i += 1
    return False


def _optional_after(body: str, end: int) -> bool:
    rest = body[end + 1:]
    return rest[:1] in ("?", "*") or rest.startswith("{0")


_WORD_START = re.compile(r"[A-Za-z0-9_]")


def label_regex(pattern: str, text_is_lower: bool = True) -> str:
    """Java form of a case-insensitive JS label pattern, tuned for scanning.

    * A leading ``\\b`` that is always followed by a word character (a plain
      word, or a required group whose alternatives all start with one) only
      needs "no word character before": one look-behind instead of the
      two-way boundary test.
    * On lower-cased text ``(?i)`` is redundant when the pattern holds no
      upper-case letter (escapes such as ``\\S`` aside); dropping it keeps
      Java's matcher on its faster case-sensitive path.
    """
    body = pattern
    if body.startswith("\\b"):
        rest = body[2:]
        group = _leading_group(rest)
        if group is not None:
            alts, end = group
            ok = not _optional_after(rest, end) and all(_WORD_START.match(a) for a in alts)
        else:
            ok = bool(_WORD_START.match(rest))
        if ok:
            body = f"(?<!{WORD})" + rest
    upper = re.search(r"[A-Z]", re.sub(r"\\.", "", pattern))
    flag = "(?i)" if (upper or not text_is_lower) else ""
    return flag + js_regex(body)


_META = set("\\[](){}?*+.|^$")


def _literal_prefix(alt: str) -> str:
    """Leading plain characters of a regex alternative; a char followed by a
    quantifier that allows zero repeats is not required, so it is cut."""
    out = []
    for ch in alt:
        if ch in _META:
            if ch in "?*{" and out:
                out.pop()
            break
        out.append(ch)
    return "".join(out)


def required_literals(pattern: str) -> list[str] | None:
    """Strings one of which must occur in any match of ``pattern``, or None.

    Conservative: only a leading ``\\b`` and one required leading group of
    plain alternatives (or a plain leading literal) are understood; a
    top-level ``|``, an optional group or anything else gives None (no
    pre-filter), so the guard can never drop a real match.
    """
    body = pattern[2:] if pattern.startswith("\\b") else pattern
    if _has_top_level_bar(body):
        return None
    group = _leading_group(body)
    if group is not None:
        alts, end = group
        if _optional_after(body, end):
            return None
        lits = [_literal_prefix(a) for a in alts]
        return lits if lits and all(lits) else None
    if body.startswith("("):
        return None
    lit = _literal_prefix(body)
    return [lit] if lit else None


def required_inner_literal(pattern: str) -> str | None:
    """The longest string that stands in every match of ``pattern`` outside groups and classes, or None.

    Conservative like ``required_literals``: a top-level ``|``, any ``(?`` and escapes other than
    classes, boundaries and quoted punctuation give None.
    """
    if _has_top_level_bar(pattern) or "(?" in pattern:
        return None
    runs, depth, in_class, i = [""], 0, False, 0
    while i < len(pattern):
        ch = pattern[i]
        i += 1
        if ch == "\\":
            ch = pattern[i:i + 1]
            i += 1
            if ch.isalnum() and ch not in "bBdDwWsS" or not ch:
                return None
            literal = not ch.isalnum()
        else:
            literal = ch not in _META
        if in_class:
            in_class = not (ch == "]" and not literal)
        elif depth and ch in "()" and not literal:
            depth += 1 if ch == "(" else -1
        elif depth == 0 and literal:
            runs[-1] += ch
        elif depth == 0:
            if ch in "?*{":
                runs[-1] = runs[-1][:-1]
            depth += ch == "("
            if ch == "{":
                i = pattern.find("}", i) + 1 or len(pattern)
            runs.append("")
        in_class = in_class or (ch == "[" and not literal)
    best = max(runs, key=len)
    return best or None


def detect_labels(text: Column, patterns: dict[str, str] | None = None,
                  text_is_lower: bool = True) -> Column:
    """Labels whose pattern occurs in ``text``, in dictionary order.

    When a pattern needs one of a few literal strings at its start, or one further on (and the text is
    lower-cased, the pattern has no upper-case letter), a byte-level
    ``contains`` test guards the regex, which then only runs on candidates.
    """
    patterns = ISSUE_PATTERNS if patterns is None else patterns

    def test(p: str) -> Column:
        rx = text.rlike(label_regex(p, text_is_lower))
        lits = None
        if text_is_lower and not re.search(r"[A-Z]", re.sub(r"\\.", "", p)):
            inner = required_inner_literal(p)
            lits = required_literals(p) or ([inner] if inner else None)
        if not lits:
            return rx
        guard = F.lit(False)
        for lit in dict.fromkeys(lits):
            guard = guard | F.contains(text, F.lit(lit))
        return guard & rx

    hits = [F.when(test(p), F.lit(label)) for label, p in patterns.items()]
    return F.array_compact(F.array(*hits)) if hits else F.array().cast("array<string>")


# ---------------------------------------------------------------- tables

def keyword_table(catalog: DataFrame, ord_col: str = "cat_ord",
                  sources: tuple[str, ...] = ("name", "series_title"),
                  carry: tuple[str, ...] = ("name", "brand", "product_line"),
                  rules: KeywordRules = DEFAULT_RULES) -> DataFrame:
    """One row per generated keyword: (ord, kw_ord, keyword, priority, match_type, carry...)."""
    # Keyword generation is CPU-heavy per row and the catalog is small in bytes, so it tends
    # to arrive in few partitions: spread it by its ordinal, as wide as the session shuffles.
    spread = catalog.select(ord_col, *dict.fromkeys(carry + sources)).repartition(F.col(ord_col))
    return (with_keywords(spread, sources, "kws", rules).select(ord_col, *carry, F.posexplode("kws").alias("kw_ord", "kw"))
            .select(ord_col, "kw_ord", F.col("kw.text").alias("keyword"),
                    F.col("kw.priority").alias("priority"), F.col("kw.type").alias("match_type"),
                    *carry))


def best_per_keyword(keywords: DataFrame, ord_col: str = "cat_ord",
                     w: MatchWeights = DEFAULT_WEIGHTS) -> DataFrame:
    """Per distinct keyword text, the catalog hit that wins every tie for that text.

    Verification depends on the text only, so the post-level arg-max equals the
    arg-max over verified texts of this per-text winner.
    """
    k = (keywords.where(F.length("keyword") >= w.min_keyword_len)
         .withColumn("score", match_score(F.col("priority"), F.col("keyword"), F.col("match_type"), w)))
    hit = F.struct(
        F.col("score"), F.col(ord_col).alias("cat_ord"), F.col("kw_ord"),
        F.col("name").alias("figure_name"), F.col("brand"), F.col("product_line"),
        F.col("keyword").alias("matched_keyword"), F.col("match_type"), F.col("priority"),
        match_confidence(F.col("priority"), F.length("keyword")).alias("confidence"))
    order = F.struct((-F.col("score")).alias("o0"), F.col(ord_col).alias("o1"), F.col("kw_ord").alias("o2"))
    return k.groupBy("keyword").agg(F.min_by(hit, order).alias("hit"))


def keyword_anchors(best: DataFrame, frequencies: DataFrame | None = None) -> DataFrame:
    """One or two equality terms per keyword, and what stands around them.

    The anchor is the keyword's word run of least ``frequencies`` (term, n), the plural of a final run
    counted in; ties go to the longest, then the first. Without frequencies a run counts as often as
    keywords hold it. Columns: anchor, keyword, ``k`` (place of the anchor among the keyword's
    ``m`` words, -1 for keywords without any), ``body`` (all words but the last), ``inner`` (the gaps between
    words), ``last``, ``plural`` (may the last word carry an s?), ``lead`` and ``tail`` (what stands before the first
    and behind the last word), hit.
    """
    terms = _terms_of(best)
    if frequencies is None:
        frequencies = terms.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    # A keyword has one row per term: the array below is as long as the keyword has words.
    run = F.struct(F.coalesce("n", F.lit(0)).alias("n"), "k", "term")
    found = (terms.join(frequencies, "term", "left").groupBy("keyword")
             .agg(F.any_value("hit").alias("hit"), F.collect_list(F.when(F.col("term").isNotNull(), run)).alias("runs")))
    w, g = F.col("w"), F.col("g")
    parts = found.select("keyword", "hit", "runs", word_tokens(F.col("keyword")).alias("w"), gap_runs(F.col("keyword")).alias("g")) \
        .select("keyword", "hit", "runs", "w", F.size(w).alias("m"), (F.element_at(g, -1) == "").alias("plural"),
                F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))).alias("body"), F.try_element_at(w, F.lit(-1)).alias("last"),
                F.slice(g, 2, F.greatest(F.size(g) - 2, F.lit(0))).alias("inner"),
                F.element_at(g, 1).alias("lead"), F.element_at(g, -1).alias("tail"))
    counted = F.transform(w, lambda t, i: F.struct(
        F.aggregate(F.filter("runs", lambda r: r["k"] == i), F.lit(0).cast("long"), lambda a, r: a + r["n"]).alias("n"),
        (-F.length(t)).alias("l"), i.alias("k")))
    picked = parts.select("*", F.coalesce(F.array_min(counted)["k"], F.lit(-1)).alias("k"))
    quoted = F.array("keyword", F.concat("keyword", F.lit("'")))
    anchor = F.when(F.col("k") < 0, quoted).otherwise(F.transform(F.filter("runs", lambda r: r["k"] == F.col("k")), lambda r: r["term"]))
    return picked.select(F.explode(anchor).alias("anchor"), "k", "keyword", "m", "body", "inner", "last", "plural", "lead", "tail", "hit")


def _terms_of(best: DataFrame) -> DataFrame:
    """keyword, hit, k, term: each word of a keyword and, where its final word may carry an s, that form; one row without
    a term for a keyword without words."""
    words = word_tokens(F.col("keyword"))
    plural = F.when(F.col("keyword").rlike(f"{WORD}\\z"), F.array(F.concat(F.try_element_at("w", F.lit(-1)), F.lit("s"))))
    terms = F.concat("w", F.coalesce(plural, F.array().cast("array<string>")))
    return (best.select("keyword", "hit", words.alias("w")).select("keyword", "hit", F.size("w").alias("m"), F.posexplode_outer(terms))
            .select("keyword", "hit", F.least(F.col("pos"), F.col("m") - 1).alias("k"), F.col("col").alias("term")))


def anchor_terms(best: DataFrame) -> DataFrame:
    """(term): every word a keyword's match can rest on, once."""
    return _terms_of(best.select("keyword", F.lit(None).alias("hit"))).where(F.col("term").isNotNull()).select("term").distinct()


def token_frequencies(posts: DataFrame, terms: DataFrame, broadcast_ok: bool) -> DataFrame:
    """(term, n): at how many places of the posts (``txt`` and its hyphen-free copy) each of ``terms`` stands:
    the join rows that an anchor costs.

    One pass over the posts; each task counts before the shuffle, which carries one row per term and task.
    """
    txt = F.col("txt")
    copies = F.when(F.contains(txt, F.lit("-")), F.array(txt, dehyphen(txt))).otherwise(F.array(txt))
    # Outer: else the optimizer adds a filter on the array's size, which cuts every text into words a second time.
    found = posts.select(F.explode_outer(copies).alias("t")).select(F.explode_outer(word_tokens(F.col("t"))).alias("term"))
    count = F.count(F.lit(1)).alias("n")
    if broadcast_ok:
        return found.join(F.broadcast(terms), "term").groupBy("term").agg(count)
    asked = word_filter(terms.select(F.xxhash64("term").alias("h")))  # most words are in no keyword: not counted nor shuffled
    return found.where(asked(F.xxhash64("term"))).groupBy("term").agg(count).join(terms.hint("merge"), "term")


def post_places(posts: DataFrame, key: str, carry: tuple[str, ...], with_runs: bool, outer: bool,
                base: bool = False) -> DataFrame:
    """One row per word of a post's text and of its hyphen-free copy: key, carried columns, ``v`` (0 text, 1 copy),
    ``words``, ``gaps``, ``pos``, ``term``; with ``with_runs`` also the gaps, at places from size(words) on.

    ``outer`` keeps a row for a text without terms (and spares a filter that cuts texts twice), ``base`` adds one row per post with ``BASE_TERM``. The arrays are
    references into the row, not copies: nothing is materialised before a filter or projection has dropped them.
    """
    txt = F.col("txt")
    copies = F.when(F.contains(txt, F.lit("-")), F.array(txt, dehyphen(txt))).otherwise(F.array(txt))
    text = posts.select(key, *carry, F.posexplode_outer(copies).alias("v", "t"))
    split = text.select(key, *carry, "v", word_tokens(F.col("t")).alias("words"), gap_runs(F.col("t")).alias("gaps"))
    terms = F.concat("words", "gaps") if with_runs else F.col("words")
    if base:
        terms = F.concat(terms, F.when(F.col("v") == 0, F.array(F.lit(BASE_TERM))).otherwise(F.array().cast("array<string>")))
    explode = F.posexplode_outer if outer else F.posexplode
    return split.select(key, *carry, "v", "words", "gaps", explode(terms).alias("pos", "term"))


def verify_place() -> Column:
    """Does the keyword of an anchor row occur around this place? Equal to its boundary pattern (see ``keyword_pattern``).

    A boundary makes words of the keyword whole words of the text and its gaps whole gaps. Where
    the keyword begins or ends with a gap, a word must stand beyond it, or ``'s`` behind its end.
    """
    words, gaps, pos, m, k = (F.col(c) for c in ("words", "gaps", "pos", "m", "k"))
    n, start = F.size(words), pos - k
    first = F.greatest(start, F.lit(0)) + 1
    end, s, quote = start + m, F.lit("s"), F.lit("'")
    last = F.get(words, end - 1)
    tail_gap = F.get(gaps, end)
    # One neighbour first: it turns most candidates away before any array is sliced.
    beside = (F.when(k > 0, F.get(words, pos - 1) == F.get(F.col("body"), k - 1))
              .when(k < m - 2, F.get(words, pos + 1) == F.get(F.col("body"), k + 1)).otherwise(F.lit(True)))
    worded = ((k >= 0) & (pos < n) & (start >= 0) & (end <= n) & beside
              & ((last == F.col("last")) | (F.col("plural") & (last == F.concat("last", s))))
              & (F.slice(words, first, m - 1) == F.col("body")) & (F.slice(gaps, first + 1, m - 1) == F.col("inner"))
              & ((F.col("lead") == "") | ((start > 0) & (F.get(gaps, start) == F.col("lead"))))
              & ((F.col("tail") == "") | ((end < n) & (tail_gap == F.col("tail")))
                 | ((tail_gap == F.concat("tail", quote)) & (F.get(words, end) == s))))
    q = pos - n
    bare = (k < 0) & (q > 0) & (q < n) & ((F.col("term") == F.col("keyword")) | (F.get(words, q) == s))
    return F.coalesce(worded | bare, F.lit(False))


def match_candidates(posts: DataFrame, anchors: DataFrame, key: str, with_runs: bool, broadcast_ok: bool) -> DataFrame:
    """Verified (key, keyword, hit) rows: anchor equi-join, then the check around the anchor's place."""
    if broadcast_ok:
        places = post_places(posts.select(key, "txt"), key, (), with_runs, outer=True)
        cand = places.join(F.broadcast(anchors), F.col("term") == F.col("anchor"))
        return cand.where(verify_place()).select(key, "keyword", "hit")
    return position_join(posts, anchors, key, with_runs)


def word_filter(hashes: DataFrame) -> Callable[[Column], Column]:
    """A test of a 64-bit hash that holds for every ``h`` of the table, and for few others.

    Each hash marks two slots of a byte; 16 slots a row and SKETCH_SLOTS at most, whatever the catalog: beyond that it
    lets more pass, and the join behind it turns them away.
    """
    slots = min(max(1 << (16 * hashes.count()).bit_length(), _BITMAP), SKETCH_SLOTS)
    size = F.lit(slots)

    def places(h: Column) -> tuple[Column, Column]:
        return F.pmod(h, size), F.pmod(F.shiftrightunsigned(h, 32), size)

    rows = (hashes.select(F.explode(F.array(*places(F.col("h")))).alias("s")).groupBy(F.floor(F.col("s") / _BITMAP).alias("b"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("s") + 1)).alias("bits")).collect())  # slots / _BITMAP rows
    seen = np.full(slots, ord("0"), np.uint8)
    for row in rows:
        seen[row["b"] * _BITMAP:(row["b"] + 1) * _BITMAP] += np.unpackbits(np.frombuffer(bytes(row["bits"]), np.uint8), bitorder="little")
    table = F.lit(seen.tobytes())

    def passes(h: Column) -> Column:
        one, two = (F.substring(table, p.cast("int") + 1, F.lit(1)) == F.lit(b"1") for p in places(h))
        return one & two

    return passes


def asked_windows(anchors: DataFrame) -> DataFrame:
    """The keywords as hashes: ``kid`` (keyword), ``m`` words (0: none, anchored on a gap), ``first`` word, ``start`` (the first
    LONG_KEYWORD words and the gaps between them, null for shorter ones), ``h`` (all words and the gaps between) and what must
    stand around: ``w_before``, ``w_after``, ``w_bare``. One row per form of the last word."""
    k, m, none = F.col("k"), F.col("m"), F.array().cast("array<string>")
    # Two anchors of a keyword are the forms of its last word, unless they are of another one.
    last = (F.when((k < 0) | (k == m - 1), F.array("anchor"))
            .when(F.col("plural"), F.array(F.col("last"), F.concat("last", F.lit("s")))).otherwise(F.array("last")))
    rows = anchors.select("anchor", "keyword", "k", "m", "body", "inner", "lead", "tail", F.explode(last).alias("end"))
    words = F.when(k < 0, F.array("end")).otherwise(F.concat("body", F.array("end")))
    return rows.select(
        F.xxhash64("keyword").alias("kid"), F.greatest(m, F.lit(0)).alias("m"), F.xxhash64(F.get(words, F.lit(0))).alias("first"),
        F.when(m > LONG_KEYWORD, F.xxhash64(F.slice(words, 1, LONG_KEYWORD), F.slice("inner", 1, LONG_KEYWORD - 1))).alias("start"),
        F.xxhash64(F.greatest(m, F.lit(0)), words, F.when(k < 0, none).otherwise(F.col("inner"))).alias("h"),
        F.when((k >= 0) & (F.col("lead") != ""), F.xxhash64("lead")).alias("w_before"),
        F.when((k >= 0) & (F.col("tail") != ""), F.xxhash64("tail")).alias("w_after"),
        F.when((k < 0) & (F.col("anchor") != F.col("keyword")), F.xxhash64(F.lit("s"))).alias("w_bare"))


def hashed_windows(posts: DataFrame, key: str, with_runs: bool, asked: DataFrame) -> DataFrame:
    """Runs of words of the posts that may be a keyword's, as numbers only, no text: key, h (see ``asked_windows``), and hashes of
    what stands around.

    ``before`` and ``after`` are the gaps at both sides, ``after_s`` the gap without its final apostrophe where ``'s``
    follows, ``next`` the word behind. Null where there is nothing, and for the outer gaps of a text, beyond which
    no word stands. Places are dropped before any shuffle unless their word begins a keyword, and their runs unless
    some keyword has the run's hash.
    """
    lengths = sorted(r["m"] for r in asked.select("m").distinct().collect() if r["m"] > 0)  # a row for each length of a keyword
    short, long_ = ([F.lit(m) for m in lengths if (m > LONG_KEYWORD) == far] for far in (False, True))
    begins, whole = word_filter(asked.select(F.col("first").alias("h"))), word_filter(asked.select("h"))
    none = F.array().cast("array<string>")
    words, gaps, pos, n, m = F.col("words"), F.col("gaps"), F.col("pos"), F.size("words"), F.col("m")
    q = pos - n
    is_word = pos < n

    def run(size: Column) -> tuple[Column, Column]:
        return F.slice(words, pos + 1, size), F.slice(gaps, pos + 2, size - 1)

    here = post_places(posts.select(key, "txt"), key, (), with_runs, outer=True)
    here = here.where((is_word | ((q > 0) & (q < n))) & begins(F.xxhash64("term")))
    sizes = F.when(~is_word, F.array(F.lit(0))).otherwise(F.array(*short).cast("array<int>"))
    if long_:
        far = word_filter(asked.where("start is not null").select(F.col("start").alias("h")))
        begun = is_word & (pos + LONG_KEYWORD <= n) & far(F.xxhash64(*run(F.lit(LONG_KEYWORD))))
        sizes = F.concat(sizes, F.when(begun, F.array(*long_)).otherwise(F.array().cast("array<int>")))
    # One row per length, not a lambda over them: a slice inside a lambda copies all words of the text.
    sized = here.select(key, "words", "gaps", "pos", "term", F.explode_outer(sizes).alias("m")).where(~is_word | (pos + m <= n))
    h = F.when(is_word, F.xxhash64(m, *run(m))).otherwise(F.xxhash64(F.lit(0), F.array("term"), none))
    found = sized.select(key, "words", "gaps", "pos", "m", h.alias("h")).where(whole(F.col("h")))
    end = pos + m
    gap = F.get(gaps, end)
    end_s = (F.get(words, end) == "s") & gap.endswith(F.lit("'"))
    return found.select(
        key, "h",
        F.when(is_word & (pos > 0), F.xxhash64(F.get(gaps, pos))).alias("before"),
        F.when(is_word & (end < n), F.xxhash64(gap)).alias("after"),
        F.when(is_word & end_s, F.xxhash64(F.substr(gap, F.lit(1), F.length(gap) - 1))).alias("after_s"),
        F.when(~is_word, F.xxhash64(F.get(words, q))).alias("next"))


def position_join(posts: DataFrame, anchors: DataFrame, key: str, with_runs: bool) -> DataFrame:
    """``match_candidates`` for catalogs beyond the broadcast limit: no exchange carries a text.

    Posts become rows of hashes, one per run of words that may be a keyword (``hashed_windows``). They meet the keywords by
    the hash of all words and the gaps between, so that a word of many keywords does not meet all of them; what must stand
    around is compared in the same row. Hashes have 64 bits. All joins are sort-merge joins on shuffled rows, whose hot
    runs adaptive execution splits; no side is broadcast.
    """
    asked = asked_windows(anchors)

    def same(have: str, want: str, *others: Column) -> Column:
        test = F.col(have) == F.col(want)
        for o in others:
            test = test | o
        return F.col(want).isNull() | F.coalesce(test, F.lit(False))

    checked = (hashed_windows(posts, key, with_runs, asked).join(asked.hint("merge"), "h")
               .where(same("before", "w_before") & same("after", "w_after", F.col("after_s") == F.col("w_after")) & same("next", "w_bare"))
               .select(key, "kid").distinct())
    hits = anchors.groupBy(F.xxhash64("keyword").alias("kid")).agg(F.any_value("keyword").alias("keyword"), F.any_value("hit").alias("hit"))
    return checked.join(hits.hint("merge"), "kid").select(key, "keyword", "hit")


def hit_order() -> Column:
    """Least first: highest score, then the catalog's order (any orderable type), then the keyword's."""
    return F.struct((-F.col("hit.score")).alias("o0"), F.col("hit.cat_ord").alias("o1"), F.col("hit.kw_ord").alias("o2"))


def best_match(verified: DataFrame, key: str) -> DataFrame:
    """Arg-max per post: highest score, then lowest catalog ordinal, then keyword ordinal."""
    return verified.groupBy(key).agg(F.min_by(F.col("hit"), hit_order()).alias("best"))


@dataclass
class Anchors:
    best_per_keyword: DataFrame
    anchors: DataFrame
    broadcast: bool
    with_runs: bool


@dataclass
class LinkPlan:
    keywords: DataFrame
    anchors: DataFrame
    verified: DataFrame
    best: DataFrame
    broadcast: bool


def prepare_anchors(catalog: DataFrame, posts: DataFrame | None = None, ord_col: str = "cat_ord",
                    rules: KeywordRules = DEFAULT_RULES, weights: MatchWeights = DEFAULT_WEIGHTS,
                    broadcast_rows: int = BROADCAST_ANCHOR_ROWS, broadcast_bytes: int = BROADCAST_BYTES,
                    keywords: DataFrame | None = None) -> Anchors:
    """Catalog side of the link, materialised once.

    Keyword generation, the per-text winner and the anchor terms are small next to the posts: they are
    checkpointed into the shared folder (lineage cut, survives executor loss), and one small aggregate
    over them gives the row count and size that decide broadcast or shuffle. With ``posts`` (column
    ``txt``) anchors are chosen by the terms' frequency in them, which takes a pass over the posts; without, by
    their frequency among the keywords. The choice changes the work, never the result. ``keywords`` takes a
    keyword table made before.
    """
    keywords = keyword_table(catalog, ord_col=ord_col, rules=rules) if keywords is None else keywords
    best_kw = materialize(best_per_keyword(keywords, ord_col=ord_col, w=weights))
    frequencies = None
    if posts is not None:
        small = fits_broadcast(size_stats(best_kw.select("keyword")), broadcast_rows, broadcast_bytes)
        frequencies = token_frequencies(posts, anchor_terms(best_kw), small)
    anchors = materialize(keyword_anchors(best_kw, frequencies))
    stats = size_stats(anchors, F.count_if(F.col("k") < 0).alias("runs"))
    return Anchors(best_kw, anchors, fits_broadcast(stats, broadcast_rows, broadcast_bytes), stats["runs"] > 0)


def plan_link(posts: DataFrame, catalog: DataFrame, key: str = "post_id",
              ord_col: str = "cat_ord", rules: KeywordRules = DEFAULT_RULES,
              weights: MatchWeights = DEFAULT_WEIGHTS,
              broadcast_rows: int = BROADCAST_ANCHOR_ROWS) -> LinkPlan:
    """Build the link plan. ``posts`` needs ``key`` and ``txt`` (see ``search_text``)."""
    a = prepare_anchors(catalog, posts, ord_col, rules, weights, broadcast_rows)
    verified = match_candidates(posts, a.anchors, key, with_runs=a.with_runs, broadcast_ok=a.broadcast)
    return LinkPlan(keyword_table(catalog, ord_col=ord_col, rules=rules), a.anchors, verified, best_match(verified, key), a.broadcast)


def match_posts(posts: DataFrame, catalog: DataFrame, key: str = "post_id",
                title: str = "title", body: str = "selftext", author: str = "author",
                created: str = "created_date", permalink: str = "permalink",
                label_patterns: dict[str, str] | None = None,
                permalink_prefix: str = PERMALINK_PREFIX,
                layout_partitions: int | None = None, anchors: Anchors | None = None,
                **kw) -> DataFrame:
    """Every post once: best catalog link ('' when none) and detected issue labels.

    ``key`` must identify a post row uniquely (for dumps, where the same post
    can appear in two files, use file path + position).

    Posts are tokenised, joined and verified on the scan's own splits; only slim rows reach the
    arg-max. ``layout_partitions`` spreads a tiny input that arrives in fewer splits than there are
    cores (it shuffles the texts, so it is off by default). ``anchors`` takes a catalog prepared
    before (``prepare_anchors``), for callers that link many batches.
    """
    prepared = posts.select(key, author, created, permalink,
                            search_text(F.col(title), F.col(body)).alias("txt"))
    if layout_partitions:
        prepared = prepared.repartition(layout_partitions, key)
    a = anchors or prepare_anchors(catalog, prepared.select("txt"), **kw)
    cols = [F.col(author).alias("reddit_author"), F.col(created).alias("reddit_date"),
            F.concat(F.lit(permalink_prefix), F.coalesce(F.col(permalink), F.lit(""))).alias("reddit_permalink"),
            F.array_join(detect_labels(F.col("txt"), label_patterns), ", ").alias("detected_issues")]
    names = ["reddit_author", "reddit_date", "reddit_permalink", "detected_issues"]
    if a.broadcast:
        best = _one_pass(prepared.select(key, "txt", *cols), a, key, names)
    else:
        verified = match_candidates(prepared.select(key, "txt"), a.anchors, key, a.with_runs, False)
        best = prepared.select(key, *cols).hint("merge").join(best_match(verified, key), key, "left")
    blank = F.lit("")
    return best.select(
        key,
        F.coalesce(F.col("best.figure_name"), blank).alias("figure_name"),
        F.coalesce(F.col("best.brand"), blank).alias("brand"),
        F.coalesce(F.col("best.product_line"), blank).alias("product_line"),
        "reddit_author", "reddit_date", "reddit_permalink",
        F.coalesce(F.col("best.matched_keyword"), blank).alias("matched_keyword"),
        F.coalesce(F.col("best.match_type"), blank).alias("match_type"),
        F.coalesce(F.col("best.confidence"), blank).alias("confidence"),
        "detected_issues")


def _one_pass(posts: DataFrame, a: Anchors, key: str, carry: list[str]) -> DataFrame:
    """Link without joining back: every post keeps one base row (a place with ``BASE_TERM``, which meets an anchor
    row without a hit) next to its verified hits, then one aggregate per key.

    Texts stay on the scan's own splits: only (key, hit, carried columns) reach the
    aggregate's shuffle, and columns nobody reads are not computed.
    """
    places = post_places(posts, key, tuple(carry), a.with_runs, outer=True, base=True)
    none = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in a.anchors.schema}
    base = posts.sparkSession.range(1).select(*(none | {"anchor": F.lit(BASE_TERM).alias("anchor")}).values())
    j = places.join(F.broadcast(a.anchors.unionByName(base)), F.col("term") == F.col("anchor"))
    # The check stands in the filter alone: what passes it is a hit or a base row, which has none.
    kept = j.where((F.col("term") == BASE_TERM) | verify_place())
    order = F.when(F.col("hit").isNotNull(), hit_order())
    # Project before aggregating, so no text is shuffled. Carried columns are the same in all rows of a key.
    slim = kept.select(key, *carry, "hit", order.alias("hit_order"))
    return slim.groupBy(key).agg(F.min_by("hit", "hit_order").alias("best"),
                                 *[F.any_value(c).alias(c) for c in carry])
