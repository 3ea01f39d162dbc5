"""Keyword generation: one catalog string -> ordered array<struct<text, priority, type>>.

The whole rule set is a single array expression (no UDF), so keyword
generation runs inside the catalog scan's codegen stage. Order matters for
tie-breaking downstream, so the array keeps emission order:

1. full lower-cased string                                    (1, full)
2. parentheticals removed, if changed and non-empty           (2, no-parens)
3. each parenthetical's content, >= 4 chars                    (2, parens-content)
4. version suffix removed, if it differs from 1 and 2          (2, no-version)
5. word 2-grams >= 8 and 3-grams >= 12 chars, by start word    (3, phrase)
6. single words >= 6 chars not in the stop list                (4, word)
7. a hyphen-free copy of every keyword holding '-', >= 4 chars (same priority/type)
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import WS, js_trim

# Words never used alone as keywords ("version" is deliberately absent).
STOP_WORDS = ["figure", "edition", "special", "limited", "exclusive", "series", "collection"]


@dataclass(frozen=True)
class KeywordRules:
    """Thresholds of the generator (defaults are the source's fixed values)."""
    parens_min: int = 4
    pair_min: int = 8
    triple_min: int = 12
    word_min: int = 6
    dehyphen_min: int = 4
    stop_words: tuple = field(default_factory=lambda: tuple(STOP_WORDS))


DEFAULT_RULES = KeywordRules()


def _kw(text: Column, priority: int, kind: str) -> Column:
    return F.struct(text.alias("text"), F.lit(priority).alias("priority"), F.lit(kind).alias("type"))


KEYWORD_ARRAY = "array<struct<text:string,priority:int,type:string>>"


def _empty() -> Column:
    return F.array().cast(KEYWORD_ARRAY)


def parens_removed(low: Column) -> Column:
    return js_trim(F.regexp_replace(low, r"\([^)]*\)", ""))


def version_removed(low: Column) -> Column:
    return js_trim(F.regexp_replace(low, rf"(?i){WS}*v(?:er)?\.?{WS}*\d+(?:\.\d+)?", ""))


def name_words(nop: Column) -> Column:
    return F.filter(F.split(nop, rf"{WS}+", -1), lambda w: F.length(w) > 0)


def word_ngrams(words: Column, rules: KeywordRules = DEFAULT_RULES) -> Column:
    """2-grams (>= pair_min) and 3-grams (>= triple_min), 2-gram first at each start."""
    n = F.size(words)

    def at(i: Column) -> Column:
        two = F.array_join(F.slice(words, i + 1, 2), " ")
        three = F.array_join(F.slice(words, i + 1, 3), " ")
        return F.filter(F.array(
            F.when(F.length(two) >= rules.pair_min, _kw(two, 3, "phrase")),
            F.when((i < n - 2) & (F.length(three) >= rules.triple_min), _kw(three, 3, "phrase")),
        ), lambda k: k.isNotNull())

    return F.when(n >= 2, F.flatten(F.transform(F.sequence(F.lit(0), n - 2), at))).otherwise(_empty())


def significant_words(words: Column, rules: KeywordRules = DEFAULT_RULES) -> Column:
    keep = F.filter(words, lambda w: (F.length(w) >= rules.word_min)
                    & ~w.isin(*rules.stop_words))
    return F.transform(keep, lambda w: _kw(w, 4, "word"))


def dehyphenate(kws: Column, rules: KeywordRules = DEFAULT_RULES) -> Column:
    """Append a hyphen-free copy of every keyword that holds '-' (same priority/type)."""
    plain = lambda k: F.replace(k["text"], F.lit("-"), F.lit(""))
    extra = F.transform(
        F.filter(kws, lambda k: F.contains(k["text"], F.lit("-"))
                 & (F.length(plain(k)) >= rules.dehyphen_min)),
        lambda k: F.struct(plain(k).alias("text"), k["priority"].alias("priority"),
                           k["type"].alias("type")))
    return F.concat(kws, extra)


def name_parts(s: Column) -> dict[str, Column]:
    """What the rules read of one string: lower-cased, without parentheticals, without version."""
    low = F.lower(s)
    return {"low": low, "nop": parens_removed(low), "nov": version_removed(low)}


def keywords_of_parts(low: Column, nop: Column, nov: Column, words: Column, rules: KeywordRules = DEFAULT_RULES) -> Column:
    """Rules 1-6 in emission order (no hyphen-free copies); empty for null / ''."""
    no_parens = F.when((nop != "") & (nop != low), F.array(_kw(nop, 2, "no-parens"))).otherwise(_empty())
    inside = F.filter(
        F.transform(F.regexp_extract_all(low, F.lit(r"\(([^)]+)\)"), 0),
                    lambda m: js_trim(F.regexp_replace(m, r"[()]", ""))),
        lambda t: F.length(t) >= rules.parens_min)
    parens_content = F.transform(inside, lambda t: _kw(t, 2, "parens-content"))
    no_version = F.when((nov != "") & (nov != low) & (nov != nop),
                        F.array(_kw(nov, 2, "no-version"))).otherwise(_empty())
    base = F.concat(F.array(_kw(low, 1, "full")), no_parens, parens_content, no_version,
                    word_ngrams(words, rules), significant_words(words, rules))
    return F.when(F.coalesce(low, F.lit("")) == "", _empty()).otherwise(base)


def base_keywords(s: Column, rules: KeywordRules = DEFAULT_RULES) -> Column:
    """Rules 1-6 for one string."""
    p = name_parts(s)
    return keywords_of_parts(p["low"], p["nop"], p["nov"], name_words(p["nop"]), rules)


def gen_keywords(s: Column, rules: KeywordRules = DEFAULT_RULES) -> Column:
    """Ordered keyword structs for one string (rules 1-7); empty for null / ''."""
    return dehyphenate(base_keywords(s, rules), rules)


def with_keywords(df: DataFrame, sources: tuple[str, ...], name: str, rules: KeywordRules = DEFAULT_RULES) -> DataFrame:
    """``df`` with the keywords of all ``sources`` in one array: ``gen_keywords`` of each, concatenated.

    Step by step, so that every intermediate value is computed once a row and not once for each use of it.
    """
    columns = df.columns
    parts = [(f"_{i}_{part}", c) for i, s in enumerate(sources) for part, c in name_parts(F.col(s)).items()]
    df = df.select(*columns, *[c.alias(n) for n, c in parts])
    df = df.select("*", *[name_words(F.col(f"_{i}_nop")).alias(f"_{i}_words") for i in range(len(sources))])
    df = df.select(*columns, *[keywords_of_parts(*(F.col(f"_{i}_{part}") for part in ("low", "nop", "nov", "words")), rules)
                               .alias(f"_{i}") for i in range(len(sources))])
    return df.select(*columns, F.concat(*[dehyphenate(F.col(f"_{i}"), rules) for i in range(len(sources))]).alias(name))
