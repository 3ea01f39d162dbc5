"""Column helpers that reproduce the source dialect's string rules on Spark.

Every helper is ``Column -> Column`` built from native Spark SQL functions, so it
stays inside whole-stage codegen. The rules that differ between the source
dialect (JavaScript regex / string methods) and Java regex are handled here:

* JS ``\\s`` is Unicode-aware and JS ``trim`` strips all of it; Spark ``trim``
  strips spaces only.  -> ``WS`` class and ``js_trim``.
* JS ``\\b`` is an ASCII word boundary; Java's ``\\b`` is partly Unicode-aware.
  -> ``B`` look-around pair.
* JS ``$`` without the m flag is end of input; Java's also matches before a final
  newline. -> ``\\z``.
* ``Number.toFixed(2)`` rounds the exact binary double; ``round`` rounds the
  decimal text. -> ``format_number(x, '0.00')``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# JS whitespace: \t \n \v \f \r, space, NBSP, Ogham space mark, U+2000..U+200A,
# line/paragraph separators, narrow NBSP, medium math space, ideographic space, BOM.
WS = r"[\t\n\x0B\f\r \u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\uFEFF]"
WORD = r"[A-Za-z0-9_]"
NONWORD = r"[^A-Za-z0-9_]"
# ASCII word boundary (JS \b without the u flag).
B = rf"(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))"

_REGEX_META = r"([.*+?^${}()|\[\]\\])"


def js_regex(pattern: str) -> str:
    """Translate a JS-flavoured pattern to Java: ``\\b`` -> ``B``, ``\\s`` -> ``WS``.

    Only escapes outside character classes are rewritten; the patterns used in
    this package do not put ``\\s`` or ``\\b`` inside a class.
    """
    out, i, in_class = [], 0, False
    while i < len(pattern):
        c = pattern[i]
        if c == "\\" and i + 1 < len(pattern):
            nxt = pattern[i + 1]
            if not in_class and nxt == "b":
                out.append(B)
            elif not in_class and nxt == "s":
                out.append(WS)
            else:
                out.append(pattern[i:i + 2])
            i += 2
            continue
        if c == "[":
            in_class = True
        elif c == "]":
            in_class = False
        out.append(c)
        i += 1
    return "".join(out)


def js_trim(c: Column) -> Column:
    """``String.prototype.trim``: strip JS whitespace at both ends."""
    return F.regexp_replace(c, rf"\A{WS}+|{WS}+\z", "")


def regex_escape(c: Column) -> Column:
    """Escape regex metacharacters of a data value (same set as the source)."""
    return F.regexp_replace(c, _REGEX_META, r"\\$1")


def regex_escape_py(s: str) -> str:
    return re.sub(r"([.*+?^${}()|\[\]\\])", r"\\\1", s)


def first_group(c: Column, pattern: str, group: int = 1) -> Column:
    """First match of ``pattern`` (group ``group``), trimmed, ``''`` when absent."""
    return js_trim(F.regexp_extract(c, pattern, group))


def to_fixed2(x: Column) -> Column:
    """``Number.toFixed(2)``: ``format_number(x, '0.00')`` rounds the exact binary double."""
    return F.call_function("format_number", x, F.lit("0.00"))


def normalize_text(c: Column) -> Column:
    """Drop a leading BOM, CRLF/CR -> LF, remove zero-width characters."""
    c = F.regexp_replace(c, r"\A\uFEFF", "")
    c = F.regexp_replace(c, r"\r\n?", "\n")
    return F.regexp_replace(c, r"[\u200B-\u200D\uFEFF]", "")


def drop_comment_lines(c: Column) -> Column:
    """Remove lines whose first non-blank character is ``#``."""
    lines = F.split(c, "\n", -1)
    kept = F.filter(lines, lambda ln: ~js_trim(ln).startswith("#"))
    return F.array_join(kept, "\n")


def text_preview(c: Column, n: int = 500) -> Column:
    """Newlines to spaces, then the first ``n`` characters (the preview feature)."""
    return F.substring(F.replace(F.coalesce(c, F.lit("")), F.lit("\n"), F.lit(" ")), 1, n)


_EPOCH_NTZ = "timestamp_ntz'1970-01-01 00:00:00'"


def epoch_to_iso(x: Column) -> Column:
    """Epoch seconds (double) -> ``yyyy-MM-ddTHH:mm:ss.SSSZ`` in UTC; 0/absent -> ''.

    Computed on TIMESTAMP_NTZ so the session time zone never shifts it; the
    millisecond value is truncated toward zero like a JS Date.
    """
    ms = (x * F.lit(1000.0)).cast("bigint")
    ts = F.timestamp_add("MILLISECOND", ms, F.expr(_EPOCH_NTZ))
    iso = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return F.when(F.coalesce(x, F.lit(0.0)) != 0, iso).otherwise(F.lit(""))


def ntz_epoch_seconds(ts: Column) -> Column:
    """Epoch seconds (double) of a TIMESTAMP_NTZ, independent of the session zone."""
    micros = F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), ts)
    return micros / F.lit(1e6)


# The strings the null-normaliser maps to null.
NULL_TOKENS = ["", "UNKNOWN", "unknown"]


def clean_text(c: Column) -> Column:
    """'' / UNKNOWN / unknown / null -> null; else trim and drop one edge quote each side."""
    cleaned = F.regexp_replace(js_trim(c), r'\A"|"\z', "")
    return F.when(c.isNull() | c.isin(*NULL_TOKENS), F.lit(None).cast("string")).otherwise(cleaned)


def extract_scale(spec: Column) -> Column:
    """``Scale:`` then ``1/n``, ``n:n`` or the rest of the line; null when absent."""
    pattern = rf"(?i)Scale:{WS}*(1/\d+|\d+:\d+|[^\n]+)"
    hit = F.regexp_extract(spec, pattern, 1)
    found = F.coalesce(spec, F.lit("")).rlike(pattern)
    return F.when(found, js_trim(hit)).otherwise(F.lit(None).cast("string"))


def age_bucket(release_date: Column, as_of_year: int | Column) -> Column:
    """New / 1 Year / n Years / Pre-order / Unknown from the first 4-digit run."""
    year = F.regexp_extract(F.lower(release_date), r"\d{4}", 0)
    as_of = F.lit(as_of_year) if isinstance(as_of_year, int) else as_of_year
    diff = as_of - year.try_cast("int")
    unknown = (release_date.isNull() | (release_date == "") | (release_date == "UNKNOWN")
               | (year == ""))
    return (F.when(unknown, "Unknown")
            .when(diff == 0, "New")
            .when(diff == 1, "1 Year")
            .when(diff > 1, F.concat(diff.cast("string"), F.lit(" Years")))
            .otherwise("Pre-order"))


def labels_to_json(c: Column) -> Column:
    """'a, b' -> '["a","b"]'; blank -> '[]' (split on commas, trim, drop empties)."""
    parts = F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ",", -1), js_trim),
                     lambda p: p != "")
    return F.to_json(parts)
