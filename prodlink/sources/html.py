"""Heading text from collected web pages (the fetch itself is out of scope).

``<h1>`` elements as an HTML parser sees them: what stands in comments and in elements whose content is
plain text (scripts, styles ...) is no markup. Entities are HTML 5's: names with a semicolon, the older
names also without one (the longest that fits), numbers in decimal or hex with or without one.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Named entities with their characters, from the standard library: with a semicolon, and the older ones without.
ENTITIES = {name[:-1]: text for name, text in html5.items() if name.endswith(";")}
SHORT_ENTITIES = {name: text for name, text in html5.items() if not name.endswith(";")}

H1 = r"(?is)<h1(?:\s[^>]*)?>(.*?)(?:</h1\s*>|\z)"
# Comments, and elements whose content is text. Their tags go with it; one that is not closed reaches to the end.
_NO_MARKUP = (r"(?is)<!--.*?(?:--!?>|\z)|"
              r"<(script|style|textarea|title|xmp|iframe|noembed|noframes)\b[^>]*>.*?(?:</\1\b[^>]*>|\z)")
_NUMBER = r"\A#([xX][0-9A-Fa-f]+|[0-9]+);?"
_NAME = r"\A([A-Za-z][A-Za-z0-9]*);"
_SHORT = r"\A(" + "|".join(sorted(SHORT_ENTITIES, key=lambda n: (-len(n), n))) + ")"
# Numbers 128 to 159 mean the characters of that place in Windows' code page, where it has one.
_OLD_NUMBERS = {str(i): bytes([i]).decode("cp1252", "ignore") for i in range(128, 160) if bytes([i]).decode("cp1252", "ignore")}


def _lookup(names: dict[str, str]) -> Column:
    """The names as one map literal."""
    return F.from_json(F.lit(json.dumps(names)), "map<string,string>")


def _character(code: Column) -> Column:
    """The character of a code point (decimal text); U+FFFD where there is none."""
    n = code.try_cast("bigint")
    valid = n.between(1, 0x10FFFF) & ~n.between(0xD800, 0xDFFF)
    char = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")).otherwise(F.lit("�"))
    return F.coalesce(F.try_element_at(_lookup(_OLD_NUMBERS), n.cast("string")), char)


def unescape_entities(c: Column) -> Column:
    """Decode numeric and named entities, each once; anything else that starts with ``&`` stays. Texts without ``&``
    are passed on as they are."""
    named, short = _lookup(ENTITIES), _lookup(SHORT_ENTITIES)

    def decoded(part: Column) -> Column:
        number, name, old = (F.regexp_extract(part, p, 1) for p in (_NUMBER, _NAME, _SHORT))
        code = F.when(F.lower(number).startswith("x"), F.conv(F.substring(number, 2, 99), 16, 10)).otherwise(number)
        full = F.try_element_at(named, name)
        return (F.when(number != "", F.concat(_character(code), F.regexp_replace(part, _NUMBER, "")))
                .when(full.isNotNull(), F.concat(full, F.regexp_replace(part, _NAME, "")))
                .when(old != "", F.concat(F.element_at(short, old), F.regexp_replace(part, _SHORT, "")))
                .otherwise(F.concat(F.lit("&"), part)))

    parts = F.split(c, "&", -1)
    tail = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), decoded)
    return F.when(F.contains(c, F.lit("&")), F.concat(F.get(parts, F.lit(0)), F.array_join(tail, ""))).otherwise(c)


def heading_text(html: Column, pattern: str = H1) -> Column:
    """Text of every ``<h1>`` element, tags stripped, entities decoded, concatenated."""
    parts = F.regexp_extract_all(F.regexp_replace(html, _NO_MARKUP, ""), F.lit(pattern), 1)
    return F.array_join(F.transform(parts, lambda p: unescape_entities(F.regexp_replace(p, r"<[^>]*>", ""))), "")
