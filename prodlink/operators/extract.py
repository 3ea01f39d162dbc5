"""Stage 1: listing documents -> product catalog.

``split_records`` turns one row per document into one row per section (the
only fan-out); everything after it is a per-row projection or filter, so the
stage has no shuffle at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import WS, drop_comment_lines, first_group, js_trim, normalize_text, to_fixed2

# Fixed value: JPY -> USD rate of the source (a parameter of build_catalog).
JPY_TO_USD = 0.0069

CATALOG_COLUMNS = ["gcode", "name", "brand", "product_line", "series_title", "release_date",
                   "sculptor", "material", "spec", "status", "price_jpy", "price_usd"]

S = WS  # JS \s
# Field patterns of the listing format (first match, case-insensitive),
# written for Java regex: S is JS whitespace, \z is JS's end of input.
P_GCODE = r"(?mi)^FIGURE-\d+"
P_RELEASE = rf"(?i)Release Date{S}+([^\t\n]+)"
P_BRAND = rf"(?i)Brand{S}+(.+?)(?:\n|\z)"
P_LINE = rf"(?i)Product Line{S}+(.+?)(?:\n|\z)"
P_SERIES = rf"(?i)Series Title{S}+(.+?)(?:\n|\z)"
P_NAME = rf"(?i)Character Name{S}+(.+?)(?:\n|Sculptor|\z)"
P_SCULPTOR = rf"(?i)Sculptor{S}+(.+?)(?:{S}*\n|\z)"
P_PRICE = rf"(?i)(?:List Price|Price)[:{S[1:-1]}]+\u00A5?([\d,]+)"
P_SPEC = rf"(?is)Specifications{S}+(.+?)(?=\[Set Contents\]|Details|Copyright|FIGURE-\d+|\z)"
P_MATERIAL = rf"(?i)Material:{S}*(.+?)(?:\n|\z)"
P_ABOUT = rf"(?i)about{S}+this{S}+item"


def prepare_document(value: Column) -> Column:
    return drop_comment_lines(normalize_text(value))


def split_records(docs: DataFrame, value: str = "value", keep: tuple[str, ...] = ("source", "path")) -> DataFrame:
    """(keep..., pos, section): split at a line that is exactly ``-``, positions kept."""
    return docs.select(*keep, F.posexplode(F.split(prepare_document(F.col(value)), "\n-\n", -1))
                       .alias("pos", "section"))


def is_candidate(section: Column) -> Column:
    """A section with a code line and at least 50 characters."""
    return section.rlike(P_GCODE) & (F.length(section) >= 50)


def extract_fields(section: Column) -> list[Column]:
    return [
        js_trim(F.regexp_extract(section, P_GCODE, 0)).alias("gcode"),
        first_group(section, P_NAME).alias("name"),
        first_group(section, P_BRAND).alias("brand"),
        first_group(section, P_LINE).alias("product_line"),
        first_group(section, P_SERIES).alias("series_title"),
        first_group(section, P_RELEASE).alias("release_date"),
        first_group(section, P_SCULPTOR).alias("sculptor"),
        F.lit("").alias("status"),
        section.rlike(P_ABOUT).alias("has_about"),
    ]


def extract_price(section: Column, rate: float = JPY_TO_USD) -> list[Column]:
    """price_jpy (commas removed, integer text) and price_usd (toFixed(2)); '' when absent."""
    digits = F.regexp_replace(F.regexp_extract(section, P_PRICE, 1), ",", "")
    jpy = digits.try_cast("bigint")
    has = section.rlike(P_PRICE) & jpy.isNotNull()
    return [F.when(has, jpy.cast("string")).otherwise("").alias("price_jpy"),
            F.when(has, to_fixed2(jpy.cast("double") * F.lit(rate))).otherwise("").alias("price_usd")]


def extract_spec(section: Column) -> list[Column]:
    spec = first_group(section, P_SPEC)
    return [spec.alias("spec"), first_group(spec, P_MATERIAL).alias("material")]


def parse_sections(sections: DataFrame, rate: float = JPY_TO_USD,
                   keep: tuple[str, ...] = ("source", "pos")) -> DataFrame:
    """Every candidate section -> all extracted columns (before the brand filter)."""
    s = F.col("section")
    return sections.where(is_candidate(s)).select(
        *keep, *extract_fields(s), *extract_price(s, rate), *extract_spec(s))


def filter_valid_records(parsed: DataFrame) -> DataFrame:
    return parsed.where((F.col("gcode") != "") & (F.col("brand") != ""))


def build_catalog(docs: DataFrame, rate: float = JPY_TO_USD) -> DataFrame:
    """Whole documents -> catalog rows (source, pos, catalog columns); no shuffle. For files that
    should be split over tasks see ``build_catalog_from_records``."""
    parsed = parse_sections(split_records(docs), rate)
    return filter_valid_records(parsed).select("source", "pos", *CATALOG_COLUMNS)


def build_catalog_from_records(records: DataFrame, rate: float = JPY_TO_USD) -> DataFrame:
    """Catalog rows from ``read_listing_records`` output (the reader already split
    the files, so a single huge file is spread over many input splits).

    Normalisation and comment removal run per record, then the record is split once more, for
    separators that only show after them (CRLF files). ``pos`` is the struct (path, block, n, part):
    the file, the input split's start, the record's order inside its split, the part of the record.
    """
    return catalog_of(parse_records(records, rate))


def parse_records(records: DataFrame, rate: float = JPY_TO_USD) -> DataFrame:
    """Every section of ``read_listing_records`` output parsed: source, pos, blank, candidate and the catalog columns."""
    parts = (records.select("source", "path", "block", "n",
                            F.posexplode(F.split(prepare_document(F.col("section")), r"\n-\n", -1)).alias("part", "section"))
             .select("source", F.struct("path", "block", "n", "part").alias("pos"), "section"))
    s = F.col("section")
    flagged = parts.select("*", is_candidate(s).alias("candidate"))
    columns = [*extract_fields(s), *extract_price(s, rate), *extract_spec(s)]
    return flagged.select("source", "pos", (js_trim(s) == "").alias("blank"), "candidate", *columns)


def catalog_of(parsed: DataFrame) -> DataFrame:
    """The products among ``parse_records`` output."""
    return filter_valid_records(parsed.where("candidate")).select("source", "pos", *CATALOG_COLUMNS)


def count_parsed(parsed: DataFrame) -> DataFrame:
    """``count_sections`` from ``parse_records`` output."""
    kept = F.col("candidate") & (F.col("gcode") != "") & (F.col("brand") != "")
    return parsed.groupBy("source").agg(F.count_if(~F.col("blank")).alias("sections"), F.count_if("candidate").alias("parsed"),
                                        F.count_if(kept).alias("kept"))


def count_sections(sections: DataFrame) -> DataFrame:
    """Per source: non-blank sections, parsed products, products kept."""
    s = F.col("section")
    cand = is_candidate(s)
    kept = cand & (first_group(s, P_BRAND) != "")
    return sections.groupBy("source").agg(
        F.count_if(js_trim(s) != "").alias("sections"),
        F.count_if(cand).alias("parsed"),
        F.count_if(kept).alias("kept"))
