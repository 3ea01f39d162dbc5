"""Query registry: id -> (Spark builder, DuckDB oracle SQL or None).

Every builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole given tables. Column names are aliased identically in the oracle.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import keywords as K
from ..functions import text as T
from ..operators import enrich as N
from ..operators.catalog import union_catalogs
from ..operators import extract as X
from ..operators import link as L
from ..operators import posts as P
from ..operators import report as R
from ..operators import snapshot as SN
from ..session import scratch_path
from ..sources import csv_lenient as SC
from ..sources import html as H
from ..sources import json_dump as SJ
from ..sources import listing as SL
from ..streaming import dumps as ST
from . import derived as D
from . import oracle as O
from . import workflow as W

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: Builder) -> Builder:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


# Label dictionary suited to the driver's documents (the source's own seven
# labels never occur in them); used by the label queries next to the defaults.
DATA_LABELS = {
    **L.ISSUE_PATTERNS,
    "license_text": r"\blicen[cs]e",
    "email_address": r"\b[a-z0-9._]+@[a-z0-9.]+\.[a-z]+\b",
    "secret_word": r"\b(api[_-]?key|secret|password|token)\b",
    "year_number": r"\b(19|20)\d{2}\b",
}


# ====================================================================== keywords

def _kw_table(spark, sf):
    return L.keyword_table(D.catalog_from_benchmark(spark, sf))


@register("gen_keywords", O.with_(O.CAT_CTE, O.KW_STEPS) +
          "SELECT cat_ord, kw_ord, keyword, priority, match_type FROM kw")
def q_gen_keywords(spark, sf):
    return _kw_table(spark, sf).select("cat_ord", "kw_ord", "keyword", "priority", "match_type")


def _unpivot_sources(cat: DataFrame) -> DataFrame:
    return cat.select("cat_ord", F.explode(F.array(
        F.struct(F.lit(0).alias("src"), F.col("name").alias("s")),
        F.struct(F.lit(1).alias("src"), F.col("series_title").alias("s")))).alias("x")) \
        .select("cat_ord", "x.src", "x.s")


@register("word_ngrams", O.with_(O.CAT_CTE, O.KW_STEPS) + """
SELECT cat_ord, src, cast(generate_subscripts(k_phr, 1) - 1 AS integer) AS pos,
       struct_extract(unnest(k_phr), 'text') AS phrase
FROM kw_c""")
def q_word_ngrams(spark, sf):
    u = _unpivot_sources(D.catalog_from_benchmark(spark, sf))
    words = K.name_words(K.parens_removed(F.lower("s")))
    return u.select("cat_ord", "src", F.posexplode(K.word_ngrams(words)).alias("pos", "k")) \
        .select("cat_ord", "src", "pos", F.col("k.text").alias("phrase"))


@register("significant_words", O.with_(O.CAT_CTE, O.KW_STEPS) + """
SELECT cat_ord, src, cast(generate_subscripts(k_word, 1) - 1 AS integer) AS pos,
       struct_extract(unnest(k_word), 'text') AS word
FROM kw_c""")
def q_significant_words(spark, sf):
    u = _unpivot_sources(D.catalog_from_benchmark(spark, sf))
    words = K.name_words(K.parens_removed(F.lower("s")))
    return u.select("cat_ord", "src", F.posexplode(K.significant_words(words)).alias("pos", "k")) \
        .select("cat_ord", "src", "pos", F.col("k.text").alias("word"))


@register("dehyphenate", O.with_(O.CAT_CTE, O.KW_STEPS) + """
SELECT cat_ord, src, cast(generate_subscripts(extra, 1) - 1 AS integer) AS pos,
       struct_extract(unnest(extra), 'text') AS keyword,
       struct_extract(unnest(extra), 'priority') AS priority,
       struct_extract(unnest(extra), 'type') AS match_type
FROM (SELECT cat_ord, src, kws[len(base) + 1:] AS extra FROM kw_e)""")
def q_dehyphenate(spark, sf):
    """The hyphen-free copies that rule 7 appends, with their positions."""
    u = _unpivot_sources(D.catalog_from_benchmark(spark, sf))
    base = K.base_keywords(F.col("s"))
    full = K.dehyphenate(base)
    extra = F.slice(full, F.size(base) + 1, F.greatest(F.size(full) - F.size(base), F.lit(0)))
    return u.select("cat_ord", "src", F.posexplode(extra).alias("pos", "k")) \
        .select("cat_ord", "src", "pos", F.col("k.text").alias("keyword"),
                F.col("k.priority").alias("priority"), F.col("k.type").alias("match_type"))


@register("union_catalogs", O.with_(O.CAT_CTE) + """
SELECT CAST(cat_ord % 2 AS INTEGER) AS src_ord, cat_ord, name, brand FROM cat""")
def q_union_catalogs(spark, sf):
    cat = D.catalog_from_benchmark(spark, sf)
    return union_catalogs([cat.where("cat_ord % 2 = 0"), cat.where("cat_ord % 2 = 1")]) \
        .select("src_ord", "cat_ord", "name", "brand")


# ====================================================================== linking

def _posts_prepared(spark, sf):
    p = D.posts_from_documents(spark, sf)
    return p.select("post_id", L.search_text(F.col("title"), F.col("selftext")).alias("txt"))


def _link_plan(spark, sf):
    return L.plan_link(_posts_prepared(spark, sf), D.catalog_from_benchmark(spark, sf))


_LINK = O.with_(O.CAT_CTE, O.POST_CTE, O.KW_STEPS, O.HITS_STEPS)


# Words of the keywords (the last one also with an s) and the places of the posts where each stands.
_TERM_STEPS = r"""
kwords AS (
  SELECT keyword, unnest(w) AS run, generate_subscripts(w, 1) - 1 AS k, len(w) AS m, regexp_matches(keyword, '[A-Za-z0-9_]$') AS ends
  FROM (SELECT keyword, regexp_extract_all(keyword, '[A-Za-z0-9_]+') AS w FROM kwt)),
kterms AS (
  SELECT keyword, k, run, run AS term FROM kwords
  UNION ALL SELECT keyword, k, run, run || 's' FROM kwords WHERE k = m - 1 AND ends),
places AS (
  SELECT unnest(regexp_extract_all(txt, '[A-Za-z0-9_]+')) AS term FROM pt
  UNION ALL SELECT unnest(regexp_extract_all(txt_nh, '[A-Za-z0-9_]+')) FROM pt WHERE contains(txt, '-')),
freq AS (SELECT term, count(*) AS n FROM places WHERE term IN (SELECT term FROM kterms) GROUP BY term),
picked AS (
  SELECT keyword, k FROM (
    SELECT keyword, k, row_number() OVER (PARTITION BY keyword ORDER BY sum(coalesce(n, 0)), -length(run), k) AS place
    FROM kterms LEFT JOIN freq USING (term) GROUP BY keyword, k, run) WHERE place = 1)"""


@register("token_frequencies", _LINK.rstrip() + "," + _TERM_STEPS + " SELECT term, n FROM freq")
def q_token_frequencies(spark, sf):
    """How often each word of a keyword stands in the posts: what its use as an anchor costs."""
    best = L.best_per_keyword(L.keyword_table(D.catalog_from_benchmark(spark, sf)))
    return L.token_frequencies(_posts_prepared(spark, sf), L.anchor_terms(best), broadcast_ok=False)


@register("keyword_anchors", _LINK.rstrip() + "," + _TERM_STEPS + """
SELECT keyword, cast(k AS integer) AS k, term AS anchor FROM kterms SEMI JOIN picked USING (keyword, k)""")
def q_keyword_anchors(spark, sf):
    """Each keyword's rarest word, the equality term of the containment join."""
    posts = _posts_prepared(spark, sf)
    return L.prepare_anchors(D.catalog_from_benchmark(spark, sf), posts).anchors.where("k >= 0").select("keyword", "k", "anchor")


@register("regex_escape", _LINK + r"""
SELECT keyword, regexp_replace(keyword, '([.*+?^${}()|\[\]\\])', '\\\1', 'g') AS escaped FROM kwt""")
def q_regex_escape(spark, sf):
    """Keywords with their regex metacharacters escaped, as a boundary pattern holds them."""
    k = _kw_table(spark, sf).where(F.length("keyword") >= 4).select("keyword").distinct()
    return k.select("keyword", T.regex_escape(F.col("keyword")).alias("escaped"))


@register("match_candidates", _LINK + "SELECT DISTINCT post_id, keyword FROM vhit")
def q_match_candidates(spark, sf):
    return _link_plan(spark, sf).verified.select("post_id", "keyword").distinct()


@register("match_score", _LINK + "SELECT post_id, keyword, max(score) AS score FROM allhit GROUP BY 1, 2")
def q_match_score(spark, sf):
    v = _link_plan(spark, sf).verified
    return v.groupBy("post_id", "keyword").agg(F.max("hit.score").alias("score"))


@register("best_match", _LINK + """
SELECT post_id, cat_ord, kw_ord, score, name AS figure_name, keyword AS matched_keyword FROM best""")
def q_best_match(spark, sf):
    b = _link_plan(spark, sf).best
    return b.select("post_id", F.col("best.cat_ord").alias("cat_ord"), F.col("best.kw_ord").alias("kw_ord"),
                    F.col("best.score").alias("score"), F.col("best.figure_name").alias("figure_name"),
                    F.col("best.matched_keyword").alias("matched_keyword"))


@register("match_confidence", _LINK + """
SELECT post_id, keyword AS matched_keyword, priority, confidence FROM best""")
def q_match_confidence(spark, sf):
    b = _link_plan(spark, sf).best
    return b.select("post_id", F.col("best.matched_keyword").alias("matched_keyword"),
                    F.col("best.priority").alias("priority"), F.col("best.confidence").alias("confidence"))


def _match_posts(spark, sf, labels=None, layout_partitions=None):
    posts = D.posts_from_documents(spark, sf).withColumn("created_date", T.epoch_to_iso(F.col("created_utc")))
    return L.match_posts(posts, D.catalog_from_benchmark(spark, sf), label_patterns=labels,
                         layout_partitions=layout_partitions)


def _match_posts_sql(labels=None) -> str:
    return _LINK + f"""
SELECT p.post_id, coalesce(b.name, '') AS figure_name, coalesce(b.brand, '') AS brand,
  coalesce(b.product_line, '') AS product_line, p.author AS reddit_author,
  {O.iso_sql('p.created_utc')} AS reddit_date, 'https://reddit.com' || p.permalink AS reddit_permalink,
  coalesce(b.keyword, '') AS matched_keyword, coalesce(b.match_type, '') AS match_type,
  coalesce(b.confidence, '') AS confidence, array_to_string({O.labels_sql('p.txt', labels)}, ', ') AS detected_issues
FROM ptxt p LEFT JOIN best b USING (post_id)"""


@register("match_posts", _match_posts_sql())
def q_match_posts(spark, sf):
    return _match_posts(spark, sf)


_DUMP_LINK = O.with_(O.CAT_CTE, re.sub(r"text \|\| coalesce\(.*?, ''\) AS selftext", "text AS selftext", O.POST_CTE).replace("substr(replace(text, chr(10), ' '), 1, 80) AS title", "'' AS title"),
                     O.KW_STEPS, O.HITS_STEPS)


@register("link_dump_posts", _match_posts_sql(DATA_LABELS).replace(_LINK, _DUMP_LINK))
def q_link_dump_posts(spark, sf):
    """Posts parsed from listing dumps, linked and labelled on their whole bodies."""
    posts = P.build_posts(SJ.parse_listing_documents(D.document_dumps(spark, sf)))
    keyed = posts.withColumn("post_id", F.col("id").cast("bigint"))
    return L.match_posts(keyed, D.catalog_from_benchmark(spark, sf), label_patterns=DATA_LABELS)


@register("match_posts_shuffle", _match_posts_sql())
def q_match_posts_shuffle(spark, sf):
    """The path for catalogs beyond the broadcast limit, forced: no side is broadcast, no exchange carries a text."""
    posts = D.posts_from_documents(spark, sf).withColumn("created_date", T.epoch_to_iso(F.col("created_utc")))
    return L.match_posts(posts, D.catalog_from_benchmark(spark, sf), broadcast_rows=0)


@register("build_matches", _match_posts_sql(DATA_LABELS))
def q_build_matches(spark, sf):
    return _match_posts(spark, sf, DATA_LABELS)


@register("count_matches", _LINK + """
SELECT count(b.post_id) AS matched, count(*) - count(b.post_id) AS unmatched
FROM ptxt p LEFT JOIN best b USING (post_id)""")
def q_count_matches(spark, sf):
    return R.count_matches(_match_posts(spark, sf))


@register("detect_labels", O.with_(O.POST_CTE) + f"""
SELECT post_id, array_to_string({O.labels_sql('txt', DATA_LABELS)}, ', ') AS detected_issues FROM ptxt""")
def q_detect_labels(spark, sf):
    p = _posts_prepared(spark, sf)
    return p.select("post_id", F.array_join(L.detect_labels(F.col("txt"), DATA_LABELS), ", ")
                    .alias("detected_issues"))


@register("labels_to_json", O.with_(O.POST_CTE) + f"""
SELECT post_id, to_json({O.labels_sql('txt', DATA_LABELS)})::varchar AS issues FROM ptxt""")
def q_labels_to_json(spark, sf):
    p = _posts_prepared(spark, sf)
    joined = F.array_join(L.detect_labels(F.col("txt"), DATA_LABELS), ", ")
    return p.select("post_id", T.labels_to_json(joined).alias("issues"))


# ====================================================================== enrichment


AS_OF_YEAR = 1999
_ENR = O.with_(O.ENR_CTE)
_COMB = O.with_(O.ENR_CTE, O.combined_sql(AS_OF_YEAR))


def _combined(spark, sf):
    matched = N.filter_matched(D.enrich_matches_from_part(spark, sf))
    return N.enrich_join(matched, D.enrich_catalog_from_part(spark, sf), AS_OF_YEAR)


@register("filter_matched", _ENR + "SELECT post_id, figure_name, brand FROM emm")
def q_filter_matched(spark, sf):
    return N.filter_matched(D.enrich_matches_from_part(spark, sf)).select("post_id", "figure_name", "brand")


@register("dedupe_last", _ENR + """
SELECT k_name, k_brand, r.cat_ord AS cat_ord, r.sculptor AS sculptor, r.release_date AS release_date FROM eclast""")
def q_dedupe_last(spark, sf):
    return N.dedupe_last(D.enrich_catalog_from_part(spark, sf)) \
        .select("k_name", "k_brand", "cat_ord", "sculptor", "release_date")


@register("dedupe_last_incremental", _ENR + """
SELECT k_name, k_brand, r.cat_ord AS cat_ord, r.sculptor AS sculptor, r.release_date AS release_date FROM eclast""")
def q_dedupe_last_incremental(spark, sf):
    """The last-wins catalog as a stored snapshot: three deliveries in mixed order, compacted after the second."""
    rows, path = D.enrich_catalog_from_part(spark, sf), scratch_path(spark, "snapshot")
    for part in (2, 0, 1):
        SN.add_rows(rows.where(F.col("cat_ord") % 3 == part), path)
        if part == 0:
            SN.compact(spark, path)
    return SN.read_snapshot(spark, path).select("k_name", "k_brand", "cat_ord", "sculptor", "release_date")


@register("enrich_join", _COMB + "SELECT * EXCLUDE (found) FROM comb")
def q_enrich_join(spark, sf):
    return _combined(spark, sf).drop("found")


@register("build_combined", _COMB + "SELECT post_id, " + ", ".join(N.COMBINED_COLUMNS) + " FROM comb")
def q_build_combined(spark, sf):
    return _combined(spark, sf).select("post_id", *N.COMBINED_COLUMNS)


@register("enrich_semi", _ENR + """
SELECT post_id, figure_name, brand FROM emm m
WHERE EXISTS (SELECT 1 FROM eclast l WHERE l.k_name = lower(m.figure_name) AND l.k_brand = lower(m.brand))""")
def q_enrich_semi(spark, sf):
    m = N.filter_matched(D.enrich_matches_from_part(spark, sf))
    return N.enrich_split(m, D.enrich_catalog_from_part(spark, sf), "left_semi").select("post_id", "figure_name", "brand")


@register("enrich_anti", _ENR + """
SELECT post_id, figure_name, brand FROM emm m
WHERE NOT EXISTS (SELECT 1 FROM eclast l WHERE l.k_name = lower(m.figure_name) AND l.k_brand = lower(m.brand))""")
def q_enrich_anti(spark, sf):
    m = N.filter_matched(D.enrich_matches_from_part(spark, sf))
    return N.enrich_split(m, D.enrich_catalog_from_part(spark, sf), "left_anti").select("post_id", "figure_name", "brand")


@register("count_enriched", _COMB + """
SELECT count(*) FILTER (WHERE found) AS found_in_catalog, count(*) FILTER (WHERE NOT found) AS missing_from_catalog FROM comb""")
def q_count_enriched(spark, sf):
    return R.count_enriched(_combined(spark, sf))


@register("clean_text", _ENR + f"""
SELECT cat_ord, {O.clean_sql('sculptor')} AS sculptor, {O.clean_sql('series_title')} AS series_title,
       {O.clean_sql('release_date')} AS release_date FROM ec""")
def q_clean_text(spark, sf):
    c = D.enrich_catalog_from_part(spark, sf)
    return c.select("cat_ord", T.clean_text(F.col("sculptor")).alias("sculptor"),
                    T.clean_text(F.col("series_title")).alias("series_title"),
                    T.clean_text(F.col("release_date")).alias("release_date"))


@register("extract_scale", _ENR + f"SELECT cat_ord, {O.scale_sql('spec')} AS scale FROM ec")
def q_extract_scale(spark, sf):
    c = D.enrich_catalog_from_part(spark, sf)
    return c.select("cat_ord", T.extract_scale(F.col("spec")).alias("scale"))


_ORDER_DATE_SQL = ("CASE WHEN o_orderkey % 13 = 0 THEN 'UNKNOWN' WHEN o_orderkey % 17 = 0 THEN '' "
                   "WHEN o_orderkey % 19 = 0 THEN 'mid ' || strftime(o_orderdate, '%b') ELSE "
                   "strftime(o_orderdate, '%b') || '-' || cast(year(o_orderdate) AS varchar) END")


@register("age_bucket", f"SELECT o_orderkey, {O.age_sql('d', AS_OF_YEAR)} AS age FROM "
          f"(SELECT o_orderkey, {_ORDER_DATE_SQL} AS d FROM orders)")
def q_age_bucket(spark, sf):
    o = D.table(spark, sf, "orders")
    k = F.col("o_orderkey")
    month = F.date_format("o_orderdate", "MMM")
    d = (F.when(k % 13 == 0, F.lit("UNKNOWN")).when(k % 17 == 0, F.lit(""))
         .when(k % 19 == 0, F.concat(F.lit("mid "), month))
         .otherwise(F.concat(month, F.lit("-"), F.year("o_orderdate").cast("string"))))
    return o.select("o_orderkey", T.age_bucket(d, AS_OF_YEAR).alias("age"))


def _faulty(spark, sf):
    return D.with_validation_faults(_combined(spark, sf))


_VAL = O.with_(O.ENR_CTE, O.combined_sql(AS_OF_YEAR), O.FAULTS_CTE)


@register("validate_records", _VAL + "SELECT post_id, cast(err_ord AS integer) AS err_ord, message FROM errs")
def q_validate_records(spark, sf):
    return N.validate_records(_faulty(spark, sf))


@register("count_errors", _VAL + """
SELECT (SELECT count(*) FROM errs) AS total_errors,
       (SELECT count(DISTINCT post_id) FROM errs) AS records_with_errors,
       (SELECT count(*) FROM errs) = 0 AS passed""")
def q_count_errors(spark, sf):
    return R.count_errors(N.validate_records(_faulty(spark, sf)))


@register("top_errors", _VAL + """
SELECT post_id, cast(err_ord AS integer) AS err_ord, message,
       greatest((SELECT count(*) FROM errs) - 10, 0) AS more
FROM errs ORDER BY post_id, err_ord LIMIT 10""")
def q_top_errors(spark, sf):
    return R.top_errors(N.validate_records(_faulty(spark, sf)), n=10)


# ====================================================================== listings -> catalog


_LIST = O.with_(O.LIST_CTE)


def _listing_docs(spark, sf):
    return SL.read_listing_text(spark, D.write_listing_files(spark, sf), pattern="*/*.txt")


@register("src_listing_records", _LIST + f"SELECT source, {O.CATALOG_COLS} FROM lcat WHERE brand <> ''")
def q_src_listing_records(spark, sf):
    """The splittable reader: records cut by the reader, parsed one by one."""
    records = SL.read_listing_records(spark, D.write_listing_files(spark, sf), pattern="*/*.txt")
    return X.build_catalog_from_records(records).drop("pos")


def _sections(spark, sf):
    return X.split_records(_listing_docs(spark, sf))


@register("src_listing_text", _LIST + """
SELECT source, cast(sum(length(section)) + 3 * (count(*) - 1) + 1 AS bigint) AS n_chars FROM lsec GROUP BY source""")
def q_src_listing_text(spark, sf):
    return _listing_docs(spark, sf).select("source", F.length("value").cast("bigint").alias("n_chars"))


# The text writer ends every file with a newline, so the last section keeps one.
@register("split_records", _LIST + """
SELECT source, pos, section || CASE WHEN is_last THEN chr(10) ELSE '' END AS section FROM lsec""")
def q_split_records(spark, sf):
    return _sections(spark, sf).select("source", "pos", "section")


@register("count_sections", _LIST + """
SELECT source, count(*) AS sections, count(*) FILTER (WHERE p_partkey % 13 <> 0) AS parsed,
       count(*) FILTER (WHERE p_partkey % 13 <> 0 AND p_partkey % 17 <> 0) AS kept
FROM lsec GROUP BY source""")
def q_count_sections(spark, sf):
    return X.count_sections(_sections(spark, sf))


@register("extract_fields", _LIST + """
SELECT source, pos, gcode, name, brand, product_line, series_title, release_date, sculptor, status, has_about
FROM lcat""")
def q_extract_fields(spark, sf):
    s = _sections(spark, sf)
    return s.where(X.is_candidate(F.col("section"))).select("source", "pos", *X.extract_fields(F.col("section")))


@register("extract_price", _LIST + "SELECT source, pos, price_jpy, price_usd FROM lcat")
def q_extract_price(spark, sf):
    s = _sections(spark, sf)
    return s.where(X.is_candidate(F.col("section"))).select("source", "pos", *X.extract_price(F.col("section")))


@register("extract_spec", _LIST + "SELECT source, pos, spec, material FROM lcat")
def q_extract_spec(spark, sf):
    s = _sections(spark, sf)
    return s.where(X.is_candidate(F.col("section"))).select("source", "pos", *X.extract_spec(F.col("section")))


@register("filter_valid_records", _LIST + "SELECT source, pos, gcode, has_about FROM lcat WHERE brand <> ''")
def q_filter_valid_records(spark, sf):
    return X.filter_valid_records(X.parse_sections(_sections(spark, sf))).select("source", "pos", "gcode", "has_about")


@register("build_catalog", _LIST + f"SELECT source, pos, {O.CATALOG_COLS} FROM lcat WHERE brand <> ''")
def q_build_catalog(spark, sf):
    return X.build_catalog(_listing_docs(spark, sf))


# ====================================================================== text preparation, html



def _injected_documents(spark, sf):
    """documents.text with BOM / CR / zero-width / comment lines injected by key modulus."""
    d = D.table(spark, sf, "documents")
    k, t = F.col("doc_id"), F.col("text")
    t = F.when(k % 4 == 0, F.replace(t, F.lit("\n"), F.lit("\r\n"))) \
        .when(k % 7 == 0, F.replace(t, F.lit("\n"), F.lit("\r"))).otherwise(t)
    t = F.when(k % 5 == 0, F.replace(t, F.lit("."), F.lit(".\u200b"))).otherwise(t)
    t = F.when(k % 3 == 0, F.concat(F.lit("\ufeff"), t)).otherwise(t)
    t = F.when(k % 6 == 0, F.concat(F.lit("# page 1 of 3\n"), t)).otherwise(t)
    t = F.when(k % 9 == 0, F.concat(t, F.lit("\n   # trailing note"))).otherwise(t)
    return d.select("doc_id", t.alias("text"))


_NORM_SQL = ("regexp_replace(regexp_replace(regexp_replace(text, '^\\x{FEFF}', ''), '\\r\\n?', chr(10), 'g'), "
             "'[\\x{200B}-\\x{200D}\\x{FEFF}]', '', 'g')")


@register("normalize_text", f"""
SELECT doc_id, CASE WHEN doc_id % 6 = 0 THEN '# page 1 of 3' || chr(10) ELSE '' END || {_NORM_SQL}
  || CASE WHEN doc_id % 9 = 0 THEN chr(10) || '   # trailing note' ELSE '' END AS text FROM documents""")
def q_normalize_text(spark, sf):
    d = _injected_documents(spark, sf)
    return d.select("doc_id", T.normalize_text(F.col("text")).alias("text"))


@register("drop_comment_lines", f"""
SELECT doc_id, array_to_string(list_filter(string_split({_NORM_SQL}, chr(10)),
  lambda l: NOT regexp_matches(l, '^\\s*#')), chr(10)) AS text FROM documents""")
def q_drop_comment_lines(spark, sf):
    d = _injected_documents(spark, sf)
    return d.select("doc_id", X.prepare_document(F.col("text")).alias("text"))


@register("text_preview", "SELECT doc_id, substr(replace(coalesce(text, ''), chr(10), ' '), 1, 500) AS preview FROM documents")
def q_text_preview(spark, sf):
    d = D.table(spark, sf, "documents")
    return d.select("doc_id", T.text_preview(F.col("text")).alias("preview"))


# A heading with numeric, named, old, unknown, doubly escaped and broken entities, and markup that is none, put behind
# every fifth page, and the text that a parser finds there.
ODD_HEADING = ("<!-- <h1>old</h1> --><h1>caf&eacute; <b>don&#8217;t</b> &#xe9;&#X1F600; &amp;lt; &lt;i&gt; &bogus; & &;&nbsp;&hellip;</h1>"
               "<script>var x = '<h1>no</h1>';</script><H1 class='t'>A &amp B &rsquor; &check; &notit; &#150;&#65 &copy2<!-- <i> --></H1>"
               "<style>h1 { } <h1>none</h1></style><h10>not</h10>")
ODD_TEXT = "café don’t é😀 &lt; <i> &bogus; & &;\u00a0…A & B ’ ✓ ¬it; –A ©2"


@register("html_heading_text", f"""
SELECT page_id, array_to_string(list_transform(regexp_extract_all(html, '(?is)<h1(?:\\s[^>]*)?>(.*?)</h1\\s*>', 1), lambda h:
  replace(regexp_replace(h, '<[^>]*>', '', 'g'), '&amp;', '&')), '') || CASE WHEN page_id % 5 = 0 THEN '{ODD_TEXT}' ELSE '' END AS heading
FROM pages""")
def q_html_heading_text(spark, sf):
    p = D.table(spark, sf, "pages")
    html = F.concat("html", F.when(F.col("page_id") % 5 == 0, F.lit(ODD_HEADING)).otherwise(F.lit("")))
    return p.select("page_id", H.heading_text(html).alias("heading"))


# ====================================================================== dumps -> posts


_ENV = O.with_(O.ENV_CTE)

_POSTS_SQL = _ENV + """
SELECT id AS "Post ID", title AS "Title", author AS "Author", flair_raw AS "Flair", created_date AS "Created Date",
       selftext AS "Text (Preview)", permalink AS "Permalink", url AS "URL"
FROM ev WHERE trim(flair_raw) = 'error'"""
_POSTS_SQL_DISTINCT = _POSTS_SQL.replace("FROM ev ", "FROM ev0 ")


def _children(spark, sf):
    c = SJ.read_listing_dumps(spark, D.write_dump_files(spark, sf))
    return c.withColumn("dump", F.regexp_extract("path", r"dump=(-?\d+)", 1).cast("bigint"))


@register("src_json_listing", _ENV + "SELECT dump, pos, id, title FROM ev")
def q_src_json_listing(spark, sf):
    return _children(spark, sf).select("dump", "pos", F.col("post.id").alias("id"), F.col("post.title").alias("title"))


@register("filter_flair", _ENV + "SELECT dump, pos, id FROM ev WHERE trim(flair_raw) = 'error'")
def q_filter_flair(spark, sf):
    return P.filter_flair(_children(spark, sf), "error").select("dump", "pos", F.col("post.id").alias("id"))


@register("project_posts", _ENV + """
SELECT dump, pos, id, title, author, coalesce(flair_raw, 'No Flair') AS flair, created_date, selftext, permalink, url FROM ev""")
def q_project_posts(spark, sf):
    c = _children(spark, sf)
    dump = F.regexp_extract("path", r"dump=(-?\d+)", 1).cast("bigint").alias("dump")
    return P.project_posts(c).select(dump, "pos", "id", "title", "author", "flair", "created_date", "selftext", "permalink", "url")


@register("epoch_to_iso", _ENV + "SELECT dump, pos, created_date FROM ev")
def q_epoch_to_iso(spark, sf):
    c = _children(spark, sf)
    return c.select("dump", "pos", T.epoch_to_iso(F.col("post.created_utc")).alias("created_date"))


@register("union_posts", _ENV + "SELECT id, count(*) AS copies FROM ev GROUP BY id")
def q_union_posts(spark, sf):
    return _children(spark, sf).groupBy(F.col("post.id").alias("id")).agg(F.count(F.lit(1)).alias("copies"))


@register("union_posts_distinct", _ENV + """
SELECT dump, pos, id, title FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY cast(dump AS varchar), pos) AS copy FROM ev) WHERE copy = 1""")
def q_union_posts_distinct(spark, sf):
    """Each post once over all dumps, as it stands in the first file (by path) that has it."""
    once = P.distinct_posts(SJ.read_listing_dumps(spark, D.write_dump_files(spark, sf)))
    return once.select(F.regexp_extract("path", r"dump=(-?\d+)", 1).cast("bigint").alias("dump"), "pos",
                       F.col("post.id").alias("id"), F.col("post.title").alias("title"))


@register("stream_posts_distinct", _POSTS_SQL_DISTINCT)
def q_stream_posts_distinct(spark, sf):
    """The posts stage as a stream in two runs that keeps each post once; the second run brings a dump that repeats posts."""
    first, second = D.write_dump_files(spark, sf, repeat_first=False), D.write_dump_files(spark, sf)
    out, ckpt = scratch_path(spark, "stream_distinct"), scratch_path(spark, "stream_distinct_ckpt")
    ST.run_posts_stream(spark, first, out, ckpt, flair="error", distinct=True)
    ST.run_posts_stream(spark, second, out, ckpt, flair="error", distinct=True)
    return P.posts_csv_frame(spark.read.parquet(out))


@register("count_flair", _ENV + """
SELECT dump, count(*) AS posts, count(*) FILTER (WHERE trim(flair_raw) = 'error') AS flair_posts FROM ev GROUP BY dump""")
def q_count_flair(spark, sf):
    c = _children(spark, sf)
    return P.count_flair(c, "error").select(
        F.regexp_extract("path", r"dump=(-?\d+)", 1).cast("bigint").alias("dump"), "posts", "flair_posts")


@register("build_posts", _POSTS_SQL)
def q_build_posts(spark, sf):
    return P.posts_csv_frame(P.build_posts(_children(spark, sf), "error"))


# ====================================================================== CSV scan and sinks



@register("src_csv_lenient", """
SELECT cast(c_custkey AS varchar) AS c_custkey,
  CASE WHEN c_custkey % 17 = 0 THEN c_name || chr(10) || 'second line'
       WHEN c_custkey % 23 = 0 THEN c_name || ' q' ELSE c_name END AS c_name,
  cast(c_nationkey AS varchar) AS c_nationkey, cast(c_acctbal AS varchar) AS c_acctbal, c_mktsegment
FROM customer WHERE c_custkey % 11 <> 0 AND c_custkey % 13 <> 0""")
def q_src_csv_lenient(spark, sf):
    path = D.write_customer_csv(spark, sf)
    absent = SC.read_csv_lenient(spark, f"{path}-absent", D.CUSTOMER_COLUMNS)
    return SC.read_csv_lenient(spark, path, D.CUSTOMER_COLUMNS).unionByName(absent)


@register("sink_catalog_csv", _LIST + f"SELECT source, {O.CATALOG_COLS} FROM lcat WHERE brand <> ''")
def q_sink_catalog_csv(spark, sf):
    path = scratch_path(spark, "catalog_csv")
    SC.write_stage_csv(X.build_catalog(_listing_docs(spark, sf)).drop("pos"), path, ["source"])
    return SC.read_stage_csv(spark, path, X.CATALOG_COLUMNS).na.fill("")


@register("sink_posts_csv", _POSTS_SQL)
def q_sink_posts_csv(spark, sf):
    path = scratch_path(spark, "posts_csv")
    frame = P.posts_csv_frame(P.build_posts(_children(spark, sf), "error"))
    SC.write_stage_csv(frame, path)
    SC.write_stage_csv(frame.where("false"), path)  # an empty later run leaves the export alone
    return SC.read_stage_csv(spark, path, [t for _, t in P.POSTS_CSV_COLUMNS]).na.fill("")


@register("sink_matches_csv", _match_posts_sql(DATA_LABELS))
def q_sink_matches_csv(spark, sf):
    path = scratch_path(spark, "matches_csv")
    m = _match_posts(spark, sf, DATA_LABELS)
    SC.write_stage_csv(m, path)
    return SC.read_stage_csv(spark, path, m.columns).na.fill("") \
        .withColumn("post_id", F.col("post_id").cast("bigint"))


RUN_DATE, NEXT_DATE = "1999-06-30", "1999-07-31"


@register("sink_combined_csv", _COMB + f"""
SELECT post_id, {', '.join(N.COMBINED_COLUMNS)}, unnest(['{RUN_DATE}', '{NEXT_DATE}']) AS run_date FROM comb""")
def q_sink_combined_csv(spark, sf):
    path = scratch_path(spark, "combined_csv")
    c = _combined(spark, sf).select("post_id", *N.COMBINED_COLUMNS)
    for day in (RUN_DATE, NEXT_DATE):  # the second run keeps the first one's partition
        SC.write_stage_csv(c.withColumn("run_date", F.lit(day)), path, ["run_date"])
    back = SC.read_stage_csv(spark, path, ["post_id", *N.COMBINED_COLUMNS])
    return back.withColumn("post_id", F.col("post_id").cast("bigint")) \
        .withColumn("run_date", F.col("run_date").cast("string"))


# ====================================================================== accuracy reports

def _outcomes(spark, sf):
    """Review outcomes from ``labels``: category from (quality, toxic), null for some; two class schemes that
    overlap: is it right or expected, and is it of use."""
    lb = D.table(spark, sf, "labels")
    cat = F.when(F.col("doc_id") % 17 != 0, F.concat(F.lit("q"), F.col("quality").cast("string"), F.lit("_t"), F.col("toxic").cast("string")))
    right = F.when(F.col("doc_id") % 17 != 0, F.when((F.col("quality") == 1) | (F.col("toxic") == 1), "expected").otherwise("wrong"))
    use = F.when((F.col("quality") == 1) & (F.col("toxic") == 0), F.lit("usable")).otherwise(F.lit("unused"))
    return lb.select("doc_id", cat.alias("category"), right.alias("right_class"), use.alias("use_class"))


_OUT_SQL = ("SELECT doc_id, CASE WHEN doc_id % 17 <> 0 THEN 'q' || cast(quality AS varchar) || '_t' || cast(toxic AS varchar) END AS category, "
            "CASE WHEN doc_id % 17 <> 0 THEN CASE WHEN quality = 1 OR toxic = 1 THEN 'expected' ELSE 'wrong' END END AS right_class, "
            "CASE WHEN quality = 1 AND toxic = 0 THEN 'usable' ELSE 'unused' END AS use_class FROM labels")


@register("accuracy_by_category", f"""
SELECT category, count(*) AS n, count(*) * 100.0 / sum(count(*)) OVER () AS pct
FROM ({_OUT_SQL}) GROUP BY category""")
def q_accuracy_by_category(spark, sf):
    return R.accuracy_by_category(_outcomes(spark, sf))


@register("accuracy_rollup", f"""
SELECT right_class, use_class, category, cast(level AS integer) AS level, n, n * 100.0 / (SELECT count(*) FROM labels) AS pct FROM (
  SELECT right_class, NULL AS use_class, category, 2 AS level, count(*) AS n FROM ({_OUT_SQL}) GROUP BY right_class, category
  UNION ALL SELECT right_class, NULL, NULL, 3, count(*) FROM ({_OUT_SQL}) GROUP BY right_class
  UNION ALL SELECT NULL, use_class, category, 4, count(*) FROM ({_OUT_SQL}) GROUP BY use_class, category
  UNION ALL SELECT NULL, use_class, NULL, 5, count(*) FROM ({_OUT_SQL}) GROUP BY use_class
  UNION ALL SELECT NULL, NULL, NULL, 7, count(*) FROM ({_OUT_SQL}))""")
def q_accuracy_rollup(spark, sf):
    return R.accuracy_rollup(_outcomes(spark, sf), ("right_class", "use_class"))


# ====================================================================== workflow



@register("workflow", O.workflow_sql(N.COMBINED_COLUMNS, 1999))
def flagship(spark, sf):
    """entry(): the whole workflow in one plan; the combined table is the result."""
    return W.run_workflow(spark, sf).combined.select("post_key", *N.COMBINED_COLUMNS)


@register("count_stages", _LINK + """,
""" + O.ENR_CTE.strip("\n") + "," + O.combined_sql(AS_OF_YEAR).strip("\n") + """
SELECT 'catalog' AS stage, count(*) AS n FROM cat
UNION ALL SELECT 'keywords', count(*) FROM kw WHERE length(keyword) >= 4
UNION ALL SELECT 'posts', count(*) FROM ptxt
UNION ALL SELECT 'linked', count(*) FROM best
UNION ALL SELECT 'matched', count(*) FROM emm
UNION ALL SELECT 'combined', count(*) FROM comb
UNION ALL SELECT 'found', count(*) FROM comb WHERE found""")
def q_count_stages(spark, sf):
    """Cardinalities per stage, observed while the link and the enrichment are computed once."""
    counts = R.StageCounts()
    catalog = counts.watch(D.catalog_from_benchmark(spark, sf), "catalog")
    keywords = counts.watch(L.keyword_table(catalog).where(F.length("keyword") >= 4), "keywords")
    anchors = L.prepare_anchors(catalog, keywords=keywords)
    posts = counts.watch(_posts_prepared(spark, sf), "posts")
    verified = L.match_candidates(posts, anchors.anchors, "post_id", anchors.with_runs, anchors.broadcast)
    matched = counts.watch(N.filter_matched(D.enrich_matches_from_part(spark, sf)), "matched")
    combined = N.enrich_join(matched, D.enrich_catalog_from_part(spark, sf), AS_OF_YEAR)
    for df in (counts.watch(L.best_match(verified, "post_id"), "linked"), counts.watch(combined, "combined", found=F.col("found"))):
        df.write.format("noop").mode("overwrite").save()
    return counts.table(spark)


# ====================================================================== streaming



@register("stream_posts", _POSTS_SQL)
def q_stream_posts(spark, sf):
    """The posts stage as a file-source stream (availableNow), read back: equals build_posts."""
    root = D.write_dump_files(spark, sf)
    out, ckpt = scratch_path(spark, "stream_posts"), scratch_path(spark, "stream_posts_ckpt")
    ST.run_posts_stream(spark, root, out, ckpt, flair="error")
    return P.posts_csv_frame(spark.read.parquet(out))
