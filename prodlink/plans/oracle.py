"""DuckDB oracle SQL for every registered query.

Each oracle is an independent brute-force statement over the same parquet
views (``benchmark``, ``documents``, ``part`` ...). They share CTE text built
here; nothing in this module runs Spark.
"""

from __future__ import annotations

from ..operators.link import ISSUE_PATTERNS
from .derived import LABEL_PHRASES

# ------------------------------------------------------------------ CAT / POST

CAT_CTE = """
cat_w AS (
  SELECT item_id, string_split(trim(regexp_replace(text, '[^A-Za-z0-9]+', ' ', 'g')), ' ') AS w
  FROM benchmark),
cat_k AS (SELECT item_id, w, unnest(range(0, (len(w) - 1) // 6 + 1)) AS k FROM cat_w),
cat_v AS (
  SELECT item_id, (item_id * 1000000 + k) * 2 AS cat_ord, coalesce(w[6*k+1], 'end') AS w1, coalesce(w[6*k+2], 'end') AS w2,
    coalesce(w[6*k+3], 'end') AS w3, coalesce(w[6*k+4], 'end') AS w4, coalesce(w[6*k+5], 'end') AS w5,
    coalesce(w[6*k+6], 'end') AS w6 FROM cat_k),
cat_n AS (
  SELECT * FROM cat_v
  UNION ALL
  SELECT * REPLACE (cat_ord + 1 AS cat_ord) FROM cat_v WHERE item_id % 10 = 0),
cat AS (
  SELECT cat_ord,
    CASE item_id % 5 WHEN 0 THEN w1 || ' ' || w2
                     WHEN 1 THEN w1 || ' ' || w2 || ' (' || w3 || ' ' || w4 || ')'
                     WHEN 2 THEN w1 || '-' || w2 || ' Ver.2.5'
                     WHEN 3 THEN w1 || ' ' || w2 || ' ' || w3
                     ELSE w1 || ' ' || w2 || ' (' || w3 || ') v2' END AS name,
    'Brand' || cast(item_id % 5 AS varchar(20)) AS brand,
    'Line' || cast(item_id % 3 AS varchar(20)) AS product_line,
    CASE WHEN item_id % 4 = 0 THEN '' ELSE w5 || ' ' || w6 END AS series_title,
    'Mar-' || cast(2017 + cat_ord % 11 AS varchar(20)) AS release_date
  FROM cat_n)"""

POST_CTE = """
post AS (
  SELECT doc_id AS post_id, substr(replace(text, chr(10), ' '), 1, 80) AS title, text || coalesce(LABEL_LIST[doc_id % 29 + 1], '') AS selftext,
    source AS author, cast(1704067200 + doc_id * 60 AS double) AS created_utc,
    '/r/' || lang || '/comments/' || cast(doc_id AS varchar(20)) || '/' AS permalink
  FROM documents),
ptxt AS (
  SELECT post_id, author, created_utc, permalink,
    lower(title || ' ' || replace(coalesce(selftext, ''), chr(10), ' ')) AS txt
  FROM post)"""


POST_CTE = POST_CTE.replace("LABEL_LIST", "[" + ", ".join(f"'{p}'" for p in LABEL_PHRASES) + "]")


def iso_sql(x: str) -> str:
    """Epoch seconds -> ISO text with milliseconds, '' for 0 / null."""
    return (f"CASE WHEN coalesce({x}, 0) <> 0 THEN strftime(make_timestamp("
            f"cast(trunc({x} * 1000) AS bigint) * 1000), '%Y-%m-%dT%H:%M:%S.%g') || 'Z' ELSE '' END")


# ------------------------------------------------------------------ keywords

def _kw(text: str, prio: int | str, kind: str) -> str:
    return f"{{'text': {text}, 'priority': {prio}, 'type': {kind}}}"


KW_STEPS = """
kw_src AS (
  SELECT cat_ord, name, brand, product_line, 0 AS src, name AS s FROM cat
  UNION ALL
  SELECT cat_ord, name, brand, product_line, 1 AS src, series_title AS s FROM cat),
kw_a AS (
  SELECT *, lower(s) AS low,
    regexp_replace(regexp_replace(lower(s), '\\([^)]*\\)', '', 'g'), '^\\s+|\\s+$', '', 'g') AS nop,
    regexp_replace(regexp_replace(lower(s), '\\s*v(?:er)?\\.?\\s*\\d+(?:\\.\\d+)?', '', 'gi'), '^\\s+|\\s+$', '', 'g') AS nov
  FROM kw_src),
kw_b AS (
  SELECT *, list_filter(string_split_regex(nop, '\\s+'), lambda w: length(w) > 0) AS words FROM kw_a),
kw_c AS (
  SELECT *,
    CASE WHEN nop <> '' AND nop <> low THEN [NOPKW] ELSE [] END AS k_nop,
    list_transform(list_filter(list_transform(regexp_extract_all(low, '\\(([^)]+)\\)', 0),
        lambda m: regexp_replace(regexp_replace(m, '[()]', '', 'g'), '^\\s+|\\s+$', '', 'g')),
        lambda t: length(t) >= 4), lambda t: PARKW) AS k_par,
    CASE WHEN nov <> '' AND nov <> low AND nov <> nop THEN [NOVKW] ELSE [] END AS k_nov,
    CASE WHEN len(words) >= 2 THEN flatten(list_transform(range(1, len(words)), lambda i: list_filter([
        CASE WHEN length(array_to_string(words[i:i+1], ' ')) >= 8 THEN TWOKW END,
        CASE WHEN i < len(words) - 1 AND length(array_to_string(words[i:i+2], ' ')) >= 12 THEN THREEKW END],
        lambda k: k IS NOT NULL))) ELSE [] END AS k_phr,
    list_transform(list_filter(words, lambda w: length(w) >= 6 AND NOT list_contains(
        ['figure', 'edition', 'special', 'limited', 'exclusive', 'series', 'collection'], w)),
        lambda w: WORDKW) AS k_word
  FROM kw_b),
kw_d AS (
  SELECT cat_ord, name, brand, product_line, src,
    CASE WHEN coalesce(s, '') = '' THEN [] ELSE [FULLKW] || k_nop || k_par || k_nov || k_phr || k_word END AS base
  FROM kw_c),
kw_e AS (
  SELECT cat_ord, name, brand, product_line, src, base,
    base || list_transform(list_filter(base, lambda k: contains(struct_extract(k, 'text'), '-')
              AND length(replace(struct_extract(k, 'text'), '-', '')) >= 4),
           lambda k: {'text': replace(struct_extract(k, 'text'), '-', ''),
                      'priority': struct_extract(k, 'priority'), 'type': struct_extract(k, 'type')}) AS kws
  FROM kw_d),
kw_f AS (
  SELECT cat_ord, name, brand, product_line, src, kws,
    coalesce(sum(len(kws)) OVER (PARTITION BY cat_ord ORDER BY src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off
  FROM kw_e),
kw AS (
  SELECT cat_ord, name, brand, product_line,
    cast(off + generate_subscripts(kws, 1) - 1 AS integer) AS kw_ord,
    struct_extract(unnest(kws), 'text') AS keyword,
    struct_extract(unnest(kws), 'priority') AS priority,
    struct_extract(unnest(kws), 'type') AS match_type
  FROM kw_f)"""

KW_STEPS = (KW_STEPS
            .replace("NOPKW", _kw("nop", 2, "'no-parens'"))
            .replace("PARKW", _kw("t", 2, "'parens-content'"))
            .replace("NOVKW", _kw("nov", 2, "'no-version'"))
            .replace("TWOKW", _kw("array_to_string(words[i:i+1], ' ')", 3, "'phrase'"))
            .replace("THREEKW", _kw("array_to_string(words[i:i+2], ' ')", 3, "'phrase'"))
            .replace("WORDKW", _kw("w", 4, "'word'"))
            .replace("FULLKW", _kw("low", 1, "'full'")))

SCORE_SQL = ("cast(CASE priority WHEN 1 THEN 1000 WHEN 2 THEN 500 WHEN 3 THEN 300 WHEN 4 THEN 100 ELSE 0 END"
             " + length(keyword) + CASE WHEN match_type = 'phrase' THEN 50 ELSE 0 END AS INTEGER)")
CONF_SQL = ("CASE WHEN priority IN (1, 2) THEN 'High' WHEN priority = 3 AND length(keyword) >= 12 THEN 'High'"
            " WHEN priority = 3 THEN 'Medium' WHEN priority = 4 AND length(keyword) >= 8 THEN 'Medium'"
            " ELSE 'Low' END")

# Brute force: every (post, keyword) pair passes a substring pre-check, then the regex.
HITS_STEPS = f"""
kwl AS (
  SELECT *, {SCORE_SQL} AS score, {CONF_SQL} AS confidence,
    '\\b' || regexp_replace(keyword, '([.*+?^${{}}()|\\[\\]\\\\])', '\\\\\\1', 'g') || '(?:''?s)?\\b' AS pattern
  FROM kw WHERE length(keyword) >= 4),
kwt AS (SELECT DISTINCT keyword, pattern FROM kwl),
pt AS (SELECT post_id, txt, replace(txt, '-', '') AS txt_nh FROM ptxt),
vhit AS (
  SELECT pt.post_id, kwt.keyword
  FROM pt JOIN kwt ON (contains(pt.txt, kwt.keyword) AND regexp_matches(pt.txt, kwt.pattern))
                   OR (contains(pt.txt_nh, kwt.keyword) AND regexp_matches(pt.txt_nh, kwt.pattern))),
allhit AS (
  SELECT v.post_id, k.* EXCLUDE (pattern) FROM vhit v JOIN kwl k USING (keyword)),
best AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY post_id ORDER BY score DESC, cat_ord, kw_ord) AS rn
    FROM allhit) WHERE rn = 1)"""


def labels_sql(text: str, patterns: dict[str, str] | None = None) -> str:
    patterns = ISSUE_PATTERNS if patterns is None else patterns
    items = ", ".join(f"CASE WHEN regexp_matches({text}, '{p}', 'i') THEN '{k}' END"
                      for k, p in patterns.items())
    return f"list_filter([{items}], lambda x: x IS NOT NULL)"


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip("\n") for c in ctes) + "\n"


# ------------------------------------------------------------------ ENR

ENR_CTE = """
em AS (
  SELECT p_partkey AS post_id,
    CASE WHEN p_partkey % 19 = 0 THEN '' WHEN p_partkey % 11 = 0 THEN 'nobody ' || cast(p_partkey AS varchar(20))
         WHEN p_partkey % 5 = 0 THEN upper(p_name) ELSE p_name END AS figure_name,
    p_brand AS brand, p_type AS product_line,
    CASE p_partkey % 4 WHEN 0 THEN 'loose_joints, warped_parts' WHEN 1 THEN ' broken_parts' ELSE '' END AS detected_issues,
    CASE WHEN p_partkey % 6 = 0 THEN '' ELSE 'https://example.org/' || cast(p_partkey AS varchar(20)) END AS reddit_permalink
  FROM part),
ec AS (
  SELECT p_partkey AS cat_ord, p_name AS name, p_brand AS brand, p_type AS product_line,
    CASE p_partkey % 7 WHEN 0 THEN '' WHEN 1 THEN '"' || p_type || '"' ELSE p_type END AS series_title,
    CASE WHEN p_partkey % 9 = 0 THEN 'UNKNOWN' WHEN p_partkey % 10 = 0 THEN ''
         ELSE 'S' || cast(p_size AS varchar(20)) || ' ' END AS sculptor,
    CASE WHEN p_partkey % 8 = 0 THEN 'UNKNOWN' ELSE 'late Mar-' || cast(1995 + p_partkey % 10 AS varchar(20)) END AS release_date,
    CASE WHEN p_partkey % 3 = 0 THEN 'Scale: 1/' || cast(p_size AS varchar(20)) || chr(10) || 'Material: PVC'
         WHEN p_partkey % 6 = 2 THEN 'Scale:  1:' || cast(p_size AS varchar(20)) || ' ca.'
         WHEN p_partkey % 6 = 5 THEN 'scale: non scale ' || cast(p_size AS varchar(20)) || chr(10) || 'Size: H1'
         ELSE 'Size: H' || cast(p_size AS varchar(20)) END AS spec,
    CASE WHEN p_partkey % 3 = 0 THEN 'PVC' ELSE '' END AS material
  FROM part),
emm AS (SELECT * FROM em WHERE figure_name <> '' AND brand <> ''),
eclast AS (
  SELECT lower(name) AS k_name, lower(brand) AS k_brand, arg_max(ec, cat_ord) AS r
  FROM ec GROUP BY 1, 2)"""


def clean_sql(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL OR {x} IN ('', 'UNKNOWN', 'unknown') THEN NULL "
            f"ELSE regexp_replace(trim({x}), '^\"|\"$', '', 'g') END")


def scale_sql(x: str) -> str:
    return (f"CASE WHEN regexp_matches(coalesce({x}, ''), '(?i)Scale:\\s*(1/\\d+|\\d+:\\d+|[^\\n]+)') "
            f"THEN trim(regexp_extract({x}, '(?i)Scale:\\s*(1/\\d+|\\d+:\\d+|[^\\n]+)', 1)) END")


def age_sql(x: str, as_of: int) -> str:
    y = f"regexp_extract(lower({x}), '\\d{{4}}', 0)"
    d = f"({as_of} - cast({y} AS integer))"
    return (f"CASE WHEN {x} IS NULL OR {x} = '' OR {x} = 'UNKNOWN' OR {y} = '' THEN 'Unknown' "
            f"WHEN {d} = 0 THEN 'New' WHEN {d} = 1 THEN '1 Year' "
            f"WHEN {d} > 1 THEN cast({d} AS varchar) || ' Years' ELSE 'Pre-order' END")


def issues_json_sql(x: str) -> str:
    return (f"to_json(list_filter(list_transform(string_split(coalesce({x}, ''), ','), lambda s: trim(s)), "
            f"lambda s: s <> ''))::varchar")


def combined_sql(as_of: int) -> str:
    found = "(l.r IS NOT NULL)"
    return f"""
comb AS (
  SELECT m.post_id, {found} AS found, 'data' AS mode,
    CASE WHEN {found} THEN {clean_sql('l.r.name')} ELSE m.figure_name END AS figure_name,
    CASE WHEN {found} THEN {clean_sql('l.r.brand')} ELSE m.brand END AS brand,
    CASE WHEN {found} THEN {clean_sql('l.r.product_line')} ELSE m.product_line END AS product_line,
    CASE WHEN {found} THEN {clean_sql('l.r.series_title')} END AS series_title,
    CASE WHEN {found} THEN {clean_sql('l.r.sculptor')} END AS sculptor,
    CASE WHEN {found} THEN {scale_sql('l.r.spec')} END AS scale,
    CASE WHEN {found} THEN {clean_sql('l.r.material')} END AS materials,
    CASE WHEN {found} THEN 'AmiAmi' END AS seller,
    CASE WHEN {found} THEN {age_sql('l.r.release_date', as_of)} ELSE 'Unknown' END AS age,
    'true' AS authenticity,
    {issues_json_sql('m.detected_issues')} AS issues,
    CASE WHEN coalesce(m.reddit_permalink, '') <> '' THEN 'Reddit report: ' || m.reddit_permalink END AS issue_description
  FROM emm m LEFT JOIN eclast l ON lower(m.figure_name) = l.k_name AND lower(m.brand) = l.k_brand)"""


FAULTS_CTE = """
fr AS (
  SELECT post_id,
    CASE WHEN post_id % 23 = 0 THEN 'bad' ELSE mode END AS mode,
    CASE WHEN post_id % 37 = 0 THEN NULL ELSE figure_name END AS figure_name,
    CASE WHEN post_id % 41 = 0 THEN '' ELSE brand END AS brand,
    CASE WHEN post_id % 29 = 0 THEN '{"a": 1}' WHEN post_id % 31 = 0 THEN 'not json' ELSE issues END AS issues
  FROM comb),
errs AS (
  SELECT post_id, generate_subscripts(e, 1) - 1 AS err_ord, unnest(e) AS message FROM (
    SELECT post_id, list_filter([
      CASE WHEN coalesce(figure_name, '') = '' THEN 'Row ' || post_id || ': Missing figure_name' END,
      CASE WHEN coalesce(brand, '') = '' THEN 'Row ' || post_id || ': Missing brand' END,
      CASE WHEN coalesce(mode NOT IN ('fix', 'data'), true) THEN 'Row ' || post_id || ': Invalid mode (must be ''fix'' or ''data'')' END,
      CASE WHEN coalesce(issues, '') <> '' AND NOT json_valid(issues) THEN 'Row ' || post_id || ': Invalid JSON in issues field' END,
      CASE WHEN coalesce(issues, '') <> '' AND json_valid(issues) AND json_type(issues) <> 'ARRAY' THEN 'Row ' || post_id || ': issues must be a JSON array' END
    ], lambda x: x IS NOT NULL) AS e FROM fr))"""


# ------------------------------------------------------------------ LIST

LIST_CTE = """
lsec AS (
  SELECT p_partkey, 'vendor' || cast(p_partkey // 500 AS varchar) AS source,
    cast(row_number() OVER (PARTITION BY p_partkey // 500 ORDER BY p_partkey) - 1 AS integer) AS pos,
    p_partkey = max(p_partkey) OVER (PARTITION BY p_partkey // 500) AS is_last,
    p_name, p_brand, p_type, p_size, cast(floor(p_retailprice) AS bigint) * 10 AS jpy,
    concat_ws(chr(10),
      CASE WHEN p_partkey % 13 = 0 THEN 'NOCODE' ELSE printf('FIGURE-%012d', p_partkey) END,
      'About this item',
      'Release Date' || chr(9) || 'Mar-' || cast(2017 + p_partkey % 11 AS varchar) || chr(9) || 'List Price' || chr(9)
        || format('{:,}', cast(floor(p_retailprice) AS bigint) * 10) || ' JPY',
      CASE WHEN p_partkey % 17 = 0 THEN 'Maker' || chr(9) || p_brand ELSE 'Brand' || chr(9) || p_brand END,
      'Product Line' || chr(9) || p_type,
      CASE WHEN p_partkey % 4 = 0 THEN 'Series Title  Saga of ' || p_type || ' ' || cast(p_size AS varchar) || ' ' END, 'Character Name    ' || p_name,
      'Sculptor' || chr(9) || 'S' || cast(p_size AS varchar) || ' ',
      'Specifications' || chr(9) || 'Scale: 1/' || cast(p_size AS varchar), 'Material: PVC & ABS', '',
      '[Set Contents]', 'Main Body x1', 'Details' || chr(9) || 'x') AS section
  FROM part),
lcat AS (
  SELECT source, pos, p_partkey, printf('FIGURE-%012d', p_partkey) AS gcode, p_name AS name,
    CASE WHEN p_partkey % 17 = 0 THEN '' ELSE p_brand END AS brand, p_type AS product_line,
    CASE WHEN p_partkey % 4 = 0 THEN 'Saga of ' || p_type || ' ' || cast(p_size AS varchar) ELSE '' END AS series_title,
    'Mar-' || cast(2017 + p_partkey % 11 AS varchar) AS release_date, 'S' || cast(p_size AS varchar) AS sculptor,
    'PVC & ABS' AS material, 'Scale: 1/' || cast(p_size AS varchar) || chr(10) || 'Material: PVC & ABS' AS spec,
    '' AS status, cast(jpy AS varchar) AS price_jpy, printf('%.2f', jpy * 0.0069::double) AS price_usd,
    true AS has_about
  FROM lsec WHERE p_partkey % 13 <> 0)"""

CATALOG_COLS = ("gcode, name, brand, product_line, series_title, release_date, sculptor, material, spec, "
                "status, price_jpy, price_usd")


# ------------------------------------------------------------------ ENV

ENV_CTE = """
ev0 AS (
  SELECT event_id, event_id // 1000 AS dump,
    cast(row_number() OVER (PARTITION BY event_id // 1000 ORDER BY event_id) - 1 AS integer) AS pos,
    cast(event_id AS varchar) AS id, event_type AS title, 'u' || cast(user_id AS varchar) AS author,
    CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 7 = 1 THEN ' ' || event_type || ' ' ELSE event_type END AS flair_raw,
    strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.' || lpad(cast(millisecond(ts) % 1000 AS varchar), 3, '0') || 'Z' AS created_date,
    substr(replace(coalesce(props, ''), chr(10), ' '), 1, 500) AS selftext,
    '/r/x/comments/' || cast(event_id AS varchar) || '/' AS permalink, '' AS url
  FROM events),
ev AS (SELECT * FROM ev0 UNION ALL SELECT * REPLACE (-1 AS dump) FROM ev0 WHERE dump = 0)"""


# ------------------------------------------------------------------ workflow

def workflow_sql(columns: list[str], as_of: int, flair: str = "error") -> str:
    """The whole workflow by brute force: two vendors' catalogs, documents and dump posts, link, combine."""
    shared = "cat_ord, name, brand, product_line, series_title, release_date"
    catalog = f"""
wcat AS (
  SELECT {shared}, NULL::varchar AS sculptor, NULL::varchar AS material, NULL::varchar AS spec FROM cat0
  UNION ALL
  SELECT (1::bigint << 50) + row_number() OVER (ORDER BY source, pos), name, brand, product_line, series_title, release_date, sculptor, material, spec
  FROM lcat WHERE brand <> ''),
cat AS (SELECT {shared} FROM wcat)"""
    texts = f"""
wpost AS (
  SELECT 'doc:' || post_id AS post_id, title, selftext, permalink FROM post
  UNION ALL
  SELECT 'dump:dump' || dump || ':' || pos, title, selftext, permalink FROM ev0 WHERE trim(flair_raw) = '{flair}'),
ptxt AS (
  SELECT post_id, permalink, lower(title || ' ' || replace(coalesce(selftext, ''), chr(10), ' ')) AS txt FROM wpost)"""
    linked = f"""
emm AS (
  SELECT p.post_id, b.name AS figure_name, b.brand, b.product_line,
    array_to_string({labels_sql('p.txt')}, ', ') AS detected_issues, 'https://reddit.com' || p.permalink AS reddit_permalink
  FROM ptxt p JOIN best b USING (post_id) WHERE b.name <> '' AND b.brand <> ''),
eclast AS (
  SELECT lower(name) AS k_name, lower(brand) AS k_brand, arg_max(wcat, cat_ord) AS r FROM wcat GROUP BY 1, 2)"""
    post = POST_CTE[:POST_CTE.index(",\nptxt AS")]
    return (with_(LIST_CTE, ENV_CTE, CAT_CTE.replace("\ncat AS (", "\ncat0 AS ("), catalog, post, texts, KW_STEPS, HITS_STEPS,
                  linked, combined_sql(as_of))
            + f"SELECT post_id AS post_key, {', '.join(columns)} FROM comb")
