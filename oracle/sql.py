"""Oracle SQL (DuckDB) per registered query.

Every statement reads the pre-registered views of the given tables; the
fixtures are derived inline by the CTEs of ``oracle/ctes.py``. Column names
equal the Spark query's.
"""

from __future__ import annotations

from .ctes import segment_sql
from .ctes import with_ctes as W

ORACLE: dict[str, str] = {}


def oracle(name: str, sql: str) -> None:
    ORACLE[name] = sql.strip()


oracle("c1_category_join", W("""
SELECT job_id, platform, category, major_category, middle_category, sub_category, year, month, day
FROM classified
""", "classified"))

oracle("c1_category_join_part", W("""
SELECT job_id, platform, category, major_category, middle_category, sub_category FROM lineitem_classified
""", "lineitem_classified"))

oracle("b10_daily_postings", W("SELECT * FROM daily", "daily"))

oracle("b10_daily_postings_lineitem", W("""
SELECT DISTINCT year, month, day,
       year || '-' || lpad(month, 2, '0') || '-' || lpad(day, 2, '0') AS date_str,
       platform, job_id, company, title, major_category, middle_category, sub_category
FROM lineitem_classified
""", "lineitem_classified"))

oracle("b11_unique_postings", W("SELECT * FROM unique_jds", "unique_jds"))

oracle("b11_unique_postings_lineitem", W("""
SELECT DISTINCT platform, job_id, title, company, major_category, middle_category, sub_category
FROM lineitem_classified
""", "lineitem_classified"))

oracle("d1_count_major", W("""
SELECT major_category, COUNT(*) AS count FROM unique_jds GROUP BY 1
""", "unique_jds"))

oracle("d2_count_major_middle", W("""
SELECT major_category, middle_category, COUNT(*) AS count FROM unique_jds GROUP BY 1, 2
""", "unique_jds"))

oracle("k1_first_stage", W("SELECT * FROM cleaned", "cleaned"))

oracle("b8_company_detail", W("SELECT * FROM company_detail", "company_detail"))


# --- helpers ---------------------------------------------------------------

# White space as Python's str.split() and strip() see it.
_WHITE = (r"[\x{{9}}-\x{{D}}\x{{1C}}-\x{{20}}\x{{85}}\x{{A0}}\x{{1680}}\x{{2000}}-\x{{200A}}"
          r"\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}]")
WHITE = _WHITE.replace("{{", "{").replace("}}", "}")
STRIP = f"regexp_replace({{x}}, '^{_WHITE}+|{_WHITE}+$', '', 'g')"


def tokens_sql(x: str) -> str:
    s = STRIP.format(x=x)
    return f"(CASE WHEN {s} = '' THEN CAST([] AS VARCHAR[]) ELSE regexp_split_to_array({s}, '{WHITE}+') END)"


def sido_sql(x: str) -> str:
    t = tokens_sql(x)
    return f"substring(CASE WHEN starts_with({t}[1], '주소') THEN {t}[2] ELSE {t}[1] END, 1, 2)"


def gugun_sql(x: str) -> str:
    t = tokens_sql(x)
    return f"substring(CASE WHEN starts_with({t}[1], '주소') THEN {t}[3] ELSE {t}[2] END, 1, 2)"


HEADING = r"<h1[^>]*>([^<]*(?:<[^/][^<]*|</[^h][^<]*)*)"


def html_text_sql(x: str) -> str:
    e = f"regexp_replace({x}, '<[^>]*>', '', 'g')"
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
        e = f"replace({e}, '{ent}', '{ch}')"
    return STRIP.format(x=e)


def paragraphs_sql(x: str) -> str:
    # Opening tags, with or without attributes, become chr(1), closing ones chr(2).
    marked = (f"regexp_replace(regexp_replace({x}, '<p(?:[ \\t\\r\\n][^>]*)?>', chr(1), 'g'), "
              f"'</p[ \\t\\r\\n]*>', chr(2), 'g')")
    return f"list_transform(regexp_extract_all({marked}, '\\x01([^\\x01\\x02]*)', 1), lambda p: {html_text_sql('p')})"


# --- sources and projections ----------------------------------------------

oracle("a3_read_table", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")

oracle("a4_read_day", """
SELECT event_id, user_id, event_type, CAST(year(ts) AS VARCHAR) AS year,
       lpad(CAST(month(ts) AS VARCHAR), 2, '0') AS month, lpad(CAST(day(ts) AS VARCHAR), 2, '0') AS day
FROM events WHERE year(ts) = 2024 AND month(ts) = 1 AND day(ts) = 15
""")

oracle("a10_sql_view", W("""
SELECT major_category, middle_category, COUNT(DISTINCT job_id) AS count FROM cleaned GROUP BY 1, 2
""", "cleaned"))

oracle("b2_select_columns", W("SELECT job_id, platform, category, company, title, url, end_at, location FROM postings",
                              "postings"))

oracle("b3_align", W("SELECT * EXCLUDE (year, month, day) FROM postings", "postings"))

oracle("b4_split_platform", W("""
SELECT job_id, platform, company, major_category FROM order_postings WHERE platform IN ('wanted', 'rallit')
""", "order_postings"))

oracle("b5_by_major", W("""
SELECT job_id, platform, category, major_category, middle_category, sub_category FROM cleaned
WHERE major_category = 'GAME'
""", "cleaned"))

oracle("b6_has_coordinates", W("SELECT * FROM company_detail WHERE lat IS NOT NULL AND lon IS NOT NULL",
                               "company_detail"))

_DEADLINE = """
SELECT DISTINCT company, title, url, end_at, primary_responsibility, company_description,
       major_category, middle_category
FROM {src}
WHERE TRY_CAST(end_at AS DATE) >= DATE '{d}' AND TRY_CAST(end_at AS DATE) <= DATE '{d}' + 7
"""
oracle("b7_upcoming_deadlines", W(_DEADLINE.format(src="cleaned", d="2024-01-20"), "cleaned"))
oracle("b7_upcoming_deadlines_orders", W(_DEADLINE.format(src="order_postings", d="1998-06-01"), "order_postings"))

oracle("b8_company_detail_embeddings", """
SELECT DISTINCT company,
       CASE WHEN coordinate IS NOT NULL THEN CAST(coordinate[1] AS DOUBLE) ELSE NULL END AS lat,
       CASE WHEN coordinate IS NOT NULL THEN CAST(coordinate[2] AS DOUBLE) ELSE NULL END AS lon,
       company_description
FROM (SELECT 'company-' || CAST(label AS VARCHAR) AS company,
             CASE WHEN vec_id % 7 = 0 THEN NULL ELSE embedding[1:2] END AS coordinate,
             'label ' || CAST(label AS VARCHAR) AS company_description
      FROM embeddings)
""")

oracle("b9_sub_category_list", W("SELECT sub_category FROM unique_jds", "unique_jds"))

oracle("b19_events_in", W("""
SELECT event_id, job_name, state FROM job_events
WHERE state IN ('SUCCEEDED', 'FAILED', 'TIMEOUT', 'STOPPED') AND job_name IN ('first_stage', 'second_stage')
""", "job_events"))

# --- joins ---------------------------------------------------------------

oracle("c2_posting_skills", W("""
SELECT u.major_category, u.middle_category, u.platform, u.job_id, js.unnested_skill AS skill
FROM unique_jds u JOIN jd_skills js ON u.platform = js.platform AND u.job_id = js.job_id
""", "unique_jds", "jd_skills"))


def _mart(table: str, col: str, alias: str) -> str:
    return W(f"""
SELECT u.major_category, u.middle_category, u.sub_category, u.platform, u.job_id, t.{col} AS {alias}
FROM unique_jds u JOIN {table} t ON u.platform = t.platform AND u.job_id = t.job_id
""", "unique_jds", table)


oracle("c3_posting_preferred", _mart("jd_preferred_english_nouns", "unnested_preferred_english_nouns", "preferred"))
oracle("c4_posting_required", _mart("jd_required_english_nouns", "unnested_required_english_nouns", "required"))
oracle("c5_posting_responsibility", _mart("jd_primary_responsibility_english_nouns",
                                          "unnested_primary_responsibility_english_nouns", "primary_responsibility"))
oracle("c6_posting_welfare_english", _mart("jd_welfare_english_nouns", "unnested_welfare_english_nouns",
                                           "unnested_welfare_english_nouns"))
oracle("c7_posting_welfare_korean", _mart("jd_welfare_korean_nouns", "unnested_welfare_korean_nouns",
                                          "unnested_welfare_korean_nouns"))

oracle("c8_company_coordinates", W("""
SELECT DISTINCT u.major_category, u.middle_category, u.sub_category, c.company, c.lat, c.lon
FROM unique_jds u JOIN company_detail c ON u.company = c.company
WHERE c.lat IS NOT NULL AND c.lon IS NOT NULL
""", "unique_jds", "company_detail"))

oracle("c9_semi_on", """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')
""")

oracle("c10_geocode", """
WITH cp AS (
  SELECT CAST(c.c_custkey AS VARCHAR) AS job_id,
         CASE c.c_custkey % 4 WHEN 0 THEN 'wanted' WHEN 1 THEN 'jumpit' WHEN 2 THEN 'rallit' ELSE 'jobplanet' END
           AS platform,
         n.n_name AS location,
         CASE WHEN c.c_custkey % 3 = 0 THEN NULL
              ELSE [CAST(c.c_nationkey AS DOUBLE), CAST(c.c_custkey % 10 AS DOUBLE)] END AS coordinate
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey),
addr AS (
  SELECT n_name AS location, CAST(30.0 AS DOUBLE) + CAST(n_nationkey AS DOUBLE) AS lat,
         CAST(120.0 AS DOUBLE) + CAST(n_regionkey AS DOUBLE) AS lon
  FROM nation WHERE n_nationkey % 5 <> 0)
SELECT cp.job_id, cp.platform, cp.location,
       CASE WHEN cp.platform IN ('jobplanet', 'jumpit')
            THEN CASE WHEN a.lat IS NOT NULL AND a.lon IS NOT NULL THEN [a.lat, a.lon] END
            ELSE cp.coordinate END AS coordinate
FROM cp LEFT JOIN addr a ON cp.location = a.location
WHERE cp.platform IN ('wanted', 'jumpit', 'rallit', 'jobplanet')
""")

oracle("c11_classify_loose", W("""
SELECT p.job_id, p.platform, p.category, l.major_category, l.middle_category, p.year, p.month, p.day
FROM postings p LEFT JOIN loose_taxonomy l ON replace(p.category, ' ', '') = l.category_key
""", "postings", "loose_taxonomy"))

# --- aggregations ----------------------------------------------------------

_ORDER_JDS = ("(SELECT DISTINCT platform, job_id, title, company, major_category, middle_category, sub_category "
              "FROM order_postings)")
oracle("d1_count_major_orders", W(f"SELECT major_category, COUNT(*) AS count FROM {_ORDER_JDS} GROUP BY 1",
                                  "order_postings"))
oracle("d2_count_major_middle_orders", W(
    f"SELECT major_category, middle_category, COUNT(*) AS count FROM {_ORDER_JDS} GROUP BY 1, 2", "order_postings"))
oracle("d3_count_sub", W("SELECT sub_category, COUNT(*) AS count FROM unique_jds GROUP BY 1", "unique_jds"))

oracle("d4_daily_counts", W("""
SELECT CAST(ds AS DATE) AS date_str, c AS count FROM (SELECT date_str AS ds, COUNT(*) AS c FROM daily GROUP BY date_str)
""", "daily"))

oracle("d4_daily_counts_events", W("""
SELECT CAST(ds AS DATE) AS date_str, c AS count FROM (
  SELECT ds, COUNT(*) AS c FROM (
    SELECT DISTINCT year, month, day, year || '-' || lpad(month, 2, '0') || '-' || lpad(day, 2, '0') AS ds,
           platform, job_id, company, title, major_category, middle_category, sub_category
    FROM event_postings)
  GROUP BY ds)
""", "event_postings"))

oracle("d5_distinct_by_major", W("""
SELECT major_category, COUNT(DISTINCT job_id) AS count FROM lineitem_classified GROUP BY 1
""", "lineitem_classified"))
oracle("d6_distinct_by_major_middle", W("""
SELECT major_category, middle_category, COUNT(DISTINCT job_id) AS count FROM lineitem_classified GROUP BY 1, 2
""", "lineitem_classified"))

oracle("d7_count_non_null", W("""
SELECT major_category, middle_category, sub_category, COUNT(job_id) AS job_id_count FROM cleaned GROUP BY 1, 2, 3
""", "cleaned"))
oracle("d8_ranked_major", W("""
SELECT major_category, COUNT(*) AS count, row_number() OVER (ORDER BY COUNT(*) DESC, major_category) AS position
FROM cleaned WHERE major_category IS NOT NULL GROUP BY 1
""", "cleaned"))
oracle("d9_ranked_middle", W("""
SELECT middle_category, COUNT(*) AS count, row_number() OVER (ORDER BY COUNT(*) DESC, middle_category) AS position
FROM cleaned WHERE middle_category IS NOT NULL GROUP BY 1
""", "cleaned"))
oracle("d10_groups_per_middle", W("""
SELECT middle_category, COUNT(*) AS job_id_count
FROM (SELECT major_category, middle_category, sub_category FROM cleaned GROUP BY 1, 2, 3)
WHERE middle_category IS NOT NULL GROUP BY 1
""", "cleaned"))
oracle("d11_count_by_sido", W(f"""
SELECT sido_location, COUNT(*) AS count
FROM (SELECT {sido_sql('location')} AS sido_location FROM cleaned)
WHERE sido_location IS NOT NULL GROUP BY 1
""", "cleaned"))
oracle("d12_count_by_gugun", W(f"""
SELECT gugun_location, COUNT(*) AS count
FROM (SELECT {gugun_sql('location')} AS gugun_location FROM cleaned)
WHERE gugun_location IS NOT NULL GROUP BY 1
""", "cleaned"))

_LI = "(SELECT job_id, platform, company, title FROM lineitem_postings)"
oracle("d14_repeated_keys", W(f"SELECT job_id, COUNT(*) AS count FROM {_LI} GROUP BY job_id HAVING COUNT(*) > 1",
                              "lineitem_postings"))
oracle("d15_duplicate_rows", W(f"""
SELECT * FROM {_LI} WHERE job_id IN (SELECT job_id FROM lineitem_postings GROUP BY job_id HAVING COUNT(*) > 1)
""", "lineitem_postings"))


def _dup_pair(src: str) -> str:
    return f"""
SELECT l.* FROM {src} l JOIN (
  SELECT job_id, company FROM {src} GROUP BY job_id, company HAVING COUNT(*) > 1) r
ON l.job_id IS NOT DISTINCT FROM r.job_id AND l.company IS NOT DISTINCT FROM r.company
"""


oracle("d16_duplicate_rows_pair", W(_dup_pair(_LI), "lineitem_postings"))
oracle("d16_duplicate_rows_pair_postings", W(_dup_pair(
    "(SELECT job_id, platform, company, category, year, month, day FROM postings)"), "postings"))


def _dup_summary(src: str) -> str:
    k1 = f"(SELECT job_id, COUNT(*) AS c FROM {src} GROUP BY job_id)"
    k2 = f"(SELECT job_id, company, COUNT(*) AS c FROM {src} GROUP BY job_id, company)"
    return f"""
SELECT total_rows, dup_rows, dup_pair_rows, dup_rows // 2 AS dup_count_half,
       total_rows - dup_rows // 2 AS net_postings_half, dup_rows = dup_pair_rows AS keys_agree,
       dup_rows - dup_keys AS removable_rows, total_rows - dup_rows + dup_keys AS net_postings
FROM (SELECT CAST((SELECT COUNT(*) FROM {src}) AS BIGINT) AS total_rows,
             CAST((SELECT coalesce(SUM(c), 0) FROM {k1} WHERE c > 1) AS BIGINT) AS dup_rows,
             CAST((SELECT COUNT(*) FROM {k1} WHERE c > 1) AS BIGINT) AS dup_keys,
             CAST((SELECT coalesce(SUM(c), 0) FROM {k2} WHERE c > 1) AS BIGINT) AS dup_pair_rows)
"""


oracle("d17_duplicate_summary", W(_dup_summary("lineitem_postings"), "lineitem_postings"))
oracle("d17_duplicate_summary_postings", W(_dup_summary("postings"), "postings"))

oracle("d18_distinct_dates", W("""
SELECT *, row_number() OVER (ORDER BY year, month, day) AS position FROM (SELECT DISTINCT year, month, day FROM event_postings)
""", "event_postings"))

oracle("d19_dedupe_first", """
SELECT doc_id, text, lang, source FROM (
  SELECT doc_id, text, lang, source,
         row_number() OVER (PARTITION BY text ORDER BY doc_id, lang, source) AS rn
  FROM documents)
WHERE rn = 1
""")

oracle("d20_distinct_ids", """
SELECT DISTINCT unnest([page_id, page_id + 1, page_id // 2]) AS posting_id FROM pages WHERE page_id % 10 <> 0
""")


def _profile_sql() -> str:
    cols = [("o_orderkey", True), ("o_custkey", True), ("o_orderstatus", False), ("o_totalprice", True),
            ("o_orderdate", False), ("o_orderpriority", False)]
    parts = []
    for c, num in cols:
        mean = f"round(avg({c}), 4)" if num else "CAST(NULL AS DOUBLE)"
        spread = f"round(stddev_samp({c}), 2)" if num else "CAST(NULL AS DOUBLE)"
        marks = ", ".join(f"round(quantile_cont(CAST({c} AS DOUBLE), {q}), 4) AS {n}" if num else f"CAST(NULL AS DOUBLE) AS {n}"
                          for q, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3")))
        parts.append(f"SELECT '{c}' AS \"column\", COUNT({c}) AS count, COUNT(*) - COUNT({c}) AS nulls, "
                     f"CAST(MIN({c}) AS VARCHAR) AS min, CAST(MAX({c}) AS VARCHAR) AS max, {mean} AS mean, {spread} AS stddev, {marks} "
                     f"FROM orders")
    return " UNION ALL ".join(parts)


oracle("d21_profile", _profile_sql())

# --- sorts -------------------------------------------------------------------

oracle("f2_sort_by", W(f"""
SELECT *, row_number() OVER (ORDER BY CAST(job_id AS VARCHAR) NULLS FIRST, platform NULLS FIRST, company NULLS FIRST, title NULLS FIRST)
          AS position FROM {_LI}""", "lineitem_postings"))
oracle("f4_preview", W(f"SELECT * FROM {_LI} ORDER BY job_id, company, platform, title LIMIT 20",
                       "lineitem_postings"))

# --- set operations ---------------------------------------------------------

oracle("g1_union_sources", W("SELECT * FROM postings", "postings"))
oracle("g2_enrich_subset", W("""
SELECT p.job_id, p.platform, p.location,
       CASE WHEN p.platform IN ('jobplanet', 'jumpit')
            THEN CASE WHEN a.lat IS NOT NULL AND a.lon IS NOT NULL THEN [a.lat, a.lon] END
            ELSE p.coordinate END AS coordinate,
       p.year, p.month, p.day
FROM postings p LEFT JOIN posting_addresses a ON p.location = a.location
WHERE p.platform IN ('wanted', 'jumpit', 'rallit', 'jobplanet')
""", "postings", "posting_addresses"))
oracle("g3_union_loose", W("""
SELECT job_id, platform, title, location, CAST(NULL AS VARCHAR) AS company, CAST(NULL AS VARCHAR) AS end_at
FROM postings WHERE platform = 'wanted'
UNION ALL
SELECT job_id, platform, NULL, NULL, company, end_at FROM postings WHERE platform = 'jobplanet'
UNION ALL
SELECT job_id, platform, title, NULL, NULL, end_at FROM postings WHERE platform = 'jumpit'
UNION ALL
SELECT job_id, platform, NULL, location, NULL, NULL FROM postings WHERE platform = 'rallit'
""", "postings"))

# --- scalar functions ---------------------------------------------------

oracle("h1_clean_text", "SELECT doc_id, replace(text, chr(10), ' ') AS text FROM documents")

oracle("h2_h13_text_functions", f"""
SELECT doc_id,
       replace(text, chr(13) || chr(10), chr(10)) AS lf_text,
       nullif(split_part(text, chr(10), 2), '') AS second_line,
       replace(source, ' ', '') AS source_nospace,
       CAST(len({tokens_sql('text')}) AS BIGINT) AS n_tokens,
       substring(lang, 1, 1) AS lang_initial,
       starts_with(text, 'The') AS starts_the,
       {STRIP.format(x="split_part(text, chr(10), 1)")} AS first_line_stripped
FROM documents
""")

oracle("h10_sido_gugun", W(f"""
SELECT job_id, location, {sido_sql('location')} AS sido, {gugun_sql('location')} AS gugun FROM postings
""", "postings"))

oracle("h12_url_id", r"SELECT page_id, nullif(regexp_extract(url, '/(\d+)', 1), '') AS url_id FROM pages")

oracle("h17_date_parts", """
SELECT event_id, y AS year, m AS month, d AS day, y || '-' || lpad(m, 2, '0') || '-' || lpad(d, 2, '0') AS date_str
FROM (SELECT event_id, CAST(year(ts) AS VARCHAR) AS y, CAST(month(ts) AS VARCHAR) AS m,
             CAST(day(ts) AS VARCHAR) AS d FROM events)
""")

oracle("h25_json_field", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.k') AS k_text
FROM events
""")

# --- term extraction ---------------------------------------------------------

oracle("i1_jd_skills", W("SELECT * FROM jd_skills", "jd_skills"))
for _key, _col, _kind in [("i2_preferred_english", "preferred", "english"),
                          ("i3_preferred_korean", "preferred", "korean"),
                          ("i4_responsibility_english", "primary_responsibility", "english"),
                          ("i5_responsibility_korean", "primary_responsibility", "korean"),
                          ("i6_required_english", "required", "english"),
                          ("i7_required_korean", "required", "korean"),
                          ("i8_welfare_english", "welfare", "english"),
                          ("i9_welfare_korean", "welfare", "korean")]:
    oracle(_key, W(f"SELECT * FROM jd_{_col}_{_kind}_nouns", f"jd_{_col}_{_kind}_nouns"))

oracle("i10_latin_terms", "SELECT doc_id, coalesce(regexp_extract_all(text, '[A-Za-z]+'), []) AS terms FROM documents")

oracle("i11_lexicon_terms", W("""
, doc_tokens AS (
  SELECT doc_id, unnest(arr) AS tok, generate_subscripts(arr, 1) AS pos
  FROM (SELECT doc_id, regexp_extract_all(text, '[A-Za-zÀ-ɏ]+') AS arr FROM documents)),
tn AS (""" + segment_sql("doc_tokens") + """),
arr AS (SELECT doc_id, flatten(list(nouns ORDER BY pos)) AS nouns FROM doc_tokens JOIN tn USING (tok) GROUP BY doc_id)
SELECT d.doc_id, coalesce(a.nouns, []) AS nouns FROM documents d LEFT JOIN arr a USING (doc_id)
""", "lexicon").replace("\n, doc_tokens", ",\ndoc_tokens", 1))

oracle("i14_page_links", r"""
SELECT page_id, pos - 1 AS pos, href, posting_id FROM (
  SELECT page_id, unnest(arr) AS href, generate_subscripts(arr, 1) AS pos
  FROM (SELECT page_id, regexp_extract_all(
          regexp_replace(regexp_replace(regexp_replace(html, '<li(?:\s[^>]*)?>', chr(1), 'g'), '</li>', chr(2), 'g'), '<a\s', chr(3), 'g'),
          '\x01[^\x01\x02\x03]*\x03(?:[^>]*\s)?href="([^"]*)"', 1) AS arr FROM pages)
), LATERAL (SELECT nullif(regexp_extract(href, '^/(.+)$', 1), '') AS posting_id)
WHERE posting_id IS NOT NULL
""")

oracle("i15_first_paragraph", f"SELECT page_id, {paragraphs_sql('html')}[1] AS first_paragraph FROM pages")

oracle("i16_page_sections", f"""
SELECT page_id, {html_text_sql(f"nullif(regexp_extract(html, '{HEADING}', 1), '')")} AS position_name,
       ps[1] AS intro, coalesce(ps[3], ps[4]) AS main_work, coalesce(ps[5], ps[6]) AS require,
       coalesce(ps[7], ps[8]) AS preference, coalesce(ps[9], ps[10]) AS welfare
FROM (SELECT page_id, html, {paragraphs_sql('html')} AS ps FROM pages)
""")

# --- alerts -------------------------------------------------------------

_OBJ_TEXT = """
CASE detail_type WHEN 'Object Created' THEN 'A new object has been created in S3'
                 WHEN 'Object Deleted' THEN 'An object has been deleted from S3'
                 ELSE 'Unknown S3 operation' END AS text,
CASE detail_type
  WHEN 'Object Created' THEN 'Bucket Name: ' || bucket_name || chr(10) || 'Object Key: ' || object_key || chr(10)
                             || 'Object Size: ' || CAST(object_size AS VARCHAR) || ' bytes'
  WHEN 'Object Deleted' THEN 'Bucket Name: ' || bucket_name || chr(10) || 'Object Key: ' || object_key
END AS attachment
"""
oracle("j1_object_alerts", W(f"""
SELECT event_id, {_OBJ_TEXT} FROM object_events
WHERE detail_type IN ('Object Created', 'Object Deleted') AND bucket_name IN ('bucket-0', 'bucket-1')
""", "object_events"))
oracle("j1_object_alerts_all", W(f"SELECT event_id, detail_type, {_OBJ_TEXT} FROM object_events", "object_events"))

oracle("j2_job_state_alerts", W("""
SELECT event_id,
       CASE state WHEN 'SUCCEEDED' THEN 'Glue Job ' || job_name || ' has succeeded!'
                  WHEN 'FAILED' THEN 'Glue Job ' || job_name || ' has failed.'
                  WHEN 'TIMEOUT' THEN 'Glue Job ' || job_name || ' has timed out.'
                  WHEN 'STOPPED' THEN 'Glue Job ' || job_name || ' has been stopped.'
                  ELSE '' END AS text,
       CASE WHEN state = 'SUCCEEDED' THEN 'Execution Time: ' || CAST(execution_time // 3600 AS VARCHAR) || 'h '
            || CAST((execution_time % 3600) // 60 AS VARCHAR) || 'm ' || CAST(execution_time % 60 AS VARCHAR) || 's.'
       END AS attachment
FROM job_events
WHERE state IN ('SUCCEEDED', 'FAILED', 'TIMEOUT', 'STOPPED') AND job_name IN ('first_stage', 'second_stage')
""", "job_events"))

# --- composite -------------------------------------------------------------

oracle("k2_second_stage", W("SELECT * FROM enriched", "enriched"))

oracle("h16_reformat_date", """
SELECT o_orderkey, strftime(o_orderdate, '%Y.%m.%d') AS dotted, strftime(o_orderdate, '%Y-%m-%d') AS end_at,
       CAST(NULL AS VARCHAR) AS not_a_date
FROM orders
""")

oracle("i13_eda_terms", W("SELECT * FROM eda_enriched", "eda_enriched"))

# --- site payloads back to postings (B14-B18) -------------------------------------

_POSTING_COLS = ("job_id, platform, category, url, company, {title}, primary_responsibility, required, "
                 "{preferred}, {end_at}, skills, {location}, {welfare}, {body}, {company_description}, {coordinate}")

oracle("b14_normalize_wanted", W("SELECT " + _POSTING_COLS.format(
    title="coalesce(title, '') AS title", preferred="preferred", end_at="end_at", location="location",
    welfare="welfare", body="'' AS body", company_description="company_description",
    coordinate="coordinate") + " FROM postings WHERE platform = 'wanted' AND CAST(job_id AS BIGINT) % 17 <> 0 AND CAST(job_id AS BIGINT) % 19 <> 0", "postings"))

oracle("b15_normalize_jumpit", W("SELECT " + _POSTING_COLS.format(
    title="title", preferred="preferred", end_at="end_at", location="location", welfare="welfare",
    body="CAST(NULL AS VARCHAR) AS body", company_description="company_description",
    coordinate="CAST(NULL AS DOUBLE[]) AS coordinate") + " FROM postings WHERE platform = 'jumpit' AND CAST(job_id AS BIGINT) % 17 <> 0", "postings"))

oracle("b16_normalize_jobplanet", W("SELECT " + _POSTING_COLS.format(
    title="title", preferred="nullif(preferred, '') AS preferred",
    end_at="strftime(TRY_CAST(end_at AS DATE), '%Y-%m-%d') AS end_at",
    location="nullif(coalesce(location, ''), '') AS location", welfare="nullif(welfare, '') AS welfare",
    body="CAST(NULL AS VARCHAR) AS body", company_description="nullif(company_description, '') AS company_description",
    coordinate="CAST(NULL AS DOUBLE[]) AS coordinate") + " FROM postings WHERE platform = 'jobplanet' AND CAST(job_id AS BIGINT) % 17 <> 0", "postings"))

oracle("b17_normalize_rallit", W("SELECT " + _POSTING_COLS.format(
    title="title", preferred="preferred", end_at="end_at", location="location", welfare="welfare",
    body="body", company_description="company_description",
    coordinate="CASE WHEN coordinate[1] <> 0 AND coordinate[2] <> 0 THEN coordinate END AS coordinate")
    + " FROM postings WHERE platform = 'rallit' AND CAST(job_id AS BIGINT) % 17 <> 0", "postings"))

oracle("b1_landing_rows", W("""
SELECT * EXCLUDE (g) FROM (
  SELECT *, CAST(floor(CAST(job_id AS BIGINT) / 64) AS BIGINT) AS g FROM postings)
WHERE g % 7 <> 6
""", "postings"))

oracle("d22_row_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS rows FROM {t}" for t in (
        "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
        "embeddings", "pages", "benchmark", "labels", "conversations")))

oracle("h26_first_nested", """
SELECT event_id,
       CASE WHEN event_id % 5 = 0 OR event_id % 7 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS x,
       CASE WHEN event_id % 5 = 0 OR event_id % 7 = 0 THEN NULL ELSE CAST(json_extract(props, '$.k') AS BIGINT) END AS k
FROM events
""")

oracle("i17_clean_tags", r"""
SELECT page_id,
       list_transform(regexp_extract_all(html, '<li[^>]*>\s*<a href="[^"]*">([^<]*)</a>', 1),
                      lambda t: regexp_replace(replace(t, '#', ''), '^\s+|\s+$', '', 'g')) AS tags
FROM pages
""")

# --- composed layers (K3-K5) ----------------------------------------------------


def _digest(name: str, sql: str, cols: list[str]) -> str:
    """One line for a table; DOUBLE columns are marked with a leading '.'."""
    text = []
    for c in sorted(cols, key=lambda c: c.lstrip(".")):
        v = f'CAST(round("{c[1:]}" * 10000) AS BIGINT)' if c[0] == "." else f'"{c}"'
        text.append(f"coalesce(CAST({v} AS VARCHAR), '~')")
    part = f"CAST('0x' || substr(md5(concat_ws('|', {', '.join(text)})), 1, 7) AS BIGINT)"
    return (f"SELECT '{name}' AS table_name, COUNT(*) AS rows, CAST(coalesce(SUM({part}), 0) AS BIGINT) AS checksum "
            f"FROM ({sql}) AS t")


_CATS = ["major_category", "middle_category", "sub_category"]
_POST = [*_CATS, "platform", "job_id"]
_K3 = [("daily_jd_table", "b10_daily_postings", ["year", "month", "day", "date_str", *_POST, "company", "title"]),
       ("company_detail", "b8_company_detail", ["company", ".lat", ".lon", "company_description"]),
       ("jd_skills", "i1_jd_skills", ["job_id", "platform", "unnested_skill"])]
for _i, (_c, _k) in enumerate([(c, k) for c in ("preferred", "responsibility", "required", "welfare") for k in ("english", "korean")]):
    _col = "primary_responsibility" if _c == "responsibility" else _c
    _K3.append((f"jd_{_col}_{_k}_nouns", f"i{_i + 2}_{_c}_{_k}", ["job_id", "platform", f"unnested_{_col}_{_k}_nouns"]))
oracle("k3_normalized_layer", " UNION ALL ".join(_digest(n, ORACLE[k], c) for n, k, c in _K3))

_K4 = [("unique_jds", "b11_unique_postings", [*_POST, "title", "company"]),
       ("unique_category_count_major", "d1_count_major", ["major_category", "count"]),
       ("unique_category_count_major_middle", "d2_count_major_middle", ["major_category", "middle_category", "count"]),
       ("unique_category_count_sub", "b9_sub_category_list", ["sub_category"]),
       ("unique_daily_job_posting_count", "d4_daily_counts", ["date_str", "count"]),
       ("unique_upcoming_deadline_jobs_7days", "b7_upcoming_deadlines",
        ["company", "title", "url", "end_at", "primary_responsibility", "company_description", "major_category", "middle_category"]),
       ("unique_company_coordinates", "c8_company_coordinates", [*_CATS, "company", ".lat", ".lon"]),
       ("unique_jd_skills", "c2_posting_skills", ["major_category", "middle_category", "platform", "job_id", "skill"]),
       ("unique_preferred_english", "c3_posting_preferred", [*_POST, "preferred"]),
       ("unique_required_english", "c4_posting_required", [*_POST, "required"]),
       ("unique_primary_responsibility_english", "c5_posting_responsibility", [*_POST, "primary_responsibility"]),
       ("unique_welfare_english", "c6_posting_welfare_english", [*_POST, "unnested_welfare_english_nouns"]),
       ("unique_welfare_korean", "c7_posting_welfare_korean", [*_POST, "unnested_welfare_korean_nouns"])]
oracle("k4_mart_layer", " UNION ALL ".join(_digest(n, ORACLE[k], c) for n, k, c in _K4))

_NON_NULL = f"SELECT {', '.join(_CATS)}, COUNT(job_id) AS job_id_count FROM cleaned GROUP BY ALL"
_CLEANED = ["year", "month", "day", "job_id", "platform", "category", *_CATS, "company", "title", "preferred", "required",
            "primary_responsibility", "url", "end_at", "skills", "location", "welfare", "body", "company_description", "coordinate"]
_DUP = [c for c in _CLEANED if c not in ("skills", "coordinate")]


def _ranked(col: str, expr: str) -> str:
    return f"SELECT {col}, COUNT(*) AS count FROM (SELECT {expr} AS {col} FROM cleaned) WHERE {col} IS NOT NULL GROUP BY 1"


def _repeated(keys: list[str]) -> str:
    same = " AND ".join(f"c.{k} IS NOT DISTINCT FROM r.{k}" for k in keys)
    return (f"SELECT c.* FROM cleaned c JOIN (SELECT {', '.join(keys)} FROM cleaned GROUP BY ALL HAVING COUNT(*) > 1) r ON {same}")


oracle("k5_explore", W(" UNION ALL ".join([
    _digest("count_non_null", _NON_NULL, [*_CATS, "job_id_count"]),
    _digest("ranked_major", _ranked("major_category", "major_category"), ["major_category", "count"]),
    _digest("ranked_middle", _ranked("middle_category", "middle_category"), ["middle_category", "count"]),
    _digest("groups_per_middle", f"SELECT middle_category, COUNT(job_id_count) AS job_id_count FROM ({_NON_NULL}) "
            "WHERE middle_category IS NOT NULL GROUP BY 1", ["middle_category", "job_id_count"]),
    _digest("count_by_sido", _ranked("sido_location", sido_sql("location")), ["sido_location", "count"]),
    _digest("count_by_gugun", _ranked("gugun_location", gugun_sql("location")), ["gugun_location", "count"]),
    _digest("duplicate_rows", _repeated(["job_id"]), _DUP),
    _digest("duplicate_rows_pair", _repeated(["job_id", "company"]), _DUP),
    _digest("duplicate_summary", _dup_summary("cleaned"), ["total_rows", "dup_rows", "dup_pair_rows", "dup_count_half",
                                                            "net_postings_half", "removable_rows", "net_postings"]),
    _digest("profile", " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", COUNT({c}) AS count, COUNT(*) - COUNT({c}) AS nulls, "
        f"{f'MIN({c})' if c in _DUP else 'NULL'} AS min, {f'MAX({c})' if c in _DUP else 'NULL'} AS max, "
        "CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS stddev FROM cleaned" for c in _CLEANED),
        ["column", "count", "nulls", "min", "max", ".mean", ".stddev"]),
]), "cleaned"))

oracle("d13_count_by", """
SELECT n_name AS location, COUNT(*) AS count FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey GROUP BY 1
""")
