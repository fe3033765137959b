"""DuckDB CTEs that derive the fixtures (FIXTURES.md) from the given tables.

These are the oracle's own definitions, written from the fixture rules, not
from the Spark plans. Nothing is imported from the library.
"""

from __future__ import annotations

from .values import PART_TYPE_TAXONOMY, POSTING_ADDRESSES, URL_PREFIX, loose_taxonomy_rows, taxonomy_rows


def q(s: str | None) -> str:
    if s is None:
        return "NULL"
    return "'" + s.replace("'", "''") + "'"


def _values(rows, cols) -> str:
    body = ", ".join("(" + ", ".join(q(v) if isinstance(v, str) or v is None else repr(float(v)) for v in r) + ")"
                     for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({', '.join(cols)})"


SUB_LIST = "[" + ", ".join(q(sub) for _, _, sub in taxonomy_rows()) + "]"
URL_CASE = "CASE platform " + " ".join(f"WHEN {q(p)} THEN {q(u)} || job_id" for p, u in URL_PREFIX.items()) + " END"

CTES: dict[str, tuple[str, list[str]]] = {}


def cte(name: str, sql: str, deps: list[str] | None = None) -> None:
    CTES[name] = (sql, deps or [])


cte("taxonomy", _values(taxonomy_rows(), ["major_category", "middle_category", "sub_category"]))
cte("loose_taxonomy", _values(loose_taxonomy_rows(), ["category_key", "major_category", "middle_category"]))
cte("part_taxonomy", _values(PART_TYPE_TAXONOMY, ["major_category", "middle_category", "sub_category"]))
cte("posting_addresses", "SELECT location, CAST(lat AS DOUBLE) AS lat, CAST(lon AS DOUBLE) AS lon FROM ("
    + _values(POSTING_ADDRESSES, ["location", "lat", "lon"]) + ")")

cte("posting_base", f"""
SELECT d.doc_id, d.text, d.lang, d.source, s.k,
       CAST(ceil(length(d.text) / 4) AS INTEGER) AS qn,
       CAST((d.doc_id * 7 + s.k) % 96 AS INTEGER) AS cat_n,
       DATE '2024-01-01' + CAST(d.doc_id % 45 + s.k AS INTEGER) AS snap,
       CASE d.doc_id % 4 WHEN 0 THEN 'wanted' WHEN 1 THEN 'jumpit' WHEN 2 THEN 'rallit' ELSE 'jobplanet' END AS platform,
       CAST(d.doc_id AS VARCHAR) AS job_id
FROM documents d, range(0, 3) s(k)
WHERE s.k <= d.doc_id % 3
""")

cte("postings", f"""
SELECT
  job_id,
  platform,
  CASE WHEN cat_n = 95 THEN '블록체인 엔지니어' WHEN cat_n < 88 THEN {SUB_LIST}[cat_n + 1] ELSE 'unmapped-' || CAST(cat_n AS VARCHAR) END AS category,
  {URL_CASE} AS url,
  CASE WHEN doc_id % 50 = 0 THEN NULL ELSE 'company-' || CAST(doc_id % 200 AS VARCHAR) END AS company,
  split_part(text, chr(10), 1) AS title,
  substring(text, 2 * qn + 1, qn) AS primary_responsibility,
  substring(text, qn + 1, qn) AS required,
  substring(text, 1, qn) AS preferred,
  CASE WHEN doc_id % 11 = 0 THEN NULL
       WHEN doc_id % 13 = 0 THEN 'open-ended'
       ELSE CAST(DATE '2024-01-01' + CAST(doc_id % 45 AS INTEGER) AS VARCHAR) END AS end_at,
  CASE WHEN doc_id % 7 = 0 THEN NULL ELSE regexp_extract_all(text, '[A-Z][A-Za-z]+') END AS skills,
  CASE WHEN doc_id % 10 = 3 THEN chr(12288) || '경기' || chr(12288) || '성남시'
       WHEN doc_id % 20 = 8 THEN '부산' || chr(160) || '해운대구' ELSE
  CASE doc_id % 5 WHEN 0 THEN '서울 강남구' WHEN 1 THEN '주소 경기 성남시' WHEN 2 THEN '부산'
       WHEN 3 THEN NULL ELSE '서울  마포구' END END AS location,
  substring(text, 3 * qn + 1, length(text) + 1) AS welfare,
  CASE platform WHEN 'wanted' THEN '' WHEN 'rallit' THEN lang ELSE NULL END AS body,
  source || chr(10) || lang AS company_description,
  CASE WHEN doc_id % 3 = 0 THEN NULL
       ELSE [CAST(33.0 AS DOUBLE) + CAST(doc_id % 50 AS DOUBLE) / CAST(10.0 AS DOUBLE),
             CAST(126.0 AS DOUBLE) + CAST(doc_id % 30 AS DOUBLE) / CAST(10.0 AS DOUBLE)] END AS coordinate,
  CAST(year(snap) AS VARCHAR) AS year,
  CAST(month(snap) AS VARCHAR) AS month,
  lpad(CAST(day(snap) AS VARCHAR), 2, '0') AS day
FROM posting_base
""", ["posting_base"])

# First stage: classify, clean five text columns, geocode two platforms.
cte("classified", """
SELECT p.*, t.major_category, t.middle_category, t.sub_category
FROM postings p LEFT JOIN taxonomy t ON p.category = t.sub_category
""", ["postings", "taxonomy"])

cte("cleaned", """
SELECT c.year, c.month, c.day, c.job_id, c.platform, c.category, c.major_category, c.middle_category,
       c.sub_category, c.company, c.title,
       replace(c.preferred, chr(10), ' ') AS preferred,
       replace(c.required, chr(10), ' ') AS required,
       replace(c.primary_responsibility, chr(10), ' ') AS primary_responsibility,
       c.url, c.end_at, c.skills, c.location,
       replace(c.welfare, chr(10), ' ') AS welfare,
       c.body,
       replace(c.company_description, chr(10), ' ') AS company_description,
       CASE WHEN c.platform IN ('jobplanet', 'jumpit')
            THEN CASE WHEN a.lat IS NOT NULL AND a.lon IS NOT NULL THEN [a.lat, a.lon] END
            ELSE c.coordinate END AS coordinate
FROM classified c LEFT JOIN posting_addresses a ON c.location = a.location
WHERE c.platform IN ('wanted', 'jumpit', 'rallit', 'jobplanet')
""", ["classified", "posting_addresses"])

# Latin terms per text column (whole text, repeats kept, blank -> []).
_LAT = "coalesce(regexp_extract_all({c}, '[A-Za-z]+'), [])"

# Lexicon and the nouns of every token (Korean path stand-in).
cte("lexicon", """
SELECT DISTINCT term FROM (
  SELECT unnest(regexp_extract_all(text, '[A-Za-zÀ-ɏ]+')) AS term FROM benchmark
)
""")



def segment_sql(tokens: str) -> str:
    """(tok, nouns) by dynamic programming over the positions of a token: best
    value and words up to each; a word gains 2 per letter less 1."""
    return f"""
SELECT tok, nouns FROM (
  WITH RECURSIVE hits AS (
    SELECT v.tok, v.s, v.s + v.n AS e, 2 * v.n - 1 AS g, l.term
    FROM (SELECT tok, s, unnest(generate_series(1, least(length(tok) - s, (SELECT max(length(term)) FROM lexicon)))) AS n
          FROM (SELECT tok, unnest(generate_series(0, length(tok) - 1)) AS s FROM (SELECT DISTINCT tok FROM {tokens}))) v
    JOIN lexicon l ON l.term = substring(v.tok, v.s + 1, v.n)
  ), ends AS (
    SELECT tok, e, list({{'s': s, 'g': g, 't': term}}) AS m FROM hits GROUP BY tok, e
  ), dp(tok, i, best) AS (
    SELECT tok, 0::BIGINT, [{{'v': 0::BIGINT, 'w': []::VARCHAR[]}}] FROM (SELECT DISTINCT tok FROM hits)
    UNION ALL
    SELECT d.tok, d.i + 1, list_append(d.best, list_sort(list_append(
             list_transform(coalesce(x.m, []), lambda h: {{'v': d.best[h.s + 1].v + h.g, 'w': list_append(d.best[h.s + 1].w, h.t)}}),
             d.best[d.i + 1]), 'DESC')[1])
    FROM dp d LEFT JOIN ends x ON x.tok = d.tok AND x.e = d.i + 1 WHERE d.i < length(d.tok)
  )
  SELECT tok, best[length(tok) + 1].w AS nouns FROM dp WHERE i = length(tok)
)
"""


_KO_COLS = ["preferred", "required", "primary_responsibility", "welfare"]
_KO_PAT = "[A-Za-zÀ-ɏ]+"
# Noun arrays are a function of the text alone, so they are keyed by text.
cte("ko_texts", "SELECT DISTINCT txt FROM (" + " UNION ALL ".join(
    f"SELECT {c} AS txt FROM cleaned" for c in _KO_COLS) + ") WHERE txt IS NOT NULL", ["cleaned"])
cte("ko_tokens", f"""
SELECT txt, unnest(arr) AS tok, generate_subscripts(arr, 1) AS pos
FROM (SELECT txt, regexp_extract_all(txt, '{_KO_PAT}') AS arr FROM ko_texts)
""", ["ko_texts"])
cte("token_nouns", segment_sql("ko_tokens"), ["ko_tokens", "lexicon"])
cte("ko_arrays", """
SELECT txt, flatten(list(nouns ORDER BY pos)) AS nouns
FROM ko_tokens JOIN token_nouns USING (tok)
GROUP BY txt
""", ["ko_tokens", "token_nouns"])

cte("enriched", "SELECT c.*, " + ", ".join(
    f"coalesce(k{i}.nouns, []) AS {c}_korean_nouns" for i, c in enumerate(_KO_COLS)) + ", " + ", ".join(
    f"{_LAT.format(c='c.' + c)} AS {c}_english_nouns" for c in _KO_COLS) + " FROM cleaned c " + " ".join(
    f"LEFT JOIN ko_arrays k{i} ON k{i}.txt = c.{c}" for i, c in enumerate(_KO_COLS)),
    ["cleaned", "ko_arrays"])

cte("daily", """
SELECT DISTINCT year, month, day,
       year || '-' || lpad(month, 2, '0') || '-' || lpad(day, 2, '0') AS date_str,
       platform, job_id, company, title, major_category, middle_category, sub_category
FROM cleaned
""", ["cleaned"])
cte("unique_jds", """
SELECT DISTINCT platform, job_id, title, company, major_category, middle_category, sub_category FROM daily
""", ["daily"])
cte("company_detail", """
SELECT DISTINCT company,
       CASE WHEN coordinate IS NOT NULL THEN CAST(coordinate[1] AS DOUBLE) ELSE NULL END AS lat,
       CASE WHEN coordinate IS NOT NULL THEN CAST(coordinate[2] AS DOUBLE) ELSE NULL END AS lon,
       company_description
FROM cleaned
""", ["cleaned"])


def _term_table(name: str, col: str, out: str, src: str = "enriched") -> None:
    cte(name, f"SELECT DISTINCT job_id, platform, t.{out} FROM {src}, unnest({col}) AS t({out})", [src])


_term_table("jd_skills", "skills", "unnested_skill", "cleaned")
for _c in _KO_COLS:
    for _k in ("english", "korean"):
        _term_table(f"jd_{_c}_{_k}_nouns", f"{_c}_{_k}_nouns", f"unnested_{_c}_{_k}_nouns")

# lineitem binding
cte("lineitem_postings", """
SELECT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS job_id,
       l.l_returnflag AS platform, p.p_type AS category,
       'supplier-' || CAST(l.l_suppkey AS VARCHAR) AS company,
       'part-' || CAST(l.l_partkey AS VARCHAR) AS title,
       CAST(year(l.l_shipdate) AS VARCHAR) AS year,
       CAST(month(l.l_shipdate) AS VARCHAR) AS month,
       CAST(day(l.l_shipdate) AS VARCHAR) AS day
FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey
""")
cte("lineitem_classified", """
SELECT l.*, t.major_category, t.middle_category, t.sub_category
FROM lineitem_postings l LEFT JOIN part_taxonomy t ON l.category = t.sub_category
""", ["lineitem_postings", "part_taxonomy"])

# orders binding
cte("order_postings", """
SELECT CAST(o_orderkey AS VARCHAR) AS job_id,
       CASE o_orderstatus WHEN 'F' THEN 'wanted' WHEN 'O' THEN 'rallit' WHEN 'P' THEN 'jumpit' END AS platform,
       'customer-' || CAST(o_custkey AS VARCHAR) AS company,
       'order-' || CAST(o_orderkey AS VARCHAR) AS title,
       'orders/' || CAST(o_orderkey AS VARCHAR) AS url,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS end_at,
       o_orderpriority AS primary_responsibility,
       'segment of customer ' || CAST(o_custkey AS VARCHAR) AS company_description,
       o_orderstatus AS major_category, o_orderpriority AS middle_category,
       CAST(NULL AS VARCHAR) AS sub_category, o_totalprice, o_orderdate
FROM orders
""")

# events binding
cte("event_postings", """
SELECT CAST(year(ts) AS VARCHAR) AS year, CAST(month(ts) AS VARCHAR) AS month, CAST(day(ts) AS VARCHAR) AS day,
       event_type AS platform, CAST(user_id AS VARCHAR) AS job_id,
       CAST(NULL AS VARCHAR) AS company, CAST(NULL AS VARCHAR) AS title,
       CAST(NULL AS VARCHAR) AS major_category, CAST(NULL AS VARCHAR) AS middle_category,
       CAST(NULL AS VARCHAR) AS sub_category
FROM events
""")


def with_ctes(final_sql: str, *names: str) -> str:
    """Prefix ``final_sql`` with the named CTEs and their dependencies."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return final_sql
    body = ",\n".join(f"{n} AS ({CTES[n][0].strip()})" for n in order)
    return f"WITH {body}\n{final_sql}"

# events as operational events
cte("object_events", """
SELECT event_id,
       CASE event_type WHEN 'purchase' THEN 'Object Created' WHEN 'error' THEN 'Object Deleted'
            ELSE event_type END AS detail_type,
       'bucket-' || CAST(user_id % 3 AS VARCHAR) AS bucket_name,
       'events/' || CAST(event_id AS VARCHAR) || '.json' AS object_key,
       CAST(floor(value * 100) AS BIGINT) AS object_size
FROM events
""")
cte("job_events", """
SELECT event_id,
       CASE user_id % 3 WHEN 0 THEN 'first_stage' WHEN 1 THEN 'second_stage' ELSE 'other_job' END AS job_name,
       'run-' || CAST(event_id AS VARCHAR) AS job_run_id,
       CASE event_type WHEN 'purchase' THEN 'SUCCEEDED' WHEN 'error' THEN 'FAILED' WHEN 'click' THEN 'TIMEOUT'
            WHEN 'view' THEN 'STOPPED' ELSE 'RUNNING' END AS state,
       CAST(floor(value * 30) AS BIGINT) AS execution_time
FROM events
""")


# Term arrays over the five columns of the exploratory report
_EDA_COLS = ["required", "primary_responsibility", "preferred", "welfare", "company_description"]
cte("eda_texts", "SELECT DISTINCT txt FROM (" + " UNION ALL ".join(
    f"SELECT {c} AS txt FROM cleaned" for c in _EDA_COLS) + ") WHERE txt IS NOT NULL", ["cleaned"])
cte("eda_tokens", f"""
SELECT txt, unnest(arr) AS tok, generate_subscripts(arr, 1) AS pos
FROM (SELECT txt, regexp_extract_all(txt, '{_KO_PAT}') AS arr FROM eda_texts)
""", ["eda_texts"])
cte("eda_token_nouns", segment_sql("eda_tokens"), ["eda_tokens", "lexicon"])
cte("eda_arrays", """
SELECT txt, flatten(list(nouns ORDER BY pos)) AS nouns FROM eda_tokens JOIN eda_token_nouns USING (tok) GROUP BY txt
""", ["eda_tokens", "eda_token_nouns"])
cte("eda_enriched", "SELECT c.job_id, c.platform, c.category, c.year, c.month, c.day, " + ", ".join(
    f"coalesce(k{i}.nouns, []) AS {c}_korean_nouns" for i, c in enumerate(_EDA_COLS)) + ", " + ", ".join(
    f"{_LAT.format(c='c.' + c)} AS {c}_english_nouns" for c in _EDA_COLS) + " FROM cleaned c " + " ".join(
    f"LEFT JOIN eda_arrays k{i} ON k{i}.txt = c.{c}" for i, c in enumerate(_EDA_COLS)),
    ["cleaned", "eda_arrays"])
