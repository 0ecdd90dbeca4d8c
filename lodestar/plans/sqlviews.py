"""DuckDB SQL twins of ``lodestar.sources.views`` and the text functions.

Used only to build the oracle queries; each helper returns a SQL fragment.
RE2 (DuckDB) treats ``\\b`` and ``\\w`` as ASCII like ECMAScript, so the
rules are written with ``\\b`` here and with look-arounds on the Spark side.
"""

from __future__ import annotations

from lodestar.constants import AS_OF, EDUCATION_LEVELS, FILLER_WORDS, REGIONS, TYPES

SP = r"[\t\n\x0B\f\r\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"


def lst(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def spaces(x: str) -> str:
    return f"regexp_replace({x}, '{SP}', ' ', 'g')"


def norm_hash(x: str) -> str:
    s = f"trim(lower({spaces(x)}))"
    s = f"regexp_replace({s}, '[^A-Za-z0-9_ ]', '', 'g')"
    return f"regexp_replace({s}, ' +', ' ', 'g')"


def norm_title(x: str) -> str:
    s = f"lower({spaces(x)})"
    s = f"regexp_replace({s}, '\\b20[0-9]{{2}}\\b', '', 'g')"
    s = f"regexp_replace({s}, '[^A-Za-z0-9_ ]', '', 'g')"
    s = f"regexp_replace({s}, '\\b({'|'.join(FILLER_WORDS)})\\b', '', 'g')"
    s = f"regexp_replace({s}, ' +', ' ', 'g')"
    return f"trim({s})"


def item_hash(t: str, u: str) -> str:
    return f"sha256({norm_hash(t)} || '|' || {norm_hash(u)})"


def sort_key(x: str) -> str:
    s = f"trim(regexp_replace(lower({x}), '[^a-z0-9]+', ' ', 'g'))"
    return f"array_to_string(list_sort(string_split({s}, ' ')), ' ')"


def slug(t: str, u: str) -> str:
    s = f"lower({spaces(t)})"
    s = f"regexp_replace({s}, '[^a-z0-9 -]', '', 'g')"
    s = f"regexp_replace({s}, ' +', '-', 'g')"
    s = f"regexp_replace({s}, '-+', '-', 'g')"
    s = f"regexp_replace(substring({s}, 1, 60), '-$', '')"
    return f"({s} || '-' || substring(sha256({u}), 1, 8))"


def present(x: str) -> str:
    return f"({x} IS NOT NULL AND length({x}) > 0)"


def completeness(p: str = "") -> str:
    return ("LEAST("
            f"(CASE WHEN {present(p + 'title')} THEN 20 ELSE 0 END)"
            f" + (CASE WHEN {p}description IS NOT NULL AND length({p}description) > 50 THEN 20 ELSE 0 END)"
            f" + (CASE WHEN {p}deadline IS NOT NULL THEN 15 ELSE 0 END)"
            f" + (CASE WHEN {present(p + 'organization')} THEN 15 ELSE 0 END)"
            f" + (CASE WHEN {present(p + 'application_url')} THEN 15 ELSE 0 END)"
            f" + (CASE WHEN {present(p + 'funding_amount')} THEN 10 ELSE 0 END)"
            f" + (CASE WHEN {present(p + 'eligibility_text')} THEN 5 ELSE 0 END), 100)")


def as_of(v: str = AS_OF) -> str:
    return f"TIMESTAMP '{v}'"


def status(doc: str = "doc_id") -> str:
    return (f"(CASE {doc} % 10 WHEN 7 THEN 'expired' WHEN 8 THEN 'flagged' "
            f"WHEN 9 THEN 'removed' ELSE 'active' END)")


ITEMS = f"""items AS (
  SELECT doc_id, doc_id AS item_order,
    split_part(text, chr(10), 1) AS title,
    text AS description,
    split_part(text, chr(10), 2) AS summary,
    ({lst(TYPES)})[doc_id % 8 + 1] AS type,
    [source, lang] AS fields,
    [({lst(REGIONS)})[(doc_id // 8) % 8 + 1]] AS regions,
    CAST([] AS VARCHAR[]) AS countries,
    [({lst(EDUCATION_LEVELS)})[doc_id % 6 + 1]] AS target_audience,
    CASE WHEN lang = 'en' THEN 'Open to all applicants' ELSE '' END AS eligibility_text,
    CASE WHEN doc_id % 5 = 0 THEN NULL
         ELSE DATE '2024-01-31' + CAST(doc_id % 60 - 20 AS INTEGER) END AS deadline,
    doc_id % 13 = 0 AS is_rolling,
    CASE WHEN doc_id % 3 = 0 THEN NULL ELSE 'USD ' || CAST(n_chars AS VARCHAR) END AS funding_amount,
    doc_id % 4 = 0 AS is_fully_funded,
    CASE WHEN doc_id % 11 = 0 THEN NULL ELSE source END AS organization,
    CASE WHEN doc_id % 9 = 0 THEN NULL
         ELSE 'https://apply.example.org/' || lang || '/' || CAST(doc_id AS VARCHAR) END AS application_url,
    'https://www.example.org/' || lang || '/' || CAST(doc_id % 4 AS VARCHAR) AS source_url,
    source AS source_site, lang
  FROM documents)"""

OPPORTUNITIES = f"""opportunities AS (
  SELECT 'doc-' || CAST(doc_id AS VARCHAR) AS id, doc_id, title,
    {slug('title', "('https://www.example.org/' || lang || '/' || CAST(doc_id AS VARCHAR))")} AS slug,
    description, summary, type, fields, regions, countries, target_audience,
    eligibility_text, deadline, is_rolling, funding_amount, is_fully_funded,
    'https://www.example.org/' || lang || '/' || CAST(doc_id AS VARCHAR) AS source_url,
    source_site, organization, application_url,
    {status()} AS status,
    'basic' AS verification_level, 'low' AS scam_risk,
    CAST({completeness()} AS INTEGER) AS completeness_score,
    true AS ai_processed,
    CAST(NULL AS VARCHAR) AS source_hash, CAST(NULL AS VARCHAR) AS raw_html,
    CAST(NULL AS VARCHAR) AS deadline_text,
    {as_of()} - to_hours(CAST(doc_id % 240 AS BIGINT)) AS created_at,
    {as_of()} - to_hours(CAST(doc_id % 240 AS BIGINT)) AS updated_at
  FROM items)"""

STORED_ITEMS = f"""stored_items AS (
  SELECT i.*, {status('i.doc_id')} AS status FROM items i
  WHERE i.doc_id IN (SELECT doc_id FROM labels))"""

BATCH_ITEMS = """batch_items AS (
  SELECT i.* FROM items i WHERE i.doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL))"""

DISTRIBUTION_LOG = """distribution_log AS (
  SELECT 'log-' || CAST(event_id AS VARCHAR) AS id,
    CASE WHEN value < 1.0 THEN NULL ELSE 'doc-' || CAST(event_id // 10 AS VARCHAR) END AS opportunity_id,
    CASE WHEN event_type = 'click' THEN 'telegram' ELSE 'email_digest' END AS channel,
    'user-' || CAST(user_id AS VARCHAR) AS channel_detail,
    ts AS posted_at,
    CASE WHEN value > 400.0 THEN 'failed' ELSE 'sent' END AS status,
    CAST(event_id AS VARCHAR) AS external_id
  FROM events WHERE event_type IN ('click', 'view'))"""

FLAGGED_LISTINGS = """flagged_listings AS (
  SELECT 'flag-' || CAST(event_id AS VARCHAR) AS id,
    'doc-' || CAST(event_id // 10 AS VARCHAR) AS opportunity_id,
    CASE WHEN value > 100.0 THEN 'suspicious_content' ELSE 'extraction_failed' END AS flag_reason,
    'URL: https://www.example.org/e/' || CAST(event_id AS VARCHAR) AS details,
    true AS auto_flagged,
    event_id % 2 = 0 AS reviewed,
    CASE WHEN event_id % 2 = 0 THEN 'user-' || CAST(user_id AS VARCHAR) END AS reviewed_by,
    CASE WHEN event_id % 2 = 0 THEN ts + INTERVAL 1 DAY END AS reviewed_at,
    ts AS created_at
  FROM events WHERE event_type = 'error')"""

USER_PROFILES = f"""user_profiles AS (
  SELECT 'user-' || CAST(c_custkey AS VARCHAR) AS id, c_name AS display_name,
    lower(c_name) || '@example.org' AS email,
    CAST(c_nationkey AS VARCHAR) AS nationality,
    c_mktsegment AS field_of_study,
    CASE WHEN c_acctbal < 0 THEN 'unknown' ELSE ({lst(EDUCATION_LEVELS)})[c_custkey % 6 + 1] END AS education_level,
    [c_mktsegment] AS interests,
    [({lst(REGIONS)})[c_nationkey % 8 + 1]] AS regions_of_interest,
    {as_of()} AS created_at, {as_of()} AS updated_at
  FROM customer)"""

SAVED_OPPORTUNITIES = """saved_opportunities AS (
  SELECT 'user-' || CAST(o_custkey AS VARCHAR) AS user_id,
    'doc-' || CAST(o_orderkey // 12 AS VARCHAR) AS opportunity_id,
    o_orderdate AS saved_at
  FROM orders)"""

SCRAPE_RUNS = """scrape_runs AS (
  SELECT 'run-' || source_site || '-' || strftime(day, '%Y%m%d') AS id, source_site, started_at, completed_at,
    CASE WHEN errors > 0 AND scraped > 0 THEN 'partial' WHEN errors > 0 THEN 'failed' ELSE 'success' END AS status,
    CAST(listings_found AS INTEGER) AS listings_found, CAST(scraped AS INTEGER) AS listings_new,
    0 AS listings_duplicate, CAST(NULL AS VARCHAR) AS error_message,
    CAST(date_diff('second', started_at, completed_at) AS INTEGER) AS duration_seconds
  FROM (SELECT 'src' || CAST(user_id % 20 AS VARCHAR) AS source_site, CAST(ts AS DATE) AS day,
          min(ts) AS started_at, max(ts) AS completed_at, count(*) AS listings_found,
          count(*) FILTER (WHERE event_type <> 'error') AS scraped,
          count(*) FILTER (WHERE event_type = 'error') AS errors
        FROM events GROUP BY 1, 2))"""

_DEPS = {
    "items": [],
    "opportunities": ["items"],
    "stored_items": ["items"],
    "batch_items": ["items"],
    "distribution_log": [],
    "flagged_listings": [],
    "user_profiles": [],
    "saved_opportunities": [],
    "scrape_runs": [],
}
_SQL = {"items": ITEMS, "opportunities": OPPORTUNITIES, "stored_items": STORED_ITEMS,
        "batch_items": BATCH_ITEMS, "distribution_log": DISTRIBUTION_LOG,
        "flagged_listings": FLAGGED_LISTINGS, "user_profiles": USER_PROFILES,
        "saved_opportunities": SAVED_OPPORTUNITIES, "scrape_runs": SCRAPE_RUNS}


def with_views(*names: str, extra: list[str] | None = None) -> str:
    """``WITH`` clause holding the named views and their dependencies, in
    dependency order, followed by any extra CTE fragments."""
    order: list[str] = []

    def add(n):
        for dep in _DEPS[n]:
            add(dep)
        if n not in order:
            order.append(n)
    for n in names:
        add(n)
    parts = [_SQL[n] for n in order] + list(extra or [])
    return "WITH " + ",\n".join(parts) + "\n" if parts else ""
