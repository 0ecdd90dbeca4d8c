"""Registered frontier / link / page-content queries over ``pages``."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.operators import html as H
from lodestar.plans import sqlviews as V
from lodestar.plans.catalog import register
from lodestar.sources.tables import read_table


def _pages(spark, sf_dir):
    return read_table(spark, sf_dir, "pages", ["page_id", "url", "html"])


def _sq(s):
    return s.replace("'", "''")


HOST = f"lower(regexp_extract(url, '{_sq(H.HOST_RE)}', 1))"
_CATS = "[" + ", ".join(f"'{c}'" for c in H.GENERIC_CATEGORIES) + "]"
def _decoded_sql(x):
    x = f"regexp_replace({x}, '^[\"'']|[\"'']$', '', 'g')"
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&#x27;", "''"), ("&#38;", "&"), ("&amp;", "&")):
        x = f"replace({x}, '{entity}', '{char}')"
    return x


RAW_LINKS = f"""raw AS (SELECT page_id, url, {_decoded_sql('v')} AS href, position FROM (
  SELECT page_id, url, unnest(l) AS v, unnest(range(0, len(l))) AS position
  FROM (SELECT page_id, url, regexp_extract_all(regexp_replace(html, '{_sq(H.DEAD_RE)}', ' ', 'g'), '{_sq(H.HREF_RE)}', 1) AS l FROM pages)))"""


@register("h1_seed_urls", f"""
WITH prof AS (SELECT {HOST} AS source_site, min(regexp_extract(url, '^([A-Za-z]+)://', 1)) AS scheme FROM pages GROUP BY 1),
c AS (SELECT source_site, scheme || '://' || source_site AS base_url,
        unnest({_CATS}) AS category, unnest(range(0, len({_CATS}))) AS cat_pos FROM prof),
p AS (SELECT *, unnest(range(1, {H.GENERIC_INDEX_PAGES} + 1)) AS page_no FROM c)
SELECT source_site, cat_pos, page_no,
  CASE WHEN page_no = 1 THEN base_url || '/category/' || category || '/'
       ELSE base_url || '/category/' || category || '/page/' || CAST(page_no AS VARCHAR) || '/' END AS url FROM p""")
def h1_seed_urls(spark, sf_dir):
    return H.seed_urls(H.site_profiles(_pages(spark, sf_dir)))


@register("h2_extract_links", V.with_views(extra=[RAW_LINKS]) + "SELECT page_id, position, href FROM raw")
def h2_extract_links(spark, sf_dir):
    return H.extract_links(_pages(spark, sf_dir)).select("page_id", "position", "href")


def _resolved_sql():
    """Absolute urls of root-relative, absolute and other hrefs that the pages
    hold; percent-encoding keeps the characters a url may hold as they are."""
    enc = "url_encode(href)"
    for code, char in (("2F", "/"), ("2C", ","), ("3F", "?"), ("3D", "="), ("26", "&"), ("23", "#"), ("3A", ":"), ("21", "!"), ("40", "@"),
                       ("28", "("), ("29", ")"), ("27", "''"), ("2A", "*"), ("2B", "+"), ("3B", ";"), ("24", "$"), ("25", "%")):
        enc = f"replace({enc}, '%{code}', '{char}')"
    root = "lower(regexp_extract(url, '^[a-z]+://[^/?#]+'))"
    return (f"CASE WHEN starts_with(href, '/') THEN {root} || {enc} WHEN regexp_matches(href, '^https?://[^/?#]+$') THEN href || '/' "
            f"WHEN regexp_matches(href, '^https?://') THEN {enc} END")


@register("h3_resolve_url", V.with_views(extra=[RAW_LINKS]) + f"SELECT page_id, position, {_resolved_sql()} AS link FROM raw WHERE link IS NOT NULL")
def h3_resolve_url(spark, sf_dir):
    return H.resolve_url(H.extract_links(_pages(spark, sf_dir))).select("page_id", "position", "link")


def _drop_ref_sql(u):
    kept = (f"list_filter(string_split(regexp_extract(split_part({u}, '#', 1), '\\?(.*)$', 1), '&'), "
            "lambda x: split_part(x, '=', 1) <> 'ref' AND x <> '')")
    return (f"CASE WHEN NOT contains(split_part({u}, '#', 1), '?') THEN {u} ELSE split_part({u}, '?', 1) || "
            f"CASE WHEN len({kept}) > 0 THEN '?' || array_to_string({kept}, '&') ELSE '' END || regexp_extract({u}, '(#.*)$', 1) END")


@register("h4_canonical_url", """
SELECT page_id, """ + _drop_ref_sql("url") + """ AS drop_ref,
  regexp_replace(url, '\\?[^#]*', '', 'g') AS drop_query,
  CASE WHEN ends_with(url, '/') THEN url ELSE url || '/' END AS trailing_slash
FROM pages""")
def h4_canonical_url(spark, sf_dir):
    p = _pages(spark, sf_dir)
    return p.select("page_id", H.canonical_drop_ref("url").alias("drop_ref"),
                    H.canonical_drop_query("url").alias("drop_query"),
                    H.canonical_trailing_slash("url").alias("trailing_slash"))


_PATH = f"regexp_extract(href_abs, '{_sq(H.PATH_RE)}', 1)"
_EXCL = "[" + ", ".join(f"'{x}'" for x in H.EXCLUDED_PREFIXES) + "]"


@register("h5_h6_link_rules", V.with_views(extra=[RAW_LINKS,
    f"a AS (SELECT page_id, position, url, CASE WHEN starts_with(href, '/') THEN regexp_extract(url, '^([^/?#]*//[^/?#]*)', 1) || href ELSE href END AS href_abs FROM raw)",
    f"s AS (SELECT *, list_filter(string_split({_PATH}, '/'), lambda x: x <> '') AS segs FROM a)"]) + f"""
SELECT page_id, position,
  contains(lower(regexp_extract(href_abs, '{_sq(H.HOST_RE)}', 1)), {HOST}) AS same_site,
  regexp_matches(href_abs, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/[0-9]{{4}}/[0-9]{{2}}/[0-9]{{2}}/[^/?#]+/?$') AS date_path,
  regexp_matches(href_abs, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/[0-9]+/[^/?#]+/?$') AS numeric_path,
  coalesce(len(segs) = 1 AND len(list_filter({_EXCL}, lambda p: starts_with(lower(segs[1]), p))) = 0, false) AS single_segment
FROM s""")
def h5_h6_link_rules(spark, sf_dir):
    links = H.extract_links(_pages(spark, sf_dir))
    absu = F.when(F.col("href").startswith("/"),
                  F.concat(F.regexp_extract("url", r"^([^/?#]*//[^/?#]*)", 1), F.col("href"))).otherwise(F.col("href"))
    a = links.withColumn("href_abs", absu)
    return a.select("page_id", "position",
                    H.same_site("href_abs", H.host("url")).alias("same_site"),
                    H.detail_date_path("href_abs").alias("date_path"),
                    H.detail_numeric_path("href_abs").alias("numeric_path"),
                    F.coalesce(H.detail_single_segment("href_abs"), F.lit(False)).alias("single_segment"))


@register("h7_h8_first_capped_links", V.with_views(extra=[RAW_LINKS,
    "d AS (SELECT page_id, href AS link, min(position) AS position FROM raw GROUP BY 1, 2)"]) + f"""
SELECT page_id, link, position, count(*) OVER (PARTITION BY page_id) AS found FROM d
QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY position) <= {H.MAX_LINKS_PER_INDEX}""")
def h7_h8_first_capped_links(spark, sf_dir):
    links = H.extract_links(_pages(spark, sf_dir)).withColumnRenamed("href", "link")
    return H.cap_links(H.distinct_links(links)).select("page_id", "link", "position", "found")


def detail_sql():
    link_host = HOST.replace("url", "link")
    path = f"regexp_extract(link, '{_sq(H.PATH_RE)}', 1)"
    return [RAW_LINKS,
            f"resolved AS (SELECT page_id, url, position, {_resolved_sql()} AS l0 FROM raw)",
            f"can AS (SELECT page_id, url, position, {_drop_ref_sql('l0')} AS link FROM resolved WHERE l0 IS NOT NULL)",
            f"seg AS (SELECT *, list_filter(string_split({path}, '/'), lambda x: x <> '') AS segs FROM can WHERE contains({link_host}, {HOST}))",
            "det AS (SELECT page_id, link, min(position) AS position FROM seg WHERE len(segs) = 1 "
            f"AND len(list_filter({_EXCL}, lambda p: starts_with(lower(segs[1]), p))) = 0 GROUP BY 1, 2)"]


@register("h2_h8_detail_links", V.with_views(extra=detail_sql()) + f"""
SELECT page_id, link, position, count(*) OVER (PARTITION BY page_id) AS found FROM det
QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY position) <= {H.MAX_LINKS_PER_INDEX}""")
def h2_h8_detail_links(spark, sf_dir):
    return H.detail_links(_pages(spark, sf_dir)).select("page_id", "link", "position", "found")


_TEXT_OF = "trim(replace(replace(replace(replace(regexp_replace({x}, '<[^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&amp;', '&'))"
_CUT = r"(?is)<script[\s>].*?</script\s*>|<style[\s>].*?</style\s*>|<nav[\s>].*?</nav\s*>|<footer[\s>].*?</footer\s*>|<div class=\"ad\">.*?</div>"


CONTENT = f"regexp_replace(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '{_CUT}', '', 'g')"


@register("h9_page_title", f"""SELECT page_id, {_TEXT_OF.format(x="regexp_extract(html, '(?s)<article>.*?<h1>(.*?)</h1>', 1)")} AS title FROM pages""")
def h9_page_title(spark, sf_dir):
    return H.page_content(_pages(spark, sf_dir)).select("page_id", "title")


@register("h9_h11_page_content", f"""SELECT page_id, regexp_replace(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '{_CUT}', '', 'g') AS content
FROM pages""")
def h9_h11_page_content(spark, sf_dir):
    return H.page_content(_pages(spark, sf_dir)).select("page_id", "content")


WS = r"[\t\n\x0B\f\r\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF} ]"


@register("h12_min_text", f"""
SELECT page_id, length(regexp_replace(regexp_replace(html, '<[^>]*>', '', 'g'), '^{WS}+|{WS}+$', '', 'g')) AS text_chars
FROM pages WHERE length(regexp_replace(regexp_replace(html, '<[^>]*>', '', 'g'), '^{WS}+|{WS}+$', '', 'g')) >= 100""")
def h12_min_text(spark, sf_dir):
    p = _pages(spark, sf_dir)
    return H.min_text(p, "html").select("page_id", H.text_length("html").cast("bigint").alias("text_chars"))


@register("s1_scan_pages", f"""
WITH c AS (SELECT page_id, url, {_TEXT_OF.format(x="regexp_extract(html, '(?s)<article>.*?<h1>(.*?)</h1>', 1)")} AS title,
  regexp_replace(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '{_CUT}', '', 'g') AS content FROM pages)
SELECT page_id, url, title, length(content) AS content_chars FROM c
WHERE length(regexp_replace(regexp_replace(content, '<[^>]*>', '', 'g'), '^{WS}+|{WS}+$', '', 'g')) >= 100""")
def s1_scan_pages(spark, sf_dir):
    return H.scraped_pages(_pages(spark, sf_dir)).select("page_id", "url", "title",
                                                         F.length("content").cast("bigint").alias("content_chars"))


# pages whose content has enough text
KEPT_PAGES = f"""k AS (SELECT page_id FROM (SELECT page_id, regexp_replace(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '{_CUT}', '', 'g') AS content FROM pages)
  WHERE length(regexp_replace(regexp_replace(content, '<[^>]*>', '', 'g'), '^{WS}+|{WS}+$', '', 'g')) >= 100)"""


@register("h13_scrape_stats", V.with_views(extra=detail_sql() + [
    KEPT_PAGES,
    f"""p AS (SELECT {HOST} AS source_site, (SELECT count(*) FROM det WHERE det.page_id = pages.page_id) AS found,
      page_id IN (SELECT page_id FROM k) AS kept, html IS NULL OR html = '' AS empty FROM pages)"""]) + """
SELECT source_site, CAST(sum(found) AS BIGINT) AS found, count(*) FILTER (kept) AS scraped, count(*) FILTER (empty) AS errors,
  CASE WHEN errors > 0 AND scraped > 0 THEN 'partial' WHEN errors > 0 THEN 'failed' ELSE 'success' END AS status FROM p GROUP BY 1""")
def h13_scrape_stats(spark, sf_dir):
    return H.scrape_stats(_pages(spark, sf_dir))


@register("h2_selector_links", V.with_views(extra=[RAW_LINKS]) + "SELECT page_id, position, href FROM raw")
def h2_selector_links(spark, sf_dir):
    p = _pages(spark, sf_dir)
    return H.selector_links(p, H.site_profiles(p))
