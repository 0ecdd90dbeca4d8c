"""One registered query per inventory ID that otherwise only appears inside
a combined query (the combined queries stay registered)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.functions import format as fm
from lodestar.operators import extract as X
from lodestar.operators import html as H
from lodestar.operators import picks
from lodestar.plans import sqlfmt as Q
from lodestar.plans import queries_html as W
from lodestar.plans import sqlviews as V
from lodestar.plans.catalog import register
from lodestar.plans.queries_html import _EXCL, _PATH, RAW_LINKS
from lodestar.sources import views
from lodestar.sources.tables import read_table


@register("p2_within_lookback", V.with_views("opportunities") + f"""
SELECT id, created_at FROM opportunities WHERE created_at >= {V.as_of()} - INTERVAL 48 HOUR""")
def p2_within_lookback(spark, sf_dir):
    return views.opportunities(spark, sf_dir).where(picks.within_lookback(48)).select("id", "created_at")


@register("p3_open_deadline", V.with_views("opportunities") + f"""
SELECT id, deadline FROM opportunities WHERE deadline IS NULL OR deadline >= CAST({V.as_of()} AS DATE)""")
def p3_open_deadline(spark, sf_dir):
    return views.opportunities(spark, sf_dir).where(picks.open_deadline()).select("id", "deadline")


@register("f9_truncate", V.with_views("items") + f"""
SELECT doc_id, {Q.truncate('summary', 200, '...')} AS post_cut, {Q.truncate('description', 150, '…')} AS card_cut FROM items""")
def f9_truncate(spark, sf_dir):
    return views.items(spark, sf_dir).select("doc_id", fm.truncate("summary", 200, "...").alias("post_cut"),
                                             fm.truncate("description", 150, "…").alias("card_cut"))


@register("f11_urgent", V.with_views("items") + f"SELECT doc_id, {Q.urgent()} AS urgent FROM items")
def f11_urgent(spark, sf_dir):
    return views.items(spark, sf_dir).select("doc_id", fm.urgent().alias("urgent"))


@register("f14_type_label", V.with_views("items") + f"SELECT doc_id, {Q.type_label()} AS type_label FROM items")
def f14_type_label(spark, sf_dir):
    return views.items(spark, sf_dir).select("doc_id", fm.type_label().alias("type_label"))


@register("f17_clip_error", f"SELECT doc_id, {Q.clip_error('text')} AS error_text FROM documents")
def f17_clip_error(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return d.select("doc_id", fm.clip_error("text").alias("error_text"))


@register("f18_summary_or_description", V.with_views("opportunities") + f"""
SELECT id, {Q.summary_or_description()} AS blurb FROM opportunities""")
def f18_summary_or_description(spark, sf_dir):
    return views.opportunities(spark, sf_dir).select("id", fm.summary_or_description().alias("blurb"))


@register("h6_detail_pattern", V.with_views(extra=[RAW_LINKS,
    "a AS (SELECT page_id, position, CASE WHEN starts_with(href, '/') THEN regexp_extract(url, '^([^/?#]*//[^/?#]*)', 1) || href ELSE href END AS href_abs FROM raw)",
    f"s AS (SELECT *, list_filter(string_split({_PATH}, '/'), lambda x: x <> '') AS segs FROM a)"]) + f"""
SELECT page_id, position FROM s WHERE coalesce(len(segs) = 1 AND len(list_filter({_EXCL}, lambda p: starts_with(lower(segs[1]), p))) = 0, false)""")
def h6_detail_pattern(spark, sf_dir):
    links = H.extract_links(read_table(spark, sf_dir, "pages", ["page_id", "url", "html"]))
    absu = F.when(F.col("href").startswith("/"),
                  F.concat(F.regexp_extract("url", r"^([^/?#]*//[^/?#]*)", 1), F.col("href"))).otherwise(F.col("href"))
    return links.withColumn("href_abs", absu).where(F.coalesce(H.detail_single_segment("href_abs"), F.lit(False))) \
                .select("page_id", "position")


@register("h8_cap_links", V.with_views(extra=[RAW_LINKS]) + """
SELECT page_id, position, count(*) OVER (PARTITION BY page_id) AS found FROM raw
QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY position) <= 50""")
def h8_cap_links(spark, sf_dir):
    links = H.extract_links(read_table(spark, sf_dir, "pages", ["page_id", "url", "html"]))
    return H.cap_links(links).select("page_id", "position", "found")


@register("h10_main_content", f"SELECT page_id, length({W.CONTENT}) AS content_chars FROM pages")
def h10_main_content(spark, sf_dir):
    c = H.page_content(read_table(spark, sf_dir, "pages", ["page_id", "url", "html"]))
    return c.select("page_id", F.length("content").cast("bigint").alias("content_chars"))


@register("h11_strip_boilerplate", f"SELECT page_id, md5({W.CONTENT}) AS content_md5, false AS boilerplate_left FROM pages")
def h11_strip_boilerplate(spark, sf_dir):
    """Content with no script/style/nav/form/ad element left inside."""
    c = H.page_content(read_table(spark, sf_dir, "pages", ["page_id", "url", "html"]))
    left = F.col("content").rlike(r"(?i)<(script|style|iframe|nav|form)[\s>]|class=\"(ad|advertisement)\"")
    return c.select("page_id", F.md5(F.col("content").cast("binary")).alias("content_md5"), F.coalesce(left, F.lit(False)).alias("boilerplate_left"))
