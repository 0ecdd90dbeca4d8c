"""Registered queries for the scalar functions (F1–F18) and rendering (R1–R4),
each over the whole derived table."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.constants import DAILY_SUMMARY_MAX, MESSAGE_MAX, WEEKLY_SUMMARY_MAX
from lodestar.functions import format as fm
from lodestar.functions import text as tx
from lodestar.operators import picks, render
from lodestar.plans import sqlfmt as Q
from lodestar.plans import sqlviews as V
from lodestar.plans.catalog import register
from lodestar.sources import views


@register("f1_norm_hash", V.with_views("items") + f"""
SELECT doc_id, {V.norm_hash('title')} AS title_key, {V.norm_hash('source_url')} AS url_key FROM items""")
def f1_norm_hash(spark, sf_dir):
    return views.items(spark, sf_dir).select("doc_id", tx.norm_hash("title").alias("title_key"),
                                             tx.norm_hash("source_url").alias("url_key"))


@register("f2_norm_title", V.with_views("items") + f"""
SELECT doc_id, {V.norm_title('title')} AS norm_title FROM items""")
def f2_norm_title(spark, sf_dir):
    return views.items(spark, sf_dir).select("doc_id", tx.norm_title("title").alias("norm_title"))


@register("f3_item_hash", V.with_views("items") + f"""
SELECT doc_id, {V.item_hash('title', 'source_url')} AS hash FROM items""")
def f3_item_hash(spark, sf_dir):
    return views.items(spark, sf_dir).select("doc_id", tx.item_hash("title", "source_url").alias("hash"))


@register("f5_slug", V.with_views("opportunities") + "SELECT id, slug FROM opportunities")
def f5_slug(spark, sf_dir):
    return views.opportunities(spark, sf_dir).select("id", "slug")


@register("f6_completeness", V.with_views("items") + f"""
SELECT doc_id, CAST({V.completeness()} AS INTEGER) AS completeness_score FROM items""")
def f6_completeness(spark, sf_dir):
    return views.items(spark, sf_dir).select("doc_id", tx.completeness().alias("completeness_score"))


@register("f8_f9_escape_truncate", V.with_views("items") + f"""
SELECT doc_id, {Q.escape_html(Q.truncate('summary', DAILY_SUMMARY_MAX, '...'))} AS post_summary,
       {Q.escape_html(Q.truncate('description', WEEKLY_SUMMARY_MAX, '…'), True)} AS card_summary
FROM items""")
def f8_f9_escape_truncate(spark, sf_dir):
    return views.items(spark, sf_dir).select(
        "doc_id",
        fm.escape_html(fm.truncate("summary", DAILY_SUMMARY_MAX, "...")).alias("post_summary"),
        fm.escape_html(fm.truncate("description", WEEKLY_SUMMARY_MAX, "…"), True).alias("card_summary"))


@register("f10_f11_deadline", V.with_views("items") + f"""
SELECT doc_id, {Q.deadline_label()} AS short_label, {Q.deadline_label(long=True)} AS long_label,
       {Q.urgent()} AS urgent, {Q.deadline_colour()} AS colour FROM items""")
def f10_f11_deadline(spark, sf_dir):
    return views.items(spark, sf_dir).select(
        "doc_id", fm.deadline_label().alias("short_label"), fm.deadline_label(long=True).alias("long_label"),
        fm.urgent().alias("urgent"), fm.deadline_colour().alias("colour"))


@register("f12_f14_type_style", V.with_views("items") + f"""
SELECT doc_id, {Q.type_emoji()} AS post_emoji, {Q.type_emoji(card=True)} AS card_emoji,
       {Q.badge_colours()[0]} AS badge_bg, {Q.badge_colours()[1]} AS badge_fg,
       {Q.type_label()} AS type_label FROM items""")
def f12_f14_type_style(spark, sf_dir):
    bg, fg = fm.badge_colours()
    return views.items(spark, sf_dir).select(
        "doc_id", fm.type_emoji().alias("post_emoji"), fm.type_emoji(card=True).alias("card_emoji"),
        bg.alias("badge_bg"), fg.alias("badge_fg"), fm.type_label().alias("type_label"))


@register("f13_region_label", V.with_views("items") + f"""
SELECT doc_id, {Q.region_label()} AS region_label FROM items""")
def f13_region_label(spark, sf_dir):
    return views.items(spark, sf_dir).select("doc_id", fm.region_label().alias("region_label"))


@register("f15_f18_links", V.with_views("opportunities") + f"""
SELECT id, {Q.item_url()} AS url, {Q.summary_or_description()} AS blurb FROM opportunities""")
def f15_f18_links(spark, sf_dir):
    return views.opportunities(spark, sf_dir).select(
        "id", fm.item_url().alias("url"), fm.summary_or_description().alias("blurb"))


@register("f16_f17_labels", V.with_views() + f"""
SELECT doc_id, {Q.duration_label('n_chars * 997')} AS duration, {Q.clip_error('text')} AS error_text
FROM documents""")
def f16_f17_labels(spark, sf_dir):
    from lodestar.sources.tables import read_table
    d = read_table(spark, sf_dir, "documents", ["doc_id", "n_chars", "text"])
    return d.select("doc_id", fm.duration_label(F.col("n_chars") * 997).alias("duration"),
                    fm.clip_error("text").alias("error_text"))


def _post_sql(src: str = "opportunities", views_: tuple = ("opportunities",), pre: list | None = None,
              final: str | None = None):
    s = "s"
    lines = ", ".join([
        f"{Q.type_emoji()} || ' <b>' || {Q.escape_html('title')} || '</b>'",
        "''",
        f"CASE WHEN {Q.present('organization')} THEN '🏢 ' || {Q.escape_html('organization')} END",
        f"'📅 Deadline: ' || {Q.deadline_label()}",
        f"CASE WHEN len(regions) > 0 THEN '🌍 ' || {Q.region_label()} END",
        "CASE WHEN is_fully_funded THEN '✅ Fully Funded' END",
        f"CASE WHEN {s} <> '' THEN '' END",
        f"CASE WHEN {s} <> '' THEN {s} END",
        "''",
        f"'<a href=\"' || {Q.item_url()} || '\">View &amp; Apply →</a>'",
    ])
    keep = f"greatest(0, {MESSAGE_MAX} - ({Q.utf16_length('msg')} - {Q.utf16_length('s')}) - 3)"
    body = f"""CASE WHEN {Q.utf16_length('msg')} <= {MESSAGE_MAX} THEN msg
  ELSE array_to_string(list_transform(lines, lambda x: CASE WHEN x = s THEN substring(s, 1, {keep}) || '...' ELSE x END), chr(10))
  END"""
    return V.with_views(*views_, extra=list(pre or []) + [
        f"""b AS (SELECT *, CASE WHEN {Q.present('summary')} THEN {Q.escape_html(Q.truncate('summary', DAILY_SUMMARY_MAX, '...'))}
                  ELSE '' END AS s FROM {src})""",
        f"l AS (SELECT *, list_filter([{lines}], lambda x: x IS NOT NULL) AS lines FROM b)",
        "m AS (SELECT *, array_to_string(lines, chr(10)) AS msg FROM l)",
        f"bodies AS (SELECT *, {body} AS body FROM m)"]) + (final or "SELECT id, body FROM bodies")


@register("r1_post_body", _post_sql())
def r1_post_body(spark, sf_dir):
    return render.post_body(views.opportunities(spark, sf_dir)).select("id", "body")


@register("r2_post_header", V.with_views("opportunities", "distribution_log") + f"""
SELECT '📢 <b>' || CAST(count(*) AS VARCHAR) || ' New Opportunities</b>' || chr(10) || chr(10) ||
       'Here are the latest opportunities added to Listings:' AS header
FROM (SELECT id FROM opportunities o
      WHERE status = 'active' AND created_at >= {V.as_of()} - INTERVAL 48 HOUR
        AND (deadline IS NULL OR deadline >= CAST({V.as_of()} AS DATE))
        AND NOT EXISTS (SELECT 1 FROM distribution_log l WHERE l.channel = 'telegram' AND l.opportunity_id = o.id)
      ORDER BY completeness_score DESC, created_at DESC, id LIMIT 20)""")
def r2_post_header(spark, sf_dir):
    p = picks.daily_picks(views.opportunities(spark, sf_dir), views.distribution_log(spark, sf_dir))
    return p.agg(render.post_header(F.count(F.lit(1))).alias("header"))


def _card_sql(src: str = "opportunities"):  # noqa: C901
    bg, fg = Q.badge_colours()
    url = Q.item_url()
    raw = Q.summary_or_description()
    summ = f"CASE WHEN {Q.present(raw)} THEN {Q.escape_html(Q.truncate(raw, WEEKLY_SUMMARY_MAX, '…'), True)} ELSE '' END"
    joined = Q.escape_html("array_to_string(regions, ', ')", True)
    regions = f"CASE WHEN len(regions) > 0 THEN {joined} ELSE '' END"
    return f"""c0 AS (SELECT *, {summ} AS cs, {regions} AS cr FROM {src}),
c1 AS (SELECT *, list_filter([CASE WHEN cr <> '' THEN '🌍 ' || cr END,
         CASE WHEN is_fully_funded THEN '<span class="funded">✅ Fully Funded</span>' END], lambda x: x IS NOT NULL) AS meta FROM c0),
cards AS (SELECT *, array_to_string(list_filter([
  '<tr><td class="card">',
  '<span class="badge" style="background-color: ' || {bg} || '; color: ' || {fg} || ';">' || {Q.type_emoji(card=True)} || ' ' || {Q.type_label()} || '</span>',
  '<span class="deadline" style="color: ' || {Q.deadline_colour()} || ';">📅 ' || {Q.escape_html(Q.deadline_label(long=True), True)} || '</span>',
  '<h3><a href="' || {url} || '">' || {Q.escape_html('title', True)} || '</a></h3>',
  CASE WHEN {Q.present('organization')} THEN '<p class="org">🏢 ' || {Q.escape_html('organization', True)} || '</p>' END,
  CASE WHEN len(meta) > 0 THEN '<p class="meta">' || array_to_string(meta, ' &nbsp;·&nbsp; ') || '</p>' END,
  CASE WHEN cs <> '' THEN '<p class="summary">' || cs || '</p>' END,
  '<a class="apply" href="' || {url} || '">View &amp; Apply →</a>',
  '</td></tr>'], lambda x: x IS NOT NULL), chr(10)) AS card FROM c1)"""


@register("r3_card_html", V.with_views("opportunities", extra=[_card_sql()]) + "SELECT id, card FROM cards")
def r3_card_html(spark, sf_dir):
    return render.card_html(views.opportunities(spark, sf_dir)).select("id", "card")
