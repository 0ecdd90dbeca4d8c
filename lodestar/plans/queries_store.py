"""Registered store/log queries.  Upsert fixture: target = stored listings of
labelled documents; rows = every item, carrying its per-document url, so
labelled documents update and the rest insert."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.constants import TYPES
from lodestar.operators import picks, store
from lodestar.plans import sqlviews as V
from lodestar.plans.catalog import register
from lodestar.sources import views
from lodestar.sources.tables import read_table

UPSERT_OUT = ["id", "slug", "title", "status", "source_site", "completeness_score", "verification_level",
              "created_at", "updated_at"]


def _target(spark, sf_dir):
    lab = read_table(spark, sf_dir, "labels", ["doc_id"])
    return views.opportunities(spark, sf_dir).join(lab, "doc_id", "left_semi")


def _rows(spark, sf_dir):
    it = views.items(spark, sf_dir).withColumn(
        "source_url", F.concat(F.lit("https://www.example.org/"), F.col("lang"), F.lit("/"), F.col("doc_id").cast("string")))
    return store.to_row(it)


_URL = "'https://www.example.org/' || lang || '/' || CAST(doc_id AS VARCHAR)"
_ROWS = f"""rows_ AS (SELECT item_order, title, {V.slug('title', _URL)} AS slug, source_site, type,
  {_URL} AS source_url, CAST({V.completeness()} AS INTEGER) AS completeness_score FROM items)"""
_TARGET = "target AS (SELECT * FROM opportunities WHERE doc_id IN (SELECT doc_id FROM labels))"
_ERR = (f"CASE WHEN title IS NULL THEN 'null value in column \"title\"' "
        f"WHEN type IS NULL OR type NOT IN ({', '.join(repr(t) for t in TYPES)}) THEN 'check violation: type' "
        "WHEN source_url IS NULL THEN 'null value in column \"source_url\"' "
        "WHEN source_site IS NULL THEN 'null value in column \"source_site\"' END")


@register("s4_upsert_by_slug", V.with_views("opportunities", extra=[_ROWS, _TARGET,
    f"last_ AS (SELECT * FROM rows_ WHERE ({_ERR}) IS NULL QUALIFY row_number() OVER (PARTITION BY slug ORDER BY item_order DESC) = 1)"]) + f"""
SELECT CASE WHEN t.slug IS NULL THEN 'opp-' || substring(sha256(r.slug), 1, 24) ELSE t.id END AS id,
  coalesce(r.slug, t.slug) AS slug,
  CASE WHEN r.slug IS NOT NULL THEN r.title ELSE t.title END AS title,
  CASE WHEN r.slug IS NOT NULL THEN 'active' ELSE t.status END AS status,
  CASE WHEN r.slug IS NOT NULL THEN r.source_site ELSE t.source_site END AS source_site,
  CASE WHEN r.slug IS NOT NULL THEN r.completeness_score ELSE t.completeness_score END AS completeness_score,
  CASE WHEN t.slug IS NULL THEN 'basic' ELSE t.verification_level END AS verification_level,
  CASE WHEN t.slug IS NULL THEN {V.as_of()} ELSE t.created_at END AS created_at,
  CASE WHEN r.slug IS NOT NULL THEN {V.as_of()} ELSE t.updated_at END AS updated_at
FROM target t FULL OUTER JOIN last_ r ON t.slug = r.slug""")
def s4_upsert_by_slug(spark, sf_dir):
    return store.upsert(_target(spark, sf_dir), _rows(spark, sf_dir)).select(*UPSERT_OUT)


@register("j2_insert_or_update", V.with_views("opportunities", extra=[_ROWS, _TARGET]) + """
SELECT item_order, source_url IN (SELECT source_url FROM target) AS is_update FROM rows_""")
def j2_insert_or_update(spark, sf_dir):
    return store.classify(_rows(spark, sf_dir), _target(spark, sf_dir)).select("item_order", "is_update")


@register("a3_store_counts", V.with_views("opportunities", extra=[_ROWS, _TARGET,
    f"""c AS (SELECT source_url IN (SELECT source_url FROM target) AS is_update, {_ERR} AS error,
            slug IN (SELECT slug FROM target) AS has_slug FROM rows_)"""]) + """
SELECT count(*) FILTER (WHERE error IS NULL AND NOT is_update) AS inserted,
       count(*) FILTER (WHERE error IS NULL AND is_update) AS updated,
       count(*) FILTER (WHERE error IS NOT NULL) AS failed,
       count(*) FILTER (WHERE error IS NULL AND NOT has_slug) AS new_slugs,
       count(*) FILTER (WHERE error IS NULL AND has_slug) AS existing_slugs FROM c""")
def a3_store_counts(spark, sf_dir):
    return store.store_summary(_rows(spark, sf_dir), _target(spark, sf_dir))


# Every optional column is missing on rows of one language.
_GAPS = ["fields", "regions", "countries", "target_audience", "is_rolling", "is_fully_funded", "completeness_score", "status", "ai_processed"]
_GAP_SQL = {"completeness_score": "0", "status": "'active'", "is_rolling": "false", "is_fully_funded": "false", "ai_processed": "false"}
_GIVEN_SQL = {"status": "'active'", "ai_processed": "true", "completeness_score": f"CAST({V.completeness()} AS INTEGER)"}


@register("q4_fill_defaults", V.with_views("items") + f"""
SELECT 'opp-' || substring(sha256({V.slug('title', _URL)}), 1, 24) AS id, {V.slug('title', _URL)} AS slug, 'basic' AS verification_level,
       'low' AS scam_risk, {V.as_of()} AS created_at, """ + ", ".join(
    f"CASE WHEN lang = 'de' THEN {_GAP_SQL.get(c, 'CAST([] AS VARCHAR[])')} ELSE {_GIVEN_SQL.get(c, c)} END AS {c}" for c in _GAPS) + " FROM items")
def q4_fill_defaults(spark, sf_dir):
    langs = views.items(spark, sf_dir).select("item_order", "lang")
    rows = _rows(spark, sf_dir).join(langs, "item_order")
    gaps = rows.select(*[F.when(F.col("lang") != "de", F.col(c)).alias(c) if c in _GAPS else F.col(c) for c in rows.columns])
    return store.fill_defaults(gaps).select("id", "slug", "verification_level", "scam_risk", "created_at", *_GAPS)


@register("j8_delete_by_source", V.with_views("opportunities") + """
SELECT id FROM opportunities WHERE source_site <> 'src3' OR source_site IS NULL""")
def j8_delete_by_source(spark, sf_dir):
    return store.delete_by_source(views.opportunities(spark, sf_dir), "src3").select("id")


@register("s5_append_log", V.with_views("opportunities", "distribution_log", extra=[
    f"""new_ AS (SELECT id AS opportunity_id, 'telegram' AS channel, {V.as_of()} AS posted_at,
         CAST(completeness_score AS VARCHAR) AS external_id FROM opportunities
         WHERE status = 'active' AND created_at >= {V.as_of()} - INTERVAL 48 HOUR)""",
    """fresh AS (SELECT * FROM new_ n WHERE NOT EXISTS (SELECT 1 FROM distribution_log l
         WHERE l.opportunity_id = n.opportunity_id AND l.channel = n.channel))"""]) + """
SELECT id, opportunity_id, channel, posted_at, status, external_id FROM distribution_log
UNION ALL
SELECT 'log-' || substring(sha256(opportunity_id || '|' || channel), 1, 24), opportunity_id, channel,
       posted_at, 'sent', external_id FROM fresh""")
def s5_append_log(spark, sf_dir):
    o = views.opportunities(spark, sf_dir)
    new = (o.where(picks.is_active() & picks.within_lookback(48))
           .select(F.col("id").alias("opportunity_id"), F.lit("telegram").alias("channel"),
                   views.as_of_ts().alias("posted_at"), F.col("completeness_score").cast("string").alias("external_id")))
    return store.record_distribution(views.distribution_log(spark, sf_dir), new).select(
        "id", "opportunity_id", "channel", "posted_at", "status", "external_id")


@register("s6_append_flags", V.with_views("items") + f"""
SELECT 'flag-' || substring(sha256('low_completeness|' || source_url), 1, 24) AS id,
       'low_completeness' AS flag_reason,
       CASE WHEN summary IS NOT NULL AND summary <> '' THEN 'URL: ' || source_url || chr(10) || summary
            ELSE 'URL: ' || source_url END AS details,
       true AS auto_flagged, false AS reviewed
FROM items WHERE {V.completeness()} < 50""")
def s6_append_flags(spark, sf_dir):
    from lodestar.functions.text import completeness
    it = views.items(spark, sf_dir).where(completeness() < 50)
    return store.flag_rows(it, "low_completeness", details_col="summary").select(
        "id", "flag_reason", "details", "auto_flagged", "reviewed")


@register("f7_to_row", V.with_views("items") + f"""
SELECT item_order, title, {V.slug('title', 'source_url')} AS slug, source_url, source_site, 'active' AS status,
       true AS ai_processed, CAST({V.completeness()} AS INTEGER) AS completeness_score, {V.as_of()} AS updated_at
FROM items""")
def f7_to_row(spark, sf_dir):
    return store.to_row(views.items(spark, sf_dir)).select(
        "item_order", "title", "slug", "source_url", "source_site", "status", "ai_processed",
        "completeness_score", "updated_at")
