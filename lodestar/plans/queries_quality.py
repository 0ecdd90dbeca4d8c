"""Registered data-quality, search, visibility and referential queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lodestar.constants import (EDUCATION_LEVELS, LOG_STATUSES, RUN_STATUSES, SCAM_RISK_LEVELS, STATUSES,
                                TYPES, VERIFICATION_LEVELS)
from lodestar.functions.stem import stem_ctes
from lodestar.operators import html as H
from lodestar.operators import quality as qa
from lodestar.operators import search
from lodestar.plans import sqlviews as V
from lodestar.plans.catalog import register
from lodestar.session import checkpoint_dir
from lodestar.sources import views
from lodestar.sources.tables import read_table


def _in(values):
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _viol(table, key, src, rule, cond):
    return f"SELECT '{table}' AS table_name, '{rule}' AS rule, CAST({key} AS VARCHAR) AS row_key FROM {src} WHERE NOT coalesce({cond}, true)"


@register("q1_check_rules", V.with_views("opportunities", "user_profiles", "distribution_log", "scrape_runs") + " UNION ALL ".join([
    _viol("opportunities", "id", "opportunities", "type", f"type IN {_in(TYPES)}"),
    _viol("opportunities", "id", "opportunities", "status", f"status IN {_in(STATUSES)}"),
    _viol("opportunities", "id", "opportunities", "verification_level", f"verification_level IN {_in(VERIFICATION_LEVELS)}"),
    _viol("opportunities", "id", "opportunities", "scam_risk", f"scam_risk IN {_in(SCAM_RISK_LEVELS)}"),
    _viol("opportunities", "id", "opportunities", "completeness_score", "completeness_score BETWEEN 0 AND 100"),
    _viol("user_profiles", "id", "user_profiles", "education_level", f"education_level IN {_in(EDUCATION_LEVELS)}"),
    _viol("distribution_log", "id", "distribution_log", "status", f"status IN {_in(LOG_STATUSES)}"),
    _viol("scrape_runs", "id", "scrape_runs", "status", f"status IN {_in(RUN_STATUSES)}"),
]))
def q1_check_rules(spark, sf_dir):
    return qa.check_rules(views.opportunities(spark, sf_dir), views.user_profiles(spark, sf_dir),
                          views.distribution_log(spark, sf_dir), views.scrape_runs(spark, sf_dir))


@register("q2_missing_values", V.with_views("items") + " UNION ALL ".join(
    _viol("items", "doc_id", "items", f"{c} not null", f"{c} IS NOT NULL") for c in ("organization", "application_url", "funding_amount", "deadline")))
def q2_missing_values(spark, sf_dir):
    """The NOT NULL check over extracted items, whose optional columns have gaps."""
    return qa.required(views.items(spark, sf_dir), "items", "doc_id", ["organization", "application_url", "funding_amount", "deadline"])


@register("q2_not_null_rules", V.with_views("opportunities", "distribution_log", "flagged_listings", "scrape_runs") + " UNION ALL ".join(
    [_viol("opportunities", "id", "opportunities", f"{c} not null", f"{c} IS NOT NULL")
     for c in ["title", "slug", "type", "source_url", "source_site"]]
    + [_viol("distribution_log", "id", "distribution_log", "channel not null", "channel IS NOT NULL"),
       _viol("flagged_listings", "id", "flagged_listings", "flag_reason not null", "flag_reason IS NOT NULL"),
       _viol("scrape_runs", "id", "scrape_runs", "source_site not null", "source_site IS NOT NULL")]))
def q2_not_null_rules(spark, sf_dir):
    return qa.not_null_rules(views.opportunities(spark, sf_dir), views.distribution_log(spark, sf_dir),
                             views.flagged_listings(spark, sf_dir), views.scrape_runs(spark, sf_dir))


def _dup(table, rule, src, cols):
    key = " || '|' || ".join(f"CAST({c} AS VARCHAR)" for c in cols)
    return (f"SELECT '{table}' AS table_name, '{rule}' AS rule, {key} AS row_key, count(*) AS n "
            f"FROM {src} GROUP BY {', '.join(cols)} HAVING count(*) > 1")


@register("q3_unique_rules", V.with_views("opportunities", "saved_opportunities", "distribution_log") + " UNION ALL ".join([
    _dup("opportunities", "id unique", "opportunities", ["id"]),
    _dup("opportunities", "slug unique", "opportunities", ["slug"]),
    _dup("saved_opportunities", "primary key", "saved_opportunities", ["user_id", "opportunity_id"]),
    _dup("distribution_log", "id unique", "distribution_log", ["id"])]))
def q3_unique_rules(spark, sf_dir):
    return qa.unique_rules(views.opportunities(spark, sf_dir), views.saved_opportunities(spark, sf_dir),
                           views.distribution_log(spark, sf_dir))


_STOP = "(" + ", ".join(f"'{w}'" for w in qa.STOP_WORDS) + ")"
_POSTINGS = f"""p0 AS (
  SELECT id, unnest(string_split_regex(lower(coalesce(title, '')), '[^\\p{{L}}\\p{{N}}]+')) AS term, 'A' AS weight FROM opportunities
  UNION ALL SELECT id, unnest(string_split_regex(lower(coalesce(description, '')), '[^\\p{{L}}\\p{{N}}]+')), 'B' FROM opportunities
  UNION ALL SELECT id, unnest(string_split_regex(lower(coalesce(organization, '')), '[^\\p{{L}}\\p{{N}}]+')), 'C' FROM opportunities),
postings AS (SELECT id, term, min(weight) AS weight, count(*) AS tf FROM p0
  WHERE term <> '' AND term NOT IN {_STOP} GROUP BY id, term)"""


@register("q5_weighted_postings", V.with_views("opportunities", extra=[_POSTINGS]) + "SELECT id, term, weight, tf FROM postings")
def q5_weighted_postings(spark, sf_dir):
    return qa.weighted_postings(views.opportunities(spark, sf_dir))


SEARCH = "src1 ing"


@register("q6_text_search", V.with_views("opportunities", extra=[_POSTINGS]) + """
SELECT id FROM postings WHERE term IN ('src1', 'ing') GROUP BY id HAVING count(DISTINCT term) = 2""")
def q6_text_search(spark, sf_dir):
    return qa.text_search(views.opportunities(spark, sf_dir), SEARCH)


_STEMMED = [_POSTINGS, stem_ctes("postings", "term"),
            "stemmed AS (SELECT id, stem AS term, min(weight) AS weight, CAST(sum(tf) AS BIGINT) AS tf "
            "FROM postings p JOIN stems s ON p.term = s.word GROUP BY id, stem)"]


@register("q5_stemmed_postings", V.with_views("opportunities", extra=_STEMMED) + "SELECT id, term, weight, tf FROM stemmed")
def q5_stemmed_postings(spark, sf_dir):
    return search.stemmed_postings(views.opportunities(spark, sf_dir))


@register("q6_index_search", V.with_views("opportunities", extra=_STEMMED) + """
SELECT id FROM stemmed WHERE term IN ('licens', 'version') GROUP BY id HAVING count(*) = 2""")
def q6_index_search(spark, sf_dir):
    """Index all listings below the checkpoint folder, then search the index."""
    path = f"{checkpoint_dir(spark)}/lodestar-index/{uuid.uuid4().hex}"
    search.add_to_index(views.opportunities(spark, sf_dir), path)
    return search.search_index(spark, path, "the licensing of versions")


@register("q7_review_queue", V.with_views("flagged_listings") + "SELECT id, flag_reason FROM flagged_listings WHERE NOT reviewed")
def q7_review_queue(spark, sf_dir):
    return qa.review_queue(views.flagged_listings(spark, sf_dir)).select("id", "flag_reason")


@register("p4_browse_filters", V.with_views("opportunities") + """
SELECT id, title FROM opportunities WHERE type = 'grant' AND list_contains(regions, 'europe')
  AND is_fully_funded = false AND deadline <= DATE '2024-03-15'""")
def p4_browse_filters(spark, sf_dir):
    return qa.browse_filters(views.opportunities(spark, sf_dir), type="grant", region="europe",
                             is_fully_funded=False, deadline_before="2024-03-15").select("id", "title")


_HOST = "lower(regexp_extract(url, '" + H.HOST_RE.replace("'", "''") + "', 1))"


def _requested(spark, sf_dir):
    """Requested names (document sources and page hosts) and the site profiles."""
    pages = read_table(spark, sf_dir, "pages", ["page_id", "url", "html"])
    names = views.items(spark, sf_dir).select("source_site").union(pages.select(H.host("url"))).distinct()
    return names, H.site_profiles(pages)


@register("p5_known_sources", V.with_views("items") + f"""
SELECT source_site FROM (SELECT DISTINCT source_site FROM items UNION SELECT DISTINCT {_HOST} FROM pages)
WHERE source_site IN (SELECT {_HOST} FROM pages)""")
def p5_known_sources(spark, sf_dir):
    return qa.known_sources(*_requested(spark, sf_dir))


@register("p6_visible_rows", V.with_views("opportunities", "saved_opportunities", "user_profiles", "distribution_log") + """
SELECT 'opportunities' AS table_name, id AS row_key FROM opportunities WHERE status = 'active'
UNION ALL SELECT 'saved_opportunities', user_id || '|' || opportunity_id FROM saved_opportunities WHERE user_id = 'user-5'
UNION ALL SELECT 'user_profiles', id FROM user_profiles WHERE id = 'user-5'""")
def p6_visible_rows(spark, sf_dir):
    o = qa.visible_rows(views.opportunities(spark, sf_dir), "opportunities", "user", "user-5")
    s = qa.visible_rows(views.saved_opportunities(spark, sf_dir), "saved_opportunities", "user", "user-5")
    u = qa.visible_rows(views.user_profiles(spark, sf_dir), "user_profiles", "user", "user-5")
    lg = qa.visible_rows(views.distribution_log(spark, sf_dir), "distribution_log", "user", "user-5")
    return (o.select(F.lit("opportunities").alias("table_name"), F.col("id").alias("row_key"))
            .unionByName(s.select(F.lit("saved_opportunities").alias("table_name"),
                                  F.concat_ws("|", "user_id", "opportunity_id").alias("row_key")))
            .unionByName(u.select(F.lit("user_profiles").alias("table_name"), F.col("id").alias("row_key")))
            .unionByName(lg.select(F.lit("distribution_log").alias("table_name"), F.col("id").alias("row_key"))))


@register("j6_orphans", V.with_views("opportunities", "saved_opportunities", "distribution_log", "flagged_listings") + """
SELECT 'saved_opportunities' AS table_name, user_id || '|' || opportunity_id AS row_key FROM saved_opportunities s
  WHERE opportunity_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM opportunities o WHERE o.id = s.opportunity_id)
UNION ALL SELECT 'distribution_log', id FROM distribution_log l
  WHERE opportunity_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM opportunities o WHERE o.id = l.opportunity_id)
UNION ALL SELECT 'flagged_listings', id FROM flagged_listings f
  WHERE opportunity_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM opportunities o WHERE o.id = f.opportunity_id)""")
def j6_orphans(spark, sf_dir):
    o = views.opportunities(spark, sf_dir).select("id")
    s = qa.orphans(views.saved_opportunities(spark, sf_dir), o, "opportunity_id")
    lg = qa.orphans(views.distribution_log(spark, sf_dir), o, "opportunity_id")
    fl = qa.orphans(views.flagged_listings(spark, sf_dir), o, "opportunity_id")
    return (s.select(F.lit("saved_opportunities").alias("table_name"), F.concat_ws("|", "user_id", "opportunity_id").alias("row_key"))
            .unionByName(lg.select(F.lit("distribution_log").alias("table_name"), F.col("id").alias("row_key")))
            .unionByName(fl.select(F.lit("flagged_listings").alias("table_name"), F.col("id").alias("row_key"))))


@register("j7_cascade_delete", V.with_views("opportunities", "saved_opportunities", "distribution_log", "flagged_listings",
                                             extra=["del AS (SELECT id FROM opportunities WHERE status = 'removed')"]) + """
SELECT 'saved_opportunities' AS table_name, user_id || '|' || opportunity_id AS row_key, opportunity_id FROM saved_opportunities
  WHERE opportunity_id NOT IN (SELECT id FROM del)
UNION ALL SELECT 'flagged_listings', id, opportunity_id FROM flagged_listings WHERE opportunity_id NOT IN (SELECT id FROM del)
UNION ALL SELECT 'distribution_log', id, CASE WHEN opportunity_id IN (SELECT id FROM del) THEN NULL ELSE opportunity_id END
  FROM distribution_log""")
def j7_cascade_delete(spark, sf_dir):
    deleted = views.opportunities(spark, sf_dir).where(F.col("status") == "removed").select("id")
    s, fl, lg = qa.cascade_delete_opportunities(deleted, views.saved_opportunities(spark, sf_dir),
                                                views.flagged_listings(spark, sf_dir), views.distribution_log(spark, sf_dir))
    return (s.select(F.lit("saved_opportunities").alias("table_name"),
                     F.concat_ws("|", "user_id", "opportunity_id").alias("row_key"), "opportunity_id")
            .unionByName(fl.select(F.lit("flagged_listings").alias("table_name"), F.col("id").alias("row_key"), "opportunity_id"))
            .unionByName(lg.select(F.lit("distribution_log").alias("table_name"), F.col("id").alias("row_key"), "opportunity_id")))


@register("s7_scrape_runs", V.with_views("scrape_runs") + """
SELECT id, source_site, started_at, completed_at, status, listings_found, listings_new, duration_seconds FROM scrape_runs""")
def s7_scrape_runs(spark, sf_dir):
    return views.scrape_runs(spark, sf_dir).select("id", "source_site", "started_at", "completed_at", "status",
                                                   "listings_found", "listings_new", "duration_seconds")


@register("j7_cascade_delete_users", V.with_views("user_profiles", "saved_opportunities",
                                                   extra=["gone AS (SELECT id FROM user_profiles WHERE education_level = 'unknown')"]) + """
SELECT 'user_profiles' AS table_name, id AS row_key FROM user_profiles WHERE id NOT IN (SELECT id FROM gone)
UNION ALL SELECT 'saved_opportunities', user_id || '|' || opportunity_id FROM saved_opportunities
  WHERE user_id NOT IN (SELECT id FROM gone)""")
def j7_cascade_delete_users(spark, sf_dir):
    prof = views.user_profiles(spark, sf_dir)
    gone = prof.where(F.col("education_level") == "unknown").select("id")
    p2, s2 = qa.cascade_delete_users(gone, prof, views.saved_opportunities(spark, sf_dir))
    return (p2.select(F.lit("user_profiles").alias("table_name"), F.col("id").alias("row_key"))
            .unionByName(s2.select(F.lit("saved_opportunities").alias("table_name"),
                                   F.concat_ws("|", "user_id", "opportunity_id").alias("row_key"))))


@register("p5_unknown_sources", V.with_views("items") + f"""
SELECT source_site FROM (SELECT DISTINCT source_site FROM items UNION SELECT DISTINCT {_HOST} FROM pages)
WHERE source_site NOT IN (SELECT {_HOST} FROM pages)""")
def p5_unknown_sources(spark, sf_dir):
    return qa.unknown_sources(*_requested(spark, sf_dir))