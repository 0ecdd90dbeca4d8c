"""Registered queries over the listing views (picks, predicates, log)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.operators import picks
from lodestar.plans import sqlviews as V
from lodestar.plans.catalog import register
from lodestar.sources import views

_PICK_SQL_COLS = "id, title, slug, type, completeness_score, created_at, deadline"
_OPEN = f"(deadline IS NULL OR deadline >= CAST({V.as_of()} AS DATE))"


@register("w1_daily_picks", V.with_views("opportunities", "distribution_log") + f"""
SELECT {_PICK_SQL_COLS} FROM opportunities o
WHERE status = 'active' AND created_at >= {V.as_of()} - INTERVAL 48 HOUR AND {_OPEN}
  AND NOT EXISTS (SELECT 1 FROM distribution_log l
                  WHERE l.channel = 'telegram' AND l.opportunity_id = o.id)
ORDER BY completeness_score DESC, created_at DESC, id LIMIT 20""")
def w1_daily_picks(spark, sf_dir):
    return picks.daily_picks(views.opportunities(spark, sf_dir), views.distribution_log(spark, sf_dir))


@register("w2_weekly_picks", V.with_views("opportunities") + f"""
SELECT {_PICK_SQL_COLS} FROM opportunities
WHERE status = 'active' AND created_at >= {V.as_of()} - INTERVAL 7 DAY AND {_OPEN}
ORDER BY completeness_score DESC, created_at DESC, id LIMIT 15""")
def w2_weekly_picks(spark, sf_dir):
    return picks.weekly_picks(views.opportunities(spark, sf_dir))


@register("p1_p3_candidates", V.with_views("opportunities") + f"""
SELECT id, completeness_score, created_at FROM opportunities
WHERE status = 'active' AND created_at >= {V.as_of()} - INTERVAL 48 HOUR AND {_OPEN}""")
def p1_p3_candidates(spark, sf_dir):
    return picks.candidates(views.opportunities(spark, sf_dir), 48).select("id", "completeness_score", "created_at")


@register("s3_scan_log_channel", V.with_views("distribution_log") + """
SELECT DISTINCT opportunity_id AS id FROM distribution_log
WHERE channel = 'telegram' AND opportunity_id IS NOT NULL""")
def s3_scan_log_channel(spark, sf_dir):
    return picks.posted_ids(views.distribution_log(spark, sf_dir), "telegram")


@register("j1_unposted", V.with_views("opportunities", "distribution_log") + """
SELECT id, status FROM opportunities o
WHERE NOT EXISTS (SELECT 1 FROM distribution_log l
                  WHERE l.channel = 'telegram' AND l.opportunity_id = o.id)""")
def j1_unposted(spark, sf_dir):
    return picks.unposted(views.opportunities(spark, sf_dir).select("id", "status"),
                          views.distribution_log(spark, sf_dir), "telegram")


@register("w3_limit_per_source", V.with_views() + """
SELECT page_id, source_site FROM (
  SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS source_site,
         row_number() OVER (PARTITION BY regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) ORDER BY page_id) AS rn
  FROM pages) WHERE rn <= 3""")
def w3_limit_per_source(spark, sf_dir):
    from lodestar.sources.tables import read_table
    p = read_table(spark, sf_dir, "pages", ["page_id", "url"]).select(
        "page_id", F.regexp_extract("url", r"^[a-z]+://([^/?#]+)", 1).alias("source_site"))
    return picks.limit_per_group(p, "source_site", [F.col("page_id")], 3)


@register("w4_page_slice", V.with_views("opportunities") + """
SELECT id, completeness_score FROM opportunities WHERE status = 'active'
ORDER BY completeness_score DESC, created_at DESC, id LIMIT 20 OFFSET 20""")
def w4_page_slice(spark, sf_dir):
    o = views.opportunities(spark, sf_dir).where(picks.is_active())
    return picks.page_slice(o, picks.rank_order(), page=2).select("id", "completeness_score")


@register("w4_cursor_pages", V.with_views("opportunities") + """
SELECT id, completeness_score, CAST((row_number() OVER (ORDER BY completeness_score DESC, created_at DESC, id) - 1) // 20 + 1 AS INTEGER) AS page
FROM opportunities WHERE status = 'active' QUALIFY page <= 3""")
def w4_cursor_pages(spark, sf_dir):
    o = views.opportunities(spark, sf_dir).where(picks.is_active())
    end, pages = None, []
    for number in (1, 2, 3):
        page = picks.next_page(o, end)
        pages.append(page.select("id", "completeness_score", F.lit(number).alias("page")))
        end = picks.cursor(page)
        if end is None:
            break
    out = pages[0]
    for p in pages[1:]:
        out = out.unionByName(p)
    return out
