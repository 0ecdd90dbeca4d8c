"""Registered composite jobs and run reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.operators import render
from lodestar.plans import jobs
from lodestar.plans import queries_dedup as D_
from lodestar.plans import queries_extract as X_
from lodestar.plans import queries_html as W
from lodestar.plans import sqlfmt as Q
from lodestar.plans import sqlviews as V
from lodestar.plans.catalog import register
from lodestar.sources import views


_TRIM = "regexp_replace(title, '^" + W.WS + "+|" + W.WS + "+$', '', 'g')"
# The ingest in SQL: kept pages, valid answers, the batch in the order of
# (source, page), the pool in the order of (created_at, id), their classes.
_INGEST = [
    W.KEPT_PAGES, X_.ISSUES,
    f"""kp AS (SELECT page_id, url, {W.HOST} AS source_site FROM pages WHERE page_id IN (SELECT page_id FROM k))""",
    f"""ok AS (SELECT kp.page_id, kp.url, kp.source_site, {_TRIM} AS title, row_number() OVER (ORDER BY kp.source_site, kp.page_id) AS item_order
      FROM kp JOIN r USING (page_id) WHERE len(issues) = 0)""",
    "batch_items AS (SELECT item_order, title, url AS source_url FROM ok)",
    "stored_items AS (SELECT row_number() OVER (ORDER BY created_at, id) AS doc_id, title, source_url, status FROM opportunities)",
    *D_.CLASSES,
    f"""un AS (SELECT ok.*, {V.slug('ok.title', 'ok.url')} AS slug FROM ok JOIN res ON res.item_order = ok.item_order WHERE res.is_unique)""",
    f"""a4 AS (SELECT s.source, (SELECT count(*) FROM kp WHERE source_site = s.source) AS scraped, (SELECT count(*) FROM ok WHERE source_site = s.source) AS extracted,
      (SELECT count(*) FROM un WHERE source_site = s.source) AS "unique",
      (SELECT count(*) FROM un WHERE source_site = s.source AND url NOT IN (SELECT source_url FROM opportunities)) AS inserted,
      (SELECT count(*) FROM un WHERE source_site = s.source AND url IN (SELECT source_url FROM opportunities)) AS updated
      FROM (SELECT DISTINCT {W.HOST} AS source FROM pages) s)""",
    """results AS (SELECT *, scraped - extracted AS extraction_failures, CAST(CASE WHEN scraped = 0 THEN 1 ELSE 0 END AS BIGINT) AS failed,
      CAST(CASE WHEN scraped = 0 OR extracted = 0 THEN 1 ELSE 0 END AS BIGINT) AS n_errors,
      CASE WHEN scraped = 0 THEN 'failed' WHEN extracted = 0 THEN 'partial' ELSE 'success' END AS status FROM a4)"""]


def _ingest_sql(last):
    return V.with_views("opportunities", extra=_INGEST).replace("WITH ", "WITH RECURSIVE ", 1) + last


@register("c2_ingest", _ingest_sql("""
SELECT CASE WHEN t.slug IS NULL THEN 'opp-' || substring(sha256(n.slug), 1, 24) ELSE t.id END AS id, coalesce(n.slug, t.slug) AS slug,
  coalesce(n.title, t.title) AS title, CASE WHEN n.slug IS NULL THEN t.status ELSE 'active' END AS status,
  coalesce(n.source_site, t.source_site) AS source_site
FROM opportunities t FULL OUTER JOIN (SELECT * FROM un QUALIFY row_number() OVER (PARTITION BY slug ORDER BY item_order DESC) = 1) n ON t.slug = n.slug"""))
def c2_ingest(spark, sf_dir):
    return jobs.ingest(spark, sf_dir)["upserted"].select("id", "slug", "title", "status", "source_site")


@register("a4_source_result", _ingest_sql("SELECT * FROM results"))
def a4_source_result(spark, sf_dir):
    return jobs.ingest(spark, sf_dir)["results"]


@register("a5_run_totals", _ingest_sql("""SELECT CAST(sum(inserted) AS BIGINT) AS total_inserted, CAST(sum(updated) AS BIGINT) AS total_updated,
  CAST(sum(n_errors) AS BIGINT) AS total_errors FROM results"""))
def a5_run_totals(spark, sf_dir):
    return jobs.run_totals(jobs.ingest(spark, sf_dir)["results"])


@register("a6_run_health", _ingest_sql("""SELECT bool_and(status = 'failed') AS all_failed, bool_or(status IN ('failed', 'partial')) AS any_issue,
  bool_and(status = 'success') AS all_success, CASE WHEN bool_and(status = 'success') THEN 0 ELSE 1 END AS exit_code FROM results"""))
def a6_run_health(spark, sf_dir):
    return jobs.run_health(jobs.ingest(spark, sf_dir)["results"])


@register("s9_dry_run", _ingest_sql("SELECT source, CAST(0 AS BIGINT) AS inserted, CAST(0 AS BIGINT) AS updated, failed FROM results"))
def s9_dry_run(spark, sf_dir):
    return jobs.ingest(spark, sf_dir, dry_run=True)["results"].select("source", "inserted", "updated", "failed")


_CLOCK = """sites AS (SELECT """ + W.HOST + """ AS source_site, min(page_id) AS n FROM pages GROUP BY 1),
clock AS (SELECT source_site, min(ts) AS started_at, max(ts) AS completed_at, min(CASE WHEN event_type = 'error' THEN event_id END) AS err
  FROM sites JOIN events ON user_id = n GROUP BY 1)"""


@register("r5_run_summary", _ingest_sql("").rstrip() + ", " + _CLOCK + f""",
ms AS (SELECT 1000 * (CAST(floor(epoch(max(completed_at))) AS BIGINT) - CAST(floor(epoch(min(started_at))) AS BIGINT)) AS ms FROM clock)
SELECT 0 AS seq, CAST(NULL AS VARCHAR) AS source,
  CASE WHEN bool_and(status = 'failed') THEN '❌ <b>Listings Pipeline Failed</b>' WHEN bool_or(status IN ('failed', 'partial'))
    THEN '⚠️ <b>Listings Pipeline Complete (with issues)</b>' ELSE '✅ <b>Listings Pipeline Complete</b>' END || chr(10) || chr(10) ||
  'Scrapers: ' || CAST(count(*) AS VARCHAR) || ' run' || chr(10) || 'Inserted: ' || CAST(sum(inserted) AS VARCHAR) || ' | Updated: ' ||
  CAST(sum(updated) AS VARCHAR) || ' | Errors: ' || CAST(sum(n_errors) AS VARCHAR) || chr(10) || 'Duration: ' ||
  (SELECT {Q.duration_label('ms')} FROM ms) || chr(10) || chr(10) || '<b>Per scraper:</b>' AS line FROM results
UNION ALL SELECT 1, source, '• ' || source || ': ' || CAST(scraped AS VARCHAR) || ' scraped → ' || CAST(extracted AS VARCHAR) || ' extracted → ' ||
  CAST(inserted + updated AS VARCHAR) || ' stored' FROM results""")
def r5_run_summary(spark, sf_dir):
    clock = views.fetch_clock(spark, sf_dir)
    res = jobs.ingest(spark, sf_dir, started=clock)["results"]
    ms = clock.agg((F.unix_timestamp(F.max("completed_at").cast("timestamp")) - F.unix_timestamp(F.min("started_at").cast("timestamp"))).alias("s")).first()
    return render.run_summary(res, F.lit((ms["s"] or 0) * 1000))


@register("r6_failure_alert", V.with_views("scrape_runs") + """
SELECT id, '❌ <b>Scraper Failed: ' || source_site || '</b>' || chr(10) || chr(10) || 'Error: run ended ' || status || ' after ' ||
  CAST(duration_seconds AS VARCHAR) || ' s' AS message FROM scrape_runs WHERE status IN ('failed', 'partial')""")
def r6_failure_alert(spark, sf_dir):
    runs = views.scrape_runs(spark, sf_dir).where(F.col("status").isin("failed", "partial"))     # alerts only for runs with errors
    return runs.select("id", render.failure_alert(F.col("source_site"), F.concat(
        F.lit("run ended "), F.col("status"), F.lit(" after "), F.col("duration_seconds").cast("string"), F.lit(" s"))).alias("message"))


_FOUND = W.detail_sql()[1:]


@register("s7_run_log", V.with_views("opportunities", extra=[W.RAW_LINKS, *_FOUND, *_INGEST]).replace("WITH ", "WITH RECURSIVE ", 1) + ", " + _CLOCK + f""",
st AS (SELECT {W.HOST} AS source_site, sum((SELECT count(*) FROM det WHERE det.page_id = pages.page_id)) AS found,
  count(*) FILTER (html IS NULL OR html = '') AS errors FROM pages GROUP BY 1)
SELECT 'run-' || s.source_site || '-20240131000000' AS id, s.source_site, {V.as_of()} AS started_at, coalesce(c.completed_at, {V.as_of()}) AS completed_at,
  CASE WHEN s.errors > 0 AND a.scraped > 0 THEN 'partial' WHEN s.errors > 0 THEN 'failed' WHEN c.err IS NOT NULL THEN 'partial' ELSE 'success' END AS status,
  CAST(s.found AS INTEGER) AS listings_found, CAST(a.inserted AS INTEGER) AS listings_new, CAST(a.extracted - a."unique" AS INTEGER) AS listings_duplicate,
  CASE WHEN c.err IS NOT NULL THEN 'event ' || CAST(c.err AS VARCHAR) WHEN s.errors > 0 THEN CAST(s.errors AS VARCHAR) || ' pages without readable html' END AS error_message,
  CAST(floor(epoch(c.completed_at)) - floor(epoch(c.started_at)) AS INTEGER) AS duration_seconds
FROM st s JOIN results a ON a.source = s.source_site LEFT JOIN clock c ON c.source_site = s.source_site""")
def s7_run_log(spark, sf_dir):
    return jobs.ingest(spark, sf_dir, started=views.fetch_clock(spark, sf_dir))["runs"]


@register("c2_second_run", _ingest_sql("""SELECT source, scraped, extracted, CAST(0 AS BIGINT) AS "unique", CAST(0 AS BIGINT) AS inserted, CAST(0 AS BIGINT) AS updated,
  extraction_failures, failed, n_errors, status FROM results"""))
def c2_second_run(spark, sf_dir):
    """A second ingest over what the first one stored: nothing is new."""
    stored = jobs.ingest(spark, sf_dir)["upserted"].checkpoint()
    return jobs.ingest(spark, sf_dir, target=stored)["results"]


from lodestar.plans.queries_text import _card_sql, _post_sql  # noqa: E402

_W1_FULL = f"""ranked AS (SELECT *, CAST(row_number() OVER (ORDER BY completeness_score DESC, created_at DESC, id) AS INTEGER) AS rank
  FROM (SELECT * FROM opportunities o
    WHERE status = 'active' AND created_at >= {V.as_of()} - INTERVAL 48 HOUR
      AND (deadline IS NULL OR deadline >= CAST({V.as_of()} AS DATE))
      AND NOT EXISTS (SELECT 1 FROM distribution_log l WHERE l.channel = 'telegram' AND l.opportunity_id = o.id)
    ORDER BY completeness_score DESC, created_at DESC, id LIMIT 20))"""
_HEADER = ("SELECT 'telegram' AS channel, 0 AS seq, CAST(NULL AS VARCHAR) AS opportunity_id, "
           "'📢 <b>' || CAST(count(*) AS VARCHAR) || ' New Opportunities</b>' || chr(10) || chr(10) || "
           "'Here are the latest opportunities added to Listings:' AS body FROM ranked HAVING count(*) > 0")
_OUTBOX_SQL = _post_sql("ranked", ("opportunities", "distribution_log"), [_W1_FULL],
                        _HEADER + " UNION ALL SELECT 'telegram', rank, id, body FROM bodies")


@register("c3_daily_distribution", _OUTBOX_SQL)
def c3_daily_distribution(spark, sf_dir):
    return jobs.daily_distribution(spark, sf_dir)["outbox"]


_SECOND = f"""SELECT id AS opportunity_id, CAST(row_number() OVER (ORDER BY completeness_score DESC, created_at DESC, id) AS INTEGER) - 8 AS seq
  FROM opportunities o WHERE status = 'active' AND created_at >= {V.as_of()} - INTERVAL 48 HOUR
    AND (deadline IS NULL OR deadline >= CAST({V.as_of()} AS DATE))
    AND NOT EXISTS (SELECT 1 FROM distribution_log l WHERE l.channel = 'telegram' AND l.opportunity_id = o.id)
  QUALIFY seq BETWEEN 1 AND 8"""


@register("c3_second_run", V.with_views("opportunities", "distribution_log") + _SECOND)
def c3_second_run(spark, sf_dir):
    """A daily run of 8 posts after another: the next picks, none of the first ones."""
    log = jobs.daily_distribution(spark, sf_dir, limit=8)["log"].checkpoint()
    return jobs.daily_distribution(spark, sf_dir, log=log, limit=8)["outbox"].where("seq > 0").select("opportunity_id", "seq")


@register("s8_outbox", _post_sql("ranked", ("opportunities", "distribution_log"), [_W1_FULL],
                                  "SELECT channel, seq, opportunity_id FROM (" + _HEADER
                                  + " UNION ALL SELECT 'telegram', rank, id, body FROM bodies)"))
def s8_outbox(spark, sf_dir):
    return jobs.daily_distribution(spark, sf_dir)["outbox"].select("channel", "seq", "opportunity_id")


_W1 = f"""picks_ AS (SELECT id FROM opportunities o
  WHERE status = 'active' AND created_at >= {V.as_of()} - INTERVAL 48 HOUR
    AND (deadline IS NULL OR deadline >= CAST({V.as_of()} AS DATE))
    AND NOT EXISTS (SELECT 1 FROM distribution_log l WHERE l.channel = 'telegram' AND l.opportunity_id = o.id)
  ORDER BY completeness_score DESC, created_at DESC, id LIMIT 20)"""


@register("a7_distribution_counts", V.with_views("opportunities", "distribution_log", extra=[_W1]) + """
SELECT count(CASE WHEN e.value <= 400 THEN 1 END) AS posted, count(CASE WHEN e.value > 400 THEN 1 END) AS failed,
  count(*) - count(e.value) AS skipped FROM picks_ LEFT JOIN events e ON 'doc-' || CAST(e.event_id AS VARCHAR) = picks_.id""")
def a7_distribution_counts(spark, sf_dir):
    return jobs.daily_distribution(spark, sf_dir, outcomes=views.send_outcomes(spark, sf_dir))["counts"]


_W2 = f"""wk AS (SELECT id FROM opportunities
  WHERE status = 'active' AND created_at >= {V.as_of()} - INTERVAL 7 DAY
    AND (deadline IS NULL OR deadline >= CAST({V.as_of()} AS DATE))
  ORDER BY completeness_score DESC, created_at DESC, id LIMIT 15)"""


@register("r7_digest_report", V.with_views("opportunities", "distribution_log", extra=[_W2]) + """
SELECT '📧 <b>Weekly Email Digest Sent</b>' || chr(10) || chr(10) || '📬 Broadcast ID: digest-1' || chr(10) ||
  '📊 Opportunities included: ' || CAST((SELECT count(*) FROM wk) AS VARCHAR) || chr(10) ||
  '✅ Log entries recorded: ' || CAST((SELECT count(*) FROM wk WHERE NOT EXISTS (SELECT 1 FROM distribution_log l
      WHERE l.opportunity_id = wk.id AND l.channel = 'email_digest')) AS VARCHAR) || chr(10) || chr(10) ||
  '<i>Review and publish in the mail service dashboard.</i>' AS message""")
def r7_digest_report(spark, sf_dir):
    return jobs.weekly_digest(spark, sf_dir)["report"]


_W2_FULL = f"""wk AS (SELECT *, row_number() OVER (ORDER BY completeness_score DESC, created_at DESC, id) AS rank
  FROM (SELECT * FROM opportunities
    WHERE status = 'active' AND created_at >= {V.as_of()} - INTERVAL 7 DAY
      AND (deadline IS NULL OR deadline >= CAST({V.as_of()} AS DATE))
    ORDER BY completeness_score DESC, created_at DESC, id LIMIT 15))"""
_SUBJ = ("'Listings Weekly: ' || CAST(n AS VARCHAR) || ' New Opportunit' || CASE WHEN n = 1 THEN 'y' ELSE 'ies' END"
         " || ' This Week'")
_DIGEST = V.with_views("opportunities", extra=[_W2_FULL, _card_sql("wk"),
    "agg AS (SELECT count(*) AS n, string_agg(card, chr(10) ORDER BY rank) AS body FROM cards HAVING count(*) > 0)"]) + f"""
SELECT 'email_digest' AS channel, 0 AS seq, CAST(NULL AS VARCHAR) AS opportunity_id,
  '<!DOCTYPE html>' || chr(10) || '<html lang="en">' || chr(10) || '<head><meta charset="UTF-8"><title>' ||
  replace(replace(replace(replace({_SUBJ}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') ||
  '</title></head>' || chr(10) || '<body>' || chr(10) || '<table class="digest">' || chr(10) ||
  '<tr><td><h1>Listings</h1><p>Your weekly opportunity digest</p></td></tr>' || chr(10) || '<tr><td><p>Here are the top ' ||
  CAST(n AS VARCHAR) || CASE WHEN n = 1 THEN ' opportunity' ELSE ' opportunities' END || ' added this week.</p></td></tr>' ||
  chr(10) || body || chr(10) ||
  '<tr><td><a href="https://listings.example.org/opportunities">Browse All Opportunities →</a></td></tr>' || chr(10) ||
  '<tr><td><a href="{{{{ unsubscribe_url }}}}">Unsubscribe</a></td></tr>' || chr(10) || '</table>' || chr(10) || '</body>' ||
  chr(10) || '</html>' AS body, {_SUBJ} AS subject FROM agg"""


@register("r4_digest", "SELECT subject, length(body) AS html_chars FROM (" + _DIGEST + ")")
def r4_digest(spark, sf_dir):
    return jobs.weekly_digest(spark, sf_dir)["outbox"].select("subject", F.length("body").cast("bigint").alias("html_chars"))


@register("c4_weekly_digest", _DIGEST)
def c4_weekly_digest(spark, sf_dir):
    return jobs.weekly_digest(spark, sf_dir)["outbox"]
