"""Scheduled jobs write versions of their tables and continue from them."""

import os
import tempfile

from conftest import SF_SMALL
from lodestar.constants import AS_OF
from lodestar.plans import run
from pyspark.sql import functions as F


def test_daily_runs_continue_from_the_log(spark):
    out = tempfile.mkdtemp(prefix="lodestar-run-")
    posted = []
    for n in (1, 2):
        d = run.run_daily(spark, SF_SMALL, out, AS_OF)
        assert all(d["written"].values())
        assert run.versions(spark, f"{out}/log") == list(range(1, n + 1))
        box = run.newest(spark, f"{out}/daily_outbox")
        posted.append({r.opportunity_id for r in box.where("seq > 0").collect()})
        if n == 1:
            before = spark.read.parquet(f"{SF_SMALL}/events.parquet").where("event_type in ('click', 'view')").count()
            assert run.newest(spark, f"{out}/log").count() == before + len(posted[0]) and posted[0]
    assert not posted[0] & posted[1]
    w = run.run_weekly(spark, SF_SMALL, out, AS_OF)
    assert all(w["written"].values()) and "Weekly Email Digest Sent" in w["report"].first().message


def test_outcomes_decide_what_is_logged(spark):
    out = tempfile.mkdtemp(prefix="lodestar-sent-")
    run.run_daily(spark, SF_SMALL, out, AS_OF, dry_run=True)
    ids = [r.opportunity_id for r in __import__("lodestar.plans.jobs", fromlist=["x"]).daily_distribution(spark, SF_SMALL)["outbox"].where("seq > 0").orderBy("seq").collect()]
    told = spark.createDataFrame([(ids[0], "sent", "m1"), (ids[1], "failed", None)], "opportunity_id string, status string, external_id string")
    run.run_daily(spark, SF_SMALL, out, AS_OF, outcomes=told)
    c = run.newest(spark, f"{out}/daily_counts").first()
    assert (c.posted, c.failed, c.skipped) == (1, 1, len(ids) - 2)
    log = run.newest(spark, f"{out}/log").where(F.col("opportunity_id").isin(ids) & (F.col("channel") == "telegram"))
    assert [(r.opportunity_id, r.external_id) for r in log.collect()] == [(ids[0], "m1")]


def test_second_ingest_stores_nothing_new(spark):
    out = tempfile.mkdtemp(prefix="lodestar-ingest-")
    clock = spark.sql("select 'x' as source_site, timestamp_ntz'2024-01-31 00:00:00' as started_at, timestamp_ntz'2024-01-31 00:01:30' as completed_at, 'e' as error_message").limit(0)
    first = run.run_ingest(spark, SF_SMALL, out, AS_OF, started=clock)
    stored = run.newest(spark, f"{out}/listings")
    n, new = stored.count(), sum(r.inserted for r in first["results"].collect())
    second = run.run_ingest(spark, SF_SMALL, out, AS_OF)
    rows = second["results"].collect()
    assert new > 0 and sum(r.inserted + r.updated + r.unique for r in rows) == 0
    assert run.versions(spark, f"{out}/listings") == [1, 2] and run.newest(spark, f"{out}/listings").count() == n


def test_ingest_options(spark):
    from lodestar.plans import jobs
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    site = jobs.html.host("url")
    host = pages.select(site.alias("s")).groupBy("s").count().orderBy(F.desc("count"), "s").first().s
    clock = spark.createDataFrame([(host,)], "source_site string").selectExpr(
        "source_site", "timestamp_ntz'2024-01-31 00:00:00' as started_at", "timestamp_ntz'2024-01-31 00:01:30' as completed_at", "'gone' as error_message")
    got = jobs.ingest(spark, SF_SMALL, sources=[host.upper()], pages_per_source=1, started=clock, dry_run=True)
    r = got["results"].collect()
    assert [(x.source, x.scraped <= 1) for x in r] == [(host, True)]
    x = got["runs"].first()
    assert (x.duration_seconds, x.error_message, x.status) == (90, "gone", "partial")


def test_dry_run_writes_nothing(spark):
    out = tempfile.mkdtemp(prefix="lodestar-dry-")
    d = run.run_daily(spark, SF_SMALL, out, AS_OF, dry_run=True)
    assert not any(d["written"].values()) and not os.listdir(out)


def test_one_source_fails_and_the_others_are_stored(spark):
    """A profile with an unreadable selector ends its own source as 'failed';
    everything else is as if that source had not been asked for."""
    from lodestar.plans import jobs
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    sites = sorted(r.s for r in pages.select(jobs.html.host("url").alias("s")).distinct().collect())
    bad = sites[0]
    for column, value in (("content_selectors", F.array(F.lit("div > p"))), ("link_arg", F.lit("h2#top"))):
        kind = jobs.html.PROFILE_DEFAULTS[column][0]
        profiles = jobs.html.site_profiles(pages).withColumn(column, F.when(F.col("source_site") == bad, value.cast(kind)).otherwise(F.col(column)))
        out = tempfile.mkdtemp(prefix="lodestar-fail-")
        got = run.run_ingest(spark, SF_SMALL, out, AS_OF, profiles=profiles)
        rows = {r.source: r for r in got["results"].collect()}
        assert (rows[bad].status, rows[bad].scraped, rows[bad].failed, rows[bad].n_errors) == ("failed", 0, 1, 1)
        records = {r.source_site: r for r in run.newest(spark, f"{out}/runs").collect()}
        assert records[bad].status == "failed" and records[bad].error_message.startswith("UnknownSelector") and records[bad].listings_new == 0
        assert sorted(records) == sites and records[bad].completed_at is not None
        want = jobs.ingest(spark, SF_SMALL, sources=sites[1:])
        assert {r.source: r for r in want["results"].collect()} == {k: v for k, v in rows.items() if k != bad}
        assert sum(r.inserted for r in rows.values()) > 0
        shown = ["id", "slug", "title", "status", "source_site"]
        assert sorted(run.newest(spark, f"{out}/listings").select(shown).collect()) == sorted(want["upserted"].select(shown).collect())
