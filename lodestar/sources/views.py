"""The listing tables, derived from the stored driver tables.

documents → extracted items and stored listings; events → distribution log,
scrape runs and review flags; customer → user profiles; orders → saved
listings.  The same definitions exist as SQL in ``lodestar.plans.sqlviews``
for the DuckDB oracle; the two must stay identical.

Attributes that the documents do not carry (type, region, deadline, status,
creation time) are assigned deterministically from the document id, so every
row is kept and every run is repeatable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.constants import AS_OF, EDUCATION_LEVELS, REGIONS, TYPES
from lodestar.functions.text import completeness, slug
from lodestar.sources.tables import read_table


def as_of_ts(as_of: str = AS_OF) -> Column:
    return F.expr(f"TIMESTAMP_NTZ '{as_of}'")


def _pick(values, idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def _s(c: Column) -> Column:
    return c.cast("string")


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracted items: one per document, in document order.

    title = the whole first line, description = the whole text, summary = the
    whole second line ('' if none); source_url is coarse (lang + doc_id mod 4)
    so that re-scraped copies hash to the same key.
    """
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang", "source", "n_chars"])
    doc, text, lang = F.col("doc_id"), F.col("text"), F.col("lang")
    second = F.when(F.instr(text, "\n") > 0,
                    F.substring_index(F.substring_index(text, "\n", 2), "\n", -1)).otherwise(F.lit(""))
    return d.select(
        doc.alias("doc_id"),
        doc.alias("item_order"),
        F.substring_index(text, "\n", 1).alias("title"),
        text.alias("description"),
        second.alias("summary"),
        _pick(TYPES, doc % 8).alias("type"),
        F.array(F.col("source"), lang).alias("fields"),
        F.array(_pick(REGIONS, F.expr("doc_id div 8") % 8)).alias("regions"),
        F.array().cast("array<string>").alias("countries"),
        F.array(_pick(EDUCATION_LEVELS, doc % 6)).alias("target_audience"),
        F.when(lang == "en", F.lit("Open to all applicants")).otherwise(F.lit("")).alias("eligibility_text"),
        F.when(doc % 5 == 0, F.lit(None).cast("date"))
         .otherwise(F.date_add(F.lit("2024-01-31").cast("date"), (doc % 60 - 20).cast("int"))).alias("deadline"),
        (doc % 13 == 0).alias("is_rolling"),
        F.when(doc % 3 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("USD "), _s(F.col("n_chars")))).alias("funding_amount"),
        (doc % 4 == 0).alias("is_fully_funded"),
        F.when(doc % 11 == 0, F.lit(None).cast("string")).otherwise(F.col("source")).alias("organization"),
        F.when(doc % 9 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("https://apply.example.org/"), lang, F.lit("/"), _s(doc))).alias("application_url"),
        F.concat(F.lit("https://www.example.org/"), lang, F.lit("/"), _s(doc % 4)).alias("source_url"),
        F.col("source").alias("source_site"),
        lang.alias("lang"),
    )


def listing_status(doc: Column) -> Column:
    r = doc % 10
    return (F.when(r == 7, "expired").when(r == 8, "flagged").when(r == 9, "removed")
            .otherwise("active"))


def opportunities(spark: SparkSession, sf_dir: str, as_of: str = AS_OF) -> DataFrame:
    """Stored listings: every item with id, per-row url and slug, status,
    completeness and a creation time within the ten days before ``as_of``."""
    it = items(spark, sf_dir)
    doc = F.col("doc_id")
    url = F.concat(F.lit("https://www.example.org/"), F.col("lang"), F.lit("/"), _s(doc))
    created = as_of_ts(as_of) - F.make_dt_interval(F.lit(0), (doc % 240).cast("int"))
    return it.select(
        F.concat(F.lit("doc-"), _s(doc)).alias("id"),
        "doc_id", "title",
        slug(F.col("title"), url).alias("slug"),
        "description", "summary", "type", "fields", "regions", "countries", "target_audience",
        "eligibility_text", "deadline", "is_rolling", "funding_amount", "is_fully_funded",
        url.alias("source_url"), "source_site", "organization", "application_url",
        listing_status(doc).alias("status"),
        F.lit("basic").alias("verification_level"),
        F.lit("low").alias("scam_risk"),
        completeness().alias("completeness_score"),
        F.lit(True).alias("ai_processed"),
        F.lit(None).cast("string").alias("source_hash"),
        F.lit(None).cast("string").alias("raw_html"),
        F.lit(None).cast("string").alias("deadline_text"),
        created.alias("created_at"),
        created.alias("updated_at"),
    )


def stored_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items already stored before this batch: documents that carry a label row
    (semi-join), with their listing status."""
    lab = read_table(spark, sf_dir, "labels", ["doc_id"])
    return (items(spark, sf_dir).join(lab, "doc_id", "left_semi")
            .withColumn("status", listing_status(F.col("doc_id"))))


def batch_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of this batch: documents without a label row (anti-join)."""
    lab = read_table(spark, sf_dir, "labels", ["doc_id"])
    return items(spark, sf_dir).join(lab, "doc_id", "left_anti")


def distribution_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posting log: clicks are channel posts, views are digest entries.

    Ten consecutive events refer to one listing; a value below 1 marks a log
    row whose listing was deleted (id set to NULL)."""
    e = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    e = e.where(F.col("event_type").isin("click", "view"))
    ev = F.col("event_id")
    return e.select(
        F.concat(F.lit("log-"), _s(ev)).alias("id"),
        F.when(F.col("value") < 1.0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("doc-"), _s(F.expr("event_id div 10")))).alias("opportunity_id"),
        F.when(F.col("event_type") == "click", "telegram").otherwise("email_digest").alias("channel"),
        F.concat(F.lit("user-"), _s(F.col("user_id"))).alias("channel_detail"),
        F.col("ts").alias("posted_at"),
        F.when(F.col("value") > 400.0, "failed").otherwise("sent").alias("status"),
        _s(ev).alias("external_id"),
    )


def flagged_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    e = e.where(F.col("event_type") == "error")
    ev = F.col("event_id")
    reviewed = (ev % 2 == 0)
    return e.select(
        F.concat(F.lit("flag-"), _s(ev)).alias("id"),
        F.concat(F.lit("doc-"), _s(F.expr("event_id div 10"))).alias("opportunity_id"),
        F.when(F.col("value") > 100.0, "suspicious_content").otherwise("extraction_failed").alias("flag_reason"),
        F.concat(F.lit("URL: https://www.example.org/e/"), _s(ev)).alias("details"),
        F.lit(True).alias("auto_flagged"),
        reviewed.alias("reviewed"),
        F.when(reviewed, F.concat(F.lit("user-"), _s(F.col("user_id")))).alias("reviewed_by"),
        F.when(reviewed, F.col("ts") + F.expr("INTERVAL 1 DAY")).alias("reviewed_at"),
        F.col("ts").alias("created_at"),
    )


def user_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])
    level = F.when(F.col("c_acctbal") < 0, F.lit("unknown")).otherwise(_pick(EDUCATION_LEVELS, F.col("c_custkey") % 6))
    return c.select(
        F.concat(F.lit("user-"), _s(F.col("c_custkey"))).alias("id"),
        F.col("c_name").alias("display_name"),
        F.concat(F.lower(F.col("c_name")), F.lit("@example.org")).alias("email"),
        _s(F.col("c_nationkey")).alias("nationality"),
        F.col("c_mktsegment").alias("field_of_study"),
        level.alias("education_level"),
        F.array(F.col("c_mktsegment")).alias("interests"),
        F.array(_pick(REGIONS, F.col("c_nationkey") % 8)).alias("regions_of_interest"),
        as_of_ts().alias("created_at"),
        as_of_ts().alias("updated_at"),
    )


def saved_opportunities(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    return o.select(
        F.concat(F.lit("user-"), _s(F.col("o_custkey"))).alias("user_id"),
        F.concat(F.lit("doc-"), _s(F.expr("o_orderkey div 12"))).alias("opportunity_id"),
        F.col("o_orderdate").alias("saved_at"),
    )


def scrape_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run records: one per (source, day) of events; errors are error events,
    scraped the others; status by the run rule (errors with pages → partial,
    errors only → failed, else success)."""
    e = read_table(spark, sf_dir, "events", ["ts", "user_id", "event_type"])
    src = F.concat(F.lit("src"), _s(F.col("user_id") % 20))
    g = (e.select(src.alias("source_site"), F.to_date("ts").alias("day"), "ts", "event_type")
         .groupBy("source_site", "day")
         .agg(F.min("ts").alias("started_at"), F.max("ts").alias("completed_at"),
              F.count(F.lit(1)).alias("listings_found"),
              F.count_if(F.col("event_type") != "error").alias("scraped"),
              F.count_if(F.col("event_type") == "error").alias("errors")))
    status = (F.when((F.col("errors") > 0) & (F.col("scraped") > 0), "partial")
              .when(F.col("errors") > 0, "failed").otherwise("success"))
    return g.select(
        F.concat(F.lit("run-"), F.col("source_site"), F.lit("-"), F.date_format("day", "yyyyMMdd")).alias("id"),
        "source_site", "started_at", "completed_at", status.alias("status"),
        F.col("listings_found").cast("int").alias("listings_found"), F.col("scraped").cast("int").alias("listings_new"),
        F.lit(0).alias("listings_duplicate"), F.lit(None).cast("string").alias("error_message"),
        (F.unix_timestamp(F.col("completed_at").cast("timestamp")) - F.unix_timestamp(F.col("started_at").cast("timestamp")))
        .cast("int").alias("duration_seconds"))


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extraction answers per page: the item of the document with the page's
    id, as JSON text (the tables hold no model answers).  Keys without a value
    are absent; items with an empty summary or no organisation break a rule."""
    it = items(spark, sf_dir)
    body = F.struct("title", "description", "summary", "type", "fields", "regions", "countries", "target_audience",
                    "eligibility_text", F.date_format("deadline", "yyyy-MM-dd").alias("deadline"), "is_rolling",
                    "funding_amount", "is_fully_funded", "organization", "application_url")
    return it.select(F.col("doc_id").alias("page_id"), F.to_json(body).alias("raw_response"))


def send_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the sender reported per listing: the event with the listing's
    number; values above 400 are failures, listings without one were skipped."""
    e = read_table(spark, sf_dir, "events", ["event_id", "value"])
    return e.select(F.concat(F.lit("doc-"), _s(F.col("event_id"))).alias("opportunity_id"),
                    F.when(F.col("value") > 400.0, "failed").otherwise("sent").alias("status"), _s(F.col("event_id")).alias("external_id"))


def fetch_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When each source's fetch began and ended, and its first error: the
    events of user n belong to the source whose first page is page n."""
    from lodestar.operators.html import host
    sites = read_table(spark, sf_dir, "pages", ["page_id", "url"]).groupBy(host("url").alias("source_site")).agg(F.min("page_id").alias("n"))
    e = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type"])
    per = e.groupBy(F.col("user_id").alias("n")).agg(
        F.min("ts").alias("started_at"), F.max("ts").alias("completed_at"),
        F.min(F.when(F.col("event_type") == "error", F.col("event_id"))).alias("err"))
    return sites.join(per, "n").select("source_site", "started_at", "completed_at",
                                       F.concat(F.lit("event "), _s(F.col("err"))).alias("error_message"))
