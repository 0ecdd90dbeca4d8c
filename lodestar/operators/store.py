"""Keyed upsert, append-only logs and run records.

Tables are immutable DataFrames: an upsert or append returns the new table,
and ``write_table`` stores it (no transactional table format is assumed).
The upsert is one outer join on slug: the stored table is read once per
batch, and shuffled once unless the batch is small enough for AQE to
broadcast it.  Join strategies are left to AQE, which knows the bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.constants import AS_OF, TYPES
from lodestar.functions.text import completeness, slug
from lodestar.sources.views import as_of_ts

SUPPLIED = ["title", "slug", "description", "summary", "type", "fields", "regions", "countries",
            "target_audience", "eligibility_text", "deadline", "is_rolling", "funding_amount",
            "is_fully_funded", "source_url", "source_site", "organization", "application_url",
            "status", "ai_processed", "completeness_score", "updated_at"]
KEPT = ["id", "verification_level", "scam_risk", "source_hash", "raw_html", "deadline_text", "created_at"]


def to_row(items: DataFrame, as_of: str = AS_OF) -> DataFrame:
    """item → stored columns (status 'active', ai_processed true, slug,
    completeness, updated_at = as_of).  Keeps ``item_order`` for ordering."""
    return items.select(
        "item_order", "title", slug(F.col("title"), F.col("source_url")).alias("slug"),
        "description", "summary", "type", "fields", "regions", "countries", "target_audience",
        "eligibility_text", "deadline", "is_rolling", "funding_amount", "is_fully_funded",
        "source_url", "source_site", "organization", "application_url",
        F.lit("active").alias("status"), F.lit(True).alias("ai_processed"),
        completeness().alias("completeness_score"), as_of_ts(as_of).alias("updated_at"))


def row_errors(rows: DataFrame) -> Column:
    """Why the store would reject a row (NOT NULL / CHECK), or NULL."""
    return F.when(F.col("title").isNull(), F.lit("null value in column \"title\"")) \
        .when(F.col("type").isNull() | ~F.col("type").isin(*TYPES), F.lit("check violation: type")) \
        .when(F.col("source_url").isNull(), F.lit("null value in column \"source_url\"")) \
        .when(F.col("source_site").isNull(), F.lit("null value in column \"source_site\""))


def default_id(slug_col: Column) -> Column:
    """Deterministic id for a new row (instead of a random uuid)."""
    return F.concat(F.lit("opp-"), F.substring(F.sha2(slug_col, 256), 1, 24))


def fill_defaults(rows: DataFrame, as_of: str = AS_OF) -> DataFrame:
    """Q4: defaults for an inserted row."""
    now = as_of_ts(as_of)
    return (rows.withColumn("id", default_id(F.col("slug")))
            .withColumn("verification_level", F.lit("basic"))
            .withColumn("scam_risk", F.lit("low"))
            .withColumn("source_hash", F.lit(None).cast("string"))
            .withColumn("raw_html", F.lit(None).cast("string"))
            .withColumn("deadline_text", F.lit(None).cast("string"))
            .withColumn("created_at", now)
            .withColumn("fields", F.coalesce("fields", F.array().cast("array<string>")))
            .withColumn("regions", F.coalesce("regions", F.array().cast("array<string>")))
            .withColumn("countries", F.coalesce("countries", F.array().cast("array<string>")))
            .withColumn("target_audience", F.coalesce("target_audience", F.array().cast("array<string>")))
            .withColumn("is_rolling", F.coalesce("is_rolling", F.lit(False)))
            .withColumn("is_fully_funded", F.coalesce("is_fully_funded", F.lit(False)))
            .withColumn("completeness_score", F.coalesce("completeness_score", F.lit(0)))
            .withColumn("status", F.coalesce("status", F.lit("active")))
            .withColumn("ai_processed", F.coalesce("ai_processed", F.lit(False))))


def classify(rows: DataFrame, target: DataFrame) -> DataFrame:
    """A row is an update iff its source_url already exists (any status).

    Only stored urls that occur in the batch are kept (semi-join against the
    batch's url set), one row per url."""
    batch_urls = rows.select(F.col("source_url")).where(F.col("source_url").isNotNull()).distinct()
    urls = (target.select("source_url").join(batch_urls, "source_url", "left_semi")
            .select(F.col("source_url").alias("_u")).distinct())
    return (rows.join(urls, rows["source_url"] == urls["_u"], "left")
            .withColumn("is_update", F.col("_u").isNotNull()).drop("_u"))


def upsert(target: DataFrame, rows: DataFrame, as_of: str = AS_OF, protect_status: bool = False) -> DataFrame:
    """Upsert stored rows keyed by slug.

    ``rows`` are F7 rows; rows the store would reject are left out (see
    ``store_counts``).  Among rows sharing a slug the last in order wins, as
    sequential upserts would leave it.  A matched slug takes every supplied
    column, keeps id / created_at / verification / scam risk, and returns to
    status 'active'; a new slug is inserted with defaults.
    """
    return _merged(target, rows, as_of, protect_status, "full_outer")


def upsert_changes(target: DataFrame, rows: DataFrame, as_of: str = AS_OF, protect_status: bool = False) -> DataFrame:
    """S4, the rows alone that ``upsert`` inserts or updates.  Stored rows of
    other slugs are not read into the result, so a small batch broadcasts."""
    return _merged(target, rows, as_of, protect_status, "right_outer")


def _merged(target: DataFrame, rows: DataFrame, as_of: str, protect_status: bool, how: str) -> DataFrame:
    good = rows.where(row_errors(rows).isNull())
    newest = good.groupBy("slug").agg(F.max("item_order").alias("item_order"))
    last = good.join(newest, ["slug", "item_order"], "left_semi").select(*[F.col(c).alias("n_" + c) for c in SUPPLIED])
    t = target.select(*[F.col(c).alias(c) for c in SUPPLIED + KEPT])
    j = t.join(last, F.col("slug") == F.col("n_slug"), how)
    new, old = F.col("n_slug").isNotNull(), F.col("slug").isNotNull()
    status = F.col("n_status")
    if protect_status:
        status = F.when(old & F.col("status").isin("flagged", "removed"), F.col("status")).otherwise(status)
    supplied = {c: status if c == "status" else F.col("n_" + c) for c in SUPPLIED}
    defaults = {"id": default_id(F.col("n_slug")), "verification_level": F.lit("basic"), "scam_risk": F.lit("low"),
                "created_at": as_of_ts(as_of)}
    return j.select(*[F.when(new, supplied[c]).otherwise(F.col(c)).alias(c) for c in SUPPLIED],
                    *[F.when(old, F.col(c)).otherwise(defaults.get(c, F.lit(None))).alias(c) for c in KEPT])


def store_summary(rows: DataFrame, target: DataFrame) -> DataFrame:
    """A3: inserted / updated / failed as judged by source_url (the reported
    counts), plus the slug-keyed judgement the write actually follows
    (``new_slugs`` / ``existing_slugs``); failures are rows the store rejects."""
    keys = rows.select("slug").where(F.col("slug").isNotNull()).distinct()
    have = target.select("slug").join(keys, "slug", "left_semi").distinct().withColumn("_has_slug", F.lit(True))
    c = classify(rows, target).withColumn("error", row_errors(rows)).join(have, "slug", "left")
    ok = F.col("error").isNull()
    return c.agg(F.count_if(ok & ~F.col("is_update")).alias("inserted"),
                 F.count_if(ok & F.col("is_update")).alias("updated"),
                 F.count_if(~ok).alias("failed"),
                 F.count_if(ok & F.col("_has_slug").isNull()).alias("new_slugs"),
                 F.count_if(ok & F.col("_has_slug").isNotNull()).alias("existing_slugs"))


def store_errors(rows: DataFrame) -> DataFrame:
    """A3 error list as rows (source_url, error) — never gathered in one row."""
    return rows.select("source_url", row_errors(rows).alias("error")).where(F.col("error").isNotNull())


def delete_by_source(target: DataFrame, source_site: str) -> DataFrame:
    """J8."""
    return target.where(~(F.col("source_site") == source_site) | F.col("source_site").isNull())


def record_distribution(log: DataFrame, new: DataFrame) -> DataFrame:
    """Append (opportunity_id, channel, posted_at, external_id) rows; a pair
    already recorded (or repeated in ``new``) is skipped silently."""
    first = (new.groupBy("opportunity_id", "channel")
             .agg(F.min(F.struct("posted_at", "external_id")).alias("_f"))
             .select("opportunity_id", "channel", "_f.posted_at", "_f.external_id"))
    seen = log.select("opportunity_id", "channel").join(
        first.select("opportunity_id", "channel"), ["opportunity_id", "channel"], "left_semi")
    fresh = first.join(seen, ["opportunity_id", "channel"], "left_anti")
    rows = fresh.select(
        F.concat(F.lit("log-"), F.substring(F.sha2(F.concat_ws("|", "opportunity_id", "channel"), 256), 1, 24)).alias("id"),
        "opportunity_id", "channel", F.lit(None).cast("string").alias("channel_detail"),
        "posted_at", F.lit("sent").alias("status"), "external_id")
    return log.unionByName(rows, allowMissingColumns=True)


def flag_rows(df: DataFrame, reason: str, url_col: str = "source_url", details_col: str | None = None,
              as_of: str = AS_OF) -> DataFrame:
    """Review rows with details 'URL: …' (+ newline + details)."""
    url = F.concat(F.lit("URL: "), F.col(url_col))
    details = url if details_col is None else F.when(F.col(details_col).isNotNull() & (F.col(details_col) != ""),
                                                     F.concat(url, F.lit("\n"), F.col(details_col))).otherwise(url)
    return df.select(
        F.concat(F.lit("flag-"), F.substring(F.sha2(F.concat_ws("|", F.lit(reason), F.col(url_col)), 256), 1, 24)).alias("id"),
        F.lit(None).cast("string").alias("opportunity_id"), F.lit(reason).alias("flag_reason"),
        details.alias("details"), F.lit(True).alias("auto_flagged"), F.lit(False).alias("reviewed"),
        F.lit(None).cast("string").alias("reviewed_by"), F.lit(None).cast("timestamp_ntz").alias("reviewed_at"),
        as_of_ts(as_of).alias("created_at"))


def open_runs(sources: DataFrame, as_of: str = AS_OF) -> DataFrame:
    """S7 (open): one 'running' row per source with zero counters."""
    return sources.select(
        F.concat(F.lit("run-"), F.col("source_site"), F.lit("-"), F.date_format(as_of_ts(as_of), "yyyyMMddHHmmss")).alias("id"),
        "source_site", as_of_ts(as_of).alias("started_at"), F.lit(None).cast("timestamp_ntz").alias("completed_at"),
        F.lit("running").alias("status"), F.lit(0).alias("listings_found"), F.lit(0).alias("listings_new"),
        F.lit(0).alias("listings_duplicate"), F.lit(None).cast("string").alias("error_message"),
        F.lit(None).cast("int").alias("duration_seconds"))


def close_runs(runs: DataFrame, stats: DataFrame) -> DataFrame:
    """S7 (close): left join the run's stats by id and fill the closing columns.

    ``stats``: id, status, completed_at, duration_seconds, listings_found,
    listings_new, listings_duplicate, error_message."""
    s = stats.select(*[F.col(c).alias("s_" + c) for c in stats.columns])
    j = runs.join(s, runs["id"] == s["s_id"], "left")
    out = [F.col("id"), F.col("source_site"), F.col("started_at")]
    for c in ["completed_at", "status", "listings_found", "listings_new", "listings_duplicate",
              "error_message", "duration_seconds"]:
        out.append(F.coalesce(F.col("s_" + c), F.col(c)).alias(c) if ("s_" + c) in s.columns else F.col(c))
    return j.select(*out)


def outbox(header: DataFrame, posts: DataFrame, channel: str) -> DataFrame:
    """Header row (seq 0) then one row per post in rank order.

    ``header``: one row with ``body``; ``posts``: opportunity_id, rank, body."""
    h = header.select(F.lit(channel).alias("channel"), F.lit(0).alias("seq"),
                      F.lit(None).cast("string").alias("opportunity_id"), "body")
    p = posts.select(F.lit(channel).alias("channel"), F.col("rank").cast("int").alias("seq"), "opportunity_id", "body")
    return h.unionByName(p)


def write_table(df: DataFrame, path: str, dry_run: bool = False, mode: str = "overwrite") -> bool:
    """S9-aware sink: a dry run stops before the write."""
    if dry_run:
        return False
    df.write.mode(mode).parquet(path)
    return True
