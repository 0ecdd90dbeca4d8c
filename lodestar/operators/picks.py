"""Ranked selection of stored listings: the daily channel picks and the weekly
digest picks, with their predicates and the anti-join against the posting log.

Plan shape (W1): scan → filter (status, lookback, deadline) → left-anti join
on id against the channel's log ids → TakeOrderedAndProject(20).  The filter
runs before the join so only the lookback window reaches the shuffle, and the
anti-join is null-safe by construction (a NULL log id never matches, unlike a
NOT IN list).  Top-k keeps k rows per partition, so the final merge is tiny.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.constants import (AS_OF, DAILY_LOOKBACK_HOURS, DAILY_MAX, DEFAULT_PAGE_SIZE,
                                WEEKLY_LOOKBACK_DAYS, WEEKLY_MAX)
from lodestar.sources.views import as_of_ts

PICK_COLUMNS = ["id", "title", "slug", "type", "completeness_score", "created_at", "deadline"]


def is_active(status: str = "status") -> Column:
    """P1."""
    return F.col(status) == "active"


def within_lookback(hours: int, as_of: str = AS_OF, col: str = "created_at") -> Column:
    """created_at ≥ as_of − hours, inclusive."""
    return F.col(col) >= as_of_ts(as_of) - F.make_dt_interval(F.lit(0), F.lit(hours))


def open_deadline(as_of: str = AS_OF, col: str = "deadline") -> Column:
    """No deadline, or a deadline on or after the as_of (UTC) date."""
    return F.col(col).isNull() | (F.col(col) >= F.to_date(as_of_ts(as_of)))


def posted_ids(log: DataFrame, channel: str) -> DataFrame:
    """S3: the ids already posted on one channel (NULL ids dropped)."""
    return (log.where((F.col("channel") == channel) & F.col("opportunity_id").isNotNull())
            .select(F.col("opportunity_id").alias("id")).distinct())


def unposted(opps: DataFrame, log: DataFrame, channel: str) -> DataFrame:
    """Listings not yet in the channel's log (anti-join; AQE chooses the
    strategy from the measured bytes of both sides)."""
    posted = (log.where((F.col("channel") == channel) & F.col("opportunity_id").isNotNull())
              .select(F.col("opportunity_id").alias("id")))
    return opps.join(posted, "id", "left_anti")


def rank_order() -> list[Column]:
    """Completeness first; creation time and id break ties deterministically."""
    return [F.col("completeness_score").desc(), F.col("created_at").desc(), F.col("id").asc()]


def candidates(opps: DataFrame, hours: int, as_of: str = AS_OF) -> DataFrame:
    return opps.where(is_active() & within_lookback(hours, as_of) & open_deadline(as_of))


def daily_picks(opps: DataFrame, log: DataFrame, as_of: str = AS_OF,
                limit: int = DAILY_MAX, columns=PICK_COLUMNS) -> DataFrame:
    """Active, created in the last 48 h, open, not yet posted; top 20."""
    c = candidates(opps, DAILY_LOOKBACK_HOURS, as_of)
    return unposted(c, log, "telegram").orderBy(*rank_order()).limit(limit).select(*columns)


def weekly_picks(opps: DataFrame, as_of: str = AS_OF, limit: int = WEEKLY_MAX,
                 columns=PICK_COLUMNS) -> DataFrame:
    """Active, created in the last 7 days, open; top 15 (sent rows included)."""
    c = candidates(opps, WEEKLY_LOOKBACK_DAYS * 24, as_of)
    return c.orderBy(*rank_order()).limit(limit).select(*columns)


def limit_per_group(df: DataFrame, group: str, order: list, n: int) -> DataFrame:
    """The first ``n`` rows of each group.

    Each group's rows are ranked by a window; a hot group is one sort, never
    collected.  (Spark also inserts a partial per-partition top-n filter below
    the shuffle, so only ≤ n rows per group and partition are shuffled.)
    """
    from pyspark.sql import Window
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def page_slice(df: DataFrame, order: list, page: int = 1, page_size: int = DEFAULT_PAGE_SIZE) -> DataFrame:
    """1-based page of ``page_size`` rows in a total order."""
    return df.orderBy(*order).offset((page - 1) * page_size).limit(page_size)


RANK_KEYS = [("completeness_score", True), ("created_at", True), ("id", False)]     # column, falling; as in rank_order


def cursor(page: DataFrame) -> dict | None:
    """Where a page ends, to go on from; None after an empty page.  Brings
    the rank columns of one page to the driver."""
    rows = page.select(*[c for c, _ in RANK_KEYS]).collect()
    return max(rows, key=_place).asDict() if rows else None


def _place(row) -> tuple:
    score, created, id_ = (row[c] for c, _ in RANK_KEYS)
    return (score is None, 0 if score is None else -score, created is None,
            0.0 if created is None else -created.timestamp(), id_ is not None, "" if id_ is None else id_)


def after(end: dict) -> Column:
    """Rows that come after a cursor in ``rank_order`` (nulls last in
    falling columns, first in rising ones).  The first condition bounds the
    leading column alone, which prunes row groups of a table in rank order."""
    def beyond(c: str, falling: bool) -> Column:
        v = end[c]
        if v is None:
            return F.lit(False) if falling else F.col(c).isNotNull()
        return (F.col(c) < F.lit(v)) | F.col(c).isNull() if falling else F.col(c) > F.lit(v)
    rest = F.lit(False)
    for c, falling in reversed(RANK_KEYS):
        rest = beyond(c, falling) | (F.col(c).eqNullSafe(F.lit(end[c])) & rest)
    lead = RANK_KEYS[0][0]
    return rest if end[lead] is None else ((F.col(lead) <= F.lit(end[lead])) | F.col(lead).isNull()) & rest


def next_page(df: DataFrame, end: dict | None = None, page_size: int = DEFAULT_PAGE_SIZE) -> DataFrame:
    """W4 by cursor: the page after ``end`` (None: the first).  Unlike an
    offset, a later page sorts and keeps no more rows than the first: each
    task keeps ``page_size`` rows, whatever the page's number."""
    return (df if end is None else df.where(after(end))).orderBy(*rank_order()).limit(page_size)
