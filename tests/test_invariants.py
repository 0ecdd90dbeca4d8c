"""Invariants of the rows-only queries at sf0.001 (no SQL twin exists)."""

import __spark_entry__ as E
from conftest import SF_SMALL


def q(spark, name):
    return E.queries()[name](spark, SF_SMALL)


def test_dedup_counts_add_up(spark):
    st = q(spark, "a2_dedup_stats").first()
    assert st.unique_count + st.hash_duplicates + st.fuzzy_duplicates == st.total
    dups = q(spark, "w5_union_duplicates")
    assert dups.count() == st.hash_duplicates + st.fuzzy_duplicates
    assert dups.where("score < 85 OR matched_title IS NULL").count() == 0
    res = {r.rep_order: r.unique for r in q(spark, "j5_greedy_resolve").collect()}
    c1 = {r.item_order: r.is_unique for r in q(spark, "c1_dedup_batch").collect()}
    assert all(c1[o] == u for o, u in res.items() if o in c1)


def test_extraction_counts_add_up(spark):
    s = q(spark, "x7_extraction_summary").first()
    assert s.succeeded + s.failed == s.total == q(spark, "x4_validate").count()
    assert q(spark, "x6_split_results").count() == s.succeeded
    assert q(spark, "x5_issues").count() == s.failed


def test_ingest_results_consistent(spark):
    res = q(spark, "a4_source_result").collect()
    up = q(spark, "c2_ingest")
    target = E.queries()["f5_slug"](spark, SF_SMALL).count()
    assert up.count() == target + sum(r.inserted for r in res)
    assert all(r.extracted <= r.scraped and r.unique <= r.extracted for r in res)
    dry = q(spark, "s9_dry_run").collect()
    assert all(r.inserted == 0 and r.updated == 0 for r in dry)   # nothing stored; scrape failures still count


def test_scores_and_links(spark):
    f4 = q(spark, "f4_token_sort_ratio")
    assert f4.where("score < 85 OR score > 100").count() == 0
    assert q(spark, "h2_h8_detail_links").where("position < 0 OR found < 1").count() == 0
