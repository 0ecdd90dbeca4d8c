"""Benchmark the headline queries.

Runs each query at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS] and prints one JSON line.  Each query is forced to full
evaluation with the no-op sink (no driver collect); the first query also
pays JVM/Python-worker warm-up, so a warm-up run precedes the timings.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lodestar.plans.catalog import load_all  # noqa: E402
from lodestar.session import get_session  # noqa: E402

HEADLINE = [
    "w1_daily_picks", "w2_weekly_picks", "r1_post_body", "r3_card_html", "f3_item_hash",
    "a1_intra_batch_first", "j3_hash_match", "j4_fuzzy_best", "c1_dedup_batch",
    "s4_upsert_by_slug", "q5_weighted_postings", "q6_text_search", "h2_extract_links",
    "s1_scan_pages", "x3_x5_validate", "c3_daily_distribution", "c4_weekly_digest",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(f"local[{cpus}]", app="lodestar-bench", shuffle_partitions=int(cpus) * 2,
                        extra={"spark.driver.memory": "16g"})
    reg = load_all()
    names = [n for n in HEADLINE if n in reg]
    # Untimed warm-up: JVM code paths on the bench data, and the Python
    # workers (Arrow UDF, mapInPandas) on the smallest tables; workers are
    # reused by the timed queries.
    reg["w1_daily_picks"].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(small):
        for name in ("f4_token_sort_ratio", "s1_scan_pages"):
            reg[name].build(spark, small).write.format("noop").mode("overwrite").save()
    times = {}
    for n in names:
        t0 = time.time()
        reg[n].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.time() - t0, 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))


if __name__ == "__main__":
    main()
