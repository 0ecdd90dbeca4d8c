"""Write the physical-plan shape of the headline queries to PLANS.md.

For each query: every parquet scan with its ReadSchema / PushedFilters, and
every join, exchange, aggregate, window, top-k and Python evaluation node of
the final (AQE) plan after one execution.
usage: python scripts/plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from lodestar.plans.catalog import load_all  # noqa: E402
from lodestar.session import get_session  # noqa: E402

KEEP = ("Scan parquet", "Join", "Exchange", "HashAggregate", "TakeOrderedAndProject", "Window",
        "ArrowEvalPython", "MapInPandas", "Generate", "Expand", "BroadcastExchange", "AQEShuffleRead")


def shape(df) -> list[str]:
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    out = []
    for line in plan.split("\n"):
        if any(k in line for k in KEEP):
            line = re.sub(r"#\d+L?", "", line)
            line = re.sub(r"Location: [^,]+, ", "", line)
            out.append(line.rstrip()[:400])
    return out


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", shuffle_partitions=16)
    reg = load_all()
    lines = ["# Physical plans of the headline queries", "",
             f"Final adaptive plans after one run at `{sf}` (local[8]); node lines only, ids stripped.", ""]
    for name in HEADLINE + ["h8_cap_links", "w3_limit_per_source", "j1_unposted", "s5_append_log"]:
        lines += [f"## {name}", "", "```"] + shape(reg[name].build(spark, sf)) + ["```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(lines))


if __name__ == "__main__":
    main()
