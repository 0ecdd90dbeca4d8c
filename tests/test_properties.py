"""Property tests: Spark expressions against the independent Python rule on
generated inputs, and the DataFrame resolution rounds against the
sequential loop on random graphs."""

import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import seqref
from lodestar.functions import text as tx
from lodestar.operators import dedup

ALPH = st.sampled_from(list("abcXYZ 019_-!.,'é") + [" ", "\t", "\n", "2024", "2031", " the ", " an ", "A"])
TEXT = st.lists(ALPH, min_size=0, max_size=25).map("".join)


@settings(max_examples=1, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(TEXT, TEXT), min_size=60, max_size=60))
def test_text_functions_match_rule(spark, pairs):
    df = spark.createDataFrame(pairs, "t string, u string")
    got = df.select("t", "u", tx.norm_hash("t").alias("h"), tx.norm_title("t").alias("n"),
                    tx.item_hash("t", "u").alias("ih"), tx.slug("t", "u").alias("sl"),
                    tx.sort_key(tx.norm_title("t")).alias("k")).collect()
    for r in got:
        assert r.h == seqref.norm_hash(r.t), r.t
        assert r.n == seqref.norm_title(r.t), r.t
        assert r.ih == seqref.item_hash(r.t, r.u)
        assert r.sl == seqref.slug(r.t, r.u), r.t
        assert r.k == seqref.token_sort(seqref.norm_title(r.t))


def test_completeness_bounds(spark):
    rnd = random.Random(5)
    rows = [tuple(rnd.choice([None, "", "x", "y" * 60]) for _ in range(6)) + (rnd.choice([None, "2024-01-01"]),)
            for _ in range(200)]
    df = spark.createDataFrame(rows, "title string, description string, organization string, application_url string, "
                                     "funding_amount string, eligibility_text string, deadline string")
    vals = [r[0] for r in df.select(tx.completeness()).collect()]
    assert all(0 <= v <= 100 for v in vals) and max(vals) == 100


def test_resolution_matches_sequential_loop(spark):
    rnd = random.Random(11)
    nodes, edges, expect, off = [], [], {}, 0
    for _ in range(40):
        n = rnd.randint(1, 12)
        es = {(a, b) for a in range(n) for b in range(a + 1, n) if rnd.random() < 0.3}
        for i, u in seqref.greedy(n, es).items():
            expect[off + i] = u
        nodes += [(f"k{off + i}", off + i) for i in range(n)]
        edges += [(f"k{off + a}", f"k{off + b}") for a, b in es]
        off += n
    nd = spark.createDataFrame(nodes, "node string, ord long")
    ed = spark.createDataFrame(edges, "src string, dst string")
    got = {int(r.node[1:]): r.unique for r in dedup.greedy_resolve(nd, ed).collect()}
    assert got == expect
