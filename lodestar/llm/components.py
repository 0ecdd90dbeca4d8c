"""Connected components of an edge table by alternating star contraction.

Each round turns every node's neighbourhood into a star around its smallest
node (first the larger neighbours, then the smaller ones).  Nothing is
gathered per node: the smallest neighbour is an aggregate joined back to the
edges, so a hub with a third of all edges is split like any skewed join.
Rounds are written to the shared folder; their number grows with the
logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import written


def _mark(df: DataFrame) -> tuple:
    r = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    return r[0], r[1]


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a long, b long) to (node, component): the smallest node
    reachable.  Only nodes with an edge appear; an empty table gives none."""
    cur = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = _mark(cur)
    while mark[0]:
        both = cur.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(cur.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u and v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        low2 = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low2, "a")
        nxt = written(small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                      .unionAll(low2.select("a", F.col("m").alias("b"))).distinct(), "edges")
        new = _mark(nxt)
        cur = nxt
        if new == mark:
            break
        mark = new
    return cur.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        cur.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
