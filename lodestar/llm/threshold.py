"""Exact top-k by inner product with the threshold algorithm.

Rows and queries are dealt into blocks of bounded size, and every pair of
blocks is a group of its own.  In a group each dimension has a list of the
rows sorted by value.  A query walks the lists in step, from the top where
its weight is positive and from the bottom where it is negative, scores each
new row in full, and stops once the best score an unseen row could have
(the sum of weight * value at the present depth) is below the k-th score.
The groups' few results are ranked per query at the end.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.common import written

ROWS, QUERIES, FIRST_DEPTH = 1024, 1024, 16


def threshold_top(v: np.ndarray, ids: np.ndarray, q: np.ndarray, own: np.ndarray, k: int):
    """For each query row of ``q``: (query, row, score) of its k best rows of
    ``v``, ties to smaller ids, without rows of the id in ``own``."""
    n = len(v)
    down = np.argsort(v, axis=0, kind="stable")[::-1]
    val = np.take_along_axis(v, down, axis=0)
    out_q, out_r, out_s = [], [], []
    for i, w in enumerate(q):
        pos, neg = np.flatnonzero(w > 0), np.flatnonzero(w < 0)
        seen = np.zeros(n, bool)
        rows, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, step = 0, FIRST_DEPTH
        while True:
            to = min(n, at + step)
            new = np.zeros(n, bool)
            new[down[at:to, pos].ravel()] = True
            new[down[n - to:n - at, neg].ravel()] = True
            if to == n:
                new[:] = True       # also rows that no list with a weight names
            new &= ~seen
            seen |= new
            fresh = np.flatnonzero(new & (ids != own[i]))
            rows = np.concatenate([rows, fresh])
            scores = np.concatenate([scores, v[fresh] @ w])
            if len(rows) > k:
                best = np.lexsort((ids[rows], -scores))[:k]
                rows, scores = rows[best], scores[best]
            if to == n:
                break
            bound = int((w[pos] * val[to - 1, pos]).sum() + (w[neg] * val[n - to, neg]).sum())
            if len(rows) >= k and scores.min() > bound:
                break
            at, step = to, step * 2
        out_q.append(np.full(len(rows), i))
        out_r.append(rows)
        out_s.append(scores)
    return np.concatenate(out_q), np.concatenate(out_r), np.concatenate(out_s)


def _group(k: int):
    def run(t: pa.Table) -> pa.Table:
        side = t.column("asks").to_numpy().astype(bool)
        ids, key = t.column("id").to_numpy(), t.column("key").to_numpy()
        vec = t.column("v").combine_chunks()
        m = np.asarray(vec.flatten()).reshape(len(t), -1).astype(np.int64)
        r, q = np.flatnonzero(~side), np.flatnonzero(side)
        if not len(r) or not len(q):
            return pa.table({"key": pa.array([], pa.int64()), "query_id": pa.array([], pa.int64()),
                             "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
        a, b, s = threshold_top(m[r], ids[r], m[q], ids[q], k)
        return pa.table({"key": key[q][a], "query_id": ids[q][a], "vec_id": ids[r][b], "score": s})
    return run


def top_k(queries: DataFrame, rows: DataFrame, k: int = 5) -> DataFrame:
    """``queries`` and ``rows``: (id long, v array<long>) to (query_id, rank,
    vec_id, score): the ``k`` rows of the highest inner product of another id.

    Rows with a null id, a null vector or null components take no part;
    vectors of different length are not compared.  A row that repeats in id
    and vector counts once.  Products are 64-bit integers.
    """
    def ready(df, asks):
        d = df.select(F.col("id").cast("long").alias("id"), F.col("v").cast("array<long>").alias("v"))
        d = d.where("id is not null and v is not null and size(v) > 0 and forall(v, e -> e is not null)")
        return d.dropDuplicates(["id", "v"]).withColumn("key", F.xxhash64("id", "v")).withColumn("asks", F.lit(asks))
    r, q = written(ready(rows, False), "topk-rows"), written(ready(queries, True), "topk-queries")
    rb, qb = max(1, -(-r.count() // ROWS)), max(1, -(-q.count() // QUERIES))
    r = r.withColumn("rb", F.pmod("key", F.lit(rb))).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(qb - 1))))
    q = q.withColumn("qb", F.pmod("key", F.lit(qb))).withColumn("rb", F.explode(F.sequence(F.lit(0), F.lit(rb - 1))))
    cols = [F.col("rb").cast("long"), F.col("qb").cast("long"), F.size("v").alias("dim"), "asks", "id", "key", "v"]
    found = (r.select(*cols).unionAll(q.select(*cols)).groupBy("rb", "qb", "dim")
             .applyInArrow(_group(k), "key long, query_id long, vec_id long, score long"))
    w = Window.partitionBy("key", "query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def integer_vectors(vecs: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, embedding) to (id, v): floor(scale * x) of finite vectors."""
    ok = F.forall("embedding", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    return vecs.where(F.coalesce(ok, F.lit(False))).select(
        F.col("vec_id").alias("id"), F.transform("embedding", lambda e: F.floor(e.cast("double") * scale)).alias("v"))
