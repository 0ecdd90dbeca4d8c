"""Registered de-duplication queries: batch = items of unlabelled documents,
pool = active items of labelled documents (stored before this batch)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.operators import dedup
from lodestar.plans import sqlviews as V
from lodestar.plans.catalog import register
from lodestar.sources import views


def batch_and_pool(spark, sf_dir):
    batch = views.batch_items(spark, sf_dir).select("item_order", "title", "source_url")
    pool = dedup.active_keys(views.stored_items(spark, sf_dir), "doc_id")
    return batch, pool


_H = f"{V.item_hash('title', 'source_url')}"


@register("s2_scan_active_keys", V.with_views("stored_items") + """
SELECT doc_id AS pool_order, title, source_url FROM stored_items WHERE status = 'active'""")
def s2_scan_active_keys(spark, sf_dir):
    return dedup.active_keys(views.stored_items(spark, sf_dir), "doc_id")


@register("a1_intra_batch_first", V.with_views("batch_items", extra=[
    f"h AS (SELECT item_order, title, {_H} AS hash FROM batch_items)"]) + """
SELECT item_order, hash,
       min(item_order) OVER (PARTITION BY hash) AS first_order,
       arg_min(title, item_order) OVER (PARTITION BY hash) AS first_title
FROM h""")
def a1_intra_batch_first(spark, sf_dir):
    b, _ = batch_and_pool(spark, sf_dir)
    return dedup.intra_batch_first(dedup.with_keys(b)).select("item_order", "hash", "first_order", "first_title")


@register("j3_hash_match", V.with_views("batch_items", "stored_items", extra=[
    f"h AS (SELECT item_order, title, {_H} AS hash FROM batch_items)",
    "s AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY hash ORDER BY item_order) = 1)",
    f"p AS (SELECT {_H} AS hash, arg_min(title, doc_id) AS pool_title FROM stored_items "
    "WHERE status = 'active' GROUP BY 1)"]) + """
SELECT s.item_order, s.hash, p.pool_title FROM s LEFT JOIN p ON s.hash = p.hash""")
def j3_hash_match(spark, sf_dir):
    b, p = batch_and_pool(spark, sf_dir)
    a1 = dedup.intra_batch_first(dedup.with_keys(b))
    s1 = a1.where(F.col("item_order") == F.col("first_order"))
    return dedup.hash_match(s1, dedup.with_keys(p)).select("item_order", "hash", "pool_title")


_FK = V.sort_key(V.norm_title("title"))
# Scores of all key pairs that can reach 85: the edit distance bound is
# lossless, and the longest common subsequence is computed row by row.
_SCORES = [
    f"b AS (SELECT item_order, title, {_H} AS hash, {_FK} AS fkey FROM batch_items)",
    f"p AS (SELECT doc_id AS pool_order, title, {_H} AS hash, {_FK} AS fkey FROM stored_items WHERE status = 'active')",
    "bk AS (SELECT DISTINCT fkey FROM b WHERE fkey <> '')",
    "ak AS (SELECT fkey FROM bk UNION SELECT fkey FROM p WHERE fkey <> '')",
    """cand AS (SELECT x.fkey AS a, y.fkey AS c FROM bk x JOIN ak y ON x.fkey <> y.fkey
      WHERE abs(length(x.fkey) - length(y.fkey)) * 200 <= 31 * (length(x.fkey) + length(y.fkey))
        AND levenshtein(x.fkey, y.fkey) * 200 <= 31 * (length(x.fkey) + length(y.fkey)))""",
    """lcs(a, c, i, r) AS (SELECT a, c, 0, list_transform(range(0, length(c) + 1), lambda x: 0) FROM cand
      UNION ALL SELECT a, c, i + 1, list_transform(range(1, length(c) + 2), lambda j: list_max(t[1:j])) FROM (
        SELECT a, c, i, list_concat([0], list_transform(range(1, length(c) + 1), lambda j:
          greatest(r[j + 1], r[j] + CASE WHEN substring(c, j, 1) = substring(a, i + 1, 1) THEN 1 ELSE 0 END))) AS t
        FROM lcs WHERE i < length(a)))""",
    """sc AS (SELECT a, c, CAST(floor(100 * (CAST(2 * r[length(c) + 1] AS DOUBLE) / (length(a) + length(c))) + 0.5) AS INTEGER) AS score
      FROM lcs WHERE i = length(a) AND score >= 85)"""]
CLASSES = _SCORES + [
    """s1 AS (SELECT b.item_order, b.title, b.fkey, CASE WHEN item_order <> min(item_order) OVER h THEN arg_min(b.title, b.item_order) OVER h
        ELSE ph.title END AS hash_title FROM b LEFT JOIN (SELECT hash, arg_min(title, pool_order) AS title FROM p GROUP BY 1) ph USING (hash)
      WINDOW h AS (PARTITION BY hash))""",
    "s2 AS (SELECT * FROM s1 WHERE hash_title IS NULL AND fkey <> '')",
    "reps AS (SELECT fkey, min(item_order) AS rep_order, arg_min(title, item_order) AS rep_title FROM s2 GROUP BY 1)",
    "pf AS (SELECT fkey, min(pool_order) AS p_order, arg_min(title, pool_order) AS p_title FROM p WHERE fkey <> '' GROUP BY 1)",
    """ph AS (SELECT r.fkey, 100 AS score, p_order, p_title FROM reps r JOIN pf USING (fkey)
      UNION ALL SELECT r.fkey, score, p_order, p_title FROM reps r JOIN sc ON sc.a = r.fkey JOIN pf ON pf.fkey = sc.c)""",
    "live AS (SELECT *, row_number() OVER (ORDER BY rep_order) AS n FROM reps WHERE fkey NOT IN (SELECT fkey FROM ph))",
    "nb AS (SELECT l.n, l.fkey, coalesce((SELECT list(sc.c) FROM sc WHERE sc.a = l.fkey), []) AS near FROM live l)",
    """walk(n, kept) AS (SELECT CAST(0 AS BIGINT), CAST([] AS VARCHAR[]) UNION ALL
      SELECT nb.n, CASE WHEN len(list_intersect(nb.near, kept)) = 0 THEN list_append(kept, nb.fkey) ELSE kept END
      FROM walk JOIN nb ON nb.n = walk.n + 1)""",
    "uk AS (SELECT unnest(kept) AS fkey FROM (SELECT kept FROM walk ORDER BY n DESC LIMIT 1))",
    "ur AS (SELECT reps.* FROM reps JOIN uk USING (fkey))",
    """hits AS (SELECT fkey, score, 0 AS src, p_order AS ord, p_title AS t FROM ph
      UNION ALL SELECT fkey, 100, 1, rep_order, rep_title FROM ur
      UNION ALL SELECT sc.a, sc.score, 1, ur.rep_order, ur.rep_title FROM sc JOIN ur ON ur.fkey = sc.c)""",
    """fz AS (SELECT s.item_order, s.title, h.t, h.score FROM s2 s JOIN hits h USING (fkey)
      WHERE (h.src = 0 OR h.ord < s.item_order) AND s.item_order NOT IN (SELECT rep_order FROM ur)
      QUALIFY row_number() OVER (PARTITION BY s.item_order ORDER BY h.score DESC, h.src, h.ord) = 1)""",
    """res AS (SELECT item_order, title, false AS is_unique, 'hash' AS match_type, hash_title AS matched_title, 100 AS score FROM s1 WHERE hash_title IS NOT NULL
      UNION ALL SELECT item_order, title, false, 'fuzzy', t, score FROM fz
      UNION ALL SELECT item_order, title, true, NULL, NULL, NULL FROM s1 WHERE hash_title IS NULL
        AND (fkey = '' OR item_order IN (SELECT rep_order FROM ur)))"""]


def _sql(parts, last):
    return V.with_views("batch_items", "stored_items", extra=parts).replace("WITH ", "WITH RECURSIVE ", 1) + last


@register("j4_fuzzy_best", _sql(_SCORES, """
SELECT item_order, score, matched_title FROM (
  SELECT b.item_order, 100 AS score, p.title AS matched_title, p.pool_order FROM b JOIN p ON p.fkey = b.fkey WHERE b.fkey <> ''
  UNION ALL SELECT b.item_order, sc.score, p.title, p.pool_order FROM b JOIN sc ON sc.a = b.fkey JOIN p ON p.fkey = sc.c)
QUALIFY row_number() OVER (PARTITION BY item_order ORDER BY score DESC, pool_order) = 1"""))
def j4_fuzzy_best(spark, sf_dir):
    b, p = batch_and_pool(spark, sf_dir)
    return dedup.best_match(b, p)


@register("c1_dedup_batch", _sql(CLASSES, "SELECT * FROM res"))
def c1_dedup_batch(spark, sf_dir):
    b, p = batch_and_pool(spark, sf_dir)
    return dedup.dedup_batch(b, p)


@register("a2_dedup_stats", _sql(CLASSES, """
SELECT count(*) AS total, count(*) FILTER (is_unique) AS unique_count, count(*) FILTER (match_type = 'hash') AS hash_duplicates,
  count(*) FILTER (match_type = 'fuzzy') AS fuzzy_duplicates FROM res"""))
def a2_dedup_stats(spark, sf_dir):
    b, p = batch_and_pool(spark, sf_dir)
    return dedup.dedup_stats(dedup.dedup_batch(b, p))


@register("w5_union_duplicates", _sql(CLASSES, "SELECT item_order, title, match_type, matched_title, score FROM res WHERE NOT is_unique"))
def w5_union_duplicates(spark, sf_dir):
    b, p = batch_and_pool(spark, sf_dir)
    return dedup.duplicates(dedup.dedup_batch(b, p))


@register("f4_token_sort_ratio", _sql(_SCORES, """
SELECT a, c AS b, score FROM sc WHERE c NOT IN (SELECT fkey FROM bk) OR a < c"""))
def f4_token_sort_ratio(spark, sf_dir):
    """Token-sort ratio of every key pair that scores at least 85."""
    from lodestar.functions import fuzzy as fz
    b, p = batch_and_pool(spark, sf_dir)
    bk = dedup.with_keys(b).where(F.col("fkey") != "").select("fkey").distinct()
    pk = dedup.with_keys(p).where(F.col("fkey") != "").select("fkey").distinct()
    return dedup.candidate_pairs(bk, pk).select("a", "b", fz.ratio_udf(F.col("a"), F.col("b")).alias("score")).where("score >= 85")


@register("j5_greedy_resolve", _sql(CLASSES, "SELECT rep_order, rep_title, fkey IN (SELECT fkey FROM uk) AS \"unique\" FROM reps"))
def j5_greedy_resolve(spark, sf_dir):
    """Per key representative: its batch order and whether it stays unique."""
    b, p = batch_and_pool(spark, sf_dir)
    parts: dict = {}
    dedup.dedup_batch(b, p, parts)
    return (parts["reps"].join(parts["resolved"].withColumnRenamed("node", "fkey"), "fkey", "left")
            .select("rep_order", "rep_title", F.coalesce("unique", F.lit(False)).alias("unique")))
