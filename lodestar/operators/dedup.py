"""Order-faithful two-stage de-duplication of a batch against stored records.

Semantics (sequential reference rule): items are visited in batch order;
an item is a *hash* duplicate if an earlier batch item or a stored record has
the same (normalised title | normalised url) hash; otherwise it is a *fuzzy*
duplicate if its best token-sort ratio against stored records and against
earlier items confirmed unique is ≥ 85; otherwise it is unique and joins the
comparison pool.  matchedTitle is the best-scoring pool record, ties going to
the earliest (stored records before batch items).

Spark plan:
  A1  per-hash first item: a partially aggregated ``min(item_order)``, its
      title fetched by an equi-join, both joined back.
  J3  survivors left-joined to per-hash first stored record.
  J4  fuzzy edges at the level of distinct token-sorted keys: equal keys need
      no comparison (score 100), and a batch key that is stored meets only what
      else rounds to 100; different keys meet in tiles of two blocks of length
      bands, dealt by their counts; a tile tests the lossless length, histogram
      and common-subsequence bounds over arrays of pairs, and only survivors
      reach the Arrow LCS kernel.
  J5  items sharing a key are twins: all but the first are duplicates
      whatever happens, so only one representative per key enters the
      ordered resolution, the lexicographically-first maximal independent set.
      The rule never looks beyond a connected component: components of
      bounded size are resolved one by one in their order, each in a task;
      larger ones in DataFrame rounds, checkpointed each round to cut lineage.
No step emits pairs of items inside a key group or collects a group that may
grow without bound.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.constants import FUZZY_THRESHOLD
from lodestar.functions import fuzzy as fz
from lodestar.functions.text import item_hash, norm_title, sort_key
from lodestar.operators.components import components

ITEM_COLS = ["item_order", "title", "source_url"]
COMPONENT_EDGES = 200_000   # larger components are resolved in rounds over tables
BLOCK_KEYS = 16_384     # keys of one length band on the right of a tile
BLOCK_CHARS = 8_000_000  # and their characters
LEFT_PART = 1 / 8       # on the left, where a key is one step of the work


def active_keys(records: DataFrame, order_col: str | None = None) -> DataFrame:
    """(pool_order, title, source_url) of active stored records, ordered
    by one column, or by creation time and then id."""
    order = F.col(order_col) if order_col else F.struct("created_at", "id")
    return records.where(F.col("status") == "active").select(order.alias("pool_order"), "title", "source_url")


def with_keys(df: DataFrame) -> DataFrame:
    return df.withColumn("hash", item_hash("title", "source_url")) \
             .withColumn("fkey", sort_key(norm_title("title")))


def intra_batch_first(items: DataFrame) -> DataFrame:
    """A1: every item with the order/title of the first item of its hash."""
    firsts = items.groupBy("hash").agg(F.min("item_order").alias("first_order"))
    named = firsts.join(items.select("hash", F.col("item_order").alias("first_order"), F.col("title").alias("first_title")),
                        ["hash", "first_order"])
    return items.join(named, "hash")


def hash_match(survivors: DataFrame, pool: DataFrame) -> DataFrame:
    """Survivors with the title of the first stored record of the same hash (or NULL)."""
    first = pool.groupBy("hash").agg(F.min("pool_order").alias("pool_order"))
    named = pool.select("hash", "pool_order", F.col("title").alias("pool_title")).join(first, ["hash", "pool_order"], "left_semi")
    return survivors.join(named.select("hash", "pool_title"), "hash", "left")


def _near_in_tile(left: pd.DataFrame, right: pd.DataFrame, least: int) -> pd.DataFrame:
    """The pairs of one tile that survive the bounds: a batch key with keys
    ``one`` of which meet it from one side only, the shorter (then smaller) on
    the left, while the others meet every batch key; a batch–batch pair with a < b."""
    a, b = left["key"].tolist(), right["key"].tolist()
    rank = {k: i for i, k in enumerate(sorted({*a, *b}, key=lambda k: (len(k), k)))}
    ra, rb = np.array([rank[k] for k in a], np.int64), np.array([rank[k] for k in b], np.int64)
    one = right["one"].to_numpy(bool)
    i, j = fz.near_places(a, b, lambda x, ys: (ra[x] < rb[ys]) | (~one[ys] & (ra[x] != rb[ys])), least)
    x, y = left["key"].to_numpy(object)[i], right["key"].to_numpy(object)[j]
    xp, yp = left["pool"].to_numpy(bool)[i], right["pool"].to_numpy(bool)[j]
    swap = one[j] & (x > y).astype(bool)
    return pd.DataFrame({"a": np.where(swap, y, x), "b": np.where(swap, x, y), "a_is_pool": np.where(swap, yp, xp),
                         "b_is_batch": one[j], "b_is_pool": np.where(swap, xp, yp)})


def candidate_pairs(batch_keys: DataFrame, pool_keys: DataFrame, least: int = FUZZY_THRESHOLD, among: bool = True) -> DataFrame:
    """Pairs of a batch key and another key that survive the lossless
    length-band, histogram and common-subsequence bounds of a score of
    ``least``: (a, b, a_is_pool, b_is_batch, b_is_pool).  A batch–batch pair
    appears once (a < b).  Without ``among`` batch keys meet pool keys only."""
    allk = (batch_keys.select("fkey", F.lit(True).alias("is_b"), F.lit(False).alias("is_p"))
            .unionByName(pool_keys.select("fkey", F.lit(False).alias("is_b"), F.lit(True).alias("is_p")))
            .groupBy("fkey").agg(F.max("is_b").alias("is_b"), F.max("is_p").alias("is_p")))
    allk = allk.withColumn("len", F.length("fkey")).withColumn("band", fz.band(F.col("len"))).checkpoint()
    # A band is dealt into blocks by its number of keys and characters, and a
    # tile compares one block with one block, so a hot band is as many tiles
    # as it needs.  One row per band and side (lengths are at most 2^31: some
    # fifty bands), which bounds the broadcast.
    sides = {"a": (allk.where("is_b").withColumn("one", F.lit(False)), LEFT_PART),
             "b": (allk.withColumn("one", F.col("is_b")) if among else allk.where("is_p").withColumn("one", F.lit(False)), 1)}
    blocks = {own: d.groupBy("band").agg(F.ceil(F.greatest(
        F.count(F.lit(1)) / (BLOCK_KEYS * part), F.sum("len") / (BLOCK_CHARS * part))).cast("int").alias("blocks")) for own, (d, part) in sides.items()}

    def dealt(own, other):
        met = blocks[other].select(F.col("band").alias(f"{other}_band"), F.col("blocks").alias("met"))
        return (sides[own][0].join(F.broadcast(blocks[own]), "band")
                .select(F.col("fkey").alias("key"), F.col("is_p").alias("pool"), "one", F.col("band").alias(f"{own}_band"),
                        F.pmod(F.xxhash64("fkey"), F.col("blocks")).cast("int").alias(f"{own}_block"),
                        F.explode(fz.probe_bands(F.col("len"), least)).alias(f"{other}_band"))
                .join(F.broadcast(met), f"{other}_band")
                .where(~F.col("one") | (F.col("a_band") <= F.col("b_band")))
                .withColumn(f"{other}_block", F.explode(F.sequence(F.lit(0), F.col("met") - 1))).drop("met")
                .repartition(par, *tile))

    # the work grows with pairs, not with the bytes AQE sees: the partition count is given
    par = max(8, allk.sparkSession.sparkContext.defaultParallelism * 16)
    tile = ["a_band", "a_block", "b_band", "b_block"]
    left, right = dealt("a", "b"), dealt("b", "a")
    kind = "a string, b string, a_is_pool boolean, b_is_batch boolean, b_is_pool boolean"
    return left.groupBy(*tile).cogroup(right.groupBy(*tile)).applyInPandas(lambda x, y: _near_in_tile(x, y, least), kind)


def fuzzy_edges(batch_keys: DataFrame, pool_keys: DataFrame, least: int = FUZZY_THRESHOLD, among: bool = True) -> DataFrame:
    """J4 at key level: (bkey, okey, score, b_pool, other_is_batch,
    other_is_pool) for every batch key and every different key (batch or
    pool) scoring at least ``least``.  A batch–batch pair appears once, with
    bkey < okey; the flags say which sides are also stored (pool) keys.
    Without ``among`` the other keys are the pool's only."""
    pairs = candidate_pairs(batch_keys, pool_keys, least, among)
    scored = pairs.withColumn("score", fz.match_ratio_udf(F.col("a"), F.col("b")))
    return (scored.where(F.col("score") >= least)
            .select(F.col("a").alias("bkey"), F.col("b").alias("okey"), "score",
                    F.col("a_is_pool").alias("b_pool"), F.col("b_is_batch").alias("other_is_batch"),
                    F.col("b_is_pool").alias("other_is_pool")))


def _stored_hits(keys: DataFrame, stored: DataFrame, among: bool) -> tuple[DataFrame, DataFrame]:
    """Batch keys (fkey) against stored keys (fkey): (bkey, okey, score) of
    all that may be a key's best stored match, and the edges of the other keys.

    A key that is stored scores 100 with itself, and a lower score never beats
    that: such keys meet stored keys that round to 100 only, and no batch keys."""
    known = keys.join(stored, "fkey", "left_semi").select("fkey")
    edges = fuzzy_edges(keys.join(stored, "fkey", "left_anti").select("fkey"), stored, among=among)
    if among:
        edges = edges.checkpoint()
    hits = (edges.where("other_is_pool").select("bkey", "okey", "score")
            .unionByName(fuzzy_edges(known, stored, 100, among=False).select("bkey", "okey", "score"))
            .unionByName(known.select(F.col("fkey").alias("bkey"), F.col("fkey").alias("okey"), F.lit(100).alias("score"))))
    return hits, edges


def _in_order(pdf: pd.DataFrame) -> pd.DataFrame:
    """The order rule in one component: a node is unique unless an earlier neighbour is."""
    before: dict = {}
    for s, d in zip(pdf["src_at"], pdf["dst_at"]):
        before.setdefault(d, []).append(s)
    names = dict(zip(pdf["src_at"], pdf["src"])) | dict(zip(pdf["dst_at"], pdf["dst"]))
    unique: dict = {}
    for n in sorted(names):
        unique[n] = not any(unique[s] for s in before.get(n, ()))
    return pd.DataFrame({"node": [names[n] for n in unique], "unique": list(unique.values())})


def greedy_resolve(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Lexicographically-first maximal independent set.

    ``nodes(node, ord)``, ord unique; ``edges(src, dst)`` with ord(src) <
    ord(dst).  Returns ``(node, unique)``.  Nodes without an edge are unique.
    A component of up to ``COMPONENT_EDGES`` edges is resolved in its order by
    one task, so a long chain of near titles costs no rounds of its own; the
    components themselves are found in a logarithmic number of rounds.
    """
    edges = edges.distinct().checkpoint()
    part = components(edges).checkpoint()
    placed = edges.join(part.withColumnRenamed("node", "src"), "src").checkpoint()
    small = placed.groupBy("component").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= COMPONENT_EDGES).select("component")
    # an order may be a struct, which Python doesn't compare: a node goes by its place in its (bounded) component
    at = (nodes.join(part.join(small, "component", "left_semi"), "node")
          .select("node", F.row_number().over(Window.partitionBy("component").orderBy("ord")).alias("at"))).checkpoint()
    ordered = (placed.join(small, "component", "left_semi")
               .join(at.select(F.col("node").alias("src"), F.col("at").alias("src_at")), "src")
               .join(at.select(F.col("node").alias("dst"), F.col("at").alias("dst_at")), "dst"))
    kind = nodes.schema["node"].dataType
    each = ordered.groupBy("component").applyInPandas(_in_order, T.StructType([T.StructField("node", kind), T.StructField("unique", T.BooleanType())])).checkpoint()
    large = placed.join(small, "component", "left_anti").select("src", "dst")
    free = nodes.join(part, "node", "left_anti").select("node", F.lit(True).alias("unique"))
    return free.unionByName(each).unionByName(_resolve_in_rounds(nodes, large))


def _resolve_in_rounds(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """The same for the nodes of ``edges``, of any size.  Each round decides
    every undecided node whose earlier neighbours are all decided (the
    earliest undecided node always is), so the loop ends; each round's state
    is checkpointed to the shared folder."""
    edges = edges.checkpoint()
    touched = edges.select(F.col("src").alias("node")).union(edges.select(F.col("dst").alias("node"))).distinct()
    state = (nodes.join(touched, "node", "left_semi")
             .select("node", F.lit(None).cast("boolean").alias("unique"))).checkpoint()
    while not (undecided := state.where(F.col("unique").isNull()).select(F.col("node").alias("dst"))).isEmpty():
        # only edges into undecided nodes matter from here on
        edges = edges.join(undecided, "dst", "left_semi")
        nb = (edges.join(state.select(F.col("node").alias("src"), F.col("unique").alias("su")), "src")
              .groupBy(F.col("dst").alias("node"))
              .agg(F.count_if(F.col("su") == True).alias("n_u"),  # noqa: E712
                   F.count_if(F.col("su").isNull()).alias("n_open")))
        state = (state.join(nb, "node", "left")
                 .select("node", F.when(F.col("unique").isNotNull(), F.col("unique"))
                         .when(F.coalesce(F.col("n_u"), F.lit(0)) > 0, F.lit(False))
                         .when(F.coalesce(F.col("n_open"), F.lit(0)) == 0, F.lit(True))
                         .alias("unique"))).checkpoint()
    return state


def best_match(items: DataFrame, pool: DataFrame) -> DataFrame:
    """Per item (item_order, title) the stored title (pool_order, title)
    with the best score of at least 85, ties to the earliest record.  Items
    and records with an empty key match nothing; items without a match give
    no row."""
    # each side is read more than once: its keys are made once
    keyed = lambda d, k: d.withColumn(k, sort_key(norm_title("title"))).where(F.col(k) != "").checkpoint()
    i, p = keyed(items, "bkey"), keyed(pool, "okey")
    named = p.join(p.groupBy("okey").agg(F.min("pool_order").alias("pool_order")), ["okey", "pool_order"], "left_semi").select(
        "okey", "pool_order", F.col("title").alias("matched_title"))
    keys = i.select(F.col("bkey").alias("fkey")).distinct().checkpoint()
    hits = _stored_hits(keys, named.select(F.col("okey").alias("fkey")).checkpoint(), False)[0].join(named, "okey")
    best = hits.groupBy("bkey").agg(F.min(F.struct((-F.col("score")).alias("neg"), "pool_order", "matched_title")).alias("_b"))
    return i.join(best, "bkey").select("item_order", (-F.col("_b.neg")).alias("score"), F.col("_b.matched_title").alias("matched_title"))


def dedup_batch(batch: DataFrame, pool: DataFrame, parts: dict | None = None) -> DataFrame:
    """Classify every batch item.

    batch: (item_order, title, source_url), item_order unique and defining
    the visit order; pool: (pool_order, title, source_url) of active stored
    records.  Returns one row per item: item_order, title, is_unique,
    match_type ('hash'|'fuzzy'|NULL), matched_title, score.
    """
    # The keys of every title are made once, as is stage 1 (A1 + J3): every later step reads these tables.
    items = with_keys(batch.select(*ITEM_COLS)).checkpoint()
    pool = with_keys(pool.select("pool_order", "title", "source_url")).checkpoint()
    a1 = intra_batch_first(items)
    j3 = hash_match(a1, pool)
    stage1 = j3.select(
        "item_order", "title", "fkey",
        F.when(F.col("item_order") != F.col("first_order"), F.col("first_title"))
         .otherwise(F.col("pool_title")).alias("hash_title")).checkpoint()
    hash_dups = (stage1.where(F.col("hash_title").isNotNull())
                 .select("item_order", "title", F.lit("hash").alias("match_type"),
                         F.col("hash_title").alias("matched_title"), F.lit(100).alias("score")))
    s2 = stage1.where(F.col("hash_title").isNull()).select("item_order", "title", "fkey")

    blank = s2.where(F.col("fkey") == "").select("item_order", "title")
    keyed = s2.where(F.col("fkey") != "")
    reps = (keyed.groupBy("fkey").agg(F.min("item_order").alias("item_order"))
            .join(keyed, ["fkey", "item_order"])
            .select("fkey", F.col("item_order").alias("rep_order"), F.col("title").alias("rep_title"))).checkpoint()   # read by six later joins
    filled = pool.where(F.col("fkey") != "").select("fkey", "pool_order", "title")
    pool_first = (filled.groupBy("fkey").agg(F.min("pool_order").alias("pool_order"))
                  .join(filled, ["fkey", "pool_order"])
                  .select("fkey", F.col("pool_order").alias("p_order"), F.col("title").alias("p_title"))).checkpoint()

    # Candidate matches per batch key: stored records (same or adjacent key) ...
    pool_hits, edges = _stored_hits(reps.select("fkey"), pool_first.select("fkey"), True)
    pool_hits = pool_hits.checkpoint()
    # A representative whose key matches a stored record is a duplicate outright.
    pool_dup_keys = pool_hits.select(F.col("bkey").alias("fkey")).distinct()

    bb = edges.where(F.col("other_is_batch")).select("bkey", "okey", "score")
    ro = reps.select("fkey", "rep_order")
    oriented = (bb.join(ro.withColumnRenamed("fkey", "bkey").withColumnRenamed("rep_order", "o1"), "bkey")
                .join(ro.withColumnRenamed("fkey", "okey").withColumnRenamed("rep_order", "o2"), "okey"))
    live = reps.join(pool_dup_keys, "fkey", "left_anti").select(F.col("fkey").alias("node"),
                                                                F.col("rep_order").alias("ord"))
    g_edges = (oriented.select(F.when(F.col("o1") < F.col("o2"), F.col("bkey")).otherwise(F.col("okey")).alias("src"),
                               F.when(F.col("o1") < F.col("o2"), F.col("okey")).otherwise(F.col("bkey")).alias("dst"))
               .join(live.select(F.col("node").alias("src")), "src", "left_semi")
               .join(live.select(F.col("node").alias("dst")), "dst", "left_semi"))
    resolved = greedy_resolve(live, g_edges)
    if parts is not None:
        parts.update(edges=edges, resolved=resolved, reps=reps)
    unique_keys = resolved.where("unique").select(F.col("node").alias("fkey"))
    unique_reps = reps.join(unique_keys, "fkey", "left_semi")

    # ... and unique representatives (same or adjacent key), valid only if earlier than the item.
    sym = bb.unionByName(bb.select(F.col("okey").alias("bkey"), F.col("bkey").alias("okey"), "score"))
    rep_same = unique_reps.select(F.col("fkey").alias("bkey"), F.col("fkey").alias("okey"), F.lit(100).alias("score"))
    rep_hits = (sym.unionByName(rep_same)
                .join(unique_reps.select(F.col("fkey").alias("okey"), F.col("rep_order").alias("c_order"),
                                         F.col("rep_title").alias("c_title")), "okey")
                .select("bkey", "score", F.lit(1).alias("c_src"), "c_order",
                        F.lit(None).cast(pool.schema["pool_order"].dataType).alias("c_pool"), "c_title"))
    pool_cands = (pool_hits.join(pool_first.select(F.col("fkey").alias("okey"), F.col("p_order").alias("c_pool"),
                                                   F.col("p_title").alias("c_title")), "okey")
                  .select("bkey", "score", F.lit(0).alias("c_src"),
                          F.lit(None).cast(keyed.schema["item_order"].dataType).alias("c_order"), "c_pool", "c_title"))
    cands = pool_cands.unionByName(rep_hits)

    is_unique_rep = (keyed.join(unique_reps.select("fkey", F.col("rep_order").alias("item_order")),
                                ["fkey", "item_order"], "left_semi"))
    fuzzy_items = keyed.join(is_unique_rep.select("item_order"), "item_order", "left_anti")
    # Every item of a key is later than its representative, so the best of
    # the candidates before the representative is reduced to one row per key;
    # only candidates after it are tested item by item.
    order = F.struct((-F.col("score")).alias("neg"), "c_src", "c_order", "c_pool", "c_title", "score")
    placed = cands.withColumnRenamed("bkey", "fkey").join(ro, "fkey")
    early = (F.col("c_src") == 0) | (F.col("c_order") <= F.col("rep_order"))
    once = placed.where(early).withColumn("before", ~((F.col("c_src") == 0) | (F.col("c_order") < F.col("rep_order"))))
    per_key = once.groupBy("fkey", "before").agg(F.min(order).alias("_b")).select("fkey", "before", "_b.*")
    late = placed.where(~early).select("fkey", F.lit(True).alias("before"), (-F.col("score")).alias("neg"), "c_src", "c_order", "c_pool", "c_title", "score")
    best = (fuzzy_items.join(per_key.unionByName(late), "fkey")
            .where(~F.col("before") | (F.col("c_order") < F.col("item_order")))
            .groupBy("item_order", "title").agg(F.min(order).alias("_b"))
            .select("item_order", "title", F.lit("fuzzy").alias("match_type"),
                    F.col("_b.c_title").alias("matched_title"), F.col("_b.score").alias("score")))

    uniques = (is_unique_rep.select("item_order", "title").unionByName(blank)
               .select("item_order", "title", F.lit(None).cast("string").alias("match_type"),
                       F.lit(None).cast("string").alias("matched_title"), F.lit(None).cast("int").alias("score")))
    dups = hash_dups.unionByName(best)
    return (dups.withColumn("is_unique", F.lit(False))
            .unionByName(uniques.withColumn("is_unique", F.lit(True)))
            .select("item_order", "title", "is_unique", "match_type", "matched_title", "score"))


def dedup_stats(result: DataFrame) -> DataFrame:
    """A2: total, unique, hash and fuzzy duplicate counts."""
    return result.agg(F.count(F.lit(1)).alias("total"),
                      F.count_if(F.col("is_unique")).alias("unique_count"),
                      F.count_if(F.col("match_type") == "hash").alias("hash_duplicates"),
                      F.count_if(F.col("match_type") == "fuzzy").alias("fuzzy_duplicates"))


def duplicates(result: DataFrame) -> DataFrame:
    """Hash and fuzzy duplicates in one list."""
    return result.where(~F.col("is_unique")).drop("is_unique")
