"""MinHash near-duplicates: one-permutation hashing with optimal
densification, banded buckets, star-shaped candidate edges.

Per text one pass hashes the distinct five-word shingles, keeps the smallest
of each of 128 bins and fills empty bins from bins that a fixed random
sequence per bin names.  Equal sets are one class from then on, so copies
never meet as pairs.  Four bins make a band; in a bucket of a band every
class is compared with three centres only (the member that shares most
buckets, and two picked by hash), so candidates grow with the members, not
their square.  Candidates are confirmed on their full shingle sets.  Classes
of buckets that are not one component after that get an exact second pass: a
prefix-filtered join on their rarest shingles.  Two sets that reach the bound
share one of their rarest shingles early enough; shingles of one set alone
never meet, and of a template that many texts share only what two sets can
still reach the bound with.  Only pairs of different components are looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.llm.common import mix, shingle_sets, text_array, written
from lodestar.llm.components import components

BINS, ROWS = 128, 4
BLOCK = 256             # classes with a common shingle that meet in one group of the second pass
_BITS = 7
_TRIES = 512


def _walks() -> np.ndarray:
    i = np.arange(BINS * _TRIES, dtype=np.uint64) + np.uint64(0x3C6EF372FE94F82B)
    return (mix(i * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _BITS)).astype(np.int64).reshape(BINS, _TRIES)


_WALKS = _walks()


def signature(h: np.ndarray) -> np.ndarray:
    """The 128 densified bin minima of a sorted, non-empty array of hashes."""
    bins = (h >> np.uint64(64 - _BITS)).astype(np.int64)
    first = np.empty(len(h), bool)
    first[0] = True
    np.not_equal(bins[1:], bins[:-1], out=first[1:])
    at = np.flatnonzero(first)
    sig = np.zeros(BINS, np.uint64)
    full = np.zeros(BINS, bool)
    sig[bins[at]] = h[at]
    full[bins[at]] = True
    if len(at) < BINS:
        todo = np.flatnonzero(~full)
        for a, b in ((0, 16), (16, _TRIES)):
            hit = full[_WALKS[todo, a:b]]
            got = hit.any(axis=1)
            sig[todo[got]] = sig[_WALKS[todo[got], a + hit[got].argmax(axis=1)]]
            todo = todo[~got]
            if not len(todo):
                break
        if len(todo):  # no walk met a full bin: the first full bin
            sig[todo] = sig[bins[at[0]]]
    return sig


_SIG = T.StructType([T.StructField("rid", T.LongType()), T.StructField("doc_id", T.LongType()),
                     T.StructField("th", T.LongType()), T.StructField("n_shingles", T.LongType()),
                     T.StructField("k1", T.LongType()), T.StructField("k2", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType()))])
_SET = T.StructType([T.StructField("k1", T.LongType()), T.StructField("k2", T.LongType()),
                     T.StructField("cls", T.LongType()), T.StructField("elems", T.ArrayType(T.LongType()))])


def _keys(s: np.ndarray) -> tuple[int, int]:
    """Two independent 64-bit sums over a set."""
    with np.errstate(over="ignore"):
        a = mix(s + np.uint64(0x632BE59BD9B4E019)).sum(dtype=np.uint64)
        b = mix(s ^ np.uint64(0x2545F4914F6CDD1D)).sum(dtype=np.uint64)
    return int(a.view(np.int64)), int(b.view(np.int64))


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext
    base, seen = TaskContext.get().partitionId() << 33, 0
    turn = np.array([0x9FB21C651E98DF25, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3], np.uint64)
    for batch in batches:
        n = len(batch)
        size, k1, k2 = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        sigs, which = [], []
        for r, s in shingle_sets(text_array(batch)):
            size[r] = len(s)
            if len(s):
                k1[r], k2[r] = _keys(s)
                sigs.append(signature(s))
                which.append(r)
        per = np.zeros(n, np.int64)
        per[which] = BINS // ROWS
        if sigs:
            m = np.stack(sigs).reshape(len(sigs), BINS // ROWS, ROWS)
            bands = mix((m * turn).sum(axis=2, dtype=np.uint64)).view(np.int64).ravel()
        else:
            bands = np.zeros(0, np.int64)
        off = np.concatenate([[0], np.cumsum(per)]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(base + seen + np.arange(n)), batch.column("doc_id"), batch.column("th"), pa.array(size), pa.array(k1), pa.array(k2),
             pa.ListArray.from_arrays(pa.array(off), pa.array(bands))], names=[f.name for f in _SIG])
        seen += n


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The full sets of texts whose set is the wanted one."""
    for batch in batches:
        w1, w2, cls = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("k1", "k2", "cls"))
        keep, sets, held = [], [], 0

        def out():
            off = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            vals = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
            return pa.RecordBatch.from_arrays([pa.array(w1[keep]), pa.array(w2[keep]), pa.array(cls[keep]),
                                               pa.ListArray.from_arrays(pa.array(off), pa.array(vals))], names=[f.name for f in _SET])
        for r, s in shingle_sets(text_array(batch)):
            if len(s) and _keys(s) == (w1[r], w2[r]):
                keep.append(r)
                sets.append(s)
                held += len(s)
                if held > 500_000:
                    yield out()
                    keep, sets, held = [], [], 0
        yield out()


def near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """``docs`` (doc_id, text) to one row per input row: doc_id, n_shingles,
    component_id, kept, and ``n_class``, the rows with the same shingle set.

    Rows are linked if 100 * intersection >= ``percent`` * union of their
    shingle sets.  Null or empty texts, and texts of white space, have an
    empty set and link with nothing; they are kept.  A null doc_id takes part
    and is the smallest id only of a component without other ids.  Repeated
    doc_ids are rows of their own (two rows of one id count as different
    documents; both carry kept if they are their component's smallest id).
    """
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("th"))
    sig = written(src.mapInArrow(_sign, _SIG), "oph")
    some = sig.where("n_shingles > 0")
    classes = written(some.groupBy("k1", "k2", "n_shingles").agg(
        F.min("rid").alias("cls"), F.min("doc_id").alias("min_doc"), F.count(F.lit(1)).alias("n_class")), "classes")

    # one row per class and band that at least two classes share
    rep = some.select("rid", F.posexplode("bands").alias("band", "bucket")).join(
        classes.select(F.col("cls").alias("rid")), "rid", "left_semi")
    shared = rep.groupBy("band", "bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = written(rep.join(shared, ["band", "bucket"]).select("band", "bucket", F.col("rid").alias("cls"), "size"), "members")
    links = _links(src, sig, members, percent)

    comp = components(links)
    label = classes.join(comp.withColumnRenamed("node", "cls"), "cls", "left").withColumn(
        "component", F.coalesce("component", "cls"))
    smallest = label.groupBy("component").agg(F.min("min_doc").alias("component_id"))
    of_class = label.join(smallest, "component").select("k1", "k2", "n_shingles", "component_id", "n_class")
    none = sig.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(1).cast("long").alias("n_class"))
    full = some.select("doc_id", "n_shingles", "k1", "k2").join(of_class, ["k1", "k2", "n_shingles"]).select(
        "doc_id", "n_shingles", "component_id", "n_class")
    return full.unionAll(none).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))).select(
        "doc_id", "n_shingles", "component_id", "kept", "n_class")


def _candidates(members: DataFrame) -> DataFrame:
    """Star edges (a = centre, b = member) of every bucket, each pair once."""
    popular = members.groupBy("cls").agg(F.sum("size").alias("met"))
    ranked = members.join(popular, "cls")
    tie = F.pmod(F.xxhash64("cls"), F.lit(1 << 20))
    centres = ranked.groupBy("band", "bucket").agg(
        F.max_by("cls", F.col("met") * (1 << 20) + tie).alias("c0"),
        F.min_by("cls", F.xxhash64("cls", F.lit(1))).alias("c1"),
        F.min_by("cls", F.xxhash64("cls", F.lit(2))).alias("c2"))
    stars = members.join(centres, ["band", "bucket"]).select("cls", F.explode(F.array("c0", "c1", "c2")).alias("c"))
    return stars.where("cls <> c").select(F.least("cls", "c").alias("a"), F.greatest("cls", "c").alias("b")).distinct()


def _prefixes(sets: DataFrame, loose: DataFrame, percent: int) -> DataFrame:
    """(cls, component, n, at, token): the shingles of every set by which a
    partner must be found.  Shingles are ordered by the number of sets that
    hold them, rarest first; ``at`` is the place in that order.  Sets of n and
    n' shingles that reach ``percent`` have at least percent / 100 of n in
    common, so one of the first n - that + 1 is common.  Shingles of one set
    alone come first in the order and are left out of the rows."""
    each = sets.join(loose, "cls").select("cls", "component", F.size("elems").alias("n"), F.explode("elems").alias("token"))
    held = each.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    own = each.join(held, "token").groupBy("cls").agg(
        F.min("component").alias("component"), F.min("n").alias("n"), F.array_sort(F.collect_list(F.struct("df", "token"))).alias("common"))
    own = own.withColumn("alone", F.col("n") - F.size("common")).withColumn(
        "take", F.expr(f"int(n - (({int(percent)}L * n + 99) div 100) + 1 - alone)"))
    return own.where("take > 0").select("cls", "component", "n", "alone", F.posexplode(F.slice("common", F.lit(1), F.col("take"))).alias("k", "t")).select(
        "cls", "component", "n", (F.col("alone") + F.col("k")).alias("at"), F.col("t.token").alias("token"))


def _rest(members: DataFrame, sets: DataFrame, comp: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that may reach ``percent``, among
    the classes of buckets that are not one component.  Of such a pair at
    least one is outside the largest component of a shingle they share; those
    meet all others of the shingle in groups of about ``BLOCK`` by ``BLOCK``."""
    m = members.join(comp.withColumnRenamed("node", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    split = m.groupBy("band", "bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    loose = m.join(split, ["band", "bucket"], "left_semi").select("cls", "component").distinct()
    pre = written(_prefixes(sets, loose, percent), "prefixes")
    parts = pre.groupBy("token", "component").agg(F.count(F.lit(1)).alias("n"))
    mixed = parts.groupBy("token").agg(
        F.max_by("component", F.struct("n", "component")).alias("main"), F.max("n").alias("n_main"), F.sum("n").alias("n_all"),
        F.count(F.lit(1)).alias("n_parts")).where("n_parts > 1").select(
        "token", "main", F.ceil(F.col("n_all") / BLOCK).alias("wide"), F.ceil((F.col("n_all") - F.col("n_main")) / BLOCK).alias("high"))
    m = pre.join(mixed, "token")
    deal = lambda n, seed: F.pmod(F.xxhash64("cls", F.lit(seed)), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    x = m.where("component <> main").select(
        "token", deal("high", 11).alias("i"), every("wide").alias("j"), F.col("cls").alias("a"), F.col("component").alias("ca"), F.col("n").alias("na"), F.col("at").alias("ia"))
    y = m.select(
        "token", deal("wide", 12).alias("j"), every("high").alias("i"), F.col("cls").alias("b"), F.col("component").alias("cb"), F.col("n").alias("nb"), F.col("at").alias("ib"),
        (F.col("component") == F.col("main")).alias("in_main"))
    # a shingle at places ia and ib leaves at most min(na - ia, nb - ib) in common if no earlier one is
    need = f"({int(percent)}L * (na + nb) + {99 + int(percent)}) div {100 + int(percent)}"
    return (x.join(y, ["token", "i", "j"])
            .where(f"ca <> cb and (in_main or a < b) and 100L * least(na, nb) >= {int(percent)}L * greatest(na, nb) and least(na - ia, nb - ib) >= {need}")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def _links(src: DataFrame, sig: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Links whose components are those of all links between members of a bucket."""
    pairs = written(_candidates(members), "pairs")
    wanted = members.select("cls").distinct()
    reps = sig.select(F.col("rid").alias("cls"), "doc_id", "th", "k1", "k2").join(wanted, "cls")
    texts = src.join(reps, src.doc_id.eqNullSafe(reps.doc_id) & (src.th == reps.th)).select("text", "k1", "k2", "cls")
    sets = written(texts.mapInArrow(_sets, _SET).select("cls", "elems"), "sets")
    if sets.groupBy("cls").count().where("count > 1").limit(1).count():  # rows that repeat in id and text
        sets = sets.dropDuplicates(["cls"])
    stars = written(_confirmed(pairs, sets, percent), "links")
    rest = written(_rest(members, sets, components(stars), percent), "rest")
    return stars if rest.isEmpty() else stars.unionAll(_confirmed(rest, sets, percent))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that are links by their full sets."""
    x = sets.select(F.col("cls").alias("a"), F.col("elems").alias("ea"))
    y = sets.select(F.col("cls").alias("b"), F.col("elems").alias("eb"))
    both = F.size(F.array_intersect("ea", "eb"))
    return (pairs.join(x, "a").join(y, "b").select("a", "b", both.alias("i"), (F.size("ea") + F.size("eb")).alias("n"))
            .where(F.expr(f"100L * i >= {int(percent)}L * (n - i)")).select("a", "b"))
