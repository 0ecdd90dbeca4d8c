"""Near-duplicate vectors by spherical-cap filters.

Filter directions are structured: after a random rotation a vector is cut
into four blocks, each block has B random unit codes, and every combination
of four codes is one direction (B^4 of them, never listed).  A vector's
filters are list-decoded block by block: a partial combination is dropped as
soon as its score plus the best possible rest stays below the vector's
threshold.  The threshold is ``ALPHA``, or ``DELTA`` below the vector's best
direction where that is lower, so every vector has filters.  Vectors meet in
the filters they share; a pair is looked at where the filter is one of the
``OWN`` best of either side, first in half precision with a margin that
loses nothing, then in double precision.

Equal vectors are one class from the start.  A filter shared by more than
``CELL`` classes is dealt into blocks, and pairs of blocks are compared in
separate groups, so no group grows with the data.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.llm.common import written
from lodestar.llm.components import components

BLOCKS, ROTATIONS, ALPHA, DELTA, OWN, CELL = 4, 2, 0.5, 0.045, 6, 512
_MARGIN = 0.004     # over the error of a cosine of half-precision unit vectors
_VEC = T.StructType([T.StructField("cls", T.LongType()), T.StructField("part", T.IntegerType()),
                     T.StructField("filter", T.LongType()), T.StructField("own", T.BooleanType()),
                     T.StructField("half", T.BinaryType())])
_PAIR = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def _codes(dim: int, b: int, turn: int) -> tuple[np.ndarray, list[np.ndarray]]:
    rng = np.random.default_rng([dim, b, turn, 11])
    q = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
    cuts = np.array_split(np.arange(dim), min(BLOCKS, dim))
    out = []
    for c in cuts:
        m = rng.normal(size=(b, len(c)))
        out.append((m / np.linalg.norm(m, axis=1, keepdims=True)).T / np.sqrt(len(cuts)))
    return q, out


def decode(x: np.ndarray, b: int, turn: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, filter, score) of every direction over its row's threshold; ``x``: unit rows."""
    q, codes = _codes(x.shape[1], b, turn)
    y = x @ q
    scores, at = [], 0
    for c in codes:
        scores.append(y[:, at:at + c.shape[0]] @ c)
        at += c.shape[0]
    best = np.stack([s.max(axis=1) for s in scores])
    need = np.minimum(ALPHA, best.sum(axis=0) - DELTA)
    row, acc, code = np.arange(len(x)), np.zeros(len(x)), np.zeros(len(x), np.int64)
    for i, s in enumerate(scores):
        total = acc[:, None] + s[row]
        keep = total >= (need - best[i + 1:].sum(axis=0))[row][:, None] - 1e-12
        r, c = np.nonzero(keep)
        acc, code, row = total[r, c], code[r] * b + c, row[r]
    return row, code, acc


def _filters(b: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, len(whole), 256):
                batch = whole.slice(lo, 256)
                cls, part = (batch.column(c).to_numpy() for c in ("cls", "part"))
                vec = batch.column("vec")
                dims = np.diff(vec.offsets.to_numpy())
                for d in np.unique(dims):
                    rows = np.flatnonzero(dims == d)
                    x = np.stack([np.asarray(vec[int(r)].values, dtype=np.float64) for r in rows])
                    x /= np.abs(x).max(axis=1, keepdims=True)
                    x /= np.linalg.norm(x, axis=1, keepdims=True)
                    half = np.ascontiguousarray(x.astype(np.float16))
                    for turn in range(ROTATIONS):
                        r, f, s = decode(x, b, turn)
                        order = np.lexsort((-s, r))
                        r, f = r[order], f[order]
                        rank = np.arange(len(r)) - np.searchsorted(r, r)
                        take = rows[r]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(cls[take]), pa.array(part[take]), pa.array(f * ROTATIONS + turn), pa.array(rank < OWN),
                             pa.array([half[i].tobytes() for i in range(len(half))], pa.binary()).take(pa.array(r))],
                            names=[x.name for x in _VEC])
    return run


def _near(cosine: float):
    """Pairs within each run of equal (part, filter, cell) of sorted rows."""
    def compare(key, cls, own, blk, cross, half):
        dims = np.array([len(h) for h in half])
        d = dims.max() // 2
        m = np.zeros((len(half), d), np.float32)
        for k in np.unique(dims):
            rows = np.flatnonzero(dims == k)
            m[rows, :k // 2] = np.frombuffer(b"".join(half[i] for i in rows), np.float16).reshape(len(rows), -1)
        out = []
        live = np.arange(len(key))
        for o in range(1, len(key)):
            live = live[live + o < len(key)]
            live = live[key[live] == key[live + o]]
            if not len(live):
                break
            j = live + o
            try_ = (own[live] | own[j]) & ~(cross[live] & (blk[live] == blk[j])) & (dims[live] == dims[j])
            i, j = live[try_], j[try_]
            for at in range(0, len(i), 65536):
                x, y = i[at:at + 65536], j[at:at + 65536]
                ok = np.einsum("ij,ij->i", m[x], m[y]) >= cosine - _MARGIN
                out.append(np.stack([np.minimum(cls[x[ok]], cls[y[ok]]), np.maximum(cls[x[ok]], cls[y[ok]])], axis=1))
        return np.unique(np.concatenate(out), axis=0) if out else np.zeros((0, 2), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            if rest is not None:
                t = pa.concat_tables([rest, t])
            key = t.column("cell").to_numpy()
            last = int(np.searchsorted(key == key[-1], True)) if len(key) else 0
            rest = t.slice(last)
            if last:
                yield _emit(t.slice(0, last))
        if rest is not None and len(rest):
            yield _emit(rest)

    def _emit(t):
        key, cls, blk = (t.column(c).to_numpy() for c in ("cell", "cls", "blk"))
        own, cross = (t.column(c).to_numpy().astype(bool) for c in ("own", "crossed"))
        p = compare(key, cls, own, blk, cross, t.column("half").to_pylist())
        return pa.RecordBatch.from_arrays([pa.array(p[:, 0]), pa.array(p[:, 1])], names=["a", "b"])
    return run


def near_vectors(vecs: DataFrame, cosine: float = 0.98) -> DataFrame:
    """``vecs`` (vec_id, embedding, label) to one row per input row: vec_id,
    n_links, component_id, kept.

    Vectors are compared if their labels are equal and not null and their
    lengths agree.  Null, empty or all-zero vectors, vectors with null or
    non-finite components and rows without a label link with nothing (0
    links, a component of their own, kept).  A null vec_id is linked like any
    other and names a component only if no other id is in it.  A repeated
    vec_id is a row of its own: its copies link with each other.
    """
    x = F.transform("embedding", lambda e: e.cast("double"))
    fine = (F.col("part0").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0)
            & F.forall("vec", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
            & F.exists("vec", lambda e: e != 0))
    rows = vecs.select("vec_id", F.col("label").alias("part0"), "embedding").withColumn("vec", x).select(
        F.col("vec_id").cast("long").alias("vec_id"), "part0", F.transform("vec", lambda e: e + F.lit(0.0)).alias("vec"),
        F.coalesce(fine, F.lit(False)).alias("fine"))
    good = rows.where("fine").withColumn("h1", F.xxhash64("part0", "vec")).withColumn("h2", F.xxhash64("vec", "part0", F.lit(1)))
    kinds = good.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("min_id"))
    # a class needs one of its rows' vectors: any_value on an array would sort, so rows are matched by id and made distinct
    numbered = written(kinds.withColumn("cls", F.monotonically_increasing_id()), "vec-classes")
    one = good.join(numbered, ["h1", "h2"]).where(F.col("vec_id").eqNullSafe(F.col("min_id"))).select(
        "cls", F.hash("part0").alias("part"), "part0", "vec").dropDuplicates(["cls"])
    reps = written(one, "vec-reps")
    n = numbered.count()
    links = written(_links(reps, max(16, int(round(2 * n ** 0.25))), cosine), "vec-links")
    weight = numbered.select("cls", "copies")
    ends = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degree = ends.join(weight.withColumnRenamed("cls", "b"), "b").groupBy(F.col("a").alias("cls")).agg(F.sum("copies").alias("others"))
    label = numbered.join(components(links).withColumnRenamed("node", "cls"), "cls", "left").withColumn(
        "component", F.coalesce("component", "cls"))
    smallest = label.groupBy("component").agg(F.min("min_id").alias("component_id"))
    per = label.join(smallest, "component").join(degree, "cls", "left").select(
        "h1", "h2", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id")
    out = good.select("vec_id", "h1", "h2").join(per, ["h1", "h2"]).select("vec_id", "n_links", "component_id")
    none = rows.where(~F.col("fine")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionAll(none).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _links(reps: DataFrame, b: int, cosine: float) -> DataFrame:
    """Pairs (a < b) of classes with a cosine of at least ``cosine``."""
    hits = written(reps.mapInArrow(_filters(b), _VEC), "filters")
    sizes = hits.groupBy("part", "filter").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    meet = hits.join(sizes, ["part", "filter"]).withColumn("blocks", F.ceil(F.col("size") / CELL).cast("int"))
    meet = meet.withColumn("blk", F.pmod(F.xxhash64("cls", "filter"), F.col("blocks")).cast("int"))
    meet = meet.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    meet = meet.select(F.xxhash64("part", "filter", F.least("blk", "other"), F.greatest("blk", "other")).alias("cell"),
                       "cls", "own", "blk", (F.col("blk") != F.col("other")).alias("crossed"), "half")
    near = meet.repartition("cell").sortWithinPartitions("cell").mapInArrow(_near(cosine), _PAIR).distinct()
    va = reps.select(F.col("cls").alias("a"), F.col("vec").alias("va"), F.col("part0").alias("pa"))
    vb = reps.select(F.col("cls").alias("b"), F.col("vec").alias("vb"), F.col("part0").alias("pb"))
    dot = lambda p, q: F.aggregate(F.zip_with(p, q, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)
    both = near.join(va, "a").join(vb, "b").where("pa = pb and size(va) = size(vb)")
    return both.where(dot("va", "vb") / (F.sqrt(dot("va", "va")) * F.sqrt(dot("vb", "vb"))) >= cosine).select("a", "b")
