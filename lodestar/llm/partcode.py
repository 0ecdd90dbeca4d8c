"""Product codes of integer vectors, found on a trie of distinct parts.

A vector is cut into equal consecutive parts and every part is written as the
index of its nearest codebook entry.  The distinct parts of a block of rows
are sorted, which makes them the leaves of a trie with one level per
dimension.  The trie is walked depth first: the distances of a prefix to all
entries are summed up once and shared by everything below it.  At a leaf the
smallest distance is the code; in training, the part times its number of
copies goes to that entry's sum.

Every pass is one scan of the vectors.  A task hands on only one row per
entry and dimension, so what is shuffled or brought to the driver is bounded
by the codebooks (parts * entries * dimensions), whatever the number of rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.llm.common import written

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
LIMIT = 1 << 27         # integer components beyond it count as it, so that distances fit in a long
LEAVES = 2048           # subtrees of at most so many leaves are summed level by level

_SUMS = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("entry", T.IntegerType()),
                      T.StructField("dim", T.IntegerType()), T.StructField("total", T.LongType()), T.StructField("n", T.LongType())])


def integers(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    """(rows, dim) integers floor(SCALE * x) of the column ``embedding``."""
    col = batch.column("embedding")
    flat = col.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(flat * SCALE), -LIMIT, LIMIT).astype(np.int64).reshape(len(batch), dim)


def distinct_parts(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct rows, the number of copies of each, and every row's place among them."""
    order = np.lexsort(parts.T[::-1])
    s = parts[order]
    head = np.ones(len(s), bool)
    head[1:] = (s[1:] != s[:-1]).any(axis=1)
    at = np.flatnonzero(head)
    place = np.empty(len(s), np.int64)
    place[order] = np.cumsum(head) - 1
    return s[at], np.diff(np.append(at, len(s))), place


def walk(leaves: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry (ties: the lower index) and squared distance of each of the
    sorted distinct rows ``leaves``, by a depth-first walk of their trie."""
    n, depth_of_leaf = leaves.shape
    code, dist = np.empty(n, np.int64), np.empty(n, np.int64)

    def step(values: np.ndarray, depth: int) -> np.ndarray:
        d = values[:, None] - book[None, :, depth]
        return d * d

    def small(lo: int, hi: int, depth: int, near: np.ndarray) -> None:
        """All leaves of a small subtree: one sum per distinct prefix and level."""
        block = leaves[lo:hi]
        head = np.zeros(hi - lo, bool)
        head[0] = True
        near = near[None, :]
        for k in range(depth, depth_of_leaf):
            above = np.cumsum(head) - 1                 # each leaf's prefix one level up
            head[1:] |= block[1:, k] != block[:-1, k]
            at = np.flatnonzero(head)
            near = near[above[at]] + step(block[at, k], k)
        best = near.argmin(axis=1)
        code[lo:hi], dist[lo:hi] = best, near[np.arange(len(best)), best]

    def visit(lo: int, hi: int, depth: int, near: np.ndarray) -> None:
        if hi - lo <= LEAVES:
            small(lo, hi, depth, near)
            return
        col = leaves[lo:hi, depth]
        cuts = lo + np.flatnonzero(col[1:] != col[:-1]) + 1
        run = lo                                        # children from ``run`` on wait for a common block
        for a, b in zip(np.append(lo, cuts).tolist(), np.append(cuts, hi).tolist()):
            if b - a > LEAVES:
                if run < a:
                    small(run, a, depth, near)
                visit(a, b, depth + 1, near + step(leaves[a:a + 1, depth], depth)[0])
                run = b
            elif b - run > LEAVES:
                small(run, a, depth, near)
                run = a
        if run < hi:
            small(run, hi, depth, near)

    if n:
        visit(0, n, 0, np.zeros(len(book), np.int64))
    return code, dist


def _collect_sums(books: np.ndarray):
    n_parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n_parts, entries, width), np.int64)
        count = np.zeros((n_parts, entries), np.int64)
        for batch in batches:
            x = integers(batch, n_parts * width)
            for p in range(n_parts):
                leaves, copies, _ = distinct_parts(x[:, p * width:(p + 1) * width])
                code, _ = walk(leaves, books[p])
                np.add.at(total[p], code, leaves * copies[:, None])
                np.add.at(count[p], code, copies)
        p, e = np.nonzero(count)
        if len(p):
            k = np.tile(np.arange(width), len(p))
            p, e = np.repeat(p, width), np.repeat(e, width)
            yield pa.RecordBatch.from_arrays(
                [pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(k, pa.int32()), pa.array(total[p, e, k]), pa.array(count[p, e])],
                names=[f.name for f in _SUMS])
    return run


def _encode(books: np.ndarray, names: list[str]):
    n_parts, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = integers(batch, n_parts * width)
            codes, error = np.empty((len(x), n_parts), np.int64), np.zeros(len(x), np.int64)
            for p in range(n_parts):
                leaves, _, place = distinct_parts(x[:, p * width:(p + 1) * width])
                code, dist = walk(leaves, books[p])
                codes[:, p] = code[place]
                error += dist[place]
            text = [bytes(r).hex() for r in codes.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(text, pa.string()), pa.array(error)], names=names)
    return run


def kept_vectors(vecs: DataFrame, parts: int = PARTS) -> DataFrame:
    """(vec_id, label, embedding) of the rows that can be coded; see ``compress``."""
    x = F.col("embedding")
    fine = x.isNotNull() & (F.size(x) > 0) & (F.size(x) % parts == 0) & F.forall(
        x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    return vecs.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding").where(fine)


def train(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray | None:
    """Codebooks (parts, entries, dimensions of a part): the vectors of the
    smallest ids, then ``rounds`` rounds of floored means.  None without rows."""
    first = kept.withColumn("dims", F.size("embedding")).orderBy(F.col("vec_id").asc_nulls_last(), "embedding")
    head = first.limit(1).collect()
    if not head:
        return None
    dim = head[0]["dims"]
    rows = first.where(F.col("dims") == dim).limit(entries).collect()
    seed = np.array([r["embedding"] for r in rows], np.float64)
    seed = np.clip(np.floor(seed * SCALE), -LIMIT, LIMIT).astype(np.int64)
    books = np.ascontiguousarray(seed.reshape(len(rows), parts, dim // parts).transpose(1, 0, 2))
    src = kept.where(F.size("embedding") == dim).select("embedding")
    for _ in range(rounds):
        means = src.mapInArrow(_collect_sums(books), _SUMS).groupBy("part", "entry", "dim").agg(
            F.sum("total").alias("total"), F.sum("n").alias("n"))
        books = books.copy()
        for r in means.collect():       # at most parts * entries * dimensions rows
            books[r["part"], r["entry"], r["dim"]] = r["total"] // r["n"]
    return books


def compress(vecs: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """``vecs`` (vec_id, label, embedding) to one row per kept vector: vec_id,
    code (two hex digits a part), error, label_error (errors summed over equal
    labels, nulls together), codebooks_sha256.

    Dropped: null or empty vectors, vectors with null or non-finite
    components, vectors whose length is not a multiple of ``parts`` or differs
    from that of the kept vector of the smallest id.  With fewer vectors than
    entries the codebooks have that many entries.  A null vec_id comes last in
    the order of ids; equal ids are ordered by their vectors; each repeated
    row is coded and counted.  Components over ``LIMIT`` / ``SCALE`` count as
    that bound.  An empty table gives an empty result.
    """
    if not 0 < entries <= 256:
        raise ValueError("two hex digits name at most 256 entries")
    kept = kept_vectors(vecs, parts)
    books = train(kept, parts, entries, rounds)
    schema = T.StructType([kept.schema["vec_id"], kept.schema["label"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    if books is None:
        return kept.sparkSession.createDataFrame([], T.StructType([schema["vec_id"], schema["code"], schema["error"], T.StructField(
            "label_error", T.LongType()), T.StructField("codebooks_sha256", T.StringType())]))
    fits = kept.where(F.size("embedding") == books.shape[0] * books.shape[2])
    coded = written(fits.mapInArrow(_encode(books, schema.names), schema), "codes")
    of_label = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    sha = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return coded.join(of_label, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(sha).alias("codebooks_sha256"))
