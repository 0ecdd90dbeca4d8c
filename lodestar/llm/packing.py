"""Packing documents into sequences of fixed length by non-negative least
squares over the length histogram.

Every document becomes full pieces of ``size`` tokens and one remainder.
Combinations of at most three lengths that fill a sequence exactly are
enumerated; a non-negative least-squares fit finds how often to repeat each
so that together they use up the histogram; the counts are rounded, what is
left is packed greedily from the longest length, and lengths that find no
partners are laid end to end and cut at sequence borders.

The driver handles the histogram and the plan only (at most ``size`` lengths
and their combinations, whatever the corpus).  A piece finds its place by its
rank among the pieces of its length: local ranks per written partition, plus
the counts of the partitions before.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.llm.common import text_array, written
from lodestar.llm.tokens import encoder

SIZE, END_ID = 2048, 1
WASTE = 256             # a greedily packed sequence may leave a 256th empty
_PIECE = T.StructType([T.StructField("part", T.LongType()), T.StructField("doc_id", T.LongType()),
                       T.StructField("th", T.LongType()), T.StructField("start", T.LongType()),
                       T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
                       T.StructField("doc_tokens", T.LongType()), T.StructField("local", T.LongType())])
_PLACED = T.StructType([*_PIECE.fields[1:7], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])


def _pieces(path: str, size: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, seen = TaskContext.get().partitionId(), {}
        enc = encoder(path, False)
        for batch in batches:
            for lo, hi, ids, off in enc.runs(text_array(batch)):
                row, start, length, crc, total, local = [], [], [], [], [], []
                for r in range(hi - lo):
                    doc = np.append(ids[off[r]:off[r + 1]], np.uint32(end_id)).astype("<u4")
                    for a in range(0, len(doc), size):
                        piece = doc[a:a + size]
                        n = len(piece)
                        row.append(lo + r)
                        start.append(a)
                        length.append(n)
                        crc.append(zlib.crc32(piece.tobytes()))
                        total.append(len(doc))
                        local.append(seen.get(n, 0))
                        seen[n] = local[-1] + 1
                at = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(row), pa.int64()), batch.column("doc_id").take(at), batch.column("th").take(at),
                     *(pa.array(x, pa.int64()) for x in (start, length, crc, total, local))], names=_PIECE.names)
    return run


# ---- the plan, from the histogram alone ----------------------------------

def combinations(size: int) -> np.ndarray:
    """All (a >= b >= c >= 0) with a + b + c = size and a < size; c = 0: two lengths."""
    out = []
    for c in range(0, size // 3 + 1):
        b = np.arange(max(c, 1), (size - c) // 2 + 1)
        a = size - c - b
        out.append(np.stack([a, b, np.full(len(b), c)], axis=1)[a < size])
    return np.concatenate(out)


def solve(combos: np.ndarray, hist: np.ndarray, rounds: int = 150) -> np.ndarray:
    """Repeat counts x >= 0 that bring the combinations' use of each length
    near ``hist`` (accelerated projected gradient on the squared error)."""
    a, b, c = combos.T
    m = len(hist)

    def use(x):
        u = np.bincount(a, x, m) + np.bincount(b, x, m) + np.bincount(c, x, m)
        u[0] = 0
        return u

    def back(r):
        r = r.copy()
        r[0] = 0
        return r[a] + r[b] + r[c]

    live = (hist[a] > 0) & (hist[b] > 0) & ((hist[c] > 0) | (c == 0))
    y = live.astype(float)
    for _ in range(12):     # largest eigenvalue of the normal matrix
        y = np.where(live, back(use(y)), 0)
        norm = np.linalg.norm(y)
        if norm == 0:
            return np.zeros(len(combos))
        y /= norm
    step = 1 / (1.05 * norm)
    x = z = np.zeros(len(combos))
    t = 1.0
    for _ in range(rounds):
        new = np.where(live, np.maximum(z - step * back(use(z) - hist), 0), 0)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z = new + (t - 1) / t2 * (new - x)
        x, t = new, t2
    return x


def make_plan(hist: np.ndarray, size: int = SIZE) -> dict[str, np.ndarray]:
    """Intervals of ranks per length: key (length << 40 | first rank), the
    first sequence, pieces of that length in a sequence, first offset; for
    the last, cut part (``per`` = 0) the offset counts from its beginning."""
    left = hist.astype(np.int64).copy()
    used = np.zeros(size + 1, np.int64)
    rows: list[tuple[int, int, int, int]] = []
    seq = 0

    def place(pattern: list[tuple[int, int]], count: int):
        nonlocal seq
        at = 0
        for length, per in pattern:
            rows.append(((length << 40) | int(used[length]), seq, per, at))
            used[length] += per * count
            left[length] -= per * count
            at += per * length
        seq += count

    if left[size]:
        place([(size, 1)], int(left[size]))
    combos = combinations(size)
    x = solve(combos, np.append(left[:size], 0).astype(float)[:size + 1])
    rest = np.cumsum(x)
    counts = np.diff(np.floor(rest + 0.5), prepend=0).astype(np.int64)
    order = np.flatnonzero(counts)
    for i in order[np.argsort(-counts[order], kind="stable")]:
        pattern: list[tuple[int, int]] = []
        for v in combos[i].tolist():
            if v and pattern and pattern[-1][0] == v:
                pattern[-1] = (v, pattern[-1][1] + 1)
            elif v:
                pattern.append((v, 1))
        n = min([int(counts[i]), *(int(left[v]) // k for v, k in pattern)])
        if n:
            place(pattern, n)
    last = []
    for length in range(size - 1, 0, -1):
        while left[length]:
            pattern, gap = [(length, 1)], size - length
            v = min(gap, length)
            while gap and v:
                have = int(left[v]) - (1 if v == length else 0)
                k = min(have, gap // v)
                if k > 0:
                    if v == length:
                        pattern[0] = (length, 1 + k)
                    else:
                        pattern.append((v, k))
                    gap -= k * v
                v = min(gap, v - 1)
            if gap > size // WASTE:
                last.append(length)
                break
            place(pattern, min(int(left[v]) // k for v, k in pattern))
    at = 0
    for length in last:
        rows.append(((length << 40) | int(used[length]), seq, 0, at))
        at += int(left[length]) * length
    rows.sort()
    p = np.array(rows, np.int64).reshape(-1, 4)
    return {"key": p[:, 0], "seq": p[:, 1], "per": p[:, 2], "at": p[:, 3]}


def _place(plan, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = plan.value
        for batch in batches:
            col = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in ("start", "length", "ids_crc32", "doc_tokens", "rank")}
            ids, th = batch.column("doc_id"), batch.column("th")
            i = np.searchsorted(p["key"], (col["length"] << 40) | col["rank"], side="right") - 1
            j = col["rank"] - (p["key"][i] & ((1 << 40) - 1))
            per = np.maximum(p["per"][i], 1)
            seq, off = p["seq"][i] + j // per, p["at"][i] + (j % per) * col["length"]
            flat = p["per"][i] == 0
            pos = p["at"][i] + j * col["length"]
            seq, off = np.where(flat, p["seq"][i] + pos // size, seq), np.where(flat, pos % size, off)
            over = np.flatnonzero(flat & (off + col["length"] > size))
            head = size - off[over]
            length, crc = col["length"].copy(), col["ids_crc32"].copy()
            length[over] = head
            take = pa.array(np.concatenate([np.arange(len(i)), over]))
            whole = np.ones(len(i), bool)
            whole[over] = False
            known = np.concatenate([whole, np.zeros(len(over), bool)])
            crc = pa.array(np.concatenate([crc, crc[over]]), mask=~known)
            yield pa.RecordBatch.from_arrays(
                [ids.take(take), th.take(take), pa.array(np.concatenate([col["start"], col["start"][over] + head])),
                 pa.array(np.concatenate([length, col["length"][over] - head])), crc,
                 pa.array(np.concatenate([col["doc_tokens"], col["doc_tokens"][over]])),
                 pa.array(np.concatenate([seq, seq[over] + 1])), pa.array(np.concatenate([off, np.zeros(len(over), np.int64)]))],
                names=_PLACED.names)
    return run


def _cut_crcs(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, False)
        for batch in batches:
            cuts = batch.column("cuts").to_pylist()
            out: list[list[int]] = [[], [], [], []]
            for lo, hi, ids, off in enc.runs(text_array(batch)):
                for r in range(hi - lo):
                    doc = np.append(ids[off[r]:off[r + 1]], np.uint32(end_id)).astype("<u4")
                    for c in cuts[lo + r]:
                        for k, v in enumerate((lo + r, c["start"], c["length"], zlib.crc32(doc[c["start"]:c["start"] + c["length"]].tobytes()))):
                            out[k].append(v)
            at = pa.array(out[0], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(at), batch.column("th").take(at),
                                              *(pa.array(x, pa.int64()) for x in out[1:])],
                                             names=["doc_id", "th", "start", "length", "cut_crc"])
    return run


def pack(docs: DataFrame, tokenizer: str, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """``docs`` (doc_id, text) to one row per piece: doc_id, start, length,
    ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids are those of ``tokenizer`` (a file of the tokenizers
    library) and ``end_id``; null and empty texts have the end id alone.
    Rows with a null or a repeated doc_id are documents of their own.  An
    empty table gives no rows.
    """
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("th"))
    pieces = written(src.mapInArrow(_pieces(tokenizer, size, end_id), _PIECE), "pieces")
    counts = pieces.groupBy("part", "length").agg((F.max("local") + 1).alias("n"))
    hist = np.zeros(size + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():   # at most ``size`` rows
        hist[r["length"]] = r["n"]
    plan = docs.sparkSession.sparkContext.broadcast(make_plan(hist, size))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).select("part", "length", "before")
    ranked = pieces.join(base, ["part", "length"]).withColumn("rank", F.col("before") + F.col("local"))
    placed = written(ranked.select("doc_id", "th", "start", "length", "ids_crc32", "doc_tokens", "rank")
                     .mapInArrow(_place(plan, size), _PLACED), "placed")
    wanted = placed.where("ids_crc32 is null").groupBy("doc_id", "th").agg(
        F.collect_set(F.struct("start", "length")).alias("cuts"))      # at most 2 * size cuts of one text
    hit = src.alias("t").join(wanted.alias("w"), F.expr("t.doc_id <=> w.doc_id and t.th <=> w.th"))
    hit = hit.select("t.doc_id", "t.th", "t.text", "w.cuts").dropDuplicates(["doc_id", "th"])
    cut = hit.mapInArrow(_cut_crcs(tokenizer, end_id), "doc_id long, th long, start long, length long, cut_crc long")
    open_ = placed.where("ids_crc32 is null").alias("p").join(
        cut.alias("c"), F.expr("p.doc_id <=> c.doc_id and p.th <=> c.th and p.start = c.start and p.length = c.length"))
    cols = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return placed.where("ids_crc32 is not null").select(*cols).unionAll(
        open_.select("p.doc_id", "p.start", "p.length", F.col("cut_crc").alias("ids_crc32"), "p.doc_tokens", "p.sequence_id", "p.offset"))
