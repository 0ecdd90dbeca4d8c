"""Target-distribution importance resampling with bit-sliced weights.

Features are hashed word runs of one to three words.  The bucket counts of
the raw corpus and of the target give every bucket an integer gain (log ratio
of the two smoothed distributions).  A document's weight is the sum of gains
over its features: its bucket counts are written as bit planes of one bit a
bucket, the gains as planes of their two's complement, and for each pair of
planes the number of common bits counts 2^(i + j) times.  Weights are exact
integers.  A Gumbel term from a hash of the id turns the highest scores into
a draw without replacement.

Two scans of the texts: one sums up bucket counts (a task hands on at most
one row a bucket), one weighs.  The draw ranks only documents over a lower
bound of the cut, in ranges of the score, never in one task.
"""

from __future__ import annotations

import functools
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.llm.common import _LOWER, byte_runs, text_array, word_spans, written

BUCKETS, RUN = 10000, 3
MIN_WORDS, PERCENT, SEED = 20, 5, 42
GROUP = 64                  # documents whose planes are built at once
LONG = 48                   # words of more bytes take the library's crc32 one by one
_WORDS = -(-BUCKETS // 64)  # 64-bit words of a plane
_ONES = 0xFFFFFFFF

_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True

_COUNT = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("n", T.LongType())])
_WEIGHT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()),
                        T.StructField("n_features", T.LongType()), T.StructField("weight", T.LongType())])
_PLACE = [T.StructField("pid", T.IntegerType()), T.StructField("pos", T.LongType())]


# ---- crc32 of many word runs at once --------------------------------------
# The register of a crc is linear over xor: appending n bytes to register r
# gives shift_n(r) ^ register(0, bytes), so the crc of "a b" follows from the
# registers of its words.

@functools.cache
def _byte_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, np.uint32(0xEDB88320) ^ (t >> np.uint32(1)), t >> np.uint32(1))
    return t


@functools.cache
def _shift_tables() -> np.ndarray:
    """[n, k, b]: byte b at place k of a register, n zero bytes later."""
    t = _byte_table()
    out = np.empty((LONG + 1, 4, 256), np.uint32)
    for k in range(4):
        out[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
    for n in range(LONG):
        out[n + 1] = t[out[n] & 255] ^ (out[n] >> np.uint32(8))
    return out


def _register(start: int, data: bytes) -> int:
    return zlib.crc32(data, start ^ _ONES) ^ _ONES


def _append(r: np.ndarray, length: np.ndarray, zero: np.ndarray) -> np.ndarray:
    """Registers ``r`` after words of ``length`` bytes whose registers from 0 are ``zero``."""
    t, n = _shift_tables(), np.minimum(length, LONG)
    out = t[n, 0, r & 255] ^ t[n, 1, (r >> np.uint32(8)) & 255] ^ t[n, 2, (r >> np.uint32(16)) & 255] ^ t[n, 3, r >> np.uint32(24)]
    for i in np.flatnonzero(length > LONG):
        out[i] = _register(int(r[i]), bytes(int(length[i])))
    return out ^ zero


def _space(r: np.ndarray) -> np.ndarray:
    return _byte_table()[(r ^ np.uint32(32)) & 255] ^ (r >> np.uint32(8))


def word_registers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The register of each word from a start of 0."""
    t, length = _byte_table(), ends - starts
    out = np.zeros(len(starts), np.uint32)
    order = np.argsort(-np.minimum(length, LONG + 1), kind="stable")
    n_long = int((length > LONG).sum())
    for i in order[:n_long]:
        out[i] = _register(0, data[starts[i]:ends[i]].tobytes())
    order = order[n_long:]
    r, at, left = np.zeros(len(order), np.uint32), starts[order], length[order]
    live = len(order)
    for k in range(int(left[0]) if live else 0):
        live = int(np.searchsorted(-left, -k, side="left"))      # words of more than k bytes come first
        r[:live] = t[(r[:live] ^ data[at[:live] + k]) & 255] ^ (r[:live] >> np.uint32(8))
    out[order] = r
    return out


def features(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket) of every feature of a run of texts, and the words of each row."""
    data = _LOWER[raw]
    starts, ends = word_spans(data, off, _WORD)
    first = np.searchsorted(starts, off)
    n_words = np.diff(first)
    row = np.repeat(np.arange(len(n_words)), n_words)
    zero, length = word_registers(data, starts, ends), ends - starts
    rows, buckets = [], []
    reg = _append(np.full(len(zero), _ONES, np.uint32), length, zero)
    for k in range(RUN):
        rows.append(row[:len(row) - k][row[k:] == row[:len(row) - k]] if k else row)
        buckets.append((reg ^ np.uint32(_ONES)) % np.uint32(BUCKETS))
        if k + 1 == RUN or len(row) <= k + 1:
            break
        # one word more: the run at i goes on with word i + k + 1 if that is of the same text
        on = np.flatnonzero(row[k + 1:] == row[:len(row) - k - 1])
        where = on if k == 0 else np.searchsorted(at, on)
        reg, at = _append(_space(reg[where]), length[on + k + 1], zero[on + k + 1]), on
    return np.concatenate(rows), np.concatenate(buckets).astype(np.int64), n_words


# ---- counts and gains ------------------------------------------------------

def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for _, _, raw, off in byte_runs(text_array(batch)):
            total += np.bincount(features(raw, off)[1], minlength=BUCKETS)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], names=["bucket", "n"])


def bucket_counts(texts: DataFrame) -> list[int]:
    """Features of all ``texts`` (text) in each bucket; at most BUCKETS rows reach the driver."""
    out = [0] * BUCKETS
    for r in texts.select("text").mapInArrow(_count, _COUNT).groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(raw: list[int], target: list[int]) -> np.ndarray:
    n_raw, n_target = sum(raw) + BUCKETS, sum(target) + BUCKETS
    return np.array([math.floor(1000 * math.log(float((t + 1) * n_raw) / float((s + 1) * n_target)))
                     for s, t in zip(raw, target)], np.int64)


# ---- bit planes --------------------------------------------------------------

def planes(m: np.ndarray, bits: int) -> np.ndarray:
    """(bits, rows, words): plane i holds bit i of every bucket of every row."""
    out = np.zeros((bits, len(m), _WORDS * 8), np.uint8)
    one = m.dtype.type(1)
    for i in range(bits):
        packed = np.packbits(((m >> m.dtype.type(i)) & one).astype(bool), axis=1)
        out[i, :, :packed.shape[1]] = packed
    return out.view(np.uint64)


def gain_planes(g: np.ndarray) -> np.ndarray:
    """(planes, words) of the two's complement of the gains; the last plane counts negatively."""
    bits = max(int(g.max(initial=0)).bit_length(), int((~g.min(initial=0))).bit_length()) + 1
    return planes(g[None, :], bits)[:, 0, :]


def bit_sliced(counts: np.ndarray, g: np.ndarray) -> np.ndarray:
    """Sum of counts times gains of every row of ``counts`` (rows, BUCKETS), from planes ``g``."""
    out = np.zeros(len(counts), np.int64)
    high = counts.max(axis=1)
    signs = [1 << j for j in range(len(g) - 1)] + [-(1 << (len(g) - 1))]
    i = 0
    while True:
        rows = np.flatnonzero(high >> i)
        if not len(rows):
            return out
        p = planes((counts[rows] >> counts.dtype.type(i)) & counts.dtype.type(1), 1)[0]
        for j, s in enumerate(signs):
            out[rows] += (np.bitwise_count(p & g[j]).sum(axis=1, dtype=np.int64) * s) << i
        i += 1


def _weigh(g: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weight, words, n = (np.zeros(len(batch), np.int64) for _ in range(3))
            for lo, hi, raw, off in byte_runs(text_array(batch)):
                row, bucket, n_words = features(raw, off)
                words[lo:hi] = n_words
                n[lo:hi] = np.bincount(row, minlength=hi - lo)
                order = np.argsort(row, kind="stable")
                row, bucket = row[order], bucket[order]
                for a in range(0, hi - lo, GROUP):
                    b = min(a + GROUP, hi - lo)
                    x, y = np.searchsorted(row, [a, b])
                    counts = np.bincount((row[x:y] - a) * BUCKETS + bucket[x:y], minlength=(b - a) * BUCKETS)
                    weight[lo + a:lo + b] = bit_sliced(counts.astype(np.uint32).reshape(b - a, BUCKETS), g)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(words), pa.array(n), pa.array(weight)], names=_WEIGHT.names)
    return run


def weights(docs: DataFrame, g: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features, weight of every row of ``docs`` (doc_id, text)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_weigh(gain_planes(g)), _WEIGHT)


# ---- the draw ----------------------------------------------------------------

def _placed(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        pid, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = len(batch)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, pid, np.int32)), pa.array(np.arange(seen, seen + n))], names=names)
            seen += n
    return run


def ranked(rows: DataFrame, order: list) -> DataFrame:
    """``rows`` with ``rank`` (long, from 1) in the order of ``order``: ranges
    of the order are sorted apart and numbered from the sizes of those before.
    ``rows`` must be a written table, so that its rows come in a fixed order;
    that order breaks ties, and lets a range of equal keys be split."""
    key = [*order, "row"]
    src = rows.withColumn("row", F.monotonically_increasing_id())
    schema = T.StructType([*rows.schema.fields, *_PLACE])
    parts = written(src.repartitionByRange(*key).sortWithinPartitions(*key).drop("row").mapInArrow(_placed(schema.names), schema), "ranges")
    before, at = [], 0
    for r in parts.groupBy("pid").agg(F.max("pos").alias("last")).orderBy("pid").collect():      # one row a partition
        before.append((r["pid"], at))
        at += r["last"] + 1
    starts = rows.sparkSession.createDataFrame(before, "pid int, before long")
    return parts.join(F.broadcast(starts), "pid").withColumn("rank", F.col("before") + F.col("pos") + 1).select(*rows.columns, "rank")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """``docs`` (doc_id, text) and ``target`` (text) to one row per document:
    doc_id, n_features, weight, score, rank (null where not drawn), n_words.

    Null and empty texts have no features and weight 0 and are never drawn.
    A null doc_id is hashed as an empty one and comes last among equal scores;
    repeated ids are documents of their own, with the same hash term.  An
    empty target or corpus counts as buckets of 0; an empty corpus gives an
    empty result.
    """
    g = gains(bucket_counts(docs), bucket_counts(target))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0))))
    rows = written(weights(docs, g).withColumn("score", F.col("weight") + noise.cast("long")), "weights")
    drawn = (F.col("n_words") >= min_words)
    # the sketch's rank is off by at most 1 / accuracy of the rows, so this is a lower bound of the cut; the count makes sure
    stats = rows.where(drawn).agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("score", max(0.0, 1 - percent / 100 - 0.001), 10000).alias("low")).first()
    k = percent * stats["n"] // 100
    low = stats["low"]
    if k and rows.where(drawn & (F.col("score") >= low)).count() < k:
        low = rows.where(drawn).agg(F.min("score")).first()[0]
    cols = ["doc_id", "n_features", "weight", "score", "rank", "n_words"]
    none = F.lit(None).cast("long")
    if not k:
        return rows.withColumn("rank", none).select(*cols)
    top = drawn & (F.col("score") >= F.lit(low))
    best = ranked(written(rows.where(top), "top"), [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "n_features"])
    best = best.withColumn("rank", F.when(F.col("rank") <= k, F.col("rank")))
    return best.select(*cols).unionAll(rows.where(~top).withColumn("rank", none).select(*cols))
