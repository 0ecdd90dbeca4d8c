"""Shared pieces of the operators: tables written to the shared folder, whole
texts as byte buffers, word and shingle hashes."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.session import checkpoint_dir

CHUNK_BYTES = 1 << 20   # texts are hashed in runs of about this many bytes; one longer text is one run


def read_table(spark: SparkSession, sf_dir: str, name: str, cols: list[str]) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*cols)


def tokenizer_file(name: str) -> str:
    """The place of a public tokenizer's file; operators take it as a parameter."""
    import public_tokenizers
    return str(public_tokenizers.path(name))


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/lodestar-llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it back:
    later steps survive a lost executor and never recompute what came before."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out():
    """Rows whose labels may not be learned from: crc32(doc_id as text) mod 4 = 2."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


# ---- whole texts as bytes ------------------------------------------------

def text_array(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    """The text column, null as empty, without an offset."""
    col = batch.column(name)
    if col.null_count:
        col = pc.fill_null(col, "")
    if col.offset:
        col = pa.concat_arrays([col])
    return col


def byte_runs(col: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, row offsets into bytes) for runs of rows of about ``size`` bytes."""
    n = len(col)
    if not n:
        return
    wide = pa.types.is_large_string(col.type)
    off = np.frombuffer(col.buffers()[1], dtype=np.int64 if wide else np.int32)[col.offset:col.offset + n + 1].astype(np.int64)
    data = np.frombuffer(col.buffers()[2], dtype=np.uint8) if col.buffers()[2] is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + size, side="right")) - 1)
        yield lo, hi, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_P = np.uint64(0x9E3779B97F4A7C15)
_PINV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POW: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "p" not in _POW or len(_POW["p"]) < n:
        m = max(n, CHUNK_BYTES + 65536)
        for key, base in (("p", _P), ("q", _PINV)):
            a = np.full(m, base, np.uint64)
            a[0] = 1
            _POW[key] = np.multiply.accumulate(a)
    return _POW["p"][:n], _POW["q"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (two multiply-xorshift rounds)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def word_spans(data: np.ndarray, off: np.ndarray, inside: np.ndarray = ~_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """First and last + 1 byte of each word, texts apart: a run of bytes for
    which ``inside`` holds, ``[^\\x20\\x09-\\x0D]+`` if not given."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z
    word = inside[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    before = np.empty(len(data), bool)
    before[0] = False
    before[1:] = word[:-1]
    after = np.empty(len(data), bool)
    after[-1] = False
    after[:-1] = word[1:]
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    return starts, ends


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span, by prefix sums of byte * p^position."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    p, q = _powers(len(data))
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * p, out=total[1:])
    h = (total[ends] - total[starts]) * q[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


_TURNS = [np.uint64(pow(0xC2B2AE3D27D4EB4F, k + 1, 1 << 64)) for k in range(64)]


def shingle_sets(col: pa.Array, k: int = 5) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct 64-bit shingle hashes) of every text: k words,
    A-Z lower-cased; fewer words are one shingle; no words, no shingle."""
    for lo, hi, raw, off in byte_runs(col):
        data = _LOWER[raw]
        starts, ends = word_spans(data, off)
        wh = word_hashes(data, starts, ends)
        first = np.searchsorted(starts, off)
        m = len(wh) - k + 1
        sh = np.zeros(0, np.uint64)
        if m > 0:
            sh = np.zeros(m, np.uint64)
            for j in range(k):
                sh += wh[j:j + m] * _TURNS[j]
            sh = mix(sh)
        for r in range(hi - lo):
            a, b = first[r], first[r + 1]
            if b - a >= k:
                s = np.sort(sh[a:b - k + 1])
                keep = np.empty(len(s), bool)
                keep[0] = True
                np.not_equal(s[1:], s[:-1], out=keep[1:])
                yield lo + r, s[keep]
            elif b > a:
                h = np.uint64(int(b - a) * 0x51_7C_C1_B7)
                with np.errstate(over="ignore"):
                    for j in range(b - a):
                        h = h + wh[a + j] * _TURNS[j + 8]
                yield lo + r, mix(np.array([h], np.uint64))
            else:
                yield lo + r, np.zeros(0, np.uint64)
