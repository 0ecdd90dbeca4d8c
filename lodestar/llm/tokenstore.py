"""Raw token-id files with a minimal perfect hash index.

A store is a folder of two Parquet tables, so any store that Spark can write
to can hold it:

``ids``    one row per chunk: shard, first (ids of the shard before the
           chunk), keys / copies / sizes of its documents, and the payload:
           the little-endian ids end to end (2 bytes each if the vocabulary
           allows, else 4).
``index``  one row per bucket of keys: a seed, a displacement per small group
           of keys, and in slot order a fingerprint, shard, offset and size.

A key's hash names its bucket, its group's displacement gives its one slot,
the fingerprint tells unknown keys, and the slot says where the ids lie.
Nothing is searched and no key is stored in the index.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestar.llm.common import mix, text_array
from lodestar.llm.tokens import encoder

END_ID = 2
CHUNK_IDS = 1 << 20
BUCKET_KEYS = 2048
_CHUNKS = ("shard long, first long, keys array<long>, copies array<long>, sizes array<long>, width int, payload binary")
_INDEX = "bucket long, seed long, disp array<long>, fps array<long>, shards array<long>, firsts array<long>, sizes array<long>"
_FOUND = "doc_id long, copy long, shard long, first long, size long"


def _encode(path: str, end_id: int, width: int):
    kind = "<u2" if width == 2 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        shard, first, at = TaskContext.get().partitionId(), 0, 0
        enc = encoder(path, True)
        last, copy = (), 0
        keys, copies, sizes, parts = [], [], [], []

        def flush():
            return pa.RecordBatch.from_arrays(
                [pa.array([shard]), pa.array([first]), pa.array([keys], pa.list_(pa.int64())), pa.array([copies], pa.list_(pa.int64())),
                 pa.array([sizes], pa.list_(pa.int64())), pa.array([width], pa.int32()), pa.array([b"".join(parts)], pa.binary())],
                names=["shard", "first", "keys", "copies", "sizes", "width", "payload"])
        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            for lo, hi, ids, off in enc.runs(text_array(batch)):
                for r in range(hi - lo):
                    key = names[lo + r]
                    copy = copy + 1 if last == (key,) else 0
                    last = (key,)
                    doc = np.append(ids[off[r]:off[r + 1]], np.uint32(end_id)).astype(kind)
                    keys.append(key)
                    copies.append(copy)
                    sizes.append(len(doc))
                    parts.append(doc.tobytes())
                    at += len(doc)
                    if at - first >= CHUNK_IDS:
                        yield flush()
                        first = at
                        keys, copies, sizes, parts = [], [], [], []
        if keys:
            yield flush()
    return run


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Write (doc_id, text) in ascending doc_id order, one shard per range of ids."""
    from tokenizers import Tokenizer
    width = 2 if Tokenizer.from_file(tokenizer).get_vocab_size() <= 1 << 16 else 4
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ranged = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    ranged.mapInArrow(_encode(tokenizer, end_id, width), _CHUNKS).write.parquet(f"{path}/ids")


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunk headers to entries."""
    for batch in batches:
        n = np.diff(batch.column("keys").offsets.to_numpy())
        sizes = np.asarray(batch.column("sizes").flatten(), dtype=np.int64)
        end = np.cumsum(sizes)
        cut = np.concatenate([[0], np.cumsum(n)])
        base = np.repeat(np.concatenate([[0], end])[cut[:-1]], n)
        first = np.repeat(batch.column("first").to_numpy(), n) + end - sizes - base
        yield pa.RecordBatch.from_arrays(
            [batch.column("keys").flatten(), batch.column("copies").flatten(),
             pa.array(np.repeat(batch.column("shard").to_numpy(), n)), pa.array(first), pa.array(sizes)],
            names=["doc_id", "copy", "shard", "first", "size"])


def entries(spark: SparkSession, path: str) -> DataFrame:
    """The stored documents: doc_id, copy (number among rows of one id), shard, first, size."""
    return spark.read.parquet(f"{path}/ids").select("shard", "first", "keys", "copies", "sizes").mapInArrow(_listed, _FOUND)


# ---- the minimal perfect hash --------------------------------------------

def _parts(h: np.ndarray, m: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Group, two slot terms and fingerprint of key hashes in a bucket of m keys."""
    u = mix(h.view(np.uint64) + np.array([seed], np.uint64))
    groups = np.uint64(max(1, -(-m // 4)))
    a, b = mix(u + np.uint64(0x1F83D9ABFB41BD6B)), mix(u ^ np.uint64(0x5BE0CD19137E2179))
    return ((a >> np.uint64(32)) % groups).astype(np.int64), ((a & np.uint64(0xFFFFFFFF)) % np.uint64(m)).astype(np.int64), \
        ((b >> np.uint64(32)) % np.uint64(m)).astype(np.int64), (b & np.uint64(0x7FFFFFFF)).astype(np.int64)


def _try_slots(h: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray] | None:
    m = len(h)
    group, f1, f2, _ = _parts(h, m, seed)
    members: dict[int, list[int]] = {}
    for i, g in enumerate(group.tolist()):
        members.setdefault(g, []).append(i)
    disp, slot, free = np.zeros(max(1, -(-m // 4)), np.int64), np.zeros(m, np.int64), bytearray(b"\1") * m
    p, q = f1.tolist(), f2.tolist()
    rest = 0
    for g, keys in sorted(members.items(), key=lambda x: (-len(x[1]), x[0])):
        if len(keys) == 1:      # one key: straight to the next free slot
            while not free[rest]:
                rest += 1
            got, d = [rest], (rest - p[keys[0]]) % m
        else:
            for d in range(min(m * m, 40 * m)):
                d0, d1 = divmod(d, m)
                got = [(p[k] + d0 * q[k] + d1) % m for k in keys]
                if len(set(got)) == len(got) and all(free[s] for s in got):
                    break
            else:
                return None
        disp[g] = d
        for k, s in zip(keys, got):
            slot[k] = s
            free[s] = 0
    return disp, slot


def build_slots(h: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """(seed, displacement of each group, slot of each key) with every slot of
    0..m-1 taken once; key hashes must differ."""
    if len(np.unique(h)) < len(h):
        raise ValueError("two keys have the same hash")
    seed = 0
    while (got := _try_slots(h, seed)) is None:
        seed += 1
    return seed, *got


def find_slots(h: np.ndarray, seed: int, disp: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """(slot, fingerprint) of key hashes."""
    group, f1, f2, fp = _parts(h, m, seed)
    d0, d1 = np.divmod(disp[group], m)
    return (f1 + d0 * f2 + d1) % m, fp


def _build(t: pa.Table) -> pa.Table:
    h = t.column("h").to_numpy()
    seed, disp, slot = build_slots(h)
    order = np.argsort(slot)
    fp = _parts(h, len(h), seed)[3]
    col = lambda n: [t.column(n).to_numpy()[order].tolist()]
    return pa.table({"bucket": pa.array([t.column("bucket")[0].as_py()], pa.int64()),
                     "seed": pa.array([seed], pa.int64()), "disp": pa.array([disp.tolist()], pa.list_(pa.int64())), "fps": pa.array([fp[order].tolist()], pa.list_(pa.int64())),
                     "shards": pa.array(col("shard"), pa.list_(pa.int64())), "firsts": pa.array(col("first"), pa.list_(pa.int64())),
                     "sizes": pa.array(col("size"), pa.list_(pa.int64()))})


def _look(keys: pa.Table, index: pa.Table) -> pa.Table:
    n, none = len(keys), len(index) == 0
    out = {"doc_id": keys.column("doc_id"), "copy": keys.column("copy")}
    if not n or none:
        empty = keys.slice(0, 0)
        return pa.table({"doc_id": empty.column("doc_id"), "copy": empty.column("copy"),
                         **{c: pa.array([], pa.int64()) for c in ("shard", "first", "size")}})
    row = {c: np.asarray(index.column(c)[0].values) for c in ("disp", "fps", "shards", "firsts", "sizes")}
    slot, fp = find_slots(keys.column("h").to_numpy(), index.column("seed")[0].as_py(), row["disp"], len(row["fps"]))
    ok = row["fps"][slot] == fp
    out |= {"shard": pa.array(row["shards"][slot]), "first": pa.array(row["firsts"][slot]), "size": pa.array(row["sizes"][slot])}
    return pa.table(out).filter(pa.array(ok))


def _hashed(keys: DataFrame, buckets: int) -> DataFrame:
    return keys.withColumn("h", F.xxhash64("doc_id", "copy")).withColumn("bucket", F.pmod(F.xxhash64("h"), F.lit(buckets)).cast("long"))


def write_index(spark: SparkSession, path: str) -> None:
    """Build the index of a store whose ids are written."""
    found = entries(spark, path)
    n = spark.read.parquet(f"{path}/ids").agg(F.sum(F.size("keys"))).first()[0] or 0
    buckets = max(1, -(-n // BUCKET_KEYS))
    built = _hashed(found, buckets).groupBy("bucket").applyInArrow(_build, _INDEX)
    built.withColumn("buckets", F.lit(buckets).cast("long")).write.parquet(f"{path}/index")


def lookup(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """``keys`` (doc_id, copy) to (doc_id, copy, shard, first, size); keys
    that the store doesn't hold give no row (a fingerprint of 31 bits lets
    one unknown key in two billion through)."""
    index = spark.read.parquet(f"{path}/index")
    top = index.select("buckets").limit(1).collect()
    h = _hashed(keys.select("doc_id", F.col("copy").cast("long").alias("copy")), top[0][0] if top else 1)
    return h.groupBy("bucket").cogroup(index.drop("buckets").groupBy("bucket")).applyInArrow(_look, _FOUND)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks to (shard, first, size, ids_crc32) of their documents."""
    for batch in batches:
        for row in range(len(batch)):
            width, data = batch.column("width")[row].as_py(), batch.column("payload")[row].as_buffer()
            ids = np.frombuffer(data, "<u2" if width == 2 else "<u4").astype("<u4")
            sizes = np.asarray(batch.column("sizes")[row].values)
            end = np.cumsum(sizes)
            crc = [zlib.crc32(ids[e - n:e].tobytes()) for e, n in zip(end.tolist(), sizes.tolist())]
            k = len(sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(k, batch.column("shard")[row].as_py())), pa.array(batch.column("first")[row].as_py() + end - sizes),
                 pa.array(sizes), pa.array(crc, pa.int64())], names=["shard", "first", "size", "ids_crc32"])


def digest(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of ``keys`` read back from a store."""
    ids = spark.read.parquet(f"{path}/ids")
    per = ids.select("shard", F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x).alias("n")).groupBy("shard").agg(F.sum("n").alias("n"))
    w = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)     # one row per shard
    base = per.withColumn("base", F.coalesce(F.sum("n").over(w), F.lit(0))).select("shard", "base")
    crc = ids.select("shard", "first", "sizes", "width", "payload").mapInArrow(_read, "shard long, first long, size long, ids_crc32 long")
    at = lookup(spark, path, keys).join(base, "shard")
    return at.join(crc, ["shard", "first", "size"]).select(
        "doc_id", (F.col("base") + F.col("first")).alias("start"), F.col("size").alias("n_tokens"), "ids_crc32")


def store(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Write ids and index of ``docs`` (doc_id, text) to ``path``.

    Null and empty texts hold the end id alone.  A null doc_id sorts first; rows
    that share a doc_id are told apart by their number in the store (``copy``).
    An empty table gives a store without rows.
    """
    write_ids(docs, path, tokenizer, end_id)
    write_index(docs.sparkSession, path)
