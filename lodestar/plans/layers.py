"""A keyed table in layers: base folders, one per hash bucket of the key, and
small layers of changed rows.

A batch adds one layer that holds its changed rows only, so what is written
grows with the batch.  A reader takes the newest row of a key; the base is
only filtered by the layers' keys.  ``compact`` rewrites the buckets that the
layers touch and drops the layers.  All parts are entries of the store's
manifest (``table#b<bucket>``, ``table#d<version>``) beside an entry of the
table itself, which tells the key and counts versions, so that two writers of
one table still conflict.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 64
MAX_LAYERS = 8      # layers that a reader merges before the table is compacted
MARK = "layers:"    # the table's own entry: this and the key column


def bucket_of(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def is_layered(store, table: str, at) -> bool:
    return table in at.tables and at.tables[table][1].startswith(MARK)


def parts(table: str, kind: str, at) -> dict[str, str]:
    """Entry to folder, in order: base buckets (kind b) or layers (kind d)."""
    return {n: f for n, (_, f) in sorted(at.tables.items()) if n.startswith(f"{table}#{kind}")}


def write_base(store, table: str, df: DataFrame, key: str) -> dict[str, str]:
    """Write rows as base folders of their buckets; returns manifest entries."""
    folder = f"{table}/v-{uuid.uuid4().hex}"
    (df.withColumn("_bucket", bucket_of(key)).repartitionByRange("_bucket", key).sortWithinPartitions("_bucket", key)
     .write.partitionBy("_bucket").parquet(f"{store.root}/{folder}"))
    names = [n for n in store.names(folder) if n.startswith("_bucket=")]
    return {table: MARK + key} | {f"{table}#b{int(n[8:]):04d}": f"{folder}/{n}" for n in names}


def write_changes(store, table: str, changed: DataFrame, at) -> dict[str, str]:
    """Write changed rows (one per key, all columns) as the next layer."""
    folder = f"{table}/v-{uuid.uuid4().hex}"
    changed.write.parquet(f"{store.root}/{folder}")
    return {table: at.tables[table][1], f"{table}#d{at.version(table) + 1:08d}": folder}


def _key(table: str, at) -> str:
    return at.tables[table][1][len(MARK):]


def _layers(store, table: str, at) -> DataFrame | None:
    """The newest changed row of each key."""
    key, out = _key(table, at), None
    for n, folder in enumerate(parts(table, "d", at).values()):
        one = store.spark.read.parquet(f"{store.root}/{folder}").withColumn("_layer", F.lit(n))
        out = one if out is None else out.unionByName(one)
    if out is None:
        return None
    last = out.groupBy(key).agg(F.max("_layer").alias("_layer"))
    return out.join(last, [key, "_layer"], "left_semi").drop("_layer")


def read(store, table: str, at, buckets: list[int] | None = None) -> DataFrame | None:
    """The table of a state; with ``buckets`` only the rows of those."""
    key = _key(table, at)
    base = [f for n, f in parts(table, "b", at).items() if buckets is None or int(n.rpartition("#b")[2]) in buckets]
    layers = _layers(store, table, at)
    if layers is not None and buckets is not None:
        layers = layers.where(bucket_of(key).isin(*buckets))
    if not base:
        return layers
    stored = store.spark.read.parquet(*[f"{store.root}/{f}" for f in base])
    if layers is None:
        return stored
    return stored.join(layers.select(key), key, "left_anti").select(*stored.columns).unionByName(layers)


def touched(df: DataFrame, key: str) -> list[int]:
    """The buckets of a table's keys (at most ``BUCKETS`` numbers)."""
    return sorted(r["b"] for r in df.select(bucket_of(key).alias("b")).distinct().collect() if r["b"] is not None)


def compact(store, table: str, at=None):
    """Fold the layers into the buckets they touch; other buckets stay as
    they are.  Returns the new state, the given one if there are no layers."""
    at = at or store.snapshot()
    layers = _layers(store, table, at)
    if layers is None:
        return at
    key = _key(table, at)
    entries = write_base(store, table, read(store, table, at, touched(layers, key)), key)
    return store.publish(at, entries | dict.fromkeys(parts(table, "d", at)))
