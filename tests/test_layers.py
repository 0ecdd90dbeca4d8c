"""The layered table against a plain one, and what a batch writes."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from lodestar.plans import layers
from lodestar.plans.state import Conflict, Store

SCHEMA = "slug string, n long"


def _size(root, folder):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(f"{root}/{folder}") for f in fs if f.endswith(".parquet"))


def _rows(df):
    return sorted((r["slug"], r["n"]) for r in df.collect())


def _base(spark, root, n):
    store = Store(spark, str(root))
    rows = spark.range(n).select(F.concat(F.lit("s"), "id").alias("slug"), F.col("id").alias("n"))
    return store, store.publish(store.snapshot(), layers.write_base(store, "t", rows, "slug"))


def test_layers_equal_a_plain_table(spark, tmp_path):
    store, state = _base(spark, tmp_path / "store", 300)
    want = {f"s{i}": i for i in range(300)}
    for k, batch in enumerate(([("s1", -1), ("new", 5)], [("s1", -2), ("s7", -7)], [])):
        state = store.publish(state, layers.write_changes(store, "t", spark.createDataFrame(batch, SCHEMA), state))
        want |= dict(batch)
        assert _rows(store.read("t")) == sorted(want.items()) and state.version("t") == k + 2
    some = layers.touched(spark.createDataFrame([("s1", 0), ("s2", 0)], SCHEMA), "slug")
    part = layers.read(store, "t", state, some)
    inside = {r["slug"] for r in store.read("t").where(layers.bucket_of("slug").isin(*some)).collect()}
    assert {r["slug"] for r in part.collect()} == inside and {"s1", "s2"} <= inside
    before = layers.parts("t", "b", state)
    after = layers.compact(store, "t", state)
    assert _rows(store.read("t")) == sorted(want.items()) and not layers.parts("t", "d", after)
    changed = {n for n, f in layers.parts("t", "b", after).items() if before.get(n) != f}
    hit = layers.touched(spark.createDataFrame([("s1", 0), ("s7", 0), ("new", 0)], SCHEMA), "slug")
    assert changed == {f"t#b{b:04d}" for b in hit}
    assert layers.compact(store, "t", after) == after
    assert _rows(store.read("t", state)) == sorted(want.items())        # the earlier state still reads


def test_bytes_grow_with_the_batch(spark, tmp_path):
    sizes = []
    for n in (1_000, 100_000):
        store, state = _base(spark, tmp_path / str(n), n)
        state = store.publish(state, layers.write_changes(store, "t", spark.createDataFrame([("s1", -1), ("s2", -2)], SCHEMA).coalesce(1), state))
        sizes.append(_size(store.root, layers.parts("t", "d", state)["t#d00000002"]))
        assert store.read("t").count() == n
    assert sizes[0] == sizes[1]


def test_two_writers_of_one_table(spark, tmp_path):
    store, state = _base(spark, tmp_path / "store", 10)
    one, two = (layers.write_changes(store, "t", spark.createDataFrame([(f"s{i}", -i)], SCHEMA), state) for i in (1, 2))
    store.publish(state, one)
    with pytest.raises(Conflict):
        store.publish(state, two)
    assert dict(_rows(store.read("t")))["s2"] == 2
