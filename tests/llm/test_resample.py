"""Importance resampling against plain dictionaries of word runs."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np

from lodestar.llm import queries, resample

SMALL = "/root/testdata/sf0.001"
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def buckets(text):
    w = words(text)
    return Counter(zlib.crc32(" ".join(w[i:i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(w) - k + 1))


def plain(docs, target):
    per = [buckets(t) for _, t in docs]
    s, t = Counter(), Counter()
    for c in per:
        s.update(c)
    for x in target:
        t.update(buckets(x))
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in range(10000)]
    rows = []
    for (i, text), c in zip(docs, per):
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(n * gain[b] for b, n in c.items())
        rows.append([i, sum(c.values()), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words(text))])
    able = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0], r[1]))
    for k, r in enumerate(able[:5 * len(able) // 100]):
        r[4] = k + 1
    return sorted(map(tuple, rows), key=str)


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    got = sorted((tuple(r) for r in queries.QUERIES["op12_bit_sliced_resampling"](spark, SMALL).collect()), key=str)
    assert got == plain(docs, target) and any(r[4] for r in got)


def test_odd_rows(spark):
    rng = np.random.default_rng(4)
    some = [(int(i), " ".join(f"w{x}" for x in rng.integers(0, 50, 30))) for i in range(60)]
    odd = [(100, None), (101, ""), (102, " \n-/ "), (103, "One TWO three-four é日本 9a"), (104, "x" * 3000 + " y" * 30), (105, "日本語" * 200 + " a b"),
           (106, "É" * 30 + " é " * 25), (107, "the same " * 40000), (7, some[7][1]), (7, some[7][1]), (None, some[9][1]), (None, None)]
    target = ["w1 w2 w3", None, "", "w4 w5 é"]
    df = spark.createDataFrame([(*r, 1) for r in some + odd], "doc_id long, text string, weight int")
    tg = spark.createDataFrame([(t,) for t in target], "text string")
    got = sorted((tuple(r) for r in resample.resample(df, tg).collect()), key=str)
    assert got == plain(some + odd, target)
    assert resample.resample(df.limit(0), tg).count() == 0
    assert sorted((tuple(r) for r in resample.resample(df, tg.limit(0)).collect()), key=str) == plain(some + odd, [])


def test_bit_sliced_sums_are_exact():
    rng = np.random.default_rng(5)
    for low, high in ((-30000, 30000), (0, 5), (-7, 0), (0, 1), (-1, 0)):
        g = rng.integers(low, high, resample.BUCKETS)
        m = rng.integers(0, 3, size=(9, resample.BUCKETS)).astype(np.uint32)
        m[0], m[1, 17] = 0, 40_000_000
        assert (resample.bit_sliced(m, resample.gain_planes(g)) == m.astype(np.int64) @ g).all()


def test_ranks_of_ties_and_many_ranges(spark):
    rows = spark.range(5000).selectExpr("id as doc_id", "cast(id % 3 as long) as score")
    path = resample.written(rows, "test-ranks")
    got = {r.doc_id: r["rank"] for r in resample.ranked(path, [resample.F.col("score").desc(), "doc_id"]).collect()}
    want = sorted(range(5000), key=lambda i: (-(i % 3), i))
    assert got == {i: k + 1 for k, i in enumerate(want)}
