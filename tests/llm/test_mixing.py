"""Context mixing: counts, base scores and bit-by-bit probabilities against plain loops."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lodestar.llm import mixing, queries

SMALL = "/root/testdata/sf0.001"


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def trained(i):
    return i is None or zlib.crc32(str(i).encode()) % 7 != 2


def plain_base(docs):
    words = [[*tokens(t), None] for _, t in docs]
    c = Counter(w for (i, _), ws in zip(docs, words) if trained(i) for w in ws)
    n, v = sum(c.values()), len(c)
    return [(i, not trained(i), len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws))
            for (i, _), ws in zip(docs, words)]


def plain_events(text):
    b = b"\n" * mixing.ORDER + " ".join(tokens(text)).encode() + b"\n"
    return [(b[i - mixing.ORDER:i], b[i]) for i in range(mixing.ORDER, len(b))]


def plain_bits(model, past, byte):
    """Natural log of the probability of a byte, one bit and one counter at a time."""
    key = np.array([int.from_bytes(past, "big") << 8 | byte])
    ctx, place = mixing.contexts(key)
    total, node = 0.0, 1
    for j in range(7, -1, -1):
        bit, s = byte >> j & 1, []
        for k in range(mixing.INPUTS):
            at, mask = mixing.places(ctx[k], model.bits[k])
            s.append(int(model.tables[k][int(at[0]) ^ (int(mixing._NODE[node]) & mask)]))
        gate = int(model.gate(place, [np.array([x]) for x in s])[0])
        odds = sum(float(model.weights[gate, k]) * float(model.odds[k][s[k]]) for k in range(mixing.INPUTS)) + float(model.weights[gate, -1])
        odds = max(-8.0, min(8.0, odds))
        odds = (odds + float(model.map[node, int(mixing._cell(np.array([odds]))[0])])) / 2
        total -= math.log1p(math.exp(-odds if bit else odds))
        node = node * 2 | bit
    return total


@pytest.fixture(scope="module")
def model(spark):
    return mixing.fit(mixing.gather(spark.read.parquet(f"{SMALL}/documents.parquet")))


def test_query_on_the_small_table(spark, model):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: r for r in queries.QUERIES["op13_context_mixing_lm"](spark, SMALL).collect()}
    for i, held, n, known, total, base in plain_base(docs):
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total) and math.isclose(r.base_score, base, rel_tol=1e-9)
        assert r.score < 0 and math.isclose(r.bits_per_byte, -r.score * math.log2(10) / len(plain_events(dict(docs)[i])), rel_tol=1e-9)
    text = dict(docs)
    for i in sorted(text, key=lambda i: len(text[i] or ""))[:6]:
        want = sum(plain_bits(model, p, b) for p, b in plain_events(text[i])) / math.log(10)
        assert math.isclose(got[i].score, want, rel_tol=1e-4)
    held = [r for r in got.values() if r.held_out]
    order0 = Counter(b for i, t in docs if trained(i) for _, b in plain_events(t))
    n = sum(order0.values())
    plain = sum(math.log10((order0[b] + 1) / (n + 256)) for r in held for _, b in plain_events(text[r.doc_id]))
    assert sum(r.score for r in held) > 0.7 * plain        # far fewer bits than single bytes need


def test_probabilities_of_all_bytes_sum_to_one(model):
    for past in (b"\n\n\n\n\n", b"\n\n\nth", b"of th", b"qzx\xff\x00", "nd é".encode()):
        keys = np.array([int.from_bytes(past, "big") << 8 | b for b in range(256)])
        assert math.isclose((10 ** model.log10(keys)).sum(), 1.0, rel_tol=1e-5)


@pytest.mark.parametrize("slice_", [64, 1 << 22])
def test_events_are_those_of_the_token_bytes(monkeypatch, slice_):
    monkeypatch.setattr(mixing, "SLICE", slice_)
    texts = ["One  TWO\tthree", None, "", " \n ", "é日本 x", "a" * 700, " lead and trail  ", "b c " * 300]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
    got = {}
    for lo, _, stream, spans, row, toks in mixing._text_runs(batch):
        for r, e in mixing.event_slices(stream, spans):
            for x, k in zip(r, e):
                got.setdefault(lo + int(x), []).append((int(k >> 8).to_bytes(mixing.ORDER, "big"), int(k & 255)))
    assert got == {i: plain_events(t) for i, t in enumerate(texts)}


def test_counters_hold_all_events(model, spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    seen = Counter(e for i, t in docs if trained(i) for e in plain_events(t))
    counts = {r.key: r.n for r in mixing.gather(spark.createDataFrame(docs, "doc_id long, text string")).where("kind = 0").collect()}
    assert counts == {int.from_bytes(p, "big") << 8 | b: n for (p, b), n in seen.items()}
    # the first bit of the order-1 context of a blank: its counter's node is shared with nothing but hash collisions
    mine = sum(n for (p, b), n in seen.items() if p[-1] == 32)
    at, mask = mixing.places(mixing.contexts(np.array([32 << 8]))[0][0], model.bits[0])
    s = int(model.tables[0][int(at[0]) ^ (int(mixing._NODE[1]) & mask)])
    assert s & 255 == min(mine, 255)         # all bytes after a blank that matter here are below 128 or scaled with it


def test_remembered_events_have_the_same_probability(model, monkeypatch):
    monkeypatch.setattr(mixing, "CACHE", 300)
    rng, kept = np.random.default_rng(2), mixing.Remembered(model)
    for _ in range(6):
        events = np.unique(rng.integers(0, 900, 200)) * 257 + (1 << 30)
        rng.shuffle(events)
        assert np.array_equal(kept.log10(events), model.log10(events))


def test_states_keep_small_counts():
    n0, n1 = np.array([0, 3, 0, 1000, 1, 255]), np.array([0, 0, 9, 1, 100000, 255])
    s = mixing.states(n0, n1)
    assert [(int(x) & 255, int(x) >> 8) for x in s] == [(0, 0), (3, 0), (0, 9), (255, 1), (1, 255), (255, 255)]


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(mixing, "HOT", 3)       # most words go through the join
    rows = [(i, f"word{i % 5} and some word{i % 3}") for i in range(40)] + [
        (50, None), (51, ""), (52, " \t "), (53, "x" * 100000), (54, "the same " * 20000), (None, "and null"), (7, "again"), (7, "again"), (55, "日本 É é")]
    df = spark.createDataFrame([(i, t, 1.0, True) for i, t in rows], "doc_id long, text string, score double, held_out boolean")
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in mixing.language_scores(df).collect()), key=str)
    assert got == sorted(((*r[:5], round(r[5], 6)) for r in plain_base(rows)), key=str)
    assert mixing.language_scores(df.limit(0)).count() == 0
    only = mixing.language_scores(df.where("doc_id is not null and not (doc_id in (0))").where(~mixing.in_training()))
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0 and math.isclose(r.bits_per_byte, 8.0) for r in only.collect())
