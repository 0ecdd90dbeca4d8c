"""Packing and the token store against plain encoding of every text."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lodestar.llm import packing, queries, tokenstore
from lodestar.llm.common import shared_path, tokenizer_file
from lodestar.llm.tokens import Encoder

SMALL = "/root/testdata/sf0.001"
ODD = ["", " ", "a  b", "x  y   z", " lead trail ", " \n\n a. b, c.. d.) e", "it's, they'll. don't.", "<|endoftext|> hi",
       "été. Ñandú, İstanbul ΣΑΣ. ß", "a.b.c, 1.5, 3.", "\tTab\r\nx\x1cy z", "é é. ño", "日本語 テスト。 12 34.",
       "a " * 5 + "b", "word ,x .y", "x.\ny", "x\n y", "\ny", "é\né", "a\n", "b\nc\n\nd", "emoji 😀 😀. a😀, b", "A   B C"]


def plain(name, texts):
    t = Tokenizer.from_file(tokenizer_file(name))
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("name,lead", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_encoder_equals_the_library(spark, name, lead):
    texts = ODD + [r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("text").collect()]
    enc, got = Encoder(tokenizer_file(name), lead), []
    for lo, hi, ids, off in enc.runs(pa.array(texts)):
        got += [ids[off[r]:off[r + 1]].tolist() for r in range(hi - lo)]
    assert got == plain(name, texts)


def check_packed(rows, docs, size, end_id):
    """Every id in one piece, pieces in place, sequences gapless."""
    by, seqs = {}, {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(by) == set(docs)
    for d, ids in docs.items():
        ids, at = ids + [end_id], 0
        for r in sorted(by[d], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids)) and r.length > 0
            at += r.length
            assert r.ids_crc32 == crc(ids[r.start:at])
        assert at == len(ids)
    for s in seqs.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= size
    return len(seqs)


def test_op4_packs_every_id_once_with_little_padding(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()}
    ids = dict(zip(docs, plain("word_bpe_49k.json", list(docs.values()))))
    n = check_packed(queries.QUERIES["op4_nnls_packing"](spark, SMALL).collect(), ids, 2048, 1)
    total = sum(len(x) + 1 for x in ids.values())
    assert n <= -(-total // 2048) + 1 + 0.01 * n


def test_packing_odd_rows_and_one_hot_length(spark):
    texts = [None, "", "word " * 3000] + ["same text " * 9] * 400
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, length string")
    got = packing.pack(df, tokenizer_file("word_bpe_49k.json"), size=64, end_id=1).collect()
    ids = dict(enumerate(plain("word_bpe_49k.json", [t or "" for t in texts])))
    n = check_packed(got, ids, 64, 1)
    assert n <= 1.02 * sum(len(x) + 1 for x in ids.values()) / 64 + 1
    assert packing.pack(df.limit(0), tokenizer_file("word_bpe_49k.json")).count() == 0
    twice = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (7, "x y"), (7, "z")], "doc_id long, text string")
    assert sorted(r.doc_tokens for r in packing.pack(twice, tokenizer_file("word_bpe_49k.json")).collect()) == [2, 3, 4, 4]


def test_plan_uses_the_histogram_up():
    rng = np.random.default_rng(3)
    hist = np.zeros(257, np.int64)
    hist[1:257] = rng.integers(0, 40, 256)
    x = packing.solve(packing.combinations(256), hist[:256].astype(float))
    combos = packing.combinations(256)
    used = sum(np.bincount(combos[:, k], x, 256) for k in range(3))
    assert abs(used[1:] - hist[1:256]).sum() < abs(hist[1:256]).sum() * 0.5
    assert (combos.sum(axis=1) == 256).all() and (x >= 0).all()


def test_op10_equals_plain_encoding(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()}
    want, at = {}, 0
    for d in sorted(docs):
        ids = plain("byte_bpe_50k.json", [docs[d]])[0] + [2]
        want[d] = (at, len(ids), crc(ids))
        at += len(ids)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.QUERIES["op10_perfect_hash_store"](spark, SMALL).collect()}
    assert got == want


def test_store_odd_rows_and_unknown_keys(spark):
    rows = [(5, None), (None, "x"), (3, ""), (5, "again"), (-1, "日本"), (None, None)]
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, shard int")
    path = shared_path(spark, "t")
    tokenstore.store(df, path, tokenizer_file("byte_bpe_50k.json"))
    e = tokenstore.entries(spark, path)
    got = tokenstore.digest(spark, path, e.select("doc_id", "copy")).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in got) == sorted((d is not None, d or 0) for d, _ in rows)
    unknown = spark.range(1000, 3000).select(F.col("id").alias("doc_id"), F.lit(0).alias("copy"))
    assert tokenstore.lookup(spark, path, unknown).count() == 0
    empty = shared_path(spark, "t")
    tokenstore.store(df.limit(0), empty, tokenizer_file("byte_bpe_50k.json"))
    assert tokenstore.digest(spark, empty, unknown).count() == 0


def test_slots_are_minimal_and_perfect():
    for m in (1, 2, 3, 7, 500, 3000):
        h = np.random.default_rng(m).integers(-2**63, 2**63 - 1, m)
        seed, disp, slot = tokenstore.build_slots(h)
        assert sorted(slot.tolist()) == list(range(m))
        assert (tokenstore.find_slots(h, seed, disp, m)[0] == slot).all()


@pytest.mark.parametrize("name, lead", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_remembered_pieces_are_arrays_and_may_be_forgotten(monkeypatch, name, lead):
    from lodestar.llm import tokens
    monkeypatch.setattr(tokens, "KNOWN_MAX", 40)
    enc, tok = Encoder(tokenizer_file(name), lead), Tokenizer.from_file(tokenizer_file(name))
    tok.encode_special_tokens = True
    for i in range(30):
        texts = [f"Word{i} the w{i % 7}x. same again, Größe {'ab' * (i % 5)}", "", "the same again", f"日本 {i}"]
        for lo, hi, ids, off in enc.runs(pa.array(texts)):
            got = [ids[off[r]:off[r + 1]].tolist() for r in range(hi - lo)]
            assert got == [tok.encode(t, add_special_tokens=False).ids for t in texts[lo:hi]]
        assert len(enc.known) == len(enc.start) == len(enc.size) == len(enc.met) <= 60
        assert isinstance(enc.known, np.ndarray) and (np.diff(enc.known) > 0).all()
