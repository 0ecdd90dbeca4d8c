"""Near-duplicates, vectors, search and the pipeline against brute force."""

import numpy as np
import pytest

import corpus_pipeline
from lodestar.llm import capfilter, oph, queries, threshold
from lodestar.llm.components import components

SMALL = "/root/testdata/sf0.001"


def groups(n, links):
    root = list(range(n))
    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def shingles(text):
    w = (text or "").translate({c: c + 32 for c in range(65, 91)})
    import re
    w = re.findall(r"[^\x20\x09-\x0D]+", w)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_components_equal_union_find(spark):
    rng = np.random.default_rng(1)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, int(x)) for x in range(101, 160)] + [tuple(map(int, rng.integers(160, 260, 2))) for _ in range(60)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = groups(260, links)
    assert got == {i: want[i] for i in {x for p in links for x in p if p[0] != p[1]}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_near(texts):
    s = [shingles(t) for t in texts]
    links = [(i, j) for i in range(len(s)) for j in range(i) if s[i] and s[j] and 100 * len(s[i] & s[j]) >= 75 * len(s[i] | s[j])]
    return s, groups(len(s), links)


def test_near_duplicates_odd_rows(spark):
    base = [f"w{i}" for i in range(40)]
    texts = [None, "", " \n\t", "one two", "ONE  two", "one two three", " ".join(base), " ".join(base[:36] + ["x"] * 4), " ".join(base[:38]),
             " ".join(base[::-1]), "é " * 9, "É " * 9, "long " * 50000] + [" ".join(base[:20])] * 5
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, cls string")
    got = {r.doc_id: r for r in oph.near_duplicates(df).collect()}
    s, comp = plain_near(texts)
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {i: (len(s[i]), comp[i], comp[i] == i) for i in range(len(texts))}
    assert oph.near_duplicates(df.limit(0)).count() == 0
    twice = spark.createDataFrame([(None, "a b c"), (5, "a b c"), (5, "a b c"), (None, "")], "doc_id long, text string")
    assert sorted((r.component_id or -1, r.kept) for r in oph.near_duplicates(twice).collect()) == [(-1, True), (5, False), (5, True), (5, True)]


def test_copies_around_a_hub_are_one_group(spark):
    rng = np.random.default_rng(8)
    base, texts = [f"a{i}" for i in range(120)], []
    for _ in range(150):        # each copy is near the first text, most are not near each other
        w = list(base)
        for at in rng.choice(24, 3, replace=False):
            w[at * 5] = f"z{rng.integers(10**9)}"
        texts.append(" ".join(w))
    texts = [" ".join(base)] + texts
    got = {r.doc_id: r.component_id for r in oph.near_duplicates(
        spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    _, comp = plain_near(texts)
    assert got == dict(enumerate(comp))


def test_family_without_a_hub(spark):
    # one template; only the two texts of a pair reach 0.75 (101 of 133), all others stay below it (100 of 134)
    base = [f"a{i}" for i in range(104)]
    texts = [" ".join(base + [f"s{r // 2}"] + [f"p{r}x{j}" for j in range(16)]) for r in range(160)]
    got = {r.doc_id: r.component_id for r in oph.near_duplicates(
        spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    _, comp = plain_near(texts)
    assert comp == [r - r % 2 for r in range(160)] and got == dict(enumerate(comp))


def test_op2_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    s, comp = plain_near([d.text for d in docs])
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in queries.QUERIES["op2_minhash_dedup"](spark, SMALL).collect()}
    assert got == {d.doc_id: (len(s[i]), docs[comp[i]].doc_id, comp[i] == i) for i, d in enumerate(docs)}


def test_vectors_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (1, [2.0, 0.0], 1), (2, [1.0, 0.05], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [], 1),
            (7, [0.0, -0.0], 1), (8, [nan, 1.0], 1), (9, [inf, 1.0], 1), (10, [None, 1.0], 1), (11, [-1.0, 0.0], 1), (12, [1.0, 0.0, 0.0], 1),
            (13, [1.0, -0.0], 1), (None, [0.0, 1.0], 3), (20, [1e-200, 1.0], 3), (21, [3e300, 3e300], 4), (22, [1e300, 1e300], 4)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<double>, label int, cls int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in capfilter.near_vectors(df).collect()}
    assert {k: got[k] for k in (0, 1, 2, 13)} == {0: (3, 0, True), 1: (3, 0, False), 2: (3, 0, False), 13: (3, 0, False)}
    assert all(got[k] == (0, k, True) for k in (3, 4, 5, 6, 7, 8, 9, 10, 11, 12))
    assert got[None] == (1, 20, False) and got[20] == (1, 20, True)
    assert capfilter.near_vectors(df.limit(0)).count() == 0


def test_vectors_of_a_large_group_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(capfilter, "CELL", 16)
    rng = np.random.default_rng(5)
    c = rng.normal(size=32)
    x = np.concatenate([c + 0.08 * rng.normal(size=(150, 32)), rng.normal(size=(100, 32))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = x @ x.T >= 0.98
    df = spark.createDataFrame([(i, [float(a) for a in v], 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r.n_links for r in capfilter.near_vectors(df).collect()}
    assert sum(got.values()) >= 0.97 * (want.sum() - len(x)) and all(got[i] <= want[i].sum() - 1 for i in got)


def test_op1_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").orderBy("vec_id").collect()
    x = np.array([r.embedding for r in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    lab = np.array([r.label for r in rows])
    near = (x @ x.T >= 0.98) & (lab[:, None] == lab[None]) & ~np.eye(len(x), dtype=bool)
    comp = groups(len(x), np.argwhere(near))
    got = {r.vec_id: (r.n_links, r.component_id) for r in queries.QUERIES["op1_cap_filter_dedup"](spark, SMALL).collect()}
    assert got == {r.vec_id: (int(near[i].sum()), rows[comp[i]].vec_id) for i, r in enumerate(rows)}


@pytest.mark.parametrize("blocks", [1024, 7])
def test_top_k_equals_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(threshold, "ROWS", blocks)
    monkeypatch.setattr(threshold, "QUERIES", blocks)
    rng = np.random.default_rng(3)
    v = rng.integers(-3, 4, size=(60, 6))
    v[5] = v[9] = 0
    rows = [(i, [int(a) for a in x]) for i, x in enumerate(v)] + [(60, None), (None, [1] * 6), (61, [1, None, 1, 1, 1, 1]), (62, [1, 2]), (3, [int(a) for a in v[3]])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "id long, v array<long>, key int")
    got = {}
    for r in threshold.top_k(df.where("id % 5 = 0"), df, 4).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = {q: [(k + 1, j, s) for k, (s, j) in enumerate((-a, j) for a, j in sorted((-int(v[q] @ v[j]), j) for j in range(60) if j != q)[:4])]
            for q in range(0, 60, 5)}
    assert {q: sorted(x) for q, x in got.items()} == want
    assert threshold.top_k(df.limit(0), df, 4).count() == 0


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept, SMALL)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        ids = [r.doc_id for r in out.select("doc_id").collect()]
        assert len(ids) == len(set(ids)) and 0 < len(ids) <= kept.count()
        if name == "near_duplicates":
            before = kept.select("doc_id", "text").orderBy("doc_id").collect()
            _, comp = plain_near([r.text for r in before])
            assert sorted(ids) == sorted({before[c].doc_id for c in comp})
        if name == "secrets":
            assert sorted(ids) == sorted(r.doc_id for r in kept.select("doc_id").collect())
            assert not out.where("text rlike 'AKIA[0-9A-Z]{16}' or n_chars <> length(text)").count()
        kept = spark.createDataFrame(out.collect(), docs.schema)
    pieces = corpus_pipeline.run(spark, SMALL).collect()
    assert {r.doc_id for r in pieces} == set(ids)


def test_pipeline_odd_rows(spark):
    rows = [(None, None, "x", None), (1, "", "x", 0), (1, "a b c d e f", "y", 11), (1, "a b c d e f", "z", 11), (2, "w " * 30000, None, 60000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SMALL).count() == 0
        out = stage(spark, docs, SMALL)
        if name != "packing":
            assert out.columns == docs.columns
        if name == "near_duplicates":
            assert out.count() == 4
        elif name == "secrets":
            assert out.count() == 5


def test_pipeline_keeps_the_smallest_id_whatever_other_ids_are(spark):
    base = [" ".join(f"w{g}x{i}" for i in range(40)) for g in range(6)]
    rows = [(i, base[i % 6] + " end", "x") for i in range(30, 0, -1)]
    plain = spark.createDataFrame(rows, "doc_id long, text string, row string")
    odd = spark.createDataFrame([(None, base[2] + " end", "x"), (None, "alone", "x"), (7, base[0], "first"), (7, base[1] + " end", "x"), *rows],
                                "doc_id long, text string, row string")
    kept = lambda d: sorted((r.doc_id if r.doc_id is not None else -1, r.row) for r in corpus_pipeline.one_of_each(spark, d, SMALL).collect())
    assert kept(plain) == [(i, "x") for i in range(1, 7)]
    assert kept(odd) == [(-1, "x")] + kept(plain)


def test_second_pass_meets_few_pairs(spark):
    # 300 texts on one template, each with enough of its own that no two reach the bound
    base = [f"a{i}" for i in range(100)]
    texts = [" ".join(base + [f"p{r}x{j}" for j in range(30)]) for r in range(300)]
    sets = spark.createDataFrame([(r, [hash(" ".join(t.split()[i:i + 5])) for i in range(126)]) for r, t in enumerate(texts)], "cls long, elems array<long>")
    members = spark.createDataFrame([(0, 1, r, 300) for r in range(300)], "band int, bucket long, cls long, size long")
    none = spark.createDataFrame([], "node long, component long")
    assert oph._rest(members, sets, none, 75).count() == 0      # 44,850 pairs share the bucket
    assert oph._rest(members, sets, none, 50).count() == 44850
