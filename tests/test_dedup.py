"""De-duplication: the five-item fixture, the order fixture, and the full
plan against the sequential rule on the sf0.001 batch."""

from pyspark.sql import functions as F

import seqref
from conftest import SF_SMALL
from lodestar.operators import dedup
from lodestar.plans.queries_dedup import batch_and_pool

FIX = [
    (1, "Global Scholars Program 2026", "https://globalscholars.org/program-2026"),
    (2, "Global Scholars Program 2026", "https://globalscholars.org/program-2026"),
    (3, "Global Scholars Program 2027", "https://opportunitiesforstudents.com/global-scholars"),
    (4, "UN Youth Internship Programme 2026", "https://un.org/internships/youth-2026"),
    (5, "Fulbright Foreign Student Program 2026", "https://fulbright.edu/foreign-student-2026"),
]


def _run(spark, items, pool=()):
    b = spark.createDataFrame(items, "item_order long, title string, source_url string")
    p = spark.createDataFrame(list(pool), "pool_order long, title string, source_url string")
    return {r.item_order: r for r in dedup.dedup_batch(b, p).collect()}


def test_five_item_fixture(spark):
    out = _run(spark, FIX)
    assert [out[i].is_unique for i in range(1, 6)] == [True, False, False, True, True]
    assert (out[2].match_type, out[2].score, out[2].matched_title) == ("hash", 100, FIX[0][1])
    assert (out[3].match_type, out[3].score, out[3].matched_title) == ("fuzzy", 100, FIX[0][1])
    b = spark.createDataFrame(FIX, "item_order long, title string, source_url string")
    p = spark.createDataFrame([], "pool_order long, title string, source_url string")
    st = dedup.dedup_stats(dedup.dedup_batch(b, p)).first()
    assert (st.total, st.unique_count, st.hash_duplicates, st.fuzzy_duplicates) == (5, 3, 1, 1)


def test_order_is_sequential_not_components(spark):
    # A~B and B~C score ≥ 85, A~C does not: A and C unique, B duplicate.
    a = "abcdefghijklmnopqrst"
    b, c = a + "uvw", a + "uvwxyz12"
    assert seqref.token_sort_ratio(a, b) >= 85 and seqref.token_sort_ratio(b, c) >= 85
    assert seqref.token_sort_ratio(a, c) < 85
    out = _run(spark, [(1, a, "u1"), (2, b, "u2"), (3, c, "u3")])
    assert (out[1].is_unique, out[2].is_unique, out[3].is_unique) == (True, False, True)


def test_stored_records_win_ties(spark):
    out = _run(spark, [(1, "Alpha Prize", "u1"), (2, "Alpha Prize", "u2")], [(0, "alpha prize!", "p0")])
    assert not out[1].is_unique and out[1].matched_title == "alpha prize!"
    assert not out[2].is_unique and out[2].matched_title == "alpha prize!"


def test_plan_matches_sequential_rule(spark):
    b, p = batch_and_pool(spark, SF_SMALL)
    got = {r.item_order: (r.is_unique, r.match_type, r.matched_title, r.score)
           for r in dedup.dedup_batch(b, p).collect()}
    items = sorted((r.item_order, r.title, r.source_url) for r in b.collect())
    pool = [(r.title, r.source_url) for r in sorted(p.collect(), key=lambda r: r.pool_order)]
    assert got == seqref.dedup(items, pool)


def test_no_cartesian_product(spark):
    b, p = batch_and_pool(spark, SF_SMALL)
    bk = dedup.with_keys(b).select("fkey").distinct()
    pk = dedup.with_keys(p).select("fkey").distinct()
    plan = dedup.fuzzy_edges(bk, pk)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_shuffled_band_join_matches_rule(spark, monkeypatch):
    """Bands dealt into many blocks give the same classification."""
    monkeypatch.setattr(dedup, "BLOCK_KEYS", 3)
    b, p = batch_and_pool(spark, SF_SMALL)
    got = {r.item_order: (r.is_unique, r.match_type, r.matched_title, r.score)
           for r in dedup.dedup_batch(b, p).collect()}
    items = sorted((r.item_order, r.title, r.source_url) for r in b.collect())
    pool = [(r.title, r.source_url) for r in sorted(p.collect(), key=lambda r: r.pool_order)]
    assert got == seqref.dedup(items, pool)


def test_fuzzy_edges_equal_brute_force(spark):
    """Every key pair scoring ≥ 85 (all pairs, by brute force) is an edge, and
    nothing else is: the band join and both bounds lose nothing."""
    from lodestar.functions import fuzzy as fz
    b, p = batch_and_pool(spark, SF_SMALL)
    bk = [r.fkey for r in dedup.with_keys(b).where(F.col("fkey") != "").select("fkey").distinct().collect()]
    pk = [r.fkey for r in dedup.with_keys(p).where(F.col("fkey") != "").select("fkey").distinct().collect()]
    bset, pset = set(bk), set(pk)
    want = set()
    for a in bset:
        for o in bset | pset:
            if a != o and (o not in bset or a < o) and fz.ratio(a, o) >= 85:
                want.add((a, o))
    bdf = spark.createDataFrame([(k,) for k in bk], "fkey string")
    pdf = spark.createDataFrame([(k,) for k in pk], "fkey string")
    got = {(r.bkey, r.okey) for r in dedup.fuzzy_edges(bdf, pdf).collect()}
    assert got == want


def test_hot_key_batch_matches_rule(spark):
    """A third of the batch shares one title (and url pattern); another title
    repeats 50 times; the rest are near-copies: same answer as the loop."""
    import random as _r
    rnd = _r.Random(9)
    words = ["grant", "study", "fund", "award", "prize", "youth", "global", "science", "art", "lab"]
    items = []
    for i in range(300):
        if i % 3 == 0:
            t, u = "Global Youth Science Award 2026", f"https://a.org/{i % 2}"
        elif i % 6 == 1:
            t, u = "Open Arts Fund", "https://b.org/x"
        else:
            t = " ".join(rnd.choice(words) for _ in range(rnd.randint(2, 6)))
            u = f"https://c.org/{i}"
        items.append((i, t, u))
    pool = [(0, "global youth science award", "https://p.org/0"), (1, "Art Lab Prize", "https://p.org/1")]
    out = _run(spark, items, pool)
    ref = seqref.dedup(items, [(t, u) for _, t, u in pool])
    assert {k: (v.is_unique, v.match_type, v.matched_title, v.score) for k, v in out.items()} == ref


def _plain_rule(nodes, edges):
    before, unique = {}, {}
    for s, d in edges:
        before.setdefault(d, set()).add(s)
    for n, _ in sorted(nodes, key=lambda x: x[1]):
        unique[n] = not any(unique[s] for s in before.get(n, ()))
    return unique


def test_order_rule_on_a_long_chain(spark, monkeypatch):
    """10,000 near titles in a chain: no round per link; every other one is unique."""
    n = 10_000
    name = lambda i: f"t{(i * 7919) % n:05d}"  # noqa: E731   names and order disagree
    nodes = [(name(i), i) for i in range(n)] + [("alone", n)]
    edges = [(name(i), name(i + 1)) for i in range(n - 1)]
    rounds = []
    real = dedup._resolve_in_rounds
    monkeypatch.setattr(dedup, "_resolve_in_rounds", lambda nd, ed: rounds.append(ed.count()) or real(nd, ed))
    got = {r.node: r.unique for r in dedup.greedy_resolve(
        spark.createDataFrame(nodes, "node string, ord long"), spark.createDataFrame(edges, "src string, dst string")).collect()}
    assert got == _plain_rule(nodes, edges) and rounds == [0]


def test_order_rule_in_rounds_equals_components(spark, monkeypatch):
    import random
    rng = random.Random(3)
    order = rng.sample(range(300), 300)
    nodes = [(f"n{i}", order[i]) for i in range(300)]
    pairs = {tuple(sorted(rng.sample(range(300), 2), key=lambda i: order[i])) for _ in range(330)}
    edges = [(f"n{a}", f"n{b}") for a, b in pairs]
    nd, ed = spark.createDataFrame(nodes, "node string, ord long"), spark.createDataFrame(edges + edges[:9], "src string, dst string")
    want = _plain_rule(nodes, edges)
    for limit in (200_000, 5, 0):
        monkeypatch.setattr(dedup, "COMPONENT_EDGES", limit)
        assert {r.node: r.unique for r in dedup.greedy_resolve(nd, ed).collect()} == want
    assert dedup.greedy_resolve(nd, ed.limit(0)).where("unique").count() == 300


def test_order_of_a_component_may_be_a_struct(spark):
    # the ingest visits items in the order of (source, page); a null source comes first
    nodes = [("c", "s1", 2), ("a", "s1", 10), ("b", None, 7)]
    nd = spark.createDataFrame(nodes, "node string, s string, n long").select("node", F.struct("s", "n").alias("ord"))
    ed = spark.createDataFrame([("b", "c"), ("c", "a")], "src string, dst string")
    assert {r.node: r.unique for r in dedup.greedy_resolve(nd, ed).collect()} == {"b": True, "c": False, "a": True}


def test_texts_of_equal_letters_do_not_reach_the_kernel(spark):
    """Unrelated keys with the same letter counts pass every bound on counts;
    only those within the distance may be left for the kernel, and all of them."""
    import random
    from lodestar.functions import fuzzy as fz
    rnd = random.Random(5)
    letters = list("abcdefghijklmnopqrst" * 10 + " " * 40)
    keys = []
    for _ in range(60):
        rnd.shuffle(letters)
        keys.append("".join(letters))
    for k in keys[:10]:
        chars = list(k)
        for _ in range(30):
            chars[rnd.randrange(len(chars))] = rnd.choice("abc_xyz0 é")
        keys.append("".join(chars))
    keys += ["", "a", "ab", "abc", "abcd", "abcdefg", "abcdefh"]
    want = {(a, b) for a in keys for b in keys if a < b and fz.ratio(a, b) >= 85}
    i, j = fz.near_places(keys, keys, lambda x, ys: [keys[x] < keys[y] for y in ys])
    near = {(keys[x], keys[y]) for x, y in zip(i, j)}
    assert want <= near and len(want) >= 10 and len(near) < 100
    df = spark.createDataFrame([(k,) for k in keys if k], "fkey string")
    got = {(r.a, r.b) for r in dedup.candidate_pairs(df, df.limit(0)).collect()}
    assert want <= got and len(got) < 100


def test_a_stored_key_meets_only_what_rounds_to_100(spark, monkeypatch):
    """A batch key that is stored scores 100 with itself, so nothing else is
    compared with it but stored keys that round to 100 and may be earlier."""
    long = "abcdefghi klmno " * 14
    items = [(1, long, "u1"), (2, "Open Arts Fund", "u2"), (3, "Open Arts Funds", "u3"), (4, "Brand New Prize", "u4"), (5, "Brand New Prizes", "u5")]
    pool = [(0, long + "x", "p0"), (1, long, "p1"), (2, "open arts fund", "p2"), (3, "open art fund", "p3")]
    calls = []
    real = dedup.fuzzy_edges
    monkeypatch.setattr(dedup, "fuzzy_edges", lambda b, p, *a, **k: calls.append((b.count(), a, k)) or real(b, p, *a, **k))
    got = {k: (v.is_unique, v.match_type, v.matched_title, v.score) for k, v in _run(spark, items, pool).items()}
    assert got == seqref.dedup(items, [(t, u) for _, t, u in pool])
    assert got[1] == (False, "fuzzy", long + "x", 100) and got[2][2] == "open arts fund"
    assert calls == [(3, (), {"among": True}), (2, (100,), {"among": False})]
    b = spark.createDataFrame(items, "item_order long, title string, source_url string")
    p = spark.createDataFrame(pool, "pool_order long, title string, source_url string")
    assert {r.item_order: (r.score, r.matched_title) for r in dedup.best_match(b, p).collect()} == {
        1: (100, long + "x"), 2: (100, "open arts fund"), 3: (97, "open arts fund")}


def test_bounds_of_long_and_short_keys_lose_nothing():
    """Keys of one to many mask words, a few far longer in one class than the
    rest, and letters beyond the alphabet; for both scores in use."""
    import random
    from lodestar.functions import fuzzy as fz
    rnd = random.Random(11)
    keys = []
    for size in (3, 40, 70, 180, 190, 600, 2100):
        for _ in range(12):
            k = "".join(rnd.choice("aabcdeeeeefghiinnnorsttt   zé9") for _ in range(size + rnd.randrange(3)))
            keys.append(k)
            for edits in (1, size // 20, size // 9):
                chars = list(k)
                for _ in range(edits):
                    chars[rnd.randrange(len(chars))] = rnd.choice(["", "z", "e", "zz"])
                keys.append("".join(chars))
        keys.append("z" * size)
    keys = list(dict.fromkeys(keys))
    for least in (85, 100):
        want = {(a, b) for a in keys for b in keys if a < b and abs(len(a) - len(b)) * 200 <= 31 * (len(a) + len(b)) and fz.ratio(a, b) >= least}
        i, j = fz.near_places(keys, keys, lambda x, ys: [keys[x] < keys[y] for y in ys], least)
        near = {(keys[x], keys[y]) for x, y in zip(i, j)}
        assert want and want <= near and len(near) <= len(want) + 60
