"""Part codes: the trie walk and the whole operator against plain loops."""

import hashlib

import numpy as np
import pytest

from lodestar.llm import partcode


@pytest.mark.parametrize("leaves", [1, 7, 2048])
def test_walk_equals_all_distances(monkeypatch, leaves):
    monkeypatch.setattr(partcode, "LEAVES", leaves)
    rng = np.random.default_rng(leaves)
    for width in (1, 2, 4):
        parts = rng.integers(-4, 5, size=(900, width))
        book = rng.integers(-4, 5, size=(9, width))
        s, copies, place = partcode.distinct_parts(parts)
        assert (s[place] == parts).all() and copies.sum() == 900 and len({tuple(r) for r in parts}) == len(s)
        code, dist = partcode.walk(s, book)
        all_ = ((s[:, None, :] - book[None]) ** 2).sum(axis=2)
        assert (code == all_.argmin(axis=1)).all() and (dist == all_.min(axis=1)).all()
    empty = np.zeros((0, 3), np.int64)
    assert [len(a) for a in partcode.walk(empty, np.zeros((2, 3), np.int64))] == [0, 0]


def plain(rows, parts, entries, rounds):
    """(vec_id, label, vector) rows that all count, coded by loops over Python integers."""
    cap = partcode.LIMIT
    x = [(i, lab, [int(min(max(np.floor(256 * float(e)), -cap), cap)) for e in v]) for i, lab, v in rows]
    x.sort(key=lambda r: (r[0] is None, r[0], r[2]))
    w = len(x[0][2]) // parts
    cut = lambda v, p: v[p * w:(p + 1) * w]
    books = [[cut(v, p) for _, _, v in x[:entries]] for p in range(parts)]

    def nearest(p, v):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), i) for i, e in enumerate(books[p]))
    for _ in range(rounds):
        for p in range(parts):
            got = {}
            for _, _, v in x:
                got.setdefault(nearest(p, cut(v, p))[1], []).append(cut(v, p))
            for e, vs in got.items():
                books[p][e] = [sum(c) // len(vs) for c in zip(*vs)]
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    out = []
    for i, lab, v in x:
        best = [nearest(p, cut(v, p)) for p in range(parts)]
        out.append([i, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best), lab])
    by = {}
    for r in out:
        by[r[3]] = by.get(r[3], 0) + r[2]
    return sorted(((r[0], r[1], r[2], by[r[3]], sha) for r in out), key=str)


def test_odd_rows_equal_plain_loops(spark):
    rng = np.random.default_rng(3)
    nan, inf = float("nan"), float("inf")
    good = [(int(i), int(rng.integers(0, 3)), [float(e) for e in rng.normal(size=8)]) for i in range(40)]
    good += [(7, None, good[3][2]), (None, None, good[5][2]), (7, 1, [1e300, -1e300] * 4), (90, 2, [0.0] * 8), (91, 2, [0.0] * 8)]
    bad = [(-5, 1, None), (-4, 1, []), (-3, 1, [nan] + [0.0] * 7), (-2, 1, [inf] * 8), (-1, 1, [None] * 8), (200, 1, [1.0] * 16), (201, 1, [1.0] * 6)]
    df = spark.createDataFrame([(*r, "x") for r in good + bad], "vec_id long, label int, embedding array<double>, code string")
    got = sorted((tuple(r) for r in partcode.compress(df, parts=4, entries=6).collect()), key=str)
    assert got == plain(good, 4, 6, 2)
    assert partcode.compress(df.limit(0)).columns == partcode.compress(df, 4, 6).columns
    assert partcode.compress(df.limit(0)).count() == 0 and partcode.compress(df.where("vec_id = -5")).count() == 0


def test_fewer_vectors_than_entries(spark):
    rows = [(1, None, [1.0, 2.0]), (2, 5, [1.0, 2.0]), (3, 5, [-1.0, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    got = sorted((tuple(r) for r in partcode.compress(df, parts=2).collect()), key=str)
    assert got == plain(rows, 2, 64, 2) and {r[2] for r in got} == {0}
