"""Document quality by a linear-chain conditional random field over lines.

Every line has features of its own and of its two neighbours.  The field
labels lines good or bad; it is trained on a bounded sample of labelled
documents, whose lines carry the document's label.  A document's score is
the mean of its lines' forward-backward marginals, weighted by their length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm import common
from lodestar.llm.common import byte_runs, held_out, text_array, word_hashes, word_spans
from lodestar.llm.labelled import labelled_sample

PER_CLASS = 1500        # labelled documents of each class that are learned from
MAX_LINES = 400         # longer documents are not learned from (they are scored in full)
CUT = 0.7
_N = 14

_LETTERS = np.zeros(256, bool)
_LETTERS[65:91] = _LETTERS[97:123] = True
_LETTERS[128:] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_STOPS = np.zeros(256, bool)
_STOPS[[0x2C, 0x2E]] = True
_SIGN = np.zeros(256, bool)
_SIGN[33:127] = True
_SIGN &= ~(_LETTERS | _DIGIT | _STOPS)


def line_features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of each line, bytes of each line, first line of each text and the end)."""
    n = len(data)
    breaks = np.flatnonzero(data == 10) + 1
    row = np.searchsorted(off, breaks - 1, side="right") - 1          # the text that holds each line end
    starts = np.concatenate([off[:-1], breaks])
    owner = np.concatenate([np.arange(len(off) - 1), row])
    order = np.lexsort((starts, owner))
    starts, owner = starts[order], owner[order]
    first = np.searchsorted(owner, np.arange(len(off)))
    ends = np.empty(len(starts), np.int64)
    ends[:-1] = starts[1:] - 1
    last = first[1:] - 1
    ends[last] = off[1:]
    ends = np.maximum(ends, starts)
    size = ends - starts

    def share(table):
        c = np.concatenate([[0], np.cumsum(table[data])]) if n else np.zeros(1, np.int64)
        return (c[ends] - c[starts]) / np.maximum(size, 1)
    s, e = word_spans(data, off)
    h = word_hashes(common._LOWER[data], s, e) if n else np.zeros(0, np.uint64)
    at = np.searchsorted(starts, s, side="right") - 1                 # the line of each word
    # empty lines share their start with no word; a text's first line may share its start with an empty text before
    m = len(starts)
    words = np.bincount(at, minlength=m)
    some = np.maximum(words, 1)
    lengths = (e - s)

    def mean(x):
        return np.bincount(at, x, m) / some
    same = np.zeros(len(s))
    if len(s) > 1:
        same[1:] = (h[1:] == h[:-1]) & (at[1:] == at[:-1])
    kind = np.lexsort((h, at))
    fresh = np.ones(len(s))
    if len(s) > 1:
        hk, ak = h[kind], at[kind]
        fresh[1:] = (hk[1:] != hk[:-1]) | (ak[1:] != ak[:-1])
    distinct = np.bincount(at[kind], fresh, m) / some
    tail = _SIGN[data[e - 1]].astype(float) if len(s) else np.zeros(0)
    bare = (~_LETTERS[data[s]] & (lengths <= 2)).astype(float) if len(s) else np.zeros(0)
    caps = (_UPPER[data[s]] & _UPPER[data[np.minimum(s + 1, e - 1)]] & (lengths > 1)).astype(float) if len(s) else np.zeros(0)
    x = np.stack([np.log1p(size), share(_LETTERS), share(_DIGIT), share(_SIGN), share(_STOPS), share(_UPPER), np.log1p(words),
                  mean(np.minimum(lengths, 40)) / 10, np.where(words > 0, distinct, 1), mean(same), mean(tail), mean(bare), mean(caps),
                  mean((lengths <= 3).astype(float))], axis=1)
    return x, size, first


def with_neighbours(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Standardised features of a line, the one before and the one after, and
    marks for a missing neighbour and the bias."""
    m = len(x)
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:], after[:-1] = x[:-1], x[1:]
    begin, end = np.zeros(m, bool), np.zeros(m, bool)
    begin[first[:-1]] = True
    end[first[1:] - 1] = True
    before[begin] = 0
    after[end] = 0
    return np.concatenate([x, before, after, begin[:, None], end[:, None], np.ones((m, 1))], axis=1)


def marginals(score: np.ndarray, first: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """P(good) of every line, the summed pair marginals (2 x 2) and the log
    partition sum, for chains ``first[i]..first[i+1]`` with log potential
    ``score`` for good (bad: 0) and ``trans``."""
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    start, size = first[:-1][order], size[order]
    a = np.zeros((len(score), 2))
    b = np.zeros((len(score), 2))
    live = len(size)
    for t in range(int(size[0]) if len(size) else 0):
        live = int(np.searchsorted(-size, -t, side="left"))            # chains longer than t
        i = start[:live] + t
        if t == 0:
            a[i] = 0
        else:
            p = a[i - 1]
            a[i] = np.logaddexp(p[:, :1] + trans[0], p[:, 1:] + trans[1])
        a[i, 1] += score[i]
    for t in range((int(size[0]) if len(size) else 0) - 2, -1, -1):
        live = int(np.searchsorted(-size, -(t + 1), side="left"))      # chains with a line after t
        i = start[:live] + t
        nxt = b[i + 1].copy()
        nxt[:, 1] += score[i + 1]
        b[i] = np.logaddexp(trans[:, 0] + nxt[:, :1], trans[:, 1] + nxt[:, 1:])
    g = a + b
    z = np.logaddexp(g[:, 0], g[:, 1])
    good = np.exp(g[:, 1] - z)
    pair = np.zeros((2, 2))
    inner = np.ones(len(score), bool)
    inner[first[1:] - 1] = False
    i = np.flatnonzero(inner)
    for y in (0, 1):
        for w in (0, 1):
            pair[y, w] = np.exp(a[i, y] + trans[y, w] + b[i + 1, w] + w * score[i + 1] - z[i]).sum()
    return good, pair, float(z[first[:-1]].sum())


def train(x: np.ndarray, first: np.ndarray, y: np.ndarray, rounds: int = 160, ridge: float = 2e-3) -> dict[str, np.ndarray]:
    """Maximum likelihood by Adam; ``y``: label of each chain (all its lines).
    Chains count alike, whatever their number of lines."""
    if not len(y):
        return {"mean": np.zeros(_N), "std": np.ones(_N), "w": np.zeros(3 * _N + 3), "trans": np.zeros((2, 2))}
    mean, std = x.mean(axis=0), x.std(axis=0) + 1e-6
    f = with_neighbours((x - mean) / std, first)
    size = np.diff(first)
    line_y = np.repeat(y, size).astype(float)
    w, trans = np.zeros(f.shape[1]), np.zeros((2, 2))
    p = np.concatenate([w, trans.ravel()])
    m = v = np.zeros(len(p))
    per = 1 / len(y)
    seen = np.zeros((2, 2))
    seen[0, 0], seen[1, 1] = (size[y == 0] - 1).sum(), (size[y == 1] - 1).sum()
    for k in range(1, rounds + 1):
        w, trans = p[:f.shape[1]], p[f.shape[1]:].reshape(2, 2)
        good, pair, _ = marginals(f @ w, first, trans)
        grad = np.concatenate([f.T @ (good - line_y), (pair - seen).ravel()]) * per + ridge * p
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        p = p - 0.05 * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.999 ** k)) + 1e-9)
    return {"mean": mean, "std": std, "w": p[:f.shape[1]], "trans": p[f.shape[1]:].reshape(2, 2)}


def score_lines(model: dict[str, np.ndarray], x: np.ndarray, size: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Scores of the texts whose lines these are."""
    f = with_neighbours((x - model["mean"]) / model["std"], first)
    good, _, _ = marginals(f @ model["w"], first, model["trans"])
    weight = size + 1.0
    return np.clip(np.add.reduceat(good * weight, first[:-1]) / np.add.reduceat(weight, first[:-1]), 0, 1)


def _train_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        y = batch.column("y").to_numpy()
        for lo, hi, data, off in byte_runs(text_array(batch)):
            x, _, first = line_features(data, off)
            for r in range(hi - lo):
                lines = x[first[r]:first[r + 1]]
                if len(lines) <= MAX_LINES:
                    yield pa.RecordBatch.from_arrays([pa.array([int(y[lo + r])], pa.int32()), pa.array([lines.astype(np.float32).tobytes()], pa.binary())], names=["y", "x"])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS) -> dict[str, np.ndarray]:
    """Train on at most 2 * ``per_class`` labelled documents of at most
    ``MAX_LINES`` lines.  Without labelled rows every score is 0.5."""
    rows = labelled_sample(docs, labels, label, per_class).mapInArrow(_train_rows, "y int, x binary").collect()
    parts = [np.frombuffer(r["x"], np.float32).reshape(-1, _N).astype(float) for r in rows]
    # an order of its own, so that the sums don't depend on the order of rows
    order = sorted(range(len(rows)), key=lambda i: (len(parts[i]), rows[i]["y"], bytes(rows[i]["x"])))
    first = np.concatenate([[0], np.cumsum([len(parts[i]) for i in order])]).astype(np.int64)
    x = np.concatenate([parts[i] for i in order]) if parts else np.zeros((0, _N))
    return train(x, first, np.array([rows[i]["y"] for i in order], np.int64))


def scores(docs: DataFrame, model: dict[str, np.ndarray], name: str = "score") -> DataFrame:
    """``docs`` with a ``text`` column to its rows with ``name`` (0 to 1) as last column."""
    from pyspark.sql import types as T

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(len(batch))
            for lo, hi, data, off in byte_runs(text_array(batch)):
                out[lo:hi] = score_lines(model, *line_features(data, off))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=[*batch.schema.names, name])
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def classify(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs`` (doc_id,
    text).  Null and empty texts are scored as one empty line; null and
    repeated doc_ids are rows like any other."""
    model = fit(docs, labels)
    out = scores(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))
