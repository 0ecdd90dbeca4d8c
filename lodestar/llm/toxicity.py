"""Toxicity by a support vector machine on a subsequence string kernel, with
Nystroem landmarks.

The kernel of two strings sums over their common subsequences of three
letters (signs and spaces match nothing), each gap weighted by ``DECAY`` per letter, and is normalised; so
inserted characters and gaps weaken a likeness but keep it.  A string is a
word without its outer punctuation, or a run of single letters with their
spaces.  Landmarks are the strings that mark toxic labelled documents, and
common other ones, as many as it takes until no further one tells of
documents that those before leave open (a string marks toxic documents if
chance doesn't explain it, near copies counting once; first letters that many
strings share count as a string); the kernel to them, whitened by their own kernel matrix,
is the feature map of a linear machine.  As the machine is linear in the
subsequences' weights, it is kept as one weight per subsequence, and scoring
a string is a sum of look-ups.  It is trained on labelled documents, which
are sets of strings, not sentences: a document is as toxic as its most toxic
string, and in a toxic document the string that the machine finds worst is
the example.  Nothing is seen across a word gap.  A document's score is its
worst string's, through a logistic step fitted on training documents.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm import common
from lodestar.llm.common import byte_runs, held_out, text_array, word_hashes, word_spans
from lodestar.llm.labelled import labelled_sample

PER_CLASS = 1000        # labelled documents of each class that are learned from
MAX_STRINGS = 2000      # documents with more distinct strings are not learned from (they are scored in full)
COMMON, DECAY, LONG = 8, 0.7, 24
KNOWN_MAX = 200_000
CUT = 0.3

_OUTER = np.zeros(256, bool)
_OUTER[33:127] = True
_OUTER[48:58] = _OUTER[65:91] = _OUTER[97:123] = False
_JOIN = np.zeros(256, bool)
_JOIN[[32, 9]] = True


def string_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans of the strings of each text, by start: words without outer
    punctuation, runs of at least three single letters, and overlapping
    windows of words over ``LONG`` bytes."""
    s, e = word_spans(data, off)
    for _ in range(4):
        cut = (e - s > 1) & _OUTER[data[np.minimum(s, len(data) - 1)]] if len(s) else np.zeros(0, bool)
        s = s + cut
        cut = (e - s > 1) & _OUTER[data[e - 1]] if len(s) else cut
        e = e - cut
    if len(s) > 2:
        one = e - s == 1
        text = np.searchsorted(off, s, side="right")
        link = one[:-1] & one[1:] & (text[1:] == text[:-1]) & (s[1:] - e[:-1] <= 2)
        edge = np.diff(np.concatenate([[0], link.astype(np.int8), [0]]))
        a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        run = b - a >= 2
        s, e = np.concatenate([s, s[a[run]]]), np.concatenate([e, e[b[run]]])
    wide = np.flatnonzero(e - s > LONG)
    if len(wide):
        parts = [(np.arange(s[i], e[i] - LONG // 2, LONG // 2), e[i]) for i in wide.tolist()]
        ws = np.concatenate([p for p, _ in parts])
        we = np.concatenate([np.minimum(p + LONG, end) for p, end in parts])
        keep = e - s <= LONG
        s, e = np.concatenate([s[keep], ws]), np.concatenate([e[keep], we])
    order = np.argsort(s, kind="stable")
    return s[order], e[order]


def _classes() -> np.ndarray:
    """Letter class of each byte: a-z, digits, bytes of other letters; 0 for
    signs and white space, which match nothing and only make gaps."""
    c = np.zeros(256, np.int64)
    c[97:123] = np.arange(1, 27)
    c[48:58] = 27
    c[128:192] = 28 + np.arange(64) % 36
    return c


_CLASS = _classes()
_SIDE = 64


def _padded(strings: list[bytes], width: int) -> np.ndarray:
    return _CLASS[np.frombuffer(b"".join(x.ljust(width, b" ") for x in strings), np.uint8).reshape(len(strings), width)]


def _triples(n: int):
    for i in range(n - 2):
        for k in range(i + 2, n):
            for j in range(i + 1, k):
                yield i, j, k, DECAY ** (k - i + 1)


def norms(x: np.ndarray) -> np.ndarray:
    """Square root of each row's kernel with itself, by dynamic programming."""
    total = np.zeros(len(x))
    n, b = x.shape
    s1, s2 = np.zeros((n, b + 1)), np.zeros((n, b + 1))
    for a in range(b):
        hit = ((x[:, a][:, None] == x) & (x > 0)) * (DECAY * DECAY)
        total += (hit * s2[:, :b]).sum(axis=1)
        two = hit * s1[:, :b]
        r1, r2 = np.zeros(n), np.zeros(n)
        s1 *= DECAY
        s2 *= DECAY
        for j in range(b):
            r1 = r1 * DECAY + hit[:, j]
            r2 = r2 * DECAY + two[:, j]
            s1[:, j + 1] += r1
            s2[:, j + 1] += r2
    return np.sqrt(total)


def mark_table(marks: list[bytes]) -> np.ndarray:
    """Normalised weight of every three-letter subsequence in each landmark."""
    t = np.zeros((_SIDE ** 3, len(marks)), np.float32)
    for m, word in enumerate(marks):
        x = _padded([word], max(3, len(word)))
        for i, j, k, w in _triples(x.shape[1]):
            if x[0, i] and x[0, j] and x[0, k]:
                t[(x[0, i] * _SIDE + x[0, j]) * _SIDE + x[0, k], m] += w
        t[:, m] /= max(float(norms(x)[0]), 1e-9)
    return t


def against(strings: list[bytes], table: np.ndarray) -> np.ndarray:
    """Normalised kernel of each string with the columns of ``table``: every
    subsequence of three letters looks up its weight.  Strings without three
    letters are like nothing."""
    out = np.zeros((len(strings), table.shape[1]), np.float32)
    size = np.array([len(x) for x in strings])
    for n in np.unique(size[size >= 3]):
        rows = np.flatnonzero(size == n)
        for lo in range(0, len(rows), 2048):
            some = rows[lo:lo + 2048]
            x = _padded([strings[i] for i in some], int(n))
            got = np.zeros((len(some), table.shape[1]), np.float32)
            two = {}
            for i, j, k, w in _triples(int(n)):
                if (i, j) not in two:
                    two[i, j] = (x[:, i] * _SIDE + x[:, j]) * _SIDE
                got += np.float32(w) * table[two[i, j] + x[:, k]]
            out[some] = got / np.maximum(norms(x), 1e-6)[:, None]
    return out


def likeness(strings: list[bytes], marks: list[bytes]) -> np.ndarray:
    """Normalised kernel of each string with each mark, 32 marks at a time."""
    return np.concatenate([against(strings, mark_table(marks[i:i + 32])) for i in range(0, len(marks), 32)], axis=1)


# ---- training on a bounded sample ----------------------------------------

def _doc_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        y = batch.column("y").to_numpy()
        for lo, hi, raw, off in byte_runs(text_array(batch)):
            data = common._LOWER[raw]
            s, e = string_spans(data, off)
            buf, first = data.tobytes(), np.searchsorted(s, off)
            for r in range(hi - lo):
                got = sorted({buf[a:b] for a, b in zip(s[first[r]:first[r + 1]].tolist(), e[first[r]:first[r + 1]].tolist())})
                if len(got) <= MAX_STRINGS:
                    yield pa.RecordBatch.from_arrays([pa.array([int(y[lo + r])], pa.int32()), pa.array([b"\n".join(got)], pa.binary())],
                                                     names=["y", "strings"])


def _gapped(word: bytes, i: int) -> list[bytes]:
    """The word with characters put between its letters."""
    fill = b".*-_ "[i % 5:i % 5 + 1]
    mid = 1 + i % max(1, len(word) - 1)
    return [fill.join(word[k:k + 1] for k in range(len(word))), word[:mid] + fill + word[mid:], word[:mid] + word[mid - 1:mid] + word[mid:]]


def train(docs: Iterable[tuple[int, list[bytes]]], rate: float = 0.5) -> dict:
    """A model from (label, distinct strings) of documents; ``rate``: how
    many of the labelled documents are toxic where the scores are used."""
    empty = {"marks": [], "weights": np.zeros(_SIDE ** 3), "bias": 0.0, "step": (1.0, 0.1, 0.1)}
    at: dict[bytes, int] = {}
    labels, rows = [], []
    for y, strings in docs:
        labels.append(y)
        rows.append(np.array([at.setdefault(w, len(at)) for w in strings], np.int32))
    vocab = list(at)
    del at
    kept = _without_copies(rows, len(vocab))
    rows_bad, rows_good = ([rows[i] for i in kept if bool(labels[i]) == bad] for bad in (True, False))
    if not rows_bad or not rows_good:
        return empty
    known = np.array([len(w) >= 3 for w in vocab])
    df_bad, df_good = (np.bincount(np.concatenate(r), minlength=len(vocab)) * known for r in (rows_bad, rows_good))
    share_bad, share_good = df_bad / len(rows_bad), df_good / len(rows_good)
    telling = (share_bad > 20 * share_good) & _significant(df_bad, df_good, len(rows_bad) / (len(rows_bad) + len(rows_good)))
    by = lambda ids, key: sorted(ids.tolist(), key=lambda i: (-key[i], vocab[i]))
    stems, stem_bad, stem_good = _stems(vocab, rows_bad, rows_good)
    of_stems = (stem_bad / len(rows_bad) > 20 * stem_good / len(rows_good)) & _significant(
        stem_bad, stem_good, len(rows_bad) / (len(rows_bad) + len(rows_good)))
    share = dict(zip([vocab[i] for i in np.flatnonzero(telling)], share_bad[telling]))
    share |= dict(zip([stems[i] for i in np.flatnonzero(of_stems)], stem_bad[of_stems] / len(rows_bad)))
    if not share:
        return empty
    ranked = sorted(share, key=lambda w: (-share[w], -len(w), w))
    # families: what a string and its likes hold of the toxic documents, less
    # what strings of the others hold that are as like it
    benign = by(np.flatnonzero(df_good), df_good)
    other = benign[:1000] + benign[1000::max(1, len(benign) // 2000)]
    rows, cols, vals, harm = _kin(ranked, [vocab[i] for i in other], share_good[other])
    first = np.searchsorted(cols, np.arange(len(ranked) + 1))
    marks: list[bytes] = []
    left, free = np.array([share[w] for w in ranked]), np.ones(len(ranked), bool)
    while True:
        gain = np.where(free, np.bincount(cols, vals * left[rows], len(ranked)) - 3 * harm, -np.inf)
        i = int(gain.argmax())
        if gain[i] * len(rows_bad) < 4:
            break
        marks.append(ranked[i])
        free[i] = False
        at_i = slice(first[i], first[i + 1])
        left[rows[at_i]] *= 1 - vals[at_i]
    best = np.zeros(len(vocab), np.float32)         # likeness of all strings is never held for all marks at once
    good_marks: list[bytes] = []
    for lo in range(0, len(marks), 32):
        like = likeness(vocab, marks[lo:lo + 32])
        bad, good = (_share_alike(like, rows) for rows in (rows_bad, rows_good))
        fine = bad > 5 * good           # a mark whose likes clean documents hold as well tells nothing
        good_marks += [m for m, ok in zip(marks[lo:lo + 32], fine) if ok]
        best = np.maximum(best, np.where(fine, like, 0).max(axis=1))
    marks = good_marks
    toxic = len(marks)
    if not toxic:
        return empty
    marks += [vocab[i] for i in benign[:COMMON]]
    k = likeness(marks, marks).astype(float)
    val, vec = np.linalg.eigh((k + k.T) / 2)
    white = vec @ np.diag(1 / np.sqrt(np.maximum(val, 1e-3))) @ vec.T

    value = best * (0.2 + telling)
    extra = [g for i, w in enumerate(marks[:toxic]) for g in _gapped(w, i)]
    extra_like = likeness(extra, marks)
    w, bias = np.zeros(len(marks)), 0.0
    for turn in range(3):
        pos = np.unique([r[value[r].argmax()] for r in rows_bad if len(r)])
        pos = pos[best[pos] >= 0.5]         # a label without anything like a landmark is no example
        top = np.unique(np.concatenate([r[np.argsort(-value[r])[:8]] for r in rows_good if len(r)]))
        spread = np.unique(np.concatenate([r[::7] for r in rows_good if len(r)]))
        neg = np.union1d(top, spread[:: max(1, len(spread) // 8000)])
        pos = np.setdiff1d(pos, neg)
        x = np.concatenate([likeness([vocab[i] for i in pos], marks), extra_like, likeness([vocab[i] for i in neg], marks)]) @ white
        y = np.concatenate([np.ones(len(pos) + len(extra)), -np.ones(len(neg))])
        cost = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
        w, bias = _machine(x, y, cost)
        weights = _weights(marks, white @ w)
        value = against(vocab, weights.astype(np.float32)[:, None])[:, 0] + bias
    top_of = lambda rows: np.array([value[r].max() if len(r) else value.min() for r in rows])
    v = np.concatenate([top_of(rows_bad), top_of(rows_good)])
    step = _step(v, np.repeat([1.0, 0.0], [len(rows_bad), len(rows_good)]),
                     np.repeat([rate / len(rows_bad), (1 - rate) / len(rows_good)], [len(rows_bad), len(rows_good)]) * len(v))
    return {"marks": marks, "weights": weights, "bias": bias, "step": step}


def _without_copies(rows: list[np.ndarray], n: int) -> list[int]:
    """The documents that are no near copies of one before: of the strings that
    few documents hold, each shows the 64 of the smallest hash; a third of them
    (at least 8, or all) in common is a copy.  Else what a group of copies shares by chance of its
    label would look like evidence from many documents."""
    df = np.bincount(np.concatenate(rows), minlength=n) if rows else np.zeros(n, int)
    few = df <= max(2, len(rows) // 5)
    order = common.mix(np.arange(n, dtype=np.uint64) + np.uint64(0x51ED270B))
    seen: dict[int, list[int]] = {}
    kept = []
    for i, r in enumerate(rows):
        r = r[few[r]]
        show = r[np.argsort(order[r])[:64]].tolist()
        met = np.bincount(np.array([d for w in show for d in seen.get(w, ())], np.int64), minlength=1)
        if show and met.max() >= min(len(show), max(8, len(show) / 3)):
            continue
        for w in show:
            seen.setdefault(w, []).append(i)
        kept.append(i)
    return kept


def _stems(vocab: list[bytes], rows_bad: list[np.ndarray], rows_good: list[np.ndarray]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """First letters (5 to 9 bytes) of longer strings that at least five toxic
    documents hold, and how many toxic and other documents hold them: an insult
    may come with many endings."""
    cut = lambda r: {w[:k] for i in r.tolist() for w in (vocab[i],) for k in range(5, min(len(w), 10))}
    bad: dict[bytes, int] = {}
    for r in rows_bad:
        for w in cut(r):
            bad[w] = bad.get(w, 0) + 1
    bad = {w: n for w, n in bad.items() if n >= 5}
    good = dict.fromkeys(bad, 0)
    for r in rows_good:
        for w in cut(r) & good.keys():
            good[w] += 1
    return list(bad), np.array(list(bad.values()), np.int64), np.array(list(good.values()), np.int64)


def _share_alike(like: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
    """The share of documents that hold a string much like each mark."""
    some = [r for r in rows if len(r)]
    if not some:
        return np.zeros(like.shape[1])
    first = np.cumsum([0] + [len(r) for r in some[:-1]])
    return np.maximum.reduceat(like[np.concatenate(some)] >= 0.7, first, axis=0).sum(axis=0) / len(rows)


def _significant(df_bad: np.ndarray, df_good: np.ndarray, rate: float) -> np.ndarray:
    """Strings found in toxic documents more often than chance explains: by the
    Chernoff bound of a binomial, times the number of strings that at least as
    many documents hold, less than one half by chance."""
    n = df_bad + df_good
    p = np.clip(df_bad / np.maximum(n, 1), 1e-12, 1 - 1e-12)
    bound = np.exp(-n * (p * np.log(p / rate) + (1 - p) * np.log((1 - p) / (1 - rate))))
    as_common = len(n) - np.searchsorted(np.sort(n), n)
    return (df_bad >= 2) & (p > rate) & (bound * as_common < 0.5)


def _weights(marks: list[bytes], beta: np.ndarray) -> np.ndarray:
    """One weight per subsequence: the landmarks' tables times their weights, 32 at a time."""
    return sum(mark_table(marks[lo:lo + 32]).astype(float) @ beta[lo:lo + 32] for lo in range(0, len(marks), 32))


def _kin(ranked: list[bytes], other: list[bytes], share: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(rows, columns, values) of the likeness of ``ranked`` to itself where it
    counts, by column, and what ``other`` holds that is as like each; 32 columns at a time."""
    rows, cols, vals, harm = [], [], [], []
    for lo in range(0, len(ranked), 32):
        table = mark_table(ranked[lo:lo + 32])
        kin = np.clip(2 * against(ranked, table) - 0.6, 0, 1).T
        c, r = np.nonzero(kin)
        rows.append(r)
        cols.append(c + lo)
        vals.append(kin[c, r].astype(float))
        harm.append(np.clip(2 * against(other, table) - 0.6, 0, 1).T @ share)
    return np.concatenate(rows), np.concatenate(cols), np.concatenate(vals), np.concatenate(harm)


def _machine(x: np.ndarray, y: np.ndarray, cost: np.ndarray, c: float = 3000.0, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, by accelerated gradient steps."""
    z = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    h = (z * cost[:, None]).T @ z * 2 * c + np.eye(z.shape[1])
    step = 1 / np.linalg.eigvalsh(h)[-1]
    p = q = np.zeros(z.shape[1])
    t = 1.0
    for _ in range(rounds):
        slack = np.maximum(0, 1 - y * (z @ q))
        grad = q * np.append(np.ones(z.shape[1] - 1), 0) - 2 * c * z.T @ (cost * y * slack)
        new, t2 = q - step * grad, (1 + np.sqrt(1 + 4 * t * t)) / 2
        q, p, t = new + (t - 1) / t2 * (new - p), new, t2
    return p[:-1], float(p[-1])


def _step(v: np.ndarray, y: np.ndarray, cost: np.ndarray) -> tuple[float, float, float]:
    """Where the toxic begin, near the machine's boundary, and the shares of
    toxic documents below and above: the most likely step, the middle of equal ones."""
    rate = float((y * cost).sum() / cost.sum())
    tried = []
    for t in np.linspace(-0.5, 1.0, 31):
        shares, fit_ = [], 0.0
        for side in (v < t, v >= t):
            p = ((y * cost)[side].sum() + rate) / (cost[side].sum() + 1)
            fit_ += (cost[side] * np.where(y[side] > 0, np.log(p), np.log(1 - p))).sum()
            shares.append(float(p))
        tried.append((fit_, float(t), *shares))
    best = max(tried)[0]
    alike = [x[1:] for x in tried if x[0] >= best - 1e-9]
    at, low, high = alike[len(alike) // 2]
    return at, low, max(low, high)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS) -> dict:
    """Train on at most 2 * ``per_class`` labelled documents; without both
    labels every document has the same low score."""
    rows = labelled_sample(docs, labels, label, per_class).mapInArrow(_doc_strings, "y int, strings binary").collect()
    rate = labels.where(F.col(label).isin(0, 1) & ~held_out()).agg(F.avg(F.col(label).cast("double"))).first()[0]
    rows = sorted((r["y"], bytes(r["strings"])) for r in rows)
    return train(((y, x.split(b"\n") if x else []) for y, x in rows), rate or 0.5)


# ---- scoring -------------------------------------------------------------

_KNOWN: dict[tuple, dict[int, float]] = {}


def _values(model: dict, hashes: list[int], strings) -> np.ndarray:
    """Decision values of distinct strings; a worker remembers them."""
    key = (model["bias"], *model["marks"])
    if key not in _KNOWN:
        _KNOWN.clear()
        _KNOWN[key] = {}
    known = _KNOWN[key]
    if len(known) > KNOWN_MAX:
        known.clear()
    new = [i for i, h in enumerate(hashes) if h not in known]
    if new:
        v = against([strings(i) for i in new], model["weights"].astype(np.float32)[:, None])[:, 0] + model["bias"]
        known.update(zip([hashes[i] for i in new], v.tolist()))
    return np.array([known[h] for h in hashes])


def score_texts(model: dict, data: np.ndarray, off: np.ndarray) -> np.ndarray:
    s, e = string_spans(data, off)
    out = np.full(len(off) - 1, model["bias"])
    if len(s):
        uniq, at, inv = np.unique(word_hashes(data, s, e), return_index=True, return_inverse=True)
        buf = data.tobytes()
        v = _values(model, uniq.tolist(), lambda i: buf[s[at[i]]:e[at[i]]])[inv]
        first = np.searchsorted(s, off)
        some = np.flatnonzero(np.diff(first))
        out[some] = np.maximum.reduceat(v, first[some])
    at, low, high = model["step"]
    return low + (high - low) / (1 + np.exp(-np.clip(6 * (out - at), -30, 30)))


def scores(docs: DataFrame, model: dict, name: str = "score") -> DataFrame:
    """``docs`` with a ``text`` column to its rows with ``name`` (0 to 1) as last column."""
    from pyspark.sql import types as T

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(len(batch))
            for lo, hi, raw, off in byte_runs(text_array(batch)):
                out[lo:hi] = score_texts(model, common._LOWER[raw], off)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=[*batch.schema.names, name])
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def classify(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs`` (doc_id,
    text).  Null and empty texts have no strings and the lowest evidence;
    null and repeated doc_ids are rows like any other."""
    out = scores(docs.select("doc_id", "text"), fit(docs, labels))
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))
