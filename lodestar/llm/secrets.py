"""Secrets in texts: candidates by pattern, false positives out by a random forest.

Candidates are runs of at least 16 key characters with a digit, and values
given to a secret's name.  The forest looks at a candidate's length, make-up
and character transitions, how much of it is dictionary words (the corpus's
most frequent ones), whether it is part of a path or address, and at the
words next to it.  It is trained on labelled findings.  Where the user has
none, findings of the corpus label themselves by rules that are seldom wrong
(a provider's format, a value assigned to a secret's name; or digits alone, a
path, an address, dictionary words), and copies without their context make
the forest judge by the candidate too.  All documents are labelled; only the
findings that are learned from are bounded.  Where they are of one label,
there is nothing to train and the rules decide alone.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.llm.common import byte_runs, text_array, written
from lodestar.llm.sanitise import _terms

PER_LABEL = 4000        # findings of each label that are learned from
DICTIONARY = 3000       # most frequent words of all texts
TREES, DEPTH, CUT = 40, 8, 0.5
MARK = "[SECRET]"

_RUN = re.compile(rb"(?<![A-Za-z0-9+/_\-])(?=[A-Za-z+/_\-]*[0-9])[A-Za-z0-9+/_\-]{16,}={0,2}")
_NAME = rb"(?:pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|credential)s?"
_GIVEN = re.compile(rb"(?i:" + _NAME + rb")[\"']?[ \t]{0,2}[:=][ \t]{0,2}[\"']?([^\s\"'<>\x80-\xff]{8,})")
_NEAR = re.compile(rb"(?i:" + _NAME + rb")[\"']?[ \t]{0,2}[:=]?[ \t]{0,2}[\"']?$")
_PROVIDER = re.compile(rb"AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk-[A-Za-z0-9]{20,}|AIza[A-Za-z0-9_\-]{35}")
_WORD = re.compile(rb"[A-Za-z\x80-\xff]{2,}")
_LETTERS = re.compile(rb"[A-Za-z]{3,}")


def candidates(text: bytes) -> list[tuple[int, int]]:
    """Spans of candidates in bytes, by start; of spans that overlap the named value counts."""
    named = [m.span(1) for m in _GIVEN.finditer(text)]
    out, at = list(named), 0
    for m in _RUN.finditer(text):       # both kinds come by start and don't overlap their own kind
        while at < len(named) and named[at][1] <= m.start():
            at += 1
        if at == len(named) or m.end() <= named[at][0]:
            out.append(m.span())
    return sorted(out)


def code_points(text: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Byte spans, by start, as spans in code points: one pass over the text."""
    out, done, n = [], 0, 0
    for a, b in spans:
        start = n + len(text[done:a].decode())
        done, n = b, start + len(text[a:b].decode())
        out.append((start, n))
    return out


def replaced(text: bytes, spans: list[tuple[int, int]], mark: bytes) -> bytes:
    """The text with every span replaced; spans by start, none overlapping."""
    ends = [0, *(b for _, b in spans)]
    return mark.join(text[a:b] for a, b in zip(ends, [*(a for a, _ in spans), len(text)]))


def context(text: bytes, a: int, b: int) -> tuple[bytes, bytes, bytes]:
    return text[a:b], text[max(0, a - 48):a], text[b:b + 24]


def features(c: bytes, before: bytes, after: bytes, words: frozenset) -> list[float]:
    n = len(c)
    kinds = "".join("d" if 48 <= x <= 57 else "u" if 65 <= x <= 90 else "l" if 97 <= x <= 122 else "s" for x in c)
    count = Counter(c)
    p = np.array(list(count.values())) / n
    letters = sum(kinds.count(k) for k in "ul")
    runs = _LETTERS.findall(c)
    near = [w.lower() for w in _WORD.findall(before)[-3:] + _WORD.findall(after)[:3]]
    low = c.lower()
    return [n, len(count) / n, float(-(p * np.log2(p)).sum()), kinds.count("d") / n, kinds.count("u") / n, kinds.count("l") / n, kinds.count("s") / n,
            sum(x != y for x, y in zip(kinds, kinds[1:])) / max(1, n - 1), float(all(x in b"0123456789abcdef" for x in low)),
            sum(low.count(x) for x in b"aeiou") / max(1, letters), sum(len(r) for r in runs if r.lower() in words) / n,
            max(map(len, runs), default=0) / n, c.count(b"/") + before.endswith((b"/", b".")) + 2 * (b"://" in before.rsplit(None, 1)[-1] if before.strip() else 0),
            float(before.endswith(b"@") or after.startswith(b"@")), float(bool(_NEAR.search(before))), float(before.rstrip()[-1:] in (b"=", b":", b'"', b"'")),
            float(after[:1] in (b'"', b"'")), sum(w in words for w in near) / max(1, len(near))]


def self_label(c: bytes, before: bytes, after: bytes, words: frozenset) -> int | None:
    """1 or 0 for findings whose nature is plain, else None."""
    runs = _LETTERS.findall(c)
    if _PROVIDER.fullmatch(c):
        return 1
    if re.fullmatch(rb"[0-9_\-+/]+", c) or c.count(b"/") >= 2 or before.endswith(b"@") or after.startswith(b"@"):
        return 0
    if b"://" in (before.rsplit(None, 1) or [b""])[-1] or sum(len(r) for r in runs if r.lower() in words) >= 0.6 * len(c):
        return 0
    if _NEAR.search(before) and len(set(c)) >= 6 and re.search(rb"[0-9]", c):
        return 1
    return None


# ---- the forest ----------------------------------------------------------

def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = 5) -> list[tuple]:
    """Trees as arrays (feature or -1, threshold, left, right, share of 1)."""
    rng, out = np.random.default_rng(seed), []
    tries = max(2, int(round(np.sqrt(x.shape[1]))))
    for _ in range(trees):
        nodes: list[list] = []
        todo = [(rng.integers(0, len(y), len(y)), 0, None)]
        while todo:
            rows, level, parent = todo.pop()
            at = len(nodes)
            if parent is not None:
                nodes[parent[0]][parent[1]] = at
            share = float(y[rows].mean())
            nodes.append([-1, 0.0, 0, 0, share])
            if level == depth or share in (0.0, 1.0) or len(rows) < 6:
                continue
            best = (1e9, -1, 0.0)
            for f in rng.permutation(x.shape[1])[:tries]:
                order = np.argsort(x[rows, f], kind="stable")
                v, t = x[rows[order], f], np.cumsum(y[rows[order]])
                cut = np.flatnonzero(v[1:] > v[:-1])
                if not len(cut):
                    continue
                left, ones, total = cut + 1.0, t[cut], t[-1]
                right = len(rows) - left
                gini = ones * (left - ones) / left + (total - ones) * (right - total + ones) / right
                k = int(gini.argmin())
                if gini[k] < best[0]:
                    best = (gini[k], int(f), float((v[cut[k]] + v[cut[k] + 1]) / 2))
            if best[1] < 0:
                continue
            nodes[at][:2] = best[1], best[2]
            low = x[rows, best[1]] <= best[2]
            todo += [(rows[low], level + 1, (at, 2)), (rows[~low], level + 1, (at, 3))]
        out.append(tuple(np.array(col) for col in zip(*nodes)))
    return out


def vote(forest: list[tuple], x: np.ndarray) -> np.ndarray:
    """Mean share of secrets in the leaves that rows of ``x`` reach."""
    total = np.zeros(len(x))
    for feature, threshold, left, right, share in forest:
        at = np.zeros(len(x), np.int64)
        for _ in range(DEPTH):
            f = feature[at]
            go = np.where(x[np.arange(len(x)), np.maximum(f, 0)] <= threshold[at], left[at], right[at])
            at = np.where(f < 0, at, go)
        total += share[at]
    return total / max(1, len(forest))


def train(findings: list[tuple[bytes, bytes, bytes, int]], words: frozenset) -> dict:
    """A model from labelled findings (candidate, before, after, 0 or 1)."""
    if len({y for *_, y in findings}) < 2:      # nothing to tell apart: the rules decide
        return {"forest": [], "words": words}
    rows = [(features(c, b, a, words), y) for c, b, a, y in findings]
    rows += [(features(c, b" ", b" ", words), y) for c, _, _, y in findings]
    x, y = np.array([r for r, _ in rows]), np.array([v for _, v in rows])
    return {"forest": grow(x, y), "words": words}


def dictionary(docs: DataFrame, size: int = DICTIONARY) -> frozenset:
    """The most frequent words of all texts (a bounded list)."""
    top = docs.select(F.explode(_terms(F.col("text"))).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.desc("n"), "w").limit(size).collect()
    return frozenset(r["w"].encode() for r in top)


def fit(docs: DataFrame, labelled: DataFrame | None = None) -> dict:
    """The model for ``docs``.  ``labelled`` (candidate, before, after, label)
    are the user's findings; without them those of all documents."""
    words = dictionary(docs)
    if labelled is not None:
        key = F.xxhash64("candidate", "before", "after")
        rows = [r for y in (0, 1) for r in labelled.where(F.col("label") == y).orderBy(key).limit(PER_LABEL).collect()]
        return train([(r["candidate"].encode(), (r["before"] or "").encode(), (r["after"] or "").encode(), int(r["label"])) for r in rows if r["candidate"]], words)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for _, _, data, off in byte_runs(text_array(batch)):
                buf = data.tobytes()
                for lo, hi in zip(off[:-1].tolist(), off[1:].tolist()):
                    text = buf[lo:hi]
                    for a, b in candidates(text):
                        found = context(text, a, b)
                        y = self_label(*found, words)
                        if y is not None:
                            for k, v in enumerate((*found, y)):
                                out[k].append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[k], pa.binary()) for k in range(3)] + [pa.array(out[3], pa.int32())],
                                             names=["c", "before", "after", "y"])
    found = docs.select("text").mapInArrow(run, "c binary, before binary, after binary, y int")
    found = found.groupBy("c", "before").agg(F.min(F.struct("after", "y")).alias("x")).select("c", "before", "x.*")
    found = written(found, "findings")
    key = F.xxhash64("c", "before", "after")
    rows = [r for y in (0, 1) for r in found.where(F.col("y") == y).orderBy(key).limit(PER_LABEL).collect()]
    return train([(bytes(r["c"]), bytes(r["before"]), bytes(r["after"]), r["y"]) for r in rows], words)


# ---- scanning ------------------------------------------------------------

def find(text: bytes, model: dict, cut: float = CUT) -> tuple[list[tuple[int, int]], int, float]:
    """(byte spans of secrets, candidates, best score) of one text."""
    spans = candidates(text)
    if not spans:
        return [], 0, 0.0
    if not model["forest"]:
        sure = [(a, b) for a, b in spans if self_label(*context(text, a, b), model["words"]) == 1]
        return sure, len(spans), float(bool(sure))
    p = vote(model["forest"], np.array([features(*context(text, a, b), model["words"]) for a, b in spans]))
    return [s for s, v in zip(spans, p) if v >= cut], len(spans), float(p.max())


def _texts(batch: pa.RecordBatch):
    for lo, hi, data, off in byte_runs(text_array(batch)):
        buf = data.tobytes()
        for r in range(hi - lo):
            yield lo + r, buf[off[r]:off[r + 1]]


def scan(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` (doc_id, text) to doc_id, n_candidates, n_secrets, spans
    (start:end in code points, comma-joined) and best_score per row.  Null
    and empty texts have no candidates; null and repeated doc_ids are rows
    like any other; an empty table gives no rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m, spans, best = [], [], [], []
            for _, text in _texts(batch):
                found, count, score = find(text, model)
                n.append(count)
                m.append(len(found))
                spans.append(",".join(f"{a}:{b}" for a, b in code_points(text, found)))
                best.append(score)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(m, pa.int64()),
                                              pa.array(spans, pa.string()), pa.array(best, pa.float64())],
                                             names=["doc_id", "n_candidates", "n_secrets", "spans", "best_score"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_candidates long, n_secrets long, spans string, best_score double")


def redact(docs: DataFrame, model: dict, mark: str = MARK) -> DataFrame:
    """``docs`` with every secret of ``text`` replaced; other columns as they are."""
    at = docs.columns.index("text")
    schema = T.StructType(docs.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, off in byte_runs(text_array(batch)):      # a worker holds one run's texts
                buf, part, new = data.tobytes(), batch.slice(lo, hi - lo), {}
                for r in range(hi - lo):
                    text = buf[off[r]:off[r + 1]]
                    found, _, _ = find(text, model)
                    if found:
                        new[r] = replaced(text, found, mark.encode()).decode()
                if new:
                    cols = list(part.columns)
                    cols[at] = pa.array([new.get(r, x) for r, x in enumerate(cols[at].to_pylist())], pa.string())
                    part = pa.RecordBatch.from_arrays(cols, names=part.schema.names)
                yield part
    return docs.mapInArrow(run, schema)
