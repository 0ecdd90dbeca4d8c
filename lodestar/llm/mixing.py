"""Language-model scores by logistic context mixing.

A text is the byte string of its tokens: lower-cased words, a blank after each
but the last, one end byte.  Every bit of it is predicted by counters that are
found by hashes of several contexts (the last one to five bytes, and of these
the ones in the word so far) and the bits already known.  The counters' log odds are combined by a
weight set that a gate picks from the place in the word and from how much the
contexts have seen; what a counter's state says is itself learned; the result
is refined by an adaptive map of (known bits, odds) to observed frequencies.

What is learned covers all training texts.  Distinct events (five bytes and
the next one) are counted by a group-by, so the table of events grows with
the corpus; the hashed counters are summed up from it in blocks, one group a
block.  Weights are learned online over the events, a counter never
containing the occurrence that it predicts; tasks' weights are averaged.  The
map is learned the same way in a further pass over the events.

A text's probability is a product over its events, so equal events of a slice
of texts are computed once.  Word counts for the base score come from
the same scan; the most frequent words (``HOT``) go to all tasks, all other
words are joined by hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.llm.common import _LOWER, _SPACE, byte_runs, mix, text_array, word_hashes, word_spans, written

ORDER = 5                       # bytes of the longest context
SPACE, END = 0x20, 0x0A         # neither occurs in a word
INPUTS = ORDER + 1              # orders 1 to 5, and the word so far
MIN_BITS, MAX_BITS, BLOCK_BITS = 16, 22, 6      # a predictor's table has 2^bits counters; above MAX_BITS contexts share them
GATES, NODES, ODDS = 256, 256, 33
SLICE = 1 << 22                 # bytes of text whose equal events are computed once
BATCH, RATE = 4096, 0.02        # events of one online step, and its size
CACHE = 1 << 20                 # events that a task keeps with their probabilities
HOT = 1 << 16                   # words whose counts go to all tasks
_END_WORD = np.int64(-0x2B5A3F1C9D4E6071)
_STRETCH_MAX = 8.0

_COUNT = T.StructType([T.StructField("kind", T.ByteType()), T.StructField("key", T.LongType()), T.StructField("n", T.LongType())])
_SLOT = T.StructType([T.StructField("predictor", T.IntegerType()), T.StructField("block", T.IntegerType()),
                      T.StructField("ctx", T.LongType()), T.StructField("byte", T.IntegerType()), T.StructField("n", T.LongType())])
_TABLE = T.StructType([T.StructField("predictor", T.IntegerType()), T.StructField("block", T.IntegerType()), T.StructField("states", T.BinaryType())])
_STAT = T.StructType([T.StructField("at", T.IntegerType()), T.StructField("value", T.DoubleType()), T.StructField("mass", T.DoubleType())])
_SCORE = T.StructType([
    T.StructField("rid", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("held_out", T.BooleanType()),
    T.StructField("n_tokens", T.LongType()), T.StructField("hot_known", T.LongType()), T.StructField("hot_log", T.DoubleType()),
    T.StructField("score", T.DoubleType()), T.StructField("n_bytes", T.LongType()),
    T.StructField("words", T.ArrayType(T.LongType())), T.StructField("times", T.ArrayType(T.IntegerType()))])


# ---- texts as events ---------------------------------------------------------

def token_bytes(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The token bytes of a run of texts, each after ``ORDER`` end bytes that
    are context only; where each text's own bytes begin and end; row and hash
    of every token."""
    data = _LOWER[raw]
    starts, ends = word_spans(data, off)
    n, length = len(off) - 1, ends - starts
    first = np.searchsorted(starts, off)
    n_words = np.diff(first)
    row = np.repeat(np.arange(n), n_words)
    size = np.bincount(row, weights=length + 1, minlength=n).astype(np.int64)
    size[n_words == 0] = 1
    hi = np.cumsum(size + ORDER)
    lo = hi - size
    before = np.concatenate([[0], np.cumsum(length + 1)])
    at = before[:-1] - before[first[:-1]][row] + lo[row]        # where each word's bytes go
    out = np.full(int(hi[-1]) if n else 0, SPACE, np.uint8)
    inside = np.flatnonzero(~_SPACE[data])
    out[np.repeat(at - starts, length) + inside] = data[inside]
    pads = (lo[:, None] - 1 - np.arange(ORDER)[None, :]).ravel()
    out[pads] = END
    out[hi - 1] = END
    tokens = np.concatenate([word_hashes(data, starts, ends).view(np.int64), np.full(n, _END_WORD)])
    return out, np.stack([lo, hi]), np.concatenate([row, np.arange(n)]), tokens


def event_slices(stream: np.ndarray, spans: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, event) of every byte of the texts, in slices; an event is the byte below its ORDER predecessors."""
    lo, hi = spans
    window = np.ndarray((len(stream) - ORDER,), ">u8", np.append(stream, np.zeros(2, np.uint8)), strides=(1,))   # ORDER bytes, the byte, two more
    inside = np.zeros(len(stream) + 1, np.int8)
    inside[lo] += 1
    inside[hi] -= 1
    at = np.flatnonzero(np.cumsum(inside[:-1], dtype=np.int8))
    row = np.repeat(np.arange(len(lo), dtype=np.int32), hi - lo)
    for a in range(0, len(at), SLICE):
        yield row[a:a + SLICE], (window[at[a:a + SLICE] - ORDER] >> np.uint64(16)).astype(np.int64)


def _text_runs(batch: pa.RecordBatch) -> Iterator[tuple]:
    for lo, hi, raw, off in byte_runs(text_array(batch), SLICE - SLICE // 8):
        yield lo, hi, *token_bytes(raw, off)


# ---- contexts, counters, odds --------------------------------------------------

_NODE = (mix(np.arange(NODES, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.int64)


def contexts(events: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The 64-bit context hash of every predictor for every event, and the place in the word (0 to 3)."""
    past = events >> 8
    hashes = [mix((past & ((1 << (8 * k)) - 1)).view(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(k)) for k in range(1, ORDER + 1)]
    word, inside, place = np.zeros(len(past), np.int64), np.ones(len(past), bool), np.zeros(len(past), np.int64)
    for k in range(ORDER):
        b = (past >> (8 * k)) & 255
        inside &= (b != SPACE) & (b != END)
        word |= np.where(inside, b, 0) << (8 * k)
        place += inside
    return [*hashes, mix(word.view(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(77))], np.minimum(place, 3)


def places(ctx: np.ndarray, bits: int) -> tuple[np.ndarray, int]:
    """First counter of each context (its block in the top bits), and the mask of the bits below the block."""
    return (ctx >> np.uint64(64 - bits)).astype(np.int64), (1 << (bits - BLOCK_BITS)) - 1


_STEPS = np.array([0, 1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64, 96, 128, 192])   # counts from one step to the next are alike
_KINDS = len(_STEPS) ** 2


def _state_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n0, n1 = np.arange(65536) & 255, np.arange(65536) >> 8
    odds = np.log((n1 + 0.4) / (n0 + 0.4)).astype(np.float32)
    kind = (np.searchsorted(_STEPS, n1, side="right") - 1) * len(_STEPS) + np.searchsorted(_STEPS, n0, side="right") - 1
    seen = n0 + n1
    return odds, kind, ((seen > 0).astype(np.int8) + (seen > 1) + (seen > 7)).astype(np.int64)


_ODDS_OF, _KIND_OF, _LEVEL_OF = _state_tables()


def states(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Two counts as one 16-bit state: scaled down to 255, a count above 0 stays above 0."""
    big = np.maximum(np.maximum(n0, n1), 255.0)
    a, b = (np.where(x > 0, np.maximum(1, np.floor(x * 255.0 / big)), 0).astype(np.uint16) for x in (n0, n1))
    return a | (b << np.uint16(8))


class Model:
    """Counters, weight sets and the refining map; predicts the bits of events."""

    def __init__(self, tables: list[np.ndarray]):
        self.tables = tables
        self.bits = [len(t).bit_length() - 1 for t in tables]
        self.weights = np.full((GATES, INPUTS + 1), 0.25, np.float32)
        self.weights[:, INPUTS] = 0.0
        self.odds = [_ODDS_OF] * INPUTS                     # log odds of every state
        self.map = None                                     # (NODES, ODDS) log odds

    def bit_inputs(self, events: np.ndarray, left_out: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]]:
        """(node, gate, counter states, bit) for the eight bits of every event; ``left_out``
        takes one occurrence of the event out of its counters."""
        ctx, place = contexts(events)
        where = [places(c, b) for c, b in zip(ctx, self.bits)]
        node = np.ones(len(events), np.int64)
        for j in range(7, -1, -1):
            bit = (events >> j) & 1
            s = [t[at ^ (_NODE[node] & mask)] for t, (at, mask) in zip(self.tables, where)]
            if left_out:
                one, shift = np.where(bit == 1, np.uint16(256), np.uint16(1)), np.where(bit == 1, np.uint16(8), np.uint16(0))
                s = [v - np.where((v >> shift) & np.uint16(255) > 0, one, np.uint16(0)) for v in s]
            yield node, self.gate(place, s), s, bit
            node = (node << 1) | bit

    @staticmethod
    def gate(place: np.ndarray, s: list[np.ndarray]) -> np.ndarray:
        """The weight set: place in the word, and how much orders 5 and 3 and the word so far have seen."""
        return (place << 6) | (_LEVEL_OF[s[4]] << 4) | (_LEVEL_OF[s[2]] << 2) | _LEVEL_OF[s[5]]

    def inputs(self, s: list[np.ndarray]) -> np.ndarray:
        x = np.ones((INPUTS + 1, len(s[0])), np.float32)
        for k, v in enumerate(s):
            x[k] = self.odds[k][v]
        return x

    def mixed(self, gate: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Log odds of a 1 by the weight sets."""
        return np.clip(np.einsum("ki,ik->i", x, self.weights[gate]), -_STRETCH_MAX, _STRETCH_MAX)

    def refined(self, node: np.ndarray, odds: np.ndarray) -> np.ndarray:
        return odds if self.map is None else (odds + self.map[node, _cell(odds)]) / 2

    def log10(self, events: np.ndarray) -> np.ndarray:
        """log10 of the probability of each distinct event's byte after its context.
        Events in order share the bits that their contexts and first bits have in common."""
        out = np.zeros(len(events))
        order = np.argsort(events)
        for a in range(0, len(events), 1 << 16):
            take = order[a:a + (1 << 16)]
            part = events[take]
            ctx, place = contexts(part)
            where = [places(c, b) for c, b in zip(ctx, self.bits)]
            total = np.zeros(len(part))
            head = np.ones(len(part), bool)
            for j in range(7, -1, -1):
                known = part >> (j + 1)
                np.not_equal(known[1:], known[:-1], out=head[1:])
                at = np.flatnonzero(head)
                node = (1 << (7 - j)) | (known[at] & ((1 << (7 - j)) - 1))
                s = [t[x[at] ^ (_NODE[node] & mask)] for t, (x, mask) in zip(self.tables, where)]
                odds = self.refined(node, self.mixed(self.gate(place[at], s), self.inputs(s))).astype(np.float64)
                both = np.log1p(np.exp(np.stack([odds, -odds])))            # of a 0, of a 1
                total -= both[(part >> j) & 1, np.cumsum(head) - 1]
            out[take] = total / np.log(10.0)
        return out


class Remembered:
    """``Model.log10`` that keeps the events of earlier slices, up to about ``CACHE`` of them."""

    def __init__(self, model: Model):
        self.model, self.ids, self.values = model, np.zeros(0, np.int64), np.zeros(0)

    def log10(self, events: np.ndarray) -> np.ndarray:
        order = np.argsort(events)
        ids = events[order]
        at = np.searchsorted(self.ids, ids)
        old = np.zeros(len(ids), bool)
        old[at < len(self.ids)] = self.ids[at[at < len(self.ids)]] == ids[at < len(self.ids)]
        values = np.empty(len(ids))
        values[old] = self.values[at[old]]
        values[~old] = self.model.log10(ids[~old])
        if len(self.ids) > CACHE:
            self.ids, self.values = ids, values
        else:
            self.ids, self.values = np.insert(self.ids, at[~old], ids[~old]), np.insert(self.values, at[~old], values[~old])
        out = np.empty(len(ids))
        out[order] = values
        return out


def _cell(odds: np.ndarray) -> np.ndarray:
    return np.rint((odds + _STRETCH_MAX) * ((ODDS - 1) / (2 * _STRETCH_MAX))).astype(np.int64)


# ---- learning ------------------------------------------------------------------

def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, stream, spans, _, tokens in _text_runs(batch):
            for kind, key in [*((0, e) for _, e in event_slices(stream, spans)), (1, tokens)]:
                code, some = pd.factorize(key)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), kind, np.int8)), pa.array(some),
                                                  pa.array(np.bincount(code, minlength=len(some)))], names=_COUNT.names)


def _columns(batches: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.concatenate([b.column(c).to_numpy() for b in batches]) for c in ("key", "n"))


def _to_predictors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(events, n):
        for k, ctx in enumerate(contexts(events)[0]):
            t = pd.DataFrame({"c": ctx.view(np.int64), "b": (events & 255).astype(np.int32), "n": n})
            t = t.groupby(["c", "b"], sort=False, as_index=False)["n"].sum()
            block = (t["c"].to_numpy().view(np.uint64) >> np.uint64(64 - BLOCK_BITS)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(t), k, np.int32)), pa.array(block), pa.array(t["c"].to_numpy()),
                                              pa.array(t["b"].to_numpy()), pa.array(t["n"].to_numpy())], names=_SLOT.names)
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += len(batch)
        if size >= 400_000:
            yield from rows(*_columns(held))
            held, size = [], 0
    if size:
        yield from rows(*_columns(held))


def _build(bits: list[int]):
    """Counters of one (predictor, block) after the other, from rows sorted by them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, n0, n1 = None, None, None

        def done():
            return pa.RecordBatch.from_arrays([pa.array([now[0]], pa.int32()), pa.array([now[1]], pa.int32()),
                                               pa.array([states(n0, n1).tobytes()], pa.binary())], names=_TABLE.names)
        for batch in batches:
            k, block, ctx, byte, n = (batch.column(c).to_numpy() for c in _SLOT.names)
            cut = np.flatnonzero((k[1:] != k[:-1]) | (block[1:] != block[:-1])) + 1
            for a, b in zip(np.append(0, cut), np.append(cut, len(k))):
                if a == b:
                    continue
                if now != (k[a], block[a]):
                    if now is not None:
                        yield done()
                    now = (k[a], block[a])
                    n0, n1 = (np.zeros(1 << (bits[k[a]] - BLOCK_BITS)) for _ in range(2))
                at, mask = places(ctx[a:b].view(np.uint64), bits[k[a]])
                at, node, w = at & mask, np.ones(b - a, np.int64), n[a:b].astype(float)
                for j in range(7, -1, -1):
                    bit = (byte[a:b].astype(np.int64) >> j) & 1
                    slot = at ^ (_NODE[node] & mask)
                    n1 += np.bincount(slot, weights=w * bit, minlength=len(n1))
                    n0 += np.bincount(slot, weights=w * (1 - bit), minlength=len(n0))
                    node = (node << 1) | bit
        if now is not None:
            yield done()
    return run


def _online(model):
    """One pass of online steps over a task's events; (weight times mass, mass) of every weight."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _copy(model.value)
        square, mass = np.full(m.weights.shape, 1e-4), np.zeros(GATES)
        for batch in batches:
            events, n = _columns([batch])
            for a in range(0, len(events), BATCH):
                part, w = events[a:a + BATCH], n[a:a + BATCH].astype(np.float64)
                for _, gate, s, bit in m.bit_inputs(part, left_out=True):
                    x = m.inputs(s)
                    err = (bit - 1 / (1 + np.exp(-m.mixed(gate, x).astype(np.float64)))) * w
                    per = np.bincount(gate, weights=w, minlength=GATES)
                    step = np.stack([np.bincount(gate, weights=err * x[k], minlength=GATES) for k in range(INPUTS + 1)], axis=1)
                    step /= np.maximum(per, 1e-9)[:, None]
                    square += step * step
                    m.weights += (RATE * step / np.sqrt(square)).astype(np.float32)
                    mass += per
        value = m.weights.astype(np.float64) * mass[:, None]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(value.size), pa.int32()), pa.array(value.ravel()),
                                          pa.array(np.repeat(mass, INPUTS + 1))], names=_STAT.names)
    return run


def _copy(m: Model) -> Model:
    out = Model(m.tables)
    out.weights, out.odds, out.map = m.weights.copy(), m.odds, m.map
    return out


def _observe_states(model):
    """How often a 1 followed a state, by (predictor, kind of state): (ones, all)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        ones, all_ = np.zeros(INPUTS * _KINDS), np.zeros(INPUTS * _KINDS)
        for batch in batches:
            events, n = _columns([batch])
            w = n.astype(np.float64)
            for _, _, s, bit in m.bit_inputs(events, left_out=True):
                for k, v in enumerate(s):
                    at = _KIND_OF[v] + k * _KINDS
                    ones += np.bincount(at, weights=w * bit, minlength=len(ones))
                    all_ += np.bincount(at, weights=w, minlength=len(ones))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(ones)), pa.int32()), pa.array(ones), pa.array(all_)], names=_STAT.names)
    return run


def _observe(model):
    """How often a 1 followed, by (node, cell of the odds): (ones, all)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        ones, all_ = np.zeros(NODES * ODDS), np.zeros(NODES * ODDS)
        for batch in batches:
            events, n = _columns([batch])
            for a in range(0, len(events), 1 << 15):
                w = n[a:a + (1 << 15)].astype(np.float64)
                for node, gate, s, bit in m.bit_inputs(events[a:a + (1 << 15)], left_out=True):
                    at = node * ODDS + _cell(m.mixed(gate, m.inputs(s)))
                    ones += np.bincount(at, weights=w * bit, minlength=len(ones))
                    all_ += np.bincount(at, weights=w, minlength=len(all_))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(ones)), pa.int32()), pa.array(ones), pa.array(all_)], names=_STAT.names)
    return run


def in_training():
    """Rows that the model learns from: crc32(doc_id as text) mod 7 is not 2; a null id counts as such."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) != 2, F.lit(True))


def gather(docs: DataFrame) -> DataFrame:
    """(kind, key, n) over all training texts: kind 0 counts events, kind 1 tokens by hash."""
    found = docs.where(in_training()).select("text").mapInArrow(_gather, _COUNT)
    counted = found.groupBy("kind", "key").agg(F.sum("n").alias("n"))
    return written(counted.sortWithinPartitions("kind", F.xxhash64("key"), "key"), "lm-counts")


def fit(counts: DataFrame) -> Model:
    """The model of all events of ``counts`` (see ``gather``).  Its size is
    bounded by ``MAX_BITS``: at most 48 MB of counters reach the driver and
    go to the tasks."""
    spark = counts.sparkSession
    events = counts.where("kind = 0").select("key", "n")
    n_events = events.count()
    want = (n_events * 4).bit_length()
    calm = events.coalesce(max(1, n_events >> 19))          # a task should see many events in a row
    bits = [min(max(want, MIN_BITS), top) for top in (18, 20, *[MAX_BITS] * (INPUTS - 2))]
    blocks = (events.mapInArrow(_to_predictors, _SLOT).repartition("predictor", "block")
              .sortWithinPartitions("predictor", "block").mapInArrow(_build(bits), _TABLE))
    tables = [np.zeros(1 << b, np.uint16) for b in bits]
    for r in blocks.toLocalIterator():
        width = 1 << (bits[r["predictor"]] - BLOCK_BITS)
        tables[r["predictor"]][r["block"] * width:(r["block"] + 1) * width] = np.frombuffer(r["states"], np.uint16)
    model = Model(tables)

    def passed(rows: DataFrame, step, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The sums of one pass over the events; ``size`` rows at most."""
        sent = spark.sparkContext.broadcast(model)
        value, mass = np.zeros(size), np.zeros(size)
        for r in rows.mapInArrow(step(sent), _STAT).groupBy("at").agg(F.sum("value").alias("value"), F.sum("mass").alias("mass")).collect():
            value[r["at"]], mass[r["at"]] = r["value"], r["mass"]
        sent.unpersist()
        return value, mass

    ones, all_ = passed(events, _observe_states, INPUTS * _KINDS)
    middle = np.bincount(_KIND_OF, weights=_ODDS_OF) / np.bincount(_KIND_OF)
    seen = _odds(ones.reshape(INPUTS, _KINDS), all_.reshape(INPUTS, _KINDS), middle[None, :])
    model.odds = [(_ODDS_OF + (v - middle)[_KIND_OF]).astype(np.float32) for v in seen]
    value, mass = passed(calm, _online, model.weights.size)
    model.weights = np.where(mass > 0, value / np.maximum(mass, 1e-9), model.weights.ravel()).reshape(model.weights.shape).astype(np.float32)
    ones, all_ = passed(events, _observe, NODES * ODDS)
    centre = np.tile(np.linspace(-_STRETCH_MAX, _STRETCH_MAX, ODDS), NODES)
    model.map = _odds(ones, all_, centre).reshape(NODES, ODDS).astype(np.float32)
    return model


def _odds(ones: np.ndarray, all_: np.ndarray, prior: np.ndarray) -> np.ndarray:
    """Log odds of what was seen, drawn to prior odds that count as 20 bits."""
    p = (ones + 20 / (1 + np.exp(-prior))) / (all_ + 20)
    return np.clip(np.log(p / (1 - p)), -_STRETCH_MAX, _STRETCH_MAX)


# ---- scoring ---------------------------------------------------------------------

def _per_row(row: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, key) in order, with their numbers."""
    order = np.lexsort((key, row))
    row, key = row[order], key[order]
    head = np.ones(len(row), bool)
    head[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1])
    at = np.flatnonzero(head)
    return row[at], key[at], np.diff(np.append(at, len(row)))


def _score(model, hot):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        rid, m = TaskContext.get().partitionId() << 33, Remembered(model.value)
        hot_key, hot_n = hot.value
        for batch in batches:
            rows = len(batch)
            n_tokens, known, n_bytes = (np.zeros(rows, np.int64) for _ in range(3))
            score, hot_log, sizes = np.zeros(rows), np.zeros(rows), np.zeros(rows, np.int64)
            words, times = [], []
            for lo, hi, stream, spans, row, tokens in _text_runs(batch):
                n_bytes[lo:hi] = spans[1] - spans[0]
                for at, events in event_slices(stream, spans):
                    code, some = pd.factorize(events)
                    score[lo:hi] += np.bincount(at, weights=m.log10(some)[code], minlength=hi - lo)
                r, w, n = _per_row(row, tokens)
                n_tokens[lo:hi] = np.bincount(r, weights=n, minlength=hi - lo)
                i = np.minimum(np.searchsorted(hot_key, w), max(len(hot_key) - 1, 0))
                is_hot = hot_key[i] == w if len(hot_key) else np.zeros(len(w), bool)
                known[lo:hi] = np.bincount(r[is_hot], weights=n[is_hot], minlength=hi - lo)
                hot_log[lo:hi] = np.bincount(r[is_hot], weights=n[is_hot] * np.log10(hot_n[i[is_hot]] + 1.0), minlength=hi - lo)
                sizes[lo:hi] = np.bincount(r[~is_hot], minlength=hi - lo)
                words.append(w[~is_hot])
                times.append(n[~is_hot])
            off = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
            flat = lambda xs, t: pa.array(np.concatenate(xs) if xs else [], t)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rid + np.arange(rows)), batch.column("doc_id"), batch.column("held_out"), pa.array(n_tokens), pa.array(known), pa.array(hot_log),
                 pa.array(score), pa.array(n_bytes), pa.ListArray.from_arrays(off, flat(words, pa.int64())),
                 pa.ListArray.from_arrays(off, flat(times, pa.int32()))], names=_SCORE.names)
            rid += rows
    return run


def scores(docs: DataFrame, counts: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text), see ``language_scores``."""
    spark = docs.sparkSession
    vocabulary = counts.where("kind = 1").select("key", "n")
    total = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    top = vocabulary.orderBy(F.col("n").desc(), "key").limit(HOT).collect()      # at most HOT rows of two numbers
    pairs = np.array(sorted((r["key"], r["n"]) for r in top), np.int64).reshape(-1, 2)
    sent, hot = spark.sparkContext.broadcast(model), spark.sparkContext.broadcast((pairs[:, 0].copy(), pairs[:, 1].copy()))
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("held_out", ~in_training())
    rows = written(src.mapInArrow(_score(sent, hot), _SCORE), "lm-scores")
    rest = rows.select("rid", F.explode(F.arrays_zip("words", "times")).alias("w")).select("rid", F.col("w.words").alias("key"), F.col("w.times").alias("times"))
    cold = rest.join(vocabulary, "key").groupBy("rid").agg(
        F.sum("times").alias("cold_known"), F.sum(F.col("times") * F.log10(F.col("n") + F.lit(1.0))).alias("cold_log"))
    size = float(total[0] + total[1] + 1)
    zero = F.lit(0.0)
    return rows.drop("words", "times").join(cold, "rid", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("hot_known") + F.coalesce("cold_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(int(total[0])).cast("long").alias("train_tokens"),
        (F.col("hot_log") + F.coalesce("cold_log", zero) - F.col("n_tokens") * F.log10(F.lit(size))).alias("base_score"), "score",
        (-F.col("score") * float(np.log2(10.0)) / F.col("n_bytes")).alias("bits_per_byte"))


def language_scores(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) to doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score, bits_per_byte, one row per input row.

    ``score`` is the log10 probability of the text's tokens, bit by bit.  Null
    and empty texts, and texts of white space, are one end token.  A null
    doc_id is learned from; repeated ids and texts count as often as they
    occur.  Without training texts every bit has probability one half.  Words
    are told apart by a 64-bit hash.  Memory of a task grows with its longest
    text only.  An empty table gives an empty result.
    """
    counts = gather(docs)
    return scores(docs, counts, fit(counts))
