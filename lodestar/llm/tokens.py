"""Token ids of whole texts, by the tokenizers library, each distinct piece once.

Texts are cut where the tokenizer's own rules always cut (between words), the
pieces of a run of texts are hashed and made distinct with numpy, unknown
ones are encoded, and the ids are put back together by gathers.  Ids are the
same as those of ``Tokenizer.encode`` over the whole text; strings of special
tokens in a text are ordinary text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa

from lodestar.llm import common
from lodestar.llm.common import byte_runs, word_hashes, word_spans

KNOWN_MAX = 500_000     # distinct pieces remembered per worker
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_STOP = np.zeros(256, bool)
_STOP[[0x2C, 0x2E]] = True      # , and .
_PRINT = np.zeros(256, bool)
_PRINT[0x21:0x7F] = True
_TWO = np.zeros(256, bool)
_TWO[0xC3:0xE0] = True          # first bytes of two-byte characters that are no white space
# one word of letters below U+0100, with a space before it or not
_PLAIN = re.compile(rb" ?(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")


def _byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies use for each byte."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    out, extra = [""] * 256, 0
    for b in range(256):
        if b in shown:
            out[b] = chr(b)
        else:
            out[b], extra = chr(256 + extra), extra + 1
    return out


def _cut_stops(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans that end in a letter and one stop become two."""
    if not len(s):
        return s, e
    long = e - s >= 2
    cut = long & _STOP[data[e - 1]] & _LETTER[data[np.maximum(e - 2, 0)]]
    n = 1 + cut
    at = np.cumsum(n) - n
    s2, e2 = np.empty(n.sum(), np.int64), np.empty(n.sum(), np.int64)
    s2[at], e2[at] = s, e - cut
    s2[at[cut] + 1], e2[at[cut] + 1] = e[cut] - 1, e[cut]
    return s2, e2


def _lead_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans that begin at a text's start or at one space or line end between two words."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z
    cut = np.zeros(n, bool)
    if n > 2:
        nxt = np.zeros(n, bool)
        nxt[:-1] = _PRINT[data[1:]] | _TWO[data[1:]]
        prv = np.zeros(n, bool)
        prv[1:] = _PRINT[data[:-1]]
        prv[2:] |= _TWO[data[:-2]]
        nxt[off[1:][off[1:] > 0] - 1] = False        # white space that ends its text
        prv[off[off < n]] = False
        one = nxt & prv
        line = one & (data == 10)
        cut = one & (data == 32) | line
        cut[1:] |= line[:-1]
    cut[off[off < n]] = True
    s = np.flatnonzero(cut)
    return s, np.append(s[1:], n)


def _gather(pool: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The spans of ``pool`` that begin at ``start``, end to end."""
    end = np.cumsum(size)
    return pool[np.repeat(start - (end - size), size) + np.arange(end[-1] if len(end) else 0)]


class PieceCache:
    """Ids of texts from the ids of their distinct pieces; a worker remembers
    up to ``KNOWN_MAX`` of them.  Subclasses say where texts are cut and how
    pieces are encoded."""

    def __init__(self):
        self._forget()

    def _forget(self):
        self.known = np.zeros(0, np.uint64)      # hashes in order; the arrays below go with them
        self.start, self.size, self.met = (np.zeros(0, np.int64) for _ in range(3))
        self.pool, self.used = np.zeros(16384, np.uint32), 0

    def _shrink(self):
        """Keep the pieces that most runs have met, at most half of them."""
        n = len(self.known)
        keep = self.met >= max(2, int(np.partition(self.met, n // 2)[n // 2]) + 1)
        known, size = self.known[keep], self.size[keep]
        ids = _gather(self.pool, self.start[keep], size)
        self._forget()
        self._put(known, np.zeros(len(known), np.int64), size, ids)

    def _put(self, hashes: np.ndarray, at: np.ndarray, size: np.ndarray, ids: np.ndarray):
        """Remember pieces: their hashes in order, the places of these among
        the known ones, numbers of ids, and ids end to end."""
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(len(self.pool), np.uint32)])
        self.pool[self.used:self.used + len(ids)] = ids
        start = self.used + np.cumsum(size) - size
        self.used += len(ids)
        self.known, self.start, self.size, self.met = (np.insert(x, at, v) for x, v in (
            (self.known, hashes), (self.start, start), (self.size, size), (self.met, 0)))

    def _prepare(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return raw, off

    def _spans(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raise TypeError("a subclass cuts the texts")

    def _encode(self, pieces: list[bytes]) -> list[list[int]]:
        raise TypeError("a subclass encodes the pieces")

    def runs(self, col: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first row, last row + 1, ids, row offsets into ids) for runs of rows."""
        for lo, hi, raw, raw_off in byte_runs(col):
            data, off = self._prepare(raw, raw_off)
            s, e = self._spans(data, off)
            if not len(s):
                yield lo, hi, np.zeros(0, np.uint32), np.zeros(hi - lo + 1, np.int64)
                continue
            uniq, first, inv = np.unique(word_hashes(data, s, e), return_index=True, return_inverse=True)
            if len(self.known) > KNOWN_MAX:
                self._shrink()
            slot = np.searchsorted(self.known, uniq)
            new = np.ones(len(uniq), bool)
            near = slot < len(self.known)
            new[near] = self.known[slot[near]] != uniq[near]
            if new.any():
                buf, at = data.tobytes(), first[new]
                got = self._encode([buf[a:b] for a, b in zip(s[at].tolist(), e[at].tolist())])
                self._put(uniq[new], slot[new], np.fromiter(map(len, got), np.int64, len(got)),
                          np.fromiter(chain.from_iterable(got), np.uint32))
                slot = slot + np.cumsum(new) - new      # places after the new ones came in
            self.met[slot] += 1
            slot = slot[inv]
            size = self.size[slot]
            ids = _gather(self.pool, self.start[slot], size)
            yield lo, hi, ids, np.concatenate([[0], np.cumsum(size)])[np.searchsorted(s, off)]


class Encoder(PieceCache):
    """Ids of texts by one vocabulary file.  ``lead``: pieces keep the space
    before a word (byte-level BPE); else white space is dropped and ASCII
    letters are lower-cased (word BPE)."""

    def __init__(self, path: str, lead: bool):
        from tokenizers import Tokenizer
        super().__init__()
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        self.lead = lead
        self.table = str.maketrans({chr(b): c for b, c in enumerate(_byte_letters())})

    def _prepare(self, raw, off):
        return (raw if self.lead else common._LOWER[raw]), off

    def _spans(self, data, off):
        return _cut_stops(data, *(_lead_spans(data, off) if self.lead else word_spans(data, off)))

    def _encode(self, pieces):
        plain, table, tokenize, tok = _PLAIN.fullmatch, self.table, self.tok.model.tokenize, self.tok
        space, out = table[32], []
        for p in pieces:
            if plain(p):        # one word of plain letters: the vocabulary's own letters for its bytes
                if p.isascii():     # ASCII letters are their own letters, only a space has another
                    text = space + p[1:].decode() if p[0] == 32 else p.decode()
                else:
                    text = (p if self.lead else p.decode().lower().encode()).decode("latin-1").translate(table)
                out.append([t.id for t in tokenize(text)])
            else:
                out.append(tok.encode(p.decode(), add_special_tokens=False).ids)
        return out


_OPEN: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, lead: bool) -> Encoder:
    """The worker's encoder of a file (workers live for many tasks)."""
    if (path, lead) not in _OPEN:
        _OPEN[path, lead] = Encoder(path, lead)
    return _OPEN[path, lead]
