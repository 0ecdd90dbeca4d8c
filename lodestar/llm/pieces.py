"""SentencePiece ids of whole texts and back, with a prefix-shared forward pass.

Texts are cut into marked words (a run of marks and the characters up to the
next mark), the distinct ones of a run of texts are sorted, and the sorted
list is walked as a trie, depth first: the forward state of every prefix (the
last piece of its best path and where it begins) is kept on the stack and
shared by all words that continue the prefix.

Which path is best follows the model.  This model is a byte-pair one: its
scores are merge ranks, and the path with the highest sum of scores is not
what merging gives.  So a transition is admitted only if merging the two
pieces' characters gives just these two pieces; exactly one path per prefix
has only admitted transitions, and it is the merge result.  Ids equal those
of the sentencepiece library.  Characters without a piece fall back to bytes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.llm.common import text_array
from lodestar.llm.tokens import PieceCache

MARK = "▁"
FITS_MAX = 400_000     # pairs of pieces remembered per worker
SHORT = (2, 1)          # lengths to try where no longer piece ends alike


class Model:
    """The pieces of a model file."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb
        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        spec = proto.normalizer_spec
        if proto.trainer_spec.model_type != 2 or spec.name != "identity" or spec.remove_extra_whitespaces or not spec.add_dummy_prefix:
            raise ValueError("expected a byte-pair model without normalisation and with a leading mark")
        self.id = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == 1}
        self.score = {p.piece: p.score for p in proto.pieces if p.type == 1}
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == 6}
        # lengths of the pieces that end in the same three characters, longest first
        found: dict[str, set[int]] = {}
        for p in self.id:
            if len(p) >= 3:
                found.setdefault(p[-3:], {1, 2}).add(len(p))
        self.ends = {k: tuple(sorted(v, reverse=True)) for k, v in found.items()}
        raw = [p.piece.replace(MARK, " ").encode() if p.type == 1 else bytes([int(p.piece[3:5], 16)]) if p.type == 6 else b""
               for p in proto.pieces]
        self.size = np.array([len(x) for x in raw])
        self.start = np.cumsum(self.size) - self.size
        self.pool = np.frombuffer(b"".join(raw), np.uint8)
        self._fits: dict[int, bool] = {}

    def merged(self, text: str) -> list[str]:
        """Pieces of a short string by merging the best pair, leftmost first."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _merges(self, left: str, right: str) -> bool:
        return self.merged(left + right) == ([left, right] if left else [right])

    def walk(self, words: list[str]) -> list[list[int]]:
        """Ids of sorted distinct words, sharing the states of common prefixes.

        The state of a prefix is the last piece of its one admitted path: its
        text, its number (characters without a piece have numbers of their
        own, above all ids) and where it begins."""
        if len(self._fits) > FITS_MAX:
            self._fits.clear()
        ids, ends, fits, none = self.id, self.ends, self._fits, len(self.score) + 1000
        out, before = [], ""
        last, number, back = [""], [none + 0x110000], [0]
        for word in words:
            n, same = len(word), 0
            top = min(n, len(before))
            while same < top and word[same] == before[same]:
                same += 1
            del last[same + 1:], number[same + 1:], back[same + 1:]
            for end in range(same + 1, n + 1):
                for size in ends.get(word[end - 3:end] if end > 2 else "", SHORT):
                    begin = end - size
                    if begin < 0:
                        continue
                    piece = word[begin:end]
                    i = ids.get(piece)
                    if i is None:
                        continue
                    key = i << 22 | number[begin]
                    ok = fits.get(key)
                    if ok is None:
                        ok = fits[key] = self._merges(last[begin], piece)
                    if ok:
                        break
                else:       # a character that no piece holds
                    begin, piece = end - 1, word[end - 1]
                    i = none + ord(piece)
                last.append(piece)
                number.append(i)
                back.append(begin)
            path, at = [], n
            while at:
                i = number[at]
                path += [i] if i < none else [self.bytes[b] for b in reversed(last[at].encode())]
                at = back[at]
            out.append(path[::-1])
            before = word
        return out

    def text(self, ids: np.ndarray) -> bytes:
        """The bytes of one text's ids."""
        size = self.size[ids]
        end = np.cumsum(size)
        out = self.pool[np.repeat(self.start[ids] - (end - size), size) + np.arange(end[-1] if len(end) else 0)]
        return out.tobytes()[1:]        # without the leading mark


class PieceEncoder(PieceCache):
    def __init__(self, path: str):
        super().__init__()
        self.model = Model(path)

    def _prepare(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A mark (a space) before every text that isn't empty; marks that the
        text holds are spaces."""
        buf = raw.tobytes()
        if MARK.encode() in buf:
            texts = [buf[a:b].replace(MARK.encode(), b" ") for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
            raw = np.frombuffer(b"".join(texts), np.uint8)
            off = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        some = np.diff(off) > 0
        data = np.insert(raw, off[:-1][some], 32)
        return data, off + np.concatenate([[0], np.cumsum(some)])

    def _spans(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(data):
            z = np.zeros(0, np.int64)
            return z, z
        space = data == 32
        cut = space.copy()
        cut[1:] &= ~space[:-1]
        cut[off[off < len(data)]] = True
        s = np.flatnonzero(cut)
        return s, np.append(s[1:], len(data))

    def _encode(self, pieces: list[bytes]) -> list[list[int]]:
        words = [p.decode().replace(" ", MARK) for p in pieces]
        order = sorted(range(len(words)), key=words.__getitem__)
        out: list[list[int]] = [[]] * len(words)
        for i, path in zip(order, self.model.walk([words[i] for i in order])):
            out[i] = path
        return out


_OPEN: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """The worker's encoder of a model file."""
    if path not in _OPEN:
        _OPEN[path] = PieceEncoder(path)
    return _OPEN[path]


def digests(docs: DataFrame, model: str) -> DataFrame:
    """``docs`` (doc_id, text), encoded and decoded again in one pass: doc_id,
    n_ids, ids_crc32, decoded_crc32 and whether the text came back (``same``).
    Empty and odd rows are as in ``encode``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model)
        for batch in batches:
            col = text_array(batch)
            for lo, hi, ids, off in enc.runs(col):
                texts = col.slice(lo, hi - lo).to_pylist()
                out: list[list] = [[], [], [], []]
                for text, a, b in zip(texts, off[:-1].tolist(), off[1:].tolist()):
                    back = enc.model.text(ids[a:b])
                    for k, v in enumerate((b - a, zlib.crc32(ids[a:b].astype("<u4").tobytes()), zlib.crc32(back),
                                           back == text.replace(MARK, " ").encode())):
                        out[k].append(v)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), *(pa.array(x, pa.int64()) for x in out[:3]),
                                                  pa.array(out[3], pa.bool_())], names=["doc_id", "n_ids", "ids_crc32", "decoded_crc32", "same"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_ids long, ids_crc32 long, decoded_crc32 long, same boolean")


def _clash_free(df: DataFrame, names: list[str]) -> DataFrame:
    return df.drop(*[n for n in names if n in df.columns])


def encode(docs: DataFrame, model: str) -> DataFrame:
    """``docs`` with ``text`` to its rows with ``ids`` (array<int>) and
    ``ids_crc32`` (of the ids as little-endian unsigned 32-bit integers).

    Null and empty texts have no ids.  Columns of these names that ``docs``
    already has are replaced.  Marks (U+2581) in a text are spaces.
    """
    src = _clash_free(docs, ["ids", "ids_crc32"])
    schema = T.StructType([*src.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("ids_crc32", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model)
        for batch in batches:
            for lo, hi, ids, off in enc.runs(text_array(batch)):
                crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(ids.astype(np.int32))),
                     pa.array(crc, pa.int64())], names=schema.names)
    return src.mapInArrow(run, schema)


def decode(docs: DataFrame, model: str) -> DataFrame:
    """``docs`` with ``ids`` to its rows with ``decoded`` (string; null ids:
    empty); bytes that are no UTF-8 become U+FFFD."""
    src = _clash_free(docs, ["decoded"])
    schema = T.StructType([*src.schema.fields, T.StructField("decoded", T.StringType())])
    at = src.columns.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = encoder(model).model
        for batch in batches:
            col = batch.column(at)
            off, flat = col.offsets.to_numpy(), np.asarray(col.values)
            texts = [m.text(flat[a:b]).decode("utf-8", "replace") for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=schema.names)
    return src.mapInArrow(run, schema)
