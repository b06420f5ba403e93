"""Subword pieces: unigram Viterbi over a double-array trie, and decoding.

The vocabulary (pieces and their ranks) is read from a public SentencePiece
model; nothing is trained.  Its pieces get log scores from their ranks by
Zipf's law, a fixed rule.  A text becomes units (a run of spaces and what
follows up to the next space), as no piece crosses such a border; the best
segmentation of each distinct unit maximises the sum of log scores.  What no
piece covers is written as byte pieces, so decoding gives back every text.

Inside the trie the white-space marker is the space itself; a literal marker
character in a text is thus told apart from a space, and survives.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourglass.llm.spans import SpanCache, gather, join_documents, spans_between
from hourglass.llm.support import binary_values, chunks

MARKER = "▁"
#: What an uncovered character costs below the least likely piece.
UNKNOWN = 10.0
#: Longest unit (bytes) that is segmented together with others.
TOGETHER = 64


@dataclass
class Vocabulary:
    """``texts[id]`` bytes of each piece (b"" for control pieces), ``scores[id]``
    its log score, ``byte_ids[value]`` the id of each byte piece, and the trie:
    state ``t = base[s] + byte + 1`` follows ``s`` if ``check[t] == s``;
    ``piece[t]`` is the id of the piece that ends there, or -1."""

    texts: list[bytes]
    scores: np.ndarray
    byte_ids: np.ndarray
    base: np.ndarray
    check: np.ndarray
    piece: np.ndarray


def double_array(keys: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Base, check and value arrays of a trie over bytes.

    Sorted keys are split by their next byte, level by level; each state's
    children go to the first place where all their slots are free.
    """
    names = sorted(keys)
    size = 1 << 10
    base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    check[0], first = 0, 1
    work = [(0, 0, len(names), 0)]  # state, range of keys, depth
    while work:
        following = []
        for state, lo, hi, depth in work:
            if len(names[lo]) == depth:
                value[state] = keys[names[lo]]
                lo += 1
            if lo == hi:
                continue
            codes, cuts = [], []
            for k in range(lo, hi):
                c = names[k][depth]
                if not codes or codes[-1] != c:
                    codes.append(c)
                    cuts.append(k)
            slots = np.array(codes) + 1
            while check[first] >= 0:
                first += 1
            window, b = 1 << 10, -1
            while b < 0:
                if first + window + 600 > len(check):
                    base = np.concatenate((base, np.zeros(len(base) + window, np.int32)))
                    more = np.full(len(check) + window, -1, np.int32)
                    check, value = np.concatenate((check, more)), np.concatenate((value, more))
                free = np.flatnonzero(check[first : first + window] < 0) + first - slots[0]
                free = free[free >= 0]
                fits = (check[free[:, None] + slots] < 0).all(axis=1)
                b = int(free[fits.argmax()]) if fits.any() else -1
                window *= 4
            base[state] = b
            check[b + slots] = state
            following += [(b + c + 1, f, t, depth + 1) for c, f, t in zip(codes, cuts, [*cuts[1:], hi], strict=True)]
        work = following
    pad = np.full(258, -1, np.int32)
    return np.concatenate((base, np.zeros(258, np.int32))), np.concatenate((check, pad)), np.concatenate((value, pad))


def load_vocabulary(path: str) -> Vocabulary:
    """Pieces of a SentencePiece model with Zipf log scores by rank."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    texts, byte_ids, keys = [], np.full(256, -1, np.int32), {}
    for i in range(model.get_piece_size()):
        if model.is_byte(i):
            value = int(model.id_to_piece(i)[1:-1], 16)
            byte_ids[value] = i
            texts.append(bytes([value]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            texts.append(b"")
        else:
            texts.append(model.id_to_piece(i).replace(MARKER, " ").encode())
            keys[texts[i]] = i
    return make_vocabulary(texts, keys, byte_ids)


def make_vocabulary(texts: list[bytes], keys: dict[bytes, int], byte_ids: np.ndarray) -> Vocabulary:
    scores = np.zeros(len(texts))
    ranked = np.array(sorted(keys.values()), np.int64)
    weight = 1.0 / (np.arange(len(ranked)) + 2.7)
    scores[ranked] = np.log(weight / weight.sum())
    return Vocabulary(texts, scores, byte_ids, *double_array(keys))


def _char_bytes(lead: np.ndarray) -> np.ndarray:
    return 1 + (lead >= 0xC0) + (lead >= 0xE0) + (lead >= 0xF0)


class Encoder:
    """Encodes and decodes with one vocabulary; remembers distinct units in a
    cache of bounded size, which ``encode_documents`` empties after each task."""

    def __init__(self, v: Vocabulary) -> None:
        self.v = v
        self.cache = SpanCache()
        self.worst = float(v.scores.min()) - UNKNOWN
        self.lists = (v.base.tolist(), v.check.tolist(), v.piece.tolist(), v.scores.tolist())
        self.longest = max((len(t) for t in v.texts), default=1)

    def _one(self, unit: bytes) -> list[int]:
        """Viterbi of a single unit of any length."""
        base, check, piece, scores = self.lists
        n = len(unit)
        best, back = [-np.inf] * (n + 1), [(0, -1)] * (n + 1)
        best[0] = 0.0
        for p in range(n):
            if best[p] == -np.inf:
                continue
            width = 1 + (unit[p] >= 0xC0) + (unit[p] >= 0xE0) + (unit[p] >= 0xF0)
            state, covered = 0, False
            for e in range(p, min(n, p + self.longest)):
                t = base[state] + unit[e] + 1
                if check[t] != state:
                    break
                state = t
                if (i := piece[t]) >= 0:
                    covered |= e + 1 - p == width
                    if best[p] + scores[i] > best[e + 1]:
                        best[e + 1], back[e + 1] = best[p] + scores[i], (p, i)
            if not covered and best[p] + self.worst > best[min(p + width, n)]:
                best[min(p + width, n)], back[min(p + width, n)] = best[p] + self.worst, (p, -1)
        out: list[list[int]] = []
        while n:
            p, i = back[n]
            out.append([i] if i >= 0 else self.v.byte_ids[list(unit[p:n])].tolist())
            n = p
        return [i for part in reversed(out) for i in part]

    def _many(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Viterbi of units of similar length, place by place over all of them."""
        v, n, most = self.v, len(units), max(map(len, units))
        size = np.array([len(u) for u in units])
        text = np.zeros((n, most + 4), np.uint8)
        flat = np.frombuffer(b"".join(units), np.uint8)
        text[np.arange(most + 4) < size[:, None]] = flat
        best = np.full((n, most + 1), -np.inf)
        best[:, 0] = 0.0
        came, which = np.zeros((n, most + 1), np.int16), np.full((n, most + 1), -1, np.int32)
        for p in range(most):
            rows = np.flatnonzero((p < size) & (best[:, p] > -np.inf))
            if not len(rows):
                continue
            start, state = best[rows, p], np.zeros(len(rows), np.int32)
            width = _char_bytes(text[rows, p])
            bare = np.ones(len(rows), bool)
            live = np.arange(len(rows))
            for e in range(p, most):
                t = v.base[state] + text[rows[live], e] + 1
                ok = (v.check[t] == state) & (e < size[rows[live]])
                live, state = live[ok], t[ok]
                if not len(live):
                    break
                ends = v.piece[state]
                hit = ends >= 0
                who, ids = live[hit], ends[hit]
                bare[who[width[who] == e + 1 - p]] = False
                score = start[who] + v.scores[ids]
                up = score > best[rows[who], e + 1]
                at = rows[who[up]]
                best[at, e + 1], came[at, e + 1], which[at, e + 1] = score[up], p, ids[up]
            who = np.flatnonzero(bare)
            to = np.minimum(p + width[who], size[rows[who]])
            up = start[who] + self.worst > best[rows[who], to]
            at, to = rows[who[up]], to[up]
            best[at, to], came[at, to], which[at, to] = start[who[up]] + self.worst, p, -1
        # Back from the end: mark the last byte of each piece, or all bytes of an uncovered character.
        ids, place = np.full((n, most), -1, np.int32), size.copy()
        while len(rows := np.flatnonzero(place > 0)):
            end = place[rows]
            p, i = came[rows, end].astype(np.int64), which[rows, end]
            ids[rows, end - 1] = i
            for k in range(4):
                raw = (i < 0) & (p + k < end)
                ids[rows[raw], p[raw] + k] = v.byte_ids[text[rows[raw], p[raw] + k]]
            place[rows] = p
        used = ids >= 0
        return ids[used], used.sum(axis=1)

    def _units(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        size = np.array([len(u) for u in units])
        order = np.argsort(size, kind="stable")
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        edges = np.searchsorted(size[order], [0, 9, 17, 33, TOGETHER + 1])
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            if lo < hi:
                parts.append(self._many([units[k] for k in order[lo:hi]]))
        for k in order[edges[-1] :]:
            one = np.array(self._one(units[k]), np.int32)
            parts.append((one, np.array([len(one)])))
        values, lengths = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        at = np.cumsum(lengths) - lengths
        back = np.argsort(order, kind="stable")
        return gather(values, at[back], lengths[back]), lengths[back]

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in order, and where each text's ids start (plus the end).

        A text that is not empty gets one marker in front, as the library does.
        """
        docs = [b" " + t if t else b"" for t in texts]
        buf, at = join_documents(docs)
        space = buf == 0x20
        cut = space.copy()
        cut[1:] &= ~space[:-1]
        starts, ends = spans_between(buf, at, cut)
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        ids, lengths = self.cache.values(buf, starts, ends, self._units)
        upto = np.concatenate(([0], np.cumsum(lengths)))
        return ids, upto[np.searchsorted(starts, at)]

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of one document's ids, without the marker in front."""
        return b"".join([self.v.texts[i] for i in ids.tolist()])[1:]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str, vocabulary: Vocabulary | None = None) -> Encoder:
    """The encoder of a model file, kept per process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(vocabulary or load_vocabulary(path))
    return _ENCODERS[path]


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encode_documents(docs: DataFrame, model: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_pieces, n_byte_pieces, ids, ids_crc32, round_trip`` per row.

    ``ids_crc32`` is over the ids as little-endian 32-bit integers;
    ``round_trip``: decoding the ids gives the whole text back.  Null and empty
    texts have no ids.  Rows are encoded one by one: null and repeated ids pass
    through, an empty table gives no rows, other columns are not read.
    """
    path = model or default_model()
    rows = docs.select(F.col(id_col).alias("doc_id"), text_col)
    # The vocabulary, of fixed size, is built once and sent to all tasks.
    shared = docs.sparkSession.sparkContext.broadcast(encoder(path).v)
    schema = T.StructType(
        [
            rows.schema[0], T.StructField("n_pieces", T.LongType()), T.StructField("n_byte_pieces", T.LongType()),
            T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("ids_crc32", T.LongType()),
            T.StructField("round_trip", T.BooleanType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, shared.value)
        raw = np.zeros(len(own.v.texts), bool)
        raw[own.v.byte_ids[own.v.byte_ids >= 0]] = True
        for batch in batches:
            texts = binary_values(batch.column(1))
            for lo, hi in chunks(texts):
                ids, at = own.encode(texts[lo:hi])
                ids = ids.astype("<i4")
                bytes_upto = np.concatenate(([0], np.cumsum(raw[ids])))
                parts = [ids[f:t] for f, t in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo), pa.array(np.diff(at), pa.int64()), pa.array(np.diff(bytes_upto[at]), pa.int64()),
                        pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32())),
                        pa.array([zlib.crc32(p.tobytes()) for p in parts], pa.int64()),
                        pa.array([own.decode(p) == t for p, t in zip(parts, texts[lo:hi], strict=True)], pa.bool_()),
                    ],
                    schema.names,
                )
        own.cache.clear()  # the worker lives on, its memory is wanted by other stages

    return rows.mapInArrow(run, schema)
