"""Vectorised words and span hashes over UTF-8 buffers (numpy).

A chunk of documents is one byte buffer in which the documents are joined by
a line feed; words, tokens or shingles of all of them are then found and
hashed by a few array operations.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
_MULT = 0x9E3779B97F4A7C15
_BASE = 0xD1342543DE82EF95
_TABLES: dict[str, np.ndarray] = {}
#: Longest power tables that a worker keeps (16 bytes a place).
KEPT_PLACES = 3 << 20


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift-multiply rounds)."""
    x = x + U64((seed * _MULT + 0x2545F4914F6CDD1D) & (2**64 - 1))
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, for n places; kept
    for the next buffer unless this one is unusually long."""
    have = _TABLES.get("pow")
    if have is not None and len(have) >= n:
        return have, _TABLES["back"]
    n = max(n, 1 << 16)
    step, back = np.full(n, _BASE, U64), np.full(n, pow(_BASE, -1, 2**64), U64)
    step[0] = back[0] = 1
    power, back = np.cumprod(step), np.cumprod(back)
    if n <= KEPT_PLACES:
        _TABLES["pow"], _TABLES["back"] = power, back
    return power, back


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span; equal bytes give equal hashes in
    every chunk and task (a polynomial over random byte values, then mixed)."""
    if "byte" not in _TABLES:
        _TABLES["byte"] = mix(np.arange(256, dtype=U64), 7)
    power, back = _powers(len(buf) + 1)
    prefix = np.empty(len(buf) + 1, U64)
    prefix[0] = 0
    np.cumsum(_TABLES["byte"][buf] * power[: len(buf)], out=prefix[1:])
    return mix((prefix[ends] - prefix[starts]) * back[starts] + (ends - starts).astype(U64))


def _white() -> np.ndarray:
    if "white" not in _TABLES:
        _TABLES["white"] = np.zeros(256, bool)
        _TABLES["white"][[0x20, *range(0x09, 0x0E)]] = True
    return _TABLES["white"]


def join_documents(docs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The documents as one buffer, and where each starts (plus the end)."""
    buf = np.frombuffer(b"\n".join([*docs, b""]), np.uint8)
    at = np.zeros(len(docs) + 1, np.int64)
    np.cumsum([len(d) + 1 for d in docs], out=at[1:])
    return buf, at


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    return edge[::2], edge[1::2]


def words_of(docs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` of all documents in order,
    and the index of each document's first word (plus the end)."""
    buf, at = join_documents(docs)
    starts, ends = runs(~_white()[buf])
    return span_hashes(buf, starts, ends), np.searchsorted(starts, at)


def segments(lengths: np.ndarray) -> np.ndarray:
    """0, 1, .. within each of the given lengths, one after another."""
    total = int(lengths.sum())
    return np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def gather(flat: np.ndarray, offsets: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenate the slices ``flat[o : o + n]``."""
    return flat[np.repeat(offsets, lengths) + segments(lengths)]


class SpanCache:
    """Values (runs of int32) of the spans that were seen before.

    Text repeats its words; a value is computed once per distinct span.  All is
    held in arrays; before they would take more than ``limit`` bytes, the cache
    starts anew.
    """

    #: Bytes of a span besides its values: hash, order, offset and length.
    SPAN_BYTES = 28

    def __init__(self, limit: int = 48 << 20) -> None:
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.keys, self.place = np.empty(0, U64), np.empty(0, np.int64)
        self.flat, self.used, self.spans = np.empty(1 << 12, np.int32), 0, 0
        self.at, self.len = np.empty(1 << 12, np.int64), np.empty(1 << 12, np.int32)

    @staticmethod
    def _room(a: np.ndarray, n: int) -> np.ndarray:
        return a if n <= len(a) else np.concatenate((a, np.empty(max(n - len(a), len(a) // 2), a.dtype)))

    def _add(self, hashes: np.ndarray, before: np.ndarray, values: np.ndarray, lengths: np.ndarray) -> None:
        n, k = self.spans, len(hashes)
        self.at, self.len = self._room(self.at, n + k), self._room(self.len, n + k)
        self.flat = self._room(self.flat, self.used + len(values))
        self.flat[self.used : self.used + len(values)] = values
        self.at[n : n + k] = self.used + np.cumsum(lengths) - lengths
        self.len[n : n + k] = lengths
        self.used, self.spans = self.used + len(values), n + k
        self.keys, self.place = np.insert(self.keys, before, hashes), np.insert(self.place, before, np.arange(n, n + k))

    def values(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, compute) -> tuple[np.ndarray, np.ndarray]:
        """The values of all spans in order, and how many each span has.
        ``compute(list of bytes) -> (values, lengths)`` gives those of new spans."""
        distinct, first, back = np.unique(span_hashes(buf, starts, ends), return_index=True, return_inverse=True)
        if (self.spans + len(distinct)) * self.SPAN_BYTES + 4 * self.used > self.limit:
            self.clear()
        before = np.searchsorted(self.keys, distinct)
        new = np.ones(len(distinct), bool)
        inside = before < len(self.keys)
        new[inside] = self.keys[before[inside]] != distinct[inside]
        if new.any():
            data = buf.tobytes()
            own = first[new]
            self._add(distinct[new], before[new], *compute([data[f:t] for f, t in zip(starts[own].tolist(), ends[own].tolist(), strict=True)]))
        place = self.place[np.searchsorted(self.keys, distinct)][back]
        lengths = self.len[place].astype(np.int64)
        return gather(self.flat, self.at[place], lengths), lengths


def spans_between(buf: np.ndarray, at: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the units of joined documents: each begins where
    ``cut`` says so or where its document does."""
    cut = cut.copy()
    cut[at[:-1]] = True
    cut[at[1:] - 1] = False  # the line feeds between documents; an empty one has no unit
    starts = np.flatnonzero(cut)
    if not len(starts):
        return starts, starts
    ends = np.minimum(np.append(starts[1:], len(buf)), (at[1:] - 1)[np.searchsorted(at, starts, "right") - 1])
    return starts, ends
