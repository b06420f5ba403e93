"""Scan for secrets: base patterns, and formats learned by grammar inference.

A first pass over the texts gathers the values that the base patterns label and
a sample of ordinary runs of credential characters, both bounded; each kind, and
the ordinary runs as background, trains a probabilistic automaton
(``grammar.learn``).  A second pass scores every run of the least learned length
or more, and its parts between ``=`` and ``/``: what lies outside the base spans
and is far likelier in a learned format than as an ordinary run becomes a span
of kind ``format``.  Base spans are scored too.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourglass.llm.grammar import Automaton, learn
from hourglass.llm.spans import join_documents, runs
from hourglass.llm.support import binary_values, chunks, discard, materialize

#: Distinct values per kind, and ordinary runs, that train an automaton: those with the smallest hashes.
TRAINING_VALUES, ORDINARY_RUNS = 1000, 4000
#: A kind with fewer distinct labelled values learns no format; longer values are no examples of one.
MIN_VALUES, MAX_LENGTH = 10, 128
#: log10 of how much likelier than an ordinary run a format has to make a value.
MARGIN = 6.0
#: Verdicts of runs that a task keeps.
CACHE = 1 << 17
# The base patterns and the least length of what they match.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX_LONG = re.compile(r"[0-9a-f]{24,}")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24
ORDINARY = len(KINDS)
PARTS = re.compile(r"[^=/]+")
WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")


def _set(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


DIGITS = b"0123456789"
IN_HEX = _set(DIGITS + b"abcdef")


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, end, kind, labelled value) of the base matches, by start and kind.

    Matches are the leftmost that do not overlap, per kind; those that are too
    short are dropped after matching, so they still use up their characters.
    """
    found = [(m.start(), m.end(), 0, m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    found += [(m.start(), m.end(), 1, m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    found += [(m.start(), m.end(), 2, m[0]) for m in HEX_LONG.finditer(text)]
    return sorted(found, key=lambda x: (x[0], x[2]))


def run_pattern(least: int) -> re.Pattern[str]:
    """Whole runs of credential characters with at least ``least`` of them."""
    return re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{%d,}" % least)


def _suspects(docs: list[bytes]) -> list[bool]:
    """Which documents may hold a base match (never too few)."""
    buf, at = join_documents(docs)
    lo, hi = runs(IN_HEX[buf])
    hit = lo[hi - lo >= MIN_HEX]
    flags = np.zeros(len(docs), bool)
    flags[np.searchsorted(at, hit, "right") - 1] = True
    lower = buf.tobytes().lower()
    if b"akia" in lower or any(w in lower for w in WORDS):
        for i, d in enumerate(docs):
            low = d.lower()
            flags[i] |= b"akia" in low or any(w in low for w in WORDS)
    return flags.tolist()


class _Smallest:
    """The ``most`` distinct (hash, value) pairs with the smallest hashes."""

    def __init__(self, most: int) -> None:
        self.most, self.pairs, self.bar = most, set(), 1 << 32

    def add(self, pairs: Iterable[tuple[int, str]]) -> None:
        self.pairs.update(p for p in pairs if p[0] <= self.bar)
        if len(self.pairs) > 4 * self.most:
            self.trim()

    def trim(self) -> list[tuple[int, str]]:
        best = heapq.nsmallest(self.most, self.pairs)
        self.pairs = set(best)
        if len(best) == self.most:
            self.bar = best[-1][0]
        return best


def training_values(docs: DataFrame, text_col: str = "text", most: int = TRAINING_VALUES, ordinary: int = ORDINARY_RUNS) -> DataFrame:
    """``kind, h, value``: per task at most ``most`` labelled values of each kind by
    their hash, and ``ordinary`` runs without a base match (kind 3) by the hash of
    run and text, so that a run counts as often as there are texts that hold it."""
    pattern = run_pattern(MIN_ASSIGN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [_Smallest(most) for _ in KINDS] + [_Smallest(ordinary)]
        for batch in batches:
            texts = binary_values(batch.column(0))
            for lo, hi in chunks(texts):
                some = texts[lo:hi]
                for d, flag in zip(some, _suspects(some), strict=True):
                    text, seed = d.decode(), zlib.crc32(d)
                    usual = set(pattern.findall(text))
                    for _, _, kind, value in base_spans(text) if flag else ():
                        usual.discard(value)
                        if len(value) <= MAX_LENGTH:
                            found[kind].add([(zlib.crc32(value.encode()), value)])
                    bar = found[ORDINARY].bar
                    near = [(h, v) for v in usual if (h := zlib.crc32(v.encode(), seed)) <= bar]
                    found[ORDINARY].add(p for p in near if len(p[1]) <= MAX_LENGTH and not base_spans(p[1]))
        kept = [(k, h, v) for k, values in enumerate(found) for h, v in values.trim()]
        columns = [pa.array([x[n] for x in kept], t) for n, t in enumerate((pa.int32(), pa.int64(), pa.string()))]
        yield pa.RecordBatch.from_arrays(columns, ["kind", "h", "value"])

    return docs.select(text_col).mapInArrow(run, "kind int, h long, value string")


@dataclass
class Formats:
    """Automata of the kinds, the one of ordinary runs, and the least length learned."""

    kinds: dict[str, Automaton]
    ordinary: Automaton
    least: int

    def ratio(self, value: str) -> float:
        """log10 of how much likelier the best format makes ``value`` than the background does."""
        if not self.kinds:
            return -np.inf
        return max(a.total(value) for a in self.kinds.values()) - self.ordinary.total(value)

    def accepts(self, value: str) -> bool:
        """In reach of a format's own examples, and far from ordinary."""
        return any(a.accepts(value) for a in self.kinds.values()) and self.ratio(value) >= MARGIN

    def within(self, run: str) -> list[tuple[int, int]]:
        """(from, to) of the accepted value in ``run`` without dots at its ends, or
        of those of its parts between ``=`` and ``/`` where one of them is likelier
        in a format than the whole."""

        def accepted(lo: int, hi: int) -> list[tuple[float, int, int]]:
            part = run[lo:hi].rstrip(".")
            hi, lo = lo + len(part), lo + len(part) - len(part.lstrip("."))
            value = run[lo:hi]
            return [(self.ratio(value), lo, hi)] if hi - lo >= self.least and self.accepts(value) else []

        whole = accepted(0, len(run))
        parts = [x for m in PARTS.finditer(run) for x in accepted(*m.span())] if "=" in run or "/" in run else []
        best = parts if parts and (not whole or max(parts)[0] > whole[0][0]) else whole
        return [(f, t) for _, f, t in best]


def infer_formats(docs: DataFrame, text_col: str = "text", most: int = TRAINING_VALUES, ordinary: int = ORDINARY_RUNS) -> Formats:
    """Formats from at most ``most`` distinct values of each kind and ``ordinary``
    runs (a documented bound on what is fitted; every row is read).  The gathered values are removed
    from the shared folder when they have been read."""
    values = materialize(training_values(docs, text_col, most, ordinary), "labels")
    found: list[list[str]] = []
    try:
        for kind in range(ORDINARY + 1):
            mine = values.filter(F.col("kind") == kind).select("h", "value").distinct().orderBy("h", "value")
            found.append([r.value for r in mine.limit(ordinary if kind == ORDINARY else most).collect()])
    finally:
        discard(values)
    labelled = {v for some in found[:ORDINARY] for v in some}
    kinds = {k: learn(v) for k, v in zip(KINDS, found[:ORDINARY], strict=True) if len(v) >= MIN_VALUES}
    least = min((len(v) for some in found[:ORDINARY] if len(some) >= MIN_VALUES for v in some), default=MIN_ASSIGN)
    return Formats(kinds, learn([v for v in found[ORDINARY] if v not in labelled] or ["-"], folds=0, layered=False), least)


def _written(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{f}:{t}" for f, t, kind in spans)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", formats: Formats | None = None) -> DataFrame:
    """Per row ``doc_id, n_assign, n_access, n_hex, base_sha256, spans, scores``.

    Spans are kind:start:end in code points (end exclusive), by start, then
    kind; ``spans`` has the base spans and the learned ones (kind ``format``),
    which never overlap a base span.  ``scores`` has, for each of them, the log10
    likelihood ratio of its value (null without a learned format).  Null and
    empty texts have no spans; repeated rows
    are scanned each; an empty table, or one without labelled values, learns
    automata that accept nothing.  Other columns are not read.
    """
    formats = infer_formats(docs, text_col) if formats is None else formats
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = T.StructType(
        [T.StructField("doc_id", rows.schema[0].dataType)]
        + [T.StructField(n, T.LongType()) for n in ("n_assign", "n_access", "n_hex")]
        + [T.StructField(n, T.StringType()) for n in ("base_sha256", "spans")]
        + [T.StructField("scores", T.ArrayType(T.DoubleType()))]
    )
    order = (*KINDS, "format")
    pattern = run_pattern(formats.least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        verdicts: dict[str, list[tuple[int, int]]] = {}

        def learned(text: str) -> list[tuple[int, int, str]]:
            out = []
            for m in pattern.finditer(text):
                value = m[0]
                inside = verdicts.get(value)
                if inside is None:
                    inside = formats.within(value)
                    if len(value) <= MAX_LENGTH:
                        if len(verdicts) >= CACHE:
                            verdicts.clear()
                        verdicts[value] = inside
                out += [(m.start() + f, m.start() + t, "format") for f, t in inside]
            return out

        for batch in batches:
            texts = binary_values(batch.column(1))
            counts: list[list[int]] = [[], [], []]
            digests, spans, scores = [], [], []
            for lo, hi in chunks(texts):
                for d, flag in zip(texts[lo:hi], _suspects(texts[lo:hi]), strict=True):
                    text = d.decode()
                    base = base_spans(text) if flag else []
                    own = [(f, t, KINDS[k]) for f, t, k, _ in base]
                    values = {(f, t, KINDS[k]): v for f, t, k, v in base}
                    new = [x for x in learned(text) if not any(f < x[1] and x[0] < t for f, t, _ in own)] if formats.kinds else []
                    for k, kind in enumerate(KINDS):
                        counts[k].append(sum(x[2] == kind for x in own))
                    every = sorted(own + new, key=lambda x: (x[0], order.index(x[2])))
                    digests.append(hashlib.sha256(_written(own).encode()).hexdigest())
                    spans.append(_written(every))
                    scores.append([round(formats.ratio(values.get(x, text[x[0] : x[1]])), 3) if formats.kinds else None for x in every])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), *[pa.array(c, pa.int64()) for c in counts], pa.array(digests, pa.string()),
                    pa.array(spans, pa.string()), pa.array(scores, pa.list_(pa.float64())),
                ],
                schema.names,
            )

    return rows.mapInArrow(run, schema)
