"""Language-model scores from a weighted backoff automaton.

The model is a smoothed bigram: states are the words seen in training (and
the start of a text), an arc of state h with word w has the weight
``(c(h, w) + MU p(w)) / (c(h) + MU)``, and a state's failure arc leads to the
empty state with weight ``MU / (c(h) + MU)``, where ``p(w)`` is the additive
unigram.  A text is traversed once from left to right; the state carried is the
last word, and log-probabilities add up.

No task holds the whole automaton.  Each block of documents takes the arcs that
its own texts can use: one pass over the texts writes every block's tokens to
the shared folder and sends its distinct n-grams, by ranges of their hashes, to
be counted; each block gets the counts of its own n-grams back and reads its
tokens again.  Words and pairs are identified by 63-bit hashes.

A task counts one group of n-grams at a time, ``1 / (GROUPS * shuffle
partitions)`` of all: ``spark.sql.shuffle.partitions`` has to grow with the input.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourglass.llm.files import commit_file, located
from hourglass.llm.near_dedup import _groups
from hourglass.llm.spans import U64, mix, words_of
from hourglass.llm.support import binary_values, chunks, materialize, shared_path

#: Pseudo-count of the backoff distribution, and of each unigram.
MU, ADD = 2.0, 0.1
#: Bytes of text in a block, and groups of n-grams per shuffle partition.
BLOCK_BYTES, GROUPS = 4 << 20, 8
#: Hashes of words (and the end) are even, those of pairs (and the start) odd.
END, START = U64(2), U64(3)
ODD = U64(1)
#: Stands for a null id in a block file.
NO_ID = -(2**63)


class Grams:
    """The n-grams of a block of documents with ``words[at[k]:at[k + 1]]`` each.

    ``keys`` are the sorted hashes of the distinct words, pairs and the start;
    ``token``, ``state`` and ``pair`` give each token's places among them, and
    ``doc`` its document.
    """

    def __init__(self, words: np.ndarray, at: np.ndarray) -> None:
        sizes = np.diff(at) + 1
        ends = np.cumsum(sizes)
        tokens = np.full(int(sizes.sum()), END, U64)
        inside = np.ones(len(tokens), bool)
        inside[ends - 1] = False
        tokens[inside] = words & ~ODD
        single, token = np.unique(np.append(tokens, START), return_inverse=True)
        # The state before a token is the word before it; the start before the first of a text.
        state = np.concatenate((token[-1:], token[:-2]))
        state[ends - sizes] = token[-1]
        tokens, token = single[token[:-1]], token[:-1]
        double, pair = np.unique(mix(mix(single[state], 31) + tokens, 32) | ODD, return_inverse=True)
        both = np.concatenate((single, double))
        order = np.argsort(both)
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        self.keys, self.token, self.state, self.pair = both[order], place[token], place[state], place[len(single) + pair]
        self.start, self.doc = place[np.searchsorted(single, START)], np.repeat(np.arange(len(sizes)), sizes)

    def counts(self, train: np.ndarray) -> np.ndarray:
        """How often each key occurs in the documents with ``train``."""
        mine = train[self.doc]
        n = np.bincount(self.token[mine], minlength=len(self.keys)) + np.bincount(self.pair[mine], minlength=len(self.keys))
        n[self.start] = train.sum()
        return n


def _small(n: np.ndarray) -> bytes:
    """Counts in the narrowest type that holds them all."""
    return n.astype(np.min_scalar_type(n.max(initial=0))).tobytes()


def _wide(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, f"<u{len(data) // n}").astype(np.int64) if n else np.zeros(0, np.int64)


def _planes(keys: np.ndarray) -> bytes:
    """Sorted keys as the byte planes of their steps: the high planes are nearly
    all zero, which the compression of the shuffle makes use of."""
    return np.ascontiguousarray(np.diff(keys, prepend=U64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _unplanes(data: bytes) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<u8").ravel()
    return np.cumsum(steps, dtype=U64)


def _block_bytes(ids: np.ndarray, held: np.ndarray, at: np.ndarray, words: np.ndarray) -> bytes:
    """A block file: sizes, ids, held-out flags, offsets, the distinct words by
    falling count, and each word's rank as compressed byte planes."""
    distinct, rank, n = np.unique(words, return_inverse=True, return_counts=True)
    order = np.argsort(-n, kind="stable")
    to = np.empty(len(order), "<u4")
    to[order] = np.arange(len(order))
    ranks = np.ascontiguousarray(to[rank].view(np.uint8).reshape(-1, 4).T).tobytes()
    head = np.array([len(ids), len(distinct)], "<i8")
    return b"".join([x.tobytes() for x in (head, ids, at, distinct[order], held)] + [zlib.compress(ranks, 1)])


def _read_block(folder: str, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    store, root = located(folder)
    with store.open_input_stream(f"{root}/{block}.tok") as file:
        data = file.read()
    n, v = np.frombuffer(data, "<i8", 2).tolist()
    ids, at = np.frombuffer(data, "<i8", n, 16), np.frombuffer(data, "<i8", n + 1, 16 + 8 * n)
    distinct = np.frombuffer(data, "<u8", v, 24 + 16 * n).astype(U64)
    held = np.frombuffer(data, bool, n, 24 + 16 * n + 8 * v)
    ranks = np.frombuffer(zlib.decompress(data[24 + 17 * n + 8 * v :]), np.uint8).reshape(4, -1)
    return ids, held, at, distinct[np.ascontiguousarray(ranks.T).view("<u4").ravel()]


_SENT = T.StructType(
    [T.StructField(c, T.LongType()) for c in ("group", "block")] + [T.StructField(c, T.BinaryType()) for c in ("keys", "counts")]
)
_SENT_ARROW = pa.schema([("group", pa.int64()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])


def _sent(docs: DataFrame, folder: str, groups: int) -> DataFrame:
    """Writes the blocks' files; a row per block and group with the n-grams of
    that range of hashes and their counts in the block's training documents.

    A block's number is its partition and place in it, the same in every attempt.
    """
    edges = np.array([-(-(k << 64) // groups) for k in range(groups)], U64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            names, texts = batch.column(0).to_pylist(), binary_values(batch.column(1))
            for lo, hi in chunks(texts, BLOCK_BYTES):
                parts = [words_of([t.lower() for t in texts[lo + f : lo + t]]) for f, t in chunks(texts[lo:hi])]
                at = np.concatenate(([0], np.cumsum(np.concatenate([np.diff(a) for _, a in parts])))).astype(np.int64)
                ids = np.array([NO_ID if i is None else i for i in names[lo:hi]], np.int64)
                held = np.array([i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i in names[lo:hi]], bool)
                words = np.concatenate([w for w, _ in parts])
                commit_file(folder, f"{block}.tok", _block_bytes(ids, held, at, words))
                grams = Grams(words, at)
                n, cut = grams.counts(~held), np.append(np.searchsorted(grams.keys, edges), len(grams.keys))
                yield pa.RecordBatch.from_pylist(
                    [
                        {"group": k, "block": block, "keys": _planes(grams.keys[f:t]), "counts": _small(n[f:t])}
                        for k, (f, t) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True))
                        if f < t
                    ],
                    schema=_SENT_ARROW,
                )
                block += 1

    return docs.mapInArrow(run, _SENT)


def _counted(sent: DataFrame, parts: int) -> DataFrame:
    """Per block and group the counts of its n-grams in all training documents;
    one row of each group also has the group's training tokens and words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, block, keys, counts in _groups(batches, 1):
            own = [_unplanes(k) for k in keys]
            distinct, back = np.unique(np.concatenate(own), return_inverse=True)
            total = np.bincount(back, np.concatenate([_wide(c, len(k)) for c, k in zip(counts, own, strict=True)])).astype(np.int64)
            words = total[distinct & ODD == 0]
            upto = np.cumsum([len(k) for k in own]).tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(block), pa.array(group), pa.array(np.diff(upto, prepend=0)),
                    pa.array([_small(total[back[f:t]]) for f, t in zip([0, *upto[:-1]], upto, strict=True)], pa.binary()),
                    pa.array([int(words.sum()), *[0] * (len(own) - 1)]), pa.array([int((words > 0).sum()), *[0] * (len(own) - 1)]),
                ],
                ["block", "group", "size", "counts", "tokens", "words"],
            )

    dealt = sent.repartitionById(parts, (F.col("group") % parts).cast("int")).sortWithinPartitions("group", "block")
    return dealt.mapInArrow(run, "block long, group long, size long, counts binary, tokens long, words long")


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` per row.

    The model learns from the documents whose crc32 of the id as text is not 0
    modulo 10 (a null id counts as training); all are scored.  A null or empty
    text is one end token.  Rows that repeat count each.  An empty table gives
    no rows; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_col)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    folder = shared_path(docs.sparkSession, "blocks")
    counted = materialize(_counted(_sent(rows, folder, GROUPS * parts), parts), "ngrams")
    totals = counted.agg(F.sum("tokens").alias("n"), F.sum("words").alias("v")).first()
    train, distinct = int(totals.n or 0), int(totals.v or 0)
    asked = counted.select("block", "group", "size", "counts").repartition("block").sortWithinPartitions("block", "group")
    schema = T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("held_out", T.BooleanType())]
        + [T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known", "train_tokens")]
        + [T.StructField(c, T.DoubleType()) for c in ("base_score", "score")]
    )

    def traverse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _, size, counts in _groups(batches, 1):
            count = np.concatenate([_wide(c, n) for c, n in zip(counts, size.tolist(), strict=True)])
            ids, held, at, words = _read_block(folder, int(block[0]))
            grams = Grams(words, at)
            c, doc = count[grams.token], grams.doc
            unigram = (c + ADD) / (train + ADD * (distinct + 1))
            # Arc and failure weights together: an unseen arc is the failure arc times the unigram.
            arc = (count[grams.pair] + MU * unigram) / (count[grams.state] + MU)
            n = len(ids)

            def per_document(x: np.ndarray, doc=doc, n=n) -> np.ndarray:
                return np.bincount(doc, x, n)

            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, mask=ids == NO_ID), pa.array(held), pa.array(np.bincount(doc, minlength=n), pa.int64()),
                    pa.array(per_document(c > 0).astype(np.int64)), pa.array(np.full(n, train, np.int64)),
                    pa.array(per_document(np.log10(unigram))), pa.array(per_document(np.log10(arc))),
                ],
                schema.names,
            )

    return asked.mapInArrow(traverse, schema)
