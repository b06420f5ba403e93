"""Token ids in Simple-8b files: word-aligned packing with vectorised decoding.

A 64-bit word has a selector (top 4 bits) and as many ids as fit at the
selector's width.  An id of more than 60 bits is an escape: selector 15 holds
its low 60 bits and the next word, of selector 0, which holds no id, the rest.
Ids are packed in blocks of ``BLOCK_IDS``; the file's head has the first word
of every block, so any block is decoded alone.

File: magic, four int64 (documents, ids, words, documents without an id, which
come first), then int64 document ids and id counts, int64 first words per block
(plus the end), and the words.  A task rolls to its next file at ``FILE_IDS``
ids, so neither writing nor reading holds more than that and one document.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourglass.llm.files import commit_file
from hourglass.llm.spans import U64, SpanCache, join_documents, spans_between
from hourglass.llm.support import binary_values, chunks, shared_path

MAGIC = b"S8BIDS02"
BLOCK_IDS = 1 << 14
FILE_IDS = 1 << 22
HEAD = 8 + 4 * 8
#: Ids per word and bits per id of selectors 1 to 15 (15: escape).
COUNTS = np.array([0, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 1])
WIDTHS = np.array([0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 60])
END_ID = 0


def pack(ids: np.ndarray) -> np.ndarray:
    """The words of one block of ids (below 2**64)."""
    ids = np.asarray(ids, U64)
    n = len(ids)
    choice = np.full(n, 15)
    for s in range(14, 0, -1):
        wide = np.concatenate(([0], np.cumsum(ids >> U64(WIDTHS[s]) > 0)))
        # The last word of a block may be filled up with zeros.
        end = np.minimum(np.arange(n) + COUNTS[s], n)
        choice[wide[end] == wide[:-1]] = s
    jump = COUNTS[choice].tolist()
    at, place = [], 0
    while place < n:
        at.append(place)
        place += jump[place]
    at = np.array(at, np.int64)
    chosen = choice[at]
    slot = np.cumsum(1 + (chosen == 15)) - 1 - (chosen == 15)
    words = np.zeros(len(at) + int((chosen == 15).sum()), U64)
    padded = np.concatenate((ids, np.zeros(60, U64)))
    for s in np.unique(chosen):
        mine = np.flatnonzero(chosen == s)
        value = np.zeros(len(mine), U64)
        for k in range(COUNTS[s]):
            part = padded[at[mine] + k] & U64((1 << 60) - 1)
            value |= part << U64(k * WIDTHS[s])
        words[slot[mine]] = value | U64(int(s) << 60)
        if s == 15:
            words[slot[mine] + 1] = ids[at[mine]] >> U64(60)
    return words


def unpack(words: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` ids of a block's words."""
    select = (words >> U64(60)).astype(np.int64)
    counts = COUNTS[select]
    first = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), U64)
    for s in np.unique(select[select > 0]):
        mine = np.flatnonzero(select == s)
        mask = U64((1 << int(WIDTHS[s])) - 1)
        for k in range(COUNTS[s]):
            out[first[mine] + k] = (words[mine] >> U64(k * WIDTHS[s])) & mask
        if s == 15:
            out[first[mine]] |= words[mine + 1] << U64(60)
    return out[:n]


def file_bytes(doc_ids: np.ndarray, counts: np.ndarray, ids: np.ndarray, unnamed: int = 0) -> bytes:
    blocks = [pack(ids[k : k + BLOCK_IDS]) for k in range(0, len(ids), BLOCK_IDS)]
    first = np.concatenate(([0], np.cumsum([len(b) for b in blocks]))).astype("<i8")
    head = np.array([len(doc_ids), len(ids), int(first[-1]), unnamed], "<i8")
    parts = [MAGIC, head.tobytes(), doc_ids.astype("<i8").tobytes(), counts.astype("<i8").tobytes(), first.tobytes()]
    return b"".join([*parts, *[b.astype("<u8").tobytes() for b in blocks]])


def read_bytes(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(document ids, id counts, all ids, how many first documents have no id) of a file."""
    if data[:8] != MAGIC:
        raise ValueError("not a token file")
    docs, n, _, unnamed = np.frombuffer(data, "<i8", 4, 8).tolist()
    blocks = -(-n // BLOCK_IDS)
    names, counts = np.frombuffer(data, "<i8", docs, HEAD), np.frombuffer(data, "<i8", docs, HEAD + 8 * docs)
    first = np.frombuffer(data, "<i8", blocks + 1, HEAD + 16 * docs)
    words = np.frombuffer(data, "<u8", -1, HEAD + 16 * docs + 8 * (blocks + 1)).astype(U64)
    parts = [unpack(words[first[k] : first[k + 1]], min(BLOCK_IDS, n - k * BLOCK_IDS)) for k in range(blocks)]
    return names, counts, np.concatenate(parts) if parts else np.zeros(0, U64), unnamed


_TOKENIZERS: dict[str, object] = {}


def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = Tokenizer.from_file(path)
    return _TOKENIZERS[path]


def cuttable(path: str) -> bool:
    """Whether the tokenizer is the plain byte-level one, whose words (a run of
    letters, of digits or of other marks, each with one space in front, or white
    space) are told apart by the neighbouring characters alone."""
    with open(path, encoding="utf-8") as f:
        t = json.load(f)
    pre = t.get("pre_tokenizer") or {}
    plain = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
    return bool(plain and not t.get("normalizer") and not t.get("truncation") and not t.get("padding"))


def _kinds() -> np.ndarray:
    """1 letter, 2 digit, 3 other mark, 4 white space; 0 for bytes
    next to which no text is cut: apostrophes (they start contractions),
    control characters, and all that is not ASCII."""
    kind = np.zeros(256, np.uint8)
    kind[0x21:0x7F] = 3
    kind[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
    kind[0x30:0x3A] = 2
    kind[[0x20, *range(0x09, 0x0E)]] = 4
    kind[0x27] = 0
    return kind


KINDS = _kinds()


def cuts(buf: np.ndarray) -> np.ndarray:
    """Places before which a text can be cut without changing its ids: where a
    run of letters, digits or marks ends (white space stays with what follows
    it), and before a space that a visible character follows."""
    kind, out = KINDS[buf], np.zeros(len(buf), bool)
    seen = (kind > 0) & (kind < 4)
    out[1:] = seen[:-1] & (kind[1:] > 0) & (kind[1:] != kind[:-1])
    out[:-1] |= (buf[:-1] == 0x20) & (buf[1:] > 0x20) & (buf[1:] < 0x7F)
    return out


class TextEncoder:
    """Ids as the plain library call gives them; each distinct unit between
    two cuts goes through the library once per cache filling.  Texts with the
    string of a special token go through it whole."""

    def __init__(self, path: str) -> None:
        self.library, self.cut, self.cache = _tokenizer(path), cuttable(path), SpanCache()
        self.special = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        self.batch = getattr(self.library, "encode_batch_fast", self.library.encode_batch)  # without offsets

    def _units(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in self.batch([u.decode() for u in units], add_special_tokens=False)]
        lengths = np.array([len(i) for i in ids], np.int64)
        return np.fromiter(chain.from_iterable(ids), np.int32, int(lengths.sum())), lengths

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in order, and how many each text has."""
        if not self.cut:
            return self._units(texts)
        buf, at = join_documents(texts)
        cut = cuts(buf)
        if any(s in buf.tobytes() for s in self.special):
            for k, t in enumerate(texts):
                if any(s in t for s in self.special):
                    cut[at[k] : at[k + 1]] = False
        starts, ends = spans_between(buf, at, cut)
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        ids, lengths = self.cache.values(buf, starts, ends, self._units)
        upto = np.concatenate(([0], np.cumsum(lengths)))
        return ids, np.diff(upto[np.searchsorted(starts, at)])


_ENCODERS: dict[str, TextEncoder] = {}


def _encoder(path: str) -> TextEncoder:
    """Kept by the worker for its next tasks; its cache has a size limit."""
    if path not in _ENCODERS:
        _ENCODERS[path] = TextEncoder(path)
    return _ENCODERS[path]


MANIFEST = "shard int, part int, file string, documents long, ids long"


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", file_ids: int = FILE_IDS
) -> DataFrame:
    """Writes the ids of all documents in ascending id order, an end id after
    each; every range of document ids has a shard of one or more files.
    Returns the manifest: (shard, part, file, documents, ids) per file.

    Null texts count as empty (the end id alone).  Rows with a null id come
    first; rows that repeat an id follow each other.  An empty table gives an
    empty manifest.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, part = _encoder(tokenizer), TaskContext.get().partitionId(), 0
        names, counts, ids, unnamed = [], [], [], 0

        def roll() -> pa.RecordBatch:
            nonlocal names, counts, ids, unnamed, part
            n, flat = np.concatenate(counts), np.concatenate(ids)
            name = commit_file(folder, f"ids-{shard:06d}-{part:06d}.s8b", file_bytes(np.concatenate(names), n, flat, unnamed))
            row = [[shard], [part], [name], [len(n)], [len(flat)]]
            names, counts, ids, unnamed, part = [], [], [], 0, part + 1
            kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(row, kinds, strict=True)], [f.split()[0] for f in MANIFEST.split(", ")])

        for batch in batches:
            texts = binary_values(batch.column(1))
            for lo, hi in chunks(texts):
                own, n = encoder.encode(texts[lo:hi])
                ids.append(np.insert(own, np.cumsum(n), END_ID).astype(np.uint32))
                counts.append(n + 1)
                ident = batch.column(0).slice(lo, hi - lo)
                unnamed += ident.null_count
                names.append(ident.fill_null(0).to_numpy())
                if sum(map(len, ids)) >= file_ids:
                    yield roll()
        if counts:
            yield roll()

    manifest = f"{folder}-manifest"
    rows.mapInArrow(run, MANIFEST).write.parquet(manifest)
    return docs.sparkSession.read.parquet(manifest)


def read_tokens(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the files of
    the manifest; ``start`` counts the ids of all documents before it."""
    # One row per shard in the outer sum, the files of a shard in the inner one.
    outer = F.sum("all").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    shards = manifest.groupBy("shard").agg(F.sum("ids").alias("all")).select("shard", F.coalesce(outer, F.lit(0)).alias("before"))
    inner = F.sum("ids").over(Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    listed = manifest.withColumn("inner", F.coalesce(inner, F.lit(0))).join(shards, "shard")
    listed = listed.select("file", (F.col("before") + F.col("inner")).cast("long").alias("base"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.s8b").load(folder)
    files = files.withColumn("file", F.element_at(F.split("path", "/"), -1)).join(listed, "file").select("content", "base")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, base in zip(batch.column(0), batch.column(1), strict=True):
                names, counts, ids, unnamed = read_bytes(content.as_py())
                ids, upto = ids.astype("<u4"), np.cumsum(counts)
                crc = [zlib.crc32(ids[t - n : t].tobytes()) for t, n in zip(upto.tolist(), counts.tolist(), strict=True)]
                doc_id = pa.array(names, pa.int64(), mask=np.arange(len(names)) < unnamed)
                columns = [doc_id, *[pa.array(c, pa.int64()) for c in (base.as_py() + upto - counts, counts, crc)]]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def tokenise_documents(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Writes the ids of ``docs`` to fresh files in the shared folder and reads them back."""
    folder = shared_path(docs.sparkSession, "tokens")
    manifest = write_tokens(docs, folder, tokenizer or default_tokenizer())
    if manifest.isEmpty():
        return docs.sparkSession.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return read_tokens(docs.sparkSession, folder, manifest)
