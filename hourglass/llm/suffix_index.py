"""Removal of long repeated byte strings by a logarithmic family of sparse
suffix arrays.

*Suffixes.* Of the ``SPREAD`` (256, for 400-byte matches) places from each
place on, the one whose 8-byte gram has the least hash is an anchor.  A
400-byte string decides by its own bytes which anchor it has, so equal strings
have the same anchor at the same offset, and only suffixes at anchors (one in
some 128 bytes) are indexed, in the order of their first bytes and of the
fingerprint of their first 145 bytes, the *core* that every 400-byte string
with this anchor contains.

*Family.* Documents come in batches.  A batch's suffix array, one row per
distinct core, is merge-scanned against the arrays of all levels: a core that
meets another may be part of a long match, any other cannot.  Then arrays of
equal size class merge: two of level i make one of level i + 1, so that a
suffix is rewritten a logarithmic number of times.

*Extension.* The strings of an anchor differ in their offset before it, from 0
to 255.  For a range of offsets, the bytes that all its strings share (core)
and the bytes that they cover together (hull) are compared with those of the
same range at other anchors: a hull that recurs accepts all strings of the
range, a core that does not recur rejects all, and a range between both, as
there is one at either end of a match, is split by 16 until single strings
decide; one accepted range of each hull goes along as a witness for the others.
So each string is decided exactly, and no pairs are formed.

Groups are counted by fingerprint with partial sums in the tasks, so a passage
that many documents share, or a text that holds a third of all rows, costs a
row a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.llm.spans import U64, join_documents, mix, segments, span_hashes
from hourglass.llm.support import binary_values, chunks, materialize, shared_path

LENGTH = 400
BATCHES = 4
SPLIT = 16
#: Bytes that are hashed at once.
PIECE = 1 << 21
LOW = U64((1 << 24) - 1)


def spread_of(length: int) -> int:
    """Offsets before an anchor: the largest power of 4 up to 2/3 of the length."""
    spread = 1
    while spread * 4 * 3 <= 2 * length:
        spread *= 4
    return spread


def sizes_of(spread: int) -> list[int]:
    """Sizes of the ranges of offsets below the whole, down to 1."""
    sizes = []
    while spread > 1:
        spread = max(1, spread // SPLIT)
        sizes.append(spread)
    return sizes


# ---------------------------------------------------------------- in a task


def _least(buf: np.ndarray, spread: int) -> np.ndarray:
    """For each place, the first place of the least gram among ``spread`` from it on."""
    n = len(buf)
    out = np.empty(n, np.int64)
    for lo in range(0, n, PIECE):
        own = min(PIECE, n - lo)
        data = np.zeros(own + spread + 8, np.uint8)
        part = buf[lo : lo + len(data)]
        data[: len(part)] = part
        m = own + spread
        grams = mix(np.ndarray((m,), "<u8", data.tobytes(), strides=(1,)).astype(U64), 11)
        grams = (grams & ~LOW) | np.arange(m, dtype=U64)
        width = 1
        while width < spread:
            grams = np.minimum(grams[:-width], grams[width:])
            width *= 2
        out[lo : lo + own] = (grams[:own] & LOW).astype(np.int64) + lo
    return out


def _hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """``span_hashes`` in pieces, so that its tables stay small."""
    if len(buf) <= 2 * PIECE or not len(starts):
        return span_hashes(buf, starts, ends)
    out, piece = np.empty(len(starts), U64), starts // PIECE
    for k in np.unique(piece):
        mine = np.flatnonzero(piece == k)
        lo = int(k) * PIECE
        out[mine] = span_hashes(buf[lo : int(ends[mine].max())], starts[mine] - lo, ends[mine] - lo)
    return out


def anchors(buf: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Anchors of the documents of a buffer: (document, place, first and last
    start of the strings that it is the anchor of), places in the buffer."""
    spread = spread_of(length)
    sizes = np.maximum(np.diff(at) - 1 - length + 1, 0)
    starts = np.repeat(at[:-1], sizes) + segments(sizes)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none, none, none
    doc, place = np.repeat(np.arange(len(sizes)), sizes), _least(buf, spread)[starts]
    first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    last = np.append(first[1:], len(starts)) - 1
    return doc[first], place[first], starts[first], starts[last]


def _ranges(buf: np.ndarray, at: np.ndarray, doc: np.ndarray, place: np.ndarray, index: np.ndarray, size: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Core and hull fingerprints of the ranges of offsets ``index * size``
    and on; a hull that leaves its document is 0."""
    near, far = index * size, index * size + size - 1
    salt = mix(index.astype(U64), 13)
    core = _hashes(buf, place - near, place - far + length) ^ salt
    inside = (place - far >= at[doc]) & (place - near + length < at[doc + 1])
    hull = np.zeros(len(place), U64)
    hull[inside] = _hashes(buf, (place - far)[inside], (place - near + length)[inside]) ^ salt[inside]
    return core, hull


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(U64).view(np.int64))


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, np.ndarray, np.ndarray]]:
    """(batch, first row, buffer, starts) of about 1 MB of whole documents each."""
    for batch in batches:
        texts = binary_values(batch.column(1))
        for lo, hi in chunks(texts):
            yield batch.slice(lo, hi - lo), lo, *join_documents(texts[lo:hi])


def suffixes_of(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """``row, place, head, core, hull`` per anchor of ``rows`` (row, text): its
    place in the document, its first bytes as an ordered long, and the
    fingerprints of the whole range of offsets."""
    spread = spread_of(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, buf, at in _documents(batches):
            doc, place, _, _ = anchors(buf, at, length)
            core, hull = _ranges(buf, at, doc, place, np.zeros(len(doc), np.int64), spread, length)
            head = np.ndarray((len(buf),), ">u8", buf.tobytes() + bytes(8), strides=(1,))[place].astype(U64) ^ U64(1 << 63)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(doc)), pa.array(place - at[doc], pa.int64()), _signed(head), _signed(core), _signed(hull)],
                ["row", "place", "head", "core", "hull"],
            )

    return rows.mapInArrow(run, "row long, place long, head long, core long, hull long")


def ranges_of(texts: DataFrame, size: int, parent: int, length: int) -> DataFrame:
    """``row, place, index, core, hull`` of the ranges of ``size`` offsets in the
    open ranges of ``texts`` (row, text, open: array of place and index of the
    range of ``parent`` offsets), as far as strings of the anchor have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, buf, at in _documents(batches):
            todo = batch.column(2)
            counts = np.diff(todo.offsets.to_numpy())
            doc = np.repeat(np.arange(len(counts)), counts)
            fields = todo.flatten()
            place = fields.field("place").to_numpy() + at[doc]
            index = fields.field("index").to_numpy()
            _, known, first, last = anchors(buf, at, length)
            k = np.searchsorted(known, place)
            lo = np.maximum(index * parent, place - last[k]) // size
            hi = np.minimum(index * parent + parent - 1, place - first[k]) // size
            n = np.maximum(hi - lo + 1, 0)
            doc, place, child = np.repeat(doc, n), np.repeat(place, n), np.repeat(lo, n) + segments(n)
            core, hull = _ranges(buf, at, doc, place, child, size, length)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(doc)), pa.array(place - at[doc], pa.int64()), pa.array(child, pa.int64()), _signed(core), _signed(hull)],
                ["row", "place", "index", "core", "hull"],
            )

    return texts.mapInArrow(run, "row long, place long, index long, core long, hull long")


# ------------------------------------------------------------------ the family


def discard(spark: SparkSession, path: str) -> None:
    """Removes a folder of ours that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


class Table:
    """A table in the shared folder, dealt by the hash of ``keys`` and sorted by
    them, so that joins on these keys neither shuffle nor sort it again."""

    def __init__(self, df: DataFrame, name: str, keys: list[str]) -> None:
        self.spark, self.path = df.sparkSession, shared_path(df.sparkSession, name)
        self.name = self.path.rsplit("/", 1)[1].replace("-", "_")
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        dealt = df.repartition(parts, *keys)
        dealt.write.option("path", self.path).option("compression", "zstd").bucketBy(parts, *keys).sortBy(*keys).saveAsTable(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def remove(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        discard(self.spark, self.path)


class SuffixFamily:
    """Suffix arrays of size classes: level i holds some 2**i batches."""

    KEYS = ["head", "core"]

    def __init__(self) -> None:
        self.levels: dict[int, Table] = {}

    @staticmethod
    def _files(tables: list[Table]) -> DataFrame:
        parts = [t.spark.read.schema(t.read().schema).parquet(t.path) for t in tables]
        return reduce(DataFrame.unionByName, parts)

    def settle(self) -> None:
        """Merges arrays until every level holds one."""
        level = 0
        while -1 in self.levels:
            if level not in self.levels:
                self.levels[level] = self.levels.pop(-1)
                break
            pair = [self.levels.pop(-1), self.levels.pop(level)]
            # From the plain files: Spark 4.1 takes a union of dealt tables as dealt, and then misses equal rows.
            both = self._files(pair).dropDuplicates(self.KEYS)
            self.levels[-1] = Table(both, f"suffixes-{level + 1}", self.KEYS)
            for table in pair:
                table.remove()
            level += 1

    def add(self, suffixes: DataFrame) -> DataFrame:
        """Takes in a batch (head, core per suffix); returns the distinct cores
        of the batch that occur twice in it or in an earlier batch.  A core that
        occurred once so far is returned when a later batch meets it."""
        self.settle()
        counted = materialize(suffixes.groupBy(*self.KEYS).agg((F.count(F.lit(1)) > 1).alias("twice")), "batch")
        batch = Table(counted.select(*self.KEYS), "suffixes-0", self.KEYS)
        met = [batch.read().join(level.read(), self.KEYS) for level in self.levels.values()]
        own = counted.where("twice").select(*self.KEYS)
        self.levels[-1] = batch
        return materialize(reduce(DataFrame.unionByName, met, own).dropDuplicates(self.KEYS), "met")

    def remove(self) -> None:
        for table in self.levels.values():
            table.remove()
        self.levels.clear()


def _recurring(rows: DataFrame, column: str) -> DataFrame:
    """The values of a fingerprint column that more than one range has (0: none)."""
    counts = rows.where(F.col(column) != 0).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    # Stored, so that both sides of the join that follows are plain shuffles, which Spark can split at a hot value.
    return materialize(counts.where("n > 1").select(column), f"recurring-{column}")


def _judged(ranges: DataFrame) -> DataFrame:
    """``ranges`` plus ``whole``: the hull recurs, so all its strings do."""
    hulls = _recurring(ranges, "hull").withColumn("whole", F.lit(True))
    return ranges.join(hulls, "hull", "left").withColumn("whole", F.coalesce("whole", F.lit(False)))


def _undecided(state: DataFrame) -> DataFrame:
    """The ranges to be split: those that are neither accepted nor rejected,
    and for each of their cores one accepted range of every hull, as a witness
    of the strings that it shares with them."""
    undecided = state.where("not whole")
    cores = undecided.select("core").distinct()
    witness = state.where("whole").groupBy("core", "hull").agg(F.min(F.struct("row", "place", "index")).alias("w")).join(cores, "core", "left_semi")
    return undecided.select("row", "place", "index").unionByName(witness.select("w.*"))


def repeated_spans(rows: DataFrame, length: int = LENGTH, batches: int = BATCHES) -> tuple[DataFrame, Table | None]:
    """(``row, spans``: array of start and end of byte runs that are covered by
    strings of ``length`` bytes that also start elsewhere, unsorted and
    overlapping; the texts of these documents by row) of ``rows`` (row, text:
    a stored table).  The second is None if no text repeats."""
    spread = spread_of(length)
    suffixes = materialize(suffixes_of(rows.select("row", "text"), length), "suffixes")
    family, met = SuffixFamily(), []
    for k in range(batches):
        batch = suffixes.where(F.pmod(F.xxhash64("row"), F.lit(batches)) == k)
        met.append(family.add(batch.select("head", "core")))
    cores = materialize(reduce(DataFrame.unionByName, met).distinct(), "cores")
    found = materialize(_judged(suffixes.join(cores, SuffixFamily.KEYS, "left_semi").drop("head")), "anchors")
    family.remove()
    spans = []

    def accept(judged: DataFrame, size: int) -> None:
        first = F.col("place") - F.col("index") * size - (size - 1)
        spans.append(judged.where("whole").select("row", F.struct(first.alias("start"), (first + size - 1 + length).alias("end")).alias("span")))

    state = found.withColumn("index", F.lit(0).cast("long"))
    accept(state, spread)
    if state.isEmpty():
        return spans[0].groupBy("row").agg(F.collect_list("span").alias("spans")), None
    wanted = found.select("row").distinct()
    texts = Table(rows.select("row", "text").join(wanted, "row"), "texts", ["row"])
    parent = spread
    for size in sizes_of(spread):
        todo = _undecided(state).groupBy("row").agg(F.collect_list(F.struct("place", "index")).alias("open"))
        ranges = materialize(ranges_of(texts.read().join(todo, "row").select("row", "text", "open"), size, parent, length), f"ranges-{size}")
        live = ranges.join(_recurring(ranges, "core"), "core", "left_semi")
        # Of single strings, core and hull are the string itself.
        state = materialize(_judged(live) if size > 1 else live.withColumn("whole", F.lit(True)), f"judged-{size}")
        accept(state, size)
        parent = size
    every = reduce(DataFrame.unionByName, spans)
    return every.groupBy("row").agg(F.collect_list("span").alias("spans")), texts


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of ``n`` bytes lie in one of the runs."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, ends, -1)
    return np.cumsum(edge[:-1]) > 0


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, batches: int = BATCHES, keep_text: bool = False) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans,
    kept_sha256``, and the bytes that stay (``kept``, if ``keep_text``).

    Removed is each byte in a string of ``length`` bytes that also starts
    elsewhere, in the same document or another; null texts count as empty, and
    texts shorter than ``length`` stay whole.  Rows with null or repeated ids
    are documents of their own, so rows that repeat a text lose all of it (if
    long enough).  An empty table gives no rows; other columns are not read.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("doc_id"), text.alias("text"))
    rows = rows.withColumns({"n_bytes": F.octet_length("text").cast("long"), "sha": F.sha2("text", 256)})
    path = shared_path(docs.sparkSession, "rows")
    rows.write.option("compression", "zstd").parquet(path)
    rows = docs.sparkSession.read.schema(rows.schema).parquet(path)
    spans, texts = repeated_spans(rows, length, batches)
    light = rows.select("row", "doc_id", "n_bytes", "sha")
    zero = F.lit(0).cast("long")
    schema = "row long, n_removed long, n_spans long, kept_sha256 string, kept binary"

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            out = []
            for row, data, runs in zip(batch.column(0).to_pylist(), binary_values(batch.column(1)), batch.column(2), strict=True):
                fields = runs.values
                gone = covered(len(data), fields.field("start").to_numpy(), fields.field("end").to_numpy())
                kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                edges = int((np.diff(gone, prepend=False) & gone).sum())
                out.append((row, int(gone.sum()), edges, hashlib.sha256(kept).hexdigest(), kept if keep_text else None))
            names = ["row", "n_removed", "n_spans", "kept_sha256", "kept"]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            columns = [pa.array(list(c), kind) for c, kind in zip(zip(*out) if out else [[]] * 5, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    if texts is None:
        done = light.select("doc_id", "n_bytes", zero.alias("n_removed"), zero.alias("n_spans"), F.col("sha").alias("kept_sha256"), "row")
        return done.join(rows.select("row", F.col("text").cast("binary").alias("kept")), "row").select(*names, "kept") if keep_text else done.select(*names)
    joined = texts.read().join(spans, "row").select("row", "text", "spans")
    changed = materialize(joined.mapInArrow(cut, schema), "cut")
    out = light.join(changed, "row", "left").select(
        "row", "doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"), "kept",
    )
    if not keep_text:
        return out.select(*names)
    return out.join(rows.select("row", "text"), "row").select(*names, F.coalesce("kept", F.col("text").cast("binary")).alias("kept"))
