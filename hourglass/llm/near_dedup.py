"""Near-duplicate documents: b-bit MinHash and a multi-index Hamming join.

A document's set are its distinct 5-word shingles.  Documents with the same
set form a class and go on as its smallest id.  A class has a signature of
``CHUNKS * WIDTH`` b-bit MinHash values in ``CHUNKS`` chunks.  Two signatures
that differ in at most ``2 * CHUNKS - 1`` places have a chunk with at most one
difference (pigeonhole), so the index enumerates each chunk with each one place
left out: all pairs under that distance meet under some key.

What meets under a key is not expanded into pairs.  First every member meets
the key's leader only (a star): the member that meets most others, which among
edited copies is the one nearest to the original.  Links are confirmed on the
full sets and joined into components.  Then, for keys whose other members still
lie in several components, the members outside the leader's component meet all
members of other components, in blocks of bounded size, where signatures and
bottom-k sketches leave the pairs worth confirming.  Every pair that shares a
key is thus either compared or already connected.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourglass.llm.components import components
from hourglass.llm.spans import U64, mix, words_of
from hourglass.llm.support import binary_values, chunks, materialize, own_names, work_names

SHINGLE = 5
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 85
CHUNKS, WIDTH = 8, 5
PLACES = CHUNKS * WIDTH
#: Chance that the signatures of a pair at the bar differ in more places than
#: are confirmed on full sets.  The index guarantees 2 * CHUNKS - 1 = 15 places
#: and finds nearly all beyond; at a bar of 85 (80) the mean is 6 (8), up to 20
#: (23) places are confirmed, and the index misses a pair with a chance of 5e-7 (2e-5).
TAIL = 5e-8
#: Rows of one side of a block.
BLOCK = 2048
#: Smallest hashes per set in a sketch, and how many standard deviations below
#: the bar its estimate may lie; a union of at most this size is exact.
SKETCH, MARGIN = 256, 5
#: Bits of the fixed-size filter of ids whose texts are needed (8 MB).
FILTER_BITS = 1 << 26


def reach(percent: int) -> int:
    """Largest signature distance that is confirmed on full sets."""
    p = percent / 100
    beyond = np.cumsum([math.comb(PLACES, k) * (1 - p) ** k * p ** (PLACES - k) for k in range(PLACES, -1, -1)])[::-1]
    return int(np.count_nonzero(beyond > TAIL)) - 1


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes per text (A-Z lower-cased).

    Fewer than 5 words: one hash of the whole sequence; no words: empty.
    """
    word, at = words_of([t.lower() for t in texts])
    keyed = [mix(word, k + 1) for k in range(SHINGLE)]
    last = len(word) - SHINGLE + 1
    rolled = mix(sum(keyed[k][k : k + last] for k in range(SHINGLE))) if last > 0 else word[:0]
    out = []
    for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        n = hi - lo
        if n >= SHINGLE:
            out.append(np.unique(rolled[lo : hi - SHINGLE + 1]))
        elif n:
            whole = sum((keyed[k][lo + k : lo + k + 1] for k in range(n)), np.full(1, n, U64))
            out.append(mix(whole, 99))
        else:
            out.append(rolled[:0])
    return out


_SEEDS = mix(np.arange(PLACES, dtype=U64), 11)
_ODD = mix(np.arange(PLACES, dtype=U64), 12) | U64(1)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """A row of ``PLACES`` 16-bit MinHash values per non-empty set."""
    if not sets:
        return np.zeros((0, PLACES), np.uint16)
    flat = np.concatenate(sets)
    at = np.cumsum([0, *[len(s) for s in sets[:-1]]])
    out = np.empty((len(sets), PLACES), np.uint16)
    for k in range(PLACES):
        low = np.minimum.reduceat((flat ^ _SEEDS[k]) * _ODD[k], at)
        out[:, k] = (mix(low) & U64(0xFFFF)).astype(np.uint16)
    return out


def index_keys(sigs: np.ndarray) -> np.ndarray:
    """Per signature one key for each chunk and each place of it left out."""
    place = np.arange(PLACES, dtype=U64)
    term = mix(sigs.astype(U64) + (place << U64(16)), 21).reshape(len(sigs), CHUNKS, WIDTH)
    left = term.sum(axis=2, keepdims=True, dtype=U64) - term
    return mix(left.reshape(len(sigs), PLACES) + place, 22).astype(np.int64)


def _sign(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("doc_id"), text_col)
    schema = T.StructType(
        [
            rows.schema[0], T.StructField("n_shingles", T.LongType()), T.StructField("digest", T.BinaryType()),
            T.StructField("sig", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = binary_values(batch.column(1))
            sizes, digests, sigs = [], [], []
            for lo, hi in chunks(texts):
                sets = shingle_sets(texts[lo:hi])
                rows_of = iter(signatures([s for s in sets if len(s)]))
                for s in sets:
                    sizes.append(len(s))
                    digests.append(hashlib.md5(s.tobytes()).digest() if len(s) else None)
                    sigs.append(next(rows_of).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(sigs, pa.binary())],
                schema.names,
            )

    return rows.mapInArrow(run, schema)


def _keyed(reps: DataFrame) -> DataFrame:
    """``slot, key, rep``: the index entries of every class."""
    schema = T.StructType([T.StructField("rep", reps.schema["rep"].dataType), T.StructField("keys", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sigs = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, PLACES)
                flat = pa.array(index_keys(sigs).ravel(), pa.int64())
                at = pa.array(np.arange(0, len(flat) + 1, PLACES, dtype=np.int32), pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(at, flat)], schema.names)

    return reps.select("rep", "sig").mapInArrow(run, schema).select(F.posexplode("keys").alias("slot", "key"), "rep")


def _bit(col: Column) -> Column:
    return F.pmod(F.xxhash64(col), F.lit(FILTER_BITS)) + 1


def _with_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` without most rows whose ``doc_id`` is not in ``ids(id)``; no row
    of ``ids`` is lost.  The filter is a bitmap of ``FILTER_BITS`` at most, sent
    to all tasks in rows of 4 KB."""
    bits = ids.select(_bit(F.col("id")).alias("b")).groupBy(F.bitmap_bucket_number("b").alias("_bucket"))
    bitmap = bits.agg(F.bitmap_construct_agg(F.bitmap_bit_position("b")).alias("_bitmap"))
    rows = docs.withColumn("_b", _bit(F.col("doc_id"))).withColumn("_bucket", F.bitmap_bucket_number("_b"))
    rows = rows.withColumn("_pos", F.bitmap_bit_position("_b"))
    test = F.expr("getbit(cast(conv(hex(substring(_bitmap, cast(_pos div 8 as int) + 1, 1)), 16, 10) as int), cast(_pos % 8 as int)) = 1")
    return rows.join(F.broadcast(bitmap), "_bucket").filter(test).select(*docs.columns)


def _sets(docs: DataFrame, ids: DataFrame, most: int | None = None) -> DataFrame:
    """``id, set`` for at least the ids given: the sorted shingle hashes, or the
    upper halves of the ``most`` smallest."""
    schema = T.StructType([T.StructField("id", docs.schema["doc_id"].dataType), T.StructField("set", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = binary_values(batch.column(1))
            sets = [s for lo, hi in chunks(texts) for s in shingle_sets(texts[lo:hi])]
            if most is not None:
                sets = [(s[:most] >> U64(32)).astype(np.uint32) for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.tobytes() for s in sets], pa.binary())], schema.names)

    return _with_ids(docs, ids).mapInArrow(run, schema)


def _confirm(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough.

    Rows that repeat an id with another text give it several sets; any of them may link.
    """
    pairs = materialize(pairs, "pairs")
    have = _sets(docs, pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct())
    one, two = (have.select(F.col("id").alias(c), F.col("set").alias(f"set_{c}")) for c in ("a", "b"))
    rows = pairs.select("a", "b").join(one, "a").join(two, "b").select("a", "b", "set_a", "set_b")
    out = T.StructType([T.StructField(c, pairs.schema[c].dataType) for c in ("a", "b")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, U64), np.frombuffer(y, U64)
                small, large = sorted((len(x), len(y)))
                ok = 100 * small >= percent * large
                if ok:
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    ok = 100 * both >= percent * (small + large - both)
                keep.append(ok)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return rows.mapInArrow(run, out).distinct()


def _near(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose signatures differ in ``reach(percent)`` places at most."""
    most = reach(percent)
    one = reps.select(F.col("rep").alias("a"), F.col("sig").alias("_x"))
    two = reps.select(F.col("rep").alias("b"), F.col("sig").alias("_y"))
    rows = pairs.join(one, "a").join(two, "b").select("a", "b", "_x", "_y")
    out = T.StructType([T.StructField(c, pairs.schema[c].dataType) for c in ("a", "b")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16).reshape(-1, PLACES) for k in (2, 3))
            yield batch.select(["a", "b"]).filter(pa.array((x != y).sum(axis=1) <= most))

    return rows.mapInArrow(run, out)


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[np.ndarray]]:
    """Columns of each run of rows that agree in the first ``keys`` columns."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        rest = table if rest is None else pa.concat_tables([rest, table])
        heads = [rest.column(k).to_numpy() for k in range(keys)]
        new = np.zeros(rest.num_rows, bool)
        for h in heads:
            new[1:] |= h[1:] != h[:-1]
        cuts = np.flatnonzero(new)
        if not len(cuts):
            continue
        done = rest.slice(0, int(cuts[-1])).combine_chunks()
        columns = [c.to_numpy(zero_copy_only=False) for c in done.columns]
        for lo, hi in zip([0, *cuts[:-1].tolist()], cuts.tolist(), strict=True):
            yield [c[lo:hi] for c in columns]
        rest = rest.slice(int(cuts[-1])).combine_chunks()
    if rest is not None and rest.num_rows:
        yield [c.to_numpy(zero_copy_only=False) for c in rest.columns]


def sketch_similarity(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Similarity of sketch pairs (rows padded with the largest value), and
    whether it is exact: the union is not larger than a sketch."""
    both = np.sort(np.concatenate((x, y), axis=1), axis=1)
    real = both != np.iinfo(both.dtype).max
    twice = np.zeros(both.shape, bool)
    twice[:, 1:] = (both[:, 1:] == both[:, :-1]) & real[:, 1:]
    rank = np.arange(both.shape[1]) - np.cumsum(twice, axis=1)
    union = real.sum(axis=1) - twice.sum(axis=1)
    met = (twice & (rank < x.shape[1])).sum(axis=1)
    return met / np.maximum(np.minimum(union, x.shape[1]), 1), union <= x.shape[1]


def _worth(x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    found, exact = sketch_similarity(x, y)
    p = percent / 100
    return found >= p - np.where(exact, 0.01, MARGIN * math.sqrt(p * (1 - p) / SKETCH))


def _blocks(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs worth confirming from ``key, tile, slice, slot, asks, rep, comp,
    sig, low`` rows: in each (key, tile, slice), rows that ask meet the others
    of other components.  A pair that shares several keys is taken up under the
    first: the first chunk with one difference at most."""
    kind, most = rows.schema["rep"].dataType, reach(percent)
    out = T.StructType([T.StructField("a", kind), T.StructField("b", kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, _, slot, asks, rep, comp, sig, low in _groups(batches, 3):
            asks = asks.astype(bool)
            if asks.all() or not asks.any():
                continue
            chunk, left_out = divmod(int(slot[0]), WIDTH)
            sig = np.frombuffer(b"".join(sig.tolist()), np.uint16).reshape(-1, PLACES)
            q, r = np.flatnonzero(asks), np.flatnonzero(~asks)
            total = np.zeros((len(q), len(r)), np.uint8)
            open_ = comp[q][:, None] != comp[r][None, :]
            for c in range(CHUNKS):
                here = np.zeros(total.shape, np.uint8)
                for k in range(c * WIDTH, (c + 1) * WIDTH):
                    here += sig[q, k][:, None] != sig[r, k][None, :]
                if c < chunk:
                    open_ &= here > 1
                elif c == chunk and left_out:
                    open_ &= here == 1
                total += here
            i, j = np.nonzero(open_ & (total <= most))
            if not len(i):
                continue
            sketch = np.full((len(low), SKETCH), np.iinfo(np.uint32).max, np.uint32)
            for k, data in enumerate(low):
                part = np.frombuffer(data, np.uint32)
                sketch[k, : len(part)] = part
            keep = np.concatenate([_worth(sketch[q[i[k : k + 2048]]], sketch[r[j[k : k + 2048]]], percent) for k in range(0, len(i), 2048)])
            if keep.any():
                x, y = rep[q[i[keep]]], rep[r[j[keep]]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])

    return rows.mapInArrow(run, out)


def near_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, block: int = BLOCK
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    ``component_id`` is the smallest id reachable by links, ``kept`` is
    ``doc_id = component_id``.  Null or empty texts have no shingles and no
    links.  Rows with a null id take no part: their component is null and they
    are kept.  Rows that repeat an id share its component.  An empty table
    gives no rows; other columns are not read.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    signed = materialize(_sign(docs, "doc_id", "text"), "signed")
    able = signed.filter("doc_id is not null and n_shingles > 0")
    classes = materialize(
        able.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "classes"
    )
    placed = materialize(able.join(classes, "digest", "left").withColumn("rep", F.coalesce("rep", "doc_id")), "placed")
    reps = placed.filter("doc_id = rep").select("rep", "sig")

    keyed = _keyed(reps)
    shared = keyed.groupBy("key").agg(F.min("rep").alias("_lo"), F.max("rep").alias("_hi"), F.count(F.lit(1)).alias("n"))
    shared = materialize(shared.filter("_lo <> _hi").select("key", "n"), "shared")
    entries = materialize(keyed.join(shared, "key"), "entries")
    # The leader of a key: the member that meets most others under all its keys.
    met = materialize(entries.groupBy("rep").agg((F.sum("n") * 65536 + F.pmod(F.xxhash64("rep"), F.lit(65536))).alias("met")), "met")
    leads = materialize(entries.join(met, "rep").groupBy("key").agg(F.max_by("rep", "met").alias("lead")), "leads")
    entries = materialize(entries.join(leads, "key"), "led")
    ends = [F.least("lead", "rep").alias("a"), F.greatest("lead", "rep").alias("b")]
    stars = entries.filter("rep <> lead").select(*ends).distinct()
    # An id that repeats links its own classes.
    links = materialize(_confirm(_near(stars, reps, percent), docs, percent), "confirmed")
    links = links.union(placed.filter("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b")))
    comps = components(links)

    def of(rows: DataFrame, col: str, to: str) -> DataFrame:
        names = comps.select(F.col("node").alias(col), F.col("comp").alias(to))
        return rows.join(names, col, "left").withColumn(to, F.coalesce(to, col))

    # Keys of three classes or more whose classes besides the leader differ in component.
    more = materialize(of(entries.filter("n > 2"), "rep", "comp"), "more")
    open_keys = (
        more.groupBy("key")
        .agg(
            F.min(F.when(F.col("rep") != F.col("lead"), F.col("comp"))).alias("_lo"),
            F.max(F.when(F.col("rep") != F.col("lead"), F.col("comp"))).alias("_hi"),
            F.max(F.when(F.col("rep") == F.col("lead"), F.col("comp"))).alias("home"),
            F.count(F.lit(1)).alias("_all"),
        )
        .filter("_lo <> _hi")
    )
    open_keys = materialize(open_keys.select("key", "home", "_all"), "open")
    rest = more.join(open_keys, "key").filter("rep <> lead").withColumn("asks", F.col("comp") != F.col("home"))
    asking = materialize(rest.filter("asks").groupBy("key").agg(F.count(F.lit(1)).alias("_asking")), "asking")
    sketches = _sets(docs, rest.select(F.col("rep").alias("id")).distinct(), SKETCH)
    about = materialize(
        reps.join(sketches.select(F.col("id").alias("rep"), F.col("set").alias("low")), "rep"), "about"
    )
    rest = rest.join(asking, "key").join(about, "rep")
    tiles, slices = F.ceil(F.col("_all") / F.lit(block)).cast("int"), F.ceil(F.col("_asking") / F.lit(block)).cast("int")
    rest = rest.withColumns({"_tiles": tiles, "_slices": slices})
    own, spread = F.pmod(F.xxhash64("rep"), F.col("_tiles")).cast("int"), F.pmod(F.xxhash64("rep", F.lit(1)), F.col("_slices")).cast("int")
    columns = ["key", "tile", "slice", "slot", "asks", "rep", "comp", "sig", "low"]
    as_row = rest.withColumn("tile", own).withColumn("slice", F.explode(F.expr("sequence(0, _slices - 1)"))).withColumn("asks", F.lit(False))
    as_ask = rest.filter("asks").withColumn("slice", spread).withColumn("tile", F.explode(F.expr("sequence(0, _tiles - 1)")))
    blocks = as_row.select(columns).union(as_ask.select(columns))
    pairs = _blocks(blocks.repartition("key", "tile", "slice").sortWithinPartitions("key", "tile", "slice"), percent).distinct()
    comps = components(links.union(_confirm(pairs, docs, percent)))

    # By id, the least component of its rows (an id can repeat with several texts).
    found = signed.filter("doc_id is not null").select("doc_id", "n_shingles")
    out = of(found, "doc_id", "component_id").unionByName(
        signed.filter("doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    )
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that are kept: one of each component of links at ``percent``.

    Where an id repeats with different texts, each of them is a document of its
    own: rows are told apart by id and text.  Rows with a null id are kept.
    Other columns pass through, whatever their names.
    """
    work, names = work_names(docs)
    ident, text = names[id_col], names[text_col]
    digest = F.md5(F.coalesce(F.col(text), F.lit("")))
    per = work.groupBy(ident).agg(F.min(digest).alias("_lo"), F.max(digest).alias("_hi"))
    if not per.filter(F.col(ident).isNotNull() & (F.col("_lo") != F.col("_hi"))).isEmpty():
        name = F.concat(F.col(ident).cast("string"), F.lit("\0"))
        if isinstance(work.schema[ident].dataType, T.IntegralType):  # sorts as the number does
            name = F.lpad(F.hex(F.col(ident).cast("long").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
        work, ident = work.withColumn("_row", F.concat(name, digest)), "_row"
    gone = near_components(work, ident, text, percent).filter("not kept").select(F.col("doc_id").alias(ident)).distinct()
    return work.join(gone, ident, "left_anti").select(*own_names(names))
