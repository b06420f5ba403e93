"""The lowest and highest of many seeded draws from a pool that no machine holds.

Sending every drawn residual to its row would move ``B`` values a row.  A bound
needs only the k-th lowest (highest) draw, so the work is done on *codes*, one
byte a residual, in the order of the residuals:

1. the pool is sorted and cut into pieces; a sample of its values gives at most
   127 edges.  Code ``2j + 1`` means "equal to edge j", ``2j`` "below it and
   above the edge before".
2. Rows are packed into blocks.  Every block meets every slice of codes
   (``SLICE`` bytes; a product, which writes nothing), finds its draws again from
   its row keys and keeps the k lowest and k highest codes of a row: 2k bytes.
3. The slices of a block are merged.  An odd code is the value itself.  Only
   for an even one are the draws of a row in that code (few, as codes are
   near-quantiles) looked up in the pool; their k-th value is exact.

Nothing is capped or approximated: the sample decides how many draws step 3
looks up, not the result.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourglass.functions.draws import MOD, MUL_A, MUL_B
from hourglass.session import ensure_checkpoint_dir

#: Residuals of a piece, edges of the codes, codes of a slice, rows of a block and of one numpy step.
PIECE = 1 << 16
EDGES = 127
SLICE = 1 << 26
BLOCK = 1 << 19
STEP = 1 << 12
PAD = 255

# Tasks get these functions with the plan: workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _batch(schema: str, *columns) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary(), "points": pa.list_(pa.float64())}
    fields = [f.split() for f in schema.replace("array<double>", "points").split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], [n for n, _ in fields])


def positions(keys: np.ndarray, B: int, n: int, seed: int) -> np.ndarray:
    """Pool positions of the ``B`` draws of each key (``functions.draws.draw_index``)."""
    x0 = keys.astype(np.int64)[:, None] % MOD
    x1 = (x0 * MUL_A + (np.arange(1, B + 1, dtype=np.int64) * MUL_B + seed)[None, :]) % MOD
    x2 = x1 * MUL_A % MOD
    x3 = (x2 * MUL_A + x0) % MOD
    x4 = (x3 * MUL_A + x1) % MOD
    return (x3 * MOD + x4) % n


def encode(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """The code of each value; NaN counts as the largest number."""
    at = np.searchsorted(edges, values, "left")
    met = edges[np.minimum(at, len(edges) - 1)]
    return (2 * at + ((at < len(edges)) & ((met == values) | (np.isnan(met) & np.isnan(values))))).astype(np.uint8)


def _cut_pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, seq, held, have = TaskContext.get().partitionId(), 0, [], 0

    def piece(values: np.ndarray) -> pa.RecordBatch:
        points = np.unique(values)
        if len(points) > EDGES:
            points = np.sort(values)[np.linspace(0, len(values) - 1, EDGES + 1).astype(int)]
        return _batch("part long, seq long, n long, points array<double>, data binary", [part], [seq], [len(values)], [points], [values.tobytes()])

    for batch in batches:
        held.append(batch.column(0).to_numpy(zero_copy_only=False))
        have += batch.num_rows
        while have >= PIECE:
            values = np.concatenate(held)
            yield piece(values[:PIECE])
            seq, held, have = seq + 1, [values[PIECE:]], have - PIECE
    if have:
        yield piece(np.concatenate(held))


def _deal_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, seq, held = TaskContext.get().partitionId(), 0, []

    def block() -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        keys = rows.column(rows.num_columns - 1).fill_null(-1).to_numpy().astype(np.int32)
        rows = rows.select(list(range(rows.num_columns - 1)))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(rows, max_chunksize=1 << 14)
        return _batch("block long, keys binary, rows binary", [(part << 32) + seq], [keys.tobytes()], [sink.getvalue().to_pybytes()])

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= BLOCK:
            yield block()
            seq, held = seq + 1, []
    if held:
        yield block()


def _join_codes(group: pa.Table) -> pa.Table:
    group = group.sort_by("start")
    codes = b"".join(x.as_py() for x in group.column("codes"))
    return pa.table({"slice": group.column("slice")[:1], "start": group.column("start")[:1], "codes": pa.array([codes], pa.binary())})


def draw_bounds(rows: DataFrame, key: str, residuals: DataFrame, order: list[str], B: int, seed: int, lo_i: int, hi_i: int) -> DataFrame:
    """``rows`` without ``key``, plus ``_lo`` and ``_hi``: of the ``B`` residuals
    drawn for the row's key, those at the 0-based places ``lo_i`` and ``hi_i`` of
    their sorted order (NaN last).  ``residuals`` has ``residual`` and the columns
    ``order``, which fix its positions; null residuals are left out.  Null keys
    and an empty pool give nulls.  Rows keep their number and values.
    """
    spark = rows.sparkSession
    own = T.StructType([f for f in rows.schema.fields if f.name != key])
    out_schema = T.StructType([*own.fields, T.StructField("_lo", T.DoubleType()), T.StructField("_hi", T.DoubleType())])
    k_lo, k_hi = lo_i + 1, B - hi_i

    known = residuals.where(F.col("residual").isNotNull()).select(*order, F.col("residual").cast("double").alias("residual"))
    pool = known.repartitionByRange(*order).sortWithinPartitions(*order).select("residual")
    pieces = _kept(pool.mapInArrow(_cut_pool, "part long, seq long, n long, points array<double>, data binary"), "pool")
    # A few numbers for each piece of PIECE residuals.
    sizes = sorted((r.part, r.seq, r.n) for r in pieces.select("part", "seq", "n").collect())
    n = sum(s for *_, s in sizes)
    if not n or not 0 <= lo_i <= hi_i < B:
        empty = F.lit(None).cast("double")
        return rows.select(*[f.name for f in own.fields], empty.alias("_lo"), empty.alias("_hi"))
    ends = np.cumsum([s for *_, s in sizes])
    starts = ends - [s for *_, s in sizes]
    places = spark.createDataFrame(
        [(p, s, i, int(starts[i]), int(starts[i]) // SLICE) for i, (p, s, _) in enumerate(sizes)],
        "part long, seq long, piece long, start long, slice long",
    )
    placed = pieces.join(F.broadcast(places), ["part", "seq"])
    # Edges: all values, if they are few; else points of the sampled quantiles.
    found = pieces.select(F.explode("points").alias("v")).groupBy("v").count()
    seen = found.select("v").limit(EDGES + 1).collect()
    whole = len(seen) <= EDGES and not pieces.where(F.size("points") > EDGES).limit(1).count()
    if whole:
        edges = np.unique([r.v for r in seen])
    else:
        probs = [float(x) for x in (np.arange(EDGES) + 0.5) / EDGES]
        points = pieces.select(F.explode("points").alias("v"))
        edges = np.unique(points.select(F.percentile_approx("v", probs, 2000)).first()[0])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                values = np.frombuffer(batch.column(2)[i].as_py())
                yield _batch("slice long, start long, codes binary", [batch.column(0)[i].as_py()], [batch.column(1)[i].as_py()], [encode(values, edges).tobytes()])

    coded = placed.select("slice", "start", "data").mapInArrow(code, "slice long, start long, codes binary")
    slices = _kept(coded.groupBy("slice").applyInArrow(_join_codes, "slice long, start long, codes binary"), "codes")
    blocks = _kept(rows.select(*[f.name for f in own.fields], key).mapInArrow(_deal_rows, "block long, keys binary, rows binary"), "blocks")

    def codes_of(keys: np.ndarray, start: int, codes: np.ndarray):
        """Per step of rows: the rows, their draws' positions and codes (PAD outside the slice)."""
        for a in range(0, len(keys), STEP):
            at = positions(keys[a : a + STEP], B, n, seed)
            if start == 0 and len(codes) == n:
                yield a, at, codes[at], None
            else:
                outside = (at < start) | (at >= start + len(codes))
                yield a, at, codes[np.where(outside, 0, at - start)], outside

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block, start = batch.column(0)[i].as_py(), batch.column(2)[i].as_py()
                keys = np.frombuffer(batch.column(1)[i].as_buffer(), np.int32)
                low, high = np.empty((len(keys), k_lo), np.uint8), np.empty((len(keys), k_hi), np.uint8)
                for a, _, c, outside in codes_of(keys, start, np.frombuffer(batch.column(3)[i].as_buffer(), np.uint8)):
                    up, down = c, 254 - c
                    if outside is not None:
                        up, down = np.where(outside, PAD, up), np.where(outside, PAD, down)
                    low[a : a + STEP] = np.partition(up, lo_i, axis=1)[:, :k_lo]
                    high[a : a + STEP] = np.partition(down, k_hi - 1, axis=1)[:, :k_hi]
                yield _batch("block long, low binary, high binary", [block], [low.tobytes()], [high.tobytes()])

    def merge(group: pa.Table) -> pa.Table:
        """Per row the code at each bound, and which of the draws in that code it is (1-based, from outside)."""
        columns = {"block": group.column("block")[:1]}
        for name, k in (("low", k_lo), ("high", k_hi)):
            parts = [np.frombuffer(x.as_buffer(), np.uint8).reshape(-1, k) for x in group.column(name)]
            best = np.sort(np.concatenate(parts, axis=1), axis=1)[:, :k]
            last = best[:, -1]
            rank = (best == last[:, None]).sum(axis=1).astype(np.int32)
            columns[name] = pa.array([(last if name == "low" else 254 - last).tobytes()], pa.binary())
            columns[f"{name}_rank"] = pa.array([rank.tobytes()], pa.binary())
        return pa.table(columns)

    def look_up(merged: DataFrame) -> DataFrame:
        """Exact values of the bounds whose code holds more than one value, per block."""

        def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    block, start = batch.column(0)[i].as_py(), batch.column(2)[i].as_py()
                    keys, codes = np.frombuffer(batch.column(1)[i].as_buffer(), np.int32), np.frombuffer(batch.column(3)[i].as_buffer(), np.uint8)
                    wanted = [np.frombuffer(batch.column(j)[i].as_buffer(), kind) for j, kind in ((4, np.uint8), (5, np.int32), (6, np.uint8), (7, np.int32))]
                    for a, at, c, outside in codes_of(keys, start, codes):
                        for side in (0, 1):
                            want, rank = wanted[2 * side][a : a + STEP], wanted[2 * side + 1][a : a + STEP]
                            hit = (c == want[:, None]) & (want % 2 == 0)[:, None] & (keys[a : a + STEP] >= 0)[:, None]
                            if outside is not None:
                                hit &= ~outside
                            slot, b = np.nonzero(hit)
                            if len(slot):
                                p = at[slot, b]
                                piece = np.searchsorted(ends, p, "right")
                                yield _batch(
                                    "block long, slot int, side int, rank int, piece long, off long",
                                    np.full(len(slot), block), (slot + a).astype(np.int32), np.full(len(slot), side, np.int32), rank[slot], piece, p - starts[piece],
                                )

        def read(asked: pa.Table, data: pa.Table) -> pa.Table:
            if not asked.num_rows:
                return pa.table({"block": pa.array([], pa.int64()), "slot": pa.array([], pa.int32()), "side": pa.array([], pa.int32()), "rank": pa.array([], pa.int32()), "value": pa.array([], pa.float64())})
            values = np.frombuffer(data.column("data")[0].as_buffer())
            picked = pa.array(values[asked.column("off").to_numpy()], from_pandas=False)
            return asked.select(["block", "slot", "side", "rank"]).append_column("value", picked)

        def choose(group: pa.Table) -> pa.Table:
            slot, side, rank, value = (group.column(c).to_numpy() for c in ("slot", "side", "rank", "value"))
            columns = {"block": group.column("block")[:1]}
            for s, name in ((0, "low"), (1, "high")):
                mine = side == s
                place, r, v = slot[mine], rank[mine], value[mine]
                order = np.lexsort((v, place))
                place, r, v = place[order], r[order], v[order]
                who, first, count = np.unique(place, return_index=True, return_counts=True)
                at = first + (r[first] - 1 if s == 0 else count - r[first])
                columns[f"{name}_slots"] = pa.array([who.astype(np.int32).tobytes()], pa.binary())
                columns[f"{name}_values"] = pa.array([v[at].tobytes()], pa.binary())
            return pa.table(columns)

        met = blocks.select("block", "keys").join(merged, "block").crossJoin(slices.hint("shuffle_replicate_nl"))
        asked = met.select("block", "keys", "start", "codes", "low", "low_rank", "high", "high_rank").mapInArrow(
            ask, "block long, slot int, side int, rank int, piece long, off long"
        )
        values = (
            asked.groupBy("piece").cogroup(placed.select("piece", "data").groupBy("piece"))
            .applyInArrow(read, "block long, slot int, side int, rank int, value double")
        )
        return values.groupBy("block").applyInArrow(choose, "block long, low_slots binary, low_values binary, high_slots binary, high_values binary")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)}
                missing = np.frombuffer(row["keys"], np.int32) < 0
                bounds = []
                for name in ("low", "high"):
                    value = edges[np.minimum(np.frombuffer(row[name], np.uint8) // 2, len(edges) - 1)]
                    if row.get(f"{name}_slots"):
                        value[np.frombuffer(row[f"{name}_slots"], np.int32)] = np.frombuffer(row[f"{name}_values"])
                    bounds.append(value)
                at = 0
                for part in pa.ipc.open_stream(row["rows"]):
                    own_part = slice(at, at + part.num_rows)
                    at += part.num_rows
                    ends_ = [pa.array(v[own_part], mask=missing[own_part], from_pandas=False) for v in bounds]
                    yield pa.RecordBatch.from_arrays([*part.columns, *ends_], [*part.schema.names, "_lo", "_hi"])

    product = blocks.select("block", "keys").crossJoin(slices.select("start", "codes").hint("shuffle_replicate_nl"))
    scanned = product.select("block", "keys", "start", "codes").mapInArrow(scan, "block long, low binary, high binary")
    merged = scanned.groupBy("block").applyInArrow(merge, "block long, low binary, low_rank binary, high binary, high_rank binary")
    if whole:
        return blocks.join(merged, "block").select("keys", "rows", "low", "high").mapInArrow(unpack, out_schema)
    merged = _kept(merged, "bounds")
    both = blocks.join(merged, "block").join(look_up(merged), "block", "left")
    return both.drop("block").mapInArrow(unpack, out_schema)
