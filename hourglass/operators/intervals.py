"""Bootstrap prediction intervals (B1-B4) and their coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourglass.functions.draws import combine_keys, draw_index, nearest_rank, text_key
from hourglass.functions.ranks import POS, sorted_positions
from hourglass.operators.extremes import draw_bounds

# Interval ends of the original analysis.
LOWER_Q = 0.025
UPPER_Q = 0.975


def row_key(unique_id: str = "unique_id", ds: str = "ds") -> Column:
    """Stable integer key of a (series, timestamp) row, for draws only: rows
    are told apart by their true keys."""
    t = F.col(ds).cast("timestamp_ntz")
    days = F.datediff(F.to_date(t), F.lit("1970-01-01").cast("date")).cast("bigint")
    minutes = (days * 24 + F.hour(t)) * 60 + F.minute(t)
    micros = minutes * 60_000_000 + (F.extract(F.lit("SECOND"), t) * 1_000_000).cast("bigint")
    return combine_keys(text_key(unique_id), micros)


#: Residuals per array chunk of the pool, and row keys per block of draws.
CHUNK = 4096
BLOCK_KEYS = 64
#: Residuals of a pool whose chunks may be broadcast (8 bytes each).
BROADCAST_POOL = 1 << 19


def index_pool(residuals: DataFrame, unique_id: str = "unique_id", ds: str = "ds") -> DataFrame:
    """Give each residual a dense 0-based position ``_idx`` in (series, ds) order.

    A distributed sort-and-number (``functions.ranks``): no task holds a whole
    series, and the positions equal a global ``row_number`` in that order.
    Null residuals are not part of the pool.
    """
    known = residuals.select(unique_id, ds, "residual").where(F.col("residual").isNotNull())
    pos = sorted_positions(known, [unique_id, ds])
    return pos.select(F.col(POS).alias("_idx"), F.col("residual").cast("double").alias("residual"))


def chunk_pool(pool: DataFrame, size: int = CHUNK) -> DataFrame:
    """The indexed pool as numbered arrays: (``_chunk``, ``_pool``), ``size``
    residuals each, in position order."""
    ordered = F.sort_array(F.collect_list(F.struct("_idx", "residual")))
    return pool.groupBy(F.expr(f"_idx div {size}").alias("_chunk")).agg(
        F.transform(ordered, lambda e: e["residual"]).alias("_pool")
    )


def gather_draws(
    keys: DataFrame,
    pool: DataFrame,
    B: int,
    seed: int,
    chunk: int = CHUNK,
    block_keys: int = BLOCK_KEYS,
    broadcast_pool: int = BROADCAST_POOL,
) -> DataFrame:
    """``keys`` (distinct rows with a bigint ``_key``) plus ``_draws``: the
    ``B`` residuals drawn for the key, in draw order.

    No shuffle or broadcast holds a row per draw.  Keys are dealt into blocks
    of about ``block_keys`` (by hash, so a repeated task forms the same blocks).

    * A pool whose *counted* size is within ``broadcast_pool`` is one broadcast
      array; a block's draws are arrays of positions, looked up in place.
    * A larger pool stays distributed in chunks.  A block's draws are grouped by
      the chunk that they hit: one row with an index array per (block, chunk)
      meets its chunk in a merge join (there are then so many chunks that the
      draws spread evenly), is gathered inside, and a block's arrays come
      together again in draw order.

    An empty pool gives every key an empty array.
    """
    n = pool.count()
    if not n:
        return keys.withColumn("_draws", F.array().cast("array<double>"))
    names = [F.col(c) for c in keys.columns]
    # A fixed number of partitions: the expansion below must not be coalesced by the size before it.
    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = F.greatest(F.ceil(keys.select(F.count(F.lit(1))).scalar() / F.lit(block_keys)), F.lit(parts)).cast("bigint")
    blocks = (
        keys.select(F.struct(*names).alias("_k"), many.alias("_m"))
        .select("_k", F.pmod(F.xxhash64("_k"), F.col("_m")).alias("_block"))
        .repartition(parts, "_block")
        .groupBy("_block")
        .agg(F.sort_array(F.collect_list("_k")).alias("_keys"))
    )
    places = F.sequence(F.lit(0), F.lit(B - 1))
    if n <= broadcast_pool:
        whole = F.broadcast(chunk_pool(pool, broadcast_pool))
        drawn = lambda k: F.transform(
            places, lambda b: F.element_at("_pool", draw_index(k["_key"], b, n, seed).cast("int") + 1)
        )
        met = blocks.withColumn("_chunk", F.lit(0).cast("bigint")).join(whole, "_chunk")
        return met.select(
            F.inline(F.transform("_keys", lambda k: F.struct(k.alias("_k"), drawn(k).alias("_draws"))))
        ).select("_k.*", "_draws")
    own = F.posexplode("_keys").alias("_slot", "_k")
    draws = blocks.select("_block", own).select("_block", "_slot", F.col("_k._key").alias("_key"), F.explode(places).alias("_b"))
    at = draw_index(F.col("_key"), F.col("_b"), n, seed)
    draws = draws.select("_block", (F.col("_slot") * F.lit(B) + F.col("_b")).alias("p"), at.alias("_idx"))
    wanted = (
        draws.select("_block", F.expr(f"_idx div {chunk}").alias("_chunk"), "p", F.expr(f"cast(_idx % {chunk} as int) + 1").alias("o"))
        .groupBy("_block", "_chunk")
        .agg(F.collect_list(F.struct("p", "o")).alias("_want"))
    )
    met = wanted.hint("merge").join(chunk_pool(pool, chunk), "_chunk")
    got = met.select("_block", F.expr("transform(_want, w -> struct(w.p as p, element_at(_pool, w.o) as r))").alias("_got"))
    flat = got.groupBy("_block").agg(F.sort_array(F.flatten(F.collect_list("_got"))).alias("_all"))
    both = blocks.hint("merge").join(flat.select("_block", F.transform("_all", lambda e: e["r"]).alias("_all")), "_block")
    slots = F.expr(f"transform(_keys, (k, s) -> struct(k as _k, slice(_all, s * {B} + 1, {B}) as _draws))")
    return both.select(F.inline(slots)).select("_k.*", "_draws")


def bootstrap_interval(
    preds: DataFrame,
    residuals: DataFrame,
    B: int = 500,
    seed: int = 25,
    lower_q: float = LOWER_Q,
    upper_q: float = UPPER_Q,
    unique_id: str = "unique_id",
    ds: str = "ds",
    pred_col: str = "y_pred",
) -> DataFrame:
    """Per row: ``B`` draws of ``prediction + residual`` -> nearest quantiles
    ``lower_bound``, ``upper_bound`` and ``width`` (B1, B2, B3).

    Residuals are drawn with replacement from the pooled in-sample residuals
    (all series): draw b of a row takes pool position
    ``draw_index(row_key, b, n, seed)``.

    Plan: the draws of a row depend on its key alone, and only two of them, by
    rank, are needed; :func:`hourglass.operators.extremes.draw_bounds` finds these
    without moving a value per draw, and keeps the rows packed meanwhile (no join
    by key).  The prediction is the same for all draws of a row, so the quantiles
    of the residuals plus the prediction are the quantiles of the sums.

    Rows that repeat a key share its draws; rows with a null key, and all rows
    if the pool is empty, get null bounds.
    """
    key = [unique_id, ds]
    lo_i, hi_i = nearest_rank(B, lower_q), nearest_rank(B, upper_q)
    row = F.when(F.col(unique_id).isNotNull() & F.col(ds).isNotNull(), row_key(unique_id, ds))
    out = draw_bounds(preds.withColumn("_key", row), "_key", residuals, key, B, seed, lo_i, hi_i)
    lower, upper = F.col(pred_col) + F.col("_lo"), F.col(pred_col) + F.col("_hi")
    return out.select(
        *preds.columns, lower.alias("lower_bound"), upper.alias("upper_bound"), (upper - lower).alias("width")
    )


def interval_coverage(df: DataFrame, target: str = "y", by: Sequence[str] = ()) -> DataFrame:
    """Rows inside / outside ``[lower_bound, upper_bound]`` (both ends in)."""
    in_ci = F.col(target).between(F.col("lower_bound"), F.col("upper_bound"))
    return df.groupBy(*by, in_ci.alias("in_ci")).agg(F.count(F.col(target)).alias("n"))


def multi_step_bootstrap(
    forecasts: DataFrame,
    residuals: DataFrame,
    B: int = 1000,
    seed: int = 25,
    decay: float = 0.25,
    lower_q: float = LOWER_Q,
    upper_q: float = UPPER_Q,
    unique_id: str = "unique_id",
    ds: str = "ds",
) -> DataFrame:
    """Bootstrap paths over a multi-step forecast.

    For each series and draw b: ``x_k = prediction_k + residual draw`` and the
    path ``p_1 = x_1``, ``p_k = decay * p_{k-1} + x_k`` (a running fold over
    the horizon).  Per (series, step): mean of the paths (``prediction``),
    nearest quantiles (``lower_bound``, ``upper_bound``) and ``width``.

    ``forecasts`` is (unique_id, ds, y_pred, step), one row per (series, step).
    The draws of all its rows are gathered in arrays (:func:`gather_draws`).
    Unrolled, the path is ``p_k = sum over j <= k of decay^(k-j) * x_j`` in
    step order, so every (series, step) row sums the arrays of its series up to
    its own step, with these weights.  A group holds one series, that is h
    arrays of ``B`` values.
    """
    lo_i, hi_i = nearest_rank(B, lower_q), nearest_rank(B, upper_q)
    keys = forecasts.select(unique_id, ds, "step", "y_pred").withColumn(
        "_key", combine_keys(text_key(unique_id), F.col("step"))
    )
    drawn = gather_draws(keys, index_pool(residuals, unique_id, ds), B, seed)
    x = F.transform("_draws", lambda r: F.col("y_pred") + r)
    series = drawn.groupBy(unique_id).agg(F.sort_array(F.collect_list(F.struct("step", ds, x.alias("x")))).alias("_x"))
    steps = series.select(unique_id, "_x", F.posexplode("_x").alias("_k", "_own"))
    # Horner's rule over the steps up to the row's own.
    path = F.aggregate(
        F.slice("_x", F.lit(1), F.col("_k") + 1),
        F.transform(F.col("_own.x"), lambda _: F.lit(0.0)),
        lambda acc, e: F.zip_with(acc, e["x"], lambda p, v: p * F.lit(decay) + v),
    )
    paths = steps.select(unique_id, F.col(f"_own.{ds}").alias(ds), F.col("_own.step").alias("step"), F.sort_array(path).alias("_s"))
    total = F.aggregate("_s", F.lit(0.0), lambda a, v: a + v)
    at = lambda i: F.try_element_at("_s", F.lit(i + 1))
    out = paths.select(
        unique_id, ds, "step", F.try_divide(total, F.size("_s").cast("double")).alias("prediction"),
        at(lo_i).alias("lower_bound"), at(hi_i).alias("upper_bound"),
    )
    return out.withColumn("width", F.col("upper_bound") - F.col("lower_bound"))
