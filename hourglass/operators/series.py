"""Long-series operators: daily sum (A4), lags (W1), bounded per-series
history (W5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourglass.functions.carry import with_carry
from hourglass.functions.grid import HALO_COL, bucket_window, step_index, with_halo, with_row_halo
from hourglass.functions.time import parse_duration, trunc_day, trunc_hour


def lag_name(target: str, lag: int) -> str:
    return f"{target}__{lag}__lag"


def daily_sum(
    df: DataFrame,
    id_col: str = "pickup_location_id",
    ts_col: str = "pickup_datetime_hour",
    target: str = "num_pickup",
    every: str = "1d",
) -> DataFrame:
    """Tumbling calendar-day (or hour) sums per series, labelled by the
    window start, renamed to (unique_id, ds, y) (A4 + P10).

    A plain two-phase group-by: no sort is needed before it.
    """
    d = parse_duration(every)
    if d.months or d.micros not in (3_600_000_000, 86_400_000_000):
        raise ValueError("daily_sum supports every='1h' or '1d'")
    bucket = trunc_day(ts_col) if d.micros == 86_400_000_000 else trunc_hour(ts_col)
    return df.groupBy(F.col(id_col).alias("unique_id"), bucket.alias("ds")).agg(
        F.sum(target).cast("bigint").alias("y")
    )


def with_history(
    df: DataFrame, unique_id: str, ds: str, size: int, grid_freq: str | None = None, by_position: bool = False
) -> DataFrame:
    """``df`` in parts (``_bucket``) that each also hold, as ``_halo`` rows, the
    ``size`` rows before their own rows of a series.  Windows per (series,
    part) then equal windows per series.

    By default the parts are ranges of the sort order, which hand their last
    rows on (any series, gaps allowed).  ``grid_freq`` (e.g. ``'1d'``) declares
    complete series on that grid: the parts are then time buckets, without a
    sample.  A missing or repeated step in a part is an error: a lag would reach
    the wrong row.  (A gap that covers a whole halo leaves lags null, as at the
    start of a series.)  The check runs in the sort that the caller's windows
    need anyway.  ``by_position=True`` cuts the parts by exact row position.
    """
    if grid_freq is not None:
        return _complete(with_halo(df, ds, grid_freq, size), unique_id, ds, grid_freq)
    return with_row_halo(df, unique_id, ds, size) if by_position else with_carry(df, unique_id, ds, size)


def _complete(h: DataFrame, unique_id: str, ds: str, freq: str) -> DataFrame:
    """``h``, raising where two neighbouring rows of a part are not one step apart."""
    step = step_index(ds, freq)
    apart = (step - F.lag(step, 1).over(bucket_window(unique_id, ds))).alias("_apart")
    where = F.concat_ws(" ", F.lit(f"series not complete on the {freq} grid before"), F.col(unique_id), F.col(ds))
    checked = F.when(F.col("_apart") != 1, F.raise_error(where).cast("boolean")).otherwise(F.lit(True))
    return h.select("*", apart).where(checked).drop("_apart")


def time_lags(
    df: DataFrame,
    lags: Sequence[int],
    target: str = "y",
    ts_column: str = "ds",
    unique_id: str = "unique_id",
    drop_nulls: bool = True,
    grid_freq: str | None = None,
    by_position: bool = False,
) -> DataFrame:
    """Row-based lags of ``target`` inside each series ordered by time.

    Output: ``ds, unique_id, target`` and one ``{target}__{lag}__lag`` column
    per lag (other columns are not kept).  All lags share one window.

    No task holds a whole series: see :func:`with_history`.
    """
    names = [lag_name(target, i) for i in lags]
    h = with_history(df.select(ts_column, unique_id, target), unique_id, ts_column, max(lags), grid_freq, by_position)
    w = bucket_window(unique_id, ts_column)
    lagged = [F.lag(target, i).over(w).alias(n) for i, n in zip(lags, names)]
    out = h.select(ts_column, unique_id, target, HALO_COL, *lagged).where(~F.col(HALO_COL)).drop(HALO_COL)
    return out.dropna(how="any") if drop_nulls else out


def row_mean(cols: Sequence[Column]) -> Column:
    """Row-wise mean that skips nulls; null when all are null."""
    total = None
    count = None
    for c in cols:
        v = F.coalesce(c.cast("double"), F.lit(0.0))
        n = F.when(c.isNotNull(), F.lit(1)).otherwise(F.lit(0))
        total = v if total is None else total + v
        count = n if count is None else count + n
    return F.try_divide(total, F.nullif(count, F.lit(0)).cast("double"))


def history_arrays(
    df: DataFrame,
    size: int,
    target: str = "y",
    ds: str = "ds",
    partition: Sequence[str] = ("unique_id",),
) -> DataFrame:
    """For every row: the last ``size`` values of ``target`` up to and
    including it (oldest first), and the row's position in its series (W5).

    The array is bounded by ``size`` (the largest lag), whatever the length
    of the series.
    """
    w = Window.partitionBy(*partition).orderBy(ds)
    return df.withColumns(
        {
            "_hist": F.collect_list(F.col(target).cast("double")).over(w.rowsBetween(-(size - 1), 0)),
            "_pos": F.row_number().over(w),
        }
    )
