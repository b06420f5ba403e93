"""Residual diagnostics (A11-A15): MAE, moments, histogram, exact nearest
quantiles, autocorrelation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.functions.grid import HALO_COL, bucket_window
from hourglass.functions.ranks import POS, sorted_positions
from hourglass.operators.series import with_history


def mae(df: DataFrame, target: str = "y", pred: str = "y_hat", by: Sequence[str] = ("unique_id",)) -> DataFrame:
    """Mean absolute error per group."""
    return df.groupBy(*by).agg(
        F.avg(F.abs(F.col(target) - F.col(pred))).alias("mae"), F.count(F.col(target)).alias("n")
    )


def residual_moments(df: DataFrame, col: str = "residual", by: Sequence[str] = ("unique_id",)) -> DataFrame:
    """Mean and sample standard deviation."""
    return df.groupBy(*by).agg(
        F.count(col).alias("n"), F.avg(col).alias("mean"), F.stddev_samp(col).alias("std")
    )


def residual_histogram(df: DataFrame, col: str = "residual", bins: int = 20) -> DataFrame:
    """Equal-width histogram over the global [min, max].

    Bucket ``floor((x - min) / (max - min) * bins)``, the maximum folded into
    the last bucket.  min and max are scalar subqueries (one small pass).
    """
    lo = df.select(F.min(col)).scalar()
    hi = df.select(F.max(col)).scalar()
    span = hi - lo
    raw = F.floor((F.col(col) - lo) / span * F.lit(bins))
    bucket = F.when(span == 0, F.lit(0)).otherwise(F.least(raw, F.lit(bins - 1))).cast("int")
    counts = df.where(F.col(col).isNotNull()).groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(
        "bucket",
        (lo + span * F.col("bucket") / F.lit(bins)).alias("lower"),
        (lo + span * (F.col("bucket") + 1) / F.lit(bins)).alias("upper"),
        "n",
    )


def residual_quantiles(
    df: DataFrame,
    probs: Sequence[float],
    col: str = "residual",
    by: Sequence[str] = ("unique_id",),
) -> DataFrame:
    """Exact 'nearest' quantiles per group (A15): the value at 0-based rank
    ``floor((n - 1) * q + 0.5)`` of the sorted group.

    Ranks come from a range-partitioned sort (``functions.ranks``), so a
    group holding a large share of the rows is spread over many tasks; ``n``
    is a two-phase count per group, and the wanted ranks are joined in.
    """
    base = df.where(F.col(col).isNotNull()).select(*by, col)
    ranked = sorted_positions(base, [col], by)
    counts = base.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    qs = F.array(*[F.lit(float(q)) for q in probs])
    targets = counts.select(*by, F.explode(qs).alias("q"), "_n").select(
        *by, "q", F.floor((F.col("_n") - 1).cast("double") * F.col("q") + F.lit(0.5)).cast("bigint").alias(POS)
    )
    return ranked.join(targets, [*by, POS]).select(*by, "q", F.col(col).alias("value"))


def residual_acf(
    df: DataFrame,
    max_lag: int = 30,
    col: str = "residual",
    unique_id: str = "unique_id",
    ds: str = "ds",
    grid_freq: str | None = None,
    by_position: bool = False,
) -> DataFrame:
    """Autocorrelation at lags 1..max_lag per series, lag 0 left out.

    ``acf_k = sum(c_t * c_{t-k}) / sum(c_t^2)`` with ``c`` the residual
    minus its series mean.  The mean is a per-series group-by joined back;
    the lags run per part of a series (``series.with_history``); the sums are
    two-phase aggregates.
    """
    base = df.where(F.col(col).isNotNull()).select(unique_id, ds, col)
    means = base.groupBy(unique_id).agg(F.avg(col).alias("_mean"))
    centred = base.join(means, unique_id).select(unique_id, ds, (F.col(col) - F.col("_mean")).alias("_c"))
    lag_exprs = lambda w: [F.lag("_c", k).over(w).alias(f"_l{k}") for k in range(1, max_lag + 1)]
    h = with_history(centred, unique_id, ds, max_lag, grid_freq, by_position)
    lagged = h.select(unique_id, "_c", HALO_COL, *lag_exprs(bucket_window(unique_id, ds))).where(~F.col(HALO_COL))
    sums = lagged.groupBy(unique_id).agg(
        F.sum(F.col("_c") * F.col("_c")).alias("_den"),
        *[F.sum(F.col("_c") * F.col(f"_l{k}")).alias(f"_n{k}") for k in range(1, max_lag + 1)],
    )
    pairs = F.array(*[F.struct(F.lit(k).alias("lag"), F.col(f"_n{k}").alias("num")) for k in range(1, max_lag + 1)])
    return sums.select(unique_id, "_den", F.inline(pairs)).select(
        unique_id, "lag", F.try_divide(F.coalesce("num", F.lit(0.0)), F.col("_den")).alias("acf")
    )
