"""Lag models: mean-of-lags predictor (T4-T6), pooled lag regression
(T7-T9) and the recursive multi-step forecast shared by both.

The recursion never loops over Spark jobs and never calls Python per row:
each series carries a bounded array of its last ``max(lags)`` values and
``F.aggregate`` appends one prediction per step, all inside the JVM.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourglass.functions.carry import last_of_series
from hourglass.functions.grid import HALO_COL, bucket_window
from hourglass.functions.time import add_duration
from hourglass.operators.series import lag_name, row_mean, with_history
from hourglass.operators.spine import extend_horizon

Step = Callable[[Column], Column]


# --------------------------------------------------------------- step functions


def mean_step(lags: Sequence[int]) -> Step:
    """Next value = mean of the lagged values (nulls skipped)."""
    return lambda acc: row_mean([F.try_element_at(acc, F.lit(-int(lag))) for lag in lags])


def linear_step(lags: Sequence[int], intercept: "Column | float", coefs: Sequence["Column | float"]) -> Step:
    """Next value = intercept + sum(coef_j * value lag_j ago).

    ``intercept`` and ``coefs`` may be columns (per-fold parameters joined on
    the rows) or Python floats.
    """

    def step(acc: Column) -> Column:
        out = intercept if isinstance(intercept, Column) else F.lit(float(intercept))
        for lag, c in zip(lags, coefs, strict=True):
            cc = c if isinstance(c, Column) else F.lit(float(c))
            out = out + cc * F.element_at(acc, F.lit(-int(lag)))
        return out

    return step


def recursive_forecast(hist: Column, h: int, step: Step) -> Column:
    """Array of ``h`` forecasts; each step sees the history plus the earlier
    forecasts (recursive strategy).  ``hist`` is oldest-first."""
    start = hist.cast(T.ArrayType(T.DoubleType()))
    full = F.aggregate(
        F.sequence(F.lit(1), F.lit(h)), start, lambda acc, _k: F.concat(acc, F.array(step(acc)))
    )
    return F.slice(full, -h, h)


def direct_weights(lags: Sequence[int], h: int, intercept: float, coefs: Sequence[float]) -> list[list[float]]:
    """Per horizon, the weights on the last ``max(lags)`` values (oldest first) and a constant.

    With the state (last values, 1), one step of the recursion is a product with
    the companion matrix; the forecast of step k is the newest entry of its k-th
    power, so it is one dot product over the history.
    """
    L = max(lags)
    companion = np.zeros((L + 1, L + 1))
    companion[np.arange(L - 1), np.arange(1, L)] = 1.0
    for lag, c in zip(lags, coefs, strict=True):
        companion[L - 1, L - lag] += c
    companion[L - 1, L] = intercept
    companion[L, L] = 1.0
    row = np.eye(L + 1)[L - 1]
    out = []
    for _ in range(h):
        row = row @ companion
        out.append(row.tolist())
    return out


def direct_forecast(hist: Column, weights: Column, size: int) -> Column:
    """Array of forecasts, one per row of ``weights`` (see :func:`direct_weights`),
    from the last ``size`` values of ``hist``.

    A missing value with a weight makes a forecast null; without one it does not count.
    """
    last = F.concat(F.slice(hist.cast(T.ArrayType(T.DoubleType())), -size, size), F.array(F.lit(1.0)))
    terms = lambda w: F.zip_with(last, w, lambda x, c: F.when(c == 0, F.lit(0.0)).otherwise(x * c))
    return F.transform(weights, lambda w: F.aggregate(terms(w), F.lit(0.0), lambda a, x: a + x))


def weight_rows(params: DataFrame, lags: Sequence[int], h: int) -> DataFrame:
    """(fold_id, ``_weights``) of per-fold parameters: one small row per fold."""
    rows = [
        (r["fold_id"], direct_weights(lags, h, r["intercept"], [r[f"coef_lag_{lag}"] for lag in lags])) for r in params.collect()
    ]
    return params.sparkSession.createDataFrame(rows, "fold_id int, _weights array<array<double>>")


def forecasts(hist: Column, model: "LagModel", h: int, strategy: str) -> Column:
    """Array of ``h`` forecasts by ``strategy``: ``recursive`` or ``direct``, which are equal.

    The mean of lags skips missing values, so it is linear in complete histories
    alone: others go through the recursion in either strategy.
    """
    recursive = recursive_forecast(hist, h, model.step())
    if strategy == "recursive":
        return recursive
    if strategy != "direct":
        raise ValueError("strategy must be 'recursive' or 'direct'")
    coefs = model.coefs or [1.0 / len(model.lags)] * len(model.lags)
    direct = direct_forecast(hist, F.lit(direct_weights(model.lags, h, model.intercept, coefs)), model.max_lag)
    if model.coefs is not None:
        return direct
    return F.when(F.exists(F.slice(hist, -model.max_lag, model.max_lag), F.isnull), recursive).otherwise(direct)


# ------------------------------------------------------------------ model rows


@dataclass(frozen=True)
class LagModel:
    """Parameters of a lag model.  ``coefs is None`` means the mean of lags."""

    lags: tuple[int, ...]
    freq: str = "1d"
    intercept: float = 0.0
    coefs: tuple[float, ...] | None = None

    @property
    def max_lag(self) -> int:
        return max(self.lags)

    def step(self) -> Step:
        if self.coefs is None:
            return mean_step(self.lags)
        return linear_step(self.lags, self.intercept, self.coefs)


# ------------------------------------------------------------ mean-lag model


def mean_lag_predict(
    X: DataFrame,
    lags: Sequence[int],
    freq: str = "1d",
    unique_id: str = "unique_id",
    ds: str = "ds",
    target: str = "y",
    grid: bool = False,
    by_position: bool = False,
) -> DataFrame:
    """One-step predictions on the history plus one future row per series (T4).

    ``y_hat`` = mean of the lag values (nulls skipped).  Rows are kept only
    where ``ds > min(ds) + max(lags) * freq`` of their series (strict).
    Output: the input columns plus ``y_hat``.

    ``grid=True`` declares complete series on the ``freq`` grid; see
    ``series.with_history``: in no mode does a task hold a whole series.
    """
    cols = X.columns
    ext = extend_horizon(X, 1, freq, unique_id, ds, target)
    firsts = X.groupBy(unique_id).agg(F.min(ds).alias("_first"))
    h = with_history(ext, unique_id, ds, max(lags), freq if grid else None, by_position)
    w = bucket_window(unique_id, ds)
    lag_cols = [F.lag(target, i).over(w) for i in lags]
    out = h.select(*cols, HALO_COL, row_mean(lag_cols).alias("y_hat")).where(~F.col(HALO_COL)).join(firsts, unique_id)
    out = out.where(F.col(ds) > add_duration(F.col("_first"), freq, max(lags)))
    return out.select(*cols, "y_hat")


def mean_lag_residuals(
    X: DataFrame,
    lags: Sequence[int],
    freq: str = "1d",
    unique_id: str = "unique_id",
    ds: str = "ds",
    target: str = "y",
    grid: bool = False,
) -> DataFrame:
    """In-sample residuals ``y - y_hat`` where ``y`` is known (T5).

    Kept as a frame (unique_id, ds, residual); pooled over all series by
    whoever reads it.
    """
    pred = mean_lag_predict(X, lags, freq, unique_id, ds, target, grid)
    return pred.where(F.col(target).isNotNull()).select(
        unique_id, ds, (F.col(target) - F.col("y_hat")).alias("residual")
    )


def series_tails(
    X: DataFrame,
    size: int,
    unique_id: str = "unique_id",
    ds: str = "ds",
    target: str = "y",
    freq: str | None = None,
) -> DataFrame:
    """Per series: the last ``size`` target values (oldest first) as ``_hist``,
    the last ``ds`` as ``_last`` and the row count as ``_n``.

    With ``freq`` (complete grid) the tail is cut by time before any
    grouping: a two-phase max/count per series, a filter
    ``ds > last - size * freq``, then a group of at most ``size`` rows per
    series.  Without it, the ranges of the sort order give their last rows
    (``functions.carry``).  A hot series never reaches one task whole.
    """
    if freq is not None:
        last = X.groupBy(unique_id).agg(F.max(ds).alias("_last"), F.count(F.lit(1)).alias("_n"))
        tail = X.select(unique_id, ds, target).join(last, unique_id).where(
            F.col(ds) > add_duration(F.col("_last"), freq, -size)
        )
        return tail.groupBy(unique_id).agg(
            F.first("_last").alias("_last"),
            F.first("_n").alias("_n"),
            F.transform(
                F.sort_array(F.collect_list(F.struct(ds, F.col(target).cast("double").alias("v")))), lambda e: e["v"]
            ).alias("_hist"),
        )
    return last_of_series(X, unique_id, ds, size, F.col(target).cast("double"))


def forecast_series(
    X: DataFrame,
    model: LagModel,
    h: int,
    unique_id: str = "unique_id",
    ds: str = "ds",
    target: str = "y",
    min_history: int | None = None,
    grid: bool = False,
    strategy: str = "recursive",
) -> DataFrame:
    """``h`` forecasts after each series' last row (T6 / T8 core); see :func:`forecasts` for ``strategy``.

    Output (unique_id, ds, y_pred, step).  Series with fewer than
    ``min_history`` rows (default ``max_lag + 1``: the first row with every
    lag must exist before the forecast row) get no forecast.
    """
    L = model.max_lag
    need = L + 1 if min_history is None else min_history
    tails = series_tails(X, L, unique_id, ds, target, model.freq if grid else None)
    tails = tails.where(F.col("_n") >= need)
    fc = tails.select(
        unique_id,
        "_last",
        F.posexplode(forecasts(F.col("_hist"), model, h, strategy)).alias("_k", "y_pred"),
    )
    return fc.select(
        unique_id,
        add_duration(F.col("_last"), model.freq, F.col("_k") + 1).alias(ds),
        "y_pred",
        (F.col("_k") + 1).alias("step"),
    )


def recursive_forecast_frame(
    X: DataFrame,
    model: LagModel,
    h: int,
    unique_id: str = "unique_id",
    ds: str = "ds",
    target: str = "y",
    grid: bool = False,
) -> DataFrame:
    """Input rows plus ``h`` forecast rows per series, flagged by
    ``IsForecasted = ds > last ds of the series`` (T6, T8)."""
    cols = X.columns
    fc = forecast_series(X, model, h, unique_id, ds, target, grid=grid)
    hist = X.withColumn(target, F.col(target).cast("double")).withColumn("IsForecasted", F.lit(False))
    fut = fc.select(unique_id, ds, F.col("y_pred").alias(target))
    for c in cols:
        if c not in (unique_id, ds, target):
            fut = fut.withColumn(c, F.lit(None).cast(X.schema[c].dataType))
    fut = fut.withColumn("IsForecasted", F.lit(True))
    return hist.unionByName(fut.select(*cols, "IsForecasted"))


# ------------------------------------------------------------ lag regression


def design_columns(lags: Sequence[int], target: str = "y") -> list[str]:
    return ["intercept"] + [lag_name(target, i) for i in lags]


def lag_features(
    X: DataFrame,
    lags: Sequence[int],
    unique_id: str = "unique_id",
    ds: str = "ds",
    target: str = "y",
    keep: Sequence[str] = (),
    grid_freq: str | None = None,
    by_position: bool = False,
) -> DataFrame:
    """Rows with every lag present (nulls dropped), plus an intercept column.

    No task holds a whole series: see ``series.with_history``.
    """
    names = [lag_name(target, i) for i in lags]
    base = X.select(unique_id, ds, F.col(target).cast("double").alias(target), *keep)
    h = with_history(base, unique_id, ds, max(lags), grid_freq, by_position)
    w = bucket_window(unique_id, ds)
    lagged = [F.lag(target, i).over(w).alias(n) for i, n in zip(lags, names)]
    out = h.select(*base.columns, HALO_COL, *lagged).where(~F.col(HALO_COL)).drop(HALO_COL)
    return out.dropna(subset=names + [target]).withColumn("intercept", F.lit(1.0))


def normal_equation_sums(
    feats: DataFrame,
    lags: Sequence[int],
    target: str = "y",
    group_cols: Sequence[str] = (),
) -> DataFrame:
    """Sums behind ordinary least squares (T9): for Z = [intercept, lags, y]
    every ``s_{a}_{b} = sum(z_a * z_b)`` with a <= b, per group.

    One two-phase aggregate; the sums of several groups add up, so expanding
    folds are prefix sums of per-segment sums (no row is copied per fold).
    """
    names = design_columns(lags, target) + [target]
    aggs = []
    for i, a in enumerate(names):
        for b in names[i:]:
            aggs.append(F.sum(F.col(a) * F.col(b)).alias(f"s__{a}__{b}"))
    if group_cols:
        return feats.groupBy(*group_cols).agg(*aggs)
    return feats.agg(*aggs)


def solve_normal_equations(row: dict, lags: Sequence[int], target: str = "y") -> tuple[float, tuple[float, ...]]:
    """Solve (X'X) b = X'y from one row of sums (a (p+1)^2 system on the driver)."""
    feats = design_columns(lags, target)
    p = len(feats)
    xtx = np.zeros((p, p))
    xty = np.zeros(p)
    for i, a in enumerate(feats):
        for j, b in enumerate(feats):
            k = f"s__{a}__{b}" if i <= j else f"s__{b}__{a}"
            xtx[i, j] = row[k] or 0.0
        xty[i] = row[f"s__{a}__{target}"] or 0.0
    beta, *_ = np.linalg.lstsq(xtx, xty, rcond=None)
    return float(beta[0]), tuple(float(b) for b in beta[1:])


def fit_lag_regression(
    X: DataFrame,
    lags: Sequence[int],
    freq: str = "1d",
    unique_id: str = "unique_id",
    ds: str = "ds",
    target: str = "y",
    method: str = "normal",
    grid: bool = False,
) -> LagModel:
    """Pooled OLS of ``y`` on its lags with an intercept, over all series.

    ``method='normal'``: one distributed aggregate of the normal-equation
    sums, solved on the driver (the system is (p+1)^2, p = number of lags).
    ``method='ml'``: ``pyspark.ml`` ``LinearRegression`` with the normal
    solver and no regularisation (same coefficients).
    """
    feats = lag_features(X, lags, unique_id, ds, target, grid_freq=freq if grid else None)
    if method == "normal":
        row = normal_equation_sums(feats, lags, target).first().asDict()
        b0, coefs = solve_normal_equations(row, lags, target)
        return LagModel(tuple(lags), freq, b0, coefs)
    if method == "ml":
        from pyspark.ml.feature import VectorAssembler
        from pyspark.ml.regression import LinearRegression

        cols = [lag_name(target, i) for i in lags]
        vec = VectorAssembler(inputCols=cols, outputCol="_features").transform(feats)
        lr = LinearRegression(
            featuresCol="_features", labelCol=target, regParam=0.0, solver="normal", standardization=False
        ).fit(vec)
        return LagModel(tuple(lags), freq, float(lr.intercept), tuple(float(c) for c in lr.coefficients))
    raise ValueError("method must be 'normal' or 'ml'")


def model_frame(spark, model: LagModel, fold_id: int | None = None) -> DataFrame:
    """A fitted model as one parameter row (saved as parquet instead of a pickle)."""
    row = {"intercept": model.intercept}
    for lag, c in zip(model.lags, model.coefs or [1.0 / len(model.lags)] * len(model.lags), strict=True):
        row[f"coef_lag_{lag}"] = c
    if fold_id is not None:
        row = {"fold_id": fold_id, **row}
    return spark.createDataFrame([row])


def save_model(spark, model: LagModel, path: str) -> None:
    """Persist a fitted model as one parquet row (kind, freq, lags, intercept, coefs)."""
    row = {
        "kind": "mean" if model.coefs is None else "linear",
        "freq": model.freq,
        "lags": [int(x) for x in model.lags],
        "intercept": float(model.intercept),
        "coefs": [float(c) for c in (model.coefs or ())],
    }
    schema = "kind string, freq string, lags array<int>, intercept double, coefs array<double>"
    spark.createDataFrame([row], schema).coalesce(1).write.mode("overwrite").parquet(path)


def load_model(spark, path: str) -> LagModel:
    """Read a model written by :func:`save_model`."""
    r = spark.read.parquet(path).first()
    coefs = None if r["kind"] == "mean" else tuple(r["coefs"])
    return LagModel(tuple(r["lags"]), r["freq"], r["intercept"], coefs)
