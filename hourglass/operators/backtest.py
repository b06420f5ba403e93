"""Expanding time folds (T10, J6), rolling origins (T11, T12), evaluation
(A8-A10) and the whole backtest (T13) -- every fold, series and origin in
one plan, with the fold and the origin as columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourglass.functions.carry import asof_join, search_sorted
from hourglass.functions.grid import step_index
from hourglass.functions.time import Duration, add_duration, interval_expr, ntz_lit, parse_duration, to_datetime
from hourglass.operators.forecast import (
    LagModel,
    direct_forecast,
    forecasts,
    lag_features,
    linear_step,
    normal_equation_sums,
    recursive_forecast,
    solve_normal_equations,
    weight_rows,
)
from hourglass.operators.series import history_arrays


def time_folds(df: DataFrame, test_from, every: str = "3mo", ds: str = "ds") -> DataFrame:
    """Expanding-window folds (T10): (fold_id int, train_from, test_from, test_to).

    Fold starts are ``test_from, test_from + every, ...`` strictly before
    ``max(ds)``; ``test_to`` is the next start, the last one is ``max(ds)``
    (so the newest timestamp is in no fold); ``train_from`` is ``min(ds)``.
    ``test_from >= max(ds)`` gives no fold.  The frame has one row per
    ``every`` step inside the data's time span: its size depends on the
    span, not on the number of rows, so it can be held as one array.
    """
    t0 = ntz_lit(to_datetime(test_from))
    b = df.agg(F.min(ds).alias("lo"), F.max(ds).alias("hi"))
    starts = F.when(
        t0 < F.col("hi"),
        F.filter(F.sequence(t0, F.col("hi"), interval_expr(every)), lambda s: s < F.col("hi")),
    ).otherwise(F.array().cast("array<timestamp_ntz>"))
    b = b.select("lo", "hi", starts.alias("starts"))
    return b.select(
        F.posexplode("starts").alias("fold_id", "test_from"), "lo", "hi", "starts"
    ).select(
        F.col("fold_id").cast("int").alias("fold_id"),
        F.col("lo").alias("train_from"),
        "test_from",
        F.coalesce(F.try_element_at("starts", F.col("fold_id") + 2), F.col("hi")).alias("test_to"),
    )


def assign_folds(df: DataFrame, folds: DataFrame, ds: str = "ds") -> DataFrame:
    """Every (row, fold) with ``train_from <= ds < test_to``, plus ``is_test``.

    This copies each row into every fold whose window holds it (the long
    form of the original list of fold frames), from one array of all folds and
    without a join.  Prefer :func:`assign_test_fold` + prefix sums for work that
    can be cumulated over folds.
    """
    fold = F.struct("train_from", "test_from", "test_to", "fold_id")
    every = folds.agg(F.sort_array(F.collect_list(fold)).alias("f")).scalar()
    holds = lambda f: (F.col(ds) >= f["train_from"]) & (F.col(ds) < f["test_to"])
    long = df.withColumn("_folds", every).select(*df.columns, F.explode(F.filter("_folds", holds)).alias("_f"))
    return long.select(*df.columns, F.col("_f.fold_id").alias("fold_id"), (F.col(ds) >= F.col("_f.test_from")).alias("is_test"))


def assign_test_fold(df: DataFrame, folds: DataFrame, ds: str = "ds") -> DataFrame:
    """Tag each row with the one fold whose *test* window holds it (null if none).

    The fold starts are one sorted array, and each row finds its place in it by
    a binary search: no join, and no row is copied, as test windows do not
    overlap.
    """
    lists = folds.agg(F.sort_array(F.collect_list(F.struct("test_from", "test_to", "fold_id"))).alias("f"))
    part = lambda name: lists.select(F.transform("f", lambda e: e[name])).scalar()
    placed = df.withColumn("_starts", part("test_from")).withColumn("_at", search_sorted(F.col("_starts"), F.col(ds)) - 1)
    inside = (F.col("_at") >= 0) & (F.col(ds) < F.get(part("test_to"), F.col("_at")))
    return placed.select(*df.columns, F.when(inside, F.get(part("fold_id"), F.col("_at"))).alias("fold_id"))


def segment_of(tagged: DataFrame, folds: DataFrame, ds: str = "ds") -> DataFrame:
    """``_seg``: the test fold holding the row, -1 before the first test
    window, null after the last one (the newest timestamp)."""
    t0 = folds.select(F.min("test_from")).scalar()
    return tagged.withColumn("_seg", F.when(F.col(ds) < t0, F.lit(-1)).otherwise(F.col("fold_id")))


def fold_sizes(df: DataFrame, folds: DataFrame, target: str = "y", ds: str = "ds") -> DataFrame:
    """Rows and target sum of the train and test part of each fold (J6 sizes),
    without copying any row into several folds.

    Each row is counted once, in its segment (its test window, or the part
    before the first one); the train part of fold i is every segment before
    it, so its sizes are sums over the (tiny) segment frame.
    """
    segs = (
        segment_of(assign_test_fold(df, folds, ds), folds, ds)
        .where(F.col("_seg").isNotNull())
        .groupBy("_seg")
        .agg(F.count(F.lit(1)).alias("_n"), F.sum(target).cast("bigint").alias("_y"))
    )
    # The segment frame has a row per fold; as one array it gives each fold its sums.
    every = segs.agg(F.collect_list(F.struct("_seg", "_n", "_y")).alias("s")).scalar()
    sized = folds.select("fold_id", every.alias("_segs"))
    zero = F.lit(0).cast("bigint")

    def total(field: str, which) -> Column:
        return F.aggregate(F.filter("_segs", which), zero, lambda acc, e: acc + F.coalesce(e[field], zero))

    before, own = (lambda e: e["_seg"] < F.col("fold_id")), (lambda e: e["_seg"] == F.col("fold_id"))
    return sized.select(
        F.col("fold_id").cast("int").alias("fold_id"),
        total("_n", before).alias("train_rows"),
        total("_y", before).alias("train_y"),
        total("_n", own).alias("test_rows"),
        total("_y", own).alias("test_y"),
    )


def rolling_cutoffs(
    test_rows: DataFrame,
    max_lag: int,
    h: int,
    step_size: int | None = None,
    freq: str = "1d",
    ds: str = "ds",
) -> DataFrame:
    """Forecast origins per fold (T11): (fold_id, cutoff).

    From the fold's first test ``ds`` + ``max_lag`` steps of ``freq`` (the
    history the lags need; for daily series these are ``max_lag`` days, as in
    the original), every ``step_size`` (default ``h``) steps, strictly before
    the fold's last test ``ds``.
    """
    step = step_size or h
    unit = parse_duration(freq)
    every = Duration(unit.months * step, unit.micros * step)
    b = test_rows.where(F.col("fold_id").isNotNull()).groupBy("fold_id").agg(
        F.min(ds).alias("_lo"), F.max(ds).alias("_hi")
    )
    first = add_duration(F.col("_lo"), freq, max_lag)
    seq = F.when(
        first < F.col("_hi"),
        F.filter(F.sequence(first, F.col("_hi"), interval_expr(every)), lambda c: c < F.col("_hi")),
    ).otherwise(F.array().cast("array<timestamp_ntz>"))
    return b.select("fold_id", F.explode(seq).alias("cutoff"))


def rolling_origin_forecast(
    test_rows: DataFrame,
    cutoffs: DataFrame,
    h: int,
    lags: Sequence[int],
    params: DataFrame | None = None,
    freq: str = "1d",
    unique_id: str = "unique_id",
    ds: str = "ds",
    target: str = "y",
    grid: bool = False,
    strategy: str = "recursive",
) -> DataFrame:
    """h-step forecasts from every origin of every fold, joined to actuals.

    For each (fold, series, cutoff) the history is the series' test rows with
    ``ds <= cutoff``; the forecast starts after the series' own last such row.
    Output: (fold_id, unique_id, ds, cutoff, y, y_pred); horizons past the
    data fall out of the inner join with the actuals.

    Plan: one window per (fold, series), bounded by the fold's length, gives
    each row its history array.  The row that an origin starts from is the one
    at the origin itself (``grid``: complete series, an equi-join), else it is
    found by :func:`hourglass.functions.carry.asof_join`: a sorted union in
    ranges, nothing broadcast.  The recursion runs in ``F.aggregate``.  ``params`` (fold_id, intercept,
    coef_lag_<l>...) gives a linear model per fold; without it the step is the
    mean of the lags.  ``strategy='direct'``: each forecast is one dot product
    over the history, equal to the recursion (``forecast.direct_weights``).
    """
    L = max(lags)
    part = ["fold_id", unique_id]
    rows = test_rows.where(F.col("fold_id").isNotNull()).select(*part, ds, target)
    if grid:
        # Complete grid: the as-of row of a cutoff is the row at ds == cutoff,
        # so the origins are a plain equi-join on (fold, ds) -- balanced by
        # time, no broadcast needed (AQE picks the join by measured size).
        hist = history_arrays(rows, L, target, ds, part)
        c = cutoffs.select("fold_id", F.col("cutoff").alias(ds), "cutoff")
        origin = hist.join(c, ["fold_id", ds], "inner").where(F.size("_hist") >= L)
    else:
        # Each series meets each origin of its fold; the as-of join finds the row.
        pairs = rows.select(*part).distinct().join(cutoffs, "fold_id")
        last = asof_join(pairs, rows.withColumn("_last", F.col(ds)), part, "cutoff", ds, ["_last"])
        last = last.where(F.col("_last").isNotNull()).withColumnRenamed("_last", ds)
        hist = history_arrays(rows, L, target, ds, part)
        origin = hist.join(last, [*part, ds], "inner").where(F.size("_hist") >= L)
    if params is None:
        steps = forecasts(F.col("_hist"), LagModel(tuple(lags), freq), h, strategy)
    elif strategy == "direct":
        origin = origin.join(F.broadcast(weight_rows(params, lags, h)), "fold_id", "inner")
        steps = direct_forecast(F.col("_hist"), F.col("_weights"), L)
    else:
        origin = origin.join(F.broadcast(params), "fold_id", "inner")
        steps = recursive_forecast(
            F.col("_hist"), h, linear_step(lags, F.col("intercept"), [F.col(f"coef_lag_{lag}") for lag in lags])
        )
    fc = origin.select(
        *part,
        "cutoff",
        F.col(ds).alias("_last"),
        F.posexplode(steps).alias("_k", "y_pred"),
    ).select(*part, "cutoff", add_duration(F.col("_last"), freq, F.col("_k") + 1).alias(ds), "y_pred")
    return fc.join(rows, [*part, ds], "inner").select(
        "fold_id", unique_id, ds, "cutoff", target, "y_pred"
    )


def evaluate_forecast(
    df: DataFrame,
    unique_id: str = "unique_id",
    ds: str = "ds",
    target: str = "y",
    by: Sequence[str] = ("fold_id",),
    freq: str = "1d",
) -> DataFrame:
    """Bias, MAE and score per horizon.

    Stage 1 per (series, horizon): ``bias = mean(y_pred - y)``,
    ``mae = mean(|y_pred - y|)``, ``mae_per = sum|err| / sum y`` (null when
    the sum is 0), ``score = mae + |bias|``.  Stage 2 per horizon: the
    unweighted mean over series of bias, mae and score.  ``horizon`` is
    ``ds - cutoff`` in whole ``freq`` steps (days for daily series).
    """
    by = [c for c in by if c in df.columns]
    err = F.col("y_pred") - F.col(target)
    horizon = (step_index(F.col(ds), freq) - step_index(F.col("cutoff"), freq)).cast("int")
    s1 = df.select(
        *by, unique_id, horizon.alias("horizon"), err.alias("_e"), F.col(target)
    ).groupBy(*by, unique_id, "horizon").agg(
        F.avg("_e").alias("bias"),
        F.avg(F.abs("_e")).alias("mae"),
        F.try_divide(F.sum(F.abs("_e")), F.sum(target).cast("double")).alias("mae_per"),
    ).withColumn("score", F.col("mae") + F.abs("bias"))
    return s1.groupBy(*by, "horizon").agg(
        F.avg("bias").alias("bias"), F.avg("mae").alias("mae"), F.avg("score").alias("score")
    )


def metrics_wide(metrics: DataFrame, horizons: Sequence[int], by: Sequence[str] = ("fold_id",)) -> DataFrame:
    """``{metric}_{horizon}`` columns, one row per fold (A10).

    A pivot with an explicit value list (no extra pass to find the values).
    """
    by = [c for c in by if c in metrics.columns]
    long = metrics.unpivot([*by, "horizon"], ["bias", "mae", "score"], "metric", "value")
    long = long.withColumn("name", F.concat_ws("_", F.col("metric"), F.col("horizon").cast("string")))
    names = [f"{m}_{k}" for m in ("bias", "mae", "score") for k in horizons]
    if by:
        return long.groupBy(*by).pivot("name", names).agg(F.first("value"))
    return long.groupBy().pivot("name", names).agg(F.first("value"))


def fit_per_fold(
    series: DataFrame,
    folds: DataFrame,
    lags: Sequence[int],
    unique_id: str = "unique_id",
    ds: str = "ds",
    target: str = "y",
    grid_freq: str | None = None,
) -> DataFrame:
    """Per-fold lag-regression parameters from prefix sums (T7 over T9).

    Lags are built once on the whole series (train is a prefix, so this
    equals building them on each train set).  Each row's products are
    summed once, into the segment before its test window; the train sums of
    fold i are the sums of all earlier segments.  Only one row of sums per
    fold reaches the driver, where each small system is solved.
    """
    spark = series.sparkSession
    feats = lag_features(series, lags, unique_id, ds, target, grid_freq=grid_freq)
    tagged = segment_of(assign_test_fold(feats, folds, ds), folds, ds).where(F.col("_seg").isNotNull())
    # One action: every fold id (also folds without test rows) with its
    # segment sums, plus the segment before the first fold (-1).
    segs = normal_equation_sums(tagged, lags, target, ["_seg"])
    ids = folds.select(F.col("fold_id").alias("_seg")).unionByName(
        series.sparkSession.range(1).select(F.lit(-1).cast("int").alias("_seg"))
    )
    rows_ = ids.join(segs, "_seg", "left").collect()
    sums = {r["_seg"]: r.asDict() for r in rows_ if any(v is not None for k, v in r.asDict().items() if k != "_seg")}
    fold_ids = sorted(r["_seg"] for r in rows_ if r["_seg"] >= 0)
    rows = []
    keys = [k for k in next(iter(sums.values()), {}) if k.startswith("s__")] if sums else []
    acc = {k: 0.0 for k in keys}
    if -1 in sums:
        for k in keys:
            acc[k] += sums[-1][k] or 0.0
    for fid in fold_ids:
        if any(acc.values()):
            b0, coefs = solve_normal_equations(acc, lags, target)
            rows.append((fid, b0, *coefs))
        if fid in sums:
            for k in keys:
                acc[k] += sums[fid][k] or 0.0
    schema = "fold_id int, intercept double, " + ", ".join(f"coef_lag_{lag} double" for lag in lags)
    return spark.createDataFrame(rows, schema)


def backtest(
    series: DataFrame,
    test_from,
    every: str = "3mo",
    h: int = 7,
    lags: Sequence[int] = (1, 7, 14, 28),
    model: str = "mean",
    freq: str = "1d",
    unique_id: str = "unique_id",
    ds: str = "ds",
    target: str = "y",
    grid: bool = False,
    strategy: str = "recursive",
) -> DataFrame:
    """The whole backtest (T13): folds -> per-fold model -> rolling-origin
    forecasts on each fold's test part -> metrics per (fold, horizon).

    ``model='mean'``: the mean-of-lags model (no fit).  ``model='linear'``:
    pooled lag regression fitted per fold on its expanding train part.
    """
    folds = time_folds(series, test_from, every, ds)
    tagged = assign_test_fold(series, folds, ds)
    cutoffs = rolling_cutoffs(tagged, max(lags), h, freq=freq, ds=ds)
    params = None
    if model == "linear":
        params = fit_per_fold(series, folds, lags, unique_id, ds, target, grid_freq=freq if grid else None)
    elif model != "mean":
        raise ValueError("model must be 'mean' or 'linear'")
    fc = rolling_origin_forecast(tagged, cutoffs, h, lags, params, freq, unique_id, ds, target, grid=grid, strategy=strategy)
    return evaluate_forecast(fc, unique_id, ds, target, freq=freq)


__all__ = [
    "LagModel",
    "assign_folds",
    "assign_test_fold",
    "backtest",
    "evaluate_forecast",
    "fit_per_fold",
    "fold_sizes",
    "metrics_wide",
    "rolling_cutoffs",
    "rolling_origin_forecast",
    "time_folds",
]
