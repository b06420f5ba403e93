"""Forecast and backtest queries on the complete daily order series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.operators import backtest as BT
from hourglass.operators.forecast import (
    LagModel,
    fit_lag_regression,
    forecast_series,
    lag_features,
    mean_lag_predict,
    mean_lag_residuals,
    model_frame,
    normal_equation_sums,
    recursive_forecast_frame,
)
from hourglass.plans import inputs as I
from hourglass.plans.catalog import as_double, query, rounded
from hourglass.plans.q_etl import hourly_demand_df


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.daily_series(spark, sf_dir)


@query("mean_lag_predict")
def q_mean_lag_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(as_double(mean_lag_predict(_daily(spark, sf_dir), I.LAGS, "1d", grid=True), ["y"]))


@query("mean_lag_residuals")
def q_mean_lag_residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(mean_lag_residuals(_daily(spark, sf_dir), I.LAGS, "1d", grid=True))


@query("mean_lag_forecast")
def q_mean_lag_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(recursive_forecast_frame(_daily(spark, sf_dir), LagModel(tuple(I.LAGS)), I.HORIZON, grid=True))


@query("lag_normal_equations")
def q_lag_normal_equations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(normal_equation_sums(lag_features(_daily(spark, sf_dir), I.LAGS, grid_freq="1d"), I.LAGS))


@query("lag_regression_fit")
def q_lag_regression_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(model_frame(spark, fit_lag_regression(_daily(spark, sf_dir), I.LAGS, grid=True)))


@query("lag_regression_forecast")
def q_lag_regression_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = _daily(spark, sf_dir)
    model = fit_lag_regression(daily, I.LAGS, grid=True)
    return rounded(forecast_series(daily, model, I.HORIZON, grid=True))


@query("lag_regression_direct")
def q_lag_regression_direct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forecasts of ``lag_regression_forecast`` as dot products over the history."""
    daily = _daily(spark, sf_dir)
    model = fit_lag_regression(daily, I.LAGS, grid=True)
    return rounded(forecast_series(daily, model, I.HORIZON, grid=True, strategy="direct"))


def _folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return BT.time_folds(_daily(spark, sf_dir), I.TEST_FROM, I.FOLD_EVERY)


@query("time_folds")
def q_time_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _folds(spark, sf_dir)


@query("fold_sizes")
def q_fold_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return BT.fold_sizes(_daily(spark, sf_dir), _folds(spark, sf_dir))


@query("rolling_cutoffs")
def q_rolling_cutoffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = BT.assign_test_fold(_daily(spark, sf_dir), _folds(spark, sf_dir))
    return BT.rolling_cutoffs(tagged, max(I.LAGS), I.HORIZON)


def _rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = _daily(spark, sf_dir)
    tagged = BT.assign_test_fold(daily, _folds(spark, sf_dir))
    cutoffs = BT.rolling_cutoffs(tagged, max(I.LAGS), I.HORIZON)
    return BT.rolling_origin_forecast(tagged, cutoffs, I.HORIZON, I.LAGS, grid=True)


@query("rolling_origin_forecast")
def q_rolling_origin_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_rolling(spark, sf_dir))


@query("rolling_origin_asof")
def q_rolling_origin_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rolling origins on the sparse daily order counts of every customer nation:
    series have gaps, so most origins lie between two rows (J7)."""
    sparse = I.nation_counts(spark, sf_dir)
    tagged = BT.assign_test_fold(sparse, BT.time_folds(sparse, I.TEST_FROM, I.FOLD_EVERY))
    cutoffs = BT.rolling_cutoffs(tagged, max(I.LAGS), I.HORIZON)
    return rounded(BT.rolling_origin_forecast(tagged, cutoffs, I.HORIZON, I.LAGS))


@query("lag_normal_equations_gappy")
def q_lag_normal_equations_gappy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T9 over row lags of the sparse daily counts of every customer nation."""
    return rounded(normal_equation_sums(lag_features(I.nation_counts(spark, sf_dir), I.LAGS), I.LAGS))


@query("evaluate_forecast")
def q_evaluate_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(BT.evaluate_forecast(_rolling(spark, sf_dir)))


@query("metrics_wide")
def q_metrics_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = BT.evaluate_forecast(_rolling(spark, sf_dir))
    return rounded(BT.metrics_wide(m, range(1, I.HORIZON + 1)))


@query("backtest")
def q_backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(
        BT.backtest(_daily(spark, sf_dir), I.TEST_FROM, I.FOLD_EVERY, I.HORIZON, I.LAGS, model="mean", grid=True)
    )


@query("backtest_linear")
def q_backtest_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(
        BT.backtest(_daily(spark, sf_dir), I.TEST_FROM, I.FOLD_EVERY, I.HORIZON, I.LAGS, model="linear", grid=True)
    )


@query("backtest_direct")
def q_backtest_direct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``backtest_linear`` with direct weights per fold and horizon."""
    daily = _daily(spark, sf_dir)
    metrics = BT.backtest(
        daily, I.TEST_FROM, I.FOLD_EVERY, I.HORIZON, I.LAGS, model="linear", grid=True, strategy="direct"
    )
    return rounded(metrics)


@query("backtest_from_table")
def q_backtest_from_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From raw files to metrics: the monthly load of all orders into a snapshot
    table, a fetch by time range and the list of all nations, daily sums per
    nation, expanding folds, rolling origins, and the metrics per fold and horizon."""
    from hourglass.operators.clean import load_monthly
    from hourglass.operators.series import daily_sum
    from hourglass.operators.spine import fill_series_gaps
    from hourglass.plans.q_etl import _fresh, orders_by_month
    from hourglass.sources.snapshots import SnapshotTable

    table = SnapshotTable(spark, _fresh(spark, "backtest")).ensure()
    load_monthly(orders_by_month(spark, sf_dir), table)
    nations = [r[0] for r in I.table(spark, sf_dir, "nation").select("n_nationkey").collect()]
    daily = fill_series_gaps(daily_sum(table.fetch("1990-01-01", "2010-01-01", nations)), freq="1d", span="global")
    return rounded(BT.backtest(daily, I.TEST_FROM, I.FOLD_EVERY, I.HORIZON, I.LAGS, model="mean", grid=True))


@query("predict_for_date")
def q_predict_for_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read [ref - max_lag days, ref + 1 day) of the hourly table, sum to
    days, predict the next day per location with the mean-lag model."""
    from hourglass.operators.inference import predict_for_date

    return rounded(
        as_double(predict_for_date(hourly_demand_df(spark, sf_dir), "2024-01-30", LagModel(tuple(I.LAGS)), grid=True), ["y"])
    )


@query("horizon_predictions")
def q_horizon_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-step mean-lag predictions on the history plus h future days whose
    target is set to 0, kept to the future days (T3 + T4 + P11)."""
    from hourglass.operators.select import keep_dates
    from hourglass.operators.spine import extend_horizon

    daily = _daily(spark, sf_dir)
    ext = extend_horizon(daily, I.HORIZON, "1d")
    future = ext.where(F.col("y").isNull()).select("unique_id", "ds")
    filled = ext.withColumn("y", F.coalesce("y", F.lit(0).cast("bigint")))
    pred = mean_lag_predict(filled, I.LAGS, "1d", grid=True)
    return rounded(keep_dates(pred, future, by=["unique_id"]))


@query("lag1_regression_forecast")
def q_lag1_regression_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pooled regression on the previous day only, then a recursive h-step
    forecast per series (T7 + T8 with one lag: checkable in SQL)."""
    daily = _daily(spark, sf_dir)
    model = fit_lag_regression(daily, [1], grid=True)
    return rounded(forecast_series(daily, model, I.HORIZON, min_history=2, grid=True))
