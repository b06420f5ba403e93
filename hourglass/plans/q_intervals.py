"""Prediction-interval and residual-diagnostic queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.operators import intervals as IV
from hourglass.operators import residuals as R
from hourglass.operators.clean import transform_raw
from hourglass.operators.forecast import LagModel, forecast_series, mean_lag_predict, mean_lag_residuals
from hourglass.plans import inputs as I
from hourglass.plans.catalog import query, rounded

# Bootstrap sizes and seed of the original analysis.
B_ROW = 500
B_PATH = 1000
SEED = 25
PROBS = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]


def _residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mean_lag_residuals(I.daily_series(spark, sf_dir), I.LAGS, "1d", grid=True)


def _in_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    pred = mean_lag_predict(I.daily_series(spark, sf_dir), I.LAGS, "1d", grid=True)
    return pred.where(F.col("y").isNotNull()).withColumnRenamed("y_hat", "y_pred")


def _intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return IV.bootstrap_interval(_in_sample(spark, sf_dir), _residuals(spark, sf_dir), B=B_ROW, seed=SEED)


@query("bootstrap_interval")
def q_bootstrap_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_intervals(spark, sf_dir))


def hourly_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zero-filled hourly demand of every location, under series names."""
    demand = transform_raw(I.raw_trips(spark, sf_dir), I.TRIP_YEAR, I.TRIP_MONTH)
    return demand.select(
        F.col("pickup_location_id").cast("string").alias("unique_id"),
        F.col("pickup_datetime_hour").alias("ds"),
        F.col("num_pickup").cast("bigint").alias("y"),
    )


@query("bootstrap_interval_hourly")
def q_bootstrap_interval_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    pred = mean_lag_predict(hourly_series(spark, sf_dir), I.HOURLY_LAGS, "1h", grid=True).where(F.col("y").isNotNull())
    residuals = pred.select("unique_id", "ds", (F.col("y") - F.col("y_hat")).alias("residual"))
    rows = pred.withColumnRenamed("y_hat", "y_pred")
    return rounded(IV.bootstrap_interval(rows, residuals, B=I.HOURLY_DRAWS, seed=SEED))


@query("interval_coverage")
def q_interval_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return IV.interval_coverage(_intervals(spark, sf_dir))


@query("multi_step_bootstrap")
def q_multi_step_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    fc = forecast_series(I.daily_series(spark, sf_dir), LagModel(tuple(I.LAGS)), I.HORIZON, grid=True)
    return rounded(IV.multi_step_bootstrap(fc, _residuals(spark, sf_dir), B=B_PATH, seed=SEED))


@query("mae")
def q_mae(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(R.mae(_in_sample(spark, sf_dir), pred="y_pred"))


@query("residual_moments")
def q_residual_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(R.residual_moments(_residuals(spark, sf_dir)))


@query("residual_histogram")
def q_residual_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(R.residual_histogram(_residuals(spark, sf_dir), bins=20))


@query("residual_quantiles")
def q_residual_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(R.residual_quantiles(_residuals(spark, sf_dir), PROBS))


@query("residual_acf")
def q_residual_acf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(R.residual_acf(_residuals(spark, sf_dir), max_lag=30, grid_freq="1d"))
