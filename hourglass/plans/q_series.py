"""Series queries: daily sums, gap-filled daily series, lags, horizon."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hourglass.operators.forecast import mean_lag_predict
from hourglass.operators.select import series_slice
from hourglass.operators.series import daily_sum, time_lags
from hourglass.operators.spine import extend_horizon
from hourglass.plans import inputs as I
from hourglass.plans.catalog import as_double, query, rounded
from hourglass.plans.q_etl import hourly_demand_df

# Hourly lags (1 hour, 1 day, 1 week).
HOURLY_LAGS = [1, 24, 168]


@query("daily_sum")
def q_daily_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_sum(hourly_demand_df(spark, sf_dir))


@query("daily_series")
def q_daily_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.daily_series(spark, sf_dir)


@query("time_lags")
def q_time_lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return time_lags(I.daily_series(spark, sf_dir), I.LAGS, grid_freq="1d")


@query("time_lags_nulls")
def q_time_lags_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = time_lags(I.daily_series(spark, sf_dir), I.LAGS, drop_nulls=False, grid_freq="1d")
    return as_double(out, [c for c in out.columns if c.endswith("__lag")])


@query("time_lags_gappy")
def q_time_lags_gappy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 by rows on series with gaps: daily order counts of every customer nation."""
    return time_lags(I.nation_counts(spark, sf_dir), I.LAGS)


@query("extend_horizon")
def q_extend_horizon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_double(extend_horizon(I.daily_series(spark, sf_dir), I.HORIZON, "1d"), ["y"])


@query("series_slice")
def q_series_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    pred = mean_lag_predict(I.daily_series(spark, sf_dir), I.LAGS, "1d", grid=True)
    return rounded(
        series_slice(pred, ["y_hat"], target="y", locations=None, plot_from="2001-01-01")
        .where("unique_id IN ('1-URGENT', '5-LOW')")
    )


@query("hourly_lags")
def q_hourly_lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly demand renamed to series columns (P10), lags of 1 hour, 1 day
    and 1 week on the complete hourly grid (W1, grid mode)."""
    from hourglass.operators.select import rename_to_series

    series = rename_to_series(hourly_demand_df(spark, sf_dir)).select("unique_id", "ds", "y")
    return time_lags(series, HOURLY_LAGS, grid_freq="1h")
