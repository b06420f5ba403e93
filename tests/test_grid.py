"""Grid mode (halo time buckets) gives exactly the window-mode results."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.errors import PySparkException

from hourglass.functions import grid as G
from hourglass.operators.forecast import LagModel, fit_lag_regression, forecast_series, lag_features, mean_lag_predict
from hourglass.operators.residuals import residual_acf
from hourglass.operators.series import time_lags


@pytest.fixture()
def small_buckets(monkeypatch):
    monkeypatch.setattr(G, "DEFAULT_BUCKET_STEPS", 16)
    monkeypatch.setattr(G.with_halo, "__defaults__", (16,))


def _series(spark, freq_hours=24, n=100):
    rng = np.random.default_rng(11)
    rows = []
    for uid in ("A", "B", "C"):
        start = datetime(2023, 1, 1) + timedelta(hours=freq_hours * int(rng.integers(0, 40)))
        for i in range(n):
            rows.append((uid, start + timedelta(hours=freq_hours * i), int(rng.integers(0, 30))))
    return spark.createDataFrame(rows, "unique_id string, ds timestamp_ntz, y long")


def _set(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("freq, hours", [("1d", 24), ("1h", 1), ("6h", 6)])
def test_time_lags_grid_equals_window(spark, small_buckets, freq, hours):
    df = _series(spark, hours)
    lags = [1, 3, 7, 16]
    assert _set(time_lags(df, lags, grid_freq=freq)) == _set(time_lags(df, lags))
    assert _set(time_lags(df, lags, drop_nulls=False, grid_freq=freq)) == _set(time_lags(df, lags, drop_nulls=False))


def test_lag_longer_than_a_bucket(spark, small_buckets):
    df = _series(spark, n=60)
    assert _set(time_lags(df, [1, 40], grid_freq="1d")) == _set(time_lags(df, [1, 40]))
    assert _set(time_lags(df, [1, 40], by_position=True)) == _set(time_lags(df, [1, 40]))


def test_cutoffs_step_in_multiples_of_the_frequency(spark):
    from hourglass.operators.backtest import rolling_cutoffs

    rows = [(0, datetime(2023, 1, 1) + timedelta(days=2 * i)) for i in range(12)]
    df = spark.createDataFrame(rows, "fold_id int, ds timestamp_ntz")
    got = sorted(r.cutoff for r in rolling_cutoffs(df, 1, 3, freq="2d").collect())
    assert got == [datetime(2023, 1, 3), datetime(2023, 1, 9), datetime(2023, 1, 15), datetime(2023, 1, 21)]


def test_predict_features_acf_grid_equal_window(spark, small_buckets):
    df = _series(spark)
    lags = [1, 7, 14]
    a = _set(mean_lag_predict(df, lags, "1d", grid=True))
    b = _set(mean_lag_predict(df, lags, "1d"))
    assert a == b
    assert _set(lag_features(df, lags, grid_freq="1d")) == _set(lag_features(df, lags))
    res = df.withColumn("residual", df.y.cast("double") - 10.0)
    ga = {(r.unique_id, r.lag): r.acf for r in residual_acf(res, 5, grid_freq="1d").collect()}
    wa = {(r.unique_id, r.lag): r.acf for r in residual_acf(res, 5).collect()}
    assert ga.keys() == wa.keys()
    for k in ga:
        assert ga[k] == pytest.approx(wa[k])


def test_forecast_tail_grid_equals_window(spark, small_buckets):
    df = _series(spark)
    m = fit_lag_regression(df, [1, 7], grid=True)
    w = fit_lag_regression(df, [1, 7])
    assert m.coefs == pytest.approx(w.coefs)
    for model in (LagModel((1, 7, 14)), m):
        a = _set(forecast_series(df, model, 5, grid=True))
        b = _set(forecast_series(df, model, 5))
        assert [(u, d, s) for u, d, _, s in a] == [(u, d, s) for u, d, _, s in b]
        assert [v for _, _, v, _ in a] == pytest.approx([v for _, _, v, _ in b])


def test_sorted_positions_equals_row_number_with_hot_group(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from hourglass.functions.ranks import POS, sorted_positions

    rng = np.random.default_rng(5)
    rows = [("hot", float(v)) for v in rng.normal(size=3000)] + [
        (f"g{i}", float(v)) for i in range(20) for v in rng.normal(size=20)
    ]
    df = spark.createDataFrame(rows, "g string, v double")
    got = sorted_positions(df, ["v"], ["g"], num_partitions=8)
    parts = got.select(F.spark_partition_id().alias("p"), "g").where("g = 'hot'").select("p").distinct().count()
    assert parts > 1  # the hot group is spread over several range partitions
    exp = df.select("g", "v", (F.row_number().over(Window.partitionBy("g").orderBy("v")) - 1).alias(POS))
    assert sorted(tuple(r) for r in got.select("g", "v", POS).collect()) == sorted(tuple(r) for r in exp.collect())
    glob = sorted_positions(df, ["g", "v"], num_partitions=8).select(POS).collect()
    assert sorted(r[0] for r in glob) == list(range(len(rows)))


def test_position_buckets_equal_window_on_gappy_series(spark, small_buckets, monkeypatch):
    monkeypatch.setattr(G, "DEFAULT_BUCKET_STEPS", 8)
    rng = np.random.default_rng(3)
    rows = []
    for uid in ("A", "B", "C"):
        t = datetime(2023, 1, 1)
        for _ in range(int(rng.integers(5, 70))):
            t += timedelta(hours=int(rng.integers(1, 50)))  # irregular gaps
            rows.append((uid, t, int(rng.integers(0, 30))))
    df = spark.createDataFrame(rows, "unique_id string, ds timestamp_ntz, y long")
    lags = [1, 2, 5, 8]
    a = _set(time_lags(df, lags, drop_nulls=False, by_position=True))
    b = _set(time_lags(df, lags, drop_nulls=False))
    assert a == b


def test_position_buckets_predict_features_acf(spark, small_buckets, monkeypatch):
    monkeypatch.setattr(G, "DEFAULT_BUCKET_STEPS", 8)
    rng = np.random.default_rng(9)
    rows = []
    for uid in ("A", "B"):
        t = datetime(2023, 1, 1)
        for _ in range(int(rng.integers(20, 60))):
            t += timedelta(days=int(rng.integers(1, 4)))
            rows.append((uid, t, int(rng.integers(0, 30))))
    df = spark.createDataFrame(rows, "unique_id string, ds timestamp_ntz, y long")
    lags = [1, 3, 7]
    assert _set(lag_features(df, lags, by_position=True)) == _set(lag_features(df, lags))
    assert _set(mean_lag_predict(df, lags, "1d", by_position=True)) == _set(mean_lag_predict(df, lags, "1d"))
    res = df.withColumn("residual", df.y.cast("double") - 12.5)
    pa_ = {(r.unique_id, r.lag): r.acf for r in residual_acf(res, 6, by_position=True).collect()}
    wa = {(r.unique_id, r.lag): r.acf for r in residual_acf(res, 6).collect()}
    assert pa_.keys() == wa.keys()
    for k in pa_:
        assert pa_[k] == pytest.approx(wa[k])


@pytest.mark.parametrize("days", [[0, 1, 3, 4], [0, 1, 1, 2], [0, 1, 2, 5, 6]])
def test_gaps_and_repeats_are_errors_on_a_grid(spark, days):
    rows = [("a", datetime(2023, 1, 1) + timedelta(days=d), d) for d in days]
    df = spark.createDataFrame(rows, "unique_id string, ds timestamp_ntz, y long")
    with pytest.raises(PySparkException, match="not complete on the 1d grid before a 2023-01"):
        time_lags(df, [1], drop_nulls=False, grid_freq="1d").collect()
    assert time_lags(df, [1], drop_nulls=False).count() == len(days)  # the default takes any series
