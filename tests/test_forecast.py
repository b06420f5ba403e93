"""Lags (W1), mean-lag model (T4-T6), lag regression (T7-T9), folds and
rolling origins (T10-T13): checked against plain-Python brute force."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourglass.operators import backtest as BT
from hourglass.operators.forecast import (
    LagModel,
    direct_weights,
    fit_lag_regression,
    forecast_series,
    lag_features,
    mean_lag_predict,
    mean_lag_residuals,
    recursive_forecast_frame,
)
from hourglass.operators.series import time_lags
from hourglass.plans import inputs as I
from tests.conftest import SF


def test_time_lags_values(spark):
    data = {
        "ds": ["2023-01-01", "2023-01-02", "2023-01-03", "2023-01-04"] * 2,
        "unique_id": ["A"] * 4 + ["B"] * 4,
        "y": [10, 20, 30, 40, 15, 25, 35, 45],
    }
    df = spark.createDataFrame(list(zip(data["ds"], data["unique_id"], data["y"])), "ds string, unique_id string, y long")
    out = time_lags(df, [1, 2]).where("unique_id = 'A'").orderBy("ds").collect()
    assert out[-1]["y__1__lag"] == 30
    assert out[-1]["y__2__lag"] == 20


@pytest.mark.parametrize(
    "days, ids, lags",
    [(5, ["A", "B"], [1, 2]), (7, ["A", "B", "C"], [1, 2, 3]), (10, ["A", "B", "C", "D"], [1, 2, 3, 4, 5]), (15, ["A"], list(range(1, 8)))],
)
def test_time_lags_dimensions(spark, days, ids, lags):
    rows = []
    k = 0
    for uid in ids:
        for i in range(days):
            rows.append((f"2023-01-{i + 1:02d}", uid, k))
            k += 1
    df = spark.createDataFrame(rows, "ds string, unique_id string, y long")
    out = time_lags(df, lags)
    with_nulls = time_lags(df, lags, drop_nulls=False)
    assert out.count() == (days - max(lags)) * len(ids)
    assert len(out.columns) == 3 + len(lags) == len(with_nulls.columns)
    assert all(f"y__{lag}__lag" in out.columns for lag in lags)


def _series(spark, n=60, ids=("A", "B")):
    rng = np.random.default_rng(7)
    rows = []
    for uid in ids:
        for i in range(n):
            rows.append((uid, datetime(2023, 1, 1) + timedelta(days=i), int(rng.integers(0, 50))))
    return spark.createDataFrame(rows, "unique_id string, ds timestamp_ntz, y long"), rows


def _by_series(rows):
    out = {}
    for uid, ds, y in rows:
        out.setdefault(uid, []).append((ds, y))
    return {k: sorted(v) for k, v in out.items()}


def test_mean_lag_predict_brute_force(spark):
    df, rows = _series(spark, 40)
    lags = [1, 7, 14]
    got = {(r.unique_id, r.ds): r.y_hat for r in mean_lag_predict(df, lags).collect()}
    exp = {}
    for uid, s in _by_series(rows).items():
        ys = [y for _, y in s] + [None]
        dss = [d for d, _ in s] + [s[-1][0] + timedelta(days=1)]
        for i in range(len(ys)):
            if dss[i] > dss[0] + timedelta(days=max(lags)):
                exp[(uid, dss[i])] = float(np.mean([ys[i - lag] for lag in lags]))
    assert got.keys() == exp.keys()
    for k in exp:
        assert got[k] == pytest.approx(exp[k])
    res = mean_lag_residuals(df, lags)
    assert res.count() == len(exp) - 2  # the future rows have no residual


def _recursive_python(hist, h, step):
    acc = list(map(float, hist))
    for _ in range(h):
        acc.append(step(acc))
    return acc[-h:]


def test_mean_lag_forecast_brute_force(spark):
    df, rows = _series(spark, 45)
    lags = (1, 7, 14, 28)
    out = recursive_forecast_frame(df, LagModel(lags), 7)
    assert out.count() == len(rows) + 7 * 2
    fut = {(r.unique_id, r.ds): r.y for r in out.where("IsForecasted").collect()}
    for uid, s in _by_series(rows).items():
        exp = _recursive_python([y for _, y in s], 7, lambda a: float(np.mean([a[-lag] for lag in lags])))
        for k in range(7):
            assert fut[(uid, s[-1][0] + timedelta(days=k + 1))] == pytest.approx(exp[k])


def test_regression_fit_matches_numpy_and_ml(spark):
    df, rows = _series(spark, 80)
    lags = [1, 2, 7]
    m_ne = fit_lag_regression(df, lags)
    m_ml = fit_lag_regression(df, lags, method="ml")
    X, yv = [], []
    for s in _by_series(rows).values():
        ys = [y for _, y in s]
        for i in range(max(lags), len(ys)):
            X.append([1.0] + [ys[i - lag] for lag in lags])
            yv.append(ys[i])
    beta = np.linalg.lstsq(np.array(X, float), np.array(yv, float), rcond=None)[0]
    assert m_ne.intercept == pytest.approx(beta[0], rel=1e-8, abs=1e-8)
    assert m_ne.coefs == pytest.approx(tuple(beta[1:]), rel=1e-8, abs=1e-8)
    assert m_ml.coefs == pytest.approx(tuple(beta[1:]), rel=1e-6, abs=1e-6)
    fc = {(r.unique_id, r.step): r.y_pred for r in forecast_series(df, m_ne, 5).collect()}
    for uid, s in _by_series(rows).items():
        exp = _recursive_python(
            [y for _, y in s], 5, lambda a: beta[0] + sum(c * a[-lag] for c, lag in zip(beta[1:], lags))
        )
        for k in range(5):
            assert fc[(uid, k + 1)] == pytest.approx(exp[k])


def test_time_folds_on_orders(spark):
    daily = I.daily_series(spark, SF)
    folds = BT.time_folds(daily, "2000-01-01", "3mo").orderBy("fold_id").collect()
    assert len(folds) == 7
    assert folds[0].test_from == datetime(2000, 1, 1)
    assert folds[-1].test_to == datetime(2001, 8, 1)  # max(ds): the newest day is in no fold
    for a, b in zip(folds, folds[1:]):
        assert a.test_to == b.test_from
    none = BT.time_folds(daily, "2001-08-01", "3mo")
    assert none.count() == 0


def test_fold_sizes_prefix_sums(spark):
    daily = I.daily_series(spark, SF)
    folds = BT.time_folds(daily, "2000-01-01", "3mo")
    sizes = BT.fold_sizes(daily, folds).orderBy("fold_id").collect()
    long = BT.assign_folds(daily, folds).groupBy("fold_id", "is_test").count().collect()
    direct = {(r.fold_id, r.is_test): r["count"] for r in long}
    for s in sizes:
        assert s.train_rows == direct[(s.fold_id, False)]
        assert s.test_rows == direct[(s.fold_id, True)]
    for a, b in zip(sizes, sizes[1:]):
        assert b.train_rows == a.train_rows + a.test_rows


def test_fit_per_fold_equals_direct_fit(spark):
    daily = I.daily_series(spark, SF)
    lags = [1, 7]
    folds = BT.time_folds(daily, "2000-01-01", "6mo")
    params = {r.fold_id: r for r in BT.fit_per_fold(daily, folds, lags).collect()}
    for f in folds.collect():
        feats = lag_features(daily, lags).where(F.col("ds") < F.lit(f.test_from))
        direct = fit_lag_regression(daily.where(F.col("ds") < F.lit(f.test_from)), lags)
        assert feats.count() > 0
        assert params[f.fold_id].intercept == pytest.approx(direct.intercept, rel=1e-7, abs=1e-7)
        assert params[f.fold_id].coef_lag_1 == pytest.approx(direct.coefs[0], rel=1e-7, abs=1e-7)


def test_rolling_origin_brute_force(spark):
    df, rows = _series(spark, 70, ids=("A", "B", "C"))
    lags = [1, 7]
    h = 3
    folds = BT.time_folds(df, "2023-02-01", "1mo")
    tagged = BT.assign_test_fold(df, folds)
    cutoffs = BT.rolling_cutoffs(tagged, max(lags), h)
    got = {
        (r.fold_id, r.unique_id, r.cutoff, r.ds): r.y_pred
        for r in BT.rolling_origin_forecast(tagged, cutoffs, h, lags).collect()
    }
    got_grid = {
        (r.fold_id, r.unique_id, r.cutoff, r.ds): r.y_pred
        for r in BT.rolling_origin_forecast(tagged, cutoffs, h, lags, grid=True).collect()
    }
    assert got_grid == got
    # brute force
    fl = folds.collect()
    exp = {}
    series = _by_series(rows)
    for f in fl:
        test = {uid: [(d, y) for d, y in s if f.test_from <= d < f.test_to] for uid, s in series.items()}
        all_ds = sorted(d for s in test.values() for d, _ in s)
        first, last = all_ds[0] + timedelta(days=max(lags)), all_ds[-1]
        c = first
        while c < last:
            for uid, s in test.items():
                hist = [y for d, y in s if d <= c]
                if len(hist) < max(lags):
                    continue
                last_d = max(d for d, _ in s if d <= c)
                fc = _recursive_python(hist[-max(lags):], h, lambda a: float(np.mean([a[-lag] for lag in lags])))
                for k in range(h):
                    d = last_d + timedelta(days=k + 1)
                    if any(dd == d for dd, _ in s):
                        exp[(f.fold_id, uid, c, d)] = fc[k]
            c += timedelta(days=h)
    assert got.keys() == exp.keys()
    for k in exp:
        assert got[k] == pytest.approx(exp[k])


def test_backtest_linear_runs(spark):
    daily = I.daily_series(spark, SF)
    m = BT.backtest(daily, "2000-01-01", "3mo", 7, [1, 7, 14, 28], model="linear")
    rows = m.collect()
    assert {r.horizon for r in rows} <= set(range(1, 8))
    assert all(r.mae >= 0 and r.score >= r.mae for r in rows)


def test_model_save_load_round_trip(spark, tmp_dir):
    from hourglass.operators.forecast import load_model, save_model

    df, _ = _series(spark, 50)
    fitted = fit_lag_regression(df, [1, 7])
    for m in (fitted, LagModel((1, 7, 14))):
        save_model(spark, m, f"{tmp_dir}/model")
        back = load_model(spark, f"{tmp_dir}/model")
        assert back == m
        a = sorted(tuple(r) for r in forecast_series(df, back, 3).collect())
        b = sorted(tuple(r) for r in forecast_series(df, m, 3).collect())
        assert a == b


def test_hourly_backtest_horizons_in_steps(spark):
    from hourglass.operators.select import rename_to_series
    from hourglass.plans.q_etl import hourly_demand_df

    s = rename_to_series(hourly_demand_df(spark, SF)).select("unique_id", "ds", "y")
    for grid in (True, False):
        m = BT.backtest(s, "2024-01-15", "7d", h=24, lags=[1, 24], model="mean", freq="1h", grid=grid)
        rows = m.collect()
        assert {r.horizon for r in rows} == set(range(1, 25))
        assert {r.fold_id for r in rows} == {0, 1, 2}


def test_direct_weights_against_recursion():
    """Every horizon's dot product equals the recursion, also where a lag repeats."""
    rng = np.random.default_rng(3)
    for lags in ([1], [3], [1, 2], [1, 7, 14, 28], [2, 2, 5]):
        coefs, intercept, hist = rng.normal(size=len(lags)) / len(lags), rng.normal(), rng.normal(size=max(lags)).tolist()
        want = _recursive_python(hist, 12, lambda a: intercept + sum(c * a[-lag] for lag, c in zip(lags, coefs)))
        got = [float(np.dot(w, [*hist, 1.0])) for w in direct_weights(lags, 12, intercept, coefs)]
        assert got == pytest.approx(want)


@pytest.mark.parametrize("coefs", [None, (0.5, 0.25, -0.125)])
def test_direct_forecast_equals_recursive(spark, coefs):
    """Per series, with gaps and missing values: equal numbers and equal nulls."""
    df, _ = _series(spark, 45, ids=("A", "B", "C"))
    holes = F.when((F.col("unique_id") == "B") & (F.dayofmonth("ds") % 9 == 4), F.lit(None)).otherwise(F.col("y"))
    df = df.withColumn("y", holes)
    model = LagModel((1, 3, 7), intercept=2.0 if coefs else 0.0, coefs=coefs)
    for grid in (False, True):
        rows = [
            {(r.unique_id, r.ds): r.y_pred for r in forecast_series(df, model, 10, grid=grid, strategy=s).collect()}
            for s in ("recursive", "direct")
        ]
        assert rows[0].keys() == rows[1].keys() and len(rows[0]) == 30
        assert all(rows[1][k] is None if v is None else rows[1][k] == pytest.approx(v) for k, v in rows[0].items())
    with pytest.raises(ValueError):
        forecast_series(df, model, 3, strategy="other")


def test_direct_rolling_origins_equal_recursion(spark):
    df, _ = _series(spark, 150, ids=("A", "B"))
    folds = BT.time_folds(df, "2023-03-01", "1mo")
    tagged = BT.assign_test_fold(df, folds)
    cutoffs = BT.rolling_cutoffs(tagged, 7, 3)
    for params in (None, BT.fit_per_fold(df, folds, [1, 7])):
        for grid in (False, True):
            rows = [
                {(r.fold_id, r.unique_id, r.cutoff, r.ds): r.y_pred for r in
                 BT.rolling_origin_forecast(tagged, cutoffs, 3, [1, 7], params, grid=grid, strategy=s).collect()}
                for s in ("recursive", "direct")
            ]
            assert rows[0] and rows[0].keys() == rows[1].keys()
            assert all(rows[1][k] == pytest.approx(v) for k, v in rows[0].items())
