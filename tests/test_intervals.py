"""Bootstrap intervals (B1-B4), coverage (A16) and residual diagnostics
(A11-A15) against plain-Python brute force with the same hash draws."""

import hashlib
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourglass.functions.draws import KEY_SCALE, MOD, MUL_A, MUL_B, nearest_rank
from hourglass.operators import intervals as IV
from hourglass.operators import residuals as R


def py_text_key(v) -> int:
    return int(hashlib.md5(str(v).encode()).hexdigest()[:8], 16)


def py_combine(a: int, b: int) -> int:
    return (a * KEY_SCALE + b) % MOD


def py_draw(key: int, b: int, n: int, seed: int) -> int:
    x0 = key % MOD
    x1 = (x0 * MUL_A + (b + 1) * MUL_B + seed) % MOD
    x2 = (x1 * MUL_A) % MOD
    x3 = (x2 * MUL_A + x0) % MOD
    x4 = (x3 * MUL_A + x1) % MOD
    return (x3 * MOD + x4) % n


def py_row_key(uid: str, ds: datetime) -> int:
    return py_combine(py_text_key(uid), (ds - datetime(1970, 1, 1)) // timedelta(microseconds=1))


def _frames(spark):
    rng = np.random.default_rng(3)
    res_rows, pred_rows = [], []
    for uid in ("A", "B"):
        for i in range(30):
            ds = datetime(2023, 1, 1) + timedelta(days=i)
            res_rows.append((uid, ds, float(np.round(rng.normal(), 3))))
            pred_rows.append((uid, ds, int(rng.integers(0, 20)), float(np.round(rng.uniform(0, 20), 3))))
    res = spark.createDataFrame(res_rows, "unique_id string, ds timestamp_ntz, residual double")
    preds = spark.createDataFrame(pred_rows, "unique_id string, ds timestamp_ntz, y long, y_pred double")
    return res, preds, res_rows, pred_rows


def test_bootstrap_interval_brute_force(spark):
    res, preds, res_rows, pred_rows = _frames(spark)
    B, seed = 50, 25
    got = {(r.unique_id, r.ds): r for r in IV.bootstrap_interval(preds, res, B=B, seed=seed).collect()}
    pool = [r for _, _, r in sorted(res_rows)]
    n = len(pool)
    lo, hi = nearest_rank(B, 0.025), nearest_rank(B, 0.975)
    for uid, ds, y, p in pred_rows:
        key = py_row_key(uid, ds)
        vals = sorted(p + pool[py_draw(key, b, n, seed)] for b in range(B))
        r = got[(uid, ds)]
        assert r.lower_bound == pytest.approx(vals[lo])
        assert r.upper_bound == pytest.approx(vals[hi])
        assert r.width == pytest.approx(vals[hi] - vals[lo])


def test_bootstrap_hours_of_a_day_have_their_own_bounds(spark):
    res, _, res_rows, _ = _frames(spark)
    rows = [("A", datetime(2023, 3, 1) + timedelta(hours=i), 100.0 * i) for i in range(48)] + [("A", None, 1.0)]
    preds = spark.createDataFrame(rows, "unique_id string, ds timestamp_ntz, y_pred double")
    got = {r.ds: r for r in IV.bootstrap_interval(preds, res, B=30).collect()}
    pool = [r for _, _, r in sorted(res_rows)]
    lo = nearest_rank(30, 0.025)
    assert len(got) == 49 and got[None].lower_bound is None
    for uid, ds, p in rows[:48]:
        vals = sorted(p + pool[py_draw(py_row_key(uid, ds), b, len(pool), 25)] for b in range(30))
        assert got[ds].lower_bound == pytest.approx(vals[lo])


@pytest.mark.parametrize("chunk", [1, 7, 4096])
def test_gather_from_a_distributed_pool_equals_the_broadcast_one(spark, chunk):
    res, preds, _, _ = _frames(spark)
    keys = preds.select("unique_id", "ds").withColumn("_key", IV.row_key())
    pool = IV.index_pool(res)
    whole = IV.gather_draws(keys, pool, 40, 25)
    parts = IV.gather_draws(keys, pool, 40, 25, chunk=chunk, block_keys=3, broadcast_pool=0)
    a, b = ({(r.unique_id, r.ds): r._draws for r in x.collect()} for x in (whole, parts))
    assert a == b and len(a) == 60 and all(len(d) == 40 for d in a.values())
    plan = parts._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [_chunk" in plan and "BroadcastHashJoin [_chunk" not in plan
    # No exchange carries a row per draw: the draws travel as arrays only.
    assert not [x for x in plan.splitlines() if "Exchange" in x and "_idx" in x and "_b#" in x]


def test_gather_with_an_empty_pool_and_no_keys(spark):
    res, preds, _, _ = _frames(spark)
    none = IV.bootstrap_interval(preds, res.where("residual is null"), B=5)
    assert {r.lower_bound for r in none.collect()} == {None} and none.count() == 60
    assert IV.bootstrap_interval(preds.limit(0), res, B=5).count() == 0


@pytest.mark.parametrize("kind", ["few values", "all distinct", "mostly zero"])
def test_bounds_from_codes_equal_brute_force(spark, monkeypatch, kind):
    """Pieces, slices and blocks of a few rows; pools with more values than there are edges."""
    from hourglass.operators import extremes as X

    for name, size in (("PIECE", 37), ("EDGES", 9), ("SLICE", 90), ("BLOCK", 20), ("STEP", 7)):
        monkeypatch.setattr(X, name, size)
    rng = np.random.default_rng(8)
    values = {
        "few values": rng.integers(-3, 4, 400) / 3,
        "all distinct": rng.normal(size=400),
        "mostly zero": np.where(rng.random(400) < 0.8, 0.0, rng.normal(size=400)),
    }[kind].tolist()
    t0 = datetime(2023, 1, 1)
    res_rows = [("A" if i < 150 else "B", t0 + timedelta(hours=i), v) for i, v in enumerate(values)]
    res_rows[7] = (*res_rows[7][:2], float("nan"))
    rows = [("C", t0 + timedelta(hours=i), 10.0 * i) for i in range(60)] + [("C", t0, 3.0), (None, t0, 1.0)]
    res = spark.createDataFrame(res_rows, "unique_id string, ds timestamp_ntz, residual double").repartition(3)
    preds = spark.createDataFrame(rows, "unique_id string, ds timestamp_ntz, y_pred double")
    B = 40
    got = IV.bootstrap_interval(preds, res, B=B).collect()
    assert len(got) == len(rows)
    pool, lo, hi = [r for *_, r in sorted(res_rows, key=lambda r: r[:2])], nearest_rank(B, 0.025), nearest_rank(B, 0.975)
    for r in got:
        if r.unique_id is None:
            assert r.lower_bound is None and r.upper_bound is None
            continue
        key = py_row_key(r.unique_id, r.ds)
        drawn = np.sort([pool[py_draw(key, b, len(pool), 25)] for b in range(B)])
        np.testing.assert_allclose([r.lower_bound, r.upper_bound], [r.y_pred + drawn[lo], r.y_pred + drawn[hi]])


def test_bounds_move_no_array_of_draws(spark):
    res, preds, _, _ = _frames(spark)
    plan = IV.bootstrap_interval(preds, res, B=40)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "_draws" not in plan and "_want" not in plan


def test_interval_coverage_adds_up(spark):
    res, preds, _, _ = _frames(spark)
    iv = IV.bootstrap_interval(preds, res, B=40)
    cov = {r.in_ci: r.n for r in IV.interval_coverage(iv).collect()}
    assert sum(cov.values()) == preds.count()
    inside = iv.where(F.col("y").between(F.col("lower_bound"), F.col("upper_bound"))).count()
    assert cov.get(True, 0) == inside


def test_multi_step_bootstrap_brute_force(spark):
    res, _, res_rows, _ = _frames(spark)
    fc_rows = [
        (uid, datetime(2023, 2, 1) + timedelta(days=k), float(10 + k + (uid == "B")), k + 1)
        for uid in ("A", "B")
        for k in range(4)
    ]
    fc = spark.createDataFrame(fc_rows, "unique_id string, ds timestamp_ntz, y_pred double, step int")
    B, seed = 60, 25
    got = {(r.unique_id, r.step): r for r in IV.multi_step_bootstrap(fc, res, B=B, seed=seed).collect()}
    pool = [r for _, _, r in sorted(res_rows)]
    n = len(pool)
    lo, hi = nearest_rank(B, 0.025), nearest_rank(B, 0.975)
    for uid in ("A", "B"):
        steps = sorted((s, p) for u, _, p, s in fc_rows if u == uid)
        paths = []
        for b in range(B):
            acc, path = 0.0, []
            for s, p in steps:
                x = p + pool[py_draw(py_combine(py_text_key(uid), s), b, n, seed)]
                acc = acc * 0.25 + x
                path.append(acc)
            paths.append(path)
        arr = np.array(paths)
        for j, (s, _) in enumerate(steps):
            col = sorted(arr[:, j])
            r = got[(uid, s)]
            assert r.prediction == pytest.approx(float(np.mean(col)))
            assert r.lower_bound == pytest.approx(col[lo])
            assert r.upper_bound == pytest.approx(col[hi])


def test_residual_quantiles_nearest(spark):
    res, _, res_rows, _ = _frames(spark)
    probs = [0.0, 0.1, 0.5, 0.9, 1.0]
    got = {(r.unique_id, r.q): r.value for r in R.residual_quantiles(res, probs).collect()}
    for uid in ("A", "B"):
        vals = sorted(r for u, _, r in res_rows if u == uid)
        for q in probs:
            assert got[(uid, q)] == vals[int(np.floor((len(vals) - 1) * q + 0.5))]


def test_residual_acf_numpy(spark):
    res, _, res_rows, _ = _frames(spark)
    got = {(r.unique_id, r.lag): r.acf for r in R.residual_acf(res, max_lag=5).collect()}
    for uid in ("A", "B"):
        x = np.array([r for u, _, r in sorted(res_rows) if u == uid])
        c = x - x.mean()
        den = (c * c).sum()
        for k in range(1, 6):
            assert got[(uid, k)] == pytest.approx((c[k:] * c[:-k]).sum() / den)


def test_histogram_and_moments(spark):
    res, preds, res_rows, pred_rows = _frames(spark)
    h = R.residual_histogram(res, bins=7).collect()
    assert sum(r.n for r in h) == len(res_rows)
    assert all(0 <= r.bucket < 7 for r in h)
    m = {r.unique_id: r for r in R.residual_moments(res).collect()}
    a = np.array([r for u, _, r in res_rows if u == "A"])
    assert m["A"].mean == pytest.approx(a.mean())
    assert m["A"].std == pytest.approx(a.std(ddof=1))
    e = {r.unique_id: r.mae for r in R.mae(preds, pred="y_pred").collect()}
    assert e["B"] == pytest.approx(np.mean([abs(y - p) for u, _, y, p in pred_rows if u == "B"]))
