"""Boundary exchange: equal to windows per series, whatever the cuts; as-of
joins and fold lookup against plain loops."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from hourglass.functions.carry import asof_join, last_of_series, range_cuts, search_sorted, with_carry
from hourglass.functions.grid import BUCKET_COL, HALO_COL, bucket_window
from hourglass.operators import backtest as BT
from hourglass.operators.forecast import lag_features, mean_lag_predict
from hourglass.operators.series import time_lags

LAGS = [1, 3, 7]


@pytest.fixture(scope="module")
def gappy(spark):
    """Series with gaps: a hot one, short ones, a null name, null values."""
    rng = random.Random(4)
    rows = []
    for uid, n in (("hot", 300), ("a", 1), ("b", 5), (None, 40), ("z", 17), ("hotter", 60)):
        days = rng.sample(range(1000), n)
        rows += [(uid, datetime(2023, 1, 1) + timedelta(days=d), rng.choice([None, d, d % 7])) for d in days]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "unique_id string, ds timestamp_ntz, y long").repartition(4)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("ranges", [1, 2, 9, 64])
def test_lags_equal_a_window_per_series(gappy, ranges):
    w = Window.partitionBy("unique_id").orderBy("ds")
    want = gappy.select("*", *[F.lag("y", k).over(w).alias(f"l{k}") for k in LAGS])
    parts = with_carry(gappy, "unique_id", "ds", max(LAGS), ranges=ranges)
    own = bucket_window("unique_id", "ds")
    got = parts.select(*gappy.columns, HALO_COL, *[F.lag("y", k).over(own).alias(f"l{k}") for k in LAGS]).where(~F.col(HALO_COL)).drop(HALO_COL)
    assert rows_of(got) == rows_of(want)
    if ranges == 9:
        sizes = [r["count"] for r in parts.groupBy(BUCKET_COL).count().collect()]
        assert len(sizes) > 5 and max(sizes) < 200


def test_defaults_use_no_window_of_a_whole_series(gappy):
    for df in (time_lags(gappy, LAGS), lag_features(gappy, LAGS), mean_lag_predict(gappy, LAGS)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        windows = [x for x in plan.splitlines() if x.strip(" :+-").startswith("Window ") and "lag(" in x]
        assert windows and all(BUCKET_COL in x for x in windows)


def test_ends_of_series(gappy):
    got = {r.unique_id: (r._last, r._n, r._hist) for r in last_of_series(gappy, "unique_id", "ds", 7, F.col("y"), ranges=9).collect()}
    for uid in ("hot", "a", "b", None, "z", "hotter"):
        own = sorted((r.ds, r.y) for r in gappy.collect() if r.unique_id == uid) if uid != "hot" else sorted(((r.ds, r.y) for r in gappy.collect() if r.unique_id == uid), key=lambda x: x[0])
        assert got[uid] == (own[-1][0], len(own), [y for _, y in own][-7:])


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_asof(spark, gappy, ranges):
    rng = random.Random(9)
    asked = [(k, rng.choice(["hot", "a", "z", None, "nobody"]), datetime(2022, 12, 1) + timedelta(hours=rng.randrange(26000))) for k in range(200)]
    asked += [(900, "hot", None), (901, "hot", max(r.ds for r in gappy.collect()))]
    left = spark.createDataFrame(asked, "k long, unique_id string, t timestamp_ntz")
    got = {r.k: r.found for r in asof_join(left, gappy.withColumn("found", F.col("ds")), "unique_id", "t", "ds", ["found"], ranges).collect()}
    rows = gappy.collect()
    for k, uid, t in asked:
        assert got[k] == max((r.ds for r in rows if r.unique_id == uid and t is not None and r.ds <= t), default=None)
    assert len(got) == len(asked)
    none = asof_join(left, gappy.limit(0).withColumn("found", F.col("ds")), "unique_id", "t", "ds", ["found"], ranges)
    assert {r.found for r in none.collect()} == {None}


def test_binary_search(spark):
    df = spark.range(0, 60).select("id", F.array(*[F.lit(v) for v in (3, 3, 10, 11, 50)]).alias("a"))
    got = {r.id: r.n for r in df.select("id", search_sorted(F.col("a"), F.col("id"), 5).alias("n")).collect()}
    assert all(got[k] == sum(v <= k for v in (3, 3, 10, 11, 50)) for k in range(60))
    assert spark.range(1).select(search_sorted(F.array().cast("array<int>"), F.lit(1)).alias("n")).first().n == 0


def test_cuts_are_bounded_and_empty_frames_have_none(gappy):
    assert range_cuts(gappy.limit(0), ["unique_id", "ds"], 8) == []
    assert len(range_cuts(gappy, ["unique_id", "ds"], 8)) <= 7
    assert time_lags(gappy.limit(0), LAGS).count() == 0


def test_fold_lookup_has_no_join(spark, gappy):
    df = gappy.where("unique_id = 'hot'")
    folds = BT.time_folds(df, "2024-01-01", "3mo")
    tagged = BT.assign_test_fold(df, folds)
    for out in (tagged, BT.assign_folds(df, folds), BT.fold_sizes(df, folds)):
        assert "NestedLoopJoin" not in out._jdf.queryExecution().executedPlan().toString()
    known = folds.collect()
    for r in tagged.collect():
        assert r.fold_id == next((f.fold_id for f in known if f.test_from <= r.ds < f.test_to), None)
    none = BT.time_folds(df, "2030-01-01", "3mo")
    assert {r.fold_id for r in BT.assign_test_fold(df, none).collect()} == {None} and BT.fold_sizes(df, none).count() == 0
