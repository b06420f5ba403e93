"""Hourly table: keyed upsert (U2), ensure/scan/write (S2-S4), range fetch."""

from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from hourglass.operators.select import fetch_range
from hourglass.operators.upsert import dedupe_by_key, upsert_by_key
from hourglass.schema import PICKUP_HOURLY
from hourglass.sources.table import HourlyTable

H = datetime(2023, 1, 1, 10)


def frame(spark, rows):
    return spark.createDataFrame(rows, PICKUP_HOURLY)


def as_dict(df):
    return {r.key: (r.num_pickup, r.pickup_location_id, r.pickup_datetime_hour) for r in df.collect()}


CURRENT = [("A_2023_01", H, 10, 1), ("B_2023_01", H, 20, 2), ("C_2023_01", H, 30, 3)]
NEW = [("B_2023_01", H, 25, 2), ("C_2023_01", H, 35, 3), ("D_2023_01", H, 40, 4)]
EXPECTED = {"A_2023_01": (10, 1, H), "B_2023_01": (25, 2, H), "C_2023_01": (35, 3, H), "D_2023_01": (40, 4, H)}


def test_upsert_frames(spark):
    out = upsert_by_key(frame(spark, CURRENT), frame(spark, NEW))
    assert as_dict(out) == EXPECTED
    assert out.columns == [f.name for f in PICKUP_HOURLY]


def test_upsert_is_idempotent(spark):
    once = upsert_by_key(frame(spark, CURRENT), frame(spark, NEW))
    twice = upsert_by_key(once, frame(spark, NEW))
    assert as_dict(once) == as_dict(twice)


def test_upsert_update_cols_keeps_other_columns(spark):
    new = [("B_2023_01", datetime(2023, 1, 1, 11), 25, 9)]
    out = upsert_by_key(frame(spark, CURRENT), frame(spark, new), update_cols=["num_pickup"])
    assert as_dict(out)["B_2023_01"] == (25, 2, H)


def test_duplicate_keys_in_batch_are_deterministic(spark):
    new = [("B_2023_01", H, 99, 2), ("B_2023_01", H, 25, 2), ("B_2023_01", H, 50, 2)]
    out = upsert_by_key(frame(spark, CURRENT), frame(spark, new), order_cols=["num_pickup"])
    assert as_dict(out)["B_2023_01"][0] == 25
    # without an order the smallest full row wins -- same on every run
    a = as_dict(dedupe_by_key(frame(spark, new)))
    b = as_dict(dedupe_by_key(frame(spark, list(reversed(new)))))
    assert a == b


def test_repeated_current_keys_and_nulls_stay_unless_replaced(spark):
    old = [("A", H, 1, 1), ("A", H, 2, 1), ("B", H, 3, 2), ("B", H, 4, 2), (None, H, 5, 3), (None, H, 6, 3)]
    new = [("B", H, 9, 2), ("B", H, 8, 2), ("C", H, 7, 4)]
    for by_range in (False, True):
        out = upsert_by_key(frame(spark, old), frame(spark, new), by_range=by_range)
        assert sorted(r.num_pickup for r in out.collect()) == [1, 2, 5, 6, 7, 8]
        out = upsert_by_key(frame(spark, old), frame(spark, new), update_cols=["num_pickup"], by_range=by_range)
        assert sorted(r.num_pickup for r in out.collect()) == [1, 2, 5, 6, 7, 8, 8]
        none = upsert_by_key(frame(spark, old), frame(spark, [(None, H, 9, 9)]), null_keys="keep_one", by_range=by_range)
        assert sorted(r.num_pickup for r in none.collect()) == [1, 2, 3, 4, 9]


@pytest.mark.parametrize("update_cols", [None, ["num_pickup"]])
def test_merge_takes_one_shuffle_and_no_join(spark, update_cols):
    out = upsert_by_key(frame(spark, CURRENT), frame(spark, NEW), update_cols=update_cols)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_table_and_snapshots_merge_in_one_shuffle(spark, tmp_dir):
    """The range shuffle of the layout is the shuffle of the merge: no other
    exchange is in the merged plan."""
    for in_order in (False, True):
        out = upsert_by_key(frame(spark, CURRENT), frame(spark, NEW), by_range=True, in_order=in_order)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "rangepartitioning" in plan
        assert as_dict(out) == EXPECTED


def test_null_key_rejected(spark):
    new = [(None, H, 1, 1)]
    with pytest.raises(PySparkException):
        upsert_by_key(frame(spark, CURRENT), frame(spark, new)).collect()
    kept = upsert_by_key(frame(spark, CURRENT), frame(spark, new), null_keys="drop")
    assert kept.count() == 3


def test_table_upsert_and_read(spark, tmp_dir):
    t = HourlyTable(spark, f"{tmp_dir}/pickup_hourly").ensure()
    assert t.read().count() == 0
    t.upsert(frame(spark, CURRENT), key_fixes_month=False)
    t.upsert(frame(spark, NEW), key_fixes_month=False)
    assert as_dict(t.read()) == EXPECTED


def test_table_upsert_into_empty(spark, tmp_dir):
    t = HourlyTable(spark, f"{tmp_dir}/pickup_hourly")
    t.upsert(frame(spark, [("A_2023_01", H, 10, 1)]))
    assert as_dict(t.read()) == {"A_2023_01": (10, 1, H)}
    t.ensure()  # never drops data
    assert t.read().count() == 1


def test_table_touched_months_only(spark, tmp_dir):
    t = HourlyTable(spark, f"{tmp_dir}/pickup_hourly")
    jan = [("k1", datetime(2023, 1, 5), 1, 1)]
    feb = [("k2", datetime(2023, 2, 5), 2, 1)]
    t.upsert(frame(spark, jan + feb))
    t.upsert(frame(spark, [("k2", datetime(2023, 2, 5), 7, 1)]))
    assert as_dict(t.read()) == {"k1": (1, 1, datetime(2023, 1, 5)), "k2": (7, 1, datetime(2023, 2, 5))}


FETCH_ROWS = [
    ("A_2023_01", datetime(2023, 1, 1, 10), 10, 1),
    ("B_2023_01", datetime(2023, 1, 1, 11), 20, 2),
    ("C_2023_01", datetime(2023, 1, 2, 10), 30, 1),
    ("D_2023_01", datetime(2023, 1, 2, 11), 40, 2),
]


@pytest.fixture()
def table(spark, tmp_dir):
    t = HourlyTable(spark, f"{tmp_dir}/pickup_hourly")
    t.upsert(frame(spark, FETCH_ROWS), key_fixes_month=False)
    return t


@pytest.mark.parametrize(
    "a, b, locs, expected",
    [
        (datetime(2000, 1, 1), datetime(2099, 1, 1), [1], {"A_2023_01", "C_2023_01"}),
        (datetime(2023, 1, 1), datetime(2023, 1, 1, 23, 59, 59), None, {"A_2023_01", "B_2023_01"}),
        (datetime(2023, 1, 1), datetime(2023, 1, 1, 23, 59, 59), [2], {"B_2023_01"}),
        (datetime(2023, 1, 1), datetime(2023, 1, 1, 23, 59, 59), [], {"A_2023_01", "B_2023_01"}),
        (datetime(2000, 1, 1), datetime(2099, 1, 1), 2, {"B_2023_01", "D_2023_01"}),
        # a row exactly at `to` is outside the default half-open range
        (datetime(2023, 1, 1, 10), datetime(2023, 1, 2, 10), None, {"A_2023_01", "B_2023_01"}),
    ],
)
def test_fetch(table, a, b, locs, expected):
    assert set(as_dict(table.fetch(a, b, locs))) == expected


def test_fetch_closed_both(table):
    got = table.fetch(datetime(2023, 1, 1, 10), datetime(2023, 1, 2, 10), closed="both")
    assert set(as_dict(got)) == {"A_2023_01", "B_2023_01", "C_2023_01"}


def test_fetch_bad_range(table, spark):
    with pytest.raises(ValueError):
        table.fetch(datetime(2023, 1, 2), datetime(2023, 1, 1))
    with pytest.raises(ValueError):
        fetch_range(frame(spark, FETCH_ROWS), datetime(2023, 1, 2), datetime(2023, 1, 1))


def test_fetch_prunes_and_pushes(table, spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = table.fetch(datetime(2023, 1, 1), datetime(2023, 1, 2), [1])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pickup_month" in plan
    assert "GreaterThanOrEqual(pickup_datetime_hour" in plan
    assert "In(pickup_location_id" in plan or "EqualTo(pickup_location_id" in plan


def test_null_location_never_matches(spark):
    rows = FETCH_ROWS + [("E", datetime(2023, 1, 1, 12), 5, None)]
    got = fetch_range(frame(spark, rows), datetime(2000, 1, 1), datetime(2099, 1, 1), [1, 2])
    assert got.where(F.col("key") == "E").count() == 0


def test_table_key_moving_month_leaves_no_stale_row(spark, tmp_dir):
    t = HourlyTable(spark, f"{tmp_dir}/pickup_hourly")
    t.upsert(frame(spark, [("k1", datetime(2023, 1, 5), 1, 1)]), key_fixes_month=False)
    t.upsert(frame(spark, [("k1", datetime(2023, 2, 5), 9, 1)]), key_fixes_month=False)
    assert as_dict(t.read()) == {"k1": (9, 1, datetime(2023, 2, 5))}


def test_table_write_replaces_everything(spark, tmp_dir):
    t = HourlyTable(spark, f"{tmp_dir}/pickup_hourly")
    t.write(frame(spark, CURRENT))
    t.write(frame(spark, NEW))
    assert set(as_dict(t.read())) == {"B_2023_01", "C_2023_01", "D_2023_01"}


def test_predict_for_date_from_table(spark, tmp_dir):
    from hourglass.operators.forecast import LagModel
    from hourglass.operators.inference import predict_for_date
    from hourglass.operators.clean import transform_raw
    from hourglass.plans import inputs as I
    from tests.conftest import SF

    t = HourlyTable(spark, f"{tmp_dir}/pickup_hourly")
    t.upsert(transform_raw(I.raw_trips(spark, SF), 2024, 1))
    mean = predict_for_date(t.scan(), "2024-01-30", LagModel((1, 7, 14, 28)), [3, 7], grid=True).collect()
    assert {r.unique_id for r in mean} <= {3, 7} and all(r.ds == datetime(2024, 1, 31) for r in mean)
    lin = LagModel((1, 7), "1d", 0.5, (0.5, 0.25))
    got = predict_for_date(t.scan(), "2024-01-30", lin, [3]).collect()
    daily = {
        r.d: r.s
        for r in t.read().where("pickup_location_id = 3").groupBy(F.to_date("pickup_datetime_hour").alias("d"))
        .agg(F.sum("num_pickup").alias("s")).collect()
    }
    from datetime import date

    exp = 0.5 + 0.5 * daily[date(2024, 1, 30)] + 0.25 * daily[date(2024, 1, 24)]
    assert len(got) == 1 and got[0].y_pred == pytest.approx(exp)
