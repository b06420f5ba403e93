"""ETL: month spine, hour spine, month filter, validity report, zero fill,
surrogate key, multi-month scan and coverage."""

from datetime import date, datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourglass.operators.clean import filter_in_month, transform_raw, validity_report
from hourglass.operators.spine import hour_spine
from hourglass.schema import PICKUP_HOURLY, standardize_raw_schema
from hourglass.sources.raw import month_coverage, month_spine, months_of, raw_file_name, scan_monthly_files

RAW = T.StructType(
    [
        T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
        T.StructField("passenger_count", T.DoubleType()),
        T.StructField("PULocationID", T.LongType()),
        T.StructField("extra", T.StringType()),
    ]
)


def raw_df(spark, rows):
    return spark.createDataFrame(rows, RAW)


def test_month_spine_reference_case(spark):
    got = [r.month for r in month_spine(spark, date(2023, 9, 5), date(2024, 3, 28)).collect()]
    assert got == [
        date(2023, 9, 1),
        date(2023, 10, 1),
        date(2023, 11, 1),
        date(2023, 12, 1),
        date(2024, 1, 1),
        date(2024, 2, 1),
        date(2024, 3, 1),
    ]


def test_month_spine_single_month(spark):
    got = [r.month for r in month_spine(spark, date(2024, 2, 29), date(2024, 2, 1)).collect()]
    assert got == [date(2024, 2, 1)]  # both ends fall in the same month
    got = [r.month for r in month_spine(spark, date(2024, 3, 5), date(2024, 2, 1)).collect()]
    assert got == []  # from-month after to-month -> empty, as the original loop
    got = [r.month for r in month_spine(spark, date(2024, 2, 10), date(2024, 2, 20)).collect()]
    assert got == [date(2024, 2, 1)]


@pytest.mark.parametrize(
    "year, month, hours, last",
    [
        (2024, 1, 744, datetime(2024, 1, 31, 23)),
        (2024, 2, 696, datetime(2024, 2, 29, 23)),  # leap February
        (2023, 2, 672, datetime(2023, 2, 28, 23)),
        (2023, 12, 744, datetime(2023, 12, 31, 23)),  # December -> next year
    ],
)
def test_hour_spine(spark, year, month, hours, last):
    rows = hour_spine(spark, year, month).collect()
    assert len(rows) == hours
    assert rows[0][0] == datetime(year, month, 1)
    assert rows[-1][0] == last
    assert hour_spine(spark, year, month).schema[0].dataType == T.TimestampNTZType()


def _fixture_rows():
    return [
        (datetime(2023, 12, 1, 0, 5), 1.0, 10, "x"),
        (datetime(2023, 12, 1, 0, 55), 2.7, 10, "x"),
        (datetime(2023, 12, 1, 0, 30), 1.0, 11, "x"),
        (datetime(2023, 12, 31, 23, 59, 59, 999999), 1.0, 11, "x"),
        (datetime(2023, 11, 30, 23, 59), 1.0, 10, "x"),  # neighbour month
        (datetime(2024, 1, 1, 0, 0), 1.0, 12, "x"),  # neighbour month (next year)
        (None, 1.0, 10, "x"),  # null timestamp
        (datetime(2023, 12, 2, 3, 0), 1.0, None, "x"),  # null location
    ]


def test_standardize_raw_schema(spark):
    df = standardize_raw_schema(raw_df(spark, _fixture_rows()))
    assert df.columns == ["pickup_datetime", "passenger_count", "pickup_location_id"]
    assert [f.dataType for f in df.schema] == [T.TimestampNTZType(), T.IntegerType(), T.IntegerType()]
    assert df.where(F.col("passenger_count") == 2).count() == 1  # 2.7 -> 2 (truncation)


def test_filter_in_month_half_open(spark):
    clean = standardize_raw_schema(raw_df(spark, _fixture_rows()))
    kept = filter_in_month(clean, 2023, 12)
    assert kept.count() == 5  # 4 located + 1 null location, no neighbours, no null ts
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual" in plan or ">=" in plan


def test_validity_report(spark):
    clean = standardize_raw_schema(raw_df(spark, _fixture_rows()))
    r = validity_report(clean, 2023, 12).collect()[0]
    assert r.total_records == 7  # null timestamps are not counted
    assert r.records_in_range == 5
    assert r.records_deleted == 2
    assert r.pct_in_range == pytest.approx(500 / 7)
    assert r.null_locations == 1


def test_validity_report_empty(spark):
    clean = standardize_raw_schema(raw_df(spark, [(None, 1.0, 1, "x")]))
    r = validity_report(clean, 2023, 12).collect()[0]
    assert r.total_records == 0 and r.pct_in_range is None


def test_transform_raw_december(spark):
    out = transform_raw(raw_df(spark, _fixture_rows()), 2023, 12)
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in PICKUP_HOURLY]
    rows = out.collect()
    # two located ids seen in December, every hour of December for each
    assert len(rows) == 744 * 2
    assert sum(r.num_pickup for r in rows) == 4
    by_key = {r.key: r.num_pickup for r in rows}
    assert by_key["2023-12-01 00:00:00.000000-10"] == 2
    assert by_key["2023-12-01 00:00:00.000000-11"] == 1
    assert by_key["2023-12-31 23:00:00.000000-11"] == 1
    assert by_key["2023-12-01 01:00:00.000000-10"] == 0
    assert len(by_key) == len(rows)  # keys are unique


def test_transform_raw_empty(spark):
    out = transform_raw(raw_df(spark, []), 2024, 2)
    assert out.count() == 0
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in PICKUP_HOURLY]


def test_transform_raw_leap_february(spark):
    rows = [(datetime(2024, 2, 29, 13, 1), 1.0, 5, "x"), (datetime(2024, 3, 1, 0, 0), 1.0, 5, "x")]
    out = transform_raw(raw_df(spark, rows), 2024, 2).collect()
    assert len(out) == 696
    assert sum(r.num_pickup for r in out) == 1


def test_transform_invariants_on_events(spark):
    from hourglass.plans import inputs as I
    from tests.conftest import SF

    raw = I.raw_trips(spark, SF)
    out = transform_raw(raw, 2024, 1)
    n_locs = raw.select("PULocationID").distinct().count()
    assert out.count() == 744 * n_locs
    assert out.agg(F.sum("num_pickup")).first()[0] == raw.count()


def test_scan_monthly_files_and_coverage(spark, tmp_dir):
    for (y, m), ts in {(2024, 1): [datetime(2024, 1, 3, 4, 5), datetime(2024, 2, 1, 0, 0)], (2024, 3): [datetime(2024, 3, 9)]}.items():
        t = pa.table(
            {
                "tpep_pickup_datetime": pa.array(ts, pa.timestamp("us")),
                "passenger_count": pa.array([1.0] * len(ts)),
                "PULocationID": pa.array([7] * len(ts), pa.int64()),
            }
        )
        pq.write_table(t, f"{tmp_dir}/{raw_file_name(y, m)}")
    raw = scan_monthly_files(spark, tmp_dir)
    assert {r.file_month for r in raw.select("file_month").distinct().collect()} == {date(2024, 1, 1), date(2024, 3, 1)}
    out = transform_raw(raw)  # both months in one plan
    assert out.count() == 744 + 744
    assert out.agg(F.sum("num_pickup")).first()[0] == 2  # the Feb row claimed by January is dropped
    rep = {r.file_month: r for r in validity_report(standardize_raw_schema(raw)).collect()}
    assert rep[date(2024, 1, 1)].records_deleted == 1
    cov = month_coverage(
        month_spine(spark, date(2024, 1, 1), date(2024, 4, 1)),
        raw.groupBy(F.col("file_month").alias("month")).agg(F.count(F.lit(1)).alias("records")),
    )
    got = {r.month: r.is_present for r in cov.collect()}
    assert got == {date(2024, 1, 1): True, date(2024, 2, 1): False, date(2024, 3, 1): True, date(2024, 4, 1): False}


def test_months_of(spark):
    from hourglass.plans import inputs as I
    from tests.conftest import SF

    m = months_of(I.table(spark, SF, "orders"), "o_orderdate")
    assert m.agg(F.sum("records")).first()[0] == I.table(spark, SF, "orders").count()


def test_key_and_hours_independent_of_session_time_zone(spark):
    from hourglass.operators.spine import surrogate_key
    from hourglass.functions.time import trunc_hour

    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(datetime(2024, 3, 10, 2, 30, 5), 1)], "ts timestamp_ntz, loc int")
        r = df.select(trunc_hour("ts").alias("h"), "loc").select("h", surrogate_key("h", "loc").alias("k")).first()
        assert r.h == datetime(2024, 3, 10, 2, 0)  # an hour that does not exist in that zone
        assert r.k == "2024-03-10 02:00:00.000000-1"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_load_monthly_one_scan_equals_separate_steps(spark, tmp_dir):
    from hourglass.operators.clean import load_monthly
    from hourglass.sources.table import HourlyTable

    rows = {
        (2024, 1): [datetime(2024, 1, 3, 4, 5), datetime(2024, 1, 3, 4, 50), datetime(2024, 2, 1, 0, 0), None],
        (2024, 2): [datetime(2024, 2, 29, 23, 59)],
        (2024, 4): [None, None],
    }
    for (y, m), ts in rows.items():
        t = pa.table(
            {
                "tpep_pickup_datetime": pa.array(ts, pa.timestamp("us")),
                "passenger_count": pa.array([1.0] * len(ts)),
                "PULocationID": pa.array([7] * (len(ts) - 1) + [None], pa.int64()),
            }
        )
        pq.write_table(t, f"{tmp_dir}/{raw_file_name(y, m)}")
    raw = scan_monthly_files(spark, tmp_dir)
    table = HourlyTable(spark, f"{tmp_dir}/table")
    report = {r.file_month: tuple(r) for r in load_monthly(raw, table).collect()}
    direct = {r.file_month: tuple(r) for r in validity_report(standardize_raw_schema(raw)).collect()}
    assert report == direct
    got = sorted(tuple(r) for r in table.read().collect())
    exp = sorted(tuple(r) for r in transform_raw(raw).collect())
    assert got == exp


def test_scan_modes_agree(spark, tmp_dir):
    for (y, m), ts in {(2024, 1): [datetime(2024, 1, 3, 4, 5)], (2024, 2): [datetime(2024, 2, 9), datetime(2024, 3, 1)]}.items():
        t = pa.table(
            {
                "tpep_pickup_datetime": pa.array(ts, pa.timestamp("us")),
                "passenger_count": pa.array([1.0] * len(ts)),
                "PULocationID": pa.array([5] * len(ts), pa.int64()),
            }
        )
        pq.write_table(t, f"{tmp_dir}/{raw_file_name(y, m)}")
    a = sorted(tuple(r) for r in transform_raw(scan_monthly_files(spark, tmp_dir)).collect())
    b = sorted(tuple(r) for r in transform_raw(scan_monthly_files(spark, tmp_dir, per_file=False)).collect())
    assert a == b and len(a) == 744 + 696


def test_list_monthly_files_skips_names_without_month(spark, tmp_dir):
    from hourglass.sources.raw import list_monthly_files

    t = pa.table({"tpep_pickup_datetime": pa.array([datetime(2024, 1, 1)], pa.timestamp("us"))})
    pq.write_table(t, f"{tmp_dir}/{raw_file_name(2024, 3)}")
    pq.write_table(t, f"{tmp_dir}/{raw_file_name(2023, 12)}")
    pq.write_table(t, f"{tmp_dir}/lookup.parquet")
    got = [(p.rsplit("/", 1)[-1], m) for p, m in list_monthly_files(spark, tmp_dir)]
    assert got == [(raw_file_name(2023, 12), date(2023, 12, 1)), (raw_file_name(2024, 3), date(2024, 3, 1))]
