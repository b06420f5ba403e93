"""Month-grouped scan of raw files."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourglass.sources.raw import MissingColumns, scan_months

SCHEMA = T.StructType([T.StructField("at", T.TimestampNTZType()), T.StructField("n", T.LongType())])


def put(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}")


@pytest.fixture()
def folder(spark, tmp_dir):
    put(spark, tmp_dir, "trips_a-2023-01.parquet", [(datetime(2023, 1, 5), 1, "x")], "at timestamp_ntz, n int, extra string")
    put(spark, tmp_dir, "trips_b-2023-01.parquet", [(datetime(2023, 1, 6), 2)], "at timestamp_ntz, n int")
    put(spark, tmp_dir, "trips-2023-02.parquet", [(3.0, datetime(2023, 2, 7))], "n double, at timestamp_ntz")
    put(spark, tmp_dir, "notes.parquet", [("no month in the name",)], "text string")
    return tmp_dir


def test_types_drift_and_files_of_a_month(spark, folder):
    df = scan_months(spark, folder, SCHEMA)
    got = sorted((r.at, r.n, r.file_month) for r in df.collect())
    jan, feb = date(2023, 1, 1), date(2023, 2, 1)
    assert got == [(datetime(2023, 1, 5), 1, jan), (datetime(2023, 1, 6), 2, jan), (datetime(2023, 2, 7), 3, feb)]
    assert [f.dataType for f in df.schema.fields[:2]] == [f.dataType for f in SCHEMA.fields]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2 and "extra" not in plan  # a scan per month, not per file


def test_a_month_filter_leaves_one_scan(spark, folder):
    df = scan_months(spark, folder, SCHEMA).where(F.col("file_month") == F.lit(date(2023, 2, 1)))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1
    assert [r.n for r in df.collect()] == [3]


def test_missing_columns_are_named(spark, folder):
    put(spark, folder, "trips-2023-03.parquet", [(datetime(2023, 3, 1),)], "at timestamp_ntz")
    put(spark, folder, "trips-2023-04.parquet", [(4,)], "n int")
    with pytest.raises(MissingColumns, match=r"2023-03\.parquet: n; .*2023-04\.parquet: at"):
        scan_months(spark, folder, SCHEMA)


def test_nothing_there(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        scan_months(spark, tmp_dir, SCHEMA)
