"""Snapshot commits: atomic writes, failing and concurrent writers, old snapshots."""

from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from hourglass.schema import PICKUP_HOURLY
from hourglass.sources.snapshots import ConcurrentWrite, SnapshotTable

JAN, FEB = datetime(2023, 1, 1, 10), datetime(2023, 2, 1, 10)
FIRST = [("A", JAN, 10, 1), ("B", JAN, 20, 2), ("C", FEB, 30, 3)]
SECOND = [("B", JAN, 25, 2), ("D", JAN, 40, 4)]
MERGED = {"A": 10, "B": 25, "C": 30, "D": 40}


def frame(spark, rows):
    return spark.createDataFrame(rows, PICKUP_HOURLY)


def counts(df):
    return {r.key: r.num_pickup for r in df.collect()}


@pytest.fixture()
def table(spark, tmp_dir):
    t = SnapshotTable(spark, f"{tmp_dir}/hourly").ensure()
    t.upsert(frame(spark, FIRST))
    return t


def test_upsert_and_fetch(spark, table):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    table.upsert(frame(spark, SECOND))
    assert counts(table.read()) == MERGED
    assert table.read().columns == [f.name for f in PICKUP_HOURLY]
    assert counts(table.fetch("2023-01-01", "2023-02-01", [2, 4])) == {"B": 25, "D": 40}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before
    assert table.versions() == [1, 2, 3] and counts(table.scan(2)) == {"A": 10, "B": 20, "C": 30}
    # February was not written again: both snapshots list the same batch.
    assert table._manifest(2)[1]["2023-02-01"] == table._manifest(3)[1]["2023-02-01"]
    with pytest.raises(ValueError):
        table.scan(9)


def test_months_outside_the_range_are_not_read(table):
    files = table.fetch("2023-02-01", "2023-03-01")
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pickup_month" in plan and "PushedFilters" in plan


def test_moved_key_leaves_its_old_month(spark, table):
    table.upsert(frame(spark, [("C", JAN, 31, 3)]), key_fixes_month=False)
    assert counts(table.read()) == {"A": 10, "B": 20, "C": 31}
    assert list(table._manifest()[1]) == ["2023-01-01"]


def test_failing_write_leaves_the_table(spark, table):
    boom = frame(spark, SECOND).withColumn("num_pickup", F.raise_error(F.lit("boom")).cast("int"))
    for write in (table.upsert, table.write):
        with pytest.raises(PySparkException):
            write(boom)
    with pytest.raises(PySparkException):
        table.upsert(frame(spark, [(None, JAN, 1, 1)]))
    assert counts(table.read()) == {"A": 10, "B": 20, "C": 30} and table.versions() == [1, 2]
    assert not [n for n in table._names(f"{table.path}/data") if n.startswith("_stage")]


def test_second_of_two_writers_is_refused(spark, table):
    base, months = table._manifest()
    table.upsert(frame(spark, SECOND))  # commits while the other one still works
    batch, written = table._write_batch(table._scan_of(months), "key")
    with pytest.raises(ConcurrentWrite):
        table._commit(base, dict.fromkeys(written, batch))
    assert counts(table.read()) == MERGED
    assert not [n for n in table._names(f"{table.path}/snapshots") if n.endswith(".tmp")]


def test_write_replaces_and_expire_removes(spark, table):
    reader = table.read()
    table.write(frame(spark, SECOND))
    assert counts(reader) == {"A": 10, "B": 20, "C": 30}  # a reader keeps the snapshot it began with
    assert counts(table.read()) == {"B": 25, "D": 40}
    table.expire()
    assert table.versions() == [3] and counts(table.read()) == {"B": 25, "D": 40}
    assert len([n for n in table._names(f"{table.path}/data") if n.startswith("batch=")]) == 1


def test_empty(spark, tmp_dir):
    t = SnapshotTable(spark, f"{tmp_dir}/none").ensure()
    t.upsert(frame(spark, []))
    assert t.read().count() == 0 and t.versions() == [1] and t.ensure().versions() == [1]
