"""Streaming query: events as a file stream -> watermarked hourly counts ->
keyed upserts into a table; the table is read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from hourglass.plans.catalog import query
from hourglass.session import ensure_checkpoint_dir
from hourglass.sources.table import HourlyTable
from hourglass.streaming.hourly import events_trip_stream, start_hourly_stream


@query("stream_hourly_counts")
def q_stream_hourly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/hourglass-stream-run-{uuid.uuid4().hex}"
    table = HourlyTable(spark, f"{root}/pickup_hourly")
    q = start_hourly_stream(spark, events_trip_stream(spark, sf_dir), table, checkpoint=f"{root}/_ckpt")
    q.awaitTermination()
    return table.read()


@query("stream_then_close_month")
def q_stream_then_close_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streaming counts into a table, then the month is closed (zero fill):
    the table equals the batch hourly demand table."""
    from hourglass.plans import inputs as I
    from hourglass.streaming.hourly import close_month

    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/hourglass-stream-run-{uuid.uuid4().hex}"
    table = HourlyTable(spark, f"{root}/pickup_hourly")
    q = start_hourly_stream(spark, events_trip_stream(spark, sf_dir), table, checkpoint=f"{root}/_ckpt")
    q.awaitTermination()
    close_month(table, I.TRIP_YEAR, I.TRIP_MONTH)
    return table.read()
