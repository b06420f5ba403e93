"""Incremental hourly counts with Structured Streaming.

The batch transform needs a whole month to zero-fill it, so the stream keeps
the part that can be incremental: trips are counted per (hour, location)
with a watermark on the pickup time, and every micro-batch upserts the
changed counts into the hourly table by key (``foreachBatch`` + U2).  The
zero fill of a finished month stays a batch step (``transform_raw``).

Late data: a trip older than the watermark is dropped by the stateful
aggregate; within the watermark its hour's count is re-emitted and the
upsert overwrites the row -- the same rule as a late file overwriting by key.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from hourglass.functions.time import trunc_hour
from hourglass.operators.spine import HOUR, LOC, N, surrogate_key
from hourglass.session import ensure_checkpoint_dir
from hourglass.sources.table import HourlyTable

TS = "pickup_datetime"
#: Files of a month can come in any order, so counts stay open for the longest
#: month; the state is one row per hour and location of that time.
WATERMARK = "31 days"


def hourly_count_stream(clean: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Streaming (hour, location) counts of standardized trips.

    ``clean`` has ``pickup_datetime`` (``timestamp_ntz``) and
    ``pickup_location_id``.  A watermark needs a zoned timestamp, so the
    event time is the hour start read as a UTC instant (built from the NTZ
    fields, independent of the session time zone); the group key holds it
    next to the NTZ hour, so state older than the watermark is dropped.
    """
    hour = trunc_hour(TS)
    event = F.make_timestamp(
        F.year(TS), F.month(TS), F.dayofmonth(TS), F.hour(TS), F.lit(0), F.lit(0), F.lit("UTC")
    )
    return (
        clean.where(F.col(TS).isNotNull() & F.col(LOC).isNotNull())
        .select(event.alias("_event"), hour.alias(HOUR), LOC)
        .withWatermark("_event", watermark)
        .groupBy("_event", HOUR, LOC)
        .agg(F.count(F.col(LOC)).alias(N))
        .select(HOUR, LOC, N)
    )


def upsert_batches(table: HourlyTable):
    """``foreachBatch`` sink: upsert each micro-batch by key into ``table``."""

    def write(batch: DataFrame, _epoch: int) -> None:
        rows = batch.select(
            surrogate_key(HOUR, LOC).alias("key"),
            HOUR,
            F.col(N).cast("int").alias(N),
            F.col(LOC).cast("int").alias(LOC),
        )
        table.upsert(rows, key_fixes_month=True)

    return write


def start_hourly_stream(
    spark: SparkSession,
    source: DataFrame,
    table: HourlyTable,
    checkpoint: str | None = None,
    watermark: str = WATERMARK,
) -> StreamingQuery:
    """Run the count stream into the table; ``availableNow`` processes what is
    there and stops (a scheduled run), the checkpoint makes re-runs resume.
    What came later than the watermark is counted by :func:`late_groups`."""
    ckpt = checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/hourglass-stream/{uuid.uuid4().hex}"
    counts = hourly_count_stream(source, watermark)
    return (
        counts.writeStream.outputMode("update")
        .option("checkpointLocation", ckpt)
        .foreachBatch(upsert_batches(table))
        .trigger(availableNow=True)
        .start()
    )


def late_groups(query: StreamingQuery) -> int:
    """(hour, location) groups of micro-batches that came behind the watermark
    and are missing from the table, over the progress that the query keeps.
    Above 0, the months concerned should be loaded again from their files."""
    return sum(int(op["numRowsDroppedByWatermark"]) for p in query.recentProgress for op in p["stateOperators"])


def events_trip_stream(spark: SparkSession, sf_dir: str, max_files: int = 1) -> DataFrame:
    """The driver's ``events`` table read as a file stream, as clean trips."""
    schema = T.StructType(
        [
            T.StructField("event_id", T.LongType()),
            T.StructField("ts", T.TimestampNTZType()),
            T.StructField("user_id", T.LongType()),
            T.StructField("event_type", T.StringType()),
            T.StructField("value", T.DoubleType()),
            T.StructField("props", T.StringType()),
        ]
    )
    raw = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", "events.parquet")
        .option("maxFilesPerTrigger", max_files)
        .parquet(sf_dir)
    )
    return raw.select(F.col("ts").alias(TS), F.col("user_id").cast("int").alias(LOC))


def close_month(table: HourlyTable, year: int, month: int) -> None:
    """Zero-fill a finished month of the table (the batch step after the
    stream): every location with trips that month gets every hour, missing
    hours as 0.  Reads only that month (partition pruning) and upserts only
    into it."""
    from datetime import date

    from hourglass.operators.spine import fill_missing_hours
    from hourglass.schema import enforce_schema

    start = date(year, month, 1)
    end = date(year + 1, 1, 1) if month == 12 else date(year, month + 1, 1)
    counts = table.fetch(start, end).select(
        F.lit(start).cast("date").alias("file_month"), HOUR, LOC, F.col(N).cast("bigint").alias(N)
    )
    filled = fill_missing_hours(counts).select(
        surrogate_key(HOUR, LOC).alias("key"), HOUR, F.col(N).cast("int").alias(N), LOC
    )
    table.upsert(enforce_schema(filled), key_fixes_month=True)
