"""Month filter (P2), validity report (P3) and the raw-to-hourly transform."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourglass.functions.time import ntz_lit, trunc_hour
from hourglass.schema import enforce_schema, standardize_raw_schema
from hourglass.sources.raw import with_file_month

TS = "pickup_datetime"
LOC = "pickup_location_id"


def _month_bounds(year: int, month: int) -> tuple[Column, Column]:
    start = date(year, month, 1)
    end = date(year + 1, 1, 1) if month == 12 else date(year, month + 1, 1)
    return ntz_lit(start), ntz_lit(end)


def in_month(ts: str = TS, year: int | None = None, month: int | None = None) -> Column:
    """Half-open month predicate ``m0 <= ts < m0 + 1 month``.

    With a literal month the bounds are constants, so the predicate reaches
    the parquet reader as ``PushedFilters``.  Without one, the month comes from
    each row's ``file_month`` column (several monthly files in one plan).
    Null timestamps never satisfy it.
    """
    if year is not None and month is not None:
        lo, hi = _month_bounds(year, month)
    else:
        lo = F.col("file_month").cast("timestamp_ntz")
        hi = F.add_months(F.col("file_month"), 1).cast("timestamp_ntz")
    return (F.col(ts) >= lo) & (F.col(ts) < hi)


def filter_in_month(df: DataFrame, year: int | None = None, month: int | None = None, ts: str = TS) -> DataFrame:
    """Keep rows whose timestamp lies in the file's month."""
    if year is not None and month is not None and "file_month" not in df.columns:
        df = with_file_month(df, year, month)
    return df.where(in_month(ts, year, month))


def validity_report(df: DataFrame, year: int | None = None, month: int | None = None, ts: str = TS, loc: str = LOC) -> DataFrame:
    """Per file month: records in range, total, deleted, in-range percent.

    Both counts count non-null timestamps.  An empty month gives a null
    percent instead of a division error.  ``null_locations`` counts in-range
    rows without a location; they are left out of the hourly counts.
    """
    if "file_month" not in df.columns:
        if year is None or month is None:
            raise ValueError("give year and month, or a frame with file_month")
        df = with_file_month(df, year, month)
    cond = in_month(ts, year, month)
    return (
        df.groupBy("file_month")
        .agg(
            F.count(F.when(cond, F.col(ts))).alias("records_in_range"),
            F.count(F.col(ts)).alias("total_records"),
            F.count(F.when(cond & F.col(loc).isNull(), F.lit(1))).alias("null_locations"),
        )
        .select(
            "file_month",
            "total_records",
            "records_in_range",
            (F.col("total_records") - F.col("records_in_range")).alias("records_deleted"),
            F.try_divide(F.col("records_in_range") * F.lit(100.0), F.col("total_records")).alias(
                "pct_in_range"
            ),
            "null_locations",
        )
    )


def transform_raw(df: DataFrame, year: int | None = None, month: int | None = None) -> DataFrame:
    """Raw trips -> complete hourly demand table rows.

    P1 standardize -> P2 month filter -> A1 hourly counts -> A3 zero fill ->
    P5 surrogate key -> P4 schema.  Works on one month (``year``/``month``
    given) or on many months at once (rows tagged by ``file_month``).
    """
    from hourglass.operators.spine import add_surrogate_key, fill_missing_hours, hourly_counts

    clean = standardize_raw_schema(df)
    clean = filter_in_month(clean, year, month)
    counts = hourly_counts(clean)
    filled = fill_missing_hours(counts)
    return enforce_schema(add_surrogate_key(filled))


def load_monthly(raw: DataFrame, table, year: int | None = None, month: int | None = None) -> DataFrame:
    """Load raw trip files into the hourly table and report their validity
    (the monthly load, all months at once) with ONE scan of the raw data.

    The raw rows are aggregated once by (file month, hour, location, in-month
    flag) -- a frame of hours x locations, tiny next to the raw data -- and
    that aggregate is checkpointed to ``spark.checkpoint.dir``.  The validity
    report (same columns as :func:`validity_report`) and the zero-filled,
    keyed rows upserted into ``table`` are both derived from it.  Returns the
    report.
    """
    from hourglass.operators.spine import HOUR, add_surrogate_key, fill_missing_hours
    from hourglass.session import ensure_checkpoint_dir

    clean = standardize_raw_schema(raw)
    if "file_month" not in clean.columns:
        if year is None or month is None:
            raise ValueError("give year and month, or raw rows with file_month")
        clean = with_file_month(clean, year, month)
    agg = (
        clean.groupBy("file_month", trunc_hour(TS).alias(HOUR), F.col(LOC), in_month(TS, year, month).alias("_in"))
        .agg(F.count(F.lit(1)).alias("_n"), F.count(TS).alias("_dated"))
    )
    ensure_checkpoint_dir(agg.sparkSession)
    agg = agg.checkpoint(eager=True)

    report = agg.groupBy("file_month").agg(
        F.sum(F.when(F.col("_in"), F.col("_n")).otherwise(F.lit(0))).cast("bigint").alias("records_in_range"),
        F.sum("_dated").cast("bigint").alias("total_records"),
        F.sum(F.when(F.col("_in") & F.col(LOC).isNull(), F.col("_n")).otherwise(F.lit(0))).cast("bigint").alias(
            "null_locations"
        ),
    ).select(
        "file_month",
        "total_records",
        "records_in_range",
        (F.col("total_records") - F.col("records_in_range")).alias("records_deleted"),
        F.try_divide(F.col("records_in_range") * F.lit(100.0), F.col("total_records")).alias("pct_in_range"),
        "null_locations",
    )
    counts = agg.where(F.col("_in") & F.col(LOC).isNotNull()).select(
        "file_month", HOUR, LOC, F.col("_n").alias("num_pickup")
    )
    table.upsert(enforce_schema(add_surrogate_key(fill_missing_hours(counts))))
    return report
