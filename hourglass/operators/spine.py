"""Hour spine (T1), hourly counts (A1), zero fill (A3), surrogate key (P5),
gap fill of long series, and horizon extension (T3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourglass.functions.time import add_duration, date_lit, interval_expr, trunc_hour

TS = "pickup_datetime"
HOUR = "pickup_datetime_hour"
LOC = "pickup_location_id"
N = "num_pickup"


def month_hours(file_month: Column) -> Column:
    """Array of every hour of a month, end excluded (closed='left')."""
    start = file_month.cast("timestamp_ntz")
    stop = F.add_months(file_month, 1).cast("timestamp_ntz") - F.expr("INTERVAL 1 HOUR")
    return F.sequence(start, stop, F.expr("INTERVAL 1 HOUR"))


def hour_spine(spark: SparkSession, year: int, month: int) -> DataFrame:
    """Every hour of one month as DataFrame(pickup_datetime_hour)."""
    from datetime import date

    m0 = date_lit(date(year, month, 1))
    return spark.range(1).select(F.explode(month_hours(m0)).alias(HOUR))


def hourly_counts(clean: DataFrame) -> DataFrame:
    """Trips per (file month, hour, location), counting non-null locations (A1).

    Rows without a location are dropped first (they cannot be keyed); the
    validity report counts them.  The aggregate is two-phase: a map-side
    partial count per task, then a shuffle of at most one row per
    (hour, location) per task.  The not-null predicates are stated here so
    that every later use of this frame has the same plan (its shuffle is
    then computed once and reused).
    """
    keys = ["file_month"] if "file_month" in clean.columns else []
    hour = trunc_hour(TS)
    return (
        clean.where(F.col(LOC).isNotNull() & hour.isNotNull())
        .groupBy(*keys, hour.alias(HOUR), F.col(LOC))
        .agg(F.count(F.col(LOC)).alias(N))
    )


def fill_missing_hours(counts: DataFrame) -> DataFrame:
    """Every hour of the month for every location seen that month; gaps -> 0 (A3).

    The sparse counts (one row per month, hour and location) are dealt by
    (month, location) into a fixed number of partitions; in each such group,
    of at most one row per hour of the month, every row is exploded into the
    hours from its own up to the next counted one (the first from the start of
    the month, the last to its end).  So the dense rows are made where they
    stay: no spine, no join and no shuffle of filled rows.  Locations appear
    only in months where they have trips.
    """
    if "file_month" not in counts.columns:
        counts = counts.withColumn("file_month", F.trunc(F.to_date(HOUR), "MM"))
    first = F.col("file_month").cast("timestamp_ntz")
    after = F.add_months("file_month", 1).cast("timestamp_ntz")
    hour = F.expr("INTERVAL 1 HOUR")
    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    w = Window.partitionBy("file_month", LOC).orderBy(HOUR)
    runs = (
        counts.where((F.col(HOUR) >= first) & (F.col(HOUR) < after) & F.col(LOC).isNotNull())
        .repartition(parts, "file_month", LOC)
        .select(
            "file_month", LOC, F.col(HOUR).alias("_seen"), N,
            F.when(F.lag(HOUR).over(w).isNull(), first).otherwise(F.col(HOUR)).alias("_from"),
            F.coalesce(F.lead(HOUR).over(w), after).alias("_to"),
        )
    )
    filled = runs.select("file_month", F.explode(F.sequence("_from", F.col("_to") - hour, hour)).alias(HOUR), LOC, "_seen", N)
    return filled.select(
        "file_month", HOUR, LOC, F.when(F.col(HOUR) == F.col("_seen"), F.col(N)).otherwise(F.lit(0)).cast("bigint").alias(N)
    )


def surrogate_key(hour: "str | Column" = HOUR, loc: "str | Column" = LOC) -> Column:
    """``'YYYY-MM-DD HH:MM:SS.ffffff-<location>'``; null if either part is null."""
    h = F.col(hour) if isinstance(hour, str) else hour
    lc = F.col(loc) if isinstance(loc, str) else loc
    # Built from the wall-clock fields of the timestamp_ntz value, so the text
    # never passes through a zoned timestamp (no session time-zone effect).
    # ``cast(ntz as string)`` is zone-free; its first 19 characters are
    # 'YYYY-MM-DD HH:MM:SS', a fraction follows a point, without trailing zeros.
    text = h.cast("string")
    fraction = F.rpad(F.split_part(text, F.lit("."), F.lit(2)), 6, "0")
    text = F.concat(F.substring(text, 1, 19), F.lit("."), fraction)
    return F.concat(text, F.lit("-"), lc.cast("string"))


def add_surrogate_key(df: DataFrame) -> DataFrame:
    """Add ``key`` from hour and location (P5)."""
    return df.withColumn("key", surrogate_key())


# ---------------------------------------------------------------- long series


def fill_series_gaps(
    df: DataFrame,
    unique_id: str = "unique_id",
    ds: str = "ds",
    target: str = "y",
    freq: str = "1d",
    span: str = "global",
) -> DataFrame:
    """Give every series every step of a regular grid; missing steps -> 0.

    ``span='global'``: the grid runs from the min to the max ``ds`` over all
    series (like the hourly fill, where a month is the span);
    ``span='series'``: from each series' own first to last row.
    Row-based lags equal calendar lags only on such complete series.
    The per-series bounds are one row per series; the grid is exploded per
    series, never crossed with the data.
    """
    step = interval_expr(freq)
    # Not-null predicates stated once, and every derived frame (per-series
    # bounds, global bounds) is an aggregate over the *values* of this input,
    # so Catalyst cannot push it down to a separate scan of the raw data: all
    # branches share one scan and one shuffle of ``df`` (exchange reuse).
    base = df.select(unique_id, ds, target).where(F.col(unique_id).isNotNull() & F.col(ds).isNotNull())
    # The count reads the target, so the optimizer keeps the input's own
    # aggregate here instead of a cheaper separate one.
    per_series = (
        base.groupBy(unique_id)
        .agg(F.min(ds).alias("_lo"), F.max(ds).alias("_hi"), F.count(target).alias("_n"))
        .where(F.col("_n") >= 0)
    )
    if span == "global":
        lo = per_series.select(F.min("_lo")).scalar()
        hi = per_series.select(F.max("_hi")).scalar()
        # least/greatest with the series' own bounds equal the global bounds
        # and keep this branch identical to the one the scalars read.
        per_series = per_series.select(
            unique_id, F.least(F.col("_lo"), lo).alias("_lo"), F.greatest(F.col("_hi"), hi).alias("_hi")
        )
    elif span != "series":
        raise ValueError("span must be 'global' or 'series'")
    # A fixed number of partitions: the bounds are few, what they expand to is not.
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    per_series = per_series.repartition(parts, unique_id)
    grid = per_series.select(unique_id, F.explode(F.sequence("_lo", "_hi", step)).alias(ds))
    return (
        grid.join(base, [unique_id, ds], "left")
        .select(unique_id, ds, F.coalesce(F.col(target), F.lit(0).cast(df.schema[target].dataType)).alias(target))
    )


def last_ds(df: DataFrame, unique_id: str = "unique_id", ds: str = "ds", name: str | None = None) -> DataFrame:
    """Newest ``ds`` per series (A5)."""
    return df.groupBy(unique_id).agg(F.max(ds).alias(name or ds))


def extend_horizon(
    df: DataFrame,
    h: int = 1,
    freq: str = "1d",
    unique_id: str = "unique_id",
    ds: str = "ds",
    target: str = "y",
) -> DataFrame:
    """Append ``h`` future rows per series after its last ``ds``, target null."""
    fut = last_ds(df, unique_id, ds, "_last").select(
        unique_id,
        F.explode(F.sequence(F.lit(1), F.lit(h))).alias("_k"),
        "_last",
    )
    fut = fut.select(
        unique_id,
        add_duration(F.col("_last"), freq, F.col("_k")).alias(ds),
    )
    for c in df.columns:
        if c not in (unique_id, ds):
            fut = fut.withColumn(c, F.lit(None).cast(df.schema[c].dataType))
    return df.unionByName(fut.select(df.columns))
