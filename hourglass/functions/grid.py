"""Regular time grids: step numbers and halo buckets.

On a complete regular grid (every series has every step, which the gap
fills guarantee) row-based lags equal calendar lags, so a series can be cut
into fixed time buckets and windowed per (series, bucket).  Each row also
goes, as a *halo* copy, into the next bucket when it is among the last
``halo`` steps of its own bucket, so every window still sees the ``halo``
rows before its first own row.  No task then holds more than one bucket of
one series, however long or hot that series is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourglass.functions.time import parse_duration

BUCKET_COL = "_bucket"
HALO_COL = "_halo"
DEFAULT_BUCKET_STEPS = 1024


def step_index(ds: "str | Column", freq: str) -> Column:
    """Whole ``freq`` steps since 1970-01-01 (time-zone independent for NTZ)."""
    col = F.col(ds) if isinstance(ds, str) else ds
    d = parse_duration(freq)
    if d.months and not d.micros:
        months = F.year(col) * 12 + F.month(col) - 1
        return F.floor(months / F.lit(d.months)).cast("long")
    hour_us = 3_600_000_000
    if not d.months and d.micros % hour_us == 0:
        days = F.datediff(F.to_date(col), F.lit("1970-01-01").cast("date")).cast("long")
        hours = days * 24 + F.hour(col)
        return F.floor(hours / F.lit(d.micros // hour_us)).cast("long")
    raise ValueError(f"grid steps support whole hours, days or months, not {freq!r}")


def with_halo(
    df: DataFrame,
    ds: str,
    freq: str,
    halo: int,
    bucket_steps: int = DEFAULT_BUCKET_STEPS,
) -> DataFrame:
    """Add ``_bucket`` and ``_halo``; rows near a bucket end are duplicated
    into the next bucket (one pass, an ``explode`` of one or two bucket ids).
    A bucket is never shorter than the halo, so any lag works.
    """
    bucket_steps = max(bucket_steps, halo)
    step = step_index(ds, freq)
    b = F.floor(step / F.lit(bucket_steps)).cast("long")
    off = step - b * F.lit(bucket_steps)
    targets = F.when(off >= F.lit(bucket_steps - halo), F.array(b, b + 1)).otherwise(F.array(b))
    return (
        df.withColumn("_own", b)
        .withColumn(BUCKET_COL, F.explode(targets))
        .withColumn(HALO_COL, F.col(BUCKET_COL) != F.col("_own"))
        .drop("_own")
    )


def bucket_window(unique_id: "str | list[str]", ds: str) -> Window:
    ids = [unique_id] if isinstance(unique_id, str) else list(unique_id)
    return Window.partitionBy(*ids, BUCKET_COL).orderBy(ds)


def with_row_halo(
    df: DataFrame,
    unique_id: str,
    ds: str,
    halo: int,
    bucket_rows: int | None = None,
) -> DataFrame:
    """Halo buckets by *row position* instead of time, for series that are
    not complete grids (row-lag semantics kept exactly).

    Positions inside each series come from a distributed sort
    (:func:`hourglass.functions.ranks.sorted_positions`), so no task holds a
    whole series even while numbering; a row at position p goes to bucket
    ``p // bucket_rows`` and, when among the last ``halo`` rows of it, also to
    the next bucket.
    """
    from hourglass.functions.ranks import POS, sorted_positions

    size = max(bucket_rows or DEFAULT_BUCKET_STEPS, halo)
    pos = sorted_positions(df, [ds], [unique_id])
    b = F.floor(F.col(POS) / F.lit(size)).cast("long")
    off = F.col(POS) - b * F.lit(size)
    targets = F.when(off >= F.lit(size - halo), F.array(b, b + 1)).otherwise(F.array(b))
    return (
        pos.withColumn("_own", b)
        .withColumn(BUCKET_COL, F.explode(targets))
        .withColumn(HALO_COL, F.col(BUCKET_COL) != F.col("_own"))
        .drop("_own", POS)
    )
