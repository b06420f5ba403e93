"""Range fetch (P6-P8), series slice (P9), renames (P10), null drops."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourglass.functions.time import ntz_lit, to_datetime

HOUR = "pickup_datetime_hour"
LOC = "pickup_location_id"


def normalize_locations(locations: "int | Sequence[int] | None") -> list[int]:
    """``None`` or ``[]`` -> no filter; a single int -> one-item list."""
    if locations is None:
        return []
    if isinstance(locations, int):
        return [locations]
    return list(locations)


def check_range(from_date, to_date) -> tuple[datetime, datetime]:
    """``from > to`` is an error; equal bounds are allowed."""
    a, b = to_datetime(from_date), to_datetime(to_date)
    if a > b:
        raise ValueError(f"{a} can't be higher than {b}")
    return a, b


def range_predicate(
    from_date: "str | date | datetime",
    to_date: "str | date | datetime",
    closed: str = "left",
    ts: str = HOUR,
) -> Column:
    """``from <= ts < to`` (``closed='left'``, default) or ``<= to`` (``'both'``)."""
    a, b = check_range(from_date, to_date)
    lo = F.col(ts) >= ntz_lit(a)
    if closed == "left":
        return lo & (F.col(ts) < ntz_lit(b))
    if closed == "both":
        return lo & (F.col(ts) <= ntz_lit(b))
    raise ValueError("closed must be 'left' or 'both'")


def fetch_range(
    df: DataFrame,
    from_date,
    to_date,
    pickup_locations: "int | Sequence[int] | None" = None,
    closed: str = "left",
    ts: str = HOUR,
    loc: str = LOC,
) -> DataFrame:
    """Rows of a time range, optionally for some locations.

    Literal bounds, so on a parquet scan the predicate is pushed to the
    reader; a null location never matches a non-empty list.
    """
    out = df.where(range_predicate(from_date, to_date, closed, ts))
    locs = normalize_locations(pickup_locations)
    if locs:
        out = out.where(F.col(loc).isin(locs))
    return out


def rename_to_series(
    df: DataFrame, id_col: str = LOC, ts_col: str = HOUR, target: str = "num_pickup"
) -> DataFrame:
    """``pickup_location_id -> unique_id``, ``hour -> ds``, ``num_pickup -> y`` (P10)."""
    return df.withColumnsRenamed({id_col: "unique_id", ts_col: "ds", target: "y"})


def drop_nulls(df: DataFrame) -> DataFrame:
    """Drop rows with a null in any column."""
    return df.dropna(how="any")


def series_slice(
    df: DataFrame,
    series: Sequence[str],
    x: str = "ds",
    target: str | None = "y",
    band: Sequence[str] | None = None,
    locations: "int | Sequence[int] | None" = None,
    loc: str = "unique_id",
    plot_from=None,
    long: bool = True,
) -> DataFrame:
    """Data behind a time-series chart.

    Optional location filter, optional strict ``x > plot_from``; keeps x,
    the chosen series, the target and the band columns.  ``long=True``
    unpivots the value columns to (x, [loc,] variable, value).
    """
    out = df
    locs = normalize_locations(locations)
    if locs:
        out = out.where(F.col(loc).isin(locs))
    if plot_from is not None:
        out = out.where(F.col(x) > ntz_lit(to_datetime(plot_from)))
    values = list(series) + ([target] if target else []) + list(band or [])
    ids = [x] + ([loc] if loc in df.columns else [])
    out = out.select(*ids, *[F.col(c).cast("double").alias(c) for c in values])
    if not long:
        return out
    return out.unpivot(ids, values, "variable", "value")


def keep_dates(df: DataFrame, dates: DataFrame, ds: str = "ds", by: Sequence[str] = ()) -> DataFrame:
    """Keep rows whose timestamp is one of ``dates`` (P11): a left-semi join,
    optionally also on ``by`` columns (e.g. the series id)."""
    keys = [*by, ds]
    return df.join(dates.select(*keys).distinct(), keys, "left_semi")


def first_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first ``n`` rows by ``order`` (O3): a top-k (TakeOrderedAndProject),
    each task keeps only its own top ``n`` before the final merge."""
    return df.orderBy(*order).limit(n)


def last_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The last ``n`` rows by ``order`` (O3)."""
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n)
