"""Time helpers on ``timestamp_ntz`` columns.

All helpers are JVM-side expressions (they stay inside whole-stage codegen)
and are independent of the session time zone: they never pass through a
zoned ``timestamp``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Duration-string units -> (months, microseconds) per unit.
_UNITS = {
    "us": (0, 1),
    "ms": (0, 1_000),
    "s": (0, 1_000_000),
    "m": (0, 60 * 1_000_000),
    "h": (0, 3_600 * 1_000_000),
    "d": (0, 86_400 * 1_000_000),
    "w": (0, 7 * 86_400 * 1_000_000),
    "mo": (1, 0),
    "q": (3, 0),
    "y": (12, 0),
}
_PART = re.compile(r"(\d+)(mo|us|ms|s|m|h|d|w|q|y)")


@dataclass(frozen=True)
class Duration:
    """A calendar duration: whole months plus a fixed number of microseconds."""

    months: int = 0
    micros: int = 0

    @property
    def is_calendar(self) -> bool:
        return self.months != 0

    def __str__(self) -> str:  # pragma: no cover - display only
        return f"Duration(months={self.months}, micros={self.micros})"


def parse_duration(spec: "str | Duration") -> Duration:
    """Parse ``'1h'``, ``'1d'``, ``'3mo'``, ``'1w'``, ``'1d12h'`` ...

    The full unit is parsed (``'3mo'`` is three months, not three minutes).
    """
    if isinstance(spec, Duration):
        return spec
    text = spec.strip().lower()
    pos, months, micros = 0, 0, 0
    for m in _PART.finditer(text):
        if m.start() != pos:
            raise ValueError(f"bad duration string: {spec!r}")
        n = int(m.group(1))
        mo, us = _UNITS[m.group(2)]
        months += n * mo
        micros += n * us
        pos = m.end()
    if pos != len(text) or (months == 0 and micros == 0):
        raise ValueError(f"bad duration string: {spec!r}")
    return Duration(months, micros)


def _dt_interval(micros: "int | Column", times: "int | Column" = 1) -> Column:
    """Day-time interval of ``micros * times`` microseconds."""
    total = F.lit(micros) * (times if isinstance(times, Column) else F.lit(times))
    total = total.cast("bigint")
    day_us = 86_400 * 1_000_000
    days = F.floor(total / F.lit(day_us)).cast("int")
    rest = total - days.cast("bigint") * F.lit(day_us)
    secs = (rest / F.lit(1_000_000)).cast("decimal(18,6)")
    return F.make_dt_interval(days, F.lit(0), F.lit(0), secs)


def add_duration(ts: "str | Column", spec: "str | Duration", times: "int | Column" = 1) -> Column:
    """``ts + times * spec``; ``times`` may be a column (e.g. a step number)."""
    col = F.col(ts) if isinstance(ts, str) else ts
    d = parse_duration(spec)
    t = times if isinstance(times, Column) else F.lit(times)
    out = col
    if d.months:
        out = out + F.make_ym_interval(F.lit(0), (t * F.lit(d.months)).cast("int"))
    if d.micros:
        if d.micros % (86_400 * 1_000_000) == 0:
            out = out + F.make_dt_interval((t * F.lit(d.micros // (86_400 * 1_000_000))).cast("int"))
        else:
            out = out + _dt_interval(d.micros, t)
    return out


def interval_expr(spec: "str | Duration") -> Column:
    """An interval literal usable as a ``sequence`` step."""
    d = parse_duration(spec)
    if d.months and d.micros:
        raise ValueError("a sequence step must be either months or a fixed time")
    if d.months:
        return F.expr(f"INTERVAL {d.months} MONTHS")
    secs = d.micros / 1_000_000
    if d.micros % 1_000_000 == 0:
        return F.expr(f"INTERVAL {d.micros // 1_000_000} SECONDS")
    return F.expr(f"INTERVAL '{secs:.6f}' SECOND")


def trunc_hour(ts: "str | Column") -> Column:
    col = F.col(ts) if isinstance(ts, str) else ts
    return F.make_timestamp_ntz(
        F.year(col), F.month(col), F.dayofmonth(col), F.hour(col), F.lit(0), F.lit(0)
    )


def trunc_day(ts: "str | Column") -> Column:
    col = F.col(ts) if isinstance(ts, str) else ts
    return F.to_date(col).cast("timestamp_ntz")


def month_start(ts: "str | Column") -> Column:
    """First day of the month as ``date``."""
    col = F.col(ts) if isinstance(ts, str) else ts
    return F.trunc(F.to_date(col), "MM")


def ntz_lit(value: "str | date | datetime") -> Column:
    """A ``timestamp_ntz`` literal from a string, date or naive datetime."""
    if isinstance(value, datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(value, date):
        value = value.strftime("%Y-%m-%d 00:00:00")
    return F.lit(value).cast("timestamp_ntz")


def date_lit(value: "str | date | datetime") -> Column:
    if isinstance(value, datetime):
        value = value.date()
    if isinstance(value, date):
        value = value.isoformat()
    return F.lit(value).cast("date")


def to_datetime(value: "str | date | datetime") -> datetime:
    """Normalise a Python bound to a naive ``datetime``."""
    if isinstance(value, datetime):
        return value
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day)
    return datetime.fromisoformat(str(value))
