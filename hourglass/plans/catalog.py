"""Query catalogue: every registered query reads the driver tables of one
scale-factor folder and returns a DataFrame.

Each query has the same name in ``hourglass.plans.oracle.ORACLE_SQL`` when an
equivalent DuckDB statement exists.  Doubles are rounded to 6 digits at the
very end (presentation only), as the oracle does.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn

    return deco


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(
        [
            F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def as_double(df: DataFrame, cols) -> DataFrame:
    """Present integer columns that hold nulls as double (presentation only):
    both engines then hand the same values to pandas (a nullable integer
    column otherwise arrives as float in one and as nullable int in the other)."""
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


def _load_all() -> None:
    # Import modules that register queries (kept in separate files by area).
    from hourglass.plans import q_etl, q_forecast, q_intervals, q_series, q_streaming  # noqa: F401


def all_queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(QUERIES)
