"""How the driver's test tables feed the engine.

- trips  = ``events``: ``ts`` -> pickup time, ``user_id`` -> pickup location,
  ``value`` -> passenger count.  The file claims month 2024-01.
- long series = ``orders``: one series per ``o_orderpriority``, ``y`` = orders
  per day, gap-filled on the global daily grid.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.functions.time import trunc_day
from hourglass.operators.spine import fill_series_gaps

# The month the events file stands for, and the model setup
# of the original (lags in days, horizon in days, fold length).
TRIP_YEAR, TRIP_MONTH = 2024, 1
LAGS = [1, 7, 14, 28]
HORIZON = 7
#: Lags of the hourly series (an hour, a day, a week) and bootstrap draws per hour.
HOURLY_LAGS = [1, 24, 168]
HOURLY_DRAWS = 100
FOLD_EVERY = "3mo"
TEST_FROM = "2000-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` under the raw trip column names."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("ts").alias("tpep_pickup_datetime"),
        F.col("value").alias("passenger_count"),
        F.col("user_id").alias("PULocationID"),
    )


def raw_orders_as_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` under the raw trip column names (many months in one file)."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderdate").alias("tpep_pickup_datetime"),
        F.col("o_totalprice").alias("passenger_count"),
        F.col("o_custkey").alias("PULocationID"),
    )


def order_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per (priority, day): the sparse long series (no gap fill)."""
    o = table(spark, sf_dir, "orders")
    return o.groupBy(
        F.col("o_orderpriority").alias("unique_id"), trunc_day("o_orderdate").alias("ds")
    ).agg(F.count(F.lit(1)).alias("y"))


def nation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per (nation of the customer, day), without gap fill."""
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    named = o.join(c.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    return named.groupBy(
        F.col("c_nationkey").cast("string").alias("unique_id"), trunc_day("o_orderdate").alias("ds")
    ).agg(F.count(F.lit(1)).alias("y"))


def daily_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complete daily series (unique_id string, ds timestamp_ntz, y bigint)."""
    return fill_series_gaps(order_counts(spark, sf_dir), freq="1d", span="global")
