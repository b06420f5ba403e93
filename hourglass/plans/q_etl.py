"""ETL queries: raw trips -> hourly demand table, and table operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.operators.clean import filter_in_month, transform_raw, validity_report
from hourglass.operators.spine import hourly_counts
from hourglass.plans import inputs as I
from hourglass.plans.catalog import query, rounded
from hourglass.schema import standardize_raw_schema
from hourglass.sources.raw import month_coverage, month_spine_of, months_of


def orders_tagged_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as raw trips; each year's rows form one 'file' claiming January."""
    raw = I.raw_orders_as_trips(spark, sf_dir)
    return raw.withColumn(
        "file_month", F.make_date(F.year("tpep_pickup_datetime"), F.lit(1), F.lit(1))
    )


def orders_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as raw trips of monthly files: each order's file is its own month,
    its location the nation of its customer."""
    nations = I.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    raw = I.raw_orders_as_trips(spark, sf_dir).join(nations, F.col("PULocationID") == F.col("c_custkey"), "left")
    return raw.select(
        "tpep_pickup_datetime", "passenger_count", F.col("c_nationkey").cast("bigint").alias("PULocationID"),
        F.trunc("tpep_pickup_datetime", "MM").alias("file_month"),
    )


def hourly_demand_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transform_raw(I.raw_trips(spark, sf_dir), I.TRIP_YEAR, I.TRIP_MONTH)


@query("month_spine")
def q_month_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return month_spine_of(I.table(spark, sf_dir, "orders"), "o_orderdate")


@query("month_coverage")
def q_month_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hourglass.sources.raw import month_spine

    orders = I.table(spark, sf_dir, "orders")
    spine = month_spine(spark, "1994-10-01", "2002-03-31")
    return month_coverage(spine, months_of(orders, "o_orderdate"))


@query("standardize_raw")
def q_standardize_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardize_raw_schema(I.raw_trips(spark, sf_dir))


@query("validity_report")
def q_validity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = standardize_raw_schema(orders_tagged_by_year(spark, sf_dir))
    return rounded(validity_report(clean))


@query("filter_in_month")
def q_filter_in_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = standardize_raw_schema(orders_tagged_by_year(spark, sf_dir))
    return filter_in_month(clean)


@query("hourly_counts")
def q_hourly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = standardize_raw_schema(I.raw_trips(spark, sf_dir))
    clean = filter_in_month(clean, I.TRIP_YEAR, I.TRIP_MONTH)
    return hourly_counts(clean)


@query("hourly_demand")
def q_hourly_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly_demand_df(spark, sf_dir)


@query("hourly_demand_multi_month")
def q_hourly_demand_multi_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2 over many 'files' at once: every order, in the file of its month."""
    return transform_raw(orders_by_month(spark, sf_dir))


# --------------------------------------------------------------- table ops
# Two overlapping versions of the same month: "current" from trips before the
# 20th, "new" from trips since the 15th; both run the full transform.

def _hourly_slice(spark: SparkSession, sf_dir: str, lo: str | None, hi: str | None) -> DataFrame:
    raw = I.raw_trips(spark, sf_dir)
    if lo:
        raw = raw.where(F.col("tpep_pickup_datetime") >= F.lit(lo).cast("timestamp_ntz"))
    if hi:
        raw = raw.where(F.col("tpep_pickup_datetime") < F.lit(hi).cast("timestamp_ntz"))
    return transform_raw(raw, I.TRIP_YEAR, I.TRIP_MONTH)


@query("upsert_by_key")
def q_upsert_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hourglass.operators.upsert import upsert_by_key

    current = _hourly_slice(spark, sf_dir, None, "2024-01-20")
    new = _hourly_slice(spark, sf_dir, "2024-01-15", None)
    return upsert_by_key(current, new, key="key")


@query("upsert_update_cols")
def q_upsert_update_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hourglass.operators.upsert import upsert_by_key

    current = _hourly_slice(spark, sf_dir, None, "2024-01-20")
    new = _hourly_slice(spark, sf_dir, "2024-01-15", None)
    return upsert_by_key(current, new, key="key", update_cols=["num_pickup"])


@query("fetch_range")
def q_fetch_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hourglass.operators.select import fetch_range

    return fetch_range(hourly_demand_df(spark, sf_dir), "2024-01-10", "2024-01-20")


@query("fetch_range_closed")
def q_fetch_range_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hourglass.operators.select import fetch_range

    return fetch_range(hourly_demand_df(spark, sf_dir), "2024-01-10", "2024-01-20", closed="both")


@query("fetch_locations")
def q_fetch_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hourglass.operators.select import fetch_range

    return fetch_range(hourly_demand_df(spark, sf_dir), "2000-01-01", "2099-01-01", [3, 7, 42])


@query("table_fetch")
def q_table_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2-S4 + U2 + P6 on the real table: the hourly demand of the events is
    upserted into a fresh month-partitioned table under spark.checkpoint.dir
    (first write, then the same batch again: idempotent), and a range is read
    back with partition pruning and pushed filters."""
    import uuid

    from hourglass.session import ensure_checkpoint_dir
    from hourglass.sources.table import HourlyTable

    root = ensure_checkpoint_dir(spark).rstrip("/")
    table = HourlyTable(spark, f"{root}/hourglass-tables/pickup_hourly-{uuid.uuid4().hex}")
    batch = hourly_demand_df(spark, sf_dir)
    table.upsert(batch)
    table.upsert(batch)
    return table.fetch("2024-01-10", "2024-01-20")


@query("load_report")
def q_load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1 in one raw scan: all orders, in monthly 'files', are loaded into
    a fresh table under spark.checkpoint.dir; the validity report comes from
    the same aggregate."""
    import uuid

    from hourglass.operators.clean import load_monthly
    from hourglass.session import ensure_checkpoint_dir
    from hourglass.sources.table import HourlyTable

    root = ensure_checkpoint_dir(spark).rstrip("/")
    table = HourlyTable(spark, f"{root}/hourglass-tables/load-{uuid.uuid4().hex}")
    return rounded(load_monthly(orders_by_month(spark, sf_dir), table))


@query("load_table")
def q_load_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table written by the one-scan load, read back whole: equals the
    multi-month transform."""
    import uuid

    from hourglass.operators.clean import load_monthly
    from hourglass.session import ensure_checkpoint_dir
    from hourglass.sources.table import HourlyTable

    root = ensure_checkpoint_dir(spark).rstrip("/")
    table = HourlyTable(spark, f"{root}/hourglass-tables/load-{uuid.uuid4().hex}")
    load_monthly(orders_by_month(spark, sf_dir), table)
    return table.read()


def _fresh(spark: SparkSession, name: str) -> str:
    """A new folder for a table of a query, below ``spark.checkpoint.dir``."""
    import uuid

    from hourglass.session import ensure_checkpoint_dir

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/hourglass-tables/{name}-{uuid.uuid4().hex}"


@query("scan_monthly")
def q_scan_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders are written as one raw file folder per month, then scanned
    back month by month with a fixed schema and standardized."""
    from pyspark.sql import types as T

    from hourglass.sources.raw import scan_months

    root = _fresh(spark, "raw")
    name = F.concat(F.lit("yellow_tripdata_"), F.date_format("file_month", "yyyy-MM"), F.lit(".parquet"))
    orders = orders_by_month(spark, sf_dir)
    orders.select(*[c for c in orders.columns if c != "file_month"], name.alias("file")).repartition("file").write.partitionBy(
        "file"
    ).parquet(root)
    wanted = T.StructType(
        [
            T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
            T.StructField("passenger_count", T.DoubleType()),
            T.StructField("PULocationID", T.LongType()),
        ]
    )
    return standardize_raw_schema(scan_months(spark, root, wanted))


@query("snapshot_fetch")
def q_snapshot_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2-S4 + U2 on the snapshot table: the hourly demand of the events in two
    commits that touch the same month, then a range read of the last snapshot."""
    from hourglass.sources.snapshots import SnapshotTable

    table = SnapshotTable(spark, _fresh(spark, "snapshots")).ensure()
    batch = hourly_demand_df(spark, sf_dir)
    table.upsert(batch)
    table.upsert(batch)
    return table.fetch("2024-01-10", "2024-01-20")


@query("latest_rows")
def q_latest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3: the ten newest rows of the hourly demand table (top-k report)."""
    from hourglass.operators.select import last_rows

    return last_rows(hourly_demand_df(spark, sf_dir), 10, ["pickup_datetime_hour", "key"])
