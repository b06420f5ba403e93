"""The hourly demand table on parquet: ensure (S3), lazy scan (S2),
keyed upsert write (U2 + S4) and range fetch (P6-P8).

Layout: a Hive-partitioned parquet folder, one partition per month
(``pickup_month=YYYY-MM-01``).  A range read prunes whole months; an upsert
rewrites only the months its batch touches, through Spark's dynamic partition
overwrite (each month directory is replaced at job commit).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourglass.functions.time import date_lit, month_start
from hourglass.operators.select import check_range, fetch_range
from hourglass.operators.upsert import upsert_by_key
from hourglass.schema import MONTH_PARTITION, PICKUP_HOURLY, enforce_schema
from hourglass.session import ensure_checkpoint_dir

HOUR = "pickup_datetime_hour"


def _fs_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def _fs_delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(conf).delete(p, True)


class HourlyTable:
    """One parquet table with the fixed hourly-demand schema."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType = PICKUP_HOURLY):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.disk_schema = T.StructType(list(schema.fields) + [T.StructField(MONTH_PARTITION, T.DateType())])

    # ------------------------------------------------------------------ S3
    def exists(self) -> bool:
        return _fs_exists(self.spark, f"{self.path}/_SUCCESS")

    def ensure(self) -> "HourlyTable":
        """Create the empty table when absent; never drops existing data."""
        if not self.exists():
            empty = self.spark.createDataFrame([], self.disk_schema)
            empty.write.mode("append").partitionBy(MONTH_PARTITION).parquet(self.path)
        return self

    # ------------------------------------------------------------------ S2
    def scan(self) -> DataFrame:
        """Lazy scan with the fixed schema; keeps the month partition column."""
        return self.spark.read.schema(self.disk_schema).parquet(self.path)

    def read(self) -> DataFrame:
        return enforce_schema(self.scan(), self.schema)

    # ------------------------------------------------------------- P6-P8
    def fetch(
        self,
        from_date,
        to_date,
        pickup_locations: "int | Sequence[int] | None" = None,
        closed: str = "left",
    ) -> DataFrame:
        """Rows in ``[from, to)`` (or ``[from, to]``), optionally by location.

        The time range is also stated on the month partition column, so the
        reader skips months outside it (``PartitionFilters``) and pushes the
        hour range into each file (``PushedFilters``).
        """
        a, b = check_range(from_date, to_date)
        months = (F.col(MONTH_PARTITION) >= date_lit(a.replace(day=1).date())) & (
            F.col(MONTH_PARTITION) <= date_lit(b.replace(day=1).date())
        )
        df = self.scan().where(months)
        return enforce_schema(fetch_range(df, a, b, pickup_locations, closed), self.schema)

    # ------------------------------------------------------------------ S4
    def write(self, df: DataFrame) -> None:
        """Replace the whole table with ``df`` (static overwrite, month folders,
        rows clustered by month and key)."""
        out = enforce_schema(df, self.schema).withColumn(MONTH_PARTITION, month_start(HOUR))
        prev = self.spark.conf.get("spark.sql.sources.partitionOverwriteMode")
        self.spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
        try:
            (
                out.repartitionByRange(MONTH_PARTITION, "key")
                .write.mode("overwrite")
                .partitionBy(MONTH_PARTITION)
                .parquet(self.path)
            )
        finally:
            self.spark.conf.set("spark.sql.sources.partitionOverwriteMode", prev)

    # ---------------------------------------------------------- U2 + S4
    def upsert(
        self,
        new: DataFrame,
        key: str = "key",
        key_fixes_month: bool = True,
        order_cols: Sequence[str] | None = None,
        update_cols: Sequence[str] | None = None,
        null_keys: str = "error",
    ) -> None:
        """Merge a batch into the table by key and write the touched months.

        ``key_fixes_month=True`` (keys made from the hour, as the transform
        makes them): a key never changes month, so only months present in
        the batch are read, merged and rewritten.  Otherwise every month is
        merged and rewritten.

        The batch is first written to a staging folder under the session's
        ``spark.checkpoint.dir`` (shared storage: survives executor loss and
        cuts the lineage), then merged with the current rows of the touched
        months and written back with dynamic partition overwrite.  With keys
        that fix the month the merge deals rows into ranges of keys, so one
        shuffle and one sort serve the merge and the layout of the files.
        """
        self.ensure()
        batch = enforce_schema(new, self.schema).withColumn(MONTH_PARTITION, month_start(HOUR))
        stage = f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/hourglass-staging/batch-{uuid.uuid4().hex}"
        batch.write.mode("overwrite").partitionBy(MONTH_PARTITION).parquet(stage)
        staged = self.spark.read.schema(self.disk_schema).parquet(stage)

        current = self.scan()
        if key_fixes_month:
            touched = [r[0] for r in staged.select(MONTH_PARTITION).distinct().collect()]
            if not touched:
                return
            current = current.where(F.col(MONTH_PARTITION).isin(touched))
        merged = upsert_by_key(
            current, staged, key=key, order_cols=order_cols, update_cols=update_cols, null_keys=null_keys,
            by_range=key_fixes_month,
        )
        prev = self.spark.conf.get("spark.sql.sources.partitionOverwriteMode")
        merged_stage = None
        try:
            if key_fixes_month:
                # Dynamic overwrite: tasks read the touched months and write new
                # files to Spark's job staging folder; the month folders are only
                # replaced at job commit, so a failed or retried job leaves the
                # table as it was.
                self.spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
                # The merge leaves them in ranges of keys already.
                out = merged
            else:
                # Keys may move between months, so every month is rewritten and
                # a month left empty must disappear: static overwrite, which
                # cannot read its own target, so the merge is staged first.
                merged_stage = f"{stage}-merged"
                merged.write.mode("overwrite").partitionBy(MONTH_PARTITION).parquet(merged_stage)
                out = self.spark.read.schema(self.disk_schema).parquet(merged_stage).repartitionByRange(MONTH_PARTITION, key)
                self.spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
            out.write.mode("overwrite").partitionBy(MONTH_PARTITION).parquet(self.path)
        finally:
            self.spark.conf.set("spark.sql.sources.partitionOverwriteMode", prev)
        _fs_delete(self.spark, stage)
        if merged_stage:
            _fs_delete(self.spark, merged_stage)
