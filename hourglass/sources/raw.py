"""Raw monthly trip files (S1), month spine (S6), month coverage."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourglass.functions.time import date_lit, month_start
from hourglass.schema import enforce_schema

# Monthly raw file name and the pattern that reads its month.
RAW_FILE_PATTERN = "yellow_tripdata_{year}-{month:02d}.parquet"
RAW_FILE_MONTH_REGEX = r"(\d{4})-(\d{2})\.parquet"


def raw_file_name(year: int, month: int) -> str:
    return RAW_FILE_PATTERN.format(year=year, month=month)


def list_monthly_files(spark: SparkSession, root: str, glob: str = "*.parquet", month_regex: str = RAW_FILE_MONTH_REGEX):
    """(path, first-of-month date) of every raw file under ``root`` whose
    name holds a month.  File-system metadata only (bounded by the number of
    monthly files, not by their size)."""
    import re

    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    base = jvm.org.apache.hadoop.fs.Path(root)
    fs = base.getFileSystem(conf)
    statuses = fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{glob}")) or []
    found = []
    rx = re.compile(month_regex)
    for st in statuses:
        path = st.getPath().toString()
        m = rx.search(path)
        if m:
            found.append((path, date(int(m.group(1)), int(m.group(2)), 1)))
    return sorted(found, key=lambda t: (t[1], t[0]))


def scan_monthly_files(
    spark: SparkSession,
    root: str,
    glob: str = "*.parquet",
    month_regex: str = RAW_FILE_MONTH_REGEX,
    merge_schema: bool = False,
    per_file: bool = True,
) -> DataFrame:
    """Read every monthly raw file under ``root`` in ONE plan.

    Each row carries ``file_month`` (date, first of month), the month its
    file claims, so all months go through one plan instead of a loop of
    reads.

    ``per_file=True`` (default): the files are listed (metadata only), the
    month is read from each name once, and the plan is a union of per-file
    scans, each tagged with a literal month -- no per-row work to find the
    month, and a month filter on top is pushed into every file's scan as
    literal bounds (parquet row groups of other months are skipped).  Schema
    drift between months is absorbed by ``unionByName(allowMissingColumns)``.
    ``per_file=False``: one scan of the folder, the month taken per row from
    the hidden ``_metadata.file_path`` column.
    """
    if per_file:
        files = list_monthly_files(spark, root, glob, month_regex)
        if not files:
            raise FileNotFoundError(f"no monthly files under {root!r} matching {glob!r}")
        out = None
        for path, month in files:
            part = spark.read.parquet(path).withColumn("file_month", date_lit(month))
            out = part if out is None else out.unionByName(part, allowMissingColumns=True)
        return out
    df = (
        spark.read.option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .option("mergeSchema", str(merge_schema).lower())
        .parquet(root)
    )
    name = F.col("_metadata.file_path")
    y = F.regexp_extract(name, month_regex, 1)
    m = F.regexp_extract(name, month_regex, 2)
    file_month = F.when(y != "", F.make_date(y.cast("int"), m.cast("int"), F.lit(1)))
    return df.withColumn("file_month", file_month)


class MissingColumns(ValueError):
    """Monthly files lack columns that the scan needs."""


def scan_months(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    glob: str = "*.parquet",
    month_regex: str = RAW_FILE_MONTH_REGEX,
) -> DataFrame:
    """The monthly raw files under ``root`` with the columns of ``schema`` and ``file_month``.

    There is one scan per month and layout, whatever the number of files, each
    with its month as a literal, so that a filter on the month or on the time
    reaches its scan.  Columns are cast to ``schema`` (types drift between
    months); other columns of the files are not read.  Every file is checked
    before anything is read: if columns are missing, :class:`MissingColumns`
    names all files and columns at once instead of giving nulls.  Only footers
    are read for that, several at a time.
    """
    files = list_monthly_files(spark, root, glob, month_regex)
    if not files:
        raise FileNotFoundError(f"no monthly files under {root!r} matching {glob!r}")
    with ThreadPoolExecutor(max_workers=8) as pool:
        layouts = list(pool.map(lambda f: spark.read.parquet(f[0]).schema, files))
    groups: dict[tuple[date, str], list[str]] = {}
    found, lacking = {}, []
    for (path, month), layout in zip(files, layouts, strict=True):
        missing = [f.name for f in schema.fields if f.name not in layout.names]
        if missing:
            lacking.append(f"{path.rsplit('/', 1)[-1]}: {', '.join(missing)}")
            continue
        used = T.StructType([layout[f.name] for f in schema.fields])
        key = (month, used.json())
        found[key] = used
        groups.setdefault(key, []).append(path)
    if lacking:
        raise MissingColumns("missing columns; " + "; ".join(lacking))
    parts = [
        enforce_schema(spark.read.schema(found[key]).parquet(*paths), schema).withColumn("file_month", date_lit(key[0]))
        for key, paths in groups.items()
    ]
    return reduce(DataFrame.unionAll, parts)


def with_file_month(df: DataFrame, year: int, month: int) -> DataFrame:
    """Tag a frame read from one file with the month that file claims."""
    return df.withColumn("file_month", date_lit(date(year, month, 1)))


def month_spine_col(from_date, to_date):
    """Array of first-of-month dates from ``from_date`` to ``to_date``, both ends in."""
    start = F.trunc(from_date, "MM")
    stop = F.trunc(to_date, "MM")
    return F.when(start <= stop, F.sequence(start, stop, F.expr("INTERVAL 1 MONTH"))).otherwise(
        F.array().cast("array<date>")
    )


def month_spine(spark: SparkSession, from_date, to_date) -> DataFrame:
    """First-of-month dates, both ends included, as a DataFrame(month)."""
    a = date_lit(from_date if not isinstance(from_date, datetime) else from_date.date())
    b = date_lit(to_date if not isinstance(to_date, datetime) else to_date.date())
    return spark.range(1).select(F.explode(month_spine_col(a, b)).alias("month"))


def month_spine_of(df: DataFrame, ts_col: str) -> DataFrame:
    """Month spine over the [min, max] of a timestamp column of ``df``."""
    bounds = df.agg(F.min(ts_col).alias("lo"), F.max(ts_col).alias("hi"))
    return bounds.select(
        F.explode(month_spine_col(F.to_date("lo"), F.to_date("hi"))).alias("month")
    )


def month_coverage(spine: DataFrame, months_present: DataFrame) -> DataFrame:
    """Which months of a spine have data.

    ``months_present`` is (month date, records bigint), one row per month.
    Months without data come back with ``records = 0`` and
    ``is_present = false``: the report of failed/absent months that the
    monthly loop of the original design only logged.
    """
    present = months_present.select(
        F.col("month"), F.col("records").cast("bigint").alias("records")
    )
    return (
        spine.join(present, "month", "left")
        .select(
            "month",
            F.coalesce("records", F.lit(0).cast("bigint")).alias("records"),
            F.col("records").isNotNull().alias("is_present"),
        )
    )


def months_of(df: DataFrame, ts_col: str) -> DataFrame:
    """(month, records): records per calendar month of ``ts_col``."""
    return (
        df.where(F.col(ts_col).isNotNull())
        .groupBy(month_start(ts_col).alias("month"))
        .agg(F.count(F.lit(1)).alias("records"))
    )
