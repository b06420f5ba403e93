"""Fixed schemas of the engine and the schema boundary helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Hourly demand table: fixed column order and types.
PICKUP_HOURLY = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("pickup_datetime_hour", T.TimestampNTZType()),
        T.StructField("num_pickup", T.IntegerType()),
        T.StructField("pickup_location_id", T.IntegerType()),
    ]
)

# Raw trip column -> (clean name, type).
RAW_TRIP_COLUMNS = {
    "tpep_pickup_datetime": ("pickup_datetime", T.TimestampNTZType()),
    "passenger_count": ("passenger_count", T.IntegerType()),
    "PULocationID": ("pickup_location_id", T.IntegerType()),
}

# Partition column added on disk so range reads prune whole months.
MONTH_PARTITION = "pickup_month"


def enforce_schema(df: DataFrame, schema: T.StructType = PICKUP_HOURLY) -> DataFrame:
    """Select the schema's columns in order and cast them (ANSI: strict)."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def standardize_raw_schema(df: DataFrame) -> DataFrame:
    """Keep the three raw trip columns, rename them, cast them.

    Extra columns (such as a ``file_month`` added by the monthly scan) are
    kept so that several monthly files can run through one plan.
    """
    keep = [c for c in df.columns if c == "file_month"]
    cols = [
        F.col(raw).cast(t).alias(clean) for raw, (clean, t) in RAW_TRIP_COLUMNS.items()
    ]
    return df.select(*cols, *keep)


def null_of(dtype: T.DataType) -> Column:
    return F.lit(None).cast(dtype)
