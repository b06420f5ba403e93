"""Exact positions on many partitions, with payload columns, written out whole."""

import pytest
from pyspark.sql import functions as F

from hourglass.functions.ranks import POS, sorted_positions


@pytest.mark.parametrize("by", [[], ["g"]])
def test_positions_of_many_rows_with_payload(spark, tmp_dir, by):
    n = 400_000
    rows = spark.range(n).select(
        (F.col("id") % 7).alias("g"), F.pmod(F.xxhash64("id"), F.lit(1 << 40)).alias("k"), (F.col("id") * 3).alias("payload")
    )
    path = f"{tmp_dir}/positions-{len(by)}"
    sorted_positions(rows, ["k", "payload"], by, num_partitions=64).write.parquet(path)
    got = spark.read.parquet(path).toPandas().sort_values([*by, "k", "payload"])
    assert len(got) == n
    want = got.groupby("g").cumcount() if by else range(n)
    assert (got[POS].to_numpy() == list(want)).all()
