"""Property tests: halo-bucket windows and distributed positions equal their
plain per-group forms for random shapes."""

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from hourglass.functions import grid as G
from hourglass.functions.ranks import POS, sorted_positions
from hourglass.operators.series import time_lags

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(
    lengths=st.lists(st.integers(min_value=1, max_value=60), min_size=1, max_size=4),
    lags=st.lists(st.integers(min_value=1, max_value=9), min_size=1, max_size=3, unique=True),
    bucket=st.integers(min_value=9, max_value=40),
    offset=st.integers(min_value=0, max_value=500),
)
def test_halo_lags_equal_window_lags(spark, lengths, lags, bucket, offset):
    rows = []
    for i, n in enumerate(lengths):
        start = datetime(2020, 1, 1) + timedelta(days=offset + 7 * i)
        rows += [(f"s{i}", start + timedelta(days=d), d * 3 + i) for d in range(n)]
    df = spark.createDataFrame(rows, "unique_id string, ds timestamp_ntz, y long")
    old = G.with_halo.__defaults__
    G.with_halo.__defaults__ = (bucket,)
    try:
        a = sorted(tuple(r) for r in time_lags(df, lags, drop_nulls=False, grid_freq="1d").collect())
    finally:
        G.with_halo.__defaults__ = old
    b = sorted(tuple(r) for r in time_lags(df, lags, drop_nulls=False).collect())
    assert a == b


@SETTINGS
@given(
    sizes=st.lists(st.integers(min_value=1, max_value=200), min_size=1, max_size=5),
    parts=st.integers(min_value=1, max_value=9),
)
def test_sorted_positions_equal_row_number(spark, sizes, parts):
    rows = [(f"g{i}", float((j * 7919) % 101)) for i, n in enumerate(sizes) for j in range(n)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = sorted(tuple(r) for r in sorted_positions(df, ["v"], ["g"], num_partitions=parts, checkpoint=False)
                 .select("g", "v", POS).collect())
    exp = sorted(
        tuple(r)
        for r in df.select("g", "v", (F.row_number().over(Window.partitionBy("g").orderBy("v")) - 1).alias(POS)).collect()
    )
    assert got == exp
