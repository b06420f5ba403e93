"""Exact positions in a sort order without funnelling a group into one task.

``sorted_positions`` gives every row its 0-based position inside its group
(or globally) in a sort order.  It range-partitions on (group, order) --
Spark samples the keys, so one hot group is spread over many partitions --,
sorts within each partition, numbers rows by their place in the partition,
and adds the number of same-group rows in all earlier partitions (a prefix
sum over a frame of one row per (partition, group)).  The result is the
same as ``row_number() - 1`` over a window per group, but no task sorts
more than one range partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourglass.session import ensure_checkpoint_dir

POS = "_pos"
#: Rows of (partition, group) offsets that may be broadcast; beyond, a join by key.
BROADCAST_ROWS = 50_000


def sorted_positions(
    df: DataFrame,
    order: Sequence["str | Column"],
    by: Sequence[str] = (),
    num_partitions: int | None = None,
    checkpoint: bool = True,
) -> DataFrame:
    """Add ``_pos``: 0-based position of each row within ``by`` ordered by ``order``.

    Ties get distinct consecutive positions (any order among equal keys).
    Partition ids and row numbers are taken once: the range-partitioned, sorted
    and numbered frame is checkpointed to ``spark.checkpoint.dir`` (shared
    storage; also cuts the lineage), and both the rows and the counts per
    partition read that one copy.  (``checkpoint`` once made this optional; the
    copy is needed for right positions, so the argument no longer has an effect.)
    """
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    keys = [F.col(c) for c in by] + order_cols
    parted = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    tagged = parted.sortWithinPartitions(*keys).select(
        "*", F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_mid")
    )
    ensure_checkpoint_dir(df.sparkSession)
    tagged = tagged.checkpoint(eager=True)
    # One row per (partition, group): its size and first row id.
    part = tagged.groupBy("_pid", *by).agg(F.count(F.lit(1)).alias("_c"), F.min("_mid").alias("_m0"))
    # Prefix sums over the partitions of each group.  The frame has one row
    # per (partition, group), so each window task is small.
    w = (Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))).orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1
    )
    part = part.select("_pid", *by, "_m0", F.coalesce(F.sum("_c").over(w), F.lit(0)).alias("_off"))
    # One row per (partition, group): sent to all tasks only when it is small.
    if part.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        part = F.broadcast(part)
    out = tagged.join(part, ["_pid", *by])
    return out.withColumn(POS, F.col("_off") + F.col("_mid") - F.col("_m0")).drop("_pid", "_mid", "_m0", "_off")
