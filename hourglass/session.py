"""Spark session helpers.

The engine never creates hidden sessions inside operators; callers pass a
``SparkSession`` (or a DataFrame) in.  ``get_spark`` is a convenience for
tests, the bench and notebooks.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_spark(
    master: str | None = None,
    app_name: str = "hourglass",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session configured the way the engine expects.

    - session time zone pinned to UTC (all engine timestamps are
      ``timestamp_ntz``; UTC keeps any zoned intermediate stable),
    - adaptive query execution on, with partition coalescing and skew-join
      splitting, so shuffle sizes follow the data at run time,
    - UI off (no server is opened).
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("HOURGLASS_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared folder and is respected as is.
    Only in a local session where it is unset (tests, the bench) a scratch
    folder is made; elsewhere a missing setting is an error, as a folder of one
    machine would not be seen by the others.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        current = tempfile.mkdtemp(prefix="hourglass-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current
