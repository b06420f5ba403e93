"""The hourly demand table with snapshot commits.

Layout below the table folder::

    data/batch=<id>/pickup_month=<month>/*.parquet   written once, never changed
    snapshots/<number>.json                          which batch holds which month

A write first puts its rows in a batch folder of its own, which no reader looks
at, and then commits by one rename of a manifest to the next free number.  A
reader takes the highest number and reads exactly the folders it lists.  A write
that fails before the rename leaves the old snapshot as it was; of two writers
that started from the same snapshot the second finds the number taken and gets
:class:`ConcurrentWrite` (its batch is never listed, so it can simply try
again).  No session setting is changed.  The file system's rename has to refuse
an existing target (HDFS does so atomically); on a store without that, writers
must be kept apart by other means.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourglass.functions.time import month_start
from hourglass.operators.upsert import upsert_by_key
from hourglass.schema import MONTH_PARTITION, enforce_schema
from hourglass.sources.table import HOUR, HourlyTable, _fs_delete

BATCH = "batch"


class ConcurrentWrite(RuntimeError):
    """Another writer committed since this one read the table."""


class SnapshotTable(HourlyTable):
    """:class:`HourlyTable` whose writes replace months by one atomic commit.

    ``fetch``, ``read`` and ``upsert`` have the arguments of the plain table.
    """

    # ------------------------------------------------------- file system
    def _hadoop(self, path: str):
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(conf), p

    def _names(self, path: str) -> list[str]:
        fs, p = self._hadoop(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def _read_text(self, path: str) -> str:
        fs, p = self._hadoop(path)
        stream = fs.open(p)
        try:
            return self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    # --------------------------------------------------------- snapshots
    def versions(self) -> list[int]:
        """Numbers of the committed snapshots, oldest first."""
        return [int(n[:-5]) for n in self._names(f"{self.path}/snapshots") if n.endswith(".json") and n[0].isdigit()]

    def _manifest(self, version: int | None = None) -> tuple[int, dict[str, str]]:
        """Number and ``month -> batch`` of a snapshot (default: the newest; 0: nothing written yet)."""
        have = self.versions()
        if version is None:
            version = have[-1] if have else 0
        if version == 0:
            return 0, {}
        if version not in have:
            raise ValueError(f"no snapshot {version} in {self.path}")
        return version, json.loads(self._read_text(f"{self.path}/snapshots/{version:010d}.json"))["months"]

    def _commit(self, base: int, months: dict[str, str]) -> int:
        """Makes ``months`` snapshot ``base + 1``; raises if that number is taken."""
        jvm = self.spark.sparkContext._jvm
        draft, final = f"{self.path}/snapshots/_{uuid.uuid4().hex}.tmp", f"{self.path}/snapshots/{base + 1:010d}.json"
        fs, p = self._hadoop(draft)
        stream = fs.create(p, False)
        try:
            stream.write(bytearray(json.dumps({"months": dict(sorted(months.items()))}).encode()))
        finally:
            stream.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), fs.getConf())
        target = self._hadoop(final)[1]
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(p, target, options)
        except Exception as e:
            fs.delete(p, False)
            if "FileAlreadyExists" in str(e) or base + 1 in self.versions():
                raise ConcurrentWrite(f"snapshot {base + 1} of {self.path} was committed by another writer") from e
            raise
        return base + 1

    # ---------------------------------------------------------------- S3
    def exists(self) -> bool:
        return bool(self.versions())

    def ensure(self) -> "SnapshotTable":
        """Commit an empty first snapshot when there is none; never drops data."""
        if not self.exists():
            try:
                self._commit(0, {})
            except ConcurrentWrite:
                pass  # another writer made the table
        return self

    # ---------------------------------------------------------------- S2
    def scan(self, version: int | None = None) -> DataFrame:
        """Lazy scan of the newest snapshot, or of an earlier one by its number."""
        return self._scan_of(self._manifest(version)[1])

    def _scan_of(self, months: dict[str, str]) -> DataFrame:
        if not months:
            return self.spark.createDataFrame([], self.disk_schema)
        folders = [f"{self.path}/data/{BATCH}={b}/{MONTH_PARTITION}={m}" for m, b in sorted(months.items())]
        disk = T.StructType([*self.disk_schema.fields, T.StructField(BATCH, T.StringType())])
        return self.spark.read.schema(disk).option("basePath", f"{self.path}/data").parquet(*folders).drop(BATCH)

    # ---------------------------------------------------------------- S4
    def _write_batch(self, rows: DataFrame, key: str, clustered: bool = False) -> tuple[str, list[str]]:
        """Rows (with their month) in a new batch folder, clustered by month and
        key (``clustered``: they lie in ranges of keys already) and sorted by key
        inside a file; its id and the months it holds."""
        batch = uuid.uuid4().hex
        folder = f"{self.path}/data/{BATCH}={batch}"
        (
            (rows if clustered else rows.repartitionByRange(MONTH_PARTITION, key))
            .sortWithinPartitions(MONTH_PARTITION, key)
            .write.partitionBy(MONTH_PARTITION)
            .parquet(folder)
        )
        prefix = f"{MONTH_PARTITION}="
        found = [n[len(prefix):] for n in self._names(folder) if n.startswith(prefix)]
        for name in found:
            date.fromisoformat(name)  # a row without an hour has no month and must not be written
        return batch, found

    def write(self, df: DataFrame) -> None:
        """Replace the whole table with ``df`` in one commit."""
        base, _ = self._manifest()
        out = enforce_schema(df, self.schema).withColumn(MONTH_PARTITION, month_start(HOUR))
        batch, months = self._write_batch(out, "key")
        self._commit(base, dict.fromkeys(months, batch))

    # --------------------------------------------------------- U2 + S4
    def upsert(
        self,
        new: DataFrame,
        key: str = "key",
        key_fixes_month: bool = True,
        order_cols: Sequence[str] | None = None,
        update_cols: Sequence[str] | None = None,
        null_keys: str = "error",
    ) -> None:
        """Merge a batch by key; only the months it touches are read and written
        again (every month with ``key_fixes_month=False``), all in one commit."""
        base, months = self._manifest()
        stage = f"{self.path}/data/_stage-{uuid.uuid4().hex}"
        rows = enforce_schema(new, self.schema).withColumn(MONTH_PARTITION, month_start(HOUR))
        try:
            rows.write.partitionBy(MONTH_PARTITION).parquet(stage)
            staged = self.spark.read.schema(self.disk_schema).parquet(stage)
            prefix = f"{MONTH_PARTITION}="
            touched = {n[len(prefix):] for n in self._names(stage) if n.startswith(prefix)}
            if not touched:
                return
            read = {m: b for m, b in months.items() if m in touched or not key_fixes_month}
            merged = upsert_by_key(
                self._scan_of(read), staged, key=key, order_cols=order_cols, update_cols=update_cols, null_keys=null_keys,
                by_range=key_fixes_month, in_order=key_fixes_month,
            )
            batch, written = self._write_batch(merged, key, clustered=key_fixes_month)
        finally:
            _fs_delete(self.spark, stage)
        kept = {m: b for m, b in months.items() if m not in read}
        self._commit(base, {**kept, **dict.fromkeys(written, batch)})

    # ------------------------------------------------------------ upkeep
    def expire(self, keep: int = 1) -> None:
        """Forget all but the newest ``keep`` snapshots and remove the batches
        that none of those lists.  To be run while nobody writes: a batch that
        is not yet committed is listed nowhere."""
        if keep < 1:
            raise ValueError("at least one snapshot is kept")
        have = self.versions()
        listed = {b for v in have[-keep:] for b in self._manifest(v)[1].values()}
        for v in have[:-keep]:
            _fs_delete(self.spark, f"{self.path}/snapshots/{v:010d}.json")
        for name in self._names(f"{self.path}/data"):
            if name.startswith(f"{BATCH}=") and name[len(BATCH) + 1:] not in listed:
                _fs_delete(self.spark, f"{self.path}/data/{name}")
