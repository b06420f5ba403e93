"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.session import ensure_checkpoint_dir

#: Fixed value: the ASCII white space that separates words in all contracts.
WHITE = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below ``spark.checkpoint.dir`` (shared by all machines)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: cuts the
    lineage, survives lost executors, and later jobs read it instead of
    computing it again."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Removes tables made by :func:`materialize` that nothing reads any more."""
    for df in tables:
        context = df.sparkSession.sparkContext
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            path = context._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def work_names(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its columns called ``in0, in1, ...`` by position, and the new
    name of each: no column of a caller, whatever its name, meets a work column."""
    names = [f"in{k}" for k in range(len(docs.columns))]
    return docs.toDF(*names), dict(zip(docs.columns, names, strict=True))


def own_names(names: dict[str, str], without: Iterable[str] = ()) -> list[Column]:
    """The caller's columns under their own names, but for those named in ``without`` (in any case)."""
    left_out = {c.lower() for c in without}
    return [F.col(new).alias(old) for old, new in names.items() if old.lower() not in left_out]


def text_of(text: "str | Column" = "text") -> Column:
    """The text, null counting as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only (every other character stays)."""
    return F.translate(col, UPPER, UPPER.lower())


def binary_values(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def chunks(items: list[bytes], limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """(from, to) index ranges of neighbouring items with about ``limit`` bytes
    in all; an item longer than that stands alone and whole."""
    at, size = 0, 0
    for i, x in enumerate(items):
        if size and size + len(x) > limit:
            yield at, i
            at, size = i, 0
        size += len(x) + 1
    if at < len(items):
        yield at, len(items)
