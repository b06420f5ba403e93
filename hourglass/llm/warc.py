"""WARC archives: deterministic sharded writer, and reader.

Records are range-partitioned and sorted by id.  Each task writes its range as
files of one gzip member per record, rolled by compressed size; headers and
digests are regenerated from the payload.  A file is written under a temporary
name and then moved; the manifest of all files is written last, and readers
take only files that it lists.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.llm.files import commit_file
from hourglass.llm.support import shared_path, text_of

#: Compressed bytes after which a file is closed.
ROLL_BYTES = 8 << 20
#: Fixed values of the format and a fixed date, so that output is reproducible.
VERSION, DATE = "WARC/1.1", "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record as a gzip member; a revisit has no payload."""
    body = b"" if revisit else payload
    head = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}:{payload_digest(payload)}')}>",
        "WARC-Date": DATE,
        "WARC-Target-URI": (url or "").replace("\r", "%0D").replace("\n", "%0A"),
        "WARC-Payload-Digest": f"sha1:{payload_digest(payload)}",
        "WARC-Block-Digest": f"sha1:{payload_digest(body)}",
        "X-Page-Id": "" if page_id is None else str(page_id),
        "X-Payload-Length": str(len(payload)),
        "Content-Type": "text/html; charset=utf-8",
        "Content-Length": str(len(body)),
    }
    if revisit:
        head |= {"WARC-Profile": PROFILE, "X-Refers-To-Page-Id": "" if refers_to is None else str(refers_to)}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return gzip.compress(f"{VERSION}\r\n{lines}\r\n".encode() + body + b"\r\n\r\n", 4, mtime=0)


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """Writes all rows below ``folder`` and returns the manifest (file, records, bytes).

    Of equal payloads of at least ``min_bytes`` bytes, the record with the smallest id is the
    response and the others revisit it.  Null html is an empty payload; a null
    id sorts first and never is the target while its group has another id;
    rows that repeat id and payload: the first is as its id says, the others
    revisit that id.  An empty table gives an empty manifest.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), F.encode(text_of(html_col), "UTF-8").alias("payload"))
    rows = rows.withColumn("sha", F.sha2("payload", 256))
    # Per equal payloads the smallest id; only small rows take part.
    small = rows.filter(F.length("payload") >= min_bytes).select("id", "sha")
    first = small.groupBy("sha").agg(F.min("id").alias("refers"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    marks = small.join(first, "sha").filter("id is null or id <> refers").distinct()
    both = rows.select("id", "sha", F.lit(1).alias("kind"), "url", "payload", F.lit(None).cast("long").alias("refers")).union(
        marks.select("id", "sha", F.lit(0), F.lit(None).cast("string"), F.lit(None).cast("binary"), "refers")
    )
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = both.repartitionByRange(parts, "id").sortWithinPartitions("id", "sha", "kind", "url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number, held, n = TaskContext.get().partitionId(), 0, bytearray(), 0
        mark = last = None

        def close() -> pa.RecordBatch:
            name = commit_file(folder, f"part-{shard:06d}-{number:04d}.warc.gz", bytes(held))
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64()), pa.array([len(held)], pa.int64())], ["file", "records", "bytes"])

        for batch in batches:
            for r in batch.to_pylist():
                key = (r["id"], r["sha"])
                if r["kind"] == 0:
                    mark = (key, r["refers"])
                    continue
                marked = mark is not None and mark[0] == key
                again = key == last and len(r["payload"]) >= min_bytes and r["id"] is not None
                refers = mark[1] if marked else r["id"] if again else None
                held += record(r["id"], r["url"], r["payload"], refers, refers is not None)
                n, last = n + 1, key
                if len(held) >= ROLL_BYTES:
                    yield close()
                    number, held, n = number + 1, bytearray(), 0
        if n:
            yield close()

    manifest = f"{folder}-manifest"
    both.mapInArrow(run, "file string, records long, bytes long").write.parquet(manifest)
    return pages.sparkSession.read.parquet(manifest)


def records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an archive (one gzip member each)."""
    at = 0
    while at < len(data):
        member, parts = zlib.decompressobj(31), []
        while not member.eof:
            parts.append(member.decompress(data[at : at + 65536]))
            at = min(at + 65536, len(data)) - len(member.unused_data)
        text = b"".join(parts)
        head, _, rest = text.partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        yield fields, rest[: int(fields["Content-Length"])]


def read_warc(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """One row per record of the files in the manifest; fails on a block whose digest is wrong."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
    files = files.withColumn("file", F.element_at(F.split("path", "/"), -1)).join(manifest.select("file"), "file", "left_semi").select("content")
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                out = []
                for head, block in records(content.as_py()):
                    if head["WARC-Block-Digest"] != f"sha1:{payload_digest(block)}":
                        raise ValueError(f"damaged record {head['WARC-Record-ID']}")
                    number = {k: int(head[k]) if head.get(k) else None for k in ("X-Page-Id", "X-Refers-To-Page-Id")}
                    out.append(
                        (number["X-Page-Id"], int(head["X-Payload-Length"]), head["WARC-Payload-Digest"][5:], head["WARC-Type"], number["X-Refers-To-Page-Id"], head["WARC-Target-URI"])
                    )
                columns = zip(*out, strict=True)
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
                names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return files.mapInArrow(run, schema)


def archive_pages(pages: DataFrame) -> DataFrame:
    """Writes ``pages`` to a fresh archive in the shared folder and reads it back."""
    folder = shared_path(pages.sparkSession, "warc")
    manifest = write_warc(pages, folder)
    if manifest.isEmpty():
        return pages.sparkSession.createDataFrame([], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string")
    return read_warc(pages.sparkSession, folder, manifest)
