"""A sink of records with a commit: parts named by their content, and a manifest that makes them count.

``df.write.format("records").option("path", folder).mode("append").save()`` and
``df.writeStream.format("records").option("path", folder)`` have every task write its rows
as JSON lines to a part named by the SHA-256 of what is in it. The driver then publishes one manifest that names
the parts: nothing is there before that, a job that fails takes away its run's parts, and what a task
writes later, or wrote before it was tried again, is in no manifest (``sweep`` deletes it). A stream's manifest has its batch's number, so a batch that is run
again replaces it. ``spark.read.format("records")`` isn't needed: ``read`` opens what the manifests name with Spark's own reader.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import BooleanType, IntegerType, LongType, Row, StringType, StructType

#: Bytes of one part at most, but for a longer record.
PART_BYTES = 64 << 20
#: Types whose values are JSON as they come.
AS_THEY_COME = (StringType, LongType, IntegerType, BooleanType)


_encode = json.JSONEncoder(ensure_ascii=False).encode  # made once: json.dumps makes one for every row


@dataclass
class Written(WriterCommitMessage):
    parts: list[str]
    records: int


def _plain(v):
    if isinstance(v, Row):
        return {k: _plain(x) for k, x in v.asDict().items()}
    if isinstance(v, dict):
        return {str(k): _plain(x) for k, x in v.items()}
    if isinstance(v, (list, tuple)):
        return [_plain(x) for x in v]
    if isinstance(v, (bytes, bytearray)):
        return base64.b64encode(v).decode()
    return v if v is None or isinstance(v, (str, int, float, bool)) else str(v)


class _Folder:
    """What batch and stream writers share: parts by tasks, manifests by the driver."""

    def __init__(self, path: str, names: list[str]):
        self.path, self.names, self.run = path.rstrip("/"), names, uuid.uuid4().hex[:12]

    def _fs(self) -> tuple[pafs.FileSystem, str]:
        return pafs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (pafs.LocalFileSystem(), self.path)

    def _put(self, name: str, data: bytes) -> None:
        """A whole file or none: written beside and moved."""
        fs, base = self._fs()
        fs.create_dir(f"{base}/{name.rsplit('/', 1)[0]}", recursive=True)
        side = f"{base}/{name}.{uuid.uuid4().hex}"
        with fs.open_output_stream(side) as out:
            out.write(data)
        fs.move(side, f"{base}/{name}")

    def _part(self, lines: list[bytes], attempt: str) -> str:
        data = b"".join(lines)
        name = f"parts/{hashlib.sha256(data).hexdigest()}-{self.run}-{attempt}.json"
        self._put(name, data)
        return name

    def write(self, iterator: Iterator[Row]) -> Written:
        return self._write(map(_plain, row) for row in iterator)

    def _write(self, rows: Iterator[Iterable]) -> Written:
        attempt, parts, lines, size, n = uuid.uuid4().hex[:8], [], [], 0, 0
        try:
            for row in rows:
                line = _encode(dict(zip(self.names, row, strict=True))).encode() + b"\n"
                if lines and size + len(line) > PART_BYTES:
                    parts.append(self._part(lines, attempt))
                    lines, size = [], 0
                lines.append(line)
                size += len(line)
                n += 1
            if lines:
                parts.append(self._part(lines, attempt))
        except BaseException:
            self.take_back(parts)  # a task that fails leaves nothing
            raise
        return Written(parts, n)

    def publish(self, name: str, messages: list[Written | None]) -> None:
        done = [m for m in messages if m is not None]
        manifest = {"parts": sorted(p for m in done for p in m.parts), "records": sum(m.records for m in done)}
        self._put(f"manifests/{name}.json", json.dumps(manifest).encode())

    def take_back(self, parts: list[str]) -> None:
        fs, base = self._fs()
        for part in parts:
            if fs.get_file_info(f"{base}/{part}").type != pafs.FileType.NotFound:
                fs.delete_file(f"{base}/{part}")

    def unpublished(self, run: str = "") -> list[str]:
        """Parts, of one run or all, that no manifest names."""
        fs, base = self._fs()
        files = lambda kind: [i.base_name for i in fs.get_file_info(pafs.FileSelector(f"{base}/{kind}", allow_not_found=True))]
        named = set()
        for name in files("manifests"):
            with fs.open_input_stream(f"{base}/manifests/{name}") as f:
                named |= set(json.loads(f.read())["parts"])
        return [f"parts/{n}" for n in files("parts") if f"-{run}" in n and f"parts/{n}" not in named]


class RecordWriter(_Folder, DataSourceWriter):
    def __init__(self, path: str, names: list[str], overwrite: bool):
        super().__init__(path, names)
        self.overwrite = overwrite

    def commit(self, messages: list[Written | None]) -> None:
        fs, base = self._fs()
        old = [i.path for i in fs.get_file_info(pafs.FileSelector(f"{base}/manifests", allow_not_found=True))] if self.overwrite else []
        self.publish(f"batch-{uuid.uuid4().hex}", messages)
        for path in old:
            fs.delete_file(path)

    def abort(self, messages: list[Written | None]) -> None:
        self.take_back(self.unpublished(self.run))


class RecordStreamWriter(_Folder, DataSourceStreamWriter):
    def commit(self, messages: list[Written | None], batchId: int) -> None:  # noqa: N803
        self.publish(f"stream-{batchId:012d}", messages)

    def abort(self, messages: list[Written | None], batchId: int) -> None:  # noqa: N803
        self.take_back(self.unpublished(self.run))


class RecordStreamArrowWriter(RecordStreamWriter, DataSourceStreamArrowWriter):
    """For rows of plain values, which needn't become Spark's rows first."""

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return self._write(row for batch in iterator for row in zip(*[c.to_pylist() for c in batch.columns], strict=True))


class RecordSink(DataSource):
    """Option ``path``: a folder that all executors reach by a scheme that pyarrow knows."""

    @classmethod
    def name(cls) -> str:
        return "records"

    def writer(self, schema: StructType, overwrite: bool) -> RecordWriter:
        return RecordWriter(self.options["path"], schema.names, overwrite)

    def streamWriter(self, schema: StructType, overwrite: bool) -> RecordStreamWriter:  # noqa: N802
        plain = all(isinstance(f.dataType, AS_THEY_COME) for f in schema) and len(schema) > 0
        return (RecordStreamArrowWriter if plain else RecordStreamWriter)(self.options["path"], schema.names)


def parts(spark: SparkSession, path: str) -> DataFrame:
    """(part, manifest) of all that is published."""
    found = spark.read.schema("parts array<string>, records long").option("multiLine", True).json(f"{path.rstrip('/')}/manifests")
    return found.selectExpr("explode(parts) AS part", "input_file_name() AS manifest")


def read(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """The published records; parts of broken runs lie in the folder but aren't opened."""
    names = [r[0] for r in parts(spark, path).select("part").distinct().collect()]  # one per PART_BYTES at least
    reader = spark.read.schema(schema)
    return reader.json([f"{path.rstrip('/')}/{n}" for n in names]) if names else spark.createDataFrame([], schema)


def sweep(path: str) -> int:
    """Delete all parts that no manifest names, left by tasks that were lost; only while nothing writes there."""
    folder = _Folder(path, [])
    left = folder.unpublished()
    folder.take_back(left)
    return len(left)
