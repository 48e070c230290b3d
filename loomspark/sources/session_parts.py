"""K2: a data source that writes lines to compressed parts of a target size, with a manifest.

``write`` deals rows to files as they come: a part ends when its compressed
bytes reach the target, so a session, which is one line, is never split. Tasks
write to folders of their own attempt; what they finished is in their commit
messages, and only that is renamed into place, numbered, and listed in the
manifest, which is written last. A killed task, or a failed job, leaves
nothing but what the next commit or abort deletes.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from ..shipping import ship

NAME, MANIFEST = "session_parts", "manifest.json"


@dataclass
class Part:
    file: str
    records: int
    bytes: int
    uncompressed_bytes: int
    sha256: str


@dataclass
class Written(WriterCommitMessage):
    parts: list[Part]


class _Open:
    """A part that is being written."""

    def __init__(self, fs: pafs.FileSystem, path: str):
        self.out, self.path, self.zip, self.digest = fs.open_output_stream(path, compression=None), path, zlib.compressobj(6, zlib.DEFLATED, 31), hashlib.sha256()
        self.records = self.bytes = self.plain = 0

    def _put(self, data: bytes) -> None:
        if data:
            self.out.write(data)
            self.digest.update(data)
            self.bytes += len(data)

    def add(self, line: bytes) -> None:
        self._put(self.zip.compress(line))
        self.records += 1
        self.plain += len(line)

    def close(self) -> Part:
        self._put(self.zip.flush())
        self.out.close()
        return Part(self.path, self.records, self.bytes, self.plain, self.digest.hexdigest())


class PartsWriter(DataSourceArrowWriter):
    def __init__(self, path: str, target: int, overwrite: bool):
        self.path, self.target, self.overwrite, self.run = path, target, overwrite, uuid.uuid4().hex

    def _fs(self) -> tuple[pafs.FileSystem, str]:
        return pafs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (pafs.LocalFileSystem(), self.path)

    def write(self, batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        fs, root = self._fs()
        task, done, now = TaskContext.get(), [], None
        own = f"{root}/_staging-{self.run}/{task.partitionId():06d}-{task.taskAttemptId()}"
        fs.create_dir(own, recursive=True)
        for b in batches:
            for v in b.column(0):
                line = v.as_py()
                if line is None:
                    continue
                now = now or _Open(fs, f"{own}/{len(done):05d}.jsonl.gz")
                now.add(line.encode("utf-8", "surrogatepass") + b"\n")
                if now.bytes >= self.target:
                    done.append(now.close())
                    now = None
        if now:
            done.append(now.close())
        return Written(done)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, root = self._fs()
        if self.overwrite and fs.get_file_info(f"{root}/{MANIFEST}").type != pafs.FileType.NotFound:
            fs.delete_file(f"{root}/{MANIFEST}")
            fs.delete_dir(f"{root}/data")
        elif fs.get_file_info(f"{root}/{MANIFEST}").type != pafs.FileType.NotFound:
            raise FileExistsError(f"{root}/{MANIFEST}")
        fs.create_dir(f"{root}/data", recursive=True)
        parts = []
        for p in sorted((p for m in messages if m for p in m.parts), key=lambda p: p.file):
            name = f"data/part-{len(parts):06d}.jsonl.gz"
            fs.move(p.file, f"{root}/{name}")
            parts.append(asdict(p) | {"file": name})
        with fs.open_output_stream(f"{root}/{MANIFEST}") as out:
            out.write(json.dumps({"records": sum(p["records"] for p in parts), "parts": parts}).encode())
        # also of failed runs, whose last tasks may have written after their abort
        for x in fs.get_file_info(pafs.FileSelector(root)):
            if x.base_name.startswith("_staging-"):
                fs.delete_dir(x.path)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, root = self._fs()
        if fs.get_file_info(f"{root}/_staging-{self.run}").type != pafs.FileType.NotFound:
            fs.delete_dir(f"{root}/_staging-{self.run}")


class SessionParts(DataSource):
    """``df.write.format("session_parts").option("target", bytes).save(folder)``; ``df`` has one string column."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def writer(self, schema: StructType, overwrite: bool) -> PartsWriter:
        return PartsWriter(self.options["path"], int(self.options.get("target", 128 << 20)), overwrite)


def write_parts(lines: DataFrame, folder: str, target: int, overwrite: bool = False) -> None:
    """Lines (the first column; null ones are left out) to ``folder``; parts reach ``target`` compressed bytes or are the last of their task.

    ``folder`` is a path or URI that Arrow's file systems open. Without
    ``overwrite`` an existing manifest is an error.
    """
    spark = lines.sparkSession
    ship(spark)
    spark.dataSource.register(SessionParts)
    lines.select(lines.columns[0]).write.format(NAME).option("target", target).mode("overwrite" if overwrite else "append").save(folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The listed parts: file, records, bytes, uncompressed_bytes, sha256."""
    x = spark.read.schema("parts array<struct<file:string,records:long,bytes:long,uncompressed_bytes:long,sha256:string>>").option("wholetext", True).json(f"{folder}/{MANIFEST}")
    return x.selectExpr("inline(parts)")
