"""S9 and S10 as a stream: a table that grows by ids, read page by page above a high-water mark.

The offset is the highest id read. A page holds at most ``limit`` new rows,
and besides them those of the last ``overlap`` ids again, as rows with lower
ids may become visible late; ``usage_stream`` lets every id through once. A
query that restarts goes on from its checkpoint: a page that it had begun is
read again between the same ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.types import StructType

from ..shipping import ship

NAME = "usage_pages"


class PageReader(SimpleDataSourceStreamReader):
    def __init__(self, options: dict, columns: list[str]):
        self.path, self.key, self.columns = options["path"], options["key"], columns
        self.limit, self.overlap, self.start = int(options.get("limit", 1000)), int(options.get("overlap", 0)), int(options.get("start", 0))

    def _rows(self, after: int, upto: int | None) -> pa.Table:
        """Rows with ids above ``after``, up to ``upto``, by id. Files and columns that aren't needed are passed over."""
        fs, path = pafs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (pafs.LocalFileSystem(), self.path)
        found = ds.dataset(path, filesystem=fs, format="parquet", exclude_invalid_files=True)
        where = pc.field(self.key) > after
        where = where if upto is None else where & (pc.field(self.key) <= upto)
        return found.to_table(columns=self.columns, filter=where).sort_by(self.key)

    def _tuples(self, t: pa.Table) -> Iterator[tuple]:
        return zip(*(c.to_pylist() for c in t.columns), strict=True) if t.num_rows else iter(())

    def initialOffset(self) -> dict:
        return {"id": self.start}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        new = self._rows(start["id"], None)
        if not new.num_rows:
            return iter(()), start
        end = {"id": new[self.key][min(self.limit, new.num_rows) - 1].as_py()}
        return self.readBetweenOffsets(start, end), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return self._tuples(self._rows(start["id"] - self.overlap, end["id"]))

    def commit(self, end: dict) -> None:
        pass


class UsagePages(DataSource):
    """``spark.readStream.format("usage_pages").schema(...).option("key", id).option("limit", n).option("overlap", n).load(folder)``."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def simpleStreamReader(self, schema: StructType) -> PageReader:
        return PageReader(self.options, schema.fieldNames())


def usage_stream(spark: SparkSession, folder: str, schema: StructType | str, key: str, limit: int = 1000, overlap: int = 100, start: int = 0) -> DataFrame:
    """Every row above ``start`` once, in pages of ``limit`` new ids; ids are integers and distinct. A row with a null id is never read.

    A row that becomes visible with an id below the high-water mark is found
    if it is within ``overlap`` of it. ``folder`` holds Parquet files and is a
    path or URI that Arrow's file systems open.
    """
    ship(spark)
    spark.dataSource.register(UsagePages)
    x = spark.readStream.format(NAME).schema(schema).option("key", key).option("limit", limit).option("overlap", overlap).option("start", start).load(folder)
    return x.dropDuplicates([key])
