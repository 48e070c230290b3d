"""What the operators of this subpackage share: the shared folder, written
tables, the word pattern and the shipping of this package to executors."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: A word is a run of anything but space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
#: The same six characters, as text.
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only in local mode, where none is named (as in tests), a temporary folder
    is made and set; elsewhere a missing setting is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="loomspark-"))
    return sc._jsc.sc().getCheckpointDir().get()


#: Paths of the tables written so far, in order.
_made: list[str] = []


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it again.

    This cuts the lineage, survives lost executors, and makes what is
    computed once readable many times.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _made.append(path)
    return spark.read.schema(df.schema).parquet(path)


def running(df: DataFrame, order: list[str], sums: dict[str, Column], name: str) -> DataFrame:
    """``df`` with exclusive running sums along a total order; written.

    Rows are dealt into ranges of the order, as many as the shuffle has
    partitions, and summed within each; only the ranges' totals meet in one task.
    """
    x = written(df.repartitionByRange(*order).withColumns({"_p": F.spark_partition_id(), **{f"_{n}": c for n, c in sums.items()}}), f"{name}-ranges")
    before = W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1)
    totals = x.groupBy("_p").agg(*[F.sum(f"_{n}").alias(n) for n in sums])
    totals = written(totals.select("_p", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_base_{n}") for n in sums]), f"{name}-bases")
    within = W.partitionBy("_p").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    out = [(F.col(f"_base_{n}") + F.coalesce(F.sum(f"_{n}").over(within), F.lit(0))).alias(n) for n in sums]
    return x.join(totals, "_p").select(*df.columns, *out)


def tidied(spark: SparkSession, build: Callable[[], DataFrame], name: str) -> DataFrame:
    """What ``build`` returns, written; the tables that building it wrote are deleted then."""
    since = len(_made)
    out = written(build(), name)
    for path in _made[since:-1]:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    del _made[since:-1]
    return out


class Recent(dict):
    """What one task computes again and again, made by ``make`` when first asked for; of ``most`` bytes or so.

    When half of them are held these become the older half, whose values are taken over when asked for again, so that what recurs stays.
    """

    def __init__(self, make: Callable, most: int = 24 << 20):
        super().__init__()
        self.make, self.most, self.held, self.older = make, most, 0, {}

    def __missing__(self, key):
        value = self.older[key] if key in self.older else self.make(key)
        self.held += 200 + 2 * len(key)
        if self.held > self.most // 2:
            self.older = dict(self)
            self.clear()
            self.held = 0
        self[key] = value
        return value


#: Bytes of text that an operator takes from one Arrow batch at a time.
SLICE = 8 << 20


def slices(batches: Iterator[pa.RecordBatch], most: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``most`` bytes (or one row); at the end of the task unused memory goes back to the system."""
    for b in batches:
        rows = max(1, int(b.num_rows * most / max(b.nbytes, 1))) if b.nbytes > most else max(1, b.num_rows)
        for lo in range(0, max(1, b.num_rows), rows):
            yield b.slice(lo, rows)
    pa.default_memory_pool().release_unused()


def ship(spark: SparkSession) -> None:
    """Give executors this package, once per application."""
    sc = spark.sparkContext
    if getattr(sc, "_loomspark_shipped", False):
        return
    root = Path(__file__).resolve().parent.parent
    folder = tempfile.mkdtemp(prefix="loomspark-")
    to = os.path.join(folder, "loomspark_src.zip")
    with zipfile.ZipFile(to, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(to)  # the driver copies it to where executors fetch it from
    sc._loomspark_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def word_count(c: Column) -> Column:
    """Number of words; null counts as none."""
    return F.coalesce(F.regexp_count(c, F.lit(WORD)), F.lit(0)).cast("long")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until no column of ``df`` has it in any case."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def any_column(c: Column) -> Column:
    """A column as a string, for keys made of columns of any type."""
    return F.coalesce(c.cast("string"), F.lit(""))
