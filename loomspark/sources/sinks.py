"""Sinks (K1 to K9): JSON lines, staged publishing, manifests, content-addressed archives, packages.

Files are written by executors through Spark or Hadoop's file systems; the
driver only renames folders and writes one-row manifests.
"""

from __future__ import annotations

import io
import json
import tarfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship

COMMIT = "COMMIT.json"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return fs.exists(p)


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = False) -> None:
    fs, p, _ = _fs(spark, path)
    out = fs.create(p, overwrite)
    out.write(bytearray(text.encode()))
    out.close()


def jsonl(rows: DataFrame, path: str, compression: str = "gzip") -> None:
    """K1."""
    rows.select(F.to_json(F.struct("*")).alias("value")).write.option("compression", compression).text(path)


def publish(spark: SparkSession, target: str, write: Callable[[str], None], verify: Callable[[str], bool], replace: bool = False) -> None:
    """K3: write to a staging folder beside the target, verify it, then rename. A failed run publishes nothing."""
    if exists(spark, target) and not replace:
        raise FileExistsError(target)
    staging = target.rstrip("/") + ".staging"
    fs, s, jvm = _fs(spark, staging)
    fs.delete(s, True)
    try:
        write(staging)
        if not verify(staging):
            raise ValueError(f"{target}: what was written doesn't verify")
        to, old = jvm.org.apache.hadoop.fs.Path(target), jvm.org.apache.hadoop.fs.Path(target.rstrip("/") + ".previous")
        if fs.exists(to):  # kept until the new one is in its place
            fs.delete(old, True)
            if not fs.rename(to, old):
                raise OSError(f"cannot move {target} aside")
        if not fs.rename(s, to):
            if fs.exists(old):
                fs.rename(old, to)
            raise OSError(f"cannot rename {staging}")
        fs.delete(old, True)
    finally:
        fs.delete(s, True)


def manifest(spark: SparkSession, folder: str, pattern: str = "part-*") -> DataFrame:
    """K4: (name, bytes, sha256) of a folder's files, hashed on the executors."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def verify_manifest(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """K4: files that are missing, extra or changed; none where the sets are equal."""
    from ..operators.verify import compare

    return compare(actual, expected, ["name"], ["bytes", "sha256"])


def commit_last(spark: SparkSession, objects: DataFrame, key: str, content: str, target: str) -> int:
    """K5: write objects that aren't there yet, then the commit marker; running it again changes nothing.

    Names come from content hashes, so an object under its name is the object.
    Returns the number written.
    """
    named = objects.select(F.col(key).alias("name"), F.col(content).cast("string").alias("value"), F.sha2(F.col(content).cast("binary"), 256).alias("sha256"))
    if exists(spark, f"{target}/{COMMIT}"):
        return 0
    named.select("sha256", "name", "value").dropDuplicates(["sha256"]).write.mode("overwrite").parquet(f"{target}/objects")
    got = spark.read.parquet(f"{target}/objects")
    n = got.count()
    bad = got.where(F.sha2(F.col("value").cast("binary"), 256) != F.col("sha256")).count()
    if bad:
        raise ValueError(f"{bad} objects don't match their hashes")
    write_text(spark, f"{target}/{COMMIT}", json.dumps({"objects": n}))
    return n


def archive(spark: SparkSession, rows: DataFrame, payload: str, target: str) -> DataFrame:
    """K6: content-addressed segments: distinct payloads under their hash, the checkpoint last. Returns the checkpoint."""
    x = rows.select(F.sha2(payload, 256).alias("sha256"), F.octet_length(payload).cast("long").alias("bytes"), payload).dropDuplicates(["sha256"])
    if exists(spark, f"{target}/segments"):  # running it again adds only what isn't there
        x = x.join(spark.read.parquet(f"{target}/segments").select("sha256"), "sha256", "left_anti").select(*x.columns)
    x.write.mode("append").parquet(f"{target}/segments")
    checkpoint = spark.read.parquet(f"{target}/segments").agg(F.count_distinct("sha256").alias("segments"), F.sum("bytes").alias("bytes"))
    checkpoint.coalesce(1).write.mode("overwrite").json(f"{target}/checkpoint")
    return spark.read.json(f"{target}/checkpoint")


def packages(rows: DataFrame, package: str, name: str, content: str, order: str) -> DataFrame:
    """K7 and K8: one tar.gz a package, as (package, archive binary, files): deterministic, members in order.

    A package is built in one task, streamed from rows sorted by package;
    its size is what the packing has bounded.
    """
    ship(rows.sparkSession)
    x = rows.select(F.col(package).cast("string").alias("package"), F.col(order).alias("o"), F.col(name).cast("string").alias("name"), F.col(content).cast("string").alias("content"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import gzip

        held, buffer, gz, tar, n = None, None, None, None, 0

        def close():
            tar.close()
            gz.close()
            return pa.RecordBatch.from_arrays([pa.array([held]), pa.array([buffer.getvalue()], pa.binary()), pa.array([n], pa.int64())], names=["package", "archive", "files"])

        for b in batches:
            for p, _, member, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if p != held:
                    if held is not None:
                        yield close()
                    held, buffer, n = p, io.BytesIO(), 0
                    gz = gzip.GzipFile(fileobj=buffer, mode="wb", mtime=0)
                    tar = tarfile.open(fileobj=gz, mode="w")
                data = (text or "").encode()
                info = tarfile.TarInfo(member)
                info.size = len(data)
                tar.addfile(info, io.BytesIO(data))
                n += 1
        if held is not None:
            yield close()

    return x.repartition("package").sortWithinPartitions("package", "o", "name").mapInArrow(run, "package string, archive binary, files long")


def dated_packages(rows: DataFrame, date: str, name: str, content: str, order: str, most: int) -> DataFrame:
    """K8: (date, file, archive, files): a date's rows, in order, packed greedily into archives of at most ``most`` bytes, numbered from 0."""
    from ..operators.packing import pack

    x = rows.select(F.col(date).cast("string").alias("date"), F.col(order).alias("o"), F.col(name).alias("n"), F.col(content).alias("c"))
    batches = pack(x.withColumn("size", F.octet_length("c").cast("long")), "date", "o", "size", most).select(F.col("date").alias("_d"), F.col("o").alias("_o"), "batch")
    y = x.join(batches, (x["date"] == batches["_d"]) & (x["o"] == batches["_o"]))
    file = F.format_string("batch_%05d.tar.gz", F.col("batch"))
    y = y.select(F.concat("date", F.lit("/"), file).alias("p"), "n", "c", "o")
    out = packages(y, "p", "n", "c", "o")
    return out.select(F.split("package", "/")[0].alias("date"), F.split("package", "/")[1].alias("file"), "archive", "files")


def otlp(spans: DataFrame, trace: str, span: str, parent: str, name: str, start_ns: Column, end_ns: Column, attributes: str | None = None, resource: dict[str, str] | None = None, scope: str | None = None) -> DataFrame:
    """K9: one OTLP span a row, as JSON text; ``attributes`` is a map of strings, ``resource`` and ``scope`` wrap the span."""
    listed = lambda m: F.transform(F.map_entries(m), lambda e: F.struct(e["key"].alias("key"), F.struct(e["value"].alias("stringValue")).alias("value")))
    fields = [F.col(trace).alias("traceId"), F.col(span).alias("spanId"), F.col(parent).alias("parentSpanId"), F.col(name).alias("name"), start_ns.cast("string").alias("startTimeUnixNano"), end_ns.cast("string").alias("endTimeUnixNano")]
    if attributes:
        fields.append(listed(F.col(attributes)).alias("attributes"))
    body = F.struct(*fields)
    if resource is not None or scope is not None:
        named = F.create_map(*[F.lit(v) for kv in (resource or {}).items() for v in kv]) if resource else F.lit(None).cast("map<string,string>")
        inner = F.struct(F.struct(F.lit(scope).alias("name")).alias("scope"), F.array(body).alias("spans"))
        body = F.struct(F.array(F.struct(F.struct(listed(named).alias("attributes")).alias("resource"), F.array(inner).alias("scopeSpans"))).alias("resourceSpans"))
    return spans.select(F.to_json(body).alias("value"))
