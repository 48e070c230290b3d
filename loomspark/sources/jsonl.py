"""JSON-lines scans (S1 to S6, S11, S12): tolerant or strict, plain, gzip or zstd; usage logs; sealed segments."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship
from pyspark.sql import Window as W

#: Names under which usage logs wrap their rows; names of sealed and open segments.
WRAPPERS = ["items", "usage_logs", "usageLogs", "logs", "data"]
SEGMENT, OPEN_SEGMENT = r"([a-z0-9-]+)-(\d{8,20})\.ndjson$", r"\.open$"


def discover(spark: SparkSession, roots: list[str], pattern: str = "*.{jsonl,ndjson,jsonl.gz,ndjson.gz}", exclude: str | None = None) -> DataFrame:
    """Paths under the roots by name, sorted and distinct."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    files = reader.load(roots).select("path", "length", "modificationTime")  # contents aren't read
    if exclude:
        files = files.where(~F.col("path").contains(exclude))
    return files.dropDuplicates(["path"]).orderBy("path")


def lines(spark: SparkSession, roots: list[str], pattern: str = "*.{jsonl,ndjson,jsonl.gz,ndjson.gz}") -> DataFrame:
    """(path, line): no blank lines, no carriage returns."""
    x = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).text(roots)
    x = x.select(F.col("_metadata.file_path").alias("path"), F.rtrim(F.regexp_replace("value", "\r$", "")).alias("line"))
    return x.where(F.trim("line") != "")


def numbered(spark: SparkSession, roots: list[str], pattern: str = "*.{jsonl,ndjson}") -> DataFrame:
    """S1 with line numbers from 1: files are read whole, so for files that fit an executor's memory."""
    x = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).text(roots, wholetext=True)
    x = x.select(F.col("_metadata.file_path").alias("path"), F.posexplode(F.split("value", "\r?\n")).alias("n", "line"))
    return x.where(F.trim("line") != "").select("path", (F.col("n") + 1).alias("line_no"), "line")


def zstd_lines(spark: SparkSession, roots: list[str], pattern: str = "*.zst", step: int = 1 << 22) -> DataFrame:
    """S1 for zstd, which Spark's text reader may lack: files as bytes, decompressed as a stream in Arrow batches."""
    ship(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(roots).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import io

        import zstandard

        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                reader, rest = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(content), read_across_frames=True), b""
                while chunk := reader.read(step):
                    *whole, rest = (rest + chunk).split(b"\n")
                    found = [x.rstrip(b"\r").decode() for x in whole if x.strip()]
                    if found:
                        yield pa.RecordBatch.from_pydict({"path": [path] * len(found), "line": found})
                if rest.strip():
                    yield pa.RecordBatch.from_pydict({"path": [path], "line": [rest.decode()]})

    return files.mapInArrow(run, "path string, line string")


def tolerant(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Parsed rows (VARIANT ``v``), and the lines that aren't JSON."""
    x = found.withColumn("v", F.try_parse_json("line"))
    return x.where("v is not null").drop("line"), x.where("v is null").drop("v")


def strict(found: DataFrame) -> DataFrame:
    """S3: parsed rows; a malformed line raises, with its path and, where lines are ``numbered``, its number."""
    v, where = F.try_parse_json("line"), [F.lit("malformed JSON in "), F.col("path")]
    if "line_no" in found.columns:
        where += [F.lit(" line "), F.col("line_no").cast("string")]
    bad = F.raise_error(F.concat(*where)).cast("boolean")
    return found.where(F.when(v.isNull(), bad).otherwise(F.lit(True))).select("path", v.alias("v"))


def usage_values(text: DataFrame, column: str = "value") -> DataFrame:
    """Rows of a usage log that is one JSON document or JSON lines; arrays and known wrappers are opened."""
    # JSON lines if every line is JSON of its own, which no line of a longer document's layout is
    parts = F.filter(F.split(column, "\r?\n"), lambda x: F.trim(x) != "")
    docs = text.select(F.col(column).alias("_t"), parts.alias("_p"))
    alone = F.forall("_p", lambda x: F.try_parse_json(x).isNotNull())
    by_line = docs.where(alone).select(F.explode("_p").alias("_l")).select(F.try_parse_json("_l").alias("v"))
    whole = docs.where(~alone).select(F.try_parse_json("_t").alias("v"))
    every = by_line.union(whole).where("v is not null")
    listed = F.from_json(F.to_json("v"), "array<string>")
    opened = F.coalesce(*[F.try_variant_get("v", f"$.{w}", "variant") for w in WRAPPERS], F.col("v"))
    every = every.select(opened.alias("v"))
    is_list = F.schema_of_variant("v").startswith("ARRAY")
    many = every.where(is_list).select(F.explode(listed).alias("_s")).select(F.try_parse_json("_s").alias("v"))
    return every.where(~is_list).union(many).where("v is not null")


def segments(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(path, shard, number) of sealed segments by name; and problems: a shard's numbers skip, an open segment isn't empty, a name is no segment's.

    Empty open segments (``length`` 0, where that column is there) are neither.
    """
    length = F.col("length") if "length" in files.columns else F.lit(1)
    x = files.select("path", F.regexp_extract("path", SEGMENT, 1).alias("shard"), F.regexp_extract("path", SEGMENT, 2).try_cast("long").alias("number"), F.col("path").rlike(OPEN_SEGMENT).alias("open"), length.alias("length"))
    good = x.where("shard != '' and not open").select("path", "shard", "number")
    before = F.lag("number").over(W.partitionBy("shard").orderBy("number"))
    gap = good.withColumn("after", before).where(F.col("number") - F.col("after") != 1).select("path", F.lit("gap").alias("problem"))
    left = x.where("open and length > 0").select("path", F.lit("open"))
    return good, gap.union(left).union(x.where("shard = '' and not open").select("path", F.lit("name")))


def checked(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files (path, content) against a manifest (path, sha256, bytes): ok, hash, missing or extra."""
    x = files.select("path", F.sha2("content", 256).alias("_h"), F.octet_length("content").cast("long").alias("_b"))
    j = x.join(manifest, "path", "full")
    state = F.when(F.col("_h").isNull(), "missing").when(F.col("sha256").isNull(), "extra").when((F.col("_h") != F.col("sha256")) | (F.col("_b") != F.col("bytes")), "hash").otherwise("ok")
    return j.select("path", state.alias("state"))


def page(rows: DataFrame, order: list[str], size: Column, offset: int, limit: int, most_bytes: int) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` of a total order, as many as fit the bytes (one at least)."""
    x = rows.orderBy(*order).offset(offset).limit(limit)
    w = W.orderBy(*order)
    x = x.withColumn("_n", F.row_number().over(w)).withColumn("_b", F.sum(size).over(w.rowsBetween(W.unboundedPreceding, 0)))
    return x.where((F.col("_b") <= most_bytes) | (F.col("_n") == 1)).drop("_n", "_b")


def incremental(rows: DataFrame, key: str, high_water: int | None, overlap: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """The rows above a high-water mark less an overlap, at most ``limit``, and the next mark."""
    x = rows if high_water is None else rows.where(F.col(key) > high_water - overlap)
    x = x.orderBy(key).limit(limit)
    return x, x.agg(F.max(key).alias("high_water"))


def manifest_json(spark: SparkSession, path: str) -> DataFrame:
    """S12."""
    return spark.read.option("multiLine", "true").json(path)


def jdbc_usage(spark: SparkSession, url: str, usage: str, accounts: str, users: str, after: int, limit: int, **options: str) -> DataFrame:
    """S9 and J12 over JDBC: usage with its optional account and user, the next page after an id. The filter is pushed down."""
    read = lambda t: spark.read.format("jdbc").options(url=url, dbtable=t, **options).load()
    u, a, s = read(usage).where(F.col("id") > after), read(accounts), read(users)
    j = u.join(a, u["account_id"] == a["id"], "left").join(s, u["user_id"] == s["id"], "left")
    return j.select(u["*"], F.coalesce(F.nullif(F.trim(a["name"]), F.lit("")), s["name"]).alias("owner")).orderBy(u["id"]).limit(limit)
