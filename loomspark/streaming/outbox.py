"""A table kept by upserts from a stream, as a log that is merged.

Every epoch writes the newest row of each of its keys as a delta, dealt into
buckets by the key's hash. A merge folds the open deltas into new versions of
the buckets that they touch, and then writes a ledger: which version each
bucket has, and up to which epoch deltas are in them. The ledger's rename is
the commit: before it, readers see the old versions and the open deltas,
afterwards the new versions. A read touches the buckets and what isn't merged
yet, never the history.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Ledgers that are kept for readers that still use them.
KEPT = 2


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def ledger(spark: SparkSession, target: str) -> dict:
    """The last ledger: its number, ``upto`` (the last epoch merged) and ``versions`` of the buckets."""
    names = [n for n in _names(spark, f"{target}/ledger") if n.endswith(".json")]
    if not names:
        return {"number": 0, "upto": -1, "versions": {}}
    return json.loads(spark.read.option("wholetext", True).text(f"{target}/ledger/{names[-1]}").first()[0])


def _delta(target: str, epoch: int) -> str:
    return f"{target}/delta/epoch={epoch:012d}"


def open_epochs(spark: SparkSession, target: str, upto: int) -> list[int]:
    found = [int(n.split("=")[1]) for n in _names(spark, f"{target}/delta") if n.startswith("epoch=")]
    fs, _ = _fs(spark, target)
    return [e for e in found if e > upto and fs.exists(_fs(spark, f"{_delta(target, e)}/_SUCCESS")[1])]


def _newest(x: DataFrame, key: str, order: str, *more: str) -> DataFrame:
    """The row of each key with the greatest (order, epoch)."""
    row = F.struct(*[c for c in x.columns if c not in more])
    return x.groupBy(key, *more).agg(F.max_by(row, F.struct(F.col(order), F.col("_epoch"))).alias("r")).select("r.*", *more)


def upsert(target: str, key: str, order: str, buckets: int = 64, merge_after: int = 16) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` sink: the newest row of each key stays. An epoch may run again: it replaces its own delta, and one that is merged already is passed over.

    After ``merge_after`` open epochs they are merged. Of rows with equal
    order that of the later epoch counts. A null key is a key.
    """

    def write(df: DataFrame, epoch: int) -> None:
        spark = df.sparkSession
        if epoch <= ledger(spark, target)["upto"]:
            return
        x = df.withColumns({"_epoch": F.lit(epoch).cast("long"), "_bucket": bucket_of(key, buckets)})
        _newest(x, key, order, "_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(_delta(target, epoch))
        if len(open_epochs(spark, target, ledger(spark, target)["upto"])) >= merge_after:
            merge(spark, target, key, order)

    return write


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _rows(spark: SparkSession, target: str, said: dict, only: list[str] | None = None) -> DataFrame | None:
    """Rows of the buckets' versions and of open deltas, with their bucket."""
    versions = {b: v for b, v in said["versions"].items() if only is None or b in only}
    paths = [f"{target}/base/{v}" for v in sorted(set(versions.values()))]
    epochs = open_epochs(spark, target, said["upto"])
    parts = []
    if paths:
        base = spark.read.option("basePath", f"{target}/base").parquet(*paths)
        # a version folder holds the buckets of one merge, of which some may have newer ones
        current = F.create_map(*[F.lit(x) for b, v in versions.items() for x in (int(b), v.split("=")[1])])
        parts.append(base.where(F.col("version") == F.try_element_at(current, F.col("_bucket"))).drop("version"))
    if epochs:
        parts.append(spark.read.option("basePath", f"{target}/delta").parquet(*[_delta(target, e) for e in epochs]).drop("epoch"))
    if not parts:
        return None
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def merge(spark: SparkSession, target: str, key: str, order: str) -> bool:
    """Fold the open deltas into new versions of the buckets that they touch; whether there were any. A merge that dies leaves all as it was."""
    said = ledger(spark, target)
    epochs = open_epochs(spark, target, said["upto"])
    if not epochs:
        return False
    touched = sorted({n.split("=")[1] for e in epochs for n in _names(spark, _delta(target, e)) if n.startswith("_bucket=")})
    version = f"version={said['number'] + 1:08d}-{uuid.uuid4().hex[:8]}"
    if touched:
        x = _rows(spark, target, said, touched)
        _newest(x, key, order, "_bucket").write.partitionBy("_bucket").parquet(f"{target}/base/{version}")
    new = {"number": said["number"] + 1, "upto": max(epochs), "versions": said["versions"] | {b: version for b in touched}}
    fs, at = _fs(spark, f"{target}/ledger/.{version}.tmp")
    out = fs.create(at, True)
    out.write(bytearray(json.dumps(new).encode()))
    out.close()
    if not fs.rename(at, _fs(spark, f"{target}/ledger/{new['number']:012d}.json")[1]):
        raise FileExistsError(f"another merge wrote ledger {new['number']} of {target}")
    return True


def vacuum(spark: SparkSession, target: str) -> int:
    """Delete deltas that are merged, and versions and ledgers that the last ``KEPT`` ledgers don't name; how many folders and files went. For when no reader is older than these."""
    names = [n for n in _names(spark, f"{target}/ledger") if n.endswith(".json")]
    kept = [json.loads(spark.read.option("wholetext", True).text(f"{target}/ledger/{n}").first()[0]) for n in names[-KEPT:]]
    used, upto = {v for k in kept for v in k["versions"].values()}, min((k["upto"] for k in kept), default=-1)
    gone = [f"ledger/{n}" for n in names[:-KEPT]] + [f"base/{n}" for n in _names(spark, f"{target}/base") if n.startswith("version=") and n not in used]
    gone += [f"delta/{n}" for n in _names(spark, f"{target}/delta") if n.startswith("epoch=") and int(n.split("=")[1]) <= upto]
    for g in gone:
        fs, p = _fs(spark, f"{target}/{g}")
        fs.delete(p, True)
    return len(gone)


def read_latest(spark: SparkSession, target: str, key: str, order: str) -> DataFrame:
    """The newest row of each key, from the buckets and the open deltas."""
    x = _rows(spark, target, ledger(spark, target))
    if x is None:
        raise FileNotFoundError(target)
    return _newest(x, key, order, "_bucket").drop("_epoch", "_bucket")


def due(rows: DataFrame, now_ms: Column) -> DataFrame:
    """Deliveries to attempt: pending ones whose time has come, and those in flight whose lease has run out."""
    return rows.where(((F.col("state") == "pending") & (F.col("next_attempt_ms") <= now_ms)) | ((F.col("state") == "inflight") & (F.col("lease_until_ms") <= now_ms)))


def claimed(rows: DataFrame, now_ms: Column, lease_ms: int) -> DataFrame:
    """``due`` deliveries as they are claimed: in flight, one attempt more, leased; to be upserted."""
    return due(rows, now_ms).withColumns({"state": F.lit("inflight"), "attempts": F.col("attempts") + 1, "lease_until_ms": now_ms + lease_ms})
