"""Streams of captures: idempotent acceptance, conflicts, coverage, windows."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..shipping import ship


def captures(spark: SparkSession, folder: str, schema: str, files_per_trigger: int = 64) -> DataFrame:
    """Files as they land; the trigger's bound is the backpressure."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def accept(rows: DataFrame, key: str, ts: str, late: str = "1 hour") -> DataFrame:
    """First of each id within the watermark."""
    return rows.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def judge(rows: DataFrame, key: str, digest: str, idle_ms: int | None = None) -> DataFrame:
    """T2 in full: accepted, duplicate or conflict for every arrival, against all before and within the batch.

    State a key: the digest first seen, kept for good, which alone is exact.
    With ``idle_ms`` it is dropped after that time without an arrival, and a
    later duplicate counts as accepted.
    """

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        first = state.get[0] if state.exists else None
        for pdf in batches:
            status = []
            for d in pdf[digest]:
                status.append("accepted" if first is None else "duplicate" if d == first else "conflict")
                first = d if first is None else first
            yield pd.DataFrame({"id": [str(k[0])] * len(pdf), "digest": pdf[digest].astype(str), "status": status})
        state.update((first,))
        if idle_ms is not None:
            state.setTimeoutDuration(idle_ms)

    ship(rows.sparkSession)
    timeout = GroupStateTimeout.NoTimeout if idle_ms is None else GroupStateTimeout.ProcessingTimeTimeout
    slim = rows.select(key, F.col(digest).cast("string").alias(digest))
    return slim.groupBy(key).applyInPandasWithState(step, "id string, digest string, status string", "first string", "append", timeout)


def coverage(rows: DataFrame, key: str, source: str, ts: str) -> DataFrame:
    """T4: last time and count by source, kept up to date (update or complete mode)."""
    return rows.groupBy(key, source).agg(F.max(ts).alias("last_seen"), F.count("*").alias("n"))


def tumbling(rows: DataFrame, ts: str, width: str, late: str, *keys: str) -> DataFrame:
    return rows.withWatermark(ts, late).groupBy(F.window(ts, width), *keys).agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def sliding(rows: DataFrame, ts: str, width: str, step: str, late: str, *keys: str) -> DataFrame:
    return rows.withWatermark(ts, late).groupBy(F.window(ts, width, step), *keys).agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def sessions(rows: DataFrame, ts: str, gap: str, late: str, *keys: str) -> DataFrame:
    return rows.withWatermark(ts, late).groupBy(F.session_window(ts, gap), *keys).agg(F.count("*").alias("n"))


def records(batches: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """T5: log records of OTLP envelopes (JSON text), and envelopes that can't be read (kept whole)."""
    v = F.try_parse_json(column)
    good = batches.where(v.isNotNull()).select(F.explode(F.from_json(column, "struct<resourceLogs:array<struct<scopeLogs:array<struct<logRecords:array<struct<traceId:string,spanId:string,timeUnixNano:string,attributes:string>>>>>>>").getField("resourceLogs")).alias("r"))
    good = good.select(F.explode("r.scopeLogs").alias("s")).select(F.explode("s.logRecords").alias("l")).select("l.*")
    return good, batches.where(v.isNull())
