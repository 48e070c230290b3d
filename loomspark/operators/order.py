"""Order-sensitive operators: windows with total orders, and one fold where a window can't do."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..shipping import ship


def epochs(events: DataFrame, group: list[str], kind: str, order: list[str]) -> DataFrame:
    """Lifecycle epochs. ``kind`` is start, terminal or null (no boundary).

    A start while open and a terminal without a start are invalid; the latest
    epoch is closed if the last boundary is a valid terminal.
    """
    x = events.where(F.col(kind).isNotNull())
    w = W.partitionBy(*group).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    s, t = F.sum((F.col(kind) == "start").cast("int")).over(w), F.sum((F.col(kind) == "terminal").cast("int")).over(w)
    x = x.withColumns({"_s": s, "_t": t})
    bad = F.when(F.col(kind) == "start", F.col("_s") - 1 > F.col("_t")).otherwise(F.col("_s") < F.col("_t"))
    x = x.withColumn("_bad", bad)
    return x.groupBy(*group).agg(
        F.count_if(F.col(kind) == "start").alias("starts"),
        F.count_if(F.col(kind) == "terminal").alias("terminals"),
        F.count_if("_bad").alias("invalid"),
        F.max_by((F.col(kind) == "terminal") & ~F.col("_bad"), F.struct(*order)).alias("closed"),
    )


def collapse(events: DataFrame, group: list[str], event: str, at_ms: str, key: str, within_ms: int = 2000) -> DataFrame:
    """Drop an event within ``within_ms`` of the last *kept* row, before or after it, if that is the same event.

    Rows count in order of arrival (``key``); one without a time is kept, and
    so is the next. What is dropped depends on what was kept, so this is a
    fold; each group's rows stream by in order, and only the last kept one is held.
    """
    ship(events.sparkSession)
    names, where = events.columns, [events.columns.index(g) for g in group]
    e, at = events.columns.index(event), events.columns.index(at_ms)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last, when = None, None, None
        for b in batches:
            keep = []
            for row in zip(*(b.column(i).to_pylist() for i in (*where, e, at)), strict=True):
                g, name, t = row[:-2], row[-2], row[-1]
                if g != held:
                    held, last, when = g, None, None
                same = name == last and t is not None and when is not None and abs(t - when) <= within_ms
                keep.append(not same)
                if not same:
                    last, when = name, t
            yield b.filter(pa.array(keep, pa.bool_()))

    return events.repartition(*group).sortWithinPartitions(*group, key).select(*names).mapInArrow(fold, events.schema)


def previous(rows: DataFrame, group: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """The value of the row before."""
    return rows.withColumn(out, F.lag(value).over(W.partitionBy(*group).orderBy(*order)))


def answered(rows: DataFrame, group: str, order: str, opens: Column, answers: Column, out: str) -> DataFrame:
    """Each opening row with whether an answer follows before the next opening row."""
    n = F.sum(opens.cast("int")).over(W.partitionBy(group).orderBy(order).rowsBetween(W.unboundedPreceding, 0))
    x = rows.withColumn("_o", n)
    return x.withColumn(out, F.max(answers).over(W.partitionBy(group, "_o"))).where(opens).drop("_o")


def capture_order(rows: DataFrame, group: str, ts: str, trace: str, ordinal: str, source_order: str, key: str) -> DataFrame:
    """``position`` by time, then native ordinal within a trace, then source order, then id.

    If any time in the group is missing, the whole group falls back to source order.
    """
    timed = F.min(F.col(ts).isNotNull().cast("int")).over(W.partitionBy(group)) == 1
    x = rows.withColumn("_timed", timed)
    # several traces at one time: ordinals of different traces don't compare
    one_trace = F.min(F.coalesce(trace, F.lit(""))).over(W.partitionBy(group, ts)) == F.max(F.coalesce(trace, F.lit(""))).over(W.partitionBy(group, ts))
    x = x.withColumn("_ordinal", F.when(one_trace, F.col(ordinal)))
    by = [F.when(F.col("_timed"), F.col(ts)), F.when(F.col("_timed"), F.col("_ordinal")).asc_nulls_last(), F.col(source_order), F.col(key)]
    return x.withColumn("position", F.row_number().over(W.partitionBy(group).orderBy(*by))).drop("_timed", "_ordinal")


def gaps(rows: DataFrame, group: list[str], number: str) -> DataFrame:
    """Where a sequence of numbers skips: after, next, n_missing."""
    x = rows.select(*group, number).distinct()
    x = x.withColumn("after", F.lag(number).over(W.partitionBy(*group).orderBy(number)))
    return x.where(F.col(number) - F.col("after") > 1).select(*group, "after", F.col(number).alias("next"), (F.col(number) - F.col("after") - 1).cast("long").alias("n_missing"))


def alternating(rows: DataFrame, group: list[str], order: list[str], kind: str) -> DataFrame:
    """Whether boundaries strictly alternate start, terminal, and how many operations that makes."""
    n = F.row_number().over(W.partitionBy(*group).orderBy(*order))
    x = rows.where(F.col(kind).isin("start", "terminal")).withColumn("_ok", F.col(kind) == F.when(n % 2 == 1, "start").otherwise("terminal"))
    g = x.groupBy(*group).agg(F.min("_ok").alias("_all"), F.count("*").alias("_n"))
    return g.select(*group, (F.col("_all") & (F.col("_n") % 2 == 0)).alias("alternates"), F.expr("_n div 2").alias("operations"))


def latest_status(rows: DataFrame, group: list[str], order: list[str], status: str, priority: list[str], out: str) -> DataFrame:
    """Per group the last status of the first kind in ``priority`` that occurs at all; other kinds come after them."""
    rank = F.array_position(F.array(*map(F.lit, priority)), F.col(status))
    x = rows.where(F.col(status).isNotNull()).withColumn("_p", F.when(rank > 0, -rank).otherwise(-len(priority) - 1))
    return x.groupBy(*group).agg(F.max_by(status, F.struct("_p", *order)).alias(out))


def latest(rows: DataFrame, group: list[str], order: list[str], value: Column, out: str) -> DataFrame:
    """The last value that isn't null."""
    return rows.where(value.isNotNull()).groupBy(*group).agg(F.max_by(value, F.struct(*order)).alias(out))


def first_seen(rows: DataFrame, group: list[str], order: list[str], value: str, out: str) -> DataFrame:
    return rows.groupBy(*group).agg(F.min_by(value, F.struct(*order)).alias(out))


def fold_messages(rows: DataFrame, group: str, position: str, identity: str, content: str) -> DataFrame:
    """A3 without its deep merge: snapshots of one conversation, the k-th occurrence of an identity in any snapshot is one message.

    ``messages.merge_messages`` merges by fields. Expressible by windows: occurrences are numbered within their snapshot,
    equal numbers meet, the longest content stays, different ones count as divergences.
    ``rows`` has (group, ``snapshot``, position, identity, content).
    """
    n = F.row_number().over(W.partitionBy(group, "snapshot", identity).orderBy(position))
    g = rows.withColumn("occurrence", n).groupBy(group, identity, "occurrence")
    return g.agg(
        F.min(position).alias("position"),
        F.max_by(content, F.struct(F.length(content), F.col(content))).alias("content"),
        (F.count_distinct(content) - 1).alias("divergences"),
    )
