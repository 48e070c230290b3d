"""Greedy packing by bytes, a recurrence over all rows of a group, in three passes over blocks of rows."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from ..shipping import ship
from .checkpoint import cut

OVERHEAD, FILL = 2048, 0.9


def _summary(need: np.ndarray, limit: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a block's rows: bytes up to each; from a batch that begins at each, how many batches begin after it and what the last of them holds."""
    n, ends = len(need), np.cumsum(need)
    after = np.maximum(np.searchsorted(ends, ends - need + limit, "right"), np.arange(n) + 1)  # where the next batch begins
    more, used = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in range(n - 1, -1, -1):
        j = after[i]
        if j < n:
            more[i], used[i] = more[j] + 1, used[j]
        else:
            used[i] = ends[-1] - ends[i] + need[i]
    return ends, more, used


def pack(rows: DataFrame, group: str, order: str, size: str, most: int, overhead: int = OVERHEAD, fill: float = FILL) -> DataFrame:
    """``batch`` (from 0): as many rows, in order, as fit into ``fill`` of ``most`` bytes with ``overhead`` each; one at least.

    Orders are distinct within a group. A batch index depends on all rows
    before, but a block of rows only on how many bytes the batch holds that
    is open where the block begins. So rows are dealt into ranges once; each
    block states, for every row that may be the first to begin a batch in
    it, how many batches follow and what the last one holds (short, as only
    the first ``most`` bytes of a block can); these statements are folded by
    group; then each block numbers its rows.
    """
    ship(rows.sparkSession)
    limit, integer = most * fill, T.LongType()
    slim = rows.select(group, order, F.col(size).cast("long").alias(size))
    x = cut(slim.repartitionByRange(group, order).withColumn("_block", F.spark_partition_id()))
    kind, names = slim.schema[group], slim.columns

    def state(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable")
        ends, more, used = _summary(pdf[size].to_numpy(np.int64) + overhead, limit)
        first = int(np.searchsorted(ends, limit, "right")) + 1  # no batch that is open before lets more rows in
        at = np.arange(min(first, len(ends)))
        out = pd.DataFrame({"upto": ends[at], "more": more[at], "used": used[at], "total": ends[-1]})
        return out.assign(**{group: pdf[group].iloc[0], "_block": pdf["_block"].iloc[0]})

    fields = [T.StructField(n, integer) for n in ("upto", "more", "used", "total")]
    stated = cut(x.groupBy(group, "_block").applyInPandas(state, T.StructType([*fields, kind, T.StructField("_block", T.IntegerType())])))

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        entry, base, held, batch = [], [], 0, 0
        blocks = pdf.sort_values(["_block", "upto"]).groupby("_block", sort=True)
        for _, b in blocks:
            entry.append(held)
            base.append(batch)
            at = int(np.searchsorted(b["upto"].to_numpy() + held, limit, "right")) if held else 0
            if at < len(b):  # this row begins a batch (the first of all isn't counted as one)
                batch += int(b["more"].iloc[at]) + (1 if held else 0)
                held = int(b["used"].iloc[at])
            else:
                held += int(b["total"].iloc[0])
        return pd.DataFrame({group: pdf[group].iloc[0], "_block": [k for k, _ in blocks], "_held": entry, "_base": base})

    entries = stated.groupBy(group).applyInPandas(fold, T.StructType([kind, T.StructField("_block", T.IntegerType()), T.StructField("_held", integer), T.StructField("_base", integer)]))

    def number(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable")
        held, batch, out = int(pdf["_held"].iloc[0]), int(pdf["_base"].iloc[0]), []
        for need in pdf[size].to_numpy(np.int64) + overhead:
            if held and held + need > limit:
                batch, held = batch + 1, 0
            held += int(need)
            out.append(batch)
        return pdf[names].assign(batch=out)

    joined = x.withColumn("_g", F.col(group)).drop(group).join(entries.withColumnRenamed(group, "_h"), F.col("_g").eqNullSafe(F.col("_h")) & (x["_block"] == entries["_block"]))
    joined = joined.select(F.col("_g").alias(group), order, size, x["_block"], "_held", "_base")
    return joined.groupBy(group, "_block").applyInPandas(number, T.StructType([*slim.schema.fields, T.StructField("batch", integer)]))


def parts(rows: DataFrame, order: list[str], size: str, target: int) -> DataFrame:
    """K2: part numbers by a running sum of bytes, so that no row is split; ``oversize`` where one row exceeds the target.

    Rows are dealt into ranges of the order once, written to the shared folder
    as the ranges must not change, and summed within each; only one total a range is ordered in one task.
    """
    x = cut(rows.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()))
    before = F.sum(size).over(W.partitionBy("_p").orderBy(*order).rowsBetween(W.unboundedPreceding, -1))
    totals = x.groupBy("_p").agg(F.sum(size).alias("_total"))
    base = totals.select("_p", F.coalesce(F.sum("_total").over(W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    x = x.join(base, "_p").withColumn("_at", F.col("_base") + F.coalesce(before, F.lit(0)))
    return x.select(*rows.columns, F.floor(F.col("_at") / target).cast("long").alias("part"), (F.col(size) > target).alias("oversize"))
