"""Usage analytics: roll-ups, nearest-rank percentiles, timelines that keep empty slots, settlement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .graph import components


def model_stats(rows: DataFrame, model: str, tokens: str, ok: Column) -> DataFrame:
    """A14."""
    return rows.groupBy(model).agg(F.count("*").alias("requests"), F.sum(tokens).alias("tokens"), F.count_if(ok).alias("succeeded")).orderBy(F.desc("tokens"), model)


def roll_up(rows: DataFrame, day: Column, month: Column, tokens: str) -> DataFrame:
    """Totals by day, by month and overall, in one pass of grouping sets."""
    x = rows.select(day.alias("day"), month.alias("month"), F.col(tokens).alias("_t"))
    g = x.groupingSets([["day", "month"], ["month"], []], "day", "month").agg(F.count("*").alias("requests"), F.sum("_t").alias("tokens"), F.grouping_id().alias("_g"))
    level = F.when(F.col("_g") == 0, "day").when(F.col("_g") == 2, "month").otherwise("all")
    return g.select(level.alias("level"), "day", "month", "requests", "tokens")


def nearest_rank(column: str, p: float) -> Column:
    """The value at rank ceil(p n) of a column."""
    return F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY `{column}`)")


def finite_mean(c: Column) -> Column:
    """Mean of the finite values; null if there are none."""
    d = c.cast("double")
    return F.avg(F.when(F.isnan(d) | (F.abs(d) == float("inf")), None).otherwise(d))


def uptime(rows: DataFrame, ts_s: Column, ok: Column, start: int, width_s: int, buckets: int) -> DataFrame:
    """Fixed equal buckets over a span, empty ones kept; status by ratio: up from 0.97, degraded from 0.90, else down."""
    spark = rows.sparkSession
    b = F.floor((ts_s - start) / width_s).cast("long")
    g = rows.select(b.alias("bucket"), ok.alias("_ok")).where(F.col("bucket").between(0, buckets - 1)).groupBy("bucket").agg(F.count("*").alias("n"), F.count_if("_ok").alias("good"))
    every = spark.range(buckets).withColumnRenamed("id", "bucket")
    x = every.join(g, "bucket", "left").na.fill(0, ["n", "good"])
    share = F.col("good") / F.col("n")
    return x.withColumn("status", F.when(F.col("n") == 0, "empty").when(share >= 0.97, "up").when(share >= 0.90, "degraded").otherwise("down"))


def daily(rows: DataFrame, day: Column, first: str, last: str, values: dict[str, Column]) -> DataFrame:
    """One row a day, empty days too."""
    spark = rows.sparkSession
    g = rows.groupBy(day.alias("day")).agg(*[c.alias(n) for n, c in values.items()])
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("day"))
    return days.join(g, "day", "left")


def channel_health(rows: DataFrame, channel: str, model: str, latency: str, ok: Column, tokens: str) -> tuple[DataFrame, DataFrame]:
    """Per channel totals, share of success, mean and 95th percentile of finite latencies; and its models ranked by requests, tokens and name."""
    x = rows.select(channel, model, F.col(latency).cast("double").alias("_l"), ok.alias("_ok"), F.col(tokens).alias("_t"))
    finite = F.when(~F.isnan("_l") & (F.abs("_l") != float("inf")), F.col("_l"))
    x = x.withColumn("_f", finite)
    totals = x.groupBy(channel).agg(F.count("*").alias("requests"), F.count_if("_ok").alias("succeeded"), F.sum("_t").alias("tokens"), F.avg("_f").alias("mean_latency"), nearest_rank("_f", 0.95).alias("p95_latency"))
    per = x.groupBy(channel, model).agg(F.count("*").alias("requests"), F.sum("_t").alias("tokens"))
    rank = F.row_number().over(W.partitionBy(channel).orderBy(F.desc("requests"), F.desc("tokens"), model))
    return totals, per.withColumn("rank", rank)


def settle(rows: DataFrame, key: str, ids: str, fields: list[str], order: str) -> DataFrame:
    """A4: rows that share any id settle once: first present value by order; disagreement is a conflict.

    Components are found over (row, id) edges, so chains of shared ids join.
    """
    wide = rows.select(key, F.explode(ids).alias("_id"))
    least = wide.groupBy("_id").agg(F.min(key).alias("_lead"))
    edges = wide.join(least, "_id").select(F.col(key).alias("a"), F.col("_lead").alias("b"))
    of = components(edges, "a", "b")
    x = rows.join(of, rows[key] == of["node"], "left").withColumn("component", F.coalesce("component", key))
    g = x.groupBy("component").agg(
        F.count("*").alias("rows"),
        *[F.min_by(f, F.when(F.col(f).isNotNull(), F.struct(order, key))).alias(f) for f in fields],
        *[(F.count_distinct(f) > 1).alias(f"{f}_conflict") for f in fields],
    )
    return g


def top(rows: DataFrame, by: str, tie: str, k: int) -> DataFrame:
    """O2: a total order, then the first k."""
    return rows.orderBy(F.desc(by), tie).limit(k)


def keyset_page(rows: DataFrame, key: str, after: int, limit: int) -> DataFrame:
    """The next page after a key."""
    return rows.where(F.col(key) > after).orderBy(key).limit(limit)


def watchdog(rows: DataFrame, ts: str, ok: Column) -> DataFrame:
    """A21."""
    return rows.agg(F.count("*").alias("checks"), F.count_if(ok).alias("passed"), F.max(ts).alias("last_check"), F.max_by(ok, ts).alias("last_ok"))
