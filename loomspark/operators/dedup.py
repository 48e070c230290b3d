"""Idempotence, snapshots and conservation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .checkpoint import cut


def idempotent(rows: DataFrame, key: str | list[str], digest: str) -> DataFrame:
    """A2: one row an id: ``n`` rows, ``status`` accepted, duplicate (same bytes) or conflict (different bytes)."""
    keys = [key] if isinstance(key, str) else key
    g = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.count_distinct(digest).alias("kinds"))
    status = F.when(F.col("kinds") > 1, "conflict").when(F.col("n") > 1, "duplicate").otherwise("accepted")
    return g.select(*keys, "n", "kinds", status.alias("status"))


def refuse_conflicts(rows: DataFrame, key: str, digest: str) -> DataFrame:
    """A2, strict: distinct rows by id; an id with different bytes raises when the plan runs."""
    w = W.partitionBy(key)
    bad = F.min(digest).over(w) != F.max(digest).over(w)
    x = rows.withColumn("_n", F.row_number().over(w.orderBy(digest)))
    x = x.withColumn("_ok", F.when(bad, F.raise_error(F.concat(F.lit("one id, different bytes: "), F.col(key).cast("string")))).otherwise(F.lit(True)))
    return x.where("_ok and _n = 1").drop("_n", "_ok")


def contiguous(needle: Column, haystack: Column) -> Column:
    """Whether an array is a contiguous run of another; the empty one always is."""
    last = F.size(haystack) - F.size(needle)
    starts = F.when(last >= 0, F.sequence(F.lit(1), last + 1))
    return F.when(F.size(needle) == 0, True).when(last < 0, False).otherwise(F.exists(starts, lambda i: F.slice(haystack, i, F.size(needle)) == needle))


#: Parts that a group is ordered in before its winners meet.
SALTS = 64


def winners(rows: DataFrame, group: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group by a total order.

    A group's parts, dealt by hash of the row, are ordered first, then their winners, so no task orders a large group.
    """
    names = rows.columns
    x = rows.withColumn("_salt", F.pmod(F.xxhash64(*names), F.lit(SALTS)))
    for keys in ([*group, "_salt"], group):
        x = x.withColumn("_r", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("_r = 1").drop("_r")
    return x.select(*names)


def snapshots(rows: DataFrame, key: str, group: str, parts: str, order: list[Column], digest: str = "digest") -> DataFrame:
    """A disposition for each snapshot of a group.

    exact: the same content is in the group already (by ``order``);
    subset: a contiguous run of a longer kept snapshot of the group;
    repeat: the same content was kept in another group; divergent: kept, but
    not the group's winner; kept: the winner.

    Keys are distinct. A snapshot is held against those that share its part
    which is rarest in the group, not against all that share any; arrays meet only then.
    """
    by = list(order) + [F.asc(key)]
    slim = rows.drop(parts)
    firsts = winners(slim, [group, digest], by).select(F.col(key).alias("_k")).withColumn("_is_first", F.lit(True))
    x = cut(rows.join(firsts, rows[key] == firsts["_k"], "left").drop("_k"))
    distinct = x.where("_is_first").select(F.col(group).alias("g"), F.col(key).alias("k"), F.col(parts).alias("p"), F.size(parts).alias("n"))
    lines = cut(distinct.select("g", "k", "n", F.explode(F.array_distinct("p")).alias("part")))
    often = lines.groupBy("g", "part").agg(F.count("*").alias("often"))
    rarest = lines.join(often, ["g", "part"]).where("often > 1").groupBy("g", "k", "n").agg(F.min_by("part", F.struct("often", "part")).alias("part"), F.count("*").alias("shared"), F.min("often").alias("often"))
    # a snapshot with a part that no other has is no run of another
    whole = lines.groupBy("k").agg(F.count("*").alias("all"))
    rarest = rarest.join(whole, "k").where("shared = all").drop("shared", "all", "often")
    holders = lines.select("g", "part", F.col("k").alias("k2"), F.col("n").alias("n2"))
    pairs = rarest.join(holders, ["g", "part"]).where("k != k2 and n2 > n").select("k", "k2")
    arrays = distinct.select("k", "p")
    met = pairs.join(arrays, "k").join(arrays.select(F.col("k").alias("k2"), F.col("p").alias("p2")), "k2")
    inside = met.where(contiguous(F.col("p"), F.col("p2"))).select(F.col("k").alias("_i")).distinct().withColumn("_inside", F.lit(True))
    y = cut(x.join(inside, x[key] == inside["_i"], "left").drop("_i", parts))
    left = y.where("_is_first and _inside is null")
    best = cut(winners(left.drop("_is_first", "_inside"), [group], by).select(F.col(key).alias("_w"), F.col(digest).alias("_d"), F.col(group).alias("_g")))
    first_group = best.groupBy("_d").agg(F.min("_g").alias("_first_group"))
    z = y.join(best.select("_w"), y[key] == best["_w"], "left").join(first_group, y[digest] == first_group["_d"], "left")
    status = (
        F.when(F.col("_is_first").isNull(), "exact")
        .when(F.col("_inside").isNotNull(), "subset")
        .when(F.col("_w").isNull(), "divergent")
        .when(F.col(group) != F.col("_first_group"), "repeat")
        .otherwise("kept")
    )
    judged = z.select(F.col(key).alias("_j"), status.alias("status"))
    return rows.join(judged, rows[key] == judged["_j"]).drop("_j")


def conservation(statuses: DataFrame, status: str = "status") -> DataFrame:
    """One row: input, the count of each status, and whether they add up."""
    kinds = ["exact", "subset", "repeat", "divergent", "kept"]
    counts = [F.count_if(F.col(status) == k).alias(k) for k in kinds]
    out = statuses.agg(F.count("*").alias("input"), *counts)
    return out.withColumn("conserved", F.col("input") == sum((F.col(k) for k in kinds), F.lit(0)))


def line_parts(text: Column) -> Column:
    return F.transform(F.split(text, "\n"), lambda x: F.sha2(x, 256))
