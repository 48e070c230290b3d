"""Exact joins whose misses are results too."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def conserve(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row: matched, missing (left only), extra (right only), without_key, duplicate_keys, complete.

    Keys are aggregated on both sides first, so a hot key is one row in the join.
    """
    a = left.groupBy(key).agg(F.count("*").alias("_l"))
    b = right.groupBy(key).agg(F.count("*").alias("_r"))
    both = a.where(F.col(key).isNotNull()).join(b.where(F.col(key).isNotNull()), key, "full")
    counts = both.agg(
        F.count_if(F.col("_l").isNotNull() & F.col("_r").isNotNull()).alias("matched"),
        F.count_if(F.col("_r").isNull()).alias("missing"),
        F.count_if(F.col("_l").isNull()).alias("extra"),
        F.count_if(F.col("_l") > 1).alias("duplicate_keys"),
    )
    none = a.agg(F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("_l"))), F.lit(0)).alias("without_key"))
    out = counts.crossJoin(none)  # one row by one row
    return out.withColumn("complete", F.col("missing") + F.col("without_key") + F.col("duplicate_keys") == 0)


def known_as(column: Column, key: Column, own: Column) -> Column:
    """The condition of a left join ``column = key`` whose rows without ``column`` go by ``own``, a spread value of the same type: none matches, and they don't meet in one task."""
    return (F.coalesce(column, own) == key) & column.isNotNull()


def missing(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.join(right.select(key).distinct(), key, "left_anti")


def pair_calls(calls: DataFrame, results: DataFrame, group: str, call: str) -> DataFrame:
    """Per group: calls, paired (exactly one call and one result), orphan results, duplicates, unresolved, rate."""
    c = calls.groupBy(group, call).agg(F.count("*").alias("_c"))
    r = results.groupBy(group, call).agg(F.count("*").alias("_r"))
    both = c.join(r, [group, call], "full").na.fill(0, ["_c", "_r"])
    out = both.groupBy(group).agg(
        F.sum("_c").alias("calls"),
        F.count_if((F.col("_c") == 1) & (F.col("_r") == 1)).alias("paired"),
        F.count_if((F.col("_c") == 0) & (F.col("_r") > 0)).alias("orphans"),
        F.count_if(F.col("_c") > 1).alias("duplicate_calls"),
        F.count_if(F.col("_r") > 1).alias("duplicate_results"),
        F.count_if((F.col("_c") > 0) & (F.col("_r") == 0)).alias("unresolved"),
    )
    return out.withColumn("rate", F.when(F.col("calls") == 0, F.lit(0.0)).otherwise(F.col("paired") / F.col("calls")))


def definitions_complete(called: DataFrame, defined: DataFrame, group: str, name: str, complete: str) -> DataFrame:
    """Per group: distinct called names, those whose definition is complete, and whether all are.

    Calls and definitions meet in one aggregate, which holds each name once; a null group or name has no definition.
    """
    d = defined.where(F.col(group).isNotNull() & F.col(name).isNotNull()).select(group, name, F.lit(False).alias("_called"), F.col(complete).alias("_ok"))
    every = called.select(group, name, F.lit(True).alias("_called"), F.lit(None).cast(d.schema["_ok"].dataType).alias("_ok")).union(d)
    x = every.groupBy(group, name).agg(F.max("_called").alias("_called"), F.max("_ok").alias("_ok")).where("_called")
    out = x.groupBy(group).agg(F.count("*").alias("called"), F.count_if(F.coalesce("_ok", F.lit(False))).alias("complete"))
    return out.withColumn("all_complete", F.col("called") == F.col("complete"))


def relations(sides: dict[str, tuple[DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Edges (from_id, to_id, relation), one equi-join each on the sides' key; sides have ``id`` and a key column."""
    out = None
    for relation, (a, key_a, b, key_b) in sides.items():
        x = a.where(F.col(key_a).isNotNull()).select(F.col("id").alias("from_id"), F.col(key_a).alias("_k"))
        y = b.where(F.col(key_b).isNotNull()).select(F.col("id").alias("to_id"), F.col(key_b).alias("_k"))
        e = x.join(y, "_k").select("from_id", "to_id", F.lit(relation).alias("relation"))
        out = e if out is None else out.unionByName(e)
    return out.distinct()


def parents(nodes: DataFrame, node: str, parent: str) -> DataFrame:
    """Each node with whether its parent is known: root, resolved or unresolved."""
    known = nodes.select(F.col(node).alias("_p")).distinct()
    x = nodes.join(known, known_as(nodes[parent], known["_p"], nodes[node]), "left")
    state = F.when(F.col(parent).isNull(), "root").when(F.col("_p").isNull(), "unresolved").otherwise("resolved")
    return x.select(*nodes.columns, state.alias("parent_state"))


def coverage(a: DataFrame, b: DataFrame, key: str, refs: str) -> DataFrame:
    """Full join of two views of the same turns; they agree where both exist, counts are equal and references meet."""
    x, y = (d.groupBy(key).agg(F.count("*").alias(n)) for d, n in ((a, "n_a"), (b, "n_b")))
    one = lambda d: d.select(key, F.explode(refs).alias("_ref")).distinct()
    meet = one(a).join(one(b), [key, "_ref"], "left_semi").select(key).distinct().withColumn("_meet", F.lit(True))
    j = x.join(y, key, "full").join(meet, key, "left")
    agree = (F.col("n_a") == F.col("n_b")) & F.col("_meet")
    return j.select(key, F.coalesce("n_a", F.lit(0)).alias("n_a"), F.coalesce("n_b", F.lit(0)).alias("n_b"), F.coalesce(agree, F.lit(False)).alias("agrees"))


def attach(rows: DataFrame, key: str, definitions: DataFrame, columns: list[str]) -> DataFrame:
    """A definition's columns to rows, only where all its versions agree."""
    one = definitions.groupBy(key).agg(*[F.min(c).alias(c) for c in columns], *[(F.count_distinct(c) > 1).alias(f"_x{k}") for k, c in enumerate(columns)])
    clash = " or ".join(f"_x{k}" for k in range(len(columns)))
    return rows.join(one.where(f"not ({clash})").select(key, *columns), key, "left")


def single_parents(edges: DataFrame, child: str, parent: str) -> DataFrame:
    """Child to its parent, and whether it has one only."""
    g = edges.where(f"{child} is not null and {parent} is not null").groupBy(child).agg(F.count_distinct(parent).alias("n_parents"), F.min(parent).alias("parent"))
    return g.select(child, F.when(F.col("n_parents") == 1, F.col("parent")).alias("parent"), "n_parents")
