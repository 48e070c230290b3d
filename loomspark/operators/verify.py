"""Verification: results computed again and compared as tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compare(actual: DataFrame, expected: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """V1 and V3: full outer compare; rows that are missing, extra or different, with the columns that differ."""
    a = actual.select(*keys, *[F.col(v).alias(f"a_{v}") for v in values], F.lit(True).alias("_a"))
    e = expected.select(*keys, *[F.col(v).alias(f"e_{v}") for v in values], F.lit(True).alias("_e"))
    j = a.join(e, keys, "full")
    differ = F.array_compact(F.array(*[F.when(~F.col(f"a_{v}").eqNullSafe(F.col(f"e_{v}")), F.lit(v)) for v in values]))
    state = F.when(F.col("_a").isNull(), "missing").when(F.col("_e").isNull(), "extra").when(F.size(differ) > 0, "different").otherwise("equal")
    return j.select(*keys, state.alias("state"), F.array_join(differ, ",").alias("differ")).where("state != 'equal'")


def contract(rows: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """1.3: valid rows, and violations with the names of the rules that fail (null fails)."""
    failed = F.array_compact(F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()]))
    x = rows.withColumn("violations", failed)
    return x.where(F.size("violations") == 0).drop("violations"), x.where(F.size("violations") > 0)


def strict(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """1.3, strict: raises when the plan runs over a row that breaks a rule."""
    bad = reduce(lambda a, b: F.coalesce(a, b), [F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()])
    ok = F.when(bad.isNotNull(), F.raise_error(F.concat(F.lit("contract broken: "), bad))).otherwise(F.lit(True))
    return rows.where(ok.cast("boolean"))


def selected(rows: DataFrame, session: tuple[str, str] | None = None, task: tuple[str, str] | None = None) -> DataFrame:
    """The rows of one session or of one task, given as (column, value); both at once, neither, and nothing found are errors."""
    if (session is None) == (task is None):
        raise ValueError("give a session or a task, not both")
    column, value = session or task
    found = rows.where(F.col(column) == value)
    if found.isEmpty():
        raise LookupError(f"no row has {column} = {value}")
    return found


def set_equal(a: DataFrame, b: DataFrame) -> DataFrame:
    """U4: one row: how many rows are only in a, only in b, and whether the sets are equal."""
    x, y = a.distinct().withColumn("_s", F.lit(1)), b.distinct().withColumn("_s", F.lit(2))
    g = x.union(y).groupBy(*a.columns).agg(F.sum("_s").alias("_s"))
    return g.agg(F.count_if(F.col("_s") == 1).alias("only_a"), F.count_if(F.col("_s") == 2).alias("only_b")).withColumn("equal", F.col("only_a") + F.col("only_b") == 0)


def monotone(rows: DataFrame, baseline: DataFrame, key: str, counters: list[str]) -> DataFrame:
    """V6: counters that fell below their baseline; a key that isn't there any more has lost all that it had."""
    j = baseline.select(key, *[F.col(c).alias(f"_b_{c}") for c in counters]).join(rows.select(key, *counters), key, "left")
    fell = F.array_compact(F.array(*[F.when(F.coalesce(F.col(c), F.lit(0)) < F.col(f"_b_{c}"), F.lit(c)) for c in counters]))
    return j.select(key, F.array_join(fell, ",").alias("fell")).where("fell != ''")


def blocking(rows: DataFrame, baseline: DataFrame, key: str, counters: list[str], rules: dict[str, Column]) -> DataFrame:
    """V6: (key, reasons): why a key may not go on: rules that it breaks and counters that fell; keys without a reason don't appear."""
    _, bad = contract(rows, rules)
    broken = bad.select(key, F.explode("violations").alias("reason"))
    fell = monotone(rows, baseline, key, counters).select(key, F.explode(F.split("fell", ",")).alias("c")).select(key, F.concat(F.lit("fell:"), "c"))
    return broken.union(fell).groupBy(key).agg(F.array_join(F.sort_array(F.collect_set("reason")), ",").alias("reasons"))
