"""V1 and V3: tables compared by trees of multiset digests.

Every row has a digest of all that is compared; digests are summed, which
forgets their order, by ranges of the hash of the row's key, one side with
plus and the other with minus. A range whose sums are nought is equal on both
sides and isn't looked at again; others are opened into smaller ranges, and
only the rows of the smallest ones that differ meet by key. Equal tables cost
one scan and a shuffle of as many rows as there are ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .checkpoint import written

#: Parts of 32 bits of a row's digest that are summed; 2**31 rows fit into a range.
PARTS = 4


def row_digest(*columns: str) -> Column:
    """The SHA-256 of the columns' names and values; nulls are values."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def sums(rows: DataFrame, keys: list[str], sign: int) -> DataFrame:
    """keys, values, ``_digest``, ``_hash`` (of the key) and the digest's parts, all times the side's sign."""
    x = rows.withColumns({"_digest": row_digest(*rows.columns), "_hash": F.xxhash64(*keys), "_sign": F.lit(sign).cast("long")})
    part = lambda k: F.conv(F.substring("_digest", 8 * k + 1, 8), 16, 10).cast("long") * F.col("_sign")
    return x.withColumns({f"_d{k}": part(k) for k in range(PARTS)})


def open_ranges(rows: DataFrame, bits: int) -> DataFrame:
    """The ranges (of 2**bits) in which the sides differ."""
    totals = [F.sum(c).alias(c) for c in ("_sign", *[f"_d{k}" for k in range(PARTS)])]
    x = rows.groupBy(F.shiftrightunsigned("_hash", 64 - bits).alias("_range")).agg(*totals)
    return x.where(" or ".join(f"_d{k} != 0" for k in range(PARTS)) + " or _sign != 0").select("_range")


def differences(actual: DataFrame, expected: DataFrame, keys: list[str], bits: tuple[int, ...] = (12, 22)) -> DataFrame:
    """Rows that are not on both sides equally often: keys, state, differ, and how many rows only each side has.

    Both have the same columns. ``state`` is missing (only expected), extra
    (only actual) or different; ``differ`` names the columns that differ
    where one row stands against one, else it is empty. Keys may be null, and
    may repeat. Equal tables, also empty ones, give no rows.
    """
    both = sums(actual.select(*expected.columns), keys, 1).union(sums(expected, keys, -1))
    for k, b in enumerate(bits):
        # 2**bits rows of eight bytes at most; the first set is small enough to be sent to all tasks
        found = written(open_ranges(both, b), "ranges")
        near = both["_hash"]
        both = both.join(F.broadcast(found) if k == 0 else found, F.shiftrightunsigned(near, 64 - b) == found["_range"], "left_semi")
    net = both.groupBy(*keys, "_digest").agg(F.sum("_sign").alias("_net"), *[F.first(c).alias(c) for c in expected.columns if c not in keys]).where("_net != 0")
    values = [c for c in expected.columns if c not in keys]
    row = F.struct(F.lit(0).alias("_"), *values)
    by = net.groupBy(*keys).agg(
        F.sum(F.when(F.col("_net") > 0, F.col("_net")).otherwise(0)).alias("only_actual"), F.sum(F.when(F.col("_net") < 0, -F.col("_net")).otherwise(0)).alias("only_expected"),
        F.first(F.when(F.col("_net") > 0, row), ignorenulls=True).alias("_a"), F.first(F.when(F.col("_net") < 0, row), ignorenulls=True).alias("_e"),
    )
    state = F.when(F.col("only_actual") == 0, "missing").when(F.col("only_expected") == 0, "extra").otherwise("different")
    names = F.array_compact(F.array(F.lit(None).cast("string"), *[F.when(~F.col(f"_a.{v}").eqNullSafe(F.col(f"_e.{v}")), F.lit(v)) for v in values]))
    one = (F.col("only_actual") == 1) & (F.col("only_expected") == 1)
    return by.select(*keys, state.alias("state"), F.when(one, F.array_join(names, ",")).otherwise("").alias("differ"), "only_actual", "only_expected")
