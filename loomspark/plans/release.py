"""Sessions to a verified release: snapshots, assessment, conservation, parts; and the acceptance row."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import dedup, packing, score, verify


@dataclass
class Release:
    statuses: DataFrame
    conservation: DataFrame
    assessed: DataFrame
    parts: DataFrame


def release(sessions: DataFrame, key: str, group: str, parts: str, order: list[Column], checks: dict[str, Column], weights: dict[str, float], size: str, target: int) -> Release:
    """Dispositions by U6, assessment of what is kept, parts of a target size."""
    statuses = dedup.snapshots(sessions, key, group, parts, order)
    kept = statuses.where("status = 'kept'").drop("status")
    assessed = score.assess(kept, checks, weights)
    numbered = packing.parts(assessed.where("eligible"), [key], size, target)
    return Release(statuses, dedup.conservation(statuses), assessed, numbered)


def acceptance(r: Release, names: list[str], weights: dict[str, float], least_score: float) -> DataFrame:
    """One row: conserved, contract_holds, above_threshold, accepted (all of them)."""
    broken = score.reassess(r.assessed, names, weights).agg(F.count("*").alias("broken"))
    low = r.assessed.where("eligible").agg(F.count_if(F.col("score") < least_score).alias("low"))
    x = r.conservation.crossJoin(broken).crossJoin(low)  # one row each
    x = x.select("conserved", (F.col("broken") == 0).alias("contract_holds"), (F.col("low") == 0).alias("above_threshold"))
    return x.withColumn("accepted", F.col("conserved") & F.col("contract_holds") & F.col("above_threshold"))


def strict_acceptance(row: DataFrame) -> DataFrame:
    return verify.strict(row, {"accepted": F.col("accepted")})
