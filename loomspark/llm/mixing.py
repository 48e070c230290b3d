"""Mixing sources to target weights.

The words of each source form one stream, packed into blocks of a fixed
length. Every output shard draws a multinomial count for each source (each
of its slots draws a source by target share); a slot's index within its
source goes through the source's pseudorandom permutation of block indexes,
and the block with that index is what the slot takes. What the draws of a
source exceed or miss its quota by is settled between sources, so that the
words taken meet the target to within half a block.

All positions come from two-level prefix sums (hashed buckets or ranges, then
rows), so neither a source's documents or shards nor the sources are ever ordered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import running, table, word_count, written

#: Words in a block; slots in an output shard; buckets of the prefix sums; rounds of a permutation.
BLOCK, SLOTS, BUCKETS, ROUNDS = 64, 8192, 4096, 10
BINS = 4096


def source_key(c: Column) -> Column:
    """A source as a key that is never null and sorts by code point, null last."""
    return F.when(c.isNull(), F.lit("z")).otherwise(F.concat(F.lit("s"), c.cast("string")))


def targets(per_source: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """``(sk, source_size)`` to its weight and target, in words.

    Targets are ``weight * level``, but at most ``most`` times the source's
    size; the level is such that they add up to ``share`` of all sizes. That
    is where resharing the excess by weight ends. Sorted by the ratio of cap
    to weight, the capped sources come first, so one running sum finds it.
    """
    n = len(weights)
    x = running(per_source, ["sk"], {"rank": F.lit(1)}, "mix-rank")
    w = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % n + 1).cast("int"))
    x = x.withColumn("weight", w.cast("double")).withColumn("cap", F.col("source_size") * float(most)).drop("rank")
    x = x.withColumn("ratio", F.col("cap") / F.col("weight"))
    x = written(running(x, ["ratio", "sk"], {"capped": F.col("cap"), "lighter": F.col("weight")}, "mix-level"), "mix-capped")
    totals = x.agg(F.sum("source_size").alias("everything"), F.sum("weight").alias("weights"))
    x = x.crossJoin(totals).withColumn("level", (F.col("everything") * float(share) - F.col("capped")) / (F.col("weights") - F.col("lighter")))  # one row
    least = x.where("ratio >= level").agg(F.min(F.struct("ratio", "sk", "level"))["level"].alias("least"))
    x = x.drop("level").crossJoin(least)  # one row
    return x.select("sk", "source_size", "weight", F.least("cap", F.col("weight") * F.col("least")).alias("target"))


def in_interval(points: DataFrame, at: str, intervals: DataFrame, lo: str, hi: str, total: int) -> DataFrame:
    """Join each point to the one interval ``[lo, hi)`` that holds it, by equal bins of ``[0, total)``."""
    width = max(1, -(-total // BINS))
    spread = intervals.where(F.col(hi) > F.col(lo)).withColumn(
        "bin", F.explode(F.sequence(F.expr(f"{lo} div {width}"), F.expr(f"({hi} - 1) div {width}")))
    )
    p = points.withColumn("bin", F.expr(f"{at} div {width}"))
    return p.join(spread, "bin").where((F.col(at) >= F.col(lo)) & (F.col(at) < F.col(hi))).drop("bin")


def permuted(df: DataFrame, index: str, n: str, key: Column, rounds: int = ROUNDS) -> DataFrame:
    """Replace ``index`` by its image under a pseudorandom permutation of ``[0, n)``, one for each key.

    Swap or not: each round pairs x with k - x and swaps by a hash bit of the pair.
    """
    def step(x: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(r, key), F.col(n)) - x, F.col(n))
        bit = F.xxhash64(-1 - r, key, F.greatest(x, other)).bitwiseAND(F.lit(1)) == 1
        return F.when(bit, other).otherwise(x)

    # a fold, as the optimizer would otherwise write every round out twice in the next
    return df.withColumn(index, F.aggregate(F.array(*[F.lit(r) for r in range(rounds)]), F.col(index), step))


def sized(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """One short row for each document, written: uid, doc_id, sk, bucket, size in words."""
    x = docs.select(
        F.monotonically_increasing_id().alias("uid"),
        F.col(doc_id).alias("doc_id"),
        source_key(F.col(source)).alias("sk"),
        F.pmod(F.xxhash64(F.col(doc_id), F.lit("bucket")), F.lit(BUCKETS)).alias("bucket"),
        word_count(F.col(text)).alias("size"),
    )
    return written(x, "mix-sized")


def positions(rows: DataFrame) -> DataFrame:
    """``start``: where a document's words begin in its source's stream."""
    sums = rows.groupBy("sk", "bucket").agg(F.sum("size").alias("words"))
    run = W.partitionBy("sk").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select("sk", "bucket", F.coalesce(F.sum("words").over(run), F.lit(0)).alias("base"))
    order = F.xxhash64("doc_id", F.lit("order")), "doc_id", "size", "uid"
    within = W.partitionBy("sk", "bucket").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return (
        rows.join(sums, ["sk", "bucket"])
        .withColumn("start", F.col("base") + F.coalesce(F.sum("size").over(within), F.lit(0)))
        .drop("base", "bucket")
    )


def slots(per_source: DataFrame, seed: int, block: int = BLOCK, per_shard: int = SLOTS) -> DataFrame:
    """``(sk, source_size, target)`` to the mix: shard, slot, sk and the index of the block it takes."""
    spark = per_source.sparkSession
    s = per_source.where("source_size > 0").withColumn("n_blocks", F.expr(f"(source_size + {block - 1}) div {block}"))
    s = s.withColumn("quota", F.round(F.col("target") / F.col("source_size") * F.col("n_blocks")).cast("long"))
    s = running(s.select("sk", "n_blocks", "quota"), ["sk"], {"lo": F.col("quota")}, "mix-quota")
    s = written(s.withColumn("hi", F.col("lo") + F.col("quota")), "mix-sources")
    total = int(s.agg(F.coalesce(F.sum("quota"), F.lit(0))).first()[0])
    drawn = spark.range(total).select(
        "id",
        F.expr(f"id div {per_shard}").alias("shard"),
        F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(max(total, 1))).alias("u"),
    )
    drawn = in_interval(drawn, "u", s.select("sk", "lo", "hi"), "lo", "hi", total).select("id", "shard", "sk")
    drawn = written(drawn, "mix-drawn")
    counts = drawn.groupBy("sk", "shard").agg(F.count("*").alias("n"))
    counts = written(running(counts, ["sk", "shard"], {"at": F.col("n")}, "mix-counts"), "mix-bases")
    counts = counts.join(counts.groupBy("sk").agg(F.min("at").alias("first")), "sk").select("sk", "shard", (F.col("at") - F.col("first")).alias("base"))
    rank = F.row_number().over(W.partitionBy("sk", "shard").orderBy("id"))
    indexed = drawn.join(counts, ["sk", "shard"]).select("id", "shard", "sk", (F.col("base") + rank - 1).alias("j"))

    # settle: draws beyond a quota go to the sources that fell short of theirs
    tally = s.join(drawn.groupBy("sk").agg(F.count("*").alias("d")), "sk", "left").withColumn("d", F.coalesce("d", F.lit(0)))
    over, under = F.greatest(F.col("d") - F.col("quota"), F.lit(0)), F.greatest(F.col("quota") - F.col("d"), F.lit(0))
    tally = running(tally.select("sk", "n_blocks", "quota", "d"), ["sk"], {"over_lo": over, "lo": under}, "mix-tally")
    tally = written(tally.withColumn("hi", F.col("lo") + under), "mix-settled")
    indexed = indexed.join(tally.select("sk", "quota", "over_lo", "n_blocks"), "sk")
    kept = indexed.where("j < quota").select("id", "shard", "sk", "j", "n_blocks")
    surplus = indexed.where("j >= quota").select("id", "shard", (F.col("over_lo") + F.col("j") - F.col("quota")).alias("g"))
    moved = in_interval(surplus, "g", tally.select("sk", "lo", "hi", "d", "n_blocks"), "lo", "hi", total)
    moved = moved.select("id", "shard", "sk", (F.col("d") + F.col("g") - F.col("lo")).alias("j"), "n_blocks")
    out = kept.union(moved).withColumn("block", F.col("j") % F.col("n_blocks"))
    out = permuted(out, "block", "n_blocks", F.xxhash64(F.lit(seed), F.col("sk")))
    return out.select("shard", F.expr(f"id % {per_shard}").alias("slot"), "sk", "block")


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 7, block: int = BLOCK, per_shard: int = SLOTS) -> DataFrame:
    """How many of its words the mix takes from each document.

    Sources by code point, null last, weigh ``weights``, repeating, and share
    ``share`` of all words; no source gives over ``most`` (a whole number)
    times its size. Every row counts as a document: repeated rows and ids are
    taken each for itself; a null id is an id. Null, empty and blank texts
    have no words, and nothing is taken from them. A text of any length is
    spread over its blocks. An empty table gives no rows. Other columns are
    not looked at. The seed decides the draws; reruns agree.
    """
    rows = sized(docs)
    per_source = targets(rows.groupBy("sk").agg(F.sum("size").alias("source_size")), weights, share, most)
    per_source = written(per_source, "mix-targets")
    takes = slots(per_source, seed, block, per_shard).groupBy("sk", "block").agg(F.count("*").alias("times"))
    x = positions(rows)
    parts = x.where("size > 0").withColumn(
        "block", F.explode(F.sequence(F.expr(f"start div {block}"), F.expr(f"(start + size - 1) div {block}")))
    )
    parts = parts.withColumn(
        "words",
        F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block) - F.greatest("start", F.col("block") * block),
    ).drop("start")
    taken = (
        parts.join(takes, ["sk", "block"], "left")
        .groupBy("uid", "doc_id", "sk", "size")
        .agg(F.coalesce(F.sum(F.col("words") * F.col("times")), F.lit(0)).alias("taken"))
    )
    taken = taken.union(rows.where("size = 0").select("uid", "doc_id", "sk", "size", F.lit(0).cast("long")))
    return taken.join(per_source, "sk").select("doc_id", "size", "source_size", F.coalesce("target", F.lit(0.0)).alias("target"), "taken", "uid")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("uid")
