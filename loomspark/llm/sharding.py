"""Sharding by k-d tree partitioning.

Documents are points in a space of metadata (place of the id, size, language,
source). A node that is to hold m shards is split along its widest dimension
at the weighted median, or rather at the share of bytes that half of its
shards need, until every leaf is one shard of the target size.

Medians are found together for all nodes of a level: a histogram of at most
1024 bins a node goes to the driver (at most nodes x bins short rows, however
large the input), and the bin that holds the median is refined until it holds
one unit or a fortieth of a shard. Equal texts are one unit and stay together;
only where they exceed a shard by themselves are they dealt by id into pieces.
As units may be large, cuts alone leave leaves uneven, so these are levelled:
units of an eighth of a shard or more go, the heaviest first, to leaves with few
of such, and small units of leaves above the level move to leaves below it, in
passes over ever smaller units, found by prefix sums.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import table, written

DIMS = ("c_id", "c_size", "c_lang", "c_source")
#: Bits of a coordinate, of the tie-break behind it, and of a histogram step; pieces of a group above a shard, in each shard's worth; buckets of prefix sums.
COORD, TIE, STEP, PIECES, BUCKETS = 20, 42, 10, 20, 256
#: Part of a shard that a cut may miss the median by; parts of a shard that units moved in each levelling pass may weigh.
ENOUGH, PASSES = 1 / 40, (1 / 8, 1 / 32, 1 / 128, 1 / 512)
#: Units of this part of a shard or more are placed one by one; there are at most ``1 / LARGE`` of them to a shard.
LARGE = 1 / 8


@dataclass
class Node:
    """A node holds shards first .. first + n - 1; split at key < cut of dimension dim."""

    first: int
    n: int
    dim: int | None = None
    cut: int = 0
    left: Node | None = None
    right: Node | None = None


def _lits(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def _nth(array: Column, n: Column) -> Column:
    """From 0."""
    return F.element_at(array, (n + 1).cast("int"))


def _key(dim: Column) -> Column:
    """Of a unit, along a dimension given as a column: the coordinate, then the tie-break."""
    return F.shiftleft(_nth(F.array(*DIMS), dim), TIE).bitwiseOR(F.col("tie"))


def _place(root: Node) -> Column:
    """Of a unit: the first shard of the open node or leaf that it lies in, by a walk down the tree."""
    nodes = [root]
    for x in nodes:
        nodes += [x.left, x.right] if x.left else []
    where = {id(x): i for i, x in enumerate(nodes)}
    left = _lits([where[id(x.left)] if x.left else i for i, x in enumerate(nodes)])
    right = _lits([where[id(x.right)] if x.left else i for i, x in enumerate(nodes)])
    dims, cuts = _lits([x.dim or 0 for x in nodes]), _lits([x.cut for x in nodes])
    depth = lambda x: 1 + max(depth(x.left), depth(x.right)) if x.left else 0
    step = lambda at, _: F.when(_key(_nth(dims, at)) < _nth(cuts, at), _nth(left, at)).otherwise(_nth(right, at))
    end = F.aggregate(_lits([*range(depth(root))]), F.lit(0).cast("long"), step) if root.left else F.lit(0)
    return _nth(_lits([x.first for x in nodes]), end)


def _leaves(node: Node) -> list[Node]:
    return [node] if node.left is None else _leaves(node.left) + _leaves(node.right)


def grow(units: DataFrame, n_shards: int, enough: float) -> Node:
    """The tree over ``units`` (DIMS, tie, weight); a median is exact to ``enough`` bytes or one unit."""
    root = Node(0, n_shards)
    while to_split := {x.first: x for x in _leaves(root) if x.n > 1}:
        at = units.withColumn("node", _place(root))
        spread = [F.max(c) - F.min(c) for c in DIMS]
        stats = at.groupBy("node").agg(F.sum("weight"), *spread).collect()
        state = {}  # node: [dim, lo, bits, weight before lo, wanted weight]
        for node, weight, *spreads in stats:
            if x := to_split.get(node):
                state[node] = [max(range(len(DIMS)), key=lambda d: (spreads[d], -d)), 0, COORD + TIE, 0, weight * (x.n // 2) / x.n]
        cuts = {}
        while state:
            held = lambda k: _nth(_lits([state[i][k] if i in state else 0 for i in range(n_shards)]), F.col("node"))
            shift = _nth(_lits([max(0, state[i][2] - STEP) if i in state else 0 for i in range(n_shards)]), F.col("node"))
            off = F.call_function("shiftright", _key(held(0)) - held(1), shift.cast("int"))
            bins = (
                at.select("node", "weight", F.greatest(F.lit(-1), F.least(off, F.lit(1 << STEP))).alias("bin"))
                .groupBy("node", "bin").agg(F.sum("weight"), F.count("*")).collect()
            )
            by_node: dict[int, list] = {}
            for node, b, weight, n in bins:
                if node in state and 0 <= b < 1 << STEP:
                    by_node.setdefault(node, []).append((b, weight, n))
            for node, got in by_node.items():
                dim, low, bits, before, wanted = state[node]
                step = max(0, bits - STEP)
                for b, weight, n in sorted(got):
                    if before + weight >= wanted:
                        break
                    before += weight
                start = low + (b << step)
                if n == 1 or weight <= enough or step == 0:
                    # the nearer end of the bin
                    cuts[node] = (dim, start if wanted - before <= before + weight - wanted else start + (1 << step))
                    del state[node]
                else:
                    state[node] = [dim, start, step, before, wanted]
        for first, x in to_split.items():
            x.dim, x.cut = cuts.get(first, (0, 0))
            x.left, x.right = Node(first, x.n // 2), Node(first + x.n // 2, x.n - x.n // 2)
    return root


def _coordinate(c: Column, low: Column, high: Column) -> Column:
    width = F.greatest(high - low, F.lit(1e-9))
    return F.floor((c - low) / width * ((1 << COORD) - 1)).cast("long")


def _name_number(c: Column) -> Column:
    """The first six bytes of a name as a number in its order; null comes first."""
    head = F.rpad(F.hex(F.substring(F.encode(c.cast("string"), "utf-8"), 1, 6)), 12, "0")
    return F.coalesce(F.conv(head, 16, 10).cast("double"), F.lit(-1.0))


def spread_large(placed: DataFrame, key: list[str], n_shards: int, even: float) -> DataFrame:
    """Units of LARGE parts of a shard that together exceed their shard go to the shards with the least of such, the heaviest first.

    The driver gets these units, at most ``n_shards / LARGE`` short rows.
    """
    large = [r.asDict() for r in placed.where(F.col("weight") >= even * LARGE).select(*key, "weight", "shard").collect()]
    held, moved = [0] * n_shards, []
    for u in sorted(large, key=lambda u: (-u["weight"], *[u[k] for k in key])):
        if held[u["shard"]] and held[u["shard"]] + u["weight"] > even:
            moved.append(u)
        else:
            held[u["shard"]] += u["weight"]
    for u in moved:  # the heaviest first
        u["shard"] = min(range(n_shards), key=lambda k: (held[k], k))
        held[u["shard"]] += u["weight"]
    if not moved:
        return placed
    goal = placed.sparkSession.createDataFrame([tuple(u[k] for k in (*key, "shard")) for u in moved], placed.select(*key, "shard").schema).withColumnRenamed("shard", "_goal")
    x = placed.join(F.broadcast(goal), key, "left")  # at most n_shards / LARGE rows: a proven bound
    return written(x.select(*[F.coalesce("_goal", "shard").alias(c) if c == "shard" else F.col(c) for c in placed.columns]), "shard-spread")


def level(placed: DataFrame, key: list[str], n_shards: int) -> DataFrame:
    """Units (weight, tie, shard ...) with shards changed so that the bytes of shards come near each other.

    Large units are spread first. Then each pass moves units up to a size.
    Leaves are to hold one level of bytes, or what their larger units weigh,
    if that is more. The driver gets two sums a shard.
    """
    names = placed.columns
    total = placed.agg(F.sum("weight")).first()[0] or 0
    placed = spread_large(placed, key, n_shards, total / n_shards)
    for part in PASSES:
        bound = total / n_shards * part
        small = F.col("weight") <= bound
        got = {r[0]: (r[1], r[2]) for r in placed.groupBy("shard").agg(F.sum("weight"), F.sum(F.when(~small, F.col("weight")).otherwise(0))).collect()}
        held = [got.get(k, (0, 0)) for k in range(n_shards)]
        fixed, rest, free = 0, total, n_shards
        for big in sorted((b for _, b in held), reverse=True):  # those above the level that the others then share
            if not free or big <= rest / free:
                break
            fixed, rest, free = fixed + 1, rest - big, free - 1
        even = rest / free if free else 0
        over = [max(0, int(w - max(b, even))) for w, b in held]
        under = [max(0, int(max(b, even) - w)) for w, b in held]
        if max(over, default=0) <= bound / 8:
            continue
        starts = [sum(over[:k]) for k in range(n_shards)]
        ends = [sum(under[: k + 1]) for k in range(n_shards)]
        of = lambda values: _nth(_lits(values), F.col("shard"))
        x = placed.withColumn("_bucket", F.pmod("tie", F.lit(BUCKETS)))
        movable = x.where(small & (of(over) > 0))
        sums = movable.groupBy("shard", "_bucket").agg(F.sum("weight").alias("_w"))
        run = W.partitionBy("shard").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
        sums = written(sums.select("shard", "_bucket", F.coalesce(F.sum("_w").over(run), F.lit(0)).alias("_base")), "shard-sums")
        within = W.partitionBy("shard", "_bucket").orderBy("tie", *[c for c in names if c not in ("tie", "shard")]).rowsBetween(W.unboundedPreceding, -1)
        middle = F.col("_base") + F.coalesce(F.sum("weight").over(within), F.lit(0)) + F.expr("weight div 2")
        moved = movable.join(sums, ["shard", "_bucket"]).withColumn("_at", middle)
        place = _lits(starts)
        goal = F.size(F.filter(_lits(ends), lambda e: e <= _nth(place, F.col("shard")) + F.col("_at")))
        goal = F.when((F.col("_at") < of(over)) & (goal < n_shards), goal).otherwise(F.col("shard")).cast("int")
        moved = moved.select(*[goal.alias(c) if c == "shard" else F.col(c) for c in names])
        placed = written(x.where(~(small & (of(over) > 0))).select(*names).union(moved), "shard-levelled")
    return placed


def shard(docs: DataFrame, n_shards: int = 40) -> DataFrame:
    """Deal documents into ``n_shards`` shards of nearly equal bytes.

    Returns one row a document: doc_id, size (UTF-8 bytes of the text plus
    16; a null text has none), text_crc32 (0 for null), shard, slot (from 0,
    without gaps, in each shard). Every row counts, repeated ones and null
    ids too. A document is never cut, so very long ones make their shard
    uneven. Equal texts share a shard, unless they exceed one. Null language
    or source is a value like another. An empty table gives no rows. Fewer
    documents than shards leave shards empty. Other columns are not looked at.
    """
    text, parts = F.coalesce("text", F.lit("")), 4 * PIECES * n_shards
    rows = written(
        docs.select(
            F.monotonically_increasing_id().alias("uid"),
            "doc_id",
            (F.octet_length(text).cast("long") + 16).alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.xxhash64(text).alias("h"),
            F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(parts)).cast("int").alias("part"),
            _name_number(F.col("lang")).alias("lang"),
            _name_number(F.col("source")).alias("source"),
        ),
        "shard-rows",
    )
    ranges = [f(c) for c in ("doc_id", "lang", "source") for f in (F.min, F.max)]
    total, longest, *ends = rows.agg(F.sum("size"), F.max("size"), *ranges).first()
    low_id, high_id, *names = [float(e or 0) for e in ends]
    target = max(1.0, (total or 0) / n_shards)
    group = ["text_crc32", "h", "size"]
    dealt = rows.groupBy(*group, "part").agg(
        F.sum("size").alias("weight"), F.min("doc_id").alias("first_id"), F.min("lang").alias("lang"), F.min("source").alias("source")
    )
    # only groups above a shard need more than one unit; of the others the sizes decide
    whole = rows.groupBy(*group).agg(F.sum("size").alias("whole")).where(F.col("whole") > target)
    whole = written(whole.withColumn("chunks", F.ceil(F.col("whole") / target * PIECES).cast("int")).drop("whole"), "shard-large")
    dealt = dealt.join(F.broadcast(whole), group, "left")  # less than n_shards groups: a proven bound
    dealt = dealt.withColumn("chunk", F.coalesce(F.col("part") % F.col("chunks"), F.lit(0))).drop("chunks")
    dealt = written(dealt, "shard-parts")
    scaled = lambda c, low, high: _coordinate(F.min(c), F.lit(low), F.lit(high))
    units = written(
        dealt.groupBy(*group, "chunk").agg(
            F.sum("weight").alias("weight"),
            _coordinate(F.coalesce(F.min("first_id").cast("double"), F.lit(low_id)), F.lit(low_id), F.lit(high_id)).alias("c_id"),
            scaled("lang", *names[:2]).alias("c_lang"),
            scaled("source", *names[2:]).alias("c_source"),
        ).withColumn("c_size", _coordinate(F.log("size"), F.log(F.lit(16.0)), F.log(F.lit(float(longest or 0) + 1))))
        .withColumn("tie", F.pmod(F.xxhash64(*group, "chunk"), F.lit(1 << TIE))),
        "shard-units",
    )
    tree = grow(units, n_shards, target * ENOUGH)
    placed = units.select(*group, "chunk", "weight", "tie", _place(tree).cast("int").alias("shard"))
    placed = level(written(placed, "shard-tree"), [*group, "chunk"], n_shards).drop("weight", "tie")
    of_part = dealt.join(placed, [*group, "chunk"]).select(*group, "part", "shard")
    out = written(rows.join(of_part, [*group, "part"]).select("uid", "doc_id", "size", "text_crc32", "shard"), "shard-placed")
    # slots by two-level counts: no shard is ever ordered in one task
    out = out.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "uid"), F.lit(BUCKETS)))
    counts = out.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    run = W.partitionBy("shard").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(run), F.lit(0)).alias("base"))
    rank = F.row_number().over(W.partitionBy("shard", "bucket").orderBy("doc_id", "uid"))
    return out.join(counts, ["shard", "bucket"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("base") + rank - 1).cast("long").alias("slot")
    )


def write_shards(docs: DataFrame, path: str, n_shards: int = 40, file_rows: int = 200_000) -> None:
    """Write the documents themselves, a folder for each shard and in it files of at most ``file_rows`` rows, in order of slots (ids must be unique)."""
    place = shard(docs, n_shards).select("doc_id", "shard", "slot")
    part = F.expr(f"slot div {file_rows}")
    docs.join(place, "doc_id").repartition("shard", part).sortWithinPartitions("shard", "slot").write.option("maxRecordsPerFile", file_rows).partitionBy("shard").parquet(path)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = shard(table(spark, sf_dir, "documents"))
    return x.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
