"""Hard-negative mining with bit-sliced integer products.

Components become integers; rows are packed into blocks of numpy matrices, and
a stated set of anchors is held against all rows, block by block. Within a
pair of blocks the rows' component bit-planes are taken most significant
first: each adds its share to all partial products and halves the interval
in which the final product lies. Pairs whose interval can no longer reach the
best found, or no longer meets a positive's band, are dropped; when few are
left, they go on as a list of pairs.

Two sweeps: the first finds each anchor's best rows of its own label, the
second the best rows of other labels within each positive's band.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship, slices, table, written

#: Rows and anchors in a block; blocks of rows that meet one copy of an anchor block; share of live pairs below which they become a list.
ROWS, ANCHORS, MEET, FEW = 2048, 512, 8, 1 / 16
#: Components are floor(256 * x). Sums of their squares are below this, so that all bounds fit 64 bits up to 1024 dimensions.
SCALE, LARGEST = 256, 2.0**56
NO_ID, LEAST, MOST = (1 << 63) - 1, -(1 << 63), (1 << 63) - 1
BLOCK = ["number", "n", "dim", "uids", "ids", "labels", "comps", "bands"]
BLOCK_SCHEMA = "number long, n int, dim int, uids binary, ids binary, labels binary, comps binary, bands binary"
_ARROW = pa.schema([("number", pa.int64()), ("n", pa.int32()), ("dim", pa.int32()), *[(c, pa.binary()) for c in BLOCK[3:]]])


def packed(rows: DataFrame, most: int | None = None) -> DataFrame:
    """(uid, id, label, vector, bands) to blocks of ``most`` rows, or one for each partition: arrays, the vectors' as integers, short ones ended with zeros.

    A block's number is that of its partition, or of its first row.
    """

    def block(part: list[tuple]) -> pa.RecordBatch:
        uids, ids, labels, vectors, bands = zip(*part, strict=True)
        dim, wide = max(map(len, vectors)), max(map(len, bands))
        comps, bounds = np.zeros((len(ids), dim), np.int64), np.full((len(ids), wide), LEAST, np.int64)
        for i, (v, x) in enumerate(zip(vectors, bands, strict=True)):
            comps[i, : len(v)] = np.floor(SCALE * v.astype(np.float64)).astype(np.int64)
            bounds[i, : len(x)] = x
        small = np.int16 if not comps.size or np.abs(comps).max() < 1 << 15 else np.int64
        arrays = [np.array(x, np.int64) for x in (uids, ids, labels)] + [comps.astype(small), bounds]
        data = [uids[0] if most else TaskContext.get().partitionId(), len(ids), dim, *[x.tobytes() for x in arrays]]
        return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(data, _ARROW, strict=True)], schema=_ARROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part: list[tuple] = []
        for b in slices(batches):
            uids, ids, labels = (b.column(i).to_pylist() for i in range(3))
            for i, uid in enumerate(uids):
                part.append((uid, ids[i], labels[i], b.column(3)[i].values.to_numpy(zero_copy_only=False), b.column(4)[i].as_py()))
                if len(part) == most:
                    yield block(part)
                    part = []
        if part:
            yield block(part)

    return rows.select("uid", "id", "label", "vector", "bands").mapInArrow(run, BLOCK_SCHEMA)


class Block:
    """A block's arrays again."""

    def __init__(self, number: int, n: int, dim: int, uids: bytes, ids: bytes, labels: bytes, comps: bytes, bands: bytes):
        self.n, (self.uids, self.ids, self.labels) = n, (np.frombuffer(x, np.int64) for x in (uids, ids, labels))
        self.comps = np.frombuffer(comps, np.int16 if len(comps) == 2 * n * dim else np.int64).reshape(n, dim).astype(np.int64)
        self.bands = np.frombuffer(bands, np.int64).reshape(n, -1)


def bar(of: np.ndarray, value: np.ndarray, n: int, best: int) -> np.ndarray:
    """For each of ``n`` anchors the value of rank ``best`` among its pairs (sorted by anchor); LEAST where it has fewer."""
    out, edges = np.full(n, LEAST), np.searchsorted(of, np.arange(n + 1))
    for k in np.flatnonzero(np.diff(edges) >= best):
        own = value[edges[k] : edges[k + 1]]
        out[k] = np.partition(own, len(own) - best)[len(own) - best]
    return out


def sliced(a: np.ndarray, c: np.ndarray, live: np.ndarray, keep: Callable, few: float = FEW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Exact inner products of the pairs that ``keep(i, low, high)`` keeps to the end: anchors' and rows' indexes, products.

    ``keep`` gets pairs' anchors and the bounds of their products after each
    bit-plane of ``c``, and says which may still qualify.
    """
    dim = max(a.shape[1], c.shape[1])
    a, c = (np.pad(x, ((0, 0), (0, dim - x.shape[1]))) for x in (a, c))
    up, down = np.maximum(a, 0).sum(1), np.minimum(a, 0).sum(1)
    top = int(max(c.max(initial=0), -c.min(initial=0) - 1, 0)).bit_length()
    exact = np.float32 if np.abs(a).sum(1).max(initial=0) < 1 << 24 else np.float64
    af = a.astype(exact)
    i, j = np.nonzero(live)
    sums, pairs = np.zeros(live.shape, np.int64), None
    for plane in range(top, -1, -1):
        # in two's complement the sign's plane counts negatively; the planes below can add 0 to ``rest`` times each component
        weight, rest = (-1 << plane if plane == top else 1 << plane), (1 << plane) - 1
        bits = c >> plane & 1
        if pairs is None:
            sums += weight * (af @ bits.T.astype(exact)).astype(np.int64)
            now = sums[i, j]
        else:
            for lo in range(0, len(i), 65_536):
                s = slice(lo, lo + 65_536)
                pairs[s] += weight * np.einsum("ij,ij->i", a[i[s]], bits[j[s]])
            now = pairs
        good = keep(i, now + rest * down[i], now + rest * up[i])
        i, j, now = i[good], j[good], now[good]
        if pairs is not None or len(i) <= few * live.size:
            pairs = now.copy() if pairs is None else now
    return i, j, now


def first(of: np.ndarray, score: np.ndarray, ids: np.ndarray, uid: np.ndarray, best: int) -> np.ndarray:
    """Positions of each anchor's ``best`` pairs: by score descending, then id, then row."""
    order = np.lexsort((uid, ids, -score, of))
    of = of[order]
    rank = np.arange(len(of)) - np.searchsorted(of, of)
    return order[rank < best]


def met(rows: DataFrame, anchors: DataFrame, n_anchors: int) -> DataFrame:
    """Every block of rows with every block of anchors, by equal keys; an anchor block is copied as often as the blocks of rows that it meets need."""
    copies = max(1, -(-rows.count() // MEET))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = rows.withColumn("g", each(n_anchors)).withColumn("s", F.pmod(F.xxhash64("number"), F.lit(copies)))
    right = anchors.select(F.col("number").alias("g"), *[F.col(c).alias(f"a_{c}") for c in BLOCK]).withColumn("s", each(copies))
    return left.join(right, ["g", "s"]).select(*[f"a_{c}" for c in BLOCK], *BLOCK)


def swept(pairs: DataFrame, sweep: Callable[[Block, Block], Iterator[tuple]], columns: list[str]) -> DataFrame:
    """The columns (of longs) that ``sweep`` finds in the met blocks of anchors and rows."""
    arrow = pa.schema([(c, pa.int64()) for c in columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            for k in range(b.num_rows):
                v = [x[k].as_py() for x in b.columns]
                for out in sweep(Block(*v[: len(BLOCK)]), Block(*v[len(BLOCK) :])):
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], schema=arrow)

    return pairs.mapInArrow(run, ", ".join(f"{c} long" for c in columns))


def own_label(best: int) -> Callable[[Block, Block], Iterator[tuple]]:
    """Of each anchor the best other rows of its label."""

    def sweep(a: Block, c: Block) -> Iterator[tuple]:
        live = (a.labels[:, None] == c.labels) & (a.uids[:, None] != c.uids)
        i, j, score = sliced(a.comps, c.comps, live, lambda i, low, high: high >= bar(i, low, a.n, best)[i])
        at = first(i, score, c.ids[j], c.uids[j], best)
        i, j = i[at], j[at]
        yield a.uids[i], a.ids[i], score[at], c.ids[j], c.uids[j]

    return sweep


def other_labels(best: int, percent: tuple[int, int]) -> Callable[[Block, Block], Iterator[tuple]]:
    """Of each anchor and each of its bands (positives' scores) the best rows of other labels between these percentages of it."""

    def sweep(a: Block, c: Block) -> Iterator[tuple]:
        from_, to = -(-percent[0] * np.where(a.bands == LEAST, 0, a.bands) // 100), percent[1] * np.where(a.bands == LEAST, 0, a.bands) // 100
        from_, to = np.where(a.bands == LEAST, MOST, from_), np.where(a.bands == LEAST, LEAST, to)

        def keep(i, low, high):
            out = np.zeros(len(i), bool)
            for lo, hi in zip(from_.T, to.T, strict=True):
                lo, hi = lo[i], hi[i]
                inside = (low >= lo) & (high <= hi)
                out |= (high >= np.maximum(lo, bar(i[inside], low[inside], a.n, best)[i])) & (low <= hi)
            return out

        i, j, score = sliced(a.comps, c.comps, a.labels[:, None] != c.labels, keep)
        for band, lo, hi in zip(a.bands.T, from_.T, to.T, strict=True):
            here = np.flatnonzero((score >= lo[i]) & (score <= hi[i]))
            at = here[first(i[here], score[here], c.ids[j[here]], c.uids[j[here]], best)]
            yield a.uids[i[at]], band[i[at]], score[at], c.ids[j[at]], c.uids[j[at]]

    return sweep


def merged(found: DataFrame, keys: list[str], best: int, parts: int = 64) -> DataFrame:
    """Each key's ``best`` rows of (score, id, uid), with rank: of parts of a key first, then of these."""
    x = found.withColumn("part", F.pmod(F.xxhash64("uid"), F.lit(parts)))
    order = F.struct((-F.col("score")).alias("down"), "id", "uid")
    for by in ([*keys, "part"], keys):
        x = x.groupBy(*by).agg(F.slice(F.array_sort(F.collect_list(order)), 1, best).alias("top"))
        x = x.select(*by, F.posexplode("top").alias("rank", "t")).select(*by, "rank", (-F.col("t.down")).alias("score"), "t.id", "t.uid")
    return x.withColumn("rank", F.col("rank") + 1)


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, percent: tuple[int, int] = (80, 100), block_rows: int = ROWS, block_anchors: int = ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of rows (vec_id, label, vector).

    An anchor's positives are its ``positives`` best other rows of its label
    by inner product; a positive's negatives the ``negatives`` best rows of
    other labels whose scores lie between ``percent`` of the positive's.
    Higher scores come first, ties by smaller vec_id (null last), then in any
    order that stays within a run.

    Rows with a null label or vector, a null or non-finite component, or
    components so large (a norm of 2**20) that scores don't fit, take no
    part. Shorter vectors count as ended with zeros, empty ones as zeros.
    Every row is a row of its own: repeated rows are found as often as they
    occur, and each repeated anchor is an anchor, the others of its id are
    others. Anchors without positives, and positives without negatives, give
    no rows; nor does an empty table. Other columns are not looked at.
    """
    ship(rows.sparkSession)
    number = lambda x: SCALE * x.cast("double")
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + number(x) * number(x))
    x = rows.select("vec_id", "label", "vector", is_anchor.alias("anchor")).where("label is not null and vector is not null").where(fine & (square < LARGEST))
    x = x.select(F.monotonically_increasing_id().alias("uid"), F.coalesce("vec_id", F.lit(NO_ID)).alias("id"), F.col("label").cast("long").alias("label"), "vector", F.coalesce("anchor", F.lit(False)).alias("anchor"), F.array().cast("array<bigint>").alias("bands"))
    x = written(x, "vectors")
    blocks = written(packed(x, block_rows), "vector-blocks")
    anchors = x.where("anchor")
    n = max(1, -(-anchors.count() // block_anchors))
    held = written(packed(anchors.repartition(n)), "anchor-blocks")
    own = swept(met(blocks, held, n), own_label(positives), ["anchor", "anchor_id", "score", "id", "uid"])
    own = written(merged(own, ["anchor", "anchor_id"], positives), "positives")
    bands = own.groupBy("anchor").agg(F.collect_set("score").alias("bands"))
    judged = anchors.drop("bands").join(bands.withColumnRenamed("anchor", "uid"), "uid")
    held = written(packed(judged.repartition(n)), "anchor-bands")
    other = swept(met(blocks, held, n), other_labels(negatives, percent), ["anchor", "band", "score", "id", "uid"])
    other = merged(other, ["anchor", "band"], negatives)
    name = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    own = own.select("anchor", F.col("score").alias("band"), name("anchor_id").alias("anchor_id"), name("id").alias("positive_id"))
    return own.join(other, ["anchor", "band"]).select("anchor_id", "positive_id", "rank", name("id").alias("negative_id"), F.col("band").alias("positive_score"), F.col("score").alias("negative_score"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(x.select("vec_id", label.alias("label"), F.col("embedding").alias("vector")), F.col("vec_id") % 100 == 0)


SQL11 = r"""
WITH e AS (
  SELECT row_number() OVER () AS uid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.uid AS anchor, a.vec_id AS anchor_id, b.vec_id AS id, b.uid, a.label = b.label AS same,
    list_inner_product(a.v, b.v)::BIGINT AS score
  FROM e a JOIN e b ON a.uid <> b.uid WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id, uid) <= 5),
n AS (
  SELECT p.anchor_id, p.id AS positive_id, p.score AS positive_score, s.id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor, p.uid ORDER BY s.score DESC, s.id, s.uid) AS rank
  FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""
