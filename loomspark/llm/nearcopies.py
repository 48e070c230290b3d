"""Near-duplicate documents by MinHash.

288 minima of universal hashes, in 48 bands of 6, bring together all pairs
at Jaccard similarity 0.75 but a fraction of (1 - 0.75**6)**48, or 9e-5; a
pair that is missed counts only where no other path links its documents.
Documents of equal shingle sets are one node from the start. A bucket never yields all its pairs:

1. every member of a bucket is paired with the bucket's least member;
2. in buckets that still hold several components, the members outside the
   largest are held against all others where they lie, in blocks of bounded
   bytes, and only pairs that link two components are given out.

Each candidate is first held against the signatures (one byte a minimum), far
below the threshold, then confirmed on the full shingle sets before it joins anything. Components are
found by alternating large-star and small-star.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship, slices, table, written
from .components import components

WIDTH, BANDS, PER_BAND, THRESHOLD = 5, 48, 6, 75
HASHES = BANDS * PER_BAND
#: Signatures of a pair at the threshold agree this far at least, but for 5 standard deviations.
LEAST_AGREEMENT = THRESHOLD / 100 - 5 * (THRESHOLD / 100 * (1 - THRESHOLD / 100) / HASHES) ** 0.5
#: Members that one copy of a leader's text is held against.
COPY_LOAD = 2000
#: Shingles (8 bytes each) of a bucket's members that meet in one task: outside its largest component, and of all.
OUTSIDE, INSIDE = 400_000, 4_000_000

_rng = np.random.default_rng(20240229)
_A = _rng.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)
_P = _rng.integers(0, 1 << 62, (WIDTH + 1, WIDTH), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_Q = _rng.integers(0, 1 << 62, PER_BAND, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; of the whole where there are fewer words; none without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z, and the six white spaces
    if not words:
        return np.empty(0, np.uint64)
    ids = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(WIDTH, len(words))
    n = len(words) - width + 1
    x = np.full(n, width, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            x = _mixed(x + ids[k : k + n] * _P[width, k])
    return np.unique(x)


def signature(s: np.ndarray) -> np.ndarray:
    """HASHES minima (32 bits) of a set that isn't empty."""
    x, least = (s >> np.uint64(32)).astype(np.uint32), None
    for at in range(0, len(x), 1024):
        part = np.multiply.outer(_A, x[at : at + 1024])
        part += _B[:, None]
        part = part.min(axis=1)
        least = part if least is None else np.minimum(least, part)
    return least


def band_keys(minima: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band, distinct between bands."""
    with np.errstate(over="ignore"):
        x = (minima.reshape(BANDS, PER_BAND).astype(np.uint64) * _Q).astype(np.uint64)
        out = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for k in range(PER_BAND):
            out = _mixed(out + x[:, k])
    return out


def sketch(docs: DataFrame) -> DataFrame:
    """``(doc_id, th, text)`` to doc_id, th, n, s1 and s2 (identity of the set), sig and keys (null without words)."""
    fields = [("doc_id", pa.int64()), ("th", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("sig", pa.binary()), ("keys", pa.list_(pa.int64()))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            n, s1, s2, sig, keys = [], [], [], [], []
            for t in b.column(2):
                s = shingles(t.as_py())
                n.append(len(s))
                if len(s):
                    h, minima = xxhash.xxh3_128_intdigest(s.tobytes()), signature(s)
                    s1.append((h >> 64) - (1 << 63))
                    s2.append((h & (1 << 64) - 1) - (1 << 63))
                    sig.append(((minima * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8).tobytes())
                    keys.append(band_keys(minima).view(np.int64))
                else:
                    for c in (s1, s2, sig, keys):
                        c.append(None)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *[pa.array(c, f[1]) for c, f in zip((n, s1, s2, sig, keys), fields[2:], strict=True)]], names=[f[0] for f in fields])

    return docs.mapInArrow(run, "doc_id long, th long, n long, s1 long, s2 long, sig binary, keys array<long>")


def _agreeing(pairs: DataFrame) -> DataFrame:
    """Of (a, b, sig_a, sig_b) the pairs whose signatures agree far enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in slices(batches):
            sides = [np.frombuffer(b"".join(x.column(i).to_pylist()), np.uint8).reshape(-1, HASHES) for i in (2, 3)]
            same = (sides[0] == sides[1]).mean(axis=1)
            ok = pa.array((same - 1 / 256) / (1 - 1 / 256) >= LEAST_AGREEMENT)
            yield pa.RecordBatch.from_arrays([x.column(0).filter(ok), x.column(1).filter(ok)], names=["a", "b"])

    return pairs.mapInArrow(run, "a long, b long")


def _confirmed(pairs: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """Of written pairs (a, b) those whose full sets reach the threshold."""
    needed = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    keys = nodes.select("node", F.col("doc_id").alias("d"), F.col("th").alias("h")).join(needed, "node")
    texts = docs.join(keys, (docs["doc_id"] == keys["d"]) & (docs["th"] == keys["h"])).select("node", "text")
    texts = written(texts, "near-texts")
    load = pairs.groupBy("a").agg(F.ceil(F.count("*") / COPY_LOAD).cast("int").alias("copies"))
    lead = texts.join(load, texts["node"] == load["a"]).select("a", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), F.lit(None).cast("long").alias("b"), "text")
    members = pairs.join(load, "a").withColumn("copy", F.pmod(F.xxhash64("b"), F.col("copies")).cast("int"))
    members = members.join(texts, members["b"] == texts["node"]).select("a", "copy", "b", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, base = None, None
        for x in slices(batches):
            out_a, out_b = [], []
            a, copy, b, text = (x.column(i) for i in range(4))
            for i in range(x.num_rows):
                at, other, s = (a[i].as_py(), copy[i].as_py()), b[i].as_py(), shingles(text[i].as_py())
                if other is None:
                    held, base = at, s
                elif at == held:
                    both = len(np.intersect1d(base, s, assume_unique=True))
                    if 100 * both >= THRESHOLD * (len(base) + len(s) - both):
                        out_a.append(at[0])
                        out_b.append(other)
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])

    rows = lead.union(members).repartition("a", "copy").sortWithinPartitions("a", "copy", F.col("b").asc_nulls_first())
    return rows.mapInArrow(run, "a long, b long").distinct()


def _sized(pairs: DataFrame) -> DataFrame:
    """(a, na, b, nb) in any order to distinct (a, b), a < b, whose sizes allow the threshold."""
    ok = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * THRESHOLD
    return pairs.where((F.col("a") != F.col("b")) & ok).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def links(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """``nodes`` (node, doc_id, th, n, sig, keys) to ``(node, component)`` of all that are linked."""
    sigs = nodes.select("node", "sig")
    rows = nodes.select("node", "n", F.explode("keys").alias("key"))
    least = rows.groupBy("key").agg(F.min(F.struct("node", "n")).alias("lead"), F.count("*").alias("size"))
    members = written(rows.join(least.where("size > 1").select("key", "lead"), "key"), "near-members")

    def checked(pairs: DataFrame, name: str) -> DataFrame:
        a, b = sigs.select(F.col("node").alias("a"), F.col("sig").alias("sig_a")), sigs.select(F.col("node").alias("b"), F.col("sig").alias("sig_b"))
        pairs = written(_agreeing(pairs.join(a, "a").join(b, "b").select("a", "b", "sig_a", "sig_b")), f"{name}-agree")
        return written(_confirmed(pairs, nodes, docs), f"{name}-links")

    found = checked(_sized(members.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("lead.node").alias("b"), F.col("lead.n").alias("nb"))), "near1")
    of = written(components(found), "near1-components")
    x = members.select("key", "node", "n").join(of, "node", "left").withColumn("c", F.coalesce("component", "node")).drop("component")
    more = written(_between(x, nodes, docs), "near2-links")
    # the links between components join these; only labels take part
    side = lambda c: of.select(F.col("node").alias(c), F.col("component").alias(f"c{c}"))
    labels = more.join(side("a"), "a", "left").join(side("b"), "b", "left").select(F.coalesce("ca", "a").alias("x"), F.coalesce("cb", "b").alias("y"))
    up = components(labels, "x", "y").select(F.col("node").alias("was"), F.col("component").alias("now"))
    known = of.union(up.select("was", "was").join(of.select("node"), F.col("was") == F.col("node"), "left_anti")).toDF("node", "c")
    return known.join(up, known["c"] == up["was"], "left").select("node", F.coalesce("now", "c").alias("component"))


def _between(members: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """Members (key, node, n, c) to pairs (a, b) that link different components c of one bucket.

    In a bucket of several components, every member outside the largest
    is held against all. Tasks get blocks of such members with OUTSIDE
    shingles or so and of others with INSIDE, with signatures and full sets,
    on which a pair is confirmed before it counts; only the pairs that link
    two components are given out, one for each two components of a block.
    """
    by = members.groupBy("key", "c").agg(F.sum("n").alias("m")).groupBy("key").agg(F.count("*").alias("cs"), F.sum("m").alias("all"), F.max(F.struct("m", "c")).alias("top"))
    by = by.where("cs > 1").select("key", F.col("top.c").alias("main"), F.ceil((F.col("all") - F.col("top.m")) / OUTSIDE).cast("int").alias("blocks"), F.ceil(F.col("all") / INSIDE).cast("int").alias("chunks"))
    open_ = written(members.join(by, "key"), "near2-open")
    needed = open_.select("node").distinct()
    sets = _sets(nodes.join(needed, "node").select("node", F.col("doc_id").alias("d"), F.col("th").alias("h"), "sig"), docs)
    sets = written(sets, "near2-sets")
    numbers = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    pick = lambda c: F.pmod(F.xxhash64("node", F.lit(c)), F.col(c)).cast("int")
    outside = open_.where("c != main").select("key", "node", "n", "c", F.lit(0).alias("role"), pick("blocks").alias("block"), F.explode(numbers("chunks")).alias("chunk"))
    every = open_.select("key", "node", "n", "c", F.lit(1).alias("role"), F.explode(numbers("blocks")).alias("block"), pick("chunks").alias("chunk"))
    rows = outside.union(every).join(sets, "node").select("key", "block", "chunk", "role", "node", "n", "c", "sig", "shingles")

    def solve(group: list[list]) -> list[tuple[int, int]]:
        role, node, n, c = (np.array(group[k], np.int64) for k in (3, 4, 5, 6))
        sigs = np.frombuffer(b"".join(group[7]), np.uint8).reshape(-1, HASHES)
        out, inner = np.flatnonzero(role == 0), np.flatnonzero(role == 1)
        same = {x: x for x in c.tolist()}

        def root(x: int) -> int:
            while same[x] != x:
                x = same[x]
            return x

        found: list[tuple[int, int]] = []
        for i in out.tolist():
            near = inner[(c[inner] != c[i]) & (100 * n[inner] >= THRESHOLD * n[i]) & (100 * n[i] >= THRESHOLD * n[inner])]
            near = near[((sigs[near] == sigs[i]).mean(axis=1) - 1 / 256) / (1 - 1 / 256) >= LEAST_AGREEMENT]
            if not len(near):
                continue
            own = np.frombuffer(group[8][i], np.uint64)
            others = [np.frombuffer(group[8][j], np.uint64) for j in near.tolist()]
            flat = np.concatenate(others)
            at = np.minimum(np.searchsorted(own, flat), len(own) - 1)
            sizes = np.array([len(o) for o in others])
            both = np.add.reduceat((own[at] == flat).astype(np.int64), np.concatenate([[0], np.cumsum(sizes)[:-1]]))
            for j in near[100 * both >= THRESHOLD * (len(own) + sizes - both)].tolist():
                x, y = root(int(c[i])), root(int(c[j]))
                if x != y:
                    same[x] = y
                    found.append((min(node[i], node[j]), max(node[i], node[j])))
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, group = None, [[] for _ in range(9)]

        def give() -> pa.RecordBatch:
            pairs = solve(group) if group[0] else []
            return pa.RecordBatch.from_arrays([pa.array([int(p[k]) for p in pairs], pa.int64()) for k in (0, 1)], names=["a", "b"])

        for x in slices(batches):
            for row in zip(*(col.to_pylist() for col in x.columns), strict=True):
                if row[:3] != held:
                    yield give()
                    held, group = row[:3], [[] for _ in range(9)]
                for col, v in zip(group, row, strict=True):
                    col.append(v)
        yield give()

    rows = rows.repartition("key", "block", "chunk").sortWithinPartitions("key", "block", "chunk")
    return rows.mapInArrow(run, "a long, b long").distinct()


def _sets(keys: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, d, h, sig) to node, sig and shingles: the full set."""
    joined = docs.join(keys, (docs["doc_id"] == keys["d"]) & (docs["th"] == keys["h"])).select("node", "sig", "text").dropDuplicates(["node"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            sets = [shingles(t.as_py()).tobytes() for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(sets, pa.binary())], names=["node", "sig", "shingles"])

    return joined.mapInArrow(run, "node long, sig binary, shingles binary")


def near_copies(docs: DataFrame) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id (the smallest linked doc_id), kept.

    Words are lowered in A-Z only. Fewer than five words are one shingle, the
    whole; null, empty and blank texts have none and are linked with nothing,
    not even with each other. Whole texts count, of any length. Rows of one
    id are one document as far as ids go: each row has its own size, and the
    component of any of them. A row with a null id is linked with nothing,
    has a null component and is kept. Repeated rows fare alike. An empty
    table gives no rows. Other columns are not looked at.
    """
    ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text")
    rows = written(sketch(docs), "near-sketch")
    linkable = rows.where("n > 0 and doc_id is not null")
    # one node for each set; rows of one id are one node too, by links added below
    first = linkable.groupBy("s1", "s2").agg(F.min(F.struct("doc_id", "th")).alias("f"))
    nodes = linkable.join(first, ["s1", "s2"]).where("doc_id = f.doc_id and th = f.th").dropDuplicates(["s1", "s2"])
    nodes = written(nodes.select(F.xxhash64("s1", "s2").alias("node"), "doc_id", "th", "n", "sig", "keys"), "near-nodes")
    of = links(nodes, docs)
    each = linkable.select("doc_id", F.xxhash64("s1", "s2").alias("node")).distinct()
    each = each.join(of, "node", "left").select("doc_id", F.coalesce("component", "node").alias("c")).distinct()
    least = written(each.withColumn("least", F.lit(None).cast("long")).groupBy("c").agg(F.min("doc_id").alias("least")), "near-least")
    by_doc = each.join(least, "c").groupBy("doc_id").agg(F.min("least").alias("component_id"), F.count("*").alias("parts"), F.max("least").alias("other"))
    by_doc = written(by_doc, "near-docs")
    # an id with rows in several components joins them
    bridges = by_doc.where("component_id != other")
    if not bridges.isEmpty():
        pairs = each.join(least, "c").join(bridges.select("doc_id", F.col("component_id").alias("a")), "doc_id")
        joined = components(pairs.select("a", F.col("least").alias("b")))
        by_doc = by_doc.join(joined, by_doc["component_id"] == joined["node"], "left").withColumn("component_id", F.coalesce("component", "component_id"))
    by_doc = by_doc.select(F.col("doc_id").alias("d"), "component_id")
    out = rows.join(by_doc, (rows["doc_id"] == by_doc["d"]) & (rows["n"] > 0), "left")
    own = F.when(F.col("component_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"), F.coalesce(own == F.col("doc_id"), F.lit(True)).alias("kept"))


def op8_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(table(spark, sf_dir, "documents"))


#: Every pair of documents by the shingles that they share: for small tables.
SQL8 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
  ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS c FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b USING (g) WHERE a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * k >= 75 * (nx.c + ny.c - k)),
e AS (SELECT x AS a, y AS b FROM l UNION SELECT y, x FROM l),
r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a AS doc_id, least(a, min(b)) AS component_id FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.c, 0) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id, coalesce(c.component_id, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""
