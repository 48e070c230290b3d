"""Line dedup with a sharded minimal perfect hash.

Distinct line hashes that occur in at least two documents go, with the number
of these documents, to shards of bounded size. Each shard is a minimal perfect hash (levels of bit arrays: a
key that is alone at its position sets the bit, the others go on to the next
level; the index is the rank of the bit) over three arrays: fingerprint, count
and first document. Documents send 128-bit hashes of their lines, not lines,
to probe the arrays: a line goes if the fingerprint is its own, the count
says enough documents, and the first of them is another. Shards are copied as
often as the lines that probe them need, so that no task takes all probes of one line.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SPACES, fresh, ship, slices, table, written

#: Keys in a shard on average; lines that probe one copy of a shard; shortest key in code points.
SHARD_KEYS, COPY_LOAD, SHORTEST = 65_536, 100_000, 10
NO_ID = (1 << 63) - 1
_STRIP = SPACES.encode()


def line_key(line: bytes) -> bytes | None:
    """The key of a line, or None where it is too short to count."""
    k = line.strip(_STRIP)
    if len(k) < SHORTEST or len(k) < 4 * SHORTEST and len(k.decode("utf-8", "replace")) < SHORTEST:
        return None
    return k.lower()  # of bytes: A-Z only


def line_hash(key: bytes) -> tuple[int, int]:
    h = xxhash.xxh3_128_intdigest(key)
    return (h >> 64) - (1 << 63), (h & (1 << 64) - 1) - (1 << 63)


class PerfectHash:
    """Minimal perfect hash over distinct uint64 keys."""

    GAMMA = 2

    def __init__(self, levels: list[np.ndarray], ranks: list[np.ndarray]):
        self.levels, self.ranks = levels, ranks  # bits; count of set bits before each position block

    @staticmethod
    def _at(keys: np.ndarray, level: int, m: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            x = keys + np.uint64(0x9E3779B97F4A7C15 * (level + 1) & (1 << 64) - 1)
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            return ((x ^ (x >> np.uint64(31))) % np.uint64(m)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels = []
        while len(keys):
            m = -(-max(64, len(keys) * cls.GAMMA) // 64) * 64
            at = cls._at(keys, len(levels), m)
            alone = np.bincount(at, minlength=m) == 1
            levels.append(np.packbits(alone, bitorder="little"))
            keys = keys[~alone[at]]
        return cls.of(levels)

    @classmethod
    def of(cls, levels: list[np.ndarray]) -> PerfectHash:
        ranks, before = [], 0
        for bits in levels:
            ones = np.bitwise_count(bits.view("<u8")).astype(np.int64)
            ends = before + np.cumsum(ones)
            ranks.append(ends - ones)
            before = int(ends[-1])
        return cls(levels, ranks)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """From 0 for keys of the set; of other keys any index or -1."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (bits, rank) in enumerate(zip(self.levels, self.ranks, strict=True)):
            words = bits.view("<u8")
            at = self._at(keys[left], level, len(bits) * 8)
            word = words[at >> 6]
            set_ = (word >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
            below = np.bitwise_count(word & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)))
            out[left[set_]] = (rank[at >> 6] + below)[set_]
            left = left[~set_]
        return out

    def dump(self) -> bytes:
        sizes = np.array([len(x) for x in self.levels], "<u4")
        return np.uint32(len(sizes)).tobytes() + sizes.tobytes() + b"".join(x.tobytes() for x in self.levels)

    @classmethod
    def load(cls, data: bytes) -> PerfectHash:
        n = int(np.frombuffer(data, "<u4", 1)[0])
        sizes, at, levels = np.frombuffer(data, "<u4", n, 4), 4 + 4 * n, []
        for s in map(int, sizes):
            levels.append(np.frombuffer(data, np.uint8, s, at))
            at += s
        return cls.of(levels)


def _unsigned(x: np.ndarray) -> np.ndarray:
    return x.astype(np.int64).view(np.uint64)


def line_hashes(docs: DataFrame) -> DataFrame:
    """``(k, th, text)`` to one row for each countable line: k, th, idx, h1, h2."""
    schema = "k long, th long, idx int, h1 long, h2 long"
    arrow = pa.schema([("k", pa.int64()), ("th", pa.int64()), ("idx", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            cols: tuple[list, ...] = ([], [], [], [], [])
            k, th, text = (b.column(i) for i in range(3))
            for i in range(b.num_rows):
                a, h = k[i].as_py(), th[i].as_py()
                for n, line in enumerate((text[i].as_py() or "").encode("utf-8", "surrogatepass").split(b"\n")):
                    if key := line_key(line):
                        for c, v in zip(cols, (a, h, n, *line_hash(key)), strict=True):
                            c.append(v)
                if len(cols[0]) > 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, arrow, strict=True)], schema=arrow)
                    cols = ([], [], [], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, arrow, strict=True)], schema=arrow)

    return docs.mapInArrow(run, schema)


def build_shards(repeated: DataFrame, n_shards: int) -> DataFrame:
    """Repeated line hashes (h1, h2, n documents, first) to one row of arrays for each shard."""
    schema = "shard int, perfect binary, prints binary, counts binary, firsts binary"

    def one(pdf):
        import pandas as pd

        keys = _unsigned(pdf["h1"].to_numpy())
        # equal h1 with another h2 would be two keys at one place: of 2^64, not to be expected, but refused
        if len(np.unique(keys)) != len(keys):
            raise ValueError("two distinct lines share 64 bits of their hashes")
        mph = PerfectHash.build(keys)
        at = mph.index(keys)
        prints, counts, firsts = np.empty(len(at), np.int64), np.empty(len(at), np.uint32), np.empty(len(at), np.int64)
        prints[at], counts[at], firsts[at] = pdf["h2"], np.minimum(pdf["n"], (1 << 32) - 1), pdf["first"]
        return pd.DataFrame([[pdf["shard"].iloc[0], mph.dump(), prints.tobytes(), counts.tobytes(), firsts.tobytes()]], columns=["shard", "perfect", "prints", "counts", "firsts"])

    return repeated.withColumn("shard", F.pmod("h1", F.lit(n_shards)).cast("int")).groupBy("shard").applyInPandas(one, schema)


def probe(hashes: DataFrame, arrays: DataFrame, fewest_docs: int) -> DataFrame:
    """Lines (k, th, idx, h1, h2, shard, copy) that the arrays (with copy) know from enough documents and a smaller one."""
    nulls = [F.lit(None).cast("binary").alias(c) for c in ("perfect", "prints", "counts", "firsts")]
    lines = hashes.select("shard", "copy", F.lit(1).alias("kind"), "k", "th", "idx", "h1", "h2", *nulls)
    tables = arrays.select("shard", "copy", F.lit(0).alias("kind"), *[F.lit(0).cast(t).alias(c) for c, t in (("k", "long"), ("th", "long"), ("idx", "int"), ("h1", "long"), ("h2", "long"))], "perfect", "prints", "counts", "firsts")
    arrow = pa.schema([("k", pa.int64()), ("th", pa.int64()), ("idx", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, mph, prints, counts, firsts = None, None, None, None, None
        for b in slices(batches):
            shard, copy, kind, k, th, idx, h1, h2 = (b.column(i).to_numpy(zero_copy_only=False) for i in range(8))
            edges = np.flatnonzero((np.diff(shard) != 0) | (np.diff(copy) != 0) | (np.diff(kind) != 0)) + 1
            out: list[list] = [[], [], []]
            for lo, hi in zip([0, *edges], [*edges, b.num_rows], strict=True):
                if lo == hi:
                    continue
                if kind[lo] == 0:
                    held = (shard[lo], copy[lo])
                    mph = PerfectHash.load(b.column(8)[lo].as_py())
                    prints, counts, firsts = (np.frombuffer(b.column(i)[lo].as_py(), t) for i, t in ((9, np.int64), (10, np.uint32), (11, np.int64)))
                elif held == (shard[lo], copy[lo]):
                    at = mph.index(_unsigned(h1[lo:hi]))
                    hit = at >= 0
                    hit[hit] = (prints[at[hit]] == h2[lo:hi][hit]) & (counts[at[hit]] >= fewest_docs) & (firsts[at[hit]] < k[lo:hi][hit])
                    for c, v in zip(out, (k, th, idx), strict=True):
                        c.append(v[lo:hi][hit])
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), f.type) for c, f in zip(out, arrow, strict=True)], schema=arrow)

    both = tables.union(lines).repartition("shard", "copy").sortWithinPartitions("shard", "copy", "kind")
    return both.mapInArrow(run, "k long, th long, idx int")


def dedup(docs: DataFrame, shard_keys: int = SHARD_KEYS, copy_load: int = COPY_LOAD, fewest_docs: int = 2) -> DataFrame:
    """``docs`` with ``kept_text``, ``n_lines`` and ``n_dropped`` added.

    A line's key is the line without white space at its ends, A-Z lowered.
    Keys of ten code points or more found in ``fewest_docs`` documents (two
    at least) lose all their lines but those in the document of the smallest
    id. Null and empty texts are one empty line; lines of any length count
    whole. Rows of one id are one document: their common lines are no
    repeats. A null id counts as larger than any other. Repeated rows fare
    alike. An empty table gives no rows. All other columns are kept, but one
    that is already named like a new column, in any case, is replaced.
    """
    ship(docs.sparkSession)
    new = ["kept_text", "n_lines", "n_dropped"]
    docs = docs.drop(*new)
    _k, _th, _drops, _rk, _rth = fresh(docs, "_k", "_th", "_drops", "_rk", "_rth")
    keyed = [F.coalesce("doc_id", F.lit(NO_ID)), F.xxhash64("text")]
    hashes = written(line_hashes(docs.select(keyed[0].alias("k"), keyed[1].alias("th"), "text")), "line-hashes")
    found = hashes.select("h1", "h2", "k").distinct().groupBy("h1", "h2").agg(F.min("k").alias("first"), F.count("*").alias("n"))
    repeated = written(found.where("n > 1"), "line-repeats")
    n_shards = max(1, -(-repeated.count() // shard_keys))
    shard = F.pmod("h1", F.lit(n_shards)).cast("int").alias("shard")
    arrays = written(build_shards(repeated, n_shards), "line-arrays")
    load = hashes.groupBy(shard).agg(F.ceil(F.count("*") / copy_load).cast("int").alias("copies"))
    load = written(load.join(arrays.select("shard"), "shard", "left_semi"), "line-loads")
    sent = hashes.withColumn("shard", shard).join(load, "shard")
    sent = sent.withColumn("copy", F.pmod(F.xxhash64("k", "idx"), F.col("copies")).cast("int"))
    copied = arrays.join(load, "shard").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    drops = probe(sent, copied, fewest_docs).groupBy("k", "th").agg(F.collect_set("idx").alias(_drops)).toDF(_rk, _rth, _drops)
    keep = docs.columns
    whole = docs.withColumns({_k: keyed[0], _th: keyed[1]})
    joined = whole.join(drops, (F.col(_k) == F.col(_rk)) & (F.col(_th) == F.col(_rth)), "left").select(*keep, _drops)
    schema = T.StructType([*docs.schema.fields, T.StructField(new[0], T.StringType()), *[T.StructField(c, T.LongType()) for c in new[1:]]])
    at = [c.lower() for c in keep].index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts, drops = b.column(at), b.column(len(keep))
            kept, n, lost = [], [], []
            for i in range(b.num_rows):
                lines, gone = (texts[i].as_py() or "").split("\n"), drops[i].as_py()
                n.append(len(lines))
                lost.append(len(gone or ()))
                if gone:
                    gone = {*gone}
                    lines = [x for j, x in enumerate(lines) if j not in gone]
                kept.append("\n".join(lines))
            cols = [pa.array(kept, pa.string()), pa.array(n, pa.int64()), pa.array(lost, pa.int64())]
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(len(keep))], *cols], names=[*keep, *new])

    return joined.mapInArrow(run, schema)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return x.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("kept_text", "utf-8"), 256).alias("kept_sha256"))


SQL3 = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
keys AS (
  SELECT doc_id, pos, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
repeated AS (
  SELECT key, min(doc_id) AS first FROM keys WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
judged AS (
  SELECT k.doc_id, k.pos, k.line, r.first IS NOT NULL AND r.first < k.doc_id AS gone
  FROM keys k LEFT JOIN repeated r USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
