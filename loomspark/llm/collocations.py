"""Phrase collocation mining with suffix arrays of word ids.

Texts are cut into pieces and words, and dealt by tasks into shards of one
language: word ids (ranks in the shard's sorted dictionary) with a stop after
each piece. In every shard numpy's prefix doubling sorts the suffixes; runs of
suffixes that share their first n words (the LCP intervals of depth n) are the
shard's n-grams with their counts. These counts, a row for each n-gram and
shard, are summed by key.

An n-gram that is frequent has frequent parts, so the n-grams of the next
length are only emitted where a bitset of fixed size says that both parts of
n - 1 words may be frequent; what it lets through wrongly is counted and
falls by its count. Parts of a candidate are at least as frequent as the
candidate, so their counts are all known.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from .common import ship, slices, table, written

#: Words in a shard, about; bits of the filter (8 MB), which is what is broadcast; parts of a language at the last ranking.
SHARD_WORDS, FILTER_BITS, RANK_PARTS = 2_000_000, 1 << 26, 64
#: What ends a piece, and as which byte it stands among the words (no UTF-8 text holds it); tab is a space.
ENDS, STOP = b".,;:!?\n\x0b\x0c\r", b"\xff"
_BYTES = bytes(0xFF if b in ENDS else 0x20 if b == 9 else b for b in range(256))
#: Arbitrary odd numbers, by which words' hashes are mixed into a phrase's.
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def word_list(text: str | None) -> list[bytes]:
    """The words of a text, A-Z lowered, with STOP between pieces."""
    x = (text or "").encode("utf-8", "surrogatepass").lower().translate(_BYTES)
    return x.replace(STOP, b" \xff ").split()


def shards(docs: DataFrame, most_words: int = SHARD_WORDS) -> DataFrame:
    """(lang, text) to rows of one language each: dictionary (sorted words) and ids (int32; 0 is a stop, a word's id its rank from 1)."""
    ship(docs.sparkSession)
    arrow = pa.schema([("lang", pa.string()), ("dictionary", pa.list_(pa.binary())), ("ids", pa.binary())])

    def row(lang: str, known: dict[bytes, int], parts: list[np.ndarray]) -> pa.RecordBatch:
        known.setdefault(STOP, 0)
        words = sorted(w for w in known if w != STOP)
        rank = np.zeros(len(known), np.int32)
        rank[[known[w] for w in words]] = np.arange(1, len(words) + 1)
        return pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([words], pa.list_(pa.binary())), pa.array([rank[np.concatenate(parts)].tobytes()])], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[dict, list]] = {}
        size: dict[str, int] = defaultdict(int)
        for b in slices(batches):
            langs, texts = b.column(0).to_pylist(), b.column(1)
            for i, lang in enumerate(langs):
                words = word_list(texts[i].as_py())
                if not words:
                    continue
                if lang not in held:
                    ids = defaultdict(count().__next__)
                    held[lang] = ids, []
                known, parts = held[lang]
                words.append(STOP)
                parts.append(np.fromiter(map(known.__getitem__, words), np.int32, len(words)))
                size[lang] += len(words)
                # the largest leaves when one is full, or all together are twice that
                if size[lang] > most_words or sum(size.values()) > 2 * most_words:
                    full = max(size, key=size.get)
                    yield row(full, *held.pop(full))
                    del size[full]
        for lang, x in held.items():
            yield row(lang, *x)

    return docs.select("lang", "text").mapInArrow(run, "lang string, dictionary array<binary>, ids binary")


def suffix_array(ids: np.ndarray, depth: int) -> np.ndarray:
    """Starts of the suffixes, sorted by their first ``depth`` ids or more (by prefix doubling, from ids to pairs to fours)."""
    rank, k = ids.astype(np.int64), 1
    order = np.argsort(rank, kind="stable")
    while k < depth:
        behind = np.zeros_like(rank)
        behind[:-k or None] = rank[k:]
        key = rank * (int(rank.max(initial=0)) + 1) + behind
        order = np.argsort(key, kind="stable")
        new = np.zeros(len(key), np.int64)
        new[1:] = np.cumsum(np.diff(key[order]) != 0)
        rank[order] = new
        k *= 2
    return order


def intervals(ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams within pieces: a start of each, in their order, and their counts (the LCP intervals of depth n)."""
    order = suffix_array(ids, n)
    padded = np.concatenate([ids, np.zeros(n, ids.dtype)])
    inside = padded[order] != 0
    for j in range(1, n):
        inside &= padded[order + j] != 0
    order = order[inside]
    if not len(order):
        return order, order
    fresh = np.zeros(len(order), bool)  # where less than n words are common with the one before
    fresh[0] = True
    for j in range(n):
        w = padded[order + j]
        fresh[1:] |= w[1:] != w[:-1]
    at = np.flatnonzero(fresh)
    return order[at], np.diff(np.append(at, len(order)))


def phrase_hash(parts: list[np.ndarray], lang: str) -> np.ndarray:
    """Of phrases whose first words have the hashes parts[0], and so on."""
    with np.errstate(over="ignore"):
        h = np.uint64(xxhash.xxh3_64_intdigest(lang.encode())) * np.ones(len(parts[0]), np.uint64)
        for j, p in enumerate(parts):
            h = (h ^ (p * MIX[j % len(MIX)])) * MIX[0]
            h ^= h >> np.uint64(29)
    return h


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def grams(parts: DataFrame, n: int, may: object | None) -> DataFrame:
    """(lang, phrase, f): each shard's n-grams and their counts; ``may`` (a broadcast bitset) must know both parts of n - 1 words."""
    arrow = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("f", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            for i in range(b.num_rows):
                lang, words = b.column(0)[i].as_py(), b.column(1)[i].values
                ids = np.frombuffer(b.column(2)[i].as_py(), np.int32)
                at, f = intervals(ids, n)
                if may is not None and len(at):
                    bits, hashes = may.value, np.concatenate([[np.uint64(0)], word_hashes(words.to_pylist())])
                    w = [hashes[ids[at + j]] for j in range(n)]
                    good = np.ones(len(at), bool)
                    for part in (w[:-1], w[1:]):
                        pos = phrase_hash(part, lang) % np.uint64(8 * len(bits))
                        good &= (bits[pos >> np.uint64(3)] >> (pos & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
                    at, f = at[good], f[good]
                for lo in range(0, len(at), 250_000):
                    some = at[lo : lo + 250_000]
                    text = [words.take(pa.array(ids[some + j] - 1)) for j in range(n)]
                    text = text[0] if n == 1 else pc.binary_join_element_wise(*text, b" ")
                    yield pa.RecordBatch.from_arrays([pa.array([lang]).take(pa.array(np.zeros(len(some), np.int32))), text.cast(pa.string()), pa.array(f[lo : lo + 250_000])], schema=arrow)

    return parts.mapInArrow(run, "lang string, phrase string, f long")


def frequent_bits(found: DataFrame, bits: int) -> np.ndarray:
    """The bitset of the phrases of ``found``: ``bits`` bits, whatever their number."""
    arrow = pa.schema([("at", pa.int32()), ("bit", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            by: dict[tuple[str, int], list] = defaultdict(list)
            for lang, phrase in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                words = phrase.encode("utf-8", "surrogatepass").split(b" ")
                by[lang, len(words)].append(words)
            for (lang, n), rows in by.items():
                pos = phrase_hash([word_hashes([r[j] for r in rows]) for j in range(n)], lang) % np.uint64(bits)
                yield pa.RecordBatch.from_arrays([pa.array((pos >> np.uint64(6)).astype(np.int32)), pa.array((np.uint64(1) << (pos & np.uint64(63))).view(np.int64))], schema=arrow)

    words = found.select("lang", "phrase").mapInArrow(run, "at int, bit long").groupBy("at").agg(F.bit_or("bit").alias("bit"))
    out = np.zeros(bits // 64, np.uint64)
    got = words.toArrow()  # at most bits / 64 rows of twelve bytes
    out[got["at"].to_numpy()] = got["bit"].to_numpy().view(np.uint64)
    return out.view(np.uint8)


def counts(docs: DataFrame, most_words: int = 3, fewest: int = 10, shard_words: int = SHARD_WORDS, filter_bits: int = FILTER_BITS) -> tuple[DataFrame, DataFrame]:
    """Phrases of 1 to ``most_words`` words that occur ``fewest`` times or more (lang, phrase, words, f), and all words of each language (lang, n)."""
    spark = docs.sparkSession
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")
    parts = written(shards(docs.select(lang, "text"), shard_words), "word-shards")
    tables, may, total = [], None, None
    for n in range(1, most_words + 1):
        # a shard sends each key once, so keys are dealt without counting beforehand
        sums = grams(parts, n, may).repartition("lang", "phrase").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
        if n == 1:
            sums = written(sums, "words")
            total = written(sums.groupBy("lang").agg(F.sum("f").alias("n")), "word-totals")
        tables.append(written(sums.where(F.col("f") >= fewest).withColumn("words", F.lit(n)), f"phrases-{n}"))
        if n < most_words:
            may = spark.sparkContext.broadcast(frequent_bits(tables[-1], filter_bits))
    out = tables[0]
    for t in tables[1:]:
        out = out.union(t)
    return out.select("lang", "phrase", "words", "f"), total


def exact_score(a: F.Column, l: F.Column, r: F.Column) -> F.Column:  # noqa: E741
    """floor(1000000 * a * a / (l * r)) in decimals: exact for counts up to 1e15."""
    wide = lambda c: c.cast(T.DecimalType(16, 0))
    top = (wide(a) * wide(a)).cast(T.DecimalType(31, 0)) * F.lit(1_000_000).cast(T.DecimalType(7, 0))
    return F.call_function("div", top.cast(T.DecimalType(38, 0)), (wide(l) * wide(r)).cast(T.DecimalType(38, 0))).cast("long")


def collocations(docs: DataFrame, most_words: int = 3, fewest: int = 10, absorbed: int = 50, top: int = 2000, shard_words: int = SHARD_WORDS, filter_bits: int = FILTER_BITS) -> DataFrame:
    """Each language's best phrases: lang, rank, phrase, a, l, r, n, score.

    A phrase of 2 to ``most_words`` words with a >= ``fewest`` occurrences is
    a candidate; its score is that of its weakest cut (ties to the first).
    Candidates inside a longer candidate that has ``absorbed`` percent of
    their occurrences or more are dropped. The first ``top`` of a language
    are returned, by score, then occurrences, then bytes of the phrase.

    A null language is ``und``; null and empty texts have no words; texts of
    any length count whole; repeated rows count as often as they occur;
    languages without candidates don't appear, and an empty table gives no
    rows. Columns besides ``text`` and ``lang`` are not looked at.
    """
    f, total = counts(docs, most_words, fewest, shard_words, filter_bits)
    words = F.split("phrase", " ")
    part = lambda lo, n: F.array_join(F.slice(words, lo, n), " ")
    one = f.where("words > 1").withColumnRenamed("f", "a")
    cut = F.explode(F.sequence(F.lit(1), F.col("words") - 1))
    cuts = one.withColumn("k", cut).withColumns({"left": part(F.lit(1), F.col("k")), "right": part(F.col("k") + 1, F.col("words") - F.col("k"))})
    of = lambda name, n: f.select("lang", F.col("phrase").alias(name), F.col("f").alias(n))
    cuts = cuts.join(of("left", "l"), ["lang", "left"]).join(of("right", "r"), ["lang", "right"])
    cuts = cuts.withColumn("score", exact_score(F.col("a"), F.col("l"), F.col("r")))
    weakest = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "words")).alias("c")).select("lang", "phrase", "c.*")
    # contiguous parts of two words or more, shorter than the phrase
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda n: F.transform(F.sequence(F.lit(1), F.col("words") - n + 1), lambda lo: part(lo, n))))
    longer = one.where("words > 2").select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = weakest.join(longer, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < absorbed * F.col("a")))
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the first of each part of a language, then the first of these
    kept = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)))
    kept = kept.withColumn("rank", F.row_number().over(W.partitionBy("lang", "part").orderBy(*best))).where(F.col("rank") <= top)
    kept = kept.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*best)).cast("long")).where(F.col("rank") <= top)
    return kept.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


SQL13 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
g AS (
  SELECT lang, 1 AS words, unnest(w) AS phrase FROM w
  UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM w
  UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM w),
f AS (SELECT lang, words, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE words = 1 GROUP BY lang),
c AS (SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE words > 1 AND f >= 10),
cuts AS (
  SELECT *, unnest(range(1, words)) AS k FROM c),
parts AS (SELECT *, array_to_string(w[1:k], ' ') AS lp, array_to_string(w[k + 1:words], ' ') AS rp FROM cuts),
scored AS (
  SELECT p.lang, p.words, p.phrase, p.a, k, x.f AS l, y.f AS r,
    ((1000000::HUGEINT * p.a * p.a) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM parts p JOIN f x ON x.lang = p.lang AND x.phrase = p.lp AND x.words = p.k
  JOIN f y ON y.lang = p.lang AND y.phrase = p.rp AND y.words = p.words - p.k),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner2 AS (
  SELECT lang, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase, a FROM c WHERE words = 3),
longer AS (SELECT lang, phrase, max(a) AS longer FROM inner2 GROUP BY ALL),
kept AS (
  SELECT s.* FROM weakest s LEFT JOIN longer o ON o.lang = s.lang AND o.phrase = s.phrase
  WHERE o.longer IS NULL OR 100 * o.longer < 50 * s.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT r.lang, rank, phrase, a, l, r, n, score FROM ranked r JOIN n ON n.lang = r.lang WHERE rank <= 2000
"""
