"""Document fingerprints as invertible Bloom lookup sketches.

A text's paragraphs (lines, cut after every 32 words) are hashed into cells
of a count, an xor of digests and an xor of their checks. Subtracting the
cells of two versions leaves their difference, and peeling (a cell that holds
one digest gives it away, which empties other cells) recovers the digests
that differ. If the fingerprints themselves don't peel, larger sketches do:
the digests are dealt into tables of six or so on average, and each table
that fails is built again twice as large with other hashes, until it peels.
All of it are SQL expressions on arrays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import table, written

#: Cells in each third of a fingerprint and of the first larger tables; digests a table; words a paragraph piece.
THIRD, LARGER, PER_TABLE, PIECE = 8, 7, 6, 32
#: Rounds of peeling; doublings after which a table counts as an error (each attempt fails with a small probability, so some ten suffice for all corpora).
ROUNDS, DOUBLINGS = 12, 20


def digests(text: Column) -> Column:
    """Distinct digests of the paragraphs, as an array of longs; a text of white space has the digest of none."""
    piece = rf"(?:[^\x20\x09-\x0D]+[\x20\x09\x0B-\x0D]*){{1,{PIECE}}}"
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(piece), F.lit(0)), lambda p: F.xxhash64(F.rtrim(p))))


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, also within lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _check(k: Column) -> Column:
    return F.xxhash64(k, F.lit("check"))


def _placed(k: Column, n: Column, third: Column, seed: Column) -> Column:
    at = [(F.pmod(F.xxhash64(k, seed * 3 + t), third) + t * third).cast("int").alias(f"i{t}") for t in range(3)]
    return F.struct(k.alias("k"), n.alias("n"), _check(k).alias("h"), *at)


def _hit(r: Column, c: Column) -> Column:
    return (r["i0"] == c) | (r["i1"] == c) | (r["i2"] == c)


def _cell(n: Column, k: Column, h: Column) -> Column:
    return F.struct(n.alias("n"), k.alias("k"), h.alias("h"))


def cells(placed: Column, third: Column) -> Column:
    """The cells of signed, placed digests."""
    zero = _cell(F.lit(0), F.lit(0).cast("long"), F.lit(0).cast("long"))
    add = lambda a, r: _cell(a["n"] + r["n"], a["k"].bitwiseXOR(r["k"]), a["h"].bitwiseXOR(r["h"]))
    return F.transform(F.sequence(F.lit(0), (3 * third - 1).cast("int")), lambda c: F.aggregate(F.filter(placed, lambda r: _hit(r, c)), zero, add))


def sketch(keys: Column, third: int = THIRD, seed: int = 0) -> Column:
    return _let(F.transform(keys, lambda k: _placed(k, F.lit(1), F.lit(third), F.lit(seed))), lambda p: cells(p, F.lit(third)))


def subtracted(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: _cell(x["n"] - y["n"], x["k"].bitwiseXOR(y["k"]), x["h"].bitwiseXOR(y["h"])))


_FOUND = "array<struct<k:bigint,n:int>>"


def peeled(diff: Column, third: Column, seed: Column) -> Column:
    """The digests recovered from cells, with 1 for the first side and -1 for the second; null where some are left over."""

    def step(state: Column, _: Column) -> Column:
        pure = F.filter(state["cells"], lambda x: (F.abs(x["n"]) == 1) & (x["h"] == _check(x["k"])))
        found = F.transform(F.array_distinct(pure), lambda x: _placed(x["k"], x["n"], third, seed))
        less = lambda a, r: _cell(a["n"] - r["n"], a["k"].bitwiseXOR(r["k"]), a["h"].bitwiseXOR(r["h"]))

        def then(rs: Column) -> Column:
            rest = F.transform(state["cells"], lambda x, c: F.aggregate(F.filter(rs, lambda r: _hit(r, c)), x, less))
            new = F.transform(rs, lambda r: F.struct(r["k"].alias("k"), r["n"].alias("n")))
            return F.when(F.size(rs) == 0, state).otherwise(F.struct(rest.alias("cells"), F.concat(state["found"], new).alias("found")))

        return _let(found, then)

    start = F.struct(diff.alias("cells"), F.array().cast(_FOUND).alias("found"))
    end = F.aggregate(F.array(*[F.lit(i) for i in range(ROUNDS)]), start, step)
    left = lambda s: F.exists(s["cells"], lambda x: (x["n"] != 0) | (x["k"] != 0) | (x["h"] != 0))
    return _let(end, lambda s: F.when(~left(s), s["found"]))


def _table(a: Column, b: Column) -> Column:
    """The digests in which two small sets differ, by ever larger tables: an attempt is made only where those before failed."""

    def attempt(doubled: Column) -> Column:
        third, seed = F.lit(LARGER) * F.call_function("shiftleft", F.lit(1), doubled), doubled + 1
        placed = F.concat(F.transform(a, lambda k: _placed(k, F.lit(1), third, seed)), F.transform(b, lambda k: _placed(k, F.lit(-1), third, seed)))
        return _let(placed, lambda p: peeled(cells(p, third), third, seed))

    last = F.raise_error(F.lit("a table didn't peel")).cast(_FOUND)
    tried = F.aggregate(F.sequence(F.lit(0), F.lit(DOUBLINGS)), F.lit(None).cast(_FOUND), lambda got, i: F.when(got.isNotNull(), got).otherwise(attempt(i)))
    return _let(tried, lambda t: F.when(t.isNotNull(), t).otherwise(last))


def _dealt(keys: Column, parts: Column, shift: int, part: Column) -> Column:
    return F.filter(keys, lambda k: F.pmod(F.shiftright(k, shift), parts) == part)


def difference(a: Column, b: Column, sketch_a: Column, sketch_b: Column) -> Column:
    """The digests in one of two sets only, as an array of (k, n), n telling the side. In two levels of parts, so that long texts cost little more a digest."""
    total = F.size(a) + F.size(b)
    parts = F.ceil(F.sqrt(F.ceil(total / PER_TABLE))).cast("long")

    def inner(p: Column) -> Column:
        sides = F.struct(_dealt(a, parts, 8, p).alias("a"), _dealt(b, parts, 8, p).alias("b"))
        one = lambda s: lambda q: _let(F.struct(_dealt(s["a"], parts, 29, q).alias("a"), _dealt(s["b"], parts, 29, q).alias("b")), lambda t: _table(t["a"], t["b"]))
        return _let(sides, lambda s: F.flatten(F.transform(F.sequence(F.lit(0).cast("long"), parts - 1), one(s))))

    large = F.flatten(F.transform(F.sequence(F.lit(0).cast("long"), parts - 1), inner))
    small = peeled(subtracted(sketch_a, sketch_b), F.lit(THIRD), F.lit(0))
    # more differing digests than cells never peel
    fits = F.abs(F.size(a) - F.size(b)) <= 3 * THIRD
    return F.when(total == 0, F.array().cast(_FOUND)).otherwise(F.coalesce(F.when(fits, small), large))


def side(found: Column, n: int) -> Column:
    """The digests of one side of a difference: 1 for the first, -1 for the second."""
    return F.transform(F.filter(found, lambda x: x["n"] == n), lambda x: x["k"])


def likeness(a: Column, b: Column, differing: Column) -> Column:
    """Shared digests over all: 1 for two texts without any."""
    total = F.size(a) + F.size(b)
    return F.when(total == 0, F.lit(1.0)).otherwise((total - differing) / (total + differing)).cast("double")


def as_text(s: Column) -> Column:
    part = lambda x: F.concat(F.hex(x["n"].cast("long")), F.lit("."), F.lpad(F.hex(x["k"]), 16, "0"), F.lpad(F.hex(x["h"]), 16, "0"))
    return F.array_join(F.transform(s, lambda x: F.when(x["n"] == 0, F.lit("")).otherwise(part(x))), "-")


KEY = ["nul", "k", "th"]


def in_order(docs: DataFrame) -> DataFrame:
    """(nul, k, th, head, quarter) to distinct (nul, k, th) with copies, the key of the next as n_nul, n_k, n_th, and of the one before as p_nul, p_k, p_th, with its quarter.

    The order is by k, nulls last, then by the head of the text; the last is
    followed by the first. Short rows only are sorted, in ranges as many as the shuffle has partitions.
    """
    keys = docs.groupBy(*KEY).agg(F.min("head").alias("head"), F.min("quarter").alias("quarter"), F.count("*").cast("int").alias("copies"))
    along = ["nul", "k", "head", "th"]
    x = written(keys.repartitionByRange(*along).withColumn("p", F.spark_partition_id()), "next-ranges")
    me, order = F.struct(*KEY, "quarter"), F.struct(*along)
    ends = x.groupBy("p").agg(F.min_by(me, order).alias("first"), F.max_by(me, order).alias("last"))
    w = W.orderBy("p")  # one row a range
    every = w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    ends = ends.select("p", F.coalesce(F.lag("last").over(w), F.last("last").over(every)).alias("before"))
    within = W.partitionBy("p").orderBy(*along)
    x = x.withColumn("lag", F.lag(me).over(within)).join(ends, "p").withColumn("prev", F.coalesce("lag", "before"))
    return x.select(*KEY, "copies", *[F.col(f"prev.{c}").alias(f"p_{c}") for c in (*KEY, "quarter")])


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text) to doc_id, text, its digests a, and of the next document in ascending order of ids the digests b and as much of its text as an edit takes (``patch``).

    Null ids come last; rows of one id go by the first 32 characters of the
    text. Of rows that are wholly equal each is followed by another, the last
    by the next document. Texts are exchanged once, and both sides of the
    last join read that exchange; of next documents only the beginnings and digests travel.
    """
    x = docs.select(F.col("doc_id").isNull().alias("nul"), F.coalesce("doc_id", F.lit(0)).alias("k"), F.xxhash64("text").alias("th"), "text")
    quarter = F.floor(F.length("text") / 4).cast("int")
    order = written(in_order(x.select(*KEY, F.substring("text", 1, 32).alias("head"), quarter.alias("quarter"))), "next-order")
    x = x.join(order, KEY).withColumn("copy", F.row_number().over(W.partitionBy(*KEY).orderBy("copies")))
    sent = x.where("copy = 1").select(*[F.col(f"p_{c}").alias(c) for c in KEY], F.substring("text", F.lit(1), F.col("p_quarter")).alias("patch"), digests(F.col("text")).alias("b"))
    x = x.select(*KEY, "text", "copy", "copies").withColumn("a", digests(F.col("text"))).withColumn("quarter", quarter)
    own = F.col("copy") < F.col("copies")
    return x.join(sent, KEY).select(
        F.when(~F.col("nul"), F.col("k")).alias("doc_id"), "text", "a", "quarter",
        F.when(own, F.substring("text", F.lit(1), F.col("quarter"))).otherwise(F.col("patch")).alias("patch"), F.when(own, F.col("a")).otherwise(F.col("b")).alias("b"),
    )


def fingerprint(docs: DataFrame) -> DataFrame:
    """One row a document, with its fingerprint, that of its edited text, both likenesses, and the paragraph digests that the edit took (``edited_lost``) and brought (``edited_gained``).

    Null texts count as empty; texts of any length count whole. Every row is
    a document, repeated rows and ids too; of equal ids the text whose first
    32 characters are lesser comes first. The only row of a table is its own
    next. An empty table gives no rows. Other columns are not looked at.
    """
    x = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    x = with_next(x).withColumn("n_chars", F.length("text").cast("long"))
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - F.col("quarter")), F.col("patch"))
    x = x.withColumn("edited", edited)
    x = x.select("doc_id", "n_chars", F.sha2(F.encode("edited", "utf-8"), 256).alias("edited_sha256"), "a", digests(F.col("edited")).alias("e"), "b")
    x = x.withColumns({f"s{c}": sketch(F.col(c)) for c in "aeb"})
    col = F.col
    x = x.withColumns({"de": difference(col("a"), col("e"), col("sa"), col("se")), "db": difference(col("a"), col("b"), col("sa"), col("sb"))})
    return x.select(
        "doc_id", "n_chars", "edited_sha256",
        as_text(col("sa")).alias("fingerprint"), as_text(col("se")).alias("edited_fingerprint"),
        likeness(col("a"), col("e"), F.size("de")).alias("near_edited"), likeness(col("a"), col("b"), F.size("db")).alias("near_next"),
        side(col("de"), 1).alias("edited_lost"), side(col("de"), -1).alias("edited_gained"),
    )


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint(table(spark, sf_dir, "documents")).drop("edited_lost", "edited_gained")
