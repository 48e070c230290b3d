"""Exact removal of repeated 200-byte strings with suffix arrays.

Sorting all suffixes of a large corpus in one place is out of the question,
so texts are first cut down to what can repeat. The anchor of a 200-byte string
is that one of its 32-byte strings which hashes least, so it depends on its
own bytes only, and neighbouring strings mostly share it. Equal strings have
equal anchors; a string whose anchor occurs once is unique. Of an anchor that
recurs, the contexts (all 200-byte strings that have it in one place, as one
piece of text) are compared: equal contexts repeat as a whole, and one of
each distinct kind goes to a suffix array for the anchor.

The suffix arrays are sorted in two stages: suffixes smaller than their
successors are sorted directly, the others are induced from them by one scan
over the buckets; adjacent common prefixes of 200 bytes mark the repeats.
Anchors with too many distinct contexts for one task are settled by grouping
hashes of their strings instead, which finds the same repeats.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, ship, slices, table, written

SPAN, GRAM = 200, 32
WINDOW = SPAN - GRAM + 1
#: Bytes of contexts sorted at once; distinct contexts of an anchor (some 300 bytes each, and 60 times that in
#: memory while they are sorted, so 300 MB) beyond which their strings are grouped by hash.
SORT_BYTES, HOT = 1_500_000, 16_000
NO_ID = (1 << 63) - 1
#: Ends a context; no byte of UTF-8 is as large.
END = 0xFF

_rng = np.random.default_rng(64)
#: Two polynomial hashes, so that equality of strings has 128 bits: values of bytes and base of each.
_BYTE = [_rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2)]
_BASE = [int(_rng.integers(0, 1 << 62)) * 2 + 1 for _ in range(2)]


@lru_cache(2)
def _kept_powers(which: int) -> list[np.ndarray]:
    return _made_powers(which, 1 << 16)


def _made_powers(which: int, n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse."""
    out = []
    for b in (_BASE[which], pow(_BASE[which], -1, 1 << 64)):
        x = np.full(n, b, np.uint64)
        x[0] = 1
        out.append(np.multiply.accumulate(x))
    return out


def _sums(which: int, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of a text's polynomial, and the powers that shift a difference of them to the front."""
    n = len(data)
    up, down = _kept_powers(which) if n < 1 << 16 else _made_powers(which, n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[which][np.frombuffer(data, np.uint8)] * up[:n], out=sums[1:])
    return sums, down


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _sliding(x: np.ndarray, width: int, op) -> np.ndarray:
    have = 1
    while 2 * have <= width:
        x = op(x[:-have], x[have:])
        have *= 2
    return op(x[: len(x) - (width - have)], x[width - have :]) if have < width else x


def anchors(data: bytes) -> tuple[np.ndarray, ...] | None:
    """Of a text: hash of each anchor, two hashes of its context, first and last start of the strings that it is the anchor of."""
    n = len(data)
    if n < SPAN:
        return None
    sums, down = _sums(0, data)
    m = n - GRAM + 1
    grams = _mixed((sums[GRAM:] - sums[:m]) * down[:m])
    # the place goes into the low bits, so that the first of the least is found with it
    bits = np.uint64(m.bit_length())
    least = _sliding(grams >> bits << bits | np.arange(m, dtype=np.uint64), WINDOW, np.minimum)
    at = (least & (np.uint64(1) << bits) - np.uint64(1)).astype(np.int64)  # of each 200-byte string, its anchor
    first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    last = np.append(first[1:] - 1, len(at) - 1)
    chosen = at[first]
    context = []
    for sums, down in ((sums, down), _sums(1, data)):
        context.append(_mixed((sums[last + SPAN] - sums[first]) * down[first] + (last - first).astype(np.uint64)).view(np.int64))
    return grams[chosen].view(np.int64), *context, first.astype(np.int32), last.astype(np.int32)


def _types(t: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its successor (that of the last isn't)."""
    ends = np.flatnonzero(np.append(t[1:] != t[:-1], True))  # of runs of one byte
    smaller = np.append(t[ends[:-1]] < t[ends[1:]], False)
    return np.repeat(smaller, np.diff(np.concatenate([[-1], ends])))


def suffix_order(t: np.ndarray, wanted: np.ndarray, depth: int = SPAN) -> np.ndarray:
    """Two-stage sort of the wanted suffixes of ``t``, to ``depth`` bytes at least.

    With a larger suffix the next smaller one must be wanted too, and all between.
    """
    small = _types(t)
    data = t.tobytes()
    direct = sorted(np.flatnonzero(wanted & small).tolist(), key=lambda p: data[p : p + depth])
    direct = np.array(direct, np.int64)
    heads = t[direct] if len(direct) else np.empty(0, np.uint8)
    at = np.searchsorted(heads, np.arange(257))
    larger = wanted & ~small
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    order: list[np.ndarray] = []

    def induce(done: np.ndarray) -> None:
        before = done[done > 0] - 1
        before = before[larger[before]]
        if len(before):
            c = t[before]
            by = np.argsort(c, kind="stable")
            before, c = before[by], c[by]
            cuts = np.flatnonzero(np.diff(c)) + 1
            for part in np.split(before, cuts):
                waiting[t[part[0]]].append(part)

    for c in range(256):
        k = 0
        while k < len(waiting[c]):  # a run of one byte adds to the bucket that is being scanned
            order.append(waiting[c][k])
            induce(waiting[c][k])
            k += 1
        waiting[c] = []
        same = direct[at[c] : at[c + 1]]
        if len(same):
            order.append(same)
            induce(same)
    return np.concatenate(order) if order else np.empty(0, np.int64)


def adjacent_prefixes(t: np.ndarray, order: np.ndarray, most: int = SPAN) -> np.ndarray:
    """Common prefix of each suffix with the next in order, up to ``most`` (a multiple of 8) bytes."""
    padded = np.concatenate([t, np.full(most + 8, END, np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    words = np.ascontiguousarray(words).view(">u8").ravel().astype(np.uint64)
    a, b = order[:-1], order[1:]
    out, left = np.zeros(len(a), np.int32), np.arange(len(a))
    for at in range(0, most, 8):
        if not len(left):
            break
        differ = words[a[left] + at] ^ words[b[left] + at]
        rest = differ[differ != 0]
        out[left] += np.where(differ == 0, 8, 0).astype(np.int32)
        if len(rest):
            lead = np.zeros(len(rest), np.int32)
            for k in range(1, 8):
                lead += (rest >> np.uint64(64 - 8 * k) == 0).astype(np.int32)
            out[left[differ != 0]] += lead
        left = left[differ == 0]
    return out


def repeated_starts(contexts: list[bytes]) -> list[np.ndarray]:
    """Of each context, the starts of its 200-byte strings that occur elsewhere in these contexts."""
    lengths = np.array([len(c) for c in contexts], np.int64)
    base = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    t = np.frombuffer(b"".join(c + b"\xff" for c in contexts), np.uint8)
    last = base + lengths - SPAN
    # wanted: the starts, and what a larger last start is induced from
    small = np.where(_types(t), np.arange(len(t)), len(t))
    until = np.minimum.accumulate(small[::-1])[::-1][last]
    mark = np.zeros(len(t) + 1, np.int32)
    np.add.at(mark, base, 1)
    np.add.at(mark, until + 1, -1)
    wanted = np.cumsum(mark[:-1]) > 0
    order = suffix_order(t, wanted)
    starts = np.zeros(len(t), bool)
    mark[:] = 0
    np.add.at(mark, base, 1)
    np.add.at(mark, last + 1, -1)
    starts = np.cumsum(mark[:-1]) > 0
    order = order[starts[order]]
    equal = np.flatnonzero(adjacent_prefixes(t, order) >= SPAN)
    found = np.zeros(len(t), bool)
    found[order[equal]] = found[order[equal + 1]] = True
    return [np.flatnonzero(found[b : e + 1]) for b, e in zip(base, last, strict=True)]


def _runs(x: np.ndarray) -> list[tuple[int, int]]:
    """Sorted numbers to runs, first and last."""
    cuts = np.flatnonzero(np.diff(x) != 1)
    return list(zip(x[np.concatenate([[0], cuts + 1])].tolist(), x[np.append(cuts, len(x) - 1)].tolist(), strict=True)) if len(x) else []


def _anchor_rows(docs: DataFrame) -> DataFrame:
    names = ["h", "c", "c2", "k", "th", "s", "t"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            out: list[list] = [[] for _ in names]
            for k, th, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                if found := anchors((text.as_py() or "").encode("utf-8", "surrogatepass")):
                    n = len(found[0])
                    for c, v in zip(out, (*found[:3], np.full(n, k), np.full(n, th), *found[3:]), strict=True):
                        c.append(v)
                if len(out[0]) >= 1000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=names)
                    out = [[] for _ in names]
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=names)

    return docs.mapInArrow(run, "h long, c long, c2 long, k long, th long, s int, t int")


def _contexts(needed: DataFrame, docs: DataFrame) -> DataFrame:
    """Rows (h, kinds, n, rep: k, th, s, t) with the bytes of the context."""
    by_doc = needed.groupBy("rep.k", "rep.th").agg(F.collect_list(F.struct("h", "kinds", "n", "rep.s", "rep.t")).alias("parts"))
    joined = by_doc.join(docs.withColumnRenamed("k", "dk").withColumnRenamed("th", "dth"), (F.col("k") == F.col("dk")) & (F.col("th") == F.col("dth")))
    joined = joined.dropDuplicates(["k", "th"]).select("k", "th", "text", "parts")
    names = ["h", "kinds", "n", "k", "th", "s", "context"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            for lo in range(0, b.num_rows, 200):
                out: list[list] = [[] for _ in names]
                for row in b.slice(lo, 200).to_pylist():
                    data = row["text"].encode("utf-8", "surrogatepass")
                    for p in row["parts"]:
                        for c, v in zip(out, (p["h"], p["kinds"], p["n"], row["k"], row["th"], p["s"], data[p["s"] : p["t"] + SPAN]), strict=True):
                            c.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=names)

    return joined.mapInArrow(run, "h long, kinds long, n long, k long, th long, s int, context binary")


def _sorted_repeats(contexts: DataFrame) -> DataFrame:
    """Repeats within contexts, by suffix arrays over whole anchors: k, th, s, e (bytes)."""
    names = ["k", "th", "s", "e"]

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        out: list[list] = [[] for _ in names]
        for (_, _, k, th, s, _), found in zip(rows, repeated_starts([r[5] for r in rows]), strict=True):
            for a, z in _runs(found):
                for c, v in zip(out, (k, th, s + a, s + z + SPAN), strict=True):
                    c.append(v)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0
        for b in slices(batches):
            for row in zip(*(b.column(i).to_pylist() for i in range(6)), strict=True):
                if size >= SORT_BYTES and row[0] != rows[-1][0]:
                    yield solve(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[5])
        if rows:
            yield solve(rows)

    x = contexts.select("h", "n", "k", "th", "s", "context").repartition("h").sortWithinPartitions("h")
    return x.mapInArrow(run, "k long, th long, s int, e int")


def _grouped_repeats(contexts: DataFrame) -> DataFrame:
    """The same for anchors of very many contexts: strings of equal hashes, grouped."""
    names = ["w", "w2", "v", "k", "th", "i"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            for lo in range(0, b.num_rows, 500):
                out: list[list] = [[] for _ in names]
                for h, k, th, s, data in zip(*(b.slice(lo, 500).column(i).to_pylist() for i in range(5)), strict=True):
                    m, w = len(data) - SPAN + 1, []
                    for sums, down in (_sums(0, data), _sums(1, data)):
                        w.append(_mixed((sums[SPAN:] - sums[:m]) * down[:m]).view(np.int64))
                    for c, v in zip(out, (*w, np.full(m, h), np.full(m, k), np.full(m, th), np.arange(s, s + m, dtype=np.int32)), strict=True):
                        c.append(v)
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=names)

    x = contexts.select("h", "k", "th", "s", "context").mapInArrow(run, "w long, w2 long, v long, k long, th long, i int")
    counts = x.groupBy("w", "w2", "v").agg(F.count("*").alias("n")).where("n > 1").select("w", "w2", "v")
    return x.join(counts, ["w", "w2", "v"]).select("k", "th", F.col("i").alias("s"), (F.col("i") + SPAN).alias("e"))


def repeats(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """``(k, th, text)`` to byte ranges (k, th, s, e) whose union is what repeats."""
    found = _anchor_rows(docs)
    # written, so that both sides of the join are plain exchanges, which adaptive execution can split
    several = written(found.groupBy("h").agg(F.count("*").alias("total")).where("total > 1").select("h"), "spans-several")
    found = written(found.join(several, "h"), "spans-anchors")
    kinds = found.groupBy("h", "c", "c2").agg(F.count("*").alias("n"), F.min(F.struct("k", "th", "s", "t")).alias("rep"))
    kinds = written(kinds, "spans-kinds")
    per_anchor = kinds.groupBy("h").agg(F.count("*").alias("kinds")).where("kinds > 1")
    whole = found.join(kinds.where("n > 1").select("h", "c", "c2"), ["h", "c", "c2"]).select("k", "th", "s", (F.col("t") + SPAN).alias("e"))
    contexts = written(_contexts(kinds.join(per_anchor, "h"), docs), "spans-contexts")
    mixed = _sorted_repeats(contexts.where(F.col("kinds") <= hot))
    rest = _grouped_repeats(contexts.where(F.col("kinds") > hot))
    return whole.union(mixed).union(rest)


def remove_repeats(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """``docs`` with ``kept`` (binary: the remaining bytes), ``spans`` (what went) and ``n_bytes`` added.

    Every byte goes that lies in a 200-byte string that also starts elsewhere,
    in the same text too. A text is its UTF-8 bytes; null is empty; texts
    below 200 bytes keep all, longer ones are searched whole. A repeated row is another
    document, so it and the first lose all (of 200 bytes or more); null ids
    are ids. An empty table gives no rows. All other columns are kept,
    but one that is already named like a new column, in any case, is replaced.
    """
    ship(docs.sparkSession)
    docs = docs.drop("kept", "spans", "n_bytes")
    _k, _th, _ranges, _rk, _rth = fresh(docs, "_k", "_th", "_ranges", "_rk", "_rth")
    keys = {_k: F.coalesce("doc_id", F.lit(NO_ID)), _th: F.xxhash64("text")}
    found = repeats(docs.select(keys[_k].alias("k"), keys[_th].alias("th"), "text"), hot)
    ranges = found.groupBy("k", "th").agg(F.collect_set(F.struct("s", "e")).alias(_ranges)).toDF(_rk, _rth, _ranges)
    keep = docs.columns
    at = [c.lower() for c in keep].index("text")
    joined = docs.withColumns(keys).join(ranges, (F.col(_k) == F.col(_rk)) & (F.col(_th) == F.col(_rth)), "left").select(*keep, _ranges)
    span = T.ArrayType(T.StructType([T.StructField("s", T.IntegerType()), T.StructField("e", T.IntegerType())]))
    schema = T.StructType([*docs.schema.fields, T.StructField("kept", T.BinaryType()), T.StructField("spans", span), T.StructField("n_bytes", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans_type = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))
        for b in slices(batches):
            kept, spans, sizes = [], [], []
            for text, ranges in zip(b.column(at), b.column(len(keep)).to_pylist(), strict=True):
                data = (text.as_py() or "").encode("utf-8", "surrogatepass")
                merged: list[list[int]] = []
                for s, e in sorted((r["s"], r["e"]) for r in ranges or ()):
                    if merged and s <= merged[-1][1]:
                        merged[-1][1] = max(e, merged[-1][1])
                    else:
                        merged.append([s, e])
                edges = [0, *[x for m in merged for x in m], len(data)]
                kept.append(b"".join(data[i:j] for i, j in zip(edges[::2], edges[1::2], strict=True)))
                spans.append([{"s": s, "e": e} for s, e in merged])
                sizes.append(len(data))
            new = [pa.array(kept, pa.binary()), pa.array(spans, spans_type), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(len(keep))], *new], names=[*keep, "kept", "spans", "n_bytes"])

    return joined.mapInArrow(run, schema)


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return x.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )
