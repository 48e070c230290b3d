"""Phrase collocations against a plain version, and their parts."""

import random
import re
from collections import Counter
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomspark.llm import collocations as c

ROWS = [(1, None, "en"), (2, "", "en"), (3, " \t\n", None), (4, "one", None), (5, "A b\tC. a B c", "de"), (6, "é\x1c\x85 ok. ok", "de"), (7, "ab " * 60_000, "fr"), (8, "x" * 200_000, "fr")]


def plain(rows, fewest=10, absorbed=50, top=2000):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        low = (text or "").translate({k: k + 32 for k in range(65, 91)})
        for piece in re.split("[.,;:!?\n-\r]", low):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + k])) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    found = {k: v for k, v in f.items() if v >= fewest and len(k[1]) > 1}
    longest = Counter()
    for (lang, w), a in found.items():
        for part in {w[:2], w[1:]} if len(w) == 3 else ():
            longest[lang, part] = max(longest[lang, part], a)
    out = []
    for lang in n:
        best = []
        for (at, w), a in found.items():
            if at == lang and not (longest[at, w] and 100 * longest[at, w] >= absorbed * a):
                cuts = [(10**6 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
                score, k = min(cuts)
                best.append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(best)[:top])]
    return sorted(out)


@pytest.mark.parametrize("shard_words, bits", [(2_000_000, 1 << 26), (50, 64)])
def test_collocations(spark, shard_words, bits):
    rng = random.Random(5)
    words = [f"w{k}" for k in range(12)] + ["É", "zz"]
    rows = ROWS + [(10 + k, " ".join(rng.choice(words) + rng.choice(["", "", "", ".", ",\n"]) for _ in range(30)), rng.choice(["en", "de", None])) for k in range(120)]
    rows += rows[-3:]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "doc_id long, text string, lang string, f int, words int, phrase int").repartition(3)
    got = c.collocations(df, top=25, shard_words=shard_words, filter_bits=bits)
    assert got.dtypes == [("lang", "string"), ("rank", "bigint"), ("phrase", "string"), *[(x, "bigint") for x in ("a", "l", "r", "n", "score")]]
    assert sorted(tuple(r) for r in got.collect()) == plain(rows, top=25)
    assert c.collocations(df.where("false")).collect() == []


def test_long_scores_are_exact(spark):
    rows = [(10**15, 10**15, 10**15), (999_999_999_999_989, 10**15 - 1, 10**15 - 3), (10, 33, 37), (3 * 10**12, 4 * 10**13, 5 * 10**12 + 1)]
    got = spark.createDataFrame(rows, "a long, l long, r long").select(c.exact_score(F.col("a"), F.col("l"), F.col("r")))
    assert [r[0] for r in got.collect()] == [int(Decimal(10**6 * a * a // (l * r))) for a, l, r in rows]


def test_suffix_array_and_intervals():
    ids = np.random.default_rng(3).integers(0, 5, 400).astype(np.int32)
    for n in (1, 2, 3):
        at, f = c.intervals(ids, n)
        want = Counter(tuple(ids[i : i + n].tolist()) for i in range(len(ids) - n + 1) if (ids[i : i + n] != 0).all())
        assert {tuple(ids[i : i + n].tolist()): int(k) for i, k in zip(at, f, strict=True)} == want
    order = c.suffix_array(ids, len(ids))
    assert order.tolist() == sorted(range(len(ids)), key=lambda i: ids[i:].tolist())
