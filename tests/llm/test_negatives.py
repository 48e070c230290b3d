"""Hard negatives against plain products over all pairs, and the bit-sliced products themselves."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomspark.llm import negatives as n


def plain(rows, positives=5, negatives=5):
    """Rows of (vec_id, label, vector)."""
    fit = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v) and sum((256 * x) ** 2 for x in v) < 2.0**56
    e = [(k, i, y, [math.floor(256 * float(np.float32(x))) for x in v]) for k, (i, y, v) in enumerate(rows) if y is not None and fit(v)]
    big, out = 1 << 63, Counter()
    for k, i, y, v in e:
        if i is None or i % 100:
            continue
        s = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), big if j is None else j, u, z == y) for u, j, z, w in e if u != k)
        for p in [x for x in s if x[3]][:positives]:
            fits = [x for x in s if not x[3] and 80 * -p[0] <= 100 * -x[0] <= 100 * -p[0]][:negatives]
            for r, x in enumerate(fits):
                out[i, None if p[1] == big else p[1], r + 1, None if x[1] == big else x[1], -p[0], -x[0]] += 1
    return out


@pytest.mark.parametrize("block_rows, block_anchors", [(2048, 512), (7, 3)])
def test_hard_negatives(spark, block_rows, block_anchors):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(4, 16))
    rows = [(int(k * 10), int(rng.integers(0, 3)), (base[k % 4] + rng.normal(size=16) * 0.6).tolist()) for k in range(150)]
    rows += [rows[10], rows[10], rows[20], (None, 1, rows[3][2]), (None, 0, rows[10][2]), (100, None, rows[1][2]), (200, 1, None), (300, 1, [math.nan] * 16), (400, 2, [math.inf, *rows[0][2][1:]])]
    rows += [(500, 1, [None, 1.0]), (600, 0, []), (700, 2, [1.0, 2.0]), (-100, 1, [-3.0] * 20), (800, 1, [3e38]), (900, -4, [2000.0] * 16), (1, 0, [0.0] * 16), (1000, 1, [0.0] * 16)]
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "vec_id long, label int, vector array<float>, uid int, id int, anchor string").repartition(3)
    got = n.mine(df, F.col("vec_id") % 100 == 0, block_rows=block_rows, block_anchors=block_anchors)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert Counter(map(tuple, got.collect())) == plain(rows)
    assert n.mine(df.where("false"), F.col("vec_id") % 100 == 0).collect() == []


@pytest.mark.parametrize("few", [0, 1 / 16, 1])
@pytest.mark.parametrize("most", [3, 300, 1 << 20])
def test_bit_planes_give_exact_products(few, most):
    rng = np.random.default_rng(most)
    a, c = rng.integers(-most, most, (9, 12)), rng.integers(-most, most, (40, 10))
    want = np.pad(c, ((0, 0), (0, 2))) @ a.T
    bounds, best = [], 4

    def keep(i, low, high):
        bounds.append((i, low, high))
        return high >= n.bar(i, low, len(a), best)[i]

    i, j, got = n.sliced(a, c, np.ones((9, 40), bool), keep, few)
    assert (got == want[j, i]).all() and (bounds[-1][1] == bounds[-1][2]).all()
    for k in range(9):
        assert sorted(got[i == k])[-best:] == sorted(want[:, k])[-best:]
    widths = [(high - low).max() for _, low, high in bounds]
    assert widths == sorted(widths, reverse=True) and len(bounds[-1][0]) < len(bounds[0][0])
