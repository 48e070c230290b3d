"""Repeats against brute force, and the suffix sort itself."""

import hashlib
import random

import numpy as np
import pytest

from loomspark.llm import substrings as sb

SCHEMA = "doc_id long, text string, h string, s string, k string"


def brute(rows):
    seen = {}
    for _, t in rows:
        d = (t or "").encode()
        for i in range(len(d) - 199):
            seen[d[i : i + 200]] = seen.get(d[i : i + 200], 0) + 1
    out = []
    for i, t in rows:
        d = (t or "").encode()
        gone = np.zeros(len(d), bool)
        for j in range(len(d) - 199):
            if seen[d[j : j + 200]] > 1:
                gone[j : j + 200] = True
        kept = np.frombuffer(d, np.uint8)[~gone].tobytes()
        out.append((i, len(d), hashlib.sha256(kept).hexdigest(), int((np.diff(np.append(0, gone.astype(int))) == 1).sum())))
    return sorted(out, key=str)


def result(spark, rows, hot):
    x = sb.remove_repeats(spark.createDataFrame([(i, t, "a", "b", "c") for i, t in rows], SCHEMA), hot)
    return sorted(((r.doc_id, r.n_bytes, hashlib.sha256(r.kept).hexdigest(), len(r.spans)) for r in x.collect()), key=str)


@pytest.mark.parametrize("hot", [16_000, 2])
def test_as_brute_force(spark, hot):
    rng = random.Random(hot)
    text = lambda n: "".join(rng.choice("abcdé \n") for _ in range(n))
    passage, other = text(260), text(230)
    rows = [(k, text(rng.randrange(300)) + passage[rng.randrange(40) :] + text(rng.randrange(300))) for k in range(25)]
    rows += [(100 + k, text(50) + other + text(10) + passage[:199]) for k in range(4)]
    rows += [(200, "ab" * 400), (201, "x" * 500), (202, "x" * 199), (203, "x" * 200), (204, text(5000)), (205, text(3000) * 2)]
    rows += [(300, None), (301, ""), (302, passage), (302, passage), (None, passage + "q")]
    assert result(spark, rows, hot) == brute(rows)


def test_empty(spark):
    assert result(spark, [], 10) == []


def test_two_stage_sort():
    rng = np.random.default_rng(3)
    for size in (1, 2, 7, 60, 400):
        for letters in (1, 2, 3, 200):
            t = np.append(rng.integers(0, letters, size), sb.END).astype(np.uint8)
            order = sb.suffix_order(t, np.append(np.ones(size, bool), False))
            b = t.tobytes()
            assert order.tolist() == sorted(range(size), key=lambda i: b[i : i + 200] if letters > 1 else b[i:])
            for x, y, got in zip(order, order[1:], sb.adjacent_prefixes(t, order), strict=False):
                same = next((k for k in range(200) if b[x + k : x + k + 1] != b[y + k : y + k + 1]), 200)
                assert got == same
