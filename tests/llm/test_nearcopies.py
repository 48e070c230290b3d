"""Near copies against brute force, and the corner cases."""

import random
from itertools import combinations

import pytest

from loomspark.llm import nearcopies

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, sig string, node string"


def brute(rows):
    sets = {}
    for d, t in rows:
        w = (t or "").encode().lower().split()
        sets[d] = {b" ".join(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({b" ".join(w)} if w else set())
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            up[y] = x
    return {d: (len(s), root(d)) for d, s in sets.items()}


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "en", None, 1, "x", "y") for d, t in rows], SCHEMA)


def test_groups_about_the_threshold(spark):
    rng = random.Random(5)
    rows, words = [], [f"w{i}" for i in range(900)]
    for g in range(3):
        base = [rng.choice(words) for _ in range(150)]
        for k in range(70):
            t = base[:]
            for _ in range(rng.randrange(0, 8)):
                t[rng.randrange(len(t))] = rng.choice(words)
            rows.append((1000 * g + k * 7 % 71, " ".join(t)))
    passage = [rng.choice(words) for _ in range(60)]
    rows += [(5000 + k, " ".join(passage + [rng.choice(words) for _ in range(rng.randrange(5, 80))])) for k in range(80)]
    want = brute(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in nearcopies.near_copies(frame(spark, rows)).collect()}
    assert got == want
    assert 3 < len({c for _, c in want.values()}) < len(rows)


def test_small_blocks_find_the_same(spark, monkeypatch):
    monkeypatch.setattr(nearcopies, "OUTSIDE", 3)
    monkeypatch.setattr(nearcopies, "INSIDE", 5)
    monkeypatch.setattr(nearcopies, "COPY_LOAD", 4)
    rng = random.Random(8)
    words, rows = [f"v{i}" for i in range(400)], []
    base = [rng.choice(words) for _ in range(120)]
    for k in range(60):
        t = base[:]
        for _ in range(rng.randrange(2, 7)):
            t[rng.randrange(len(t))] = rng.choice(words)
        rows.append((k, " ".join(t)))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in nearcopies.near_copies(frame(spark, rows)).collect()} == brute(rows)


def test_corner_cases(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE  two"), (6, "one two three"), (7, "É b c d e f"), (8, "é b c d e f"), (None, "one two"), (9, "x" * 100_000), (9, "x" * 100_000), (10, "a b " * 50_000)]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in nearcopies.near_copies(frame(spark, rows)).collect()), key=str)
    assert got == sorted([(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False), (6, 1, 6, True), (7, 2, 7, True), (8, 2, 8, True), (None, 1, None, True), (9, 1, 9, True), (9, 1, 9, True), (10, 2, 10, True)], key=str)


def test_rows_of_one_id_join(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    got = {(r.doc_id, r.component_id) for r in nearcopies.near_copies(frame(spark, [(1, a), (2, a), (2, b), (3, b)])).collect()}
    assert got == {(1, 1), (2, 1), (3, 1)}


def test_empty(spark):
    assert nearcopies.near_copies(frame(spark, [])).collect() == []


@pytest.mark.parametrize("edges, want", [([], {}), ([(1, 2), (2, 3), (5, 4), (3, 3), (None, 1)], {1: 1, 2: 1, 3: 1, 4: 4, 5: 4})])
def test_components(spark, edges, want):
    from loomspark.llm.components import components

    assert {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()} == want


def test_components_of_a_long_chain(spark):
    from loomspark.llm.components import components

    chain = [(i, i + 1) for i in range(300)]
    assert {r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()} == {0}
