"""The pipeline against plain Python over a small folder of tables."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from loomspark.llm import bpe, mixing

from .test_nearcopies import brute
from .test_operators import plain_lines


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng, at = random.Random(12), tmp_path_factory.mktemp("sf")
    good = lambda n: "\n".join(" ".join(rng.choice(["rain", "house.", "of", "the", "tree"]) + str(rng.randrange(400)) for _ in range(12)) for _ in range(n))
    rows = []
    for k in range(240):
        bad = k % 6 == 0
        text = " ".join("THE!! OF!! HOUSE!!".split() * rng.randrange(10, 40)) if bad else good(rng.randrange(2, 9))
        if k % 10 == 2 and not bad:
            text = good(9).replace("\n", " ")  # one line, of which no line is a repeat
        if k % 10 == 3 and not bad and (k - 1) % 6:
            text = rows[-1][1].replace("rain", "sun", 1)  # a near copy
        if k % 7 == 2 and not bad:
            text += "\nAll rights reserved by nobody."
        rows.append((k, text, "en", rng.choice(["a", "b", None]), len(text)))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(str(at / "documents.parquet"))
    spark.createDataFrame([(k, int(k % 6 > 0), 0) for k in range(240)], "doc_id long, quality int, toxic int").write.parquet(str(at / "labels.parquet"))
    return str(at)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out.append(stage(spark, out[-1], folder))
        if k < 4:
            assert out[-1].columns == docs.columns
            out[-1] = out[-1].checkpoint() if spark.sparkContext._jsc.sc().getCheckpointDir().isDefined() else out[-1].cache()
    rows = [sorted(((r.doc_id, r.text) for r in x.select("doc_id", "text").collect())) for x in out[:-1]]
    assert [d for d, _ in rows[1]] == [k for k in range(240) if k % 6]
    assert rows[2] == sorted((d, t) for d, _, _, t in plain_lines(rows[1]))
    kept = {d for d, (_, c) in brute(rows[2]).items() if c == d}
    assert rows[3] == [r for r in rows[2] if r[0] in kept] and len(rows[3]) < len(rows[2])
    share = {r.doc_id: (r.taken, r.size) for r in mixing.mix(out[3]).collect()}
    copies = Counter(d for d, _ in rows[4])
    for d, (taken, size) in share.items():
        low = int(taken / max(size, 1))
        assert copies[d] in (low, low + 1)
    b = bpe.ByteBPE(bpe.default_path())
    want = Counter((d, len(b.encode(t)) // 4, hashlib.sha256(b.encode(t)).hexdigest(), hashlib.sha256(t.encode()).hexdigest()) for d, t in rows[4])
    assert Counter(tuple(r) for r in out[5].collect()) == want
    assert np.isclose(sum(copies[d] * share[d][1] for d in share), 1.5 * sum(s for _, s in share.values()), rtol=0.15)
    assert Counter(tuple(r) for r in corpus_pipeline.run(spark, folder).collect()) == want


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def unlabelled(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("odd")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(at / "labels.parquet"))
    return str(at)


def test_odd_rows(spark, unlabelled):
    """Nulls in every column, empty and very long texts, ties, repeated rows and clashing columns, stage by stage."""
    rows = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n", "en", "a", 3), (None, "a line that is long enough\nx", "en", None, 5), (4, "a line that is long enough\nx", None, "a", 5),
        (4, "a line that is long enough\nx", None, "a", 5), (5, "w " * 60_000, "en", "b", 7), (6, "y" * 100_000, "en", "b", 7), (7, "one two three four five six", "en", "b", 7), (8, "ONE two three four five six", "en", "b", 7),
    ]
    docs = spark.createDataFrame([(*r, "s", 0, "k") for r in rows], SCHEMA + ", _score string, N_LINES int, _gone string")
    got = [docs]
    for name, stage in corpus_pipeline.STAGES:
        got.append(stage(spark, got[-1], unlabelled))
        if len(got) < 6:
            assert got[-1].columns == corpus_pipeline.COLUMNS, name
            got[-1] = got[-1].cache()
    view = lambda k: sorted(((r.doc_id, r.text) for r in got[k].collect()), key=str)
    assert view(1) == sorted([(r[0], r[1]) for r in rows], key=str)  # without labels all stay
    lines = {(d, t) for d, t in view(2)}
    assert {(1, ""), (2, ""), (3, " \t\n"), (4, "a line that is long enough\nx"), (None, "x"), (8, "")} <= lines and len(view(2)) == 10
    assert view(3) == view(2)  # what is left has no near copies, and empty texts are none
    assert {d for d, _ in view(4)} <= {None, 4, 5, 6, 7} and all(t and t.strip() for _, t in view(4))
    assert Counter(d for d, _ in view(4))[4] % 2 == 0  # repeated rows are kept equally often
    assert sorted(r.doc_id or -1 for r in got[5].collect()) == sorted(d or -1 for d, _ in view(4))


def test_no_rows(spark, unlabelled):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, unlabelled).collect() == []
