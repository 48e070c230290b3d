"""Parts written by size, digest trees, and whole releases that were changed."""

import gzip
import hashlib
import json
import os
import shutil
import time

import pytest
from pyspark.sql import functions as F

from loomspark.operators import digests, score
from loomspark.plans import verified
from loomspark.sources import session_parts

GATES = {"long": 60.0, "plain": 40.0}


def assessed(x):
    t = F.col("content.text")
    x = score.assess(x, {"long": F.length(t) >= 5, "plain": ~t.contains("|")}, GATES)
    return x.withColumns({"fingerprint": F.sha2(t, 256), "tokens": F.length(t).cast("long")})


def test_parts_roll_by_compressed_bytes(spark, tmp_path):
    rows = [(f"{k} " + "".join(hashlib.sha512(f"{k}-{j}".encode()).hexdigest() for j in range(6)),) for k in range(400)] + [(None,), ("",), ("x" * 200_000,)]
    df = spark.createDataFrame(rows, "line string").repartition(2)
    session_parts.write_parts(df, f"file://{tmp_path}/r", 20_000)
    parts = session_parts.read_manifest(spark, f"{tmp_path}/r").collect()
    assert sorted(os.listdir(tmp_path / "r")) == ["data", "manifest.json"]
    assert sorted(p.file for p in parts) == sorted(f"data/{x}" for x in os.listdir(tmp_path / "r/data"))
    got = []
    for p in parts:
        raw = (tmp_path / "r" / p.file).read_bytes()
        lines = gzip.decompress(raw).decode().split("\n")[:-1]
        assert (len(raw), hashlib.sha256(raw).hexdigest(), len(lines), sum(len(x) + 1 for x in lines)) == (p.bytes, p.sha256, p.records, p.uncompressed_bytes)
        got += lines
    assert sorted(got) == sorted(r[0] for r in rows if r[0] is not None)
    assert len(parts) > 2 and sum(p.bytes >= 20_000 for p in parts) >= len(parts) - 2 and max(p.bytes for p in parts) < 60_000
    with pytest.raises(Exception, match="manifest.json"):
        session_parts.write_parts(df, f"file://{tmp_path}/r", 20_000)
    assert sorted(os.listdir(tmp_path / "r")) == ["data", "manifest.json"]
    session_parts.write_parts(df.limit(3), f"file://{tmp_path}/r", 20_000, overwrite=True)
    assert session_parts.read_manifest(spark, f"{tmp_path}/r").agg(F.sum("records")).first()[0] == spark.read.text(f"{tmp_path}/r/data").count()


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    broken = spark.range(0, 100, 1, 4).select(F.when(F.col("id") == 99, F.raise_error(F.lit("killed"))).otherwise(F.col("id").cast("string")).alias("line"))
    with pytest.raises(Exception, match="killed"):
        session_parts.write_parts(broken, f"file://{tmp_path}/r", 10)
    left = lambda: [x for x in os.listdir(tmp_path / "r") if not x.startswith("_staging-")] if (tmp_path / "r").exists() else []
    assert left() == []
    time.sleep(2)  # its other tasks end meanwhile
    session_parts.write_parts(spark.range(3).selectExpr("string(id)"), f"file://{tmp_path}/r", 10)
    assert sorted(os.listdir(tmp_path / "r")) == ["data", "manifest.json"] and spark.read.text(f"{tmp_path}/r/data").count() == 3


def test_digest_trees(spark):
    rows = [(k % 90 if k < 95 else None, k % 7 if k % 5 else None, f"v{k}") for k in range(100)]
    a = spark.createDataFrame(rows, "k int, n int, v string")
    assert digests.differences(a, a.repartition(3), ["k"]).collect() == [] == digests.differences(a.where("false"), a.where("false"), ["k"]).collect()
    b = [(k, 9 if v == "v11" else n, v) for k, n, v in rows if v not in ("v12", "v97")] + [rows[20], (500, 1, "new"), (None, None, None)]
    got = {(r.k, r.state, r.differ, r.only_actual, r.only_expected) for r in digests.differences(spark.createDataFrame(b, "k int, n int, v string"), a, ["k"], bits=(2, 4)).collect()}
    assert got == {(11, "different", "n", 1, 1), (12, "missing", "", 0, 1), (20, "extra", "", 1, 0), (500, "extra", "", 1, 0), (None, "different", "n,v", 1, 1)}


@pytest.fixture
def release(spark, tmp_path):
    rows = [(f"k{k}", (f"text {k}" if k % 4 else "ab|" * (k % 3) + "x",)) for k in range(1, 60)]
    seen = {}
    rows = [r for r in rows if seen.setdefault(r[1], r[0]) == r[0]]
    x = assessed(spark.createDataFrame(rows, "key string, content struct<text:string>"))
    sha = hashlib.sha256(b"a").hexdigest()
    divergent = spark.createDataFrame([("d", 2, [sha, sha], "divergent_session_snapshots")], verified.DIVERGENT)
    verified.write_release(x.repartition(2), divergent, {"exact_duplicates": 59 - len(rows)}, 100.0, f"{tmp_path}/r", 300)
    return tmp_path / "r", x.schema["content"].dataType


def found(spark, release):
    folder, content = release
    return {(r["check"], r["subject"]) for r in verified.verify_release(spark, str(folder), content, assessed, GATES).collect()}


def rewrite(folder, part, change):
    """A part with other lines, and the manifest that goes with it."""
    m = json.loads((folder / part / "manifest.json").read_text())
    p = m["parts"][0]
    lines = change(gzip.decompress((folder / part / p["file"]).read_bytes()).decode().split("\n")[:-1])
    data = gzip.compress("".join(x + "\n" for x in lines).encode())
    (folder / part / p["file"]).write_bytes(data)
    p |= {"records": len(lines), "bytes": len(data), "uncompressed_bytes": sum(len(x.encode()) + 1 for x in lines), "sha256": hashlib.sha256(data).hexdigest()}
    (folder / part / "manifest.json").write_text(json.dumps(m))


def test_a_line_s_file_is_named_at_once_however_long_its_path(spark):
    at = "file:/" + "/".join(["a" * 200] * 18)
    x = spark.range(0, 10_000, 1, 4).select(verified._name(F.concat(F.lit(f"{at}/data/part-"), F.col("id") % 3)).alias("of"))
    spark.range(1).count()
    began = time.time()
    assert {tuple(r) for r in x.groupBy("of").count().collect()} == {("data/part-0", 3334), ("data/part-1", 3333), ("data/part-2", 3333)}
    assert time.time() - began < 10  # by a regular expression, which looks at each stretch of the path: many times that


def test_an_untouched_release_has_no_findings(spark, release):
    assert found(spark, release) == set()
    verified.strict(verified.verify_release(spark, str(release[0]), release[1], assessed, GATES))


def test_changed_files_are_named(spark, release):
    data = release[0] / "sessions/data"
    a, b = sorted(os.listdir(data))[:2]
    raw = bytearray((data / a).read_bytes())
    (data / a).write_bytes(gzip.compress(gzip.decompress(bytes(raw)) + b"\n"))
    shutil.copy(data / b, data / "part-9.jsonl.gz")
    os.remove(data / b)
    got = found(spark, release)
    assert {("checksum_differs", f"sessions/data/{a}"), ("records_differ", f"sessions/data/{a}"), ("bytes_differ", f"sessions/data/{a}"), ("empty_line", f"sessions/data/{a}")} <= got
    assert {("missing_file", f"sessions/data/{b}"), ("unexpected_file", "sessions/data/part-9.jsonl.gz")} <= got
    with pytest.raises(ValueError, match=":"):
        verified.strict(verified.verify_release(spark, str(release[0]), release[1], assessed, GATES))


def test_changed_sessions_are_named(spark, release):
    folder = release[0]
    kept = []

    def change(lines):
        rows = [json.loads(x) for x in lines]
        kept.extend(r["key"] for r in rows)
        rows[0]["content"]["text"] += "!"
        rows[1]["score"] = 50.0
        return [json.dumps(r) for r in [*rows, rows[2]]] + ["{broken"]

    rewrite(folder, "sessions", change)
    got = found(spark, release)
    assert {("assessment_differs", kept[0]), ("assessment_differs", kept[1]), ("not_eligible", kept[1]), ("report_differs", kept[1]), ("duplicate_content", kept[2]), ("session_without_report", kept[2]), ("unreadable_line", "sessions"), ("session_total_differs", "eligible")} <= got
    assert not any(c.endswith("_file") or c in ("checksum_differs", "records_differ") for c, _ in got)


def test_changed_reports_and_totals_are_named(spark, release):
    folder, keys = release[0], {}

    def change(lines):
        rows = [json.loads(x) for x in lines]
        won = [r for r in rows if r["eligible"]]
        keys.update(zip("abcd", (r["key"] for r in won), strict=False))
        won[0]["decision"], won[1]["fingerprint"], won[2]["failures"] = "rejected", "zz", ["odd"]
        rows.remove(won[3])
        return [json.dumps(r) for r in rows]

    rewrite(folder, "reports", change)
    rewrite(folder, "divergent", lambda lines: [lines[0].replace('"candidate_count":2', '"candidate_count":3')])
    said = json.loads((folder / "release.json").read_text())
    (folder / ".release.json.crc").unlink()  # of Hadoop's local file system
    (folder / "release.json").write_text(json.dumps(said | {"records": said["records"] + 1}))
    got = found(spark, release)
    assert {("decision_differs", keys["a"]), ("invalid_fingerprint", keys["b"]), ("report_differs", keys["b"]), ("report_inconsistent", keys["c"]), ("session_without_report", keys["d"]), ("divergent_inconsistent", "d"), ("not_conserved", "records"), ("status_differs", "status"), ("total_differs", "assessed")} <= got
