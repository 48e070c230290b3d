"""V1 and V3: a whole release, written with its reports, and verified from its files alone.

A release is a folder of session lines (``sessions``) and one of assessments
(``reports``), each with its manifest, and ``release.json`` with the totals.
Verification trusts none of them: files are hashed, lines counted, sessions
assessed again from their content, reports held against sessions by digest
trees, totals summed. Everything found is a row: check, subject, detail.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.checkpoint import shared, written
from ..operators.digests import differences
from ..sources import session_parts, sinks

#: What is recorded of each session beside its content.
RECORDED = T.StructType().add("fingerprint", "string").add("tokens", "long").add("score", "double").add("eligible", "boolean").add("failures", T.ArrayType(T.StringType()))
REPORT = T.StructType([T.StructField("key", T.StringType()), *RECORDED.fields, T.StructField("decision", T.StringType())])
DIVERGENT = T.StructType().add("key", "string").add("candidate_count", "long").add("fingerprints", T.ArrayType(T.StringType())).add("reason", "string")
#: Counts of what went in and didn't become a session, which the totals must add up with.
REMOVED = ["parse_failures", "exact_duplicates", "subset_snapshots"]
DIVERGENT_REASON, TOTALS = "divergent_session_snapshots", "release.json"
SHA256 = "^[0-9a-f]{64}$"


def totals_of(reports: DataFrame, divergent: DataFrame) -> dict:
    """The totals that reports and divergent sessions add up to."""
    won = F.col("eligible")
    r = reports.agg(F.count("*").alias("assessed"), F.count_if(won).alias("eligible"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("assessed_tokens"), F.coalesce(F.sum(F.when(won, F.col("tokens"))), F.lit(0)).alias("eligible_tokens")).first()
    d = divergent.agg(F.count("*").alias("divergent_sessions"), F.coalesce(F.sum("candidate_count"), F.lit(0)).alias("divergent_records")).first()
    reasons = reports.select(F.explode("failures").alias("f")).groupBy("f").count().collect()  # as many as there are gates
    return r.asDict() | d.asDict() | {"reasons": {x["f"]: x["count"] for x in reasons}}


def write_release(sessions: DataFrame, divergent: DataFrame, removed: dict[str, int], minimum: float, folder: str, target: int = 128 << 20, totals: dict | None = None, reports: DataFrame | None = None) -> None:
    """``sessions`` (key, content, and what is recorded) assessed: eligible ones to lines, all to reports; ``divergent`` as in DIVERGENT.

    ``totals`` are those that the reports add up to, and ``reports`` those of
    ``sessions``, unless given.
    """
    line = lambda *c: F.to_json(F.struct(*c), {"ignoreNullFields": "false"}).alias("line")
    names = [f.name for f in RECORDED]
    session_parts.write_parts(sessions.where("eligible").select(line("key", "content", *names)), f"{folder}/sessions", target)
    decision = F.when(F.col("eligible"), "eligible").otherwise("rejected")
    reports = sessions.withColumn("decision", decision) if reports is None else reports
    session_parts.write_parts(reports.select(line(*REPORT.fieldNames())), f"{folder}/reports", target)
    session_parts.write_parts(divergent.select(line(*DIVERGENT.fieldNames())), f"{folder}/divergent", target)
    found = totals or totals_of(reports, divergent)
    found = found | {k: removed.get(k, 0) for k in REMOVED}
    found["records"] = found.get("records", found["assessed"] + found["divergent_records"] + sum(removed.values()))
    found["status"] = "pass" if found["eligible"] and not found["parse_failures"] else "fail"
    sinks.write_text(sessions.sparkSession, f"{folder}/{TOTALS}", json.dumps(found | {"minimum": minimum}))


def _found(x: DataFrame, check: str | Column, subject: Column, detail: Column) -> DataFrame:
    check = F.lit(check) if isinstance(check, str) else check
    return x.select(check.alias("check"), subject.cast("string").alias("subject"), F.coalesce(detail.cast("string"), F.lit("")).alias("detail"))


def file_findings(spark: SparkSession, folder: str, lines: DataFrame) -> DataFrame:
    """Parts that are not as the manifest says: missing or unlisted, listed twice or outside, other sizes, hashes, records or bytes, empty lines.

    ``lines`` are those of ``lines_of``. Parts are hashed whole, so they are
    below 2 GB, as their target is.
    """
    listed = session_parts.read_manifest(spark, folder)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{folder}/data").select(_name(F.col("path")).alias("name"), F.col("length"), F.sha2("content", 256).alias("hash"))
    counted = lines.groupBy("of").agg(F.count("*").alias("lines"), F.sum("plain").alias("plain"), F.count_if("empty").alias("empty"))
    # a file without any line has no row there
    j = listed.join(files, listed["file"] == files["name"], "full").join(counted, F.col("name") == F.col("of"), "left")
    both = F.col("file").isNotNull() & F.col("name").isNotNull()
    other = lambda a, b: both & (F.col(a) != F.coalesce(F.col(b), F.lit(0)))
    checks = {
        "missing_file": F.col("name").isNull(), "unexpected_file": F.col("file").isNull(), "size_differs": other("bytes", "length"), "checksum_differs": both & (F.col("sha256") != F.col("hash")),
        "records_differ": other("records", "lines"), "bytes_differ": other("uncompressed_bytes", "plain"), "empty_line": F.coalesce(F.col("empty") > 0, F.lit(False)),
        "unsafe_path": F.coalesce(F.col("file").startswith("/") | F.col("file").rlike(r"(^|/)\.\.(/|$)"), F.lit(False)), "listed_twice": F.col("times") > 1,
    }
    j = j.join(listed.groupBy(F.col("file").alias("_f")).agg(F.count("*").alias("times")), F.col("file") == F.col("_f"), "left")
    failed = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in checks.items()]))
    return j.select(F.explode(failed).alias("check"), F.coalesce("file", "name").alias("subject"), F.lit("").alias("detail")).distinct()


def _name(path: Column) -> Column:
    # done for every line: a regular expression would be tried from each character of the path
    return F.substring_index(path, "/", -2)


def lines_of(spark: SparkSession, folder: str, schema: T.StructType, more: Callable[[DataFrame], DataFrame] = lambda x: x, drop: tuple[str, ...] = ()) -> DataFrame:
    """A folder's lines, read once and written: of (file), plain (bytes), empty, bad (the line's begin, where it can't be read), and its fields without ``drop``; ``more`` adds columns before."""
    text = spark.read.text(f"{folder}/data").select("value", _name(F.col("_metadata.file_path")).alias("of"))
    parsed = text.withColumn("r", F.from_json("value", T.StructType([*schema.fields, T.StructField("_bad", T.StringType())]), {"columnNameOfCorruptRecord": "_bad"}))
    empty = F.trim("value") == ""
    bad = ~empty & (F.col("r").isNull() | F.col("r._bad").isNotNull())
    x = parsed.select("of", (F.octet_length("value") + 1).cast("long").alias("plain"), empty.alias("empty"), F.when(bad, F.substring("value", 1, 80)).alias("bad"), (~empty & ~bad).alias("_good"), *[F.when(~bad, F.col(f"r.{n}")).alias(n) for n in schema.fieldNames()])
    return written(more(x).drop(*drop), "release-lines")


def verify_release(spark: SparkSession, folder: str, content: T.DataType, again: Callable[[DataFrame], DataFrame], weights: dict[str, float]) -> DataFrame:
    """All that is wrong with a release: check, subject, detail; no rows if nothing is.

    ``again`` takes sessions (key, content) and adds what should be recorded
    of them. ``weights`` are those of the gates, by which a report must be
    consistent in itself. Every file is read twice: hashed, and parsed; the
    rest works on what is recorded, without contents. Findings are written
    check by check.
    """
    names = [f.name for f in RECORDED]
    differ = F.array_compact(F.array(*[F.when(~F.col(n).eqNullSafe(F.col(f"_said_{n}")), F.lit(n)) for n in names]))

    def judged(x: DataFrame) -> DataFrame:
        x = again(x.withColumnsRenamed({n: f"_said_{n}" for n in names})).withColumn("differ", F.when(F.col("_good"), F.array_join(differ, ",")))
        return x.drop(*names).withColumnsRenamed({f"_said_{n}": n for n in names})

    schema = T.StructType([T.StructField("key", T.StringType()), T.StructField("content", content), *RECORDED.fields])
    all_lines = {"sessions": lines_of(spark, f"{folder}/sessions", schema, judged, ("content",)), "reports": lines_of(spark, f"{folder}/reports", REPORT), "divergent": lines_of(spark, f"{folder}/divergent", DIVERGENT)}
    sessions, reports, divergent = (x.where("_good") for x in all_lines.values())
    said = json.loads(spark.read.option("wholetext", True).text(f"{folder}/{TOTALS}").first()[0])
    to = f"{shared(spark)}/findings-{uuid.uuid4().hex}"

    def put(x: DataFrame) -> None:
        x.write.mode("append").parquet(to)

    for part, x in all_lines.items():
        put(_with_part(file_findings(spark, f"{folder}/{part}", x), part).union(_found(x.where("bad is not null"), "unreadable_line", F.lit(part), F.col("bad"))))
    # sessions against their own content, and among each other
    low = ~F.coalesce(F.col("eligible"), F.lit(False)) | (F.coalesce(F.col("score"), F.lit(-1.0)) < said["minimum"])
    twice = lambda x: x.groupBy("fingerprint").agg(F.count("*").alias("n"), F.min("key").alias("key")).where("n > 1")
    put(_found(sessions.where("differ != ''"), "assessment_differs", F.col("key"), F.col("differ")).union(_found(sessions.where(low), "not_eligible", F.col("key"), F.col("score"))))
    put(_found(twice(sessions), "duplicate_content", F.col("key"), F.col("n")))
    # reports in themselves
    due = sum((F.when(F.array_contains("failures", n), 0.0).otherwise(float(w)) for n, w in weights.items()), F.lit(0.0))
    whole = (F.col("score") == due) & (F.col("eligible") == (F.size("failures") == 0)) & (F.size(F.array_except("failures", F.array(*map(F.lit, weights)))) == 0)
    decided = F.col("decision") == F.when(F.col("eligible"), "eligible").otherwise("rejected")
    no = lambda c: ~F.coalesce(c, F.lit(False))
    faults = {"report_inconsistent": (no(whole), "score"), "decision_differs": (no(decided), "decision"), "invalid_fingerprint": (no(F.col("fingerprint").rlike(SHA256)), "fingerprint")}
    failed = F.array_compact(F.array(*[F.when(c, F.struct(F.lit(n).alias("check"), F.col(d).cast("string").alias("detail"))) for n, (c, d) in faults.items()]))
    x = reports.select("key", F.explode(failed).alias("f"))
    put(_found(x, F.col("f.check"), F.col("key"), F.col("f.detail")).union(_found(twice(reports), "duplicate_report", F.col("key"), F.col("n"))))
    fine = (F.col("candidate_count") >= 2) & (F.size("fingerprints") == F.col("candidate_count")) & F.forall("fingerprints", lambda f: F.coalesce(f.rlike(SHA256), F.lit(False))) & (F.col("reason") == DIVERGENT_REASON)
    put(_found(divergent.where(no(fine)), "divergent_inconsistent", F.col("key"), F.col("candidate_count")))
    # reports against sessions
    d = differences(sessions.select("key", *names), reports.where("eligible").select("key", *names), ["key"])
    state = F.when(F.col("state") == "missing", "report_without_session").when(F.col("state") == "extra", "session_without_report").otherwise("report_differs")
    put(_found(d, state, F.col("key"), F.col("differ")))
    # totals
    got = totals_of(reports, divergent)
    wrong = [("total_differs", k, f"{said.get(k)} is {v}") for k, v in got.items() if said.get(k) != v]
    s = sessions.agg(F.count("*").alias("n"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens")).first()
    wrong += [("session_total_differs", k, f"{said.get(k)} is {v}") for k, v in (("eligible", s["n"]), ("eligible_tokens", s["tokens"])) if said.get(k) != v]
    conserved = said.get("records") == sum(said.get(k, 0) for k in (*REMOVED, "assessed", "divergent_records"))
    wrong += [] if conserved else [("not_conserved", "records", str(said.get("records")))]
    status = "pass" if conserved and said.get("eligible") and not said.get("parse_failures") else "fail"
    wrong += [] if said.get("status") == status else [("status_differs", "status", f"{said.get('status')} is {status}")]
    schema = "check string, subject string, detail string"
    put(spark.createDataFrame(wrong, schema))  # as many as there are totals
    return spark.read.schema(schema).parquet(to)


def _with_part(x: DataFrame, part: str) -> DataFrame:
    return x.withColumn("subject", F.concat(F.lit(f"{part}/"), "subject"))


def strict(findings: DataFrame) -> None:
    """An error that names the first findings, if there are any."""
    if some := findings.limit(5).collect():
        raise ValueError("; ".join(f"{r['check']}: {r['subject']} {r['detail']}" for r in some))
