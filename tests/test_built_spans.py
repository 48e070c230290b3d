"""Spans from observations, and nesting by brackets against a stack."""

import random

import pytest
from pyspark.sql import functions as F

from loomspark.operators import built_spans as b

PHASES = "scope string, seq long, id string, phase string"


def by_stack(rows):
    out, stacks = [], {}
    for s, n, i, p in sorted((r for r in rows if r[3] in ("start", "end")), key=lambda r: (str(r[0]), r[1])):
        st = stacks.setdefault(s, [])
        if p == "start":
            st.append([s, len(st) + 1, i, n, None, st[-1][2] if st else None, "open"])
            out.append(st[-1])
        elif st:
            x = st.pop()
            x[4], x[6] = n, "closed" if x[2] == i else "crossing"
        else:
            out.append([s, None, i, None, n, None, "unopened"])
    return sorted(map(tuple, out), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_brackets(spark, seed):
    rng = random.Random(seed)
    rows = []
    for s in ["a", "b", None, "hot"]:
        st = []
        for n in range(120 if s == "hot" else 25):
            if rng.random() < 0.5 and (st or rng.random() < 0.3):
                rows.append((s, n, st.pop() if st and rng.random() < 0.8 else f"x{n}", "end"))
            else:
                st.append(f"c{n}")
                rows.append((s, n, f"c{n}", "start" if rng.random() < 0.95 else rng.choice([None, "note"])))
    x = spark.createDataFrame(rows, PHASES).repartition(5)
    assert sorted(map(tuple, b.nested(x).collect()), key=str) == by_stack(rows)
    assert b.nested(x.where("false")).collect() == []


def test_root_spans(spark):
    rows = [
        # a session that closed, with a turn by hooks and one seen on the wire only
        ("session", "s1", 1, 10, None, "session_start", None, "s1", "a"), ("session", "s1", 9, 90, None, "session_end", "closed", "s1", "b"),
        ("turn", "t1", 2, 20, None, "turn_start", None, "s1", "c"), ("turn", "t1", 3, 30, None, "turn_end", "completed", "s1", "d"), ("turn", "t1", 4, 31, None, "compaction_start", None, "s1", "e"),
        ("turn", "t2", 5, 50, "api_snapshot", None, None, "s1", "f"),
        # a session reopened; one whose boundaries don't alternate; ends that differ; a failed task; nothing
        ("session", "s2", 1, 1, None, "session_start", None, "s2", "g"), ("session", "s2", 2, 2, None, "session_end", "closed", "s2", "h"), ("session", "s2", 3, 3, None, "session_start", None, "s2", "i"),
        ("session", "s3", 1, 1, None, "session_end", "closed", "s3", "j"), ("session", "s3", 2, 2, None, "session_start", None, "s3", "k"), ("session", "s3", 3, 3, None, "session_cancelled_by_user", "closed", "s3", "l"),
        ("turn", "t3", 1, 1, None, "subagent_spawn", None, None, "m"), ("turn", "t3", 2, 2, None, "subagent_join", "completed", None, "n"), ("turn", "t3", 3, 3, None, "turn_interrupt", "cancelled", None, "o"),
        ("task", "k", 1, 1, None, "task_start", None, None, "p"), ("task", "k", 2, 2, None, "task_cancel_x", "failed", None, "q"), ("task", "n", 1, 1, None, "turn_start", None, None, "r"),
    ]
    x = spark.createDataFrame(rows, "scope_kind string, scope_id string, seq long, at long, record string, event string, status string, session_id string, capture_id string").repartition(3)
    got = {r.scope_id: r for r in b.root_spans(x).collect()}
    f = lambda k, *names: tuple(got[k][n] for n in names)
    assert set(got) == {"s1", "t1", "t2", "s2", "s3", "t3", "k"}
    assert f("s1", "root_complete", "started_at", "finished_at", "state_conflict", "span_kind", "parent_span_id") == (True, 10, 90, False, "task_root", None)
    assert f("t1", "root_complete", "status", "finished_at", "starts", "wire_starts", "captures") == (True, "completed", 30, 1, 0, ["c", "d"]) and got["t1"].parent_span_id == got["s1"].span_id == got["t2"].parent_span_id
    assert f("t2", "root_complete", "status", "finished_at", "wire_starts") == (False, "running", None, 1)
    assert f("s2", "root_complete", "status", "state_conflict") == (False, "running", False)
    assert f("s3", "root_complete", "state_conflict") == (False, True)
    assert f("t3", "root_complete", "state_conflict", "status", "parent_span_id") == (False, True, "cancelled", None)
    assert f("k", "root_complete", "status", "is_error") == (True, "failed", True)


def test_call_spans(spark):
    calls = spark.createDataFrame([("s", "c1", 1, 10, "f", "{}"), ("s", "c2", 2, 20, "g", "1"), ("s", "c2", 3, 21, "g", "2"), ("s", "c3", 4, 30, "h", None), ("s", "ran", 5, 40, "r", None), ("s", " ", 6, 50, "r", None), ("s", "c4", 7, 60, " ", None)], "scope string, call_id string, seq long, at long, name string, arguments string")
    results = spark.createDataFrame([("s", "c1", 11, 15, "ok"), ("s", "c2", 12, 25, "a"), ("s", "lost", 13, 26, "a"), ("s", "c3", 14, 35, "a"), ("s", "c3", 15, 36, "b")], "scope string, call_id string, seq long, at long, content string")
    runs = spark.createDataFrame([("s", "ran", 1, 40, "x", "started", False, "{}", None), ("s", "ran", 2, 45, "x", "failed", True, "{}", "bad"), ("s", "ran", 3, 46, "x", "completed", False, "{}", "hook"), ("s", "two", 1, 1, "y", "completed", True, None, "a"), ("s", "two", 2, 2, "y", "failed", True, None, "b"), ("s", "open", 1, 5, "z", "started", None, None, None)], "scope string, call_id string, seq long, at long, name string, status string, authoritative boolean, arguments string, result string")
    d = {r.call_id: r for r in b.dispatcher_spans(calls, results, runs).collect()}
    assert {k: (r.name, r.status, r.result, r.state_conflict) for k, r in d.items()} == {"c1": ("f", "completed", "ok", False), "c2": ("g", "completed", "a", True), "c3": ("h", "running", "b", True)}
    t = {r.call_id: r for r in b.tool_spans(runs, calls).collect()}
    assert {k: (r.name, r.status, r.result, r.started_at, r.finished_at, r.state_conflict) for k, r in t.items()} == {"ran": ("r", "failed", "bad", 40, 46, False), "two": ("y", "failed", "b", 1, 2, True), "open": ("z", "running", None, 5, None, False)}
    agents = spark.createDataFrame([("s", "a1", 1, 1, "subagent_spawn", "c1", "/p"), ("s", "a1", 2, 9, "subagent_join", None, "/p"), ("s", "a2", 3, 1, "subagent_spawn", "ran", None), ("s", "a3", 4, 1, "subagent_spawn", "c1", None), ("s", "a3", 5, 2, "subagent_spawn", "c2", None), ("s", "a4", 6, 2, "subagent_join", "none", None), ("s", "a4", 7, 2, "other", "c1", None)], "scope string, agent string, seq long, at long, event string, call_id string, path string")
    a = {r.agent: r for r in b.subagent_spans(agents, calls, runs).collect()}
    assert {k: (r.name, r.status, r.state_conflict) for k, r in a.items()} == {"a1": ("/p", "completed", False), "a2": ("subagent", "running", True), "a3": ("subagent", "running", True), "a4": ("subagent", "completed", True)}
    assert (a["a1"].parent_span_id, a["a2"].parent_span_id, a["a3"].parent_span_id) == (d["c1"].span_id, t["ran"].span_id, None)


def test_native_spans(spark):
    rows = [("n", "t", 1, 1, "rollout_started", "r", None, None), ("n", "t", 9, 9, "rollout_ended", "r", "failed", None), ("n", "t", 2, 2, "inference_started", "i", None, "c1"), ("n", "t", 3, 3, "inference_completed", "i", None, "c2"), ("n", "t", 4, 4, "inference_failed", "i", None, "c2"), ("n", "u", 2, 2, "inference_started", "i", None, "c1"), ("n", "t", 5, 5, "odd", "x", None, None)]
    x = spark.createDataFrame(rows, "namespace string, trace string, seq long, at long, event string, id string, status string, parent_call string")
    got = {(r.trace, r.id): (r.span_kind, r.status, r.parent_call, r.started_at, r.finished_at, r.state_conflict) for r in b.native_spans(x).collect()}
    assert got == {("t", "r"): ("rollout", "failed", None, 1, 9, False), ("t", "i"): ("inference", "failed", None, 2, 4, True), ("u", "i"): ("inference", "running", "c1", 2, None, False)}
    assert b.native_spans(x.where(F.lit(False))).collect() == []
