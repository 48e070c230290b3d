"""Spans built from observations, and calls nested by brackets.

A span is all that is observed of one identity: its state follows from
grouped minima, maxima and distinct counts, never from a fold. Where calls
have no parent of their own, nesting gives it: the starts and ends of a scope
are brackets, whose depth is a prefix sum; the k-th start of a depth belongs
to its k-th end. Prefix sums have two levels, over ranges, so that a scope
with most of the rows spreads over many tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.text import stable_id, terminal_status
from .checkpoint import written

# --- fixed values: what starts and ends the root of a scope, by kind of scope; beginnings of event names that end it too ---
STARTS = {"session": ["session_start"], "turn": ["turn_start", "subagent_spawn"], "task": ["task_start"]}
ENDS = {
    "session": ["session_end", "session_ended", "session_cancelled"], "turn": ["turn_end", "turn_stop", "turn_interrupt", "turn_aborted", "subagent_join"],
    "task": ["task_end", "task_ended", "cancel", "cancelled", "canceled", "terminated", "aborted"],
}
PREFIXES = {"session": "session_cancel", "task": "task_cancel"}
WIRE, SPAWN, JOIN = "api_snapshot", "subagent_spawn", "subagent_join"
ERRORS = ["failed", "cancelled", "timeout", "incomplete"]
#: Rollout events by kind of span and phase, with the status that an end has by itself.
NATIVE = [
    ("rollout_started", "rollout", "start", None), ("rollout_ended", "rollout", "end", "completed"), ("thread_started", "agent", "start", None), ("thread_ended", "agent", "end", "completed"),
    ("codex_turn_started", "turn", "start", None), ("codex_turn_ended", "turn", "end", "completed"), ("inference_started", "inference", "start", None), ("inference_completed", "inference", "end", "completed"),
    ("inference_failed", "inference", "end", "failed"), ("inference_cancelled", "inference", "end", "cancelled"),
]
# -----------------------------------------------------------------------------------------------------------------------


def span_id(*parts: Column) -> Column:
    return stable_id("runtime-span", *parts)


def prefix(x: DataFrame, group: list[str], order: str, counts: dict[str, Column], lows: dict[str, str] | None = None) -> DataFrame:
    """``x`` with inclusive running sums along ``order`` within ``group``, and for ``lows`` (new name: a sum's name) the least of that sum before each row, 0 at most.

    ``order`` is unique within a group. Rows are dealt into ranges and written; a group's ranges meet by a row each.
    """
    lows = lows or {}
    x = written(x.repartitionByRange(*group, order).withColumns({"_p": F.spark_partition_id(), **{f"_{n}": c for n, c in counts.items()}}), "ranges")
    own = W.partitionBy("_p", *group).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    x = x.withColumns({n: F.sum(f"_{n}").over(own) for n in counts})
    x = x.withColumns({n: F.min(F.col(of) - F.col(f"_{of}")).over(own) for n, of in lows.items()})
    t = x.groupBy("_p", *group).agg(*[F.sum(f"_{n}").alias(f"_t_{n}") for n in counts], *[F.min(F.least(n, of)).alias(f"_t_{n}") for n, of in lows.items()])
    before = W.partitionBy(*group).orderBy("_p").rowsBetween(W.unboundedPreceding, -1)
    t = t.withColumns({f"_b_{n}": F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)) for n in counts})
    t = t.withColumns({f"_b_{n}": F.min(F.col(f"_t_{n}") + F.col(f"_b_{of}")).over(before) for n, of in lows.items()})
    t = t.select(F.col("_p").alias("_q"), *[F.col(g).alias(f"_g_{g}") for g in group], *[f"_b_{n}" for n in (*counts, *lows)])
    x = x.join(t, reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in group], F.col("_p") == F.col("_q")))
    x = x.withColumns({n: F.least(F.col(n) + F.col(f"_b_{of}"), F.col(f"_b_{n}")) for n, of in lows.items()})
    x = x.withColumns({n: F.col(n) + F.col(f"_b_{n}") for n in counts})
    return x.drop("_p", "_q", *[f"_g_{g}" for g in group], *[f"_{n}" for n in counts], *[f"_b_{n}" for n in (*counts, *lows)])


def nested(events: DataFrame) -> DataFrame:
    """Events (scope, seq, id, phase: start or end) to pairs: scope, depth, id, started, ended, parent, state.

    ``state`` is closed, open (no end), unopened (no start, id is the end's),
    or crossing: the end at the start's depth is of another id, as where calls
    overlap without nesting. ``parent`` is the id of the enclosing start.
    Other phases, and null ones, are passed over; ``seq`` is unique in a scope.
    """
    x = events.where(F.col("phase").isin("start", "end")).select("scope", "seq", "id", "phase")
    is_start = F.col("phase") == "start"
    x = prefix(x, ["scope"], "seq", {"sum": F.when(is_start, 1).otherwise(-1).cast("long")}, {"low": "sum"})
    # an end beyond all starts has none and lowers the floor; from there depth counts anew. Other ends have the depth of their start.
    x = x.withColumns({"depth": F.col("sum") - F.col("low") + F.when(is_start, 0).otherwise(1), "lost": F.col("sum") < F.col("low")})
    x = written(x, "brackets")
    unopened = x.where("lost").select("scope", F.lit(None).cast("long").alias("depth"), "id", F.lit(None).cast("long").alias("started"), F.col("seq").cast("long").alias("ended"), F.lit(None).cast(events.schema["id"].dataType).alias("parent"), F.lit("unopened").alias("state"))
    known = x.where("not lost").select("scope", "seq", "id", "phase", "depth")
    known = prefix(known, ["scope", "depth"], "seq", {"k": F.when(F.col("phase") == "start", 1).otherwise(0).cast("long")})
    at = lambda phase, c: F.max(F.when(F.col("phase") == phase, F.col(c)))
    pairs = known.groupBy("scope", "depth", "k").agg(at("start", "id").alias("id"), at("start", "seq").alias("started"), at("end", "seq").alias("ended"), at("end", "id").alias("_end"))
    # the enclosing start is the last one of the depth above that began before: as many of them as had begun then
    inner = pairs.where("depth > 1").select("scope", (F.col("depth") - 1).alias("depth"), F.col("started").alias("seq"), F.lit(0).cast("long").alias("_one"), F.col("k").alias("_k"))
    outer = pairs.select("scope", "depth", F.col("started").alias("seq"), F.lit(1).cast("long").alias("_one"), F.lit(None).cast("long").alias("_k"))
    above = prefix(inner.union(outer), ["scope", "depth"], "seq", {"nth": F.col("_one")}).where("_k is not null")
    named = pairs.select(F.col("scope").alias("_s"), F.col("depth").alias("_d"), F.col("k").alias("_nth"), F.col("id").alias("parent"))
    above = above.join(named, F.col("scope").eqNullSafe(F.col("_s")) & (F.col("depth") == F.col("_d")) & (F.col("nth") == F.col("_nth"))).select(F.col("scope").alias("_s"), (F.col("depth") + 1).alias("_d"), "_k", "parent")
    x = pairs.join(above, F.col("scope").eqNullSafe(F.col("_s")) & (F.col("depth") == F.col("_d")) & (F.col("k") == F.col("_k")), "left")
    state = F.when(F.col("ended").isNull(), "open").when(~F.col("id").eqNullSafe(F.col("_end")), "crossing").otherwise("closed")
    return x.select("scope", "depth", "id", F.col("started").cast("long").alias("started"), F.col("ended").cast("long").alias("ended"), "parent", state.alias("state")).union(unopened)


def root_spans(seen: DataFrame) -> DataFrame:
    """Observations (scope_kind, scope_id, seq, at, record, event, status, session_id, capture_id) to one root span a scope.

    Turns start by themselves or by a snapshot on the wire, and hang from
    their session's root. A root is complete if it started and ended with one
    status; a session's boundaries must also alternate, and its last epoch be
    closed, else it is running. Scopes without a boundary give no span;
    observations that are none of a scope's kind don't count.
    """
    kind, event = F.col("scope_kind"), F.coalesce(F.col("event"), F.lit(""))
    starts, ends = F.lit(False), F.lit(False)
    for k in STARTS:
        starts = starts | ((kind == k) & event.isin(STARTS[k]))
        ends = ends | ((kind == k) & (event.isin(ENDS[k]) | (event.startswith(PREFIXES[k]) if k in PREFIXES else F.lit(False))))
    starts = starts | ((kind == "turn") & (F.col("record") == WIRE))
    x = seen.withColumns({"_start": F.coalesce(starts, F.lit(False)), "_end": F.coalesce(ends, F.lit(False))}).where("_start or _end")
    x = x.withColumn("_status", F.when(F.col("_end"), terminal_status(F.col("status"))))
    group = ["scope_kind", "scope_id"]
    # a session's boundaries: starts before each, less its ends, are 0 or 1 where they alternate
    b = x.where("scope_kind = 'session'").select(*group, "seq", "_start")
    b = prefix(b, group, "seq", {"s": F.when(F.col("_start"), 1).otherwise(0).cast("long"), "t": F.when(F.col("_start"), 0).otherwise(1).cast("long")})
    # an invalid boundary: a start while open, an end while closed
    bad = F.when(F.col("_start"), F.col("s") - 1 > F.col("t")).otherwise(F.col("s") < F.col("t"))
    b = b.groupBy(*group).agg(F.count_if(bad).alias("invalid"), (F.max_by(~F.col("_start"), "seq")).alias("closed"))
    first, last = (lambda c, on: F.min_by(c, F.when(F.col(on), F.col("seq")))), (lambda c, on: F.max_by(c, F.when(F.col(on), F.col("seq"))))
    g = x.groupBy(*group).agg(
        F.count_if("_start").alias("starts"), F.count_if("_end").alias("ends"), F.count_if(F.col("_start") & (F.col("record") == WIRE)).alias("wire_starts"), first("at", "_start").alias("started_at"), last("at", "_end").alias("_finished"),
        last("_status", "_end").alias("_last"), F.count_distinct("_status").alias("_statuses"), F.coalesce(last("session_id", "_end"), first("session_id", "_start")).alias("_session"), F.array_sort(F.collect_set("capture_id")).alias("captures"),
    )
    g = g.join(b, group, "left")
    sound = (F.col("starts") > 0) & (F.col("ends") > 0) & (F.col("_statuses") == 1)
    complete = F.when(kind == "session", sound & (F.col("invalid") == 0) & F.col("closed")).otherwise(sound)
    status = F.when((kind == "session") & ~F.col("closed"), "running").otherwise(F.coalesce("_last", F.lit("running")))
    conflict = (F.col("_statuses") > 1) | (F.coalesce("invalid", F.lit(0)) > 0)
    g = g.withColumns({"root_complete": complete, "status": status, "state_conflict": conflict})
    parent = F.when((kind == "turn") & F.col("_session").isNotNull(), span_id(F.lit("session"), F.col("_session"), F.lit("scope_root")))
    return g.select(
        span_id(F.col("scope_kind"), F.col("scope_id"), F.lit("scope_root")).alias("span_id"), F.when(kind == "turn", "turn").otherwise("task_root").alias("span_kind"), "scope_kind", "scope_id", parent.alias("parent_span_id"), "status", "started_at",
        F.when(F.col("root_complete"), F.col("_finished")).alias("finished_at"), (F.col("root_complete") & F.col("status").isin(ERRORS)).alias("is_error"), "root_complete", "state_conflict", "starts", "ends", "wire_starts", "captures",
    )


def dispatcher_spans(calls: DataFrame, results: DataFrame, executed: DataFrame) -> DataFrame:
    """Model calls (scope, call_id, seq, at, name, arguments) and results (scope, call_id, seq, at, content) to a span a call.

    Calls that were observed where they ran (``executed``: scope, call_id)
    have spans of their own. Results without a call give none. One call and
    one result are no conflict; names, arguments and contents must agree.
    """
    names = ["scope", "call_id"]
    blank = lambda x: x.where(F.trim("call_id") != "")
    c = blank(calls).where(F.trim("name") != "").groupBy(*names).agg(F.count("*").alias("_calls"), F.count_distinct("name").alias("_names"), F.count_distinct(F.coalesce("arguments", F.lit(""))).alias("_args"), F.min_by("name", "seq").alias("name"), F.min_by("arguments", "seq").alias("arguments"), F.min("at").alias("started_at"))
    r = blank(results).groupBy(*names).agg(F.count("*").alias("_results"), F.count_distinct(F.coalesce("content", F.lit(""))).alias("_contents"), F.max_by("content", "seq").alias("result"), F.max("at").alias("finished_at"))
    x = c.join(executed.select(*names).distinct(), names, "left_anti").join(r, names, "left")
    n = F.coalesce("_results", F.lit(0))
    conflict = (F.col("_calls") != 1) | (n > 1) | (F.col("_names") != 1) | (F.col("_args") != 1) | (F.coalesce("_contents", F.lit(0)) > 1)
    return x.select(dispatcher_id(F.col("scope"), F.col("call_id")).alias("span_id"), *names, "name", F.when(n == 1, "completed").otherwise("running").alias("status"), "started_at", "finished_at", "arguments", "result", conflict.alias("state_conflict"))


def dispatcher_id(scope: Column, call: Column) -> Column:
    return span_id(F.lit("dispatcher"), scope, call)


def tool_spans(seen: DataFrame, called: DataFrame) -> DataFrame:
    """Executions (scope, call_id, seq, at, name, status, authoritative, arguments, result) to a span a call.

    ``called`` (scope, call_id, name) are the model's names: a single one is
    the span's, else that of the run. Of the ends the last authoritative one
    decides, or else the last.
    """
    names = ["scope", "call_id"]
    end = F.col("status") != "started"
    best = F.when(end, F.struct(F.coalesce("authoritative", F.lit(False)), "seq"))
    x = seen.where("call_id is not null").withColumn("_state", F.when(end, terminal_status(F.col("status"))))
    own = lambda: F.when(F.coalesce("authoritative", F.lit(False)), F.col("_state"))
    x = x.groupBy(*names).agg(
        F.min_by("name", "seq").alias("_name"), F.count_if(end).alias("_ends"), F.max_by("_state", best).alias("_last"), F.count_distinct(own()).alias("_states"), F.min("at").alias("started_at"), F.max(F.when(end, F.col("at"))).alias("finished_at"),
        F.min_by("arguments", "seq").alias("arguments"), F.max_by("result", best).alias("result"), F.count_distinct("arguments").alias("_args"),
    )
    m = called.groupBy(*names).agg(F.count_distinct("name").alias("_n"), F.min("name").alias("_model"))
    x = x.join(m, names, "left")
    return x.select(span_id(F.col("scope"), F.col("call_id")).alias("span_id"), *names, F.when(F.col("_n") == 1, F.col("_model")).otherwise(F.col("_name")).alias("name"), F.coalesce("_last", F.lit("running")).alias("status"), "started_at", "finished_at", "arguments", "result", ((F.col("_states") > 1) | (F.col("_args") > 1)).alias("state_conflict"))


def subagent_spans(seen: DataFrame, model_calls: DataFrame, executed: DataFrame) -> DataFrame:
    """Spawns and joins (scope, agent, seq, at, event, call_id, path) to a span an agent, under the call that spawned it.

    The parent is the one model call (scope, call_id) that the spawns name:
    its execution's span where there is one, else its dispatcher's.
    """
    x = seen.where(F.col("event").isin(SPAWN, JOIN) & (F.trim("agent") != ""))
    spawn = F.col("event") == SPAWN
    known = model_calls.select("scope", "call_id").distinct().withColumn("_model", F.lit(True))
    ran = executed.select("scope", "call_id").distinct().withColumn("_ran", F.lit(True))
    x = x.join(known, ["scope", "call_id"], "left").join(ran, ["scope", "call_id"], "left")
    by = F.when(spawn & F.col("_model"), F.col("call_id"))
    g = x.groupBy("scope", "agent").agg(
        F.count_if(spawn).alias("starts"), F.count_if(~spawn).alias("ends"), F.count_distinct(by).alias("_parents"), F.min(F.when(by.isNotNull(), F.struct("call_id", F.coalesce("_ran", F.lit(False)).alias("ran")))).alias("_by"), F.count_distinct("path").alias("_paths"), F.min("path").alias("_path"),
        F.min(F.when(spawn, F.col("at"))).alias("started_at"), F.max(F.when(~spawn, F.col("at"))).alias("finished_at"),
    )
    parent = F.when(F.col("_parents") == 1, F.when(F.col("_by.ran"), span_id(F.col("scope"), F.col("_by.call_id"))).otherwise(dispatcher_id(F.col("scope"), F.col("_by.call_id"))))
    conflict = (F.col("starts") != 1) | (F.col("ends") != 1) | (F.col("_parents") > 1) | (F.col("_paths") > 1)
    return g.select(span_id(F.col("scope"), F.lit("subagent"), F.col("agent")).alias("span_id"), "scope", "agent", F.coalesce("_path", F.lit("subagent")).alias("name"), parent.alias("parent_span_id"), F.when(F.col("ends") == 0, "running").otherwise("completed").alias("status"), "started_at", "finished_at", conflict.alias("state_conflict"))


def native_spans(seen: DataFrame) -> DataFrame:
    """Rollout events (namespace, trace, seq, at, event, id, status, parent_call) to a span a kind and id; unknown events give none."""
    dim = seen.sparkSession.createDataFrame(NATIVE, "_event string, span_kind string, _phase string, _implied string")
    x = seen.join(F.broadcast(dim), seen["event"] == dim["_event"]).where("id is not null")  # ten rows
    end = F.col("_phase") == "end"
    given = F.when(F.trim("status") != "", terminal_status(F.col("status")))
    x = x.withColumn("_state", F.when(end, F.coalesce(given, "_implied")))
    names = ["namespace", "trace", "span_kind", "id"]
    g = x.groupBy(*names).agg(F.count_if(end).alias("_ends"), F.max_by("_state", F.when(end, F.col("seq"))).alias("_last"), F.count_distinct("_state").alias("_states"), F.count_distinct("parent_call").alias("_parents"), F.min("parent_call").alias("_parent"), F.min("at").alias("started_at"), F.max(F.when(end, F.col("at"))).alias("finished_at"))
    return g.select(span_id(*[F.coalesce(F.col(n).cast("string"), F.lit("")) for n in names]).alias("span_id"), *names, F.when(F.col("_parents") == 1, F.col("_parent")).alias("parent_call"), F.coalesce("_last", F.lit("running")).alias("status"), "started_at", "finished_at", ((F.col("_states") > 1) | (F.col("_parents") > 1)).alias("state_conflict"))
