"""Native runtime events to a graph of nodes and typed edges, with what is open, unresolved or contradictory.

An event names a node and its phase; what all events of a node say together
is one aggregate. Edges come from the events that open a node. Nothing is
folded in order: a node's state follows from its first start and its ends.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import terminal_status

# --- fixed values: event, kind of node, phase, status that the event itself implies; relation by kind of the opened node ---
EVENTS = [
    ("rollout_started", "rollout", "start", None), ("rollout_ended", "rollout", "end", None), ("thread_started", "thread", "start", None), ("thread_ended", "thread", "end", None),
    ("codex_turn_started", "turn", "start", None), ("codex_turn_ended", "turn", "end", None), ("inference_started", "inference", "start", None), ("inference_completed", "inference", "end", "completed"),
    ("inference_failed", "inference", "end", "failed"), ("inference_cancelled", "inference", "end", "cancelled"), ("code_cell_started", "code_cell", "start", None), ("code_cell_ended", "code_cell", "end", None),
    ("tool_call_started", "tool", "start", None), ("tool_call_ended", "tool", "end", None), ("tool_call_runtime_started", "tool", "inner_start", None), ("tool_call_runtime_ended", "tool", "inner_end", None),
    ("compaction_request_started", "compaction", "start", None), ("compaction_request_completed", "compaction", "end", "completed"), ("compaction_request_failed", "compaction", "end", "failed"),
    ("agent_result_observed", "thread", "result", None),
]
RELATIONS = {"thread": "contains", "turn": "activates", "inference": "samples", "code_cell": "executes_code", "tool": "dispatches_tool", "compaction": "compacts"}
NESTED, RESULT = "nested_tool", "agent_result"
ABANDONED = ["cancelled", "aborted", "terminated"]
# ---------------------------------------------------------------------------------------------------------------------------


def classified(events: DataFrame) -> DataFrame:
    """Events (trace, seq, event, id, status, thread_id, turn_id, cell_id, parent_id) with kind, phase and state; unknown ones have none."""
    dim = events.sparkSession.createDataFrame(EVENTS, "_event string, kind string, phase string, _implied string")
    x = events.join(F.broadcast(dim), events["event"] == dim["_event"], "left")  # twenty rows
    return x.withColumn("state", F.when(F.col("phase").endswith("end"), F.coalesce("_implied", terminal_status(F.col("status"))))).drop("_event", "_implied")


def edges(events: DataFrame) -> DataFrame:
    """trace, source and target (structs of kind and id) and relation, distinct.

    A thread is contained by its parent thread or else its rollout; a tool
    call is nested in the code cell that made it, if that is known, or else
    dispatched by its turn; an agent's result goes from child to parent thread.
    """
    x = classified(events)
    node = lambda kind, c: F.when(F.col(c).isNotNull(), F.struct(F.lit(kind).alias("kind"), F.col(c).cast("string").alias("id")))
    cells = x.where("kind = 'code_cell' and phase = 'start' and id is not null").select(F.col("trace").alias("_t"), F.col("id").alias("_c")).distinct()
    starts = x.where("phase = 'start' and kind != 'rollout' and id is not null").join(cells, (F.col("trace") == F.col("_t")) & (F.col("cell_id") == F.col("_c")), "left")
    rollout = F.struct(F.lit("rollout").alias("kind"), F.col("trace").cast("string").alias("id"))
    nested = (F.col("kind") == "tool") & F.col("_c").isNotNull()
    source = F.when(F.col("kind") == "thread", F.coalesce(node("thread", "parent_id"), rollout)).when(F.col("kind") == "turn", node("thread", "thread_id")).when(nested, node("code_cell", "cell_id")).otherwise(node("turn", "turn_id"))
    relation = F.element_at(F.create_map(*[F.lit(v) for kv in RELATIONS.items() for v in kv]), F.col("kind"))
    opened = starts.select("trace", source.alias("source"), F.struct("kind", F.col("id").cast("string").alias("id")).alias("target"), F.when(nested, NESTED).otherwise(relation).alias("relation"))
    results = x.where("phase = 'result' and id is not null and parent_id is not null").select("trace", node("thread", "id").alias("source"), node("thread", "parent_id").alias("target"), F.lit(RESULT).alias("relation"))
    return opened.where("source is not null").unionByName(results).distinct()


def nodes(events: DataFrame) -> DataFrame:
    """trace, kind, id, started, ended, status, open, unresolved, conflict and disposition of every node that an event names.

    Open: started and not ended. Unresolved: never started, of an incomplete
    end, or ended before it started. A conflict is two ends that differ, or a
    tool's dispatch and runtime whose ends differ. The first end decides.
    """
    x = classified(events).where("kind is not null and phase != 'result'").withColumn("id", F.coalesce(F.col("id").cast("string"), F.when(F.col("kind") == "rollout", F.col("trace").cast("string")))).where("id is not null")
    at = lambda *phases: F.when(F.col("phase").isin(*phases), F.col("seq"))
    first = lambda phase: F.min_by("state", at(phase))
    g = x.groupBy("trace", "kind", "id").agg(
        F.min(at("start", "inner_start")).alias("started"), F.min(at("end", "inner_end")).alias("ended"), F.coalesce(first("end"), first("inner_end")).alias("last"),
        F.count_distinct("state").alias("states"), F.bool_or(F.coalesce((F.col("phase") == "inner_end") & (F.col("state") == "incomplete"), F.lit(False))).alias("_cut"),
    )
    open_ = F.col("started").isNotNull() & F.col("ended").isNull()
    status = F.when(F.col("ended").isNull(), "running").otherwise(F.col("last"))
    g = g.withColumns({"open": open_, "status": status, "conflict": (F.col("states") > 1) | F.col("_cut")})
    lost = F.col("started").isNull() | (F.col("status") == "incomplete") | F.coalesce(F.col("ended") < F.col("started"), F.lit(False))
    disposition = F.when(F.col("status") == "running", "open_tail").when(F.col("status").isin(ABANDONED), "abandoned").otherwise("executed")
    return g.select("trace", "kind", "id", "started", "ended", "status", "open", lost.alias("unresolved"), "conflict", disposition.alias("disposition"))


def summary(events: DataFrame, tasks: DataFrame) -> DataFrame:
    """One row a session: events, nodes, edges, roots, open, unresolved, conflicts, dangling edges, unknown events and ``complete``.

    ``tasks`` (trace, session, task_id) groups traces. Complete: there are
    events and roots, several roots share one task, every root has ended, and
    nothing is open, unresolved, contradictory or dangling.
    """
    by = tasks.select("trace", "session", "task_id").distinct()
    n, e = nodes(events), edges(events)
    known = n.select("trace", "kind", "id")
    ends = e.select("trace", F.explode(F.array("source", "target")).alias("n")).select("trace", "n.kind", "n.id").distinct()
    dangling = ends.join(known, ["trace", "kind", "id"], "left_anti").groupBy("trace").agg(F.count("*").alias("dangling"))
    per_node = n.groupBy("trace").agg(
        F.count("*").alias("nodes"), F.count_if(F.col("kind") == "rollout").alias("roots"), F.count_if((F.col("kind") == "rollout") & F.col("ended").isNotNull()).alias("ended_roots"),
        F.count_if("open").alias("open"), F.count_if("unresolved").alias("unresolved"), F.count_if("conflict").alias("conflicts"),
    )
    per_event = classified(events).groupBy("trace").agg(F.count("kind").alias("events"), F.count_if(F.col("kind").isNull()).alias("unknown"))
    x = by.join(per_event, "trace", "left").join(per_node, "trace", "left").join(e.groupBy("trace").agg(F.count("*").alias("edges")), "trace", "left").join(dangling, "trace", "left")
    numbers = ["events", "unknown", "nodes", "edges", "roots", "ended_roots", "open", "unresolved", "conflicts", "dangling"]
    g = x.na.fill(0, numbers).groupBy("session").agg(*[F.sum(c).alias(c) for c in numbers], F.count_distinct("task_id").alias("_tasks"))
    sound = (F.col("open") == 0) & (F.col("unresolved") == 0) & (F.col("conflicts") == 0) & (F.col("dangling") == 0)
    complete = (F.col("events") > 0) & (F.col("roots") > 0) & ((F.col("roots") <= 1) | (F.col("_tasks") == 1)) & (F.col("ended_roots") == F.col("roots")) & sound
    return g.withColumn("complete", complete).drop("_tasks", "ended_roots")
