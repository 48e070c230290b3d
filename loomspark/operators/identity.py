"""Identities: alias promotion, keys, exact links. Nothing is ever matched by nearness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import chain_members, present

# --- fixed values: canonical trace fields and their aliases ---
TRACE_ALIASES = {
    "task_session_id": ["task_session_id", "taskSessionId"],
    "session_id": ["session_id", "sessionId"],
    "thread_id": ["thread_id", "threadId"],
    "conversation_id": ["conversation_id", "conversationId"],
    "trace_id": ["trace_id", "traceId"],
    "span_id": ["span_id", "spanId"],
    "parent_span_id": ["parent_span_id", "parentSpanId"],
    "task_id": ["task_id", "taskId"],
    "root_session_id": ["root_session_id", "rootSessionId"],
    "parent_session_id": ["parent_session_id", "parentSessionId"],
    "goal_id": ["goal_id", "goalId"],
    "root_turn_id": ["root_turn_id", "rootTurnId"],
    "turn_id": ["turn_id", "turnId"],
    "agent_id": ["agent_id", "agentId"],
    "agent_path": ["agent_path", "agentPath", "agent_name"],
    "branch_id": ["branch_id", "branchId"],
    "previous_response_id": ["previous_response_id", "previousResponseId"],
    "session_final": ["session_final", "sessionFinal"],
    "traceparent": ["traceparent"],
    "trace_flags": ["trace_flags", "traceFlags"],
    "tracestate": ["tracestate"],
}
SESSION_KEYS = ["task_session_id", "root_session_id", "session_id", "conversation_id", "thread_id", "task_id", "trace_id"]
# --------------------------------------------------------------


def candidates(rows: DataFrame, key: str, sources: dict[str, Column], aliases: dict[str, list[str]] | None = None) -> DataFrame:
    """P2, first half: ``(key, field, value, source)`` from VARIANT columns, by alias."""
    out = []
    for source, v in sources.items():
        for field, names in (aliases or TRACE_ALIASES).items():
            for n in names:
                out.append(F.struct(F.lit(field).alias("field"), present(F.try_variant_get(v, f"$.{n}", "string")).alias("value"), F.lit(f"{source}.{n}").alias("source")))
    return rows.select(key, F.explode(F.array(*out)).alias("c")).select(key, "c.*").where("value is not null")


def promote(found: DataFrame, key: str) -> DataFrame:
    """P2, second half: equal values collapse to ``selected``; different ones are a conflict, and none is picked."""
    g = found.groupBy(key, "field").agg(F.count_distinct("value").alias("n"), F.min("value").alias("value"), F.sort_array(F.collect_set("source")).alias("sources"))
    return g.select(key, "field", F.when(F.col("n") == 1, F.col("value")).alias("selected"), (F.col("n") > 1).alias("conflict"), "sources")


def session_key(namespace: Column, fields: dict[str, Column], cache_key: Column, capture_id: Column) -> Column:
    """A1: the first identity there is, by precedence, within its namespace; struct (source, key)."""
    order = [(n, fields[n]) for n in SESSION_KEYS if n in fields] + [("prompt_cache_key", cache_key), ("capture_id", capture_id)]
    source = F.coalesce(*[F.when(present(c).isNotNull(), F.lit(n)) for n, c in order])
    value = F.coalesce(*[present(c) for _, c in order])
    scope = F.when(source == "trace_id", F.lit("")).otherwise(F.coalesce(namespace, F.lit("")))
    return F.struct(source.alias("source"), F.concat_ws("\0", scope, source, value).alias("key"))


def request_keys(upstream: Column, request: Column, headers: list[Column], client_headers: list[Column]) -> Column:
    """Candidate lookup keys of a row: exact ids with chain members, client ids with their prefix; sorted, distinct."""
    exact = [F.coalesce(chain_members(c), F.array().cast("array<string>")) for c in [upstream, *headers]]
    client = [F.when(present(c).isNotNull(), F.concat(F.lit("client:"), c)) for c in [request, *client_headers]]
    return F.sort_array(F.array_distinct(F.array_compact(F.concat(*exact, F.array(*client)))))


def enrich(rows: DataFrame, key: str, keys: str, facts: DataFrame, fact_key: str, fact_id: str, existing: str | None = None) -> DataFrame:
    """Rows joined to facts by exact candidate keys, with an outcome for each; the row count is conserved.

    Outcomes: matched, ambiguous (one key has several facts, or keys
    disagree), conflicting_existing, unmatched_no_key, unmatched_not_found.
    Equal facts (same ``fact_id``) under several keys are one fact.
    """
    facts = facts.groupBy(fact_key).agg(F.count_distinct(fact_id).alias("_facts"), F.min(fact_id).alias("_fact"))
    wide = rows.select(key, F.explode_outer(keys).alias("_k"))
    hits = wide.join(facts, wide["_k"] == facts[fact_key], "left")
    per = hits.groupBy(key).agg(F.count("_k").alias("_keys"), F.max("_facts").alias("_most"), F.count_distinct("_fact").alias("_n"), F.min("_fact").alias("_fact"))
    had = F.col(existing) if existing else F.lit(None).cast("string")
    outcome = (
        F.when(F.col("_keys") == 0, "unmatched_no_key")
        .when(F.coalesce(F.col("_n"), F.lit(0)) == 0, "unmatched_not_found")
        .when(F.col("_most") > 1, "ambiguous_multiple_facts")
        .when(F.col("_n") > 1, "ambiguous_candidates_disagree")
        .when(had.isNotNull() & (had != F.col("_fact").cast("string")), "conflicting_existing")
        .otherwise("matched")
    )
    out = rows.join(per, key)
    return out.select(*rows.columns, outcome.alias("outcome"), F.when(outcome == "matched", F.col("_fact")).alias("fact"))


def inherit(rows: DataFrame, key: str, target: str, links: str) -> DataFrame:
    """Rows without ``target`` take it from rows that share a link key, if they all agree.

    ``links`` is an array of namespaced keys. Adds ``linked`` (the target
    found) and ``link_conflict`` (more than one was).
    """
    wide = rows.select(key, target, F.explode(links).alias("_k"))
    known = wide.where(F.col(target).isNotNull()).groupBy("_k").agg(F.min(target).alias("_lo"), F.max(target).alias("_hi"))
    got = wide.where(F.col(target).isNull()).join(known, "_k").groupBy(key).agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
    one = F.col("_lo") == F.col("_hi")
    return rows.join(got, key, "left").select(*rows.columns, F.coalesce(F.col(target), F.when(one, F.col("_lo"))).alias("linked"), F.coalesce(~one, F.lit(False)).alias("link_conflict"))
