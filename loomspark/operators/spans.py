"""Hooks, spans and integrity: mapping tables, native consistency, roll-ups over call graphs, session headers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: hook events with lifecycle type, default status, terminal, needs turn, needs agent, tool event ---
HOOKS = [
    ("SessionStart", "session_start", "started", False, False, False, False),
    ("SessionEnd", "session_end", "closed", True, False, False, False),
    ("Stop", "turn_end", "closed", False, True, False, False),
    ("Interrupt", "turn_interrupt", "cancelled", False, True, False, False),
    ("SubagentStart", "subagent_spawn", "started", False, True, True, False),
    ("SubagentStop", "subagent_join", "closed", False, True, True, False),
    ("PreCompact", "compaction_start", "started", False, True, False, False),
    ("PostCompact", "compaction_end", "completed", False, True, False, False),
    ("UserPromptSubmit", "user_prompt_submit", "completed", False, True, False, False),
    ("PermissionRequest", "permission_request", "unknown", False, True, False, False),
    ("PreToolUse", "tool_start", "started", False, True, False, True),
    ("PostToolUse", "tool_end", "unknown", False, True, False, True),
]
HOOK_SCHEMA = "hook string, lifecycle_type string, default_status string, terminal boolean, requires_turn boolean, requires_agent boolean, tool_event boolean"
# ---------------------------------------------------------------------------------------------------------------------


def hook_table(spark: SparkSession) -> DataFrame:
    """A dimension of twelve rows."""
    return spark.createDataFrame(HOOKS, HOOK_SCHEMA)


def hook_events(rows: DataFrame, event: str, status: str, turn: str, agent: str) -> DataFrame:
    """Hook rows with their lifecycle, and a problem where the event is unknown or an identity is missing."""
    dim = hook_table(rows.sparkSession)
    x = rows.join(F.broadcast(dim), rows[event] == dim["hook"], "left")  # twelve rows
    problem = (
        F.when(F.col("hook").isNull(), "unsupported_event")
        .when(F.col("requires_turn") & F.col(turn).isNull(), "missing_turn")
        .when(F.col("requires_agent") & F.col(agent).isNull(), "missing_agent")
    )
    return x.select(*rows.columns, "lifecycle_type", F.coalesce(F.col(status), F.col("default_status")).alias("resolved_status"), "terminal", "tool_event", problem.alias("problem"))


def source_counts(rows: DataFrame, keys: list[str], source: str, sources: list[str]) -> DataFrame:
    """Rows by source, and whether every source was seen."""
    g = rows.groupBy(*keys).agg(*[F.count_if(F.col(source) == s).alias(f"n_{s}") for s in sources])
    full = F.lit(True)
    for s in sources:
        full = full & (F.col(f"n_{s}") > 0)
    return g.withColumn("all_sources", full)


def native_consistency(rows: DataFrame, keys: list[str], arguments: str, output: str, truncated: str) -> DataFrame:
    """Arguments equal as JSON, outputs equal as text, and truncation known to be off everywhere (null is not off)."""
    return rows.groupBy(*keys).agg(
        (F.count_distinct(F.coalesce(F.to_json(F.try_parse_json(arguments)), F.col(arguments))) <= 1).alias("arguments_agree"),
        (F.count_distinct(output) <= 1).alias("outputs_agree"),
        F.bool_and(F.col(truncated).eqNullSafe(F.lit(False))).alias("complete"),
    )


def reconcile(rows: DataFrame, group: str, call: str, source: str, kind: str, name: str, arguments: str, schema: str | None = None) -> DataFrame:
    """Per call: sources, duplicate starts and ends, and whether names, arguments and schemas agree between sources."""
    compared = {"name": name, "argument": arguments} | ({"schema": schema} if schema else {})
    bounds = [f(c).alias(f"_{k}_{e}") for k, c in compared.items() for f, e in ((F.min, "lo"), (F.max, "hi"))]
    per = rows.groupBy(group, call, source).agg(F.count_if(F.col(kind) == "start").alias("s"), F.count_if(F.col(kind) == "terminal").alias("t"), *bounds)
    return per.groupBy(group, call).agg(
        F.count("*").alias("sources"), F.count_if(F.col("s") > 1).alias("duplicate_starts"), F.count_if(F.col("t") > 1).alias("duplicate_ends"),
        *[(F.min(f"_{k}_lo") != F.max(f"_{k}_hi")).alias(f"{k}_mismatch") for k in compared],
    )


#: The thirteen sets that must be empty.
INTEGRITY_SETS = [
    "unscoped_spans", "open_spans", "conflicting_spans", "uncaptured_results", "quality_failures", "unresolved_parent_calls", "unresolved_parent_spans",
    "calls_without_results", "calls_without_execution", "executions_without_calls", "results_without_calls", "unlinked_interactions", "unknown_endpoints",
]


#: What is said of an id in ``integrity_sets``; a call is kept unless it is abandoned.
CALL, KEPT, EXECUTED, ANSWERED, NODE, INTERACTION, END = (1 << k for k in range(7))


def integrity_sets(spans: DataFrame, calls: DataFrame, results: DataFrame, interactions: DataFrame, links: DataFrame, parents_required: bool = True) -> DataFrame:
    """(set, id): every member of the thirteen sets, each a filter or an anti-join.

    ``spans`` (id, scope, container, open, conflict, uncaptured, quality_failure, parent_id, call_id, parent_call_id; containers
    are roots whose own state is judged elsewhere), ``calls`` (call_id, abandoned), ``results`` (call_id), ``interactions``
    (id), ``links`` (from_id, to_id). A call that its client abandoned, or that was cut off upstream, is required only if it
    has a result or an execution.
    """
    of = lambda df, c, m: df.select(F.col(c).cast("string").alias("id"), (F.lit(m) if isinstance(m, int) else m).alias("m"))
    named = of(calls, "call_id", F.when(F.coalesce("abandoned", F.lit(False)), CALL).otherwise(CALL | KEPT))
    ends = links.select(F.explode(F.array("from_id", "to_id")).alias("id")).where("id is not null")
    # all that is said of an id meets in one aggregate, one number an id; a null id is said to be there and never found
    said = named.union(of(spans.where("call_id is not null"), "call_id", EXECUTED)).union(of(results, "call_id", ANSWERED)).union(of(spans, "id", NODE)).union(of(interactions, "id", NODE | INTERACTION)).union(of(ends, "id", END))
    ids = said.groupBy("id").agg(F.bit_or("m").alias("m"))
    is_ = lambda m: F.col("m").bitwiseAND(m) != 0
    found = lambda m: is_(m) & F.col("id").isNotNull()
    required = is_(KEPT) | (is_(CALL) & found(EXECUTED | ANSWERED))
    of_ids = {
        "calls_without_results": required & ~found(ANSWERED),
        "calls_without_execution": required & ~found(EXECUTED),
        "executions_without_calls": is_(EXECUTED) & ~found(CALL),
        "results_without_calls": is_(ANSWERED) & ~found(CALL),
        "unlinked_interactions": is_(INTERACTION) & ~found(END),
        "unknown_endpoints": is_(END) & ~found(NODE | CALL),
    }
    of_spans = {
        "unscoped_spans": F.col("scope").isNull(),
        "open_spans": F.col("open") & ~F.col("container"),
        "conflicting_spans": F.col("conflict") & ~F.col("container"),
        "uncaptured_results": F.col("uncaptured"),
        "quality_failures": F.col("quality_failure"),
    }
    members = lambda df, sets: df.select(F.explode(F.array_compact(F.array(*[F.when(c, name) for name, c in sets.items()]))).alias("set"), F.col("id").cast("string").alias("id"))
    parent = lambda c, known, name: spans.where(F.col(c).isNotNull()).join(known.select(F.col(known.columns[0]).alias("_of")), F.col(c) == F.col("_of"), "left_anti").select(F.lit(name).alias("set"), F.col("id").cast("string").alias("id"))
    spoilt = members(spans, of_spans).union(parent("parent_call_id", calls.select("call_id"), "unresolved_parent_calls"))
    if parents_required:
        spoilt = spoilt.union(parent("parent_id", spans.select("id"), "unresolved_parent_spans"))
    return members(ids, of_ids).union(spoilt.distinct())


def integrity(spans: DataFrame, calls: DataFrame, results: DataFrame, interactions: DataFrame, links: DataFrame, parents_required: bool = True) -> DataFrame:
    """One row: spans, the size of each of the thirteen sets, and ``runtime_complete``: there are spans and all sets are empty."""
    n = spans.agg(F.count("*").alias("spans"))
    sets = integrity_sets(spans, calls, results, interactions, links, parents_required)
    sizes = sets.agg(*[F.count_if(F.col("set") == s).alias(s) for s in INTEGRITY_SETS], F.count("*").alias("_all"))
    return n.crossJoin(sizes).withColumn("runtime_complete", (F.col("spans") > 0) & (F.col("_all") == 0)).drop("_all")  # one row by one row


def roots(spans: DataFrame, scope: str, kind: str, terminal: str) -> DataFrame:
    """A27, ``root_complete``: one row: task roots, scopes with other than one root, roots that aren't terminal, and whether all is well."""
    r = spans.where(F.col(kind).isin("task_root", "scope_root"))
    per = r.where(F.col(kind) == "scope_root").groupBy(scope).agg(F.count("*").alias("n")).agg(F.count_if(F.col("n") != 1).alias("ambiguous_scopes"))
    lost = spans.where(F.col(scope).isNotNull()).select(scope).distinct().join(r.where(F.col(kind) == "scope_root").select(scope).distinct(), scope, "left_anti").agg(F.count("*").alias("rootless_scopes"))
    x = r.agg(F.count_if(F.col(kind) == "task_root").alias("task_roots"), F.count_if(~F.coalesce(F.col(terminal), F.lit(False))).alias("open_roots")).crossJoin(per).crossJoin(lost)  # one row each
    return x.withColumn("root_complete", (F.col("task_roots") == 1) & (F.col("ambiguous_scopes") == 0) & (F.col("rootless_scopes") == 0) & (F.col("open_roots") == 0))


def session_header(rows: DataFrame, group: str, order: list[str], models: list[str], ts: str, prompt: str) -> DataFrame:
    """Model by precedence (the least value of the first column that has any), first and last time, last system prompt."""
    g = rows.groupBy(group).agg(
        F.coalesce(*[F.min(m) for m in models]).alias("model"), F.min(ts).alias("created_at"), F.max(ts).alias("ended_at"),
        F.max_by(prompt, F.when(F.col(prompt).isNotNull(), F.struct(*order))).alias("system_prompt"), F.count_distinct(prompt).alias("prompts"),
    )
    return g.withColumn("prompt_conflict", F.col("prompts") > 1).drop("prompts")


def profile_view(messages: Column, excluded: Column) -> Column:
    """Messages (array of structs role, content, call_ids) without excluded calls; an assistant message left with nothing goes."""
    cut = F.transform(messages, lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"), F.array_except(m["call_ids"], excluded).alias("call_ids"), (F.size(m["call_ids"]) > 0).alias("had")))
    keep = F.filter(cut, lambda m: ~((m["role"] == "assistant") & m["had"] & (F.size(m["call_ids"]) == 0) & (F.coalesce(m["content"], F.lit("")) == "")))
    return F.transform(keep, lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"), m["call_ids"].alias("call_ids")))


# --- fixed values: codes in the order in which they are tried, and the beginnings or parts that give them ---
LEGACY_CODES = ["legacy_model", "legacy_request_id", "legacy_user_agent", "legacy_import_endpoint", "mechanical_monitor"]
LEGACY_MODEL, LEGACY_REQUEST, LEGACY_AGENT, LEGACY_ENDPOINT = "legacy", "legacy-", "legacy-relay", "legacy-import"
# -------------------------------------------------------------------------------------------------------------


def legacy_reason(model: Column, request: Column, agent: Column, endpoint: Column, key_name: Column | None = None, user: Column | None = None, email: Column | None = None, monitor_key: str | None = None, monitor_user: str | None = None) -> Column:
    """Why a usage row is left out, or null; the order of the rules decides.

    The rule on mechanical monitors applies where their key's or user's name is given.
    """
    low = lambda c: F.lower(F.coalesce(c if c is not None else F.lit(""), F.lit("")))
    tests = [F.exists(F.split(low(model), r"\s+"), lambda x: x.startswith(LEGACY_MODEL)), low(request).startswith(LEGACY_REQUEST), low(agent).startswith(LEGACY_AGENT), low(endpoint).contains(LEGACY_ENDPOINT)]
    monitor = F.lit(False)
    if monitor_key:
        monitor = monitor | (low(key_name) == monitor_key.lower())
    if monitor_user:
        monitor = monitor | (low(user) == monitor_user.lower()) | low(email).startswith(monitor_user.lower() + "-")
    out = F.lit(None).cast("string")
    for code, test in reversed([*zip(LEGACY_CODES, [*tests, monitor], strict=True)]):
        out = F.when(test, code).otherwise(out)
    return out


def gateway_linked(request: Column, usage_request: Column, outcome: Column) -> Column:
    """A usage link holds only where the ids are equal and the match was exact."""
    return F.coalesce((request == usage_request) & (outcome == "matched"), F.lit(False))
