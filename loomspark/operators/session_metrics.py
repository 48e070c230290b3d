"""Session bodies (JSON) to the metrics that the hard gates judge.

A body's messages become rows once; calls, results, turns and definitions
are aggregates over these rows by session, and what a body states about
itself (``meta``) is read by path. Nothing of a session meets in one place
but its own short rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.text import normal_event
from .score import ROLES, eligible_model
from .turns import is_correction, user_class

# --- fixed values: names and codes that results must share ---
REQUIRED_TEXTS = ["session_id", "trajectory_id", "provider", "model", "created_at", "status"]
EXPLICIT_STATUSES = ["success", "completed", "error", "failed", "cancelled", "canceled", "timeout"]
CLOSED_STATUSES = ["completed", "terminated", "failed", "cancelled", "canceled", "incomplete"]
GENERIC_TOOLS = ["tool1", "tool_1", "helper", "action"]
CONTENT_KEYS = ["text", "content", "output_text", "input_text"]
CONFLICT_LISTS = ["schema_conflicts", "trace_conflicts", "system_prompt_conflicts", "usage_conflicts", "tool_execution_conflicts", "runtime_evidence_conflicts", "runtime_unknown_events"]
ENDED = ["cancel", "cancelled", "canceled", "terminated", "abort", "aborted", "abandoned"]
TASK_START, TASK_END, TASK_END_PREFIXES = ["task_start", "task_started"], ["task_end", "task_ended", "task_completed", *ENDED], ["task_cancel", "task_fail"]
SESSION_START, SESSION_END, SESSION_END_PREFIXES = ["session_start", "session_started"], ["session_end", "session_ended", *ENDED], ["session_cancel", "session_fail"]
READINESS_SCHEMA = "trace-readiness.v1"  # behind the producer's name
RUNTIME_SOURCE = "canonical_model_interaction:cloud_evidence"
UNSUPPORTED = {
    "$": ["producerEvent", "producerModel", "rolloutEvent", "rolloutMessages", "rolloutUsage", "toolRegistry", "toolRegistrySha256"],
    "$.meta": [
        "active_quality_projection", "code_mode_message_projection", "producer_event_conflicts", "producer_streams", "rollout_events",
        "rollout_unknown_events", "rollout_unmapped_tools", "rollout_usage_evidence", "tool_registry_evidence",
    ],
    "$.meta.runtime_dag": ["native_event_count", "terminal_rollout_ids"],
}
# ------------------------------------------------------------


def _get(v: Column | str, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(v, path, kind)


def _text(v: Column | str, *paths: str) -> Column:
    """The first of some strings that isn't blank."""
    got = [_get(v, p, "string") for p in paths]
    return F.coalesce(*[F.when(_is_text(_get(v, p)) & (F.trim(g) != ""), g) for p, g in zip(paths, got, strict=True)])


def _is_text(v: Column) -> Column:
    return F.schema_of_variant(v) == "STRING"


def _is_kind(v: Column, start: str) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith(start), F.lit(False))


def _true(v: Column | str, path: str) -> Column:
    """A JSON ``true``; strings and numbers are none."""
    return _is_kind(_get(v, path), "BOOLEAN") & F.coalesce(_get(v, path, "boolean"), F.lit(False))


def _false(v: Column | str, path: str) -> Column:
    return _is_kind(_get(v, path), "BOOLEAN") & ~F.coalesce(_get(v, path, "boolean"), F.lit(True))


def _size(v: Column | str, path: str) -> Column:
    """Elements of an array, 0 if there is none."""
    return F.coalesce(F.size(_get(v, path, "array<variant>")), F.lit(0))


def nonempty(v: Column) -> Column:
    """Neither missing, null, blank, an empty list nor an empty object."""
    plain = F.to_json(v)
    text = F.trim(F.try_variant_get(v, "$", "string"))
    return F.when(v.isNull() | F.is_variant_null(v), False).when(_is_text(v), text != "").otherwise(~plain.isin("[]", "{}"))


def content_text(v: Column) -> Column:
    """The text of a content: a string, or the strings of its parts and of their parts, with blanks between."""

    def parts(x: Column, depth: int) -> Column:
        own = F.when(_is_text(x), F.array(F.try_variant_get(x, "$", "string")))
        if depth == 0:
            return F.coalesce(own, F.array().cast("array<string>"))
        items = F.when(_is_kind(x, "ARRAY"), F.flatten(F.transform(F.try_variant_get(x, "$", "array<variant>"), lambda y: parts(y, depth - 1))))
        named = F.when(_is_kind(x, "OBJECT"), F.flatten(F.array(*[parts(F.try_variant_get(x, f"$.{k}", "variant"), depth - 1) for k in CONTENT_KEYS])))
        return F.coalesce(own, items, named, F.array().cast("array<string>"))

    return F.array_join(parts(v, 3), " ")


def messages(sessions: DataFrame, key: str, body: str) -> DataFrame:
    """key, pos (from 0), last, m and role of every message."""
    x = sessions.select(key, F.posexplode(_get(F.try_parse_json(body), "$.messages", "array<variant>")).alias("pos", "m"), F.size(_get(F.try_parse_json(body), "$.messages", "array<variant>")).alias("_n"))
    return x.select(key, "pos", (F.col("pos") == F.col("_n") - 1).alias("last"), "m", _text("m", "$.role").alias("role"))


def calls(rows: DataFrame, key: str) -> DataFrame:
    """key, pos, last, id, name and valid (arguments are JSON) of every tool call of an assistant."""
    x = rows.where("role = 'assistant'").select(key, "pos", "last", F.explode(_get("m", "$.tool_calls", "array<variant>")).alias("c"))
    x = x.withColumn("f", F.coalesce(_get("c", "$.function"), F.col("c")))
    a = _get("f", "$.arguments")
    text = F.try_variant_get(a, "$", "string")
    valid = F.when(a.isNull() | F.is_variant_null(a), False).when(_is_text(a), F.try_parse_json(text).isNotNull()).otherwise(True)
    return x.select(key, "pos", "last", _text("c", "$.id", "$.call_id").alias("id"), _text("f", "$.name").alias("name"), valid.alias("valid"))


def results(rows: DataFrame, key: str) -> DataFrame:
    """key, id, valid (content and explicit status, no conflict), failed and conflict of every tool message."""
    status = F.lower(_text("m", "$.status"))
    is_error = _is_kind(_get("m", "$.is_error"), "BOOLEAN")
    conflict = _true("m", "$.status_conflict")
    content = nonempty(_get("m", "$.content")) | nonempty(_get("m", "$.error_message")) | nonempty(_get("m", "$.error"))
    explicit = F.coalesce(status.isin(EXPLICIT_STATUSES), F.lit(False)) | is_error
    failed = _false("m", "$.process_outcome.success") | _true("m", "$.is_error") | F.coalesce(status.isin("failed", "error", "cancelled", "canceled", "timeout"), F.lit(False))
    return rows.where("role = 'tool'").select(key, _text("m", "$.tool_call_id", "$.call_id", "$.tool_use_id").alias("id"), (content & explicit & ~conflict).alias("valid"), failed.alias("failed"), conflict.alias("conflict"))


def turns(rows: DataFrame, key: str) -> DataFrame:
    """key, user_turns, machine_turns, user_pairs (answered human turns) and corrections."""
    substantive = nonempty(_get("m", "$.content")) | nonempty(_get("m", "$.reasoning")) | nonempty(_get("m", "$.thinking")) | (_size("m", "$.tool_calls") > 0)
    user = F.col("role").eqNullSafe("user")
    by_pos = W.partitionBy(key).orderBy("pos")
    x = rows.select(key, "pos", user.alias("user"), (F.col("role").eqNullSafe("assistant") & substantive).alias("answer"), F.when(user, content_text(_get("m", "$.content"))).alias("text"), F.coalesce(_text("m", "$.meta.turn_kind"), _text("m", "$.metadata.turn_kind")).alias("kind"))
    x = x.withColumn("turn", F.sum(F.col("user").cast("int")).over(by_pos)).where("turn > 0")
    per = x.groupBy(key, "turn").agg(F.max("text").alias("text"), F.max(F.when(F.col("user"), F.col("kind"))).alias("kind"), F.bool_or("answer").alias("answered"))
    per = per.withColumn("before", F.lag("text").over(W.partitionBy(key).orderBy("turn")))
    per = per.withColumn("class", user_class(F.col("text"), F.col("before"), F.col("kind")))
    human = F.col("class") == "human"
    return per.groupBy(key).agg(
        F.count_if(F.col("class") != "harness").alias("user_turns"), F.count_if(F.col("class") == "machine").alias("machine_turns"),
        F.count_if(human & F.col("answered")).alias("user_pairs"), F.count_if(human & is_correction(F.col("text"))).alias("corrections"),
    )


def definition_complete(tool: Column) -> Column:
    """Whether a tool's definition is the producer's own, with name, description and an object of described properties."""
    d = F.coalesce(_get(tool, "$.function"), tool)
    properties = F.try_variant_get(d, "$.parameters.properties", "map<string,variant>")
    has = lambda p, k: F.try_variant_get(p, f"$.{k}", "variant").isNotNull()
    described = F.forall(F.map_values(properties), lambda p: _is_kind(p, "OBJECT") & (has(p, "type") | has(p, "oneOf") | has(p, "anyOf") | has(p, "['$ref']")) & _text(p, "$.description").isNotNull())
    required = _get(d, "$.parameters.required")
    names = F.try_variant_get(required, "$", "array<string>")
    known = required.isNull() | F.coalesce(F.size(F.array_except(names, F.map_keys(properties))) == 0, F.lit(False))
    return (
        ~_false(d, "$.schema_provenance.source_complete") & ~_true(d, "$.schema_provenance.generated_adapter") & _text(d, "$.name").isNotNull() & _text(d, "$.description").isNotNull()
        & _get(d, "$.parameters.type", "string").eqNullSafe("object") & properties.isNotNull() & F.coalesce(described, F.lit(False)) & known
    )


def _events(v: str) -> Column:
    """Normal names of a session's lifecycle events, from either list."""
    listed = F.coalesce(_get(v, "$.meta.lifecycle_events", "array<string>"), _get(v, "$.trace.lifecycle_events", "array<string>"), F.array().cast("array<string>"))
    records = F.transform(F.coalesce(_get(v, "$.meta.lifecycle_event_records", "array<variant>"), F.array().cast("array<variant>")), lambda e: F.try_variant_get(e, "$.type", "string"))
    return F.transform(F.array_compact(F.concat(listed, records)), normal_event)


def _any_event(events: Column, names: list[str], prefixes: list[str] = ()) -> Column:
    def hit(e: Column) -> Column:
        out = e.isin(names)
        for p in prefixes:
            out = out | e.startswith(p)
        return out

    return F.exists(events, hit)


def _stated(v: str) -> dict[str, Column]:
    """What a body states about itself, as the gates' columns."""
    meta = lambda p, kind: _get(v, f"$.meta.{p}", kind)
    count = lambda p: F.greatest(F.coalesce(meta(p, "long"), F.lit(0)), F.lit(0))
    flag = lambda p: _true(v, f"$.meta.{p}")
    events = _events(v)
    named = lambda k: F.coalesce(_text(v, f"$.meta.trace.{k}"), _text(v, f"$.trace.{k}")).isNotNull()
    task = named("task_session_id") & _any_event(events, TASK_START) & _any_event(events, TASK_END, TASK_END_PREFIXES)
    session = named("session_id") & _any_event(events, SESSION_START) & _any_event(events, SESSION_END, SESSION_END_PREFIXES)
    unsupported = F.lit(0)
    for at, names in UNSUPPORTED.items():
        for n in names:
            unsupported = unsupported + _get(v, f"{at}.{n}").isNotNull().cast("int")
    conflicts = count("merge_divergences") + unsupported + F.when(task | session, 0).otherwise(1)
    for c in CONFLICT_LISTS:
        conflicts = conflicts + _size(v, f"$.meta.{c}")
    for c in ("capture_dag", "task_dag"):
        conflicts = conflicts + (~_is_kind(meta(c, "variant"), "OBJECT")).cast("int")
    ready = {k: flag(f"trace_readiness.{k}") for k in ("artifact_valid", "raw_bytes_complete", "protocol_complete", "runtime_complete", "root_complete", "wire_ready", "runtime_ready", "delivery_ready")}
    consistent = (
        F.coalesce(meta("trace_readiness.schema_version", "string").endswith(READINESS_SCHEMA), F.lit(False))
        & (ready["wire_ready"] == (ready["artifact_valid"] & ready["raw_bytes_complete"] & ready["protocol_complete"]))
        & (ready["runtime_ready"] == (ready["runtime_complete"] & ready["root_complete"])) & (ready["delivery_ready"] == (ready["wire_ready"] & ready["runtime_ready"]))
    )
    at = "inference_api_conservation"
    unmatched = _size(v, f"$.meta.{at}.missing_api_capture_keys") + _size(v, f"$.meta.{at}.runtime_without_correlation_capture_ids")
    applicable = ~_false(v, f"$.meta.{at}.applicable")
    matched = F.when(flag(f"{at}.complete") & (unmatched == 0), count(f"{at}.matched_runtime_inferences")).otherwise(-1)
    status, final = F.lower(F.coalesce(_text(v, "$.status"), F.lit(""))), _true(v, "$.is_final_snapshot")
    epoch = F.when(_is_kind(meta("lifecycle_state.latest_epoch_closed", "variant"), "BOOLEAN"), flag("lifecycle_state.latest_epoch_closed")).otherwise(final)
    texts = F.lit(True)
    for f in REQUIRED_TEXTS:
        texts = texts & _text(v, f"$.{f}").isNotNull()
    usage = _get(v, "$.usage")
    return {
        "has_prompt_field": _text(v, "$.system_prompt").isNotNull(),
        "fields_present": texts & _is_kind(_get(v, "$.is_final_snapshot"), "BOOLEAN") & (F.coalesce(_get(v, "$.source_request_count", "long"), F.lit(0)) > 0)
        & _is_kind(_get(v, "$.tools"), "ARRAY") & _is_kind(_get(v, "$.messages"), "ARRAY") & (_is_kind(usage, "OBJECT") | F.coalesce(F.is_variant_null(usage), F.lit(False))),
        "n_conflicts": conflicts, "n_invalid_boundaries": count("lifecycle_state.invalid_boundary_count"), "n_unresolved_parents": _size(v, "$.meta.capture_dag.unresolved_parent_response_ids"),
        "task_complete": flag("task_dag.complete"), "has_cycle": flag("capture_dag.has_cycle"), "runtime_applicable": F.lit(True),
        "runtime_complete": flag("runtime_dag.complete") & meta("runtime_dag.source", "string").eqNullSafe(RUNTIME_SOURCE), "runtime_events": count("runtime_dag.evidence_event_count"),
        "runtime_open": _size(v, "$.meta.runtime_dag.open_node_ids") + _size(v, "$.meta.runtime_dag.unresolved_node_ids"), "runtime_conflicts": _size(v, "$.meta.runtime_dag.status_conflict_node_ids"),
        "delivery_ready": consistent & ready["delivery_ready"], "inference_applicable": applicable, "inferences": count(f"{at}.runtime_completed_inferences"), "matched_inferences": matched,
        "model_eligible": eligible_model(_text(v, "$.model"), _text(v, "$.provider")) & ~_false(v, "$.meta.model_evidence.consistent") & flag("model_evidence.provider_identity_attested"),
        "ended": status.isin(CLOSED_STATUSES) & final & epoch & (count("lifecycle_state.invalid_boundary_count") == 0), "end_event": _any_event(events, [*TASK_END, *SESSION_END], [*TASK_END_PREFIXES, *SESSION_END_PREFIXES]),
        "task_type": F.lower(F.coalesce(_get(v, "$.meta.task_type", "string"), F.lit(""))),
    }


def metrics(sessions: DataFrame, key: str, body: str) -> DataFrame:
    """One row a session: the key and every column that ``score.gates`` looks at.

    A session without messages, or whose body isn't JSON, has zeros and false. Keys are distinct.
    """
    name, key = key, "_key"
    sessions = sessions.select(F.col(name).alias(key), F.col(body).alias("_body"))
    body = "_body"
    stated = sessions.select(key, F.try_parse_json(body).alias("_v"))
    stated = stated.select(key, *[c.alias(n) for n, c in _stated("_v").items()])
    rows = messages(sessions, key, body)
    content = _get("m", "$.content")
    plain = (F.col("role") == "assistant") & (_size("m", "$.tool_calls") == 0) & (nonempty(content) | nonempty(_get("m", "$.reasoning")) | nonempty(_get("m", "$.thinking")))
    of_messages = rows.groupBy(key).agg(
        F.count("*").alias("n_messages"), F.count_if(~(F.coalesce(F.col("role").isin(ROLES), F.lit(False)) & content.isNotNull())).alias("n_bad_roles"),
        F.min_by("role", "pos").alias("first_role"), F.bool_or(F.coalesce((F.col("role") == "system") & nonempty(content), F.lit(False))).alias("has_prompt_message"),
        F.bool_or(F.coalesce(F.col("last") & plain, F.lit(False))).alias("ends_plainly"),
    )
    c, r = calls(rows, key), results(rows, key)
    per_result = r.groupBy(key, "id").agg(F.count("*").alias("n_results"))
    per_call = c.groupBy(key, "id").agg(F.count("*").alias("n"), F.count_if(~F.col("last")).alias("required"))
    met = per_call.join(per_result, [key, "id"], "left")
    known = F.col("id").isNotNull()
    of_ids = met.groupBy(key).agg(
        F.count_if(known).alias("n_ids"), F.sum(F.when(known, F.greatest(F.col("required") - 1, F.lit(0)))).alias("n_duplicate_calls"),
        F.sum(F.when(known & (F.col("n_results") == 1), F.col("required")).otherwise(0)).alias("paired"), F.count_if(known & F.col("n_results").isNull()).alias("unresolved"),
    )
    of_calls = c.groupBy(key).agg(
        F.count("*").alias("n_calls"), F.count_if(F.col("name").isNull()).alias("unnamed"), F.count_if(~F.col("valid")).alias("n_invalid_arguments"), F.count_if(~F.col("last")).alias("required"),
        F.count_distinct("name").alias("n_tool_names"), F.count_distinct(F.when(F.lower(F.trim("name")).isin(GENERIC_TOOLS), F.col("name"))).alias("n_generic_names"),
    )
    orphans = per_result.join(per_call.where(known).select(key, "id"), [key, "id"], "left_anti").groupBy(key).agg(F.sum("n_results").alias("n_orphans"))
    doubled = per_result.where(known & (F.col("n_results") > 1)).groupBy(key).agg(F.count("*").alias("n_duplicate_results"))
    of_results = r.groupBy(key).agg(F.count_if("valid").alias("n_valid_results"), F.count_if("failed").alias("n_failed_results"), F.count_if("conflict").alias("n_conflicting_results"))
    tools = sessions.select(key, F.posexplode(_get(F.try_parse_json(body), "$.tools", "array<variant>")).alias("at", "tool"))
    tools = tools.select(key, "at", F.coalesce(_text("tool", "$.function.name"), _text("tool", "$.name")).alias("name"), definition_complete(F.col("tool")).alias("ok"))
    last = tools.where("name is not null").groupBy(key, "name").agg(F.max_by("ok", "at").alias("ok")).where("ok")
    defined = c.select(key, "name").distinct().join(last, [key, "name"]).groupBy(key).agg(F.count("*").alias("n_complete_definitions"))
    out = stated
    for part in (of_messages, of_calls, of_ids, orphans, doubled, of_results, defined, turns(rows, key)):
        out = out.join(part, key, "left")
    numbers = [
        "n_messages", "n_bad_roles", "n_calls", "unnamed", "n_ids", "n_invalid_arguments", "required", "n_tool_names", "n_generic_names", "n_duplicate_calls", "paired", "unresolved", "n_orphans",
        "n_duplicate_results", "n_valid_results", "n_failed_results", "n_conflicting_results", "n_complete_definitions", "user_turns", "machine_turns", "user_pairs", "corrections",
    ]
    out = out.na.fill(0, numbers).na.fill(False, ["has_prompt_message", "ends_plainly"])
    prompt = F.col("has_prompt_field") | F.col("has_prompt_message")
    closed = F.col("ended") & (F.col("unresolved") == 0) & (F.col("ends_plainly") | F.col("end_event"))
    return out.withColumns({
        "has_system_prompt": prompt, "required_present": F.col("fields_present") & prompt, "closed": closed,
        "n_call_ids": F.when(F.col("unnamed") == 0, F.col("n_ids")).otherwise(F.lit(-1)),
        "pairing_rate": F.when(F.col("required") == 0, 1.0).otherwise(F.col("paired") / F.col("required")),
        "effective_turns": F.col("user_pairs") + F.col("paired"), "n_conflicts": F.col("n_conflicts") + F.col("n_conflicting_results"),
    }).drop("has_prompt_field", "has_prompt_message", "ends_plainly", "fields_present", "ended", "end_event", "unnamed", "n_ids", "required", "paired", "unresolved").withColumnRenamed(key, name)
