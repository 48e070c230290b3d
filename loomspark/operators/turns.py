"""Turns and sources: coverage, readiness, dispositions, message classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.text import normal_event

# --- fixed values: event names by what they need ---
EXEMPT = ["codex.conversation_starts", "codex.startup_phase", "codex.websocket_connect", "codex.websocket_request", "codex.auth_recovery", "codex.agent_communication", "codex.session", "session"]
BUSINESS = ["codex.sse_event", "codex.tool_result", "codex.tool_decision", "codex.sandbox_outcome", "codex.user_prompt", "codex.turn_ttft", "codex.turn_cost"]
CORRECTIONS = ["不对", "不是", "改成", "重新", "等等", "补充", "actually", "instead", "wrong", "not what", "change it", "correction"]
ACKS = ["ok", "okay", "yes", "y", "好的", "收到", "确认", "继续", "嗯", "是"]
HARNESS_KINDS = ["harness", "meta_injection", "tool_result_carrier"]
MACHINE_KINDS = ["heartbeat", "cron", "no_reply"]
MACHINE_WORD, MACHINE_PREFIXES = "heartbeat", ["cron:", "[cron]"]
PUNCTUATION_ONLY = r"^[\p{P}\p{S}\s]+$"
# ---------------------------------------------------


def event_scope(name: Column, process_scoped: Column, session_scoped: Column, strict: bool = False) -> Column:
    """What an event must be attributed to: process, session or turn.

    A business event needs a turn; under process scope that is a
    contradiction: ``conflict``, or an error when ``strict``.
    """
    business = name.isin(BUSINESS)
    conflict = F.raise_error(F.lit("a turn's business event in process scope")).cast("string") if strict else F.lit("conflict")
    return F.when(business & process_scoped, conflict).when(business, "turn").when(process_scoped, "process").when(session_scoped, "session").when(name.isin(EXEMPT), "exempt").otherwise("turn")


def wire_evidence(record_type: Column, status: Column, sessions: list[Column], turns: list[Column], conflict_fields: Column) -> Column:
    """Struct (turn_scoped, http_success, identity_conflict), all false for anything but API snapshots.

    ``sessions`` and ``turns`` are the fields of which one must be present;
    ``conflict_fields`` is the array of fields whose evidence disagrees.
    """
    some = lambda cs: F.coalesce(*[F.when(F.trim(c) != "", F.lit(True)) for c in cs], F.lit(False))
    api = F.coalesce(record_type == "api_snapshot", F.lit(False))
    conflict = F.coalesce(F.exists(conflict_fields, lambda f: f.startswith("traceContext.")), F.lit(False))
    return F.struct(
        (api & some(sessions) & some(turns) & ~conflict).alias("turn_scoped"),
        (api & F.coalesce((status >= 200) & (status < 300), F.lit(False))).alias("http_success"),
        (api & conflict).alias("identity_conflict"),
    )


def user_class(text: Column, before: Column, kind: Column | None = None) -> Column:
    """A user message as harness, machine or human; ``before`` is the user text before it, ``kind`` the label that it carries.

    Labels come first. Empty, punctuation only, acknowledgements, repeats and what cron jobs and heartbeats say are machine.
    """
    label = F.lower(F.coalesce(kind if kind is not None else F.lit(""), F.lit("")))
    low = F.lower(F.trim(F.coalesce(text, F.lit(""))))
    machine = (low == "") | low.rlike(PUNCTUATION_ONLY) | low.isin(ACKS) | F.coalesce(F.trim(text) == F.trim(before), F.lit(False)) | low.contains(MACHINE_WORD)
    for p in MACHINE_PREFIXES:
        machine = machine | low.startswith(p)
    return F.when(label.isin(HARNESS_KINDS), "harness").when(label.isin(MACHINE_KINDS), "machine").when(machine, "machine").otherwise("human")


def is_correction(text: Column) -> Column:
    low, out = F.lower(text), F.lit(False)
    for p in CORRECTIONS:
        out = out | low.contains(p)
    return out


def roll_up(events: DataFrame, keys: list[str], source: str, sources: list[str], kind: str, status: str) -> DataFrame:
    """Per turn: events by source, starts, terminals, missing sources, conflict where terminal statuses differ."""
    counts = [F.count_if(F.col(source) == s).alias(f"n_{s}") for s in sources]
    g = events.groupBy(*keys).agg(
        *counts,
        F.count_if(F.col(kind) == "start").alias("starts"),
        F.count_if(F.col(kind) == "terminal").alias("terminals"),
        (F.count_distinct(F.when(F.col(kind) == "terminal", F.col(status))) > 1).alias("conflict"),
        F.collect_set(source).alias("_seen"),  # at most len(sources) values
    )
    lacking = F.array_except(F.array(*map(F.lit, sources)), "_seen")
    return g.withColumn("missing", F.array_join(F.sort_array(lacking), ",")).drop("_seen")


def readiness(turns: DataFrame, keys: list[str], counters: list[str]) -> DataFrame:
    """Ready if every counter is zero over all turns."""
    g = turns.groupBy(*keys).agg(F.count("*").alias("turns"), *[F.sum(c).alias(c) for c in counters])
    ok = F.lit(True)
    for c in counters:
        ok = ok & (F.col(c) == 0)
    return g.withColumn("ready", ok)


def dispositions(rows: DataFrame, key: str, producer: str, session: str, turn: str, related: str, requires_turn: str, process: str, selected: Column) -> DataFrame:
    """(key, producer, disposition): which of seven a record is, as seen from the ``selected`` session.

    process_level, turn_assigned, session_level, unscoped_turn, other_session
    and unknown_session by the row; of the unscoped and unknown those of a
    named producer that never referenced the session are ambient. A record
    without a session whose ``related`` sessions hold the selected one is
    ambiguous, and counts as a reference. Two passes: what a producer
    references is an aggregate, joined back on the producer.
    """
    inside = F.coalesce(F.col(session) == selected, F.lit(False))
    ambiguous = F.col(session).isNull() & F.coalesce(F.array_contains(related, selected), F.lit(False))
    needs = F.coalesce(F.col(requires_turn), F.lit(False))
    first = (
        F.when(F.coalesce(F.col(process), F.lit(False)), "process_level")
        .when(inside & F.col(turn).isNotNull(), "turn_assigned")
        .when(inside & ~needs, "session_level")
        .when((inside | ambiguous) & needs, "unscoped_turn")
        .when(F.col(session).isNotNull(), "other_session")
        .otherwise("unknown_session")
    )
    x = rows.select(key, producer, first.alias("_first"), (inside | ambiguous).alias("_knows"))
    knowing = x.where(F.col("_knows") & F.col(producer).isNotNull()).select(F.col(producer).alias("_p")).distinct().withColumn("_hit", F.lit(True))
    x = x.join(knowing, x[producer] == knowing["_p"], "left")
    pending = F.col("_first").isin("unscoped_turn", "unknown_session")
    ambient = pending & F.col(producer).isNotNull() & F.col("_hit").isNull()
    return x.select(key, producer, F.when(ambient, "ambient").otherwise(F.col("_first")).alias("disposition"))


def scoped(rows: DataFrame, namespace: str, selected: Column) -> DataFrame:
    """Telemetry as selected, other or unscoped."""
    return rows.withColumn("scope", F.when(F.col(namespace).isNull(), "unscoped").when(F.col(namespace) == selected, "selected").otherwise("other"))


def freshness(rows: DataFrame, keys: list[str], source: str, ts: str, as_of: Column, expected: list[str], within: dict[str, int], default_s: int = 300) -> DataFrame:
    """T4 in batch: for each key and expected source the last time, its age, and fresh, stale or missing."""
    limit = F.lit(default_s)
    for s, sec in within.items():
        limit = F.when(F.col(source) == s, F.lit(sec)).otherwise(limit)
    seen = rows.groupBy(*keys, source).agg(F.max(ts).alias("last_seen"))
    every = rows.select(*keys).distinct().withColumn(source, F.explode(F.array(*map(F.lit, expected))))
    g = every.join(seen, [*keys, source], "left")
    age = F.unix_seconds(as_of) - F.unix_seconds(F.col("last_seen").cast("timestamp"))
    return g.select(*keys, source, "last_seen", age.alias("age_s"), F.when(F.col("last_seen").isNull(), "missing").when(age > limit, "stale").otherwise("fresh").alias("state"))


def bounded_samples(rows: DataFrame, group: str, order: list[str], most: int) -> DataFrame:
    """O3: at most ``most`` samples a group, with how many were left out."""
    w = W.partitionBy(group)
    x = rows.withColumn("_n", F.row_number().over(w.orderBy(*order))).withColumn("omitted", F.greatest(F.count("*").over(w) - most, F.lit(0)))
    return x.where(F.col("_n") <= most).drop("_n")


def lifecycle_name(c: Column) -> Column:
    return normal_event(c)
