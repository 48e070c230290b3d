"""Hard gates and the weighted score; a gate that fails is never made up for by points."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import MODEL_VERSIONS

# --- fixed values: the seventeen gates, their weights and the profile's thresholds ---
GATES = [
    "required_fields", "message_roles", "first_message_role", "system_prompt", "effective_turns", "structured_tool_calls",
    "valid_tool_results", "tool_definitions", "tool_pairing_after_open_tail", "machine_turn_ratio", "assembly_integrity",
    "runtime_dag_integrity", "trace_delivery_ready", "inference_api_conservation", "model", "session_closed", "domain",
]
WEIGHTS = {
    "required_fields": 5, "message_roles": 5, "first_message_role": 5, "system_prompt": 5, "valid_tool_results": 5, "model": 5, "session_closed": 5,
    "structured_tool_calls": 10, "machine_turn_ratio": 10, "effective_turns": 15, "tool_definitions": 15, "tool_pairing_after_open_tail": 15,
}
ROLES = ["system", "user", "assistant", "tool"]
BAD_DOMAINS = ["roleplay", "gui", "gui_only", "embedding", "embeddings", "translation", "pure_translation", "ordinary_qa", "general_qa", "error_request", "error_only", "no_tool", "no_tools"]
#: Vendor of a version pattern, least major and minor, names of its provider; in the order in which they are tried.
ELIGIBLE = [("gpt", 5, 5, ["openai"]), ("claude", 4, 6, ["anthropic"]), ("deepseek", 4, 0, ["deepseek"]), ("glm", 5, 2, ["zhipu", "glm"]), ("kimi", 3, 0, ["moonshot", "kimi"])]
#: Names that exclude a model, and those that need a higher version of its vendor.
NEVER_ELIGIBLE, HIGHER = ["haiku"], {"sonnet": (5, 0)}
# -------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Profile:
    """Thresholds of a delivery profile."""

    effective_turns: int = 10
    user_pairs: int = 2
    tool_calls: int = 5
    valid_results: int = 5
    machine_ratio: float = 0.25
    bad_domains: tuple[str, ...] = field(default=tuple(BAD_DOMAINS))


def gates(profile: Profile = Profile()) -> dict[str, Column]:
    """Boolean columns over session metrics, by gate. Metrics are columns of the session table."""
    c, p = F.col, profile
    zero = lambda *names: _all(F.coalesce(c(n), F.lit(0)) == 0 for n in names)
    true = lambda *names: _all(F.coalesce(c(n), F.lit(False)) for n in names)
    return {
        "required_fields": true("required_present"),
        "message_roles": (c("n_messages") > 0) & zero("n_bad_roles"),
        "first_message_role": F.coalesce(c("first_role").isin("system", "user"), F.lit(False)),
        "system_prompt": true("has_system_prompt"),
        "effective_turns": (c("effective_turns") >= p.effective_turns) & (c("user_pairs") >= p.user_pairs),
        "structured_tool_calls": (c("n_calls") >= p.tool_calls) & (c("n_call_ids") == c("n_calls")) & zero("n_invalid_arguments", "n_duplicate_calls") & (c("n_tool_names") >= p.tool_calls),
        "valid_tool_results": c("n_valid_results") >= p.valid_results,
        "tool_definitions": (c("n_tool_names") > 0) & (c("n_complete_definitions") == c("n_tool_names")) & zero("n_generic_names"),
        "tool_pairing_after_open_tail": (c("pairing_rate") == 1.0) & zero("n_orphans", "n_duplicate_calls", "n_duplicate_results"),
        "machine_turn_ratio": (c("user_turns") > 0) & (c("machine_turns") / F.greatest(c("user_turns"), F.lit(1)) < p.machine_ratio),
        "assembly_integrity": zero("n_conflicts", "n_invalid_boundaries", "n_unresolved_parents") & true("task_complete") & ~F.coalesce(c("has_cycle"), F.lit(False)),
        "runtime_dag_integrity": ~F.coalesce(c("runtime_applicable"), F.lit(False)) | (true("runtime_complete") & (c("runtime_events") > 0) & zero("runtime_open", "runtime_conflicts")),
        "trace_delivery_ready": true("delivery_ready"),
        "inference_api_conservation": ~F.coalesce(c("inference_applicable"), F.lit(False)) | ((c("inferences") > 0) & (c("matched_inferences") == c("inferences"))),
        "model": true("model_eligible"),
        "session_closed": true("closed"),
        "domain": ~F.lower(F.coalesce(c("task_type"), F.lit(""))).isin(*p.bad_domains),
    }


def _all(conditions) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def assess(rows: DataFrame, checks: dict[str, Column], weights: dict[str, float] | None = None) -> DataFrame:
    """``score`` (weights of gates passed), ``eligible`` (all pass) and ``failures`` (names, in order). Null fails."""
    weights = WEIGHTS if weights is None else weights
    ok = {n: F.coalesce(c, F.lit(False)) for n, c in checks.items()}
    total = sum((F.when(c, float(weights.get(n, 0))).otherwise(0.0) for n, c in ok.items()), F.lit(0.0))
    failed = F.array_compact(F.array(*[F.when(~c, F.lit(n)) for n, c in ok.items()]))
    return rows.withColumns({"score": total, "failures": failed}).withColumn("eligible", F.size("failures") == 0)


def reassess(assessed: DataFrame, names: list[str], weights: dict[str, float]) -> DataFrame:
    """V2: score and eligibility derived again from the failures; the rows that disagree."""
    again = sum((F.when(F.array_contains("failures", n), 0.0).otherwise(float(weights.get(n, 0))) for n in names), F.lit(0.0))
    unknown = F.size(F.array_except("failures", F.array(*map(F.lit, names)))) > 0
    return assessed.where((again != F.col("score")) | (F.col("eligible") != (F.size("failures") == 0)) | unknown)


def summary(assessed: DataFrame, tokens: list[str] = ()) -> DataFrame:
    """A10: one row of counts, the mean score, three places, and sums of token columns."""
    sums = [F.coalesce(F.sum(t), F.lit(0)).alias(t) for t in tokens]
    return assessed.agg(F.count("*").alias("sessions"), F.count_if("eligible").alias("eligible"), F.round(F.avg("score"), 3).alias("mean_score"), *sums)


def reasons(assessed: DataFrame) -> DataFrame:
    """A10: how often each gate failed."""
    return assessed.select(F.explode("failures").alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def eligible_model(model: Column, provider: Column) -> Column:
    """Whether a model is of a vendor and version that count, and its provider is that vendor's.

    The first vendor in order whose version suffices decides, as a name may fit several patterns.
    """
    name, by = F.lower(F.coalesce(model, F.lit(""))), F.lower(F.coalesce(provider, F.lit("")))
    out = F.lit(False)
    for vendor, major, minor, providers in reversed(ELIGIBLE):
        pattern = MODEL_VERSIONS[vendor]
        number = lambda k, p=pattern: F.coalesce(F.regexp_extract(name, p, k).try_cast("long"), F.lit(0))
        least = lambda a, b: name.rlike(pattern) & ((number(1) > a) | ((number(1) == a) & (number(2) >= b)))  # noqa: B023, E731
        ok = least(major, minor)
        if vendor == "claude":
            for word in NEVER_ELIGIBLE:
                ok = ok & ~name.contains(word)
            for word, (a, b) in HIGHER.items():
                ok = ok & (~name.contains(word) | least(a, b))
        known = F.lit(False)
        for p in providers:
            known = known | by.contains(p)
        out = F.when(ok, known).otherwise(out)
    return out


def rewards(rows: DataFrame, group: str, kind: str, reward: str) -> DataFrame:
    """Mean reward and count by kind."""
    return rows.groupBy(group, kind).agg(F.count("*").alias("n"), F.round(F.avg(reward), 6).alias("mean_reward"))
