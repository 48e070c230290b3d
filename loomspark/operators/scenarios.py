"""V7: whether sessions show what a canary must: a second turn, a resumption, a failed process, and one that was polled until it ended."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values: the scenarios in order, the tools that launch and poll, states of a process ---
SCENARIOS = ["second_turn", "resume", "failed_tool_process", "delayed_write_stdin"]
LAUNCH, POLL, RUNNING, EXITED = "exec_command", "write_stdin", "running", "exited"
# -------------------------------------------------------------------------------------------------


def witnesses(seen: DataFrame) -> DataFrame:
    """Observations (session, turn, call_id, tool, seq, state, process, exit_code, success, requested, truncated) that count, one a call.

    A running process has a positive id and no success yet; one that exited
    succeeded exactly if its code is 0. Outputs must be whole, sequence
    numbers positive. Calls that are told in two ways don't count.
    """
    c = F.col
    running = (c("state") == RUNNING) & (c("process") > 0) & c("success").isNull()
    exited = (c("state") == EXITED) & (c("success") == (c("exit_code") == 0))
    x = seen.where(F.coalesce((running | exited) & ~c("truncated") & (c("seq") > 0) & c("call_id").isNotNull(), F.lit(False)))
    told = F.struct("tool", "seq", "state", "requested", F.when(c("state") == RUNNING, c("process")).alias("process"), F.when(c("state") == EXITED, c("exit_code")).alias("exit_code"))
    one = x.groupBy("session", "turn", "call_id").agg(F.min(told).alias("w"), F.max(told).alias("v")).where("w <=> v")
    return one.select("session", "turn", "call_id", "w.*")


def evidence(sessions: DataFrame, turns: DataFrame, starts: DataFrame, seen: DataFrame) -> DataFrame:
    """One row for each of ``sessions`` (session): the four scenarios as booleans, ``missing`` (names, in order) and ``complete``.

    ``turns`` (session, turn, interactions), ``starts`` (session, source) of
    sessions, ``seen`` as in ``witnesses``. A delayed process is one launched
    under an id that no other launch of its turn has, and polled under that
    id in the same turn, later, when it had exited. Sessions of which nothing
    else is known miss all four.
    """
    w = witnesses(seen)
    second = turns.where("interactions > 0").groupBy("session").agg(F.count_distinct("turn").alias("n")).where("n > 1").select("session", F.lit("second_turn").alias("s"))
    resumed = starts.where("source = 'resume'").select("session", F.lit("resume").alias("s")).distinct()
    failed = w.where((F.col("state") == EXITED) & (F.col("exit_code") != 0)).select("session", F.lit("failed_tool_process").alias("s")).distinct()
    launched = w.where((F.col("tool") == LAUNCH) & F.col("process").isNotNull()).groupBy("session", "turn", "process").agg(F.count("*").alias("n"), F.min("seq").alias("at")).where("n = 1")
    polled = w.where((F.col("tool") == POLL) & (F.col("state") == EXITED)).select("session", "turn", F.col("requested").alias("process"), "seq")
    delayed = launched.join(polled.groupBy("session", "turn", "process").agg(F.max("seq").alias("seq")), ["session", "turn", "process"]).where("seq > at").select("session", F.lit("delayed_write_stdin").alias("s")).distinct()
    shown = second.union(resumed).union(failed).union(delayed).groupBy("session").agg(F.collect_set("s").alias("shown"))
    x = sessions.select("session").distinct().join(shown, "session", "left")
    shown = F.coalesce("shown", F.array().cast("array<string>"))
    missing = F.array_except(F.array(*map(F.lit, SCENARIOS)), shown)
    return x.select("session", *[F.array_contains(shown, s).alias(s) for s in SCENARIOS], F.array_join(missing, ",").alias("missing"), (F.size(missing) == 0).alias("complete"))
