"""Hooks, consistency and integrity over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import built_spans, graph, scenarios, spans
from .common import table


def hook_lifecycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    name = F.when(F.col("event_type") == "signup", "SessionStart").when(F.col("event_type") == "click", "SubagentStart").when(F.col("event_type") == "view", "PreToolUse").otherwise(F.col("event_type"))
    x = e.select(name.alias("hook_event"), F.when(F.col("user_id") % 3 != 0, F.col("user_id")).alias("turn"), F.when(F.col("user_id") % 2 == 0, F.lit("a")).alias("agent"), F.lit(None).cast("string").alias("status"))
    y = spans.hook_events(x, "hook_event", "status", "turn", "agent")
    return y.groupBy(F.coalesce("lifecycle_type", F.lit("")).alias("lifecycle"), F.coalesce("resolved_status", F.lit("")).alias("status"), F.coalesce("problem", F.lit("")).alias("problem")).agg(F.count("*").alias("n"))


def source_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.source_counts(table(spark, sf_dir, "events"), ["user_id"], "event_type", ["click", "view", "signup", "error"])


def native_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    x = e.select("user_id", "props", F.col("event_type").alias("output"), F.when(F.col("event_id") % 500 != 0, False).alias("truncated"), F.floor(F.col("value")).alias("call"))
    return spans.native_consistency(x, ["user_id", "call"], "props", "output", "truncated")


def reconciled_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    kind = F.when(F.col("event_type").isin("click", "view"), "start").otherwise("terminal")
    x = e.select("user_id", F.floor(F.col("value") / 40).cast("long").alias("call"), (F.col("event_id") % 3).alias("source"), kind.alias("kind"), F.col("event_type").alias("name"), "props")
    return spans.reconcile(x, "user_id", "call", "source", "kind", "name", "props")


def runtime_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as calls, line items as results, customers as spans, nations as interactions; all thirteen sets by size."""
    o, li, c, n = (table(spark, sf_dir, t) for t in ("orders", "lineitem", "customer", "nation"))
    k = F.col("c_custkey")
    s = c.select(
        F.concat(F.lit("s"), k).alias("id"), F.when(F.col("c_nationkey") > 2, F.col("c_nationkey")).alias("scope"), (k % 10 == 0).alias("container"), (F.col("c_acctbal") < 0).alias("open"), (k % 4 == 0).alias("conflict"),
        (k % 9 == 0).alias("uncaptured"), (F.col("c_mktsegment") == "BUILDING").alias("quality_failure"), F.when(k % 3 == 0, F.concat(F.lit("s"), k + 1)).alias("parent_id"),
        F.when(k % 2 == 0, F.concat(F.lit("c"), k)).alias("call_id"), F.when(k % 5 == 0, F.concat(F.lit("c"), k)).alias("parent_call_id"),
    )
    calls = o.select(F.concat(F.lit("c"), "o_orderkey").alias("call_id"), (F.col("o_orderkey") % 6 == 0).alias("abandoned"))
    results = li.select(F.concat(F.lit("c"), F.when(F.col("l_orderkey") % 7 == 0, -F.col("l_orderkey")).otherwise(F.col("l_orderkey"))).alias("call_id"))
    links = o.select(F.concat(F.lit("c"), "o_orderkey").alias("from_id"), F.concat(F.lit("s"), "o_custkey").alias("to_id")).union(n.where("n_nationkey % 2 = 0").select(F.concat(F.lit("i"), "n_nationkey"), F.lit("nowhere")))
    return spans.integrity(s, calls, results, n.select(F.concat(F.lit("i"), "n_nationkey").alias("id")), links)


def session_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    x = c.select("conv_id", "turn", F.when(F.col("turn") % 3 == 2, F.col("role")).alias("m1"), F.col("role").alias("m2"), F.when(F.col("role") == "system", F.sha2("text", 256)).alias("prompt"))
    h = spans.session_header(x, "conv_id", ["turn"], ["m1", "m2"], "turn", "prompt")
    return h.select("conv_id", "model", "created_at", "ended_at", F.coalesce("system_prompt", F.lit("")).alias("system_prompt"), "prompt_conflict")


def legacy_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    model = F.when(F.col("user_id") % 4 == 0, F.concat(F.lit("gpt Legacy-"), F.col("event_type"))).otherwise("gpt")
    r = spans.legacy_reason(model, F.when(F.col("user_id") % 5 == 0, "LEGACY-1"), F.col("event_type"), F.when(F.col("user_id") % 7 == 0, "/legacy-import/x"), F.when(F.col("user_id") % 11 == 0, "Monitor"), None, F.when(F.col("user_id") % 13 == 0, "Probe-1@x"), "monitor", "probe")
    return e.groupBy(F.coalesce(r, F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


def nested_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of a conversation as starts and ends of calls without ids of their parents: two fifths start, two fifths end, often of another call."""
    c = table(spark, sf_dir, "conversations")
    n = F.col("conv_id") + F.col("turn") * F.col("turn")
    phase = F.when(n % 5 < 2, "start").when(n % 5 < 4, "end")
    x = built_spans.nested(c.select(F.col("conv_id").alias("scope"), F.col("turn").alias("seq"), F.concat(F.lit("c"), (n % 3).cast("string")).alias("id"), phase.alias("phase")))
    known = {c: F.coalesce(c, F.lit(-1).cast("long")) for c in ("depth", "started", "ended")}
    return x.withColumns(known | {"parent": F.coalesce("parent", F.lit(""))})


def scope_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of conversations, which are sessions: some unstarted, unended, ended twice or only seen on the wire; sessions start and end with each, but for every eleventh end."""
    o = table(spark, sf_dir, "conversations")
    k = F.col("conv_id") * 1000 + F.col("turn")
    turn, session = F.concat(F.lit("t"), k.cast("string")), F.concat(F.lit("s"), F.col("conv_id").cast("string"))
    seen = lambda kind, scope, n, event, status=None, record=None: F.struct(F.lit(kind).alias("scope_kind"), scope.alias("scope_id"), (8 * k + n).alias("seq"), (8 * k + n).alias("at"), F.lit(record).cast("string").alias("record"), F.lit(event).cast("string").alias("event"), F.lit(status).cast("string").alias("status"), session.alias("session_id"), F.concat(turn, F.lit(f"-{n}")).alias("capture_id"))
    all_ = [
        seen("session", session, 0, "session_start"), F.when(k % 3 != 0, seen("turn", turn, 1, "turn_start")), F.when(k % 5 == 0, seen("turn", turn, 2, None, None, "api_snapshot")), F.when(k % 4 != 0, seen("turn", turn, 3, "turn_end", "completed")),
        F.when(k % 7 == 0, seen("turn", turn, 4, "turn_aborted", "cancelled")), F.when(k % 11 != 0, seen("session", session, 5, "session_end", "completed")),
    ]
    x = built_spans.root_spans(o.select(F.explode(F.array_compact(F.array(*all_))).alias("o")).select("o.*"))
    return x.select("scope_kind", "scope_id", "span_kind", "status", F.coalesce("started_at", F.lit(-1)).alias("started_at"), F.coalesce("finished_at", F.lit(-1)).alias("finished_at"), "root_complete", "state_conflict", "starts", "ends", "wire_starts", F.col("parent_span_id").isNotNull().alias("hangs"))


def call_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as model calls, whose ids recur in pairs; results of two thirds of them, executions of a seventh."""
    c = table(spark, sf_dir, "conversations")
    k, p = F.col("conv_id") + F.col("turn"), F.col("conv_id") * 3 + F.floor(F.col("turn") / 3)
    x = c.select(F.col("conv_id").cast("string").alias("scope"), F.concat(F.lit("c"), F.floor(F.col("turn") / 2).cast("string")).alias("call_id"), F.col("turn").alias("seq"), F.col("turn").alias("at"), F.concat(F.lit("f"), (p % 4).cast("string")).alias("name"), F.when(F.col("turn") % 5 == 0, "x").otherwise("y").alias("arguments"), F.col("role").alias("content"), k.alias("k"))
    d = built_spans.dispatcher_spans(x, x.where("k % 3 != 0"), x.where("k % 7 = 0"))
    return d.select("scope", "call_id", "status", F.col("result").isNotNull().alias("answered"), "started_at", "state_conflict")


def inherited_scopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns that hang from the turn before and the one three before, with values at every fifth, boundaries at every seventh and a few cycles: what each inherits."""
    c = table(spark, sf_dir, "conversations")
    t, k = F.col("turn"), F.col("conv_id") * 1000 + F.col("turn")
    parents = F.array(F.when(t > 0, k - 1), F.when(t > 2, k - 3), F.when((t == 0) & (F.col("conv_id") % 10 == 3), k + 1))
    value = F.when(t % 5 == 0, F.concat(F.lit("v"), F.floor(t / F.when(F.col("conv_id") % 2 == 0, 3).otherwise(100)).cast("string"))).cast("string")
    value = F.when(F.col("conv_id") % 10 != 3, value)
    x = c.select(k.alias("node"), F.explode(parents).alias("parent"), value.alias("v"), (t % 7 == 6).alias("b"))
    x = graph.inherited_values(x, "node", "parent", "v", "b")
    return x.withColumn("inherited", F.coalesce("inherited", F.lit("")))


def scenario_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of conversations as tool observations, two a turn: launches and polls of processes, some failed, some told twice in different ways."""
    c = table(spark, sf_dir, "conversations")
    t, s = F.col("turn"), F.col("conv_id")
    launch, at = t % 2 == 0, F.floor(t / 2)
    ended = ~launch & ((s + t) % 3 != 0)
    seen = c.select(
        s.alias("session"), F.floor(t / 4).alias("turn"), F.concat(F.lit("c"), F.when(s % 9 == 4, at).otherwise(t).cast("string")).alias("call_id"), F.when(launch, "exec_command").otherwise("write_stdin").alias("tool"), (t + 1).alias("seq"),
        F.when(ended, "exited").otherwise("running").alias("state"), F.when(~ended, F.when(s % 5 == 0, 1).otherwise(at + 1)).alias("process"), F.when(ended, F.when((s + t) % 4 == 0, 1).otherwise(0)).alias("exit_code"), F.when(ended, (s + t) % 4 != 0).alias("success"), F.when(~launch, F.when(s % 5 == 0, 1).otherwise(at + 1)).alias("requested"), (s % 11 == 7).alias("truncated"),
    )
    turns = c.select(s.alias("session"), F.floor(t / 4).alias("turn"), F.when(F.col("role") == "assistant", 1).otherwise(0).alias("interactions"))
    starts = c.where("turn = 0").select(s.alias("session"), F.when(s % 3 == 0, "resume").otherwise("startup").alias("source"))
    return scenarios.evidence(c.select(s.alias("session")), turns, starts, seen)


SQL = {
    "hook_lifecycles": """
WITH x AS (SELECT CASE event_type WHEN 'signup' THEN 'session_start' WHEN 'click' THEN 'subagent_spawn' WHEN 'view' THEN 'tool_start' ELSE '' END AS lifecycle, user_id FROM events)
SELECT lifecycle, CASE WHEN lifecycle = '' THEN '' ELSE 'started' END AS status,
  CASE WHEN lifecycle = '' THEN 'unsupported_event' WHEN lifecycle <> 'session_start' AND user_id % 3 = 0 THEN 'missing_turn' WHEN lifecycle = 'subagent_spawn' AND user_id % 2 <> 0 THEN 'missing_agent' ELSE '' END AS problem,
  count(*) AS n FROM x GROUP BY ALL""",
    "source_counts": """
SELECT user_id, count(*) FILTER (event_type = 'click') AS n_click, count(*) FILTER (event_type = 'view') AS n_view, count(*) FILTER (event_type = 'signup') AS n_signup, count(*) FILTER (event_type = 'error') AS n_error,
  count(DISTINCT event_type) FILTER (event_type IN ('click','view','signup','error')) = 4 AS all_sources FROM events GROUP BY user_id""",
    "native_consistency": """
SELECT user_id, floor(value)::BIGINT AS call, count(DISTINCT props) <= 1 AS arguments_agree, count(DISTINCT event_type) <= 1 AS outputs_agree, bool_and(event_id % 500 <> 0) AS complete FROM events GROUP BY ALL""",
    "reconciled_calls": """
WITH p AS (SELECT user_id, floor(value / 40)::BIGINT AS call, event_id % 3 AS source, count(*) FILTER (event_type IN ('click','view')) AS s, count(*) FILTER (event_type NOT IN ('click','view')) AS t,
  min(event_type) AS a, max(event_type) AS b, min(props) AS c, max(props) AS d FROM events GROUP BY ALL)
SELECT user_id, call, count(*) AS sources, count(*) FILTER (s > 1) AS duplicate_starts, count(*) FILTER (t > 1) AS duplicate_ends, min(a) <> max(b) AS name_mismatch, min(c) <> max(d) AS argument_mismatch FROM p GROUP BY ALL""",
    "runtime_integrity": """
WITH r AS (SELECT DISTINCT CASE WHEN l_orderkey % 7 = 0 THEN -l_orderkey ELSE l_orderkey END AS id FROM lineitem),
e AS (SELECT c_custkey AS id FROM customer WHERE c_custkey % 2 = 0),
q AS (SELECT o_orderkey AS id FROM orders WHERE o_orderkey % 6 <> 0 OR o_orderkey IN (SELECT id FROM r) OR o_orderkey IN (SELECT id FROM e)),
s AS (SELECT count(*) AS spans, count(*) FILTER (c_nationkey <= 2) AS unscoped_spans, count(*) FILTER (c_acctbal < 0 AND c_custkey % 10 <> 0) AS open_spans, count(*) FILTER (c_custkey % 4 = 0 AND c_custkey % 10 <> 0) AS conflicting_spans,
  count(*) FILTER (c_custkey % 9 = 0) AS uncaptured_results, count(*) FILTER (c_mktsegment = 'BUILDING') AS quality_failures,
  count(*) FILTER (c_custkey % 5 = 0 AND c_custkey NOT IN (SELECT o_orderkey FROM orders)) AS unresolved_parent_calls, count(*) FILTER (c_custkey % 3 = 0 AND c_custkey + 1 NOT IN (SELECT c_custkey FROM customer)) AS unresolved_parent_spans FROM customer)
SELECT s.*, (SELECT count(*) FROM q WHERE id NOT IN (SELECT id FROM r)) AS calls_without_results, (SELECT count(*) FROM q WHERE id NOT IN (SELECT id FROM e)) AS calls_without_execution,
  (SELECT count(*) FROM e WHERE id NOT IN (SELECT o_orderkey FROM orders)) AS executions_without_calls, (SELECT count(*) FROM r WHERE id NOT IN (SELECT o_orderkey FROM orders)) AS results_without_calls,
  (SELECT count(*) FROM nation WHERE n_nationkey % 2 <> 0) AS unlinked_interactions,
  1 + (SELECT count(DISTINCT o_custkey) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)) AS unknown_endpoints, false AS runtime_complete FROM s""",
    "session_headers": """
SELECT conv_id, coalesce(min(CASE WHEN turn % 3 = 2 THEN role END), min(role)) AS model, min(turn) AS created_at, max(turn) AS ended_at,
  coalesce(arg_max(sha256(text), turn) FILTER (role = 'system'), '') AS system_prompt, count(DISTINCT text) FILTER (role = 'system') > 1 AS prompt_conflict FROM conversations GROUP BY conv_id""",
    "legacy_reasons": """
SELECT CASE WHEN user_id % 4 = 0 THEN 'legacy_model' WHEN user_id % 5 = 0 THEN 'legacy_request_id' WHEN user_id % 7 = 0 THEN 'legacy_import_endpoint' WHEN user_id % 11 = 0 OR user_id % 13 = 0 THEN 'mechanical_monitor' ELSE 'kept' END AS reason, count(*) AS n FROM events GROUP BY 1""",
    "nested_calls": """
WITH e AS (SELECT conv_id AS scope, turn AS seq, conv_id + turn * turn AS n, 'c' || (n % 3) AS id, CASE WHEN n % 5 < 2 THEN 1 ELSE -1 END AS d FROM conversations WHERE n % 5 < 4),
s AS (SELECT *, sum(d) OVER (PARTITION BY scope ORDER BY seq) AS sum FROM e),
l AS (SELECT *, least(0, coalesce(min(sum) OVER (PARTITION BY scope ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS low FROM s),
k AS (SELECT *, sum - low + (d = -1)::INT AS depth FROM l WHERE sum >= low),
n AS (SELECT *, sum((d = 1)::INT) OVER (PARTITION BY scope, depth ORDER BY seq) AS k FROM k),
p AS (SELECT scope, depth, k, max(id) FILTER (d = 1) AS id, max(seq) FILTER (d = 1) AS started, max(seq) FILTER (d = -1) AS ended, max(id) FILTER (d = -1) AS e FROM n GROUP BY ALL)
SELECT p.scope, p.depth::BIGINT AS depth, p.id, p.started, coalesce(p.ended, -1) AS ended, coalesce((SELECT arg_max(o.id, o.started) FROM p o WHERE o.scope = p.scope AND o.depth = p.depth - 1 AND o.started < p.started), '') AS parent,
  CASE WHEN ended IS NULL THEN 'open' WHEN p.id <> e THEN 'crossing' ELSE 'closed' END AS state FROM p
UNION ALL SELECT scope, -1, id, -1, seq, '', 'unopened' FROM l WHERE sum < low""",
    "scope_roots": """
WITH o AS (SELECT conv_id * 1000 + turn AS k, conv_id AS c FROM conversations),
t AS (SELECT *, (k % 3 <> 0)::INT AS a, (k % 5 = 0)::INT AS w, (k % 4 <> 0)::INT AS e, (k % 7 = 0)::INT AS x FROM o),
turns AS (SELECT 'turn' AS scope_kind, 't' || k AS scope_id, 'turn' AS span_kind, CASE WHEN x = 1 THEN 'cancelled' WHEN e = 1 THEN 'completed' ELSE 'running' END AS status,
  CASE WHEN a = 1 THEN 8 * k + 1 WHEN w = 1 THEN 8 * k + 2 ELSE -1 END AS started_at, a + w > 0 AND e + x = 1 AS root_complete, e + x > 1 AS state_conflict, (a + w)::BIGINT AS starts, (e + x)::BIGINT AS ends, w::BIGINT AS wire_starts, true AS hangs,
  CASE WHEN x = 1 THEN 8 * k + 4 ELSE 8 * k + 3 END AS f FROM t WHERE a + w + e + x > 0),
b AS (SELECT c, 8 * k AS seq, 1 AS d FROM o UNION ALL SELECT c, 8 * k + 5, -1 FROM o WHERE k % 11 <> 0),
r AS (SELECT *, sum((d = 1)::INT) OVER w AS s, sum((d = -1)::INT) OVER w AS e FROM b WINDOW w AS (PARTITION BY c ORDER BY seq)),
g AS (SELECT c, count(*) FILTER (d = 1) AS starts, count(*) FILTER (d = -1) AS ends, count(*) FILTER (CASE WHEN d = 1 THEN s - 1 > e ELSE s < e END) AS bad, arg_max(d, seq) = -1 AS closed, min(seq) FILTER (d = 1) AS started_at, max(seq) FILTER (d = -1) AS f FROM r GROUP BY c),
sessions AS (SELECT 'session', 's' || c, 'task_root', CASE WHEN closed THEN 'completed' ELSE 'running' END, started_at, ends > 0 AND bad = 0 AND closed AS root_complete, bad > 0, starts, ends, 0::BIGINT, false, f FROM g)
SELECT scope_kind, scope_id, span_kind, status, started_at, CASE WHEN root_complete THEN f ELSE -1 END AS finished_at, root_complete, state_conflict, starts, ends, wire_starts, hangs FROM (SELECT * FROM turns UNION ALL SELECT * FROM sessions)""",
    "call_spans": """
WITH x AS (SELECT conv_id::VARCHAR AS scope, 'c' || (turn // 2) AS call_id, conv_id * 3 + turn // 3 AS p, turn, CASE WHEN turn % 5 = 0 THEN 'x' ELSE 'y' END AS a, role AS c, conv_id + turn AS k FROM conversations),
g AS (SELECT scope, call_id, count(*) AS n, count(DISTINCT p % 4) AS names, count(DISTINCT a) AS args, count(*) FILTER (k % 3 <> 0) AS r, count(DISTINCT c) FILTER (k % 3 <> 0) AS contents, min(turn) AS started_at, bool_or(k % 7 = 0) AS ran FROM x GROUP BY ALL)
SELECT scope, call_id, CASE WHEN r = 1 THEN 'completed' ELSE 'running' END AS status, r > 0 AS answered, started_at, n <> 1 OR r > 1 OR names <> 1 OR args <> 1 OR contents > 1 AS state_conflict FROM g WHERE NOT ran""",
    "inherited_scopes": """
WITH RECURSIVE n AS (SELECT conv_id * 1000 + turn AS k, turn AS t, conv_id AS c, turn % 7 = 6 AS b, CASE WHEN turn % 5 = 0 AND conv_id % 10 <> 3 THEN 'v' || (turn // CASE WHEN conv_id % 2 = 0 THEN 3 ELSE 100 END) END AS v FROM conversations),
e AS (SELECT k, k - 1 AS p FROM n WHERE t > 0 UNION SELECT k, k - 3 FROM n WHERE t > 2 UNION SELECT k, k + 1 FROM n WHERE t = 0 AND c % 10 = 3),
u AS (SELECT e.k, e.p FROM e JOIN n ON n.k = e.p),
w AS (SELECT n.k, n.k AS at FROM n UNION SELECT w.k, u.p FROM w JOIN n ON n.k = w.at AND n.v IS NULL AND NOT n.b JOIN u ON u.k = w.at),
f AS (SELECT w.k, min(n.v) AS lo, max(n.v) AS hi FROM w JOIN n ON n.k = w.at GROUP BY w.k),
s AS (SELECT u.k, min(f.lo) AS lo, max(f.hi) AS hi FROM u JOIN f ON f.k = u.p GROUP BY u.k),
o AS (SELECT DISTINCT w.k FROM w JOIN n ON n.k = w.at AND n.v IS NULL AND NOT n.b JOIN w l ON l.k = w.at JOIN u ON u.k = l.at AND u.p = w.at JOIN n m ON m.k = l.at AND m.v IS NULL AND NOT m.b)
SELECT n.k AS node, CASE WHEN f.lo = f.hi THEN f.lo ELSE '' END AS inherited, coalesce(f.lo <> f.hi, false) AS contradiction,
  coalesce(NOT n.b AND n.v IS NOT NULL AND (s.lo <> n.v OR s.hi <> n.v), false) AS explicit_conflict, o.k IS NOT NULL AS cycle
FROM n JOIN f ON f.k = n.k LEFT JOIN s ON s.k = n.k LEFT JOIN o ON o.k = n.k""",
    "scenario_evidence": """
WITH x AS (SELECT conv_id AS s, turn // 4 AS u, turn AS t, turn % 2 = 0 AS launch, turn // 2 AS a, turn % 2 = 1 AND (conv_id + turn) % 3 <> 0 AS ended, CASE WHEN conv_id % 5 = 0 THEN 1 ELSE turn // 2 + 1 END AS p, (conv_id + turn) % 4 = 0 AS bad, role FROM conversations),
w AS (SELECT * FROM x WHERE s % 11 <> 7 AND (s % 9 <> 4 OR (SELECT count(*) FROM x y WHERE y.s = x.s AND y.u = x.u AND y.a = x.a) = 1)),
l AS (SELECT s, u, p, min(t) AS t FROM w WHERE launch GROUP BY ALL HAVING count(*) = 1),
d AS (SELECT DISTINCT l.s FROM l JOIN w ON w.s = l.s AND w.u = l.u AND w.p = l.p AND NOT w.launch AND w.ended AND w.t > l.t),
g AS (SELECT s, count(DISTINCT u) FILTER (role = 'assistant') > 1 AS second_turn, bool_or(t = 0) AND s % 3 = 0 AS resume, s IN (SELECT s FROM w WHERE ended AND bad) AS failed_tool_process, s IN (SELECT s FROM d) AS delayed_write_stdin FROM x GROUP BY s)
SELECT s AS session, second_turn, resume, failed_tool_process, delayed_write_stdin,
  array_to_string(list_filter([CASE WHEN NOT second_turn THEN 'second_turn' END, CASE WHEN NOT resume THEN 'resume' END, CASE WHEN NOT failed_tool_process THEN 'failed_tool_process' END, CASE WHEN NOT delayed_write_stdin THEN 'delayed_write_stdin' END], lambda v: v IS NOT NULL), ',') AS missing,
  second_turn AND resume AND failed_tool_process AND delayed_write_stdin AS complete FROM g""",
}
QUERIES = {k: (globals()[k], s) for k, s in SQL.items()}
