"""Turn analytics over ``conversations`` and source coverage over ``events``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..operators import messages, order, turns
from .common import table


def turn_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    nxt = F.lead("role").over(W.partitionBy("conv_id").orderBy("turn"))
    return (
        c.withColumn("next_role", nxt)
        .groupBy("conv_id")
        .agg(
            F.count("*").alias("n_messages"),
            F.count_if(F.col("role") == "user").alias("n_user"),
            F.count_if((F.col("role") == "user") & F.col("next_role").eqNullSafe("assistant")).alias("n_pairs"),
        )
    )


def user_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = table(spark, sf_dir, "conversations").where("role = 'user'")
    u = order.previous(u, ["conv_id"], ["turn"], "text", "before")
    u = u.select("conv_id", turns.user_class(F.col("text"), F.col("before")).alias("class"), turns.is_correction(F.col("text")).alias("correction"))
    return u.groupBy("conv_id", "class").agg(F.count("*").alias("n"), F.count_if("correction").alias("corrections"))


def answered_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    good = (F.col("role") == "assistant") & (F.length("text") >= 20)
    x = order.answered(c, "conv_id", "turn", F.col("role") == "user", good, "answered")
    return x.groupBy("conv_id").agg(F.count("*").alias("n_user"), F.count_if("answered").alias("n_answered"))


def open_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    x = order.latest(c, ["conv_id"], ["turn"], F.col("role"), "last_role")
    return x.select("conv_id", "last_role", (F.col("last_role") == "user").alias("is_open"))


def first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order.first_seen(table(spark, sf_dir, "events"), ["user_id", "event_type"], ["ts", "event_id"], "event_id", "first_event")


def transcript_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    rows = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    return c.groupBy("conv_id").agg(rows.alias("r")).select("conv_id", F.sha2(F.array_join(F.transform("r", lambda x: F.concat(x["role"], F.lit(":"), x["text"])), "\n"), 256).alias("fingerprint"))


def message_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("snapshot"), F.unix_micros(F.col("ts").cast("timestamp")).alias("position"), "event_type", "props")
    x = order.fold_messages(e, "user_id", "position", "event_type", "props")
    return x.select("user_id", "event_type", F.col("occurrence").cast("long").alias("occurrence"), "position", "content", "divergences")


def message_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("snapshot"), F.unix_micros(F.col("ts").cast("timestamp")).alias("position"), "event_type", "props")
    return messages.merge_messages(e, "user_id", "snapshot", "position", "event_type", "props").select("user_id", "event_type", "occurrence", "position", F.col("props").alias("content"), "divergences")


SOURCES = ["click", "purchase", "view", "signup", "error"]


def source_roll_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    kind = F.when(F.col("event_type") == "signup", "start").when(F.col("event_type").isin("error", "purchase"), "terminal")
    e = e.withColumns({"kind": kind, "day": F.date_format("ts", "yyyy-MM-dd")})
    return turns.roll_up(e, ["user_id", "day"], "event_type", SOURCES, "kind", "event_type")


def session_readiness(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = source_roll_up(spark, sf_dir)
    r = r.select("user_id", (F.col("starts") == 0).cast("int").alias("no_start"), F.col("conflict").cast("int").alias("conflicts"), (F.col("missing") != "").cast("int").alias("incomplete"))
    return turns.readiness(r, ["user_id"], ["no_start", "conflicts", "incomplete"])


def context_dispositions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    session = F.when(F.col("event_type") == "error", None).otherwise(F.col("user_id") % 4)
    n = F.col("event_id")
    x = e.select(
        "event_id", F.when(n % 9 != 0, F.col("user_id")).alias("producer"), session.alias("session"), F.when(n % 3 == 0, F.lit("t")).alias("turn"),
        F.when(n % 17 == 0, F.array(F.lit(2), F.lit(3))).otherwise(F.array().cast("array<int>")).alias("related"), (n % 2 == 0).alias("needs"), (n % 13 == 0).alias("process"),
    )
    return turns.dispositions(x, "event_id", "producer", "session", "turn", "related", "needs", "process", F.lit(2)).groupBy("disposition").agg(F.count("*").alias("n"))


def source_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    x = turns.freshness(e, ["user_id"], "event_type", "ts", F.lit("2024-01-31").cast("timestamp"), [*SOURCES, "hook"], {"signup": 5 * 86400, "click": 86400}, 2 * 86400)
    return x.select("user_id", "event_type", F.coalesce("age_s", F.lit(-1)).alias("age_s"), "state")


def event_scopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    name = F.when(F.col("event_type") == "click", "codex.tool_result").when(F.col("event_type") == "view", "codex.session").otherwise(F.col("event_type"))
    x = e.select(turns.event_scope(name, F.col("user_id") % 7 == 0, F.col("user_id") % 5 == 0).alias("scope"))
    return x.groupBy("scope").agg(F.count("*").alias("n"))


def telemetry_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").withColumn("ns", F.when(F.col("n_chars") > 500, F.col("lang")))
    return turns.scoped(d, "ns", F.lit("en")).groupBy("scope").agg(F.count("*").alias("n"))


def gap_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    return turns.bounded_samples(li, "o_custkey", ["o_orderkey"], 3)


def lifecycle_epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    kind = F.when(F.col("event_type") == "signup", "start").when(F.col("event_type") == "error", "terminal")
    return order.epochs(e.withColumn("kind", kind), ["user_id"], "kind", ["ts", "event_id"])


def compaction_alternates(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    kind = F.when(F.col("event_type") == "click", "start").when(F.col("event_type") == "view", "terminal")
    e = e.withColumns({"kind": kind, "day": F.date_format("ts", "yyyy-MM-dd")})
    return order.alternating(e, ["user_id", "day"], ["ts", "event_id"], "kind")


def collapse_last_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    e = e.select("event_id", "user_id", F.lower(F.substring("event_type", 1, 1)).alias("event"), F.unix_millis(F.col("ts").cast("timestamp")).alias("at_ms"))
    e = e.withColumn("event", F.when(F.col("event").isin("c", "v"), "browse").otherwise("act"))
    kept = order.collapse(e, ["user_id"], "event", "at_ms", "event_id", 3 * 3_600_000)
    return kept.groupBy("user_id").agg(F.count("*").alias("kept"), F.sum("event_id").alias("ids"))


def capture_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    ts = F.when((F.col("user_id") % 10 == 3) & (F.col("event_type") == "error"), None).otherwise(F.date_trunc("day", "ts"))
    x = e.select("event_id", "user_id", ts.alias("ts"), F.lit("t").alias("trace"), (F.col("event_id") * 7 % 101).alias("ordinal"), F.col("event_id").alias("src"))
    return order.capture_order(x, "user_id", "ts", "trace", "ordinal", "src", "event_id").select("event_id", F.col("position").cast("long").alias("position"))


def sequence_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order.gaps(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_linenumber")


def _listed(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


_PREV = "lag(text) OVER (PARTITION BY conv_id ORDER BY turn)"
_ROLL = """
SELECT user_id, strftime(ts, '%Y-%m-%d') AS day,
  count(*) FILTER (event_type='click') AS n_click, count(*) FILTER (event_type='purchase') AS n_purchase,
  count(*) FILTER (event_type='view') AS n_view, count(*) FILTER (event_type='signup') AS n_signup,
  count(*) FILTER (event_type='error') AS n_error,
  count(*) FILTER (event_type='signup') AS starts,
  count(*) FILTER (event_type IN ('error','purchase')) AS terminals,
  count(DISTINCT event_type) FILTER (event_type IN ('error','purchase')) > 1 AS conflict,
  array_to_string(list_sort(list_filter(['click','purchase','view','signup','error'], lambda s: NOT list_contains(list(event_type), s))), ',') AS missing
FROM events GROUP BY ALL
"""
SQL = {
    "turn_pairs": """
SELECT conv_id, count(*) AS n_messages, count(*) FILTER (role = 'user') AS n_user,
       count(*) FILTER (role = 'user' AND next_role = 'assistant') AS n_pairs
FROM (SELECT conv_id, role, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role
      FROM conversations) GROUP BY conv_id""",
    "user_classes": rf"""
WITH u AS (SELECT *, {_PREV} AS before, lower(trim(text)) AS low FROM conversations WHERE role = 'user'),
c AS (SELECT conv_id,
  CASE WHEN low = '' OR regexp_matches(low, '^[\p{{P}}\p{{S}}\s]+$') OR low IN ({_listed(turns.ACKS)}) OR coalesce(trim(text) = trim(before), false) OR contains(low, 'heartbeat')
    OR starts_with(low, 'cron:') OR starts_with(low, '[cron]') THEN 'machine' ELSE 'human' END AS class,
  len(list_filter([{_listed(turns.CORRECTIONS)}], lambda w: contains(low, w))) > 0 AS correction FROM u)
SELECT conv_id, class, count(*) AS n, count(*) FILTER (correction) AS corrections FROM c GROUP BY ALL""",
    "answered_turns": """
WITH g AS (SELECT *, count(*) FILTER (role='user') OVER (PARTITION BY conv_id ORDER BY turn) AS o FROM conversations),
a AS (SELECT conv_id, o, max(CASE WHEN role='user' THEN 1 ELSE 0 END) AS u,
             max(CASE WHEN role='assistant' AND length(text) >= 20 THEN 1 ELSE 0 END) AS ok FROM g WHERE o > 0 GROUP BY ALL)
SELECT conv_id, count(*) AS n_user, sum(ok)::BIGINT AS n_answered FROM a GROUP BY conv_id""",
    "open_tail": "SELECT conv_id, arg_max(role, turn) AS last_role, arg_max(role, turn) = 'user' AS is_open FROM conversations GROUP BY conv_id",
    "first_seen": "SELECT user_id, event_type, arg_min(event_id, (ts, event_id)) AS first_event FROM events GROUP BY ALL",
    "transcript_fingerprint": "SELECT conv_id, sha256(string_agg(role || ':' || text, chr(10) ORDER BY turn)) AS fingerprint FROM conversations GROUP BY conv_id",
    "message_fold": """
WITH e AS (SELECT user_id, ts::DATE AS snapshot, epoch_us(ts) AS position, event_type, props FROM events),
n AS (SELECT *, row_number() OVER (PARTITION BY user_id, snapshot, event_type ORDER BY position) AS occurrence FROM e)
SELECT user_id, event_type, occurrence, min(position) AS position, arg_max(props, (length(props), props)) AS content,
       count(DISTINCT props) - 1 AS divergences FROM n GROUP BY user_id, event_type, occurrence""",
    "message_merge": """
WITH e AS (SELECT user_id, ts::DATE AS snapshot, epoch_us(ts) AS position, event_type, props FROM events),
n AS (SELECT *, row_number() OVER (PARTITION BY user_id, snapshot, event_type ORDER BY position) AS occurrence FROM e),
f AS (SELECT *, first_value(props) OVER (PARTITION BY user_id, event_type, occurrence ORDER BY snapshot) AS kept FROM n)
SELECT user_id, event_type, occurrence, arg_min(position, snapshot) AS position, min(kept) AS content, count(*) FILTER (props <> kept) AS divergences FROM f GROUP BY user_id, event_type, occurrence""",
    "source_roll_up": _ROLL,
    "session_readiness": f"""
WITH r AS ({_ROLL})
SELECT user_id, count(*) AS turns, count(*) FILTER (starts = 0) AS no_start, count(*) FILTER (conflict) AS conflicts,
  count(*) FILTER (missing <> '') AS incomplete,
  count(*) FILTER (starts = 0) = 0 AND count(*) FILTER (conflict) = 0 AND count(*) FILTER (missing <> '') = 0 AS ready
FROM r GROUP BY user_id""",
    "context_dispositions": """
WITH x AS (SELECT event_id AS n, CASE WHEN event_id % 9 <> 0 THEN user_id END AS p, CASE WHEN event_type = 'error' THEN NULL ELSE user_id % 4 END AS s FROM events),
d AS (SELECT *, coalesce(s = 2, false) AS inside, s IS NULL AND n % 17 = 0 AS vague FROM x),
h AS (SELECT DISTINCT p FROM d WHERE (inside OR vague) AND p IS NOT NULL),
f AS (SELECT d.*, h.p IS NOT NULL AS known, CASE WHEN n % 13 = 0 THEN 'process_level' WHEN inside AND n % 3 = 0 THEN 'turn_assigned' WHEN inside AND n % 2 <> 0 THEN 'session_level'
  WHEN (inside OR vague) AND n % 2 = 0 THEN 'unscoped_turn' WHEN s IS NOT NULL THEN 'other_session' ELSE 'unknown_session' END AS k FROM d LEFT JOIN h ON d.p = h.p)
SELECT CASE WHEN k IN ('unscoped_turn', 'unknown_session') AND p IS NOT NULL AND NOT known THEN 'ambient' ELSE k END AS disposition, count(*) AS n FROM f GROUP BY 1""",
    "source_freshness": """
WITH s AS (SELECT unnest(['click', 'purchase', 'view', 'signup', 'error', 'hook']) AS event_type), u AS (SELECT DISTINCT user_id FROM events),
g AS (SELECT user_id, event_type, epoch(TIMESTAMP '2024-01-31')::BIGINT - floor(epoch(max(ts)))::BIGINT AS age_s FROM events GROUP BY ALL)
SELECT u.user_id, s.event_type, coalesce(age_s, -1) AS age_s, CASE WHEN age_s IS NULL THEN 'missing' WHEN age_s > CASE s.event_type WHEN 'signup' THEN 432000 WHEN 'click' THEN 86400 ELSE 172800 END THEN 'stale' ELSE 'fresh' END AS state
FROM u CROSS JOIN s LEFT JOIN g ON g.user_id = u.user_id AND g.event_type = s.event_type""",
    "event_scopes": """
SELECT CASE WHEN event_type = 'click' AND user_id % 7 = 0 THEN 'conflict' WHEN event_type = 'click' THEN 'turn' WHEN user_id % 7 = 0 THEN 'process' WHEN user_id % 5 = 0 THEN 'session'
  WHEN event_type = 'view' THEN 'exempt' ELSE 'turn' END AS scope, count(*) AS n FROM events GROUP BY 1""",
    "telemetry_scope": """
SELECT CASE WHEN n_chars <= 500 THEN 'unscoped' WHEN lang = 'en' THEN 'selected' ELSE 'other' END AS scope, count(*) AS n FROM documents GROUP BY 1""",
    "gap_samples": """
SELECT o_custkey, o_orderkey, greatest(c - 3, 0) AS omitted FROM (
  SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n, count(*) OVER (PARTITION BY o_custkey) AS c FROM orders) WHERE n <= 3""",
    "lifecycle_epochs": """
WITH k AS (SELECT user_id, ts, event_id, CASE event_type WHEN 'signup' THEN 1 ELSE 0 END AS s FROM events WHERE event_type IN ('signup','error')),
r AS (SELECT *, sum(s) OVER w AS ss, sum(1 - s) OVER w AS tt FROM k WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
b AS (SELECT *, CASE WHEN s = 1 THEN ss - 1 > tt ELSE ss < tt END AS bad FROM r)
SELECT user_id, count(*) FILTER (s = 1) AS starts, count(*) FILTER (s = 0) AS terminals, count(*) FILTER (bad) AS invalid,
  arg_max(s = 0 AND NOT bad, (ts, event_id)) AS closed FROM b GROUP BY user_id""",
    "compaction_alternates": """
WITH k AS (SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, event_type, row_number() OVER (PARTITION BY user_id, ts::DATE ORDER BY ts, event_id) AS n
  FROM events WHERE event_type IN ('click','view'))
SELECT user_id, day, bool_and(event_type = CASE WHEN n % 2 = 1 THEN 'click' ELSE 'view' END) AND count(*) % 2 = 0 AS alternates, count(*) // 2 AS operations
FROM k GROUP BY user_id, day""",
    "collapse_last_kept": """
WITH RECURSIVE o AS (
  SELECT event_id, user_id, CASE WHEN event_type IN ('click','view') THEN 'browse' ELSE 'act' END AS event, epoch_ms(ts) AS at_ms,
         row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events),
w AS (
  SELECT user_id, n, event_id, event AS last, at_ms AS at, true AS kept FROM o WHERE n = 1
  UNION ALL
  SELECT o.user_id, o.n, o.event_id,
    CASE WHEN o.event = w.last AND abs(o.at_ms - w.at) <= 10800000 THEN w.last ELSE o.event END,
    CASE WHEN o.event = w.last AND abs(o.at_ms - w.at) <= 10800000 THEN w.at ELSE o.at_ms END,
    NOT (o.event = w.last AND abs(o.at_ms - w.at) <= 10800000)
  FROM w JOIN o ON o.user_id = w.user_id AND o.n = w.n + 1)
SELECT user_id, count(*) AS kept, sum(event_id)::BIGINT AS ids FROM w WHERE kept GROUP BY user_id""",
    "capture_positions": """
WITH x AS (SELECT event_id, user_id, CASE WHEN user_id % 10 = 3 AND event_type = 'error' THEN NULL ELSE date_trunc('day', ts) END AS t, event_id * 7 % 101 AS o FROM events),
m AS (SELECT *, bool_and(t IS NOT NULL) OVER (PARTITION BY user_id) AS timed FROM x)
SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY CASE WHEN timed THEN t END, CASE WHEN timed THEN o END, event_id) AS position FROM m""",
    "sequence_gaps": """
WITH d AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem),
g AS (SELECT l_orderkey, lag(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS after, l_linenumber AS next FROM d)
SELECT l_orderkey, after, next, (next - after - 1)::BIGINT AS n_missing FROM g WHERE next - after > 1""",
}
QUERIES = {k: (globals()[k], s) for k, s in SQL.items()}
