"""Usage analytics, scalar functions, windows and streams over the driver's tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text, values
from ..operators import usage
from ..operators.checkpoint import shared
from ..sources import jsonl, sinks
from ..streaming import ingest
from .common import table


def _cents(c: str):
    return F.round(F.col(c) * 100).cast("long")


def model_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    li, p = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    x = li.join(p, li["l_partkey"] == p["p_partkey"]).select("p_brand", F.col("l_quantity").cast("long").alias("tokens"), "l_returnflag")
    return usage.model_stats(x, "p_brand", "tokens", F.col("l_returnflag") != "R")


def usage_roll_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("cents", _cents("value"))
    return usage.roll_up(e, F.date_format("ts", "yyyy-MM-dd"), F.date_format("ts", "yyyy-MM"), "cents")


def p95_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.groupBy("event_type").agg(usage.nearest_rank("value", 0.95).alias("p95"), usage.nearest_rank("value", 0.5).alias("p50"))


def finite_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.when(F.col("event_type") == "error", F.lit(float("nan"))).when(F.col("user_id") % 9 == 0, F.lit(float("inf"))).otherwise(_cents("value"))
    g = table(spark, sf_dir, "events").withColumn("x", c).groupBy("user_id").agg(usage.finite_mean(F.col("x")).alias("m"))
    return g.select("user_id", F.coalesce(F.round("m", 4), F.lit(-1.0)).alias("mean"))


def uptime_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``uptime_buckets_all`` under its first name."""
    return uptime_buckets_all(spark, sf_dir)


def uptime_buckets_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events: a third of the errors count as failures, in buckets of 15 minutes, so that every state occurs."""
    e = table(spark, sf_dir, "events")
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    failed = (F.col("event_type") == "error") & (_cents("value") % 3 == 0)
    return usage.uptime(e, seconds, ~failed, 1704067200 - 162000, 900, 3360)


def daily_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("cents", _cents("value"))
    x = usage.daily(e, F.to_date("ts"), "2023-12-30", "2024-02-02", {"n": F.count("*"), "cents": F.sum("cents"), "p95": usage.nearest_rank("value", 0.95)})
    return x.select(F.col("day").cast("string").alias("day"), *[F.coalesce(c, F.lit(0).cast(t)).alias(c) for c, t in (("n", "long"), ("cents", "long"), ("p95", "double"))])


def watchdog_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("at", F.unix_micros(F.col("ts").cast("timestamp")))
    return usage.watchdog(e, "at", F.col("event_type") != "error")


def settled_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    price = F.when(F.col("o_orderkey") % 3 != 0, _cents("o_totalprice"))
    ids = F.array(F.concat(F.lit("c"), F.col("o_custkey").cast("string")))
    x = o.select("o_orderkey", ids.alias("ids"), price.alias("cents"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus")).alias("status"))
    s = usage.settle(x, "o_orderkey", "ids", ["cents", "status"], "o_orderkey")
    return s.select("component", "rows", F.coalesce("cents", F.lit(-1)).alias("cents"), F.coalesce("status", F.lit("")).alias("status"), "cents_conflict", "status_conflict")


def top_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usage.top(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", "o_orderkey", 25)


def keyset_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usage.keyset_page(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", 500, 40)


def offset_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return jsonl.page(d, ["doc_id"], F.col("n_chars"), 100, 50, 60_000)


def incremental_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = jsonl.incremental(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", 1000, 50, 200)
    return rows


def local_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    day = F.date_format(text.local_time(F.col("ts").cast("timestamp"), 480), "yyyy-MM-dd")
    return e.groupBy(day.alias("day")).agg(F.count("*").alias("n"))


def masked_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.sha2(text.mask_patterns(F.col("text")), 256).alias("masked"), text.is_injection(F.col("text")).alias("injection"))


def json_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.try_parse_json("props")
    e = table(spark, sf_dir, "events").select("event_type", values.pick(v, ["$.missing", "$.k"], "long").alias("k"))
    return e.groupBy("event_type").agg(F.sum("k").alias("total"), F.count("k").alias("n"))


def canonical_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select("event_id", text.fingerprint(F.concat(F.lit('{"z": 1, "a": '), F.col("props"), F.lit("}"))).alias("fingerprint"))


def usage_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    k = F.try_variant_get(F.try_parse_json("props"), "$.k", "string")
    body = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit('{"prompt_tokens": "'), k, F.lit('", "completionTokens": 5}'))).otherwise(F.concat(F.lit('{"input_tokens": '), k, F.lit(', "total_tokens": 50}')))
    u = e.select("event_type", values.usage(F.try_parse_json(body)).alias("u"))
    return u.groupBy("event_type").agg(F.sum("u.input_tokens").alias("input"), F.sum("u.output_tokens").alias("output"), F.sum("u.total_tokens").alias("total"))


def event_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    name = F.when(F.col("event_type") == "signup", " Session-Start").when(F.col("event_type") == "error", "task.failed:x").when(F.col("event_type") == "click", "Cancelled").otherwise(F.col("event_type"))
    x = e.select(text.normal_event(name).alias("event"), F.coalesce(text.boundary(name), F.lit("none")).alias("boundary"))
    return x.groupBy("event", "boundary").agg(F.count("*").alias("n"))


def quality_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    x = p.select(text.reason_code(F.concat(F.col("url"), F.when(F.col("page_id") % 4 == 0, " Missing session for tool").when(F.col("page_id") % 4 == 1, " bad Attribute value").when(F.col("page_id") % 4 == 2, " invalid JSON").otherwise(""))).alias("reason"))
    return x.groupBy("reason").agg(F.count("*").alias("n"))


def protocol_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    path = F.when(F.col("page_id") % 5 == 0, "/v1/chat/completions").when(F.col("page_id") % 5 == 1, "/v1/Messages").when(F.col("page_id") % 5 == 2, "/v1/responses").otherwise(F.col("url"))
    body = F.when(F.col("page_id") % 3 == 0, F.lit("data: {}\n\n")).when(F.col("page_id") % 3 == 1, F.lit('{"choices": []}')).otherwise(F.lit("{}"))
    x = p.select(text.protocol_shape(path, F.lit('{"model": "m"}'), body).alias("s"))
    return x.groupBy("s.family", "s.endpoint", "s.transport").agg(F.count("*").alias("n"))


def trace_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    h = F.md5(F.col("doc_id").cast("string"))
    head = F.when(F.col("doc_id") % 9 == 0, "FF-").when(F.col("doc_id") % 10 == 0, "0-").otherwise("00-")
    t = text.traceparent(F.concat(head, h, F.lit("-"), F.substring(h, 1, 16), F.lit("-01")))
    return d.select("doc_id", F.coalesce(t["trace_id"], F.lit("")).alias("trace_id"), F.coalesce(t["parent_span_id"], F.lit("")).alias("parent_span_id"))


def model_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    name = F.concat(F.when(F.col("p_partkey") % 2 == 0, "gpt-").otherwise("Claude-"), F.col("p_size").cast("string"), F.lit("."), (F.col("p_partkey") % 7).cast("string"))
    v = text.model_version(name)
    return p.groupBy(v["vendor"].alias("vendor"), v["major"].alias("major"), v["minor"].alias("minor")).agg(F.count("*").alias("n"))


def chain_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    chain = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit(" a"), F.col("o_custkey").cast("string"), F.lit(", b,"))).otherwise(F.col("o_custkey").cast("string"))
    return o.select("o_orderkey", F.array_join(text.chain_members(chain), "|").alias("members"))


def timestamp_nanos(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    s = F.when(F.col("event_id") % 2 == 0, F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))).otherwise(F.concat(F.unix_micros(F.col("ts").cast("timestamp")).cast("string"), F.lit("000")))
    return e.select("event_id", text.ts_nanos(s).cast("string").alias("nanos"))


def embedding_norms(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    sq = F.aggregate(F.transform("embedding", lambda x: F.round(x.cast("double") * 1000).cast("long")), F.lit(0).cast("long"), lambda a, x: a + x * x)
    return e.select("vec_id", "label", sq.alias("norm2"), F.size("embedding").cast("long").alias("dims"))


def stable_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", text.stable_id("msg", F.col("conv_id"), F.col("role")).alias("id"))


def union_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, s = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    u = c.select(F.col("c_nationkey").alias("nation")).unionByName(s.select(F.col("s_nationkey").alias("nation")))
    return u.groupBy("nation").agg(F.count("*").alias("n"))


def unresolved_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(
        F.collect_set(F.when(F.col("role") == "user", F.col("turn"))).alias("calls"), F.collect_set(F.when(F.col("role") == "assistant", F.col("turn") - 1)).alias("results")
    )
    return c.select("conv_id", F.size(F.array_except("calls", "results")).cast("long").alias("unresolved"), F.coalesce(F.arrays_overlap("calls", "results"), F.lit(False)).alias("meets"))


def tumbling_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumns({"ts": F.col("ts").cast("timestamp"), "value": _cents("value")})
    x = ingest.tumbling(e, "ts", "6 hours", "1 hour", "event_type")
    return x.select(F.date_format("window.start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "n", "total")


def sliding_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumns({"ts": F.col("ts").cast("timestamp"), "value": _cents("value")})
    x = ingest.sliding(e, "ts", "12 hours", "6 hours", "1 hour")
    return x.select(F.date_format("window.start", "yyyy-MM-dd HH:mm").alias("start"), "n", "total")


def session_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    x = ingest.sessions(e, "ts", "8 hours", "1 hour", "user_id")
    return x.groupBy("user_id").agg(F.count("*").alias("sessions"), F.max("n").alias("longest"))


def streamed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream's twin of ``tumbling_windows``: read as a stream, run until all is in, read back."""
    schema = table(spark, sf_dir, "events").schema
    path = f"{sf_dir}/events.parquet"
    fs, at, _ = sinks._fs(spark, path)
    if fs.getFileStatus(at).isFile():  # a stream reads folders
        source = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    else:
        source = spark.readStream.schema(schema).parquet(path)
    e = source.withColumns({"ts": F.col("ts").cast("timestamp"), "value": _cents("value")})
    x = ingest.tumbling(e, "ts", "6 hours", "1 hour", "event_type")
    at = f"{shared(spark)}/windows-{uuid.uuid4().hex}"

    def keep(df: DataFrame, epoch: int) -> None:
        df.write.mode("overwrite").parquet(f"{at}/epoch={epoch:08d}")

    q = x.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{at}-checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    last = spark.read.parquet(at).groupBy("window", "event_type").agg(F.max_by(F.struct("n", "total"), "epoch").alias("v"))
    return last.select(F.date_format("window.start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "v.n", "v.total")



_LEVELS = """
SELECT 'day' AS level, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m') AS month, count(*) AS requests, sum(round(value * 100)::BIGINT)::BIGINT AS tokens FROM events GROUP BY ALL
UNION ALL SELECT 'month', NULL, strftime(ts, '%Y-%m'), count(*), sum(round(value * 100)::BIGINT)::BIGINT FROM events GROUP BY ALL
UNION ALL SELECT 'all', NULL, NULL, count(*), sum(round(value * 100)::BIGINT)::BIGINT FROM events"""
_TUMBLING = """
SELECT strftime(time_bucket(INTERVAL 6 HOUR, ts), '%Y-%m-%d %H:%M') AS start, event_type, count(*) AS n, sum(round(value * 100)::BIGINT)::BIGINT AS total FROM events GROUP BY ALL"""


def _masked(c: str) -> str:
    for p in text.MASKED_PATTERNS:
        c = f"regexp_replace({c}, '{p}', '{text.MASK}', 'g')".replace(r"\p{IsHan}", r"\p{Han}")
    return f"regexp_replace({c}, '{text.CN_ID}', '\\1{text.MASK}\\3', 'g')"


SQL = {
    "model_stats": """
SELECT p_brand, count(*) AS requests, sum(l_quantity)::BIGINT AS tokens, count(*) FILTER (l_returnflag <> 'R') AS succeeded
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand""",
    "usage_roll_up": _LEVELS,
    "p95_by_type": "SELECT event_type, quantile_disc(value, 0.95) AS p95, quantile_disc(value, 0.5) AS p50 FROM events GROUP BY event_type",
    "finite_means": """
SELECT user_id, coalesce(round(avg(CASE WHEN event_type <> 'error' AND user_id % 9 <> 0 THEN round(value * 100)::BIGINT END), 4), -1)::DOUBLE AS mean FROM events GROUP BY user_id""",
    "uptime_buckets_all": """
WITH b AS (SELECT floor((floor(epoch(ts)) - (1704067200 - 162000)) / 900)::BIGINT AS bucket, NOT (event_type = 'error' AND round(value * 100)::BIGINT % 3 = 0) AS ok FROM events),
g AS (SELECT bucket, count(*) AS n, count(*) FILTER (ok) AS good FROM b GROUP BY bucket)
SELECT r.bucket, coalesce(n, 0) AS n, coalesce(good, 0) AS good, CASE WHEN n IS NULL THEN 'empty' WHEN good / n >= 0.97 THEN 'up' WHEN good / n >= 0.90 THEN 'degraded' ELSE 'down' END AS status
FROM (SELECT range AS bucket FROM range(3360)) r LEFT JOIN g ON r.bucket = g.bucket""",
    "daily_history": """
WITH g AS (SELECT ts::DATE AS day, count(*) AS n, sum(round(value * 100)::BIGINT)::BIGINT AS cents, quantile_disc(value, 0.95) AS p95 FROM events GROUP BY 1)
SELECT d.day::VARCHAR AS day, coalesce(n, 0) AS n, coalesce(cents, 0) AS cents, coalesce(p95, 0) AS p95
FROM (SELECT unnest(generate_series(DATE '2023-12-30', DATE '2024-02-02', INTERVAL 1 DAY))::DATE AS day) d LEFT JOIN g ON d.day = g.day""",
    "watchdog_summary": "SELECT count(*) AS checks, count(*) FILTER (event_type <> 'error') AS passed, max(epoch_us(ts)) AS last_check, arg_max(event_type <> 'error', ts) AS last_ok FROM events",
    "settled_usage": """
WITH x AS (SELECT o_orderkey AS k, o_custkey AS c, CASE WHEN o_orderkey % 3 <> 0 THEN round(o_totalprice * 100)::BIGINT END AS cents, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS s FROM orders)
SELECT min(k) AS component, count(*) AS rows, coalesce(arg_min(cents, k) FILTER (cents IS NOT NULL), -1) AS cents, coalesce(arg_min(s, k) FILTER (s IS NOT NULL), '') AS status,
  count(DISTINCT cents) > 1 AS cents_conflict, count(DISTINCT s) > 1 AS status_conflict FROM x GROUP BY c""",
    "top_orders": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25",
    "keyset_page": "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey > 500 ORDER BY o_orderkey LIMIT 40",
    "offset_page": """
WITH p AS (SELECT doc_id, n_chars FROM documents ORDER BY doc_id LIMIT 50 OFFSET 100), s AS (SELECT *, sum(n_chars) OVER (ORDER BY doc_id) AS b, row_number() OVER (ORDER BY doc_id) AS n FROM p)
SELECT doc_id, n_chars FROM s WHERE b <= 60000 OR n = 1""",
    "incremental_page": "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey > 950 ORDER BY o_orderkey LIMIT 200",
    "local_days": "SELECT strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY 1",
    "masked_documents": f"SELECT doc_id, sha256({_masked('text')}) AS masked, regexp_matches(text, '{text.INJECTION}') AS injection FROM documents",
    "json_paths": "SELECT event_type, sum((props->>'$.k')::BIGINT)::BIGINT AS total, count(props->>'$.k') AS n FROM events GROUP BY event_type",
    "canonical_fingerprints": """SELECT event_id, sha256('{"a":{"k":' || (props->>'$.k') || '},"z":1}') AS fingerprint FROM events""",
    "usage_aliases": """
WITH x AS (SELECT event_type, event_id % 2 = 0 AS e, (props->>'$.k')::BIGINT AS k FROM events)
SELECT event_type, sum(k)::BIGINT AS input, (sum(5) FILTER (e))::BIGINT AS output, sum(CASE WHEN e THEN k + 5 ELSE greatest(50, k) END)::BIGINT AS total FROM x GROUP BY event_type""",
    "event_boundaries": """
SELECT CASE event_type WHEN 'signup' THEN 'session_start' WHEN 'error' THEN 'task_failed_x' WHEN 'click' THEN 'cancelled' ELSE event_type END AS event,
  CASE event_type WHEN 'signup' THEN 'start' WHEN 'error' THEN 'terminal' WHEN 'click' THEN 'terminal' ELSE 'none' END AS boundary, count(*) AS n FROM events GROUP BY ALL""",
    "quality_reasons": """
WITH x AS (SELECT lower(url || CASE page_id % 4 WHEN 0 THEN ' Missing session for tool' WHEN 1 THEN ' bad Attribute value' WHEN 2 THEN ' invalid JSON' ELSE '' END) AS s FROM pages)
SELECT CASE WHEN contains(s, 'lifecycle') THEN 'invalid_lifecycle' WHEN contains(s, 'conflicting') OR contains(s, 'duplicate context') THEN 'identity_conflict'
  WHEN contains(s, 'missing session') OR contains(s, 'requires session') OR contains(s, 'missing turn') OR contains(s, 'requires turn') THEN 'missing_identity'
  WHEN contains(s, 'unsupported') OR contains(s, 'unknown event') THEN 'unsupported_event' WHEN contains(s, 'attribute') OR contains(s, 'metadata') THEN 'invalid_attributes'
  WHEN contains(s, 'tool') THEN 'invalid_tool' WHEN contains(s, 'status') THEN 'invalid_lifecycle' WHEN contains(s, 'timestamp') THEN 'invalid_timestamp'
  WHEN contains(s, 'structure') OR contains(s, 'invalid json') THEN 'invalid_structure' ELSE 'conversion_error' END AS reason, count(*) AS n FROM x GROUP BY 1""",
    "protocol_shapes": """
SELECT CASE WHEN page_id % 5 = 1 THEN 'anthropic' ELSE 'openai' END AS family,
  CASE WHEN page_id % 5 = 1 THEN 'messages' WHEN page_id % 5 = 0 OR page_id % 3 = 1 THEN 'chat_completions' WHEN page_id % 5 = 2 THEN 'responses' ELSE 'unknown' END AS endpoint,
  CASE WHEN page_id % 3 = 0 THEN 'stream' ELSE 'non_stream' END AS transport, count(*) AS n FROM pages GROUP BY ALL""",
    "trace_contexts": """
SELECT doc_id, CASE WHEN doc_id % 9 = 0 OR doc_id % 10 = 0 THEN '' ELSE md5(doc_id::VARCHAR) END AS trace_id,
  CASE WHEN doc_id % 9 = 0 OR doc_id % 10 = 0 THEN '' ELSE left(md5(doc_id::VARCHAR), 16) END AS parent_span_id FROM documents""",
    "model_versions": "SELECT CASE WHEN p_partkey % 2 = 0 THEN 'gpt' ELSE 'claude' END AS vendor, p_size AS major, (p_partkey % 7)::INT AS minor, count(*) AS n FROM part GROUP BY ALL",
    "chain_members": """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'a' || o_custkey || ', b,|a' || o_custkey || '|b' ELSE o_custkey::VARCHAR END AS members FROM orders""",
    "timestamp_nanos": "SELECT event_id, (epoch_us(ts)::HUGEINT * 1000)::VARCHAR AS nanos FROM events",
    "embedding_norms": "SELECT vec_id, label, list_sum(list_transform(embedding, lambda x: round(x::DOUBLE * 1000)::BIGINT * round(x::DOUBLE * 1000)::BIGINT))::BIGINT AS norm2, len(embedding) AS dims FROM embeddings",
    "stable_ids": "SELECT conv_id, turn, 'msg-' || sha256(conv_id || chr(0) || role) AS id FROM conversations",
    "union_inputs": "SELECT nation, count(*) AS n FROM (SELECT c_nationkey AS nation FROM customer UNION ALL SELECT s_nationkey FROM supplier) GROUP BY nation",
    "unresolved_calls": """
WITH g AS (SELECT conv_id, list(turn) FILTER (role = 'user') AS c, list(turn - 1) FILTER (role = 'assistant') AS r FROM conversations GROUP BY conv_id)
SELECT conv_id, len(list_filter(coalesce(c, []), lambda x: NOT list_contains(coalesce(r, []), x))) AS unresolved, coalesce(list_has_any(c, r), false) AS meets FROM g""",
    "tumbling_windows": _TUMBLING,
    "sliding_windows": """
WITH x AS (SELECT time_bucket(INTERVAL 6 HOUR, ts) AS b, round(value * 100)::BIGINT AS v FROM events), y AS (SELECT b, v FROM x UNION ALL SELECT b - INTERVAL 6 HOUR, v FROM x)
SELECT strftime(b, '%Y-%m-%d %H:%M') AS start, count(*) AS n, sum(v)::BIGINT AS total FROM y GROUP BY b""",
    "session_windows": """
WITH l AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 8 HOUR THEN 0 ELSE 1 END AS s FROM events),
g AS (SELECT user_id, sum(s) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM l), c AS (SELECT user_id, k, count(*) AS n FROM g GROUP BY ALL)
SELECT user_id, count(*) AS sessions, max(n) AS longest FROM c GROUP BY user_id""",
    "streamed_windows": _TUMBLING,
}
SQL["uptime_buckets"] = SQL["uptime_buckets_all"]
QUERIES = {k: (globals()[k], s) for k, s in SQL.items()}
