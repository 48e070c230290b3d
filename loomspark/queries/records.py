"""Idempotence, snapshots, exact joins, graphs and gates over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dedup, graph, identity, joins, packing, score, verify
from ..plans import release as plans
from .common import table


def doc_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars", F.sha2("text", 256).alias("digest"))
    return dedup.winners(d, ["digest"], [F.desc("n_chars"), F.asc("doc_id")])


def id_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.concat_ws("|", "l_partkey", "l_suppkey").alias("digest"))
    return dedup.idempotent(li, ["l_orderkey", "l_linenumber"], "digest").groupBy("status").agg(F.count("*").alias("ids"), F.sum("n").alias("n_rows"))


def _snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars", dedup.line_parts(F.col("text")).alias("parts"), F.sha2("text", 256).alias("digest"))
    return dedup.snapshots(d, "doc_id", "source", "parts", [F.desc("n_chars"), F.asc("doc_id")])


def snapshot_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _snapshots(spark, sf_dir).select("doc_id", "status")


def dedup_conservation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.conservation(_snapshots(spark, sf_dir))


def enrich_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``enrich_outcomes_all`` under its first name."""
    return enrich_outcomes_all(spark, sf_dir)


def enrich_outcomes_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers and suppliers as facts; the outcomes come from the keys, and no fact is left out."""
    e = table(spark, sf_dir, "events")
    u, n = F.col("user_id"), F.col("event_id")
    client = F.concat(F.lit("client:"), F.expr("user_id div 15"))
    keys = F.when(n % 11 == 0, F.array().cast("array<string>")).when(n % 4 == 0, F.array(client)).when(n % 4 == 1, F.array(u.cast("string"), client)).otherwise(F.array(u.cast("string")))
    had = F.when(n % 3 == 0, u.cast("string")).when(n % 3 == 1, F.lit("7"))
    rows = e.select("event_id", keys.alias("keys"), had.alias("existing"))
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("fk"), F.col("c_custkey").cast("long").alias("fid"))
    k = F.col("s_suppkey")
    s = table(spark, sf_dir, "supplier").select(F.concat(F.lit("client:"), F.when(k % 5 == 0, k + 1).otherwise(k).cast("string")).alias("fk"), (k * 15).cast("long").alias("fid"))
    x = identity.enrich(rows, "event_id", "keys", c.union(s), "fk", "fid", "existing")
    return x.groupBy("outcome").agg(F.count("*").alias("n"), F.coalesce(F.sum("fact"), F.lit(-1)).alias("facts"))


def inherited_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    rows = d.select("doc_id", F.when(F.col("doc_id") % 3 != 0, F.col("source")).alias("target"), F.array(F.concat(F.lit("t:"), F.sha2("text", 256))).alias("links"))
    return identity.inherit(rows, "doc_id", "target", "links").select("doc_id", "linked", "link_conflict")


def conservation_joins(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"))
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"))
    return joins.conserve(o, li, "k")


def missing_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), "o_custkey")
    return joins.missing(o, table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k")), "k")


def call_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    calls = c.where("role = 'user'").select("conv_id", F.col("turn").alias("call"))
    results = c.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("call"))
    x = joins.pair_calls(calls, results, "conv_id", "call")
    return x.withColumn("rate", F.round("rate", 6))


def complete_definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    called = li.select("l_suppkey", "l_partkey")
    p = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") > 25).alias("ok"))
    defined = called.join(p, called["l_partkey"] == p["p_partkey"]).select("l_suppkey", "l_partkey", "ok")
    return joins.definitions_complete(called, defined, "l_suppkey", "l_partkey", "ok")


def _turn_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    node = F.col("conv_id") * 1000 + F.col("turn")
    first = F.col("turn") == 0
    return c.select("conv_id", "role", "text", node.alias("node"), F.when(~first, node - 1).alias("parent"))


def edges_by_relation(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _turn_nodes(spark, sf_dir).withColumnRenamed("node", "id").withColumn("before", F.col("parent"))
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_custkey")
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_custkey").alias("ck"))
    e = joins.relations({"follows": (n, "parent", n, "id"), "ordered_by": (o, "o_custkey", c, "ck")})
    return e.groupBy("relation").agg(F.count("*").alias("n"), F.sum(F.col("from_id") * 3 + F.col("to_id")).alias("checksum"))


def parent_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _turn_nodes(spark, sf_dir).where("role != 'system'")
    return joins.parents(n, "node", "parent").select("node", "parent_state")


def turn_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus", F.array("l_partkey").alias("refs"))
    return joins.coverage(li.where("l_returnflag = 'R'"), li.where("l_linestatus = 'F'"), "l_orderkey", "refs")


def attached_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("k"), "lang", "source")
    rows = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("k"))
    return joins.attach(rows, "k", d, ["lang", "source"]).select("doc_id", "lang", "source")


def lineage_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.single_parents(table(spark, sf_dir, "lineitem"), "l_partkey", "l_suppkey").na.fill(-1, ["parent"])


def usage_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c, n = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    j = o.join(c, o["o_custkey"] == c["c_custkey"], "left").join(n, c["c_nationkey"] == n["n_nationkey"], "left")
    return j.select("o_orderkey", F.coalesce(F.nullif(F.trim("c_mktsegment"), F.lit("BUILDING")), F.col("n_name"), F.lit("none")).alias("label"), F.col("o_totalprice").alias("price"))


def chain_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.walk(_turn_nodes(spark, sf_dir), "node", "parent")


def graph_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.shape(_turn_nodes(spark, sf_dir).where("role != 'system'"), "node", "parent").select("node", "is_root", "is_tip", "unresolved")


def turn_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.components(_turn_nodes(spark, sf_dir), "node", "parent")


def inherited_boundary(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _turn_nodes(spark, sf_dir).withColumns({"v": F.when((F.col("node") % 5) == 0, F.col("role")), "stop": (F.col("node") % 7) == 0})
    return graph.nearest_boundary(n, "node", "parent", "v", "stop").select("node", "inherited")


def priority_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.single_tree(table(spark, sf_dir, "lineitem"), "l_partkey", "l_suppkey", "l_quantity").na.fill(-1, ["parent"])


def verified_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.verify_tree(_turn_nodes(spark, sf_dir), "conv_id", "node", "parent")


def runtime_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    kind = F.when(F.col("event_type").isin("signup", "click"), "start").when(F.col("event_type").isin("error", "purchase"), "terminal")
    x = e.select("user_id", F.floor(F.col("value") / 50).cast("long").alias("node"), kind.alias("kind"), F.col("event_type").alias("status"))
    return graph.runtime_nodes(x, "user_id", "node", "kind", "status")


def task_graphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _turn_nodes(spark, sf_dir).withColumn("root", F.col("conv_id") * 1000)
    return graph.task_graph(n, "root", "node", "parent")


def unique_scopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.unique_scope(table(spark, sf_dir, "documents").withColumn("k", F.sha2("text", 256)), ["k"], "source", "only_source")


CHECKS = {"long_enough": 15.0, "few_marks": 10.0, "labelled": 5.0, "not_toxic": 15.0}


def _assessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, lab = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    x = d.join(lab, "doc_id", "left").select("doc_id", "n_chars", "quality", "toxic", F.contains("text", F.lit("!!")).alias("marks"))
    checks = {"long_enough": F.col("n_chars") >= 200, "few_marks": ~F.col("marks"), "labelled": F.col("quality").isNotNull(), "not_toxic": F.col("toxic") == 0}
    return score.assess(x, checks, CHECKS)


def gate_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _assessed(spark, sf_dir).select("doc_id", "score", F.array_join("failures", ",").alias("failures"), "eligible")


def failure_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score.reasons(_assessed(spark, sf_dir))


def score_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score.summary(_assessed(spark, sf_dir))


def contract_breaches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verification of assessments that were tampered with on every seventh row."""
    x = _assessed(spark, sf_dir).withColumn("score", F.when(F.col("doc_id") % 7 == 0, F.col("score") + 1).otherwise(F.col("score")))
    return score.reassess(x, list(CHECKS), CHECKS).select("doc_id")


def reward_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score.rewards(table(spark, sf_dir, "events").withColumn("cents", F.round(F.col("value") * 100).cast("long")), "user_id", "event_type", "cents")


def release_acceptance(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars", dedup.line_parts(F.col("text")).alias("parts"), F.sha2("text", 256).alias("digest"))
    checks = {"long_enough": F.col("n_chars") >= 50}
    r = plans.release(d, "doc_id", "source", "parts", [F.desc("n_chars"), F.asc("doc_id")], checks, {"long_enough": 5.0}, "n_chars", 100_000)
    return plans.acceptance(r, ["long_enough"], {"long_enough": 5.0}, 5.0)


def pack_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("lang", "doc_id", "n_chars")
    return packing.pack(d, "lang", "doc_id", "n_chars", 100_000).groupBy("lang", "batch").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"), F.min("doc_id").alias("first_doc"))


def release_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return packing.parts(d, ["doc_id"], "n_chars", 50_000).select("doc_id", "part", "oversize")


def release_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``release_differences_all`` under its first name."""
    return release_differences_all(spark, sf_dir)


def release_differences_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders on both sides; the keys of some differ, so they are missing on one side and extra on the other."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.col("o_custkey").alias("cust"))
    k = F.col("o_orderkey")
    a = o.withColumn("o_orderkey", F.when(k % 10 == 0, -k - 1).otherwise(k))
    e = o.withColumns({"o_orderkey": F.when(k % 11 == 0, -k - 1).otherwise(k), "cust": F.when(k % 13 == 0, F.col("cust") + 1).otherwise(F.col("cust"))})
    return verify.compare(a, e, ["o_orderkey"], ["o_orderstatus", "cust"]).groupBy("state", "differ").agg(F.count("*").alias("n"))


def set_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify.set_equal(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")), table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")))


def fallen_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    count = lambda x: x.groupBy("user_id").agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("errors"))
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    return verify.monotone(count(e.where(~early)), count(e.where(early)), "user_id", ["n", "errors"])


def contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {"positive": F.col("o_totalprice") > 100000, "status": F.col("o_orderstatus").isin("F", "O"), "priority": F.col("o_orderpriority").rlike("^[1-3]-")}
    _, bad = verify.contract(table(spark, sf_dir, "orders"), rules)
    return bad.select(F.explode("violations").alias("rule")).groupBy("rule").agg(F.count("*").alias("n"))


_NODES = "(SELECT conv_id, role, conv_id * 1000 + turn AS node, CASE WHEN turn <> 0 THEN conv_id * 1000 + turn - 1 END AS parent FROM conversations)"
_SNAP = """
WITH x AS (SELECT doc_id, source, n_chars, text, row_number() OVER (PARTITION BY source, text ORDER BY n_chars DESC, doc_id) AS o FROM documents),
d AS (SELECT *, len(string_split(text, chr(10))) AS n FROM x WHERE o = 1),
ins AS (SELECT DISTINCT a.doc_id FROM d a JOIN d b ON a.source = b.source AND a.n < b.n AND contains(chr(10) || b.text || chr(10), chr(10) || a.text || chr(10))),
y AS (SELECT x.*, ins.doc_id IS NOT NULL AS inside FROM x LEFT JOIN ins ON x.doc_id = ins.doc_id),
r AS (SELECT *, count(*) FILTER (o = 1 AND NOT inside) OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id ROWS UNBOUNDED PRECEDING) AS rk FROM y),
g AS (SELECT *, min(CASE WHEN o = 1 AND NOT inside AND rk = 1 THEN source END) OVER (PARTITION BY text) AS fg FROM r),
s AS (SELECT doc_id, CASE WHEN o > 1 THEN 'exact' WHEN inside THEN 'subset' WHEN rk > 1 THEN 'divergent' WHEN source <> fg THEN 'repeat' ELSE 'kept' END AS status FROM g)
"""
_GATES = """
WITH x AS (SELECT d.doc_id, n_chars >= 200 AS a, NOT contains(text, '!!') AS b, quality IS NOT NULL AS c, coalesce(toxic = 0, false) AS e
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
g AS (SELECT doc_id, (CASE WHEN a THEN 15 ELSE 0 END + CASE WHEN b THEN 10 ELSE 0 END + CASE WHEN c THEN 5 ELSE 0 END + CASE WHEN e THEN 15 ELSE 0 END)::DOUBLE AS score,
  list_filter([CASE WHEN NOT a THEN 'long_enough' END, CASE WHEN NOT b THEN 'few_marks' END, CASE WHEN NOT c THEN 'labelled' END, CASE WHEN NOT e THEN 'not_toxic' END], lambda s: s IS NOT NULL) AS f FROM x)
"""
SQL = {
    "doc_exact_dedup": "SELECT doc_id, n_chars, digest FROM (SELECT doc_id, n_chars, sha256(text) AS digest, row_number() OVER (PARTITION BY text ORDER BY n_chars DESC, doc_id) AS r FROM documents) WHERE r = 1",
    "id_conflicts": """
WITH g AS (SELECT l_orderkey, l_linenumber, count(*) AS n, count(DISTINCT (l_partkey, l_suppkey)) AS k FROM lineitem GROUP BY ALL)
SELECT CASE WHEN k > 1 THEN 'conflict' WHEN n > 1 THEN 'duplicate' ELSE 'accepted' END AS status, count(*) AS ids, sum(n)::BIGINT AS n_rows FROM g GROUP BY 1""",
    "snapshot_statuses": _SNAP + "SELECT doc_id, status FROM s",
    "dedup_conservation": _SNAP + """SELECT count(*) AS input, count(*) FILTER (status = 'exact') AS exact, count(*) FILTER (status = 'subset') AS subset,
  count(*) FILTER (status = 'repeat') AS repeat, count(*) FILTER (status = 'divergent') AS divergent, count(*) FILTER (status = 'kept') AS kept, true AS conserved FROM s""",
    "enrich_outcomes_all": """
WITH facts AS (SELECT fk, count(DISTINCT fid) AS nf, min(fid) AS fid FROM (
    SELECT c_custkey::VARCHAR AS fk, c_custkey AS fid FROM customer
    UNION ALL SELECT 'client:' || CASE WHEN s_suppkey % 5 = 0 THEN s_suppkey + 1 ELSE s_suppkey END, s_suppkey * 15 FROM supplier) GROUP BY fk),
k AS (SELECT event_id, user_id::VARCHAR AS key FROM events WHERE event_id % 11 <> 0 AND event_id % 4 <> 0
  UNION ALL SELECT event_id, 'client:' || (user_id // 15) FROM events WHERE event_id % 11 <> 0 AND event_id % 4 IN (0, 1)),
h AS (SELECT event_id, max(nf) AS most, count(DISTINCT fid) AS n, min(fid) AS fid FROM k LEFT JOIN facts ON key = fk GROUP BY event_id),
o AS (SELECT e.event_id, h.fid, CASE WHEN h.event_id IS NULL THEN 'unmatched_no_key' WHEN n = 0 THEN 'unmatched_not_found' WHEN most > 1 THEN 'ambiguous_multiple_facts'
  WHEN n > 1 THEN 'ambiguous_candidates_disagree' WHEN e.event_id % 3 = 0 AND h.fid <> e.user_id OR e.event_id % 3 = 1 AND h.fid <> 7 THEN 'conflicting_existing' ELSE 'matched' END AS outcome
  FROM events e LEFT JOIN h ON e.event_id = h.event_id)
SELECT outcome, count(*) AS n, coalesce((sum(fid) FILTER (outcome = 'matched'))::BIGINT, -1) AS facts FROM o GROUP BY outcome""",
    "inherited_links": """
WITH k AS (SELECT text, min(source) AS lo, max(source) AS hi FROM documents WHERE doc_id % 3 <> 0 GROUP BY text)
SELECT doc_id, CASE WHEN doc_id % 3 <> 0 THEN source WHEN lo = hi THEN lo END AS linked, coalesce(doc_id % 3 = 0 AND lo <> hi, false) AS link_conflict
FROM documents d LEFT JOIN k ON d.text = k.text""",
    "conservation_joins": """
WITH a AS (SELECT o_orderkey AS k, count(*) AS n FROM orders GROUP BY 1), b AS (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1),
c AS (SELECT count(*) FILTER (a.k IS NOT NULL AND b.k IS NOT NULL) AS matched, count(*) FILTER (b.k IS NULL) AS missing, count(*) FILTER (a.k IS NULL) AS extra,
  count(*) FILTER (a.n > 1) AS duplicate_keys FROM a FULL JOIN b ON a.k = b.k)
SELECT *, 0::BIGINT AS without_key, missing + duplicate_keys = 0 AS complete FROM c""",
    "missing_orders": "SELECT o_orderkey AS k, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)",
    "call_pairs": """
WITH c AS (SELECT conv_id, turn AS call, 1 AS c, 0 AS r FROM conversations WHERE role = 'user' UNION ALL SELECT conv_id, turn - 1, 0, 1 FROM conversations WHERE role = 'assistant'),
g AS (SELECT conv_id, call, sum(c) AS c, sum(r) AS r FROM c GROUP BY ALL)
SELECT conv_id, sum(c)::BIGINT AS calls, count(*) FILTER (c = 1 AND r = 1) AS paired, count(*) FILTER (c = 0 AND r > 0) AS orphans, count(*) FILTER (c > 1) AS duplicate_calls,
  count(*) FILTER (r > 1) AS duplicate_results, count(*) FILTER (c > 0 AND r = 0) AS unresolved,
  round(CASE WHEN sum(c) = 0 THEN 0 ELSE count(*) FILTER (c = 1 AND r = 1) / sum(c) END, 6)::DOUBLE AS rate FROM g GROUP BY conv_id""",
    "complete_definitions": """
WITH c AS (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem)
SELECT l_suppkey, count(*) AS called, count(*) FILTER (coalesce(p_size > 25, false)) AS complete, bool_and(coalesce(p_size > 25, false)) AS all_complete
FROM c LEFT JOIN part ON l_partkey = p_partkey GROUP BY l_suppkey""",
    "edges_by_relation": f"""
WITH n AS {_NODES}, e AS (SELECT 'follows' AS relation, a.node AS f, b.node AS t FROM n a JOIN n b ON a.parent = b.node
  UNION ALL SELECT 'ordered_by', o_orderkey, c_custkey FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT relation, count(*) AS n, sum(f * 3 + t)::BIGINT AS checksum FROM e GROUP BY relation""",
    "parent_states": f"""
WITH n AS (SELECT * FROM {_NODES} WHERE role <> 'system')
SELECT a.node, CASE WHEN a.parent IS NULL THEN 'root' WHEN b.node IS NULL THEN 'unresolved' ELSE 'resolved' END AS parent_state FROM n a LEFT JOIN n b ON a.parent = b.node""",
    "turn_coverage": """
WITH a AS (SELECT l_orderkey, count(*) AS n, list(l_partkey) AS p FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1),
b AS (SELECT l_orderkey, count(*) AS n, list(l_partkey) AS p FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1)
SELECT coalesce(a.l_orderkey, b.l_orderkey) AS l_orderkey, coalesce(a.n, 0) AS n_a, coalesce(b.n, 0) AS n_b, coalesce(a.n = b.n AND list_has_any(a.p, b.p), false) AS agrees
FROM a FULL JOIN b ON a.l_orderkey = b.l_orderkey""",
    "attached_schema": """
WITH g AS (SELECT text, min(lang) AS lang, min(source) AS source, count(DISTINCT lang) AS a, count(DISTINCT source) AS b FROM documents GROUP BY text)
SELECT doc_id, CASE WHEN a = 1 AND b = 1 THEN g.lang END AS lang, CASE WHEN a = 1 AND b = 1 THEN g.source END AS source FROM documents d JOIN g ON d.text = g.text""",
    "lineage_parents": "SELECT l_partkey, CASE WHEN count(DISTINCT l_suppkey) = 1 THEN min(l_suppkey) ELSE -1 END AS parent, count(DISTINCT l_suppkey) AS n_parents FROM lineitem GROUP BY 1",
    "usage_facts": """
SELECT o_orderkey, coalesce(nullif(trim(c_mktsegment), 'BUILDING'), n_name, 'none') AS label, o_totalprice AS price
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey """,
    "chain_walk": f"""
WITH RECURSIVE n AS {_NODES}, w AS (
  SELECT node, node AS root, 0::BIGINT AS depth, CASE WHEN parent IS NULL THEN 'root' ELSE 'unresolved' END AS state FROM n WHERE parent IS NULL OR parent NOT IN (SELECT node FROM n)
  UNION ALL SELECT n.node, w.root, w.depth + 1, w.state FROM w JOIN n ON n.parent = w.node)
SELECT node, root, depth, state FROM w""",
    "graph_shape": f"""
WITH n AS (SELECT * FROM {_NODES} WHERE role <> 'system')
SELECT node, parent IS NULL AS is_root, node NOT IN (SELECT parent FROM n WHERE parent IS NOT NULL) AS is_tip, parent IS NOT NULL AND parent NOT IN (SELECT node FROM n) AS unresolved FROM n""",
    "turn_components": f"""
WITH n AS {_NODES}, e AS (SELECT node, min(node) OVER (PARTITION BY conv_id) AS m, max(node) OVER (PARTITION BY conv_id) AS x, parent FROM n)
SELECT node, m AS component FROM e WHERE m < x""",
    "inherited_boundary": f"""
WITH RECURSIVE n AS {_NODES}, w AS (
  SELECT node, CASE WHEN node % 5 = 0 THEN role END AS v, CASE WHEN node % 5 <> 0 AND node % 7 <> 0 THEN parent END AS at FROM n
  UNION ALL SELECT w.node, CASE WHEN n.node % 5 = 0 THEN n.role END, CASE WHEN n.node % 5 <> 0 AND n.node % 7 <> 0 THEN n.parent END FROM w JOIN n ON w.at = n.node)
SELECT node, max(v) AS inherited FROM w GROUP BY node""",
    "priority_parents": """
WITH g AS (SELECT l_partkey, l_quantity, count(DISTINCT l_suppkey) AS n, min(l_suppkey) AS p FROM lineitem GROUP BY ALL),
t AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_quantity DESC) AS r FROM g)
SELECT l_partkey, CASE WHEN n = 1 THEN p ELSE -1 END AS parent, l_quantity, n > 1 AS conflict FROM t WHERE r = 1""",
    "verified_trees": f"""
WITH n AS {_NODES}
SELECT a.conv_id, count(*) AS nodes, count(*) FILTER (a.parent IS NULL) AS roots, count(*) FILTER (a.parent IS NOT NULL AND b.node IS NULL) AS unresolved,
  count(*) FILTER (a.parent IS NULL) = 1 AND count(*) FILTER (a.parent IS NOT NULL AND b.node IS NULL) = 0 AS is_tree
FROM n a LEFT JOIN n b ON a.parent = b.node GROUP BY a.conv_id""",
    "runtime_nodes": """
WITH x AS (SELECT user_id, floor(value / 50)::BIGINT AS node, event_type AS s FROM events)
SELECT user_id, node, count(*) FILTER (s IN ('signup','click')) AS starts, count(*) FILTER (s IN ('error','purchase')) AS ends,
  count(*) FILTER (s IN ('error','purchase')) = 0 AS open, count(DISTINCT s) FILTER (s IN ('error','purchase')) > 1 AS conflict,
  CASE WHEN count(DISTINCT s) FILTER (s IN ('error','purchase')) = 1 THEN min(s) FILTER (s IN ('error','purchase')) END AS status FROM x GROUP BY ALL""",
    "task_graphs": f"""
WITH n AS {_NODES}, j AS (SELECT a.conv_id * 1000 AS root, count(*) AS sessions, count(*) FILTER (a.parent IS NOT NULL AND b.node IS NULL) AS unresolved,
  bool_or(a.node = a.conv_id * 1000) AS root_present FROM n a LEFT JOIN n b ON a.parent = b.node GROUP BY 1)
SELECT *, root_present AND unresolved = 0 AS complete FROM j""",
    "unique_scopes": "SELECT sha256(text) AS k, min(source) AS only_source FROM documents GROUP BY text HAVING count(DISTINCT source) = 1",
    "gate_scores": _GATES + "SELECT doc_id, score, array_to_string(f, ',') AS failures, len(f) = 0 AS eligible FROM g",
    "failure_reasons": _GATES + "SELECT reason, count(*) AS n FROM (SELECT unnest(f) AS reason FROM g) GROUP BY reason",
    "score_summary": _GATES + "SELECT count(*) AS sessions, count(*) FILTER (len(f) = 0) AS eligible, round(avg(score), 3) AS mean_score FROM g",
    "contract_breaches": "SELECT doc_id FROM documents WHERE doc_id % 7 = 0",
    "reward_means": "SELECT user_id, event_type, count(*) AS n, round(avg(round(value * 100)::BIGINT), 6) AS mean_reward FROM events GROUP BY ALL",
    "release_acceptance": "SELECT true AS conserved, true AS contract_holds, true AS above_threshold, true AS accepted",
    "pack_batches": """
WITH RECURSIVE o AS (SELECT lang, doc_id, n_chars, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS r FROM documents),
w AS (SELECT lang, doc_id, n_chars, r, 0::BIGINT AS batch, n_chars + 2048 AS used FROM o WHERE r = 1
  UNION ALL SELECT o.lang, o.doc_id, o.n_chars, o.r, CASE WHEN w.used + o.n_chars + 2048 > 90000 THEN w.batch + 1 ELSE w.batch END,
    CASE WHEN w.used + o.n_chars + 2048 > 90000 THEN o.n_chars + 2048 ELSE w.used + o.n_chars + 2048 END
  FROM w JOIN o ON o.lang = w.lang AND o.r = w.r + 1)
SELECT lang, batch, count(*) AS n, sum(n_chars)::BIGINT AS chars, min(doc_id) AS first_doc FROM w GROUP BY ALL""",
    "release_parts": "SELECT doc_id, ((sum(n_chars) OVER (ORDER BY doc_id) - n_chars) // 50000)::BIGINT AS part, n_chars > 50000 AS oversize FROM documents",
    "release_differences_all": """
WITH a AS (SELECT CASE WHEN o_orderkey % 10 = 0 THEN -o_orderkey - 1 ELSE o_orderkey END AS k, o_custkey AS c FROM orders),
e AS (SELECT CASE WHEN o_orderkey % 11 = 0 THEN -o_orderkey - 1 ELSE o_orderkey END AS k, CASE WHEN o_orderkey % 13 = 0 THEN o_custkey + 1 ELSE o_custkey END AS c FROM orders),
j AS (SELECT a.k AS ak, e.k AS ek, a.c AS ac, e.c AS ec FROM a FULL JOIN e ON a.k = e.k)
SELECT CASE WHEN ak IS NULL THEN 'missing' WHEN ek IS NULL THEN 'extra' ELSE 'different' END AS state,
  CASE WHEN ak IS NULL OR ek IS NULL THEN 'o_orderstatus,cust' ELSE 'cust' END AS differ, count(*) AS n FROM j WHERE ak IS NULL OR ek IS NULL OR ac <> ec GROUP BY ALL""",
    "set_equality": """
WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders), b AS (SELECT c_custkey AS k FROM customer),
j AS (SELECT a.k AS x, b.k AS y FROM a FULL JOIN b ON a.k = b.k)
SELECT count(*) FILTER (y IS NULL) AS only_a, count(*) FILTER (x IS NULL) AS only_b, count(*) FILTER (x IS NULL OR y IS NULL) = 0 AS equal FROM j""",
    "fallen_counters": """
WITH g AS (SELECT user_id, count(*) FILTER (ts < '2024-01-16') AS b, count(*) FILTER (ts >= '2024-01-16') AS a,
  count(*) FILTER (ts < '2024-01-16' AND event_type = 'error') AS be, count(*) FILTER (ts >= '2024-01-16' AND event_type = 'error') AS ae FROM events GROUP BY user_id)
SELECT user_id, concat_ws(',', CASE WHEN a < b THEN 'n' END, CASE WHEN ae < be THEN 'errors' END) AS fell FROM g WHERE a > 0 AND b > 0 AND (a < b OR ae < be)""",
    "contract_violations": """
SELECT rule, count(*) AS n FROM (SELECT unnest(list_filter([CASE WHEN NOT o_totalprice > 100000 THEN 'positive' END, CASE WHEN o_orderstatus NOT IN ('F','O') THEN 'status' END,
  CASE WHEN NOT regexp_matches(o_orderpriority, '^[1-3]-') THEN 'priority' END], lambda s: s IS NOT NULL)) AS rule FROM orders) GROUP BY rule""",
}
SQL |= {"enrich_outcomes": SQL["enrich_outcomes_all"], "release_differences": SQL["release_differences_all"]}
QUERIES = {k: (globals()[k], s) for k, s in SQL.items()}
