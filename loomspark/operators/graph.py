"""Graphs as tables: walks, components, ancestry and trees.

Walks double their stride every round (pointer jumping), so a chain of n
nodes takes about log2(n) joins, each on keyed rows only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .checkpoint import cut, written
from .joins import known_as


def walk(nodes: DataFrame, node: str, parent: str) -> DataFrame:
    """(node, root, depth, state): root reached, unresolved (a parent is missing) or cycle.

    ``root`` is the last node that the walk reached, ``depth`` its distance;
    both null in or behind a cycle.
    """
    x = nodes.select(F.col(node).alias("node"), F.col(parent).alias("up"))
    known = x.select(F.col("node").alias("k")).distinct()
    x = x.join(known, known_as(x["up"], known["k"], x["node"]), "left")
    # at: where the walk stands; open: whether it may go on from there
    x = x.select("node", F.coalesce("k", "node").alias("at"), F.when(F.col("k").isNotNull(), 1).otherwise(0).cast("long").alias("depth"), (F.col("up").isNotNull() & F.col("k").isNull()).alias("lost"))
    total, k = None, 0
    while True:
        step = x.select(F.col("node").alias("n2"), F.col("at").alias("at2"), F.col("depth").alias("d2"), F.col("lost").alias("l2"))
        x = x.join(step, x["at"] == step["n2"]).select("node", F.col("at2").alias("at"), (F.col("depth") + F.col("d2")).alias("depth"), (F.col("lost") | F.col("l2")).alias("lost"))
        x = cut(x)
        now = x.agg(F.sum("depth"), F.count("*")).first()
        if now[0] == total or now[0] is None or (1 << k) > now[1]:
            break  # nothing moved, or only cycles still do
        total, k = now[0], k + 1
    # a walk that stands on a node which itself moves on is in a cycle
    stops = x.where("node = at and depth = 0").select(F.col("node").alias("stop"))
    y = x.join(stops, x["at"] == stops["stop"], "left")
    state = F.when(F.col("stop").isNull(), "cycle").when(F.col("lost"), "unresolved").otherwise("root")
    ok = F.col("stop").isNotNull()
    return y.select("node", F.when(ok, F.col("at")).alias("root"), F.when(ok, F.col("depth")).alias("depth"), state.alias("state"))


def shape(nodes: DataFrame, node: str, parent: str) -> DataFrame:
    """G1: each node as root, tip, inner or both, with whether its parent is known."""
    used = nodes.where(F.col(parent).isNotNull()).select(F.col(parent).alias("_u")).distinct()
    known = nodes.select(F.col(node).alias("_k")).distinct()
    x = nodes.join(used, nodes[node] == used["_u"], "left").join(known, known_as(nodes[parent], known["_k"], nodes[node]), "left")
    return x.select(
        node, parent,
        F.col(parent).isNull().alias("is_root"), F.col("_u").isNull().alias("is_tip"),
        (F.col(parent).isNotNull() & F.col("_k").isNull()).alias("unresolved"),
    )


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component), the least node reachable, by label propagation with pointer jumping."""
    e = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).alias("x"), F.col(b).alias("y"))
    e = cut(e.union(e.select("y", "x")).distinct())
    label = e.groupBy("x").agg(F.min("y").alias("m")).select(F.col("x").alias("node"), F.least("x", "m").alias("c"))
    label = cut(label)
    total = None
    while True:  # labels only fall, so a fixed point comes
        # the least label among neighbours, then the label of one's label
        near = e.join(label.select(F.col("node").alias("y"), "c"), "y").groupBy("x").agg(F.min("c").alias("m"))
        x = label.join(near, label["node"] == near["x"]).select("node", F.least("c", "m").alias("c"))
        up = x.select(F.col("node").alias("n2"), F.col("c").alias("c2"))
        label = cut(x.join(up, x["c"] == up["n2"]).select("node", F.least("c", "c2").alias("c")))
        now = label.agg(F.bit_xor(F.xxhash64("node", "c"))).first()[0]
        if now == total:
            return label.select("node", F.col("c").alias("component"))
        total = now


def nearest_boundary(nodes: DataFrame, node: str, parent: str, value: str, boundary: str) -> DataFrame:
    """(node, inherited, cycle): the nearest ancestor's (or own) value; the walk stops at a boundary, whatever it holds.

    Doubling: each node keeps a pointer, the value found below it, and whether
    it may go on. A walk that is still open when its stride exceeds the number
    of nodes is in or behind a cycle without values: no value, ``cycle`` true.
    """
    x = nodes.select(F.col(node).alias("node"), F.col(value).alias("v"), F.when(F.col(value).isNull() & ~F.coalesce(boundary, F.lit(False)), F.col(parent)).alias("at"))
    n, stride = x.count(), 1
    while stride <= n:
        step = x.select(F.col("node").alias("n2"), F.col("v").alias("v2"), F.col("at").alias("at2"))
        x = cut(x.join(step, known_as(x["at"], step["n2"], x["node"]), "left").select("node", F.coalesce("v", "v2").alias("v"), F.when(F.coalesce("v", "v2").isNull(), F.col("at2")).alias("at")))
        stride *= 2
        if x.where("at is not null").isEmpty():
            break
    return x.select("node", F.col("v").alias("inherited"), F.col("at").isNotNull().alias("cycle"))


def inherited_values(nodes: DataFrame, node: str, parent: str, value: str, boundary: str) -> DataFrame:
    """G4 with contradictions: node, inherited, contradiction, explicit_conflict, cycle.

    A node may have several rows: parents, values and boundaries of all of
    them count. A node without a value or boundary takes the values of the
    nearest ancestors that have one on every path; behind a boundary without
    a value there is none. Two values that differ, of a node's own or by two
    paths, are a contradiction and none is taken. ``explicit_conflict``: a
    node without a boundary has a value, and its parents lead to another.

    Pointer doubling over a lattice: what is known of a node is the least and
    the greatest value found so far, and the ancestors where its walks stand;
    joining two such is taking minima, maxima and the union. Walks that are
    still open when the stride exceeds the number of nodes are in, or behind,
    a cycle. Parents that aren't nodes end a walk; null nodes are passed over.
    A node holds all ancestors at which its open walks stand: few where values
    or boundaries are near, many under several parents without any.
    """
    x = nodes.where(F.col(node).isNotNull()).select(F.col(node).alias("node"), F.col(parent).alias("parent"), F.col(value).alias("v"), F.coalesce(boundary, F.lit(False)).alias("b"))
    own = written(x.groupBy("node").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.bool_or("b").alias("b")), "ancestry")
    up = written(x.where("parent is not null").select("node", F.col("parent").alias("at")).distinct(), "ancestry-parents")
    walks = up.join(own.where("lo is null and not b").select("node"), "node", "left_semi")
    known, n, stride = own.select("node", "lo", "hi"), own.count(), 1
    while stride <= n and not walks.isEmpty():
        there = walks.join(known.withColumnRenamed("node", "at"), "at").groupBy("node").agg(F.min("lo").alias("lo2"), F.max("hi").alias("hi2"))
        more = walks.join(walks.select(F.col("node").alias("at"), F.col("at").alias("to")), "at").select("node", F.col("to").alias("at")).distinct()
        known = written(known.join(there, "node", "left").select("node", F.least("lo", "lo2").alias("lo"), F.greatest("hi", "hi2").alias("hi")), "ancestry")
        walks = written(more, "ancestry-walks")
        stride *= 2
    cyclic = walks.select("node").distinct().withColumn("cycle", F.lit(True))
    above = up.join(known.withColumnRenamed("node", "at"), "at").groupBy("node").agg(F.min("lo").alias("plo"), F.max("hi").alias("phi"))
    mine = own.select("node", F.col("lo").alias("mine"), "b")
    x = known.join(cyclic, "node", "left").join(above, "node", "left").join(mine, "node")
    against = ~F.col("b") & F.col("mine").isNotNull() & ((F.col("plo") != F.col("mine")) | (F.col("phi") != F.col("mine")))
    return x.select("node", F.when(F.col("lo") == F.col("hi"), F.col("lo")).alias("inherited"), F.coalesce(F.col("lo") != F.col("hi"), F.lit(False)).alias("contradiction"), F.coalesce(against, F.lit(False)).alias("explicit_conflict"), F.coalesce("cycle", F.lit(False)).alias("cycle"))


def single_tree(edges: DataFrame, child: str, parent: str, priority: str) -> DataFrame:
    """Child to the parent of highest priority; equal priorities with different parents are a conflict.

    Two aggregates of fixed size: the least and greatest parent by child and priority, then those of the child's highest priority; null priorities are the lowest.
    """
    g = edges.groupBy(child, priority).agg(F.min(parent).alias("_lo"), F.max(parent).alias("_hi"))
    top = lambda c: F.when(F.max(priority).isNull(), F.min(c)).otherwise(F.max_by(c, priority)).alias(c)
    x = g.groupBy(child).agg(top("_lo"), top("_hi"), F.max(priority).alias(priority))
    return x.select(child, F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).alias("parent"), priority, F.coalesce(F.col("_lo") != F.col("_hi"), F.lit(False)).alias("conflict"))


def verify_tree(tree: DataFrame, trace: str, node: str, parent: str) -> DataFrame:
    """V4: per trace: nodes, roots, unresolved parents, and whether it is one tree."""
    known = tree.select(F.col(trace).alias("_t"), F.col(node).alias("_k")).distinct()
    x = tree.join(known, (tree[trace] == known["_t"]) & known_as(tree[parent], known["_k"], tree[node]), "left")
    g = x.groupBy(trace).agg(F.count("*").alias("nodes"), F.count_if(F.col(parent).isNull()).alias("roots"), F.count_if(F.col(parent).isNotNull() & F.col("_k").isNull()).alias("unresolved"))
    return g.withColumn("is_tree", (F.col("roots") == 1) & (F.col("unresolved") == 0))


def runtime_nodes(events: DataFrame, group: str, node: str, kind: str, status: str) -> DataFrame:
    """Start and end events to nodes: open without an end, conflicting where end statuses differ."""
    g = events.groupBy(group, node).agg(
        F.count_if(F.col(kind) == "start").alias("starts"), F.count_if(F.col(kind) == "terminal").alias("ends"),
        F.count_distinct(F.when(F.col(kind) == "terminal", F.col(status))).alias("statuses"), F.min(F.when(F.col(kind) == "terminal", F.col(status))).alias("status"),
    )
    return g.select(group, node, "starts", "ends", (F.col("ends") == 0).alias("open"), (F.col("statuses") > 1).alias("conflict"), F.when(F.col("statuses") == 1, F.col("status")).alias("status"))


def task_graph(sessions: DataFrame, root: str, session: str, parent: str) -> DataFrame:
    """Per root: sessions, unresolved parents, and whether the root itself is there."""
    known = sessions.select(F.col(session).alias("_k")).distinct()
    x = sessions.join(known, known_as(sessions[parent], known["_k"], sessions[session]), "left")
    g = x.groupBy(root).agg(F.count("*").alias("sessions"), F.count_if(F.col(parent).isNotNull() & F.col("_k").isNull()).alias("unresolved"), F.max(F.col(session) == F.col(root)).alias("root_present"))
    return g.withColumn("complete", F.col("root_present") & (F.col("unresolved") == 0))


def runtime_scopes(rows: DataFrame, captures: DataFrame, calls: DataFrame, key: str) -> DataFrame:
    """(key, scope_kind, scope): what a record belongs to, by the first rule that gives an answer.

    Rows (namespace, task_session_id, root_turn_id, session_id, turn_id,
    thread_id, parent_thread_id, call_id, is_lifecycle) are of a task; of
    their root turn; of a session, if they are its lifecycle; of the only
    root turn of their session and call; of the only one of their thread; if
    they have a parent thread, of its only root turn or of none; of their own
    turn. ``captures`` (namespace, thread_id, root_turn_id) and ``calls``
    (session_id, call_id, root_turn_id) tell the root turns; where there are several, the rule gives none.
    """
    def only(df: DataFrame, keys: list[str], out: str) -> DataFrame:
        filled = df.where(F.coalesce(F.trim("root_turn_id") != "", F.lit(False)))
        g = filled.groupBy(*keys).agg(F.min("root_turn_id").alias("_lo"), F.max("root_turn_id").alias("_hi"))
        return g.where("_lo = _hi").select(*[F.col(k).alias(f"_{out}_{k}") for k in keys], F.col("_lo").alias(out))

    blank = lambda c: F.when(F.trim(c) != "", F.col(c))
    x = rows.withColumns({c: blank(c) for c in ("task_session_id", "root_turn_id", "session_id", "turn_id", "thread_id", "parent_thread_id", "call_id")})
    by_call, by_thread, by_parent = only(calls, ["session_id", "call_id"], "of_call"), only(captures, ["namespace", "thread_id"], "of_thread"), only(captures, ["namespace", "thread_id"], "of_parent")
    is_of = lambda c, out: known_as(F.col(c), F.col(out), F.col(key).cast("string"))
    x = x.join(by_call, (F.col("session_id") == F.col("_of_call_session_id")) & is_of("call_id", "_of_call_call_id"), "left")
    x = x.join(by_thread, F.col("namespace").eqNullSafe(F.col("_of_thread_namespace")) & is_of("thread_id", "_of_thread_thread_id"), "left")
    x = x.join(by_parent, F.col("namespace").eqNullSafe(F.col("_of_parent_namespace")) & is_of("parent_thread_id", "_of_parent_thread_id"), "left")
    scope = lambda kind, c: F.struct(F.lit(kind).alias("kind"), F.col(c).alias("scope"))
    nothing = F.lit(None).cast("struct<kind:string,scope:string>")
    found = (
        F.when(F.col("task_session_id").isNotNull(), scope("task", "task_session_id"))
        .when(F.col("root_turn_id").isNotNull(), scope("turn", "root_turn_id"))
        .when(F.coalesce("is_lifecycle", F.lit(False)) & F.col("session_id").isNotNull(), scope("session", "session_id"))
        .when(F.col("of_call").isNotNull(), scope("turn", "of_call"))
        .when(F.col("of_thread").isNotNull(), scope("turn", "of_thread"))
        .when(F.col("of_parent").isNotNull(), scope("turn", "of_parent"))
        .when(F.col("parent_thread_id").isNotNull(), nothing)
        .when(F.col("turn_id").isNotNull(), scope("turn", "turn_id"))
    )
    return x.select(key, found.alias("s")).select(key, F.col("s.kind").alias("scope_kind"), F.col("s.scope").alias("scope"))


def unique_scope(rows: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """The value where a key has exactly one."""
    return rows.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi")).where("_lo = _hi").select(*keys, F.col("_lo").alias(out))
