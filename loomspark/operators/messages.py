"""A3: copies of a message from several snapshots, merged as rows.

A message's JSON is shredded level by level: each value is a row of message,
copy and path. At every path the copy to keep is found by grouped minima over
snapshot order, and what disagrees with it is counted; only below values that
are kept do the copies go on to the next level. The kept rows are then put
together from the deepest level up. A level is a few shuffles, whatever the
number of copies, and no message's copies meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.values import whole_json
from .checkpoint import written

#: Where a message's text is, in this order; how recorded sources begin; a status that says nothing.
TEXT_FIELDS, RECORDED, UNKNOWN = ["text", "content", "output_text", "input_text"], "codex_rollout.", "unknown"


def as_variant(text: Column) -> Column:
    """JSON, or what isn't JSON as a string; null is JSON's null."""
    return F.coalesce(whole_json(text), text.cast("variant"), F.parse_json(F.lit("null")))


def is_kind(v: Column, kind: str) -> Column:
    return F.schema_of_variant(v).startswith(kind)


def text_of(v: Column, deep: int = 2) -> Column:
    """The strings of a content value, joined by line feeds; those nested in more than ``deep`` lists or objects count as JSON."""
    if deep == 0:
        return F.when(is_kind(v, "STRING"), v.cast("string")).otherwise(F.to_json(v))
    inner = F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda x: text_of(x, deep - 1))
    fields = F.concat_ws("\n", *[text_of(F.try_variant_get(v, f"$.{f}", "variant"), deep - 1) for f in TEXT_FIELDS])
    return F.when(v.isNull(), None).when(is_kind(v, "STRING"), v.cast("string")).when(is_kind(v, "ARRAY"), F.concat_ws("\n", inner)).when(is_kind(v, "OBJECT"), fields)


def identity_of(v: Column) -> Column:
    """The identity of a message (VARIANT): its call, its ids, or the hash of all of it.

    All system messages are one; a result goes by its call; an answer whose
    calls all have ids goes by these; then id, message_id, and the content.
    """
    at = lambda path: F.when(is_kind(F.try_variant_get(v, path, "variant"), "STRING"), F.try_variant_get(v, path, "string"))
    role = F.coalesce(at("$.role"), F.lit("unknown"))
    calls = F.try_variant_get(v, "$.tool_calls", "array<variant>")
    ids = F.array_compact(F.transform(calls, lambda c: F.when(is_kind(F.try_variant_get(c, "$.id", "variant"), "STRING"), F.try_variant_get(c, "$.id", "string"))))
    by_calls = F.when((role == "assistant") & (F.size(calls) > 0) & (F.size(ids) == F.size(calls)), F.concat(F.lit("tool-call:"), F.array_join(F.array_sort(ids), "\0")))
    by_id = F.concat(F.lit("message:"), F.coalesce(at("$.id"), at("$.message_id")))
    whole = F.concat(F.lit("content:"), F.sha2(F.to_json(v), 256))
    return F.when(role == "system", "role:system").otherwise(F.coalesce(F.when(role == "tool", F.concat(F.lit("tool-result:"), at("$.tool_call_id"))), by_calls, by_id, whole))


def _judged(x: DataFrame) -> DataFrame:
    """Values (m, copy, path, name, field, v) with kind, what they are compared by (same) and strength: 0 for empty ones, 1 for an unknown status, 2 for others."""
    v, kind = F.col("v"), F.schema_of_variant("v")
    x = x.withColumn("kind", F.when(kind.startswith("OBJECT"), "object").when(kind.startswith("ARRAY"), F.concat(F.lit("array "), F.size(F.try_variant_get(v, "$", "array<variant>")).cast("string"))).when(kind.startswith("STRING"), "string").otherwise("other"))
    held = F.col("kind").startswith("array") | (F.col("kind") == "object")
    x = x.withColumn("json", F.when(~held, F.to_json(v)))
    text = F.when(F.col("kind") == "string", v.cast("string"))
    # two texts of arguments are alike if they are equal as JSON, or one is the other as its only field ``input``
    parsed = whole_json(text)
    only = F.when(F.size(F.json_object_keys(text)) == 1, F.try_variant_get(parsed, "$.input", "variant"))
    wrapped = F.when(is_kind(only, "STRING"), only.cast("string"))
    raw = F.coalesce(wrapped, text)
    arguments = F.coalesce(F.concat(F.lit("json "), F.to_json(whole_json(raw))), F.concat(F.lit("text "), raw))
    field = F.col("field")
    special = F.when(field == "content", F.concat(F.lit("content "), F.coalesce(text_of(v), F.lit("")))).when((field == "source") & text.startswith(RECORDED), RECORDED).when((field == "arguments") & text.isNotNull(), arguments)
    empty = F.col("json").isin("null", '""') | (F.col("kind") == "array 0") | (held & (F.to_json(v) == "{}"))
    return x.withColumns({
        "same": F.coalesce(special, F.col("json"), F.col("kind")),
        "strength": F.when(empty, 0).when((field == "status") & (text == UNKNOWN), 1).otherwise(2),
        "preferred": F.coalesce((field == "arguments") & wrapped.isNotNull(), F.lit(False)),
        "held": held,
    })


def _kept(x: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Judged values to the one kept at each path, and to all with ``conflict`` and ``goes_on`` (its inside is merged too)."""
    first = lambda least: F.min(F.when(F.col("strength") >= least, F.struct("copy", "same", "strength", "kind")))
    firsts = x.groupBy("m", "path").agg(first(0).alias("f0"), first(1).alias("f1"), first(2).alias("f2"))
    x = x.join(firsts, ["m", "path"])
    before = F.coalesce(*[F.when(F.col(f"{f}.copy") < F.col("copy"), F.col(f)) for f in ("f2", "f1", "f0")])
    x = x.withColumn("was", before)
    alike = F.col("was.same") == F.col("same")
    filled = ((F.col("was.strength") == 0) & (F.col("strength") > 0)) | ((F.col("was.strength") == 1) & (F.col("strength") == 2) & (F.col("kind") == "string"))
    merged = F.col("held") & (F.col("was.kind") == F.col("kind"))
    x = x.withColumns({"conflict": F.coalesce(~alike & ~filled & ~merged, F.lit(False)), "skipped": F.coalesce(alike & (F.col("field") == "content"), F.lit(False))})
    # the strongest first one stays; of arguments alike to it, the first that wraps them
    best = F.coalesce("f2", "f1", "f0")
    wraps = F.col("preferred") & (F.col("same") == best["same"])
    fits = F.when(wraps, F.struct(F.lit(0).alias("turn"), "copy")).when(F.col("copy") == best["copy"], F.struct(F.lit(1).alias("turn"), "copy"))
    kept = x.groupBy("m", "path").agg(*[F.min_by(c, fits).alias(c) for c in ("parent", "name", "field", "kind", "held", "json", "copy")])
    x = x.withColumn("goes_on", F.col("held") & (F.col("kind") == best["kind"]) & ~F.col("skipped"))
    return kept, x


def _inside(x: DataFrame) -> DataFrame:
    """The values of the fields and items of kept values that go on."""
    v = F.col("v")
    fields = F.when(F.col("kind") == "object", F.map_entries(F.try_variant_get(v, "$", "map<string,variant>")))
    items = F.when(F.col("kind") != "object", F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda e, i: F.struct(F.lpad(i.cast("string"), 9, "0").alias("key"), e.alias("value"))))
    x = x.where("goes_on").select("m", "copy", F.col("path").alias("parent"), "field", "kind", F.explode(F.coalesce(fields, items)).alias("e"))
    step = F.replace(F.replace(F.col("e.key"), F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1"))
    return x.select("m", "copy", "parent", F.concat("parent", F.lit("/"), step).alias("path"), F.col("e.key").alias("name"), F.when(F.col("kind") == "object", F.col("e.key")).otherwise(F.col("field")).alias("field"), F.coalesce("e.value", F.parse_json(F.lit("null"))).alias("v"))


def merge_messages(rows: DataFrame, group: str, snapshot: str, position: str, identity: str, content: str) -> DataFrame:
    """A3: the k-th occurrence of an identity in any snapshot is one message, merged field by field in snapshot order.

    ``content`` is JSON; text that isn't is a string, null is JSON's null.
    One row a message: group, identity, occurrence, the snapshot and position
    where it is first seen (the order of the merged list), content, and
    divergences: later copies that conflict. At every path the first value
    that isn't empty stays, and the first known status. Objects are merged by
    fields, lists of one length by items. Contents are alike if their texts
    are, arguments if they mean the same (the wrapped form stays), recorded
    sources always; a copy of alike content adds nothing to it. Content that
    nothing was merged into keeps its bytes; other content has sorted keys.
    No rows give no messages.
    """
    n = F.row_number().over(W.partitionBy(group, snapshot, identity).orderBy(position))
    x = rows.select(group, identity, snapshot, position, content).withColumn("_occurrence", n.cast("long"))
    x = written(x.withColumn("_uid", F.monotonically_increasing_id()), "message-copies")
    names = [group, identity, "_occurrence"]
    order = F.struct(snapshot, position, "_uid")
    copies = W.partitionBy(*names).orderBy(order)
    x = written(x.withColumns({"_copy": F.row_number().over(copies), "_m": F.first("_uid").over(copies)}), "message-order")
    firsts = x.where("_copy = 1").select("_m", *names, snapshot, position, content)
    level = x.select("_m", "_copy", F.col(content).alias("_text"))
    # most messages have one copy, or equal ones: nothing to merge
    apart = level.groupBy("_m").agg((F.min(F.coalesce("_text", F.lit(""))) != F.max(F.coalesce("_text", F.lit("")))).alias("_d"), F.count_if(F.col("_text").isNull()).alias("_nulls"), F.count("*").alias("_n"))
    apart = apart.where("_d or (_nulls > 0 and _nulls < _n)").select("_m")
    root = F.lit("")
    level = level.join(apart, "_m", "left_semi").select(F.col("_m").alias("m"), F.col("_copy").alias("copy"), F.lit(None).cast("string").alias("parent"), root.alias("path"), root.alias("name"), root.alias("field"), as_variant(F.col("_text")).alias("v"))
    levels, conflicts = [], None
    while True:
        judged = written(_judged(level), "message-level")
        if judged.isEmpty():
            break
        kept, x = _kept(judged)
        x = written(x, "message-judged")
        levels.append(written(kept, "message-kept"))
        bad = x.where("conflict").select("m", "copy")
        conflicts = bad if conflicts is None else conflicts.union(bad)
        level = _inside(x)
    # from the deepest level up: a value's inside is what was kept there
    below = None
    for kept in reversed(levels):
        if below is not None:
            of = below.groupBy(F.col("m").alias("_pm"), F.col("parent").alias("_pp")).agg(F.array_sort(F.collect_list(F.struct("name", "json"))).alias("_in"), F.max("copy").alias("_latest"))
            kept = kept.join(of, (F.col("m") == F.col("_pm")) & (F.col("path") == F.col("_pp")), "left")
            quoted = lambda e: F.concat(F.to_json(e["name"].cast("variant")), F.lit(":"), e["json"])
            inside = F.when(F.col("kind") == "object", F.concat(F.lit("{"), F.array_join(F.transform("_in", quoted), ","), F.lit("}"))).otherwise(F.concat(F.lit("["), F.array_join("_in.json", ","), F.lit("]")))
            json = F.when(F.col("held"), F.coalesce(inside, F.when(F.col("kind") == "object", "{}").otherwise("[]"))).otherwise(F.col("json"))
            kept = kept.withColumns({"json": json, "copy": F.greatest("copy", "_latest")})
        else:
            kept = kept.withColumn("json", F.coalesce("json", F.when(F.col("kind") == "object", "{}").otherwise("[]")))
        below = kept.select("m", "parent", "name", "json", "copy")
    out = firsts.withColumn("_content", F.col(content)).withColumn("divergences", F.lit(0).cast("long"))
    if below is not None:
        whole = below.select(F.col("m").alias("_m"), "json", "copy", F.lit(True).alias("_merged"))
        counted = conflicts.distinct().groupBy(F.col("m").alias("_m")).agg(F.count("*").alias("_bad"))
        out = firsts.join(whole, "_m", "left").join(counted, "_m", "left")
        bare = F.coalesce(F.try_variant_get(F.try_parse_json("json"), "$", "string"), F.col("json"))
        text = F.when(is_kind(F.parse_json("json"), "STRING"), bare).otherwise(F.col("json"))
        out = out.withColumns({"_content": F.when(F.coalesce(F.col("copy") > 1, F.lit(False)), text).otherwise(F.col(content)), "divergences": F.coalesce("_bad", F.lit(0).cast("long"))})
    return out.select(group, identity, F.col("_occurrence").alias("occurrence"), snapshot, position, F.col("_content").alias(content), "divergences")
