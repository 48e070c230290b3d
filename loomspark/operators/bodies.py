"""Request and response bodies (JSON) to messages and tool definitions, as rows.

Items and their blocks are exploded with their positions; a message is what
its blocks between two tool results add up to. Namespaces of tool definitions
are opened level by level until none is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .checkpoint import cut
from .session_metrics import _get, _is_kind, _is_text, content_text

# --- fixed values: kinds of items, fields of prompts and of nested definitions ---
CALLS, CUSTOM_CALL = ["function_call", "custom_tool_call", "tool_use"], "custom_tool_call"
OUTPUTS = ["function_call_output", "custom_tool_call_output", "tool_result"]
PROMPT_ROLES, ROLES = ["developer", "system"], ["system", "user", "assistant", "tool"]
PROMPT_FIELDS, CHILD_FIELDS, SCHEMA_FIELDS = ["instructions", "system"], ["tools", "additional_tools", "definitions"], ["parameters", "input_schema", "format"]
DEFAULT_NAMESPACE, NESTED_TOOLS = "functions", "additional_tools"
# ---------------------------------------------------------------------------------
CALL = "struct<id:string,name:string,arguments:string>"


def _plain(v: Column) -> Column:
    """A string as it is, anything else as JSON; null for null and what is missing."""
    return F.when(v.isNull() | F.is_variant_null(v), None).when(_is_text(v), F.try_variant_get(v, "$", "string")).otherwise(F.to_json(v))


def _named(v: Column) -> Column:
    """A call's name behind its namespace, but for the default one."""
    space = F.coalesce(F.trim(_get(v, "$.namespace", "string")), F.lit(""))
    name = _get(v, "$.name", "string")
    return F.when(space.isin("", DEFAULT_NAMESPACE), name).otherwise(F.concat(space, F.lit("."), name))


def _call(v: Column, kind: Column) -> Column:
    """(id, name, arguments) of a call; a custom call's input is wrapped in an object."""
    given, own = F.coalesce(_get(v, "$.arguments"), _get(v, "$.input")), F.coalesce(_get(v, "$.input"), _get(v, "$.arguments"))
    wrapped = F.concat(F.lit('{"input":'), F.coalesce(F.to_json(own), F.lit("null")), F.lit("}"))
    arguments = F.when(kind == CUSTOM_CALL, wrapped).otherwise(F.coalesce(_plain(given), F.lit("{}")))
    return F.struct(F.coalesce(_get(v, "$.call_id", "string"), _get(v, "$.id", "string")).alias("id"), _named(v).alias("name"), arguments.alias("arguments"))


def _function_calls(v: Column) -> Column:
    """Calls listed by a message, each of which may hold its function apart."""
    def one(c: Column) -> Column:
        f = F.coalesce(_get(c, "$.function"), c)
        return F.struct(F.coalesce(_get(c, "$.id", "string"), _get(c, "$.call_id", "string")).alias("id"), _named(f).alias("name"), _plain(_get(f, "$.arguments")).alias("arguments"))

    return F.coalesce(F.transform(_get(v, "$.tool_calls", "array<variant>"), one), F.array().cast(f"array<{CALL}>"))


def _blocks(items: DataFrame) -> DataFrame:
    """(key, at, item) to blocks in order: key, at, b, kind (text, calls or result), role, text, calls, call_id, is_error, status."""
    kind, role = F.coalesce(_get("item", "$.type", "string"), F.lit("")), F.coalesce(_get("item", "$.role", "string"), F.when(_get("item", "$.type", "string") == "message", "user"), F.lit(""))
    content = _get("item", "$.content")
    x = items.withColumns({"kind": kind, "role": role, "content": content})
    none, no_calls = F.lit(None), F.array().cast(f"array<{CALL}>")
    flag = lambda v: F.when(_is_kind(_get(v, "$.is_error"), "BOOLEAN"), _get(v, "$.is_error", "boolean"))
    block = lambda k, text=none, calls=no_calls, call_id=none, error=none, status=none: F.struct(F.lit(k).alias("kind"), text.cast("string").alias("text"), calls.cast(f"array<{CALL}>").alias("calls"), call_id.cast("string").alias("call_id"), error.cast("boolean").alias("is_error"), status.cast("string").alias("status"))
    item = F.col("item")
    output = F.coalesce(_get("item", "$.output"), content)
    result_id = F.coalesce(*[_get("item", f"$.{k}", "string") for k in ("call_id", "tool_use_id", "tool_call_id")])

    def of_block(v: Column) -> Column:
        k = F.coalesce(_get(v, "$.type", "string"), F.lit(""))
        error = flag(v)
        return F.when(k == "tool_use", block("calls", calls=F.array(F.struct(_get(v, "$.id", "string").alias("id"), _named(v).alias("name"), F.coalesce(_plain(_get(v, "$.input")), F.lit("null")).alias("arguments"))))).when(
            k == "tool_result", block("result", _plain(_get(v, "$.content")), call_id=_get(v, "$.tool_use_id", "string"), error=error, status=F.when(error, "error").when(~error, "success"))
        ).otherwise(block("text", content_text(v)))

    listed = F.transform(F.try_variant_get(content, "$", "array<variant>"), of_block)
    whole = block("whole", _plain(content), _function_calls(item), _get("item", "$.tool_call_id", "string"), flag("item"), _get("item", "$.status", "string"))
    found = (
        F.when(F.col("kind").isin(CALLS), F.array(block("whole", F.lit(""), F.array(_call(item, F.col("kind"))))))
        .when(F.col("kind").isin(OUTPUTS), F.array(block("result", _plain(output), call_id=result_id, error=flag("item"), status=_get("item", "$.status", "string"))))
        .when(~F.col("role").isin(ROLES), F.array().cast("array<struct<kind:string,text:string,calls:array<struct<id:string,name:string,arguments:string>>,call_id:string,is_error:boolean,status:string>>"))
        .when(_is_kind(content, "ARRAY"), listed)
        .otherwise(F.array(whole))
    )
    role = F.when(F.col("kind").isin(CALLS), "assistant").otherwise(F.col("role"))
    return x.select("key", "at", role.alias("role"), F.posexplode(found).alias("b", "x")).select("key", "at", "role", "b", "x.*")


def _joined(blocks: DataFrame) -> DataFrame:
    """Blocks to messages: key, at, part, role, content, tool_calls, tool_call_id, status, is_error."""
    alone = F.col("kind").isin("result", "whole")
    w = W.partitionBy("key", "at").orderBy("b")
    x = blocks.withColumn("_alone", alone)
    x = x.withColumn("_new", (F.col("_alone") | F.coalesce(F.lag("_alone").over(w), F.lit(False))).cast("int")).withColumn("part", F.sum("_new").over(w))
    text = F.when((F.col("kind") == "text") & (F.col("text") != ""), F.struct("b", "text"))
    g = x.groupBy("key", "at", "part").agg(
        F.min("role").alias("role"), F.bool_or("_alone").alias("alone"), F.bool_or(F.col("kind") == "result").alias("result"), F.min(F.when(F.col("_alone"), F.col("text"))).alias("whole"),
        F.sort_array(F.collect_list(text)).alias("texts"), F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("b", "calls"))), lambda s: s["calls"])).alias("tool_calls"),
        F.min("call_id").alias("tool_call_id"), F.min("status").alias("status"), F.min("is_error").alias("is_error"),
    )
    g = g.where("alone or size(texts) > 0 or size(tool_calls) > 0")
    content = F.when(F.col("alone"), F.coalesce("whole", F.lit(""))).otherwise(F.array_join(F.transform("texts", lambda t: t["text"]), "\n"))
    return g.select("key", "at", "part", F.when(F.col("result"), "tool").otherwise(F.col("role")).alias("role"), content.alias("content"), "tool_calls", "tool_call_id", "status", "is_error")


def request_messages(rows: DataFrame, key: str, body: str, anthropic: Column | None = None) -> DataFrame:
    """key, position (from 0), role, content, tool_calls, tool_call_id, status, is_error of every message of request bodies.

    Prompts come from ``instructions``, ``system`` and developer or system
    items, in this order, blank and repeated ones left out, and make the
    first message. Other items follow: a string is one user message. Bodies
    that aren't JSON have none. Keys are distinct.
    """
    v = F.try_parse_json(body)
    x = rows.select(F.col(key).alias("key"), v.alias("v"), F.coalesce(anthropic if anthropic is not None else F.lit(False), F.lit(False)).alias("_a"))
    given = F.when(F.col("_a"), _get("v", "$.messages")).otherwise(F.coalesce(_get("v", "$.input"), _get("v", "$.messages")))
    x = x.withColumn("given", given)
    fields = x.select("key", F.posexplode(F.array(*[F.trim(content_text(_get("v", f"$.{f}"))) for f in PROMPT_FIELDS])).alias("i", "prompt")).withColumn("i", F.col("i") - len(PROMPT_FIELDS))
    items = x.where(_is_kind(F.col("given"), "ARRAY")).select("key", F.posexplode(F.try_variant_get("given", "$", "array<variant>")).alias("at", "item"))
    is_prompt = F.coalesce(_get("item", "$.role", "string").isin(PROMPT_ROLES), F.lit(False)) & (F.coalesce(_get("item", "$.type", "string"), F.lit("message")) == "message")
    prompts = fields.union(items.where(is_prompt).select("key", "at", F.trim(content_text(_get("item", "$.content"))))).where("prompt != ''")
    prompts = prompts.groupBy("key", "prompt").agg(F.min("i").alias("i")).groupBy("key").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("i", "prompt"))), lambda p: p["prompt"]), "\n\n").alias("content"))
    said = _joined(_blocks(items.where(~is_prompt & (F.coalesce(_get("item", "$.type", "string"), F.lit("")) != NESTED_TOOLS))))
    none = lambda t: F.lit(None).cast(t)
    one = lambda df, role, at: df.select("key", F.lit(at).alias("at"), F.lit(0).cast("long").alias("part"), F.lit(role).alias("role"), "content", F.array().cast(f"array<{CALL}>").alias("tool_calls"), none("string").alias("tool_call_id"), none("string").alias("status"), none("boolean").alias("is_error"))
    text = x.where(_is_text(F.col("given"))).select("key", F.try_variant_get("given", "$", "string").alias("content"))
    every = one(prompts, "system", -1).unionByName(one(text, "user", 0)).unionByName(said)
    return _positioned(every, key)


def response_messages(rows: DataFrame, key: str, body: str) -> DataFrame:
    """The same columns for response bodies: a first choice's message, an Anthropic content, or the calls and messages among the output items."""
    x = rows.select(F.col(key).alias("key"), F.try_parse_json(body).alias("v"))
    choice = F.coalesce(_get("v", "$.choices[0].message"), _get("v", "$.choices[0].delta"))
    content = F.when(choice.isNull() & _get("v", "$.output").isNull() & _get("v", "$.content").isNotNull(), F.col("v"))
    items = x.select("key", F.posexplode(F.array_compact(F.array(choice, F.when(_get("v", "$.role").isNotNull(), content)))).alias("at", "item"))
    bare = x.where(choice.isNull() & _get("v", "$.role").isNull() & _get("v", "$.output").isNull() & _get("v", "$.content").isNotNull())
    items = items.unionByName(bare.select("key", F.lit(0).alias("at"), F.parse_json(F.concat(F.lit('{"role":"assistant","content":'), F.to_json(_get("v", "$.content")), F.lit("}"))).alias("item")))
    listed = x.where(choice.isNull()).select("key", F.posexplode(_get("v", "$.output", "array<variant>")).alias("at", "item"))
    kind = F.coalesce(_get("item", "$.type", "string"), F.lit(""))
    calls = listed.where(kind.isin(CALLS[:2]))
    said = listed.where(kind.isin("message", "agent_message") | ((_get("item", "$.role", "string") == "assistant") & ~kind.isin(CALLS[:2])))
    said = said.select("key", "at", F.parse_json(F.to_json(F.struct(F.lit("assistant").alias("role"), content_text(_get("item", "$.content")).alias("content")))).alias("item"))
    return _positioned(_joined(_blocks(items.unionByName(calls).unionByName(said))), key)


def _positioned(messages: DataFrame, key: str) -> DataFrame:
    at = F.row_number().over(W.partitionBy("key").orderBy("at", "part")) - 1
    return messages.select(F.col("key").alias(key), at.alias("position"), "role", "content", "tool_calls", "tool_call_id", "status", "is_error")


def tool_definitions(rows: DataFrame, key: str, body: str) -> DataFrame:
    """key, ordinal, namespace (array), name, definition_key and raw (JSON) of every tool that a request defines.

    Namespaces and lists of tools nest to any depth; they are opened level by
    level, each written, until none is left. The definition key is the JSON
    array of the namespace and the name, the default namespace left out.
    """
    v = F.try_parse_json(body)
    x = rows.select(F.col(key).alias("key"), v.alias("v"))
    lists = [_get("v", f"$.{f}", "array<variant>") for f in CHILD_FIELDS[:2]]
    nested = F.filter(F.coalesce(_get("v", "$.input", "array<variant>"), F.array().cast("array<variant>")), lambda i: F.coalesce(F.try_variant_get(i, "$.type", "string") == NESTED_TOOLS, F.lit(False)))
    none = F.array().cast("array<variant>")
    top = F.concat(*[F.coalesce(c, none) for c in lists], nested)
    level = x.select("key", F.posexplode(top).alias("i", "tool")).select("key", F.array("i").alias("ordinal"), F.array().cast("array<string>").alias("path"), F.to_json("tool").alias("raw"))
    space = lambda v, *names: F.trim(F.coalesce(*[F.try_variant_get(v, f"$.{n}", "string") for n in names]))
    grown = lambda path, name, always: F.when(F.coalesce(name, F.lit("")) == "", path).when(always | ~F.coalesce(F.try_element_at(path, F.lit(-1)) == name, F.lit(False)), F.concat(path, F.array(name))).otherwise(path)
    out = None
    while True:
        y = level.withColumn("t", F.parse_json("raw"))
        holder = F.coalesce(F.try_variant_get("t", "$.type", "string") == "namespace", F.lit(False))
        declared = F.when(holder, space(F.col("t"), "name")).otherwise(space(F.col("t"), "runtime_namespace", "namespace"))
        children = F.concat(*[F.coalesce(F.try_variant_get("t", f"$.{f}", "array<variant>"), none) for f in CHILD_FIELDS])
        y = y.withColumns({"holder": holder, "path": grown(F.col("path"), declared, holder), "children": children})
        schema = F.coalesce(*[F.try_variant_get("t", f"$.{f}", "variant") for f in SCHEMA_FIELDS]).isNotNull()
        inner = F.try_variant_get("t", "$.function", "variant")
        f = F.coalesce(inner, F.col("t"))
        path = F.when(inner.isNotNull(), grown(F.col("path"), space(f, "runtime_namespace", "namespace"), F.lit(False))).otherwise(F.col("path"))
        name = F.try_variant_get(f, "$.name", "string")
        own = y.where(~F.col("holder") & ((F.size("children") == 0) | schema)).select("key", "ordinal", path.alias("namespace"), name.alias("name"), "raw").where(F.trim("name") != "")
        identity = F.when(F.to_json("namespace") == f'["{DEFAULT_NAMESPACE}"]', F.array("name")).otherwise(F.concat("namespace", F.array("name")))
        own = own.withColumn("definition_key", F.to_json(identity))
        out = own if out is None else out.unionByName(own)
        level = cut(y.select("key", "ordinal", "path", F.posexplode("children").alias("i", "c")).select("key", F.concat("ordinal", F.array("i")).alias("ordinal"), "path", F.to_json("c").alias("raw")))
        if level.isEmpty():
            return out.select(F.col("key").alias(key), "ordinal", "namespace", "name", "definition_key", "raw")
