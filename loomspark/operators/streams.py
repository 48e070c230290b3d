"""Streamed answers rebuilt as rows: lines to events, events to deltas, deltas put together by stream and index.

Every step is a window or a grouped aggregate over rows of (stream, position),
so nothing in a body can end the job: what isn't JSON, or isn't where it
should be, is null, and counts as malformed where the protocol says so. A
body's own lines meet in one task, as they came from one value.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.values import whole_json
from .checkpoint import written

#: The protocols' event types, item types that are calls, the field that may be packed anew.
CALLS = ["function_call", "custom_tool_call"]
TERMINALS = {"response.completed": "completed", "response.failed": "failed", "response.incomplete": "incomplete", "response.cancelled": "cancelled"}
ERRORS, OPAQUE, DONE = ["error", "response.error"], "encrypted_content", "[DONE]"


def at(v: Column, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(v, path, kind)


def _typed(v: Column, *kinds: str) -> Column:
    found = F.schema_of_variant(v)
    out = F.lit(False)
    for k in kinds:
        out = out | found.startswith(k)
    return F.coalesce(out, F.lit(False))


def string_at(v: Column, path: str) -> Column:
    """A string that is there and is one; numbers and the like are null."""
    x = at(v, path)
    return F.when(_typed(x, "STRING"), x.cast("string"))


def named(v: Column, *paths: str) -> Column:
    """The first of the paths with a string that isn't blank."""
    return F.coalesce(*[F.when(F.trim(string_at(v, p)) != "", string_at(v, p)) for p in paths])


def present(v: Column) -> Column:
    """Neither missing nor JSON's null."""
    return v.isNotNull() & ~F.coalesce(F.is_variant_null(v), F.lit(False))


def by_stream(fn: Callable[[DataFrame, str, str], DataFrame]) -> Callable[[DataFrame, str, str], DataFrame]:
    """``fn`` with the key under a name of its own, so that keys of any name are fine."""

    @wraps(fn)
    def run(bodies: DataFrame, key: str, body: str) -> DataFrame:
        return fn(bodies.select(F.col(key).alias("_stream"), F.col(body).alias("_body")), "_stream", "_body").withColumnRenamed("_stream", key)

    return run


def lines(bodies: DataFrame, key: str, body: str) -> DataFrame:
    """key, n, kind (event, data, blank, other), value, start and end (bytes) of each line; lines end at line feeds only."""
    x = bodies.select(key, F.posexplode(F.regexp_extract_all(F.coalesce(body, F.lit("")), F.lit("[^\n]*\n|[^\n]+"), F.lit(0))).alias("n", "raw"))
    end = F.sum(F.octet_length("raw")).over(W.partitionBy(key).orderBy("n"))
    text = F.when(F.col("raw").endswith("\n"), F.rtrim(F.substring("raw", F.lit(1), F.length("raw") - 1), F.lit("\r"))).otherwise(F.col("raw"))
    kind = F.when(text == "", "blank").when(text.startswith("event:"), "event").when(text.startswith("data:"), "data").otherwise("other")
    value = F.when(kind == "event", F.trim(F.substring(text, 7, 1 << 30))).when(kind == "data", F.ltrim(F.substring(text, 6, 1 << 30)))
    return x.select(key, "n", kind.alias("kind"), value.alias("value"), (end - F.octet_length("raw")).alias("start"), end.alias("end"))


@by_stream
def events(bodies: DataFrame, key: str, body: str) -> DataFrame:
    """key, seq, event, data, start, end, recovered, done, v (VARIANT; null where the data isn't JSON).

    A frame ends at a blank line. A missing one is made good before an
    ``event:`` line that follows data, and before a data line that is whole
    (an object, a list, or the end's mark) after one that is whole.
    ``recovered`` says that the frame began so. Frames without data are none.
    """
    x = lines(bodies, key, body).where("kind != 'other'")
    order = W.partitionBy(key).orderBy("n")
    # only where data follows data does it matter whether a line is whole: elsewhere none is parsed before its frame is
    x = x.withColumns({"was": F.lag("kind").over(order), "next": F.lead("kind").over(order)})
    beside = (F.col("was") == "data") | (F.col("next") == "data")
    x = x.withColumn("whole", F.when((F.col("kind") == "data") & beside & F.col("value").rlike(r"^[\[{]"), whole_json(F.col("value")).isNotNull()).otherwise(F.lit(False)))
    x = x.withColumns({"was_whole": F.coalesce(F.lag("whole").over(order), F.lit(False)), "marked": F.trim("value") == DONE})
    cut = (F.col("was") == "data") & ((F.col("kind") == "event") | ((F.col("kind") == "data") & F.col("was_whole") & (F.col("whole") | F.col("marked"))))
    x = x.withColumn("cut", F.coalesce(cut, F.lit(False)))
    x = x.withColumn("frame", F.sum(F.when(F.col("cut") | F.coalesce(F.col("was") == "blank", F.lit(True)), 1).otherwise(0)).over(order))
    data = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("kind") == "data", F.struct("n", "value")))), lambda d: d["value"]), "\n")
    f = x.groupBy(key, "frame").agg(
        F.max_by("value", F.when(F.col("kind") == "event", F.col("n"))).alias("event"), data.alias("data"), F.min(F.when(F.col("kind") != "blank", F.col("start"))).alias("start"), F.max("end").alias("end"),
        F.max("cut").alias("recovered"), F.count_if(F.col("kind") == "data").alias("_data"),
    ).where("_data > 0")
    done = F.trim("data") == DONE
    f = f.withColumns({"done": done, "v": F.when(~done, whole_json(F.col("data")))})
    return f.select(key, F.col("frame").alias("seq"), "event", "data", "start", "end", "recovered", "done", "v")


def counters(found: DataFrame, key: str) -> DataFrame:
    """By stream: frames (that are JSON), malformed, recovered, done."""
    return found.groupBy(key).agg(F.count("v").alias("frames"), F.count_if(F.col("v").isNull() & ~F.col("done")).alias("malformed"), F.count_if("recovered").alias("recovered"), F.max("done").alias("done"))


def first_of(c: Column | str, order: Column | str = "seq") -> Column:
    """The first value that isn't null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.min_by(c, F.when(c.isNotNull(), F.col(order) if isinstance(order, str) else order))


def last_of(c: Column, order: str = "seq") -> Column:
    return F.max_by(c, F.when(c.isNotNull(), F.col(order)))


def joined(c: Column, *order: str) -> Column:
    """All strings, one after the other."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.when(c.isNotNull(), F.struct(*order, c.alias("_text"))))), lambda x: x["_text"]), "")


def _items(v: Column, path: str) -> Column:
    return at(v, path, "array<variant>")


def _json(v: Column) -> Column:
    return F.when(present(v), F.to_json(v))


def _done(bodies: DataFrame, key: str, counted: DataFrame, parts: DataFrame) -> DataFrame:
    """One row for each body, also those without any event."""
    x = bodies.select(key).distinct().join(counted, key, "left").join(parts, key, "left")
    return x.withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in ("frames", "malformed", "recovered")}).withColumn("done", F.coalesce("done", F.lit(False)))


@by_stream
def chat(bodies: DataFrame, key: str, body: str) -> DataFrame:
    """Chat completion streams: key, frames, malformed, recovered, done, id, model, created, usage, choices (JSON), terminal (it is done).

    ``key`` is unique. A null or empty body has no frames. Deltas that aren't
    what they should be add nothing.
    """
    found = written(events(bodies, key, body), "stream-events")
    v = F.col("v")
    heads = found.groupBy(key).agg(*[first_of(string_at(v, f"$.{f}")).alias(f) for f in ("id", "model")], first_of(at(v, "$.created", "long")).alias("created"), last_of(_json(at(v, "$.usage"))).alias("usage"))
    c = found.select(key, "seq", F.posexplode(_items(v, "$.choices")).alias("k", "c"))
    c = c.select(key, "seq", "k", F.coalesce(at(F.col("c"), "$.index", "long"), F.lit(0)).alias("index"), _json(at(F.col("c"), "$.finish_reason")).alias("finish"), F.coalesce(at(F.col("c"), "$.delta"), at(F.col("c"), "$.message")).alias("d"))
    c = written(c, "stream-choices")
    d = F.col("d")
    texts = c.groupBy(key, "index").agg(last_of(F.col("finish")).alias("finish"), last_of(string_at(d, "$.role")).alias("role"), joined(string_at(d, "$.content"), "seq", "k").alias("content"), joined(F.coalesce(string_at(d, "$.reasoning_content"), string_at(d, "$.reasoning")), "seq", "k").alias("reasoning"),
        joined(string_at(d, "$.function_call.name"), "seq", "k").alias("f_name"), joined(string_at(d, "$.function_call.arguments"), "seq", "k").alias("f_arguments"), F.count_if(present(at(d, "$.function_call"))).alias("f"))
    t = c.select(key, "index", "seq", F.posexplode(_items(d, "$.tool_calls")).alias("j", "t"))
    call, fn = F.col("t"), F.coalesce(at(F.col("t"), "$.function"), F.col("t"))
    t = t.groupBy(key, "index", F.coalesce(at(call, "$.index", "long"), F.col("j").cast("long")).alias("call")).agg(last_of(string_at(call, "$.id")).alias("id"), last_of(string_at(call, "$.type")).alias("type"), joined(string_at(fn, "$.name"), "seq", "j").alias("name"), joined(string_at(fn, "$.arguments"), "seq", "j").alias("arguments"))
    t = t.groupBy(key, "index").agg(F.array_sort(F.collect_list(F.struct(F.col("call").alias("index"), "id", F.coalesce("type", F.lit("function")).alias("type"), F.struct("name", "arguments").alias("function")))).alias("tool_calls"))
    m = texts.join(t, [key, "index"], "left")
    message = F.struct(F.coalesce("role", F.lit("assistant")).alias("role"), "content", F.coalesce("tool_calls", F.array()).alias("tool_calls"), F.when(F.col("f") > 0, F.struct(F.col("f_name").alias("name"), F.col("f_arguments").alias("arguments"))).alias("function_call"), F.when(F.col("reasoning") != "", F.col("reasoning")).alias("reasoning_content"))
    choice = F.struct("index", message.alias("message"), F.col("finish").alias("finish_reason"))
    choices = m.groupBy(key).agg(F.to_json(F.array_sort(F.collect_list(choice))).alias("choices"))
    x = _done(bodies, key, counters(found, key), heads.join(choices, key, "left"))
    return x.select(key, "frames", "malformed", "recovered", "done", "id", "model", "created", "usage", F.coalesce("choices", F.lit("[]")).alias("choices"), F.col("done").alias("terminal"))


@by_stream
def anthropic(bodies: DataFrame, key: str, body: str) -> DataFrame:
    """Message streams: key, frames, malformed, recovered, done, id, model, role, content (JSON), stop_reason, usage (map of JSON), error, terminal.

    A tool's input that breaks off is the empty object, and its call is named
    in ``truncated``. Usage fields are the last given. ``key`` is unique.
    """
    found = written(events(bodies, key, body), "stream-events")
    v = F.col("v")
    kind = F.coalesce(string_at(v, "$.type"), F.lit(""))
    start, error = kind == "message_start", kind == "error"
    heads = found.groupBy(key).agg(
        *[last_of(F.when(start, string_at(v, f"$.message.{f}"))).alias(f) for f in ("id", "model", "role")], last_of(F.when(kind == "message_delta", _json(at(v, "$.delta.stop_reason")))).alias("stop_reason"),
        last_of(F.when(error, F.to_json(v))).alias("error"), F.max((kind == "message_stop") | error).alias("terminal"),
    )
    u = found.where(start | (kind == "message_delta")).select(key, "seq", F.explode(F.coalesce(at(F.when(start, at(v, "$.message.usage")).otherwise(at(v, "$.usage")), "$", "map<string,variant>"), F.create_map().cast("map<string,variant>"))).alias("name", "value"))
    u = u.groupBy(key, "name").agg(last_of(_json(F.col("value"))).alias("value")).where("value is not null").groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "value")))).alias("usage"))
    b = found.where(kind.isin("content_block_start", "content_block_delta")).select(key, "seq", kind.alias("kind"), F.coalesce(at(v, "$.index", "long"), F.lit(0)).alias("index"), at(v, "$.content_block").alias("b"), at(v, "$.delta").alias("d"))
    b = written(b, "stream-blocks")
    # a block that starts again begins anew
    began = b.where("kind = 'content_block_start'").groupBy(key, "index").agg(F.max("seq").alias("began"), F.max_by(F.to_json("b"), "seq").alias("b0"))
    deltas = b.where("kind = 'content_block_delta'").join(began.select(key, "index", "began"), [key, "index"], "left").where("began is null or seq > began")
    d, is_ = F.col("d"), lambda t: string_at(F.col("d"), "$.type") == t
    deltas = deltas.groupBy(key, "index").agg(joined(F.when(is_("text_delta"), string_at(d, "$.text")), "seq").alias("text"), joined(F.when(is_("thinking_delta"), string_at(d, "$.thinking")), "seq").alias("thinking"), joined(F.when(is_("input_json_delta"), string_at(d, "$.partial_json")), "seq").alias("partial"))
    x = began.join(deltas, [key, "index"], "full").withColumn("b", F.parse_json("b0"))
    of, bv = lambda c: F.coalesce(F.col(c), F.lit("")), F.col("b")
    text, think = F.concat(F.coalesce(string_at(bv, "$.text"), F.lit("")), of("text")), F.concat(F.coalesce(string_at(bv, "$.thinking"), F.lit("")), of("thinking"))
    given = F.coalesce(F.to_json(at(bv, "$.input")), F.lit("{}"))
    whole = F.to_json(whole_json(F.col("partial")))
    input_ = F.when(of("partial") == "", given).otherwise(F.coalesce(whole, F.lit("{}")))
    quote = lambda c: F.coalesce(F.to_json(c.cast("variant")), F.lit("null"))
    type_ = F.coalesce(string_at(bv, "$.type"), F.lit("unknown"))
    block = F.when(type_ == "text", F.to_json(F.struct(F.lit("text").alias("type"), text.alias("text")))).when(type_ == "thinking", F.to_json(F.struct(F.lit("thinking").alias("type"), think.alias("thinking")))).when(
        type_ == "tool_use", F.concat(F.lit('{"id":'), quote(string_at(bv, "$.id")), F.lit(',"input":'), input_, F.lit(',"name":'), quote(string_at(bv, "$.name")), F.lit(',"type":"tool_use"}'))
    ).otherwise(F.coalesce("b0", F.lit("null")))
    cut = (type_ == "tool_use") & (of("partial") != "") & whole.isNull()
    x = x.groupBy(key).agg(F.concat(F.lit("["), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("index", block.alias("json")))), lambda r: r["json"]), ","), F.lit("]")).alias("content"), F.array_sort(F.collect_list(F.when(cut, string_at(bv, "$.id")))).alias("truncated"))
    x = _done(bodies, key, counters(found, key), heads.join(u, key, "left").join(x, key, "left"))
    return x.select(key, "frames", "malformed", "recovered", "done", "id", "model", F.coalesce("role", F.lit("assistant")).alias("role"), F.coalesce("content", F.lit("[]")).alias("content"), "stop_reason", F.coalesce("usage", F.create_map().cast("map<string,string>")).alias("usage"), "error", F.coalesce("truncated", F.array().cast("array<string>")).alias("truncated"), F.coalesce("terminal", F.lit(False)).alias("terminal"))


def leaves(x: DataFrame, keys: list[str], v: str, most_levels: int = 32) -> DataFrame:
    """keys, path, leaf (JSON; of lists their length too) of all values within ``v``; what lies deeper than ``most_levels`` is one leaf."""
    out, level = None, x.select(*keys, F.lit("").alias("path"), F.col(v).alias("v"))
    for k in range(most_levels):
        level = written(level, "stream-leaves")
        if level.isEmpty():
            break
        v_ = F.col("v")
        is_object, is_list = _typed(v_, "OBJECT"), _typed(v_, "ARRAY")
        items = F.transform(_items(v_, "$"), lambda e, i: F.struct(F.concat(F.lit("/"), i.cast("string")).alias("key"), e.alias("value")))
        fields = F.transform(F.map_entries(at(v_, "$", "map<string,variant>")), lambda e: F.struct(F.concat(F.lit("/"), e["key"]).alias("key"), e["value"].alias("value")))
        last = F.lit(k == most_levels - 1)
        flat = F.when(is_object & ~last, "{}").when(is_list & ~last, F.concat(F.lit("list "), F.size(items).cast("string"))).otherwise(F.to_json(v_))
        flat = F.when(F.col("path").endswith(f"/{OPAQUE}") & _typed(v_, "STRING"), "opaque").otherwise(flat)
        rows = level.select(*keys, "path", flat.alias("leaf"))
        out = rows if out is None else out.union(rows)
        level = level.where((is_object | is_list) & ~last).select(*keys, F.col("path"), F.explode(F.when(is_object, fields).otherwise(items)).alias("e"))
        level = level.select(*keys, F.concat("path", "e.key").alias("path"), F.coalesce("e.value", F.parse_json(F.lit("null"))).alias("v"))
    return out


@by_stream
def responses(bodies: DataFrame, key: str, body: str) -> DataFrame:
    """Response streams: key, frames, malformed, recovered, done, outcome, response (JSON, without output), output (JSON list), error, truncated, calls.

    Items by index: one that is done stands for one that was added. A second
    different one of an index, a second end, and an end whose output drops or
    alters an item are malformed. Where the end says why it is incomplete,
    items that were added only and aren't in it are no fault: their calls are
    ``truncated``. ``calls`` are (call_id, start, end): the bytes in which a
    call is told. Without an output in the end, the items stand. Without an
    end the response is the one created. ``key`` is unique.
    """
    found = written(events(bodies, key, body), "stream-events")
    v = F.col("v")
    order = W.partitionBy(key).orderBy("seq")
    kind = F.coalesce(string_at(v, "$.type"), F.col("event"), F.lit(""))
    e = found.where("v is not null").select(key, "seq", "start", "end", "v", kind.alias("kind"))
    ends = e.where(F.col("kind").isin(*TERMINALS, *ERRORS)).withColumn("nth", F.row_number().over(order))
    last = ends.where("nth = 1")
    outcome = F.when(F.col("kind").isin(*ERRORS), "failed")
    for k, o in TERMINALS.items():
        outcome = outcome.when(F.col("kind") == k, o)
    why = at(v, "$.response.incomplete_details")
    is_end = F.col("kind").isin(*TERMINALS)
    last = written(last.select(key, outcome.alias("outcome"), F.when(is_end, at(v, "$.response")).alias("r"), F.when(F.col("kind").isin("response.failed", *ERRORS), F.to_json(v)).alias("error"), F.col("start").alias("t_start"), F.col("end").alias("t_end")), "stream-ends")
    stopped = e.where((F.col("kind") == "response.incomplete") & _typed(why, "OBJECT", "STRING")).select(key, F.lit(True).alias("explicit")).distinct()
    made = e.where("kind = 'response.created'").groupBy(key).agg(F.max_by(F.to_json(at(v, "$.response")), "seq").alias("created"))
    # items: an event without an index goes behind those told before it
    i = e.where(F.col("kind").isin("response.output_item.added", "response.output_item.done") & at(v, "$.item").isNotNull()).select(key, "seq", "start", "end", (F.col("kind") == "response.output_item.done").alias("whole"), at(v, "$.output_index", "long").alias("index"), at(v, "$.item").alias("item"))
    before = F.size(F.collect_set("index").over(order.rowsBetween(W.unboundedPreceding, -1))).cast("long")
    i = written(i.withColumn("index", F.coalesce("index", before)).withColumn("json", F.to_json("item")), "stream-items")
    again = W.partitionBy(key, "index").orderBy("seq")
    altered = i.where("whole").withColumn("was", F.lag("json").over(again)).where("was is not null and was != json").select(key)
    kept = i.groupBy(key, "index").agg(F.max("whole").alias("whole"), F.coalesce(F.max_by("json", F.when(F.col("whole"), F.col("seq"))), F.min_by("json", "seq")).alias("json"), F.min_by(named(F.col("item"), "$.call_id", "$.id"), F.when(~F.col("whole"), F.col("seq"))).alias("added"))
    kept = kept.join(last.select(key, _items(F.col("r"), "$.output").alias("said"), at(F.col("r"), "$.output").isNotNull().alias("has_output")), key, "left").join(stopped, key, "left")
    kept = written(kept.withColumns({"has_output": F.coalesce("has_output", F.lit(False)), "there": F.to_json(F.get("said", F.col("index").cast("int")))}).withColumn("cut", F.col("has_output") & F.coalesce("explicit", F.lit(False)) & ~F.col("whole") & (F.col("index") >= F.size("said"))).drop("said"), "stream-kept")
    checked = kept.where(F.col("has_output") & ~F.col("cut"))
    same = F.lit(True)
    a, b = F.parse_json("json"), F.parse_json("there")
    for f in ("type", "id", "call_id", "name"):
        same = same & (at(a, f"$.{f}").isNull() | F.coalesce(F.to_json(at(a, f"$.{f}")) == F.to_json(at(b, f"$.{f}")), F.lit(False)))
    loose = checked.where(~F.col("whole") & ~F.coalesce(F.col("there").isNotNull() & same, F.lit(False))).select(key, "index")
    whole = checked.where("whole")
    lost = whole.where("there is null").select(key, "index")
    near = whole.where("there is not null and json != there")
    seen, told = (leaves(near.withColumn("x", F.parse_json(c)), [key, "index"], "x") for c in ("json", "there"))
    if seen is not None:
        lost = lost.union(seen.join(told, [key, "index", "path", "leaf"], "left_anti").select(key, "index").distinct())
    odd = last.where(at(F.col("r"), "$.output").isNotNull() & ~_typed(at(F.col("r"), "$.output"), "ARRAY")).select(key)
    faults = altered.union(ends.where("nth > 1").select(key)).union(loose.select(key)).union(lost.select(key)).union(odd).groupBy(key).agg(F.count("*").alias("faults"))
    # where calls are told: by call id, by the id of their item, in items, and in the end
    call_item = _typed(at(v, "$.item"), "OBJECT") & string_at(v, "$.item.type").isin(*CALLS)
    ids = e.where(call_item).select(key, named(v, "$.item.id").alias("item_id"), named(v, "$.item.call_id", "$.item.callId").alias("call")).where("item_id is not null and call is not null").groupBy(key, "item_id").agg(F.min("call").alias("by_item"))
    t = e.select(key, "start", "end", named(v, "$.call_id", "$.callId").alias("own"), F.coalesce(named(v, "$.item_id", "$.itemId"), F.when(call_item, named(v, "$.item.id"))).alias("item_id"), F.when(call_item & F.col("kind").startswith("response.output_item."), named(v, "$.item.call_id", "$.item.id")).alias("in_item"))
    t = t.join(ids, [key, "item_id"], "left").select(key, "start", "end", F.explode(F.array_distinct(F.array_compact(F.array(F.coalesce("own", "by_item"), "in_item")))).alias("call"))
    t = t.groupBy(key, "call").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    f = last.select(key, "t_start", "t_end", F.posexplode(_items(F.col("r"), "$.output")).alias("k", "item")).where(string_at(F.col("item"), "$.type").isin(*CALLS))
    f = f.select(key, F.col("k").cast("long").alias("index"), named(F.col("item"), "$.call_id", "$.id").alias("call"), "t_start", "t_end").where("call is not null").join(kept.select(key, "index", "whole"), [key, "index"], "left")
    t = t.join(f.groupBy(key, "call").agg(F.min("t_start").alias("t_start"), F.max("t_end").alias("t_end"), F.min(F.coalesce("whole", F.lit(False))).alias("whole")), [key, "call"], "full")
    span = F.struct(F.col("call").alias("call_id"), F.coalesce("start", "t_start").alias("start"), F.when(F.col("end").isNull(), F.col("t_end")).when(F.col("t_end").isNotNull() & ~F.col("whole"), F.greatest("end", "t_end")).otherwise(F.col("end")).alias("end"))
    calls = t.groupBy(key).agg(F.array_sort(F.collect_list(span)).alias("calls"))
    items = kept.groupBy(key).agg(F.concat(F.lit("["), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("index", "json"))), lambda r: r["json"]), ","), F.lit("]")).alias("items"), F.array_sort(F.collect_set(F.when(F.col("cut"), F.col("added")))).alias("truncated"))
    parts = last.select(key, "outcome", "error", F.to_json("r").alias("r"), F.to_json(at(F.col("r"), "$.output")).alias("said")).join(made, key, "full").join(items, key, "full").join(calls, key, "full").join(faults, key, "full")
    x = _done(bodies, key, counters(found, key), parts)
    response = F.to_json(F.map_filter(at(F.parse_json(F.coalesce("r", "created", F.lit("{}"))), "$", "map<string,variant>"), lambda k, _: k != "output"))
    none = F.array().cast("array<string>")
    return x.select(key, "frames", (F.col("malformed") + F.coalesce("faults", F.lit(0))).alias("malformed"), "recovered", "done", "outcome", response.alias("response"), F.coalesce("said", "items", F.lit("[]")).alias("output"), "error", F.coalesce("truncated", none).alias("truncated"), F.coalesce("calls", F.array().cast("array<struct<call_id:string,start:long,end:long>>")).alias("calls"))
