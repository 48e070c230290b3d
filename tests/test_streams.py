"""Streams rebuilt as rows: framing, three protocols, and bodies that broke off."""

import json

import pytest

from loomspark.operators import streams

d = lambda x, e=None, sep="\n\n": (f"event: {e}\n" if e else "") + f"data: {x if isinstance(x, str) else json.dumps(x)}{sep}"


def rows(spark, fn, *bodies):
    x = spark.createDataFrame(list(enumerate(bodies)), "k int, body string")
    return {r.k: r for r in fn(x.repartition(2), "k", "body").collect()}


def test_frames(spark):
    text = 'é: x\ndata: {"a": "\u2028\u2029\x85"}\n\n'
    cases = {
        text: [(None, 1)],
        'event: a\r\ndata: {"a": 1}\r\n\r\n\r\ndata: [DONE]': [("a", 1), (None, "done")],
        'event: a\ndata: {"a": 1}\nevent: b\ndata: {"a": 2}\n': [("a", 1), ("b", 2)],
        'data: {"a": 1}\ndata: {"a": 2}\ndata: [DONE]\n\n': [(None, 1), (None, 2), (None, "done")],
        'data: {"a":\ndata: 1}\n\ndata: {bad\n\nevent: only\n\n: note\n\n': [(None, 1), (None, None)],
        "data: {\"a\": 1}\ndata: {bad\n\n": [(None, None)],
        "data: " + "[" * 3000 + "\n\n": [(None, None)],
        "": [], "\n\n": [],
    }
    x = spark.createDataFrame([(k, b) for k, b in enumerate([*cases, None])], "k int, body string")
    got = {}
    for r in streams.events(x, "k", "body").selectExpr("k", "seq", "event", "done", "v is not null ok", "`start`", "`end`", "recovered", "data").orderBy("k", "seq").collect():
        got.setdefault(r.k, []).append(r)
    for k, (body, want) in enumerate(cases.items()):
        have = got.get(k, [])
        assert [(r.event, "done" if r.done else r.ok) for r in have] == [(e, "done" if w == "done" else w is not None) for e, w in want], body
        for r in have:
            part = body.encode()[r.start : r.end].decode()
            assert part.startswith(("event:", "data:")) and r.data.split("\n")[0][:50] in part
    assert [r.recovered for r in got[2]] == [False, True] and [r.recovered for r in got[3]] == [False, True, True]


def test_chat(spark):
    c = lambda delta, **x: d({"id": "i", "model": "m", "created": 5, "choices": [{"index": 0, "delta": delta, **x}]})
    whole = c({"role": "assistant", "content": "he"}) + c({"content": "y", "reasoning": "r1"}) + c({"tool_calls": [{"index": 1, "id": "c1", "function": {"name": "f", "arguments": "{\"a\""}}, {"index": 0, "id": "c0", "function": {"name": "g"}}]}) + c({"tool_calls": [{"index": 1, "function": {"arguments": ":1}"}}]}, finish_reason="tool_calls") + d({"choices": [], "usage": {"total_tokens": 3}}) + d("[DONE]")
    odd = d({"choices": [{"delta": None}, {"index": 2, "delta": {"tool_calls": None, "content": 7}}, None, 5]}) + d({"choices": None}) + d({"choices": "x"}) + d("[1]") + d("{bad") + d("nul")
    old = d({"choices": [{"index": 0, "delta": {"function_call": {"name": "f", "arguments": "x"}}}]})
    got = rows(spark, streams.chat, whole, odd, None, "", whole[: len(whole) // 2], old)
    r = got[0]
    m = json.loads(r.choices)
    assert (r.frames, r.malformed, r.recovered, r.done, r.id, r.model, r.created, json.loads(r.usage)) == (5, 0, 0, True, "i", "m", 5, {"total_tokens": 3})
    assert m == [{"index": 0, "finish_reason": '"tool_calls"', "message": {"role": "assistant", "content": "hey", "reasoning_content": "r1", "tool_calls": [{"index": 0, "id": "c0", "type": "function", "function": {"name": "g", "arguments": ""}}, {"index": 1, "id": "c1", "type": "function", "function": {"name": "f", "arguments": '{"a":1}'}}]}}]
    assert (got[1].frames, got[1].malformed, got[1].done) == (4, 2, False) and [x["index"] for x in json.loads(got[1].choices)] == [0, 2]
    assert [(got[k].frames, got[k].malformed, got[k].choices) for k in (2, 3)] == [(0, 0, "[]")] * 2
    assert got[4].malformed == 1 and not got[4].terminal
    assert json.loads(got[5].choices)[0]["message"]["function_call"] == {"name": "f", "arguments": "x"}


def test_anthropic(spark):
    start = d({"type": "message_start", "message": {"id": "m", "model": "x", "role": "assistant", "usage": {"input_tokens": 2, "output_tokens": 1}}}, "message_start")
    block = lambda i, **b: d({"type": "content_block_start", "index": i, "content_block": b})
    delta = lambda i, t, **x: d({"type": "content_block_delta", "index": i, "delta": {"type": t, **x}})
    body = start + block(1, type="tool_use", id="t1", name="f", input={}) + block(0, type="text", text="a") + delta(0, "text_delta", text="b") + delta(1, "input_json_delta", partial_json='{"a":') + delta(1, "input_json_delta", partial_json="1}") + block(2, type="thinking", thinking="") + delta(2, "thinking_delta", thinking="hm") + block(3, type="image", z=1)
    end = d({"type": "message_delta", "delta": {"stop_reason": "tool_use"}, "usage": {"output_tokens": 4}}) + d({"type": "message_stop"})
    cut = start + block(0, type="tool_use", id="t0", name="f") + delta(0, "input_json_delta", partial_json='{"a": "unfin')
    odd = d({"type": "content_block_delta", "delta": None}) + d({"type": "content_block_start"}) + d({"type": "message_start"}) + d({"type": "error", "error": {"type": "overloaded"}})
    got = rows(spark, streams.anthropic, body + end, cut, odd, None)
    r = got[0]
    assert json.loads(r.content) == [{"type": "text", "text": "ab"}, {"type": "tool_use", "id": "t1", "name": "f", "input": {"a": 1}}, {"type": "thinking", "thinking": "hm"}, {"type": "image", "z": 1}]
    assert (r.id, r.model, r.role, r.stop_reason, r.usage, r.terminal, r.truncated, r.error) == ("m", "x", "assistant", '"tool_use"', {"input_tokens": "2", "output_tokens": "4"}, True, [], None)
    assert json.loads(got[1].content) == [{"type": "tool_use", "id": "t0", "name": "f", "input": {}}] and got[1].truncated == ["t0"] and not got[1].terminal
    assert got[2].terminal and json.loads(got[2].error)["error"] == {"type": "overloaded"} and got[2].malformed == 0
    assert (got[3].content, got[3].usage, got[3].terminal) == ("[]", {}, False)


ITEM = {"type": "function_call", "id": "fc", "call_id": "c1", "name": "f", "arguments": "{}", "n": [1, {"x": None}], "encrypted_content": "a"}
added = lambda k, item: d({"type": "response.output_item.added", "output_index": k, "item": item})
done = lambda k, item: d({"type": "response.output_item.done", "output_index": k, "item": item})
end = lambda kind="completed", **r: d({"type": f"response.{kind}", "response": {"id": "r", **r}})
created = d({"type": "response.created", "response": {"id": "r", "status": "in_progress"}})
thin = {"type": "function_call", "id": "fc", "call_id": "c1", "name": "f", "arguments": ""}


@pytest.mark.parametrize("part", ["rules", "odd"])
def test_responses(spark, part):
    delta = d({"type": "response.function_call_arguments.delta", "item_id": "fc", "delta": "{"})
    cases = {
        "rules": [
            (created + added(0, thin) + delta + done(0, ITEM) + end(output=[ITEM | {"more": 1, "encrypted_content": "b"}]), dict(malformed=0, outcome="completed", truncated=[])),
            (created + added(0, thin) + done(0, ITEM) + end(), dict(malformed=0, output=[ITEM])),
            (done(0, ITEM) + end(output=[ITEM | {"n": [1, {"x": 2}]}]), dict(malformed=1)),
            (done(0, ITEM) + end(output=[]), dict(malformed=1)),
            (done(0, ITEM) + done(0, ITEM | {"name": "g"}) + end(output=[ITEM | {"name": "g"}]), dict(malformed=1)),
            (added(0, thin) + end(output=[ITEM]), dict(malformed=0)),
            (added(0, thin) + end(output=[ITEM | {"name": "g"}]), dict(malformed=1)),
            (added(0, thin) + end("incomplete", output=[], incomplete_details={"reason": "max_output_tokens"}), dict(malformed=0, outcome="incomplete", truncated=["c1"])),
            (added(0, thin) + end("incomplete", output=[]), dict(malformed=1, truncated=[])),
        ],
        "odd": [
            (created + end() + end("failed"), dict(malformed=1, outcome="completed")),
            (created + d({"type": "error", "message": "x"}), dict(malformed=0, outcome="failed")),
            (created + added(0, {"t": 0}) + "data: {cut", dict(malformed=1, outcome=None, output=[{"t": 0}])),
            (end(output="text"), dict(malformed=1)),
            (d({"type": "response.output_item.done", "item": None}) + d({"type": "response.completed"}) + d("5") + d([1]), dict(malformed=0, outcome="completed")),
            (None, dict(malformed=0, outcome=None, output=[])),
        ],
    }[part]
    got = rows(spark, streams.responses, *[b for b, _ in cases])
    for k, (body, want) in enumerate(cases):
        r = got[k].asDict() | {"output": json.loads(got[k].output) if got[k].output[0] == "[" else got[k].output}
        assert {n: r[n] for n in want} == want, (k, body, r)
    if part == "rules":
        body = cases[0][0].encode()
        (call,) = got[0].calls
        assert call.call_id == "c1" and body[call.start : call.end].decode().startswith('data: {"type": "response.output_item.added"') and call.end == body.index(b'data: {"type": "response.completed"')
        assert json.loads(got[0].response) == {"id": "r"} and json.loads(got[8].response) == {"id": "r"}
        assert got[5].calls[0].end == len(cases[5][0].encode())


def test_lines_alone_are_parsed_once(spark):
    """A data line between blanks is parsed as its frame only; lines that follow each other still make good a missing blank, whatever their ends."""
    body = 'data: {"a":1}\r\n\r\r\n' + 'data: {"b":2}\n' + 'data: {"c":3}\n' + 'data: [DONE]'
    x = streams.events(spark.createDataFrame([("k", body)], "k string, body string"), "k", "body")
    got = [(r.data, r.recovered, r.done) for r in x.orderBy("seq").collect()]
    assert got == [('{"a":1}', False, False), ('{"b":2}', False, False), ('{"c":3}', True, False), ("[DONE]", True, True)]
    plan = x._jdf.queryExecution().optimizedPlan().toString()
    assert "lead(" in plan
