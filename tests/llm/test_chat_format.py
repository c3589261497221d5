import json

from surgewatch.llm.chat_format import SCHEMAS, canonical, format_chats, order, problems, stand_in
from surgewatch.llm.queries import op4_chat_format

CALLS = "conv_id long, turn long, seq int, call_id string, name string, arguments string, after array<string>, extra string"


def test_problems():
    assert problems('{"query": "x", "limit": 3}', SCHEMAS["search"]) == ({"query": "x", "limit": 3}, [])
    assert problems('{"limit": true, "page": 1}', SCHEMAS["search"])[1] == [
        "arguments: query missing", "arguments: page unknown", "arguments.limit: not integer"]
    assert problems("{", SCHEMAS["search"]) == ("{", ["arguments: not JSON"])
    assert problems('{"text": "", "unit": "line"}', SCHEMAS["measure"])[1] == ["arguments.unit: not in enum"]
    assert problems(None, SCHEMAS["search"])[1] == ["arguments: query missing"]
    assert problems("[]", None) == ([], ["unknown tool"])


def test_odd_json():
    """Half a pair, deep nesting, what Python takes for numbers, types in lists, floats without a fraction."""
    half, wrong = problems('{"query":"\\ud83d"}', SCHEMAS["search"])
    assert not wrong and canonical(half) == '{"query":"\ufffd"}' and canonical("\ud83d\ude00") == '"\U0001f600"'
    for bad in ("[" * 100_000, "NaN", '{"limit": Infinity}', "[1e999]", "-Infinity", "", " ", "1" * 5000, "{}x"):
        assert problems(bad, SCHEMAS["search"]) == (bad, ["arguments: not JSON"])
    deep = '{"a":' * 5000 + "1" + "}" * 5000  # JSON or not, as deep as the parser goes: no crash
    assert problems(deep, SCHEMAS["search"])[1]
    either = {"properties": {"a": {"type": ["string", "null"]}, "b": {"type": "null"}, "c": {"type": "integer"}, "d": {"type": "odd"},
                             "e": {"enum": [1, "x"]}}}
    assert problems('{"a": null, "b": null, "c": 1.0, "e": 1.0}', either)[1] == []
    assert problems('{"a": 1, "b": 0, "c": 1.5, "d": 1, "e": true}', either)[1] == [
        "arguments.a: not string or null", "arguments.b: not null", "arguments.c: not integer", "arguments.d: not odd",
        "arguments.e: not in enum"]
    assert problems("true", {"type": "integer"})[1] == ["arguments: not integer"]


def test_odd_json_in_spark(spark):
    odd = ['{"query":"\\ud83d"}', "[" * 100_000, "NaN", '{"query":"' + "x" * 500_000 + '"}', None, ""]
    calls = spark.createDataFrame([(1, 1, k, f"c{k}", "search", a, None, "x") for k, a in enumerate(odd)], CALLS)
    messages = spark.createDataFrame([(1, 1, "assistant", "y" * 300_000)], "conv_id long, turn long, role string, text string")
    results = spark.createDataFrame([("c0", "z" * 300_000)], "call_id string, content string")
    rows = format_chats(messages, calls, results, SCHEMAS).collect()
    assert [r.valid for r in sorted(rows, key=lambda r: r.part)] == [None, True, False, False, True, False, False]
    assert all(json.loads(r.json) for r in rows)


def test_order():
    assert order(["a", "b", "c"], [["b"], ["c", "z"], []]) == ([2, 1, 0], set())
    assert order(["a", "b", "c"], [["b"], ["a"], []]) == ([2, 0, 1], {0, 1})
    assert order([], []) == ([], set())


def test_links(spark):
    messages = spark.createDataFrame([
        (1, 0, "user", "hi", "x"), (1, 1, "assistant", "wörk", "x"), (1, 1, "assistant", "wörk", "x"), (1, 1, "system", None, "x"),
        (None, 0, None, "lost", "x"), (2, 0, "user", "", "x")], "conv_id long, turn long, role string, text string, calls string")
    calls = spark.createDataFrame([
        (1, 1, 0, "b", "search", '{"query":"q"}', ["a"], "x"), (1, 1, 1, "a", "measure", '{"unit":"word","text":"t"}', None, "x"),
        (1, 1, 2, "c", "none", "{}", [], "x"), (1, 1, 2, "c", "none", "{}", [], "x"), (2, 5, 0, "d", "search", None, ["a"], "x"),
        (None, 1, 0, "e", "search", "{}", [], "x"), (2, 5, 1, None, "search", "{}", [], "x")], CALLS)
    results = spark.createDataFrame([("a", "2"), ("a", "1"), ("b", None), ("zzz", "orphan"), (None, "n")],
                                    "call_id string, content string")
    out = format_chats(messages, calls, results, SCHEMAS).collect()
    rows = {(x.conv_id, x.turn, x.part): x for x in out if x.part}
    assert [rows[1, 1, k].call_id for k in (1, 2, 3)] == ["a", "b", "c"]  # b waits for a
    assert json.loads(rows[1, 1, 1].json) == {"role": "tool", "tool_call_id": "a", "name": "measure", "content": "1"}
    assert (rows[1, 1, 2].linked, rows[1, 1, 2].valid) == (True, True)
    assert (rows[1, 1, 3].linked, rows[1, 1, 3].problems) == (False, "unknown tool")
    assert rows[2, 5, 1].problems == "arguments: query missing; waits for an unknown or later call"
    said = sorted(x.json for x in out if x.part == 0 and x.conv_id == 1)
    assert len(said) == 4 and sum("tool_calls" in x for x in said) == 1
    head = next(x for x in said if "tool_calls" in x)
    assert [c["id"] for c in json.loads(head)["tool_calls"]] == ["a", "b", "c"]
    assert head == canonical(json.loads(head)) and "wörk" in head
    assert sum(x.conv_id is None for x in out) == 1 and len(out) == 10
    none = format_chats(messages.limit(0), calls.limit(0), results.limit(0), SCHEMAS)
    assert none.collect() == []


def test_whole_table(spark, load):
    """Every message and every line of an assistant's message has its row, linked by a plain loop."""
    rows = load("conversations", cols="conv_id, turn, role, text")
    out = op4_chat_format(spark, "/root/testdata/sf0.001").collect()
    assert sum(x.part == 0 for x in out) == len(rows)
    assert sum(x.part > 0 for x in out) == sum(t.count("\n") + 1 for _, _, r, t in rows if r == "assistant")
    calls, results = stand_in(spark.read.parquet("/root/testdata/sf0.001/conversations.parquet"))
    calls = {c.call_id: c for c in calls.collect()}
    answer = {r.call_id: r.content for r in results.collect()}
    for x in out:
        if not x.part:
            continue
        c = calls[x.call_id]
        assert json.loads(x.json)["content"] == answer.get(x.call_id) and x.linked == (x.call_id in answer)
        wrong = problems(c.arguments, SCHEMAS.get(c.name))[1]
        wrong += ["waits for an unknown or later call"] if any(a not in calls for a in c.after or []) else []
        assert x.problems == "; ".join(wrong) and x.valid == (not wrong)
    place = {x.call_id: x.part for x in out if x.part}
    assert all(place[a] < place[i] for i, c in calls.items() for a in c.after or [] if a in place)
