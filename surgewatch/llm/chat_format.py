"""Chat formatting with linked tool calls.

Calls and results are hash-joined by identifier, a message's calls are ordered so
that each follows the calls whose results it uses, arguments are validated against
the tools' schemas, and messages are serialised as canonical JSON (sorted keys, no
white space, UTF-8).  One row per message: a conversation is never gathered, only
the calls of one message are.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

KINDS = {"string": (str,), "integer": (int, float), "number": (int, float), "boolean": (bool,), "object": (dict,), "array": (list,),
         "null": (type(None),)}


def canonical(value) -> str:
    """Sorted keys, no white space; half a surrogate pair, which UTF-8 can't hold, is U+FFFD."""
    text = json.dumps(value, sort_keys=True, ensure_ascii=False, separators=(",", ":"), allow_nan=False)
    try:
        text.encode()
        return text
    except UnicodeEncodeError:
        return text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def _is(v, kind: str) -> bool:
    """Whether a JSON value is of a schema's type; a float without a fraction is an integer."""
    return isinstance(v, KINDS[kind]) and isinstance(v, bool) == (kind == "boolean") \
        and (kind != "integer" or isinstance(v, int) or v.is_integer())


def problems(arguments: str | None, schema: dict | None) -> tuple[object, list[str]]:
    """The parsed arguments (the string itself if it is no JSON), and what is wrong with them.

    ``schema``: ``type`` (one or a list), ``properties``, ``required``, ``enum``, ``items`` and
    ``additionalProperties`` of JSON Schema, nested objects included; types it doesn't know
    hold for no value.  NaN, infinities (numbers beyond a double, too) and what is nested deeper
    than Python's parser goes aren't JSON here.
    """
    try:
        value = json.loads(arguments) if arguments is not None else {}
        canonical(value)
    except (ValueError, RecursionError):
        return arguments, ["arguments: not JSON"]
    if schema is None:
        return value, ["unknown tool"]
    found: list[str] = []

    def check(at: str, v, s: dict) -> None:
        kinds = s.get("type") or []
        kinds = [kinds] if isinstance(kinds, str) else kinds
        if kinds and not any(k in KINDS and _is(v, k) for k in kinds):
            found.append(f"{at}: not {' or '.join(kinds)}")
            return
        if "enum" in s and not any(v == x and isinstance(v, bool) == isinstance(x, bool) for x in s["enum"]):
            found.append(f"{at}: not in enum")
        if isinstance(v, dict):
            known = s.get("properties", {})
            found.extend(f"{at}: {k} missing" for k in s.get("required", ()) if k not in v)
            if s.get("additionalProperties") is False:
                found.extend(f"{at}: {k} unknown" for k in sorted(set(v) - set(known)))
            for k in sorted(set(v) & set(known)):
                check(f"{at}.{k}", v[k], known[k])
        elif isinstance(v, list) and "items" in s:
            for i, x in enumerate(v):
                check(f"{at}[{i}]", x, s["items"])

    check("arguments", value, schema)
    return value, found


def order(ids: list[str], after: list[list[str]]) -> tuple[list[int], set[int]]:
    """Topological order of calls, earliest place first among the ready; and those on or behind a cycle, last."""
    place = {c: i for i, c in enumerate(ids)}
    needs = [{place[a] for a in own if a in place} for own in after]
    users: list[list[int]] = [[] for _ in ids]
    for i, own in enumerate(needs):
        for j in own:
            users[j].append(i)
    left, out = [len(n) for n in needs], []
    ready = [i for i, n in enumerate(left) if not n]
    while ready:
        i = heapq.heappop(ready)
        out.append(i)
        for j in users[i]:
            left[j] -= 1
            if not left[j]:
                heapq.heappush(ready, j)
    stuck = [i for i in range(len(ids)) if left[i]]
    return out + stuck, set(stuck)


OUT = ("conv_id long, turn long, part int, role string, json string, call_id string, "
       "linked boolean, valid boolean, problems string, copies long")


def format_chats(messages: DataFrame, calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per message and per call's result, as canonical JSON.

    ``messages(conv_id, turn, role, text)``; ``calls(conv_id, turn, seq, call_id, name,
    arguments, after array<string>)``; ``results(call_id, content)``; ``schemas`` by tool.
    ``part`` orders a turn: its messages (0), then a ``tool`` message per call in
    topological order (1, 2, ...).  For those, ``linked`` says whether the call
    has a result (else its content is null), ``valid`` whether nothing is wrong with it,
    and ``problems`` what is: arguments against the schema, an unknown tool, a cycle,
    or a call it waits for that is unknown or comes in a later turn.

    Repeated calls of one id: the first by (conv_id, turn, seq, name, arguments) counts; repeated
    results: the smallest content.  Calls without id, conversation or turn, and results without a call, are
    left out; calls of a turn without messages get their rows.  If a turn repeats messages, its
    calls hang on the first assistant message, else the first.  Null roles and
    texts stay null in the JSON.  Arguments that aren't JSON stand there as a string.  Empty
    tables: no rows of theirs.
    """
    known = calls.filter("call_id is not null and conv_id is not null and turn is not null").select(
        "call_id", F.struct("conv_id", "turn", "seq", "name", "arguments",
                            F.coalesce("after", F.array().cast("array<string>")).alias("after")).alias("c"))
    own = known.groupBy("call_id").agg(F.min("c").alias("c")).select("call_id", "c.*")
    answers = results.filter("call_id is not null").groupBy("call_id").agg(
        F.min(F.struct(F.col("content").isNull().alias("none"), "content")).alias("r"))
    linked = own.join(answers, "call_id", "left").select(
        "*", F.col("r.content").alias("content"), F.col("r").isNotNull().alias("linked")).drop("r")
    waits = (linked.select("call_id", F.col("turn").alias("t"), F.col("conv_id").alias("c"), F.explode("after").alias("a"))
             .join(own.select(F.col("call_id").alias("a"), "conv_id", "turn"), "a", "left"))
    late = waits.groupBy("call_id").agg(F.count_if(
        F.col("turn").isNull() | (F.col("conv_id") != F.col("c")) | (F.col("turn") > F.col("t"))).alias("unmet"))
    linked = linked.join(late, "call_id", "left")
    turn = linked.groupBy("conv_id", "turn").agg(F.sort_array(F.collect_list(F.struct(  # one message's calls
        "seq", "call_id", "name", "arguments", "after", "content", "linked", F.coalesce("unmet", F.lit(0)).alias("unmet")))).alias("calls"))
    said = messages.select("conv_id", "turn", "role", "text").groupBy("conv_id", "turn", "role", "text").agg(
        F.count("*").alias("n")).withColumn("own", F.struct(
            F.coalesce(F.col("role") != "assistant", F.lit(True)).alias("other"), "role", "text"))
    there = F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    head = said.filter(there).groupBy("conv_id", "turn").agg(F.min("own").alias("head")).join(
        turn, ["conv_id", "turn"], "full")
    heads = head.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.col("head").alias("own_"), "calls")
    met = said.join(heads.filter("calls is not null and own_ is not null"), F.expr(
        "conv_id = c and turn = t and own <=> own_"), "left").select("conv_id", "turn", "role", "text", "n", "calls")
    alone = head.filter("head is null").select("conv_id", "turn", F.lit(None).cast("string").alias("role"),
                                               F.lit(None).cast("string").alias("text"), F.lit(0).cast("long").alias("n"), "calls")
    both = met.union(alone).withColumn("conv_id", F.col("conv_id").cast("long")).withColumn("turn", F.col("turn").cast("long"))
    names = [c.split()[0] for c in OUT.split(", ")]

    def rows(r: dict) -> Iterator[tuple]:
        calls_ = r["calls"] or []
        ids = [c["call_id"] for c in calls_]
        ordered, stuck = order(ids, [c["after"] for c in calls_])
        entries, tools = [], []
        for i in ordered:
            c = calls_[i]
            value, wrong = problems(c["arguments"], schemas.get(c["name"]))
            wrong = wrong + ["waits in a cycle"] * (i in stuck) + ["waits for an unknown or later call"] * bool(c["unmet"])
            entries.append({"id": c["call_id"], "type": "function", "function": {"name": c["name"], "arguments": canonical(value)}})
            tools.append((c, wrong))
        message = {"role": r["role"], "content": r["text"]}
        at = (r["conv_id"], r["turn"])
        if entries and r["n"]:
            yield *at, 0, r["role"], canonical(message | {"tool_calls": entries}), None, None, None, None, 1
        if r["n"] > bool(entries):
            yield *at, 0, r["role"], canonical(message), None, None, None, None, r["n"] - bool(entries)
        for k, (c, wrong) in enumerate(tools, 1):
            message = {"role": "tool", "tool_call_id": c["call_id"], "name": c["name"], "content": c["content"]}
            yield *at, k, "tool", canonical(message), c["call_id"], c["linked"], not wrong, "; ".join(wrong), 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.bool_(), pa.bool_(), pa.string(), pa.int64()]
        for b in batches:
            out = [x for r in b.to_pylist() for x in rows(r)]
            cols = zip(*out) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    return both.mapInArrow(run, OUT).withColumn("copy", F.explode(F.expr("sequence(1L, copies)"))).drop("copies", "copy")


#: Tools of the registered query.
SCHEMAS = {
    "search": {"type": "object", "required": ["query"], "additionalProperties": False,
               "properties": {"query": {"type": "string"}, "limit": {"type": "integer"}}},
    "measure": {"type": "object", "required": ["text", "unit"],
                "properties": {"text": {"type": "string"}, "unit": {"type": "string", "enum": ["char", "word"]}}},
}


def stand_in(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results in the schemas above: one call per line of an assistant message.

    Stand-in input only: tool, arguments (some against the schema), what a call
    waits for and which calls have results follow from the line's checksum.
    """
    line = conversations.filter("role = 'assistant'").select(
        "conv_id", "turn", F.posexplode(F.split("text", "\n")).alias("seq", "line")).withColumn("c", F.crc32("line"))
    ident = lambda n: F.concat_ws("_", F.lit("call"), "conv_id", "turn", n)
    search = F.to_json(F.struct(F.col("line").alias("query"), F.when(F.col("c") % 7 != 0, F.size(F.split("line", " "))).alias("limit"),
                                F.when(F.col("c") % 13 == 0, F.lit(1)).alias("page")))
    measure = F.to_json(F.struct(F.when(F.col("c") % 5 == 0, F.lit("line")).otherwise(F.lit("word")).alias("unit"),
                                 F.col("line").alias("text")))
    calls = line.select(
        "conv_id", "turn", "seq", ident("seq").alias("call_id"),
        F.when(F.col("c") % 17 == 0, "guess").when(F.col("c") % 2 == 0, "search").otherwise("measure").alias("name"),
        F.when(F.col("c") % 19 == 0, F.col("line")).when(F.col("c") % 2 == 0, search).otherwise(measure).alias("arguments"),
        F.when(F.col("c") % 3 == 0, F.array(ident((F.col("seq") + 1).cast("string")))).alias("after"), "c", "line")
    results = calls.filter("c % 11 != 0").select("call_id", F.upper("line").alias("content"))
    return calls.drop("c", "line"), results


__all__ = ["canonical", "problems", "order", "format_chats", "stand_in", "SCHEMAS"]
