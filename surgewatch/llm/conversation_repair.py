"""Repair of conversations: the cheapest edits after which roles alternate.

A conversation is right if its roles' initials read ``(s?(ua)+)?``.  Edits: keep a
message, give it the other role, delete it, insert an empty one.  The costs to go, from
each of the four states of that pattern, form a vector; less its smallest entry it is one
of a few, so what a block of ``BLOCK`` messages does to it is looked up in a table over
all blocks and vectors (Four Russians), made once.  Blocks are processed from the last
to the first; then, in the other direction, each block is expanded to its messages'
vectors and the edits are traced, at every step the first in ASCII order that loses
nothing, which gives the least of all cheapest edit strings.

Conversations of any length are cut into parts of ``PART`` messages.  A part is a function
of the vector after it, and these functions are chained over a conversation's parts; then
each part is traced, from every state, by itself, and the parts' states are chained.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from surgewatch.llm.common import SPACES, cut

BLOCK, PART = 4, 4096
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: States: nothing yet, after s, after u, after a.  The role that must or may come next, and where it leads.
NOTHING, AFTER_S, AFTER_U, AFTER_A = range(4)
NEXT = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
ROLE_TO = {AFTER_U: "user", AFTER_A: "assistant"}
#: Where a message that keeps its role (s, u, a, other) leads from each state.
KEPT = ((AFTER_S, None, None, None), (AFTER_U, AFTER_U, None, AFTER_U), (None, None, AFTER_A, None), (None,) * 4)
#: Symbols: role (s, u, a, other) + 4 if truncated; must go; no message.
GONE, NONE, SYMBOLS = 8, 9, 10
#: Costs to go after the last message.
AT_END = (0, 4, 2, 0)


def _steps(symbol: int, state: int) -> Iterator[tuple[str, int, int]]:
    """Edits of a message in ASCII order: letter, cost, next state."""
    yield "D", DELETE, state
    if symbol != GONE:
        late = TRUNCATED * (symbol >= 4)
        if KEPT[symbol % 4][state] is not None:
            yield "K", KEEP + late, KEPT[symbol % 4][state]
        yield "R", REROLE + late, NEXT[state]


def _before(symbol: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs to go before a message from those after it."""
    if symbol == NONE:
        return after
    v = [min(cost + after[to] for _, cost, to in _steps(symbol, s)) for s in range(4)]
    for _ in range(2):  # two insertions lead from any state to any that comes again
        v = [min(v[s], INSERT + v[NEXT[s]]) for s in range(4)]
    return tuple(v)


class _Tables(NamedTuple):
    vectors: list[tuple[int, ...]]  # normalised: the smallest entry is 0; the first is AT_END
    step: np.ndarray   # [vector, symbol] -> vector before
    cost: np.ndarray   # and what was taken off
    block: np.ndarray  # [vector, block] -> vector before the block
    total: np.ndarray


@functools.cache
def _tables() -> _Tables:
    vectors, number, k = [AT_END], {AT_END: 0}, 0
    step, cost = [], []
    while k < len(vectors):
        step.append([]), cost.append([])
        for symbol in range(SYMBOLS):
            v = _before(symbol, vectors[k])
            least = min(v)
            v = tuple(x - least for x in v)
            if v not in number:
                number[v] = len(vectors)
                vectors.append(v)
            step[k].append(number[v]), cost[k].append(least)
        k += 1
    step, cost = np.array(step), np.array(cost)
    block, total = np.arange(len(vectors))[:, None], np.zeros((len(vectors), 1), np.int64)
    for _ in range(BLOCK):  # one more symbol before those that the code has
        wide = block[:, None, :] + np.zeros((1, SYMBOLS, 1), np.int64)
        more = cost[wide, np.arange(SYMBOLS)[None, :, None]]
        total = (total[:, None, :] + more).reshape(len(vectors), -1)
        block = step[wide, np.arange(SYMBOLS)[None, :, None]].reshape(len(vectors), -1)
    return _Tables(vectors, step, cost, block, total)


def _codes(symbols: np.ndarray) -> np.ndarray:
    """Blocks of a part; what is missing in the last one is no message."""
    whole = np.full(-(-len(symbols) // BLOCK) * BLOCK, NONE, np.int64)
    whole[:len(symbols)] = symbols
    return whole.reshape(-1, BLOCK) @ SYMBOLS ** np.arange(BLOCK - 1, -1, -1)


def transitions(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What a part does to each vector after it: the vector before it, and the cost taken off."""
    t = _tables()
    v, cost = np.arange(len(t.vectors)), np.zeros(len(t.vectors), np.int64)
    for code in _codes(symbols)[::-1]:
        cost += t.total[v, code]
        v = t.block[v, code]
    return v, cost


def trace(symbols: np.ndarray, end: int, state: int, last: bool) -> tuple[str, str, int]:
    """Edits of a part from ``state``, where the vector after it is ``end``, the roles that they give
    (u, a, its own, none), and the state after it."""
    t, codes, roles = _tables(), _codes(symbols), []
    after = [end]
    for code in codes[::-1]:
        after.append(int(t.block[after[-1], code]))
    after, out = after[-2::-1], []  # the vectors after each block
    for k, v in enumerate(after):
        own = symbols[k * BLOCK:(k + 1) * BLOCK].tolist()
        vs = [v]
        for symbol in own[::-1]:
            vs.append(int(t.step[vs[-1], symbol]))
        vs.reverse()
        for i, symbol in enumerate(own):
            here, there, off = t.vectors[vs[i]], t.vectors[vs[i + 1]], int(t.cost[vs[i + 1], symbol])
            while True:
                best = [(x, to) for x, cost, to in _steps(symbol, state) if cost + there[to] == here[state] + off]
                if here[state] == INSERT + here[NEXT[state]] and (not best or best[0][0] != "D"):
                    out.append("I")
                    state = NEXT[state]
                    roles.append(ROLE_TO[state][0])
                else:
                    break
            edit, state = best[0]
            out.append(edit)
            roles.append({"D": "-", "K": "=", "R": ROLE_TO.get(state, "-")[0]}[edit])
    while last and state not in (NOTHING, AFTER_A):
        out.append("I")
        state = NEXT[state]
        roles.append(ROLE_TO[state][0])
    return "".join(out), "".join(roles), state


# -- Spark -----------------------------------------------------------------------------

def _ordered(df: DataFrame, *cols: Column) -> DataFrame:
    """Rows of a conversation in one partition, in order."""
    return df.repartition("conv").sortWithinPartitions(F.col("conv").asc_nulls_first(), *cols)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns))


def _in_batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    for some in iter(lambda: list(itertools.islice(rows, size)), []):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), schema)], schema=schema)


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows with their part and place in it."""
    from pyspark import TaskContext
    part, k, conv = (TaskContext.get().partitionId() << 32) - 1, PART, None
    for b in batches:
        parts, places = [], []
        for c in b.column(0).to_pylist():
            if k == PART or c != conv:
                part, k, conv = part + 1, 0, c
            parts.append(part), places.append(k)
            k += 1
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(parts, pa.int64()), pa.array(places, pa.int32())],
                                         names=[*b.schema.names, "part", "k"])


FUNCTIONS = pa.schema([("conv", pa.int64()), ("part", pa.int64()), ("symbols", pa.binary()), ("illegal", pa.int64()),
                       ("first", pa.string()), ("last", pa.string()), ("to", pa.list_(pa.int64())), ("cost", pa.list_(pa.int64()))])


def _functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for conv, part, own in _rows(batches):
            symbols, initials = np.array([x["symbol"] for x in own], np.uint8), [x["initial"] for x in own]
            to, cost = transitions(symbols)
            illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
            yield conv, part, symbols.tobytes(), illegal, initials[0], initials[-1], to.tolist(), cost.tolist()
    return _in_batches(rows(), FUNCTIONS)


ENDS = pa.schema([("conv", pa.int64()), ("part", pa.int64()), ("symbols", pa.binary()), ("end", pa.int64()),
                  ("is_last", pa.bool_()), ("is_first", pa.bool_()), ("cost", pa.int64())])


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts from a conversation's last to its first: the vector after each; its cost before it."""
    def rows():
        last, v, total = (), 0, 0
        for conv, part, symbols, to, cost, is_first in _rows(batches):
            new = last != (conv,)
            if new:
                last, v, total = (conv,), 0, 0
            end, total, v = v, total + cost[v], to[v]
            yield conv, part, symbols, end, new, is_first, total + _tables().vectors[v][NOTHING]
    return _in_batches(rows(), ENDS)


TRACES = pa.schema([("conv", pa.int64()), ("part", pa.int64()), ("is_first", pa.bool_()), ("cost", pa.int64()),
                    ("edits", pa.list_(pa.string())), ("roles", pa.list_(pa.string())), ("to", pa.list_(pa.int64()))])


def _traces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every part's edits from each state it may begin in."""
    def rows():
        for conv, part, symbols, end, is_last, is_first, cost in _rows(batches):
            own = [trace(np.frombuffer(symbols, np.uint8), end, s, is_last) for s in range(1 if is_first else 4)]
            yield conv, part, is_first, cost, *map(list, zip(*own))
    return _in_batches(rows(), TRACES)


CHOSEN = pa.schema([("conv", pa.int64()), ("part", pa.int64()), ("is_first", pa.bool_()), ("cost", pa.int64()),
                    ("audit", pa.string()), ("kept", pa.list_(pa.struct([("k", pa.int32()), ("role", pa.string())])))])


def _chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts in order: the edits from the state that the part before leads to, and the
    messages they leave: place (null: inserted) and new role (null: its own)."""
    names = {r[0]: r for r in ROLE_TO.values()}

    def rows():
        state = NOTHING
        for conv, part, is_first, cost, edits, roles, to in _rows(batches):
            state = NOTHING if is_first else state
            k, kept = 0, []
            for edit, role in zip(edits[state], roles[state]):
                if edit != "D":
                    kept.append({"k": None if edit == "I" else k, "role": names.get(role)})
                k += edit != "I"
            yield conv, part, is_first, cost, edits[state], kept
            state = to[state]
    return _in_batches(rows(), CHOSEN)


class Repair(NamedTuple):
    conversations: DataFrame
    messages: DataFrame


def _ddl(schema: pa.Schema) -> T.StructType:
    from pyspark.sql.pandas.types import from_arrow_schema
    return from_arrow_schema(schema)


def repair(messages: DataFrame) -> Repair:
    """Faults and cheapest repair of ``messages(conv_id, turn, role, text)``.

    ``conversations``: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit``, one row
    per conversation; ``messages``: ``conv_id, part, seq, role, text``, in this order the repaired ones.

    A conversation's messages go by turn (nulls first), those of one turn by the order of the
    rows.  The first fault of each counts: blank (no character but ASCII white space), duplicate
    (role and text came earlier), truncated (the last such character isn't one of ``.!?``).  Blank
    and duplicate messages must go.  ``illegal``: neighbours whose initials aren't su, ua or au.
    ``gaps``: turns missing between the first and the last.  ``audit``: the edits' initials in order
    (Keep, Rerole, Delete, Insert), of the cheapest the first in ASCII order.

    A null role or text is one space.  An empty role has no initial: it can't be kept, nor stand
    legally beside another.  Messages without a conversation are one conversation.  Repeated rows
    are duplicates.  Empty table: no rows.  Extra columns are not read.
    """
    text, role = F.coalesce(F.col("text").cast("string"), F.lit(" ")), F.coalesce(F.col("role").cast("string"), F.lit(" "))
    own = cut(messages.select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
                              role.alias("role"), text.alias("text"), F.monotonically_increasing_id().alias("row")))
    spark = messages.sparkSession
    order = [F.col(c).asc_nulls_first() for c in ("conv", "turn", "row")]
    bare = F.rtrim(F.col("text"), F.lit(SPACES))
    initial = F.substring("role", 1, 1)
    sorted_rows = own.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order) \
        .sortWithinPartitions(*order).select(
            "conv", "turn", "role", "text", initial.alias("initial"), F.xxhash64("role", "text").alias("h1"),
            F.xxhash64(F.lit(1), "text", "role").alias("h2"), (F.length(bare) == 0).alias("blank"),
            (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("truncated"))
    schema = T.StructType([*sorted_rows.schema, T.StructField("part", T.LongType()), T.StructField("k", T.IntegerType())])
    rows = cut(sorted_rows.mapInArrow(_numbered, schema))
    repeated = rows.groupBy("conv", "h1", "h2").agg(F.min(F.struct("part", "k")).alias("first"), F.count("*").alias("n")) \
        .filter("n > 1").select(F.col("conv").alias("c"), F.col("h1").alias("x1"), F.col("h2").alias("x2"), "first")
    late = F.coalesce(F.struct("part", "k") != F.col("first"), F.lit(False))
    seen = rows.drop("role", "text").join(
        repeated, F.col("conv").eqNullSafe(F.col("c")) & (F.col("h1") == F.col("x1")) & (F.col("h2") == F.col("x2")), "left")
    kind = F.when(F.col("initial") == "s", 0).when(F.col("initial") == "u", 1).when(F.col("initial") == "a", 2).otherwise(3)
    faults = seen.select("conv", "part", "k", "turn", "initial", "blank", (late & ~F.col("blank")).alias("duplicate"),
                         (F.col("truncated") & ~late & ~F.col("blank")).alias("truncated"))
    symbol = F.when(F.col("blank") | F.col("duplicate"), GONE).otherwise(kind + F.when(F.col("truncated"), 4).otherwise(0))
    parts = faults.groupBy("conv", "part").agg(
        F.sort_array(F.collect_list(F.struct("k", symbol.alias("symbol"), "initial"))).alias("own"),
        F.count_if("blank").alias("blank"), F.count_if("duplicate").alias("duplicate"),
        F.count_if("truncated").alias("truncated"), F.min("turn").alias("lo"), F.max("turn").alias("hi"))
    parts = cut(parts)
    functions = cut(parts.select("conv", "part", "own").mapInArrow(_functions, _ddl(FUNCTIONS)))
    before = Window.partitionBy("conv").orderBy("part")  # of parts
    functions = functions.withColumn("before", F.lag("last").over(before)).withColumn(
        "is_first", F.row_number().over(before) == 1)
    across = F.col("before").isNotNull() & ~F.concat("before", "first").isin("su", "ua", "au")
    functions = cut(functions.withColumn("illegal", F.col("illegal") + across.cast("long")))
    ends = _ordered(functions.select("conv", "part", "symbols", "to", "cost", "is_first"), F.col("part").desc()) \
        .mapInArrow(_ends, _ddl(ENDS))
    traces = ends.repartition("conv", "part").mapInArrow(_traces, _ddl(TRACES))
    chosen = cut(_ordered(traces, F.col("part")).mapInArrow(_chosen, _ddl(CHOSEN)))
    turns = rows.filter("turn is not null").groupBy("conv", "turn").agg(F.lit(1).alias("one")).groupBy("conv").agg(
        F.count("*").alias("turns"))
    counts = parts.groupBy("conv").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
                                       F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    illegal = functions.groupBy("conv").agg(F.sum("illegal").alias("illegal"))
    audits = chosen.groupBy("conv").agg(
        F.max(F.when(F.col("is_first"), F.col("cost"))).alias("cost"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    found = counts
    for other in (turns, illegal, audits):
        other = other.withColumnRenamed("conv", "c")
        found = found.join(other, F.col("conv").eqNullSafe(F.col("c")), "left").drop("c")
    gaps = F.coalesce(F.col("hi") - F.col("lo") + 1 - F.col("turns"), F.lit(0))
    long = lambda c: F.col(c).cast("long").alias(c)
    conversations = found.select(F.col("conv").alias("conv_id"), gaps.cast("long").alias("gaps"),
                                 *map(long, ("blank", "duplicate", "truncated", "illegal", "cost")), "audit")
    left = chosen.select("conv", "part", F.posexplode("kept").alias("seq", "x")).select(
        "conv", "part", "seq", F.col("x.k").alias("k"), F.col("x.role").alias("new"))
    texts = rows.select(F.col("part").alias("p"), F.col("k").alias("kk"), "role", "text")
    repaired = left.join(texts, (F.col("part") == F.col("p")) & (F.col("k") == F.col("kk")), "left").select(
        F.col("conv").alias("conv_id"), "part", "seq", F.coalesce("new", "role").alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    return Repair(conversations, repaired)


def digest(messages: DataFrame) -> DataFrame:
    """``conv_id, sha256`` of a conversation's repaired ``role:text``, newline-joined; read message by
    message, none is held."""
    import hashlib
    line = F.concat_ws(":", "role", "text").cast("binary")
    own = _ordered(messages.select(F.col("conv_id").alias("conv"), "part", "seq", line.alias("line")), F.col("part"), F.col("seq"))
    schema = pa.schema([("conv_id", pa.int64()), ("sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            conv, sha = (), None
            for c, _, _, text in _rows(batches):
                if (c,) != conv:
                    if sha:
                        yield conv[0], sha.hexdigest()
                    conv, sha = (c,), hashlib.sha256(text)
                else:
                    sha.update(b"\n" + text)
            if sha:
                yield conv[0], sha.hexdigest()
        return _in_batches(rows(), schema)
    return own.mapInArrow(run, _ddl(schema))


__all__ = ["transitions", "trace", "repair", "digest", "Repair"]
