"""Conversation repair against a search over all edits."""
import functools
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from surgewatch.llm import conversation_repair as module
from surgewatch.llm.conversation_repair import digest, repair
from surgewatch.llm.queries import op13_conversation_repair

SHA_OF_NOTHING = hashlib.sha256(b"").hexdigest()


def faults(rows):
    """First fault of each (role, text), in order."""
    seen, out = set(), []
    for role, text in rows:
        bare = re.sub(r"[\x20\x09-\x0D]", "", text)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(initials, found):
    """(cost, audit, kept): the least by cost, then by audit, over all edits; states as in the pattern (s?(ua)+)?."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    n = len(initials)

    @functools.cache
    def best(i, state, inserted):
        options = []
        if i == n and state in ("", "a"):
            options.append((0, "", ()))
        if i < n:
            c, a, k = best(i + 1, state, 0)
            options.append((c + 3, "D" + a, k))
            if found[i] not in ("blank", "duplicate"):
                late = found[i] == "truncated"
                to = step.get((state, initials[i]))
                if to:
                    c, a, k = best(i + 1, to, 0)
                    options.append((c + late, "K" + a, ((i, None), *k)))
                for role in "ua":
                    if (state, role) in step:
                        c, a, k = best(i + 1, step[state, role], 0)
                        options.append((c + 2 + late, "R" + a, ((i, role), *k)))
        if inserted < 3:
            for role in "ua":
                if (state, role) in step:
                    c, a, k = best(i, step[state, role], inserted + 1)
                    options.append((c + 2, "I" + a, ((None, role), *k)))
        return min(options, key=lambda x: x[:2]) if options else (10 ** 9, "", ())
    return best(0, "", 0)


def expected(rows):
    """Result columns of one conversation: rows of (turn, role, text) in order."""
    own = [(r, t) for _, r, t in rows]
    found, turns = faults(own), [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for r, _ in own]
    cost, audit, kept = cheapest(tuple(initials), tuple(found)) if rows else (0, "", ())
    full = {"u": "user", "a": "assistant"}
    lines = [f"{full.get(role) or own[i][0]}:{own[i][1] if i is not None else ''}" for i, role in kept]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[found.count(x) for x in ("blank", "duplicate", "truncated")],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def damage(rows):
    text = lambda x: " " if x is None else str(x)
    by = {}
    for conv, turn, role, t in rows:
        own, fault = by.setdefault(conv, []), zlib.crc32(f"{text(conv)}:{text(turn)}".encode()) % 20
        role, t = text(role), text(t)
        t = "" if fault == 1 else re.sub("[.!?]", "", t) if fault == 2 else t
        own += [(turn, "user" if fault == 4 else role, t)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return {c: in_order(x) for c, x in by.items()}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_brute_force(spark, load, sf):
    want = damage(load("conversations", sf, "conv_id, turn, role, text"))
    rows = op13_conversation_repair(spark, f"/root/testdata/{sf}").collect()
    assert len(rows) == len(want)
    for r in rows:
        assert tuple(r[c] for c in COLUMNS) == expected(want[r.conv_id]), r.conv_id


def test_null_rows(spark, tmp_path):
    rows = [(None, 1, "user", "Hi."), (None, None, None, None), (1, None, "user", None), (1, 3, "user", "A!"), (1, 3, "user", "A!"),
            (2, 1, "", "x."), (2, 2, "user", "y."), *[(c, t, "user", "z.") for c in range(100, 160) for t in range(1)]]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1).write.parquet(
        f"{tmp_path}/conversations.parquet")
    want = damage(rows)
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in op13_conversation_repair(spark, str(tmp_path)).collect()}
    assert got.keys() == want.keys() and any(not w for w in want.values())
    for c, w in want.items():
        assert got[c] == expected(w), c
    dropped = next(c for c, w in want.items() if not w)
    assert got[dropped] == (0, 0, 0, 0, 0, 0, "", SHA_OF_NOTHING)


@pytest.mark.parametrize("part", [1, 5, 4096])
def test_parts_of_random_conversations(spark, monkeypatch, part):
    monkeypatch.setattr(module, "PART", part)
    r = random.Random(part)
    rows = [(c, r.choice([None, i, i, 2 * i]), r.choice(["system", "user", "user", "assistant", "assistant", "tool"]),
             r.choice(["", " \t", "a.", "b!", "c", "d?", "e.", "f.", "g", f"{r.random()}."]))
            for c in range(60) for i in range(r.randrange(1, 17))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1)
    found, repaired = repair(df)
    sha = {x.conv_id: x.sha256 for x in digest(repaired).collect()}
    by = {}
    for c, *x in rows:
        by.setdefault(c, []).append(tuple(x))
    for x in found.collect():
        got = tuple(x[c] for c in COLUMNS[:-1]) + (sha.get(x.conv_id, SHA_OF_NOTHING),)
        assert got == expected(in_order(by[x.conv_id])), x.conv_id


def test_tables_against_single_steps():
    t = module._tables()
    assert len(t.vectors) < 100 and all(min(v) == 0 for v in t.vectors)
    r = random.Random(1)
    for n in (0, 1, 3, 4, 5, 30):
        symbols = np.array([r.randrange(9) for _ in range(n)], np.uint8)
        to, cost = module.transitions(symbols)
        for v, vector in enumerate(t.vectors):
            for s in symbols[::-1].tolist():
                vector = module._before(s, vector)
            assert tuple(x + cost[v] for x in t.vectors[to[v]]) == vector


def test_hot_conversation_and_empty_table(spark, monkeypatch):
    monkeypatch.setattr(module, "PART", 64)
    df = spark.range(3000).selectExpr("if(id % 3 = 0, id, 7) conv_id", "id div 2 turn", "if(id % 2 = 0, 'user', 'assistant') role",
                                      "concat('text ', id, '.') text", "'x' part", "1 k", "'y' conv")
    found, repaired = repair(df)
    hot = found.filter("conv_id = 7").first()
    rows = in_order([(x // 2, "user" if x % 2 == 0 else "assistant", f"text {x}.") for x in range(3000) if x % 3 or x == 7])
    import sys
    sys.setrecursionlimit(100_000)
    assert tuple(hot[c] for c in COLUMNS[:-1]) == expected(rows)[:-1]
    assert repaired.filter("conv_id = 7").count() == len(hot.audit) - hot.audit.count("D")
    empty = repair(df.limit(0))
    assert empty.conversations.collect() == [] == empty.messages.collect() == digest(empty.messages).collect()
