"""Periodic runs of words, by maximal pairs.

Two places of a text are a maximal pair if the same words follow both, as far as the
common prefix goes, and different words stand before them.  Where the distance ``q``
of a maximal pair is at most the length ``l`` of its common prefix, the ``q + l`` words
from the first place on have the period ``q`` and no neighbouring word keeps it: they
are a run, without any extension.  The pairs come out of the tree of LCP intervals,
bottom-up: a node holds the sorted places that share its prefix, each with the word
left of it; its children's lists are merged, the smaller into the larger, and places
that become neighbours are pairs whose common prefix is the node's.  Places between two
of a pair would give a shorter period, so the pairs of neighbours, and only these, have
the smallest period of their run.

Suffixes are sorted by prefix doubling, places whose first words occur once leave early.
A shortest run has ``min_length`` words, so its pair shares half of them at least: the
tree is built above that depth only.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from surgewatch.llm.common import named

MIN_LENGTH = 12
#: Words of the texts that are sorted together (a longer text is sorted alone).
GROUP_WORDS = 1 << 18


class _Places:
    """Sorted places, in chunks, so that an insertion is cheap however many there are."""
    SIZE = 1024
    __slots__ = ("chunks", "heads", "n")

    def __init__(self, place: int):
        self.chunks, self.heads, self.n = [[place]], [place], 1

    def __iter__(self) -> Iterator[int]:
        return chain.from_iterable(self.chunks)

    def add(self, place: int) -> None:
        k = max(bisect_right(self.heads, place) - 1, 0)
        c = self.chunks[k]
        insort(c, place)
        self.heads[k], self.n = c[0], self.n + 1
        if len(c) > 2 * self.SIZE:
            self.chunks.insert(k + 1, c[self.SIZE:])
            self.heads.insert(k + 1, c[self.SIZE])
            del c[self.SIZE:]

    def around(self, place: int) -> tuple[int | None, int | None]:
        """The neighbours of a place that is in the list."""
        k = bisect_right(self.heads, place) - 1
        c = self.chunks[k]
        i = bisect_left(c, place)
        before = c[i - 1] if i else self.chunks[k - 1][-1] if k else None
        after = c[i + 1] if i + 1 < len(c) else self.chunks[k + 1][0] if k + 1 < len(self.chunks) else None
        return before, after


def _starts(new: np.ndarray) -> np.ndarray:
    """For each element the index where its stretch begins; ``new`` marks beginnings."""
    return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))


def _suffixes(seq: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted places whose first ``least`` words occur again, and the words each shares with
    the one before it (0 at the first of a kind).  ``seq`` ends with a word of its own."""
    n, levels, step = len(seq), [], 1
    active = np.argsort(seq, kind="stable")
    new = np.concatenate([[True], seq[active][1:] != seq[active][:-1]])
    rank = np.empty(n, np.int64)
    rank[active] = _starts(new)
    while True:
        alone = new & np.append(new[1:], True)
        active = active[~alone]
        levels.append((active, rank[active]))  # whose first `step` words occur again
        if not len(active):
            break
        code = rank[active] * n + rank[active + step]
        order = np.argsort(code, kind="stable")
        active, code = active[order], code[order]
        old = rank[active]
        new = np.concatenate([[True], code[1:] != code[:-1]])
        rank[active] = old + _starts(new) - _starts(np.concatenate([[True], old[1:] != old[:-1]]))
        step *= 2
    depth = int(math.log2(least))
    if len(levels) <= depth or not len(levels[depth][0]):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    places = levels[depth][0]
    places = places[np.argsort(rank[places])]
    lcp, label = np.zeros(len(places), np.int64), np.empty(n, np.int64)
    for k in range(len(levels) - 1, -1, -1):
        label[:] = -1
        label[levels[k][0]] = levels[k][1]
        a, b = label[np.minimum(places[:-1] + lcp[1:], n - 1)], label[np.minimum(places[1:] + lcp[1:], n - 1)]
        lcp[1:] += ((a == b) & (a >= 0)).astype(np.int64) << k
    lcp[lcp < least] = 0
    return places, lcp


def _near(places: np.ndarray, lcp: np.ndarray) -> tuple[list[int], list[int]]:
    """Without the trees in which no two places are as near as any prefix is long."""
    kind = np.cumsum(lcp == 0)
    order = np.lexsort((places, kind))
    gaps = np.diff(places[order], prepend=-1)
    gaps[np.diff(kind[order], prepend=-1) != 0] = np.iinfo(np.int64).max
    nearest, longest = np.full(kind[-1] + 1, np.iinfo(np.int64).max), np.zeros(kind[-1] + 1, np.int64)
    np.minimum.at(nearest, kind[order], gaps)
    np.maximum.at(longest, kind, lcp)
    keep = (nearest <= longest)[kind]
    return places[keep].tolist(), lcp[keep].tolist()


def _merge(depth: int, children: list[_Places], left: np.ndarray, least: int, out: list) -> _Places:
    """The node's places; runs among places that became neighbours go to ``out``."""
    base = max(children, key=lambda c: c.n)
    child = {}
    for k, c in enumerate(children):
        if c is not base:
            for place in c:
                child[place] = k
                base.add(place)

    def pair(i, j):
        if j - i <= depth and j - i + depth >= least and left[i] != left[j]:
            out.append((i, j - i + depth, j - i))
    for place, k in child.items():
        before, after = base.around(place)
        if before is not None and child.get(before) != k:
            pair(before, place)
        if after is not None and after not in child:
            pair(place, after)
    return base


def find_runs(seq: np.ndarray, min_length: int = MIN_LENGTH) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of all runs of a sequence of numbers, the last of which occurs once."""
    least = (min_length + 1) // 2
    places, lcp = _suffixes(seq, least)
    if not len(places):
        return []
    places, lcp = _near(places, lcp)
    left = np.concatenate([[-1], seq[:-1]])
    out, stack = [], []  # open nodes: depth, children
    for k, place in enumerate(places):
        done, shared = _Places(place), lcp[k + 1] if k + 1 < len(lcp) else 0
        while stack and stack[-1][0] > shared:
            depth, children = stack.pop()
            done = _merge(depth, [*children, done], left, min_length, out)
        if not shared:
            continue
        if stack and stack[-1][0] == shared:
            stack[-1][1].append(done)
        else:
            stack.append((shared, [done]))
    return out


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    gone = np.cumsum(gone)[:-1] > 0
    return [w for w, g in zip(words, gone) if not g]


def _of_group(texts: list[list[bytes]], min_length: int) -> list[list[tuple[int, int, int]]]:
    """Runs of each text: all are one sequence, in which no two share a word."""
    numbers: dict[bytes, int] = {}
    own = [[numbers.setdefault(w, len(numbers)) for w in t] for t in texts]
    size = len(numbers) + 1
    edges = np.cumsum([0, *[len(t) + 1 for t in texts]])
    seq = np.empty(edges[-1], np.int64)
    for k, (x, at) in enumerate(zip(own, edges)):
        seq[at:at + len(x)] = x
        seq[at + len(x)] = size - 1
        seq[at:at + len(x) + 1] += k * size
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, length, period in find_runs(seq, min_length):
        k = int(np.searchsorted(edges, start, "right")) - 1
        found[k].append((start - int(edges[k]), length, period))
    return [sorted(f, key=lambda r: (r[0], r[2])) for f in found]


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, text_col: str = "text") -> DataFrame:
    """``docs`` and, per row, ``n_words``, ``runs`` (start, length, period; by start, then period) and ``collapsed``.

    Words are stretches without ASCII white space, numbered from 0.  A run is a stretch
    of at least ``min_length`` words and two periods, of smallest period ``period``, that
    no neighbouring word extends.  ``collapsed``: the words, joined by one space, without
    those that a run holds after its first period.  A null or empty text has no words, no
    runs and collapses to an empty text.  Rows may repeat; columns of these names are
    replaced, all others kept.  Empty table: no rows.
    """
    spans = "array<struct<start: long, length: long, period: long>>"
    kept = named(docs, "n_words", "runs", "collapsed")
    rows = docs.select(F.struct(*kept, F.lit(None).cast("boolean").alias("_")).alias("row"),
                       F.col(text_col).cast("string").cast("binary").alias("text"))
    runs_type = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = 0
            while at < b.num_rows:
                texts, size, lo = [], 0, at
                while at < b.num_rows and (not texts or size < GROUP_WORDS):
                    texts.append((b.column(1)[at].as_py() or b"").split())  # ASCII white space
                    size, at = size + len(texts[-1]), at + 1
                runs = _of_group(texts, min_length)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, at - lo), pa.array([len(w) for w in texts], pa.int64()),
                     pa.array([[dict(zip(("start", "length", "period"), r)) for r in x] for x in runs], runs_type),
                     pa.array([b" ".join(_collapsed(w, r) if r else w).decode() for w, r in zip(texts, runs)], pa.string())],
                    names=["row", "n_words", "runs", "collapsed"])
    schema = T.StructType([rows.schema["row"], *T.StructType.fromDDL(f"n_words long, runs {spans}, collapsed string").fields])
    found = rows.mapInArrow(run, schema)
    return found.select(*[F.col("row")[f.name].alias(f.name) for f in rows.schema["row"].dataType.fields[:-1]],
                        "n_words", "runs", "collapsed")


__all__ = ["find_runs", "periodic_runs", "MIN_LENGTH"]
