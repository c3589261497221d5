"""SimHash near-duplicates found through a Gray-order hierarchical index.

Fingerprints within ``bits`` of each other agree on whole blocks: with 64 bits
cut into ``blocks`` blocks, ``bits`` differences leave at least
``blocks - bits`` blocks untouched.  Each choice of that many blocks is one
*table*, and its masked bits are the pattern of the index's top node, which
links must share exactly.  Under a top node the fingerprints are sorted by the
Gray rank of their other bits and cut into chunks.  Inside a chunk, runs of
``LEAF`` neighbours form leaf nodes and ``FAN`` nodes a higher node; a node
keeps the bits all its members share (mask and pattern) that its parent does
not keep.  A search adds up a query's differences from the nodes on its path
and drops a whole group as soon as the sum exceeds ``bits``.

Chunks bound what one task holds: a top node with more members spans several
chunks, and pairs of those chunks are joined (again only where their shared
patterns differ in at most ``bits`` bits).  A task returns a spanning star of
the links it found, not the pairs, so copies cost one row each.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from surgewatch.llm.common import cut, fresh, named
from surgewatch.llm.graph import components

SEED = 42
LEAF, FAN = 16, 16
#: Members of a chunk, and shingles hashed at a time.
CHUNK, BLOCK = 2048, 1 << 16


# --- fingerprints ---------------------------------------------------------------------------

def fingerprint(text: bytes, k: int) -> int:
    """SimHash of the lower-cased (A-Z) UTF-8 text over ``k``-word shingles; no words: 0."""
    ws = text.lower().split()
    if not ws:
        return 0
    joined = b" ".join(ws)
    size = np.fromiter(map(len, ws), np.int64, len(ws))
    start = np.cumsum(size + 1) - size - 1
    n = max(1, len(ws) - k + 1)
    last = start[k - 1:] + size[k - 1:] if len(ws) >= k else np.array([len(joined)])
    ones = np.zeros(64, np.int64)
    h = xxhash.xxh64_intdigest
    for lo in range(0, n, BLOCK):
        hs = [h(joined[s:e], SEED) for s, e in zip(start[lo:min(n, lo + BLOCK)].tolist(),
                                                   last[lo:lo + BLOCK].tolist())]
        bits = np.unpackbits(np.array(hs, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, k: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text_id, fp long)`` per row, ``text_id`` the text's hash; null text counts as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t or b"", k) for t in b.column(1).cast(pa.binary()).to_pylist()),
                              np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(fps.view(np.int64))],
                                             ["doc_id", "text_id", "fp"])
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_id")) \
        .mapInArrow(run, "doc_id long, text_id long, fp long")


# --- the index ------------------------------------------------------------------------------

def _masks(blocks: int, bits: int) -> list[int]:
    """One mask per choice of ``blocks - bits`` blocks of the 64 bits."""
    if not 0 < bits < blocks <= 64:
        raise ValueError("bits must be positive and blocks in bits+1..64")
    edge = [64 * i // blocks for i in range(blocks + 1)]
    part = [((1 << edge[i + 1]) - 1) ^ ((1 << edge[i]) - 1) for i in range(blocks)]
    return [sum(c) for c in itertools.combinations(part, blocks - bits)]


def _gray_rank(c: Column) -> Column:
    for s in (1, 2, 4, 8, 16, 32):
        c = c.bitwiseXOR(F.shiftrightunsigned(c, s))
    return c


def _star(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest linked index of each of ``n`` items, given links a-b."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


class Index:
    """Hierarchical nodes over fingerprints in Gray order."""

    def __init__(self, fps: np.ndarray):
        self.fps, self.levels = fps, []
        low, high, size = fps, fps, LEAF
        while True:
            cuts = np.arange(0, len(low), size)
            low, high = np.bitwise_and.reduceat(low, cuts), np.bitwise_or.reduceat(high, cuts)
            self.levels.append((~(low ^ high), low))
            if len(low) <= 1:
                break
            size = FAN

    def search(self, queries: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, member) index pairs at ``bits`` or fewer differences."""
        q = np.arange(len(queries))
        node, acc, above = np.zeros(len(q), np.int64), np.zeros(len(q), np.int64), np.zeros(len(q), np.uint64)
        for depth, (mask, pattern) in enumerate(reversed(self.levels)):
            # bits that this node shares and its parent didn't
            acc = acc + np.bitwise_count((queries[q] ^ pattern[node]) & mask[node] & ~above)
            keep = acc <= bits
            q, node, acc = q[keep], node[keep], acc[keep]
            below = len(self.levels[-depth - 2][0]) if depth + 1 < len(self.levels) else len(self.fps)
            fan = FAN if depth + 1 < len(self.levels) else LEAF
            above = np.repeat(mask[node], fan)
            node = (node[:, None] * fan + np.arange(fan)).ravel()
            q, acc = np.repeat(q, fan), np.repeat(acc, fan)
            there = node < below
            q, node, acc, above = q[there], node[there], acc[there], above[there]
        near = np.bitwise_count(queries[q] ^ self.fps[node]) <= bits
        return q[near], node[near]


def _pairs_within(top: np.ndarray, fps: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between members of the same top node; rows come sorted by (top, Gray rank)."""
    n = len(fps)
    start = np.flatnonzero(np.r_[True, top[1:] != top[:-1]])
    size = np.diff(np.r_[start, n])
    small = np.repeat(size <= 4 * LEAF, size)
    a, b = [], []
    for d in range(1, 4 * LEAF):  # neighbours d apart
        i = np.flatnonzero((top[d:] == top[:-d]) & small[d:]) if d < n else np.array([], np.int64)
        if not len(i):
            break
        i = i[np.bitwise_count(fps[i] ^ fps[i + d]) <= bits]
        a.append(i)
        b.append(i + d)
    for s, m in zip(start[size > 4 * LEAF], size[size > 4 * LEAF]):
        own = fps[s:s + m]
        index = Index(own)
        for lo in range(0, m, CHUNK):
            q, t = index.search(own[lo:lo + CHUNK], bits)
            q = q + lo
            a.append(s + t[t < q])
            b.append(s + q[t < q])
    join = lambda x: np.concatenate(x) if x else np.array([], np.int64)
    return join(a), join(b)


FOUND = "a long, b long, t int, key long, chunk long, mask long, pattern long, fps binary"


def _found(a=(), b=(), chunks=()) -> pa.RecordBatch:
    i64 = lambda x: np.asarray(x, np.uint64).view(np.int64)
    none = [None] * len(a)
    cols = list(zip(*chunks)) if chunks else [[]] * 6
    return pa.RecordBatch.from_arrays(
        [pa.array(np.r_[i64(a), np.zeros(len(chunks), np.int64)]),
         pa.array(np.r_[i64(b), np.zeros(len(chunks), np.int64)])]
        + [pa.array([*none, *c], t) for c, t in zip(cols, [pa.int32(), *[pa.int64()] * 4, pa.binary()])],
        ["a", "b", "t", "key", "chunk", "mask", "pattern", "fps"])


def _scan(bits: int):
    """Per sorted partition: stars of the links inside chunks, and the chunks of top nodes that may go on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        number = itertools.count(TaskContext.get().partitionId() << 32)
        held = None

        def close(t, key, fps, open_until):
            """Rows up to the last top node's start (or all); ``open_until``: that node goes on."""
            top = np.r_[True, (t[1:] != t[:-1]) | (key[1:] != key[:-1])].cumsum()
            a, b = _pairs_within(top, fps, bits)
            label = _star(len(fps), a, b)
            i = np.flatnonzero(label != np.arange(len(fps)))
            keep = []
            for s, e in ((0, int(np.searchsorted(top, 1, "right"))), (int(np.searchsorted(top, top[-1])), len(fps))):
                at_edge = (s == 0 and first_open) or (e == len(fps) and open_until)
                if at_edge and (not keep or keep[-1][0] != s):
                    keep.append((s, e))
            chunks = []
            for s, e in keep:
                for lo in range(s, e, CHUNK):
                    own = fps[lo:min(e, lo + CHUNK)]
                    low, high = np.bitwise_and.reduce(own), np.bitwise_or.reduce(own)
                    chunks.append((int(t[s]), int(key[s]), next(number), int((~(low ^ high)).view(np.int64)),
                                   int(low.view(np.int64)), own.astype("<u8").tobytes()))
            return _found(fps[i], fps[label[i]], chunks)

        first_open = True  # the partition's first top node may have begun in the one before
        for batch in batches:
            rows = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            rows[2] = rows[2].view(np.uint64)
            held = rows if held is None else [np.r_[x, y] for x, y in zip(held, rows)]
            while len(held[2]) >= CHUNK * 8:
                t, key, fps = (x[:CHUNK * 8] for x in held)
                change = np.flatnonzero((t[1:] != t[:-1]) | (key[1:] != key[:-1]))
                # end at a top node's end if there is one
                stop = int(change[-1]) + 1 if len(change) else len(fps)
                goes_on = not len(change)
                yield close(t[:stop], key[:stop], fps[:stop], goes_on)
                held = [x[stop:] for x in held]
                first_open = goes_on
        if held is not None and len(held[2]):
            yield close(*held, True)
    return run


def _between(bits: int):
    """Links between two chunks of one top node."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                q, m = Index(y).search(x, bits)
                both = np.r_[x, y]
                label = _star(len(both), q, m + len(x))
                i = np.flatnonzero(label != np.arange(len(both)))
                yield _found(both[i], both[label[i]])
    return run


def near_links(fps: DataFrame, bits: int = 4, blocks: int | None = None) -> DataFrame:
    """``(a, b)`` links that connect all fingerprints at ``bits`` or fewer differences.

    ``fps``: distinct longs in column ``fp``.  The rows are spanning stars: two
    fingerprints within ``bits`` are connected by them, and every row joins two
    fingerprints that a chain of such links connects.
    """
    masks = _masks(blocks or bits + 2, bits)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    rows = (fps.select("fp", F.posexplode(F.array(*[F.lit(m).cast("long") for m in signed])).alias("t", "mask"))
            .select("t", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp",
                    _gray_rank(F.col("fp").bitwiseAND(F.bitwise_not(F.col("mask")))).alias("rank"))
            .repartitionByRange("t", "key", "rank").sortWithinPartitions("t", "key", "rank")
            .select("t", "key", "fp"))
    found = cut(rows.mapInArrow(_scan(bits), FOUND))
    chunk = found.filter("chunk is not null")
    other = chunk.select("t", "key", *[F.col(c).alias(f"{c}2") for c in ("chunk", "mask", "pattern", "fps")])
    differ = F.bit_count(F.col("pattern").bitwiseXOR(F.col("pattern2"))
                         .bitwiseAND(F.col("mask")).bitwiseAND(F.col("mask2")))
    across = (chunk.join(other, ["t", "key"]).filter((F.col("chunk") < F.col("chunk2")) & (differ <= bits))
              .select("fps", "fps2").mapInArrow(_between(bits), FOUND))
    return found.filter("chunk is null").select("a", "b").union(across.select("a", "b")).distinct()


def _groups(docs: DataFrame, k: int, bits: int, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, text_id, fp, low)`` per row; ``low``: the group's first ``(id, text_id)``, null ids last."""
    own = cut(fingerprints(docs, k, id_col, text_col))
    low = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_id"))
    rep = cut(own.groupBy("fp").agg(low.alias("low")))
    root = cut(components(near_links(rep.select("fp"), bits)))
    linked = rep.join(root.withColumnRenamed("node", "fp"), "fp")
    group = linked.groupBy("root").agg(F.min("low").alias("group_low"))
    named = linked.join(group, "root").select("fp", "group_low")
    # cut, so that the last join reads plain exchanges and a hot fingerprint's rows can be split
    least = cut(rep.join(named, "fp", "left").select("fp", F.coalesce("group_low", "low").alias("low")))
    return own.join(least, "fp")


def simhash_groups(docs: DataFrame, k: int = 4, bits: int = 4, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``(doc_id, fp, component_id)``: near-duplicate groups under single linkage of fingerprints.

    ``component_id`` is the smallest id of the group.  Null and empty texts, and
    texts of white space, have fingerprint 0 and are linked like any other;
    fewer than ``k`` words form one shingle.  Repeated rows and ids keep their
    rows; a null id keeps its row and never names a group unless the whole group
    has none.  Empty table: no rows.  Other columns are not read.
    """
    return _groups(docs, k, bits, id_col, text_col).select("doc_id", "fp", F.col("low.doc_id").alias("component_id"))


def keep_one_per_group(docs: DataFrame, k: int = 4, bits: int = 4, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """``docs`` without all but one document of each group: that of the smallest id stays.

    A document is an id with a text: of one id's texts in a group that of the
    smallest hash stays, its texts in other groups are judged there, and rows equal in both
    stay or go together.  Rows with a null id can't be told apart by it and stay.
    """
    d, t = fresh(docs, "_d", "_t")
    gone = (_groups(docs, k, bits, id_col, text_col)
            .filter((F.col("doc_id") != F.col("low.doc_id")) | (F.col("text_id") != F.col("low.text_id")))
            .select(F.col("doc_id").alias(d), F.col("text_id").alias(t)).filter(F.col(d).isNotNull()).distinct())
    own = (F.col(id_col).cast("long") == F.col(d)) & (F.xxhash64(F.col(text_col).cast("string")) == F.col(t))
    return docs.join(gone, own, "left_anti").select(*named(docs))


__all__ = ["fingerprint", "fingerprints", "near_links", "simhash_groups", "keep_one_per_group", "Index"]
