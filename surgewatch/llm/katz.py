"""Language model scores by Katz backoff.

An n-gram seen ``c`` times after a history seen ``C`` times has the probability
``d(c) c / C``; Good-Turing discounts ``d`` free the rest, which is spread over the
unseen words as the next shorter history has them, by a backoff weight that makes all
words' probabilities sum to 1.  The model's tables (n-gram counts, history sums) are
partitioned by the n-grams' hashes, so that no frequent history gathers in one task:

1. ``_blocks``: documents become blocks of word numbers, written once.
2. Every block sends its distinct n-grams, with their training counts, to their
   partitions (``_totals``) and gets the corpus counts of the same n-grams back.
3. Every block sends what its histories lose by discounts and what their seen words
   have of the shorter history's probability (each n-gram is summed by one block that
   has it), and gets the corpus sums back (``_history_totals``).
4. ``_score`` evaluates the recursion for a block's distinct n-grams and sums it over
   the documents' tokens.

Between blocks and partitions go sorted arrays, packed, not rows.  The driver gets a
few numbers per order.  n-grams are known by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from surgewatch.llm.common import cut

#: Counts above this one are not discounted (Katz's choice).
K = 5
#: Tokens of a block (a longer document is a block of its own), and n-grams of a partition.
BLOCK_TOKENS, PARTITION_GRAMS = 1 << 22, 1 << 21
START, END = 0, 1
#: No word holds a space, so these are no word's keys.
_MARKS = [xxhash.xxh3_64_intdigest(b" start"), xxhash.xxh3_64_intdigest(b" end")]


def learned(doc_id: Column) -> Column:
    """Whether a row is learned from: crc32 of the id's text doesn't leave 2 by 7 (a null id: learned)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 7 != 2, F.lit(True))


# -- packed arrays ----------------------------------------------------------------

def _pack(a: np.ndarray) -> bytes:
    """The array's bytes by significance, compressed."""
    a = np.ascontiguousarray(a)
    return zstandard.ZstdCompressor(level=1).compress(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes())


def _unpack(b: bytes, kind=np.int64) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).ravel()


def _unpack_all(parts, kind=np.int64) -> np.ndarray:
    return np.concatenate([np.empty(0, kind), *[_unpack(p, kind) for p in parts]])


def _pack_sorted(keys: np.ndarray) -> bytes:
    return _pack(np.diff(keys, prepend=np.uint64(0)))


def _unpack_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(_unpack(b, np.uint64), dtype=np.uint64)


# -- blocks ------------------------------------------------------------------------

BLOCK = "block long, n long, ids binary, null_ids binary, learn binary, sizes binary, seq binary, words binary"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, text, learn) to blocks: word numbers of all documents, one after the other."""
    from pyspark import TaskContext
    block = TaskContext.get().partitionId() << 32
    schema = pa.schema([(c.split()[0], pa.int64() if c.endswith("long") else pa.binary()) for c in BLOCK.split(", ")])

    def row(ids, learn, seqs, numbers):
        words = sorted(numbers, key=numbers.get)[2:]
        return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((
            block, sum(map(len, seqs)) - len(seqs), _pack(np.array([i or 0 for i in ids], np.int64)),
            _pack(np.array([i is None for i in ids])), _pack(np.array(learn, bool)),
            _pack(np.array(list(map(len, seqs)), np.int64)), _pack(np.concatenate(seqs)),
            zstandard.ZstdCompressor(level=1).compress(b" ".join(words))), schema)], schema=schema)

    def fresh():
        return [], [], [], {b" start": START, b" end": END}, 0
    ids, learn, seqs, numbers, size = fresh()
    for b in batches:
        for i, text, own in zip(*(b.column(k).to_pylist() for k in range(3))):
            words = (text or b"").lower().split()  # of bytes: A-Z only, ASCII white space only
            seq = np.empty(len(words) + 2, np.int32)
            seq[0], seq[-1] = START, END
            seq[1:-1] = [numbers.setdefault(w, len(numbers)) for w in words]
            ids.append(i), learn.append(own), seqs.append(seq)
            size += len(seq)
            if size >= BLOCK_TOKENS:
                yield row(ids, learn, seqs, numbers)
                block += 1
                ids, learn, seqs, numbers, size = fresh()
    if ids:
        yield row(ids, learn, seqs, numbers)


class _Grams(NamedTuple):
    """Distinct n-grams of a block, of one order."""
    at: np.ndarray      # the n-gram that ends at a place, or -1
    keys: np.ndarray    # 64-bit keys
    counts: np.ndarray  # places in documents that are learned from
    history: np.ndarray  # all but the last word, as an n-gram of the next lower order
    lower: np.ndarray   # all but the first word, likewise
    word: np.ndarray    # the last word


def _mix(history: np.ndarray, word: np.ndarray) -> np.ndarray:
    k = (history ^ (history >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + word
    k = (k ^ (k >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return k ^ (k >> np.uint64(29))


class _Block:
    """A block's documents and their n-grams of orders 1 to ``order``."""

    def __init__(self, row, order: int):
        self.block, self.ids, self.null_ids = row.block, _unpack(row.ids), _unpack(row.null_ids, bool)
        self.learn, sizes, self.seq = _unpack(row.learn, bool), _unpack(row.sizes), _unpack(row.seq, np.int32)
        self.sizes, self.starts = sizes, np.cumsum(sizes) - sizes
        words = zstandard.ZstdDecompressor().decompress(row.words).split()
        keys = np.array(_MARKS + [xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)
        learn = np.repeat(self.learn, sizes)
        count = lambda at, n: np.bincount(at[learn & (at >= 0)], minlength=n)
        own = np.arange(len(keys))
        self.grams = [_Grams(self.seq, keys, count(self.seq, len(keys)), own, own, own)]
        for _ in range(1, order):
            low = self.grams[-1]
            here = self.seq != START  # the first place is a start
            here[1:] &= low.at[:-1] >= 0
            ends = np.flatnonzero(here)
            codes = low.at[ends - 1].astype(np.int64)
            codes *= len(keys)
            codes += self.seq[ends]
            codes, first, which = np.unique(codes, return_index=True, return_inverse=True)
            at = np.full(len(self.seq), -1, np.int32)
            at[here] = which
            lower = low.at[ends[first]]
            del which, ends, first
            history, word = np.divmod(codes, len(keys))
            self.grams.append(_Grams(at, _mix(low.keys[history], keys[word]), count(at, len(codes)),
                                     history.astype(np.int32), lower, word.astype(np.int32)))


def _parts(keys: np.ndarray, partitions: int) -> Iterator[tuple[int, slice]]:
    """Stretches of sorted keys by partition: equal ranges of hashes."""
    p = ((keys >> np.uint64(32)) * np.uint64(partitions)) >> np.uint64(32)
    edges = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]])) if len(p) else []
    for lo, hi in zip(edges, [*edges[1:], len(p)]):
        yield int(p[lo]), slice(lo, hi)


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of sorting (stable), places in it where a key begins, key's number per sorted place."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    new = np.concatenate([[True], k[1:] != k[:-1]])
    return order, np.flatnonzero(new), np.cumsum(new) - 1


# -- counts --------------------------------------------------------------------------

def _send_counts(order: int, partitions: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for row in f.itertuples():
                own = _Block(row, order)
                for n, g in enumerate(own.grams, 1):
                    by = np.argsort(g.keys, kind="stable")
                    keys, counts = g.keys[by], g.counts[by]
                    yield pd.DataFrame([(p, own.block, n, _pack_sorted(keys[s]), _pack(counts[s]))
                                        for p, s in _parts(keys, partitions)],
                                       columns=["part", "block", "n", "keys", "counts"])
    return run


def _totals(f: pd.DataFrame) -> pd.DataFrame:
    """One partition's n-grams: corpus counts for each block that has them, whether the block
    answers for the n-gram (1), whether other blocks have it too (2); and counts of counts."""
    out = []
    for n, own in f.groupby("n"):
        keys = [_unpack_sorted(k) for k in own["keys"]]
        edges = np.cumsum([0, *map(len, keys)])
        keys, counts = np.concatenate(keys), _unpack_all(own["counts"])
        order, first, which = _groups(keys)
        sums = np.add.reduceat(counts[order], first)
        totals, flags = np.empty(len(keys), np.int64), np.empty(len(keys), np.uint8)
        totals[order] = sums[which]
        flags[order] = 2 * (np.diff(np.append(first, len(keys))) > 1)[which]
        flags[order[first]] |= 1
        for k, block in enumerate(own["block"]):
            s = slice(edges[k], edges[k + 1])
            out.append((block, n, own["part"].iloc[0], _pack(totals[s]), _pack(flags[s]), None))
        seen = sums[(sums > 0) & ((n > 1) | (keys[order[first]] != np.uint64(_MARKS[START])))]
        stats = np.bincount(np.minimum(seen, K + 2), minlength=K + 3)[1:K + 2].tolist()
        out.append((None, n, own["part"].iloc[0], None, None, [*stats, len(seen), int(seen.sum())]))
    return pd.DataFrame(out, columns=["block", "n", "part", "a", "b", "stats"]).astype({"block": "Int64"})


class Order(NamedTuple):
    """What the corpus says of one order."""
    discounts: tuple[float, ...]  # of counts 1, 2, ...
    lost: float                   # what they take from all n-grams' counts
    distinct: int
    total: int


def discounts(counts: list[int]) -> tuple[float, ...]:
    """Good-Turing discounts of counts 1 to ``k`` from the numbers ``n_1 .. n_(k+1)`` of n-grams
    with these counts: Katz's, with the largest ``k`` for which all lie between 0 and 1."""
    for k in range(len(counts) - 1, 0, -1):
        if all(counts[:k + 1]):
            rest = (k + 1) * counts[k] / counts[0]
            found = [((r + 1) * counts[r] / counts[r - 1] / r - rest) / (1 - rest) for r in range(1, k + 1)] \
                if rest < 1 else [1.0]
            if all(0 < d < 1 for d in found):
                return tuple(found)
    return ()


# -- histories -------------------------------------------------------------------------

class _Model:
    """A block's n-grams with their corpus counts, sums over histories and probabilities."""

    def __init__(self, own: _Block, answers: pd.DataFrame, orders: list[Order]):
        self.own, self.orders, self.totals, self.flags = own, orders, [], []
        for n, g in enumerate(own.grams, 1):
            a = answers[answers["n"] == n].sort_values("part")
            by = np.argsort(g.keys, kind="stable")
            totals, flags = np.empty(len(by), np.int64), np.empty(len(by), np.uint8)
            totals[by] = _unpack_all(a["a"])
            flags[by] = _unpack_all(a["b"], np.uint8)
            self.totals.append(totals), self.flags.append(flags)

    def discounted(self, n: int) -> np.ndarray:
        """``d(c) c`` of every n-gram of order ``n``."""
        d = np.array([0.0, *self.orders[n - 1].discounts])
        c = self.totals[n - 1]
        return c * np.where(c < len(d), d[np.minimum(c, len(d) - 1)], 1.0)

    def sums(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Per history of order-``n`` n-grams: the discounted counts that their suffixes have, and
        what discounts took; over the n-grams that this block answers for."""
        g, c = self.own.grams[n - 1], self.totals[n - 1]
        mine = (c > 0) & (self.flags[n - 1] & 1 > 0)
        size = len(self.own.grams[n - 2].keys)
        lower = self.discounted(n - 1)[g.lower[mine]]
        lost = (c - self.discounted(n))[mine]
        return np.bincount(g.history[mine], lower, size), np.bincount(g.history[mine], lost, size)

    def shared(self, n: int) -> np.ndarray:
        """Histories, by key, whose sums other blocks have a part in."""
        low, has = self.own.grams[n - 2], np.zeros(len(self.own.grams[n - 2].keys), bool)
        has[self.own.grams[n - 1].history] = True
        some = np.flatnonzero(has & (self.totals[n - 2] > 0) & (self.flags[n - 2] & 2 > 0))
        return some[np.argsort(low.keys[some], kind="stable")]

    def log_probabilities(self, answers: pd.DataFrame) -> np.ndarray:
        """log10 of the probability of the token at each place (0 at a start)."""
        own, first = self.own, self.orders[0]
        whole = first.total if first.lost > 0 else first.total + 1  # nothing taken: one is added
        unknown = (first.lost if first.lost > 0 else 1) / whole
        c = self.totals[0]
        with np.errstate(divide="ignore"):
            logp = np.where(c > 0, np.log10(self.discounted(1) / whole), math.log10(unknown))
        at = np.where(own.seq == START, 0.0, logp[own.seq])
        wholes, floor = np.full(len(c), whole, np.float64), np.full(len(c), unknown)
        for n in range(2, len(own.grams) + 1):
            g, c, low = own.grams[n - 1], self.totals[n - 1], self.totals[n - 2]
            seen, lost = self.sums(n)
            a, some = answers[answers["n"] == n].sort_values("part"), self.shared(n)
            if len(some):
                seen[some] = _unpack_all(a["a"], np.float64)
                lost[some] = _unpack_all(a["b"], np.float64)
            own_whole = np.where(lost > 0, low, low + 1).astype(np.float64)
            left = np.where(lost > 0, lost, 1) / own_whole
            # the shorter history of a history: of order n - 2 (of none, if n is 2)
            short = own.grams[n - 2].lower
            rest = np.maximum(1 - seen / wholes[short], floor[short])
            with np.errstate(divide="ignore"):
                weight = np.where(low > 0, np.log10(left / rest), 0.0)
                logp = np.where(c > 0, np.log10(self.discounted(n) / own_whole[g.history]),
                                weight[g.history] + logp[g.lower])
            here = g.at >= 0
            at[here] = logp[g.at[here]]
            wholes, floor = own_whole, left
        return at


def _send_sums(orders: list[Order], partitions: int):
    def run(key, blocks: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in blocks.itertuples():
            own = _Block(row, len(orders))
            model = _Model(own, answers, orders)
            for n in range(2, len(orders) + 1):
                some, (seen, lost) = model.shared(n), model.sums(n)
                keys = own.grams[n - 2].keys[some]
                out += [(p, own.block, n, _pack_sorted(keys[s]), _pack(seen[some[s]]), _pack(lost[some[s]]))
                        for p, s in _parts(keys, partitions)]
        return pd.DataFrame(out, columns=["part", "block", "n", "keys", "seen", "lost"])
    return run


def _history_totals(f: pd.DataFrame) -> pd.DataFrame:
    """One partition's histories: the corpus sums for each block that has them."""
    out = []
    for n, own in f.groupby("n"):
        keys = [_unpack_sorted(k) for k in own["keys"]]
        edges = np.cumsum([0, *map(len, keys)])
        order, first, which = _groups(np.concatenate(keys))
        sums = []
        for c in ("seen", "lost"):
            x = _unpack_all(own[c], np.float64)
            total = np.empty(len(x))
            total[order] = np.add.reduceat(x[order], first)[which]
            sums.append(total)
        for k, block in enumerate(own["block"]):
            s = slice(edges[k], edges[k + 1])
            out.append((block, n, own["part"].iloc[0], _pack(sums[0][s]), _pack(sums[1][s])))
    return pd.DataFrame(out, columns=["block", "n", "part", "a", "b"])


# -- scores --------------------------------------------------------------------------------

def _score(orders: list[Order]):
    def run(key, blocks: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in blocks.itertuples():
            own = _Block(row, len(orders))
            model = _Model(own, answers[answers["kind"] == 1], orders)
            score = model.log_probabilities(answers[answers["kind"] == 2])
            per = lambda x: np.add.reduceat(x, own.starts)
            score, c = per(score), model.totals[0]
            base = np.log10((c + 1) / (orders[0].total + orders[0].distinct + 1))
            known = (c > 0).astype(np.int64)
            base[START] = known[START] = 0
            out.append(pd.DataFrame({
                "id": pd.array(own.ids, "Int64").copy(), "learned": own.learn, "n_tokens": own.sizes - 1,
                "n_known": per(known[own.seq]), "base_score": per(base[own.seq]), "score": score}))
            out[-1].loc[own.null_ids, "id"] = pd.NA
        return pd.concat(out) if out else pd.DataFrame(columns=SCORES)
    return run


SCORES = ["id", "learned", "n_tokens", "n_known", "base_score", "score"]


def score_documents(docs: DataFrame, order: int = 2, learn: Column | None = None, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: the id, ``held_out``, ``n_tokens``, ``n_known`` (tokens learned), ``train_tokens``,
    ``base_score`` (add-one unigrams) and ``score`` (log10 probability of the text by Katz backoff).

    Tokens: words without white space, A-Z lower-cased, and one end; a history begins
    at the text's start.  Learned from: rows where ``learn`` is true (default: ``learned``
    of the id).  All unseen words are one word of the vocabulary.  A history none of whose
    counts is discounted has one added to its count, which goes to unseen words.

    A null or empty text has its end only.  Rows may repeat: each is learned from and
    scored.  Without rows to learn from every token is the unknown word, of probability 1.
    Empty table: no rows.  Extra columns are not read.
    """
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"),
                      F.coalesce(learned(F.col(id_col)) if learn is None else learn, F.lit(False)).alias("learn"))
    blocks = cut(own.mapInArrow(_blocks, BLOCK))
    tokens = blocks.agg(F.sum("n")).first()[0] or 0
    partitions = max(1, math.ceil(tokens * order / PARTITION_GRAMS))
    sent = blocks.mapInPandas(_send_counts(order, partitions), "part long, block long, n int, keys binary, counts binary")
    counts = cut(sent.groupBy("part").applyInPandas(
        _totals, "block long, n int, part long, a binary, b binary, stats array<long>"))
    said = {r["n"]: r["s"] for r in counts.filter("block is null").groupBy("n").agg(
        F.array(*[F.sum(F.col("stats")[k]) for k in range(K + 3)]).alias("s")).collect()}
    orders = []
    for n in range(1, order + 1):
        *some, distinct, total = said.get(n, [0] * (K + 3))
        d = discounts(some)
        orders.append(Order(d, sum((1 - x) * r * some[r - 1] for r, x in enumerate(d, 1)), distinct, total))
    counts = counts.filter("block is not null").drop("stats")
    answers = counts.withColumn("kind", F.lit(1))
    if order > 1:
        sums = blocks.groupBy("block").cogroup(counts.groupBy("block")).applyInPandas(
            _send_sums(orders, partitions), "part long, block long, n int, keys binary, seen binary, lost binary")
        sums = cut(sums.groupBy("part").applyInPandas(_history_totals, "block long, n int, part long, a binary, b binary"))
        answers = answers.unionByName(sums.withColumn("kind", F.lit(2)))
    scored = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(
        _score(orders), "id long, learned boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select(F.col("id").alias(id_col), (~F.col("learned")).alias("held_out"), "n_tokens", "n_known",
                         F.lit(orders[0].total).cast("long").alias("train_tokens"), "base_score", "score")


__all__ = ["learned", "discounts", "score_documents"]
