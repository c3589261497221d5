"""Katz backoff against a plain model of dictionaries."""
import functools
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from surgewatch.llm import katz
from surgewatch.llm.katz import discounts, score_documents
from surgewatch.llm.queries import op11_lm_scoring


def tokens(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x20\x09-\x0D]+", low) + ["</s>"]


class Plain:
    """Counts in dictionaries, probabilities by the textbook's recursion."""

    def __init__(self, texts, order):
        self.order, self.counts = order, [Counter() for _ in range(order)]
        for t in texts:
            seq = ["<s>", *tokens(t)]
            for n in range(1, order + 1):
                for e in range(max(n, 2), len(seq) + 1):
                    self.counts[n - 1][tuple(seq[e - n:e])] += 1
        self.d, self.after = [], [{} for _ in range(order)]
        for n, c in enumerate(self.counts):
            per = Counter(c.values())
            self.d.append(discounts([per[r] for r in range(1, katz.K + 2)]))
            for g, k in c.items():
                self.after[n].setdefault(g[:-1], {})[g[-1]] = k
        self.vocabulary = [g[0] for g in self.counts[0]]

    def take(self, n, c):
        return c * (self.d[n][c - 1] if c <= len(self.d[n]) else 1.0)

    @functools.cache
    def whole(self, h):
        seen = self.after[len(h)][h].values()
        return sum(seen) + (sum(self.take(len(h), c) for c in seen) == sum(seen))

    def direct(self, h, w):
        """Discounted share of w after h (h was seen)."""
        seen = self.after[len(h)].get(h, {})
        return self.take(len(h), seen[w]) / self.whole(h) if w in seen else 0.0

    @functools.cache
    def weight(self, h):
        seen = self.after[len(h)].get(h, {})
        left = 1 - math.fsum(self.direct(h, x) for x in seen)
        return left / (1 - math.fsum(self.p(h[1:], x) for x in seen)) if h else left

    @functools.cache
    def p(self, h, w):
        if h and h not in self.after[len(h)]:
            return self.p(h[1:], w)
        if w in self.after[len(h)].get(h, {}):
            return self.direct(h, w)
        return self.weight(h) * self.p(h[1:], w) if h else self.weight(h)

    def score(self, text):
        seq = ["<s>", *tokens(text)]
        return sum(math.log10(self.p(tuple(seq[max(0, e - self.order + 1):e]) if self.order > 1 else (), seq[e]))
                   for e in range(1, len(seq)))


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(katz, "BLOCK_TOKENS", 8000)
    monkeypatch.setattr(katz, "PARTITION_GRAMS", 40_000)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_equals_the_plain_model(spark, load, small_blocks, order):
    docs = [(d, t) for d, t in load("documents", cols="doc_id, text") if len(t or "") < 3000]
    model = Plain([t for d, t in docs if zlib.crc32(str(d).encode()) % 7 != 2], order)
    got = {r.doc_id: r for r in score_documents(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3), order).collect()}
    assert len(got) == len(docs) > 100
    n, v = sum(model.counts[0].values()), len(model.counts[0])
    for d, t in docs:
        r, own = got[d], tokens(t)
        assert r.held_out == (zlib.crc32(str(d).encode()) % 7 == 2)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum((w,) in model.counts[0] for w in own), n)
        assert r.base_score == pytest.approx(sum(math.log10((model.counts[0][(w,)] + 1) / (n + v + 1)) for w in own), rel=1e-9)
        assert r.score == pytest.approx(model.score(t), rel=1e-7)
    assert any(r.held_out for r in got.values())


@pytest.mark.parametrize("order", [2, 3])
def test_probabilities_sum_to_one(load, order):
    model = Plain([t for _, t in load("documents", cols="doc_id, text")[:25]], order)
    histories = [(), *list(model.after[1])[:20], ("never",), *(list(model.after[2])[:20] if order > 2 else [])]
    for h in histories:
        assert math.fsum(model.p(h, w) for w in [*model.vocabulary, "never seen"]) == pytest.approx(1, abs=1e-9)


def test_discounts():
    assert discounts([0] * 6) == () == discounts([0, 5, 5, 5, 5, 5])  # no word seen once: nothing to go by
    assert all(0 < d < 1 for d in discounts([900, 300, 150, 90, 60, 40])) and len(discounts([900, 300, 150, 90, 60, 40])) == 5
    assert len(discounts([900, 300, 150, 0, 0, 0])) == 2 and discounts([1, 3, 0, 0, 0, 0]) == ()


def test_query_covers_all_documents(spark, load):
    docs = load("documents", "sf0.01", "doc_id, text")
    rows = {r.doc_id: r for r in op11_lm_scoring(spark, "/root/testdata/sf0.01").collect()}
    assert rows.keys() == {d for d, _ in docs}
    assert all(rows[d].n_tokens == len(tokens(t)) for d, t in docs)
    held = [r for r in rows.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)  # histories help


def test_odd_rows(spark, odd, empty, small_blocks):
    rows = score_documents(odd, 3).collect()
    assert len(rows) == odd.count() and all(math.isfinite(r.score) for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert len(by[None]) == 2 and not any(r.held_out for r in by[None])
    assert by[1][0].n_tokens == by[2][0].n_tokens == by[3][0].n_tokens == 1
    assert by[1][0].score == by[3][0].score and by[4][0].n_tokens == 120_001
    assert score_documents(empty).collect() == []
    nothing = score_documents(odd, learn=F.lit(None).cast("boolean")).collect()
    assert {(r.score, r.base_score, r.train_tokens, r.n_known) for r in nothing} == {(0.0, 0.0, 0, 0)}
