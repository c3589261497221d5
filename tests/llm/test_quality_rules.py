import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from surgewatch.llm.quality_rules import CUTOFFS, apply_rules, binomial_tail, choose_cutoffs, measures
from surgewatch.llm.queries import op10_quality_rules


def brute(text):
    t = text or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", t)
    wins = Counter(tuple(ws[i:i + 8]) for i in range(len(ws) - 7))
    rep = {j for i in range(len(ws) - 7) if wins[tuple(ws[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(rep))


def counts(x):
    return x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words


def test_base_counts(spark, load):
    docs = dict(load("documents", "sf0.01", "doc_id, text"))
    rows = op10_quality_rules(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(docs)
    for x in rows:
        want = brute(docs[x.doc_id])
        assert counts(x) == want
        assert x.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0]) and not (x.base_failed and x.kept)
        assert x.kept == (not x.base_failed and x.rejected_by == "")


def test_binomial_tail(spark):
    cases = [(10, 0, 0.1), (10, 0, 0.01), (500, 1, 0.01), (2000, 12, 0.01), (100_000, 900, 0.01), (5, 5, 0.01), (300, 4, 0.01)]
    for n, x, a in cases:
        got = spark.range(1).select(binomial_tail(F.lit(n).cast("long"), F.lit(x).cast("long"), a)).first()[0]
        exact = sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(a)
                             + (n - i) * math.log1p(-a)) for i in range(x + 1))
        assert got == pytest.approx(1.0 if x >= n * a else exact, rel=1e-6)


def test_cutoffs_follow_the_bound(spark):
    """Good documents score 0 on all rules but one; a stratum with too few labels gets no cutoff."""
    rows = [(i, "big", 0.0, float(i % 10 == 0) * 0.05, 6.0) for i in range(3000)] + \
        [(i, "big", 0.35, 0.0, 6.0) for i in range(3000, 3200)] + [(i, "few", 0.0, 0.0, 6.0) for i in range(4000, 4040)] + \
        [(i, "few", 0.9, 0.0, 6.0) for i in range(4040, 4080)]
    scored = spark.createDataFrame(rows, "doc_id long, stratum string, symbol_share double, upper_share double, word_length double") \
        .withColumn("dup_line_share", F.lit(0.0)).withColumn("repeat_word_share", F.lit(0.0))
    labels = spark.createDataFrame([(i, int(i < 3000 or 4000 <= i < 4040), 0) for i, *_ in rows] + [(None, 1, 0), (5, None, 0)],
                                   "doc_id long, quality int, toxic int")
    got = choose_cutoffs(scored, labels).collect()
    assert [(x.stratum, x.rule, x.n_good, x.false_rejections) for x in got] == [("big", "symbol_share", 3000, 0)]
    assert got[0].cutoff == 0.3 and got[0].p_value <= 0.05 / (2 * len(CUTOFFS))
    assert choose_cutoffs(scored, labels.limit(0)).collect() == []


def test_false_rejection_rate(spark):
    """On sf0.1, bad documents go and few good ones do."""
    sf = "/root/testdata/sf0.1"
    rows = op10_quality_rules(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    good = [x for x in rows if x.quality == 1 and not x.base_failed]
    bad = [x for x in rows if x.quality == 0 and not x.base_failed]
    assert sum(not x.kept for x in good) <= 0.05 * len(good)
    assert sum(not x.kept for x in bad) >= 0.3 * len(bad)


def test_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(None, 1, 0), (5, 1, 0), (6, 0, 0), (6, 1, 0)], "doc_id long, quality int, toxic int")
    rows = apply_rules(odd, labels).collect()
    assert sorted(map(counts, rows)) == sorted(brute(x.text) for x in odd.collect())
    assert apply_rules(odd, labels.limit(0)).count() == len(rows)
    assert apply_rules(empty, labels).collect() == []
    plan = apply_rules(odd, labels)._jdf.queryExecution().toString() + measures(odd)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
