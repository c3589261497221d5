"""Quality rules whose cutoffs are chosen under a guaranteed false rejection rate.

Each rule rejects a document whose score lies above a cutoff.  On the labelled
documents of a stratum, the good ones that a cutoff rejects are a binomial count;
a cutoff is *certified* if the exact tail ``P(Bin(n, a) <= count)`` is at most
``delta / (rules x strata)``, that is, if the Clopper-Pearson bound of its false
rejection rate lies below ``a = alpha / rules``.  A rule's cutoffs are tested from
the mildest to the strictest and testing stops at the first failure (fixed
sequence), so with probability ``1 - delta`` all rules together reject at most
``alpha`` of the good documents in every stratum.  Among the certified cutoffs
the rule takes that of the largest share of bad minus share of good documents
rejected; without a certified cutoff it rejects nothing there.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from surgewatch.llm.common import SPACES, broadcast_if_small, cut, let, words

SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Rule -> cutoffs from the mildest to the strictest, fixed before any label is seen.
SHARES = (0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.08, 0.06, 0.04, 0.02)
CUTOFFS = {
    "symbol_share": SHARES,
    "upper_share": SHARES,
    "dup_line_share": SHARES,
    "repeat_word_share": SHARES,
    "word_length": (20.0, 16.0, 14.0, 12.0, 11.0, 10.0, 9.5, 9.0, 8.5, 8.0, 7.5),
}
NO_STRATUM = "(none)"


def _repeat_words(w: Column) -> Column:
    """Words inside windows of WINDOW words that occur twice or more in ``w``."""
    def covered(h: Column) -> Column:
        def starts(s: Column) -> Column:  # sorted (hash, place): equal hashes are neighbours
            same = lambda e, i: ((i > 0) & (F.get(s, i - 1)["h"] == e["h"])) | (
                F.coalesce(F.get(s, i + 1)["h"] == e["h"], F.lit(False)))
            return F.sort_array(F.transform(F.filter(s, same), lambda e: e["i"]))
        places = let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), starts)
        zero = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(places, zero, lambda a, p: F.struct(
            p.alias("last"), (a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n")), lambda a: a["n"])

    def hashes(x: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(x) - WINDOW),
                           lambda i: F.xxhash64(*[F.get(x, i + k) for k in range(WINDOW)]))
    each = lambda x: let(hashes(x), lambda h: F.when(
        F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(0))
    return F.when(F.size(w) > WINDOW, let(F.transform(w, lambda v: F.xxhash64(v)), each)).otherwise(0)


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """Per row: ``doc_id``, ``stratum``, the base counts (longs) and the rules' scores.

    A null text has no words; a null stratum is ``(none)``.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    gone = lambda chars: F.length(text) - F.length(F.translate(text, chars, ""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    both = let(words(F.col(text_col)), lambda w: F.struct(F.size(w).alias("n"), _repeat_words(w).alias("r")))
    dup = let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("d")))
    own = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(stratum_col).cast("string"), F.lit(NO_STRATUM)).alias("stratum"),
        both.alias("w"), dup.alias("l"), F.length(F.translate(text, SPACES, "")).alias("word_chars"),
        gone(SYMBOLS).alias("n_symbols"), F.length(F.regexp_replace(text, r"\P{Lu}+", "")).alias("upper"))
    long = lambda c: F.col(c).cast("long")
    share = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(0.0))
    return own.select(
        "doc_id", "stratum", long("w.n").alias("n_words"), long("word_chars").alias("word_chars"),
        long("n_symbols").alias("n_symbols"), long("l.d").alias("n_dup_lines"), long("w.r").alias("n_repeat_words"),
        share("n_symbols", "word_chars").alias("symbol_share"), share("upper", "word_chars").alias("upper_share"),
        share("l.d", "l.n").alias("dup_line_share"), share("w.r", "w.n").alias("repeat_word_share"),
        share("word_chars", "w.n").alias("word_length"))


def binomial_tail(n: Column, x: Column, a: float) -> Column:
    """``P(Bin(n, a) <= x)``, summed in logarithms; 1 where x is at least the mean."""
    step = lambda s, i: let(
        s["t"] + F.ln((n - i + 1) / i) + F.lit(math.log(a / (1 - a))),
        lambda t: F.struct(t.alias("t"), (F.greatest(s["sum"], t) + F.ln(
            F.exp(s["sum"] - F.greatest(s["sum"], t)) + F.exp(t - F.greatest(s["sum"], t)))).alias("sum")))
    first = n * F.lit(math.log1p(-a))
    ones = F.when(x > 0, F.sequence(F.lit(1).cast("long"), x)).otherwise(F.array().cast("array<long>"))
    tail = F.aggregate(ones, F.struct(first.alias("t"), first.alias("sum")), step, lambda s: F.exp(s["sum"]))
    return F.when(x >= n * F.lit(a), F.lit(1.0)).otherwise(tail)


def choose_cutoffs(scored: DataFrame, labels: DataFrame, alpha: float = 0.05, delta: float = 0.05) -> DataFrame:
    """``(stratum, rule, cutoff, n_good, false_rejections, p_value)`` of each rule that rejects.

    ``scored``: rows of ``measures``.  ``labels(doc_id, quality)``: a document is
    good if all its labels say 1, bad if one says 0; null labels and ids count for
    nothing.  No labels: no rows.
    """
    said = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("q"))
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("score"),
                               F.array(*[F.lit(float(c)) for c in cs]).alias("cuts")) for r, cs in CUTOFFS.items()])
    rows = (scored.join(said, "doc_id").select("stratum", "q", F.explode(rules).alias("x"))
            .select("stratum", "q", "x.rule", "x.cuts", F.size(F.filter(
                "x.cuts", lambda c: F.col("x.score") > c)).alias("hits")))  # the strictest `hits` cutoffs reject it
    counts = rows.groupBy("stratum", "rule", "cuts", "hits").agg(
        F.count_if(F.col("q") == 1).alias("good"), F.count_if(F.col("q") != 1).alias("bad"))
    per = counts.groupBy("stratum", "rule", "cuts").agg(
        F.collect_list(F.struct("hits", "good", "bad")).alias("c"),  # at most one per number of hits
        F.sum("good").alias("n_good"), F.sum("bad").alias("n_bad"))
    rejected = lambda k, i: F.aggregate(
        F.filter("c", lambda e: e["hits"] >= F.size("cuts") - i), F.lit(0).cast("long"), lambda s, e: s + e[k])
    per = per.select("stratum", "rule", "n_good", "n_bad", F.posexplode("cuts").alias("i", "cutoff"), "c", "cuts") \
        .select("stratum", "rule", "n_good", "n_bad", "i", "cutoff", rejected("good", F.col("i")).alias("false_rejections"),
                rejected("bad", F.col("i")).alias("hits_bad"))
    strata = scored.agg(F.count_distinct("stratum")).first()[0] or 1
    a = alpha / len(CUTOFFS)
    tested = per.withColumn("p_value", F.when(F.col("n_good") > 0, binomial_tail(
        F.col("n_good"), F.col("false_rejections"), a)).otherwise(1.0)) \
        .withColumn("ok", F.col("p_value") <= delta / (len(CUTOFFS) * strata))
    order = Window.partitionBy("stratum", "rule").orderBy("i")
    certified = tested.withColumn("certified", F.min("ok").over(order)).filter("certified")
    gain = F.try_divide(F.col("hits_bad").cast("double"), F.col("n_bad")) - F.col("false_rejections") / F.col("n_good")
    best = certified.withColumn("gain", gain).filter("gain > 0").groupBy("stratum", "rule").agg(
        F.max_by(F.struct("cutoff", "n_good", "false_rejections", "p_value"), F.struct("gain", -F.col("i"))).alias("b"))
    return best.select("stratum", "rule", "b.*")


def apply_rules(docs: DataFrame, labels: DataFrame, alpha: float = 0.05, delta: float = 0.05,
                min_words: int = 20, max_repeat_percent: int = 30) -> DataFrame:
    """Per row of ``docs``: the base counts, ``base_failed``, ``kept`` and ``rejected_by`` (comma-joined rules).

    Rows may repeat, ids may be null, texts null or empty (0 words: base_failed).
    Empty table: no rows.  Extra columns are not read.
    """
    scored = cut(measures(docs))
    cutoffs = cut(choose_cutoffs(scored, labels, alpha, delta)).groupBy("stratum").agg(
        *[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"max_{r}") for r in CUTOFFS])
    cutoffs = cut(cutoffs)
    broken = F.concat_ws(",", *[F.when(F.col(r) > F.col(f"max_{r}"), F.lit(r)) for r in CUTOFFS])
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    return (scored.join(broadcast_if_small(cutoffs, cutoffs.count(), 10_000), "stratum", "left")
            .withColumn("base_failed", failed).withColumn("rejected_by", broken)
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                    (~F.col("base_failed") & (F.col("rejected_by") == "")).alias("kept"), "rejected_by"))


__all__ = ["measures", "binomial_tail", "choose_cutoffs", "apply_rules", "CUTOFFS"]
