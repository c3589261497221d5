"""Language ID by a blended-spectrum string kernel with Nystroem landmarks and ridge regression.

The kernel of two texts is the number of character n-grams (lengths 1 to
``N_MAX``, upper and lower case alike, hashed to ``DIM`` places) that both hold,
over the geometric mean of their numbers of n-grams.  ``fit`` solves
one-versus-rest kernel ridge regression on the landmarks' kernel columns: tasks sum up the
normal equations over parts of the rows, the driver holds only sums over pairs of landmarks;
``predict`` scores texts in batches by matrix products.  Whole texts are read.
``calibrate`` finds the scores below which a text has none of the learned languages.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window, functions as F

from surgewatch.llm.common import cut, fresh, named

N_MAX, DIM = 3, 1 << 15
#: Rows and landmarks per language, and the longest text, that ``fit`` takes.
PER_CLASS, LANDMARKS, LONGEST = 200, 40, 20_000
#: Landmarks in all, shared alike by the languages (one each at least), and rows whose normal equations one task sums up.
ALL_LANDMARKS, PART = 2000, 4096
#: Length classes of ``calibrate`` (characters), the share of right rows that each may reject, and the risk of more.
EDGES, LOSE, RISK, BINS = (100, 1000), 0.002, 0.05, 1000
#: Texts scored at a time, and characters hashed at a time.
BATCH, SPAN = 64, 1 << 16

_LETTER = regex.compile(r"\p{L}")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def presence(text: str) -> np.ndarray:
    """The hashed n-grams of a text, as DIM flags."""
    flags = np.zeros(DIM, bool)
    chars = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    shift = np.uint64(64 - DIM.bit_length() + 1)
    for lo in range(0, len(chars), SPAN):
        own = chars[lo:lo + SPAN + N_MAX - 1]
        code = np.zeros(len(own), np.uint64)
        for n in range(1, N_MAX + 1):
            if len(own) < n:
                break
            code = code[:len(own) - n + 1] * np.uint64(0x110000) + own[n - 1:]
            flags[((code + np.uint64(n)) * _MIX) >> shift] = True
    return flags


def features(texts: list[str]) -> np.ndarray:
    """Rows of unit length: a product of two is the kernel of their texts."""
    return unit(np.array([presence(t) for t in texts]).reshape(-1, DIM))


def unit(flags: np.ndarray) -> np.ndarray:
    """Rows of flags as rows of unit length."""
    x = flags.astype(np.float32)
    return x / np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))


@dataclass(frozen=True)
class Model:
    langs: tuple[str, ...]
    weights: np.ndarray  # DIM x languages: landmarks times their coefficients

    def score(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language (``und`` without a letter or a learned language) and score from 0 to 1."""
        lang, score = ["und"] * len(texts), np.zeros(len(texts))
        known = [i for i, t in enumerate(texts) if t and self.langs and _LETTER.search(t)]
        for lo in range(0, len(known), BATCH):
            own = known[lo:lo + BATCH]
            f = features([texts[i] for i in own]) @ self.weights
            best = f.argmax(axis=1)
            score[own] = np.clip((f[np.arange(len(own)), best] + 1) / 2, 0, 1)
            for i, b in zip(own, best):
                lang[i] = self.langs[b]
        return lang, score


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from learning: crc32 of the id's text leaves 2 by 4 (a null id: no)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def normal_equations(rows: DataFrame, marks: np.ndarray, langs: tuple[str, ...], parts: int) -> np.ndarray:
    """``K'K`` and, beside it, ``K'Y``: ``K`` the kernel of the rows (``text``, ``lang``, ``h``) with the landmarks,
    ``Y`` one column per language of 1 and -1.  Each part is summed up in a task, rows in the order of ``h``."""
    shared = rows.sparkSession.sparkContext.broadcast((np.packbits(marks, axis=1), langs))

    def run(own: pd.DataFrame) -> pd.DataFrame:
        bits, langs = shared.value
        marks = unit(np.unpackbits(bits, axis=1, count=DIM))
        own, total = own.sort_values(["h", "text"]), np.zeros((len(marks), len(marks) + len(langs)))
        for lo in range(0, len(own), BATCH):
            some = own.iloc[lo:lo + BATCH]
            k = (features(some["text"].tolist()) @ marks.T).astype(np.float64)
            y = np.where(some["lang"].to_numpy()[:, None] == np.array(langs, object)[None, :], 1.0, -1.0)
            total += k.T @ np.hstack([k, y])
        return pd.DataFrame({"part": own["part"].iloc[:1], "total": [total.tobytes()]})
    summed = rows.select("text", "lang", "h", F.pmod("h", F.lit(parts)).cast("int").alias("part")) \
        .groupBy("part").applyInPandas(run, "part int, total binary")
    out = np.zeros((len(marks), len(marks) + len(langs)))
    for r in summed.orderBy("part").toLocalIterator():  # one part's sums at a time
        out += np.frombuffer(r["total"]).reshape(out.shape)
    return out


def fit(docs: DataFrame, ridge: float = 1e-3, per_class: int = PER_CLASS, landmarks: int = LANDMARKS) -> Model:
    """A model from at most ``per_class`` rows per language, those of the smallest id hashes.

    Learns from rows that aren't held out and have an id, a language, a letter and
    at most ``LONGEST`` characters.  No such row: a model that answers ``und``.  The first ``landmarks``
    rows of each language are landmarks, fewer with over ``ALL_LANDMARKS / landmarks`` languages.
    """
    own = docs.select("text", "lang", F.xxhash64("doc_id").alias("h")).filter(
        F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & F.col("lang").isNotNull()
        & (F.length("text") <= LONGEST) & F.col("text").rlike(r"\p{L}"))
    first = Window.partitionBy("lang").orderBy("h", "text")
    rows = cut(own.withColumn("r", F.row_number().over(first)).filter(F.col("r") <= per_class))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = tuple(sorted(sizes))
    if not langs:
        return Model((), np.zeros((DIM, 0), np.float32))
    each = max(1, min(landmarks, ALL_LANDMARKS // len(langs)))
    flags = F.pandas_udf(lambda texts: texts.map(lambda t: np.packbits(presence(t)).tobytes()), "binary")
    bits = [r["bits"] for r in rows.filter(F.col("r") <= each).select("lang", "r", flags("text").alias("bits"))
            .orderBy("lang", "r").collect()]  # 4 kB each
    held = np.unpackbits(np.array([np.frombuffer(b, np.uint8) for b in bits]), axis=1, count=DIM)
    parts = -(-sum(sizes.values()) // PART)
    sums, marks = normal_equations(rows, held, langs, parts), unit(held)
    m, kmm = len(marks), (marks @ marks.T).astype(np.float64)
    alpha = np.linalg.lstsq(sums[:, :m] + ridge * sum(sizes.values()) * kmm + 1e-9 * np.eye(m), sums[:, m:], rcond=None)[0]
    return Model(langs, (marks.T @ alpha).astype(np.float32))


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; only the text is looked at.

    Null texts and texts without a letter: ``und``, score 0.  Ties go to the first
    language by name.  Columns of these names are replaced, all others kept.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            lang, score = shared.value.score([t if isinstance(t, str) else "" for t in texts])
            yield pd.DataFrame({"lang_pred": lang, "score": score})

    keep, (p,) = named(docs, "lang_pred", "score"), fresh(docs, "_p")
    return docs.select(*keep, run(F.col(text_col).cast("string")).alias(p)).select(*keep, f"{p}.lang_pred", f"{p}.score")


def stratum(text: Column) -> Column:
    """The class of a text by its number of characters (null: 0)."""
    n = F.coalesce(F.length(text), F.lit(0))
    return sum(((n >= e).cast("int") for e in EDGES), F.lit(0))


def certified(n: int, lose: float, risk: float) -> int:
    """The most rejections among ``n`` rows that still show a rate below ``lose``: at that rate, so few
    or fewer would come with a probability of ``risk`` at most (exact binomial tail).  None do: -1."""
    total, k = 0.0, -1
    while k < n:
        i = k + 1
        total += math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1)
                          + i * math.log(lose) + (n - i) * math.log1p(-lose))
        if total > risk:
            break
        k = i
    return k


def calibrate(docs: DataFrame, model: Model, lose: float = LOSE, risk: float = RISK) -> tuple[float, ...]:
    """For each length class the score below which a text is rejected.

    The greatest cutoff (in steps of 1 / BINS) that rejects less than ``lose`` of the rows whose language
    the model tells rightly, by exact binomial bounds on the held-out rows with a language, each text
    once; ``risk`` is shared by the classes.  Cutoffs are tried upwards and the first that fails ends
    the search, so one bound per class holds.  A class with too few rows rejects nothing (0).
    """
    own = docs.filter(held_out(F.col("doc_id")) & F.col("lang").isNotNull()).select("text", "lang")
    rows = predict(own, model).filter("lang_pred = lang").select(
        F.xxhash64("text").alias("h"), stratum(F.col("text")).alias("s"), F.floor(F.col("score") * BINS).cast("int").alias("bin")).distinct()
    seen = {(r["s"], r["bin"]): r["n"] for r in rows.groupBy("s", "bin").agg(F.count("*").alias("n")).collect()}  # strata x bins at most
    out = []
    for s in range(len(EDGES) + 1):
        left = certified(sum(n for (t, _), n in seen.items() if t == s), lose, risk / (len(EDGES) + 1))
        cut = 0
        while left >= 0 and cut < BINS and left >= seen.get((s, cut), 0):
            left -= seen.get((s, cut), 0)
            cut += 1
        out.append(cut / BINS)
    return tuple(out)


def accepted(cutoffs: tuple[float, ...], text: Column, lang: Column, score: Column) -> Column:
    """Whether a text has a language: not ``und``, and its score reaches its length class's cutoff."""
    least = F.element_at(F.array(*[F.lit(float(c)) for c in cutoffs]), stratum(text) + 1)
    return (lang != "und") & (score >= least)


__all__ = ["stratum", "certified", "calibrate", "accepted", "presence", "features", "unit", "Model", "held_out",
           "normal_equations", "fit", "predict"]
