"""Line dedup: later copies of repeated runs of lines are deleted.

Documents are sequences of line ids (128-bit hashes of the lines).  Prefix doubling
ranks all suffixes by their first 1, 2, 4, ... lines: the rank of a suffix at a level
is the first place, in document order, of the same lines, so equal ranks are one
interval of the suffix array whose longest common prefix is at least that long.
A suffix alone in its interval is settled and leaves; only repeated lines go on, and
doubling stops when no interval or no run of the needed length is left.  (Places
instead of sorted numbers name the intervals: only their equality matters here, and
grouping needs no global sort.)

A run counts if it has ``min_words`` words; each letter of a script written without spaces
is one.  Every maximal repeated run of that size
is the union of its shortest sufficient runs, taken forwards from each of its lines and
backwards from each, so those are looked up: the run of ``m`` lines from a place has
the interval that the ranks of its first and last ``2^k`` lines name together.  What
occurred earlier is covered, and the covered lines of a document, merged, are the
later copies' lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from surgewatch.llm.common import cut, fresh, let, named, words

MIN_WORDS = 50
#: Thai to Lao, Myanmar, Khmer, kana, Han (fixed values, of Unicode's blocks).
UNSPACED = "[\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3041-\u30FF\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\U00020000-\U0003FFFD]"


def _place(line: str = "p") -> Column:
    """Order of places: by id (null last), then text, then line."""
    return F.struct(F.col("doc").isNull().alias("n"), "doc", "text_id", F.col(line).alias("p"))


def lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc, text_id, p, a, b, w)``: place, line id and number of words of each line (null texts have none)."""
    text = F.col(text_col).cast("string")
    # the key is computed below the explode, so that no line carries its whole text
    own = docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text).alias("text_id"),
                      F.split(text, "\n").alias("lines"))
    return own.select("doc", "text_id", F.posexplode("lines").alias("p", "line")).select(
        "doc", "text_id", "p", F.xxhash64("line").alias("a"), F.xxhash64(F.lit(1), "line").alias("b"),
        n_words(F.col("line")).alias("w"))


def n_words(line: Column) -> Column:
    """Words between white space; each letter of a script written without spaces is a word of its own."""
    apart = F.when(F.octet_length(line) > F.length(line), F.regexp_replace(line, UNSPACED, " x ")).otherwise(line)
    return F.size(words(apart))


def _intervals(rows: DataFrame, key: list[str]) -> DataFrame:
    """``key`` -> first place, for keys at two places or more.

    Cut, so that the join with a key's rows reads plain exchanges on both sides and a
    hot key's rows can be split.
    """
    return cut(rows.groupBy(*key).agg(F.min("place").alias("rank"), F.max("place").alias("_last"))
               .filter("rank <> _last").drop("_last"))


def _runs(active: DataFrame, min_words: int) -> DataFrame:
    """``(doc, text_id, s, m)``: shortest runs of ``min_words`` words within stretches of repeated lines."""
    doc = Window.partitionBy("doc", "text_id").orderBy("p")
    own = active.select("doc", "text_id", "p", "w").distinct() \
        .withColumn("stretch", F.col("p") - F.row_number().over(doc))
    part = Window.partitionBy("doc", "text_id", "stretch")
    own = own.withColumn("upto", F.sum("w").over(part.orderBy("p").rowsBetween(Window.unboundedPreceding, 0))) \
        .withColumn("before", F.col("upto") - F.col("w"))
    ahead = part.orderBy("before").rangeBetween(0, min_words - 1)
    own = own.withColumn("e", F.max("p").over(ahead)).withColumn("ahead", F.max("upto").over(ahead))
    back = part.orderBy("upto").rangeBetween(-(min_words - 1), 0)
    own = own.withColumn("s", F.min("p").over(back)).withColumn("behind", F.min("before").over(back))
    one = own.filter(F.col("ahead") - F.col("before") >= min_words).select(
        "doc", "text_id", F.col("p").alias("s"), (F.col("e") - F.col("p") + 1).alias("m"))
    two = own.filter(F.col("upto") - F.col("behind") >= min_words).select(
        "doc", "text_id", "s", (F.col("p") - F.col("s") + 1).alias("m"))
    return one.union(two).distinct()


def _same(a: str, b: str, *more) -> Column:
    on = F.col(f"{a}.doc").eqNullSafe(F.col(f"{b}.doc")) & (F.col(f"{a}.text_id") == F.col(f"{b}.text_id"))
    for m in more:
        on = on & m
    return on


def later_copies(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``(doc, text_id, start, stop)``: maximal stretches of lines (from 0, stop excluded) that
    belong to later copies of repeated runs."""
    all_lines = lines(docs, id_col, text_col).withColumn("place", _place())
    repeated = _intervals(all_lines, ["a", "b"])
    active = cut(all_lines.join(repeated, ["a", "b"]).select("doc", "text_id", "p", "w", "rank"))
    runs = cut(_runs(active, min_words).withColumn("k", F.floor(F.log2("m")).cast("int")))
    longest = runs.agg(F.max("k")).first()[0]
    ranks, covered, k = active.select("doc", "text_id", "p", "rank").distinct(), None, 0
    while longest is not None and k <= longest:
        step = 1 << k
        own = cut(runs.filter(F.col("k") == k).alias("r")
                  .join(ranks.alias("x"), _same("r", "x", F.col("r.s") == F.col("x.p")))
                  .select("r.*", F.col("x.rank").alias("head")).alias("r")
                  .join(ranks.alias("y"), _same("r", "y", F.col("r.s") + F.col("r.m") - step == F.col("y.p")))
                  .select("r.*", F.col("y.rank").alias("tail")).withColumn("place", _place("s")))
        first = _intervals(own, ["m", "head", "tail"])
        late = cut(own.join(first, ["m", "head", "tail"]).filter("rank < place").select("doc", "text_id", "s", "m"))
        covered = late if covered is None else covered.union(late)
        k += 1
        if k > longest:
            break
        pairs = (ranks.alias("x").join(ranks.alias("y"), _same("x", "y", F.col("x.p") + step == F.col("y.p")))
                 .select("x.doc", "x.text_id", "x.p", F.col("x.rank").alias("r1"), F.col("y.rank").alias("r2"))
                 .withColumn("place", _place()))
        ranks = cut(pairs.join(_intervals(pairs, ["r1", "r2"]), ["r1", "r2"]).select("doc", "text_id", "p", "rank"))
    if covered is None:
        covered = runs.select("doc", "text_id", "s", "m")
    doc = Window.partitionBy("doc", "text_id").orderBy("s", "m")
    ends = covered.withColumn("stop", F.col("s") + F.col("m")) \
        .withColumn("before", F.max("stop").over(doc.rowsBetween(Window.unboundedPreceding, -1)))
    merged = ends.withColumn("n", F.sum(F.when(F.col("s") <= F.col("before"), 0).otherwise(1)).over(
        doc.rowsBetween(Window.unboundedPreceding, 0)))
    return merged.groupBy("doc", "text_id", "n").agg(F.min("s").alias("start"), F.max("stop").alias("stop")).drop("n")


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``docs`` with later copies' lines cut from the text, and ``n_lines``, ``n_removed``.

    The first copy, in the order of ids (null last), then texts' hashes, then lines,
    stays.  A document all of whose lines are later copies keeps an empty text; a null
    text stays null (0 lines).  Rows equal in id and text are one document: they get
    the same result and aren't copies of each other.  Runs of fewer words stay.
    Empty table: no rows.  Columns ``n_lines`` and ``n_removed`` are replaced, all
    others kept.
    """
    gone = later_copies(docs, min_words, id_col, text_col).groupBy("doc", "text_id").agg(
        F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("gone"))  # within one document
    keep = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    doc, text_id, runs = fresh(docs.select(*named(docs, "n_lines", "n_removed")), "_doc", "_text_id", "_gone")
    gone = cut(gone).select(F.col("doc").alias(doc), F.col("text_id").alias(text_id), F.col("gone").alias(runs))
    text = F.col(text_col).cast("string")
    own = docs.select(*named(docs, "n_lines", "n_removed")).join(
        gone, F.col(id_col).cast("long").eqNullSafe(F.col(doc)) & (F.xxhash64(text) == F.col(text_id)), "left")
    n_lines = F.when(text.isNull(), 0).otherwise(F.length(text) - F.length(F.translate(text, "\n", "")) + 1)
    n_removed = F.aggregate(runs, F.lit(0), lambda n, g: n + g["stop"] - g["start"])
    size = F.size(runs)
    own = own.withColumn("n_lines", n_lines.cast("long")).withColumn(
        "n_removed", F.coalesce(n_removed, F.lit(0)).cast("long"))
    between = lambda x, j: F.slice(  # noqa: E731  the lines after the j-th removed stretch
        x, F.coalesce(F.get(runs, j - 1)["stop"], F.lit(0)) + 1,
        F.coalesce(F.get(runs, j)["start"], F.size(x)) - F.coalesce(F.get(runs, j - 1)["stop"], F.lit(0)))
    rebuilt = let(F.split(text, "\n"), lambda x: F.array_join(F.flatten(F.transform(
        F.sequence(F.lit(0), size), lambda j: between(x, j))), "\n"))
    new = F.when(F.col(runs).isNull(), text).otherwise(rebuilt)
    return own.select(*[new.alias(c) if c == text_col else k for c, k in zip(keep, named(docs, "n_lines", "n_removed"))],
                      "n_lines", "n_removed")


__all__ = ["lines", "later_copies", "dedup_lines", "MIN_WORDS"]
