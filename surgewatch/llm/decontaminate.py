"""Benchmark decontamination by template canonicalisation.

Every word becomes a canonical token: lower case without punctuation, and numbers,
names (capitalised words inside a sentence) and units (after a number) become typed
placeholders.  An item has further forms beside that: its first word as one inside a
sentence (a text may quote the item there), and names as plain words (a text may have
it in lower or upper case).  Windows of ``WIDTH`` tokens are hashed; the documents' windows are
joined to the items' windows by hash, each with the words in its slots.  A document
may hold several copies of an item with other words in the slots, so a place of it is
judged alone: in a place, each slot word of the item must stand for one word of the
document (the most frequent one; windows that say otherwise are dropped), and the
item is found if at least ``similarity`` of its windows remain in any one place.
Places are single offsets (document's word minus item's word: a copy without words
put in or left out), cells of offsets one item long, in steps of half an item (a copy
with less than half an item of words put in or left out lies within one, without
those beside it), and the whole document (parts far apart).  The place with the most
windows is reported, of equals one with the item's own slot words.  An item found
with other slot words than its own is re-parameterised.  Windows of placeholders only
are no evidence of a template: they count where they hold the item's own words.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from surgewatch.llm.common import broadcast_if_small, cut, fresh, let, words

WIDTH, SIMILARITY = 5, 0.8
#: Windows of the items up to this number are broadcast (about 100 bytes each); beyond, both sides are shuffled.
BROADCAST_WINDOWS = 500_000
PUNCTUATION = ".,;:!?\"'()[]{}"
#: Placeholders of numbers, names and units.
NUMBER, NAME, UNIT = "<number>", "<name>", "<unit>"
#: Unit words, after a number (fixed values).
UNITS = ("%", "percent", "mm", "cm", "m", "km", "meter", "meters", "metres", "kilometers", "kilometres", "mile", "miles",
         "inch", "inches", "foot", "feet", "yard", "yards", "g", "kg", "gram", "grams", "kilogram", "kilograms", "lb", "lbs",
         "pound", "pounds", "ounce", "ounces", "ton", "tons", "ml", "l", "liter", "liters", "litres", "gallon", "gallons",
         "s", "second", "seconds", "minute", "minutes", "hour", "hours", "day", "days", "week", "weeks", "month", "months",
         "year", "years", "dollar", "dollars", "euro", "euros", "cent", "cents", "usd", "eur", "mph", "kph", "degrees")


def _plain(w: Column) -> Column:
    return F.translate(F.lower(w), PUNCTUATION, "")


def _is_number(plain: Column) -> Column:
    return plain.rlike("^[$€£+-]?[0-9]+(st|nd|rd|th|%)?$")


#: Forms of an item, as documents may hold it: itself, inside a sentence, without case.
FORMS = ("own", "inside", "caseless")


def _canonical(w: Column, i: Column, x: Column, form: str = "own") -> Column:
    """Canonical token of word ``x``, the ``i``-th of ``w``."""
    before = F.get(w, i - 1)
    inside = F.when(i > 0, ~before.rlike("[.!?]$")).otherwise(F.lit(form == "inside"))
    return let(_plain(x), lambda p: F.when(_is_number(p), F.lit(NUMBER))
               .when(F.lit(form != "caseless") & x.rlike(r"^\p{Lu}.*\p{Ll}") & inside, F.lit(NAME))
               .when((i > 0) & p.isin(*UNITS) & _is_number(_plain(before)), F.lit(UNIT)).otherwise(p))


def windows(rows: DataFrame, key: list[str], text_col: str = "text", widths: Sequence[int] = (WIDTH,),
            form: str = "own") -> DataFrame:
    """``key``, ``i`` (first word), ``h`` (hash of the tokens), ``slots`` (words in them, null without any).

    A window of placeholders only says nothing: its hash is of the words in them.
    """
    marks = [F.xxhash64(F.lit(m)) for m in (NUMBER, NAME, UNIT)]

    def cut_up(w: Column, h: Column, width: int, slotted: Column) -> Column:
        slots = lambda i: F.array_compact(F.array(*[
            F.when(F.get(h, i + k).isin(*marks), _plain(F.get(w, i + k))) for k in range(width)]))
        tokens = lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(width)])
        at = F.when(F.size(h) >= width, F.sequence(F.lit(0), F.size(h) - width)).otherwise(F.array().cast("array<int>"))
        none = F.lit(None).cast("array<string>")
        return F.transform(at, lambda i: let(F.when(slotted, slots(i)).otherwise(none), lambda s: F.struct(
            i.alias("i"), F.when(F.size(s) == width, F.xxhash64(F.lit("bare"), s)).otherwise(tokens(i)).alias("h"), s.alias("slots"))))
    each = lambda w, h: let(F.exists(h, lambda v: v.isin(*marks)), lambda s: F.concat(
        *[cut_up(w, h, k, s) for k in widths]))
    own = let(words(F.col(text_col).cast("string")), lambda w: F.when(F.size(w) >= min(widths), let(
        F.transform(w, lambda x, i: F.xxhash64(_canonical(w, i, x, form))), lambda h: each(w, h))))
    return rows.select(*key, F.inline(own)).withColumn("slots", F.when(F.size("slots") > 0, F.col("slots")))


def contaminated(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY, width: int = WIDTH) -> DataFrame:
    """``(doc_id, text_id, item_id, n_windows, n_found, similarity, reparameterised)`` for found items.

    ``docs(doc_id, text)``, ``items(item_id, text)``; other columns are not read.
    An item of fewer than ``width`` words is one window of its own length.  Null texts and
    texts without words have no window: such items can't be found and such documents hold
    none.  Rows equal in id and text count as one; null ids are values like any other.
    Empty tables: no rows.
    """
    texts = items.select(F.col("item_id"), F.col("text")).distinct()
    size = F.least(F.size(words(F.col("text").cast("string"))), F.lit(width))
    widths = sorted(r[0] for r in texts.select(size.alias("n")).distinct().filter("n > 0").collect()) or [width]  # at most `width`
    own = reduce(DataFrame.union, [windows(texts.filter(size == k), ["item_id"], widths=(k,), form=f) for k in widths for f in FORMS])
    own = cut(own.select("item_id", F.col("i").alias("at"), "h", F.col("slots").alias("want")).distinct())
    n = own.groupBy("item_id").agg(F.count_distinct("at").alias("n_windows"))
    base = docs.select(F.col("doc_id"), F.xxhash64("text").alias("text_id"), "text")
    n = broadcast_if_small(n, n.count(), BROADCAST_WINDOWS)
    hits = cut(windows(base, ["doc_id", "text_id"], widths=widths).join(
        broadcast_if_small(own, own.count(), BROADCAST_WINDOWS), "h")
        .filter("slots is null or size(slots) = size(want)")
        .select("doc_id", "text_id", "i", "item_id", "at", "slots", "want").distinct())
    pair = ["doc_id", "text_id", "item_id"]
    place = [*pair, "kind", "cell"]
    same = lambda a, b, cols: F.lit(True) & F.expr(" and ".join(f"{a}.`{c}` <=> {b}.`{c}`" for c in cols))
    enough = lambda found: F.col(found) >= similarity * F.col("n_windows")
    # no place of a pair has more of the item's windows than the whole document
    likely = (hits.groupBy(*pair).agg(F.count_distinct("at").alias("n_hit")).alias("p").join(n.alias("n"), same("p", "n", ["item_id"]))
              .filter(enough("n_hit")).select("p.doc_id", "p.text_id", "p.item_id", "n_windows"))
    half = F.floor((F.col("n_windows") + (width - 1)) / 2)
    cell = F.floor((F.col("i") - F.col("at")) / half)
    spots = [F.struct(F.lit(k).alias("kind"), c.cast("long").alias("cell")) for k, c in (
        ("document", F.lit(0)), ("offset", F.col("i") - F.col("at")), ("cell", cell), ("cell", cell - 1))]
    placed = cut(hits.alias("h").join(likely.alias("p"), same("h", "p", pair)).select("h.*", "n_windows").select(
        "*", F.inline(F.array(*spots))))
    filled = placed.filter("slots is not null").select(
        *place, "n_windows", "at", "i", F.explode(F.arrays_zip("want", "slots")).alias("s")).select(
        *place, "n_windows", "at", "i", F.col("s.want").alias("w"), F.col("s.slots").alias("v"))
    vote = filled.groupBy(*place, "w", "v").agg(F.count("*").alias("c")).groupBy(*place, "w").agg(
        F.max_by("v", F.struct("c", "v")).alias("best"))
    agreed = (filled.alias("f").join(vote.alias("b"), same("f", "b", [*place, "w"])).select(
        "f.*", F.col("b.best")).groupBy(*place, "n_windows", "at", "i").agg(
        F.min(F.col("v") == F.col("best")).alias("ok"), F.max(F.col("w") != F.col("best")).alias("other")))
    found = agreed.filter("ok").select(*place, "n_windows", "at", "other").union(
        placed.filter("slots is null").select(*place, "n_windows", "at", F.lit(False)))
    score = found.groupBy(*place, "n_windows").agg(
        F.count_distinct("at").alias("n_found"), F.max("other").alias("reparameterised")).filter(enough("n_found"))
    best = F.max_by(F.struct("n_found", "reparameterised"), F.struct(F.col("n_found"), ~F.col("reparameterised")))
    return score.groupBy(*pair, "n_windows").agg(best.alias("b")).select(
        *pair, "n_windows", "b.n_found", (F.col("b.n_found") / F.col("n_windows")).alias("similarity"), "b.reparameterised")


def remove_contaminated(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` without the documents that hold an item; all columns are kept, whatever their names.

    Rows equal in id and text go or stay together; null ids and texts, and empty tables, as in ``contaminated``.
    """
    d, t = fresh(docs, "_d", "_t")
    bad = contaminated(docs, items, similarity).select(
        F.col("doc_id").alias(d), F.col("text_id").alias(t)).distinct()
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col(d)) & (F.xxhash64("text") == F.col(t)), "left_anti")


__all__ = ["windows", "contaminated", "remove_contaminated"]
