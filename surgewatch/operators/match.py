"""Keyword matching: posts x wordbag.

A post matches a keyword when the keyword is one of its tokens after
stopword removal; a keyword counts once per post (set intersection), and
fans out to every category it belongs to.  Posts without a match map to
category = keyword = ``'no'``.

Two physical strategies with equal results, chosen by a size check on the wordbag:

* ``literal`` (bags up to ``LITERAL_KEYWORD_LIMIT`` matchable keywords):
  the keyword set is a literal in the plan; of each post's tokens those that begin like
  a keyword and are as long as one are taken out, and kept if they are in the set (a
  hash-set probe) and only matches are exploded, then joined to the bag.  One pass, no
  shuffle of posts.
* ``join`` (larger bags): distinct tokens are exploded beside a 128-bit key of
  the post only, joined to the bag's keywords, gathered per key and joined back
  once; equal posts share a key and a matched set.  Texts are never exploded.
  Counts need no post back: ``hit_keys`` explodes the tokens beside the count keys.

The bag is broadcast when its measured bytes are below
``BROADCAST_BAG_BYTES``, otherwise joins on it are shuffled.

Stopword removal and the minimum token length are applied to the keyword
side (a keyword that is a stopword or shorter than two characters can never
equal a surviving token), which gives the same matches as filtering every
token of every post.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surgewatch.config import BROADCAST_BAG_BYTES, LITERAL_KEYWORD_LIMIT
from surgewatch.functions import text as T
from surgewatch.functions.stopwords import ENGLISH_STOPWORDS

NO_MATCH = "no"


def normalize_wordbag(bag: DataFrame) -> DataFrame:
    """trim + lower both columns; drop empty keywords and repeated pairs.

    (The reference keeps repeated pairs, which double-count; dropping them is
    a documented deviation.)
    """
    b = bag.select(F.trim(F.lower("category")).alias("category"),
                   F.trim(F.lower("keyword")).alias("keyword"))
    return b.where(F.col("keyword").isNotNull() & (F.col("keyword") != "")
                   & F.col("category").isNotNull()).dropDuplicates(["category", "keyword"])


def matchable_keywords(bag: DataFrame, min_length: int = 2) -> DataFrame:
    """Rows of a normalized bag whose keyword can equal a surviving token."""
    stop = F.lit(sorted({w.lower() for w in ENGLISH_STOPWORDS}))
    return bag.where(F.col("keyword").rlike(f"^[a-z0-9]{{{min_length},}}$")
                     & ~F.array_contains(stop, F.col("keyword")))


@dataclass
class Matcher:
    """A planned matching strategy over one normalized wordbag."""

    bag: DataFrame            # normalized bag, all rows
    usable: DataFrame         # rows with a matchable keyword
    strategy: str             # "literal" or "join"
    keywords: list[str] | None  # literal strategy only
    broadcast_bag: bool

    def _bag_side(self, df: DataFrame) -> DataFrame:
        return F.broadcast(df) if self.broadcast_bag else df

    # -- per-post matched set ------------------------------------------------
    def matched_column(self, text: str | Column = "text") -> Column:
        """Distinct matched keywords of a post (literal strategy)."""
        if self.strategy != "literal":
            raise ValueError("matched_column needs the literal strategy; use match_keywords")
        if not self.keywords:
            return F.array().cast("array<string>")
        return F.array_distinct(F.filter(T.words_like(text, self.keywords), lambda w: w.isin(self.keywords)))

    def match_keywords(self, posts: DataFrame, text: str = "text",
                       out: str = "matched") -> DataFrame:
        """posts + ``matched`` (array of distinct matched keywords, sorted)."""
        if self.strategy == "literal":
            return posts.withColumn(out, F.array_sort(self.matched_column(text)))
        kw = self._bag_side(self.usable.select("keyword").distinct())
        keys = [F.xxhash64(*posts.columns).alias("_k1"), F.xxhash64(F.lit(1), *posts.columns).alias("_k2")]
        # the keys are computed below the explode: it carries them, not the columns they come from
        hit = (posts.select(*keys, F.array_distinct(T.words(text)).alias("_w"))
               .select("_k1", "_k2", F.explode("_w").alias("keyword"))
               .join(kw, "keyword").groupBy("_k1", "_k2")
               .agg(F.array_sort(F.collect_set("keyword")).alias(out)))
        return (posts.select("*", *keys).join(hit, ["_k1", "_k2"], "left")
                .select(*posts.columns, F.coalesce(out, F.array().cast("array<string>")).alias(out)))

    def _with_matches(self, posts: DataFrame, text: str) -> DataFrame:
        if self.strategy == "literal":
            return posts.withColumn("_matched", self.matched_column(text))
        return self.match_keywords(posts, text, "_matched")

    # -- hits / misses / mapped ------------------------------------------------
    def hits(self, posts: DataFrame, text: str = "text") -> DataFrame:
        """One row per (post, matched keyword, category)."""
        ex = self._with_matches(posts, text).withColumn("keyword", F.explode("_matched")).drop("_matched")
        return ex.join(self._bag_side(self.usable), "keyword")

    def hit_keys(self, posts: DataFrame, columns: list[str], text: str = "text") -> DataFrame:
        """``columns``, keyword and category per (post, matched keyword, category): what counts need.

        A post's tokens are made distinct inside its row and exploded beside ``columns`` only, so
        no text is carried and nothing is gathered per post.  The bag is the one join, with a
        static frame: streams run it in any output mode, with wordbags of any size.
        """
        if self.strategy == "literal":
            tokens = self.matched_column(text)
        else:
            tokens = T.remove_stopwords(F.array_distinct(T.words(text)))
        return (posts.select(*columns, F.explode(tokens).alias("keyword"))
                .join(self._bag_side(self.usable), "keyword").select(*columns, "keyword", "category"))

    def misses(self, posts: DataFrame, text: str = "text") -> DataFrame:
        """Posts without any match, with category = keyword = 'no'."""
        m = self._with_matches(posts, text).where(F.size("_matched") == 0).drop("_matched")
        return m.withColumns({"category": F.lit(NO_MATCH), "keyword": F.lit(NO_MATCH)})

    def mapped(self, posts: DataFrame, text: str = "text") -> DataFrame:
        """Every post: one row per matched (keyword, category), or one 'no' row."""
        ex = self._with_matches(posts, text).withColumn("keyword", F.explode_outer("_matched")).drop("_matched")
        j = ex.join(self._bag_side(self.usable), "keyword", "left")
        return j.withColumns({
            "category": F.coalesce("category", F.lit(NO_MATCH)),
            "keyword": F.coalesce("keyword", F.lit(NO_MATCH)),
        })


def plan_matcher(bag: DataFrame, literal_limit: int = LITERAL_KEYWORD_LIMIT,
                 broadcast_bytes: int = BROADCAST_BAG_BYTES,
                 strategy: str = "auto") -> Matcher:
    """Normalize the wordbag and choose the strategy from its checked size.

    Runs one small aggregation over the bag (a dimension table) to learn its
    size; only a bag of at most ``literal_limit`` matchable keywords is
    brought to the driver, as the literal keyword set.
    """
    norm = normalize_wordbag(bag)
    usable = matchable_keywords(norm)
    stats = usable.agg(F.count(F.lit(1)).alias("rows"),
                       F.count_distinct("keyword").alias("keywords"),
                       F.sum(F.octet_length("keyword") + F.octet_length("category")).alias("bytes")).first()
    n_rows, n_kw = int(stats["rows"]), int(stats["keywords"])
    use_broadcast = int(stats["bytes"] or 0) + 64 * n_rows <= broadcast_bytes  # and row overhead
    if strategy == "auto":
        strategy = "literal" if n_kw <= literal_limit else "join"
    keywords = None
    if strategy == "literal":
        if n_kw > literal_limit:
            raise ValueError(f"wordbag has {n_kw} keywords, above the literal limit {literal_limit}")
        keywords = sorted(r["keyword"] for r in usable.select("keyword").distinct().collect())
    return Matcher(bag=norm, usable=usable, strategy=strategy, keywords=keywords,
                   broadcast_bag=use_broadcast)


def map_with_wordbag(posts: DataFrame, bag: DataFrame, text: str = "text",
                     strategy: str = "auto") -> DataFrame:
    """The whole mapping of the reference job (8 post columns + category, keyword)."""
    return plan_matcher(bag, strategy=strategy).mapped(posts, text)
