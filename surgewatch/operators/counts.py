"""Counts over mapped posts: the time series the metrics run on.

Counts are of match rows, not posts: a post matching two keywords of one
category adds two to that category.  Aggregations are hash aggregates with
map-side partial combine, so a hot key costs one row per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surgewatch.functions.timefmt import bucket_start
from surgewatch.operators.match import NO_MATCH
from surgewatch.schema import COUNT_KEYS
from surgewatch.session import checkpoint_dir


def count_keyword(mapped: DataFrame) -> DataFrame:
    """(collected_time, channel, query, category, keyword) -> count_keyword."""
    return (mapped.where(F.col("category") != NO_MATCH)
            .groupBy(*COUNT_KEYS, "keyword").agg(F.count(F.lit(1)).alias("count_keyword")))


def count_category(mapped: DataFrame) -> DataFrame:
    """(collected_time, channel, query, category) -> count_category."""
    return (mapped.where(F.col("category") != NO_MATCH)
            .groupBy(*COUNT_KEYS).agg(F.count(F.lit(1)).alias("count_category")))


def category_hits(hits: DataFrame, key: str) -> DataFrame:
    """``key, category, n_hits``: the hits of a text by category, for posts that refer to texts by ``key``.

    With a large wordbag a text has a hit for nearly each of its words, but a row here per category.
    """
    return (hits.where(F.col("category") != NO_MATCH)
            .groupBy(key, "category").agg(F.count(F.lit(1)).alias("n_hits")))


def sum_category_hits(posts: DataFrame) -> DataFrame:
    """count_category of posts beside the ``category_hits`` of their texts (equal to ``count_category``)."""
    return posts.groupBy(*COUNT_KEYS).agg(F.sum("n_hits").cast("long").alias("count_category"))


def category_from_keyword_counts(kw_counts: DataFrame) -> DataFrame:
    """count_category as the sum of keyword counts (equal to ``count_category``).

    Lets one scan of the posts feed both count tables: the second aggregate
    runs over the (small) keyword counts.
    """
    return kw_counts.groupBy(*COUNT_KEYS).agg(
        F.sum("count_keyword").cast("long").alias("count_category"))


def category_keyword_counts(kw_counts: DataFrame) -> DataFrame:
    """Keyword counts with their category count attached.

    The reference left-joins the category counts; as count_category is the
    sum of count_keyword over the same four keys, a window sum gives it with
    one exchange and no join.
    """
    w = Window.partitionBy(*COUNT_KEYS)
    return kw_counts.select(*COUNT_KEYS, "keyword",
                            F.sum("count_keyword").over(w).cast("long").alias("count_category"),
                            "count_keyword")


def top_keywords(ckc: DataFrame, k: int | None = None) -> DataFrame:
    """Order by count_category desc, count_keyword desc (keys break ties); optional top k."""
    ordered = ckc.orderBy(F.desc("count_category"), F.desc("count_keyword"),
                          *[F.asc_nulls_first(c) for c in COUNT_KEYS + ["keyword"]])
    return ordered.limit(k) if k else ordered


def ranked_keywords(ckc: DataFrame, partitions: int | None = None) -> DataFrame:
    """All rows with their place in the order of ``top_keywords`` (``rank``, from 1).

    The rows are range-partitioned on the whole order, keys included, so that equal counts
    don't gather in one task, and numbered inside their partitions; the rows of the
    partitions before are added.  Numbered rows are written to the checkpoint folder: a
    lost executor can't number them anew.
    """
    spark = ckc.sparkSession
    checkpoint_dir(spark)
    order = [F.desc("count_category"), F.desc("count_keyword"), *[F.asc_nulls_first(c) for c in COUNT_KEYS + ["keyword"]]]
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = F.monotonically_increasing_id()  # partition and row in it
    inside = ckc.repartitionByRange(n, *order).sortWithinPartitions(*order).select(
        *ckc.columns, F.shiftright(place, 33).alias("_part"), place.bitwiseAND(F.lit((1 << 33) - 1)).alias("_in")).checkpoint()
    sizes = inside.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # a row per partition
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    return inside.join(F.broadcast(sizes), "_part").select(
        *ckc.columns, (F.col("_before") + F.col("_in") + 1).cast("long").alias("rank"))


def distinct_counts(cat_counts: DataFrame) -> DataFrame:
    return cat_counts.select(*COUNT_KEYS, "count_category").dropDuplicates()


def total_count(cat_counts: DataFrame) -> DataFrame:
    """Attach the total over all categories of (collected_time, channel, query)."""
    w = Window.partitionBy("collected_time", "channel", "query")
    return cat_counts.withColumn("total_count", F.sum("count_category").over(w).cast("long"))


def bucket_counts(posts: DataFrame, ts: str = "uploaded_time", width: str = "10 minutes",
                  keys: tuple[str, ...] = ("channel",)) -> DataFrame:
    """Posts per key and ``width`` time bucket (rows without a time are dropped)."""
    return (posts.where(F.col(ts).isNotNull())
            .groupBy(*keys, bucket_start(ts, width).alias("bucket_ts"))
            .agg(F.count(F.lit(1)).alias("cnt")))
