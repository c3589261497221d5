"""Exploratory spike detection over post counts per channel and time bucket.

Input is the bucketed count table (``counts.bucket_counts``): one row per
(channel, bucket), so each window partition holds one channel's buckets --
bounded by the time range, never by the number of posts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _w(keys, order="bucket_ts"):
    return Window.partitionBy(*keys).orderBy(order)


def bucket_growth(cnt: DataFrame, keys=("channel",)) -> DataFrame:
    """prev_cnt and growth in percent vs the previous bucket; 0.0 without a positive previous."""
    w = _w(keys)
    df = cnt.withColumn("prev_cnt", F.lag("cnt", 1).over(w))
    p = F.col("prev_cnt")
    return df.withColumn("growth", F.when(p.isNull() | (p <= 0), F.lit(0.0))
                         .otherwise((F.col("cnt") - p) / p * 100).cast("double"))


def centered_ma(cnt: DataFrame, keys=("channel",), width: int = 3) -> DataFrame:
    """Centred moving average over ``width`` buckets; null where the window is incomplete."""
    half = width // 2
    frame = _w(keys).rowsBetween(-half, half)
    return cnt.withColumn("count_ma", F.when(F.count("cnt").over(frame) == width,
                                             F.avg("cnt").over(frame)))


def ma_growth(df: DataFrame, keys=("channel",)) -> DataFrame:
    """Percent change of the moving average vs the previous bucket (null if undefined)."""
    prev = F.lag("count_ma", 1).over(_w(keys))
    return df.withColumn("growth_rate_ma", (F.try_divide(F.col("count_ma"), prev) - 1) * 100)


def exceed_streak(df: DataFrame, threshold: float = 50.0, keys=("channel",),
                  reference_offset: bool = False) -> DataFrame:
    """``exceed`` = growth >= threshold; ``streak`` = length of the current run of exceeds.

    Gaps and islands: a running count of non-exceeding buckets numbers the
    islands; the streak is the running sum of exceeds inside the island.
    ``reference_offset`` reproduces the notebook, which also counted the
    non-exceeding bucket that opens an island (runs after the first one
    read one too high).
    """
    w = _w(keys)
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("exceed", (F.col("growth") >= F.lit(float(threshold))).cast("int"))
    df = df.withColumn("_island", F.sum(1 - F.col("exceed")).over(run))
    in_island = Window.partitionBy(*keys, "_island").orderBy("bucket_ts").rowsBetween(
        Window.unboundedPreceding, 0)
    streak = F.sum("exceed").over(in_island)
    if reference_offset:
        streak = streak + F.when(F.col("_island") > 0, 1).otherwise(0)
    return df.withColumn("streak", F.when(F.col("exceed") == 1, streak).otherwise(0)
                         .cast("int")).drop("_island")


def streak_alerts(df: DataFrame, min_streak: int = 3) -> DataFrame:
    return df.where(F.col("streak") >= min_streak)


def spike_table(cnt: DataFrame, threshold: float = 50.0, keys=("channel",),
                reference_offset: bool = False) -> DataFrame:
    """All notebook columns: cnt, prev_cnt, growth, count_ma, growth_rate_ma, exceed, streak."""
    df = bucket_growth(cnt, keys)
    df = centered_ma(df, keys)
    df = ma_growth(df, keys)
    return exceed_streak(df, threshold, keys, reference_offset)
