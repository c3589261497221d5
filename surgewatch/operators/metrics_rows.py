"""Spike metrics, ``rows`` mode: window functions over each count series.

Series = (channel, query, category) ordered by collected_time.  Frames are
counted in rows, so a gap in the series is spanned silently; a point without
enough history has null terms and a null score (only scored points alert).

Plan: the counts are already aggregated (one row per series point), so each
window partition holds one series (bounded by the number of snapshots) or
one snapshot's categories; two exchanges, one per partitioning.  The
acceleration window reuses the series partitioning and ordering.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surgewatch.config import DEFAULT_WEIGHTS, LONG_TERM_ROWS, VOLATILITY_ROWS
from surgewatch.schema import METRICS_COLUMNS, SERIES_KEYS


def weighted_score(weights=DEFAULT_WEIGHTS):
    w = [float(x) for x in weights]
    return (F.lit(w[0]) * F.col("short_term_growth") + F.lit(w[1]) * F.col("long_term_ratio")
            + F.lit(w[2]) * F.col("ratio_to_total") + F.lit(w[3]) * F.col("volatility")
            + F.lit(w[4]) * F.col("acceleration"))


def calculate_metrics(counts: DataFrame, weights=DEFAULT_WEIGHTS,
                      time_col: str = "collected_time", count_col: str = "count_category",
                      long_rows: int = LONG_TERM_ROWS, vol_rows: int = VOLATILITY_ROWS,
                      pieces: tuple[str, str] | None = None) -> DataFrame:
    """Metrics table (sink columns) from category counts.

    ``pieces``: the columns of ``operators.pieces.with_halo`` (piece, own) where ``counts``
    are cut into pieces and already have their ``_total``.
    """
    keys = [*SERIES_KEYS, *(pieces or ())[:1]]
    series = Window.partitionBy(*keys).orderBy(time_col)
    snapshot = Window.partitionBy("channel", "query", time_col)
    c = F.col(count_col)
    # snapshot total first: the series windows after it (lags, frames, and the
    # acceleration over growth) then share one partitioning and one exchange
    if not pieces:
        counts = counts.withColumn("_total", F.sum(c).over(snapshot))
    base = counts.select(
        *SERIES_KEYS, *(pieces or ()), F.col(time_col).alias("cur_time"), c.alias("cur_count"),
        F.lag(time_col, 1).over(series).alias("prev_time"),
        F.lag(c, 1).over(series).alias("prev_count"),
        F.avg(c).over(series.rowsBetween(-long_rows, -1)).alias("_avg_long"),
        F.stddev_samp(c).over(series.rowsBetween(-vol_rows, -1)).alias("_sd_vol"),
        F.avg(c).over(series.rowsBetween(-vol_rows, -1)).alias("_avg_vol"),
        "_total",
    )
    prev = F.col("prev_count")
    growth = (F.col("cur_count") - prev) / F.when(prev > 0, prev).otherwise(F.lit(1))
    m = base.select(
        *SERIES_KEYS, *(pieces or ()), "cur_time", "prev_time", "cur_count", "prev_count",
        growth.alias("short_term_growth"),
        F.try_divide(F.col("cur_count"), F.col("_avg_long")).alias("long_term_ratio"),
        F.try_divide(F.col("_sd_vol"), F.col("_avg_vol")).alias("volatility"),
        F.try_divide(F.col("cur_count"), F.col("_total")).cast("double").alias("ratio_to_total"),
    )
    by_time = Window.partitionBy(*keys).orderBy("cur_time")
    m = m.withColumn("acceleration",
                     F.col("short_term_growth") - F.lag("short_term_growth", 1).over(by_time))
    if pieces:
        m = m.where(F.col(pieces[1]))
    m = m.withColumn("score", weighted_score(weights))
    return m.select(*[F.col(x) for x in METRICS_COLUMNS]).withColumns({
        "cur_count": F.col("cur_count").cast("int"),
        "prev_count": F.col("prev_count").cast("int"),
        "long_term_ratio": F.col("long_term_ratio").cast("double"),
        "volatility": F.col("volatility").cast("double"),
    })
