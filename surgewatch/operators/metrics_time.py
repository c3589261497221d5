"""Spike metrics, ``time`` mode: values at exact earlier snapshot slots.

Slot k of a point at time t is the series value at exactly t - k*step (the
previous job looked these up one key at a time).  Here each slot is a window
over a *range* frame of width zero at offset k*step on the epoch, so all six
lookups are one Window operator over the series partition.

A slot that is missing or 0 counts as missing (the previous job tested
truthiness), except the slot-2 lookup of the acceleration, which keeps a 0.
Terms default instead of going null, so every point gets a score.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surgewatch.config import DEFAULT_WEIGHTS, DURATION_THRESHOLD, SNAPSHOT_MINUTES
from surgewatch.functions.timefmt import epoch_micros, minus_seconds
from surgewatch.operators.metrics_rows import weighted_score
from surgewatch.schema import METRICS_COLUMNS, SERIES_KEYS

HISTORY_SLOTS = 6


def exact_lags(counts: DataFrame, step_seconds: int = SNAPSHOT_MINUTES * 60,
               slots: int = HISTORY_SLOTS, time_col: str = "collected_time",
               count_col: str = "count_category") -> DataFrame:
    """Add ``slot_1`` .. ``slot_n``: the count at exactly t - k*step (null if absent)."""
    step = int(step_seconds) * 1_000_000
    w = Window.partitionBy(*SERIES_KEYS).orderBy(F.col("_epoch_us"))
    df = counts.withColumn("_epoch_us", epoch_micros(time_col))
    lags = {f"slot_{k}": F.max(count_col).over(w.rangeBetween(-k * step, -k * step))
            for k in range(1, slots + 1)}
    return df.withColumns(lags).drop("_epoch_us")


def _truthy(c: Column) -> Column:
    return c.isNotNull() & (c != 0)


def _growth(cur: Column, prev: Column) -> Column:
    """(cur - p) / p with p replaced by 1 when not positive."""
    p = F.when(prev > 0, prev).otherwise(F.lit(1))
    return (cur - p) / p


def calculate_metrics_time(counts: DataFrame, weights=DEFAULT_WEIGHTS,
                           step_seconds: int = SNAPSHOT_MINUTES * 60,
                           duration_threshold: float = DURATION_THRESHOLD,
                           time_col: str = "collected_time",
                           count_col: str = "count_category") -> DataFrame:
    """Metrics sink columns plus ``duration_flag`` and ``rising_flag``."""
    lagged = exact_lags(counts, step_seconds, HISTORY_SLOTS, time_col, count_col)
    snapshot = Window.partitionBy("channel", "query", time_col)
    lagged = lagged.withColumn("_total", F.sum(count_col).over(snapshot))

    cur = F.coalesce(F.col(count_col), F.lit(0))
    s = {k: F.col(f"slot_{k}") for k in range(1, HISTORY_SLOTS + 1)}
    prev_count = F.when(_truthy(s[1]), s[1]).otherwise(F.lit(1))
    growth = _growth(cur, prev_count)

    # mean of slots 1..3 that are > 0; none -> 0.0
    pos3 = [F.when(s[k] > 0, s[k]) for k in (1, 2, 3)]
    n3 = sum((F.when(x.isNotNull(), 1).otherwise(0) for x in pos3), F.lit(0))
    sum3 = sum((F.coalesce(x, F.lit(0)) for x in pos3), F.lit(0))
    long_ratio = F.when(n3 == 0, F.lit(0.0)).otherwise(cur / (sum3 / n3))

    # sample stddev / mean of slots 1..6 that are > 0; fewer than 2 -> 0.0
    pos6 = [F.when(s[k] > 0, s[k]) for k in range(1, HISTORY_SLOTS + 1)]
    n6 = sum((F.when(x.isNotNull(), 1).otherwise(0) for x in pos6), F.lit(0))
    mu6 = F.try_divide(sum((F.coalesce(x, F.lit(0)) for x in pos6), F.lit(0)), n6)

    # chronological growths g_0 (current) .. g_5; known when both counts are truthy
    counts_chain = [cur] + [s[k] for k in range(1, HISTORY_SLOTS + 1)]
    g = [F.when(_truthy(counts_chain[k]) & _truthy(counts_chain[k + 1]),
                _growth(counts_chain[k], counts_chain[k + 1])) for k in range(HISTORY_SLOTS)]
    latest3 = F.slice(F.filter(F.array(*g), lambda x: x.isNotNull()), 1, 3)
    duration = F.when((F.size(latest3) == 3)
                      & F.forall(latest3, lambda x: x > F.lit(float(duration_threshold))),
                      1).otherwise(0)
    rising = F.when(s[1].isNotNull() & s[2].isNotNull() & s[3].isNotNull()
                    & (cur > s[1]) & (s[1] > s[2]) & (s[2] > s[3]), 1).otherwise(0)

    m = lagged.select(
        *SERIES_KEYS, F.col(time_col).alias("cur_time"), cur.alias("cur_count"),
        prev_count.alias("prev_count"), growth.alias("short_term_growth"),
        long_ratio.alias("long_term_ratio"), n6.alias("_n6"), mu6.alias("_mu6"),
        *[x.alias(f"_p{i}") for i, x in enumerate(pos6)],
        F.when(F.col("_total") > 0, cur / F.col("_total")).otherwise(F.lit(0.0)).alias("ratio_to_total"),
        s[2].alias("_slot2"), duration.alias("duration_flag"), rising.alias("rising_flag"),
    )
    # sample stddev / mean, two-pass over the kept slots
    pos6 = [F.col(f"_p{i}") for i in range(HISTORY_SLOTS)]
    ss6 = sum((F.coalesce((x - F.col("_mu6")) * (x - F.col("_mu6")), F.lit(0.0)) for x in pos6),
              F.lit(0.0))
    vol = F.when((F.col("_n6") < 2) | (F.col("_mu6") <= 0), F.lit(0.0)).otherwise(
        F.sqrt(ss6 / (F.col("_n6") - 1)) / F.col("_mu6"))
    # growth of the previous point from (prev_count, slot 2); acceleration 0.0 without slot 2
    prev_growth = F.when(F.col("_slot2").isNotNull(), _growth(F.col("prev_count"), F.col("_slot2")))
    m = m.withColumns({
        "prev_time": minus_seconds("cur_time", step_seconds),
        "volatility": vol.cast("double"),
        "acceleration": F.when(prev_growth.isNull(), F.lit(0.0))
                         .otherwise(F.col("short_term_growth") - prev_growth).cast("double"),
    })
    m = m.withColumn("score", weighted_score(weights))
    return m.select(*METRICS_COLUMNS, "duration_flag", "rising_flag").withColumns({
        "cur_count": F.col("cur_count").cast("int"),
        "prev_count": F.col("prev_count").cast("int"),
        "short_term_growth": F.col("short_term_growth").cast("double"),
        "long_term_ratio": F.col("long_term_ratio").cast("double"),
        "ratio_to_total": F.col("ratio_to_total").cast("double"),
    })
