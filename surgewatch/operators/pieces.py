"""Windows over long series, cut into time ranges.

A window over one series runs in one task, however long the series is.  Here a series
is cut into pieces of a fixed time width, each with the few points around it that its
first and last points look at (a halo), so a series runs as as many tasks as it has
pieces.  What a run of points needs from all pieces before it (its length so far) is
carried by a scan over one row per piece.  Results equal the window form.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surgewatch.config import DEFAULT_WEIGHTS, LONG_TERM_ROWS, VOLATILITY_ROWS
from surgewatch.operators import spikes as S
from surgewatch.operators.metrics_rows import calculate_metrics
from surgewatch.schema import SERIES_KEYS
from surgewatch.session import checkpoint_dir

PIECE, OWN = "_piece", "_own"


def _all_equal(left: list[str], right: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(left, right)])


def with_halo(points: DataFrame, keys: list[str], order: str, seconds: int, back: int, ahead: int = 0) -> DataFrame:
    """``points`` by piece (``_piece``, ``_own`` true), and beside each piece the ``back`` last points
    of its series before it and the ``ahead`` first points after it (``_own`` false).

    Points without a time are a piece of their own, before all others.  The points are
    written to the checkpoint folder once: pieces and halos are read from the same rows.
    """
    checkpoint_dir(points.sparkSession)
    at = F.floor(F.unix_micros(F.col(order).cast("timestamp")) / F.lit(int(seconds) * 1_000_000)).cast("long")
    own = points.withColumn(PIECE, at).checkpoint()
    halos = [_halo(own, keys, order, n, after) for n, after in ((back, False), (ahead, True)) if n]
    return reduce(DataFrame.unionByName, halos, own.withColumn(OWN, F.lit(True)))


def _halo(own: DataFrame, keys: list[str], order: str, n: int, after: bool) -> DataFrame:
    inside = Window.partitionBy(*keys, PIECE).orderBy(F.asc_nulls_first(order) if after else F.desc_nulls_last(order))
    rest = [c for c in own.columns if c not in (*keys, PIECE, order)]
    edge = own.withColumn("_r", F.row_number().over(inside)).where(F.col("_r") <= n).groupBy(*keys, PIECE).agg(
        F.sort_array(F.collect_list(F.struct(order, *rest))).alias("_edge"))  # at most n points
    # every piece has a point, so the n pieces before (after) it hold the n points before (after) it
    around = Window.partitionBy(*keys).orderBy(PIECE).rowsBetween(*((1, n) if after else (-n, -1)))
    near = F.flatten(F.collect_list("_edge").over(around))
    near = F.slice(near, 1, n) if after else F.when(F.size(near) > n, F.slice(near, -n, n)).otherwise(near)
    return edge.select(*keys, PIECE, near.alias("_near")).select(*keys, PIECE, F.explode("_near").alias("_p")).select(
        *keys, PIECE, F.col(f"_p.{order}").alias(order), *[F.col(f"_p.{c}").alias(c) for c in rest], F.lit(False).alias(OWN)
    ).select(*own.columns, OWN)


def calculate_metrics_pieces(counts: DataFrame, seconds: int, weights=DEFAULT_WEIGHTS, time_col: str = "collected_time",
                             count_col: str = "count_category", long_rows: int = LONG_TERM_ROWS,
                             vol_rows: int = VOLATILITY_ROWS) -> DataFrame:
    """``calculate_metrics`` with every series cut into pieces of ``seconds``."""
    snapshot = Window.partitionBy("channel", "query", time_col)
    totals = counts.select(*SERIES_KEYS, time_col, count_col).withColumn("_total", F.sum(count_col).over(snapshot))
    # a point looks at rows before it, and at the growth of the row before, which looks at one more
    cut = with_halo(totals, SERIES_KEYS, time_col, seconds, max(long_rows, vol_rows, 2))
    return calculate_metrics(cut, weights, time_col, count_col, long_rows, vol_rows, pieces=(PIECE, OWN))


def exceed_streak_pieces(df: DataFrame, threshold: float = 50.0, keys=("channel",), order: str = "bucket_ts",
                         reference_offset: bool = False) -> DataFrame:
    """``exceed_streak`` over pieces (``_piece``): runs are counted inside a piece, and a run
    that reaches back over its start gets the length it has there."""
    keys = list(keys)
    df = df.withColumn("exceed", (F.col("growth") >= F.lit(float(threshold))).cast("int"))
    inside = Window.partitionBy(*keys, PIECE).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    island = Window.partitionBy(*keys, PIECE, "_island").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("_island", F.coalesce(F.sum(1 - F.col("exceed")).over(inside), F.lit(0)))
    df = df.withColumn("_run", F.sum("exceed").over(island))
    # one row per piece: breaks in it, and the run at its end
    ends = df.groupBy(*keys, PIECE, "_island").agg(F.coalesce(F.sum("exceed"), F.lit(0)).alias("_n")).groupBy(*keys, PIECE).agg(
        F.max("_island").alias("_breaks"), F.max_by("_n", "_island").alias("_tail"))
    by_piece = Window.partitionBy(*keys).orderBy(PIECE)
    upto = by_piece.rowsBetween(Window.unboundedPreceding, 0)
    ends = ends.withColumn("_since", F.sum((F.col("_breaks") > 0).cast("int")).over(upto))
    since = Window.partitionBy(*keys, "_since").orderBy(PIECE).rowsBetween(Window.unboundedPreceding, 0)
    ends = ends.withColumn("_after", F.sum("_tail").over(since))
    carried = ends.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate([*keys, PIECE])],
        F.coalesce(F.lag("_after").over(by_piece), F.lit(0)).alias("_carry"),
        (F.coalesce(F.sum("_breaks").over(upto), F.lit(0)) - F.col("_breaks")).alias("_broken"))
    streak = F.col("_run") + F.when(F.col("_island") == 0, F.col("_carry")).otherwise(0)
    if reference_offset:
        streak = streak + F.when(F.col("_broken") + F.col("_island") > 0, 1).otherwise(0)
    joined = df.join(carried, _all_equal([*keys, PIECE], [f"_k{i}" for i in range(len(keys) + 1)]))
    return joined.select(*[c for c in df.columns if c not in ("_island", "_run")],
                         F.when(F.col("exceed") == 1, streak).otherwise(0).cast("int").alias("streak"))


def spike_table_pieces(cnt: DataFrame, seconds: int, threshold: float = 50.0, keys=("channel",),
                       reference_offset: bool = False, width: int = 3) -> DataFrame:
    """``spike_table`` with every series cut into pieces of ``seconds``."""
    keys, half = list(keys), width // 2
    # growth of the centred average looks at the average of the point before
    df = with_halo(cnt, keys, "bucket_ts", seconds, half + 1, half)
    by_piece = [*keys, PIECE]
    df = S.ma_growth(S.centered_ma(S.bucket_growth(df, by_piece), by_piece, width), by_piece)
    df = df.where(F.col(OWN)).drop(OWN)
    return exceed_streak_pieces(df, threshold, keys, reference_offset=reference_offset).drop(PIECE)
