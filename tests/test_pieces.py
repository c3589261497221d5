"""Series cut into pieces give what windows over whole series give."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from surgewatch.operators import pieces as PC
from surgewatch.operators import spikes as S
from surgewatch.operators.metrics_rows import calculate_metrics

T0 = dt.datetime(2024, 1, 1)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def series(spark, seed, gaps=(1, 1, 1, 1, 1, 2, 40)):
    """Uneven series: some pieces have no point, some one, a run of rises spans several."""
    rnd, out = random.Random(seed), []
    for channel in ("X", "threads", None):
        at, n = 0, 1
        for k in range(rnd.choice([1, 7, 120])):
            at += rnd.choice(gaps)
            n = 2 * n if 30 < k < 60 else rnd.randint(0, 9)
            out.append((channel, T0 + dt.timedelta(minutes=10 * at), n))
    return spark.createDataFrame(out, "channel string, bucket_ts timestamp_ntz, cnt long")


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
@pytest.mark.parametrize("minutes", [10, 30, 70, 100_000])
def test_spikes_by_pieces_equal_the_windows(spark, seed, minutes):
    cnt = series(spark, seed)
    for offset in (False, True):
        want = S.spike_table(cnt, 50.0, reference_offset=offset)
        got = PC.spike_table_pieces(cnt, 60 * minutes, 50.0, reference_offset=offset).select(*want.columns)
        assert rows(got) == rows(want)


def test_a_run_longer_than_many_pieces_keeps_its_length(spark):
    cnt = spark.range(300).select(F.lit("X").alias("channel"), (F.lit(T0).cast("timestamp_ntz") + F.expr(
        "make_interval(0,0,0,0,0,cast(10 * id as int))")).alias("bucket_ts"), F.lit(1).alias("cnt"), F.lit(60.0).alias("growth"))
    cut = PC.with_halo(cnt, ["channel"], "bucket_ts", 3600, 0).drop("_own")
    out = PC.exceed_streak_pieces(cut).orderBy("bucket_ts")
    assert [r["streak"] for r in out.collect()] == list(range(1, 301))


@pytest.mark.parametrize("hours", [1, 5, 24])
def test_metrics_by_pieces_equal_the_windows(spark, hours):
    rnd = random.Random(hours)
    points = [(T0 + dt.timedelta(minutes=30 * at), ch, q, cat, rnd.randint(0, 9))
              for ch, q in (("X", "a"), ("X", None), ("threads", "a")) for cat in ("price", "legal")
              for at in sorted(rnd.sample(range(400), 80))] + [(None, "X", "a", "price", 3)]
    counts = spark.createDataFrame(points, "collected_time timestamp_ntz, channel string, query string, category string, count_category long")
    assert rows(PC.calculate_metrics_pieces(counts, 3600 * hours)) == rows(calculate_metrics(counts))


def test_empty_series(spark):
    cnt = series(spark, 1).where("false")
    assert PC.spike_table_pieces(cnt, 3600).count() == 0


def test_one_long_series_runs_as_many_tasks(spark):
    """No window over points has the series alone as its partition: only those over one row per piece."""
    cnt = spark.range(200_000).select(F.lit("X").alias("channel"), F.timestamp_seconds(F.col("id") * 600).alias("bucket_ts"),
                                      (F.col("id") * 7919 % 13).alias("cnt"))
    out = PC.spike_table_pieces(cnt, 600 * 5_000)
    spread = PC.with_halo(cnt, ["channel"], "bucket_ts", 600 * 5_000, 2, 1)
    sizes = [r["count"] for r in spread.groupBy("channel", "_piece").count().collect()]
    assert len(sizes) == 40 and max(sizes) <= 5_003
    want = S.spike_table(cnt)
    key = F.xxhash64(*[F.col(c) for c in want.columns])
    digest = lambda df: df.agg(F.sum(key.cast("decimal(38,0)")), F.count("*")).first()
    assert digest(out.select(*want.columns)) == digest(want)
