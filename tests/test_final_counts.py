"""Final, open and late rows are all rows, whatever fails in between."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from surgewatch.session import scratch_path
from surgewatch.streaming import final_counts as FC

T0 = dt.datetime(2024, 1, 1)
HITS = "collected_time timestamp, channel string, query string, category string, keyword string"


def hits(spark, *minutes):
    return spark.createDataFrame([(None if m is None else T0 + dt.timedelta(minutes=m), "X", "q", "price", "thing")
                                  for m in minutes], HITS)


def counts(df):
    at = F.round((F.unix_seconds("collected_time") - F.unix_seconds(F.lit(T0))) / 60).cast("int")
    return {r["m"]: r["n"] for r in df.groupBy(at.alias("m")).agg(F.sum("n").alias("n")).collect()}


def state(fc):
    one = F.lit(1).alias("n")
    return (counts(fc.final().withColumnRenamed("count_category", "n")), counts(fc.open().withColumnRenamed("count_category", "n")),
            counts(fc.late().select("collected_time", one)))


def maker(spark):
    return FC.FinalCounts(spark, None, scratch_path(spark, "final"), "30 minutes", "1 hour")


def test_windows_close_once_and_late_rows_are_kept(spark):
    fc = maker(spark)
    fc.take(hits(spark, 5, 10, 40), 0)                 # watermark -20
    assert state(fc) == ({}, {0: 2, 30: 1}, {})
    fc.take(hits(spark, 20, 95), 1)                    # on time; watermark 35: window 0 is final
    assert state(fc) == ({0: 3}, {30: 1, 90: 1}, {})
    fc.take(hits(spark, 15, 50, None), 2)              # 15 is late, 50 isn't; no time: late
    assert state(fc) == ({0: 3}, {30: 2, 90: 1}, {0: 1, None: 1})
    fc.take(hits(spark, 60 * 72), 3)                   # days later
    assert state(fc) == ({0: 3, 30: 2, 90: 1}, {60 * 72: 1}, {0: 1, None: 1})
    fc.take(hits(spark, 60 * 73, 100), 4)
    fc.take(hits(spark).where("false"), 5)             # an empty micro-batch
    assert state(fc) == ({0: 3, 30: 2, 90: 1}, {60 * 72: 1, 60 * 73: 1}, {0: 1, 90: 1, None: 1})


def test_first_micro_batch_without_rows_or_times(spark):
    fc = maker(spark)
    fc.take(hits(spark).where("false"), 0)
    fc.take(hits(spark, None), 1)
    assert state(fc) == ({}, {}, {None: 1})


@pytest.mark.parametrize("fails_at", range(1, 5))
def test_replay_after_a_failure_between_writes(spark, monkeypatch, fails_at):
    batches = [(5, 10, 40), (20, 95), (15, 50, 60 * 72), (60 * 73, 100)]
    whole, broken = maker(spark), maker(spark)
    for k, b in enumerate(batches):
        whole.take(hits(spark, *b), k)
        left = [fails_at]
        write = FC.write_days

        def failing(*args, **kwargs):
            left[0] -= 1
            if not left[0]:
                raise RuntimeError("lost")
            write(*args, **kwargs)

        with monkeypatch.context() as m:
            m.setattr(FC, "write_days", failing)
            with pytest.raises(RuntimeError):
                broken.take(hits(spark, *b), k)
        broken.take(hits(spark, *b), k)
        broken.take(hits(spark, *b), k)  # and once more after all was written
        assert state(broken) == state(whole)
