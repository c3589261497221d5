import datetime as dt

import pytest
from pyspark.sql import functions as F

from surgewatch.operators.metrics_rows import calculate_metrics
from surgewatch.operators.metrics_time import calculate_metrics_time

T0 = dt.datetime(2024, 1, 1, 0, 0)


def _series(spark, points, channel="X", query="q", category="c"):
    rows = [(T0 + dt.timedelta(minutes=30 * k), channel, query, category, n) for k, n in points]
    return spark.createDataFrame(
        rows, "collected_time timestamp_ntz, channel string, query string, category string, "
              "count_category long")


def _by_time(df):
    return {r["cur_time"]: r for r in df.collect()}


def test_rows_mode_golden(spark):
    m = _by_time(calculate_metrics(_series(spark, [(0, 2), (1, 4), (2, 1), (3, 3)])))
    t = [T0 + dt.timedelta(minutes=30 * k) for k in range(4)]
    assert m[t[0]]["prev_count"] is None and m[t[0]]["score"] is None
    assert m[t[1]]["short_term_growth"] == 1.0 and m[t[1]]["long_term_ratio"] == 2.0
    assert m[t[1]]["volatility"] is None and m[t[1]]["score"] is None
    r = m[t[2]]
    assert r["short_term_growth"] == -0.75 and r["acceleration"] == -1.75
    assert r["volatility"] == pytest.approx(0.4714045, abs=1e-6)
    assert r["score"] == pytest.approx(-0.16119288, abs=1e-7)
    r = m[t[3]]
    assert r["long_term_ratio"] == pytest.approx(9 / 7)
    assert r["volatility"] == pytest.approx(0.6546537, abs=1e-6)
    assert r["score"] == pytest.approx(1.59760823, abs=1e-7)
    assert r["prev_time"] == t[2] and r["prev_count"] == 1 and r["ratio_to_total"] == 1.0


def test_time_mode_golden_with_gap(spark):
    m = _by_time(calculate_metrics_time(_series(spark, [(0, 2), (1, 4), (2, 1), (4, 3)]), step_seconds=1800))
    t = {k: T0 + dt.timedelta(minutes=30 * k) for k in (0, 1, 2, 4)}
    a = m[t[0]]
    assert (a["prev_count"], a["short_term_growth"], a["long_term_ratio"], a["volatility"],
            a["acceleration"], a["score"]) == (1, 1.0, 0.0, 0.0, 0.0, pytest.approx(0.6))
    b = m[t[1]]
    assert b["long_term_ratio"] == 2.0 and b["volatility"] == 0.0 and b["score"] == pytest.approx(1.0)
    c = m[t[2]]
    assert c["acceleration"] == -1.75 and c["score"] == pytest.approx(-0.16119288, abs=1e-7)
    d = m[t[4]]
    assert d["prev_count"] == 1 and d["short_term_growth"] == 2.0
    assert d["long_term_ratio"] == pytest.approx(1.2)
    assert d["volatility"] == pytest.approx(0.6546537, abs=1e-6)
    assert d["acceleration"] == 2.0 and d["score"] == pytest.approx(1.50546537, abs=1e-7)
    assert d["prev_time"] == T0 + dt.timedelta(minutes=90)
    assert all(r["duration_flag"] == 0 and r["rising_flag"] == 0 for r in m.values())


def test_time_mode_zero_slot_counts_as_missing(spark):
    m = _by_time(calculate_metrics_time(_series(spark, [(0, 5), (1, 0), (2, 3)]), step_seconds=1800))
    r = m[T0 + dt.timedelta(minutes=60)]
    assert r["prev_count"] == 1 and r["short_term_growth"] == 2.0
    assert r["long_term_ratio"] == pytest.approx(0.6) and r["acceleration"] == pytest.approx(2.8)


def test_duration_and_rising_flags(spark):
    m = _by_time(calculate_metrics_time(_series(spark, [(0, 1), (1, 4), (2, 16), (3, 64)]),
                                        step_seconds=1800))
    last = m[T0 + dt.timedelta(minutes=90)]
    assert last["duration_flag"] == 1 and last["rising_flag"] == 1
    assert m[T0 + dt.timedelta(minutes=60)]["duration_flag"] == 0


def test_modes_agree_on_gap_free_positive_series_after_six_points(spark):
    pts = [(k, n) for k, n in enumerate([3, 5, 2, 8, 6, 4, 9, 7, 5, 11])]
    both = _series(spark, pts).unionByName(_series(spark, [(k, n + 1) for k, n in pts], category="d"))
    rows = _by_time(calculate_metrics(both).where(F.col("category") == "c"))
    time = _by_time(calculate_metrics_time(both, step_seconds=1800).where(F.col("category") == "c"))
    for k in range(6, len(pts)):
        t = T0 + dt.timedelta(minutes=30 * k)
        for col in ("short_term_growth", "long_term_ratio", "volatility", "ratio_to_total",
                    "acceleration", "score"):
            assert rows[t][col] == pytest.approx(time[t][col], rel=1e-9), (k, col)


def test_share_sums_to_one(spark):
    df = _series(spark, [(0, 2), (1, 3)]).unionByName(_series(spark, [(0, 6), (1, 1)], category="d"))
    tot = calculate_metrics(df).groupBy("cur_time").agg(F.sum("ratio_to_total").alias("s")).collect()
    assert all(r["s"] == pytest.approx(1.0) for r in tot)


def test_series_windows_share_one_exchange(spark):
    df = _series(spark, [(0, 2), (1, 3)])
    plan = calculate_metrics(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2   # snapshot total + series


def test_time_slots_are_exact_with_off_grid_points(spark):
    rows = [(T0 + dt.timedelta(minutes=m), "X", "q", "c", n) for m, n in [(0, 2), (30, 4), (45, 9), (60, 8)]]
    df = spark.createDataFrame(rows, "collected_time timestamp_ntz, channel string, query string, "
                                     "category string, count_category long")
    t = _by_time(calculate_metrics_time(df, step_seconds=1800))[T0 + dt.timedelta(minutes=60)]
    assert t["prev_count"] == 4 and t["short_term_growth"] == 1.0          # slot 1 = 00:30, not 00:45
    assert t["acceleration"] == 1.0 - (4 - 2) / 2                          # slot 2 = 00:00
    r = _by_time(calculate_metrics(df))[T0 + dt.timedelta(minutes=60)]
    assert r["prev_count"] == 9                                            # rows mode: previous row
