import datetime as dt

from pyspark.sql import functions as F

from surgewatch.operators import alerts as A
from surgewatch.operators import spikes as S

T0 = dt.datetime(2024, 1, 1)


def _growth_frame(spark, growths):
    rows = [("X", T0 + dt.timedelta(minutes=10 * k), g) for k, g in enumerate(growths)]
    return spark.createDataFrame(rows, "channel string, bucket_ts timestamp_ntz, growth double")


def _streaks(df):
    return [r["streak"] for r in df.orderBy("bucket_ts").collect()]


def test_streak_exact_and_reference_offset(spark):
    g = _growth_frame(spark, [0.0, 60.0, 70.0, 80.0, 10.0, 55.0])
    assert _streaks(S.exceed_streak(g, 50.0)) == [0, 1, 2, 3, 0, 1]
    assert _streaks(S.exceed_streak(g, 50.0, reference_offset=True)) == [0, 2, 3, 4, 0, 2]
    g2 = _growth_frame(spark, [60.0, 60.0, 0.0])
    assert _streaks(S.exceed_streak(g2, 50.0, reference_offset=True)) == [1, 2, 0]
    assert S.streak_alerts(S.exceed_streak(g, 50.0)).count() == 1


def test_bucket_growth_and_centered_ma(spark):
    rows = [("X", T0 + dt.timedelta(minutes=10 * k), c) for k, c in enumerate([2, 4, 6, 3])]
    cnt = spark.createDataFrame(rows, "channel string, bucket_ts timestamp_ntz, cnt long")
    t = S.spike_table(cnt).orderBy("bucket_ts").collect()
    assert [r["growth"] for r in t] == [0.0, 100.0, 50.0, -50.0]
    assert [r["count_ma"] for r in t] == [None, 4.0, 13 / 3, None]
    assert t[2]["growth_rate_ma"] == (13 / 3) / 4.0 * 100 - 100 or abs(
        t[2]["growth_rate_ma"] - ((13 / 3) / 4.0 - 1) * 100) < 1e-9


def _items(spark):
    cols = ("channel string, query string, category string, cur_time timestamp_ntz, "
            "prev_time timestamp_ntz, cur_count int, prev_count int, keyword string, "
            "count_keyword long, short_term_growth double, long_term_ratio double, "
            "ratio_to_total double, acceleration double, score double")
    t1, t0 = T0 + dt.timedelta(minutes=30), T0
    rows = [("X", "ev#6", "safety", t1, t0, 6, 2, kw, n, 2.0, 1.5, 0.5, 1.0, 2.5)
            for kw, n in [("fire", 3), ("recall", 3), ("airbag", 5)]]
    return A.alert_items(spark.createDataFrame(rows, cols))


def test_alert_groups_and_message(spark):
    items = _items(spark)
    g = A.alert_groups(items).collect()
    assert len(g) == 1
    assert g[0]["keywords"] == " airbag (5건),  fire (3건),  recall (3건)"
    assert g[0]["pk"] == "X#ev#6#safety"
    msg = A.alert_message(A.alert_groups(items)).first()["message"]
    assert "[X] safety" in msg and "- query: ev#6" in msg and "(+200.0%)" in msg
    assert "2024-01-01T00:00:00+00:00 ~ 2024-01-01T00:30:00+00:00" in msg


def test_new_alerts_skip_stored(spark):
    items = _items(spark)
    stored = items.where(F.col("keyword") == "fire")
    assert sorted(r["keyword"] for r in A.new_alerts(items, stored).collect()) == ["airbag", "recall"]
    assert items.first()["sk"].startswith("2024-01-01T00:30:00+00:00#")
