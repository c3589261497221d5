import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from surgewatch.operators import standardize as STD
from surgewatch.session import scratch_path
from surgewatch.sources import posts as P
from surgewatch.sources import sinks as SNK

T0 = dt.datetime(2024, 1, 1, 12, 0)


def test_dedupe_posts_first_seen_wins_and_null_time_dropped(spark):
    rows = [(1, T0, "a"), (2, T0, "a"), (3, T0, "b"), (4, None, "a"), (0, T0, "a")]
    df = spark.createDataFrame(rows, "post_id long, uploaded_time timestamp_ntz, username string")
    out = sorted(r["post_id"] for r in STD.dedupe_posts(df, ["post_id"]).collect())
    assert out == [0, 3]


def test_cap_per_query_uses_group_limit(spark):
    rows = [(i, "q" if i % 3 else "r", T0 + dt.timedelta(seconds=i)) for i in range(50)]
    df = spark.createDataFrame(rows, "post_id long, query string, uploaded_time timestamp_ntz")
    out = STD.cap_per_query(df, 5, ["query"], [F.desc("uploaded_time"), F.asc("post_id")])
    got = sorted((r["query"], r["post_id"]) for r in out.collect())
    assert [p for q, p in got if q == "q"] == [43, 44, 46, 47, 49]
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_cap_above_group_limit_threshold_is_exact(spark):
    rows = [(i, "q" if i % 10 else "r", T0 + dt.timedelta(seconds=i)) for i in range(5000)]
    df = spark.createDataFrame(rows, "post_id long, query string, uploaded_time timestamp_ntz")
    out = STD.cap_per_query(df, 1500, ["query"], [F.desc("uploaded_time"), F.asc("post_id")])
    got = sorted(r["post_id"] for r in out.where("query = 'q'").collect())
    assert got == sorted([i for i in range(5000) if i % 10][-1500:])
    assert out.where("query = 'r'").count() == 500


def test_recent_and_range_filters(spark):
    now = T0
    rows = [(1, now), (2, now - dt.timedelta(minutes=30)), (3, now - dt.timedelta(minutes=31)),
            (4, now + dt.timedelta(seconds=1))]
    df = spark.createDataFrame(rows, "post_id long, uploaded_time timestamp_ntz")
    rec = STD.recent_posts(df, F.lit(now).cast("timestamp_ntz"), 30)
    assert sorted(r[0] for r in rec.collect()) == [1, 2]
    rng = STD.date_range_posts(df, F.lit(now - dt.timedelta(minutes=30)).cast("timestamp_ntz"),
                               F.lit(now).cast("timestamp_ntz"))
    assert sorted(r[0] for r in rng.collect()) == [2]


def test_lang_filters(spark):
    df = spark.createDataFrame([(1, "en"), (2, None), (3, ""), (4, "ko")], "post_id long, lang string")
    assert sorted(r[0] for r in STD.lang_filter(df).collect()) == [1]
    assert sorted(r[0] for r in STD.lang_filter(df, strict=False).collect()) == [1, 2, 3]


def test_collect_summary_lists_zero_queries(spark):
    posts = spark.createDataFrame([("a",), ("a",)], "query string")
    qs = spark.createDataFrame([("a",), ("b",)], "query string")
    got = {r["query"]: (r["saved"], r["total_saved"], r["ok"])
           for r in STD.collect_summary(posts, qs).collect()}
    assert got == {"a": (2, 2, True), "b": (0, 2, True)}


def test_read_posts_csv_multiline_bom(spark):
    folder = scratch_path(spark, "raw-data") + "/20250819T021523Z"
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/x.csv", "w", encoding="utf-8-sig", newline="") as f:
        f.write("username,uploaded_time,collected_time,channel,query,text\r\n")
        f.write('u1,2025-08-19T02:00:00+00:00,2025-08-19T02:15:23+00:00,X,ioniq,'
                '"recall, ""fire""\nagain"\r\n')
        f.write('u2,bad,2025-08-19T02:15:23+00:00,threads,ev6,plain\r\n')
    df = P.with_batch_time(P.read_posts(spark, folder)).orderBy("username")
    rows = df.collect()
    assert rows[0]["username"] == "u1" and rows[0]["text"] == 'recall, "fire"\nagain'
    assert rows[0]["uploaded_time"] == dt.datetime(2025, 8, 19, 2, 0)
    assert rows[1]["uploaded_time"] is None
    assert rows[0]["batch_time"] == dt.datetime(2025, 8, 19, 2, 15, 23)


def test_query_list_reader(spark):
    path = scratch_path(spark, "queries") + ".txt"
    with open(path, "w", encoding="utf-8-sig") as f:
        f.write("hyundai\n\n# comment\n  ioniq  \nhyundai\nev6\n")
    assert [r["query"] for r in P.read_query_list(spark, path).collect()] == ["hyundai", "ioniq", "ev6"]


def test_write_posts_roundtrip_and_empty_header(spark):
    out = scratch_path(spark, "posts-out")
    df = spark.createDataFrame([("u", "2025-08-19T02:00:00+00:00", "2025-08-19T02:15:23+00:00", "X",
                                 "q", "  lead and trail  \n2nd line")],
                               "username string, uploaded_time string, collected_time string, "
                               "channel string, query string, text string")
    P.write_posts(df, out)
    assert P.read_posts(spark, out).first()["text"] == "  lead and trail  \n2nd line"
    empty = scratch_path(spark, "posts-empty")
    P.write_posts(df.limit(0), empty)
    assert P.read_posts(spark, empty).count() == 0


def test_merge_counts_newest_wins(spark):
    keys = "collected_time timestamp_ntz, channel string, query string, category string, count_category long"
    old = spark.createDataFrame([(T0, "X", "q", "c", 1), (T0, "X", "q", "d", 5)], keys)
    new = spark.createDataFrame([(T0, "X", "q", "c", 7)], keys)
    got = {r["category"]: r["count_category"] for r in SNK.merge_counts(old, new).collect()}
    assert got == {"c": 7, "d": 5}
    again = {r["category"]: r["count_category"]
             for r in SNK.merge_counts(SNK.merge_counts(old, new), new).collect()}
    assert again == got


NASTY = ('"username","uploaded_time",collected_time,channel,query,text\n'
         'a,1700000000,2024-01-01T00:00:00Z,X,q,"one, ""two""\nthree\n\nfour"\n'
         '\n'
         'b,,,X,,plain\n'
         'c,x,y,"th""reads",q,"""\n\n""\n,,\n"\n'
         'd,1700000001,,X,q,""\n'
         'e,,,X,q, spaced \n'
         'f,,,X,q,"no end of line"')


@pytest.mark.parametrize("size", [7, 40, 1000])
def test_split_csv_equals_the_plain_reader(spark, tmp_path, size):
    """Byte ranges that begin in quoted texts, between CR and LF and in the header."""
    from surgewatch.sources import posts as P
    (tmp_path / "20240101T000000Z").mkdir()
    (tmp_path / "20240102T000000Z").mkdir()
    (tmp_path / "20240101T000000Z" / "a b.csv").write_bytes(("﻿" + NASTY).encode())
    (tmp_path / "20240101T000000Z" / "crlf.csv").write_bytes(NASTY.replace("\n", "\r\n").encode())
    (tmp_path / "20240102T000000Z" / "old.csv").write_bytes(b'keyword,username,text\nk,"u\n\n1","t ""\n"\nk2,u2,\n')
    (tmp_path / "20240102T000000Z" / "empty.csv").write_bytes(b"")
    (tmp_path / "20240102T000000Z" / "bare.csv").write_bytes(b"username,text")
    key = "spark.sql.files.maxPartitionBytes"
    old, path = spark.conf.get(key), f"{tmp_path}/*"
    rows = lambda df: sorted(map(str, df.collect()))
    want = rows(P.read_posts(spark, path, batch_time="b"))
    assert len(want) == 14
    try:
        spark.conf.set(key, str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        lines = P.csv_lines(spark, path)
        assert lines.rdd.getNumPartitions() > 300 / size
        assert rows(P.read_posts(spark, path, batch_time="b", split=True)) == want
    finally:
        spark.conf.set(key, old)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_long_header(spark, tmp_path):
    from surgewatch.sources import posts as P
    names = ["username", "text", *[f"column{i}" for i in range(2000)]]
    (tmp_path / "wide.csv").write_text(",".join(names) + "\n" + ",".join(["u", "t"] + ["x"] * 2000) + "\n")
    assert list(P.files_by_header(spark, str(tmp_path))) == [tuple(names)]
    assert P.read_posts(spark, str(tmp_path)).select("username", "text").collect() == [("u", "t")]


def test_dedupe_finds_winners_without_the_rows(spark):
    """The aggregate holds one fixed-width number per key; no string is sorted or buffered in it."""
    import re
    df = spark.createDataFrame([(1, T0, "a", "text")], "post_id long, uploaded_time timestamp_ntz, username string, text string")
    for order in ("post_id", "uploaded_time"):
        plan = STD.first_per_key(df, ["uploaded_time", "username"], [order])._jdf.queryExecution().executedPlan().toString()
        aggs = re.findall(r"\w*Aggregate\(.*", plan)
        assert aggs and all(a.startswith("HashAggregate") and "functions=[partial_min" in a or "functions=[min" in a for a in aggs)
        assert not any(c in a for a in aggs for c in ("username#", "text#")) or all("xxhash64" in a or "_k#" in a for a in aggs)
        assert "min_by" not in plan and "SortAggregate" not in plan


@pytest.mark.parametrize("order", ["post_id", "at", "day", "note"])
def test_first_per_key_on_ties_nulls_and_equal_rows(spark, order):
    rows = [(k % 3 if k % 5 else None, "u" if k % 2 else None, k % 4 if k % 7 else None, f"t{k % 6}") for k in range(200)]
    rows += [(-2 ** 63, "lo", 1, "x"), (2 ** 63 - 1, "lo", 0, "x"), (None, "lo", 2, "y")]
    df = spark.createDataFrame(rows, "post_id long, username string, k int, note string").withColumns({
        "at": F.timestamp_seconds("k"), "day": F.date_add(F.lit(dt.date(1969, 12, 30)), F.col("k"))})
    got = STD.first_per_key(df, ["username"], [order]).collect()
    assert sorted(map(repr, (r["username"] for r in got))) == ["'lo'", "'u'", "None"]
    for r in got:
        same = [x for x in df.collect() if x["username"] == r["username"]]
        assert r in same
        least = min(((x[order] is not None, x[order]) for x in same), key=lambda p: (p[0], p[1] if p[0] else 0))
        assert (r[order] is not None, r[order]) == least
    again = STD.first_per_key(df.repartition(7, "note"), ["username"], [order]).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))


def test_metric_series_reads_its_days_files_and_row_groups(spark):
    import glob

    import pyarrow.parquet as pq
    from surgewatch.schema import METRICS_COLUMNS
    m = spark.range(20_000).select(
        F.concat(F.lit("c"), F.col("id") % 5).alias("channel"), F.concat(F.lit("q"), F.col("id") % 7).alias("query"),
        F.lit("price").alias("category"), F.timestamp_seconds(1704067200 + F.floor(F.col("id") / 35) * 1800).alias("cur_time"))
    m = m.select("*", *[F.lit(1.0).alias(c) for c in METRICS_COLUMNS if c not in m.columns and c != "prev_time"],
                 F.lit(None).cast("timestamp").alias("prev_time"))
    path = SNK.scratch_path(spark, "metrics")
    SNK.write_metrics(m, path)
    one = SNK.metric_series(spark.read.parquet(path), "c3", "q2", "price", "2024-01-03 00:00:00", "2024-01-04 12:00:00")
    assert one.count() == m.where("channel = 'c3' and query = 'q2' and cur_time between '2024-01-03' and '2024-01-04 12:00:00'").count() > 0
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = SNK.metric_series(spark.read.parquet(path), "c3", "q2", "price", "2024-01-03 00:00:00", "2024-01-04 12:00:00") \
        ._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    parts, pushed = (plan.split(x)[1].split("]")[0] for x in ("PartitionFilters: [", "PushedFilters: ["))
    assert "cur_date" in parts and "EqualTo(channel,c3)" in pushed and "EqualTo(query,q2)" in pushed
    # inside a day no two files share more than an edge of the order, so statistics tell them apart
    for day in glob.glob(f"{path}/cur_date=*"):
        spans = sorted((lambda t: (t[0], t[-1]))([tuple(r.values()) for r in pq.read_table(f, columns=["channel", "query", "category", "cur_time"], partitioning=None).to_pylist()])
                       for f in glob.glob(f"{day}/*.parquet"))
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
        for f in glob.glob(f"{day}/*.parquet"):
            keys = [tuple(r.values()) for r in pq.read_table(f, columns=["channel", "query", "category", "cur_time"], partitioning=None).to_pylist()]
            assert keys == sorted(keys)
