"""Stored files: their number, what is written of a batch, and how large ones are read."""
import datetime as dt
import os

from pyspark.sql import functions as F

from surgewatch.session import scratch_path
from surgewatch.sources import posts as P
from surgewatch.sources import sinks as SNK

T0 = dt.datetime(2024, 1, 1)


def files(path, end):
    return [f for _, _, fs in os.walk(path) for f in fs if f.endswith(end)]


def mapped(spark, n=400):
    return spark.range(n).select(F.expr("timestamp'2024-01-01' + make_interval(0, 0, 0, 0, cast(id % 5 as int)) collected_time"),
                                 F.concat(F.lit("text "), F.col("id") % 20).alias("text"), F.col("id").alias("post_id"))


def test_files_of_mapped_rows_grow_with_the_batches_not_the_tasks(spark):
    path = scratch_path(spark, "mapped")
    rows = mapped(spark).repartition(7, "text")
    SNK.write_mapped(rows, path)
    assert len(files(path, ".parquet")) == 5
    back = spark.read.parquet(path).select(*rows.columns)
    assert sorted(back.collect()) == sorted(rows.collect())


def test_a_batch_is_written_once_and_earlier_days_go(spark, monkeypatch):
    path, staged, stage = scratch_path(spark, "batch"), [], SNK.stage
    monkeypatch.setattr(SNK, "stage", lambda df: staged.append(1) or stage(df))
    day = lambda k: F.col("collected_time") + F.expr(f"INTERVAL {k} DAYS")
    rows = mapped(spark, 20)
    two = rows.unionAll(rows.withColumn("collected_time", day(1)))
    SNK.write_mapped(two, path, batch="b1")
    SNK.write_mapped(rows, path, batch="b2")
    SNK.write_mapped(rows.withColumn("collected_time", day(1)), path, batch="b1")   # corrected: one day less
    got = spark.read.parquet(path).groupBy("batch", "batch_date").count().collect()
    assert sorted((r[0], r[1].day, r[2]) for r in got) == [("b1", 2, 20), ("b2", 1, 20)] and staged == []
    SNK.write_mapped(rows.where("false"), path, batch="b2")
    assert [r[0] for r in spark.read.parquet(path).select("batch").distinct().collect()] == ["b1"]


def test_compressed_posts_read_back(spark):
    rows = [("u", str(T0), str(T0), "X", "q", t) for t in ('a "b"\nc', "", " x ", "\n\n\n", "ü,한")]
    df = spark.createDataFrame(rows * 3, ", ".join(f"{c} string" for c in P.POST_COLUMNS))
    plain, gz = scratch_path(spark, "plain"), scratch_path(spark, "gz")
    P.write_posts(df, plain)
    P.write_posts(df, gz, compression="gzip")
    assert files(gz, ".csv.gz") and not files(gz, ".csv")
    key = lambda df: sorted(df.collect(), key=str)
    assert key(P.read_posts(spark, gz, typed=False)) == key(P.read_posts(spark, plain, typed=False))


def test_split_reading_shuffles_no_whole_records(spark):
    """Records that lie in one byte range are put together where they are read."""
    folder = scratch_path(spark, "one")
    spark.createDataFrame([("u", str(T0), str(T0), "X", "q", "a\nb")], ", ".join(f"{c} string" for c in P.POST_COLUMNS)) \
        .write.options(**P.CSV_WRITE_OPTIONS).csv(folder)
    plan = P.csv_records(P.csv_lines(spark, folder))._jdf.queryExecution().optimizedPlan().toString()
    whole = plan[:plan.index("MapInPandas")]
    assert "Window" not in whole and "Aggregate" not in whole


def test_large_halves_come_as_several_files(spark, monkeypatch):
    """No task writes a whole half, and no folder is released before all its files are there."""
    from paths import SF001
    from surgewatch.plans import catalog as K
    want = sorted(K.q_stream_complete_batches(spark, SF001).collect(), key=str)
    seen, run = [], K.run_job.run
    monkeypatch.setattr(P, "MAX_ROWS_PER_FILE", 100)
    monkeypatch.setattr(K, "P", P)
    monkeypatch.setattr(K.run_job, "run", lambda s, folder, *a, **k: seen.append(P.list_files(s, folder).count()) or run(s, folder, *a, **k))
    assert sorted(K.q_stream_complete_batches(spark, SF001).collect(), key=str) == want and max(seen) > 2


def final_plan(df):
    """The plan that ``df`` ran with, down to its join."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan[:plan.index("ShuffledHashJoin")]


def odd_posts(spark):
    """Posts that refer to texts by a key: texts that are there twice, or are two of a key, null times and keys."""
    posts = spark.createDataFrame(
        [(i, f"u{i % 3}", T0 if i % 7 else None, T0 + dt.timedelta(minutes=30 * (i % 4)) if i % 5 else None, "X", "q", i % 6 if i % 11 else None)
         for i in range(60)], "post_id long, username string, uploaded_time timestamp_ntz, collected_time timestamp_ntz, channel string, query string, text_key long")
    texts = spark.createDataFrame([(0, "onor erst\nthing", "en"), (0, "onor erst\nthing", "en"), (1, "none", "de"), (1, "onti", "de"), (2, None, "en"),
                                   (3, "", None), (4, 'a "onor"', "fr"), (None, "onor", "en")], "text_key long, text string, lang string")
    return posts, texts


def test_mapped_rows_written_where_they_are_equal_the_gathered(spark, monkeypatch):
    """Texts meet the posts last, in order of the batches; the same rows, a text that is there twice included."""
    from surgewatch.plans import catalog as K
    from surgewatch.plans.pipeline import Job
    from surgewatch.sources import fixtures as FX
    j = Job(odd_posts(spark)[0], FX.wordbag(spark), texts=odd_posts(spark)[1])
    monkeypatch.setattr(K, "job", lambda spark, sf: j)
    want = sorted(K.q_write_mapped(spark, "").collect(), key=str)
    monkeypatch.setattr(K, "GATHERED_BYTES", 0)
    gathered, write = [], SNK.write_mapped
    monkeypatch.setattr(SNK, "write_mapped", lambda *a, **k: gathered.append(k["gather"]) or write(*a, **k))
    assert sorted(K.q_write_mapped(spark, "").collect(), key=str) == want != [] and gathered == [False]
    rows = K._mapped_in_order(j, SNK.mapped_order()).withColumns(dict(zip(("d", "b"), SNK.mapped_order())))
    assert "Sort" not in final_plan(rows.sortWithinPartitions("d", "b"))   # the write sorts no text


def test_batch_folders_are_written_in_order_and_compressed(spark):
    from surgewatch.sources import fixtures as FX
    posts, texts = odd_posts(spark)
    own = FX.with_texts_in_order(posts, texts, [P.batch_folder()], ["text_key"])
    assert "Sort" not in final_plan(own.select("text", P.batch_folder().alias("batch")).sortWithinPartitions("batch"))
    root = scratch_path(spark, "folders")
    P.write_batches(own, root, compression="gzip")
    assert files(root, ".csv.gz") and not files(root, ".csv")
    back = P.read_posts(spark, f"{root}/*", batch_time="b")
    want = posts.join(texts, "text_key").select("username", F.col("collected_time").cast("timestamp").alias("c")).collect()
    assert sorted(((r.username, r.b) for r in back.collect()), key=str) == sorted(map(tuple, want), key=str)


def test_mapped_rows_of_a_folder_are_one_partition_with_their_days(spark):
    path = scratch_path(spark, "one")
    rows = mapped(spark, 20)
    two = rows.unionAll(rows.withColumn("collected_time", F.col("collected_time") + F.expr("INTERVAL 1 DAY"))).coalesce(1)
    SNK.write_mapped(two, path, batch="b1")
    assert len(files(path, ".parquet")) == 1 and os.listdir(f"{path}/batch=b1")
    assert sorted(r[0].day for r in spark.read.parquet(path).select("batch_date").distinct().collect()) == [1, 2]


def test_landed_files_of_one_write_do_not_collide(spark):
    root = scratch_path(spark, "land")
    df = spark.createDataFrame([("u", str(T0), str(T0), "X", "q", "a", h) for h in ("x", "y")], ", ".join(f"{c} string" for c in [*P.POST_COLUMNS, "half"]))
    P.write_posts(df.coalesce(1), f"{root}/made", by="half")
    assert [P.land_files(spark, f"{root}/made/half={h}", f"{root}/raw/b") for h in ("x", "y", "none")] == [1, 1, 0]
    assert P.read_posts(spark, f"{root}/raw/b").count() == 2


def test_streamed_posts_are_kept_once_for_all_files(spark, monkeypatch):
    """The posts meet their texts in one pass, and what is streamed is compressed."""
    from paths import SF001
    from surgewatch.plans import catalog as K
    paths, scratch = [], K.scratch_path
    monkeypatch.setattr(K, "scratch_path", lambda *a: paths.append(scratch(*a)) or paths[-1])
    K.q_stream_posts(spark, SF001)
    assert {f.split(".")[-2] for p in paths for f in files(p, ".parquet")} == {"zstd"}
