"""End-to-end job over collector CSV batches; a replayed batch changes nothing."""
from pyspark.sql import functions as F

from paths import SF001
from surgewatch.plans.run_job import run
from surgewatch.session import scratch_path
from surgewatch.sources import fixtures as FX
from surgewatch.sources import posts as P
from surgewatch.sources import sinks as SNK


def test_job_over_two_batches_and_replay(spark):
    posts = FX.posts(spark, SF001, bucket="1 day")
    root = scratch_path(spark, "job")
    b1, b2 = f"{root}/raw/20240115T000000Z", f"{root}/raw/20240131T000000Z"
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    P.write_posts(posts.where(F.col("collected_time") < cut), b1)
    P.write_posts(posts.where(F.col("collected_time") >= cut), b2)
    bag = f"{root}/wordbag"
    FX.wordbag(spark).write.option("header", "true").csv(bag)
    out = f"{root}/out"
    run(spark, b1, bag, out, bucket="1 day")
    run(spark, b2, bag, out, bucket="1 day")
    items = spark.read.parquet(f"{out}/alert_items")
    n_items = items.count()
    n_msgs = spark.read.parquet(f"{out}/alert_messages").count()
    n_metrics = spark.read.parquet(f"{out}/metrics").count()
    run(spark, b2, bag, out, bucket="1 day")           # replay
    assert spark.read.parquet(f"{out}/alert_items").count() == n_items
    assert spark.read.parquet(f"{out}/alert_messages").count() == n_msgs
    assert spark.read.parquet(f"{out}/metrics").count() == n_metrics
    mapped = spark.read.parquet(f"{out}/mapped")
    assert sorted(r[0] for r in mapped.select("batch").distinct().collect()) == ["20240115T000000Z", "20240131T000000Z"]
    assert mapped.count() == __import__("surgewatch.plans.pipeline", fromlist=["Job"]).Job(
        posts, FX.wordbag(spark)).mapped().count()
    kw = spark.read.parquet(f"{out}/keyword_counts")
    assert kw.agg(F.sum("count_keyword")).first()[0] == FX.posts(spark, SF001, "1 day").transform(
        lambda p: __import__("surgewatch.plans.pipeline", fromlist=["Job"]).Job(
            p, FX.wordbag(spark)).hits()).count()
    assert n_items > 0
    # a run that failed before its messages: the replay writes them
    want = spark.read.parquet(f"{out}/alert_messages").where("batch = '20240131T000000Z'").count()
    SNK.drop_staged(spark, f"{out}/alert_messages")
    run(spark, b2, bag, out, bucket="1 day")
    assert spark.read.parquet(f"{out}/alert_messages").count() == want > 0


def test_incomplete_batch_waits(spark):
    root = scratch_path(spark, "job-wait")
    P.write_posts(FX.posts(spark, SF001).coalesce(2), f"{root}/raw/20240101T000000Z")
    FX.wordbag(spark).write.option("header", "true").csv(f"{root}/bag")
    args = (spark, f"{root}/raw/20240101T000000Z", f"{root}/bag", f"{root}/out")
    assert run(*args, expected_files=99) is False and not SNK.table_exists(spark, f"{root}/out")
    assert run(*args, expected_files=1) is True and SNK.table_exists(spark, f"{root}/out/mapped")


def test_upsert_reads_touched_days_only(spark):
    path = scratch_path(spark, "upsert")
    rows = spark.sql("""SELECT timestamp'2024-01-01' + make_interval(0, 0, 0, cast(id as int)) AS collected_time, 'X' AS channel,
                        'q' AS query, 'c' AS category, id AS count_category FROM range(30)""")
    SNK.upsert_counts(spark, rows, path)
    late = rows.where("count_category in (3, 4)").withColumn("count_category", F.lit(100).cast("long"))
    days = SNK.touched_days(late.withColumn("batch_date", F.to_date("collected_time")), "batch_date")
    stored = spark.read.parquet(path)
    plan = stored.where(days)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [batch_date" in plan and "2024-01-04" in plan
    for _ in range(2):
        SNK.upsert_counts(spark, late.withColumn("channel", F.lit(None).cast("string")), path)
    SNK.upsert_counts(spark, late, path)
    assert spark.read.parquet(path).agg(F.count("*"), F.sum("count_category")).first()[:] == (32, 435 - 7 + 400)
    # rows without a time keep each other, and empty batches change nothing
    null = rows.limit(1).withColumn("collected_time", F.lit(None).cast("timestamp"))
    SNK.upsert_counts(spark, null, path)
    SNK.upsert_counts(spark, null.withColumn("query", F.lit("r")), path)
    SNK.upsert_counts(spark, null.where("false"), path)
    assert spark.read.parquet(path).count() == 34


def test_sinks_leave_other_overwrites_alone(spark):
    path = scratch_path(spark, "static")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "query string, n int")
    P.write_partitioned_by_query(df, path)
    SNK.write_mapped(df.withColumn("collected_time", F.lit("2024-01-01").cast("timestamp")), scratch_path(spark, "m"))
    P.write_partitioned_by_query(df.where("n = 1"), path)
    assert spark.read.parquet(path).count() == 1


def test_first_batch_without_alerts_and_mixed_headers(spark):
    root = scratch_path(spark, "mixed")
    new = spark.createDataFrame([("u1", "2024-01-01T00:00:05Z", "2024-01-01T00:00:07Z", "X", "q", "onble")],
                                "username string, uploaded_time string, collected_time string, channel string, query string, text string")
    old = spark.createDataFrame([("q", "u2", "1704067205", "1704067207", "X", "erst, \"x\"\nonble")],
                                "keyword string, username string, uploaded_time string, collected_time string, channel string, text string")
    old.write.options(**P.CSV_WRITE_OPTIONS).csv(f"{root}/raw/20240101T000000Z")
    new.write.mode("append").options(**P.CSV_WRITE_OPTIONS).csv(f"{root}/raw/20240101T000000Z")
    rows = P.read_posts(spark, f"{root}/raw/20240101T000000Z", batch_time="b").orderBy("username").collect()
    assert [(r.username, r.query, r.channel) for r in rows] == [("u1", "q", "X"), ("u2", "q", "X")]
    assert rows[0].collected_time == rows[1].collected_time and rows[0].b == rows[1].b
    FX.wordbag(spark).write.option("header", "true").csv(f"{root}/bag")
    for k in range(2):
        run(spark, f"{root}/raw/20240101T000000Z", f"{root}/bag", f"{root}/out", batch=f"b{k}")
    m = spark.read.parquet(f"{root}/out/metrics").where("category = 'safety'").collect()
    assert [(x.cur_count, str(x.cur_time)) for x in m] == [(4, "2024-01-01 00:00:00")]  # two folders of one snapshot add up


def test_job_time_mode_matches_batch_metrics(spark):
    from surgewatch.plans.pipeline import Job, JobConfig
    posts = FX.posts(spark, SF001, bucket="1 day")
    root = scratch_path(spark, "job-time")
    b1, b2 = f"{root}/raw/a", f"{root}/raw/b"
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    P.write_posts(posts.where(F.col("collected_time") < cut), b1)
    P.write_posts(posts.where(F.col("collected_time") >= cut), b2)
    bag = f"{root}/wordbag"
    FX.wordbag(spark).write.option("header", "true").csv(bag)
    out = f"{root}/out"
    run(spark, b1, bag, out, mode="time", bucket="1 day")
    run(spark, b2, bag, out, mode="time", bucket="1 day")
    got = spark.read.parquet(f"{out}/metrics").select("channel", "query", "category", "cur_time",
                                                       F.round("score", 9).alias("s"))
    want = (Job(posts, FX.wordbag(spark), JobConfig(bucket="1 day")).metrics("time")
            .select("channel", "query", "category", F.col("cur_time").cast("timestamp").alias("cur_time"),
                    F.round("score", 9).alias("s")))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_corrected_batch_leaves_nothing_of_its_earlier_version(spark):
    """Fewer keywords, pairs and days: all tables equal those of a job that saw the corrected batch only."""
    posts = FX.posts(spark, SF001, bucket="1 day")
    root = scratch_path(spark, "job-corrected")
    FX.wordbag(spark).write.option("header", "true").csv(f"{root}/bag")
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    right = posts.where((F.col("collected_time") < cut) & (F.col("post_id") % 5 > 0))
    wrong = posts.where(F.col("collected_time") < cut).withColumns({
        "collected_time": F.col("collected_time") + F.expr("INTERVAL 3 DAYS"),
        "text": F.concat("text", F.lit(" onble onti erst")),
        "query": F.when(F.col("post_id") % 3 == 0, "mistake").otherwise(F.col("query"))})
    b1 = "20240115T000000Z"
    for name, frame in (("wrong", wrong), ("right", right)):
        P.write_posts(frame, f"{root}/{name}/{b1}")
    for out, order in (("a", (f"wrong/{b1}", f"right/{b1}")), ("b", (f"right/{b1}",))):
        for folder in order:
            run(spark, f"{root}/{folder}", f"{root}/bag", f"{root}/{out}", bucket="1 day")

    def rows(out, name, *drop):
        df = spark.read.parquet(f"{root}/{out}/{name}").drop("created_at", *drop)
        return sorted(str(r.asDict()) for r in df.select(*sorted(df.columns)).collect())
    for name in ("mapped", "keyword_counts", "metrics", "alert_items", "alert_messages"):
        assert rows("a", name) == rows("b", name) != []


def test_replaced_batch_keeps_other_batches(spark):
    path = scratch_path(spark, "replace")
    day = lambda *ids: spark.createDataFrame([(i,) for i in ids], "id int").selectExpr(
        "id", "if(id < 0, null, timestamp'2024-01-01' + make_interval(0, 0, 0, id)) as t")
    SNK.replace_batch(day(1, 2, 3, -1), path, "d", "t", "a b:c")
    SNK.replace_batch(day(2, 3, 4), path, "d", "t", "other")
    SNK.replace_batch(day(2), path, "d", "t", "a b:c")
    got = lambda: sorted((r.batch, r.id) for r in spark.read.parquet(path).collect())
    assert got() == [("a b:c", 2), ("other", 2), ("other", 3), ("other", 4)]
    SNK.replace_batch(day(2).limit(0), path, "d", "t", "a b:c")
    assert got() == [("other", 2), ("other", 3), ("other", 4)]
