"""Streaming sinks are exactly-once: a replayed micro-batch changes nothing."""
import datetime as dt

from pyspark.sql import functions as F

from surgewatch.operators.match import plan_matcher
from surgewatch.session import scratch_path
from surgewatch.sources.fixtures import FIXTURE_WORDBAG
from surgewatch.streaming.stream import StreamingMetrics

T0 = dt.datetime(2024, 1, 1)
SCHEMA = ("collected_time timestamp, channel string, query string, category string, "
          "keyword string, count_keyword long")


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_replayed_micro_batch_is_a_no_op(spark):
    bag = spark.createDataFrame(FIXTURE_WORDBAG, "category string, keyword string")
    sm = StreamingMetrics(spark, plan_matcher(bag), scratch_path(spark, "sm"), "rows", 1800)
    b0 = spark.createDataFrame([(T0 + dt.timedelta(minutes=30 * k), "X", "q", "price", "thing", n)
                                for k, n in enumerate([2, 4, 1])], SCHEMA)
    b1 = spark.createDataFrame([(T0 + dt.timedelta(minutes=90), "X", "q", "price", "thing", 5),
                                (T0 + dt.timedelta(minutes=30), "X", "q", "price", "thing", 6)], SCHEMA)
    sm._upsert(b0, 0)
    sm._upsert(b1, 1)
    counts, metrics = _rows(sm.keyword_counts()), _rows(sm.metrics())
    sm._upsert(b1, 1)                       # the same batch again after a failure
    assert _rows(sm.keyword_counts()) == counts and _rows(sm.metrics()) == metrics
    # a later change at 00:30 moved the point at 01:00 too: growth (1 - 6) / 6
    m = {r["cur_time"]: r for r in sm.metrics().collect()}
    assert abs(m[T0 + dt.timedelta(minutes=60)]["short_term_growth"] - (1 - 6) / 6) < 1e-12
    assert m[T0 + dt.timedelta(minutes=90)]["cur_count"] == 5
    assert sm.metrics().where(F.col("cur_time").isNull()).count() == 0


def test_large_wordbag_streams_and_equals_batch(spark):
    """50,000 keywords: no literal set, broadcast or not; a post's repeated token counts once."""
    from surgewatch.operators import counts as C
    from surgewatch.streaming import stream as ST
    bag = spark.range(50_000).selectExpr("concat('c', id % 7) category", "concat('kw', id) keyword")
    posts = spark.range(400).selectExpr(
        "timestamp'2024-01-01' + make_interval(0, 0, 0, 0, cast(id % 5 as int)) collected_time", "'X' channel",
        "concat('q', id % 3) query", "concat('the kw', id * 131, ' kw', id * 131, ' KW', id, ' kw', id + 40000, ' other') text")
    folder = scratch_path(spark, "large-bag")
    posts.where("query <> 'q1'").write.mode("append").parquet(folder)
    posts.where("query = 'q1'").write.mode("append").parquet(folder)
    m = plan_matcher(bag)
    assert m.strategy == "join" and not m.keywords
    want = _rows(C.count_category(m.hits(posts)))
    for matcher in (m, plan_matcher(bag, broadcast_bytes=0)):
        out, ckpt = scratch_path(spark, "large-bag-out"), scratch_path(spark, "ckpt")
        src = ST.read_post_stream(spark, folder, posts.schema, max_files_per_trigger=2)
        ST.write_upserts(ST.stream_counts(src, matcher, "30 minutes"), out, ckpt,
                         ["collected_time", "channel", "query", "category"], partitions=2).awaitTermination()
        assert _rows(ST.read_table(spark, out)) == want
    assert sum(r[-1] for r in want) == C.count_category(m.hit_keys(posts, ["collected_time", "channel", "query"])).agg(
        F.sum("count_category")).first()[0] > 1000


def test_count_keys_alone_are_exploded(spark):
    """What streams and counts join to the bag carries no text and no post back."""
    posts = spark.createDataFrame([(1, "a", "b", "c")], "collected_time int, channel string, query string, text string")
    plan = plan_matcher(spark.createDataFrame(FIXTURE_WORDBAG, "category string, keyword string"), strategy="join",
                        broadcast_bytes=0).hit_keys(posts, ["collected_time", "channel", "query"])
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    above = text[:text.index("Generate explode")]
    assert "text#" not in above and text.count("Join Inner") == 1 and "_k1" not in text


def _alert(spark, kw, minutes=0, query="q"):
    return spark.sql(f"""SELECT 'X#{query}#c' pk, '{minutes}#{kw}' sk, 'X' channel, '{query}' query, 'c' category,
        timestamp'2024-01-01' + make_interval(0,0,0,0,0,{minutes}) cur_time, timestamp'2023-12-31' prev_time, 2 cur_count,
        1 prev_count, '{kw}' keyword, 1 count_keyword, 1.0BD short_term_growth, 1.0BD long_term_ratio,
        1.0BD ratio_to_total, 1.0BD acceleration, 3.0BD score""")


def test_one_message_per_inserted_alert(spark):
    """Copies in one micro-batch, in a later one, and a replay, also after a failure before the messages."""
    from surgewatch.sources.sinks import drop_staged
    from surgewatch.streaming.stream import raise_alerts
    out, seen = scratch_path(spark, "msgs"), scratch_path(spark, "seen")
    a, b, c = _alert(spark, "a"), _alert(spark, "b"), _alert(spark, "a", 30)
    read = lambda: sorted((r.cur_time.minute, r.message.rsplit(":", 1)[1]) for r in spark.read.parquet(out).collect())
    raise_alerts(a.unionAll(a).unionAll(b), 0, out, seen)
    assert read() == [(0, " a (1건),  b (1건)")]
    raise_alerts(a.unionAll(c), 1, out, seen)              # a again: an overwrite, no insert
    assert read() == [(0, " a (1건),  b (1건)"), (30, " a (1건)")]
    for lost in (False, True):
        if lost:
            drop_staged(spark, f"{out}/_v=1")
        raise_alerts(a.unionAll(c), 1, out, seen)          # the same micro-batch again
        assert read() == [(0, " a (1건),  b (1건)"), (30, " a (1건)")]
    raise_alerts(a.unionAll(b).unionAll(c), 2, out, seen)
    assert len(read()) == 2


def test_batches_run_once_when_complete(spark):
    from surgewatch.streaming.stream import run_complete_batches
    root, ckpt, runs = scratch_path(spark, "raw"), scratch_path(spark, "ckpt"), []
    expected = spark.createDataFrame([("20240101T000000Z", 2), ("20240102T000000Z", 1), ("20240103T000000Z", 3)],
                                     "batch string, expected_files int")

    def land(*batches):
        for b in batches:
            spark.range(1).coalesce(1).write.mode("append").csv(f"{root}/{b}")
        run_complete_batches(spark, root, lambda batch, folder: runs.append((batch, folder.rsplit("/", 1)[1])), ckpt,
                             expected, 2).awaitTermination()    # each call: a restart from the checkpoint
    land("20240103T000000Z", "20240101T000000Z")
    assert runs == []
    land("20240103T000000Z", "20240102T000000Z", "unknown")
    assert runs == [("20240102T000000Z", "20240102T000000Z")]
    land("20240101T000000Z", "20240103T000000Z")
    assert runs[1:] == [(b, b) for b in ("20240101T000000Z", "20240103T000000Z")]
    land("20240101T000000Z", "20240102T000000Z")                # late extra files: not a second run
    assert len(runs) == 3


def test_rows_mode_reads_tails_not_the_history(spark, monkeypatch):
    """Points in order: the count history is never read, at any length; a late one reads it, and is right."""
    from surgewatch.operators import counts as C
    from surgewatch.operators.metrics_rows import calculate_metrics
    from surgewatch.streaming import stream as ST
    bag = spark.createDataFrame(FIXTURE_WORDBAG, "category string, keyword string")
    sm = ST.StreamingMetrics(spark, plan_matcher(bag), scratch_path(spark, "sm-tails"), "rows", 1800)
    reads, full = [], ST.StreamingMetrics._current_counts
    monkeypatch.setattr(ST.StreamingMetrics, "_current_counts", lambda self: reads.append(1) or full(self))

    def points(lo, hi, step=1, extra=0):
        return spark.createDataFrame([(T0 + dt.timedelta(minutes=30 * k), "X", q, c, w, 1 + extra + (k * 7 + len(c)) % 5)
                                      for k in range(lo, hi, step) for q in "qr" for c, w in (("price", "thing"), ("safety", "erin"))
                                      if (k + len(c)) % 3], SCHEMA)

    def check():
        m = calculate_metrics(C.category_from_keyword_counts(full(sm)))
        assert _rows(sm.metrics().select(*m.columns)) == _rows(m)
    for i, (lo, hi) in enumerate([(0, 10), (10, 60), (59, 120)]):   # the last changes one more snapshot
        sm._upsert(points(lo, hi), i)
    assert reads == []
    check()
    tails = spark.read.parquet(sm.tails_path)
    assert tails.groupBy("channel", "query", "category").count().agg(F.max("count")).first()[0] == ST.TAIL
    sm._upsert(points(30, 31, extra=3).where("query = 'q'"), 3)     # later than the tails are long
    assert reads == [1]
    check()
    sm._upsert(points(118, 121, extra=1), 4)
    assert reads == [1]
    check()


def test_stream_without_an_alert_gives_no_message(spark):
    """No item ever: no message is written, and reading them gives an empty table of their columns."""
    from surgewatch.plans import catalog as K
    none = K._stream_alerts(spark, _alert(spark, "a").where("false").withColumn("cur_time", F.col("cur_time").cast("timestamp_ntz")))
    some = K._stream_alerts(spark, _alert(spark, "a").withColumn("cur_time", F.col("cur_time").cast("timestamp_ntz")))
    assert none.dtypes == some.dtypes and none.collect() == [] and some.count() == 1


def test_alert_items_are_worked_out_once(spark, monkeypatch):
    """The files that items arrive in are cut from stored items, not each from all posts."""
    from paths import SF001
    from surgewatch.plans import catalog as K
    seen, stage = [], K.SNK.stage
    monkeypatch.setattr(K.SNK, "stage", lambda df: seen.append(df.columns) or stage(df))
    K.q_stream_alerts_once(spark, SF001)
    assert seen.count(K._items(spark, SF001).columns) == 1


def test_posts_by_text_key_stream_as_posts_with_texts(spark):
    """Hits of the texts as the static side, whole or summed by category; repeated, null and missing keys."""
    from surgewatch.operators import counts as C
    from surgewatch.streaming import stream as ST
    posts = spark.range(60).selectExpr(
        "timestamp'2024-01-01' + make_interval(0, 0, 0, 0, cast(id % 5 as int)) collected_time", "'X' channel",
        "concat('q', id % 2) query", "nullif(id % 7, 3) text_key")
    texts = spark.createDataFrame([(0, "onor thing Thing"), (1, "erst"), (1, "erst"), (2, None), (4, "no"), (5, "the onti"), (None, "onti")],
                                  "text_key long, text string")
    folder, m = scratch_path(spark, "keyed"), plan_matcher(spark.createDataFrame(FIXTURE_WORDBAG, "category string, keyword string"))
    posts.write.parquet(folder)
    hits = m.hit_keys(texts, ["text_key"])
    want = _rows(C.count_category(m.hits(posts.join(texts, "text_key"))))
    src = ST.read_post_stream(spark, folder, posts.schema)
    out, ckpt = scratch_path(spark, "keyed-out"), scratch_path(spark, "ckpt")
    ST.write_upserts(ST.stream_category_hits(src, C.category_hits(hits, "text_key"), "30 minutes"), out, ckpt,
                     ["collected_time", "channel", "query", "category"], partitions=2).awaitTermination()
    assert _rows(ST.read_table(spark, out)) == want != []
    sm = StreamingMetrics(spark, m, scratch_path(spark, "sm-keyed"), "rows", 1800)
    sm.start(src, scratch_path(spark, "ckpt"), partitions=2, hits=hits).awaitTermination()
    assert _rows(C.category_from_keyword_counts(sm.keyword_counts())) == want
