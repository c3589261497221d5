"""Structured Streaming: the batch operators over arriving post files.

* ``read_post_stream``  -- file source over batch folders (CSV as collected, or parquet).
* ``stream_counts``     -- tumbling-window category counts with a watermark.
* ``StreamingMetrics``  -- keyword counts as a streaming aggregate in update
  mode; ``foreachBatch`` upserts the changed counts into a day-partitioned
  table (update mode emits full current values, so a replayed batch writes
  the same rows: exactly-once) and recomputes the metrics of the
  (channel, query) pairs that changed, from their earliest changed snapshot.
* ``stream_dedupe``     -- first post per (uploaded_time, username) within the watermark.
* ``stream_alert_messages`` -- alert items arriving as files become grouped messages, inserts only.
* ``run_complete_batches`` -- the job, once per batch folder, when all its files are there.

State lives in the checkpoint folder under ``spark.checkpoint.dir``, so a
lost executor or a restarted query resumes from the last committed batch.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surgewatch.config import VOLATILITY_ROWS
from surgewatch.operators import alerts as A
from surgewatch.operators import counts as C
from surgewatch.operators.match import Matcher
from surgewatch.operators.standardize import recent_posts
from surgewatch.operators.metrics_rows import calculate_metrics
from surgewatch.operators.metrics_time import HISTORY_SLOTS, calculate_metrics_time
from surgewatch.schema import COUNT_KEYS
from surgewatch.functions.timefmt import bucket_start
from surgewatch.schema import POST_RAW
from surgewatch.sources.posts import CSV_OPTIONS, post_time
from surgewatch.sources.sinks import drop_staged, read_stored, stage, table_exists, upsert_by_day, write_alert_items, write_days


@contextmanager
def state_partitions(spark: SparkSession, n: int | None):
    """Shuffle partitions for a stream's stateful operators.

    A new streaming query fixes its state partition count from the session at
    its first start (AQE cannot coalesce state), and clones the session conf
    at ``start()``; so the value is set only around the start.  Size it to the
    cluster (e.g. total executor cores) -- it cannot change later without a new
    checkpoint.
    """
    if n is None:
        yield
        return
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, str(int(n)))
    try:
        yield
    finally:
        spark.conf.set(key, old)


def read_post_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """File-source stream of post batches.

    ``fmt="csv"`` reads collector CSV (header, quoted multi-line text) with the
    all-text post schema and types the two time columns as ``read_posts`` does; a
    file whose header differs fails the query instead of shifting columns (merge
    older shapes with ``read_posts`` first).  Other formats read ``schema`` as given.
    """
    r = spark.readStream
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        df = r.schema(POST_RAW).options(**CSV_OPTIONS, enforceSchema="false").csv(path)
        return df.withColumns({"uploaded_time": post_time("uploaded_time"),
                               "collected_time": post_time("collected_time")})
    return r.schema(schema).format(fmt).load(path)


def as_event_time(df: DataFrame, col: str) -> DataFrame:
    """Watermarks need TIMESTAMP; a TIMESTAMP_NTZ column is read as UTC wall clock."""
    if isinstance(df.schema[col].dataType, T.TimestampNTZType):
        return df.withColumn(col, F.col(col).cast("timestamp"))
    return df


def _watermarked(df: DataFrame, col: str, delay: str | None) -> DataFrame:
    return df.withWatermark(col, delay) if delay else df


def post_hits(posts: DataFrame, matcher: Matcher, hits: DataFrame | None = None, key: str = "text_key") -> DataFrame:
    """``COUNT_KEYS`` and keyword of arriving posts' hits, the times as event times.

    Posts that refer to their text by ``key`` are joined to ``hits`` (``key``, keyword, category: a static
    frame that ``matcher.hit_keys`` made of the texts, best a stored one), so no text is streamed.
    """
    if hits is None:
        found = matcher.hit_keys(posts, COUNT_KEYS[:3])
    else:
        found = posts.select(key, *COUNT_KEYS[:3]).join(hits, key).drop(key)
    return as_event_time(found.where(F.col("category") != "no"), "collected_time")


def _sum_counts(hits: DataFrame, bucket: str, watermark: str | None, n: F.Column) -> DataFrame:
    agg = (_watermarked(hits, "collected_time", watermark)
           .groupBy(F.window("collected_time", bucket).alias("w"), "channel", "query", "category")
           .agg(n.alias("count_category")))
    return agg.select(F.col("w.start").alias("collected_time"), "channel", "query", "category",
                      "count_category")


def stream_category_hits(posts: DataFrame, hits: DataFrame, bucket: str, watermark: str | None = None,
                         key: str = "text_key") -> DataFrame:
    """``stream_counts`` of posts that refer to their text by ``key``, from the static ``counts.category_hits`` of the texts."""
    found = as_event_time(posts.select(key, *COUNT_KEYS[:3]).join(hits, key), "collected_time")
    return _sum_counts(found, bucket, watermark, F.sum("n_hits").cast("long"))


def stream_counts(posts: DataFrame, matcher: Matcher, bucket: str,
                  watermark: str | None = None) -> DataFrame:
    """Streaming category counts per ``bucket`` window of collected_time.

    Run in update mode (``write_upserts``): each micro-batch emits the
    current totals of the windows it changed.  Without a watermark (as in the
    reference) rows count however late they come, and the state is the count
    table's size.  A watermark bounds the state and drops what is later than it.
    """
    return _sum_counts(post_hits(posts, matcher), bucket, watermark, F.count(F.lit(1)))


def write_upserts(stream: DataFrame, path: str, checkpoint: str, keys: list[str],
                  day_of: str = "collected_time", partitions: int | None = None):
    """Run ``stream`` (update mode) once over the available input, upserting each
    micro-batch's changed rows into a keyed parquet table partitioned by day.

    Update mode emits the full current value of every changed key, so an upsert
    is exact and a replayed batch rewrites the same values.  Only the touched
    days are rewritten; readers see a plain table (no versions to merge).
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        upsert_by_day(batch, path, keys, "day", day_of)

    with state_partitions(stream.sparkSession, partitions):
        return (stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
                .foreachBatch(handle).trigger(availableNow=True).start())


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table written by ``write_upserts`` (without its day partition column)."""
    return spark.read.parquet(path).drop("day")


# Points kept per series, and the partitions of the table that keeps them.
TAIL = 4 * VOLATILITY_ROWS
BUCKETS = 32
TAIL_ROWS = ("collected_time timestamp, channel string, query string, category string, count_category long, "
             "whole boolean, bucket int")


def _bucket() -> F.Column:
    return F.pmod(F.xxhash64("channel", "query"), F.lit(BUCKETS)).cast("int")


class StreamingMetrics:
    """Counts and metrics kept current while post files arrive.

    In rows mode a table of the last TAIL points per series is the state that metrics need:
    a micro-batch reads it and the days it touches, whatever the history's length.
    """

    def __init__(self, spark: SparkSession, matcher: Matcher, root: str, mode: str = "rows",
                 bucket_seconds: int = 1800, weights=None, watermark: str | None = None):
        self.spark, self.matcher, self.root = spark, matcher, root.rstrip("/")
        self.mode, self.step, self.watermark = mode, bucket_seconds, watermark
        self.weights = weights
        self.counts_path = f"{self.root}/keyword_counts"
        self.metrics_path = f"{self.root}/metrics"
        self.tails_path = f"{self.root}/tails"

    # -- batch side: one micro-batch of changed counts ---------------------------
    def _current_counts(self) -> DataFrame:
        return read_table(self.spark, self.counts_path)

    def _upsert(self, changed: DataFrame, batch_id: int) -> None:
        changed, staged = stage(changed)
        had_counts, had_tails = table_exists(self.spark, self.counts_path), table_exists(self.spark, self.tails_path)
        touched = upsert_by_day(changed, self.counts_path, COUNT_KEYS + ["keyword"], "day", "collected_time")
        if not table_exists(self.spark, self.counts_path):  # no row yet
            drop_staged(self.spark, staged)
            return
        # A changed count moves its series' later points and the share of every
        # category in its snapshot, so the unit of recomputation is the
        # (channel, query) pair: all its series (post-aggregate rows); only points
        # at or after the pair's earliest changed snapshot can change.
        pairs = (changed.groupBy("channel", "query")
                 .agg(F.min("collected_time").alias("_since")))
        kwargs = {"weights": self.weights} if self.weights else {}
        staged_tails = []
        if self.mode == "time":
            # exact slots reach back six steps: older points cannot change any
            # recomputed row, and the day partitions before them are pruned
            counts = self._current_counts()
            lo = pairs.agg(F.min("_since")).first()[0]
            if lo is not None:
                lo = lo - dt.timedelta(seconds=self.step * HISTORY_SLOTS)
                counts = (self.spark.read.parquet(self.counts_path)
                          .where(F.col("day") >= F.lit(lo.date()))
                          .where(F.col("collected_time") >= F.lit(lo)).drop("day"))
            cats = C.category_from_keyword_counts(counts)
            hist = cats.join(pairs.select("channel", "query"), ["channel", "query"], "left_semi")
            m = calculate_metrics_time(hist, step_seconds=self.step, **kwargs)
        else:
            points = C.category_from_keyword_counts(touched.join(
                changed.select(*COUNT_KEYS).distinct(), COUNT_KEYS, "left_semi"))
            hist, staged_tails = self._points(points, pairs, had_tails or not had_counts)
            m = calculate_metrics(hist.select(*COUNT_KEYS, "count_category"), **kwargs)
        m = (m.join(pairs, ["channel", "query"]).where(F.col("cur_time") >= F.col("_since"))
             .drop("_since"))
        upsert_by_day(m, self.metrics_path, ["channel", "query", "category", "cur_time"], "day",
                      "cur_time")
        if self.mode != "time":
            self._write_tails(hist)
        drop_staged(self.spark, staged, *staged_tails)

    # -- rows mode: the last points of every series, so that a micro-batch needn't read the history

    def _tails(self, pairs: DataFrame) -> DataFrame:
        """Stored tails of the buckets that ``pairs`` fall into."""
        buckets = [r[0] for r in pairs.select(_bucket().alias("b")).distinct().collect()]  # at most BUCKETS
        return read_stored(self.spark, self.tails_path, TAIL_ROWS).where(F.col("bucket").isin(buckets))

    def _points(self, points: DataFrame, pairs: DataFrame, tails_are_there: bool) -> tuple[DataFrame, list[str]]:
        """What the metrics of ``pairs`` need: the tails with the changed ``points`` put in.

        A pair whose tails don't reach VOLATILITY_ROWS points back of its earliest change (a
        batch later than the tails are long) is read from the stored counts instead.
        Returns the points with ``whole`` (whether the series has no others), and what to drop.
        """
        tail = self._tails(pairs).join(pairs.select("channel", "query"), ["channel", "query"], "left_semi")
        series = ["channel", "query", "category"]
        old = tail.select(*COUNT_KEYS, "count_category", "whole").join(points.select(*COUNT_KEYS), COUNT_KEYS, "left_anti")
        merged = old.unionByName(points.withColumn("whole", F.lit(None).cast("boolean")))
        known = F.coalesce(F.min("whole").over(Window.partitionBy(*series)), F.lit(tails_are_there))
        # a series all of whose tail points changed keeps what its tail said
        said = tail.groupBy(*series).agg(F.min("whole").alias("_said"))
        merged = merged.withColumn("whole", known).join(said, series, "left").withColumn(
            "whole", F.coalesce("_said", "whole")).drop("_said")
        merged, staged = stage(merged)
        reach = merged.join(pairs, ["channel", "query"]).groupBy(*series).agg(
            F.min("whole").alias("whole"), F.count_if(F.col("collected_time") < F.col("_since")).alias("n"))
        short, staged_short = stage(reach.where(~F.col("whole") & (F.col("n") < VOLATILITY_ROWS))
                                    .select("channel", "query").distinct())
        if short.isEmpty():
            return merged, [staged, staged_short]
        full = C.category_from_keyword_counts(self._current_counts().join(short, ["channel", "query"], "left_semi"))
        return (merged.join(short, ["channel", "query"], "left_anti")
                .unionByName(full.withColumn("whole", F.lit(True)))), [staged, staged_short]

    def _write_tails(self, points: DataFrame) -> None:
        """The last TAIL points of each series of ``points``; other series of the same buckets stay."""
        series = ["channel", "query", "category"]
        newest = Window.partitionBy(*series).orderBy(F.desc("collected_time"))
        all_of = Window.partitionBy(*series)
        rows = points.withColumns({"_r": F.row_number().over(newest), "_n": F.count(F.lit(1)).over(all_of)}) \
            .withColumn("whole", F.col("whole") & (F.col("_n") <= TAIL)).where(F.col("_r") <= TAIL)
        rows, staged = stage(rows.select(*COUNT_KEYS, "count_category", "whole", _bucket().alias("bucket")))
        if table_exists(self.spark, self.tails_path):
            own = rows.select("channel", "query").distinct()
            others = self._tails(own).join(own, ["channel", "query"], "left_anti").select(*rows.columns)
            more, staged_more = stage(rows.unionByName(others))
            write_days(more, self.tails_path, "bucket")
            drop_staged(self.spark, staged_more)
        else:
            write_days(rows, self.tails_path, "bucket")
        drop_staged(self.spark, staged)

    def start(self, posts: DataFrame, checkpoint: str, available_now: bool = True,
              partitions: int | None = None, hits: DataFrame | None = None):
        """Run over the posts available; ``hits``: as in ``post_hits``."""
        hits = post_hits(posts, self.matcher, hits)
        # collection times carry seconds: the snapshot is their bucket
        hits = hits.withColumn("collected_time", bucket_start("collected_time", f"{self.step} seconds"))
        kw = (_watermarked(hits, "collected_time", self.watermark)
              .groupBy(*COUNT_KEYS, "keyword").agg(F.count(F.lit(1)).alias("count_keyword")))
        w = (kw.writeStream.outputMode("update")
             .option("checkpointLocation", checkpoint)
             .foreachBatch(lambda df, bid: self._upsert(df, bid)))
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
        with state_partitions(self.spark, partitions):
            return w.start()

    def metrics(self) -> DataFrame:
        """Current metrics table."""
        return read_table(self.spark, self.metrics_path)

    def keyword_counts(self) -> DataFrame:
        return self._current_counts()


def stream_recent(posts: DataFrame, now: str = "collected_time", minutes: int = 30) -> DataFrame:
    """The collectors' recency filter on a stream: posts of the last ``minutes`` at collection."""
    return recent_posts(posts, F.col(now), minutes)


def stream_dedupe(posts: DataFrame, watermark: str = "1 hour",
                  keys=("uploaded_time", "username")) -> DataFrame:
    """Drop repeats of (uploaded_time, username) arriving within the watermark delay."""
    posts = as_event_time(posts, keys[0])
    return (posts.where(F.col(keys[0]).isNotNull()).withWatermark(keys[0], watermark)
            .dropDuplicatesWithinWatermark(list(keys)))


def raise_alerts(batch: DataFrame, batch_id: int, out_path: str, seen_path: str, stored_path: str | None = None) -> None:
    """Messages of a micro-batch's inserts: of the items that neither ``stored_path`` nor an earlier
    micro-batch has under the same (pk, sk); an item that comes twice counts once.

    The items are kept in ``seen_path`` with the micro-batch that brought them, before the messages are
    written: a replay, also after a failure in between, finds its own items and writes the same messages.
    """
    spark = batch.sparkSession
    new = batch.dropDuplicates(["pk", "sk"])
    if stored_path and table_exists(spark, stored_path):
        new = A.new_alerts(new, spark.read.schema(batch.schema).parquet(stored_path))
    new = write_alert_items(new, seen_path, str(batch_id))
    msgs = A.alert_message(A.alert_groups(new)).withColumn("_v", F.lit(int(batch_id)))
    write_days(msgs, out_path, "_v")


def read_messages(items: DataFrame, path: str) -> DataFrame:
    """The messages that ``stream_alert_messages`` wrote of items like ``items``; none raised: no row."""
    return read_stored(items.sparkSession, path, A.alert_message(A.alert_groups(items)).withColumn("_v", F.lit(0)).schema).drop("_v")


def stream_alert_messages(items: DataFrame, out_path: str, checkpoint: str, stored_path: str | None = None,
                          partitions: int | None = None, seen_path: str | None = None):
    """Alert items arriving as files -> one message per risk and snapshot, for inserts only.

    Items stored before the stream (``stored_path``, keyed by pk, sk) raise no message; those that
    the stream has seen are kept in ``seen_path`` (default: beside the messages).
    """
    spark, seen = items.sparkSession, seen_path or out_path.rstrip("/") + "-seen"

    def handle(batch: DataFrame, batch_id: int) -> None:
        raise_alerts(batch, batch_id, out_path, seen, stored_path)

    with state_partitions(spark, partitions):
        return (items.writeStream.option("checkpointLocation", checkpoint)
                .foreachBatch(handle).trigger(availableNow=True).start())


# -- batch folders --------------------------------------------------------------------

# What Spark's binary-file source gives of a file; only the path is read.
FILE_ROWS = "path string, modificationTime timestamp, length long, content binary"


def complete_batch_stream(spark: SparkSession, path: str, expected: int | DataFrame) -> DataFrame:
    """Batch folders below ``path``, each once, when all its files have arrived: ``batch, folder, n_files``.

    Every file of ``path/<batch>/`` is an event (its name only); the state of a batch is the number
    of its files so far and whether it was released, so files may come in any order, over any number
    of micro-batches and restarts.  ``expected``: files per batch, or a static frame ``batch,
    expected_files`` (a batch without a row there is never complete).
    """
    file = F.col("path")
    files = spark.readStream.format("binaryFile").schema(FILE_ROWS).option("pathGlobFilter", "[!_.]*").load(f"{path.rstrip('/')}/*").select(
        F.regexp_extract(file, r"([^/]+)/[^/]+$", 1).alias("batch"), F.regexp_extract(file, r"^(.*)/[^/]+$", 1).alias("folder"))
    if isinstance(expected, int):
        files = files.withColumn("expected_files", F.lit(expected))
    else:
        files = files.join(expected.select("batch", F.col("expected_files").cast("int")), "batch")

    def release(key, frames, state):
        n, released = state.get if state.exists else (0, False)
        folder, want = None, None
        for f in frames:
            n, folder, want = n + len(f), f["folder"].iloc[0], int(f["expected_files"].iloc[0])
        now = not released and want is not None and n >= want
        state.update((n, released or now))
        if now:
            yield pd.DataFrame({"batch": [key[0]], "folder": [folder], "n_files": [n]})
    return files.groupBy("batch").applyInPandasWithState(
        release, "batch string, folder string, n_files long", "n long, released boolean", "update", "NoTimeout")


def run_complete_batches(spark: SparkSession, path: str, run_batch: Callable[[str, str], None], checkpoint: str,
                         expected: int | DataFrame, partitions: int | None = None):
    """Call ``run_batch(batch, folder)`` once for every batch folder whose files are all there.

    The driver gets the names of the folders released by a micro-batch, oldest first.  A
    micro-batch that fails is replayed with the same folders: ``run_batch`` must replace
    what it wrote for a batch, as the job does.
    """
    def handle(released: DataFrame, batch_id: int) -> None:
        for r in sorted(released.select("batch", "folder").collect()):
            run_batch(r["batch"], r["folder"])

    with state_partitions(spark, partitions):
        return (complete_batch_stream(spark, path, expected).writeStream.outputMode("update")
                .option("checkpointLocation", checkpoint).foreachBatch(handle).trigger(availableNow=True).start())
