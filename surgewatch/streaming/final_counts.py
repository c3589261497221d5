"""Counts that are final: each window is given out once, when the watermark has passed it.

Spark's append mode gives the same counts but drops what comes later than the watermark.
Here the late rows are kept in a table of their own, so that final, open and late rows
together are all rows.  Everything a micro-batch writes is a partition of its number,
so a replay, also after a failure between two writes, replaces its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surgewatch.functions.timefmt import interval_seconds
from surgewatch.operators.match import Matcher
from surgewatch.schema import COUNT_KEYS
from surgewatch.sources.sinks import drop_folders, drop_staged, read_stored, stage, table_exists, write_days
from surgewatch.streaming.stream import post_hits, state_partitions

COUNT_ROWS = ("collected_time timestamp, channel string, query string, category string, count_category long, "
              "day date, _batch long")
LATE_ROWS = "collected_time timestamp, channel string, query string, category string, keyword string, day date, _batch long"
MARK_ROWS = "mark long, _batch long"


class FinalCounts:
    """Category counts per ``bucket`` of collected_time under a watermark ``delay`` behind the newest row.

    A row is late if its window ended at or before the watermark that the micro-batches before
    its own left.  Rows without a time belong to no window and count as late.
    """

    def __init__(self, spark: SparkSession, matcher: Matcher, root: str, bucket: str, delay: str):
        self.spark, self.matcher = spark, matcher
        self.width, self.delay = interval_seconds(bucket) * 1_000_000, interval_seconds(delay) * 1_000_000
        self.paths = {x: f"{root.rstrip('/')}/{x}" for x in ("parts", "final", "late", "marks")}

    def _read(self, name: str, schema: str, spark: SparkSession | None = None) -> DataFrame:
        return read_stored(spark or self.spark, self.paths[name], schema)

    def _end(self) -> F.Column:
        """A window's end in microseconds."""
        return F.unix_micros("collected_time") + F.lit(self.width)

    def _drop(self, spark: SparkSession, name: str, schema: str, where: F.Column) -> None:
        if table_exists(spark, self.paths[name]):
            folder = F.regexp_extract("_metadata.file_path", r"^(.*)/[^/]+$", 1)
            drop_folders(spark, [r[0] for r in self._read(name, schema, spark).where(where).select(folder).distinct().collect()])

    def take(self, batch: DataFrame, batch_id: int) -> None:
        """One micro-batch of hits (``COUNT_KEYS`` and keyword)."""
        spark, bid = batch.sparkSession, F.lit(int(batch_id)).cast("long")
        before = self._read("marks", MARK_ROWS, spark).where(F.col("_batch") < bid).agg(F.max("mark")).first()[0]
        # by arithmetic: a window expression would drop rows without a time
        rows = batch.withColumn("_at", F.unix_micros("collected_time"))
        rows = rows.withColumn("collected_time", F.timestamp_micros(F.col("_at") - F.pmod("_at", F.lit(self.width))))
        rows, staged = stage(rows.withColumns({"day": F.to_date("collected_time"), "_batch": bid}))
        late = F.col("collected_time").isNull()
        if before is not None:
            late = late | (self._end() <= F.lit(before))
        own = [c for c in rows.columns if c != "_at"]
        write_days(rows.where(late).select(own), self.paths["late"], "day", "_batch")
        write_days(rows.where(~late).groupBy(*COUNT_KEYS, "day", "_batch").agg(F.count(F.lit(1)).alias("count_category")),
                   self.paths["parts"], "day", "_batch")
        newest = rows.agg(F.max("_at")).first()[0]
        marks = [m for m in (before, None if newest is None else newest - self.delay) if m is not None]
        drop_staged(spark, staged)
        if not marks:
            return
        mark = max(marks)
        done = self._open(spark, before).where(self._end() <= F.lit(mark)).where(F.col("_batch") <= bid)
        final = done.groupBy(*COUNT_KEYS, "day").agg(F.sum("count_category").alias("count_category")).withColumn("_batch", bid)
        write_days(final, self.paths["final"], "day", "_batch")
        write_days(spark.range(1).select(F.lit(mark).alias("mark"), bid.alias("_batch")), self.paths["marks"], "_batch")
        # what no replay needs: marks before the last, days given out before this micro-batch
        self._drop(spark, "marks", MARK_ROWS, F.col("_batch") < bid - 1)
        if before is not None:
            self._drop(spark, "parts", COUNT_ROWS, F.col("day") < F.to_date(F.timestamp_micros(F.lit(before - self.width))))

    def _open(self, spark: SparkSession, mark: int | None) -> DataFrame:
        """Parts of the windows that end after ``mark``; earlier days aren't read."""
        parts = self._read("parts", COUNT_ROWS, spark)
        if mark is None:
            return parts
        first = F.to_date(F.timestamp_micros(F.lit(mark - self.width)))
        return parts.where((F.col("day") >= first) & (self._end() > F.lit(mark)))

    def start(self, posts: DataFrame, checkpoint: str, partitions: int | None = None, hits: DataFrame | None = None):
        """Run over the posts available; state is the parts table, so the stream itself has none.  ``hits``: as in ``post_hits``."""
        hits = post_hits(posts, self.matcher, hits)
        with state_partitions(posts.sparkSession, partitions):
            return (hits.select(*COUNT_KEYS, "keyword").writeStream.option("checkpointLocation", checkpoint)
                    .foreachBatch(self.take).trigger(availableNow=True).start())

    def final(self) -> DataFrame:
        """Counts of the windows given out."""
        return self._read("final", COUNT_ROWS).select(*COUNT_KEYS, "count_category")

    def open(self) -> DataFrame:
        """Counts so far of the windows that the watermark hasn't passed."""
        mark = self._read("marks", MARK_ROWS).agg(F.max("mark")).first()[0]
        return self._open(self.spark, mark).groupBy(*COUNT_KEYS).agg(F.sum("count_category").alias("count_category"))

    def late(self) -> DataFrame:
        """The rows that came later than the watermark: ``COUNT_KEYS`` (the window's start) and keyword."""
        return self._read("late", LATE_ROWS).select(*COUNT_KEYS, "keyword")
