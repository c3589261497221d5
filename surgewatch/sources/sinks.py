"""Sinks: mapped posts, the count table (keyed upsert), metrics, alert items and messages.

No merge-capable table format is assumed.  The keyed tables are parquet
partitioned by day; an upsert reads and rewrites only the days it touches
(literal day filters, dynamic partition overwrite per write), which makes a
replayed batch a no-op.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surgewatch.schema import COUNT_KEYS, METRICS_COLUMNS
from surgewatch.session import scratch_path

# Tables that keep texts are a third smaller than with Spark's default.
COMPRESSION = "zstd"

# Up to so many touched days are named one by one in a filter; more become a range.
MAX_LISTED_DAYS = 400


def merge_counts(old: DataFrame, new: DataFrame, keys=tuple(COUNT_KEYS),
                 value: str = "count_category") -> DataFrame:
    """Keyed upsert: one row per key, the newer frame's value winning.

    A grouped ``max_by`` on a version tag (partial aggregation map-side)
    instead of collecting rows to the driver and writing them one by one.
    """
    keys = list(keys)
    tagged = (old.select(*keys, value).withColumn("_v", F.lit(0))
              .unionByName(new.select(*keys, value).withColumn("_v", F.lit(1))))
    return tagged.groupBy(*keys).agg(F.max_by(value, "_v").alias(value))


# -- tables on disk ---------------------------------------------------------------

def _hadoop(spark: SparkSession, path: str):
    hp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hp


def table_exists(spark: SparkSession, path: str) -> bool:
    fs, hp = _hadoop(spark, path)
    return bool(fs.exists(hp))


def read_stored(spark: SparkSession, path: str, schema) -> DataFrame:
    """The parquet table at ``path`` under a known schema; no table or no row yet: empty."""
    if not table_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def stage(df: DataFrame) -> tuple[DataFrame, str]:
    """Materialize ``df`` as parquet in a fresh folder of the shared checkpoint
    folder and read it back: cuts lineage (executor loss recomputes nothing
    before it) and, unlike ``checkpoint()``, carries no inherited plan
    constraints into later unions."""
    spark = df.sparkSession
    path = scratch_path(spark, "stage")
    df.write.option("compression", COMPRESSION).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop_staged(spark: SparkSession, *paths: str) -> None:
    """Remove staging folders written by ``stage`` (through the Hadoop file system)."""
    for p in paths:
        fs, hp = _hadoop(spark, p)
        fs.delete(hp, True)


def drop_folders(spark: SparkSession, uris: list[str]) -> None:
    """Remove folders named as ``_metadata.file_path`` names them (URI-encoded)."""
    for u in uris:
        hp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(spark.sparkContext._jvm.java.net.URI(u))
        hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hp, True)


def touched_days(rows: DataFrame, day_col: str) -> Column | None:
    """Filter, in literals, on the days of ``rows`` (null included); None without rows."""
    days = [r[0] for r in rows.select(day_col).distinct().limit(MAX_LISTED_DAYS + 1).collect()]
    known = [d for d in days if d is not None]
    if len(days) > MAX_LISTED_DAYS:
        lo, hi = rows.agg(F.min(day_col), F.max(day_col)).first()
        return F.col(day_col).between(F.lit(lo), F.lit(hi)) | F.col(day_col).isNull()
    if not days:
        return None
    some = F.col(day_col).isin(known) if known else F.lit(False)
    return some | F.col(day_col).isNull() if None in days else some


def write_days(rows: DataFrame, path: str, *partitions: str, cluster: list[str] | None = None) -> None:
    """Replace the partitions that ``rows`` holds (an option of this write only).

    ``cluster``: files of a partition hold ranges of these columns, sorted, so a reader of few
    of their values skips the other files and row groups by their statistics.
    """
    if cluster:
        rows = rows.repartitionByRange(*partitions, *cluster).sortWithinPartitions(*partitions, *cluster)
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", COMPRESSION)
     .partitionBy(*partitions).parquet(path))


def replace_batch(rows: DataFrame, path: str, day_col: str, day_of: str, batch: str, by_day: bool = True) -> None:
    """Make ``rows`` all that the table at ``path``, partitioned by day and ``batch``, holds of a batch.

    Without ``by_day`` the table is partitioned by ``batch`` alone, the day a column beside the others: no
    task sorts its rows, and rows of one text stay neighbours as they came, which the files keep once.
    The days of ``rows`` are overwritten; then the batch's partitions of other days, which
    an earlier version of it wrote, go: those that keep a file they had.  ``rows`` are written
    once, with no copy of them before, so they mustn't come from the table itself.  Other
    batches' partitions aren't touched or read.
    """
    spark = rows.sparkSession
    rows = rows.withColumns({day_col: F.to_date(day_of), "batch": F.lit(batch)})

    def files() -> set[str]:
        if not table_exists(spark, path):
            return set()
        own = read_stored(spark, path, rows.schema).where(F.col("batch") == batch)
        return {r["file"] for r in own.select(F.col("_metadata.file_path").alias("file")).distinct().collect()}
    before = files()
    write_days(rows, path, *([day_col] if by_day else []), "batch")
    if before:
        drop_folders(spark, sorted({f.rsplit("/", 1)[0] for f in before & files()}))


def upsert_by_day(new: DataFrame, path: str, keys: list[str], day_col: str, day_of: str,
                  gone: DataFrame | None = None, cluster: list[str] | None = None) -> DataFrame:
    """Keyed upsert into a parquet table partitioned by ``day_col`` (= date of ``day_of``).

    ``gone``: stored rows that this write takes away, by their ``keys`` and ``day_col``.
    ``cluster``: as in ``write_days``.

    Touched days are rewritten as (stored rows whose key is not in the batch) +
    batch rows, staged in the shared checkpoint folder first.  Keys compare
    null-safely.  Rows without a time keep a partition of their own.  Returns
    the stored days' rows, read back.
    """
    spark = new.sparkSession
    new, staged_new = stage(new.withColumn(day_col, F.to_date(day_of)))
    staged, out = [staged_new], new.select(*keys, day_col)
    if gone is not None:
        gone, staged_gone = stage(gone.select(*keys, day_col))
        staged.append(staged_gone)
        out = out.unionByName(gone)
    days = touched_days(out, day_col)
    if days is None:
        drop_staged(spark, *staged)
        return read_stored(spark, path, new.schema).where(F.lit(False)).drop(day_col)
    rows, stale = new, []
    if table_exists(spark, path):
        n = out.select(*[F.col(k).alias(f"_n_{k}") for k in keys]).distinct()
        same = [F.col(k).eqNullSafe(F.col(f"_n_{k}")) for k in keys]
        stored = read_stored(spark, path, new.schema).where(days)
        kept = stored.join(n, same, "left_anti")
        rows, staged_rows = stage(new.unionByName(kept.select(*new.columns)))
        staged.append(staged_rows)
        if gone is not None:  # days that hold nothing any more
            left = rows.select(F.col(day_col).alias("_d")).distinct()
            folders = stored.select(day_col, F.regexp_extract("_metadata.file_path", r"^(.*)/[^/]+$", 1).alias("folder")).distinct()
            stale = [r["folder"] for r in folders.join(left, F.col(day_col).eqNullSafe(F.col("_d")), "left_anti").collect()]
    write_days(rows, path, day_col, cluster=cluster)
    drop_folders(spark, stale)
    drop_staged(spark, *staged)
    return read_stored(spark, path, new.schema).where(days).drop(day_col)


# -- mapped rows and counts ---------------------------------------------------------

def batch_key(batch_col: str = "collected_time"):
    """Folder-safe batch id of a row: its snapshot time as ``yyyyMMddTHHmmssZ``."""
    return F.date_format(F.col(batch_col).cast("timestamp"), "yyyyMMdd'T'HHmmss'Z'")


def mapped_order(batch_col: str = "collected_time") -> list[Column]:
    """Day and batch of mapped rows; the batch is empty, which is stored as null, without a time."""
    return [F.to_date(batch_col), F.coalesce(batch_key(batch_col), F.lit(""))]


def write_mapped(mapped: DataFrame, path: str, batch_col: str = "collected_time",
                 batch: str | None = None, gather: bool = True) -> None:
    """Mapped rows as parquet partitioned by day and batch; only the batches present are
    replaced (other batches, also of the same day, are kept), so a replayed batch
    overwrites itself.  ``batch`` names the arriving folder, whose earlier rows go, also
    those of days it no longer has, in a table partitioned by batch only (a batch is replaced and read as
    a whole; ``batch_date`` is a column); without it the rows' snapshot times are their batches,
    gathered first, so that there are about as many files as batches, not that times the tasks.
    Without ``gather`` no text is moved: each task writes what it has, unsorted if its rows come by
    ``mapped_order``; for large tables in few tasks."""
    if batch is not None:
        replace_batch(mapped, path, "batch_date", batch_col, batch, by_day=False)
        return
    rows = mapped.withColumns(dict(zip(("batch_date", "batch"), mapped_order(batch_col))))
    write_days(rows.hint("rebalance", "batch_date", "batch") if gather else rows, path, "batch_date", "batch")


def upsert_counts(spark: SparkSession, new: DataFrame, path: str,
                  value: str = "count_category", keys=tuple(COUNT_KEYS)) -> DataFrame:
    """Upsert counts into the parquet table at ``path`` (partitioned by day of collected_time).

    Returns the whole table, read back.
    """
    rows = new.select(*keys, value)
    upsert_by_day(rows, path, list(keys), "batch_date", "collected_time")
    return read_stored(spark, path, rows.withColumn("batch_date", F.to_date("collected_time")).schema)


def write_batch_counts(counts: DataFrame, path: str, batch: str) -> DataFrame:
    """Store one batch's keyword counts beside those of other batches of the same snapshots.

    Partitioned by day and batch: a replay replaces the batch's own rows, keys and days that
    it no longer has included, and folders that share a snapshot add up (``snapshot_counts``).
    Returns ``channel, query, _since``: the pairs that the batch had before or has now, and
    their earliest snapshot (staged; points before it can't change).
    """
    spark = counts.sparkSession
    pairs = counts.select("channel", "query", "collected_time")
    if table_exists(spark, path):
        schema = counts.withColumns({"batch_date": F.to_date("collected_time"), "batch": F.lit(batch)}).schema
        pairs = pairs.unionByName(read_stored(spark, path, schema).where(F.col("batch") == batch).select(*pairs.columns))
    pairs, _ = stage(pairs.groupBy("channel", "query").agg(F.min("collected_time").alias("_since"))
                     .where("channel is not null and query is not null and _since is not null"))
    replace_batch(counts, path, "batch_date", "collected_time", batch)
    return pairs


def snapshot_counts(stored: DataFrame, value: str = "count_keyword") -> DataFrame:
    """Counts per snapshot over all stored batches."""
    return stored.groupBy(*COUNT_KEYS, "keyword").agg(F.sum(value).cast("long").alias(value))


# -- metrics and alerts ---------------------------------------------------------------

def metrics_frame(metrics: DataFrame) -> DataFrame:
    """Metrics in sink shape: DDL columns, timestamps cast, ``created_at`` stamped."""
    return metrics.select(*METRICS_COLUMNS).withColumns({
        "cur_time": F.col("cur_time").cast("timestamp"),
        "prev_time": F.col("prev_time").cast("timestamp"),
        "created_at": F.current_timestamp(),
    })


METRIC_KEYS = ["channel", "query", "category", "cur_time"]


def write_metrics(metrics: DataFrame, path: str | None = None, jdbc_url: str | None = None,
                  table: str = "metrics", properties: dict | None = None, pairs: DataFrame | None = None) -> None:
    """Metrics sink: a parquet table keyed by (channel, query, category, cur_time) and
    partitioned by day, where a replayed batch replaces its own rows and each day's are clustered by series; or JDBC append when
    a URL is given (as the reference), which is at-least-once: a replay appends again.

    ``pairs`` (``channel, query, _since``): ``metrics`` is all there is of them from ``_since``
    on, so stored points of theirs that it lacks go.
    """
    out = metrics_frame(metrics)
    if jdbc_url:
        out.write.jdbc(jdbc_url, table, mode="append", properties=properties or {})
        return
    gone, spark = None, metrics.sparkSession
    if pairs is not None and table_exists(spark, path):
        since = pairs.agg(F.min("_since")).first()[0]
        if since is not None:
            stored = read_stored(spark, path, out.withColumn("cur_date", F.to_date("cur_time")).schema)
            old = stored.where(F.col("cur_date") >= F.lit(since).cast("date")).select(*METRIC_KEYS, "cur_date")
            old = old.join(pairs, ["channel", "query"]).where(F.col("cur_time") >= F.col("_since")).drop("_since")
            gone = old.join(out.select(*METRIC_KEYS), METRIC_KEYS, "left_anti")
    upsert_by_day(out, path, METRIC_KEYS, "cur_date", "cur_time", gone, cluster=METRIC_KEYS)


def metric_series(metrics: DataFrame, channel: str, query: str, category: str,
                  start, end) -> DataFrame:
    """One series between two times (inclusive), ordered by time; prunes day partitions
    when the table is partitioned by ``cur_date``."""
    s, e = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    cond = ((F.col("channel") == channel) & (F.col("query") == query)
            & (F.col("category") == category) & F.col("cur_time").between(s, e))
    if "cur_date" in metrics.columns:
        cond = cond & F.col("cur_date").between(F.to_date(s), F.to_date(e))
    return metrics.where(cond).orderBy("cur_time")


def write_alert_items(items: DataFrame, path: str, batch: str = "") -> DataFrame:
    """Alert-item table (pk, sk) by day and batch; returns the batch's items that no other batch
    stored before (the insert events that raise messages).

    Items carry the batch that stored them, so a replay, also after a failure between
    this write and the messages, returns the same items again; items that a corrected
    batch no longer raises go.
    """
    spark = items.sparkSession
    items, staged = stage(items.withColumns({"cur_date": F.to_date("cur_time"), "batch": F.lit(batch)}))
    days = touched_days(items, "cur_date")
    if days is not None and table_exists(spark, path):
        others = (read_stored(spark, path, items.schema).where(days).where(F.col("batch") != batch)
                  .select("pk", "sk"))
        items = items.join(others, ["pk", "sk"], "left_anti").select(*items.columns)
    new, _ = stage(items.drop("cur_date"))
    replace_batch(new.drop("batch"), path, "cur_date", "cur_time", batch)
    drop_staged(spark, staged)
    return new


def write_messages(messages: DataFrame, path: str, batch: str) -> None:
    """Messages by day and batch: a replay replaces all of its own."""
    replace_batch(messages, path, "cur_date", "cur_time", batch)
