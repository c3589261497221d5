"""The analysis job from the command line (one run per arriving batch folder).

    spark-submit surgewatch/plans/run_job.py --posts <batch folder> --wordbag <csv> --out <root>
        [--mode rows|time] [--bucket "30 minutes"] [--jdbc-url URL]

Steps: wait until the batch's files are all there -> read the batch -> map to the
wordbag -> store mapped rows -> store the batch's keyword counts per snapshot ->
metrics over the accumulated counts (the reference saw only the current batch), from
the earliest snapshot the batch touched on, so a late batch mends the later points ->
metrics sink -> alert items -> messages of the new items.  Collection times carry
seconds; a snapshot is their ``bucket``.  Every table is keyed, most by the batch, so
a replayed batch changes nothing, and a batch that comes again with other rows (fewer
keys or days, too) leaves nothing of its earlier version.
"""

from __future__ import annotations

import argparse
import datetime as dt
import re

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surgewatch.operators import alerts as A
from surgewatch.operators import counts as C
from surgewatch.operators.match import plan_matcher
from surgewatch.operators.metrics_rows import calculate_metrics
from surgewatch.operators.metrics_time import HISTORY_SLOTS, calculate_metrics_time
from surgewatch.operators.standardize import complete_batches
from surgewatch.functions.timefmt import bucket_start, interval_seconds
from surgewatch.session import checkpoint_dir, ensure_utc
from surgewatch.sources import posts as P
from surgewatch.sources import sinks as SNK
from surgewatch.streaming.stream import run_complete_batches


def batch_of(path: str) -> str:
    """Batch id of a folder: its ``yyyyMMddTHHmmssZ`` name, else its last part."""
    m = re.findall(r"\d{8}T\d{6}Z", path)
    return m[-1] if m else path.rstrip("/").rsplit("/", 1)[-1].replace("*", "all")


def run(spark: SparkSession, posts_path: str, wordbag_path: str, out: str, mode: str = "rows",
        bucket: str = "30 minutes", jdbc_url: str | None = None, batch: str | None = None,
        expected_files: int | None = None) -> bool:
    """Process one batch folder; False, without any write, while files are missing."""
    ensure_utc(spark)
    checkpoint_dir(spark)
    out = out.rstrip("/")
    batch = batch or batch_of(posts_path)
    if expected_files is not None:
        files = P.list_files(spark, posts_path).withColumn("batch", F.lit(batch))
        if complete_batches(files, expected_files).isEmpty():
            return False
    posts = P.read_posts(spark, posts_path)
    matcher = plan_matcher(P.read_wordbag(spark, wordbag_path))
    mapped_path = f"{out}/mapped"
    mapped = matcher.mapped(posts)
    SNK.write_mapped(mapped, mapped_path, batch=batch)
    # the stored mapped rows feed everything below: the posts are tokenized once
    parts = T.StructType().add("batch_date", "date").add("batch", "string")
    stored = SNK.read_stored(spark, mapped_path, T.StructType([*mapped.schema, *parts])).where(F.col("batch") == batch)
    snapshot = bucket_start("collected_time", bucket)
    kw_new = C.count_keyword(stored.drop("batch_date", "batch").withColumn("collected_time", snapshot))
    kw_path = f"{out}/keyword_counts"
    # from each (channel, query) pair's earliest touched snapshot on, points can change
    pairs = SNK.write_batch_counts(kw_new, kw_path, batch)
    kw_schema = kw_new.withColumns({"batch_date": F.to_date("collected_time"), "batch": F.lit(batch)}).schema
    table = SNK.read_stored(spark, kw_path, kw_schema)
    if mode == "time":  # exact slots reach back six steps: earlier days are pruned
        lo = pairs.agg(F.min("_since")).first()[0]
        if lo is not None:
            lo = lo - dt.timedelta(seconds=interval_seconds(bucket) * HISTORY_SLOTS)
            table = table.where((F.col("batch_date") >= F.lit(lo.date()))
                                & (F.col("collected_time") >= F.lit(lo)))
    kw_all = SNK.snapshot_counts(table.join(pairs.select("channel", "query"), ["channel", "query"], "left_semi"))
    cats = C.category_from_keyword_counts(kw_all)
    if mode == "time":
        metrics = calculate_metrics_time(cats, step_seconds=interval_seconds(bucket))
    else:
        metrics = calculate_metrics(cats)
    metrics, staged_metrics = SNK.stage(
        metrics.join(pairs, ["channel", "query"]).where(F.col("cur_time") >= F.col("_since")).drop("_since"))
    SNK.write_metrics(metrics, f"{out}/metrics", jdbc_url=jdbc_url, pairs=pairs)
    items = A.alert_items(A.extract_alert(metrics, kw_all))
    new_items = SNK.write_alert_items(items, f"{out}/alert_items", batch)
    SNK.write_messages(A.alert_message(A.alert_groups(new_items)), f"{out}/alert_messages", batch)
    SNK.drop_staged(spark, staged_metrics)
    return True


def run_when_complete(spark: SparkSession, raw: str, wordbag_path: str, out: str, expected_files, checkpoint: str,
                      mode: str = "rows", bucket: str = "30 minutes", partitions: int | None = None):
    """The job for every batch folder below ``raw``, once, when its files are all there (a stream)."""
    return run_complete_batches(
        spark, raw, lambda batch, folder: run(spark, folder, wordbag_path, out, mode, bucket, batch=batch),
        checkpoint, expected_files, partitions)


def main(argv=None):
    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("--posts", required=True)
    ap.add_argument("--wordbag", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--mode", default="rows", choices=["rows", "time"])
    ap.add_argument("--bucket", default="30 minutes")
    ap.add_argument("--jdbc-url", default=None)
    ap.add_argument("--expected-files", type=int, default=None)
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("surgewatch-job").getOrCreate()
    run(spark, a.posts, a.wordbag, a.out, a.mode, a.bucket, a.jdbc_url, expected_files=a.expected_files)


if __name__ == "__main__":
    main()
