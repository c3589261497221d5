"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is run to completion with the ``noop`` sink (the whole plan
executes, nothing is collected).  ``stepwise_counts`` gives the result of
``match_count`` by the library's step-by-step text operators and a join on the
tokens, as the comparison point; ``mapped_join`` is the large-bag strategy;
``upsert_day_history_Nx`` upserts one day into a table whose history grows.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from surgewatch.functions import text as TX  # noqa: E402
from surgewatch.operators import counts as C  # noqa: E402
from surgewatch.operators.match import normalize_wordbag  # noqa: E402
from surgewatch.plans import catalog as Q  # noqa: E402
from surgewatch.schema import COUNT_KEYS  # noqa: E402
from surgewatch.session import local_session, scratch_path  # noqa: E402
from surgewatch.sources import sinks as SNK  # noqa: E402
from surgewatch.sources import fixtures as FX  # noqa: E402


def stepwise_counts(spark, sf):
    """Match counts by the library's step-by-step text operators and the join strategy (for comparison only)."""
    posts = FX.posts(spark, sf)
    tokens = posts.withColumn("tokens", TX.remove_stopwords(TX.tokenize(TX.preprocess_text("text"))))
    bag = normalize_wordbag(FX.wordbag(spark))
    hits = tokens.select(*COUNT_KEYS[:3], F.explode(F.array_distinct("tokens")).alias("keyword")).join(bag, "keyword")
    return C.count_category(hits)


def upserts(spark, sf, batches=4):
    """The same day's counts upserted into a table whose history grows fourfold between the calls timed."""
    counts = C.count_category(Q.job(spark, sf).hits())
    path = scratch_path(spark, "bench-upsert")
    seconds = []
    for k in range(batches):
        old = counts.withColumn("collected_time", F.col("collected_time") - F.expr(f"INTERVAL {60 * (k + 1)} DAYS"))
        SNK.upsert_counts(spark, old, path)
        day = counts.where(F.to_date("collected_time") == F.lit("2024-01-10").cast("date"))
        t0 = time.time()
        SNK.upsert_counts(spark, day, path)
        seconds.append(time.time() - t0)
    return seconds


HEADLINE = {
    "match_count": Q.q_count_category,
    "keyword_counts": Q.q_category_keyword_counts,
    "mapped": Q.q_map_with_wordbag,
    "metrics_rows": Q.q_metrics_rows,
    "metrics_time": Q.q_metrics_time,
    "alerts": Q.q_extract_alert,
    "alert_messages": Q.q_alert_message,
    "spikes": Q.q_exceed_streak,
    "dedupe_posts": Q.q_dedupe_posts,
    "mapped_join": Q.q_map_with_wordbag_join,
    "stepwise_counts": stepwise_counts,
}


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2 if cpus != "*" else 16,
                          app="surgewatch-bench")
    only = set(sys.argv[1:])
    # warm-up (not timed): JIT and codegen on the same code path over the smallest scale
    warm = os.path.join(os.path.dirname(sf.rstrip("/")), "sf0.001")
    if os.path.isdir(warm):
        Q.q_extract_alert(spark, warm).write.format("noop").mode("overwrite").save()
    FX.posts(spark, sf).select("post_id").write.format("noop").mode("overwrite").save()
    times = {}
    for name, fn in HEADLINE.items():
        if only and name not in only:
            continue
        t0 = time.time()
        fn(spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    if not only:
        for k, t in enumerate(upserts(spark, sf), 1):
            times[f"upsert_day_history_{k}x"] = round(t, 3)
    n_posts = FX.table(spark, sf, "events").count()
    core = [k for k in times if not k.startswith("upsert") and k not in ("stepwise_counts", "mapped_join")]
    out = {
        "metric": "headline_total_sec",
        "value": round(sum(times[k] for k in core), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf.rstrip("/").rsplit("/", 1)[-1].replace("sf", ""),
        "posts": n_posts,
        "posts_per_sec_match_count": round(n_posts / times["match_count"], 1)
        if times.get("match_count") else None,
        "cpus": cpus,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
