"""Alerts: high-score series points joined to their keywords, grouped to messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surgewatch.config import ALERT_THRESHOLD
from surgewatch.schema import ALERT_COLUMNS

DECIMAL = "decimal(38,18)"

# The keyword item of an alert message, " {keyword} ({count}건)",
# items joined by ", ".
KEYWORD_ITEM_PREFIX = " "
KEYWORD_ITEM_SUFFIX = "건)"
KEYWORD_SEPARATOR = ", "

MESSAGE_TEMPLATE = (
    "[{channel}] {category} issue detected: monitoring needed\n"
    "- query: {query}\n"
    "- collected: {prev_time} ~ {cur_time}\n"
    "- surging category: {category} (+{growth}%)\n"
    "- top keywords:{keywords}"
)


def risk_rows(metrics: DataFrame, threshold: float = ALERT_THRESHOLD) -> DataFrame:
    """Points whose score is strictly above the threshold (null scores never alert)."""
    return metrics.where(F.col("score") > F.lit(float(threshold)))


def risk_rows_sustained(metrics_time: DataFrame, threshold: float = ALERT_THRESHOLD) -> DataFrame:
    """Stricter variant: also a sustained run of high growth (``duration_flag`` = 1)."""
    return risk_rows(metrics_time, threshold).where(F.col("duration_flag") == 1)


def extract_alert(metrics: DataFrame, kw_counts: DataFrame,
                  threshold: float = ALERT_THRESHOLD) -> DataFrame:
    """Risk rows x keyword counts on (time, channel, query, category); 14 columns.

    The risk side is a filtered fraction of the series points; AQE turns the
    join into a broadcast when its measured size allows, else sort-merge.
    """
    # Null-safe on time with non-null risk times matches exactly what equality
    # matches, without an inferred filter on the keyword-count side; callers that
    # also drop null channel/query/category from the shared keyword counts (see
    # ``Job.alerts``) get identical subtrees on both sides, and Spark reuses the
    # exchange instead of tokenizing the posts twice.
    r = risk_rows(metrics, threshold).where(F.col("cur_time").isNotNull()).alias("r")
    c = kw_counts.alias("c")
    cond = [F.col("r.cur_time").eqNullSafe(F.col("c.collected_time"))] + \
        [F.col(f"r.{k}") == F.col(f"c.{k}") for k in ("channel", "query", "category")]
    out = r.join(c, cond, "inner")
    cols = [F.col(f"c.{x}") if x in ("keyword", "count_keyword") else F.col(f"r.{x}")
            for x in ALERT_COLUMNS]
    return out.select(*cols)


def order_alerts(alerts: DataFrame) -> DataFrame:
    """Output order: score desc, count_keyword desc, then keys for determinism."""
    return alerts.orderBy(F.desc("score"), F.desc("count_keyword"), "channel", "query",
                          "category", "cur_time", "keyword")


def iso_text(ts) -> F.Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(c.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ssxxx")


def alert_items(alerts: DataFrame, round_digits: int | None = None) -> DataFrame:
    """Keyed alert items: pk = channel#query#category, sk = cur_time#keyword, doubles as decimals."""
    def dec(c):
        x = F.col(c)
        if round_digits is not None:
            x = F.round(x, round_digits)
        return x.cast(DECIMAL).alias(c)

    return alerts.select(
        F.concat_ws("#", "channel", "query", "category").alias("pk"),
        F.concat_ws("#", iso_text("cur_time"), F.col("keyword")).alias("sk"),
        "channel", "query", "category", "cur_time", "prev_time",
        F.col("cur_count").cast("int").alias("cur_count"),
        F.col("prev_count").cast("int").alias("prev_count"),
        "keyword", F.col("count_keyword").cast("int").alias("count_keyword"),
        dec("short_term_growth"), dec("long_term_ratio"), dec("ratio_to_total"),
        dec("acceleration"), dec("score"),
    )


def new_alerts(items: DataFrame, stored: DataFrame) -> DataFrame:
    """Items not yet stored under the same (pk, sk): the insert events of an upsert."""
    return items.join(stored.select("pk", "sk"), ["pk", "sk"], "left_anti")


def alert_groups(items: DataFrame) -> DataFrame:
    """One row per risk (pk) and snapshot: keywords as ``" kw (n건)"`` joined by ``", "``.

    Keyword order is count desc, keyword asc (the reference used arrival
    order, which is not deterministic).  A group holds the keywords of one
    category at one time, so its size is bounded by the wordbag.
    """
    item = F.concat(F.lit(KEYWORD_ITEM_PREFIX), F.col("keyword"), F.lit(" ("),
                    F.col("count_keyword").cast("string"), F.lit(KEYWORD_ITEM_SUFFIX))
    sorted_items = F.array_sort(F.collect_list(F.struct(
        (-F.col("count_keyword")).alias("neg"), F.col("keyword").alias("kw"), item.alias("item"))))
    return (items.groupBy("pk", "channel", "query", "category", "cur_time", "prev_time")
            .agg(F.array_join(F.transform(sorted_items, lambda s: s["item"]),
                              KEYWORD_SEPARATOR).alias("keywords"),
                 F.count(F.lit(1)).alias("n_keywords"),
                 F.max("short_term_growth").alias("short_term_growth"),
                 F.max("score").alias("score")))


def alert_message(groups: DataFrame, template: str = MESSAGE_TEMPLATE) -> DataFrame:
    """Message text per group; growth shown as round(100 * short_term_growth, 1) percent."""
    growth = F.round(F.col("short_term_growth").cast("double") * 100, 1).cast("string")
    parts = {
        "channel": F.col("channel"), "category": F.col("category"), "query": F.col("query"),
        "prev_time": iso_text("prev_time"), "cur_time": iso_text("cur_time"),
        "growth": growth, "keywords": F.col("keywords"),
    }
    pieces = []
    rest = template
    while "{" in rest:
        pre, _, tail = rest.partition("{")
        name, _, rest = tail.partition("}")
        if pre:
            pieces.append(F.lit(pre))
        pieces.append(F.coalesce(parts[name], F.lit("")))
    if rest:
        pieces.append(F.lit(rest))
    return groups.select("pk", "channel", "query", "category", "cur_time",
                         F.concat(*pieces).alias("message"))
