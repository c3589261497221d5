"""Post standardization: the collectors' row rules as DataFrame operators.

Deduplication finds the first row per key in a grouped aggregate rather than
by ``row_number`` over a window: the aggregate combines map-side, so a key
holding a third of all rows still costs one row per map task before the
shuffle.
"""

from __future__ import annotations

from decimal import Decimal
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surgewatch.config import QUERY_CAP
from surgewatch.functions.text import clean_post_text, flatten_text


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def recent_posts(posts: DataFrame, now, minutes: int = 30, ts: str = "uploaded_time") -> DataFrame:
    """Keep posts with ``now - minutes <= ts <= now`` (closed on both ends)."""
    hi = _c(now)
    lo = hi - F.expr(f"INTERVAL {int(minutes)} MINUTES")
    return posts.where(F.col(ts).between(lo, hi))


def date_range_posts(posts: DataFrame, since, until, ts: str = "uploaded_time") -> DataFrame:
    """Keep posts with ``since <= ts < until`` (half-open)."""
    return posts.where((F.col(ts) >= _c(since)) & (F.col(ts) < _c(until)))


def lang_filter(posts: DataFrame, lang: str = "en", strict: bool = True,
                lang_col: str = "lang") -> DataFrame:
    """strict: language must equal ``lang``; lenient: unknown (null/empty) passes too."""
    c = F.col(lang_col)
    if strict:
        return posts.where(c.eqNullSafe(F.lit(lang)))
    return posts.where(c.isNull() | (c == "") | (c == lang))


def query_in_text(posts: DataFrame, text: str = "text", query: str = "query") -> DataFrame:
    """Keep posts whose text contains the search query, case-insensitively."""
    return posts.where(F.contains(F.lower(F.col(text)), F.lower(F.col(query))))


def flatten_posts(posts: DataFrame, text: str = "text") -> DataFrame:
    return posts.withColumn(text, flatten_text(text))


def clean_threads_posts(posts: DataFrame, text: str = "text",
                        username: str = "username") -> DataFrame:
    return posts.withColumn(text, clean_post_text(text, username))


def drop_empty_posts(posts: DataFrame, text: str = "text", username: str = "username") -> DataFrame:
    """Drop posts with neither a username nor a text."""
    u, t = F.col(username), F.col(text)
    return posts.where((u.isNotNull() & (u != "")) | (t.isNotNull() & (t != "")))


# Order columns that fit beside a tie's hash in one fixed-width number.
_PLACES = {T.ByteType: lambda c: c, T.ShortType: lambda c: c, T.IntegerType: lambda c: c, T.LongType: lambda c: c,
           T.DateType: F.unix_date, T.TimestampType: F.unix_micros,
           T.TimestampNTZType: lambda c: F.unix_micros(c.cast("timestamp"))}


def _place(df: DataFrame, order: Column, tie: Column) -> Column | None:
    """``order`` (nulls first), then 62 bits of ``tie``, as one decimal; None for other types."""
    as_long = _PLACES.get(type(df.select(order.alias("o")).schema["o"].dataType))
    if as_long is None:
        return None
    whole = lambda c: c.cast("decimal(20,0)")
    first = F.coalesce(whole(as_long(order).cast("long")) + F.lit(Decimal(2 ** 63 + 1)), F.lit(Decimal(0)))
    return (whole(first) * F.lit(Decimal(2 ** 62)) + whole(F.shiftrightunsigned(tie, 2))).cast("decimal(38,0)")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the row with the smallest ``order``, nulls first.

    Ties in ``order`` are broken by a hash of the columns, so the result is deterministic.
    Null keys form their own group.

    With one order column of a number, date or time the winners are found without the rows:
    a hash aggregate over 128 bits of the key and one fixed-width place, combined map-side.  The
    rows then meet the winners on key and place, so a hot key's rows spread by their places,
    and equal rows are numbered.  Other orders carry the rows in a grouped ``min_by``.
    """
    others = [c for c in df.columns if c not in keys]
    place = _place(df, _c(order[0]), F.xxhash64(*df.columns)) if len(order) == 1 else None
    if place is None:
        ordering = F.struct(*[_c(o) for o in order], F.xxhash64(*others))
        picked = df.groupBy(*keys).agg(F.min_by(F.struct(*others), ordering).alias("_first"))
        return picked.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in others]).select(*df.columns)
    # 128 bits of the key
    own = {"_k": F.xxhash64(*keys), "_l": F.xxhash64(F.lit(1), *keys), "_p": place}
    winners = df.select(*[c.alias(n) for n, c in own.items()]).groupBy("_k", "_l").agg(F.min("_p").alias("_p"))
    rows = df.withColumns(own).join(winners, list(own), "left_semi")
    same = Window.partitionBy(*own).orderBy("_p")
    return rows.withColumn("_r", F.row_number().over(same)).where("_r = 1").select(*df.columns)


def dedupe_page(posts: DataFrame, page_keys: Sequence[str], order: Sequence[str | Column],
                ts: str = "uploaded_time") -> DataFrame:
    """Within one page parse, keep the first post per uploaded time."""
    return first_per_key(posts, [*page_keys, ts], order)


def dedupe_posts(posts: DataFrame, order: Sequence[str | Column],
                 keys: Sequence[str] = ("uploaded_time", "username")) -> DataFrame:
    """First-seen post per (uploaded_time, username); posts without a time are dropped."""
    return first_per_key(posts.where(F.col(keys[0]).isNotNull()), list(keys), order)


def stamp_posts(posts: DataFrame, channel: str | None = None, query: str | None = None,
                collected_time=None) -> DataFrame:
    """Add constant columns and rename legacy shapes (``keyword`` -> ``query``)."""
    df = posts
    if "keyword" in df.columns and "query" not in df.columns:
        df = df.withColumnRenamed("keyword", "query")
    stamps = {}
    if channel is not None:
        stamps["channel"] = F.lit(channel)
    if query is not None:
        stamps["query"] = F.lit(query)
    if collected_time is not None:
        stamps["collected_time"] = _c(collected_time)
    return df.withColumns(stamps) if stamps else df


def cap_per_query(posts: DataFrame, cap: int = QUERY_CAP,
                  keys: Sequence[str] = ("collected_time", "channel", "query"),
                  order: Sequence[Column] | None = None, salt_buckets: int = 64) -> DataFrame:
    """Newest ``cap`` posts per key (exact top-k per group).

    Two exact phases: per (key, salt) first, then per key over at most
    ``salt_buckets * cap`` survivors, so no task sorts a hot key's rows.  Ties in
    ``order`` are broken by a hash of the whole row, so the order is total and
    only equal rows are interchangeable.
    """
    row = F.xxhash64(*posts.columns)
    order = [*(order or [F.desc("uploaded_time")]), F.col("_row")]

    def top(df: DataFrame, part: list) -> DataFrame:
        w = Window.partitionBy(*part).orderBy(*order)
        return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= cap).drop("_rn")

    salted = posts.withColumn("_row", row).withColumn("_salt", F.pmod("_row", F.lit(salt_buckets)))
    return top(top(salted, [*keys, "_salt"]).drop("_salt"), list(keys)).drop("_row")


def complete_batches(files: DataFrame, expected: int, batch: str = "batch", file: str = "file") -> DataFrame:
    """Batches all of whose ``expected`` files are in: ``(batch, n_files, expected_files)``.

    ``files``: one row per arrived file; a file listed twice counts once.
    """
    return (files.groupBy(batch).agg(F.count_distinct(file).alias("n_files"))
            .withColumn("expected_files", F.lit(int(expected))).where(F.col("n_files") >= F.col("expected_files")))


def batch_stats(posts: DataFrame, since, keys: Sequence[str] = ("query", "collected_time"),
                ts: str = "uploaded_time") -> DataFrame:
    """Per batch: newest and oldest post time and whether any is older than ``since``."""
    return posts.groupBy(*keys).agg(
        F.max(ts).alias("newest"), F.min(ts).alias("oldest"),
        F.coalesce(F.bool_or(F.col(ts) < _c(since)), F.lit(False)).alias("any_older"),
        F.count(F.lit(1)).alias("n_posts"))


def collect_summary(posts: DataFrame, queries: DataFrame, query: str = "query") -> DataFrame:
    """Rows saved per query (0 for listed queries without rows), total, and ok flag.

    The total is a window over the summary, whose size is the query list.
    """
    saved = posts.groupBy(query).agg(F.count(F.lit(1)).alias("saved"))
    per = (queries.select(query).distinct().join(saved, query, "left")
           .withColumn("saved", F.coalesce("saved", F.lit(0)).cast("long")))
    total = F.sum("saved").over(Window.partitionBy())
    return per.select(query, "saved", total.cast("long").alias("total_saved"),
                      (total > 0).alias("ok"))


def safe_query_name(query: str = "query") -> Column:
    """Folder-safe query name: ``/`` to ``_`` and space to ``-``."""
    return F.translate(F.col(query), "/ ", "_-")
