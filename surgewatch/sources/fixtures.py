"""Test inputs derived from the driver's tables (see FIXTURES.md).

One ``events`` row is one post; its text is the ``documents`` row
``doc_id = event_id mod count(documents)``.  This module only shapes rows
into the post schema; every operator runs on them as on real posts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surgewatch.session import ensure_utc

# The fixture wordbag (category, keyword), raw as written in a
# wordbag file -- mixed case, padded, one keyword in two categories, a
# stopword and a multi-word keyword that can never match.
FIXTURE_WORDBAG = [
    ("safety", "onble"),
    ("safety", " Erin "),
    ("Quality", "thanedble"),
    ("quality", "onor"),
    ("service", "onor"),
    ("service", "erst"),
    ("price", "thing"),
    ("price", "onti"),
    ("legal", "the"),
    ("legal", "thing erst"),
]

# The collection cadence, at every scale.
DEFAULT_BUCKET = "30 minutes"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def wordbag(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(FIXTURE_WORDBAG, "category string, keyword string")


def post_headers(spark: SparkSession, sf_dir: str, bucket: str = DEFAULT_BUCKET) -> DataFrame:
    """Posts without their text: post_id, username, uploaded_time, collected_time, channel, query."""
    ensure_utc(spark)
    return spark.sql(
        """
        SELECT event_id AS post_id, concat('u', CAST(user_id AS STRING)) AS username,
               ts AS uploaded_time, window(ts, '{bucket}').start AS collected_time,
               CASE WHEN event_id % 2 = 0 THEN 'X' ELSE 'threads' END AS channel,
               event_type AS query
        FROM {events}
        """.replace("{bucket}", bucket), events=table(spark, sf_dir, "events"))


def keyed_posts(spark: SparkSession, sf_dir: str, bucket: str = DEFAULT_BUCKET) -> DataFrame:
    """Posts without their text, and ``text_key``, the key of their text in ``texts``."""
    ensure_utc(spark)
    return spark.sql(
        """
        SELECT event_id AS post_id, concat('u', CAST(user_id AS STRING)) AS username,
               ts AS uploaded_time, window(ts, '{bucket}').start AS collected_time,
               CASE WHEN event_id % 2 = 0 THEN 'X' ELSE 'threads' END AS channel,
               event_type AS query,
               pmod(event_id, (SELECT count(*) FROM {documents})) AS text_key
        FROM {events}
        """.replace("{bucket}", bucket),
        events=table(spark, sf_dir, "events"), documents=table(spark, sf_dir, "documents"))


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts that posts refer to: text_key, text, lang."""
    return table(spark, sf_dir, "documents").selectExpr("doc_id AS text_key", "text", "lang")


def with_texts(posts: DataFrame, rows: DataFrame) -> DataFrame:
    """``posts`` beside the ``rows`` of their ``text_key`` (texts, or what an operator made of them).

    What hangs on the text alone is thus worked out once per text, not once for each of the
    posts that have it.  A sort-merge join on the key, so the posts come out hash-spread
    over the shuffle partitions whatever the file layout of the tables (a
    broadcast of the events would leave the posts in the scan partitions of
    ``documents``, one task per file); AQE splits a skewed key.
    """
    return posts.hint("merge").join(rows, "text_key")


# Texts that a task of ``with_texts_in_order`` has in memory.
TEXT_BYTES = 128 << 20


def with_texts_in_order(posts: DataFrame, rows: DataFrame, order: list[Column], on: list[str], least: int = 1) -> DataFrame:
    """``posts`` beside the ``rows`` of their ``text_key``, each task's in ``order``, so that it can write one folder
    after another.

    The posts are sorted before they meet their texts, in a hash join that keeps their order: texts are
    moved once, not once per post, and none is in a sort.  ``on``: the columns they meet on.
    ``least``: tasks at least; as each may write a file to every folder, they number no more than the texts' size asks for.
    """
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(-(-size // TEXT_BYTES), least)
    # Spark drops a sort that it finds below a join; not below a filter that it can't work out
    own = posts.repartition(n, *on).sortWithinPartitions(*order).where(F.monotonically_increasing_id() >= 0)
    return own.join(rows.repartition(n, *on).hint("shuffle_hash"), on)


def posts(spark: SparkSession, sf_dir: str, bucket: str = DEFAULT_BUCKET) -> DataFrame:
    """Posts: post_id, username, uploaded_time, collected_time, channel, query, text, lang."""
    return with_texts(keyed_posts(spark, sf_dir, bucket), texts(spark, sf_dir)).drop("text_key")
