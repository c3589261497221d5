"""Schemas of the data model."""

from pyspark.sql import types as T

POST_COLUMNS = ["username", "uploaded_time", "collected_time", "channel", "query", "text"]

# Raw post batch as collected: every field is text (CSV).
POST_RAW = T.StructType([T.StructField(c, T.StringType(), True) for c in POST_COLUMNS])

WORDBAG = T.StructType([
    T.StructField("category", T.StringType(), True),
    T.StructField("keyword", T.StringType(), True),
])

SERIES_KEYS = ["channel", "query", "category"]
COUNT_KEYS = ["collected_time", "channel", "query", "category"]

# Metrics sink columns, in sink order.
METRICS_COLUMNS = [
    "channel", "query", "category", "cur_time", "prev_time", "cur_count", "prev_count",
    "short_term_growth", "long_term_ratio", "volatility", "ratio_to_total",
    "acceleration", "score",
]

ALERT_COLUMNS = [
    "channel", "query", "category", "cur_time", "prev_time", "cur_count", "prev_count",
    "keyword", "count_keyword", "short_term_growth", "long_term_ratio",
    "ratio_to_total", "acceleration", "score",
]
