"""surgewatch: social-risk spike monitoring as Spark DataFrame operators.

Posts are cleaned and tokenized, tokens are matched against a keyword
dictionary (the *wordbag*), matches are counted per time bucket, channel,
search query and category, and spike metrics over those count series
become alerts.  Every operator is a ``DataFrame -> DataFrame`` function
built from Spark's own expressions, so Catalyst plans all of it.
"""

from surgewatch.config import DEFAULT_WEIGHTS, ALERT_THRESHOLD  # noqa: F401

__all__ = ["DEFAULT_WEIGHTS", "ALERT_THRESHOLD"]
