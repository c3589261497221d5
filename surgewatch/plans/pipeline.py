"""The analysis job as one lazy plan.

posts -> tokens -> keyword hits -> keyword counts -> category counts ->
metrics -> alerts.  Nothing is collected; actions happen only in sinks.

Work sharing: the category counts are summed from the keyword counts, so
the posts are scanned and tokenized once per action; inside one action
(the alerts) the keyword-count subtree appears twice and Spark reuses its
exchange.  Posts that refer to their text by a key (``texts``) are not tokenized
at all: keywords are looked for once per text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surgewatch.config import ALERT_THRESHOLD, DEFAULT_WEIGHTS, DURATION_THRESHOLD
from surgewatch.functions.timefmt import interval_seconds
from surgewatch.operators import alerts as A
from surgewatch.operators import counts as C
from surgewatch.operators.match import Matcher, plan_matcher
from surgewatch.operators.metrics_rows import calculate_metrics
from surgewatch.operators.metrics_time import calculate_metrics_time
from surgewatch.schema import COUNT_KEYS


@dataclass
class JobConfig:
    bucket: str = "30 minutes"           # snapshot width (time-mode slot width)
    weights: tuple = DEFAULT_WEIGHTS
    threshold: float = ALERT_THRESHOLD
    duration_threshold: float = DURATION_THRESHOLD
    mode: str = "rows"                    # "rows" (window frames) or "time" (exact slots)
    text_col: str = "text"

    @property
    def step_seconds(self) -> int:
        return interval_seconds(self.bucket)


class Job:
    """Lazy frames of one analysis run over a post frame and a wordbag.

    With ``texts`` (``key``, text column, any others) the posts have ``key`` in place of
    the text; as in any join, a post has all rows of its key, and none if there is none.
    """

    def __init__(self, posts: DataFrame, bag: DataFrame | Matcher, cfg: JobConfig | None = None,
                 texts: DataFrame | None = None, key: str = "text_key"):
        self.cfg = cfg or JobConfig()
        self.posts, self.texts, self.key = posts, texts, key
        self.matcher = bag if isinstance(bag, Matcher) else plan_matcher(bag)

    def _matched(self, operator) -> DataFrame:
        """The rows a matcher's ``operator`` gives of the posts."""
        if self.texts is None:
            return operator(self.posts, self.cfg.text_col)
        return self.posts.join(operator(self.texts, self.cfg.text_col), self.key)

    def mapped(self) -> DataFrame:
        return self._matched(self.matcher.mapped)

    def hits(self) -> DataFrame:
        return self._matched(self.matcher.hits)

    def misses(self) -> DataFrame:
        return self._matched(self.matcher.misses)

    def keyword_counts(self) -> DataFrame:
        if self.texts is None:
            return C.count_keyword(self.matcher.hit_keys(self.posts, COUNT_KEYS[:3], self.cfg.text_col))
        hits = self.matcher.hit_keys(self.texts, [self.key], self.cfg.text_col)
        return C.count_keyword(self.posts.select(self.key, *COUNT_KEYS[:3]).join(hits, self.key))

    def category_counts(self) -> DataFrame:
        if self.texts is None:
            return C.category_from_keyword_counts(self.keyword_counts())
        hits = C.category_hits(self.matcher.hit_keys(self.texts, [self.key], self.cfg.text_col), self.key)
        return C.sum_category_hits(self.posts.select(self.key, *COUNT_KEYS[:3]).join(hits, self.key))

    def metrics(self, mode: str | None = None) -> DataFrame:
        return self._metrics_from(self.category_counts(), mode)

    def _metrics_from(self, cats: DataFrame, mode: str | None) -> DataFrame:
        mode = mode or self.cfg.mode
        if mode == "rows":
            return calculate_metrics(cats, self.cfg.weights)
        if mode == "time":
            return calculate_metrics_time(cats, self.cfg.weights, self.cfg.step_seconds,
                                          self.cfg.duration_threshold)
        raise ValueError(f"unknown metrics mode {mode!r}")

    def alerts(self, mode: str | None = None) -> DataFrame:
        """Alert rows.  Series with a null channel/query/category never alert (the
        join needs equal keys) and sit in window partitions of their own, so they
        are dropped once from the keyword counts shared by both sides of the join."""
        kw = self.keyword_counts().where(F.col("channel").isNotNull() & F.col("query").isNotNull()
                                         & F.col("category").isNotNull())
        return A.extract_alert(self._metrics_from(C.category_from_keyword_counts(kw), mode), kw,
                               self.cfg.threshold)

    def alert_items(self, mode: str | None = None, round_digits: int | None = None) -> DataFrame:
        return A.alert_items(self.alerts(mode), round_digits)

    def alert_messages(self, mode: str | None = None) -> DataFrame:
        return A.alert_message(A.alert_groups(self.alert_items(mode)))
