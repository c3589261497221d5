"""Posts that refer to their texts by a key: the same rows as from posts that hold them, the text worked on once."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from surgewatch.functions import text as TX
from surgewatch.operators.match import plan_matcher
from surgewatch.plans.pipeline import Job
from surgewatch.sources import fixtures as FX

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def frames(spark):
    posts = spark.createDataFrame(
        [(1, T0, "X", "q", 0), (2, T0, "X", "q", 0), (2, T0, "X", "q", 0), (3, T0, None, "q", 1), (4, None, "X", "q", 2),
         (5, T0, "X", "q", None), (6, T0, "X", "q", 9), (7, T0, "X", "q", 3)],
        "post_id long, collected_time timestamp, channel string, query string, text_key long")
    texts = spark.createDataFrame(
        [(0, "Onor onor thing"), (1, "ERST"), (1, "ERST"), (2, None), (2, "erin"), (3, "nothing here"), (None, "onor")],
        "text_key long, text string")
    return posts, texts


def rows(df, cols):
    return sorted(df.select(*cols).collect(), key=str)


@pytest.mark.parametrize("strategy", ["literal", "join"])
def test_job_by_texts_equals_job_by_posts(spark, frames, strategy):
    posts, texts = frames
    m = plan_matcher(FX.wordbag(spark), strategy=strategy)
    by_text, by_post = Job(posts, m, texts=texts), Job(posts.join(texts, "text_key"), m)
    cols = ["post_id", "text", "category", "keyword"]
    assert rows(by_text.mapped(), cols) == rows(by_post.mapped(), cols)
    assert rows(by_text.hits(), cols) == rows(by_post.hits(), cols)
    assert rows(by_text.misses(), cols) == rows(by_post.misses(), cols)
    for name in ("keyword_counts", "category_counts"):
        a, b = getattr(by_text, name)(), getattr(by_post, name)()
        assert a.dtypes == b.dtypes and rows(a, a.columns) == rows(b, a.columns) != []


def test_text_is_worked_on_below_the_join_with_the_posts(spark):
    from paths import SF001
    from surgewatch.plans.catalog import QUERIES
    for name in ("tokenize", "preprocess_text", "remove_stopwords", "lower_tokens", "count_keyword"):
        plan = QUERIES[name](spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("Join Inner") < plan.index("regexp_"), name


def test_posts_are_not_exploded_by_words(spark):
    """The large wordbag meets each text's words once; posts meet a row per category."""
    from paths import SF001
    from surgewatch.plans.catalog import QUERIES
    plan = QUERIES["count_category_large_bag"](spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("n_hits") < plan.index("explode")


def test_trim_of_lines_takes_the_whole_class(spark):
    spaces = "".join(c for c in TX.PY_SPACES)
    df = spark.createDataFrame([(f"{spaces}a{spaces}b c{spaces}",)], "t string")
    same = F.regexp_replace("t", rf"^{TX.PY_SPACE_CLASS}+|{TX.PY_SPACE_CLASS}+$", "") == F.btrim("t", F.lit(TX.PY_SPACES))
    assert len(TX.PY_SPACES) == sum(chr(i).isspace() for i in range(0x110000)) and df.select(same).first()[0]
