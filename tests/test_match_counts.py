from pyspark.sql import functions as F

from surgewatch.operators import counts as C
from surgewatch.operators.match import normalize_wordbag, plan_matcher
from surgewatch.sources.fixtures import FIXTURE_WORDBAG

POSTS = [
    (1, "The thing, THING and onor.", "X", "q1"),
    (2, "Erin's place", "X", "q1"),
    (3, "thing erst", "threads", "q1"),
    (4, "the", "X", "q1"),
    (5, None, "X", "q1"),
]


def _posts(spark):
    df = spark.createDataFrame(POSTS, "post_id long, text string, channel string, query string")
    return df.withColumns({"username": F.lit("u"), "uploaded_time": F.lit(None).cast("timestamp"),
                           "collected_time": F.lit("2024-01-01 00:00:00").cast("timestamp")})


def _bag(spark):
    return spark.createDataFrame(FIXTURE_WORDBAG + [("price", "thing")], "category string, keyword string")


def _rows(df):
    return sorted((r["post_id"], r["keyword"], r["category"]) for r in df.collect())


def test_wordbag_normalized(spark):
    b = sorted(tuple(r) for r in normalize_wordbag(_bag(spark)).collect())
    assert ("quality", "thanedble") in b and ("safety", "erin") in b
    assert len(b) == len(set(b)) == 10


def test_mapping_golden_both_strategies(spark):
    expected = [
        (1, "onor", "quality"), (1, "onor", "service"), (1, "thing", "price"),
        (2, "erin", "safety"),
        (3, "erst", "service"), (3, "thing", "price"),
        (4, "no", "no"), (5, "no", "no"),
    ]
    for strategy in ("literal", "join"):
        m = plan_matcher(_bag(spark), strategy=strategy)
        assert m.strategy == strategy
        assert _rows(m.mapped(_posts(spark))) == expected
        assert _rows(m.hits(_posts(spark))) == [r for r in expected if r[1] != "no"]
        assert sorted(r["post_id"] for r in m.misses(_posts(spark)).collect()) == [4, 5]
        mk = {r["post_id"]: r["matched"] for r in m.match_keywords(_posts(spark)).collect()}
        assert mk[1] == ["onor", "thing"] and mk[4] == [] and mk[5] == []


def test_counts_are_match_rows(spark):
    m = plan_matcher(_bag(spark))
    hits = m.hits(_posts(spark))
    cat = {(r["channel"], r["category"]): r["count_category"] for r in C.count_category(hits).collect()}
    assert cat[("X", "price")] == 1 and cat[("threads", "price")] == 1 and cat[("X", "quality")] == 1
    kw = C.count_keyword(hits)
    summed = {(r["channel"], r["category"]): r["count_category"]
              for r in C.category_from_keyword_counts(kw).collect()}
    assert summed == cat
    ckc = C.category_keyword_counts(kw).collect()
    assert all(r["count_category"] >= r["count_keyword"] for r in ckc)


def test_hits_plan_is_broadcast_and_python_free(spark):
    m = plan_matcher(_bag(spark))
    plan = m.hits(_posts(spark))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    for udf in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF"):
        assert udf not in plan


def test_join_strategy_never_explodes_texts(spark):
    """Below the exploded tokens only post keys are exchanged."""
    import re
    from paths import SF001
    from surgewatch.operators.match import plan_matcher
    from surgewatch.sources import fixtures as FX
    p = FX.table(spark, SF001, "documents").select("doc_id", "text")
    m = plan_matcher(FX.wordbag(spark), strategy="join", broadcast_bytes=0)
    plan = m.match_keywords(p)._jdf.queryExecution().optimizedPlan().toString()
    above = plan[plan.index("Aggregate [_k1"):plan.index("Generate explode")]
    assert not re.search(r"Project \[[^\n]*text#", above) and "Join Inner" in above
    a = {(r.doc_id, tuple(r.matched)) for r in m.match_keywords(p.unionAll(p)).collect()}
    b = {(r.doc_id, tuple(r.matched)) for r in plan_matcher(FX.wordbag(spark)).match_keywords(p).collect()}
    assert a == b


def test_rank_of_equal_counts_is_spread(spark):
    """All counts 1: every partition numbers a like share, and ranks are those of one sort."""
    rows = spark.range(20_000).selectExpr(
        "timestamp'2024-01-01' + make_interval(0,0,0,0,0,cast(id % 50 as int)) collected_time", "'X' channel",
        "concat('q', id % 7) query", "concat('c', id % 3) category", "concat('k', id) keyword",
        "1L count_category", "1L count_keyword")
    got = C.ranked_keywords(rows, 8)
    sizes = sorted(r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect())
    assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[4]
    keys = ["collected_time", "channel", "query", "category", "keyword"]
    want = sorted(tuple(r) for r in rows.select(*keys).collect())
    assert [tuple(r) for r in got.orderBy("rank").select(*keys).collect()] == want
    assert [r[0] for r in got.orderBy("rank").select("rank").collect()] == list(range(1, 20_001))
    assert C.ranked_keywords(rows.limit(0)).collect() == []
