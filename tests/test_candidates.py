"""Tokens that can be keywords: the same matches as from all tokens."""
import pytest
from pyspark.sql import functions as F

from surgewatch.functions import text as TX
from surgewatch.operators.match import plan_matcher

TEXTS = ["", None, "onor", "ONOR onor", "xonor onorx on-or", "_onor_ ERST\nerst", "onors ono 0onor onor0", "a1 A1 b", "Key key KEY",
         "é onor é", "erst", "erstİ", "THING thing thingthing", "on or", "\n\nonor", "..onor..", "\U0001F600onor\U0001F600erst", "z9", "ab"]


@pytest.mark.parametrize("bag", [["onor", "erst", "thing"], ["a1"], ["key", "z9", "onor"], ["ab", "onor", "thingthing", "0onor"], ["zzzz"]])
def test_matches_equal_those_of_all_words(spark, bag):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    m = plan_matcher(spark.createDataFrame([("c", k) for k in bag], "category string, keyword string"))
    every = F.array_distinct(F.filter(TX.words("text"), lambda w: w.isin(bag)))
    rows = df.select("text", m.matched_column("text").alias("got"), every.alias("want")).collect()
    assert [r for r in rows if r.got != r.want] == [] and (bag == ["zzzz"] or any(r.want for r in rows))


def test_only_candidates_are_taken_out(spark):
    df = spark.createDataFrame([("onor many other words and ones, ononor, erstwhile erst",)], "text string")
    assert df.select(TX.words_like("text", ["onor", "erst"])).first()[0] == ["onor", "ones", "erst"]
