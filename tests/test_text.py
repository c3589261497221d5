import pytest
from pyspark.sql import functions as F

from surgewatch.functions import text as TX
from surgewatch.functions.stopwords import ENGLISH_STOPWORDS

TRICKY = [
    "Hello,\r\nWorld!! it's a TEST",
    "😀 한국어 text mixed with ASCII_words and 42 numbers",
    "Kelvin sign and İstanbul",       # non-ASCII letters that lower-case to ASCII
    "a b c d  ee\tff\x0bgg\fhh",
    "",
    "   ",
    "\"recall, \"\"fire\"\"\nagain\"",
    "thing thing THING onor",
]


def test_stopwords_match_spark_default(spark):
    from pyspark.ml.feature import StopWordsRemover
    assert list(ENGLISH_STOPWORDS) == StopWordsRemover.loadDefaultStopWords("english")


def test_preprocess_golden(spark):
    df = spark.createDataFrame([("Hello,\r\nWorld!! 😀 한국 it's",)], "t string")
    assert df.select(TX.preprocess_text("t")).first()[0] == "Hello World it s"


def test_fused_words_equal_reference_chain(spark):
    df = spark.createDataFrame([(s,) for s in TRICKY], "t string")
    rows = df.select(TX.tokenize(TX.preprocess_text("t")).alias("a"), TX.words("t").alias("b")).collect()
    for r in rows:
        assert r["a"] == r["b"]
    kel = df.where(F.col("t").startswith("K")).select(TX.words("t")).first()[0]
    assert kel == ["elvin", "sign", "and", "stanbul"]


def test_reference_tokenizer_matches_ml(spark):
    from pyspark.ml.feature import RegexTokenizer
    df = spark.createDataFrame([(s,) for s in TRICKY], "t string").withColumn(
        "clean", TX.preprocess_text("t"))
    ml = RegexTokenizer(inputCol="clean", outputCol="ml", pattern="\\W", minTokenLength=2)
    rows = ml.transform(df).select("ml", TX.tokenize("clean").alias("ours")).collect()
    for r in rows:
        assert r["ml"] == r["ours"]


def test_null_text_gives_empty_words(spark):
    df = spark.createDataFrame([(None,)], "t string")
    assert df.select(TX.words("t")).first()[0] == []


def test_remove_stopwords_keeps_repeats(spark):
    df = spark.createDataFrame([(["the", "thing", "The", "thing", "and"],)], "a array<string>")
    assert df.select(TX.remove_stopwords("a")).first()[0] == ["thing", "thing"]


def test_flatten_text(spark):
    df = spark.createDataFrame([("  a\nb 　",), (None,)], "t string")
    assert [r[0] for r in df.select(TX.flatten_text("t")).collect()] == ["a b", ""]


@pytest.mark.parametrize("user,text,expected", [
    ("kim", "kim kim  hello  world\n\n  3시간  \nkimchi is kim\n5 phút\nplain  text",
     "hello world\nkimchi is kim\nplain  text"),
    ("a.b", "a.b a.b hi\naxb hi", "hi\naxb hi"),
    ("x\\Ey", "x\\Ey z", "z"),
    ("kim", "kim\nkim", ""),
    (None, "kim hi\r\n2 giờ", "kim hi"),
    ("kim", "", ""),
    ("kim", None, None),
    ("", "  3 ngày\n keep ", "keep"),
])
def test_clean_post_text_golden(spark, user, text, expected):
    df = spark.createDataFrame([(user, text)], "u string, t string")
    assert df.select(TX.clean_post_text("t", "u")).first()[0] == expected
