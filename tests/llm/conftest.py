import duckdb
import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns named like the operators' own.
CLASH = ("text_id", "w", "h", "i", "p", "rank", "place", "_doc", "_gone", "_p", "_place", "_group", "_d", "_t", "fp", "n",
         "key", "stratum", "component_id", "ids")


@pytest.fixture(scope="session")
def odd(spark):
    """Rows of documents with extra columns: nulls anywhere, empty, blank, very long, repeated."""
    from pyspark.sql import functions as F
    long = " ".join(f"word{i % 977} thing{i}" for i in range(60_000))
    para = " ".join(f"shared{i}" for i in range(60))
    rows = [(1, None, "en", "a", None), (2, "", "en", "a", 0), (3, " \t\n\x0b\r ", None, None, 6), (4, long, "en", "a", len(long)),
            (5, f"top\n{para}\nend of five", "en", None, 1), (6, f"other\n{para}\nend of six", "de", "b", 1),
            (6, f"other\n{para}\nend of six", "de", "b", 1), (None, f"{para}\nnull id", "fr", "b", 1), (7, "a", "en", "a", 1),
            (None, None, None, None, None), (8, "x\n" * 300, "en", "c", 600), (9, "1234 5678 !!! \U0001f600", "es", "c", 14),
            (10, "Été 한글 naïve", "fr", "c", 13), (6, "another text of the same id", "en", "c", 2)]
    df = spark.createDataFrame(rows, DOCS)
    return df.select("*", *[F.lit("x").alias(c) for c in CLASH])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def load():
    return lambda name, sf="sf0.001", cols="*": duckdb.sql(
        f"select {cols} from '/root/testdata/{sf}/{name}.parquet'").fetchall()
