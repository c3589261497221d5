"""The corpus pipeline: documents through language ID, line dedup, SimHash near-dedup,
benchmark decontamination and packing.

Each stage takes ``(spark, docs, sf_dir)``, works on all rows it gets, and returns the
columns of documents (the last: packed pieces).  ``run`` writes every stage's rows as
Parquet to the shared checkpoint folder and reads them as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from surgewatch.llm.common import fresh, named, table
from surgewatch.llm.decontaminate import remove_contaminated
from surgewatch.llm.langid import accepted, calibrate, fit, predict
from surgewatch.llm.line_dedup import dedup_lines
from surgewatch.llm.packing import pack, pieces
from surgewatch.llm.queries import tokenizer
from surgewatch.llm.simhash import keep_one_per_group
from surgewatch.session import scratch_path


def _aside(docs: DataFrame, *own: str) -> tuple[DataFrame, list[Column]]:
    """``docs`` with columns called like an operator's own renamed, and the columns that give the old names back."""
    new = [fresh(docs, c)[0] if c.lower() in own else c for c in docs.columns]
    renamed = docs.select(*[c.alias(n) for c, n in zip(named(docs), new)])
    return renamed, [c.alias(n) for c, n in zip(named(renamed), docs.columns)]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that have no language: null texts, texts without a letter, and texts whose
    score lies below the cutoff of their length class.

    The cutoffs are certified on held-out rows to reject under 0.2 % of the texts whose language the
    classifier tells rightly (``calibrate``); with too few such rows they reject nothing.  Other
    columns, repeated rows and null ids stay as they are; an empty table stays empty.
    """
    rows, back = _aside(docs, "lang_pred", "score")
    model = fit(docs)
    cutoffs = calibrate(docs, model)
    return predict(rows, model).filter(accepted(cutoffs, F.col("text"), F.col("lang_pred"), F.col("score"))).select(*back)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines of later copies; a document that was all copies stays with an empty text.

    ``n_chars`` follows the text; other columns stay as they are.  Nulls, repeated rows and empty
    tables as in ``dedup_lines``.
    """
    rows, back = _aside(docs, "n_lines", "n_removed")
    return dedup_lines(rows).withColumn("n_chars", F.length("text").cast("long")).select(*back)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each near-duplicate group (4-word shingles, 4 bits).

    Nulls, repeated rows and empty tables as in ``keep_one_per_group``.
    """
    return keep_one_per_group(docs, k=4, bits=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a benchmark item; nulls and repeats as in ``remove_contaminated``."""
    return remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 ids with their sequences and offsets.

    A null text is an empty one; every row is packed, repeated ones too; an empty table has no pieces.
    """
    return pack(pieces(docs, *tokenizer(), size=1024), size=1024)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("decontaminate", decontaminate),
    ("packing", packing),
]

#: SQL can't express language ID, SimHash groups and packing: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
