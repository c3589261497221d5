"""The stages on nulls, repeats, empty tables and columns called like the operators' own."""
import corpus_pipeline
from pyspark.sql import functions as F

from surgewatch.llm.common import cut

SF = "/root/testdata/sf0.001"


def test_odd_rows_and_clashing_columns(spark, odd):
    own = {"score": 7.5, "lang_pred": "old", "n_lines": -1, "n_removed": "x", "a.b": 2}
    docs = odd
    for c, v in own.items():
        docs = docs.withColumn(c, F.lit(v))
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = cut(stage(spark, docs, SF))
        assert docs.columns == columns, name
        rows = docs.collect()
        assert 0 < len(rows) <= n and all(r[c] == v for r in rows for c, v in own.items()), name
        n = len(rows)
        if name == "language_id":
            assert n == sum(any(ch.isalpha() for ch in r.text or "") for r in odd.collect())
    pieces = corpus_pipeline.packing(spark, docs, SF).collect()
    assert {p.doc_id for p in pieces} == {r.doc_id for r in docs.collect()}


def test_empty_table(spark, empty):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, empty, SF)
        assert out.columns == empty.columns and out.collect() == []
    assert corpus_pipeline.packing(spark, empty, SF).collect() == []
