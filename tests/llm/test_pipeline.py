import re

import corpus_pipeline
from surgewatch.llm.common import cut, table
from test_decontaminate import windows
from test_simhash import classes, slow_fingerprint

SF = "/root/testdata/sf0.001"


def test_each_stage_on_its_own_input(spark):
    """Every stage against brute force on what the one before it kept."""
    docs = table(spark, SF, "documents")
    columns, kept = docs.columns, [{r.doc_id: r.text for r in docs.collect()}]
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "line_dedup", "simhash_dedup", "decontaminate", "packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = cut(stage(spark, docs, SF))
        assert docs.columns == columns
        kept.append({r.doc_id: r.text for r in docs.collect()})
    raw, language, lines, near, clean = kept

    assert language == {d: t for d, t in raw.items() if re.search(r"[^\W\d_]", t or "")}
    assert set(lines) == set(language) and all(len(lines[d]) <= len(t) for d, t in language.items())
    ids = sorted(lines)
    group = classes([slow_fingerprint(lines[d]) for d in ids])
    assert near == {ids[g]: lines[ids[g]] for g in set(group)}
    items = [set(windows(r.text)) for r in table(spark, SF, "benchmark").collect()]
    share = {d: max(len(i & set(windows(t))) / len(i) for i in items) for d, t in near.items()}
    assert not {d for d in clean if share[d] >= 0.8} and {d for d in near if share[d] < 0.5} <= set(clean)

    pieces = corpus_pipeline.packing(spark, docs, SF).collect()
    assert {p.doc_id for p in pieces} == set(clean)
    for by, at in (("doc_id", "start"), ("sequence_id", "offset")):
        upto = {}
        for p in sorted(pieces, key=lambda p: (p[by], p[at])):
            assert p[at] == upto.get(p[by], 0)
            upto[p[by]] = p[at] + p.length
        assert by == "doc_id" or max(upto.values()) <= 1024
    total = {p.doc_id: 0 for p in pieces}
    for p in pieces:
        total[p.doc_id] += p.length
    assert all(total[p.doc_id] == p.doc_tokens for p in pieces)
