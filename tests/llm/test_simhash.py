import re

import numpy as np
import xxhash

from surgewatch.llm.queries import op2_simhash_dedup
from surgewatch.llm.simhash import Index, fingerprint, keep_one_per_group, near_links, simhash_groups


def slow_fingerprint(text, k=4):
    ws = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    sh = [" ".join(ws[i:i + k]) for i in range(max(1, len(ws) - k + 1))] if ws else []
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def classes(fps, bits=4):
    """Smallest index reachable of each fingerprint."""
    a = np.array(fps, np.uint64)
    root = list(range(len(a)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a[i + 1:] ^ a[i]) <= bits) + i + 1:
            x, y = find(i), find(int(j))
            root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(a))]


def test_whole_table(spark, load):
    docs = sorted(load("documents", cols="doc_id, text"))
    got = {x.doc_id: x for x in op2_simhash_dedup(spark, "/root/testdata/sf0.001").collect()}
    fps = [slow_fingerprint(t) for _, t in docs]
    assert all(int(got[d].fingerprint, 16) == f and len(got[d].fingerprint) == 16 for (d, _), f in zip(docs, fps))
    assert [got[d].component_id for d, _ in docs] == [docs[r][0] for r in classes(fps)]


def test_index_finds_all_links():
    r = np.random.default_rng(3)
    near = r.integers(0, 1 << 63, 40).astype(np.uint64)
    fps = np.unique(np.r_[r.integers(0, 1 << 63, 3000).astype(np.uint64),
                          *[near ^ (np.uint64(1) << r.integers(0, 64, 40).astype(np.uint64)) for _ in range(30)]])
    q, m = Index(fps).search(fps, 4)
    want = {(i, int(j)) for i in range(len(fps)) for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 4)}
    assert set(zip(q.tolist(), m.tolist())) == want


def test_hot_node_is_split(spark):
    """Thousands of fingerprints under one top node: several chunks and the joins between them."""
    r = np.random.default_rng(5)
    fps = np.unique(np.r_[r.integers(0, 1 << 14, 9000), r.integers(0, 1 << 62, 500)]).astype(np.int64)
    df = spark.createDataFrame([(int(x),) for x in fps], "fp long").coalesce(1)
    from surgewatch.llm.graph import components
    got = {x.node: x.root for x in components(near_links(df)).collect()}
    want = classes(fps.view(np.uint64).tolist())
    assert [got.get(int(f), int(f)) for f in fps] == [int(fps[w]) for w in want]


def test_long_text_in_blocks(monkeypatch):
    import surgewatch.llm.simhash as s
    text = " ".join(f"w{i * 7919 % 1000}" for i in range(3000))
    want = slow_fingerprint(text)
    monkeypatch.setattr(s, "BLOCK", 64)
    assert fingerprint(text.encode(), 4) == want


def test_odd_rows(spark, odd, empty):
    rows = simhash_groups(odd).collect()
    assert len(rows) == odd.count()
    assert {x.fp for x in rows if x.doc_id in (1, 2, 3)} == {0}
    assert {x.component_id for x in rows if x.fp == 0} == {1}  # the null id's empty text included
    kept = keep_one_per_group(odd)
    assert kept.columns == odd.columns
    ids = [x.doc_id for x in kept.collect()]
    assert 2 not in ids and 3 not in ids and 1 in ids and ids.count(None) == 2
    assert simhash_groups(empty).collect() == [] and keep_one_per_group(empty).collect() == []


def test_one_id_with_several_texts(spark):
    """Each text is judged in its own group; rows equal in id and text go together."""
    a, b = " ".join(f"a{i}" for i in range(80)), " ".join(f"b{i}" for i in range(80))
    rows = [(5, a), (6, a), (6, b), (6, b), (7, b), (7, None), (8, ""), (None, a)]
    docs = spark.createDataFrame([(i, t, "x", "x") for i, t in rows], "doc_id long, text string, _d string, text_id string")
    kept = keep_one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted(((x.doc_id, x.text) for x in kept.collect()), key=str) == sorted(
        [(5, a), (6, b), (6, b), (7, None), (None, a)], key=str)
