import random
import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from surgewatch.llm.packing import first_fit_decreasing, pack, pieces, sequences
from surgewatch.llm.queries import op3_token_counts, op7_packing, tokenizer
from surgewatch.llm.tokens import count_documents, count_written, encode, flat_files, read_flat_files, token_counts, write_flat_files


def slow_ids(text):
    return Tokenizer.from_file(tokenizer()[0]).encode(text, add_special_tokens=False).ids


def test_encode_equals_the_tokenizer():
    r = random.Random(4)
    slow = Tokenizer.from_file(tokenizer()[0])
    chars = [chr(c) for c in range(0x250)] + list("  \n\n\t'stve<|endoftext|> 　 한\U0001f600 ​")
    texts = ["".join(r.choice(chars) for _ in range(r.randint(0, 60))) for _ in range(3000)]
    texts += ["a<|endoftext|>b", "", " ", "x" * 5000, " " * 5000, "".join(chars), "it's we'll I'd  don't\r\n\r\n x"]
    for t in texts:
        assert encode(t, *tokenizer()).tolist() == slow.encode(t, add_special_tokens=False).ids, repr(t)


def test_count_documents_across_blocks(spark):
    r = random.Random(1)
    files, rows, want = 3, [], {}
    for f in range(files):
        lens = [r.choice([0, 1, 5, 40, 300]) for _ in range(60)]
        flat = np.concatenate([np.r_[np.ones(n, "<u2"), np.array([9], "<u2")] for n in lens] + [np.ones(f * 3, "<u2")]).astype("<u2")
        want[f] = lens + [f * 3] * (f > 0)
        at = block = 0
        while at < len(flat):
            n = r.choice([1, 7, 64])
            rows.append((f, block, flat[at:at + n].tobytes()))
            at, block = at + n, block + 1
        rows.append((f, block, None))
    df = spark.createDataFrame(rows, "file long, block long, data binary").repartition(5)
    got = defaultdict(list)
    for x in count_documents(df, eod=9, span=4).orderBy("file", "doc").collect():
        start = sum(n + 1 for n in want[x.file][:x.doc])
        assert x.start == start and x.doc == len(got[x.file]) and x.closed == (x.doc < 60)
        got[x.file].append(x.n_tokens)
    assert got == want
    assert count_documents(df.limit(0), eod=9).collect() == []


def test_read_flat_files(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(np.array([1, 2, 0, 3, 0, 4], "<u2").tobytes())
    (tmp_path / "b.bin").write_bytes(b"")
    got = count_documents(read_flat_files(spark, str(tmp_path), block_bytes=4), eod=0).orderBy("doc").collect()
    assert [(x.n_tokens, x.start, x.closed) for x in got] == [(2, 0, True), (1, 3, True), (1, 5, False)]


def test_op3_counts_every_document(spark, load):
    want = sorted((d, len(slow_ids(t))) for d, t in load("documents", cols="doc_id, text"))
    assert sorted((x.doc_id, x.n_tokens) for x in op3_token_counts(spark, "/root/testdata/sf0.001").collect()) == want


def test_files_read_by_ranges(spark, tmp_path):
    """A file of many ranges, a folder whose name needs quoting, and half an id at the end."""
    r, folder = random.Random(7), tmp_path / "a b%20c"
    folder.mkdir()
    lens = [r.choice([0, 1, 30, 2000]) for _ in range(400)]
    flat = np.concatenate([np.r_[np.full(n, 3, "<u4"), np.array([70_000], "<u4")] for n in lens]).astype("<u4")
    (folder / "big.bin").write_bytes(flat.tobytes() + b"\x01\x02\x03")
    blocks = read_flat_files(spark, str(folder), block_bytes=1000)
    assert blocks.count() == -(-(flat.nbytes + 3) // 1000)
    got = count_documents(blocks, eod=70_000, width=4, span=16).orderBy("doc").collect()
    assert [x.n_tokens for x in got] == lens and all(x.closed for x in got)


def test_files_of_other_attempts_do_not_count(spark, odd, empty, tmp_path):
    path = str(tmp_path / "flat")
    index = write_flat_files(odd.coalesce(2), path, *tokenizer())
    stray = tmp_path / "flat" / "tokens" / "part-000000-99999999.bin"
    stray.write_bytes(np.array([5, 50256], "<u2").tobytes())
    want = sorted((str(x.doc_id), len(slow_ids(x.text or ""))) for x in odd.collect())
    got = count_written(index, path, block_bytes=100).collect()
    assert sorted((str(x.id), x.n_tokens) for x in got) == want
    assert token_counts(empty, str(tmp_path / "none"), *tokenizer()).collect() == []


def test_ids_that_do_not_fit(spark, tmp_path):
    import pytest

    from surgewatch.llm.tokens import _stored
    with pytest.raises(ValueError, match="does not fit"):
        _stored(np.array([1, 70_000]), 2)
    assert _stored(np.array([1, 70_000]), 4).tolist() == [1, 70_000]


def test_flat_files_of_small_blocks(spark, odd, empty):
    got = count_documents(flat_files(odd.coalesce(2), *tokenizer(), block_tokens=100))
    want = sorted(len(slow_ids(x.text or "")) for x in odd.collect())
    assert sorted(x.n_tokens for x in got.collect()) == want
    assert count_documents(flat_files(empty, *tokenizer())).collect() == []


def check_packed(rows, texts, size=1024):
    ids = {d: np.array(slow_ids(t or "") + [0], "<u4") for d, t in texts.items()}
    held, own = defaultdict(list), defaultdict(list)
    for x in rows:
        assert x.doc_tokens == len(ids[x.doc_id])
        assert x.ids_crc32 == zlib.crc32(ids[x.doc_id][x.start:x.start + x.length].tobytes())
        held[x.sequence_id].append((x.offset, x.length))
        own[x.doc_id].append((x.start, x.length))
    for parts, full in [(v, None) for v in held.values()] + [(own[d], len(ids[d])) for d in ids]:
        at = 0
        for lo, n in sorted(parts):
            assert lo == at and n > 0
            at += n
        assert at <= size if full is None else at == full
    return sum(map(len, ids.values())) / (len(held) * size)


def test_op7_packs_every_id_once(spark, load):
    rows = op7_packing(spark, "/root/testdata/sf0.001").collect()
    assert check_packed(rows, dict(load("documents", cols="doc_id, text"))) > 0.97


def test_pack_odd_rows(spark, odd, empty):
    from pyspark.sql import functions as F
    named = odd.withColumn("doc_id", F.monotonically_increasing_id())
    p = pack(pieces(named, *tokenizer(), size=64, keep_ids=True), size=64, group_pieces=50)
    check_packed(p.collect(), {x.doc_id: x.text for x in named.collect()}, 64)
    s = sequences(p).collect()
    assert sum(len(x.ids) for x in s) == sum(len(slow_ids(x.text or "")) + 1 for x in odd.collect())
    assert max(len(x.ids) for x in s) <= 64
    rows = pack(pieces(odd, *tokenizer())).collect()  # null and repeated ids keep their pieces
    assert sum(x.length for x in rows) == sum(len(slow_ids(x.text or "")) + 1 for x in odd.collect())
    clash = pieces(odd, *tokenizer()).selectExpr("*", "'x' as _place", "'y' as _group")
    assert pack(clash).columns == clash.columns + ["sequence_id", "offset"] and pack(clash).count() == len(rows)
    assert pack(pieces(empty, *tokenizer())).collect() == []


def test_first_fit_equals_the_plain_loop():
    r = random.Random(2)
    for n in (1, 2, 3, 50, 400):
        lengths = np.array(sorted((r.randint(1, 100) for _ in range(n)), reverse=True))
        free, want = [], []
        for x in lengths.tolist():
            k = next((k for k, f in enumerate(free) if f >= x), len(free))
            if k == len(free):
                free.append(100)
            want.append((k, 100 - free[k]))
            free[k] -= x
        assert list(zip(*map(list, first_fit_decreasing(lengths, 100)))) == want
