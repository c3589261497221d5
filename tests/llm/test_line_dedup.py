import random
from collections import defaultdict

import pytest
import regex

from surgewatch.llm.line_dedup import dedup_lines
from surgewatch.llm.queries import op1_line_dedup


def n_words(line):
    """Letters of unspaced scripts one by one, other words by white space."""
    return len(regex.findall(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]|"
                             r"[^\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}\x20\x09-\x0D]+", line))


def brute(docs, min_words):
    """Texts after dedup: runs on the diagonals of equal lines; docs are (id, text), ordered."""
    ls = [t.split("\n") for _, t in docs]
    places, gone = defaultdict(list), [set() for _ in docs]
    for d, own in enumerate(ls):
        for p, x in enumerate(own):
            places[x].append((d, p))
    for own in places.values():
        for k, (d2, p2) in enumerate(own):
            for d1, p1 in own[:k]:
                if p1 and p2 and ls[d1][p1 - 1] == ls[d2][p2 - 1]:
                    continue  # not the start of the run
                n, words = 0, 0
                while p1 + n < len(ls[d1]) and p2 + n < len(ls[d2]) and ls[d1][p1 + n] == ls[d2][p2 + n]:
                    words += n_words(ls[d2][p2 + n])
                    n += 1
                if words >= min_words:
                    gone[d2] |= set(range(p2, p2 + n))
    return ["\n".join(x for p, x in enumerate(own) if p not in gone[d]) for d, own in enumerate(ls)]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    r = random.Random(seed)
    alphabet = ["a", "b b", "", "c c c", "d d d d d", " ", "漢字 and か", "ไทย", "é ô"]
    docs = [(i, "\n".join(r.choice(alphabet) for _ in range(r.randint(1, 25)))) for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    for min_words in (4, 9):
        got = {x.doc_id: x for x in dedup_lines(df, min_words).collect()}
        want = brute(docs, min_words)
        assert [got[i].text for i, _ in docs] == want
        assert all(got[i].n_lines == t.count("\n") + 1 for i, t in docs)


def test_whole_table(spark, load):
    import hashlib
    docs = sorted(load("documents", cols="doc_id, text"))
    got = {x.doc_id: x for x in op1_line_dedup(spark, "/root/testdata/sf0.001").collect()}
    for (i, t), want in zip(docs, brute(docs, 50)):
        assert got[i].text_md5 == hashlib.md5(want.encode()).hexdigest() and got[i].n_chars == len(want)


def test_scripts_without_spaces(spark):
    """A passage of 200 letters in two documents goes from the second; 40 letters are too few."""
    r = random.Random(3)
    han = lambda n: "".join(chr(r.randrange(0x4E00, 0x9FFF)) for _ in range(n))
    passage, short = han(200), han(40)
    docs = [(1, f"{han(30)}\n{passage}\n{short}x\n{han(9)}"), (2, f"{han(20)}\n{passage}\n{han(8)}"), (3, f"{short}\n{han(5)}"), (4, f"{short}\nend")]
    got = {x.doc_id: x for x in dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert [got[i].n_removed for i in (1, 2, 3, 4)] == [0, 1, 0, 0] and passage not in got[2].text


def test_odd_rows(spark, odd, empty):
    got = dedup_lines(odd)
    assert got.columns == odd.columns + ["n_lines", "n_removed"]
    rows = got.collect()
    assert len(rows) == odd.count()
    by = defaultdict(list)
    for x in rows:
        by[x.doc_id].append(x)
    assert by[1][0].text is None and by[1][0].n_lines == 0
    assert by[2][0].text == "" and by[2][0].n_lines == 1
    assert by[5][0].n_removed == 0
    assert sorted(x.text for x in by[6]) == ["another text of the same id", "other\nend of six", "other\nend of six"]
    assert sorted(x.text or "" for x in by[None]) == ["", "null id"]  # the first copy is that of the smallest id
    assert by[8][0].text == "x\n" and by[8][0].n_removed == 299
    assert dedup_lines(empty).collect() == []


def test_no_python(spark, odd):
    plan = dedup_lines(odd)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
