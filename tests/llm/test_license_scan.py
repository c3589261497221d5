import re

from surgewatch.llm.license_scan import NOTICES, PHRASES, scan_licenses
from surgewatch.llm.queries import op5_license_scan


def brute(text):
    ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    at = [(i, label) for phrase, label in PHRASES.items() for p in [phrase.split()]
          for i in range(len(ws) - len(p) + 1) if ws[i:i + len(p)] == p]
    return (len(ws), len(at), min(at)[0] if at else None, max(at)[0] if at else None,
            ",".join(sorted({label for _, label in at})))


def check(rows, texts):
    assert len(rows) == len(texts)
    got = sorted((x.doc_id is None, x.doc_id or 0, x.n_words, x.n_base, x.first_word or -1, x.last_word or -1, x.base_labels) for x in rows)
    want = []
    for d, t in texts:
        n, k, a, b, labels = brute(t)
        want.append((d is None, d or 0, n, k, a or -1, b or -1, labels))
    assert got == sorted(want)
    for x in rows:
        assert set(x.base_labels.split(",")) - {""} <= set(x.labels.split(",")) and 0 <= x.score <= 1
        assert (x.score == 1 or x.n_base == 0) and (x.score > 0) == (x.labels != "")


def test_whole_table(spark, load):
    docs = load("documents", "sf0.01", "doc_id, text")
    rows = op5_license_scan(spark, "/root/testdata/sf0.01").collect()
    check(rows, docs)
    assert sum(x.n_base > 0 for x in rows) > 10


def test_planted(spark):
    mit = next(t for t, label in NOTICES.items() if label == "mit-text").split()
    texts = [(1, "CC-BY cc by CC,BY; The MIT License: mit license"), (2, "apache\n\nlicense 한글 gnu general public license"),
             (3, "so " + " ".join(mit).title() + " end"), (4, " ".join(mit[:8] + ["extra", "words"] + mit[8:])),
             (5, " ".join(mit[:9])), (6, "Licensed under the GNU General Public License, version 3."), (7, "cc cc by by"),
             (8, "x " * 400 + " ".join(mit) + " y " * 50 + "Apache License"), (9, "mit" + "é" + "license mit-license")]
    rows = scan_licenses(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    check(rows, texts)
    got = {x.doc_id: x for x in rows}
    assert got[3].labels == got[4].labels == "mit-text" and got[3].score == 1 and 0.8 <= got[4].score < 1
    assert got[5].labels == "" and got[5].score == 0
    assert got[6].labels == "gpl,gpl-3.0" and got[6].base_labels == "gpl"
    assert got[8].labels == "apache,mit-text"
    assert (got[1].n_base, got[1].first_word, got[1].last_word) == (5, 0, 9)


def spoiled(words, *cuts, by=("one", "two", "three")):
    """``words`` with ``by`` put in before each of the places ``cuts``."""
    out = []
    for i, w in enumerate(words):
        out += [*(by if i in cuts else ()), w]
    return " ".join(out)


def test_words_put_in_up_to_what_verification_allows(spark):
    """A stretch may be half longer than the template, however the words put in are spread."""
    mit = next(t for t, label in NOTICES.items() if label == "mit-text").split()
    n = len(mit) - 1
    lost = " ".join(mit[:6] + mit[8:])
    texts = [(1, spoiled(mit, 8)), (2, spoiled(mit, 4, 11, by=("one", "two"))), (3, spoiled(mit, 8, by=["x"] * (n // 2))),
             (4, spoiled(mit, 8, by=["x"] * (n // 2 + 1))), (5, lost), (6, " ".join(["free of charge"] * 5 + mit + ["documentation files"] * 5)),
             (7, spoiled(mit, 3, 7, 11, 15, by=["x"])), (8, " ".join(mit[::-1])), (9, f"{spoiled(mit, 8)} and {' '.join(mit)}")]
    got = {x.doc_id: x for x in scan_licenses(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert [got[k].labels for k in range(1, 10)] == ["mit-text"] * 3 + [""] + ["mit-text"] * 2 + [""] * 2 + ["mit-text"]
    assert got[1].score == (n - 1) / n and got[2].score == (n - 2) / n and got[5].score == (n - 3) / n
    assert got[6].score == got[9].score == 1


def test_best_of_overlapping_notices(spark):
    """Of three in a row, the last stays though it overlaps the second, which the first beats."""
    notices = {"a b c d e f g h i j": "first", "h i j k l m n o p q": "second", "o p q r s t u v w x": "third"}
    texts = [(1, "a b c d e f g h i j k l m n o p q r s t u v w x"),
             (2, "a b c d e f g h i j k l x m n o p q r s t u v y w x"), (3, "z h i j k l m n o p q z"),
             (4, "a b c d e f g h i j k l x m n o p q z z z")]
    got = {x.doc_id: x.labels for x in scan_licenses(spark.createDataFrame(texts, "doc_id long, text string"), {"zz zz": "none"}, notices).collect()}
    assert got == {1: "first,second,third", 2: "first,third", 3: "second", 4: "first"}


def test_odd_rows(spark, odd, empty):
    check(scan_licenses(odd).collect(), [(x.doc_id, x.text) for x in odd.collect()])
    assert scan_licenses(empty).collect() == []
