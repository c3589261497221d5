import zlib

import numpy as np

from surgewatch.llm import langid
from surgewatch.llm.langid import fit, predict, presence
from surgewatch.llm.queries import op8_language_id


def test_held_out_accuracy(spark, load):
    truth = {d: (t, lang) for d, t, lang in load("documents", "sf0.01", "doc_id, text, lang")}
    rows = op8_language_id(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(truth)
    held = [x for x in rows if x.held_out]
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 4 == 2) for x in rows)
    assert np.mean([x.lang_pred == truth[x.doc_id][1] for x in held]) > 0.97
    assert all(0 <= x.score <= 1 for x in rows)


def test_presence_in_spans(monkeypatch):
    text = "Das ist ein Satz mit Wörtern. " * 40
    want = presence(text)
    monkeypatch.setattr(langid, "SPAN", 37)
    assert (presence(text) == want).all() and (presence(text.upper()) == want).all()


def plain_scores(train, texts, ridge=1e-3, landmarks=40):
    """Scores by sets of n-grams and one dense solution: no hashing, no parts."""
    grams = lambda t: {t.lower()[i:i + n] for n in (1, 2, 3) for i in range(len(t.lower()) - n + 1)}
    kernel = lambda a, b: np.array([[len(x & y) / (max(len(x), 1) * max(len(y), 1)) ** 0.5 for y in b] for x in a])
    langs = sorted({lang for lang, _ in train})
    rows, marks = [grams(t) for _, t in train], []
    for lang in langs:
        marks += [g for g, (x, _) in zip(rows, train) if x == lang][:landmarks]
    y = np.array([[1.0 if x == lang else -1.0 for lang in langs] for x, _ in train])
    knm, kmm = kernel(rows, marks), kernel(marks, marks)
    alpha = np.linalg.solve(knm.T @ knm + ridge * len(rows) * kmm + 1e-9 * np.eye(len(marks)), knm.T @ y)
    f = kernel([grams(t) for t in texts], marks) @ alpha
    return [langs[b] for b in f.argmax(axis=1)], np.clip((f.max(axis=1) + 1) / 2, 0, 1)


def test_against_the_exact_kernel(spark, monkeypatch):
    """Labels and scores equal those of the unhashed kernel and one dense solution, also in several parts."""
    from pyspark.sql import functions as F
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("length(text) < 1500")
    train = docs.filter(~langid.held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    train = [(r.lang, r.text) for r in train.orderBy("lang", F.xxhash64("doc_id"), "text").collect()]
    texts = [r.text for r in docs.filter(F.col("text").rlike(r"\p{L}")).orderBy("doc_id").limit(80).collect()]
    want, scores = plain_scores(train, texts)
    whole = fit(docs)
    monkeypatch.setattr(langid, "PART", 20)
    for model in (whole, fit(docs)):
        got, own = model.score(texts)
        assert np.mean([a == b for a, b in zip(got, want)]) > 0.97 and np.abs(own - scores).mean() < 0.02
    assert np.abs(whole.weights - model.weights).max() < 1e-3


def test_landmarks_are_shared_by_languages(spark, monkeypatch):
    rows = [(k, f"text {k} of language {'abcdefgh'[k % 8]}", f"l{k % 8}") for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    held = []
    sums = langid.normal_equations
    monkeypatch.setattr(langid, "normal_equations", lambda rows, marks, *more: held.append(len(marks)) or sums(rows, marks, *more))
    monkeypatch.setattr(langid, "ALL_LANDMARKS", 24)
    assert len(fit(docs).langs) == 8 and held == [24]


def test_odd_rows(spark, odd, empty):
    model = fit(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    got = predict(odd, model)
    assert got.columns == odd.columns + ["lang_pred", "score"]
    rows = got.collect()
    assert all((x.lang_pred == "und") == (not any(c.isalpha() for c in x.text or "")) for x in rows)
    assert all(x.score == 0 for x in rows if x.lang_pred == "und")
    signs = odd.sparkSession.createDataFrame([("² ½ Ⅳ ① 7",), ("²a",)], "text string")  # numerals are no letters
    assert [x.lang_pred == "und" for x in predict(signs, model).collect()] == [True, False]
    nothing = fit(empty)
    assert {x.lang_pred for x in predict(odd, nothing).collect()} == {"und"}
    assert predict(empty, model).collect() == []
    one = fit(odd.filter("lang = 'en'"))
    assert one.langs == ("en",)


def test_only_the_text_counts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = fit(docs)
    a = {x.doc_id: (x.lang_pred, x.score) for x in predict(docs.select("doc_id", "text"), model).collect()}
    b = predict(docs.selectExpr("doc_id", "text", "'xx' as lang", "'src' as source"), model).collect()
    assert all(a[x.doc_id] == (x.lang_pred, x.score) for x in b)


def test_certified_counts():
    """Against the binomial tail summed directly."""
    from math import comb
    for n, lose, risk in ((0, 0.01, 0.05), (100, 0.01, 0.05), (299, 0.01, 0.05), (1000, 0.01, 0.05), (3000, 0.002, 0.02)):
        tails = np.cumsum([comb(n, i) * lose ** i * (1 - lose) ** (n - i) for i in range(min(n, 60) + 1)])
        assert langid.certified(n, lose, risk) == int((tails <= risk).sum()) - 1


def test_calibrated_rejection(spark):
    """Texts of a script that no learned language uses go; of right rows no more than certified."""
    import random

    from pyspark.sql import functions as F
    rnd, rows = random.Random(5), []
    for k in range(12_000):
        lang = "ab"[k % 2]
        letters = ("aeioubcdfg" if lang == "a" else "hjklmnpqrst")
        rows.append((k, " ".join("".join(rnd.choices(letters, k=rnd.randint(2, 7))) for _ in range(rnd.randint(30, 60))), lang))
    strange = [(20_000 + k, "".join(rnd.choices("абвгдежзик лмнопрст", k=300)), None) for k in range(50)]
    docs = spark.createDataFrame(rows + strange, "doc_id long, text string, lang string")
    model = fit(docs)
    cutoffs = langid.calibrate(docs, model)
    assert cutoffs[0] == cutoffs[2] == 0 < cutoffs[1]  # the other length classes have no rows
    kept = {r.doc_id for r in predict(docs, model).filter(
        langid.accepted(cutoffs, F.col("text"), F.col("lang_pred"), F.col("score"))).select("doc_id").collect()}
    assert not kept & {d for d, *_ in strange} and len(kept) >= 0.998 * len(rows)
    few = docs.limit(400)
    assert langid.calibrate(few, model) == (0, 0, 0)
    # copies of one text are one row: they can't certify anything
    copies = docs.limit(1).drop("doc_id").crossJoin(spark.range(8000).withColumnRenamed("id", "doc_id"))
    assert langid.calibrate(copies, model) == (0, 0, 0)


def test_calibrate_on_odd_rows(spark, odd, empty):
    model = fit(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    assert langid.calibrate(odd, model) == langid.calibrate(empty, model) == langid.calibrate(odd, fit(empty)) == (0, 0, 0)
