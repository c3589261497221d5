import re

from surgewatch.llm.decontaminate import contaminated, remove_contaminated
from surgewatch.llm.queries import op6_decontamination

ITEM = "Anna bought 12 kg of apples and 30 kg of pears, and then Anna sold 5 kg of apples to the market in Berlin."


def windows(text):
    ws = [re.sub(r"[.,;:!?\"'()\[\]{}]", "", w) for w in re.findall(r"[^\x20\x09-\x0D]+", text.lower())]
    return [tuple(ws[i:i + 5]) for i in range(len(ws) - 4)]


def test_whole_table(spark, load):
    """Literal windows (no slots) are a lower bound; what both leave out lies far below the threshold."""
    sf = "sf0.01"
    items = {i: set(windows(t)) for i, t in load("benchmark", sf, "item_id, text")}
    want, far = set(), set()
    for d, t in load("documents", sf, "doc_id, text"):
        own = set(windows(t))
        for i, ws in items.items():
            share = len(ws & own) / len(ws)
            (want if share >= 0.8 else far).add((d, i)) if share >= 0.8 or share < 0.5 else None
    got = {(x.doc_id, x.item_id): x for x in op6_decontamination(spark, f"/root/testdata/{sf}").collect()}
    assert want and set(got) >= want and not set(got) & far
    assert all(x.similarity >= 0.8 and x.n_found <= x.n_windows and not x.reparameterised for x in got.values())


def test_reparameterised(spark):
    texts = [
        (1, "Well then. " + ITEM + " The end."),
        (2, "x y z. " + ITEM.replace("Anna", "Peter").replace("12", "7").replace("30", "41").replace("Berlin", "Paris")),
        (3, ITEM.replace("Anna bought", "Peter bought").replace("12", "7").replace("apples", "melons").replace("market", "shop")),
        (4, ITEM.lower().replace("apples", "plums").replace("pears", "nuts").replace("sold", "ate")),
        (5, None), (6, "short"), (7, "12 kg of apples and 30 kg of")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    items = spark.createDataFrame([(9, ITEM), (8, None), (7, "too short"), (None, None)], "item_id long, text string")
    got = {x.doc_id: x for x in contaminated(docs, items).collect()}
    assert set(got) == {1, 2} and not got[1].reparameterised and got[2].reparameterised
    assert sorted(x.doc_id for x in remove_contaminated(docs, items).collect()) == [3, 4, 5, 6, 7]


def test_other_forms_of_an_item(spark):
    """Inside a sentence the first word looks like a name; lower or upper case hides all names."""
    short = "Which river flows past Berlin"  # two or one windows: none may be lost
    items = spark.createDataFrame([(9, ITEM), (8, short), (7, "What is 12 plus 30 over 7?")], "item_id long, text string")
    texts = [(1, "he asked: " + short), (2, short.lower() + " then"), (3, short.upper()), (4, "so " + ITEM.lower()),
             (5, ITEM.upper()), (6, "Quiz: What is 13 plus 31 over 9?"), (7, "Which river flows, past noon"),
             (8, "Some River Flows Past Berlin"), (9, "Well, Anna bought nothing of apples and pears in Berlin.")]
    got = {(x.doc_id, x.item_id): x.reparameterised for x in contaminated(
        spark.createDataFrame(texts, "doc_id long, text string"), items).collect()}
    assert got == {(1, 8): False, (2, 8): False, (3, 8): False, (4, 9): False, (5, 9): False, (6, 7): True}


def test_slots_must_agree(spark):
    text = "the train from Berlin to Paris takes 5 hours and the train from Paris to Berlin takes 6 hours today"
    odd = "the train from Rome to Oslo takes 5 hours and the train from Kiev to Lima takes 6 hours today"
    same = text.replace("Berlin", "Rome").replace("Paris", "Oslo")
    items = spark.createDataFrame([(1, text)], "item_id long, text string")
    got = contaminated(spark.createDataFrame([(1, odd), (2, same)], "doc_id long, text string"), items).collect()
    assert [x.doc_id for x in got] == [2]


def test_copies_are_judged_alone(spark):
    """Several copies of an item with other slot words in one document, also with words put in or left out."""
    short, table = "What is 12 plus 30 over 7?", "1 2 3 4 5 6 7 8 9"
    v1, v2 = short.replace("12", "25").replace("30", "14").replace("7", "3"), short.replace("12", "8").replace("30", "9").replace("7", "6")
    long1 = ITEM.replace("Anna", "Peter").replace("12", "7").replace("30", "41").replace("Berlin", "Paris")
    long2 = ITEM.replace("Anna", "Zoe").replace("12", "99").replace("30", "98").replace("kg of apples to", "kg of apples there to")
    texts = [(1, f"{short} {v1}"), (2, f"{v1} {short}"), (3, f"{v1} {v2}"), (4, f"{v1} and then {v2} or {v1.replace('25', '26')}"),
             (5, "11 12 13 14 15 16 17 18 19 so 21 22 23 24 25 26 27 28 29"), (6, f"{long1} {ITEM}"),
             (7, f"{long2} {long1.replace('Peter', 'Ann')}"), (8, "What is 12 plus 30. What is 8 plus 9.")]
    items = spark.createDataFrame([(7, short), (8, table), (9, ITEM)], "item_id long, text string")
    got = {(x.doc_id, x.item_id): (x.n_found == x.n_windows, x.reparameterised) for x in contaminated(
        spark.createDataFrame(texts, "doc_id long, text string"), items).collect()}
    assert got == {(1, 7): (True, False), (2, 7): (True, False), (3, 7): (True, True), (4, 7): (True, True),
                   (6, 9): (True, False), (7, 9): (False, True)}  # 5: a list of numbers isn't another one


def test_short_items(spark):
    """Of fewer than five words: one window of their own length."""
    items = spark.createDataFrame([(1, "Paris is the capital"), (2, "What is 12 plus"), (3, "Berlin"), (4, " "), (5, "")],
                                  "item_id long, text string")
    texts = [(1, "we know that Paris is the capital of it"), (2, "Paris is a capital"), (3, "paris is the capital"),
             (4, "so: What is 31 plus nothing"), (5, "from Berlin to Rome"), (6, "from Bonn to Rome"), (7, "Paris")]
    got = {(x.doc_id, x.item_id): (x.n_windows, x.reparameterised) for x in contaminated(
        spark.createDataFrame(texts, "doc_id long, text string"), items).collect()}
    assert {k: v for k, v in got.items() if k != (2, 1)} == {
        (1, 1): (1, False), (3, 1): (1, False), (4, 2): (1, True), (5, 3): (1, False)} and (2, 1) not in got


def test_numbers_alone_are_no_template(spark):
    """Documents of numbers hold no other lists of numbers, at a cost that grows with them; exact lists are found."""
    import random
    r = random.Random(3)
    number = lambda n: " ".join(str(r.randrange(10 ** 6)) for _ in range(n))
    lists = [number(30) for _ in range(20)]
    texts = [(1, number(1000)), (2, number(8000)), (3, number(200) + " " + lists[7] + " " + number(200)), (4, "Total: " + lists[3])]
    got = contaminated(spark.createDataFrame(texts, "doc_id long, text string"),
                       spark.createDataFrame(list(enumerate(lists)), "item_id long, text string")).collect()
    assert sorted((x.doc_id, x.item_id, x.n_found, x.reparameterised) for x in got) == [(3, 7, 26, False), (4, 3, 26, False)]


def test_recall_of_planted_variants(spark, load):
    """Items with other numbers and names inside documents of four languages."""
    import random
    r, hosts = random.Random(5), {}
    for lang, text in load("documents", "sf0.01", "lang, text"):
        if lang and 50 < len((text or "").split()) < 400:
            hosts.setdefault(lang, []).append(text.split())
    shapes = ["{A} bought {a} kg of apples and {b} kg of pears, and then {A} sold {c} kg of apples to the market in {B}.",
              "Ein Zug fährt von {A} nach {B} in {a} Stunden, ein anderer braucht {b} Stunden; wie weit ist es bei {c} km pro Stunde?",
              "Un train part de {A} vers {B} avec {a} voyageurs et en laisse {b} en route, puis {c} montent encore.",
              "Un tren sale de {A} hacia {B} con {a} viajeros y deja {b} en camino, luego suben {c} personas."]
    names = ["Anna", "Peter", "Berlin", "Paris", "Rosa", "Madrid", "Lyon", "Emil"]

    def fill(shape):
        a, b = r.sample(names, 2)
        x, y, z = r.sample(range(2, 900), 3)
        return shape.format(A=a, B=b, a=x, b=y, c=z)
    items = [(i, fill(s)) for i, s in enumerate(shapes * 3)]
    assert len(hosts) == 4
    docs, planted = [], set()
    for own in hosts.values():
        for host in own[:15]:
            i = r.randrange(len(items))
            at = r.randrange(len(host))
            planted.add((len(docs), i))
            docs.append((len(docs), " ".join([*host[:at], fill(shapes[i % 4]), *host[at:]])))
    got = {(x.doc_id, x.item_id) for x in contaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                                                       spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert len(planted & got) >= 0.9 * len(planted)
    clean = spark.createDataFrame([(i, " ".join(h)) for own in hosts.values() for i, h in enumerate(own[:30])], "doc_id long, text string")
    assert contaminated(clean, spark.createDataFrame(items, "item_id long, text string")).collect() == []


def test_words_put_into_copies(spark):
    """Two copies of one item, each with three words put in: 20 % of the windows, so neither lies on one offset."""
    item = "Anna has 3 cats and Berta has 5 dogs while Carla has 9 birds in one big old house near Berlin on the north side of town"
    a = item.replace("Anna", "Mia").replace("3", "4").replace("Carla", "Eva").replace("one big", "one and the same big")
    b = item.replace("Anna", "Lea").replace("3", "8").replace("Carla", "Zoe").replace("one big", "one or maybe more big")
    docs = spark.createDataFrame([(1, f"so {a} and {b}"), (2, f"so {a}"), (3, f"so {b}")], "doc_id long, text string")
    items = spark.createDataFrame([(9, item)], "item_id long, text string")
    assert sorted((x.doc_id, x.n_found, x.reparameterised) for x in contaminated(docs, items).collect()) == [
        (1, 19, True), (2, 19, True), (3, 19, True)]


def test_odd_rows(spark, odd, empty):
    items = spark.createDataFrame([(1, " ".join(f"shared{i}" for i in range(5, 40)), "x")], "item_id long, text string, h string")
    got = sorted(str(x.doc_id) for x in contaminated(odd, items).collect())
    assert got == ["5", "6", "None"]
    left = remove_contaminated(odd, items)
    assert left.columns == odd.columns and left.count() == odd.count() - 4
    assert contaminated(empty, items).collect() == [] and contaminated(odd, items.limit(0)).collect() == []
    assert remove_contaminated(odd, items.limit(0)).count() == odd.count()


def test_no_python(spark, odd):
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    plan = remove_contaminated(odd, items)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
