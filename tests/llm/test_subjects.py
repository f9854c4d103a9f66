from folium.llm.subjects import Scorer, clean_labels, mine_rules, sentences, subject_areas

D = "doc_id long, text string, subject string, share double"
L = "label_id long, doc_id long, subject string, annotator string"
U = "subject string, description string"


def test_sentences():
    assert sentences("C. Reed came. “Who?” he said.\r\nA line\n\n--\n") == ["C. Reed came.", "“Who?”", "he said.", "A line"]
    assert sentences(None) == [] and sentences("  ") == []


def test_evidence():
    rules = [(("court",), "law", 0.5, 40), (("court",), "sport", 0.5, 40), (("judge",), "law", 0.94, 30), (("ball",), "sport", 0.9, 30)]
    s = Scorer(["law", "sport", *map(str, range(8))], rules)
    s.least[:] = 0.5
    got = s.shares(["The judge spoke. The court rose. Rain fell. Wind came.", "The ball flew. The court rose.", None, ""])
    assert got[0].tolist()[:2] == [0.5, 0.0] and got[1].tolist()[:2] == [0.0, 1.0] and not got[2:].any()
    pair = Scorer(["law", "sport"], [(("court",), "law", 0.6, 40), (("court", "tennis"), "sport", 0.9, 20)])
    e, doc, size = pair.evidence(["The tennis court. A court."])
    assert e.argmax(axis=1).tolist() == [1, 0] and doc.tolist() == [0, 0] and size.tolist() == [2]


def test_pairs_that_gain_are_mined(spark):
    sense = {"law": ("judge", "court"), "sport": ("tennis", "court"), "music": ("organ", "choir")}
    docs = [(i, ". ".join(f"The {a} met the {b}" for _ in range(3)), "x", 0.0) for i in range(90) for a, b in [sense[("law", "sport", "music")[i % 3]]]]
    labels = [(i, i, ("law", "sport", "music")[i % 3], None) for i in range(90)]
    u = spark.createDataFrame([(s, None) for s in sense], U)
    names, rules, held = mine_rules(spark.createDataFrame(docs, D), spark.createDataFrame(labels, L), u)
    got = {(b, s) for b, s, _, _ in rules}
    assert names == ["law", "music", "sport"] and {(("judge",), "law"), (("court",), "law"), (("court",), "sport")} <= got
    assert held and not any(len(b) > 1 for b, _ in got)  # judge and tennis decide alone


def test_many_subjects(spark):
    subjects = [f"area {i:03d}" for i in range(300)]
    word = lambda i: "w" + "".join(chr(97 + int(c)) for c in f"{i:03d}")
    docs = [(i, f"The {word(i % 300)} came. A {word(i % 300)} left. So the {word(i % 300)} stayed.", "x", 0.0) for i in range(1500)]
    labels = [(i, i, subjects[i % 300], None) for i in range(1200)]
    u = spark.createDataFrame([(s, None) for s in subjects], U)
    got = {(r.doc_id, r.subject) for r in subject_areas(spark.createDataFrame(docs, D), spark.createDataFrame(labels, L), u).collect()}
    assert got == {(i, subjects[i % 300]) for i in range(1500)}


def test_labels(spark):
    u = spark.createDataFrame([("law", "x"), ("cooking", "y")], U)
    rows = [(1, 1, " Law", "a"), (2, 2, "cookingg", None), (3, 3, None, "a"), (4, 4, "zzzzzz", "a"), (5, None, "law", "a"), (6, 1, "LAW", "b")]
    assert {tuple(r) for r in clean_labels(spark.createDataFrame(rows, L), u).collect()} == {(1, "law"), (2, "cooking")}


def test_areas(spark):
    words = {"law": ["judge", "verdict", "statute", "plaintiff"], "cooking": ["oven", "flour", "butter", "recipe"]}
    docs, labels = [], []
    for i in range(60):
        s = "law" if i % 2 else "cooking"
        w = words[s]
        docs.append((i, f"The {w[i % 4]} was near the {w[(i + 1) % 4]}. Another {w[(i + 2) % 4]} came to the town. Rain fell on the old road.", "x", 0.0))
        if i < 40:
            labels.append((i, i, s, None))
    docs += [(100, None, "x", 0.0), (101, "   ", "x", 0.0), (102, "Rain fell on the old road.", "x", 0.0), (103, "The judge came. The oven was hot.", "x", 0.0)]
    u = spark.createDataFrame([("law", "Texts about judge"), ("cooking", "Texts about oven"), (None, None)], U)
    got = {}
    for r in subject_areas(spark.createDataFrame(docs, D), spark.createDataFrame(labels, L), u).collect():
        got.setdefault(r.doc_id, set()).add(r.subject)
    assert all(got[i] == {"law" if i % 2 else "cooking"} for i in range(60)) and got[103] == {"law", "cooking"} and not got.keys() & {100, 101, 102}


def test_empty(spark):
    u = spark.createDataFrame([("law", "Texts about judge")], U)
    assert subject_areas(spark.createDataFrame([], D), spark.createDataFrame([], L), u).collect() == []
