import random

import numpy as np
from pyspark.sql import functions as F

from folium.llm import fitting, gbt
from folium.llm.holdout import CALIBRATE, JUDGE
from folium.llm.quality import STATS, fit_classifier, page_statistics, scoped_pages, statistics
from folium.llm.scans import breaks, difference, fold, number_values, open_end, page_noise, read_number, repair_text, repaired_pages, tokens
from tests.oracle import DATA

PAGES = "row_id long, run_id string, source array<string>, page long, blocks array<struct<block_type string, text string, block_order long, attrs map<string,string>>>, coll string, key string"
PREVIEWS = "row_id long, run_id string, entry_id string, kind string, text string"
CASES = "coll long, block long"


def test_boosting():
    rng = np.random.default_rng(1)
    x = rng.random((600, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(int)
    m = gbt.fit(x[:400], y[:400])
    assert ((m.probability(x[400:]) > 0.5) == y[400:]).mean() > 0.95
    assert len(gbt.fit(x, np.ones(600)).trees) == 0
    assert len(gbt.fit(np.zeros((0, 3)), np.zeros(0)).trees) == 0


def test_statistics():
    v = dict(zip(STATS, statistics(["The cat sat on the mat.", "A | b | c", "• item one", "Zoë 12"])))
    assert v["n_lines"] == 4 and v["separator_share"] == 0.25 and v["bullet_share"] == 0.25 and v["end_punctuation_share"] == 0.25 and v["accent_ratio"] > 0
    assert statistics([]) == [0.0] * len(STATS) == statistics([" ", ""])


def test_hand_checked_pages(spark):
    """Fitted on weakly labelled pages of one set of tables, calibrated on one half of hand-checked pages of another, judged on the other half."""
    df = spark.read.parquet(f"{DATA}/sf0.01/page_blocks.parquet")
    scoped, keys = scoped_pages(df, spark.createDataFrame([], CASES))
    model = fit_classifier(scoped, keys, 2000)
    got = model.reliability(JUDGE)
    print(got)
    assert not set(CALIBRATE) & set(JUDGE)
    assert got["accuracy"] >= 0.9 and got["brier"] <= 0.1
    assert all(abs(mean - share) <= 0.3 for mean, share, n in got["bins"].values() if n >= 5)


def test_page_classes_by_join(spark, monkeypatch):
    """Repeated lines taken out by a join give the same statistics as by an array."""
    from folium.llm import quality
    from folium.llm.lines import Repeats

    df = spark.read.parquet(f"{DATA}/sf0.01/page_blocks.parquet")
    cases = Repeats(df).cases.select("coll", "block")
    by_array = {r.row_id: tuple(r) for r in page_statistics(df, cases).collect()}
    monkeypatch.setattr(quality, "KEYS", 0)
    by_join = {r.row_id: tuple(r) for r in page_statistics(df, cases).collect()}
    assert cases.count() > 0 and by_array.keys() == by_join.keys()
    differ = [k for k in by_array if by_array[k][1:20] != by_join[k][1:20]]
    assert not differ, differ[:5]


def test_page_numbers():
    assert read_number("— 12 — The Old Mill")[:2] == (["a12"], "The Old Mill")
    assert read_number("THE OLD MILL [7]")[:2] == (["a7"], "THE OLD MILL")
    assert read_number("xxiv") == (["r24"], "", True) and read_number("Page 8")[0] == ["a8"] and read_number("p. 26")[2] and read_number("21/59")[0] == ["a21"]
    assert read_number("S3 THE OLD MILL")[0] == ["a53"] and read_number("The mill was old.")[0] == []
    assert number_values("l") == ["r50"] and number_values("mild") == []
    assert fold("N0TE5 0N THE 5MALL MILL, 1935") == fold("Notes on the small mill, 1935")


def test_words():
    assert breaks("a vill- age, one- and two; dra\xad wing") == [("vill", "age"), ("one", "and"), ("dra", "wing")]
    assert open_end("cleared of the comp-") == "comp" and open_end("done.") is None
    assert difference("tlie", "the") == ("li", "h") and difference("hacl", "had") == ("cl", "d") and difference("infecti0n", "infection") == ("0", "o") and difference("a", "abc") is None and difference("be", "bee") is None
    assert tokens("“The half-finished (mill), he said…") == ["the", "half-finished", "mill", "he", "said"]


def test_repair():
    out = repair_text([(1, "THE MILL 7"), (2, "The bro-\nken wheel of the tlie comp-"), (3, "any stood."), (4, "")], {1}, {2: {"tlie": "the"}}, {2: {"bro": "ken", "comp": "any"}})
    assert out == ["The broken wheel of the the company stood."]


def corpus(spark):
    rng = random.Random(9)
    nouns = "wheel garden river letter window harbour market chapel winter meadow lantern bridge".split()
    verbs = "crossed painted followed remembered counted opened gathered measured".split()
    adjectives = "narrow quiet broken painted early distant heavy modest".split()

    def sentence():
        return f"The {rng.choice(adjectives)} {rng.choice(nouns)} {rng.choice(verbs)} the {rng.choice(nouns)} of the {rng.choice(nouns)} before another {rng.choice(nouns)} was {rng.choice(verbs)} in the {rng.choice(adjectives)} {rng.choice(nouns)}."

    rows, truth = [], {"header": set(), "pageno": set(), "hyphen": set(), "misread": set()}
    n = 0
    for run in range(12):
        for page in range(1, 21):
            n += 1
            body = [" ".join(sentence() for _ in range(4)) for _ in range(2)]
            blocks = []
            if page > 1:
                blocks.append(("header" if run % 2 else "p", f"THE OLD {nouns[run].upper()} OF WESTBY", {"class": "running-head"} if run % 3 == 0 else None))
                truth["header"].add((n, 1))
            if page % 5 == 0:
                body[0] = body[0].replace("before", "befo- re", 1)
                truth["hyphen"].add((n, len(blocks) + 1))
            if page % 2 == 0:
                a, b = rng.choice([("e", "c"), ("h", "b"), ("o", "0"), ("d", "cl")])
                at = [i for i, w in enumerate(body[1].split()) if a in w[1:] and len(w) > 4 and w.isalpha()]
                words = body[1].split()
                if not at:
                    continue
                i = rng.choice(at)
                words[i] = words[i][0] + words[i][1:].replace(a, b, 1)
                body[1] = " ".join(words)
                truth["misread"].add((n, len(blocks) + 2))
            blocks += [("p", b, None) for b in body]
            blocks.append(("p", f"— {page + 4} —", {"class": "page-number"} if run % 4 == 0 else None))
            truth["pageno"].add((n, len(blocks)))
            rows.append((n, f"r{run}", ["site"], page, [(t, x, i, a) for i, (t, x, a) in enumerate(blocks, 1)], "c", "k"))
    return rows, truth


def test_noise(spark):
    rows, truth = corpus(spark)
    rows += [(900, None, None, None, None, None, None), (901, "r1", [], 3, [], None, None), (902, "r1", ["site"], 4, [("p", None, None, None), (None, "", 2, None)], None, None)]
    pages = spark.createDataFrame(rows, PAGES)
    previews = spark.createDataFrame([(1, "r1", "e", "paragraph", "THE OLD GARDEN OF WESTBY"), (2, "r1", "e", "paragraph", "[5]"), (3, "r1", "e", "paragraph", "The quiet gar-\nden was narrow."), (4, None, None, None, None), (5, "r1", "e", "heading", "THE OLD GARDEN")], PREVIEWS)
    found = page_noise(pages, previews, None, spark.createDataFrame([], CASES))
    got = {}
    for r in found["noise"].collect():
        got.setdefault((r.table_name, r.noise_kind), set()).add((r.row_id, r.block_order))
    for kind, want in truth.items():
        have = got["page_blocks", kind]
        assert len(have & want) >= 0.9 * len(want) and len(have & want) >= 0.9 * len(have), kind
    assert got["preview_blocks", "header"] == {(1, 0)} and got["preview_blocks", "pageno"] == {(2, 0)} and got["preview_blocks", "hyphen"] == {(3, 0)}
    text = {r.row_id: r.paragraphs for r in repaired_pages(pages, found).collect()}
    assert text[900] == [] and not any("befo-" in p or "THE OLD" in p or "—" in p for ps in text.values() for p in ps)


def noted(spark, noise=(), fixes=(), joins=()):
    row = "table_name string, row_id long, block_order long, "
    kinds = {"noise": (noise, "noise_kind string"), "fixes": (fixes, "s string, v string"), "joins": ([(*x, None, None, None) for x in joins], "a string, b string, to_row long, to_block long, rest string")}
    return {k: spark.createDataFrame(list(x), row + c) for k, (x, c) in kinds.items()}


def test_repaired_previews(spark):
    """A preview block is repaired by its own notes, not by those of the page of the same row_id."""
    pages = spark.createDataFrame([(1, "r", ["s"], 1, [("p", "The tlie mill.", 0, None)], None, None)], PAGES)
    previews = spark.createDataFrame([(1, "r", "e", "paragraph", "The gar-\nden of tlie mill."), (2, "r", "e", "paragraph", "[5]"), (3, "r", "e", "paragraph", None)], PREVIEWS)
    found = noted(spark, [("preview_blocks", 2, 0, "pageno"), ("page_blocks", 3, 0, "pageno")], [("preview_blocks", 1, 0, "tlie", "the")], [("preview_blocks", 1, 0, "gar", "den")])
    got = {(r.table_name, r.row_id): r.paragraphs for r in repaired_pages(pages, found, previews).collect()}
    assert got == {("page_blocks", 1): ["The tlie mill."], ("preview_blocks", 1): ["The garden of the mill."], ("preview_blocks", 2): [], ("preview_blocks", 3): []}


def test_repair_across_blocks():
    """Only a block that begins with the rest is joined; a half without its rest stays."""
    site = (2, "Share this page with your readers")
    assert repair_text([(1, "Top of the hil-"), site], set(), {}, {1: {"hil": "lside"}}) == ["Top of the hil-", site[1]]
    assert repair_text([(1, "Top of the hil-"), site, (3, "lside, at noon.")], set(), {}, {1: {"hil": "lside"}}) == ["Top of the hillside,", site[1], "at noon."]
    assert repair_text([(1, "Top of the hil-\n" + site[1])], set(), {}, {}, {1: {"hil": "lside,"}}) == ["Top of the hillside, " + site[1]]
    assert repair_text([(1, site[1] + "\nlside, at noon.")], set(), {}, {}, None, {1: {"lside"}}) == [site[1] + " at noon."]


def test_repaired_across_pages(spark):
    """The word is completed on its first page and its rest leaves every delivery of the later one."""
    rows, _ = corpus(spark)
    base = lambda n, page, *texts: (n, "r90", ["site"], page, [("p", x, i, None) for i, x in enumerate(texts, 1)], "c", "k")
    body = "The quiet garden of the river was counted before another letter was opened in the modest harbour of the company."
    rows += [base(801, 1, body + " The gar-", "Share this page with your readers and with all of the others, they said."), base(802, 2), base(803, 3, "den, he said. " + body), base(804, 3, "den, he said. " + body)]
    rows += [base(805, 4, body + " The har-"), base(806, 5, "Nobody said it. " + body)]
    pages = spark.createDataFrame(rows, PAGES)
    found = page_noise(pages, spark.createDataFrame([], PREVIEWS), None, spark.createDataFrame([], CASES))
    got = {r.row_id: r.paragraphs for r in repaired_pages(pages, found).where("row_id > 800").collect()}
    site = "Share this page with your readers and with all of the others, they said."
    assert got[801] == [body + " The gar-", site]  # its next block was taken for the rest: not a word, so nothing is joined
    assert got[805] == [body + " The har-"] and got[806] == ["Nobody said it. " + body]
    plain = [r if r[0] != 801 else base(801, 1, body + " The gar-") for r in rows]
    pages = spark.createDataFrame(plain, PAGES)
    found = page_noise(pages, spark.createDataFrame([], PREVIEWS), None, spark.createDataFrame([], CASES))
    got = {r.row_id: r.paragraphs for r in repaired_pages(pages, found).where("row_id > 800").collect()}
    assert got[801] == [body + " The garden,"] and got[802] == []
    assert got[803] == got[804] == ["he said. " + body]


def test_two_confusions_and_broken_misread(spark):
    """A word with two separate confusions, and a broken word of which one half is misread."""
    rows, _ = corpus(spark)
    body = "The quiet garden of the river was counted before another letter was opened in the modest harbour of the company."
    rows += [(900 + i, "r90", ["site"], 2 * i, [("p", f"{body} {x}", 1, None)], "c", "k") for i, x in enumerate(("They f0llowecl it.", "They remem-\nberecl it.", "They fol-\nlowed it.", "They yonder-\nless it."))]
    pages = spark.createDataFrame(rows, PAGES)
    found = page_noise(pages, spark.createDataFrame([], PREVIEWS), None, spark.createDataFrame([], CASES))
    kinds = {(r.row_id, r.noise_kind) for r in found["noise"].where("row_id >= 900").collect()}
    assert kinds == {(900, "misread"), (901, "misread"), (901, "hyphen"), (902, "hyphen")}
    text = {r.row_id: r.paragraphs for r in repaired_pages(pages, found).where("row_id >= 900").collect()}
    assert text == {900: [f"{body} They followed it."], 901: [f"{body} They remembered it."], 902: [f"{body} They followed it."], 903: [f"{body} They yonder- less it."]}


def test_fit_of_all_rows(spark, monkeypatch):
    """Sums on the driver and by tasks give the same trees; a class that few rows have is learnt."""
    rng = np.random.default_rng(4)
    x = rng.random((20_000, 3)).round(2)
    y = (x[:, 0] > 0.5).astype(int)
    y[:1000], x[:1000] = 2, [0.25, 9.0, 0.5]
    rows = spark.createDataFrame([(v.tolist(), int(c)) for v, c in zip(x, y)], "x array<double>, y int")
    local, size = fitting.fit_rows(rows, [0, 1, 2, 3], rounds=8)
    monkeypatch.setattr(fitting, "LOCAL", 0)
    spread, _ = fitting.fit_rows(rows.repartition(7), [0, 1, 2, 3], rounds=8)
    assert local == spread and size == {c: int((y == c).sum()) for c in (0, 1, 2)}
    p = np.column_stack([m.probability(x) for m in local])
    assert (p.argmax(axis=1) == y).mean() > 0.95 and (p[:1000].argmax(axis=1) == 2).all() and len(local[3].trees) == 0
    one, size = fitting.fit_rows(rows.where("y = 1"))
    assert len(one[0].trees) == 0 and size == {1: int((y == 1).sum())} and fitting.fit_rows(rows.where("y > 5"))[1] == {}


def test_words_of_all_pages_count(spark):
    """A misread form as frequent as a word in the first 4000 pages by hash, whose right word is frequent enough only in all pages."""
    rng = random.Random(3)
    rows, _ = corpus(spark)
    ids = [r.id for r in spark.range(1000, 6000).orderBy(F.xxhash64("id"), "id").collect()]
    text = "The quiet river was counted before another letter was opened in the modest harbour of the company, and all of them said that it was there."
    odd = lambda word: f" The {rng.choice('narrow quiet painted early distant heavy modest'.split())} {word} {rng.choice('crossed painted followed counted opened gathered measured'.split())} it."
    more = lambda k: odd("gardcn") if k < 35 else odd("garden") * 2 if k >= 4000 else ""
    rows += [(n, f"s{k % 40}", ["site"], k // 40 * 3, [("p", text + more(k), 1, None)], "c", "k") for k, n in enumerate(ids)]
    found = page_noise(spark.createDataFrame(rows, PAGES), spark.createDataFrame([], PREVIEWS), None, spark.createDataFrame([], CASES))
    assert {r.row_id for r in found["noise"].where("noise_kind = 'misread' AND row_id >= 1000").collect()} == set(ids[:35])


def test_empty(spark):
    pages, previews, cases = spark.createDataFrame([], PAGES), spark.createDataFrame([], PREVIEWS), spark.createDataFrame([], CASES)
    assert page_noise(pages, previews, None, cases)["noise"].collect() == []
    assert page_statistics(pages, cases).collect() == []
