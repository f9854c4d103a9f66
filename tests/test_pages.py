import random

import pytest
from pyspark.sql import functions as F

from folium.operators import boundaries as B
from folium.operators import chapters as C
from folium.operators import gates as Q
from folium.operators import geometry as G
from folium.operators import repair as P
from folium.operators import scoring as S
from folium.operators import vote as V
from folium.operators.tagging import tag_elements

PAGE = "run_id string, row_id long, page long, printed long, heading string, opens boolean, extra string"
PORTION = "run_id string, ordinal long, title string, page_start long, page_end long, source_pages array<long>, by_source boolean"


def chapters(spark, pages, portions):
    p, q = spark.createDataFrame(pages, PAGE), spark.createDataFrame(portions, PORTION)
    c = C.chapters(p, q)
    return {(r.run, r.number): (r.title, r.page_start, r.page_end, r.source_pages, r.portions) for r in c.collect()}, {(r.run, r.title) for r in C.uncovered_pages(p, c).collect()}


def page(run, n, heading=None, printed=None, opens=True):
    return (run, n, n, printed, heading, opens if heading else None, "x")


def test_chapters_by_source_numbers(spark):
    """Two portions that touch, a page that none covers, a portion whose pages are all covered."""
    pages = [page("r", n, {1: "The Mill", 4: "The Bridge"}.get(n)) for n in range(1, 8)]
    got, rest = chapters(spark, pages, [("r", 1, "The Mill", 1, 3, None, None), ("r", 2, "The Bridge", 4, 6, None, None), ("r", 3, "Again", 2, 5, None, None), ("r", 4, "No start", None, None, None, None)])
    assert got == {("r", 1): ("The Mill", 1, 1, [1, 2, 3], ["The Mill"]), ("r", 2): ("The Bridge", 4, 4, [4, 5, 6], ["The Bridge"])}
    assert rest == {("r", "Image 7")}


def test_pages_carried_back_and_split(spark):
    """The next portion's first page still has the chapter's heading; one portion holds two known titles."""
    pages = [page("r", 1, "Arthur Bell"), page("r", 2), page("r", 3, "ARTHUR BELL"), page("r", 4, "Rosa Bell"), page("r", 5), page("r", 6, "Tom Carter"), page("r", 7)]
    got, rest = chapters(spark, pages, [("r", 1, "Arthur Bell", 1, 2, None, None), ("r", 2, "Rosa Bell", 3, 7, None, None), ("r", 3, "Tom Carter", 6, 7, None, None)])
    assert got[("r", 1)][3] == [1, 2, 3] and got[("r", 1)][4] == ["Arthur Bell", "Rosa Bell"]
    assert got[("r", 2)][0] == "Rosa Bell" and got[("r", 2)][3] == [4, 5] and got[("r", 3)][0] == "Tom Carter" and got[("r", 3)][3] == [6, 7] and rest == set()


def test_printed_numbers_first(spark):
    pages = [page("r", n, printed=n - 2 if n > 2 else None) for n in range(1, 7)]
    got, rest = chapters(spark, pages, [("r", 1, "One", 1, 2, [6], False), ("r", 2, "Two", 1, 2, [5, 6], True)])
    assert got[("r", 1)][3] == [3, 4] and got[("r", 1)][1:3] == (1, 2) and got[("r", 2)][3] == [5, 6]
    assert rest == {("r", "Image 1"), ("r", "Image 2")}


def test_many_documents_and_empty(spark):
    rng = random.Random(1)
    pages = [page(f"d{i}", n, rng.choice([None, "Part A", "Part B"])) for i in range(30) for n in range(1, 9)] + [page("hot", n) for n in range(1, 400)] + [(None, 9000, 1, None, None, None, None)]
    portions = [(f"d{i}", 1, "Part A", 1, 4, None, None) for i in range(30)] + [("hot", n, f"Part {'abcdefghij'[n // 10] * 4} {'klmnopqrst'[n % 10] * 5}", 4 * n + 1, 4 * n + 4, None, None) for n in range(99)] + [(None, 1, "x", 1, 2, None, None)]
    got, _ = chapters(spark, pages, portions)
    assert sorted(n for r, n in got if r == "hot") == list(range(1, 100)) and all(got["hot", n + 1][3] == [4 * n + k for k in range(1, 5)] for n in range(99))
    assert chapters(spark, [], []) == ({}, set())


def test_titles_and_stitches(spark):
    assert C.related("The Old Mill", "old mill, the") and C.related("Arthur", "Arthur Bell") and not C.related("Rosa", "Tom") and not C.related("", "x")
    d = spark.createDataFrame([("He went to the", "Mill."), ("He went.", "and so"), ("He went on", "and on"), ("He went far", "And on"), (None, "a"), ("x", "")], "a string, b string")
    assert [r.x for r in d.select(C.stitches(F.col("a"), F.col("b")).alias("x")).collect()] == [True, False, True, False, False, False]
    h = spark.createDataFrame([("The  Mill",), ("12 34 56 7",), ("The Bell Family",), ("ab",), (None,)], "t string")
    assert [r.x for r in h.select(C.owner_heading(F.col("t")).alias("x")).collect()] == ["The Mill", None, None, None, None]


def test_matched_blocks_and_images():
    src = [("e1", "heading", "The Mill"), ("e2", "paragraph", "It was old in 1871."), ("e3", "paragraph", "Nobody came."), ("e4", "figure", "")]
    assert C.matched_blocks([("heading", "The Mill"), ("paragraph", "It was old in 1871. Nobody came."), ("figure", ""), ("paragraph", "")], src) == ["e1", "e2", "e4", None]
    assert C.block_score("p", "born 1871 in town", "p", "born 1872 in town") < 0.5 and C.block_score("p", "", "p", "x") == 0
    assert C.placed_images(["a", "b"], [("1.png", "x"), ("2.png", "y")]) == ["1.png", "2.png"]
    assert C.placed_images(["the old mill", "image", "a ship"], [("1.png", "a bridge"), ("2.png", "old mill")]) == ["2.png", "1.png", None]


def test_votes():
    assert V.fuse("sTAMINA", "STAMINA") == "STAMINA" and V.fuse("m1ll", "mill") == "mill" and V.fuse("harse", "horse", {"horse"}) == "horse" and V.fuse("a", "abcdef") == "abcdef" and V.fuse("", "x") == "x"
    c = V.choose
    assert c({"a": ("", None)}) is None and c({"a": ("x", None), "b": ("", None)}) == ("x", "a", 0.0)
    assert c({"a": ("the mill", 0.2), "b": ("the  mill", 0.9), "c": ("thc mi11", 0.95)})[:2] == ("the  mill", "b")
    assert c({"a": ("one two", 0.2), "b": ("three", 0.9), "c": ("seven eight", 0.5)})[:2] == ("three", "b")
    assert c({"a": ("the old m1ll stood", None), "b": ("the old mill stood", None)})[:2] == ("the old mill stood", "fused")
    assert c({"a": ("short", None), "b": ("something longer", None)})[:2] == ("something longer", "b")
    rows = V.aligned({"b": (["one", "two", "four"], [None] * 3), "a": (["one", "two", "three", "four"], [None] * 4)})
    assert [r["a"][0] for r in rows] == ["one", "two", "three", "four"] and rows[2].get("b", ("",))[0] == ""


def test_voted_pages(spark):
    d = spark.createDataFrame([(1, "x", ["a line", "b l1ne"]), (1, "y", ["a line", "b line"]), (1, "z", ["a line", "b line"]), (2, "x", None), (2, "y", ["only"])], "p long, e string, t array<string>")
    got = {r.p: [x.text for x in r.lines] for r in V.vote_pages(d, ["p"], "e", "t").collect()}
    assert got == {1: ["a line", "b line"], 2: ["only"]}
    dis = {r.p: r.pairs for r in V.disagreement(d.select("p", "e", F.array_join("t", " ").alias("t")), ["p"], "e", "t").collect()}
    assert dis == {1: 3, 2: 1}


def test_geometry():
    rng = random.Random(3)
    assert G.reading_order([]) == [] and G.reading_order([(50, 0, 60, 40), (0, 5, 10, 45), (0, 100, 10, 140)]) == [1, 0, 2]
    boxes = [(x := rng.randint(0, 500), y := rng.randint(0, 900), x + 40, y + 30) for _ in range(40)]
    assert sorted(G.reading_order(boxes)) == list(range(40))
    two = [(0.05, i / 10, 0.4, i / 10 + 0.05) for i in range(6)] + [(0.55, i / 10, 0.95, i / 10 + 0.05) for i in range(6)]
    mixed = [two[i // 2 + 6 * (i % 2)] for i in range(12)]
    assert [mixed[i] for i in G.lines_in_order(mixed)] == two and G.columns_of([0.5, 0.5]) == [0, 0] and G.columns_of([]) == []


def test_boxes(spark):
    d = spark.createDataFrame([(1, 100.0, 700.0, 200.0, 950.0), (1, 50.0, 500.0, 300.0, 900.0), (2, 5.0, 5.0, 5.0, 9.0)], "p long, x0 double, y0 double, x1 double, y1 double").withColumn("width", F.lit(1000)).withColumn("height", F.lit(400))
    assert {(r.p, r.swapped) for r in G.unswapped(d, ["p"]).collect()} == {(1, False), (2, False)}
    b = spark.createDataFrame([((0, 0, 100, 100), (0, 90, 90, 120)), ((0, 0, 100, 100), (0, 90, 40, 120)), ((0, 0, 100, 100), (0, -20, 100, 10)), ((0, 0, 100, 100), None)], "b struct<x0:int,y0:int,x1:int,y1:int>, c struct<x0:int,y0:int,x1:int,y1:int>")
    assert [(r.t.y0, r.t.y1) for r in b.select(G.trim_caption(F.col("b"), F.col("c"), 2, 0.2).alias("t")).collect()] == [(0, 88), (0, 100), (12, 100), (0, 100)]


def test_paragraphs():
    assert P.paragraphs(["164", "You see a wheel that turns slow-", "ly in the stream near the mill.", "", "It stops at the second hour of night.", "GIANT RAT   7   8", "Then it goes on as before."]) == ["164", "You see a wheel that turns slowly in the stream near the mill. It stops at the second hour of night.", "GIANT RAT   7   8", "Then it goes on as before."]
    assert P.paragraphs(["one longer line of plain text here,", "", "and another longer one after it."]) == ["one longer line of plain text here,", "and another longer one after it."]
    assert P.paragraphs(["a", "b", "c", "d", "e", None, ""]) == ["a", "b", "c", "d", "e"] and P.paragraphs([]) == []
    assert P.section_head("1O3") and P.section_head(" 12 ") and not P.section_head("house") and not P.section_head("Oil")


def test_tables(spark):
    head = ["NAME", "BORN", "MARRIED", "SPOUSE", "BOY", "GIRL", "DIED"]
    rows, moves = P.continued_rows([head, ["Ann", "1801", "1820", "Tom", "2", "", "1871"], ["", "", "", "Jack", "", "", ""]])
    assert moves == 1 and rows[1][6] == "" and rows[2][6] == "1871" and P.continued_rows([]) == ([], 0) and P.continued_rows([["a"], ["b"]])[1] == 0
    html = "<table><tr><th>a</th><th>b</th></tr><tr><td>1</td><td>two<br>lines</td></tr></table>"
    assert S.tables_of(html) == [[["a", "b"], ["1", "two lines"]]] and S.tables_of(None) == []
    assert S.table_score(html, html) == (1.0, 2, 0, 0) and S.table_score(html, "")[0] == 0.0
    assert S.table_score(html, html.replace("<td>1", "<td>9"))[0] == 0.75
    assert S.matched_tables(["a b c d", "x y z"], ["x y z", "a b c"]) == [(0, 1, pytest.approx(0.83, abs=0.01)), (1, 0, 1.0)]
    d = spark.createDataFrame([(html, html), (html, None)], "g string, o string")
    assert [r.score for r in S.score_tables(d, "g", "o").collect()] == [1.0, 0.0]
    t = spark.createDataFrame([("JohnSmith",), ("12A",), ("Jan 1801 Feb 1802",), ("plain",), (None,)], "t string")
    assert [r.x for r in t.select(P.suspect_signs(F.col("t")).alias("x")).collect()] == [1, 1, 1, 0, 0]
    assert Q.header_match(["Name", "Born", "Marr1ed"], ["name", "born", "married"]) and not Q.header_match(["Name"], ["died"])


def test_ranking(spark):
    m = spark.createDataFrame([("a", 0.95, 100.0, 1.0), ("b", 0.94, 50.0, 0.2), ("c", 0.93, 120.0, 2.0), ("d", 0.4, 1.0, 0.01), ("e", None, None, None)], "m string, s double, l double, c double")
    s = S.summaries(m, "m", "s", "l", "c")
    assert {r.m for r in s.where("disqualified").collect()} == {"d", "e"}
    r = S.ranked(s, "m")
    assert {x.m for x in r.collect()} == {"a", "b"} and {(x.role, x.m) for x in S.winners(r, "m").collect()} == {("quality", "a"), ("balanced", "b"), ("value", "b")}
    assert S.winners(S.ranked(s.where("m = 'd'"), "m"), "m").count() == 0


def test_sections(spark):
    c = spark.createDataFrame([("s", 1, 5, 2, 100, "the old mill"), ("s", 2, 3, 1, 60, "old mill"), ("s", 3, 1, 1, 10, "x"), ("t", 4, None, None, None, None)], "k string, ordinal long, page long, line long, score long, body string")
    best = B.choose_boundaries(c, ["k"])
    assert {(r.k, r.ordinal) for r in best.collect()} == {("s", 2), ("t", 4)}
    assert [(r.k, r.candidates, round(r.similarity, 3)) for r in B.duplicate_report(c, ["k"], best).collect()] == [("s", 3, 0.667)]
    st = spark.createDataFrame([("r", "1", 1), ("r", "2", 4), ("r", "2", 9), ("r", "3", 5), ("r", "4", 7)], "run string, section string, start_seq long")
    el = spark.createDataFrame([("r", i, f"e{i}") for i in (1, 2, 3, 4, 5, 6, 8)], "run string, seq long, elem string")
    got = {r.section: (r.start_id, r.end_seq, r.end_id) for r in B.close_boundaries(st, el, "run", "section").collect()}
    assert got == {"1": ("e1", 3, "e3"), "2": ("e4", 5, "e5"), "3": ("e5", 6, "e6")}


def test_tagging(spark):
    rows = [(i * 10 + j, "r", i, j, "text", t, y, a, None) for i in range(1, 7) for j, (t, y, a) in enumerate([("THE OLD MILL AND ITS WHEEL OF WESTBY", 0.02, "center"), ("It stood there, and nobody came.", 0.5, "left"), (str(i + 4), 0.95, "center")])]
    rows += [(900, "r", 7, 0, "text", "a narrow road", 0.01, "left", None), (901, "r", 7, 1, "image", None, 0.4, None, None), (902, "r", 7, 2, "text", "x", 0.9, None, "Footnote"), (903, None, None, 0, "text", "• one thing", None, None, None)]
    d = spark.createDataFrame(rows, "elem long, run_id string, page long, ordinal long, kind string, text string, y double, align string, role string")
    got = {r.elem: (r.label, r.confidence) for r in tag_elements(d).collect()}
    assert got[10] == ("Page-header", 0.9) and got[11][0] == "Text" and got[12] == ("Page-footer", 0.99) and got[900] == ("Title", 0.75) and got[901] == ("Picture", 0.9) and got[902] == ("Footnote", 0.95) and got[903][0] == "List-item"
    assert tag_elements(d.where("elem < 0")).count() == 0


def test_halves_and_outliers(spark):
    d = spark.createDataFrame([(1, "a", "the old mill stood"), (1, "b", "the old mill stood"), (1, "c", "zzzz qqqq"), (2, "a", "x"), (2, "b", "yyy")], "p long, e string, t string")
    assert {(r.p, r.e) for r in V.without_outliers(d, ["p"], "e", "t").collect()} == {(1, "a"), (1, "b"), (2, "a"), (2, "b")}
    l = spark.createDataFrame([([("l", 0.1, 0.3), ("r", 0.6, 0.9), ("b", None, None)],)], "x array<struct<text:string,x0:double,x1:double>>")  # noqa: E741
    assert [[t.text for t in r.h] for r in (l.select(V.half_lines(F.col("x"), 0.5, side).alias("h")).first() for side in (False, True))] == [["l", "b"], ["r", "b"]]
    v = spark.createDataFrame([([("a", "x", 0.0), ("b", "y", 0.0), ("c", "y", 0.0)],), ([],)], "v array<struct<text:string,source:string,distance:double>>")
    assert [r.s for r in v.select(V.page_source(F.col("v")).alias("s")).collect()] == ["y", None]


def test_chapter_bodies(spark):
    e = spark.createDataFrame([("r", "chapter", 1, [2, 1, 3, 9]), ("r", "page", None, [4])], "run string, kind string, number long, source_pages array<long>")
    html = {1: '<p class="running-head">THE MILL</p><p>He went to the</p>', 2: "<h1>The Mill</h1>\n<p>It was old.</p><p class='page-number'>2</p>", 3: "<p class='x'>mill and stayed.</p><table><thead><tr><th>a</th></tr></thead><tr><th>b</th></tr></table>", 4: "<p>Alone.</p>"}
    p = spark.createDataFrame([("r", n, h) for n, h in html.items()] + [("r", 4, html[4]), ("r", 9, None), ("q", 1, "<p>other</p>")], "run_id string, page long, html string")
    got = {r.kind: r.body for r in C.chapter_bodies(e, p).collect()}
    assert got == {"chapter": '<h1>The Mill</h1>\n<p>It was old.</p>\n<p>He went to the mill and stayed.</p><table><thead><tr><th scope="col">a</th></tr></thead><tr><th scope="row">b</th></tr></table>', "page": "<p>Alone.</p>"}


def test_matched_boxes(spark):
    from folium.operators.similarity import matched_boxes

    box = "array<struct<x0:double,y0:double,x1:double,y1:double>>"
    d = spark.createDataFrame([([(0.0, 0.0, 2.0, 2.0), (0.0, 0.0, 4.0, 4.0)], [(0.0, 0.0, 4.0, 4.0)]), (None, [])], f"f {box}, t {box}")
    assert [[tuple(x) for x in r.m] for r in d.select(matched_boxes("f", "t").alias("m")).collect()] == [[(1, 0, 1.0)], []]


def test_best_reading(spark):
    d = spark.createDataFrame([("p", 1, "b", 0.1, 5), ("p", 2, "c", 0.2, 50), ("p", 3, "a", 0.2, 50), ("q", 4, "z", None, None)], "k string, o long, e string, s double, n long")
    assert {(r.k, r.o) for r in V.best_reading(d, ["k"], F.col("s"), "e", ["a", "b"], "n", 10, "o").collect()} == {("p", 3), ("q", 4)}


def test_snapshot():
    from folium.plans import Param, Recipe, Stage, snapshot
    from folium.plans import Operator

    op = Operator("keep", lambda d, least: d, 1, (("x",),), ("x",), {"least": Param(int, 0)})
    s = snapshot(Recipe([Stage("b", "keep", ("a",), {"least": 5}), Stage("a", "keep", ("in",))], {"keep": op}), "r1", {"in": "/x"})
    assert [x["id"] for x in s["stages"]] == ["a", "b"] and [x["params"] for x in s["stages"]] == [{"least": 0}, {"least": 5}] and s["operators"]["keep"]["columns_in"] == [["x"]]
