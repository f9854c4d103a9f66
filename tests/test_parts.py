import pytest
from pyspark.sql import functions as F

from folium.functions import text as T
from folium.operators import blend as L
from folium.operators import manifest as M
from folium.operators import repair as P
from folium.streaming import loops


def test_choices(spark):
    d = spark.createDataFrame([("If you win, turn to 12. If not, Turn  to 7, or turn to 12 again; turn to 900.",), (None,), ("",)], "t string")
    got = [[tuple(c) for c in r.c] for r in d.select(T.choices("t").alias("c")).collect()]
    assert [t for t, _ in got[0]] == ["12"] and got[1] == got[2] == []
    assert got[0][0][1] == "If you win, turn to 12. If not, Turn  to 7"
    two = spark.createDataFrame([("x" * 100 + " turn to 5 and turn to 6",)], "t string").select(T.choices("t").alias("c")).first().c
    assert [c.target for c in two] == ["5", "6"] and two[0].snippet.endswith("turn to 5 and turn to 6") and len(two[0].snippet) == 60 + len("turn to 5") + len(" and turn to 6")


def test_metadata(spark):
    tag = '<META name="ocr-metadata" data-ocr-quality="1.7" data-ocr-integrity="x">'
    d = spark.createDataFrame([(f"  {tag}\n<p>a</p>",), (f"<p>a</p>\n{tag}",), ("\n".join(["<p>"] * 5 + [tag]),), (None,)], "h string")
    a, b, c, e = (r.m for r in d.select(T.ocr_metadata("h").alias("m")).collect())
    assert (a.quality, a.integrity, a.line, a.warning, a.rest) == (1.0, None, 0, None, "<p>a</p>") and (b.line, b.warning, b.rest) == (1, "ocr_metadata_not_first_line:1", "<p>a</p>") and c is None and e is None


def test_natural_pieces(spark):
    names = ["p10.png", "p9.png", "P9a.png", "cover.png", "p009.png"]
    d = spark.createDataFrame([(n,) for n in names], "n string").orderBy(T.natural_pieces("n"), "n")
    assert [r.n for r in d.collect()] == ["cover.png", "p009.png", "p9.png", "P9a.png", "p10.png"] or [r.n for r in d.collect()][-1] == "p10.png"


def test_section_numbers():
    assert P.without_section_numbers("12\n13-15\n12 14 The mill stood.\n\n\n~~~---\nIt fell.", "12") == "The mill stood.\n\n\n\nIt fell."
    assert P.without_section_numbers(None) is None and P.without_section_numbers("") == "" and P.without_section_numbers("12 men came.", "13") == "12 men came." and P.without_section_numbers("12 men came.", "12") == "men came."


def test_garble(spark):
    v = spark.createDataFrame([(w,) for w in ("skill", "the", "city", "box", "you", "to", "turn")], "word string")
    d = spark.createDataFrame([(1, "the sxrll of cities and boxes"), (2, "y0u t0 turn 1st"), (3, None), (4, "hdgtr h3ll0w")], "i long, t string")
    got = {r.i: r for r in L.garble_metrics(d, "i", "t", v).collect()}
    assert (got[1].words, got[1].unknown, got[1].mute, got[1].fixed) == (6, 3, 1, 1) and got[1].dictionary_score == 0.5
    assert got[2].mixed == 1 and got[2].fixed == 2 and got[2].confusion_score == 0.5 and got[3].words == 0 and got[3].confusion_score == 0 and got[4].confusion_score == 1.0


def test_loop_and_cache(spark):
    d = spark.createDataFrame([(i, 3 * i) for i in range(5)], "i long, left long")
    faults = lambda x: x.where("left > 0")
    repair = lambda x, bad: x.withColumn("left", F.greatest(F.lit(0), F.col("left") - 4))
    rows, n, clean = loops.repair_loop(d, faults, repair, 5)
    assert (n, clean) == (3, True) and rows.where("left > 0").count() == 0
    assert loops.repair_loop(d, faults, repair, 2)[1:] == (2, False)
    calls = []

    def compute(x):
        calls.append(x.count())
        return x.withColumn("text", F.upper("image"))

    pages = spark.createDataFrame([("r", 1, "a"), ("r", 2, "b")], "run string, page long, image string")
    got, cache = loops.with_cache(pages, None, ["run", "page"], "image", compute, "text")
    got, cache = loops.with_cache(spark.createDataFrame([("r", 1, "a"), ("r", 2, "c"), ("q", 1, None)], pages.schema), cache, ["run", "page"], "image", compute, "text")
    assert calls == [2, 2] and {(r.run, r.page, r.text) for r in got.collect()} == {("r", 1, "A"), ("r", 2, "C"), ("q", 1, None)} and cache.count() == 3


def test_manifest_parts(spark):
    d = spark.createDataFrame([("r", 1, "A b"), ("r", 2, "a-B"), ("r", 3, None), ("q", 4, "A b"), ("r", 5, "?")], "k string, o long, t string")
    assert {r.o: r.slug for r in M.counted_slugs(d, ["k"], "t", [F.col("o")]).collect()} == {1: "a-b", 2: "a-b_2", 3: "untitled", 5: "untitled_2", 4: "a-b"}
    s = M.spread_labels(spark.createDataFrame([(1, 0, "12-13 page"), (1, 1, "see 4-5"), (1, 2, "7-7"), (2, 0, "none"), (3, 0, None)], "s long, n long, t string"), ["s"], "n", "t")
    assert [(r.s, r.left_page, r.right_page, r.confidence) for r in s.collect()] == [(1, 12, 13, 0.9)]
    issues = spark.createDataFrame([(1, "preserved", "a", "b", "e", "e", None), (2, "mapped", "a", None, "e", None, None), (3, "deferred", None, None, None, None, ""), (4, "preserved", "a", "a", "e", "e", None)], "i long, mapping string, preview_block string, full_block string, preview_entry string, full_entry string, reason string")
    assert {(r.i, r.rule) for r in M.selector_issues(issues, ["i"]).collect()} == {(1, "preserved_block"), (2, "mapped_entry"), (3, "deferred_reason")}
    assert M.priced(spark.createDataFrame([("m", 2000), ("n", None)], "m string, t long"), spark.createDataFrame([("m", 0.5)], "m string, price double"), "m", "t", 9.0).orderBy("m").select("cost").collect()[0].cost == pytest.approx(1.0)
