import random

import pytest
from pyspark.sql import functions as F

from folium.functions import html as H
from folium.functions import text as T
from folium.operators import graph as G
from folium.operators import relational as R
from folium.operators import similarity as S
from folium.operators.validation import PORTION_RULES, split_valid
from folium.plans import Param, Recipe, Stage, check_params, operator, stamp


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)).select(column.alias("x")).first().x


def test_text_expressions(spark):
    assert one(spark, T.collapse("t"), t="  a  b\n c ") == "a b c"
    assert one(spark, T.slug("t"), t="The Old Mill, 1871!") == "the-old-mill-1871" and one(spark, T.slug("t"), t="?!") == "untitled"
    assert one(spark, T.turn_targets("t"), t="Turn to 12, or turn  to 7; turn to 12.") == [12, 7]
    assert one(spark, T.toc_entry("t"), t="The Mill ..... 14").asDict() == {"title": "The Mill", "page": 14}
    assert one(spark, T.toc_entry("t"), t="No entry here") is None
    kv = lambda t: (lambda r: r and (r.entity, [tuple(x) for x in r.pairs]))(one(spark, T.key_values("t"), t=t))
    assert kv("MANTICORE  SKILL 11  STAMINA 11") == ("MANTICORE", [("SKILL", 11), ("STAMINA", 11)])
    assert kv("Stamina = 12") == (None, [("STAMINA", 12)]) and kv("Gold pieces:") == (None, [("GOLD PIECES", None)]) and kv("the SKILL of a smith") is None
    assert one(spark, T.document_kind("t"), t="A round of cards") == "game rulebook" and one(spark, T.document_kind("t"), t="Anna Bell 1841-1902") == "family history" and one(spark, T.document_kind("t"), t="Anna 1841-1902") == "unknown"
    assert one(spark, T.looks_truncated("t", 10), t="A fragment without punctuation") and not one(spark, T.looks_truncated("t", 10), t="This sentence is complete.") and not one(spark, T.looks_truncated("t", 10), t="Short")
    assert abs(one(spark, T.text_quality("t"), t="my try") - (0.5 + 0.3 + 0.2 / 40)) < 1e-9 and one(spark, T.text_quality("t"), t="a b 12") == 0
    assert one(spark, T.corruption_score("t"), t="| 4 and |42") == 0.6 and one(spark, T.corruption_score("t"), t="x" * 40) == 0.4 and one(spark, T.corruption_score("t"), t=None) == 0
    assert one(spark, T.repaired_turn("t"), t="Then tum t0 12 or tum to 9") == "Then turn to 12 or tum to 9" and one(spark, T.repaired_turn("t"), t="TUM TO 7") == "TURN TO 7" and one(spark, T.repaired_turn("t"), t="Turn to 8") == "Turn to 8"
    assert [tuple(r) for r in one(spark, T.image_placeholders("t"), t='<p><img alt="a  map" data-count="2"><IMG></p>')] == [("a map", 1, 2), ("a map", 2, 2), ("", 1, 1)]
    assert one(spark, T.splice_table(F.col("t"), F.lit("<table>n</table>")), t="a<table>o</table>b") == "a<table>n</table>b"
    assert one(spark, T.splice_table(F.col("t"), F.lit("<table>n</table>")), t="a<p>Turn to 4.</p>") == "a<table>n</table>\n<p>Turn to 4.</p>" and one(spark, T.splice_table(F.col("t"), F.lit("T")), t="x") == "T\nx"
    assert one(spark, T.number_mismatch(F.lit("12"), F.col("t")), t="13 The mill") and not one(spark, T.number_mismatch(F.lit("12"), F.col("t")), t="12\nThe mill") and not one(spark, T.number_mismatch(F.lit("x"), F.col("t")), t="y")
    assert one(spark, T.relaxed_json("t", "a int"), t='```json\n{"a": 3}\n```').a == 3 and one(spark, T.relaxed_json("t", "a int"), t="none") is None
    assert one(spark, T.macro_section(F.col("t").cast("int"), (1, 4), (5, 90), (91, 99)), t="5") == "gameplay"
    assert one(spark, T.fix_numeric_token("t"), t="1O3.") == "103" and one(spark, T.fix_numeric_token("t"), t="house") == "house"
    assert one(spark, T.leading_int(F.col("t")), t="12L") == 12 and one(spark, T.whole_int("t"), t="12L") is None
    assert one(spark, T.is_section_number("t"), t=" 4O ") and not one(spark, T.is_section_number("t"), t="house")
    assert one(spark, T.join_hyphens("t"), t="a bro-\nken word") == "a broken word"
    assert one(spark, T.strip_number_lines("t"), t="12\ntext\n3-5") == "text"
    s = one(spark, T.table_stats("t"), t="<table><tr><td>a<td>b<td>c<td>d<td>e<td>f</tr></table>turn to")
    assert s.collapsed and s.turns == 1
    assert one(spark, T.private_text("t"), t="see /home/x/y") is None and one(spark, T.private_text("t"), t="a note") == "a note"
    assert one(spark, T.chunks("t", 4), t="abcdef\n\ngh") == ["abcd", "ef", "gh"]


def test_html():
    assert H.html_text("<h1>A</h1><p>b <b>c</b></p><table><tr><td>1</td><td>2</td></tr></table><img alt='x'><script>no</script>") == "A\nb c\n1 2\n[image: x]"
    rows = H.html_blocks("<h1>T</h1><p>see <a href='#1'>one</a></p><p> </p><img alt='pic'>")
    assert [(r["block_type"], r["text"], r["block_order"]) for r in rows] == [("h1", "T", 1), ("/h1", "", 2), ("p", 'see <a href="#1"> one </a>', 3), ("/p", "", 4), ("p", "", 5), ("img", "pic", 6)]
    assert H.html_blocks("<p></p>\n<p class=\"page-number\">7</p>\n", True) == [{"block_type": "p", "text": "7", "block_order": 1, "attrs": {"class": "page-number"}}, {"block_type": "/p", "text": "", "block_order": 2, "attrs": None}]
    page = """<p class="running-head">6-8</p>\n<h2>6</h2>\n<p>First paragraph.</p>\n<dl><dt>MANTICORE</dt><dd>SKILL 11</dd><dd>STAMINA 11</dd></dl>\n<p>If you win, turn to 364.</p>
<table><caption>Choices</caption><thead><tr><th>Roll</th><th>Go to</th></tr></thead><tbody><tr><td>1-2</td><td>10</td></tr></tbody></table>\n<img alt="Illustration of a creature.">"""
    got = H.html_blocks(page, True)
    kinds = "p /p h2 /h2 p /p dl dt /dt dd /dd dd /dd /dl p /p table caption /caption thead tr th /th th /th /tr /thead tbody tr td /td td /td /tr /tbody /table img".split()
    assert [r["block_type"] for r in got] == kinds and [r["block_order"] for r in got] == list(range(1, 38))
    assert [r["text"] for r in got if r["text"]] == ["6-8", "6", "First paragraph.", "MANTICORE", "SKILL 11", "STAMINA 11", "If you win, turn to 364.", "Choices", "Roll", "Go to", "1-2", "10", "Illustration of a creature."]
    assert [r["attrs"] for r in got if r["attrs"]] == [{"class": "running-head"}, {"alt": "Illustration of a creature."}]
    assert H.clean_html("<p class='x' onclick='y'>a &lt; b<font>c</font> <a href='http://x'>d</a><a href='#e'>e</a></p>") == "<p>a &lt; bc <a>d</a><a href=\"#e\">e</a></p>"
    assert H.clean_html("<p>a<br>b</p>  <img data-count='2' src='x'>") == '<p>a<br>b</p>\n<img alt="" data-count="2">'


def test_greedy_non_overlap_equals_fold(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice("ab"), s := rng.randint(1, 60), s + rng.randint(0, 9), rng.choice([0.1, 0.5, 0.5, 0.9])) for i in range(120)]
    df = spark.createDataFrame(rows, "row_id long, k string, s long, e long, c double")
    got = {r.row_id for r in R.greedy_non_overlap(df, ["k"], "s", "e", [-F.col("c"), F.expr("s - e"), F.col("s")], "row_id").collect()}
    kept = []
    for r in sorted(rows, key=lambda r: (-r[4], r[2] - r[3], r[2], r[0])):
        if all(r[1] != k[1] or r[2] > k[3] or k[2] > r[3] for k in kept):
            kept.append(r)
    assert got == {r[0] for r in kept}


def test_fill_sequence(spark):
    rows = [("a", i, v) for i, v in enumerate([None, None, 5, None, 7, None, 11, None], 1)] + [("b", 1, None), ("b", 2, 1), ("c", 1, None)]
    got = {(r.k, r.i): r.filled for r in R.fill_sequence(spark.createDataFrame(rows, "k string, i long, v long"), ["k"], "i", "v").collect()}
    assert [got["a", i] for i in range(1, 9)] == [3, 4, 5, 6, 7, None, 11, 12]
    assert got["b", 1] is None and got["c", 1] is None


def test_repeated_pages(spark):
    a, b = "one two three four five", "six seven eight nine ten"
    df = spark.createDataFrame([("d", 1, a), ("d", 2, a), ("d", 3, b), ("d", 4, a + " x"), ("d", 5, None), ("e", 1, a)], "k string, o long, t string")
    got = {(r.k, r.o): r.repeats for r in S.repeated_pages(df, "k", "o", "t", 0.8, 2, 2).collect()}
    assert got == {("d", 2): 1, ("d", 4): 1}


def test_alignments():
    assert S.ratio("a “b”", 'a "b"') == 1.0 and S.ratio(None, "") == 1.0
    assert S.greedy_boxes([(0, 0, 2, 2), (0, 0, 4, 4)], [(0, 0, 4, 4)]) == [(1, 0, 1.0)]
    assert S.lcs_rows(["a b", "x", "c d"], ["a b", "c d"]) == [(0, 0), (2, 1)]
    assert S.vote_lines([["a", "b"], ["a", "c"], ["a", "c"]]) == ["a", "c"]


def test_graph(spark):
    edges = spark.createDataFrame([("r", "1", "2"), ("r", "2", "1"), ("r", "2", "3"), ("r", "8", "9"), ("q", "1", "5")], "scope string, src string, dst string")
    starts = spark.createDataFrame([("r", "1")], "scope string, node string")
    assert {(r.node, r.hops) for r in G.reachable(edges, starts).collect()} == {("1", 0), ("2", 1), ("3", 2)}
    assert G.toposort({"b": ["a"], "a": [], "c": ["b"]}) == ["a", "b", "c"]
    with pytest.raises(ValueError, match="cycle"):
        G.toposort({"a": ["b"], "b": ["a"]})


def test_recipe(spark):
    registry = {}
    op = operator("t.keep", [["x"]], ["x"], least=Param(int, 0, least=0))(lambda d, least: d.where(F.col("x") >= least))
    from folium.plans import REGISTRY

    registry["keep"] = REGISTRY["t.keep"]
    assert op
    df = spark.createDataFrame([(1,), (5,)], "x long")
    r = Recipe([Stage("b", "keep", ("a",), {"least": 5}), Stage("a", "keep", ("in",))], registry)
    assert r.order({"in"}) == ["a", "b"]
    assert [x.x for x in r.plan({"in": df})["b"].collect()] == [5]
    for bad in ({"bogus": 1}, {"least": "one"}, {"least": -1}):
        with pytest.raises(ValueError):
            check_params(registry["keep"], bad)
    with pytest.raises(ValueError, match="no column"):
        r.check({"in": spark.createDataFrame([(1,)], "y long").schema})
    s = stamp(spark.createDataFrame([(None,), ("m",)], "module_id string"), "v1", "new", "r1", "now").collect()
    assert [x.module_id for x in s] == ["new", "m"] and s[0].run_id == "r1"


def test_split_valid(spark):
    df = spark.createDataFrame([("r", 1, 2, 0.5), ("r", 3, 2, 0.5), (None, 1, 1, 7.0)], "run_id string, page_start long, page_end long, confidence double")
    ok, bad = split_valid(df, PORTION_RULES)
    assert ok.count() == 1 and sorted(r.broken_rules for r in bad.collect()) == [["bounds"], ["run_id", "confidence"]]
