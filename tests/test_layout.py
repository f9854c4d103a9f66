from pyspark.sql import functions as F

from folium.operators import layout as L

BOX = "struct<x0:double,y0:double,x1:double,y1:double>"


def test_places_and_labels(spark):
    rows = [(0.05, "Left", "List-item"), (0.5, None, "Caption"), (0.95, "center", "Title"), (0.95, "right", "Text"), (None, "left", "Formula")]
    got = spark.createDataFrame(rows, "y double, a string, l string").select(L.place(F.col("y"), F.col("a")).alias("p"), L.coarse_label(F.col("l")).alias("c")).collect()
    assert [tuple(r.p) if r.p else None for r in got] == [("top", "left"), ("middle", "center"), ("bottom", "center"), ("top", "right"), None]
    assert [r.c for r in got] == ["List", "Figure", "Title", "Text", "Text"]


def test_number_runs(spark):
    rows = [(1, "d", "b", 1, 7), (2, "d", "b", 2, 99), (3, "d", "b", 3, 9), (4, "d", "b", 9, 10), (5, "d", "b", 20, 40), (6, "d", "t", 1, 1), (7, "d", "t", 2, 2), (8, "d", "b", 30, None)]
    got = {r.i: (r.run_length, r.first_page, r.last_page) for r in L.number_runs(spark.createDataFrame(rows, "i long, k string, s string, page long, n long"), ["k"], ["s"], "page", "n", "i").collect()}
    assert got == {i: (4, 1, 9) for i in (1, 2, 3, 4)}


def test_repeated_signatures(spark):
    rows = [("d", p, "The  Book" if p < 4 else "x", 0.05) for p in range(1, 7)] + [("d", p, f"note {p}", 0.95) for p in range(1, 7)]
    got = [tuple(r) for r in L.repeated_signatures(spark.createDataFrame(rows, "k string, page long, t string, y double"), ["k"], "page", "t", "y").orderBy("signature").collect()]
    assert got == [("d", "header", "the book", 3), ("d", "header", "x", 3)]


def test_boxes(spark):
    df = spark.createDataFrame([((100.0, 200.0, 500.0, 2000.0), 1000.0, 4000.0), ((0.2, 0.2, 0.2, 0.9), 1.0, 1.0)], f"b {BOX}, w double, h double")
    got = [r.n for r in df.select(L.normal_box(F.col("b"), F.col("w"), F.col("h")).alias("n")).collect()]
    assert tuple(got[0]) == (0.1, 0.05, 0.5, 0.5) and got[1] is None
    boxes = [(0.0, 0.0, 100.0, 100.0), (2.0, 2.0, 101.0, 101.0), (0.0, 0.0, 300.0, 300.0), (150.0, 150.0, 200.0, 200.0)]
    d = spark.createDataFrame([(boxes,)], f"b array<{BOX}>").select(L.distinct_boxes(F.col("b")).alias("d"), L.prune_containers(F.col("b")).alias("p")).first()
    assert [tuple(x) for x in d.d] == [boxes[0], boxes[2], boxes[3]] and [tuple(x) for x in d.p] == [boxes[0], boxes[1], boxes[3]]
