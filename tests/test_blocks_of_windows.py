"""Operators over positions work in blocks; small blocks must give what one window gives, also for a key that holds a third of the rows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from folium.operators import gates as Q
from folium.operators import graph as G
from folium.operators import relational as R


@pytest.fixture(autouse=True)
def small(monkeypatch):
    monkeypatch.setattr(R, "BLOCK", 4)


def rows(spark, seed=1, n=150):
    rng = random.Random(seed)
    out = [(rng.choice(["hot", "hot", "a", "b", None]), rng.randrange(0, 90), i, rng.choice([None, 1, 2, 3])) for i in range(n)]
    return spark.createDataFrame(out, "k string, o long, t long, v long")


def same(a, b):
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(map(tuple, a.collect()), key=key) == sorted(map(tuple, b.collect()), key=key)


def test_equal_to_windows(spark):
    d, w = rows(spark), Window.partitionBy("k").orderBy("o", "t")
    up, down = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    same(R.with_neighbours(d, ["k"], "o", ["v", "t"], ("t",)).select("k", "o", "t", "prev.t", "next.t"), d.select("k", "o", "t", F.lag("t").over(w), F.lead("t").over(w)))
    same(R.running_sum(d, ["k"], "o", F.coalesce("v", F.lit(0)), "s", ("t",)).select("t", "s"), d.select("t", F.sum(F.coalesce("v", F.lit(0))).over(up)))
    same(R.last_known(d, ["k"], "o", F.col("v"), "x", ("t",)).select("t", "x"), d.select("t", F.last("v", True).over(up)))
    same(R.last_known(d, ["k"], "o", F.col("v"), "x", ("t",), after=True).select("t", "x"), d.select("t", F.first("v", True).over(down)))
    one = d.dropDuplicates(["k", "o"])
    w1 = Window.partitionBy("k").orderBy("o")
    same(Q.context(one, ["k"], "o", "o", 2, 1).select("k", "o", "context"), one.select("k", "o", F.collect_list("o").over(w1.rowsBetween(-2, 1))))
    same(R.islands_by(d, ["k"], "o", F.col("v") == 1, ("t",)).select("t", "island"), R.islands(d, ["k"], [F.col("o"), F.col("t")], F.col("v") == 1).select("t", "island"))


def test_far_bounds(spark):
    far = 10**9
    p = spark.createDataFrame([("a", x) for x in (1, 5, 64, 5000, far, far + 1, -3)] + [("b", 5), (None, 5)], "k string, p long")
    q = spark.createDataFrame([("a", 1, 5, 1), ("a", 60, far, 2), ("a", far, far, 3), ("a", 9, 2, 4), ("a", None, 9, 5), ("b", -far, far, 6)], "k string, s long, e long, i long")
    got = {(r.k, r.p, r.i) for r in R.range_join(p, q, ["k"], "p", "s", "e").collect()}
    assert got == {("a", 1, 1), ("a", 5, 1), ("a", 64, 2), ("a", 5000, 2), ("a", far, 2), ("a", far, 3), ("b", 5, 6)}
    assert R.range_join(p, q.where("i = 4"), ["k"], "p", "s", "e").count() == 0
    v = spark.createDataFrame([("a", 1), ("a", 1), ("a", far), ("a", far + 1), ("b", 7), ("a", None)], "k string, v long")
    assert [tuple(r) for r in R.missing_ranges(v, ["k"], "v").collect()] == [("a", 1, 2, far - 1, far)]


def test_uncovered_and_greedy_with_far_bounds(spark):
    rng = random.Random(4)
    spans = [(i, rng.choice("hhx"), s := rng.randint(1, 300), s + rng.choice([0, 3, 9, 40]), rng.random()) for i in range(150)]
    spans += [(1000, "h", 5, 10**9, 0.01), (1001, "h", 10**9 + 5, 2 * 10**9, 0.5), (1002, "x", 9, 4, 0.9)]
    d = spark.createDataFrame(spans, "row_id long, k string, s long, e long, c double")
    fine, coarse = d.where("row_id % 2 = 0"), d.where("row_id % 2 = 1")
    got = {r.row_id: (r.pages, r.uncovered) for r in R.uncovered_share(coarse, fine, ["k"], "s", "e", "row_id").collect()}
    merged = {}
    for _, k, s, e, _ in sorted((x for x in spans if x[0] % 2 == 0 and x[2] <= x[3]), key=lambda x: x[2]):
        m = merged.setdefault(k, [])
        if m and s <= m[-1][1] + 1:
            m[-1][1] = max(m[-1][1], e)
        else:
            m.append([s, e])
    want = {i: (e - s + 1, e - s + 1 - sum(max(0, min(e, b) - max(s, a) + 1) for a, b in merged.get(k, []))) for i, k, s, e, _ in spans if i % 2 and s <= e}
    assert got == want
    ok = d.where("s <= e")
    kept, plain = {r.row_id for r in R.greedy_non_overlap(ok, ["k"], "s", "e", [-F.col("c")], "row_id").collect()}, []
    for r in sorted((x for x in spans if x[2] <= x[3]), key=lambda r: (-r[4], r[0])):
        if all(r[1] != q[1] or r[2] > q[3] or q[2] > r[3] for q in plain):
            plain.append(r)
    assert kept == {r[0] for r in plain}


@pytest.mark.parametrize("wide", [4, 0])
def test_reachable_by_doubling(spark, wide):
    rng = random.Random(2)
    edges = [("r", str(i), str(i + 1)) for i in range(40)] + [("q", str(rng.randrange(25)), str(rng.randrange(25))) for _ in range(45)] + [("r", "50", "51"), ("r", None, "3")]
    starts = [("r", "0"), ("q", "3"), ("s", "x")]
    want = {}
    for k, s in starts:
        front, hop = {s}, 0
        while front:
            want |= {(k, n): hop for n in front}
            hop += 1
            front = {b for kk, a, b in edges if kk == k and a in front and (k, b) not in want}
    got = {(r.scope, r.node): r.hops for r in G.reachable(spark.createDataFrame(edges, "scope string, src string, dst string"), spark.createDataFrame(starts, "scope string, node string"), wide=wide).collect()}
    assert got == want
