from datetime import datetime

from folium.operators.references import Reference, orphan_references, orphans_by_period

T = [datetime(2024, 1, d) for d in range(1, 30)]
P = "row_id long, run_id string, entry_id string, arrived_at timestamp, deleted_at timestamp, key string, steps int"
C = "row_id long, run_id string, entry_id string, arrived_at timestamp, scope string, t int"


def found(spark, parents, children):
    p, c = spark.createDataFrame(parents, P), spark.createDataFrame(children, C)
    out = orphan_references(p, [Reference("c", c, ("entry_id",))], "entry_id")
    return {(r.row_id, r.orphan_kind) for r in out.collect()}, out


def test_kinds(spark):
    parents = [(1, "r", "a", T[5], None, None, None), (2, "r", "b", T[2], T[8], None, None), (3, "r", "b", T[10], None, None, None), (4, "r", "c", T[1], T[3], None, None), (4, "r", "c", T[1], T[3], None, None), (5, "r", "d", None, None, None, None)]
    children = [(1, "r", "a", T[4], None, None), (2, "r", "a", T[5], None, None), (3, "r", "b", T[9], None, None), (4, "r", "b", T[7], None, None), (5, "r", "b", T[11], None, None), (6, "r", "c", T[3], None, None), (7, "r", "zz", T[3], None, None), (8, "q", "a", T[9], None, None),
                (9, "r", "", T[9], None, None), (10, "r", None, T[9], None, None), (11, None, "a", T[9], None, None), (12, "r", "A", T[9], None, None), (13, "r", "d", T[9], None, None), (7, "r", "zz", T[3], None, None), (14, "r", "a", None, None, None)]
    got, out = found(spark, parents, children)
    assert got == {(1, "late"), (3, "deleted"), (6, "deleted"), (7, "missing"), (8, "missing"), (11, "missing"), (12, "missing"), (13, "late"), (14, "late")}
    counts = {(r.orphan_kind, r.period): r.orphans for r in orphans_by_period(out).collect()}
    assert counts["missing", "2024-01-01"] == 5


def test_empty_tables(spark):
    assert found(spark, [], [])[0] == set()
    assert found(spark, [], [(1, "r", "a", T[4], None, None)])[0] == {(1, "missing")}


def test_against_rows(spark):
    import random

    rng = random.Random(7)
    parents = [(i, rng.choice("rs"), rng.choice("abc"), rng.choice(T), rng.choice([None, *T]), None, None) for i in range(25)]
    children = [(i, rng.choice("rs"), rng.choice("abcd"), rng.choice(T), None, None) for i in range(200)]
    want = set()
    for i, run, e, t, _, _ in children:
        own = [p for p in parents if p[1:3] == (run, e)]
        past = [p for p in own if p[3] <= t]
        if not own:
            want.add((i, "missing"))
        elif not past:
            want.add((i, "late"))
        elif all(p[4] is not None and p[4] <= t for p in past):
            want.add((i, "deleted"))
    assert found(spark, parents, children)[0] == want


def test_two_parent_tables(spark):
    """The same key is looked up in the table that each reference names."""
    a, b = spark.createDataFrame([(1, "r", "x", T[1], None, None, None)], P), spark.createDataFrame([(1, "r", "y", T[9], None, None, None)], P)
    c = spark.createDataFrame([(1, "r", "x", T[4], None, None), (2, "r", "y", T[4], None, None)], C)
    out = orphan_references({"a": a, "b": b}, [Reference("c1", c, ("entry_id",), parent="a"), Reference("c2", c, ("entry_id",), parent="b")], "entry_id")
    assert {(r.ref_table, r.row_id, r.orphan_kind) for r in out.collect()} == {("c1", 2, "missing"), ("c2", 1, "missing"), ("c2", 2, "late")}
