import random

from hypothesis import given, settings
from hypothesis import strategies as st

from folium.operators.intervals import IntervalMap, interval_spans, merge_intervals
from folium.streaming.intervals import OUT, drain_spans, spans_of_changes, stream_pieces

SCHEMA = "run_id string, page_start long, page_end long, key string, s long"


def brute(rows):
    out = set()
    for k in {r[0] for r in rows}:
        covered = sorted({p for r in rows if r[0] == k for p in range(r[1], r[2] + 1)})
        periods = []
        for p in covered:
            if periods and periods[-1][1] == p - 1:
                periods[-1][1] = p
            else:
                periods.append([p, p])
        out |= {(k, "period", *p) for p in periods}
        out |= {(k, "gap", a[1] + 1, b[0] - 1) for a, b in zip(periods, periods[1:])}
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 60), st.integers(0, 12)), max_size=40))
def test_map_equals_brute_force(items):
    m = IntervalMap()
    for s, n in items:
        m.insert(s, s + n)
    want = brute([("a", s, s + n) for s, n in items])
    assert {("a", "period", *p) for p in m.periods()} | {("a", "gap", *g) for g in m.gaps()} == want


def spans(df, **k):
    return {tuple(r) for r in interval_spans(df, "run_id", "page_start", "page_end", **k).collect()}


def test_blocks_of_any_size_agree(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), s := rng.randint(1, 200), s + rng.choice([0, 1, 3, 40]), "x", 1) for _ in range(120)]
    df = spark.createDataFrame(rows + rows[:20], SCHEMA)
    want = brute([r[:3] for r in rows])
    assert spans(df, least=1) == want
    assert spans(df, least=1, block=8) == want
    assert spans(df, least=1, block=1) == want


def test_hot_key_over_many_blocks(spark):
    """Two thirds of the rows in one key, disjoint and far apart, with long intervals over whole blocks."""
    rng = random.Random(8)
    rows = [("hot", s := rng.randrange(0, 10**9, 7), s + rng.choice([0, 3, 5, 70, 9_000_000 if rng.random() < 0.01 else 1]), "x", 1) for _ in range(2000)]
    rows += [(f"k{i % 50}", s := rng.randint(1, 50), s + 2, "x", 1) for i in range(1000)]
    want = set()
    for k in {r[0] for r in rows}:
        m = IntervalMap()
        for r in rows:
            if r[0] == k:
                m.insert(r[1], r[2])
        want |= {(k, "period", *p) for p in m.periods()} | {(k, "gap", *g) for g in m.gaps()}
    df = spark.createDataFrame(rows, SCHEMA)
    assert spans(df) == want and spans(df, block=64) == want


def test_dirty_rows_and_far_bounds(spark):
    top = 2**63 - 1
    rows = [(None, 1, 2, None, None), ("a", None, 2, None, None), ("a", 5, None, None, None), ("a", 9, 4, None, None), ("a", 0, 3, None, None), ("b", 1, top, None, None), ("b", 5, 9, None, None), ("c", 1, 1, None, None), ("c", 1, 1, None, None), ("c", 2, 2, None, None), ("c", top, top, None, None)]
    got = spans(spark.createDataFrame(rows, SCHEMA), least=1)
    assert got == {("b", "period", 1, top), ("c", "period", 1, 2), ("c", "gap", 3, top - 1), ("c", "period", top, top)}


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert spans(df) == set()
    assert merge_intervals(df, "run_id", "page_start", "page_end").collect() == []


def test_stream_equals_batch(spark, tmp_path):
    rows = [("a", 1, 3), ("a", 8, 9), ("b", 4, 4), ("a", 4, 5), ("a", None, 2), ("b", 2, 3), ("a", 6, 7)]
    for i in range(0, len(rows), 3):
        spark.createDataFrame(rows[i : i + 3], "run_id string, page_start long, page_end long").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("run_id string, page_start long, page_end long").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    seen = []

    def keep(df, _):
        seen.extend(tuple(r) for r in df.collect())

    q = stream_pieces(stream, "run_id", "page_start", "page_end", 1, block=4).writeStream.foreachBatch(keep).outputMode("update").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    want = brute([r for r in rows if r[1] is not None])
    assert {tuple(r) for r in spans_of_changes(spark.createDataFrame(seen, OUT)).collect()} == want
    assert {tuple(r) for r in drain_spans(spark, stream, "run_id", "page_start", "page_end", 1).collect()} == want
