from datetime import datetime

from folium.operators.blend import call_costs, stage_timings, vocabulary_share


def test_vocabulary(spark):
    df = spark.createDataFrame([(1, "The cats saw parties, xqzt"), (2, None), (3, "12 --")], "i long, t string")
    v = spark.createDataFrame([("the",), ("cat",), ("saw",), ("party",), (None,)], "word string")
    assert [tuple(r) for r in vocabulary_share(df, "i", "t", v).collect()] == [(1, 5, 4, 0.8)]


def test_costs(spark):
    calls = spark.createDataFrame([("r", "a", "m", 1000, 500), ("r", "a", "m", 1000, 0), ("r", "b", "x", 10, 10)], "run_id string, stage string, model string, tokens_in long, tokens_out long")
    prices = spark.createDataFrame([("m", 0.5, 1.0)], "model string, price_in double, price_out double")
    got = {(r.stage, r.model): (r.calls, r.cost, r.unpriced) for r in call_costs(calls, prices).collect()}
    assert got == {("a", "m"): (2, 1.5, 0), ("b", "x"): (1, 0.0, 1), ("a", None): (2, 1.5, 0), ("b", None): (1, 0.0, 1), (None, None): (3, 1.5, 1)}


def test_timings(spark):
    t = datetime(2024, 1, 1)
    rows = [("r", "s", 1, t, "a", 0), ("r", "s", 2, t.replace(minute=2), "b", 10), ("r", "q", 1, t, "c", None)]
    got = {r.stage: (r.seconds, r.message, r.pages_per_minute) for r in stage_timings(spark.createDataFrame(rows, "run_id string, stage string, seq long, ts timestamp, message string, pages long")).collect()}
    assert got == {"s": (120.0, "b", 5.0), "q": (0.0, "c", None)}
