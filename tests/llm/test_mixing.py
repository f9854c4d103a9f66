from folium.llm.mixing import draw, in_training_order, reached_shares, source_plan

DOCS = "doc_id long, source string, n_tokens long, extra string"
TARGETS = "source string, target_share double, max_repeats int"


def mix(spark, docs, targets):
    d, t = spark.createDataFrame(docs, DOCS), spark.createDataFrame(targets, TARGETS)
    plan = source_plan(d, t)
    out = draw(d, plan)
    return in_training_order(out).collect(), {r.source: r for r in reached_shares(out, plan).collect()}


def test_shares(spark):
    docs = [(i, "big", 10, "x") for i in range(600)] + [(1000 + i, "small", 10, "x") for i in range(50)] + [(2000 + i, "long", 40, "x") for i in range(50)] + [(3000, None, 500, ""), (3001, "none", 500, ""), (3002, "big", 0, "")]
    rows, shares = mix(spark, docs, [("big", 0.5, 1), ("small", 0.2, 2), ("long", 0.2, 5), ("absent", 0.1, 3)])
    total = 6000 + 500 + 2000 + 1000
    assert abs(shares["big"].drawn_tokens - total * 0.5) <= 10 and shares["big"].status == "met"
    assert shares["small"].drawn_tokens == 1000 and shares["small"].status == "short" and shares["small"].most_used == 2
    assert abs(shares["long"].drawn_tokens - total * 0.2) <= 40 and shares["absent"].status == "absent" and shares["absent"].drawn_tokens == 0
    assert abs(sum(r.actual_share for r in shares.values()) - 1) < 1e-9
    keys = [(r.doc_id, r.copy_no) for r in rows]
    assert len(keys) == len(set(keys)) and sum(r.n_tokens for r in rows) == sum(r.drawn_tokens for r in shares.values())
    at = [r.position for r in rows]
    assert at == sorted(at) and 0 <= at[0] and at[-1] < 1
    # the curriculum: the source of long documents comes later on average
    mean = lambda s: sum(r.position for r in rows if r.source == s) / sum(r.source == s for r in rows)
    assert mean("long") > mean("big")


def test_hot_source_and_empty(spark):
    rows, shares = mix(spark, [(i, "hot", 1 + i % 7, "") for i in range(3000)], [("hot", 1.0, 1)])
    assert len(rows) == 3000 and shares["hot"].actual_share == 1.0
    rows, shares = mix(spark, [], [("a", 1.0, 1)])
    assert rows == [] and shares["a"].status == "absent"
    rows, shares = mix(spark, [(1, "a", 5, ""), (2, "b", 5, "")], [])
    assert rows == [] and shares == {}


def test_met_by_what_was_drawn(spark):
    """Uneven documents: the last one fills what is left; 'met' says what was drawn."""
    docs = [(i, "uneven", 5 + (i * 7919) % 400, "") for i in range(300)] + [(1000 + i, "huge", 9000, "") for i in range(3)] + [(2000 + i, "rest", 3, "") for i in range(4000)]
    _, shares = mix(spark, docs, [("uneven", 0.1, 1), ("huge", 0.1, 2), ("rest", 0.1, 9)])
    total = sum(d[2] for d in docs)
    assert abs(shares["uneven"].drawn_tokens - 0.1 * total) <= 5 and shares["uneven"].status == "met"
    assert abs(shares["rest"].drawn_tokens - 0.1 * total) <= 3 and shares["rest"].status == "met"
    assert shares["huge"].drawn_tokens == 9000 and shares["huge"].status == "near"
