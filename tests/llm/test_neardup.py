import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folium.llm.neardup import _pack, _unpack, duplicate_groups, near_duplicates
from folium.llm.shingles import gram_sets, word_hashes

SCHEMA = "row_id long, text string, id string, a int"


def sets(texts, n, least):
    out = {}
    for k, t in texts:
        w = re.findall(r"[^\W_]+", (t or "").lower())
        if len(w) >= least and len(w) >= n:
            out[k] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
    return out


def brute(texts, n, t, least):
    s = sets(texts, n, least)
    ks = sorted(s)
    return {(a, b) for i, a in enumerate(ks) for b in ks[i + 1 :] if len(s[a] & s[b]) >= t * len(s[a] | s[b]) - 1e-12}


def corpus(seed, docs=70):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    out = []
    for _ in range(docs):
        if out and rng.random() < 0.6:
            w = rng.choice(out).split()
            for _ in range(rng.randint(0, 6)):
                i = rng.randrange(len(w))
                w[i : i + 1] = rng.choice([[], [rng.choice(words)], [w[i], rng.choice(words)]])
            out.append(" ".join(w) if len(w) > 2 else "w1 w2 w3")
        else:
            out.append(" ".join(rng.choice(words) for _ in range(rng.randint(3, 60))))
    return list(enumerate(out))


@given(st.lists(st.text(alphabet="ab1 é-\nİß_\U0001f600", max_size=30), min_size=1, max_size=6))
@settings(max_examples=200, deadline=None)
def test_words_are_runs_of_letters_and_digits(texts):
    h, doc = word_hashes(texts)
    want = [(i, w) for i, t in enumerate(texts) for w in re.findall(r"[^\W_]+", t.lower().replace("̇", " "))]
    assert doc.tolist() == [i for i, _ in want]
    assert len(set(h.tolist())) == len({w for _, w in want})


def test_gram_sets_and_packing():
    g, off, words = gram_sets(["a b c d", "a b c", "", "x", "a b c a b c"], 3, chars=8)
    assert np.diff(off).tolist() == [2, 1, 0, 0, 3] and words.tolist() == [4, 3, 0, 1, 6]
    assert g[off[1]] in g[off[0] : off[1]]
    assert (_unpack(_pack(g)) == g).all()


@pytest.mark.parametrize("how", [{}, {"block_bytes": 2000}, {"hot": 3}])
def test_equals_brute_force(spark, how):  # small blocks; columns of more than three texts cut into chunks
    texts = corpus(11)
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in texts], SCHEMA).repartition(3)
    for n, t, least in ((3, 0.6, 5), (5, 0.8, 1)):
        got = [(r.row_id_a, r.row_id_b) for r in near_duplicates(df, n=n, threshold=t, least_words=least, **how).collect()]
        assert len(got) == len(set(got))
        assert set(got) == brute(texts, n, t, least)


def test_copies_nulls_and_long_texts(spark):
    long = " ".join(f"t{i}" for i in range(30_000))
    texts = [(1, "a b c d e f"), (2, "a b c d e f"), (3, None), (4, ""), (5, long), (6, long + " end"), (7, "a b"), (8, "a b c d e f"), (9, "q " * 50)]
    df = spark.createDataFrame([(k, t, None, None) for k, t in texts], SCHEMA)
    got = {(r.row_id_a, r.row_id_b) for r in near_duplicates(df, n=3, threshold=0.6, least_words=3).collect()}
    assert got == {(1, 2), (1, 8), (2, 8), (5, 6)}
    groups = {r.row_id: (r.group_id, r.links) for r in duplicate_groups(df, n=3, threshold=0.6, least_words=3).collect()}
    assert groups[1] == groups[2] == groups[8] == (1, 0) and groups[5] == groups[6] == (5, 1) and groups[3] == (3, 0) and groups[4] == (4, 0) and groups[7] == (7, 0)


def test_groups_are_components(spark):
    texts = corpus(4)
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in texts], SCHEMA)
    got = {r.row_id: r.group_id for r in duplicate_groups(df, n=3, threshold=0.6, least_words=5).collect()}
    parent = {k: k for k, _ in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in brute(texts, 3, 0.6, 5) | {(a, b) for a, t in texts for b, u in texts if a < b and t == u}:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    assert got == {k: root(k) for k, _ in texts}


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert near_duplicates(df).collect() == [] and duplicate_groups(df).collect() == []
