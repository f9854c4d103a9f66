import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folium.llm.tokenizer import count_tokens, default_pattern, encode_column, load, vocabulary_path
from tests.oracle import DATA

public = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def both():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return load(vocabulary_path("byte_bpe_50k.tiktoken"), default_pattern()), t


def test_corpus(both):
    mine, ref = both
    texts = [t or "" for t in pq.read_table(f"{DATA}/sf0.01/documents.parquet").column("text").to_pylist()]
    assert [mine.encode(t) for t in texts] == [e.ids for e in ref.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(both, text):
    mine, ref = both
    ids = mine.encode(text)
    assert ids == ref.encode(text, add_special_tokens=False).ids
    assert mine.decode(ids).decode("utf-8") == text


def test_long_and_special(both):
    mine, ref = both
    for t in ("a" * 50_000, " " * 20_000, "ab" * 9_000, "<|endoftext|> x", "\n" * 999 + "x"):
        assert mine.encode(t) == ref.encode(t, add_special_tokens=False).ids


def test_column(spark):
    df = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, "  ", 0), (4, "hello", 0), (4, "hello", 0)], "doc_id long, text string, ids int")
    got = sorted((r.doc_id, r.ids) for r in encode_column(df, "doc_id", "text").collect())
    assert got[:2] == [(1, []), (2, [])] and got[2][1] == [220, 220] and got[3] == got[4] == (4, [31373])
    assert {r.doc_id: r.n_tokens for r in count_tokens(df, "doc_id", "text").collect()} == {1: 0, 2: 0, 3: 2, 4: 1}
    assert encode_column(df.limit(0), "doc_id", "text").collect() == []
