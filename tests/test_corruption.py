import unicodedata

from folium.functions import text as T
from tests.oracle import DATA


def score(text):
    """By character categories, without regular expressions."""
    text = text or ""
    kind = [unicodedata.category(c) for c in text]
    blank = [k[0] == "Z" or c in "\t\n\x0b\f\r\x85\x1c\x1d\x1e\x1f" for c, k in zip(text, kind)]
    words = "".join(" " if b else "x" for b in blank).split()
    letters, plain = sum(k[0] == "L" for k in kind), sum(k[0] in "LN" or b for k, b in zip(kind, blank))
    bars = i = 0
    while i < len(text):
        j = i + 1
        if text[i] == "|":
            while j < len(text) and text[j] in " \t\n\x0b\f\r":
                j += 1
            bars += text[j : j + 1] in tuple("0123456789")
        i += 1
    odd = "".join("x" if not b and k[0] not in "LMN" and c not in "_.,!?" else " " for c, k, b in zip(text, kind, blank)).split()
    out = min(0.3 * bars, 0.8) + 0.4 * bool(words and sum(map(len, words)) > 15 * len(words)) + 0.3 * bool(plain and letters / plain < 0.3) + 0.2 * (sum(len(x) >= 3 for x in odd) > 2)
    return round(min(1.0, out), 4)


def test_every_document(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet").select("text", T.corruption_score("text").alias("s")).collect()
    assert [r.text for r in docs if abs(r.s - score(r.text)) > 1e-6] == []


def test_unlike_alphabets(spark):
    texts = [None, "", "\u00a0", "Die möchtstrng Größe fällt über Nacht.", "Le c\u0153ur d\u00e9\u00e7u \u00e9t\u00e9", "| 4 a |5 b |6", "\u25a0\u25a0\u25a0 \u2014\u2014\u2014 a ### b", "e\u0301te\u0301 42", "1 2 3 4 a"]
    got = spark.createDataFrame(list(enumerate(texts)), "i long, t string").select("i", T.corruption_score("t").alias("s")).collect()
    assert all(abs(r.s - score(texts[r.i])) <= 1e-6 for r in got) and [r.s for r in got][5:] == [1.0, 0.2, 0.0, 0.3]
