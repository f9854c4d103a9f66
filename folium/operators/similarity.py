"""Similarity of texts, lines and boxes, and alignments that need a fold per group."""

from __future__ import annotations

import difflib
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_FOLD = str.maketrans({"‘": "'", "’": "'", "“": '"', "”": '"', "–": "-", "—": "-", "‐": "-", "­": ""})


def fold(text: str | None) -> str:
    """NFKC, plain quotes and dashes, single blanks."""
    return " ".join(unicodedata.normalize("NFKC", text or "").translate(_FOLD).split())


def ratio(a: str | None, b: str | None) -> float:
    """2 M / T over longest matching blocks of the folded texts; 1 for two empty ones."""
    return difflib.SequenceMatcher(None, fold(a), fold(b), autojunk=False).ratio()


def sequence_ratio(a: Column | str, b: Column | str) -> Column:
    return F.pandas_udf(lambda x, y: pd.Series([ratio(p, q) for p, q in zip(x, y)], dtype=float), "double")(a, b)


def kept_pages(texts: list[tuple[int, str | None]], threshold: float, least_tokens: int, look_back: int) -> list[tuple[int, int | None]]:
    """(ordinal, ordinal of the kept page that it repeats or None): each page is compared with the last `look_back` kept ones by token Jaccard; short pages are always kept."""
    kept: list[tuple[int, frozenset]] = []
    out = []
    for o, t in texts:
        tokens = frozenset(re.findall(r"[a-z0-9]+", (t or "").lower()))
        same = None
        if len(tokens) >= least_tokens:
            for k, other in reversed(kept[-look_back:]):
                union = len(tokens | other)
                if len(other) >= least_tokens and union and len(tokens & other) / union >= threshold:
                    same = k
                    break
        out.append((o, same))
        if same is None:
            kept.append((o, tokens))
    return out


def repeated_pages(df: DataFrame, key: str, ordinal: str, text: str, threshold: float = 0.95, least_tokens: int = 120, look_back: int = 2) -> DataFrame:
    """Pages that repeat one of the last kept pages of their document: key, ordinal, repeats.

    Rows are sorted within partitions and read as a stream; only the last kept
    pages are held, so a document of any length passes through.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, kept = object(), []
        for f in frames:
            rows = []
            for k, o, t in zip(f["k"], f["o"], f["t"]):
                if k != current:
                    current, kept = k, []
                tokens = frozenset(re.findall(r"[a-z0-9]+", (t or "").lower()))
                same = None
                if len(tokens) >= least_tokens:
                    for n, other in reversed(kept):
                        if len(other) >= least_tokens and len(tokens & other) / len(tokens | other) >= threshold:
                            same = n
                            break
                if same is None:
                    kept = [*kept[-look_back + 1 :], (o, tokens)] if look_back > 1 else [(o, tokens)]
                else:
                    rows.append((k, o, same))
            yield pd.DataFrame(rows, columns=["k", "o", "repeats"])

    rows = df.select(F.col(key).alias("k"), F.col(ordinal).cast("long").alias("o"), F.col(text).alias("t")).repartition("k").sortWithinPartitions("k", "o")
    return rows.mapInPandas(run, f"k {kind}, o long, repeats long").select(F.col("k").alias(key), F.col("o").alias(ordinal), "repeats")


def greedy_boxes(found: list[tuple], truth: list[tuple], least: float = 0.5) -> list[tuple[int, int, float]]:
    """Best overlaps first, each box once: (index found, index true, IoU)."""

    def over(a, b) -> float:
        w, h = max(0.0, min(a[2], b[2]) - max(a[0], b[0])), max(0.0, min(a[3], b[3]) - max(a[1], b[1]))
        u = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - w * h
        return w * h / u if u > 0 else 0.0

    all_ = sorted(((over(a, b), i, j) for i, a in enumerate(found) for j, b in enumerate(truth)), key=lambda x: (-x[0], x[1], x[2]))
    used_a, used_b, out = set(), set(), []
    for v, i, j in all_:
        if v >= least and i not in used_a and j not in used_b:
            used_a.add(i)
            used_b.add(j)
            out.append((i, j, v))
    return out


def matched_boxes(found: Column, truth: Column, least: float = 0.5) -> Column:
    """greedy_boxes of two arrays of structs <x0, y0, x1, y1> of one image: array<struct<found, truth, overlap>> (Arrow batches; null arrays count as empty)."""

    def run(f: pd.Series, t: pd.Series) -> pd.Series:
        rows = lambda a: [] if a is None else [tuple(b[k] for k in ("x0", "y0", "x1", "y1")) for b in a]
        return pd.Series([[{"found": i, "truth": j, "overlap": v} for i, j, v in greedy_boxes(rows(x), rows(y), least)] for x, y in zip(f, t)])

    return F.pandas_udf(run, "array<struct<found:int,truth:int,overlap:double>>")(found, truth)


def lcs_rows(a: list[str], b: list[str], least: float = 0.5) -> list[tuple[int, int]]:
    """Longest common subsequence of rows that are alike (ratio at least `least`): pairs of indices."""
    n, m = len(a), len(b)
    like = [[ratio(x, y) >= least for y in b] for x in a]
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in reversed(range(n)):
        for j in reversed(range(m)):
            best[i][j] = best[i + 1][j + 1] + 1 if like[i][j] else max(best[i + 1][j], best[i][j + 1])
    i = j = 0
    out = []
    while i < n and j < m:
        if like[i][j] and best[i][j] == best[i + 1][j + 1] + 1:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def vote_lines(engines: list[list[str]]) -> list[str]:
    """One text of several engines' lines: aligned to the first engine's lines, the majority wins, ties go to the earlier engine."""
    if not engines:
        return []
    base = engines[0]
    votes: list[list[str]] = [[x] for x in base]
    for other in engines[1:]:
        for tag, i1, i2, j1, j2 in difflib.SequenceMatcher(None, base, other, autojunk=False).get_opcodes():
            if tag in ("equal", "replace"):
                for i, j in zip(range(i1, i2), range(j1, j2)):
                    votes[i].append(other[j])
    out = []
    for v in votes:
        counts: dict[str, int] = {}
        for x in v:
            counts[x] = counts.get(x, 0) + 1
        out.append(max(counts, key=lambda x: (counts[x], -v.index(x))))
    return out


def divergence(a: Column, b: Column) -> Column:
    """1 - Jaccard of two token arrays."""
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, 1 - F.size(F.array_intersect(a, b)) / union).otherwise(0.0)
