"""Scores of outputs against what is right, and rankings of models by them."""

from __future__ import annotations

from difflib import SequenceMatcher
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folium.operators.relational import first_per_key

#: Share of the best score that a default model must reach, the weights of score, speed and cost, and the advantages that make value (fixed values).
FLOOR, WEIGHTS, CHEAPER, FASTER = 0.95, (0.60, 0.25, 0.15), 2.0, 1.5


def summaries(runs: DataFrame, model: str, score: str, latency: str, cost: str, least: float = 0.5) -> DataFrame:
    """Mean score, latency and cost of each model (zeros of latency and cost are no measurements) and whether it is disqualified (mean score under `least` or none)."""
    mean = lambda c: F.avg(F.when(F.col(c) != 0, F.col(c)))
    s = runs.groupBy(model).agg(F.avg(score).alias("score"), mean(latency).alias("latency"), mean(cost).alias("cost"), F.count("*").alias("cases"))
    return s.withColumn("disqualified", F.coalesce(F.col("score") < least, F.lit(True)))


def ranked(models: DataFrame, model: str) -> DataFrame:
    """Default candidates of a summary (see summaries) with three_part and the roles quality, balanced and value.

    Candidates reach FLOOR of the best qualified score and are dominated by none (as
    good in score, latency and cost, better in one; only where all are measured).
    Speed and cost count as the best candidate's over the model's.  Value: far
    cheaper or faster than the best; the highest three-part score of these.  The
    summary of a leaderboard is small and meets itself in one join on the floor.
    """
    q = models.where(~F.col("disqualified") & F.col("score").isNotNull())
    best = q.agg(F.max_by(F.struct(model, "score", "latency", "cost"), F.struct("score", model)).alias("best"))
    window = q.crossJoin(F.broadcast(best)).where(F.col("score") >= F.col("best.score") * FLOOR)  # one row
    full = (F.col("latency") > 0) & (F.col("cost") > 0)
    other = window.where(full).select(F.lit(1).alias("_j"), F.col(model).alias("_m"), F.col("score").alias("_s"), F.col("latency").alias("_l"), F.col("cost").alias("_c"))
    beaten = window.where(full).withColumn("_j", F.lit(1)).join(other, "_j").where("_s >= score AND _l <= latency AND _c <= cost AND (_s > score OR _l < latency OR _c < cost)").select(model).distinct()
    kept = window.join(beaten, model, "left_anti").unionByName(window.join(beaten, model, "left_semi").where(F.col(model) == F.col(f"best.{model}")))
    edge = kept.agg(F.min(F.when(F.col("latency") > 0, F.col("latency"))).alias("fastest"), F.min(F.when(F.col("cost") > 0, F.col("cost"))).alias("cheapest"))
    share = lambda least, own: F.coalesce(F.when(F.col(own) > 0, F.col(least) / F.col(own)), F.lit(0.0))
    three = F.round(WEIGHTS[0] * F.col("score") + WEIGHTS[1] * share("fastest", "latency") + WEIGHTS[2] * share("cheapest", "cost"), 4)
    gain = lambda own: F.coalesce(F.when((F.col(own) > 0) & (F.col(f"best.{own}") > 0), F.col(f"best.{own}") / F.col(own)), F.lit(0.0))
    out = kept.crossJoin(F.broadcast(edge)).withColumn("three_part", three)
    return out.select(model, "score", "latency", "cost", "three_part", (F.col(model) == F.col(f"best.{model}")).alias("baseline"), ((F.col(model) != F.col(f"best.{model}")) & ((gain("cost") >= CHEAPER) | (gain("latency") >= FASTER))).alias("value_candidate"))


def winners(rank: DataFrame, model: str) -> DataFrame:
    """quality, balanced and value winner of ranked(): role, model."""
    pick = lambda role, df, by: df.agg(F.max_by(model, F.struct(by, model)).alias(model)).select(F.lit(role).alias("role"), model)
    return pick("quality", rank, "score").unionByName(pick("balanced", rank, "three_part")).unionByName(pick("value", rank.where("value_candidate"), "three_part")).where(F.col(model).isNotNull())


def set_scores(truth: DataFrame, found: DataFrame, keys: list[str], item: str) -> DataFrame:
    """Precision, recall and F1 of found items per key; a missing side counts as empty."""
    both = truth.select(*keys, item).distinct().withColumn("t", F.lit(1)).unionByName(found.select(*keys, item).distinct().withColumn("t", F.lit(2)))
    side = both.groupBy(*keys, item).agg(F.sum("t").alias("t"))
    n = lambda *v: F.sum(F.when(F.col("t").isin(*v), 1).otherwise(0))
    s = side.groupBy(*keys).agg(n(3).alias("hits"), n(1, 3).alias("true_items"), n(2, 3).alias("found_items"))
    p, r = F.coalesce(F.try_divide("hits", "found_items"), F.lit(0.0)), F.coalesce(F.try_divide("hits", "true_items"), F.lit(0.0))
    return s.withColumn("precision", p).withColumn("recall", r).withColumn("f1", F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0)))


def verdict_class(truth: Column, verdict: Column) -> Column:
    """TP (a fault found), TN, FP or FN of verdicts 'pass' and 'fail'; null for any other verdict."""
    v = F.lower(F.trim(verdict))
    return F.when(v.isin("pass", "fail"), F.concat(F.when(truth == v, "T").otherwise("F"), F.when(v == "fail", "P").otherwise("N")))


def suspicious_tokens(x: Column, least: int = 4) -> Column:
    """struct<mixed, mute>: tokens of letters with digits (ordinals and 'p12' aside) and words without a vowel, of at least so many characters."""
    t = F.regexp_extract_all(F.coalesce(x, F.lit("")), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))
    long = F.filter(t, lambda w: (F.length(w) >= least) & ~w.rlike(r"(?i)^[0-9]+(st|nd|rd|th)$|^p{1,2}[0-9]+$"))
    return F.struct(F.filter(long, lambda w: w.rlike(r"\p{L}") & w.rlike(r"\p{N}")).alias("mixed"), F.filter(long, lambda w: w.rlike(r"^\p{L}+$") & ~w.rlike("[aeiouyAEIOUY]")).alias("mute"))


# ---------------------------------------------------------------- tables


class _Tables(HTMLParser):
    """Tables as rows of cell texts; a head row is one of th cells or within thead."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tables: list[list[list[str]]] = []
        self.cell: list[str] | None = None

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.tables.append([])
        elif tag == "tr" and self.tables:
            self.tables[-1].append([])
        elif tag in ("td", "th") and self.tables and self.tables[-1]:
            self.close_cell()
            self.cell = []
        elif tag == "br" and self.cell is not None:
            self.cell.append(" ")

    def handle_endtag(self, tag):
        if tag in ("td", "th", "tr", "table"):
            self.close_cell()

    def handle_data(self, data):
        if self.cell is not None:
            self.cell.append(data)

    def close_cell(self):
        if self.cell is not None:
            self.tables[-1][-1].append(" ".join("".join(self.cell).split()))
            self.cell = None


def tables_of(source: str | None) -> list[list[list[str]]]:
    """Rows of cell texts of each table; rows without cells are left out."""
    p = _Tables()
    p.feed(source or "")
    p.close()
    p.close_cell()
    return [[r for r in t if r] for t in p.tables]


def row_likeness(a: list[str], b: list[str]) -> float:
    """Equal cells count 1, one within the other 0.5, over the longer row; 0.1 if the rows differ by more than two cells."""
    if not a or not b:
        return 0.0
    if abs(len(a) - len(b)) > 2:
        return 0.1
    same = sum(1.0 if x == y else 0.5 if x and y and (x in y or y in x) else 0.0 for x, y in zip(a, b))
    return same / max(len(a), len(b))


def aligned_rows(golden: list[list[str]], output: list[list[str]], least: float = 0.5) -> list[tuple[int, int]]:
    """Longest common subsequence of rows that are alike."""
    n, m = len(golden), len(output)
    like = [[row_likeness(x, y) >= least for y in output] for x in golden]
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n):
        for j in range(m):
            best[i + 1][j + 1] = best[i][j] + 1 if like[i][j] else max(best[i][j + 1], best[i + 1][j])
    out, i, j = [], n, m
    while i and j:
        if like[i - 1][j - 1] and best[i][j] == best[i - 1][j - 1] + 1:
            i, j = i - 1, j - 1
            out.append((i, j))
        elif best[i - 1][j] >= best[i][j - 1]:
            i -= 1
        else:
            j -= 1
    return out[::-1]


def table_score(golden: str | None, output: str | None) -> tuple[float, int, int, int]:
    """(score, rows matched, rows missing, rows extra): one less the share of cells of the golden rows that are wrong; a missing row is wrong in all its cells, a row of other length by the difference too. 0 without tables on either side."""
    g, o = ([r for t in tables_of(x) for r in t] for x in (golden, output))
    if not g or not o:
        return 0.0, 0, len(g), len(o)
    pairs = aligned_rows(g, o)
    met = {i for i, _ in pairs}
    wrong = sum(abs(len(g[i]) - len(o[j])) + sum(x != y for x, y in zip(g[i], o[j])) for i, j in pairs) + sum(len(r) for i, r in enumerate(g) if i not in met)
    return round(max(0.0, 1 - wrong / max(1, sum(map(len, g)))), 4), len(pairs), len(g) - len(pairs), len(o) - len(pairs)


def matched_tables(golden: list[str], output: list[str], least: float = 0.25) -> list[tuple[int, int, float]]:
    """Each golden table's text, in order, with the most similar output table that is still free, above `least`; ties go to the first."""
    free, out = dict(enumerate(output)), []
    for i, g in enumerate(golden):
        like = [(SequenceMatcher(None, g, o).ratio(), -j) for j, o in free.items() if g and o]
        best = max(like, default=(0.0, 0))
        if best[0] > least:
            out.append((i, -best[1], best[0]))
            del free[-best[1]]
    return out


def score_tables(pairs: DataFrame, golden: str, output: str) -> DataFrame:
    """table_score of each row's two HTML texts: all columns and score, matched, missing, extra (Arrow batches)."""
    f = F.pandas_udf(lambda a, b: pd.DataFrame([table_score(x, y) for x, y in zip(a, b)], columns=["score", "matched", "missing", "extra"]), "score double, matched int, missing int, extra int")
    return pairs.withColumn("_s", f(golden, output)).select(*pairs.columns, "_s.*")


def agreed(rows: DataFrame, keys: list[str], value: str, at: str) -> DataFrame:
    """The most frequent value of each key (ties: the first seen): keys, value, times, share."""
    n = rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("times"), F.min(at).alias("_at"))
    total = n.groupBy(*keys).agg(F.sum("times").alias("_n"))
    return first_per_key(n, keys, [-F.col("times"), F.col("_at")]).join(total, keys).select(*keys, value, "times", (F.col("times") / F.col("_n")).alias("share"))
