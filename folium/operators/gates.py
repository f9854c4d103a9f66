"""Accept or keep: a candidate row replaces the existing one only if ordered rules let it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folium.operators.relational import with_neighbours
from folium.runtime import materialize


def decide(existing: DataFrame, candidate: DataFrame, key: list[str], rules: list[tuple[str, Column]]) -> DataFrame:
    """Existing left-joined with its candidate and a reason: the first rule (reason, condition that rejects) that holds, 'accepted' if none does, 'no_candidate' without one.

    Columns of the existing row are named old_*, those of the candidate new_*.
    """
    old = existing.select(*key, *[F.col(c).alias(f"old_{c}") for c in existing.columns if c not in key])
    new = candidate.select(*key, *[F.col(c).alias(f"new_{c}") for c in candidate.columns if c not in key], F.lit(1).alias("_here"))
    reason = F.when(F.col("_here").isNull(), "no_candidate")
    for name, bad in rules:
        reason = reason.when(bad, name)
    return old.join(new, key, "left").withColumn("decision", reason.otherwise("accepted")).drop("_here")


def round_robin(df: DataFrame, group: str, order: list[Column], name: str = "turn") -> DataFrame:
    """Interleave groups: the first of each group, then the second of each, and so on; the turn is the rank within the group (sort by it and the group)."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(group).orderBy(*order)))


def context(df: DataFrame, keys: list[str], order: str, value: str, before: int, after: int, name: str = "context") -> DataFrame:
    """The values of the rows around each row, itself included; one step to the neighbours for each row of the longer side."""
    d = materialize(df, "rows").withColumn("_b", F.array().cast(f"array<{df.schema[value].dataType.simpleString()}>")).withColumn("_a", F.col("_b"))
    d = d.withColumn("_p", F.col(value)).withColumn("_n", F.col(value))
    for k in range(max(before, after)):
        d = with_neighbours(d, keys, order, ["_p", "_n"])
        p, n = F.col("prev._p"), F.col("next._n")
        d = d.withColumn("_p", p).withColumn("_n", n).drop("prev", "next")
        if k < before:
            d = d.withColumn("_b", F.when(F.col("_p").isNotNull(), F.concat(F.array("_p"), "_b")).otherwise(F.col("_b")))
        if k < after:
            d = d.withColumn("_a", F.when(F.col("_n").isNotNull(), F.concat("_a", F.array("_n"))).otherwise(F.col("_a")))
    return d.withColumn(name, F.concat("_b", F.array(value), "_a")).drop("_b", "_a", "_p", "_n")


def conformance(findings: DataFrame, keys: list[str], level: str = "level") -> DataFrame:
    """'fail' with any failure, else 'needs_review' with any warning, else 'pass'."""
    n = lambda v: F.sum(F.when(F.col(level) == v, 1).otherwise(0))
    out = findings.groupBy(*keys).agg(n("fail").alias("failures"), n("warn").alias("warnings"))
    return out.withColumn("verdict", F.when(F.col("failures") > 0, "fail").when(F.col("warnings") > 0, "needs_review").otherwise("pass"))


def drift_rules() -> list[tuple[str, Column]]:
    """Rules for decide() on counts header, heading, tables and groups: the candidate may have no more headers or headings, and no higher penalty (40 a header, 25 a heading, 5 a table after the first, 15 for several tables without groups)."""

    def penalty(side: str) -> Column:
        c = lambda n: F.col(f"{side}_{n}")
        several = F.when(c("tables") >= 2, 5 * (c("tables") - 1) + F.when(c("groups") == 0, 15).otherwise(0)).otherwise(0)
        return 40 * c("header") + 25 * c("heading") + several

    return [("more_headers", F.col("new_header") > F.col("old_header")), ("more_headings", F.col("new_heading") > F.col("old_heading")), ("drift_grew", penalty("new") > penalty("old"))]


def rescue_rules(weights: dict[str, int], headers: str, gain: int) -> list[tuple[str, Column]]:
    """Rules for decide() on weighted counts: a candidate that lost its header tables is out, one that has them where there were none is in, any other must score higher by `gain`."""
    score = lambda side: sum((w * F.col(f"{side}_{n}") for n, w in weights.items()), F.lit(0))
    old, new = F.col(f"old_{headers}"), F.col(f"new_{headers}")
    return [("lost_header_table", (new == 0) & (old > 0)), ("score_not_improved", ~((old == 0) & (new > 0)) & (score("new") < score("old") + gain))]


def header_match(cells: list[str], expected: list[str], least: float = 0.75) -> bool:
    """Whether a table's head cells show every expected word: within a cell, or alike by `least`."""
    from difflib import SequenceMatcher

    bare = ["".join(ch for ch in (c or "").lower() if ch.isalnum()) for c in cells]
    return all(any(c and (e in c or SequenceMatcher(None, c, e).ratio() >= least) for c in bare) for e in expected)


def structure_regressions(pairs: DataFrame, counts: list[str], old_words: str, new_words: str, least: float = 0.98) -> DataFrame:
    """Adds reasons ('fewer_x' or 'more_x' for each count that differs) and regressed: any reason, unless all are fewer and the texts share `least` of the larger one's words."""
    reason = [F.when(F.col(f"new_{c}") < F.col(f"old_{c}"), F.lit(f"fewer_{c}")).when(F.col(f"new_{c}") > F.col(f"old_{c}"), F.lit(f"more_{c}")) for c in counts]
    reasons_ = F.filter(F.array(*reason), lambda x: x.isNotNull())
    a, b = F.size(old_words), F.size(new_words)
    same = F.coalesce(F.when((a > 0) & (b > 0), F.size(F.array_intersect(old_words, new_words)) / F.greatest(a, b)) >= least, F.lit(False))
    waived = same & ~F.exists("reasons", lambda r: ~r.startswith("fewer_"))
    return pairs.withColumn("reasons", reasons_).withColumn("regressed", (F.size("reasons") > 0) & ~waived)


def fragmented(df: DataFrame, keys: list[str], order: str, ident: str, terms: str) -> DataFrame:
    """Rows that share terms with the next one of the key, by a whole number and the id: adds next_row and shared."""
    d = with_neighbours(df, keys, order, [ident, terms], (ident,), before=False)
    return d.withColumn("next_row", F.col(f"next.{ident}")).withColumn("shared", F.array_intersect(terms, F.col(f"next.{terms}"))).drop("next").where(F.size("shared") > 0)


def profile_issues(tables: Column, pages: Column, heads: Column, headings: Column) -> Column:
    """Issues that counts of structure suggest: many tables a page, tables without heads, no headings."""
    checks = [("fragmented_tables", (tables >= 5) & (tables / F.greatest(F.lit(1), pages) >= 1.25)), ("no_heads", (tables >= 3) & (heads == 0)), ("no_headings", headings == 0)]
    return F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in checks]), lambda x: x.isNotNull())
