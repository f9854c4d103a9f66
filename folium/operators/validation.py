"""Checks of pages, portions, bundles and provenance: each gives rows of what is wrong, never drops any silently."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folium.operators.relational import with_neighbours


def _rule(c: Column | str) -> Column:
    return F.coalesce(F.expr(c) if isinstance(c, str) else c, F.lit(False))


def split_valid(df: DataFrame, rules: dict[str, Column | str]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with the names of the rules they break). A rule that is null counts as broken."""
    broken = F.filter(F.array(*[F.when(~_rule(c), F.lit(n)) for n, c in rules.items()]), lambda x: x.isNotNull())
    judged = df.withColumn("broken_rules", broken)
    return judged.where(F.size("broken_rules") == 0).drop("broken_rules"), judged.where(F.size("broken_rules") > 0)


def issues(df: DataFrame, ident: list[str], rules: dict[str, Column | str]) -> DataFrame:
    """One row per row and broken rule: ident columns and rule."""
    broken = F.filter(F.array(*[F.when(~_rule(c), F.lit(n)) for n, c in rules.items()]), lambda x: x.isNotNull())
    return df.select(*ident, F.explode(broken).alias("rule"))


PORTION_RULES = {
    "run_id": "run_id IS NOT NULL",
    "bounds": "page_start IS NOT NULL AND page_end IS NOT NULL AND page_start >= 1 AND page_start <= page_end",
    "confidence": "confidence IS NULL OR confidence BETWEEN 0 AND 1",
}
PROVENANCE_RULES = {
    "block_id": "block_id RLIKE '^blk-[A-Za-z0-9_-]+-[0-9]{4}$'",
    "prefix": "startswith(block_id, concat('blk-', entry_id, '-'))",
    "confidence": "confidence IS NULL OR confidence BETWEEN 0 AND 1",
    "source_page": "source_page_number IS NOT NULL AND source_page_number >= 1",
}
ENTRY_RULES = {
    "path": "path = concat(entry_id, '.html')",
    "printed_range": "printed_page_start IS NULL OR printed_page_end IS NULL OR printed_page_start <= printed_page_end",
    "source_pages": "source_pages IS NOT NULL AND size(source_pages) > 0",
    "not_self": "coalesce(prev_entry_id, '') != entry_id AND coalesce(next_entry_id, '') != entry_id",
}


def adjacency_issues(entries: DataFrame) -> DataFrame:
    """Neighbour ids of live entries (first delivery of each) that are not those of the reading order: run_id, entry_id, rule."""
    live = entries.where("deleted_at IS NULL AND entry_id IS NOT NULL")
    first = live.groupBy("run_id", "entry_id").agg(F.min_by(F.struct("entry_order", "prev_entry_id", "next_entry_id"), "row_id").alias("e")).select("run_id", "entry_id", "e.*")
    w = Window.partitionBy("run_id").orderBy("entry_order", "entry_id")
    seen = first.withColumn("p", F.lag("entry_id").over(w)).withColumn("n", F.lead("entry_id").over(w))
    same = lambda a, b: F.coalesce(F.nullif(F.col(a), F.lit("")), F.lit("")) == F.coalesce(F.col(b), F.lit(""))
    return issues(seen, ["run_id", "entry_id"], {"prev": same("prev_entry_id", "p"), "next": same("next_entry_id", "n")})


def order_gaps(entries: DataFrame, key: str, order: str) -> DataFrame:
    """Keys whose order numbers are not 1..N each once: key, rows, numbers, least, greatest."""
    g = entries.groupBy(key).agg(F.count("*").alias("entries"), F.countDistinct(order).alias("numbers"), F.min(order).alias("least"), F.max(order).alias("greatest"))
    return g.where("NOT (entries = numbers AND least = 1 AND greatest = entries)")


def monotonic_breaks(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """Rows whose value is below that of the row before: keys, order, value, before."""
    d = with_neighbours(df.where(F.col(value).isNotNull()), keys, order, [value], after=False).withColumn("before", F.col(f"prev.{value}"))
    return d.where(F.col("before") > F.col(value)).select(*keys, order, value, "before")
