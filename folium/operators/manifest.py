"""Identity, order and mapping of a bundle's parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folium.functions.text import slug
from folium.operators.relational import first_per_key, running_sum, with_neighbours


def counted_slugs(df: DataFrame, keys: list[str], title: str, order: list[Column], sep: str = "-", name: str = "slug") -> DataFrame:
    """Slugs of titles, made unique within the key: the second of the same slug ends in _2, and so on, in order. One slug's rows meet in a window; a null title is untitled."""
    d = df.withColumn("_s", F.coalesce(slug(title, sep), F.lit("untitled")))
    n = F.row_number().over(Window.partitionBy(*keys, "_s").orderBy(*order))
    return d.withColumn("_n", n).withColumn(name, F.when(F.col("_n") > 1, F.concat("_s", F.lit("_"), F.col("_n").cast("string"))).otherwise(F.col("_s"))).drop("_s", "_n")


def folder_sha(files: DataFrame, keys: list[str], path: str, content: str) -> DataFrame:
    """'sha256:' and the hash of a folder: path, zero, content, zero of each file in the order of the paths (content as text; a folder's listing is one row, so meant for manifests and texts)."""
    part = F.array_sort(F.collect_list(F.struct(F.col(path).alias("p"), F.coalesce(F.col(content).cast("string"), F.lit("")).alias("c"))))
    whole = F.array_join(F.transform(part, lambda x: F.concat(x.p, F.lit("\x00"), x.c, F.lit("\x00"))), "")
    return files.where(F.col(path).isNotNull()).groupBy(*keys).agg(F.concat(F.lit("sha256:"), F.sha2(whole, 256)).alias("fingerprint"), F.count("*").alias("files"))


def contact_sheets(images: DataFrame, keys: list[str], order: str, columns: int, rows: int, ties: tuple[str, ...] = ()) -> DataFrame:
    """Place of each image on sheets of a grid, by a whole number: adds sheet (from 1), grid_row and grid_column (from 0)."""
    d = running_sum(images, keys, order, F.lit(1), "_n", ties).withColumn("_n", F.col("_n") - 1)
    cell = F.pmod("_n", F.lit(columns * rows))
    return d.select(*images.columns, (F.floor(F.col("_n") / (columns * rows)) + 1).alias("sheet"), F.floor(cell / columns).alias("grid_row"), F.pmod(cell, F.lit(columns)).alias("grid_column"))


def latest_scoped(df: DataFrame, keys: list[str], scope: str, wanted: str, everywhere: tuple[str, ...], at: str, ordinal: str) -> DataFrame:
    """The latest row of each key in the wanted scope, else the latest in a scope that stands for all; others do not count. Latest by time, then ordinal."""
    d = df.withColumn("_r", F.when(F.col(scope) == wanted, 0).when(F.col(scope).isin(*everywhere), 1)).where("_r IS NOT NULL")
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct((-F.col("_r")).alias("r"), F.col(at).alias("t"), F.col(ordinal).alias("o")))
    return d.groupBy(*keys).agg(best.alias("_b")).select(*keys, *[F.col("_b")[c].alias(c) for c in rest])


def selector_map(preview: DataFrame, full: DataFrame, keys: list[str], block: str = "block_id", entry: str = "entry_id") -> DataFrame:
    """Where each preview block is found in the full bundle: keys, block, entry, mapping ('preserved': the same block in the same entry; 'mapped': its entry is there; 'deferred'), full_entry and reason."""
    b = full.select(*keys, block, entry).distinct().withColumn("_same", F.lit(1))
    e = full.select(*keys, entry).distinct().withColumn("_entry", F.lit(1))
    d = preview.join(b, [*keys, block, entry], "left").join(e, [*keys, entry], "left")
    mapping = F.when(F.col("_same") == 1, "preserved").when(F.col("_entry") == 1, "mapped").otherwise("deferred")
    return d.select(*keys, block, entry, mapping.alias("mapping"), F.when(F.col("_entry") == 1, F.col(entry)).alias("full_entry"), F.when(mapping == "deferred", "entry is not in the full bundle").alias("reason"))


def selector_issues(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rules that mapping rows (mapping, preview_block, full_block, preview_entry, full_entry, reason) break: keys and rule."""
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    rules = [
        ("preserved_block", (F.col("mapping") == "preserved") & ~same("preview_block", "full_block")), ("preserved_entry", (F.col("mapping") == "preserved") & ~same("preview_entry", "full_entry")),
        ("mapped_entry", (F.col("mapping") == "mapped") & (F.coalesce("full_entry", F.lit("")) == "")), ("deferred_reason", (F.col("mapping") == "deferred") & (F.coalesce("reason", F.lit("")) == "")),
    ]
    return rows.select(*keys, F.explode(F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules]), lambda x: x.isNotNull())).alias("rule"))


def continuation_scores(portions: DataFrame, run: str, gap: int = 1, like: float = 0.5, least: float = 0.55) -> DataFrame:
    """Portions that go on with the one before them (by page_start, page_end, row_id), at most `gap` pages on: row_id, continuation_of, score.

    0.6 for the same id, 0.25 x similarity / like for titles that alike, 0.1 for the
    same type, 0.1 x the lower confidence (0.5 for a null one); from `least` on,
    two places, at most 1.
    """
    from folium.functions.text import jaccard, tokens_of

    row = F.struct("portion_id", "portion_type", "page_end", F.coalesce("confidence", F.lit(0.5)).alias("c"), tokens_of(F.coalesce("title", F.lit(""))).alias("t"))
    d = portions.where(F.col(run).isNotNull() & F.col("page_start").isNotNull() & F.col("page_end").isNotNull()).withColumn("b", row)
    d = with_neighbours(d, [run], "page_start", ["b"], ("page_end", "row_id"), after=False).withColumn("a", F.col("prev.b")).where(F.col("a").isNotNull() & (F.col("page_start") - F.col("a.page_end") - 1 <= gap) & (F.coalesce("a.portion_id", F.lit("")) != ""))
    sim = jaccard(F.col("a.t"), F.col("b.t"))
    yes = lambda c, v: F.when(F.coalesce(c, F.lit(False)), v).otherwise(0.0)
    score = yes(F.col("a.portion_id") == F.col("b.portion_id"), 0.6) + yes(sim >= like, 0.25 * sim / max(like, 0.01)) + yes(F.col("a.portion_type") == F.col("b.portion_type"), 0.1) + 0.1 * F.least("a.c", "b.c")
    return d.select("row_id", F.col("a.portion_id").alias("continuation_of"), score.alias("score")).where(F.col("score") >= least).withColumn("score", F.round(F.least(F.lit(1.0), "score"), 2))


def region_confidence(hits: Column, pages: Column) -> Column:
    """0.5 and 0.45 of the share of pages that show a region's pattern, within 0.5 to 0.95; 0 without pages."""
    return F.when(pages > 0, F.least(F.lit(0.95), F.greatest(F.lit(0.5), 0.5 + 0.45 * hits / pages))).otherwise(0.0)


def spread_labels(lines: DataFrame, sheet: list[str], line_no: str, text: str, label: str = r"\b([0-9]{1,4})\s*-\s*([0-9]{1,4})\b") -> DataFrame:
    """The printed numbers of each sheet's two pages: sheet, left_page, right_page, confidence, line_no.

    Each line with two different numbers is a candidate: 0.40 within the last twelve
    lines, 0.35 with a printer's word, 0.15 for 120 characters at most, up to 0.10 by
    place, 0.98 at most; under 0.25 none.  The surest wins, then the later line.  Only
    lines with text count; line_no runs from 0.
    """
    n = lines.where(F.trim(text) != "").groupBy(*sheet).agg(F.count("*").alias("_n"))
    d = lines.where(F.trim(text) != "").join(n, sheet).withColumn("_l", F.regexp_extract(text, label, 1)).withColumn("_r", F.regexp_extract(text, label, 2)).where("_l != '' AND CAST(_l AS BIGINT) != CAST(_r AS BIGINT)")
    score = F.when(F.col(line_no) >= F.greatest(F.lit(0), F.col("_n") - 12), 0.40).otherwise(0.0) + F.when(F.lower(text).rlike("indd|page|sheet|spread"), 0.35).otherwise(0.0)
    score = score + F.when(F.length(F.trim(text)) <= 120, 0.15).otherwise(0.0) + F.least(F.lit(0.10), F.col(line_no) / F.greatest(F.lit(1), F.col("_n")) * 0.10)
    d = d.withColumn("confidence", F.least(score, F.lit(0.98))).where("confidence >= 0.25")
    best = first_per_key(d.select(*sheet, line_no, "confidence", "_l", "_r"), sheet, [-F.col("confidence"), -F.col(line_no)])
    return best.select(*sheet, F.col("_l").cast("bigint").alias("left_page"), F.col("_r").cast("bigint").alias("right_page"), F.round("confidence", 3).alias("confidence"), line_no)


def injected_numbers(picked: DataFrame, raw: DataFrame, keys: list[str], number: str, low: int = 1, high: int = 400) -> DataFrame:
    """Numbers within a range that raw readings of a page show and the picked one lacks: keys, number (an anti-join)."""
    has = picked.select(*keys, number).distinct()
    return raw.where(F.col(number).between(low, high)).select(*keys, number).distinct().join(has, [*keys, number], "left_anti")


def priced(calls: DataFrame, prices: DataFrame, model: str, tokens: str, default: float) -> DataFrame:
    """Calls with cost: tokens / 1000 x the model's price, `default` for models without one; null tokens cost nothing."""
    return calls.join(prices.select(model, "price"), model, "left").withColumn("cost", F.round(F.coalesce(F.col(tokens), F.lit(0)) / 1000 * F.coalesce("price", F.lit(default)), 6)).drop("price")


def report_lines(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of a small report as lines of a text table: line."""
    return df.select(F.concat(F.lit("| "), F.concat_ws(" | ", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns]), F.lit(" |")).alias("line"))
