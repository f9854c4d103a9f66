"""Places and boxes of elements on pages: positions, page-number runs, repeated edges, box clean-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folium.operators.relational import islands_by, same_keys, with_neighbours
from folium.runtime import materialize


def place(y: Column, align: Column) -> Column:
    """struct<vertical (top, middle, bottom), horizontal (left, center, right)>; null without y.

    A y above 0.85 exactly at the left or right is read from the bottom up, as
    some recognisers give it.
    """
    a = F.lower(align)
    up = F.when((y > 0.85) & a.isin("left", "right"), 1 - y).otherwise(y)
    vertical = F.when(up <= 0.10, "top").when(up >= 0.90, "bottom").otherwise("middle")
    horizontal = F.when(a.contains("left"), "left").when(a.contains("right"), "right").otherwise("center")
    return F.when(y.isNotNull(), F.struct(vertical.alias("vertical"), horizontal.alias("horizontal")))


def coarse_label(label: Column) -> Column:
    """Eleven layout classes reduced to five: List, Figure, Table, Title, Text."""
    return F.when(label == "List-item", "List").when(label.isin("Picture", "Caption"), "Figure").when(label.isin("Table", "Title"), label).otherwise("Text")


def number_runs(df: DataFrame, keys: list[str], spot: list[str], page: str, number: str, ordinal: str, least: int = 3) -> DataFrame:
    """Elements in runs of numbers at one spot: ordinal, run_length, first_page, last_page.

    A run goes on where the next page is one on, whatever its number, or where a
    later page has the next number.
    """
    d = df.where(F.col(number).isNotNull()).select(*keys, *spot, page, number, ordinal)
    key = [*keys, *spot]
    d = materialize(with_neighbours(materialize(d, "numbers"), key, page, [page, number], (ordinal,), after=False), "numbers")
    p, n = F.col(f"prev.{page}"), F.col(f"prev.{number}")
    on = (F.col(page) == p + 1) | ((F.col(page) > p) & (F.col(number) == n + 1))
    g = islands_by(d, key, page, ~on, (ordinal,))
    long = g.groupBy(*key, "island").agg(F.count("*").alias("run_length"), F.min(page).alias("first_page"), F.max(page).alias("last_page")).where(F.col("run_length") >= least)
    return same_keys(g, long, [*key, "island"], "inner").select(ordinal, "run_length", "first_page", "last_page")


def repeated_signatures(df: DataFrame, keys: list[str], page: str, text: str, y: str, top: float = 0.08, bottom: float = 0.92, longest: int = 90, share: float = 0.2) -> DataFrame:
    """Texts at the top or bottom edge on at least max(3, share of the pages) distinct pages: keys, edge, signature, pages."""
    edge = F.when(F.col(y) <= top, "header").when(F.col(y) >= bottom, "footer")
    sig = F.lower(F.trim(F.regexp_replace(text, r"(?U)\s+", " ")))
    s = df.select(*keys, page, edge.alias("edge"), sig.alias("signature")).where("edge IS NOT NULL AND signature != ''").where(F.length("signature") <= longest)
    n = df.groupBy(*keys).agg(F.greatest(F.lit(3), F.floor(F.countDistinct(page) * share)).alias("least"))
    return s.groupBy(*keys, "edge", "signature").agg(F.countDistinct(page).alias("pages")).join(n, keys).where("pages >= least").drop("least")


def normal_box(box: Column, width: Column, height: Column) -> Column:
    """Box struct<x0, y0, x1, y1> in 0..1: values up to 1 stay, up to 1000 are thousandths, others are divided by the page's size; null if nothing is left of it."""

    def axis(lo: Column, hi: Column, size: Column) -> tuple[Column, Column]:
        most = F.greatest(lo, hi)
        by = F.when(most <= 1, F.lit(1.0)).when(most <= 1000, F.lit(1000.0)).otherwise(size.cast("double"))
        return F.least(F.greatest(lo / by, F.lit(0.0)), F.lit(1.0)), F.least(F.greatest(hi / by, F.lit(0.0)), F.lit(1.0))

    x0, x1 = axis(box.x0, box.x1, width)
    y0, y1 = axis(box.y0, box.y1, height)
    return F.when((x0 < x1) & (y0 < y1), F.struct(x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1")))


def _fold(boxes: Column, keep) -> Column:
    return F.aggregate(boxes, F.slice(boxes, 1, 0), lambda kept, b: F.when(keep(kept, b), F.concat(kept, F.array(b))).otherwise(kept))


def distinct_boxes(boxes: Column, least: float = 0.95, centre: float = 10, size: float = 0.02) -> Column:
    """Boxes in order without those that repeat a kept one: overlap of at least `least`, or centres and sizes that close (pixels)."""
    from folium.functions.text import iou

    def same(a: Column, b: Column) -> Column:
        near = lambda lo, hi: F.abs((a[lo] + a[hi]) / 2 - (b[lo] + b[hi]) / 2) <= centre
        alike = lambda lo, hi: F.abs((a[hi] - a[lo]) - (b[hi] - b[lo])) <= size * F.greatest(a[hi] - a[lo], b[hi] - b[lo])
        return (iou(a, b) >= least) | (near("x0", "x1") & near("y0", "y1") & alike("x0", "x1") & alike("y0", "y1"))

    return _fold(boxes, lambda kept, b: ~F.exists(kept, lambda k: same(k, b)))


def prune_containers(boxes: Column, share: float = 0.9, larger: float = 1.5) -> Column:
    """Boxes without those that cover most of another and are clearly larger."""

    def area(b: Column) -> Column:
        return (b.x1 - b.x0) * (b.y1 - b.y0)

    def covers(a: Column, b: Column) -> Column:
        w = F.greatest(F.lit(0.0), F.least(a.x1, b.x1) - F.greatest(a.x0, b.x0))
        h = F.greatest(F.lit(0.0), F.least(a.y1, b.y1) - F.greatest(a.y0, b.y0))
        return (area(a) >= larger * area(b)) & (area(b) > 0) & (w * h >= share * area(b))

    return F.filter(boxes, lambda a: ~F.exists(boxes, lambda b: covers(a, b)))
