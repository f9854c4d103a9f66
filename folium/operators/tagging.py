"""Content types of elements: look, place on the page, and what repeats over a document's pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folium.functions.tagging import contents_line, element_class, list_item, lone_number, page_range, table_line
from folium.functions.text import collapse, strip
from folium.operators.layout import number_runs, place
from folium.runtime import materialize

TOP, BOTTOM = 0.08, 0.92


def _signatures(e: DataFrame, run: str, edge: Column, name: str, least: DataFrame) -> DataFrame:
    """Texts that stand at an edge on enough pages of the run: run, sig and a mark."""
    s = e.where(edge & (F.length("t") <= 90) & (F.col("sig") != "")).groupBy(run, "sig").agg(F.countDistinct("page").alias("_n"))
    return s.join(least, run).where("_n >= least").select(run, "sig", F.lit(True).alias(name))


def _patterns(e: DataFrame, run: str, least: DataFrame) -> DataFrame:
    """Numbers and page ranges at the margins that follow a pattern: elem, p_label, p_confidence.

    Runs of numbers at one place are page numbers; of the rest, at the top equal
    texts and then ranges or numbers that are many at one place are heads, and at
    the bottom many numbers are footers.  Places are counted by aggregations.
    """
    n = e.where("number IS NOT NULL OR is_range").withColumn("_p", place(F.col("y"), F.col("align"))).where("_p IS NOT NULL").select("elem", run, "page", "t", "number", "is_range", F.col("_p.vertical").alias("v"), F.col("_p.horizontal").alias("h"))
    n = materialize(n, "margins")
    runs = materialize(number_runs(n.where("NOT is_range"), [run], ["v", "h"], "page", "number", "elem").select("elem"), "runs")
    first = runs.select("elem", F.lit("Page-footer").alias("p_label"), F.lit(0.99).alias("p_confidence"))
    rest = n.join(runs, "elem", "left_anti").join(least, run)
    spot = [run, "v", "h"]
    many = rest.groupBy(*spot).agg(F.count("*").alias("n_spot"), F.sum(F.when(F.col("is_range"), 0).otherwise(1)).alias("n_bottom"))
    same = rest.groupBy(*spot, "t").agg(F.count("*").alias("n_same"))
    rest = rest.join(many, spot).join(same, [*spot, "t"]).where("n_spot >= least").withColumn("repeats", F.col("n_same") >= F.col("least"))
    left = rest.where("v = 'top' AND NOT repeats").groupBy(*spot).agg(F.sum(F.when(F.col("is_range"), 1).otherwise(0)).alias("n_ranges"), F.sum(F.when(F.col("is_range"), 0).otherwise(1)).alias("n_numbers"))
    rest = rest.join(left, spot, "left").fillna(0, ["n_ranges", "n_numbers"]).withColumn("_five", F.greatest(F.lit(5), F.col("least")))
    top, ranges = F.col("v") == "top", F.col("n_ranges") >= F.col("_five")
    confidence = (
        F.when(top & F.col("repeats"), 0.9).when(top & ranges, F.when(F.col("is_range"), 0.9)).when(top & (F.col("n_numbers") >= F.col("_five")), F.when(~F.col("is_range"), 0.85))
        .when((F.col("v") == "bottom") & (F.col("n_bottom") >= F.col("least")), F.when(~F.col("is_range"), 0.85))
    )
    other = rest.select("elem", F.when(top, "Page-header").otherwise("Page-footer").alias("p_label"), confidence.alias("p_confidence")).where("p_confidence IS NOT NULL")
    return first.unionByName(other)


def tag_elements(elements: DataFrame, run: str = "run_id", share: float = 0.2) -> DataFrame:
    """Content type of each element: elem, label, confidence.

    elements: elem (unique), run, page, ordinal, kind, text, y (0 top to 1 bottom,
    may be null), align, role.  Passes in order: the element's look; lone numbers,
    ranges and repeated texts at the edges (not where a role named it); patterns of
    numbers, where they are surer; and the topmost text of a page as its title.
    Null texts are empty ones; an empty table gives no rows.
    """
    e = elements.withColumn("t", strip(F.coalesce("text", F.lit("")))).withColumn("sig", F.lower(collapse("t")))
    e = e.withColumn("c", element_class(F.col("kind"), F.col("text"), F.col("align"), F.col("role"))).withColumn("number", lone_number(F.col("t"))).withColumn("is_range", page_range(F.col("t")))
    e = materialize(e, "elements")
    least = e.groupBy(run).agg(F.greatest(F.lit(3), F.floor(F.countDistinct("page") * share)).alias("least"))
    y = F.col("y")
    for name, edge in (("is_head", y <= TOP), ("is_foot", y >= BOTTOM)):
        e = e.join(_signatures(e, run, edge, name, least), [run, "sig"], "left").withColumn(name, F.coalesce(name, F.lit(False)))
    free = F.col("c.source_role").isNull() & y.isNotNull()
    moved = lambda label, sure: F.struct(F.lit(label).alias("label"), F.greatest("c.confidence", F.lit(sure)).alias("confidence"))
    placed = (
        F.when(~free, F.struct("c.label", "c.confidence")).when(F.col("number").between(1, 9999) & (y >= BOTTOM), moved("Page-footer", 0.9)).when((y <= TOP) & F.col("is_range"), moved("Page-header", 0.85))
        .when(F.col("is_head"), moved("Page-header", 0.9)).when(F.col("is_foot"), moved("Page-footer", 0.9)).otherwise(F.struct("c.label", "c.confidence"))
    )
    e = e.withColumn("d", placed).join(_patterns(e, run, least), "elem", "left")
    surer = F.coalesce(F.col("p_confidence") > F.col("d.confidence"), F.lit(False))
    e = e.withColumn("label", F.when(surer, F.col("p_label")).otherwise(F.col("d.label"))).withColumn("confidence", F.when(surer, F.col("p_confidence")).otherwise(F.col("d.confidence")))
    top = e.where((F.col("kind") == "text") & (F.col("t") != "") & y.isNotNull()).groupBy(run, "page").agg(F.min_by("elem", F.struct("y", "ordinal")).alias("elem")).select("elem", F.lit(True).alias("topmost"))
    e = e.join(top, "elem", "left")
    plain = ~F.col("is_head") & F.col("number").isNull() & ~list_item(F.col("t")) & ~contents_line(F.col("t")) & ~table_line(F.col("t"))
    title = F.coalesce("topmost", F.lit(False)) & F.col("label").isin("Text", "Section-header") & (F.col("confidence") < 0.8) & (y <= TOP) & plain
    return e.select("elem", F.when(title, "Title").otherwise(F.col("label")).alias("label"), F.when(title, F.greatest("confidence", F.lit(0.75))).otherwise(F.col("confidence")).alias("confidence"))
