"""Writers: JSON lines in a kept order, and HTML bundles with manifest and provenance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folium.operators.relational import neighbours


def write_jsonl(df: DataFrame, path: str, order: list[str] | None = None, mode: str = "errorifexists") -> None:
    """JSON lines, nulls kept. With an order the rows are range-sorted, so reading the files by name gives that order."""
    d = df.orderBy(*order) if order else df
    d.write.mode(mode).option("ignoreNullFields", "false").json(path)


def bundle_pages(blocks: DataFrame) -> DataFrame:
    """HTML of each entry of a bundle: run_id, entry_id, path, html, block_ids.

    blocks: run_id, entry_id, entry_order, block_order, kind, text.  Following
    list items share one list; blank texts are not rendered, but their ordinal
    still counts, so block ids never move.
    """
    esc = F.replace(F.replace(F.replace(F.col("text"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    from pyspark.sql import Window

    w = Window.partitionBy("run_id", "entry_id").orderBy("block_order")
    b = blocks.withColumn("n", F.row_number().over(w)).withColumn("block_id", F.format_string("blk-%s-%04d", "entry_id", "n"))
    b = b.where(F.trim(F.coalesce("text", F.lit(""))) != "")
    item = F.col("kind") == "list_item"
    b = b.withColumn("before", F.lag("kind").over(w)).withColumn("after", F.lead("kind").over(w))
    tag = F.when(F.col("kind") == "heading", "h2").when(item, "li").when(F.col("kind") == "caption", "figcaption").otherwise("p")
    html = F.concat(
        F.when(item & ~F.coalesce(F.col("before") == "list_item", F.lit(False)), "<ul>").otherwise(""),
        F.lit("<"), tag, F.lit(' id="'), F.col("block_id"), F.lit('">'), esc, F.lit("</"), tag, F.lit(">"),
        F.when(item & ~F.coalesce(F.col("after") == "list_item", F.lit(False)), "</ul>").otherwise(""),
    )
    s = F.array_sort(F.collect_list(F.struct("n", html.alias("h"), "block_id")))
    out = b.groupBy("run_id", "entry_id").agg(F.first("entry_order").alias("entry_order"), s.alias("s"))
    return out.select("run_id", "entry_id", "entry_order", F.concat("entry_id", F.lit(".html")).alias("path"), F.array_join(F.transform("s", lambda x: x.h), "\n").alias("html"), F.transform("s", lambda x: x.block_id).alias("block_ids"))


def bundle_manifest(pages: DataFrame) -> DataFrame:
    """Manifest per run: entries in reading order with neighbours, paths and fingerprints of their HTML."""
    n = neighbours(pages, ["run_id"], "entry_order", "entry_id", ("entry_id",), "prev_entry_id", "next_entry_id")
    e = F.array_sort(F.collect_list(F.struct("entry_order", "entry_id", "path", "prev_entry_id", "next_entry_id", F.concat(F.lit("sha256:"), F.sha2("html", 256)).alias("fingerprint"))))
    return n.groupBy("run_id").agg(e.alias("entries")).withColumn("reading_order", F.transform("entries", lambda x: x.entry_id))
