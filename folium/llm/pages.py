"""Texts and lines of pages made of blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ordered_texts(blocks: Column) -> Column:
    """Non-empty block texts in block order (ties as they stand): array<struct<o, i, t>>."""
    full = F.filter(F.transform(blocks, lambda b, i: F.struct(b.block_order.alias("o"), i.alias("i"), b.text.alias("t"))), lambda x: x.t != "")
    return F.array_sort(full)


def page_text(blocks: Column) -> Column:
    """Non-empty block texts in block order, joined by a blank, in lower case; '' without any."""
    return F.lower(F.concat_ws(" ", F.coalesce(F.transform(ordered_texts(blocks), lambda x: x.t), F.array().cast("array<string>"))))


def page_texts(pages: DataFrame) -> DataFrame:
    return pages.select("row_id", page_text(F.col("blocks")).alias("text"))
