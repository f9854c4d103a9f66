"""Boundaries of numbered sections: choosing, ordering and closing them, phases, and numbers found in elements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folium.functions.text import jaccard, strip, tokens_of
from folium.operators.relational import first_per_key, with_neighbours


def choose_boundaries(candidates: DataFrame, keys: list[str], slack: int = 50) -> DataFrame:
    """One candidate of each section: of those whose text score is within `slack` of the best, the earliest by page, then line, then the higher score (then ordinal). Columns page, line, score, ordinal; null pages, lines and scores count as 0."""
    best = candidates.groupBy(*keys).agg(F.max(F.coalesce("score", F.lit(0))).alias("_best"))
    near = candidates.join(best, keys).where(F.coalesce("score", F.lit(0)) >= F.col("_best") - slack).drop("_best")
    return first_per_key(near, keys, [F.coalesce("page", F.lit(0)), F.coalesce("line", F.lit(0)), -F.coalesce("score", F.lit(0)), F.col("ordinal")])


def duplicate_report(candidates: DataFrame, keys: list[str], chosen: DataFrame, body: str = "body") -> DataFrame:
    """Sections with more than one candidate: keys, candidates, max_score, chosen (ordinal), similarity (the highest between the chosen text and another candidate's, null without texts)."""
    own = chosen.select(*keys, F.col("ordinal").alias("chosen"), tokens_of(body).alias("_own"))
    sim = F.when((F.size("_own") > 0) & (F.size("_other") > 0) & (F.col("ordinal") != F.col("chosen")), jaccard(F.col("_own"), F.col("_other")))
    rows = candidates.withColumn("_other", tokens_of(body)).join(own, keys)
    return rows.groupBy(*keys).agg(F.count("*").alias("candidates"), F.max("score").alias("max_score"), F.first("chosen").alias("chosen"), F.max(sim).alias("similarity")).where("candidates > 1")


def close_boundaries(starts: DataFrame, elements: DataFrame, run: str, section: str, seq: str = "seq", ident: str = "elem") -> DataFrame:
    """Sections with their last element: run, section, start_seq, end_seq, start_id, end_id.

    The earliest start of a section counts, before anything is closed.  A section
    ends before the next start of the run, the last one with the run's last element.
    One whose start element is missing is left out but still closes the one before;
    a missing end element gives null.  A section of one element takes the next
    element too, if there is one directly after it.
    """
    first = starts.where(F.col("start_seq").isNotNull()).groupBy(run, section).agg(F.min("start_seq").alias("start_seq"))
    last = elements.groupBy(run).agg(F.max(seq).alias("_last"))
    ahead = with_neighbours(first, [run], "start_seq", ["start_seq"], (section,), before=False)
    closed = ahead.join(last, run, "left").withColumn("end_seq", F.coalesce(F.col("next.start_seq") - 1, "_last")).drop("_last", "next")
    at = lambda name, to: elements.select(run, F.col(seq).alias(name), F.col(ident).alias(to))
    b = closed.join(at("start_seq", "start_id"), [run, "start_seq"]).join(at("end_seq", "end_id"), [run, "end_seq"], "left")
    b = b.withColumn("_next", F.when(F.col("start_seq") == F.col("end_seq"), F.col("end_seq") + 1)).join(at("_next", "_next_id"), [run, "_next"], "left")
    return b.select(run, section, "start_seq", F.when(F.col("_next_id").isNotNull(), F.col("_next")).otherwise(F.col("end_seq")).alias("end_seq"), "start_id", F.coalesce("_next_id", "end_id").alias("end_id"))


def rising(df: DataFrame, keys: list[str], seq: str, ordinal: str) -> DataFrame:
    """The first row of each position, so that positions strictly rise; rows without a position go."""
    return first_per_key(df.where(F.col(seq).isNotNull()), [*keys, seq], [F.col(ordinal)])


def phases(df: DataFrame, run: str, order: list[Column], opening: Column, cue: Column, late: Column) -> DataFrame:
    """Phase of each row: front before the first opening row (else before the first cue), then game; a late row of the game is end by itself, the row after it may be game again. Without opening and cue all are front. Adds column phase.

    The pivot is a minimum over each run (an aggregation); rows are compared with it, so no running state is kept.
    """
    place = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    d = df.withColumn("_o", place)
    pivot = d.groupBy(run).agg(F.min(F.when(opening, F.col("_o"))).alias("_open"), F.min(F.when(cue, F.col("_o"))).alias("_cue"))
    at = F.coalesce("_open", "_cue")
    game = at.isNotNull() & (F.col("_o") >= at)
    return d.join(pivot, run, "left").withColumn("phase", F.when(~F.coalesce(game, F.lit(False)), "front").when(F.coalesce(late, F.lit(False)), "end").otherwise("game")).drop("_o", "_open", "_cue")


def number_hits(elements: DataFrame, wanted: DataFrame, keys: list[str], ordinal: str, text: str) -> DataFrame:
    """Elements that show a wanted number: keys, number, ordinal, how ('exact', 'digits' or 'part').

    The number is the text; or all its digits in at most five characters; or one of
    its groups of digits in so short a text.  An exact hit inside a sentence (the
    element before does not end one and the one after does not begin one) does not
    count.  One equi-join on the number, neighbours by lag and lead.
    """
    t = strip(F.coalesce(text, F.lit("")))
    w = Window.partitionBy(*keys).orderBy(ordinal)
    ends = lambda c: F.coalesce((c == "") | c.rlike(r"[.!?:;\"'”’)]$"), F.lit(True))
    begins = lambda c: F.coalesce((c == "") | c.rlike(r"^\p{Lu}"), F.lit(True))
    e = elements.withColumn("_t", t).withColumn("_calm", ends(F.lag("_t").over(w)) | begins(F.lead("_t").over(w))).where(F.col("_t").rlike("[0-9]") & ((F.length("_t") <= 5) | F.col("_t").rlike("^[0-9]+$")))
    digits = F.regexp_replace("_t", "[^0-9]", "")
    parts = F.regexp_extract_all("_t", F.lit("([0-9]{1,3})"), F.lit(1))
    found = e.select(*keys, ordinal, "_t", "_calm", digits.alias("_digits"), F.explode(F.array_distinct(F.concat(F.array("_t", digits), parts))).alias("number"))
    how = F.when(F.col("_t") == F.col("number"), "exact").when((F.col("_digits") == F.col("number")) & (F.length("_t") <= 5), "digits").when((F.col("_digits") != F.col("number")) & (F.length("_t") <= 5), "part")
    hits = found.join(wanted.select(*keys, "number").distinct(), [*keys, "number"]).withColumn("how", how).where("how IS NOT NULL AND (how != 'exact' OR _calm)")
    return hits.select(*keys, "number", ordinal, "how")


def remap_ids(df: DataFrame, keys: list[str], ident: str, text: str, ordinal: str) -> DataFrame:
    """New ids: keys, ordinal, old id, new id. The number of up to four digits with which a text begins becomes the id of the first row that claims it; others keep theirs."""
    claim = F.nullif(F.regexp_extract(F.coalesce(text, F.lit("")), r"^\s*([0-9]{1,4})\b", 1), F.lit(""))
    d = df.select(*keys, ordinal, F.col(ident).alias("old_id"), claim.alias("_claim"))
    first = d.where("_claim IS NOT NULL").groupBy(*keys, "_claim").agg(F.min(ordinal).alias(ordinal)).select(*keys, ordinal, F.lit(True).alias("_won"))
    return d.join(first, [*keys, ordinal], "left").select(*keys, ordinal, "old_id", F.when(F.col("_won"), F.col("_claim")).otherwise(F.col("old_id")).alias("new_id"))
