"""Mixing sources to target weights along a time-varying curriculum.

Each source's weight is a schedule over the training time t in [0, 1]; its
integral is the token demand met by then.  A drawn copy of a document stands at
the time at which its source's cumulative demand reaches the copy's place in the
source's own stream, found by inverting the integral; sorting all copies by that
time interleaves the sources as the schedules ask.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folium.runtime import materialize, small_side

#: Buckets of a source's documents over which running sums are kept apart, so that no task holds a whole source.
BUCKETS = 4096
#: Share of the demand by which the tokens drawn may differ for a source to be met.
TOLERANCE = 0.01


def source_plan(tokens: DataFrame, targets: DataFrame) -> DataFrame:
    """One row per target source: available tokens and documents, demand, what can be drawn, and the slope of its schedule.

    The demand is target_share of all tokens (of every document, whatever its
    source).  What a source can give ends at max_repeats times its tokens; an
    absent source gives nothing.  The default slopes make a length curriculum:
    sources of short documents fade, those of long ones grow, and the total
    weight stays 1 at any time.
    """
    total = tokens.agg(F.sum("n_tokens")).first()[0] or 0
    have = tokens.where(F.col("source").isNotNull() & (F.col("n_tokens") > 0)).groupBy("source").agg(F.sum("n_tokens").alias("available_tokens"), F.count("*").alias("documents"))
    want = targets.where(F.col("source").isNotNull()).groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    p = want.join(have, "source", "left").fillna(0, ["available_tokens", "documents"])
    p = p.withColumn("demand_tokens", F.coalesce("target_share", F.lit(0.0)) * F.lit(float(total)))
    p = p.withColumn("budget", F.least("demand_tokens", F.col("available_tokens") * F.greatest(F.coalesce("max_repeats", F.lit(0)), F.lit(0))))
    p = p.withColumn("passes", F.when(F.col("available_tokens") > 0, F.floor(F.col("budget") / F.col("available_tokens"))).otherwise(0))
    p = p.withColumn("rest", F.when(F.col("available_tokens") > 0, F.col("budget") - F.col("passes") * F.col("available_tokens")).otherwise(0.0))
    length = F.when(F.col("documents") > 0, F.col("available_tokens") / F.col("documents")).otherwise(0.0)
    p = materialize(p.withColumn("length", length), "sources")
    m = p.agg(F.try_divide(F.sum(F.col("budget") * F.col("length")), F.sum("budget")), F.sum("budget")).first()
    mean, budget = m[0] or 0.0, m[1] or 0.0
    z = F.when(F.col("length") + F.lit(mean) > 0, (F.col("length") - F.lit(mean)) / (F.col("length") + F.lit(mean))).otherwise(0.0)
    p = p.withColumn("z", z)
    centre = (p.agg(F.sum(F.col("budget") * F.col("z"))).first()[0] or 0.0) / budget if budget else 0.0
    return materialize(p.withColumn("slope", (F.col("z") - F.lit(centre)) * 0.5).drop("z", "length"), "plan")


def invert_schedule(u: Column, slope: Column) -> Column:
    """The time t at which the integral of 1 + slope * (2 x - 1) from 0 to t is u (|slope| <= 1)."""
    b = 1 - slope
    return F.when(F.abs(slope) < 1e-9, u).otherwise((F.sqrt(b * b + 4 * slope * u) - b) / (2 * slope))


def draw(tokens: DataFrame, plan: DataFrame) -> DataFrame:
    """The copies drawn: doc_id, source, n_tokens, copy_no (from 1), position in [0, 1), not sorted.

    A source is passed over whole as often as its budget allows; the last, partial
    pass takes documents in the order of their hashes as far as they fit into the
    rest of the budget, then the one document whose size comes closest to what is
    left.  Documents without tokens, with a null source or one without a target
    are not drawn.
    """
    p = small_side(plan.select("source", "passes", "rest", "slope"))
    rows = tokens.where(F.col("source").isNotNull() & (F.col("n_tokens") > 0)).join(p, "source")
    rows = rows.withColumn("h", F.xxhash64("doc_id")).withColumn("bucket", F.pmod("h", F.lit(BUCKETS)))
    sums = rows.groupBy("source", "bucket").agg(F.sum("n_tokens").alias("n"))
    base = sums.withColumn("base", F.sum("n").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))).select("source", "bucket", F.coalesce("base", F.lit(0)).alias("base"))
    inside = F.sum("n_tokens").over(Window.partitionBy("source", "bucket").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("inside", inside).join(base, ["source", "bucket"])
    rows = rows.withColumn("before", F.col("base") + F.col("inside") - F.col("n_tokens"))
    rows = materialize(rows.withColumn("partial", F.col("before") + F.col("n_tokens") <= F.col("rest")), "placed")
    left = rows.groupBy("source").agg((F.max("rest") - F.sum(F.when(F.col("partial"), F.col("n_tokens")).otherwise(0))).alias("left"))
    off = F.abs(F.col("n_tokens") - F.col("left"))
    last = rows.where("NOT partial").join(small_side(materialize(left, "left")), "source").where(off < F.col("left")).groupBy("source").agg(F.min_by("before", F.struct(off, "h", "doc_id")).alias("last"))
    rows = rows.join(small_side(materialize(last, "last")), "source", "left")
    taken = F.when(F.col("partial") | F.coalesce(F.col("before") == F.col("last"), F.lit(False)), 1).otherwise(0)
    rows = rows.withColumn("times", (F.col("passes") + taken).cast("int")).where("times > 0")
    drawn = materialize(rows.select("doc_id", "source", "n_tokens", "before", "times", "slope"), "drawn")
    total = materialize(drawn.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("times")).alias("drawn")).join(tokens.where("n_tokens > 0").groupBy("source").agg(F.sum("n_tokens").alias("whole")), "source"), "totals")
    copies = drawn.join(small_side(total), "source").withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.col("times"))))
    u = ((F.col("copy_no") - 1) * F.col("whole") + F.col("before") + F.col("n_tokens") / 2) / F.col("drawn")
    position = invert_schedule(F.least(u, F.lit(1.0)), F.col("slope"))
    return copies.select("doc_id", "source", "n_tokens", "copy_no", position.alias("position"))


def in_training_order(drawn: DataFrame) -> DataFrame:
    """Range-sorted by position (ties by document and copy)."""
    return drawn.orderBy("position", "doc_id", "copy_no")


def reached_shares(drawn: DataFrame, plan: DataFrame) -> DataFrame:
    """Per target source what the mix holds: drawn_tokens, actual_share (of the mix), corpus_share (of all tokens asked for), most_used and status: absent (no document), short (max_repeats allows no more), met (drawn within TOLERANCE of the demand) or near (whole documents come no closer)."""
    got = materialize(drawn.groupBy("source").agg(F.sum("n_tokens").alias("drawn_tokens"), F.countDistinct("doc_id").alias("drawn_documents"), F.max("copy_no").alias("most_used")), "got")
    total = got.agg(F.sum("drawn_tokens")).first()[0] or 0
    r = plan.join(got, "source", "left").fillna(0, ["drawn_tokens", "drawn_documents", "most_used"])
    share = F.col("drawn_tokens") / F.lit(float(max(total, 1)))
    off = F.abs(F.col("drawn_tokens") - F.col("demand_tokens"))
    status = F.when(F.col("documents") == 0, "absent").when(F.col("budget") < F.col("demand_tokens"), "short").when(off <= TOLERANCE * F.col("demand_tokens"), "met").otherwise("near")
    asked = F.when(F.col("demand_tokens") > 0, F.col("drawn_tokens") / F.col("demand_tokens") * F.col("target_share")).otherwise(0.0)
    return r.select("source", "target_share", "max_repeats", "documents", "available_tokens", "demand_tokens", "drawn_documents", "drawn_tokens", "most_used", share.alias("actual_share"), asked.alias("corpus_share"), status.alias("status"))
