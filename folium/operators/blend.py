"""Quality metrics and roll-ups of runs: out-of-vocabulary shares, run costs, timings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folium.runtime import materialize, small_side


def word_rows(df: DataFrame, ident: str, text: str, least: int = 3) -> DataFrame:
    """One row per row and distinct lower-case word of at least so many letters, with its count."""
    w = F.explode(F.filter(F.split(F.regexp_replace(F.lower(text), "[^a-z]+", " "), " "), lambda x: F.length(x) >= least))
    return df.select(ident, w.alias("word")).groupBy(ident, "word").agg(F.count("*").alias("times"))


def vocabulary_share(df: DataFrame, ident: str, text: str, vocabulary: DataFrame, least: int = 3) -> DataFrame:
    """Per row the share of its words that the vocabulary (column word) knows, plural endings taken off once: ident, words, known, share. Rows without words are left out."""
    rows = word_rows(df, ident, text, least)
    v = small_side(materialize(vocabulary.select("word").where("word IS NOT NULL").distinct(), "vocabulary"))
    stems = rows.select("word").distinct().withColumn("try", F.explode(F.array_distinct(F.array("word", F.regexp_replace("word", "s$", ""), F.regexp_replace("word", "es$", ""), F.regexp_replace("word", "ies$", "y")))))
    known = stems.join(v.withColumnRenamed("word", "try"), "try", "left_semi").select("word").distinct().withColumn("known", F.lit(1))
    out = rows.join(known, "word", "left").groupBy(ident).agg(F.sum("times").alias("words"), F.sum(F.when(F.col("known") == 1, F.col("times")).otherwise(0)).alias("known"))
    return out.withColumn("share", F.col("known") / F.col("words"))


#: Figures that scanning puts for letters, and letters that it puts for each other (fixed values).
LEET, SWAPS = {"0": "o", "1": "l", "3": "e", "4": "a", "5": "s", "7": "t", "9": "g"}, {"x": "k", "k": "x", "r": "i", "i": "r"}


def _variants(w: Column) -> Column:
    """A word with one or two of its letters of SWAPS exchanged."""
    n = F.length(w)
    put = lambda s, i: F.concat(F.substring(s, F.lit(1), i - 1), F.translate(F.substring(s, i, F.lit(1)), "".join(SWAPS), "".join(SWAPS.values())), F.substr(s, i + 1))
    places = F.filter(F.sequence(F.lit(1), n), lambda i: F.substring(w, i, F.lit(1)).isin(*SWAPS))
    one = F.transform(places, lambda i: put(w, i))
    two = F.flatten(F.transform(places, lambda i: F.transform(F.filter(places, lambda j: j > i), lambda j: put(put(w, i), j))))
    return F.array_distinct(F.concat(one, two))


def garble_metrics(df: DataFrame, ident: str, text: str, vocabulary: DataFrame) -> DataFrame:
    """How garbled each text is: ident, words, unknown, mute (unknown words of four letters and more without a vowel), mixed (tokens of letters and figures), fixed (those and unknown words that figures or one or two exchanged letters make a known word), dictionary_score and confusion_score (0..1).

    Words are lower-case letters; plural endings are taken off for the lookup.  Each
    distinct word is looked up once, in joins with the vocabulary (column word).
    Texts without tokens have zeros.
    """
    v = materialize(vocabulary.select(F.lower("word").alias("try")).where("try IS NOT NULL").distinct(), "vocabulary")
    tokens = df.select(ident, F.explode_outer(F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda t: F.regexp_replace(t, r"^[.,;:!?()\[\]{}<>\"']+|[.,;:!?()\[\]{}<>\"']+$", "")), lambda t: t != "")).alias("raw"))
    low = F.lower("raw")
    mixed = low.rlike("[a-z]") & low.rlike("[0-9]") & ~low.rlike("^[0-9]+(st|nd|rd|th)$|^pp?[.]?[0-9]+$")
    tokens = tokens.withColumn("w", F.when(low.rlike("^[a-z]+$"), low)).withColumn("m", F.when(mixed, low))
    fixed_figures = F.regexp_replace(F.translate(F.col("m"), "".join(LEET), "".join(LEET.values())), "[^a-z]", "")
    seen = materialize(tokens.where("w IS NOT NULL").select("w").distinct(), "seen")
    stems = F.array_distinct(F.array("w", F.regexp_replace("w", "(?<=..)ies$", "y"), F.regexp_replace("w", "(?<=..)es$", ""), F.regexp_replace("w", "(?<=...)s$", "")))
    known = seen.withColumn("try", F.explode(stems)).join(v, "try", "left_semi").select("w").distinct().withColumn("known", F.lit(1))
    swapped = seen.join(known, "w", "left_anti").where(F.length("w").between(4, 24)).withColumn("try", F.explode(_variants(F.col("w")))).join(v, "try", "left_semi").select("w").distinct().withColumn("swap", F.lit(1))
    figures = tokens.where("m IS NOT NULL").select("m", fixed_figures.alias("try")).distinct().join(v, "try", "left_semi").select("m").distinct().withColumn("leet", F.lit(1))
    d = tokens.join(known, "w", "left").join(swapped, "w", "left").join(figures, "m", "left")
    n = lambda c: F.sum(F.when(c, 1).otherwise(0))
    unknown = F.col("w").isNotNull() & F.col("known").isNull()
    suspicious = F.col("m").rlike("^.{4,}$") & F.col("m").rlike("[0134579]")
    g = d.groupBy(ident).agg(
        F.count("raw").alias("tokens"), n(F.col("w").isNotNull()).alias("words"), n(unknown).alias("unknown"), n(unknown & F.col("w").rlike("^[^aeiouy]{4,}$")).alias("mute"), n(F.length("m") >= 3).alias("mixed"),
        n((F.col("swap") == 1) | (F.col("leet") == 1)).alias("fixed"), n(suspicious).alias("_odd"),
    )
    dictionary = F.least(F.lit(1.0), F.greatest(F.col("unknown") / F.greatest("words", F.lit(1)), F.when(F.col("mute") > 0, 0.5).otherwise(0.0)))
    confusion = F.least(F.lit(1.0), F.greatest(2.0 * F.col("mixed") / F.greatest("tokens", F.lit(1)), F.when(F.col("_odd") > 0, 0.6).when(F.col("fixed") > 0, 0.5).otherwise(0.0)))
    return g.select(ident, "words", "unknown", "mute", "mixed", "fixed", F.round(dictionary, 4).alias("dictionary_score"), F.round(confusion, 4).alias("confusion_score"))


def call_costs(calls: DataFrame, prices: DataFrame) -> DataFrame:
    """Calls and cost per run, stage and model with totals (nulls in stage and model): tokens in and out at prices per thousand, rounded to six places; models without a price cost nothing and are marked."""
    c = calls.join(prices, "model", "left")
    cost = F.coalesce(F.col("tokens_in") * F.col("price_in") / 1000 + F.col("tokens_out") * F.col("price_out") / 1000, F.lit(0.0))
    c = c.withColumn("cost", cost).withColumn("unpriced", F.when(F.col("price_in").isNull(), 1).otherwise(0))
    return c.groupingSets([["run_id", "stage", "model"], ["run_id", "stage"], ["run_id"]], "run_id", "stage", "model").agg(
        F.count("*").alias("calls"), F.sum("tokens_in").alias("tokens_in"), F.sum("tokens_out").alias("tokens_out"), F.round(F.sum("cost"), 6).alias("cost"), F.sum("unpriced").alias("unpriced"))


def reasons(checks: list[tuple[str, Column]]) -> Column:
    """Names of the conditions that hold, in order: array<string>. A null condition does not hold."""
    return F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in checks]), lambda x: x.isNotNull())


def stage_timings(events: DataFrame) -> DataFrame:
    """Per run and stage: seconds between its first and last event, last message, pages a minute (null without time)."""
    g = events.groupBy("run_id", "stage").agg((F.max(F.unix_micros("ts")) - F.min(F.unix_micros("ts"))).alias("us"), F.max_by("message", F.struct("ts", "seq")).alias("message"), F.max("pages").alias("pages"))
    return g.select("run_id", "stage", (F.col("us") / 1e6).alias("seconds"), "message", "pages", F.when(F.col("us") > 0, F.col("pages") * 60e6 / F.col("us")).alias("pages_per_minute"))
