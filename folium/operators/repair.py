"""Repairs of pages: paragraphs from lines, suspicious and continued table rows, running heads, absorbed subsections."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folium.functions.text import collapse
from folium.operators.relational import islands_by, same_keys

# ---------------------------------------------------------------- paragraphs

_NUMBER = re.compile(r"[0-9]{1,3}")
_GLITCH = re.compile(r"[0-9\s\-.:'\"oOlIiBbGgSsZz%]{1,6}")
_STATS = re.compile(r"(?i)skill\s+stamina|\S.{3,48}?\s+[0-9]+\s+[0-9]+")


def section_head(text: str) -> bool:
    """A number of one to three digits, or up to six signs that misreading makes of one, with a digit."""
    bare = "".join(text.split())
    return bool(_NUMBER.fullmatch(text.strip())) or bool(_GLITCH.fullmatch(bare) and any(map(str.isdigit, bare)))


def fragmented(lines: list[str]) -> bool:
    """At least five lines, and over half of them under ten characters, under 20 on average, or over 0.3 of them going on with a small letter without a stop."""
    full = [t.strip() for t in lines if t and t.strip()]
    if len(full) < 5:
        return False
    on = sum(a[-1] not in ".!?:;" and b[0].islower() for a, b in zip(full, full[1:]))
    return sum(len(t) < 10 for t in full) > 0.5 * len(full) or sum(map(len, full)) < 20 * len(full) or on > 0.3 * (len(full) - 1)


def joined_lines(lines: list[str]) -> str:
    """Lines in a row; a word broken at a hyphen is one again (a double hyphen is a dash)."""
    out = ""
    for t in lines:
        if out.endswith("-") and not out.endswith("--") and t[:1].isalpha():
            out = out[:-1] + t
        else:
            out = f"{out} {t}" if out else t
    return " ".join(out.split())


def paragraphs(lines: list[str | None]) -> list[str]:
    """Coherent paragraphs of a page's lines: section numbers and rows of stats stand alone, the rest up to the next of them is one paragraph. Empty lines part paragraphs only before the first section. The lines of a page in fragments stay lines."""
    texts = [(t or "").strip() for t in lines]
    if fragmented(texts):
        return [t for t in texts if t]
    out: list[str] = []
    held: list[str] = []
    inside = False

    def flush():
        if held:
            out.append(joined_lines(held))
            held.clear()

    for t in texts:
        head = bool(t) and section_head(t)
        if head or (t and _STATS.fullmatch(t)):
            flush()
            out.append(t)
            inside |= head
        elif t:
            held.append(t)
        elif not inside:
            flush()
    flush()
    return out


def reconstructed(lines: Column) -> Column:
    """paragraphs() of an array of lines (Arrow batches)."""
    return F.pandas_udf(lambda s: s.map(lambda x: paragraphs([] if x is None else list(x))), "array<string>")(lines)


_RANGE = re.compile(r"[0-9OoIlSB]{1,3}\s*[-–]\s*[0-9OoIlSB]{1,3}")
_NUMBERISH = re.compile(r"[0-9OoIlSB]*[0-9][0-9OoIlSB]*[.,:;)]?")
_RULE = set("—-_~*·.")


def without_section_numbers(text: str | None, section: str | None = None) -> str | None:
    """A text without lines of numbers only, the numbers before its first line's words, and lines of signs only; the other lines stand as paragraphs, blank ones at most singly.

    Before the first line's words go: the section's own number, ranges, numbers that
    a number follows or precedes, and mixtures of up to four signs that begin with a
    figure.
    """
    if not text:
        return text
    lines = [t.rstrip() for t in text.splitlines() if not re.fullmatch(r"\s*[0-9]{1,4}(\s*[-–]\s*[0-9]{1,4})?\s*", t)]
    at = next((i for i, t in enumerate(lines) if t.strip()), None)
    if at is not None:
        words, gone = lines[at].split(), 0
        while words:
            w = words[0]
            mixed = w[0].isdigit() and any(map(str.isalpha, w)) and len(w) <= 4
            number = bool(_NUMBERISH.fullmatch(w)) and (gone > 0 or len(words) > 1 and bool(_NUMBERISH.fullmatch(words[1])))
            if not (section and section.isdigit() and re.sub(r"\D", "", w) == section or _RANGE.fullmatch(w) or number or mixed):
                break
            words.pop(0)
            gone += 1
        lines[at] = " ".join(words)
    out: list[str] = []
    for t in lines:
        bare = t.strip()
        signs = bare and set(bare) <= _RULE or len(bare) >= 12 and sum(map(str.isalpha, bare)) < 0.35 * len(bare)
        if not signs and (bare or out and out[-1]):
            out.append(t if bare else "")
    while out and not out[-1]:
        out.pop()
    return "\n\n".join(out)


# ---------------------------------------------------------------- tables

#: Months as tables abbreviate them (fixed values).
MONTHS = r"\b(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Sept|Oct|Nov|Dec)\.?\b"


def suspect_signs(text: Column, broken: Column | None = None) -> Column:
    """How many signs (0 to 2) a cell shows of two cells run together: names or figures without a blank between, and more than one date (not where a line break parts them)."""
    t = F.coalesce(text, F.lit(""))
    fused = t.rlike(r"\b[A-Z][a-z]{2,}[A-Z][a-z]{2,}\b") | t.rlike("[0-9][A-Z]") | t.rlike("[0-9]{4}[A-Za-z]")
    dates = (F.regexp_count(t, F.lit(MONTHS)) >= 2) | (F.regexp_count(t, F.lit(r"\b[0-9]{4}\b")) >= 2)
    if broken is not None:
        dates = dates & ~broken
    return fused.cast("int") + dates.cast("int")


def table_reasons(rows: Column, cells: Column, suspects: Column) -> Column:
    """Why a page's tables want another reading: all cells in one row (six or more), or two suspicious signs and more."""
    return F.filter(F.array(F.when((rows <= 1) & (cells >= 6), F.lit("one_row")), F.when(suspects >= 2, F.lit("run_together"))), lambda x: x.isNotNull())


_DATE = re.compile(r"[0-9]{4}|[0-9]{1,2}[./-][0-9]{1,2}")


def continued_rows(table: list[list[str]]) -> tuple[list[list[str]], int]:
    """A table (first row: heads) in which a date of death that stands one row too high moves down: (rows, moves).

    A row goes on with the one before if name, born and married are empty and a
    spouse is there; the date moves if the row before has it and boys or girls, and
    this one neither.  Rows are worked from the top, so a moved date may move on.
    """
    if not table:
        return table, 0
    at = {h.strip().lower(): i for i, h in enumerate(table[0])}
    if any(k not in at for k in ("name", "spouse", "died")):
        return table, 0
    rows, moves = [list(r) for r in table], 0
    cell = lambda r, k: r[at[k]].strip() if k in at and at[k] < len(r) else ""
    for above, row in zip(rows[1:], rows[2:]):
        if max(at["name"], at["spouse"], at["died"]) >= min(len(above), len(row)):
            continue
        goes_on = cell(row, "spouse") and not any(cell(row, k) for k in ("name", "born", "married", "died"))
        children = lambda r: cell(r, "boy") or cell(r, "girl")
        if goes_on and _DATE.search(cell(above, "died")) and children(above) and not children(row):
            row[at["died"]], above[at["died"]] = above[at["died"]], ""
            moves += 1
    return rows, moves


def continued_tables(html: Column) -> Column:
    """continued_rows of each table of a page's HTML: array of tables, each an array of rows of cells (Arrow batches)."""
    from folium.operators.scoring import tables_of

    return F.pandas_udf(lambda s: s.map(lambda x: [continued_rows(t)[0] for t in tables_of(x)]), "array<array<array<string>>>")(html)


# ---------------------------------------------------------------- heads and subsections


def title_key(x: Column) -> Column:
    """A title for comparison: lower case, letters, digits, hyphens and blanks only."""
    return collapse(F.regexp_replace(F.lower(collapse(x)), r"[^\p{L}\p{M}\p{N}_\s-]", ""))


def promoted_heads(heads: DataFrame, headings: DataFrame, run: str, page: str, ordinal: str, most: int = 2) -> DataFrame:
    """What becomes of running heads: run, page, ordinal, action ('promote' or 'remove') and reason.

    heads: run, page, ordinal, text, leading (the first block of its page); headings:
    run, page, level (1 to 6), text.  A leading head becomes the page's title if its
    key heads no page of the run as h1 or h2, occurs at most `most` times as a head
    there, and its page has no h1 and not only lower headings.  Counts and keys by
    aggregations over the run; a null text has an empty key.
    """
    h = heads.withColumn("_key", F.coalesce(title_key(F.col("text")), F.lit("")))
    times = h.where("_key != ''").groupBy(run, "_key").agg(F.count("*").alias("_times"))
    taken = headings.where("level <= 2").select(run, title_key(F.col("text")).alias("_key")).where("_key != ''").distinct().withColumn("_taken", F.lit(True))
    level = lambda n: F.max(F.when(F.col("level") == n, True).otherwise(False))
    pages = headings.groupBy(run, page).agg(level(1).alias("_h1"), level(2).alias("_h2"), level(3).alias("_h3"))
    d = h.join(times, [run, "_key"], "left").join(taken, [run, "_key"], "left").join(pages, [run, page], "left").fillna(False, ["_taken", "_h1", "_h2", "_h3"])
    reason = (
        F.when(~F.col("leading"), "not_leading").when(F.col("_key") == "", "empty").when(F.col("_taken"), "is_a_heading").when(F.col("_times") > most, "repeated").when(F.col("_h1"), "page_has_title")
        .when(F.col("_h3") & ~F.col("_h2"), "only_lower_headings").otherwise("unique")
    )
    return d.select(run, page, ordinal, F.when(reason == "unique", "promote").otherwise("remove").alias("action"), reason.alias("reason"))


def absorbed(boundaries: DataFrame, keys: list[str], order: str, ties: tuple[str, ...], parent: Column, child: Column) -> DataFrame:
    """Boundaries without the subsections of a parent: a run of successive children directly after a parent (or after a child that was not absorbed and is a parent itself) belongs to it. Ordered by a whole number and ties."""
    d = boundaries.withColumn("_parent", F.coalesce(parent, F.lit(False))).withColumn("_at", F.struct(order, *ties))
    g = islands_by(d, keys, order, ~F.coalesce(child, F.lit(False)), ties)
    first = g.where("_parent").groupBy(*keys, "island").agg(F.min("_at").alias("_first"))
    return same_keys(g, first, [*keys, "island"]).where("_first IS NULL OR _at <= _first").drop("_parent", "_at", "_first", "island")


def first_of(inputs: list[DataFrame], ident: str, ordinal: str, prefix: str | None = None) -> DataFrame:
    """Union of inputs in their order, the first row of each id kept (rows without an id all); with a prefix the kept rows are renumbered prefix001, prefix002 and so on in that order (numbers by counts of partitions of ids, no row meets all others)."""
    from functools import reduce

    from folium.operators.relational import first_per_key

    tagged = reduce(DataFrame.unionByName, [d.withColumn("_p", F.lit(i)) for i, d in enumerate(inputs)])
    kept = first_per_key(tagged.where(F.col(ident).isNotNull()), [ident], [F.col("_p"), F.col(ordinal)]).unionByName(tagged.where(F.col(ident).isNull()))
    if prefix is None:
        return kept.drop("_p")
    block = F.floor(F.col(ordinal) / 65536)
    size = kept.groupBy("_p", block.alias("_b")).agg(F.count("*").alias("_n"))
    base = size.withColumn("_base", F.coalesce(F.sum("_n").over(Window.orderBy("_p", "_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")  # one row per 65,536 ordinals
    n = F.row_number().over(Window.partitionBy("_p", "_b").orderBy(ordinal))
    return kept.withColumn("_b", block).withColumn("_i", n).join(base, ["_p", "_b"]).withColumn(ident, F.format_string(prefix + "%03d", F.col("_base") + F.col("_i"))).drop("_p", "_b", "_i", "_base")
