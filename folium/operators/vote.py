"""Several readings of one page: alignment, votes by line and character, disagreement, and quality of what comes out."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folium.functions.text import corruption_score, strip
from folium.operators.relational import first_per_key

VOTED = "array<struct<text:string,source:string,distance:double>>"


def likeness(a: str, b: str) -> float:
    return SequenceMatcher(None, a, b, autojunk=False).ratio()


def fuse(first: str, second: str, known=frozenset()) -> str:
    """One line of two that differ little: agreement stays, a capital wins over its small letter, a letter over a digit; where two letters differ within a word of four or more, the reading that is a known word wins, else the first. What only one has is kept. Lines of very unlike lengths are not fused: the longer one wins."""
    if not first or not second or first == second:
        return first or second
    if min(len(first), len(second)) < 0.8 * max(len(first), len(second)):
        return max(first, second, key=len)
    out = []
    for tag, i, j, k, m in SequenceMatcher(None, first, second, autojunk=False).get_opcodes():
        a, b = first[i:j], second[k:m]
        if tag != "replace":
            out.append(a or b)
        elif len(a) != len(b):
            out.append(max(a, b, key=len))
        else:
            out += [_letter(first, i + n, x, y, known) for n, (x, y) in enumerate(zip(a, b))]
    return "".join(out)


def _letter(line: str, at: int, x: str, y: str, known) -> str:
    if x.lower() == y.lower():
        return max(x, y, key=str.isupper).upper() if x.isupper() or y.isupper() else x
    if x.isalpha() != y.isalpha() and (x.isdigit() or y.isdigit()):
        return x if x.isalpha() else y
    if known and x.isalpha() and y.isalpha():
        lo, hi = at, at + 1
        while lo and line[lo - 1].isalpha():
            lo -= 1
        while hi < len(line) and line[hi].isalpha():
            hi += 1
        word = line[lo:hi]
        name = at == lo and word[:1].isupper() and word[1:].islower()
        if len(word) >= 4 and not name:
            other = word[: at - lo] + y + word[at - lo + 1 :]
            if (other.lower() in known) > (word.lower() in known):
                return y
    return x


def aligned(engines: dict[str, tuple[list[str], list[float | None]]]) -> list[dict[str, tuple[str, float | None]]]:
    """Rows of lines that belong together: the engine with most characters first, then the others in alphabetical order, each aligned to the longest texts of the rows so far."""
    if not engines:
        return []
    base = max(sorted(engines), key=lambda e: sum(map(len, engines[e][0])))
    rows = [{base: x} for x in zip(*engines[base])]
    for name in sorted(set(engines) - {base}):
        lines = list(zip(*engines[name]))
        spine = [max((t.strip() for t, _ in r.values()), key=len, default="") for r in rows]
        grown: list[dict] = []
        for tag, i, j, k, m in SequenceMatcher(None, spine, [t for t, _ in lines], autojunk=False).get_opcodes():
            old, new = rows[i:j], lines[k:m]
            for n in range(max(len(old), len(new))):
                row = dict(old[n]) if n < len(old) else {}
                row[name] = new[n] if n < len(new) else ("", None)
                grown.append(row)
        rows = grown
    return rows


def choose(row: dict[str, tuple[str, float | None]], spelling: dict[str, float] | None = None, close: float = 0.1, known=frozenset()) -> tuple[str, str, float] | None:
    """(text, source, distance) of a row: none without text; the only one; the reading that two or more share; with three or more and a confidence the surest; two alike within 0.15 fused; else the surest or longest. Spelling (0..1 per engine) weighs 0.3 to confidence's 0.7 in a majority and where the two surest are within `close`."""
    given = [(e, t, c) for e, (t, c) in row.items() if t and t.strip()]
    if len(given) < 2:
        return (given[0][1], given[0][0], 0.0) if given else None
    spelling = spelling or {}
    sure = lambda c: -1.0 if c is None else c
    blend = lambda x: 0.7 * sure(x[2]) + 0.3 * spelling[x[0]] if x[0] in spelling else sure(x[2])

    def surest() -> tuple:
        told = sorted((x for x in given if x[2] is not None), key=lambda x: -x[2])
        if len(told) < 2:
            return max(given, key=lambda x: (sure(x[2]), len(x[1].strip())))
        if not spelling or told[0][2] - told[1][2] >= close:
            return told[0]
        return max(told, key=lambda x: (blend(x), x[2], len(x[1].strip())))

    ratio, pair = 0.0, None
    for n, x in enumerate(given):
        for y in given[n + 1 :]:
            r = likeness(x[1], y[1])
            if r > ratio:
                ratio, pair = r, (x[1], y[1])
    far = 1 - ratio
    same: dict[str, list] = {}
    for x in given:
        same.setdefault(" ".join(x[1].split()), []).append(x)
    group = max(same.values(), key=len)
    if len(group) > 1:
        best = max(group, key=lambda x: (blend(x), sure(x[2]), len(x[1].strip())))
        return best[1], best[0], far
    if (len(given) < 3 or all(c is None for _, _, c in given)) and pair and far <= 0.15:
        return fuse(*pair, known), "fused", far
    best = surest()
    return best[1], best[0], far


def vote_pages(readings: DataFrame, keys: list[str], engine: str, lines: str, confidences: str | None = None) -> DataFrame:
    """One voted text per page: keys, lines (text, source, distance). readings: one row per page and engine with an array of lines (and of confidences). Only a page's few readings meet in a row; Arrow batches."""
    one = F.struct(F.col(engine).alias("e"), F.coalesce(lines, F.array().cast("array<string>")).alias("t"), (F.col(confidences) if confidences else F.lit(None)).cast("array<double>").alias("c"))
    pages = readings.groupBy(*keys).agg(F.array_sort(F.collect_list(one)).alias("r"))

    def run(rs: pd.Series) -> pd.Series:
        def page(r):
            engines = {x["e"]: ([t or "" for t in x["t"]], [None] * len(x["t"]) if x["c"] is None else list(x["c"])) for x in r}
            return [v for v in map(choose, aligned(engines)) if v is not None]

        return rs.map(page)

    return pages.select(*keys, F.pandas_udf(run, VOTED)("r").alias("lines"))


def disagreement(readings: DataFrame, keys: list[str], engine: str, text: str) -> DataFrame:
    """Mean unlikeness of all pairs of a page's readings: keys, pairs, disagreement. Engines of one page are few; pairs come from a join on the page in which the first name is smaller."""
    a, b = (readings.select(*keys, F.col(engine).alias(f"_{x}"), F.coalesce(text, F.lit("")).alias(f"_t{x}")) for x in "ab")
    unlike = F.pandas_udf(lambda x, y: pd.Series([1 - likeness(p, q) for p, q in zip(x, y)], dtype=float), "double")
    return a.join(b, keys).where("_a < _b").groupBy(*keys).agg(F.count("*").alias("pairs"), F.avg(unlike("_ta", "_tb")).alias("disagreement"))


def half_lines(lines: Column, gutter: float, right: bool) -> Column:
    """Lines struct<text, x0, x1> of one half of a spread: those whose centre lies on that side of the gutter; lines without a box belong to both."""
    return F.filter(lines, lambda x: x.x0.isNull() | x.x1.isNull() | (((x.x0 + x.x1) / 2 >= gutter) if right else ((x.x0 + x.x1) / 2 < gutter)))


def without_outliers(readings: DataFrame, keys: list[str], engine: str, text: str, most: float = 0.6) -> DataFrame:
    """Readings without the engine that is unlike all others: with three or more on a page, those whose mean unlikeness to the rest is above `most` go, as long as two stay."""
    t = F.coalesce(text, F.lit(""))
    a, b = readings.select(*keys, F.col(engine).alias("_a"), t.alias("_ta")), readings.select(*keys, F.col(engine).alias("_b"), t.alias("_tb"))
    unlike = F.pandas_udf(lambda x, y: pd.Series([1 - likeness(p, q) for p, q in zip(x, y)], dtype=float), "double")
    far = a.join(b, keys).where("_a != _b").groupBy(*keys, F.col("_a").alias(engine)).agg(F.avg(unlike("_ta", "_tb")).alias("_far"), F.count("*").alias("_n"))
    far = far.where((F.col("_far") > most) & (F.col("_n") >= 2))
    n = far.groupBy(*keys).agg(F.count("*").alias("_gone"), F.max("_n").alias("_rest")).where("_rest + 1 - _gone >= 2").select(*keys)
    return readings.join(far.join(n, keys, "left_semi").select(*keys, engine), [*keys, engine], "left_anti")


def page_source(voted: Column) -> Column:
    """The engine from which most of a page's voted lines come (ties: the first by name)."""
    names = F.array_sort(F.array_distinct(F.transform(voted, lambda v: v.source)))
    counted = F.transform(names, lambda n: F.struct(F.size(F.filter(voted, lambda v: v.source == n)).alias("n"), n.alias("name")))
    best = F.aggregate(counted, F.struct(F.lit(0).alias("n"), F.lit(None).cast("string").alias("name")), lambda a, c: F.when(c.n > a.n, c).otherwise(a))
    return best["name"]


def page_quality(lines: Column, disagree: Column | float = 0.0, dictionary: Column | float = 0.0, confusion: Column | float = 0.0) -> Column:
    """How bad a page's text is: struct<corruption, missing, fragmentation, quality> in 0..1, the highest of weighted signs.

    Missing: no text (1), fewer than five lines (0.4), lines of under ten characters
    on average (0.3), corruption above 0.5 (0.3).  Fragmentation: the share of lines
    under five characters if above 0.15, or of lines that end in a word of one or two
    letters if above 0.2.
    """
    number = lambda x: x if isinstance(x, Column) else F.lit(float(x))
    full = F.filter(lines, lambda t: strip(t) != "")
    n, k = F.size(lines), F.greatest(F.lit(1), F.size(full))
    last = lambda t: F.regexp_replace(F.element_at(F.split(strip(t), r"\s+"), -1), r"^[.,!?;:]+|[.,!?;:]+$", "")
    short = F.size(F.filter(full, lambda t: F.length(strip(t)) < 5)) / k
    cut = F.size(F.filter(full, lambda t: last(t).rlike(r"^\p{L}{1,2}$"))) / k
    fragments = F.greatest(F.when(short > 0.15, short).otherwise(0.0), F.when(cut > 0.2, cut).otherwise(0.0))
    corrupt = corruption_score(F.array_join(lines, "\n"))
    mean = F.aggregate(lines, F.lit(0), lambda a, t: a + F.length(t)) / F.greatest(F.lit(1), n)
    missing = F.when(F.size(full) == 0, 1.0).otherwise(0.0) + F.when(n < 5, 0.4).otherwise(0.0) + F.when(mean < 10, 0.3).otherwise(0.0) + F.when(corrupt > 0.5, 0.3).otherwise(0.0)
    missing = F.least(missing, F.lit(1.0))
    quality = F.greatest(number(disagree) * 0.3, corrupt * 0.25, missing * 0.25, fragments * 0.2, number(dictionary) * 0.25, number(confusion) * 0.2)
    return F.struct(corrupt.alias("corruption"), F.round(missing, 4).alias("missing"), F.round(fragments, 4).alias("fragmentation"), F.round(quality, 4).alias("quality"))


#: Short words that are no fragments (fixed values).
SHORT_WORDS = "a i to of in it is be as at he we so do if my me up go no us am an or by on".split()


def without_fragments(lines: Column, least: int = 4, share: float = 0.5) -> Column:
    """Lines without the fragments at their end: at least three in a row, and at least `share` of all fragments. A fragment has under `least` characters and is no number, no capitals of one or two letters and no short word. Fewer than five lines stay as they are."""

    def fragment(t: Column) -> Column:
        s = strip(t)
        return (s != "") & (F.length(s) < least) & ~s.rlike("^[0-9]+$") & ~s.rlike(r"^\p{Lu}{1,2}$") & ~F.lower(s).isin(*SHORT_WORDS)

    flags = F.transform(lines, fragment)
    whole = F.array_position(F.reverse(flags), F.lit(False)).cast("int")
    tail = F.when(whole == 0, F.size(lines)).otherwise(whole - 1)
    all_ = F.size(F.filter(flags, lambda x: x))
    cut = (F.size(lines) >= 5) & (tail >= 3) & (tail >= share * F.greatest(all_, F.lit(1)))
    return F.when(cut, F.slice(lines, F.lit(1), F.size(lines) - tail)).otherwise(lines)


def best_reading(readings: DataFrame, keys: list[str], score: Column, engine: str, preferred: list[str], chars: str, least: int, ordinal: str) -> DataFrame:
    """The reading of each page with the lowest score among those of at least `least` characters (any, if none has so many); ties go by the preferred engines, then others, then the ordinal. A null score is the worst."""
    place = F.coalesce(F.array_position(F.array(*[F.lit(p) for p in preferred]), F.col(engine)), F.lit(0))
    order = [F.when(F.coalesce(chars, F.lit(0)) >= least, 0).otherwise(1), F.coalesce(score, F.lit(float("inf"))), F.when(place == 0, len(preferred) + 1).otherwise(place), F.col(ordinal)]
    return first_per_key(readings, keys, order)
