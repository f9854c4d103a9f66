"""What kind of element a piece of text is, by its look: ordered rules over columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folium.functions.text import STAT_KEYS, key_values, strip

#: Layout roles that a recogniser may give and the class of each (fixed values).
ROLES = {
    "TITLE": "Title", "HEADING": "Section-header", "SECTION_HEADER": "Section-header", "SECTION-HEADER": "Section-header", "HEADER": "Page-header", "FOOTER": "Page-footer",
    "PAGE_HEADER": "Page-header", "PAGE_FOOTER": "Page-footer", "LIST": "List-item", "LIST_ITEM": "List-item", "LIST-ITEM": "List-item", "TABLE": "Table", "FIGURE": "Picture",
    "PICTURE": "Picture", "CAPTION": "Caption", "FOOTNOTE": "Footnote", "FORMULA": "Formula", "LAYOUT_TITLE": "Title", "LAYOUT_SECTION_HEADER": "Section-header",
    "LAYOUT_HEADER": "Page-header", "LAYOUT_FOOTER": "Page-footer", "LAYOUT_LIST": "List-item", "LAYOUT_TABLE": "Table", "LAYOUT_FIGURE": "Picture", "LAYOUT_TEXT": "Text",
}


def count_of(t: Column, pattern: str) -> Column:
    return F.regexp_count(t, F.lit(pattern))


def lone_number(t: Column) -> Column:
    """The number of up to three digits that a text is, else null."""
    return F.regexp_extract(t, r"^\s*([0-9]{1,3})\s*$", 1).try_cast("int")


def page_range(t: Column) -> Column:
    return t.rlike(r"^[0-9]{1,3}\s*[-–]\s*[0-9]{1,3}\s*$")


def contents_line(t: Column) -> Column:
    """Dots or wide blanks before a number at the end, at most 120 characters."""
    return (F.length(t) <= 120) & (t.rlike(r"\.{3,}\s*[0-9]+\s*$") | (t.rlike(r"\s{2,}[0-9]+\s*$") & t.rlike("[A-Za-z]")))


def list_item(t: Column) -> Column:
    """Begins with a bullet, a number or a letter with a mark after it."""
    return t.rlike("^(?:[-*\u2022\u00b7]|\\(?[0-9]{1,3}[).]|\\(?[a-zA-Z][).])\\s+\\S")


def stat_block(t: Column) -> Column:
    """Stats of combat: SKILL and STAMINA, each with a number."""
    u = F.upper(t)
    return u.rlike(r"\bSKILL\s*[0-9]{1,2}\b") & u.rlike(r"\bSTAMINA\s*[0-9]{1,2}\b")


def table_line(t: Column) -> Column:
    """A row of cells: bars, three parts with wide blanks between, a name with two numbers, or many digits with wide blanks."""
    named = F.length(F.trim(F.regexp_extract(t, r"^(.+?)\s+[0-9]+\s+[0-9]+\s*$", 1)))
    stats = F.upper(t).rlike(r"^SKILL\s+STAMINA\s*$") | (named.between(5, 50) & F.regexp_extract(t, r"^(.+?)\s+[0-9]+\s+[0-9]+\s*$", 1).rlike("[A-Za-z]"))
    cells = F.size(F.filter(F.split(t, r"\s{2,}"), lambda x: F.trim(x) != "")) >= 3
    figures = (count_of(t, "[0-9]") >= 6) & (count_of(t, r"\p{L}") >= 3) & t.rlike(r"\s{2,}")
    return ~stat_block(t) & (stats | (count_of(t, r"\|") >= 2) | cells | figures)


def caption_line(t: Column) -> Column:
    return (F.length(t) <= 120) & t.rlike(r"(?i)^(fig\.?|figure|table|illustration)\s+[0-9]+")


def formula_line(t: Column) -> Column:
    """Arithmetic, an equation with a digit or an operator, or a comparison with a digit; at most 80 characters."""
    minus = t.rlike(r"\b[0-9]+\s+-\s+[0-9]+\b")
    equation = t.contains("=") & (t.rlike("[0-9]") | t.rlike(r"[+*/^]") | minus) & t.rlike(r"\b\w+\s*=\s*\w+")
    return (F.length(t) <= 80) & (t.rlike(r"\b[0-9]+\s*[+*/]\s*[0-9]+\b") | minus | equation | (t.rlike("[≈≠≤≥]") & t.rlike("[0-9]")))


def capital_heading(t: Column) -> Column:
    """At least four letters, nine tenths capitals, at most 60 characters, no equals sign."""
    letters = count_of(t, r"\p{L}")
    return ~t.contains("=") & (F.length(t) <= 60) & (letters >= 4) & (count_of(t, r"\p{Lu}") >= 0.9 * letters)


def element_class(kind: Column, text: Column, align: Column, role: Column) -> Column:
    """struct<label, confidence, source_role, form_field, combat_stats, number> of an element; the first rule that holds decides.

    A recogniser's role wins; then the kind (image, table); then for texts form
    fields, stat blocks, lone numbers up to 600, tables, contents and list items,
    captions, formulas, centred or capital headings; else Text.
    """
    t = strip(F.coalesce(text, F.lit("")))
    roles = F.create_map(*[F.lit(v) for kv in ROLES.items() for v in kv])
    named = F.try_element_at(roles, F.replace(F.upper(strip(role)), F.lit(" "), F.lit("_")))
    number = lone_number(t)

    def out(label, confidence: float, form: bool = False, stats: bool = False, n: Column | None = None, source: Column | None = None) -> Column:
        return F.struct((label if isinstance(label, Column) else F.lit(label)).alias("label"), F.lit(confidence).alias("confidence"), (source if source is not None else F.lit(None)).cast("string").alias("source_role"), F.lit(form).alias("form_field"), F.lit(stats).alias("combat_stats"), (n if n is not None else F.lit(None)).cast("int").alias("number"))

    field = t.contains("=") & ~t.rlike("[0-9]") & (F.length(t) <= 80) & t.rlike("[A-Za-z]")
    heading = ((F.coalesce(align, F.lit("")) == "center") & (F.length(t) <= 50)) | capital_heading(t)
    return (
        F.when(named.isNotNull(), out(named, 0.95, source=role)).when(kind == "image", out("Picture", 0.9)).when(kind == "table", out("Table", 0.9)).when(F.coalesce(kind, F.lit("")) != "text", out("Text", 0.4))
        .when(t == "", out("Text", 0.0)).when(field & t.rlike(r"^[A-Za-z][A-Za-z\s]{1,30}\s*=\s*$"), out("Text", 0.75, form=True)).when(field, out("Text", 0.7, form=True)).when(stat_block(t), out("Text", 0.8, stats=True))
        .when(number.between(1, 600), out("Section-header", 0.9, n=number)).when(table_line(t), out("Table", 0.85)).when(contents_line(t) | list_item(t), out("List-item", 0.85)).when(caption_line(t), out("Caption", 0.8))
        .when(formula_line(t), out("Formula", 0.75)).when(heading & (F.length(t) <= 30), out("Title", 0.75)).when(heading, out("Section-header", 0.75)).otherwise(out("Text", 0.6))
    )


def known_pairs(text: Column, allow_unknown: bool = False) -> Column:
    """Key/value pairs of a line, those with unknown keys left out unless allowed; null without any."""
    kv = key_values(text)
    pairs = kv.pairs if allow_unknown else F.filter(kv.pairs, lambda p: p.key.isin(*STAT_KEYS))
    return F.when(F.size(pairs) > 0, F.struct(kv.entity.alias("entity"), pairs.alias("pairs")))
