"""Scalar text expressions: Columns in, Columns out, all inside generated code.

Patterns carry (?U) so that \\s, \\w and \\d are Unicode as in the formats' origin.
Null texts give null unless a docstring says otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def collapse(x) -> Column:
    """Runs of white space become one blank; none at the ends."""
    return F.trim(F.regexp_replace(_c(x), r"(?U)\s+", " "))


def slug(x, sep: str = "-") -> Column:
    """Lower-case ASCII letters and digits joined by sep; 'untitled' if nothing is left."""
    s = F.regexp_replace(F.lower(_c(x)), r"[^a-z0-9]+", sep)
    s = F.regexp_replace(s, f"^{sep}+|{sep}+$", "")
    return F.when(s == "", "untitled").otherwise(s)


def block_kind(block_type) -> Column:
    """Kind of a block from its tag."""
    t = F.lower(_c(block_type))
    return (
        F.when(t.isin("h1", "h2", "h3", "h4", "h5", "h6"), "heading").when(t == "li", "list_item").when(t.isin("table", "tr", "td", "th"), "table")
        .when(t.isin("img", "figure"), "figure").when(t.isin("figcaption", "caption"), "caption").when(t.startswith("/"), "close").otherwise("paragraph")
    )


def alpha_ratio(x) -> Column:
    n = F.length(_c(x))
    return F.when(n > 0, F.length(F.regexp_replace(_c(x), r"[^A-Za-z]", "")) / n).otherwise(0.0)


#: Letters of any script, and white space of any kind, as Python, Java and RE2 read them alike.
_BLANK = r"\s\p{Z}\x{85}\x{1c}-\x{1f}"


def strip(x) -> Column:
    """A text without white space at its ends."""
    return F.regexp_replace(_c(x), rf"^[{_BLANK}]+|[{_BLANK}]+$", "")


def text_quality(x) -> Column:
    """0.5 letters' share + 0.3 share of tokens with a vowel (y is one) + 0.2 min(tokens / 40, 1), within 0..1; tokens begin with a letter and have three characters or more of letters, apostrophes and hyphens. 0 for a null text or one without tokens."""
    t = F.coalesce(_c(x), F.lit(""))
    token = "[A-Za-z][A-Za-z'’-]{2,}"
    n = F.regexp_count(t, F.lit(token))
    voiced = F.size(F.filter(F.regexp_extract_all(t, F.lit(f"({token})"), F.lit(1)), lambda w: w.rlike("[aeiouyAEIOUY]")))
    visible = F.length(F.regexp_replace(t, rf"[{_BLANK}]+", ""))
    alpha = F.length(F.regexp_replace(t, r"\P{L}+", "")) / F.greatest(visible, F.lit(1))
    score = 0.5 * alpha + 0.3 * (voiced / F.greatest(n, F.lit(1))) + 0.2 * F.least(n / 40.0, F.lit(1.0))
    return F.when(n == 0, 0.0).otherwise(F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0)))


def looks_truncated(x, least: int = 50) -> Column:
    """A text of some length that stops neither on one of . ! ? ; ' nor on a capital; an ellipsis is a stop."""
    t = strip(x)
    last = F.substring(t, -1, 1)
    return F.coalesce((F.length(t) >= least) & ~t.endswith("...") & ~last.isin(".", "!", "?", ";", "'") & ~last.rlike(r"\p{Lu}"), F.lit(False))


def fix_numeric_token(x) -> Column:
    """Digits restored in a short token that is mostly digits: O to 0, l and I to 1, S to 5, B to 8, then punctuation off; others stay."""
    t = _c(x)
    digits = F.length(F.regexp_replace(t, "[^0-9]", ""))
    fixed = F.regexp_replace(F.translate(t, "OoIlSB", "001158"), r"[^0-9]", "")
    return F.when((F.length(t) <= 6) & (digits * 2 >= F.length(t)) & (digits > 0), fixed).otherwise(t)


def leading_int(x) -> Column:
    """Leading digits as a number ('12L' gives 12), else null."""
    return F.expr("try_cast(nullif(regexp_extract({0}, '^\\\\s*([0-9]+)', 1), '') AS bigint)".format(x)) if isinstance(x, str) else F.regexp_extract(x, r"^\s*([0-9]+)", 1).try_cast("bigint")


def whole_int(x) -> Column:
    """A number if the whole text is digits, else null."""
    t = F.trim(_c(x))
    return F.when(t.rlike("^[0-9]+$"), t.try_cast("bigint"))


def is_section_number(x, low: int = 1, high: int = 999) -> Column:
    """One to three digits, or that after mending a few misread ones, within the range."""
    t = F.trim(_c(x))
    n = F.when(F.length(t) <= 3, F.regexp_replace(F.translate(t, "OoIl", "0011"), r"^(?![0-9]+$).*$", "")).try_cast("bigint")
    return F.coalesce(n.between(low, high), F.lit(False))


def turn_targets(x, low: int = 1, high: int = 999) -> Column:
    """Distinct numbers named by 'turn to N', in order, within the range."""
    found = F.expr(f"regexp_extract_all({x}, '(?i)turn\\\\s+to\\\\s+([0-9]{{1,3}})', 1)") if isinstance(x, str) else F.regexp_extract_all(x, F.lit(r"(?i)turn\s+to\s+([0-9]{1,3})"), F.lit(1))
    return F.array_distinct(F.filter(F.transform(found, lambda s: s.cast("bigint")), lambda n: n.between(low, high)))


def numbered_targets(x) -> Column:
    """All numbers of one to three digits in a text, in order, once each."""
    return F.array_distinct(F.transform(F.regexp_extract_all(_c(x), F.lit(r"\b([0-9]{1,3})\b"), F.lit(1)), lambda s: s.cast("bigint")))


def toc_entry(x) -> Column:
    """A contents line 'title ..... 12' or 'title  12': struct<title, page>; null if it is none."""
    pattern = r"^\s*(.*?\S)\s*(?:\.{2,}|…+|(?:\s*\.\s){2,}\.?|\s{2,})\s*([0-9]{1,4})\s*$"
    title, page = F.regexp_extract(_c(x), pattern, 1), F.regexp_extract(_c(x), pattern, 2)
    return F.when(page != "", F.struct(title.alias("title"), page.cast("bigint").alias("page")))


#: Stat keys of combat blocks and forms (fixed values).
STAT_KEYS = ("SKILL", "STAMINA", "LUCK")


def key_values(x) -> Column:
    """What a line assigns: struct<entity, pairs: array<struct<key, value>>>, null if nothing.

    A line with SKILL and STAMINA gives the stats that a number follows, and the
    capitals before SKILL as entity; else 'Key = 12' or 'Key: 12' alone gives one
    pair, 'Key =' one without a value.
    """
    t = strip(x)
    u = F.upper(t)
    number = lambda k: F.regexp_extract(u, rf"\b{k}\s+([0-9]{{1,3}})\b", 1)
    pair = lambda k, v: F.struct(k.alias("key"), v.cast("int").alias("value"))
    none = F.lit(None).cast("struct<key:string,value:int>")
    stats = F.filter(F.array(*[F.when(number(k) != "", pair(F.lit(k), F.nullif(number(k), F.lit("")))).otherwise(none) for k in STAT_KEYS]), lambda p: p.isNotNull())
    entity = F.nullif(collapse(F.regexp_extract(u, r"\b([A-Z][A-Z' -]{2,30})\s+SKILL\s+[0-9]{1,3}\b", 1)), F.lit(""))
    line = r"^([A-Za-z][A-Za-z ]{1,24})\s*[:=]\s*([0-9]{1,4})?\s*$"
    key = F.upper(collapse(F.regexp_extract(t, line, 1)))
    one = F.array(pair(key, F.nullif(F.regexp_extract(t, line, 2), F.lit(""))))
    out = lambda e, p: F.struct(e.cast("string").alias("entity"), p.alias("pairs"))
    return F.when(u.contains("SKILL") & u.contains("STAMINA") & (F.size(stats) > 0), out(entity, stats)).when(key != "", out(F.lit(None), one))


def private_text(x) -> Column:
    """Null for what may name a place on somebody's machine or net (addresses, paths, file names), else the text."""
    t = _c(x)
    bad = t.rlike(r"(?i)(https?://|file://|www\.)|(^|\s)(/[\w.-]+){2,}|[A-Z]:\\|\\\\|\.(pdf|docx?|xlsx?|pptx?|epub|html?|zip|png|jpe?g)\b")
    return F.when(~bad, t)


INPUT_KINDS = {"pdf": "pdf", "docx": "docx", "xlsx": "xlsx", "pptx": "pptx", "epub": "epub", "eml": "email", "mbox": "mailbox", "html": "html", "htm": "html", "zip": "archive", "png": "image", "jpg": "image", "jpeg": "image", "tif": "image", "tiff": "image", "txt": "text", "md": "text"}


def input_kind(path) -> Column:
    """Kind of input from a path's ending; 'folder' without one, 'unknown' for others."""
    name = F.element_at(F.split(F.lower(_c(path)), "[/\\\\]"), -1)
    ext = F.regexp_extract(name, r"\.([a-z0-9]+)$", 1)
    kinds = F.create_map(*[F.lit(v) for kv in INPUT_KINDS.items() for v in kv])
    return F.when(ext == "", "folder").otherwise(F.coalesce(F.element_at(kinds, ext), F.lit("unknown")))


def natural_key(x) -> Column:
    """Sort key of a file name: (has no digits, its numbers, lower-case name)."""
    numbers = F.transform(F.regexp_extract_all(_c(x), F.lit("([0-9]+)"), F.lit(1)), lambda s: s.cast("bigint"))
    return F.struct((F.size(numbers) == 0).alias("plain"), numbers.alias("numbers"), F.lower(_c(x)).alias("name"))


def chunks(x, size: int) -> Column:
    """Paragraphs of a text, each cut into pieces of at most `size` characters: array<string>."""
    parts = F.filter(F.transform(F.split(_c(x), r"\n+"), lambda p: F.trim(p)), lambda p: p != "")
    return F.flatten(F.transform(parts, lambda p: F.transform(F.sequence(F.lit(0), F.floor((F.length(p) - 1) / size)), lambda i: F.substring(p, (i * size + 1).cast("int"), F.lit(size)))))


def join_hyphens(x) -> Column:
    """'exam-' at a line's end and 'ple' on the next become one word; other line ends become blanks."""
    return collapse(F.regexp_replace(_c(x), r"(?U)(\p{L})[-\x{2010}\x{ad}\x{ac}]\s*\n\s*(\p{Ll})", "$1$2"))


def strip_number_lines(x) -> Column:
    """A text without lines that are only a number or a range of numbers."""
    lines = F.filter(F.split(_c(x), "\n"), lambda t: ~F.trim(t).rlike(r"^[0-9]{1,4}(\s*[-–]\s*[0-9]{1,4})?$"))
    return F.array_join(lines, "\n")


def ocr_metadata(html) -> Column:
    """The ocr-metadata tag among the first five lines of a page: struct<quality, integrity, risk (each clamped to 0..1), line (from 0), warning (not on the first line), rest (the page without the tag)>; null without one."""
    lines = F.split(F.regexp_replace(F.coalesce(_c(html), F.lit("")), r"^\s+", ""), r"\r\n|\r|\n")
    hit = F.transform(F.slice(lines, 1, 5), lambda t: F.trim(t).rlike(r"(?i)^<meta.*\bname\s*=\s*['\"]ocr-metadata['\"]"))
    at = F.array_position(hit, F.lit(True)).cast("int")
    tag = F.try_element_at(lines, at)

    def number(key: str) -> Column:
        v = F.regexp_extract(tag, rf"(?i)\b{key}\s*=\s*[\"']([^\"']+)[\"']", 1).try_cast("double")
        return F.when(v.isNotNull(), F.least(F.greatest(v, F.lit(0.0)), F.lit(1.0)))

    rest = F.array_join(F.filter(lines, lambda t, i: i != at - 1), "\n")
    out = F.struct(number("data-ocr-quality").alias("quality"), number("data-ocr-integrity").alias("integrity"), number("data-continuation-risk").alias("risk"), (at - 1).alias("line"), F.when(at > 1, F.concat(F.lit("ocr_metadata_not_first_line:"), (at - 1).cast("string"))).alias("warning"), rest.alias("rest"))
    return F.when(at > 0, out)


def printed_number(blocks, page) -> Column:
    """struct<number, text> of a page's printed number: of the last paragraph marked as one, else of the last paragraph that is one to four figures or a roman number; of its numbers the page's own if it is among them, else the last. Null without either."""
    marked = F.filter(blocks, lambda b: F.element_at(b.attrs, F.lit("class")) == "page-number")
    lone = F.filter(blocks, lambda b: (b.block_type == "p") & F.lower(F.trim(b.text)).rlike("^([0-9]{1,4}|[ivxlcdm]+)$"))
    text = F.trim(F.when(F.size(marked) > 0, F.try_element_at(marked, F.lit(-1)).text).otherwise(F.try_element_at(lone, F.lit(-1)).text))
    digits = F.transform(F.regexp_extract_all(text, F.lit("([0-9]+)"), F.lit(1)), lambda d: d.try_cast("bigint"))
    number = F.when(F.array_contains(digits, _c(page).cast("bigint")), _c(page).cast("bigint")).otherwise(F.try_element_at(digits, F.lit(-1)))
    return F.when(text.isNotNull(), F.struct(number.alias("number"), text.alias("text")))


def choices(x, low: int = 1, high: int = 400) -> Column:
    """'turn to N' of a text, the first for each target within the range: array<struct<target, snippet>>; the snippet has 60 characters before the phrase and 20 after it."""
    t = F.coalesce(_c(x), F.lit(""))
    phrase = r"(?i)turn to\s+[0-9]{1,3}"
    said = F.regexp_extract_all(t, F.lit(f"({phrase})"), F.lit(1))
    between = F.split(t, phrase)
    upto = lambda i: F.aggregate(F.sequence(F.lit(1), i), F.lit(""), lambda a, k: F.concat(a, F.element_at(between, k), F.when(k < i, F.element_at(said, k)).otherwise("")))

    def one(m: Column, k: Column) -> Column:
        before = upto(k + 1)
        after = F.substr(t, F.length(before) + F.length(m) + 1, F.lit(20))
        return F.struct(F.regexp_extract(m, "([0-9]{1,3})$", 1).alias("target"), F.trim(F.concat(F.right(before, F.lit(60)), m, after)).alias("snippet"))

    found = F.filter(F.transform(said, one), lambda c: c.target.cast("int").between(low, high))
    return F.filter(found, lambda c, i: F.array_position(F.transform(found, lambda d: d.target), c.target) == i + 1)


def natural_pieces(x) -> Column:
    """Sort key of alternating texts and numbers: array<struct<number, text>>, numbers before texts at the same place."""
    return F.transform(F.regexp_extract_all(F.lower(_c(x)), F.lit("([0-9]+|[^0-9]+)"), F.lit(1)), lambda p: F.struct(p.try_cast("bigint").alias("number"), F.when(p.rlike("^[0-9]"), "").otherwise(p).alias("text")))


def table_stats(html) -> Column:
    """Counts of table, tr and td tags and of 'turn to' in a page's HTML, and whether its tables look collapsed (many cells in few rows)."""
    t = _c(html)
    n = lambda p: F.regexp_count(t, F.lit(p))
    tables, rows, cells = n("(?i)<table"), n("(?i)<tr"), n("(?i)<t[dh]")
    return F.struct(tables.alias("tables"), rows.alias("rows"), cells.alias("cells"), n(r"(?i)turn\s+to").alias("turns"), ((tables > 0) & (rows <= tables) & (cells >= 6)).alias("collapsed"))


#: Words that hint at a kind of document, in order of precedence (fixed values).
KIND_WORDS = {
    "game rulebook": r"\b(game|rulebook|round|players?|cards?|tokens?|board|robot|programming)\b",
    "family history": r"\b(genealogy|biography|family|ancestor|descendant|born|married|children)\b",
    "form": r"\b(form|application|signature|required|applicant)\b",
}


def document_kind(x) -> Column:
    """A hint of the kind of document from its words, first match wins; a range of years and two capitalised words make a family history; 'unknown' otherwise and for null."""
    t = F.coalesce(_c(x), F.lit(""))
    kind = F.when(F.lit(False), "")
    for label, pattern in KIND_WORDS.items():
        kind = kind.when(t.rlike("(?i)" + pattern), label)
    names = F.regexp_count(t, F.lit(r"\b[A-Z][a-zA-Z'’-]{2,}\b"))
    return kind.when(t.rlike(r"\b[0-9]{4}\s*[-–]\s*[0-9]{4}\b") & (names >= 2), "family history").otherwise("unknown")


def tokens_of(x, least: int = 1) -> Column:
    """Distinct lower-case alphanumeric tokens of at least so many characters, sorted."""
    words = F.split(F.regexp_replace(F.lower(_c(x)), r"[^a-z0-9]+", " "), " ")
    return F.array_sort(F.array_distinct(F.filter(words, lambda w: F.length(w) >= least)))


def jaccard(a: Column, b: Column) -> Column:
    """Jaccard similarity of two token arrays; 0 if both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(0.0)


def token_coverage(source: Column, output: Column) -> Column:
    """Share of the source's tokens that the output has; 1 for a source without tokens."""
    n = F.size(source)
    return F.when(n > 0, F.size(F.array_intersect(source, output)) / n).otherwise(1.0)


def iou(a: Column, b: Column) -> Column:
    """Intersection over union of two boxes struct<x0, y0, x1, y1>."""
    w = F.greatest(F.lit(0.0), F.least(a.x1, b.x1) - F.greatest(a.x0, b.x0))
    h = F.greatest(F.lit(0.0), F.least(a.y1, b.y1) - F.greatest(a.y0, b.y0))
    area = lambda r: (r.x1 - r.x0) * (r.y1 - r.y0)
    union = area(a) + area(b) - w * h
    return F.when(union > 0, w * h / union).otherwise(0.0)


def corruption_score(x) -> Column:
    """Capped sum of signs of a broken scan (0..1, four places): 0.3 for each bar before a number up to 0.8, 0.4 for words of more than 15 characters on average, 0.3 for less than 30 % letters, 0.2 for more than two runs of three odd signs. 0 for null and empty texts."""
    t = F.coalesce(_c(x), F.lit(""))
    words = F.regexp_extract_all(t, F.lit(rf"([^{_BLANK}]+)"), F.lit(1))
    chars = F.aggregate(words, F.lit(0), lambda n, w: n + F.length(w))
    letters = F.length(F.regexp_replace(t, r"\P{L}+", ""))
    plain = F.length(F.regexp_replace(t, rf"[^\p{{L}}\p{{N}}{_BLANK}]+", ""))
    bars = F.least(0.3 * F.regexp_count(t, F.lit(r"\|\s*[0-9]+")), F.lit(0.8))
    fused = F.when((F.size(words) > 0) & (chars > 15 * F.size(words)), 0.4).otherwise(0.0)
    few = F.when((plain > 0) & (letters / F.greatest(plain, F.lit(1)) < 0.3), 0.3).otherwise(0.0)
    odd = F.when(F.regexp_count(t, F.lit(rf"[^\p{{L}}\p{{M}}\p{{N}}_{_BLANK}.,!?]{{3,}}")) > 2, 0.2).otherwise(0.0)
    return F.round(F.least(F.lit(1.0), bars + fused + few + odd), 4)


def merge_claims(existing: Column, fresh: Column) -> Column:
    """Claims struct<target, claim_type, module_id, evidence_path> in order of first occurrence, the existing ones first; two are the same if all four agree without blanks around; blank targets are dropped, null arrays count as empty."""
    both = F.concat(F.coalesce(existing, F.slice(fresh, 1, 0)), F.coalesce(fresh, F.slice(existing, 1, 0)))
    both = F.filter(both, lambda c: F.coalesce(strip(c.target), F.lit("")) != "")
    key = lambda c: F.concat_ws("\x00", *[F.coalesce(strip(c[k]), F.lit("")) for k in ("target", "claim_type", "module_id", "evidence_path")])
    return F.filter(both, lambda c, i: F.array_position(F.transform(both, key), key(c)) == i + 1)


def relaxed_json(x, schema: str) -> Column:
    """The first JSON object in a text, with or without a code fence around it, parsed by a schema; null if none parses."""
    t = F.regexp_replace(strip(x), r"(?s)^```[A-Za-z]*\s*|\s*```$", "")
    return F.from_json(F.regexp_extract(t, r"(?s)(\{.*\})", 1), schema, {"mode": "PERMISSIVE"})


def repaired_turn(x) -> Column:
    """'tum t0 12' as 'turn to 12': the first such phrase of a line whose verb is misread as tum or whose 'to' holds a zero or a lone capital O; capitals are kept."""
    t = _c(x)
    found = r"(?i)\b(turn|tum)\b(\s+)(to|t0)\b(\s+)([0-9]{1,4})\b"
    verb, to, number = (F.regexp_extract(t, found, k) for k in (1, 3, 5))
    bad = (F.lower(verb) == "tum") | to.contains("0") | to.rlike("^tO$")
    fixed = F.concat(F.when(F.upper(verb) == verb, "TURN").when(F.substring(verb, 1, 1).rlike("[A-Z]"), "Turn").otherwise("turn"), F.lit(" "), F.when((F.upper(to) == to) & to.rlike("[A-Z]"), "TO").otherwise("to"), F.lit(" "), number)
    at = F.regexp_instr(t, F.lit(found))
    phrase = F.regexp_extract(t, found, 0)
    return F.when((verb != "") & bad, F.concat(F.substring(t, F.lit(1), at - 1), fixed, F.substr(t, at + F.length(phrase)))).otherwise(t)


def image_placeholders(html) -> Column:
    """Images of a page's HTML, each as often as its data-count says: array<struct<alt, index, count>>."""
    tags = F.regexp_extract_all(F.coalesce(_c(html), F.lit("")), F.lit(r"(?is)(<img\b[^>]*>)"), F.lit(1))

    def one(tag: Column) -> Column:
        n = F.greatest(F.coalesce(F.regexp_extract(tag, r'(?i)data-count\s*=\s*["\']?([0-9]{1,4})', 1).try_cast("int"), F.lit(1)), F.lit(1))
        alt = collapse(F.regexp_extract(tag, r'(?i)\balt\s*=\s*"([^"]*)"', 1))
        return F.transform(F.sequence(F.lit(1), n), lambda i: F.struct(alt.alias("alt"), i.alias("index"), n.alias("count")))

    return F.flatten(F.transform(tags, one))


def macro_section(page: Column, front: tuple[int, int] | None = None, game: tuple[int, int] | None = None, end: tuple[int, int] | None = None) -> Column:
    """frontmatter, gameplay or endmatter: the first of the given page ranges that holds the page; null otherwise."""
    kind = F.when(F.lit(False), "")
    for name, r in (("frontmatter", front), ("gameplay", game), ("endmatter", end)):
        if r is not None:
            kind = kind.when(page.between(*r), name)
    return kind


def element_kind(block_type) -> Column:
    """image, table, text or other from an element's type, tested in that order."""
    t = F.lower(F.coalesce(_c(block_type), F.lit("")))
    return F.when(t.contains("image") | (t == "figure"), "image").when(t.contains("table"), "table").when(t.rlike("title|text|listitem|header|footer|caption|pagebreak|unknown"), "text").otherwise("other")


def number_mismatch(ident, x) -> Column:
    """Whether a numeric id is not the number with which the text's first line begins."""
    first = F.element_at(F.split(strip(F.coalesce(_c(x), F.lit(""))), r"\r\n|\r|\n"), 1)
    return _c(ident).rlike("^[0-9]+$") & ~F.coalesce(F.regexp_extract(first, r"^\s*([0-9]{1,4})\b", 1) == _c(ident), F.lit(False))


def title_score(text: Column, page: Column, position: Column) -> Column:
    """How likely a heading is the document's title: early pages (10 each from page 6 down), early places (2 each from the tenth down), two to five words (20; one word 5; up to ten 10), capitals at the start and later (15), at most 50 (10) or 100 (5) characters. Add up and take the highest from 20 on."""
    t = collapse(text)
    words = F.size(F.split(t, " "))
    length = F.when(words.between(2, 5), 20).when(words == 1, 5).when(words <= 10, 10).otherwise(0)
    capitals = F.when(t.rlike(r"^\p{Lu}.*\p{Lu}"), 15).otherwise(0)
    short = F.when(F.length(t) <= 50, 10).when(F.length(t) <= 100, 5).otherwise(0)
    return (6 - page) * 10 + (10 - F.least(position, F.lit(9))) * 2 + length + capitals + short


def splice_table(html: Column, table: Column) -> Column:
    """HTML with its first table replaced; without one the new table goes before the first paragraph that says 'turn to N', else in front. A null or empty table changes nothing."""
    h, new = F.coalesce(html, F.lit("")), F.coalesce(table, F.lit(""))
    first = r"(?is)<table\b.*?</table>"
    turn = r"(?is)<p>.*?turn\s+to\s+[0-9]{1,3}.*?</p>"
    put = lambda at, gone: F.concat(F.substring(h, F.lit(1), at - 1), new, F.when(gone == 0, "\n").otherwise(""), F.substr(h, at + gone))
    return F.when(new == "", h).when(h.rlike(first), put(F.regexp_instr(h, F.lit(first)), F.length(F.regexp_extract(h, first, 0)))).when(h.rlike(turn), put(F.regexp_instr(h, F.lit(turn)), F.lit(0))).otherwise(F.concat(new, F.lit("\n"), h))


#: What an image shows, by words in its description, in order (fixed values of this engine).
FIGURE_WORDS = {"setup_diagram": "setup|set up", "map_or_board": "map|board|layout|plan", "component_reference": "component|icon|token|piece", "card_reference": "card|sheet", "rule_example_diagram": "example|diagram|step|figure"}


def figure_role(alt: Column, caption: Column, headings: Column) -> Column:
    """struct<role, importance> of a figure: the first role whose words its description has (else instructional_figure); uncertain if its description is empty or generic, else essential."""
    a, c = F.lower(collapse(F.coalesce(alt, F.lit("")))), F.lower(collapse(F.coalesce(caption, F.lit(""))))
    told = F.concat_ws(" ", a, c, F.lower(F.coalesce(headings, F.lit(""))))
    role = F.when(F.lit(False), "")
    for name, words in FIGURE_WORDS.items():
        role = role.when(told.rlike(words), name)
    weak = a.isin("", "image", "illustration", "figure", "diagram") & (c == "")
    return F.struct(role.otherwise("instructional_figure").alias("role"), F.when(weak, "uncertain").otherwise("essential").alias("importance"))


def canonical_sha(*cols: Column | str) -> Column:
    """'sha256:' and the hash of the columns' texts joined by a zero byte (nulls as empty)."""
    return F.concat(F.lit("sha256:"), F.sha2(F.concat_ws("\x00", *[F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols]), 256))


def page_key(number, side) -> Column:
    """Key of a page: the number, or for half of a spread three figures and L or R."""
    s = F.upper(F.substring(F.coalesce(_c(side), F.lit("")), 1, 1))
    return F.when(s.isin("L", "R"), F.concat(F.lpad(_c(number).cast("string"), 3, "0"), s)).otherwise(_c(number).cast("string"))
