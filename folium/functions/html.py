"""HTML to text and to ordered blocks, with the standard library's parser in Arrow batches."""

from __future__ import annotations

import html
import re
from html.parser import HTMLParser

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Tags that hold text of their own, and those that only hold others (fixed values of the block format).
TEXT_TAGS = ("h1", "h2", "p", "dt", "dd", "li", "caption", "th", "td", "a")
HOLDER_TAGS = ("table", "thead", "tbody", "tr", "ol", "ul", "dl")
BLOCKS = "array<struct<block_type:string,text:string,block_order:bigint,attrs:map<string,string>>>"
_BREAK = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "tr", "dt", "dd", "caption", "br", "div"}
KEPT_TAGS = {"h1", "h2", "h3", "p", "ul", "ol", "li", "dl", "dt", "dd", "table", "caption", "thead", "tbody", "tr", "th", "td", "strong", "em", "img", "a", "br"}
KEPT_P_CLASSES = {"page-number", "running-head"}


class _Text(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.off = 0

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.off += 1
        elif tag in _BREAK:
            self.out.append("\n")
        elif tag == "img":
            alt = dict(attrs).get("alt")
            self.out.append(f"[image: {alt}]" if alt else "[image]")

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.off = max(0, self.off - 1)
        elif tag in ("td", "th"):
            self.out.append("\t")
        elif tag in _BREAK:
            self.out.append("\n")

    def handle_data(self, data):
        if not self.off:
            self.out.append(data)


def html_text(source: str | None) -> str:
    """Readable lines of a page's HTML; cells end with a tab, images show their alternative text."""
    p = _Text()
    p.feed(source or "")
    p.close()
    lines = (" ".join(x.split()) for x in "".join(p.out).split("\n"))
    return "\n".join(x for x in lines if x)


class _Blocks(HTMLParser):
    """Rows (type, text, attrs) in document order; the last row collects text while `parts` is a list."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[list] = []
        self.parts: list[str] | None = None

    def put(self, kind, text="", attrs=None):
        """A row before the one that still collects text."""
        self.rows.insert(len(self.rows) - (self.parts is not None), [kind, text, attrs])

    def end_text(self):
        if self.parts is not None:
            self.rows[-1][1] = " ".join(" ".join(self.parts).split())
            self.parts = None

    def handle_starttag(self, tag, attrs):
        given = dict(attrs)
        if tag == "img":
            self.put("img", given.get("alt") or "", {"alt": given.get("alt") or ""})
        elif tag == "a" and self.parts is not None:
            self.parts.append(f'<a href="{given["href"]}">' if given.get("href") else "<a>")
        elif tag in HOLDER_TAGS:
            self.put(tag)
        elif tag in TEXT_TAGS:
            self.end_text()
            name = {"p": "class", "a": "href"}.get(tag)
            self.rows.append([tag, "", {name: given[name]} if name and given.get(name) else None])
            self.parts = []

    def handle_endtag(self, tag):
        if tag == "a" and self.parts is not None:
            self.parts.append("</a>")
            return
        if self.parts is not None and self.rows[-1][0] == tag:
            self.end_text()
        if tag == "p" and self.parts is None and self.rows and self.rows[-1][:2] == ["p", ""]:
            return  # nothing to close: an empty paragraph stands alone
        if tag in HOLDER_TAGS or tag in TEXT_TAGS or tag == "img":
            self.put("/" + tag)

    def handle_data(self, data):
        if self.parts is not None:
            self.parts.append(data)


def html_blocks(source: str | None, drop_empty: bool = False) -> list[dict]:
    """Opening and closing block tags in document order, each with its own text, numbered from 1; links stay in the text. An empty paragraph has no closing row; drop_empty leaves out text blocks without text."""
    p = _Blocks()
    p.feed(source or "")
    p.close()
    p.end_text()
    rows = [r for r in p.rows if not drop_empty or r[1] or r[0].startswith("/") or r[0] in HOLDER_TAGS or r[0] == "img"]
    return [{"block_type": kind, "text": text, "block_order": n, "attrs": attrs} for n, (kind, text, attrs) in enumerate(rows, 1)]


class _Clean(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []

    def handle_starttag(self, tag, attrs):
        if tag in KEPT_TAGS:
            a = dict(attrs)
            keep = {}
            if tag == "p" and a.get("class") in KEPT_P_CLASSES:
                keep["class"] = a["class"]
            if tag == "a" and (a.get("href") or "").startswith("#"):
                keep["href"] = a["href"]
            if tag == "img":
                keep = {"alt": a.get("alt") or ""} | ({"data-count": a["data-count"]} if a.get("data-count") else {})
            self.out.append("<" + tag + "".join(f' {k}="{html.escape(v)}"' for k, v in keep.items()) + ">")

    def handle_endtag(self, tag):
        if tag in KEPT_TAGS and tag not in ("img", "br"):
            self.out.append(f"</{tag}>")

    def handle_data(self, data):
        self.out.append(html.escape(data, quote=False))


def clean_html(source: str | None) -> str:
    """Only known tags, two classes of paragraphs, inner links and the text and count of images are kept; white space is one blank, tags that follow each other stand on lines of their own."""
    p = _Clean()
    p.feed(source or "")
    p.close()
    return re.sub(r">\s+<", ">\n<", re.sub(r"\s+", " ", "".join(p.out))).strip()


def to_text(source: Column | str) -> Column:
    return F.pandas_udf(lambda s: s.map(html_text), "string")(source)


def sanitise(source: Column | str) -> Column:
    return F.pandas_udf(lambda s: s.map(clean_html), "string")(source)


def to_blocks(source: Column | str, drop_empty: bool = False) -> Column:
    def rows(x: str | None) -> list[dict]:
        return [{**b, "attrs": list(b["attrs"].items()) if b["attrs"] else None} for b in html_blocks(x, drop_empty)]

    return F.pandas_udf(lambda s: s.map(rows), BLOCKS)(source)


def render_blocks(blocks: Column) -> Column:
    """HTML of ordered blocks: opening tags with their text, closing ones as they stand; blocks without a closing tag in the list are closed at once."""
    esc = lambda t: F.replace(F.replace(F.replace(F.coalesce(t, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    closes = F.transform(F.filter(blocks, lambda b: b.block_type.startswith("/")), lambda b: F.substring(b.block_type, 2, 20))
    one = F.transform(blocks, lambda b: F.when(b.block_type.startswith("/"), F.concat(F.lit("<"), b.block_type, F.lit(">"))).otherwise(
        F.concat(F.lit("<"), b.block_type, F.lit(">"), esc(b.text), F.when(F.array_contains(closes, b.block_type), "").otherwise(F.concat(F.lit("</"), b.block_type, F.lit(">"))))))
    return F.array_join(one, "\n")
