"""Office files by their zipped XML: DOCX paragraphs, XLSX rows, PPTX slides and EPUB chapters as elements."""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from folium.functions.html import html_text
from folium.sources.files import binary_files

SCHEMA = "path string, kind string, seq long, unit long, unit_name string, element_type string, text string"


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def docx_elements(z: zipfile.ZipFile) -> Iterator[tuple[int, str | None, str, str]]:
    for p in ET.fromstring(z.read("word/document.xml")).iter():
        if _local(p.tag) != "p":
            continue
        style = next((v for s in p.iter() if _local(s.tag) == "pStyle" for k, v in s.attrib.items() if _local(k) == "val"), "")
        text = "".join((t.text or "") if _local(t.tag) == "t" else "\t" if _local(t.tag) == "tab" else "" for t in p.iter())
        if text.strip():
            low = style.lower()
            yield 1, None, "Title" if low.startswith(("title", "heading")) else "ListItem" if "list" in low else "NarrativeText", text.strip()


def xlsx_elements(z: zipfile.ZipFile) -> Iterator[tuple[int, str | None, str, str]]:
    names = set(z.namelist())
    shared = []
    if "xl/sharedStrings.xml" in names:
        shared = ["".join(t.text or "" for t in si.iter() if _local(t.tag) == "t") for si in ET.fromstring(z.read("xl/sharedStrings.xml"))]
    titles = [s.attrib.get("name") for s in ET.fromstring(z.read("xl/workbook.xml")).iter() if _local(s.tag) == "sheet"] if "xl/workbook.xml" in names else []
    sheets = sorted((n for n in names if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.findall(r"\d+", n)[-1]))
    for i, n in enumerate(sheets):
        rows = []
        for r in ET.fromstring(z.read(n)).iter():
            if _local(r.tag) != "row":
                continue
            cells = []
            for c in r:
                v = "".join(t.text or "" for t in c.iter() if _local(t.tag) in ("v", "t"))
                cells.append(shared[int(v)] if c.attrib.get("t") == "s" and v.isdigit() and int(v) < len(shared) else v)
            if any(cells):
                rows.append("\t".join(cells))
        if rows:
            yield i + 1, (titles[i] if i < len(titles) and titles[i] else f"Sheet {i + 1}"), "Table", "\n".join(rows)


def pptx_elements(z: zipfile.ZipFile) -> Iterator[tuple[int, str | None, str, str]]:
    slides = sorted((n for n in z.namelist() if re.fullmatch(r"ppt/slides/slide\d+\.xml", n)), key=lambda n: int(re.findall(r"\d+", n)[-1]))
    for i, n in enumerate(slides, 1):
        for sp in ET.fromstring(z.read(n)).iter():
            if _local(sp.tag) != "sp":
                continue
            title = any(_local(e.tag) == "ph" and e.attrib.get("type") in ("title", "ctrTitle") for e in sp.iter())
            text = "\n".join(t for p in sp.iter() if _local(p.tag) == "p" and (t := "".join(x.text or "" for x in p.iter() if _local(x.tag) == "t").strip()))
            if text:
                yield i, f"Slide {i}", "Title" if title else "NarrativeText", text


def epub_elements(z: zipfile.ZipFile) -> Iterator[tuple[int, str | None, str, str]]:
    box = ET.fromstring(z.read("META-INF/container.xml"))
    opf = next(e.attrib["full-path"] for e in box.iter() if _local(e.tag) == "rootfile")
    root, base = ET.fromstring(z.read(opf)), posixpath.dirname(opf)
    for e in root.iter():
        if _local(e.tag) in ("title", "creator") and e.text:
            yield 0, None, "Metadata" + _local(e.tag).capitalize(), e.text.strip()
    items = {e.attrib["id"]: e.attrib["href"] for e in root.iter() if _local(e.tag) == "item" and "href" in e.attrib}
    for i, ref in enumerate((e.attrib.get("idref") for e in root.iter() if _local(e.tag) == "itemref"), 1):
        name = posixpath.normpath(posixpath.join(base, items.get(ref, "")))
        if name in z.namelist():
            html = z.read(name).decode("utf-8", "replace")
            heads = {html_text(m) for m in re.findall(r"(?is)<h[1-3][^>]*>.*?</h[1-3]>", html)}
            body = re.search(r"(?is)<body.*</body>", html)
            for line in html_text(body[0] if body else html).split("\n"):
                if line:
                    yield i, ref, "Title" if line in heads else "NarrativeText", line


READERS = {"docx": docx_elements, "xlsx": xlsx_elements, "pptx": pptx_elements, "epub": epub_elements}


def elements(path: str, content: bytes) -> list[tuple]:
    """Elements of one file in order; an unreadable file gives one element of type Unreadable."""
    kind = path.rsplit(".", 1)[-1].lower()
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            return [(path, kind, i, *e) for i, e in enumerate(READERS[kind](z), 1)]
    except (zipfile.BadZipFile, KeyError, ET.ParseError, StopIteration, OSError):
        return [(path, kind, 1, 0, None, "Unreadable", None)]


def read_office(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Elements of all files of a kind below a folder: path, kind, seq, unit (sheet, slide or chapter), unit_name, element_type, text."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for p, c in zip(f["path"], f["content"]):
                yield pd.DataFrame(elements(p, c), columns=[x.split()[0] for x in SCHEMA.split(", ")])

    return binary_files(spark, path, f"*.{kind}").select("path", "content").mapInPandas(run, SCHEMA)
