"""Mail messages and mail archives."""

from __future__ import annotations

import re
from collections.abc import Iterator
from email import message_from_bytes, policy

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from folium.functions.html import html_text
from folium.sources.files import binary_files

SCHEMA = "path string, message_no long, message_id string, subject string, sender array<string>, recipients array<string>, sent string, body string, element_ids array<string>"
_FROM = re.compile(rb"^From [^\n]*\n", re.M)


def parse_message(path: str, number: int, raw: bytes) -> tuple:
    """One message's fields; the body is its plain part, else its HTML part as text. Element ids carry the message's number."""
    m = message_from_bytes(raw, policy=policy.default)
    part = m.get_body(("plain", "html"))
    try:
        body = part.get_content() if part else ""
    except (LookupError, ValueError):
        body = ""
    if part is not None and part.get_content_type() == "text/html":
        body = html_text(body)
    body = body.replace("\r\n", "\n").strip()

    def people(h: str) -> list[str]:
        return [a.addr_spec for v in m.get_all(h, []) for a in getattr(v, "addresses", ())]

    paragraphs = [p for p in re.split(r"\n\s*\n", body) if p.strip()]
    return (path, number, str(m["message-id"] or "").strip() or None, str(m["subject"] or "").strip() or None, people("from"), people("to") + people("cc"), str(m["date"] or "") or None, body, [f"m{number:04d}-e{i:04d}" for i in range(1, len(paragraphs) + 1)])


def split_mbox(raw: bytes) -> list[bytes]:
    """Messages of an mbox file, with quoted '>From ' lines restored."""
    starts = [m for m in _FROM.finditer(raw) if m.start() == 0 or raw[m.start() - 2 : m.start()] == b"\n\n" or raw[m.start() - 4 : m.start()] == b"\r\n\r\n"]
    ends = [m.start() for m in starts[1:]] + [len(raw)]
    return [re.sub(rb"(?m)^>(>*From )", rb"\1", raw[m.end() : e]) for m, e in zip(starts, ends)]


def _read(files: DataFrame, many: bool) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for path, content in zip(f["path"], f["content"]):
                parts = split_mbox(content) if many else [content]
                yield pd.DataFrame([parse_message(path, i, x) for i, x in enumerate(parts, 1)], columns=[c.split()[0] for c in SCHEMA.split(", ")])

    return files.select("path", "content").mapInPandas(run, SCHEMA)


def read_eml(spark: SparkSession, path: str) -> DataFrame:
    return _read(binary_files(spark, path), False)


def read_mbox(spark: SparkSession, path: str) -> DataFrame:
    return _read(binary_files(spark, path), True)
