"""Folders of texts, images, HTML and archives."""

from __future__ import annotations

import hashlib
import io
import posixpath
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folium.functions.html import html_text
from folium.functions.text import input_kind, natural_key


def binary_files(spark: SparkSession, path: str, pattern: str | None = None, recursive: bool = True) -> DataFrame:
    """path, modified, bytes, content; without content in the projection files are only listed."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if pattern:
        r = r.option("pathGlobFilter", pattern)
    return r.load(path).select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"), "content")


def text_pages(spark: SparkSession, path: str, start_page: int = 1) -> DataFrame:
    """One page per text file, numbered by path from start_page: page, path, text."""
    t = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    return t.select((F.row_number().over(Window.orderBy("path")) + start_page - 1).cast("long").alias("page"), "path", "text")


def image_manifest(spark: SparkSession, path: str, start_page: int = 1) -> DataFrame:
    """Images in natural order of their names (numbers count as numbers): page, image. Names only, so one window over them is small."""
    kinds = input_kind("path") == "image"
    names = binary_files(spark, path).select("path").where(kinds).withColumn("name", F.element_at(F.split("path", "/"), -1))
    n = F.row_number().over(Window.orderBy(natural_key("name"), "path"))
    return names.select((n + start_page - 1).cast("long").alias("page"), F.col("path").alias("image"))


def html_pages(spark: SparkSession, path: str) -> DataFrame:
    """HTML snapshots: path, html, text."""
    t = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("html"))
    return t.withColumn("text", F.pandas_udf(lambda s: s.map(html_text), "string")("html"))


def folder_members(spark: SparkSession, path: str) -> DataFrame:
    """Every file below a folder without reading it: path, bytes, modified, kind."""
    return binary_files(spark, path).select("path", "bytes", "modified", input_kind("path").alias("kind"))


def safe_member(name: str) -> str | None:
    """An archive member's path if it stays within the archive, else None."""
    n = posixpath.normpath(name.replace("\\", "/"))
    return None if n.startswith(("/", "../")) or n == ".." or ":" in n.split("/")[0] else n


def unzip_members(files: DataFrame) -> DataFrame:
    """Members of zip files (path, content): archive, member_no from 1, member_id, member_path, bytes, sha256, outcome (ok, unsafe, duplicate, unreadable), content."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for path, content in zip(f["path"], f["content"]):
                rows, seen = [], set()
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        for info in z.infolist():
                            if info.is_dir():
                                continue
                            name = safe_member(info.filename)
                            outcome = "unsafe" if name is None else "duplicate" if name in seen else "ok"
                            seen.add(name)
                            data = z.read(info) if outcome == "ok" else None
                            n = len(rows) + 1
                            rows.append((path, n, f"member-{n:03d}", name or info.filename, info.file_size, hashlib.sha256(data).hexdigest() if data is not None else None, outcome, data))
                except (zipfile.BadZipFile, OSError, TypeError):
                    rows.append((path, 0, None, None, None, None, "unreadable", None))
                yield pd.DataFrame(rows, columns=["archive", "member_no", "member_id", "member_path", "bytes", "sha256", "outcome", "content"])

    return files.select("path", "content").mapInPandas(run, "archive string, member_no long, member_id string, member_path string, bytes long, sha256 string, outcome string, content binary")
