"""Queries of the text problems, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folium.llm.lines import Repeats, clean_pages, repeated_blocks, repeated_lines
from folium.llm.mixing import draw, in_training_order, reached_shares, source_plan
from folium.llm.neardup import duplicate_groups, near_duplicates
from folium.llm.pages import page_texts
from folium.llm.quality import page_statistics
from folium.llm.scans import page_noise, repaired_pages
from folium.llm.subjects import composition, subject_areas
from folium.llm.tokenizer import count_tokens, encode_column
from folium.runtime import materialize, table

#: Near-duplicate pages: three words a sequence, 0.6, pages of 30 words and more.
NEAR = {"n": 3, "threshold": 0.6, "least_words": 30}


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return repeated_lines(table(spark, sf, "page_blocks"))


def p2_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """Repeated blocks of successive lines of any length, with the runs that hold them."""
    return repeated_blocks(table(spark, sf, "page_blocks"))


def p2_clean(spark: SparkSession, sf: str) -> DataFrame:
    """Pages without their repeated lines."""
    pages = table(spark, sf, "page_blocks")
    return clean_pages(pages, repeated_lines(pages))


def repeated(spark: SparkSession, sf: str) -> DataFrame:
    """The repeated lines of each collection, stored: coll, block."""
    return Repeats(table(spark, sf, "page_blocks")).cases.select("coll", "block")


def _noise(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return page_noise(table(spark, sf, "page_blocks"), table(spark, sf, "preview_blocks"), table(spark, sf, "bundle_runs"), repeated(spark, sf))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    """Running heads, page numbers, broken and misread words of scanned pages."""
    return _noise(spark, sf)["noise"]


def p3_text(spark: SparkSession, sf: str) -> DataFrame:
    """Pages and preview blocks repaired into continuous paragraphs."""
    return repaired_pages(table(spark, sf, "page_blocks"), _noise(spark, sf), table(spark, sf, "preview_blocks"))


def p5_stats(spark: SparkSession, sf: str) -> DataFrame:
    return page_statistics(table(spark, sf, "page_blocks"), repeated(spark, sf))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    """Pages of at least 120 characters of their own that are mainly no prose."""
    return p5_stats(spark, sf).where("n_chars >= 120 AND page_class != 'prose'").select("row_id", "page_class")


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(page_texts(table(spark, sf, "page_blocks")), **NEAR).select("row_id_a", "row_id_b")


def p6_groups(spark: SparkSession, sf: str) -> DataFrame:
    return duplicate_groups(page_texts(table(spark, sf, "page_blocks")), **NEAR)


def p7_ids(spark: SparkSession, sf: str) -> DataFrame:
    return encode_column(table(spark, sf, "documents"), "doc_id", "text")


def p7_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return count_tokens(table(spark, sf, "documents"), "doc_id", "text")


def _sized(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Documents with their sizes in tokens, and the plan of the mix; both stored."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "source")
    sizes = count_tokens(docs.select(F.struct("doc_id", "source").alias("k"), "text"), "k", "text")
    tokens = materialize(sizes.select("k.doc_id", "k.source", "n_tokens"), "tokens")
    return tokens, source_plan(tokens, table(spark, sf, "mix_targets"))


def p8_mix(spark: SparkSession, sf: str) -> DataFrame:
    """The mix in training order."""
    return in_training_order(draw(*_sized(spark, sf)))


def p8_shares(spark: SparkSession, sf: str) -> DataFrame:
    """Target and reached share of each source."""
    tokens, plan = _sized(spark, sf)
    return reached_shares(draw(tokens, plan), plan)


def p9_areas(spark: SparkSession, sf: str) -> DataFrame:
    """Areas of each document with the share of its sentences."""
    return subject_areas(table(spark, sf, "documents"), table(spark, sf, "subject_labels"), table(spark, sf, "subjects"))


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    return p9_areas(spark, sf).select("doc_id", "subject").distinct()


def p9_composition(spark: SparkSession, sf: str) -> DataFrame:
    """Make-up of the corpus by source and subject."""
    return composition(p9_areas(spark, sf), table(spark, sf, "documents"))


QUERIES = {"p2_found": p2_found, "p2_blocks": p2_blocks, "p2_clean": p2_clean, "p3_found": p3_found, "p3_text": p3_text, "p5_found": p5_found, "p5_stats": p5_stats, "p6_found": p6_found, "p6_groups": p6_groups, "p7_ids": p7_ids, "p7_token_counts": p7_token_counts, "p8_mix": p8_mix, "p8_shares": p8_shares, "p9_found": p9_found, "p9_areas": p9_areas, "p9_composition": p9_composition}
_P2 = r"""
WITH pages AS (SELECT row_id, run_id, source[1] AS c, blocks FROM page_blocks WHERE source[1] IS NOT NULL AND source[1] <> ''),
b AS (SELECT row_id, run_id, c, unnest(blocks) AS b FROM pages),
t AS (SELECT row_id, run_id, c, b.block_order AS block_order, string_split(coalesce(b.text, ''), chr(10)) AS parts FROM b),
l AS (SELECT row_id, run_id, c, block_order, unnest(parts) AS line, unnest(range(1, len(parts) + 1)) AS line_no FROM t),
n AS (SELECT * EXCLUDE (line), trim(regexp_replace(regexp_replace(lower(line), '\p{Nd}', '', 'g'), '[^\p{L}]+', ' ', 'g')) AS k FROM l),
w AS (SELECT * FROM n WHERE len(string_split(k, ' ')) >= 3),
k AS (SELECT c, k, count(DISTINCT run_id) AS runs FROM w GROUP BY c, k),
a AS (SELECT c, count(DISTINCT run_id) AS all_runs FROM pages GROUP BY c)
SELECT row_id, block_order, line_no FROM w JOIN k USING (c, k) JOIN a USING (c) WHERE runs >= 5 AND runs >= 0.1 * all_runs
"""
_P6 = r"""
WITH b AS (SELECT row_id, unnest(blocks) AS b, unnest(range(len(blocks))) AS i FROM page_blocks),
w AS (SELECT row_id, regexp_extract_all(lower(string_agg(b.text, ' ' ORDER BY b.block_order, i)), '[\p{L}\p{Nd}]+') AS w FROM b WHERE b.text <> '' GROUP BY row_id),
s AS (SELECT row_id, list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS s FROM w WHERE len(w) >= 30),
g AS (SELECT row_id, len(s) AS n, unnest(s) AS g FROM s),
o AS (SELECT a.row_id AS row_id_a, b.row_id AS row_id_b, a.n + b.n - count(*) AS total, count(*) AS shared FROM g a JOIN g b ON a.g = b.g AND a.row_id < b.row_id GROUP BY a.row_id, b.row_id, a.n, b.n)
SELECT row_id_a, row_id_b FROM o WHERE 5 * shared >= 3 * total
"""
_P6_GROUPS = r"""
WITH RECURSIVE t AS (SELECT row_id, lower(coalesce((SELECT string_agg(x.b.text, ' ' ORDER BY x.b.block_order, x.i) FROM (SELECT unnest(p.blocks) AS b, unnest(range(len(p.blocks))) AS i) x WHERE x.b.text <> ''), '')) AS text FROM page_blocks p),
rep AS (SELECT text, min(row_id) AS r FROM t GROUP BY text), w AS (SELECT r, regexp_extract_all(text, '[\p{L}\p{Nd}]+') AS w FROM rep),
s AS (SELECT r, list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS s FROM w WHERE len(w) >= 30), g AS (SELECT r, len(s) AS n, unnest(s) AS g FROM s),
o AS (SELECT a.r AS a, b.r AS b, a.n + b.n - count(*) AS total, count(*) AS shared FROM g a JOIN g b ON a.g = b.g AND a.r <> b.r GROUP BY a.r, b.r, a.n, b.n), e AS (SELECT a, b FROM o WHERE 5 * shared >= 3 * total),
c AS (SELECT r AS a, r AS b FROM rep UNION SELECT c.a, e.b FROM c JOIN e ON e.a = c.b), l AS (SELECT a, min(b) AS label FROM c GROUP BY a), k AS (SELECT a, count(*) AS links FROM e GROUP BY a)
SELECT t.row_id, CASE WHEN t.text = '' THEN t.row_id ELSE label END AS group_id, coalesce(links, 0) AS links FROM t JOIN rep ON rep.text = t.text JOIN l ON l.a = rep.r LEFT JOIN k ON k.a = rep.r
"""
SQL: dict[str, str] = {"p2_found": _P2, "p6_found": _P6, "p6_groups": _P6_GROUPS}
