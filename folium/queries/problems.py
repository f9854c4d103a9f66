"""Queries of the general data problems (interval coverage, orphan references)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folium.operators.intervals import interval_spans, merge_intervals
from folium.operators.references import Reference, orphan_references, orphans_by_period
from folium.runtime import table
from folium.streaming.intervals import drain_spans


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    """Covered page periods of each run and the gaps between them."""
    spans = interval_spans(table(spark, sf, "portions"), "run_id", "page_start", "page_end", least=1)
    return spans.select("run_id", "span_kind", F.col("span_start").alias("page_start"), F.col("span_end").alias("page_end"))


def p1_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The same from a stream of the portions, with the maps in keyed state."""
    whole = table(spark, sf, "portions")
    stream = spark.readStream.schema(whole.schema).parquet(f"{sf}/portions.parquet*")
    spans = drain_spans(spark, stream, "run_id", "page_start", "page_end", least=1)
    return spans.select(F.col("k").alias("run_id"), "span_kind", F.col("span_start").alias("page_start"), F.col("span_end").alias("page_end"))


def p1_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Per run: number of periods, covered pages and the pages left out between them."""
    p = merge_intervals(table(spark, sf, "portions"), "run_id", "page_start", "page_end", least=1)
    return p.groupBy("run_id").agg(
        F.count("*").alias("periods"), F.sum(F.col("period_end") - F.col("period_start") + 1).alias("covered"),
        (F.max("period_end") - F.min("period_start") + 1 - F.sum(F.col("period_end") - F.col("period_start") + 1)).alias("uncovered"),
    )


def _orphans(spark: SparkSession, sf: str) -> DataFrame:
    entries = table(spark, sf, "bundle_entries")
    refs = [
        Reference("bundle_entries", entries, ("prev_entry_id", "next_entry_id")),
        Reference("provenance_blocks", table(spark, sf, "provenance_blocks"), ("entry_id",)),
        Reference("preview_blocks", table(spark, sf, "preview_blocks"), ("entry_id",)),
    ]
    return orphan_references(entries, refs, "entry_id")


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    """References to entries that the run lacks, gets later or has deleted."""
    return _orphans(spark, sf).select("ref_table", "row_id", "ref_field", "orphan_kind")


def p4_by_month(spark: SparkSession, sf: str) -> DataFrame:
    """Orphans per table, field, kind and month of arrival."""
    return orphans_by_period(_orphans(spark, sf))


_P1 = """
WITH q AS (SELECT DISTINCT run_id, page_start AS s, page_end AS e FROM portions
           WHERE run_id IS NOT NULL AND page_start >= 1 AND page_start <= page_end),
m AS (SELECT *, max(e) OVER (PARTITION BY run_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM q),
i AS (SELECT *, sum(CASE WHEN b IS NULL OR s > b + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY run_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS g FROM m),
p AS (SELECT run_id, min(s) AS s, max(e) AS e FROM i GROUP BY run_id, g)
"""
_P4 = """
WITH r AS (
  SELECT 'bundle_entries' AS ref_table, row_id, 'prev_entry_id' AS ref_field, run_id, prev_entry_id AS k, arrived_at AS t FROM bundle_entries
  UNION ALL SELECT 'bundle_entries', row_id, 'next_entry_id', run_id, next_entry_id, arrived_at FROM bundle_entries
  UNION ALL SELECT 'provenance_blocks', row_id, 'entry_id', run_id, entry_id, arrived_at FROM provenance_blocks
  UNION ALL SELECT 'preview_blocks', row_id, 'entry_id', run_id, entry_id, arrived_at FROM preview_blocks),
j AS (
  SELECT r.ref_table, r.row_id, r.ref_field, r.t, count(b.entry_id) AS n,
    count(*) FILTER (WHERE b.arrived_at <= r.t) AS n_past,
    count(*) FILTER (WHERE b.arrived_at <= r.t AND (b.deleted_at IS NULL OR b.deleted_at > r.t)) AS n_live
  FROM r LEFT JOIN bundle_entries b ON b.run_id = r.run_id AND b.entry_id = r.k
  WHERE r.k IS NOT NULL AND r.k <> '' GROUP BY ALL),
o AS (SELECT ref_table, row_id, ref_field, t, CASE WHEN n = 0 THEN 'missing' WHEN n_past = 0 THEN 'late' ELSE 'deleted' END AS orphan_kind
      FROM j WHERE n_live = 0)
"""

QUERIES = {"p1_found": p1_found, "p1_stream": p1_stream, "p1_coverage": p1_coverage, "p4_found": p4_found, "p4_by_month": p4_by_month}
_P1_SPANS = _P1 + """SELECT run_id, 'period' AS span_kind, s AS page_start, e AS page_end FROM p UNION ALL
      SELECT * FROM (SELECT run_id, 'gap' AS span_kind, lag(e) OVER (PARTITION BY run_id ORDER BY s) + 1 AS page_start, s - 1 AS page_end FROM p) WHERE page_start IS NOT NULL"""
SQL = {
    "p1_found": _P1_SPANS,
    "p1_stream": _P1_SPANS,
    "p1_coverage": _P1 + """SELECT run_id, count(*) AS periods, CAST(sum(e - s + 1) AS BIGINT) AS covered,
      CAST(max(e) - min(s) + 1 - sum(e - s + 1) AS BIGINT) AS uncovered FROM p GROUP BY run_id""",
    "p4_found": _P4 + "SELECT ref_table, row_id, ref_field, orphan_kind FROM o",
    "p4_by_month": _P4 + "SELECT ref_table, ref_field, orphan_kind, strftime(date_trunc('month', t), '%Y-%m-%d') AS period, count(*) AS orphans FROM o GROUP BY ALL",
}
