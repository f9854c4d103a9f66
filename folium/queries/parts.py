"""Queries of manifests, mappings, labels and page parts over the test tables, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folium.functions import text as T
from folium.operators import manifest as M
from folium.operators import relational as R
from folium.queries.document import _B, _P1, blocks, first_pages
from folium.queries.pages import _BX, _boxes
from folium.runtime import materialize, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def wrap(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return wrap


@query("""WITH s AS (SELECT run_id, row_id, page_start, coalesce(CASE WHEN regexp_replace(regexp_replace(lower(title), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') = '' THEN 'untitled' ELSE regexp_replace(regexp_replace(lower(title), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') END, 'untitled') AS s FROM portions WHERE run_id IS NOT NULL),
 n AS (SELECT *, row_number() OVER (PARTITION BY run_id, s ORDER BY coalesce(page_start, 0), row_id) AS n FROM s) SELECT row_id, CASE WHEN n > 1 THEN s || '_' || n ELSE s END AS slug FROM n""")
def w05_counted_slugs(spark, sf):
    """Slugs of the portions of a run, counted where they repeat."""
    p = table(spark, sf, "portions").where("run_id IS NOT NULL").select("run_id", "row_id", "page_start", "title")
    return M.counted_slugs(p, ["run_id"], "title", [F.coalesce("page_start", F.lit(0)), F.col("row_id")], "_").select("row_id", "slug")


_META = """h AS (SELECT row_id, repeat('<p>x</p>' || chr(10), CAST(row_id % 7 AS INTEGER)) || '<meta name="ocr-metadata" data-ocr-quality="' || (row_id % 15) / 10.0::DOUBLE || '" data-ocr-integrity="0.25">' || chr(10) || '<p>y</p>' AS h FROM preview_blocks)"""


@query(f"""WITH {_META} SELECT row_id, least(1.0::DOUBLE, (row_id % 15) / 10.0::DOUBLE) AS quality, 0.25::DOUBLE AS integrity, CAST(row_id % 7 AS BIGINT) AS line, CASE WHEN row_id % 7 > 0 THEN 'ocr_metadata_not_first_line:' || row_id % 7 END AS warning, length(h) - length(regexp_extract(h, '<meta[^>]*>')) - 1 AS rest FROM h WHERE row_id % 7 < 5""")
def f08_page_metadata(spark, sf):
    """Metadata tags put on the first to seventh line of preview pages, read back; only the first five lines are looked at."""
    i = F.col("row_id")
    h = F.concat(F.repeat(F.lit("<p>x</p>\n"), (i % 7).cast("int")), F.lit('<meta name="ocr-metadata" data-ocr-quality="'), ((i % 15) / 10.0).cast("string"), F.lit('" data-ocr-integrity="0.25">\n<p>y</p>'))
    m = table(spark, sf, "preview_blocks").select("row_id", T.ocr_metadata(h).alias("m")).where("m IS NOT NULL")
    return m.select("row_id", "m.quality", "m.integrity", F.col("m.line").cast("long").alias("line"), "m.warning", F.length("m.rest").cast("long").alias("rest"))


@query("""WITH p AS (SELECT row_id, page, list_filter(blocks, lambda b: b.attrs['class'] = 'page-number') AS m, list_filter(blocks, lambda b: b.block_type = 'p' AND regexp_matches(lower(trim(b.text)), '^([0-9]{1,4}|[ivxlcdm]+)$')) AS l FROM page_blocks), t AS (SELECT row_id, page, trim(CASE WHEN len(m) > 0 THEN m[-1].text ELSE l[-1].text END) AS text FROM p),
 d AS (SELECT *, list_transform(regexp_extract_all(text, '[0-9]+'), lambda x: try_cast(x AS BIGINT)) AS d FROM t WHERE text IS NOT NULL) SELECT row_id, text, CASE WHEN list_contains(d, page) THEN page ELSE d[-1] END AS number FROM d""")
def f10_printed_pages(spark, sf):
    """The printed number of each page: marked, or the last lone number."""
    return table(spark, sf, "page_blocks").select("row_id", T.printed_number(F.col("blocks"), F.col("page")).alias("n")).where("n IS NOT NULL").select("row_id", "n.text", "n.number")


@query("""WITH k AS (SELECT *, coalesce(nullif(portion_id, ''), concat_ws('|', coalesce(run_id, ''), coalesce(title, ''), coalesce(CAST(page_start AS VARCHAR), ''), coalesce(CAST(page_end AS VARCHAR), ''))) AS k FROM portions) SELECT row_id, k AS key FROM k QUALIFY row_number() OVER (PARTITION BY k ORDER BY row_id) = 1""")
def a02_first_or_line(spark, sf):
    """The first row of each portion id; rows without one count as themselves, by what they hold."""
    t = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    key = F.coalesce(F.nullif(F.col("portion_id"), F.lit("")), F.concat_ws("|", t("run_id"), t("title"), t("page_start"), t("page_end")))
    return R.first_per_key(table(spark, sf, "portions").select(key.alias("key"), "row_id"), ["key"], [F.col("row_id")]).select("row_id", "key")


@query("""SELECT run_id, row_id, kind FROM bundle_entries WHERE kind IN ('chapter', 'page') QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY CASE WHEN kind = 'chapter' THEN 0 ELSE 1 END, arrived_at DESC, row_id DESC) = 1""")
def a25_scoped_latest(spark, sf):
    """The latest chapter of each run, else its latest page."""
    e = table(spark, sf, "bundle_entries").select("run_id", "row_id", "kind", "arrived_at")
    return M.latest_scoped(e, ["run_id"], "kind", "chapter", ("page",), "arrived_at", "row_id").select("run_id", "row_id", "kind")


@query(f"WITH {_BX} SELECT run_id, page, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1, count(*) AS boxes FROM bx WHERE page IS NOT NULL GROUP BY ALL")
def a33_box_unions(spark, sf):
    """The box that holds all boxes of a page."""
    return _boxes(spark, sf).where("page IS NOT NULL").groupBy("run_id", "page").agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), F.count("*").alias("boxes"))


@query("""WITH m AS (SELECT DISTINCT p.run_id, p.entry_id FROM provenance_blocks p WHERE entry_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM bundle_entries e WHERE e.run_id = p.run_id AND e.entry_id = p.entry_id))
 SELECT run_id, entry_id, row_number() OVER (PARTITION BY run_id ORDER BY CASE WHEN regexp_matches(entry_id, '^[0-9]+$') THEN 0 ELSE 1 END, try_cast(entry_id AS BIGINT), entry_id) AS place FROM m""")
def j04_ordered_stubs(spark, sf):
    """Stubs for entries that provenance names and the bundle lacks, numbers first."""
    from pyspark.sql import Window

    e = table(spark, sf, "bundle_entries").select("run_id", "entry_id")
    m = table(spark, sf, "provenance_blocks").where("entry_id IS NOT NULL").select("run_id", "entry_id").distinct().join(e, ["run_id", "entry_id"], "left_anti")
    digits = F.when(F.col("entry_id").rlike("^[0-9]+$"), 0).otherwise(1)
    n = F.row_number().over(Window.partitionBy("run_id").orderBy(digits, F.col("entry_id").try_cast("bigint"), "entry_id"))
    return m.select("run_id", "entry_id", n.cast("long").alias("place"))


@query("""WITH q AS (SELECT run_id, row_id, portion_id, portion_type, page_start, page_end, coalesce(confidence, 0.5) AS c, list_sort(list_distinct(list_filter(string_split(regexp_replace(lower(coalesce(title, '')), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: length(w) >= 1))) AS t FROM portions WHERE run_id IS NOT NULL AND page_start IS NOT NULL AND page_end IS NOT NULL),
 l AS (SELECT *, lag(portion_id) OVER w AS ai, lag(portion_type) OVER w AS at_, lag(page_end) OVER w AS ae, lag(c) OVER w AS ac, lag(t) OVER w AS atk FROM q WINDOW w AS (PARTITION BY run_id ORDER BY page_start, page_end, row_id)),
 s AS (SELECT *, CASE WHEN len(list_distinct(list_concat(t, atk))) > 0 THEN len(list_intersect(t, atk)) / len(list_distinct(list_concat(t, atk))) ELSE 0 END AS sim FROM l WHERE ae IS NOT NULL AND page_start - ae - 1 <= 1 AND coalesce(ai, '') <> ''),
 r AS (SELECT row_id, ai, CASE WHEN coalesce(ai = portion_id, false) THEN 0.6::DOUBLE ELSE 0 END + CASE WHEN sim >= 0.5 THEN 0.25::DOUBLE * sim / 0.5::DOUBLE ELSE 0 END + CASE WHEN coalesce(at_ = portion_type, false) THEN 0.1::DOUBLE ELSE 0 END + 0.1::DOUBLE * least(ac, c) AS score FROM s)
 SELECT row_id, ai AS continuation_of, round(least(1.0::DOUBLE, score), 2) AS score FROM r WHERE score >= 0.55""")
def w09_continuation_scores(spark, sf):
    """Portions that go on with the one before, by id, title, type and confidence."""
    return M.continuation_scores(table(spark, sf, "portions"), "run_id")


@query(f"""WITH {_B}, p AS (SELECT run_id, page, bool_or(block_type = 'header') AS h, bool_or(block_type = 'footer') AS f FROM b GROUP BY ALL), k AS (SELECT *, CASE WHEN h AND f THEN 'mixed' WHEN h THEN 'top' WHEN f THEN 'bottom' ELSE 'none' END AS pattern FROM p),
 l AS (SELECT *, lag(pattern) OVER (PARTITION BY run_id ORDER BY page) AS before FROM k), g AS (SELECT *, sum(CASE WHEN before IS NULL OR before <> pattern THEN 1 ELSE 0 END) OVER (PARTITION BY run_id ORDER BY page ROWS UNBOUNDED PRECEDING) AS island FROM l),
 r AS (SELECT run_id, island, any_value(pattern) AS pattern, min(page) AS first_page, max(page) AS last_page, count(*) AS hits, max(page) - min(page) + 1 AS span FROM g GROUP BY run_id, island)
 SELECT run_id, pattern, first_page, last_page, CASE WHEN pattern IN ('mixed', 'none') THEN 0.5::DOUBLE ELSE round(least(0.95::DOUBLE, greatest(0.5::DOUBLE, 0.5::DOUBLE + 0.45::DOUBLE * hits / span)), 6) END AS confidence FROM r""")
def w08_pattern_regions(spark, sf):
    """Regions of pages with heads, feet, both or none, and how consistent each is over the pages that it spans."""
    p = blocks(spark, sf).groupBy("run_id", "page").agg(F.bool_or(F.col("block_type") == "header").alias("h"), F.bool_or(F.col("block_type") == "footer").alias("f"))
    p = p.withColumn("pattern", F.when(F.col("h") & F.col("f"), "mixed").when(F.col("h"), "top").when(F.col("f"), "bottom").otherwise("none"))
    p = materialize(p.select("run_id", "page", "pattern"), "patterns")
    g = R.islands_by(R.with_neighbours(p, ["run_id"], "page", ["pattern"], after=False), ["run_id"], "page", F.col("prev.pattern") != F.col("pattern"))
    r = g.groupBy("run_id", "island").agg(F.first("pattern").alias("pattern"), F.min("page").alias("first_page"), F.max("page").alias("last_page"), F.count("*").alias("hits"))
    sure = M.region_confidence(F.col("hits"), F.col("last_page") - F.col("first_page") + 1)
    return r.select("run_id", "pattern", "first_page", "last_page", F.when(F.col("pattern").isin("mixed", "none"), 0.5).otherwise(F.round(sure, 6)).alias("confidence"))


@query(r"""WITH x AS (SELECT row_id, list_filter(flatten(list_transform(list_filter(blocks, lambda b: b.text <> ''), lambda b: string_split(b.text, chr(10)))), lambda t: trim(t) <> '') AS ls FROM page_blocks), l AS (SELECT row_id, len(ls) AS n, unnest(ls) AS t, unnest(range(len(ls))) AS i FROM x),
 c AS (SELECT *, regexp_extract(t, '\b([0-9]{1,4})\s*-\s*([0-9]{1,4})\b', 1) AS a, regexp_extract(t, '\b([0-9]{1,4})\s*-\s*([0-9]{1,4})\b', 2) AS b FROM l), s AS (SELECT *, least(0.98::DOUBLE, CASE WHEN i >= greatest(0, n - 12) THEN 0.40::DOUBLE ELSE 0 END + CASE WHEN regexp_matches(lower(t), 'indd|page|sheet|spread') THEN 0.35::DOUBLE ELSE 0 END + CASE WHEN length(trim(t)) <= 120 THEN 0.15::DOUBLE ELSE 0 END + least(0.10::DOUBLE, i / greatest(1, n) * 0.10::DOUBLE)) AS confidence FROM c WHERE a <> '' AND CAST(a AS BIGINT) <> CAST(b AS BIGINT))
 SELECT row_id, CAST(a AS BIGINT) AS left_page, CAST(b AS BIGINT) AS right_page, round(confidence, 3) AS confidence, i AS line_no FROM s WHERE confidence >= 0.25 QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY confidence DESC, i DESC) = 1""")
def w19_spread_labels(spark, sf):
    """Labels such as 12-13 of each page's lines, the surest of a page."""
    lines = F.filter(F.flatten(F.transform(F.filter("blocks", lambda b: b.text != ""), lambda b: F.split(b.text, "\n"))), lambda t: F.trim(t) != "")
    l = table(spark, sf, "page_blocks").where(F.size("blocks") > 0).select("row_id", F.posexplode(lines).alias("line_no", "t"))  # noqa: E741
    return M.spread_labels(l.withColumn("line_no", F.col("line_no").cast("long")), ["row_id"], "line_no", "t")


@query("SELECT row_id, array_to_string(list_transform(regexp_extract_all(lower(image), '[0-9]+|[^0-9]+'), lambda p: CASE WHEN regexp_matches(p, '^[0-9]') THEN '#' || CAST(try_cast(p AS BIGINT) AS VARCHAR) ELSE p END), '/') AS pieces FROM page_blocks WHERE image IS NOT NULL")
def s06_image_pieces(spark, sf):
    """Image names as alternating texts and numbers."""
    p = F.transform(T.natural_pieces("image"), lambda x: F.when(x.number.isNotNull(), F.concat(F.lit("#"), x.number.cast("string"))).otherwise(x.text))
    return table(spark, sf, "page_blocks").where("image IS NOT NULL").select("row_id", F.array_join(p, "/").alias("pieces"))


@query(f"WITH {_P1}, n AS (SELECT run_id, page, row_number() OVER (PARTITION BY run_id ORDER BY page) - 1 AS n FROM p1) SELECT run_id, page, n // 20 + 1 AS sheet, (n % 20) // 5 AS grid_row, n % 5 AS grid_column FROM n")
def s23_contact_sheets(spark, sf):
    """Sheets of four rows of five pages."""
    return M.contact_sheets(materialize(first_pages(spark, sf).select("run_id", "page"), "pages"), ["run_id"], "page", 5, 4).select("run_id", "page", *[F.col(c).cast("long").alias(c) for c in ("sheet", "grid_row", "grid_column")])


@query("""WITH f AS (SELECT run_id, path, coalesce(title, '') AS c FROM bundle_entries WHERE path IS NOT NULL) SELECT run_id, 'sha256:' || sha256(string_agg(path || chr(0) || c || chr(0), '' ORDER BY path, c)) AS fingerprint, count(*) AS files FROM f GROUP BY run_id""")
def s24_folder_hashes(spark, sf):
    """Hash of each bundle's folder, its titles as contents."""
    return M.folder_sha(table(spark, sf, "bundle_entries"), ["run_id"], "path", "title")


@query("""WITH p AS (SELECT DISTINCT run_id, 'b' || row_id % 50 AS block_id, entry_id FROM preview_blocks WHERE entry_id IS NOT NULL), b AS (SELECT DISTINCT run_id, 'b' || row_id % 60 AS block_id, entry_id FROM provenance_blocks WHERE entry_id IS NOT NULL), e AS (SELECT DISTINCT run_id, entry_id FROM b)
 SELECT p.run_id, p.block_id, p.entry_id, CASE WHEN b.block_id IS NOT NULL THEN 'preserved' WHEN e.entry_id IS NOT NULL THEN 'mapped' ELSE 'deferred' END AS mapping, e.entry_id AS full_entry, CASE WHEN b.block_id IS NULL AND e.entry_id IS NULL THEN 'entry is not in the full bundle' END AS reason
 FROM p LEFT JOIN b ON b.run_id = p.run_id AND b.block_id = p.block_id AND b.entry_id = p.entry_id LEFT JOIN e ON e.run_id = p.run_id AND e.entry_id = p.entry_id""")
def k03_selector_map(spark, sf):
    """Where preview blocks are found in the full bundle."""
    ids = lambda n, m: table(spark, sf, n).where("entry_id IS NOT NULL").select("run_id", F.concat(F.lit("b"), (F.col("row_id") % m).cast("string")).alias("block_id"), "entry_id").distinct()
    return M.selector_map(ids("preview_blocks", 50), ids("provenance_blocks", 60), ["run_id"])


@query("""SELECT row_id, unnest(list_filter([CASE WHEN k = 'preserved' AND entry_id IS DISTINCT FROM nullif(block_id[5:-6], '') THEN 'preserved_entry' END, CASE WHEN k = 'mapped' AND coalesce(entry_id, '') = '' THEN 'mapped_entry' END, CASE WHEN k = 'deferred' AND coalesce(text_quote, '') = '' THEN 'deferred_reason' END], lambda x: x IS NOT NULL)) AS rule
 FROM (SELECT *, CASE row_id % 3 WHEN 0 THEN 'preserved' WHEN 1 THEN 'mapped' ELSE 'deferred' END AS k FROM provenance_blocks WHERE length(block_id) > 10)""")
def v19_selector_issues(spark, sf):
    """Mapping rules on provenance blocks: the entry in the block's id, an entry, a quote."""
    p = table(spark, sf, "provenance_blocks").where(F.length("block_id") > 10)
    kind = F.when(F.col("row_id") % 3 == 0, "preserved").when(F.col("row_id") % 3 == 1, "mapped").otherwise("deferred")
    own = F.nullif(F.expr("substring(block_id, 5, length(block_id) - 9)"), F.lit(""))
    return M.selector_issues(p.select("row_id", kind.alias("mapping"), F.lit("x").alias("preview_block"), F.lit("x").alias("full_block"), own.alias("preview_entry"), F.col("entry_id").alias("full_entry"), F.col("text_quote").alias("reason")).withColumn("preview_entry", F.when(F.col("mapping") == "preserved", F.col("preview_entry")).otherwise(F.col("full_entry"))), ["row_id"])


@query("""WITH a AS (SELECT DISTINCT run_id, page_number AS number FROM page_blocks WHERE page_number BETWEEN 1 AND 400), b AS (SELECT DISTINCT run_id, printed_page_start AS number FROM bundle_entries) SELECT run_id, number FROM a EXCEPT SELECT run_id, number FROM b""")
def c19_injected_numbers(spark, sf):
    """Printed numbers that pages show and no entry begins with."""
    return M.injected_numbers(table(spark, sf, "bundle_entries").withColumnRenamed("printed_page_start", "number"), table(spark, sf, "page_blocks").withColumnRenamed("page_number", "number"), ["run_id"], "number")


@query("""WITH p AS (SELECT module_id, 0.5::DOUBLE + length(module_id) / 100.0::DOUBLE AS price FROM portions WHERE length(module_id) % 2 = 0 GROUP BY ALL) SELECT row_id, round(coalesce(page_end, 0) / 1000 * coalesce(price, 0.01::DOUBLE), 6) AS cost FROM portions LEFT JOIN p USING (module_id)""")
def c19_priced_calls(spark, sf):
    """Portions as calls whose pages are tokens, half of the modules with a price."""
    q = table(spark, sf, "portions")
    prices = q.where(F.length("module_id") % 2 == 0).select("module_id", (0.5 + F.length("module_id") / 100.0).alias("price")).distinct()
    return M.priced(q.select("row_id", "module_id", "page_end"), prices, "module_id", "page_end", 0.01).select("row_id", "cost")


@query("""SELECT '| ' || coalesce(module_id, '-') || ' | ' || count(*) || ' | ' || count(DISTINCT run_id) || ' |' AS line FROM portions GROUP BY module_id""")
def k09_report(spark, sf):
    """Portions and runs per module as lines of a report."""
    r = table(spark, sf, "portions").groupBy("module_id").agg(F.count("*").alias("n"), F.countDistinct("run_id").alias("runs"))
    return M.report_lines(r, ["module_id", "n", "runs"])


@query("""SELECT row_id, CASE WHEN upper(coalesce(spread_side, '')[1:1]) IN ('L', 'R') THEN lpad(CAST(page AS VARCHAR), 3, '0') || upper(spread_side[1:1]) ELSE CAST(page AS VARCHAR) END AS key FROM page_blocks WHERE page < 1000""")
def c22_page_keys(spark, sf):
    """Keys of pages and halves of spreads."""
    return table(spark, sf, "page_blocks").where("page < 1000").select("row_id", T.page_key("page", "spread_side").alias("key"))
