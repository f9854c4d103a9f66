"""Queries of the document operators over the test tables, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folium.functions import html as H
from folium.functions import text as T
from folium.operators import graph as G
from folium.operators import relational as R
from folium.operators import validation as V
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


def blocks(spark: SparkSession, sf: str) -> DataFrame:
    """One row per block: row_id, run_id, page, block_type, text, block_order, attrs."""
    return table(spark, sf, "page_blocks").select("row_id", "run_id", "page", F.explode("blocks").alias("b")).select("row_id", "run_id", "page", "b.block_type", "b.text", "b.block_order", "b.attrs")


_B = "b AS (SELECT row_id, run_id, page, x.block_type AS block_type, x.text AS text, x.block_order AS block_order, x.attrs AS attrs FROM (SELECT row_id, run_id, page, unnest(blocks) AS x FROM page_blocks))"
_P1 = "p1 AS (SELECT * FROM page_blocks QUALIFY row_number() OVER (PARTITION BY run_id, page ORDER BY row_id) = 1)"
_WS = r"[\s\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


def first_pages(spark: SparkSession, sf: str) -> DataFrame:
    return R.first_per_key(table(spark, sf, "page_blocks").where("page IS NOT NULL"), ["run_id", "page"], [F.col("row_id")])


# ---------------------------------------------------------------- projections and text


@query(f"""WITH {_B} SELECT CASE WHEN lower(block_type) IN ('h1','h2','h3','h4','h5','h6') THEN 'heading' WHEN lower(block_type) = 'li' THEN 'list_item'
 WHEN lower(block_type) IN ('table','tr','td','th') THEN 'table' WHEN lower(block_type) IN ('img','figure') THEN 'figure' WHEN lower(block_type) IN ('figcaption','caption') THEN 'caption'
 WHEN starts_with(block_type, '/') THEN 'close' ELSE 'paragraph' END AS kind, count(*) AS blocks, CAST(sum(length(text)) AS BIGINT) AS chars FROM b GROUP BY 1""")
def f02_block_kinds(spark, sf):
    return blocks(spark, sf).groupBy(T.block_kind("block_type").alias("kind")).agg(F.count("*").alias("blocks"), F.sum(F.length("text")).alias("chars"))


@query(f"SELECT row_id, trim(regexp_replace(text, '{_WS}', ' ', 'g')) AS clean FROM preview_blocks")
def f03_collapse(spark, sf):
    return table(spark, sf, "preview_blocks").select("row_id", T.collapse("text").alias("clean"))


@query("""SELECT run_id, CASE WHEN s = '' THEN 'untitled' ELSE s END AS slug FROM
 (SELECT run_id, regexp_replace(regexp_replace(lower(title), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS s FROM bundle_runs)""")
def f03_slugs(spark, sf):
    return table(spark, sf, "bundle_runs").select("run_id", T.slug("title").alias("slug"))


_ENT = "replace(replace(replace(replace(replace({x}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#x27;', chr(39)), '&amp;', '&')"


@query(f"""WITH l AS (SELECT row_id, list_filter(list_transform(string_split({_ENT.format(x="regexp_replace(html_text, '</?p[^>]*>', chr(10), 'g')")}, chr(10)), lambda t: trim(regexp_replace(t, '{_WS}', ' ', 'g'))), lambda t: t <> '') AS x FROM preview_blocks WHERE html_text IS NOT NULL)
 SELECT row_id, array_to_string(x, chr(10)) AS text FROM l""")
def f04_html_text(spark, sf):
    return table(spark, sf, "preview_blocks").where("html_text IS NOT NULL").select("row_id", H.to_text("html_text").alias("text"))


@query(f"""WITH p AS (SELECT row_id, unnest(regexp_extract_all(html_text, '(?s)<p>(.*?)</p>', 1)) AS t, unnest(range(len(regexp_extract_all(html_text, '(?s)<p>(.*?)</p>', 1)))) AS k FROM preview_blocks WHERE html_text IS NOT NULL),
 c AS (SELECT row_id, k, trim(regexp_replace({_ENT.format(x='t')}, '{_WS}', ' ', 'g')) AS t FROM p), b AS (SELECT row_id, k, 0 AS z, 'p' AS block_type, t AS text FROM c UNION ALL SELECT row_id, k, 1, '/p', '' FROM c WHERE t <> '')
 SELECT row_id, block_type, text, row_number() OVER (PARTITION BY row_id ORDER BY k, z) AS block_order FROM b""")
def f05_html_blocks(spark, sf):
    rows = table(spark, sf, "preview_blocks").where("html_text IS NOT NULL").select("row_id", F.explode(H.to_blocks("html_text")).alias("b"))
    return rows.select("row_id", "b.block_type", "b.text", "b.block_order")


@query("""SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS n, t AS text FROM
 (SELECT doc_id, unnest(x) AS t0, unnest(range(len(x))) AS i, trim(t0, ' ') AS t FROM (SELECT doc_id, string_split(replace(text, chr(13), ''), chr(10)) AS x FROM documents)) WHERE t <> ''""")
def f06_text_blocks(spark, sf):
    """Non-blank lines of each document as numbered paragraphs (numbered per document)."""
    lines = F.filter(F.transform(F.split(F.replace("text", F.lit("\r"), F.lit("")), "\n"), lambda t: F.trim(t)), lambda t: t != "")
    d = table(spark, sf, "documents").select("doc_id", F.posexplode(lines).alias("i", "text"))
    return d.select("doc_id", (F.col("i") + 1).cast("long").alias("n"), "text")


@query("""SELECT row_id, x[len(x)] AS printed FROM (SELECT row_id, list_transform(list_filter(blocks, lambda b: b.attrs['class'] = 'page-number'), lambda b: b.text) AS x FROM page_blocks) WHERE len(x) > 0""")
def f10_printed_number(spark, sf):
    marked = F.filter("blocks", lambda b: F.element_at(b.attrs, F.lit("class")) == "page-number")
    return table(spark, sf, "page_blocks").select("row_id", F.try_element_at(marked, F.lit(-1)).text.alias("printed")).where("printed IS NOT NULL")


@query(r"""SELECT row_id, CASE WHEN length(text) >= 0 THEN trim(regexp_replace(regexp_replace(text, '(\p{L})[-\x{2010}\x{ad}\x{ac}]\s*\n\s*(\p{Ll})', '\1\2', 'g'), '""" + _WS + """', ' ', 'g')) END AS text FROM preview_blocks""")
def f16_reflow(spark, sf):
    return table(spark, sf, "preview_blocks").select("row_id", T.join_hyphens("text").alias("text"))


@query(r"""WITH """ + _B + r""", t AS (SELECT row_id, block_order, regexp_extract(text, '^\s*(.*?\S)\s*(?:\.{2,}|…+|(?:\s*\.\s){2,}\.?|\s{2,})\s*([0-9]{1,4})\s*$', ['title', 'page']) AS m FROM b)
 SELECT row_id, block_order, m.title AS title, CAST(m.page AS BIGINT) AS page FROM t WHERE m.page <> ''""")
def f23_toc_entries(spark, sf):
    b = blocks(spark, sf).select("row_id", "block_order", T.toc_entry("text").alias("t")).where("t IS NOT NULL")
    return b.select("row_id", "block_order", "t.title", "t.page")


@query(r"""SELECT doc_id, CASE WHEN regexp_matches(t, '(?i)\b(game|rulebook|round|players?|cards?|tokens?|board|robot|programming)\b') THEN 'game rulebook'
 WHEN regexp_matches(t, '(?i)\b(genealogy|biography|family|ancestor|descendant|born|married|children)\b') THEN 'family history' WHEN regexp_matches(t, '(?i)\b(form|application|signature|required|applicant)\b') THEN 'form'
 WHEN regexp_matches(t, '\b[0-9]{4}\s*[-–]\s*[0-9]{4}\b') AND len(regexp_extract_all(t, '\b[A-Z][a-zA-Z''’-]{2,}\b')) >= 2 THEN 'family history' ELSE 'unknown' END AS kind FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)""")
def f25_document_kind(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.document_kind("text").alias("kind"))


_BL = r"\s\p{Z}\x{85}\x{1c}-\x{1f}"


@query(r"""WITH w AS (SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z][A-Za-z''’-]{2,}') AS ws, length(regexp_replace(t, '[""" + _BL + r"""]+', '', 'g')) AS vis FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents))
 SELECT doc_id, round(CASE WHEN len(ws) = 0 THEN 0.0 ELSE least(greatest(0.5::DOUBLE * length(regexp_replace(t, '\P{L}+', '', 'g')) / greatest(vis, 1)
  + 0.3::DOUBLE * (len(list_filter(ws, lambda x: regexp_matches(x, '[aeiouyAEIOUY]'))) / len(ws)) + 0.2::DOUBLE * least(len(ws) / 40.0::DOUBLE, 1.0::DOUBLE), 0), 1) END, 6) AS quality FROM w""")
def f26_text_quality(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.round(T.text_quality("text"), 6).alias("quality"))


@query(r"""WITH p AS (SELECT doc_id, unnest(x) AS t, unnest(range(len(x))) AS i FROM (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(text, '\n+'), lambda s: trim(s, ' ')), lambda s: s <> '') AS x FROM documents)),
 c AS (SELECT doc_id, i, t, unnest(range(0, (length(t) - 1) // 400 + 1)) AS k FROM p)
 SELECT doc_id, count(*) AS pieces, max(length(substr(t, k * 400 + 1, 400))) AS longest, CAST(sum(length(substr(t, k * 400 + 1, 400))) AS BIGINT) AS chars FROM c GROUP BY doc_id""")
def f27_chunks(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.explode(T.chunks("text", 400)).alias("c"))
    return d.groupBy("doc_id").agg(F.count("*").alias("pieces"), F.max(F.length("c")).cast("long").alias("longest"), F.sum(F.length("c")).alias("chars"))


@query(r"""SELECT run_id, CASE WHEN ext = '' THEN 'folder' WHEN ext IN ('pdf','docx','xlsx','pptx','epub') THEN ext WHEN ext = 'eml' THEN 'email' WHEN ext = 'mbox' THEN 'mailbox' WHEN ext IN ('html','htm') THEN 'html'
 WHEN ext = 'zip' THEN 'archive' WHEN ext IN ('png','jpg','jpeg','tif','tiff') THEN 'image' WHEN ext IN ('txt','md') THEN 'text' ELSE 'unknown' END AS kind,
 CASE WHEN NOT regexp_matches(source_artifact, '(?i)(https?://|file://|www\.)|(^|\s)(/[\w.-]+){2,}|[A-Z]:\\|\\\\|\.(pdf|docx?|xlsx?|pptx?|epub|html?|zip|png|jpe?g)\b') THEN source_artifact END AS shown
 FROM (SELECT *, regexp_extract(regexp_extract(lower(source_artifact), '[^/\\]*$'), '\.([a-z0-9]+)$', 1) AS ext FROM bundle_runs)""")
def f29_input_kind(spark, sf):
    return table(spark, sf, "bundle_runs").select("run_id", T.input_kind("source_artifact").alias("kind"), T.private_text("source_artifact").alias("shown"))


@query(r"""SELECT row_id, coalesce(length(t) >= 50 AND NOT ends_with(t, '...') AND t[-1] NOT IN ('.', '!', '?', ';', chr(39)) AND NOT regexp_matches(t[-1], '\p{Lu}'), false) AS truncated
 FROM (SELECT row_id, regexp_replace(text, '^[""" + _BL + r"""]+|[""" + _BL + r"""]+$', '', 'g') AS t FROM preview_blocks)""")
def f30_truncated(spark, sf):
    return table(spark, sf, "preview_blocks").select("row_id", T.looks_truncated("text").alias("truncated"))


@query("""SELECT row_id, printf('blk-%s-%04d', coalesce(entry_id, 'none'), row_number() OVER (PARTITION BY run_id, entry_id ORDER BY row_id)) AS block_key FROM provenance_blocks""")
def f39_block_keys(spark, sf):
    n = F.row_number().over(W.partitionBy("run_id", "entry_id").orderBy("row_id"))
    return table(spark, sf, "provenance_blocks").select("row_id", F.format_string("blk-%s-%04d", F.coalesce("entry_id", F.lit("none")), n).alias("block_key"))


@query("""SELECT run_id, 'sha256:' || sha256(coalesce(document_id, '') || chr(0) || coalesce(title, '') || chr(0) || coalesce(CAST(n_pages AS VARCHAR), '')) AS fingerprint FROM bundle_runs""")
def s24_fingerprints(spark, sf):
    return table(spark, sf, "bundle_runs").select("run_id", T.canonical_sha("document_id", "title", "n_pages").alias("fingerprint"))


@query("""SELECT row_id, list_transform(regexp_extract_all(image, '[0-9]+'), lambda s: CAST(s AS BIGINT)) AS numbers, lower(image) AS name FROM page_blocks WHERE image IS NOT NULL""")
def s05_image_keys(spark, sf):
    k = T.natural_key("image")
    return table(spark, sf, "page_blocks").where("image IS NOT NULL").select("row_id", k.numbers.alias("numbers"), F.col("image")).select("row_id", "numbers", F.lower("image").alias("name"))


@query("""WITH p AS (SELECT row_id, list_sort(list_transform(blocks, lambda b, i: {'o': b.block_order, 'i': i, 't': b.block_type, 'x': replace(replace(replace(coalesce(b.text, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;')})) AS bs FROM page_blocks WHERE len(blocks) > 0),
 c AS (SELECT *, list_transform(list_filter(bs, lambda b: starts_with(b.t, '/')), lambda b: b.t[2:]) AS closed FROM p)
 SELECT row_id, array_to_string(list_transform(bs, lambda b: CASE WHEN starts_with(b.t, '/') THEN '<' || b.t || '>' ELSE '<' || b.t || '>' || b.x || CASE WHEN list_contains(closed, b.t) THEN '' ELSE '</' || b.t || '>' END END), chr(10)) AS html FROM c""")
def k06_render(spark, sf):
    """HTML of each page from its ordered blocks."""
    return table(spark, sf, "page_blocks").where(F.size("blocks") > 0).select("row_id", H.render_blocks(F.array_sort("blocks", lambda a, b: F.when(a.block_order < b.block_order, -1).when(a.block_order > b.block_order, 1).otherwise(0))).alias("html"))


# ---------------------------------------------------------------- joins


@query("""WITH e AS (SELECT * FROM bundle_entries QUALIFY row_number() OVER (PARTITION BY run_id, entry_id ORDER BY row_id) = 1)
 SELECT p.row_id, e.kind AS entry_kind, e.entry_order FROM provenance_blocks p JOIN e USING (run_id, entry_id)""")
def j01_entry_lookup(spark, sf):
    e = R.first_per_key(table(spark, sf, "bundle_entries"), ["run_id", "entry_id"], [F.col("row_id")]).select("run_id", "entry_id", F.col("kind").alias("entry_kind"), "entry_order")
    return table(spark, sf, "provenance_blocks").select("row_id", "run_id", "entry_id").join(e, ["run_id", "entry_id"]).select("row_id", "entry_kind", "entry_order")


@query("""SELECT p.row_id AS page_row, q.row_id AS portion_row FROM page_blocks p JOIN portions q ON p.run_id = q.run_id AND p.page BETWEEN q.page_start AND q.page_end""")
def j02_pages_of_portions(spark, sf):
    p = table(spark, sf, "page_blocks").select("run_id", "page", F.col("row_id").alias("page_row"))
    q = table(spark, sf, "portions").select("run_id", "page_start", "page_end", F.col("row_id").alias("portion_row"))
    return R.range_join(p, q, ["run_id"], "page", "page_start", "page_end").select("page_row", "portion_row")


@query("""WITH x AS (SELECT row_id, run_id, unnest(source_pages) AS page FROM bundle_entries), p AS (SELECT DISTINCT run_id, page FROM page_blocks)
 SELECT x.row_id, count(p.page) AS hits, count(*) - count(p.page) AS misses FROM x LEFT JOIN p USING (run_id, page) GROUP BY x.row_id""")
def j03_source_page_hits(spark, sf):
    x = table(spark, sf, "bundle_entries").select("row_id", "run_id", F.explode("source_pages").alias("page"))
    p = table(spark, sf, "page_blocks").select("run_id", "page").distinct().withColumn("hit", F.lit(1))
    return x.join(p, ["run_id", "page"], "left").groupBy("row_id").agg(F.count("hit").alias("hits"), (F.count("*") - F.count("hit")).alias("misses"))


@query("""SELECT DISTINCT run_id, entry_id, 'stub' AS kind FROM provenance_blocks p WHERE entry_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM bundle_entries e WHERE e.run_id = p.run_id AND e.entry_id = p.entry_id)""")
def j04_backfill_stubs(spark, sf):
    e = table(spark, sf, "bundle_entries").select("run_id", "entry_id")
    return table(spark, sf, "provenance_blocks").where("entry_id IS NOT NULL").select("run_id", "entry_id").distinct().join(e, ["run_id", "entry_id"], "left_anti").withColumn("kind", F.lit("stub"))


@query("""WITH v AS (SELECT DISTINCT run_id, page_number AS page FROM page_blocks WHERE page_number IS NOT NULL), g AS (SELECT *, lead(page) OVER (PARTITION BY run_id ORDER BY page) AS n FROM v)
 SELECT run_id, page + 1 AS first, n - 1 AS last FROM g WHERE n > page + 1""")
def j05_missing_pages(spark, sf):
    """Ranges of printed numbers that no page of the run has."""
    return R.missing_ranges(table(spark, sf, "page_blocks"), ["run_id"], "page_number").select("run_id", "first", "last")


@query("""SELECT run_id, entry_id, row_id, title FROM bundle_entries WHERE entry_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY run_id, entry_id ORDER BY CASE WHEN deleted_at IS NULL THEN 0 ELSE 1 END, row_id) = 1""")
def j06_prefer_live(spark, sf):
    e = table(spark, sf, "bundle_entries").where("entry_id IS NOT NULL").select("run_id", "entry_id", "row_id", "title", "deleted_at")
    return R.prefer([e.where("deleted_at IS NULL"), e.where("deleted_at IS NOT NULL")], ["run_id", "entry_id"], "row_id").select("run_id", "entry_id", "row_id", "title")


@query("""SELECT run_id, page, row_id FROM page_blocks QUALIFY row_number() OVER (PARTITION BY run_id, page ORDER BY CASE WHEN module_id = 'marker_page_html_v1' THEN 0 ELSE 1 END, row_id) = 1""")
def j07_escalated_override(spark, sf):
    p = table(spark, sf, "page_blocks").select("run_id", "page", "row_id", "module_id")
    up = F.coalesce(F.col("module_id") == "marker_page_html_v1", F.lit(False))
    return R.prefer([p.where(up), p.where(~up)], ["run_id", "page"], "row_id").select("run_id", "page", "row_id")


@query("""WITH v AS (SELECT DISTINCT run_id, source_page_number AS page FROM provenance_blocks WHERE source_page_number IS NOT NULL), g AS (SELECT *, lead(page) OVER (PARTITION BY run_id ORDER BY page) AS n FROM v)
 SELECT run_id, page AS below, page + 1 AS first, n - 1 AS last, n AS above FROM g WHERE n > page + 1""")
def j08_nearest_pages(spark, sf):
    """Each range of pages without provenance with the nearest pages that have some, below and above."""
    return R.missing_ranges(table(spark, sf, "provenance_blocks"), ["run_id"], "source_page_number")


@query(r"""WITH p AS (SELECT row_id, run_id, page, list_sort(list_distinct(list_filter(string_split(regexp_replace(lower(array_to_string(list_transform(blocks, lambda b: b.text), ' ')), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: length(w) >= 3))) AS t FROM page_blocks WHERE len(blocks) > 0)
 SELECT a.row_id AS left_row, b.row_id AS right_row, round(CASE WHEN len(list_distinct(list_concat(a.t, b.t))) > 0 THEN len(list_intersect(a.t, b.t)) / len(list_distinct(list_concat(a.t, b.t))) ELSE 0 END, 6) AS similarity
 FROM p a JOIN p b ON a.run_id = b.run_id AND a.page = b.page AND a.row_id < b.row_id""")
def j12_redelivered_similarity(spark, sf):
    """Token similarity of rows delivered for the same page."""
    t = F.array_join(F.transform("blocks", lambda b: F.coalesce(b.text, F.lit(""))), " ")
    many = table(spark, sf, "page_blocks").groupBy("run_id", "page").agg(F.count("*").alias("n")).where("n > 1").select("run_id", "page")
    p = table(spark, sf, "page_blocks").where(F.size("blocks") > 0).join(many, ["run_id", "page"], "left_semi").select("row_id", "run_id", "page", T.tokens_of(t, 3).alias("t"))
    a, b = p.select("run_id", "page", F.col("row_id").alias("left_row"), F.col("t").alias("ta")), p.select("run_id", "page", F.col("row_id").alias("right_row"), F.col("t").alias("tb"))
    return a.join(b, ["run_id", "page"]).where("left_row < right_row").select("left_row", "right_row", F.round(T.jaccard(F.col("ta"), F.col("tb")), 6).alias("similarity"))


@query("""WITH f AS (SELECT DISTINCT run_id, page FROM page_blocks WHERE is_blank) SELECT q.row_id, count(*) AS blank_pages FROM portions q JOIN f ON f.run_id = q.run_id AND f.page BETWEEN q.page_start AND q.page_end GROUP BY q.row_id""")
def j18_blank_pages_in_portions(spark, sf):
    f = table(spark, sf, "page_blocks").where("is_blank").select("run_id", "page").distinct()
    q = table(spark, sf, "portions").select("row_id", "run_id", "page_start", "page_end")
    return R.range_join(f, q, ["run_id"], "page", "page_start", "page_end").groupBy("row_id").agg(F.count("*").alias("blank_pages"))


@query("SELECT run_id, title FROM bundle_runs WHERE run_id NOT IN (SELECT run_id FROM portions WHERE run_id IS NOT NULL)")
def j19_runs_without_portions(spark, sf):
    return table(spark, sf, "bundle_runs").select("run_id", "title").join(table(spark, sf, "portions").select("run_id"), "run_id", "left_anti")


# ---------------------------------------------------------------- aggregations


@query("""SELECT run_id, page_start, row_id, confidence FROM portions WHERE run_id IS NOT NULL AND page_start IS NOT NULL
 QUALIFY row_number() OVER (PARTITION BY run_id, page_start ORDER BY confidence DESC NULLS LAST, page_start - page_end DESC NULLS LAST, row_id) = 1""")
def a01_best_portion(spark, sf):
    p = table(spark, sf, "portions").where("run_id IS NOT NULL AND page_start IS NOT NULL").select("run_id", "page_start", "row_id", "confidence", F.expr("page_start - page_end").alias("narrow"))
    return R.argmax(p, ["run_id", "page_start"], ["confidence", "narrow"], "row_id").select("run_id", "page_start", "row_id", "confidence")


@query("""SELECT run_id, portion_id, row_id, title FROM portions WHERE portion_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY run_id, portion_id ORDER BY row_id) = 1""")
def a02_first_per_portion(spark, sf):
    p = table(spark, sf, "portions").where("portion_id IS NOT NULL").select("run_id", "portion_id", "row_id", "title")
    return R.first_per_key(p, ["run_id", "portion_id"], [F.col("row_id")])


@query("""WITH q AS (SELECT * FROM portions WHERE run_id IS NOT NULL AND page_start IS NOT NULL AND page_end IS NOT NULL),
 s AS (SELECT run_id, page_start, page_end, array_to_string(list_sort(list(DISTINCT module_id)), ',') AS modules FROM q GROUP BY ALL)
 SELECT run_id, page_start, page_end, row_id, confidence, modules FROM q JOIN s USING (run_id, page_start, page_end) QUALIFY row_number() OVER (PARTITION BY run_id, page_start, page_end ORDER BY confidence DESC NULLS LAST, row_id) = 1""")
def a03_best_with_sources(spark, sf):
    p = table(spark, sf, "portions").where("run_id IS NOT NULL AND page_start IS NOT NULL AND page_end IS NOT NULL")
    best = F.max_by(F.struct("row_id", "confidence"), F.struct(F.coalesce("confidence", F.lit(float("-inf"))), -F.col("row_id")))
    return p.groupBy("run_id", "page_start", "page_end").agg(best.alias("b"), F.array_join(F.array_sort(F.collect_set("module_id")), ",").alias("modules")).select("run_id", "page_start", "page_end", "b.row_id", "b.confidence", "modules")


@query("""WITH g AS (SELECT * FROM portions WHERE run_id IS NOT NULL AND page_start <= page_end),
 f AS (SELECT DISTINCT run_id, unnest(range(page_start, page_end + 1)) AS p FROM g WHERE module_id IS DISTINCT FROM 'coarse_segment_patterns_v1'),
 c AS (SELECT row_id, run_id, unnest(range(page_start, page_end + 1)) AS p FROM g WHERE module_id = 'coarse_segment_patterns_v1')
 SELECT row_id, count(*) AS pages, CAST(sum(CASE WHEN f.p IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS uncovered, round(sum(CASE WHEN f.p IS NULL THEN 1 ELSE 0 END) / count(*), 6) AS share FROM c LEFT JOIN f ON c.run_id = f.run_id AND c.p = f.p GROUP BY row_id""")
def a04_uncovered_share(spark, sf):
    q = table(spark, sf, "portions").where("run_id IS NOT NULL").select("row_id", "run_id", "page_start", "page_end", "module_id")
    coarse = F.coalesce(F.col("module_id") == "coarse_segment_patterns_v1", F.lit(False))
    return R.uncovered_share(q.where(coarse), q.where(~coarse), ["run_id"], "page_start", "page_end", "row_id").withColumn("share", F.round("share", 6))


@query("SELECT run_id, lower(title) AS title, min(page_start) AS page FROM portions WHERE title IS NOT NULL GROUP BY ALL")
def a07_first_page_of_title(spark, sf):
    return table(spark, sf, "portions").where("title IS NOT NULL").groupBy("run_id", F.lower("title").alias("title")).agg(F.min("page_start").alias("page"))


@query(f"""WITH {_B}, h AS (SELECT *, CASE WHEN block_type IN ('h1', 'h2') THEN 1 ELSE 0 END AS head FROM b WHERE NOT starts_with(block_type, '/')),
 g AS (SELECT *, sum(head) OVER (PARTITION BY run_id ORDER BY page, row_id, block_order ROWS UNBOUNDED PRECEDING) AS island FROM h)
 SELECT run_id, CAST(island AS BIGINT) AS island, count(*) - 1 AS body_blocks, CAST(sum(CASE WHEN head = 0 THEN least(200, length(text)) ELSE 0 END) AS BIGINT) AS score FROM g WHERE island > 0 GROUP BY ALL""")
def a08_heading_spans(spark, sf):
    """Text that follows each heading up to the next one of its run."""
    b = blocks(spark, sf).where(~F.col("block_type").startswith("/"))
    head = F.col("block_type").isin("h1", "h2")
    g = R.running_sum(b, ["run_id"], "page", F.when(head, 1).otherwise(0), "island", ("row_id", "block_order")).where("island > 0")
    return g.groupBy("run_id", "island").agg((F.count("*") - 1).alias("body_blocks"), F.sum(F.when(head, 0).otherwise(F.least(F.lit(200), F.length("text")))).alias("score"))


@query(f"WITH {_B} SELECT run_id, page, bool_or(block_type = 'header') AS has_header, bool_or(block_type = 'footer') AS has_footer FROM b GROUP BY ALL")
def a09_page_flags(spark, sf):
    return blocks(spark, sf).groupBy("run_id", "page").agg(F.bool_or(F.col("block_type") == "header").alias("has_header"), F.bool_or(F.col("block_type") == "footer").alias("has_footer"))


@query("SELECT run_id, row_id, row_number() OVER (PARTITION BY run_id ORDER BY confidence DESC NULLS LAST, row_id) AS rank FROM portions WHERE run_id IS NOT NULL QUALIFY rank <= 3")
def a10_top_portions(spark, sf):
    p = table(spark, sf, "portions").where("run_id IS NOT NULL").select("run_id", "row_id", "confidence")
    return R.top_n(p, ["run_id"], [F.desc_nulls_last("confidence"), F.col("row_id")], 3).select("run_id", "row_id", F.col("rank").cast("long").alias("rank"))


@query("""WITH x AS (SELECT DISTINCT run_id, entry_id, unnest(source_pages) AS page FROM bundle_entries WHERE entry_id IS NOT NULL)
 SELECT run_id, page, count(DISTINCT entry_id) AS entries, array_to_string(list_sort(list(DISTINCT entry_id)), ',') AS ids FROM x GROUP BY ALL HAVING count(DISTINCT entry_id) > 1""")
def a11_shared_pages(spark, sf):
    x = table(spark, sf, "bundle_entries").where("entry_id IS NOT NULL").select("run_id", "entry_id", F.explode("source_pages").alias("page")).distinct()
    return x.groupBy("run_id", "page").agg(F.count("*").alias("entries"), F.array_join(F.array_sort(F.collect_set("entry_id")), ",").alias("ids")).where("entries > 1")


@query("""WITH e AS (SELECT DISTINCT run_id, entry_id FROM bundle_entries WHERE entry_id IS NOT NULL), r AS (SELECT run_id, next_entry_id AS entry_id FROM bundle_entries UNION SELECT run_id, prev_entry_id FROM bundle_entries)
 SELECT run_id, entry_id FROM e EXCEPT SELECT run_id, entry_id FROM r""")
def a12_unreferenced_entries(spark, sf):
    e = table(spark, sf, "bundle_entries")
    nodes = e.where("entry_id IS NOT NULL").select(F.col("run_id").alias("scope"), F.col("entry_id").alias("node")).distinct()
    links = e.select(F.col("run_id").alias("scope"), F.explode(F.array("prev_entry_id", "next_entry_id")).alias("dst")).where("dst IS NOT NULL")
    return G.unreferenced(nodes, links).select(F.col("scope").alias("run_id"), F.col("node").alias("entry_id"))


@query(r"""WITH w AS (SELECT lang, unnest(list_filter(string_split(regexp_replace(lower(text), '[^a-z]+', ' ', 'g'), ' '), lambda x: length(x) >= 4)) AS word FROM documents), c AS (SELECT lang, word, count(*) AS times FROM w GROUP BY ALL)
 SELECT lang, word, times, row_number() OVER (PARTITION BY lang ORDER BY times DESC, word) AS rank FROM c QUALIFY rank <= 5""")
def a13_common_words(spark, sf):
    words = F.explode(F.filter(F.split(F.regexp_replace(F.lower("text"), "[^a-z]+", " "), " "), lambda x: F.length(x) >= 4))
    return R.most_common(table(spark, sf, "documents").select("lang", words.alias("word")), ["lang"], "word", 5).select("lang", "word", "times", F.col("rank").cast("long").alias("rank"))


@query("""SELECT row_id, array_to_string(list_filter([CASE WHEN page_number IS NULL THEN 'no_page_number' END, CASE WHEN image IS NULL THEN 'no_image' END, CASE WHEN len(blocks) = 0 OR blocks IS NULL THEN 'no_blocks' END, CASE WHEN page_number <> page THEN 'shifted' END], lambda x: x IS NOT NULL), ',') AS reasons FROM page_blocks""")
def a17_escalation_reasons(spark, sf):
    hits = F.array(F.when(F.col("page_number").isNull(), F.lit("no_page_number")), F.when(F.col("image").isNull(), F.lit("no_image")), F.when(F.coalesce(F.size("blocks"), F.lit(0)) <= 0, F.lit("no_blocks")), F.when(F.col("page_number") != F.col("page"), F.lit("shifted")))
    return table(spark, sf, "page_blocks").select("row_id", F.array_join(F.filter(hits, lambda x: x.isNotNull()), ",").alias("reasons"))


@query("SELECT row_id, confidence FROM portions ORDER BY confidence NULLS FIRST, row_id LIMIT 50")
def a18_repair_candidates(spark, sf):
    """The 50 portions most in need of another look (a budget, so the limit is the feature)."""
    return table(spark, sf, "portions").orderBy(F.asc_nulls_first("confidence"), "row_id").limit(50).select("row_id", "confidence")


@query("""SELECT source[1] AS collection, count(*) AS pages, CAST(sum(CASE WHEN NOT is_blank THEN 1 ELSE 0 END) AS BIGINT) AS filled, CAST(sum(CASE WHEN NOT is_blank AND len(blocks) > 0 THEN 1 ELSE 0 END) AS BIGINT) AS with_blocks FROM page_blocks GROUP BY 1""")
def a20_coverage(spark, sf):
    first = F.expr("if(size(source) > 0, source[0], null)").alias("collection")
    return table(spark, sf, "page_blocks").groupBy(first).agg(F.count("*").alias("pages"), F.sum(F.when(~F.col("is_blank"), 1).otherwise(0)).alias("filled"), F.sum(F.when(~F.col("is_blank") & (F.size("blocks") > 0), 1).otherwise(0)).alias("with_blocks"))


@query("SELECT module_id, block_kind, count(*) AS blocks, round(avg(confidence), 6) AS confidence, grouping(module_id, block_kind) AS level FROM provenance_blocks GROUP BY ROLLUP (module_id, block_kind)")
def a22_rollup(spark, sf):
    return table(spark, sf, "provenance_blocks").rollup("module_id", "block_kind").agg(F.count("*").alias("blocks"), F.round(F.avg("confidence"), 6).alias("confidence"), F.grouping_id().alias("level"))


@query(f"""WITH {_P1}, w AS (SELECT run_id, page, (blocks IS NULL OR len(blocks) = 0) AS empty, page_number, lag(len(blocks) > 0) OVER (PARTITION BY run_id ORDER BY page) AS b, lead(len(blocks) > 0) OVER (PARTITION BY run_id ORDER BY page) AS a FROM p1)
 SELECT run_id, count(*) AS pages, CAST(sum(CASE WHEN empty THEN 1 ELSE 0 END) AS BIGINT) AS empty_pages, CAST(sum(CASE WHEN empty AND page_number IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS empty_numbered, CAST(sum(CASE WHEN empty AND b AND a THEN 1 ELSE 0 END) AS BIGINT) AS empty_between FROM w GROUP BY run_id""")
def a24_page_health(spark, sf):
    full = F.coalesce(F.size("blocks"), F.lit(0)) > 0
    p = materialize(first_pages(spark, sf).select("run_id", "page", "page_number", full.alias("full")), "pages")
    p = R.with_neighbours(p, ["run_id"], "page", ["full"]).withColumn("b", F.col("prev.full")).withColumn("a", F.col("next.full"))
    n = lambda c: F.sum(F.when(c, 1).otherwise(0))
    e = ~F.col("full")
    return p.groupBy("run_id").agg(F.count("*").alias("pages"), n(e).alias("empty_pages"), n(e & F.col("page_number").isNotNull()).alias("empty_numbered"), n(e & F.col("b") & F.col("a")).alias("empty_between"))


@query("SELECT run_id, entry_id, row_id, title FROM bundle_entries WHERE entry_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY run_id, entry_id ORDER BY arrived_at DESC, row_id DESC) = 1")
def a25_latest_entries(spark, sf):
    return R.latest(table(spark, sf, "bundle_entries").where("entry_id IS NOT NULL").select("run_id", "entry_id", "arrived_at", "row_id", "title"), ["run_id", "entry_id"], "arrived_at", "row_id").select("run_id", "entry_id", "row_id", "title")


@query("WITH k AS (SELECT run_id, kind, min(row_id) AS first_row, count(*) AS entries FROM bundle_entries GROUP BY ALL) SELECT run_id, kind, entries, dense_rank() OVER (PARTITION BY run_id ORDER BY first_row) AS place FROM k")
def a26_first_seen_kinds(spark, sf):
    k = table(spark, sf, "bundle_entries").groupBy("run_id", "kind").agg(F.min("row_id").alias("f"), F.count("*").alias("entries"))
    return k.select("run_id", "kind", "entries", F.dense_rank().over(W.partitionBy("run_id").orderBy("f")).cast("long").alias("place"))


@query("SELECT split_part(document_id, '-', 1) AS house, arg_min(creator, run_id) FILTER (WHERE creator IS NOT NULL AND creator <> '') AS creator, count(*) AS runs FROM bundle_runs GROUP BY 1")
def a27_first_creator(spark, sf):
    c = F.when(F.col("creator").isNotNull() & (F.col("creator") != ""), F.col("run_id"))
    return table(spark, sf, "bundle_runs").groupBy(F.split_part("document_id", F.lit("-"), F.lit(1)).alias("house")).agg(F.min_by("creator", c).alias("creator"), F.count("*").alias("runs"))


@query("""SELECT row_id, array_to_string(list_transform(list_filter(blocks, lambda b: b.text <> '')[1:10], lambda b: substr(b.text, 1, 60)), ' | ') AS summary FROM page_blocks WHERE len(blocks) > 0""")
def a29_page_summary(spark, sf):
    s = F.array_join(F.transform(F.slice(F.filter("blocks", lambda b: b.text != ""), 1, 10), lambda b: F.substring(b.text, 1, 60)), " | ")
    return table(spark, sf, "page_blocks").where(F.size("blocks") > 0).select("row_id", s.alias("summary"))


@query(f"WITH {_B}, k AS (SELECT run_id, lower(trim(text)) AS head, count(DISTINCT page) AS pages FROM b WHERE attrs['class'] = 'running-head' GROUP BY ALL) SELECT * FROM k")
def a30_running_heads(spark, sf):
    b = blocks(spark, sf).where(F.element_at("attrs", F.lit("class")) == "running-head")
    return b.groupBy("run_id", F.lower(F.trim("text")).alias("head")).agg(F.countDistinct("page").alias("pages"))


@query("""SELECT run_id, min(page_start) AS first_page, max(page_end) AS last_page, count(*) AS portions FROM portions WHERE page_start <= page_end AND run_id IS NOT NULL GROUP BY run_id""")
def a33_extent(spark, sf):
    return table(spark, sf, "portions").where("page_start <= page_end AND run_id IS NOT NULL").groupBy("run_id").agg(F.min("page_start").alias("first_page"), F.max("page_end").alias("last_page"), F.count("*").alias("portions"))


_EVAL = "e AS (SELECT coalesce(module_id, 'none') AS module_id, round(avg(confidence), 6) AS score, count(*) AS portions, round(avg(page_end - page_start), 6) AS width FROM portions GROUP BY 1)"


@query(f"WITH {_EVAL} SELECT * FROM e a WHERE NOT EXISTS (SELECT 1 FROM e b WHERE b.module_id <> a.module_id AND b.score >= a.score AND b.portions <= a.portions AND b.width <= a.width AND (b.score > a.score OR b.portions < a.portions OR b.width < a.width))")
def a34_pareto(spark, sf):
    e = table(spark, sf, "portions").groupBy(F.coalesce("module_id", F.lit("none")).alias("module_id")).agg(F.round(F.avg("confidence"), 6).alias("score"), F.count("*").alias("portions"), F.round(F.avg(F.expr("page_end - page_start")), 6).alias("width"))
    return R.pareto(e, "module_id", "score", ["portions", "width"])


@query("SELECT source, count(*) AS documents, CAST(sum(length(text) // 4) AS BIGINT) AS tokens, round(sum(length(text) // 4) * 0.002::DOUBLE / 1000, 6) AS cost FROM documents GROUP BY source")
def a35_cost_estimate(spark, sf):
    t = F.floor(F.length("text") / 4)
    return table(spark, sf, "documents").groupBy("source").agg(F.count("*").alias("documents"), F.sum(t).alias("tokens"), F.round(F.sum(t) * 0.002 / 1000, 6).alias("cost"))


@query("SELECT portion_type, count(*) AS cases, round(avg(CASE WHEN confidence >= 0.5 THEN 1.0 ELSE 0.0 END), 6) AS pass_rate, round(avg(confidence), 6) AS overall FROM portions GROUP BY 1")
def a36_pass_rates(spark, sf):
    return table(spark, sf, "portions").groupBy("portion_type").agg(F.count("*").alias("cases"), F.round(F.avg(F.when(F.col("confidence") >= 0.5, 1.0).otherwise(0.0)), 6).alias("pass_rate"), F.round(F.avg("confidence"), 6).alias("overall"))


# ---------------------------------------------------------------- windows and sequences


@query(f"""WITH q AS (SELECT run_id, page_start, min(row_id) AS row_id FROM portions WHERE run_id IS NOT NULL AND page_start IS NOT NULL GROUP BY ALL), l AS (SELECT run_id, max(page) AS last_page FROM page_blocks GROUP BY 1)
 SELECT run_id, row_id, page_start, coalesce(lead(page_start) OVER (PARTITION BY run_id ORDER BY page_start) - 1, last_page) AS page_stop FROM q LEFT JOIN l USING (run_id)""")
def w01_next_starts(spark, sf):
    q = table(spark, sf, "portions").where("run_id IS NOT NULL AND page_start IS NOT NULL").groupBy("run_id", "page_start").agg(F.min("row_id").alias("row_id"))
    last = table(spark, sf, "page_blocks").groupBy("run_id").agg(F.max("page").alias("last_page"))
    return R.next_starts(q.join(last, "run_id", "left"), ["run_id"], "page_start", F.col("last_page"), "page_stop").select("run_id", "row_id", "page_start", "page_stop")


@query(f"""WITH {_P1}, n AS (SELECT run_id, page, page_number AS v, row_number() OVER (PARTITION BY run_id ORDER BY page) AS n FROM p1 WHERE page IS NOT NULL),
 x AS (SELECT *, last_value(CASE WHEN v IS NOT NULL THEN v - n END IGNORE NULLS) OVER w1 AS up, first_value(CASE WHEN v IS NOT NULL THEN v - n END IGNORE NULLS) OVER w2 AS down FROM n
  WINDOW w1 AS (PARTITION BY run_id ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), w2 AS (PARTITION BY run_id ORDER BY page ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
 SELECT run_id, page, CASE WHEN v IS NOT NULL THEN v WHEN up IS NOT NULL AND down IS NOT NULL THEN CASE WHEN up = down THEN up + n END WHEN down IS NOT NULL THEN CASE WHEN down + n >= 1 THEN down + n END ELSE up + n END AS filled FROM x""")
def w07_fill_page_numbers(spark, sf):
    p = first_pages(spark, sf).select("run_id", "page", "page_number")
    return R.fill_sequence(p, ["run_id"], "page", "page_number").select("run_id", "page", "filled")


@query(f"""WITH {_P1}, l AS (SELECT run_id, page, is_blank, lag(is_blank) OVER (PARTITION BY run_id ORDER BY page) AS b FROM p1), g AS (SELECT *, sum(CASE WHEN b IS NULL OR b <> is_blank THEN 1 ELSE 0 END) OVER (PARTITION BY run_id ORDER BY page ROWS UNBOUNDED PRECEDING) AS island FROM l)
 SELECT run_id, CAST(island AS BIGINT) AS island, bool_or(is_blank) AS is_blank, min(page) AS first_page, max(page) AS last_page, count(*) AS pages, max(page) - min(page) + 1 AS span FROM g GROUP BY run_id, island""")
def w08_regions(spark, sf):
    """Runs of pages of one kind among those present; a span counts absent pages too."""
    p = materialize(first_pages(spark, sf).select("run_id", "page", "is_blank"), "pages")
    g = R.islands_by(R.with_neighbours(p, ["run_id"], "page", ["is_blank"], after=False), ["run_id"], "page", F.col("prev.is_blank") != F.col("is_blank"))
    return g.groupBy("run_id", "island").agg(F.bool_or("is_blank").alias("is_blank"), F.min("page").alias("first_page"), F.max("page").alias("last_page"), F.count("*").alias("pages"), (F.max("page") - F.min("page") + 1).alias("span"))


@query(r"""WITH q AS (SELECT run_id, row_id, page_start, page_end, list_sort(list_distinct(list_filter(string_split(regexp_replace(lower(title), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> ''))) AS t FROM portions WHERE run_id IS NOT NULL AND page_start <= page_end AND title IS NOT NULL),
 l AS (SELECT *, lag(row_id) OVER w AS before_row, lag(page_end) OVER w AS before_end, lag(t) OVER w AS before_t FROM q WINDOW w AS (PARTITION BY run_id ORDER BY page_start, row_id))
 SELECT row_id, before_row, round(len(list_intersect(t, before_t)) / len(list_distinct(list_concat(t, before_t))), 6) AS similarity FROM l WHERE before_row IS NOT NULL AND page_start - before_end BETWEEN 0 AND 1 AND len(list_intersect(t, before_t)) / len(list_distinct(list_concat(t, before_t))) >= 0.5""")
def w09_continuations(spark, sf):
    """Portions that follow one of a like title closely."""
    q = table(spark, sf, "portions").where("run_id IS NOT NULL AND page_start <= page_end AND title IS NOT NULL").select("run_id", "row_id", "page_start", "page_end", T.tokens_of("title").alias("t"))
    q = R.with_neighbours(q, ["run_id"], "page_start", ["row_id", "page_end", "t"], ("row_id",), after=False)
    q = q.select("row_id", "page_start", "t", F.col("prev.row_id").alias("before_row"), F.col("prev.page_end").alias("before_end"), F.col("prev.t").alias("before_t"))
    q = q.where("before_row IS NOT NULL AND page_start - before_end BETWEEN 0 AND 1").withColumn("s", T.jaccard(F.col("t"), F.col("before_t"))).where("s >= 0.5")
    return q.select("row_id", "before_row", F.round("s", 6).alias("similarity"))


@query(f"""WITH {_P1}, l AS (SELECT run_id, page, page_number, page_number - page AS d, lag(page_number - page) OVER (PARTITION BY run_id ORDER BY page) AS b FROM p1 WHERE page_number IS NOT NULL),
 g AS (SELECT *, sum(CASE WHEN b IS NULL OR b <> d THEN 1 ELSE 0 END) OVER (PARTITION BY run_id ORDER BY page ROWS UNBOUNDED PRECEDING) AS island FROM l)
 SELECT run_id, min(page_number) AS first_number, max(page_number) AS last_number, count(*) AS pages FROM g GROUP BY run_id, island HAVING count(*) >= 3""")
def w10_number_runs(spark, sf):
    """Stretches of at least three pages whose printed numbers keep step with the pages."""
    p = materialize(first_pages(spark, sf).where("page_number IS NOT NULL").select("run_id", "page", "page_number", F.expr("page_number - page").alias("d")), "pages")
    g = R.islands_by(R.with_neighbours(p, ["run_id"], "page", ["d"], after=False), ["run_id"], "page", F.col("prev.d") != F.col("d"))
    return g.groupBy("run_id", "island").agg(F.min("page_number").alias("first_number"), F.max("page_number").alias("last_number"), F.count("*").alias("pages")).where("pages >= 3").drop("island")


@query("WITH l AS (SELECT run_id, row_id, source_page_number, lag(source_page_number) OVER (PARTITION BY run_id ORDER BY row_id) AS before FROM provenance_blocks WHERE source_page_number IS NOT NULL) SELECT * FROM l WHERE before > source_page_number")
def w12_number_breaks(spark, sf):
    """Provenance rows whose source page is before that of the row above."""
    return V.monotonic_breaks(table(spark, sf, "provenance_blocks").select("run_id", "row_id", "source_page_number"), ["run_id"], "row_id", "source_page_number")


@query(f"""WITH {_P1}, n AS (SELECT run_id, row_number() OVER (PARTITION BY run_id ORDER BY page) - 1 AS i FROM p1), x AS (SELECT run_id, i, unnest(range(greatest(0, CAST(ceil((i - 7) / 5) AS BIGINT)), i // 5 + 1)) AS window_id FROM n)
 SELECT run_id, window_id, count(*) AS pages FROM x GROUP BY ALL""")
def w15_windows(spark, sf):
    """Windows of eight pages, one every five."""
    n = R.running_sum(materialize(first_pages(spark, sf).select("run_id", "page"), "pages"), ["run_id"], "page", F.lit(1), "n").select("run_id", (F.col("n") - 1).cast("long").alias("i"))
    return R.sliding_windows(n, ["run_id"], "i", 8, 5).groupBy("run_id", "window_id").agg(F.count("*").alias("pages"))


@query("""WITH RECURSIVE q AS (SELECT row_id, run_id, page_start AS s, page_end AS e, row_number() OVER (PARTITION BY run_id ORDER BY coalesce(confidence, -1) DESC, page_end - page_start DESC, page_start, row_id) AS n FROM portions WHERE run_id IS NOT NULL AND page_start >= 1 AND page_start <= page_end),
 r AS (SELECT run_id, n, [{'s': s, 'e': e, 'row_id': row_id}] AS kept FROM q WHERE n = 1 UNION ALL SELECT q.run_id, q.n, CASE WHEN len(list_filter(kept, lambda k: k.s <= q.e AND q.s <= k.e)) = 0 THEN list_append(kept, {'s': q.s, 'e': q.e, 'row_id': q.row_id}) ELSE kept END FROM r JOIN q ON q.run_id = r.run_id AND q.n = r.n + 1),
 l AS (SELECT run_id, unnest(kept) AS k FROM r QUALIFY n = max(n) OVER (PARTITION BY run_id)) SELECT k.row_id AS row_id, run_id, k.s AS page_start, k.e AS page_end FROM l""")
def w22_greedy_portions(spark, sf):
    """Portions kept by confidence, then width, then start, none overlapping another of its run."""
    q = table(spark, sf, "portions").where("run_id IS NOT NULL AND page_start >= 1 AND page_start <= page_end").select("row_id", "run_id", "page_start", "page_end", "confidence")
    return R.greedy_non_overlap(q, ["run_id"], "page_start", "page_end", [-F.coalesce("confidence", F.lit(-1.0)), F.expr("page_start - page_end"), F.col("page_start")], "row_id").select("row_id", "run_id", "page_start", "page_end")


@query("""WITH e AS (SELECT * FROM bundle_entries WHERE entry_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY run_id, entry_id ORDER BY row_id) = 1)
 SELECT run_id, entry_id, lag(entry_id) OVER w AS prev_id, lead(entry_id) OVER w AS next_id FROM e WINDOW w AS (PARTITION BY run_id ORDER BY entry_order, entry_id)""")
def w23_navigation(spark, sf):
    e = R.first_per_key(table(spark, sf, "bundle_entries").where("entry_id IS NOT NULL").select("run_id", "entry_id", "row_id", "entry_order"), ["run_id", "entry_id"], [F.col("row_id")])
    return R.neighbours(e, ["run_id"], "entry_order", "entry_id", ("entry_id",)).select("run_id", "entry_id", "prev_id", "next_id")


# ---------------------------------------------------------------- sets, graph, checks, bundle


@query("SELECT run_id FROM (SELECT run_id FROM bundle_runs INTERSECT SELECT run_id FROM bundle_entries) EXCEPT SELECT run_id FROM preview_blocks")
def s07_sets(spark, sf):
    r = lambda n: table(spark, sf, n).select("run_id")
    return r("bundle_runs").intersect(r("bundle_entries")).subtract(r("preview_blocks"))


@query("""WITH RECURSIVE l AS (SELECT DISTINCT run_id, entry_id AS a, next_entry_id AS b FROM bundle_entries WHERE next_entry_id IS NOT NULL AND next_entry_id <> '' AND entry_id IS NOT NULL),
 s AS (SELECT DISTINCT run_id, entry_id AS node FROM bundle_entries WHERE entry_order = 1 AND entry_id IS NOT NULL), r AS (SELECT run_id, node FROM s UNION SELECT l.run_id, l.b FROM r JOIN l ON l.run_id = r.run_id AND l.a = r.node) SELECT run_id, node FROM r""")
def g01_reachable(spark, sf):
    e = table(spark, sf, "bundle_entries")
    links = e.where("next_entry_id IS NOT NULL AND next_entry_id <> '' AND entry_id IS NOT NULL").select(F.col("run_id").alias("scope"), F.col("entry_id").alias("src"), F.col("next_entry_id").alias("dst"))
    starts = e.where("entry_order = 1 AND entry_id IS NOT NULL").select(F.col("run_id").alias("scope"), F.col("entry_id").alias("node"))
    return G.reachable(links, starts).select(F.col("scope").alias("run_id"), "node")


@query("""SELECT DISTINCT run_id, next_entry_id AS dst FROM bundle_entries b WHERE next_entry_id IS NOT NULL AND next_entry_id <> '' AND NOT EXISTS (SELECT 1 FROM bundle_entries e WHERE e.run_id = b.run_id AND e.entry_id = b.next_entry_id)""")
def g02_dangling(spark, sf):
    e = table(spark, sf, "bundle_entries")
    links = e.where("next_entry_id IS NOT NULL AND next_entry_id <> ''").select(F.col("run_id").alias("scope"), F.col("next_entry_id").alias("dst")).distinct()
    return G.dangling(links, e.where("entry_id IS NOT NULL").select(F.col("run_id").alias("scope"), F.col("entry_id").alias("node"))).select(F.col("scope").alias("run_id"), "dst")


@query("""SELECT row_id, unnest(list_filter([CASE WHEN run_id IS NULL THEN 'run_id' END, CASE WHEN NOT coalesce(page_start >= 1 AND page_start <= page_end, false) THEN 'bounds' END, CASE WHEN NOT coalesce(confidence BETWEEN 0 AND 1, true) THEN 'confidence' END], lambda x: x IS NOT NULL)) AS rule FROM portions""")
def v01_portion_issues(spark, sf):
    return V.issues(table(spark, sf, "portions"), ["row_id"], V.PORTION_RULES)


@query("""SELECT row_id, unnest(list_filter([CASE WHEN NOT coalesce(regexp_matches(block_id, '^blk-[A-Za-z0-9_-]+-[0-9]{4}$'), false) THEN 'block_id' END, CASE WHEN NOT coalesce(starts_with(block_id, 'blk-' || entry_id || '-'), false) THEN 'prefix' END,
 CASE WHEN NOT coalesce(confidence BETWEEN 0 AND 1, true) THEN 'confidence' END, CASE WHEN NOT coalesce(source_page_number >= 1, false) THEN 'source_page' END], lambda x: x IS NOT NULL)) AS rule FROM provenance_blocks""")
def v02_provenance_issues(spark, sf):
    return V.issues(table(spark, sf, "provenance_blocks"), ["row_id"], V.PROVENANCE_RULES)


@query("""WITH g AS (SELECT run_id, count(*) AS entries, count(DISTINCT entry_order) AS numbers, min(entry_order) AS least, max(entry_order) AS greatest FROM bundle_entries GROUP BY 1) SELECT * FROM g WHERE NOT (entries = numbers AND least = 1 AND greatest = entries)""")
def v03_order_gaps(spark, sf):
    return V.order_gaps(table(spark, sf, "bundle_entries"), "run_id", "entry_order")


@query("""WITH e AS (SELECT * FROM bundle_entries WHERE deleted_at IS NULL AND entry_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY run_id, entry_id ORDER BY row_id) = 1),
 s AS (SELECT *, lag(entry_id) OVER w AS p, lead(entry_id) OVER w AS n FROM e WINDOW w AS (PARTITION BY run_id ORDER BY entry_order, entry_id))
 SELECT run_id, entry_id, unnest(list_filter([CASE WHEN coalesce(prev_entry_id, '') <> coalesce(p, '') THEN 'prev' END, CASE WHEN coalesce(next_entry_id, '') <> coalesce(n, '') THEN 'next' END], lambda x: x IS NOT NULL)) AS rule FROM s""")
def v04_adjacency(spark, sf):
    return V.adjacency_issues(table(spark, sf, "bundle_entries"))


@query("""WITH e AS (SELECT * FROM bundle_entries WHERE deleted_at IS NULL AND entry_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY run_id, entry_id ORDER BY row_id) = 1)
 SELECT run_id, count(*) AS entries, string_agg(entry_id, ',' ORDER BY entry_order, entry_id) AS reading_order, min(printed_page_start) AS printed_start, max(printed_page_end) AS printed_end FROM e GROUP BY run_id""")
def k02_manifest(spark, sf):
    """Manifest head of each bundle from its live entries."""
    e = R.first_per_key(table(spark, sf, "bundle_entries").where("deleted_at IS NULL AND entry_id IS NOT NULL").select("run_id", "entry_id", "row_id", "entry_order", "printed_page_start", "printed_page_end"), ["run_id", "entry_id"], [F.col("row_id")])
    items = F.array_sort(F.collect_list(F.struct("entry_order", "entry_id")))
    return e.groupBy("run_id").agg(F.count("*").alias("entries"), F.array_join(F.transform(items, lambda x: x.entry_id), ",").alias("reading_order"), F.min("printed_page_start").alias("printed_start"), F.max("printed_page_end").alias("printed_end"))


@query("""WITH p AS (SELECT q.row_id, p.page, p.row_id AS r, array_to_string(list_transform(list_filter(p.blocks, lambda b: b.text <> ''), lambda b: b.text), chr(10)) AS t FROM portions q JOIN page_blocks p ON p.run_id = q.run_id AND p.page BETWEEN q.page_start AND q.page_end WHERE len(p.blocks) > 0)
 SELECT row_id, count(*) AS pages, md5(string_agg('[PAGE ' || page || ']' || chr(10) || t, chr(10) || chr(10) ORDER BY page, r)) AS text_md5 FROM p GROUP BY row_id""")
def k05_portion_texts(spark, sf):
    """Text of each portion from its pages (as a digest)."""
    t = F.array_join(F.transform(F.filter("blocks", lambda b: b.text != ""), lambda b: b.text), "\n")
    p = table(spark, sf, "page_blocks").where(F.size("blocks") > 0).select("run_id", "page", F.col("row_id").alias("r"), t.alias("t"))
    q = table(spark, sf, "portions").select("row_id", "run_id", "page_start", "page_end")
    x = R.range_join(p, q, ["run_id"], "page", "page_start", "page_end").withColumn("t", F.concat(F.lit("[PAGE "), F.col("page").cast("string"), F.lit("]\n"), "t"))
    both = x.groupBy("row_id").agg(F.count("*").alias("pages"), F.array_sort(F.collect_list(F.struct("page", "r", "t"))).alias("a"))
    return both.select("row_id", "pages", F.md5(F.array_join(F.transform("a", lambda s: s.t), "\n\n")).alias("text_md5"))
