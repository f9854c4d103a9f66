"""Queries of elements, content types and section boundaries over the test tables, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folium.functions import tagging as G
from folium.functions import text as T
from folium.operators import boundaries as B
from folium.operators.tagging import tag_elements
from folium.queries.document import _BL, blocks
from folium.runtime import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def wrap(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return wrap


def elements(spark: SparkSession, sf: str) -> DataFrame:
    """Blocks with text as elements: elem, run_id, page, row_id, ordinal, block_type, kind, text, y (rank in the page from 0 to 1), align (null), role."""
    full = F.array_sort(F.filter("blocks", lambda b: (b.text != "") & ~b.block_type.startswith("/")), lambda a, b: F.when(a.block_order < b.block_order, -1).when(a.block_order > b.block_order, 1).otherwise(0))
    p = table(spark, sf, "page_blocks").select("row_id", "run_id", "page", full.alias("x")).select("row_id", "run_id", "page", F.size("x").alias("n"), F.posexplode("x").alias("i", "b"))
    kind = F.when(F.col("b.block_type").isin("img", "figure"), "image").when(F.col("b.block_type") == "table", "table").otherwise("text")
    return p.select(
        (F.col("row_id") * 100000 + F.col("b.block_order")).alias("elem"), "run_id", "page", "row_id", F.col("b.block_order").alias("ordinal"), "b.block_type", kind.alias("kind"), "b.text",
        (F.col("i") / F.greatest(F.lit(1), F.col("n") - 1)).alias("y"), F.lit(None).cast("string").alias("align"), F.when(F.col("b.block_type").isin("header", "footer", "caption"), F.upper("b.block_type")).alias("role"),
    )


_E = """x AS (SELECT row_id, run_id, page, unnest(blocks) AS b FROM page_blocks), r AS (SELECT row_id, run_id, page, b.block_type AS block_type, b.text AS text, b.block_order AS ordinal FROM x WHERE b.text <> '' AND NOT starts_with(b.block_type, '/')),
 e AS (SELECT row_id * 100000 + ordinal AS elem, *, (row_number() OVER (PARTITION BY row_id ORDER BY ordinal) - 1) / greatest(1, count(*) OVER (PARTITION BY row_id) - 1) AS y,
  CASE WHEN block_type IN ('img', 'figure') THEN 'image' WHEN block_type = 'table' THEN 'table' ELSE 'text' END AS kind, CASE WHEN block_type IN ('header', 'footer', 'caption') THEN block_type END AS role FROM r)"""
_LOOK = r"""
 l AS (SELECT *, regexp_replace(text, '^[{BL}]+|[{BL}]+$', '', 'g') AS t, try_cast(nullif(regexp_extract(text, '^[{BL}]*([0-9]{1,3})[{BL}]*$', 1), '') AS INTEGER) AS number FROM e),
 k AS (SELECT *, len(regexp_extract_all(t, '\p{L}')) AS letters, upper(t) AS u, trim(regexp_extract(t, '^(.+?)\s+[0-9]+\s+[0-9]+\s*$', 1)) AS named, regexp_matches(t, '^[0-9]{1,3}\s*[-–]\s*[0-9]{1,3}\s*$') AS is_range,
  length(t) <= 120 AND (regexp_matches(t, '\.{3,}\s*[0-9]+\s*$') OR (regexp_matches(t, '\s{2,}[0-9]+\s*$') AND regexp_matches(t, '[A-Za-z]'))) OR regexp_matches(t, '^([-*•·]|\(?[0-9]{1,3}[).]|\(?[a-zA-Z][).])\s+\S') AS listed FROM l),
 m AS (SELECT *, regexp_matches(u, '\bSKILL\s*[0-9]{1,2}\b') AND regexp_matches(u, '\bSTAMINA\s*[0-9]{1,2}\b') AS stats, contains(t, '=') AND NOT regexp_matches(t, '[0-9]') AND length(t) <= 80 AND regexp_matches(t, '[A-Za-z]') AS field,
  regexp_matches(t, '\b[0-9]+\s+-\s+[0-9]+\b') AS minus, NOT contains(t, '=') AND length(t) <= 60 AND letters >= 4 AND len(regexp_extract_all(t, '\p{Lu}')) >= 0.9::DOUBLE * letters AS caps FROM k),
 n AS (SELECT *, NOT stats AND (regexp_matches(u, '^SKILL\s+STAMINA\s*$') OR (length(named) BETWEEN 5 AND 50 AND regexp_matches(named, '[A-Za-z]')) OR len(regexp_extract_all(t, '\|')) >= 2
   OR len(list_filter(regexp_split_to_array(t, '\s{2,}'), lambda q: trim(q) <> '')) >= 3 OR (len(regexp_extract_all(t, '[0-9]')) >= 6 AND letters >= 3 AND regexp_matches(t, '\s{2,}'))) AS tabled FROM m),
 c AS (SELECT *, CASE WHEN role = 'header' THEN ('Page-header', 0.95) WHEN role = 'footer' THEN ('Page-footer', 0.95) WHEN role = 'caption' THEN ('Caption', 0.95) WHEN kind = 'image' THEN ('Picture', 0.9) WHEN kind = 'table' THEN ('Table', 0.9)
   WHEN t = '' THEN ('Text', 0.0) WHEN field AND regexp_matches(t, '^[A-Za-z][A-Za-z\s]{1,30}\s*=\s*$') THEN ('Text', 0.75) WHEN field THEN ('Text', 0.7) WHEN stats THEN ('Text', 0.8) WHEN number BETWEEN 1 AND 600 THEN ('Section-header', 0.9)
   WHEN tabled THEN ('Table', 0.85) WHEN listed THEN ('List-item', 0.85) WHEN length(t) <= 120 AND regexp_matches(t, '(?i)^(fig\.?|figure|table|illustration)\s+[0-9]+') THEN ('Caption', 0.8)
   WHEN length(t) <= 80 AND (regexp_matches(t, '\b[0-9]+\s*[+*/]\s*[0-9]+\b') OR minus OR (contains(t, '=') AND (regexp_matches(t, '[0-9]') OR regexp_matches(t, '[+*/^]') OR minus) AND regexp_matches(t, '\b\w+\s*=\s*\w+')) OR (regexp_matches(t, '[≈≠≤≥]') AND regexp_matches(t, '[0-9]'))) THEN ('Formula', 0.75)
   WHEN caps AND length(t) <= 30 THEN ('Title', 0.75) WHEN caps THEN ('Section-header', 0.75) ELSE ('Text', 0.6) END AS cls FROM n)""".replace("{BL}", _BL)


@query(f"WITH {_E}, {_LOOK} SELECT elem, cls[1] AS label, CAST(cls[2] AS DOUBLE) AS confidence FROM c")
def f19_element_classes(spark, sf):
    """Class of each element by its look alone."""
    e = elements(spark, sf)
    c = G.element_class(F.col("kind"), F.col("text"), F.col("align"), F.col("role"))
    return e.select("elem", c.label.alias("label"), c.confidence.alias("confidence"))


@query(f"""WITH {_E}, {_LOOK}, lo AS (SELECT run_id, greatest(3, CAST(floor(count(DISTINCT page) * 0.2::DOUBLE) AS BIGINT)) AS least FROM e GROUP BY 1),
 s AS (SELECT *, lower(trim(regexp_replace(t, '[{_BL}]+', ' ', 'g'))) AS sig FROM c),
 hs AS (SELECT run_id, sig FROM s JOIN lo USING (run_id) WHERE y <= 0.08 AND length(t) <= 90 AND sig <> '' GROUP BY run_id, sig, least HAVING count(DISTINCT page) >= least),
 fs AS (SELECT run_id, sig FROM s JOIN lo USING (run_id) WHERE y >= 0.92 AND length(t) <= 90 AND sig <> '' GROUP BY run_id, sig, least HAVING count(DISTINCT page) >= least),
 p AS (SELECT s.*, least, CAST(cls[2] AS DOUBLE) AS c0, hs.sig IS NOT NULL AS is_head, fs.sig IS NOT NULL AS is_foot, CASE WHEN y <= 0.10 THEN 'top' WHEN y >= 0.90 THEN 'bottom' ELSE 'middle' END AS v FROM s JOIN lo USING (run_id) LEFT JOIN hs ON hs.run_id = s.run_id AND hs.sig = s.sig LEFT JOIN fs ON fs.run_id = s.run_id AND fs.sig = s.sig),
 d AS (SELECT *, CASE WHEN role IS NOT NULL THEN (cls[1], c0) WHEN number >= 1 AND y >= 0.92 THEN ('Page-footer', greatest(c0, 0.9::DOUBLE)) WHEN y <= 0.08 AND is_range THEN ('Page-header', greatest(c0, 0.85::DOUBLE))
   WHEN is_head THEN ('Page-header', greatest(c0, 0.9::DOUBLE)) WHEN is_foot THEN ('Page-footer', greatest(c0, 0.9::DOUBLE)) ELSE (cls[1], c0) END AS dd FROM p),
 nu AS (SELECT elem, run_id, page, t, number, is_range, v, least FROM p WHERE number IS NOT NULL OR is_range),
 nl AS (SELECT *, lag(page) OVER w AS pp, lag(number) OVER w AS pn FROM nu WHERE NOT is_range WINDOW w AS (PARTITION BY run_id, v ORDER BY page, elem)),
 ni AS (SELECT *, sum(CASE WHEN pp IS NOT NULL AND (page = pp + 1 OR (page > pp AND number = pn + 1)) THEN 0 ELSE 1 END) OVER (PARTITION BY run_id, v ORDER BY page, elem ROWS UNBOUNDED PRECEDING) AS g FROM nl),
 ru AS (SELECT elem FROM (SELECT elem, count(*) OVER (PARTITION BY run_id, v, g) AS n FROM ni) WHERE n >= 3),
 re AS (SELECT *, count(*) OVER (PARTITION BY run_id, v) AS n_spot, count(*) OVER (PARTITION BY run_id, v, t) >= least AS repeats, sum(CASE WHEN is_range THEN 0 ELSE 1 END) OVER (PARTITION BY run_id, v) AS n_bottom FROM nu WHERE elem NOT IN (SELECT elem FROM ru)),
 rf AS (SELECT *, sum(CASE WHEN NOT repeats AND is_range THEN 1 ELSE 0 END) OVER (PARTITION BY run_id, v) AS n_ranges, sum(CASE WHEN NOT repeats AND NOT is_range THEN 1 ELSE 0 END) OVER (PARTITION BY run_id, v) AS n_numbers FROM re WHERE n_spot >= least),
 pt AS (SELECT elem, 'Page-footer' AS pl, 0.99::DOUBLE AS pc FROM ru UNION ALL SELECT elem, CASE WHEN v = 'top' THEN 'Page-header' ELSE 'Page-footer' END, CASE WHEN v = 'top' AND repeats THEN 0.9::DOUBLE
   WHEN v = 'top' AND n_ranges >= greatest(5, least) THEN CASE WHEN is_range THEN 0.9::DOUBLE END WHEN v = 'top' AND n_numbers >= greatest(5, least) THEN CASE WHEN NOT is_range THEN 0.85::DOUBLE END
   WHEN v = 'bottom' AND n_bottom >= least THEN CASE WHEN NOT is_range THEN 0.85::DOUBLE END END FROM rf),
 q AS (SELECT d.*, coalesce(pc > CAST(dd[2] AS DOUBLE), false) AS surer, pl, pc FROM d LEFT JOIN (SELECT * FROM pt WHERE pc IS NOT NULL) pt USING (elem)),
 z AS (SELECT *, CASE WHEN surer THEN pl ELSE dd[1] END AS lab, CASE WHEN surer THEN pc ELSE CAST(dd[2] AS DOUBLE) END AS conf FROM q),
 tp AS (SELECT elem FROM z WHERE kind = 'text' AND t <> '' QUALIFY row_number() OVER (PARTITION BY run_id, page ORDER BY y, ordinal, elem) = 1)
 SELECT elem, CASE WHEN ti THEN 'Title' ELSE lab END AS label, CASE WHEN ti THEN greatest(conf, 0.75::DOUBLE) ELSE conf END AS confidence FROM
  (SELECT z.*, tp.elem IS NOT NULL AND lab IN ('Text', 'Section-header') AND conf < 0.8 AND y <= 0.08 AND NOT is_head AND number IS NULL AND NOT listed AND NOT tabled AS ti FROM z LEFT JOIN tp USING (elem))""")
def c20_content_types(spark, sf):
    """Content types after all passes: look, edges, patterns of numbers, titles."""
    e = elements(spark, sf).withColumn("ordinal", F.struct("ordinal", "elem"))
    return tag_elements(e)


@query(f"""WITH {_E}, n AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY ordinal) AS seq FROM e) SELECT elem, seq, coalesce(page, 1) AS page, CASE WHEN contains(lower(block_type), 'image') OR lower(block_type) = 'figure' THEN 'image' WHEN contains(lower(block_type), 'table') THEN 'table'
 WHEN regexp_matches(lower(block_type), 'title|text|listitem|header|footer|caption|pagebreak|unknown') THEN 'text' ELSE 'other' END AS kind, regexp_replace(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)), '^[{_BL}]+|[{_BL}]+$', '', 'g') AS clean
 FROM n WHERE regexp_replace(text, '[{_BL}]+', '', 'g') <> ''""")
def f01_reduced(spark, sf):
    """Elements reduced to id, sequence number, page, kind and clean text; empty ones go, their numbers stay."""
    from pyspark.sql import Window

    n = elements(spark, sf).withColumn("seq", F.row_number().over(Window.partitionBy("row_id").orderBy("ordinal")).cast("long"))
    clean = T.strip(F.replace(F.replace("text", F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n")))
    return n.select("elem", "seq", F.coalesce("page", F.lit(1)).alias("page"), T.element_kind("block_type").alias("kind"), clean.alias("clean")).where("clean != ''")


_H = """h AS (SELECT run_id, lower(trim(text)) AS section, page, block_order AS line, row_id * 100000 + block_order AS ordinal, row_id, trim(text) AS body FROM b WHERE block_type IN ('h1', 'h2') AND trim(text) <> ''),
 c AS (SELECT h.*, coalesce((SELECT sum(length(o.text)) FROM b o WHERE o.row_id = h.row_id AND o.block_order > h.line), 0) AS score FROM h)"""


def _candidates(spark, sf) -> DataFrame:
    """Headings as candidates of section starts; the score is the text after them on their page."""
    after = F.aggregate(F.filter("blocks", lambda o: o.block_order > F.col("b.block_order")), F.lit(0).cast("long"), lambda n, o: n + F.coalesce(F.length(o.text), F.lit(0)))
    p = table(spark, sf, "page_blocks").select("row_id", "run_id", "page", "blocks", F.explode("blocks").alias("b")).where(F.col("b.block_type").isin("h1", "h2") & (F.trim("b.text") != ""))
    return p.select("run_id", F.lower(F.trim("b.text")).alias("section"), "page", F.col("b.block_order").alias("line"), (F.col("row_id") * 100000 + F.col("b.block_order")).alias("ordinal"), F.trim("b.text").alias("body"), after.alias("score"))


_BB = "b AS (SELECT row_id, run_id, page, x.block_type AS block_type, x.text AS text, x.block_order AS block_order FROM (SELECT row_id, run_id, page, unnest(blocks) AS x FROM page_blocks))"
_CH = "k AS (SELECT * FROM c QUALIFY score >= max(score) OVER (PARTITION BY run_id, section) - 50), ch AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY run_id, section ORDER BY coalesce(page, 0), line, score DESC, ordinal) = 1)"


@query(f"WITH {_BB}, {_H}, {_CH} SELECT run_id, section, page, line, ordinal FROM ch")
def a05_chosen_boundaries(spark, sf):
    """The start of each section among its headings: the earliest with about as much text as the best."""
    return B.choose_boundaries(_candidates(spark, sf), ["run_id", "section"]).select("run_id", "section", "page", "line", "ordinal")


@query(rf"""WITH {_BB}, {_H}, {_CH}, tk AS (SELECT c.run_id, c.section, c.ordinal, c.score, ch.ordinal AS chosen, list_distinct(list_filter(string_split(regexp_replace(lower(c.body), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: length(x) >= 1)) AS o,
  list_distinct(list_filter(string_split(regexp_replace(lower(ch.body), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: length(x) >= 1)) AS w FROM c JOIN ch ON c.run_id = ch.run_id AND c.section = ch.section)
 SELECT run_id, section, count(*) AS candidates, CAST(max(score) AS BIGINT) AS max_score, min(chosen) AS chosen, round(max(CASE WHEN len(o) > 0 AND len(w) > 0 AND ordinal <> chosen THEN len(list_intersect(o, w)) / len(list_distinct(list_concat(o, w))) END), 6) AS similarity
 FROM tk GROUP BY run_id, section HAVING count(*) > 1""")
def a06_duplicate_sections(spark, sf):
    """Sections with several headings."""
    c = _candidates(spark, sf)
    return B.duplicate_report(c, ["run_id", "section"], B.choose_boundaries(c, ["run_id", "section"])).withColumn("similarity", F.round("similarity", 6))


_SE = """el AS (SELECT run_id, entry_order AS seq, min(entry_id) AS elem FROM bundle_entries WHERE entry_id IS NOT NULL AND entry_order IS NOT NULL GROUP BY ALL), st AS (SELECT run_id, coalesce(kind, 'none') AS section, min(entry_order) AS start_seq FROM bundle_entries WHERE entry_order IS NOT NULL GROUP BY ALL),
 la AS (SELECT run_id, max(seq) AS last FROM el GROUP BY 1), cl AS (SELECT st.run_id, section, start_seq, coalesce(lead(start_seq) OVER (PARTITION BY st.run_id ORDER BY start_seq, section) - 1, last) AS end_seq FROM st LEFT JOIN la ON la.run_id = st.run_id)"""


@query(f"""WITH {_SE} SELECT cl.run_id, section, start_seq, CASE WHEN n.elem IS NOT NULL THEN end_seq + 1 ELSE end_seq END AS end_seq, s.elem AS start_id, coalesce(n.elem, t.elem) AS end_id FROM cl JOIN el s ON s.run_id = cl.run_id AND s.seq = start_seq
 LEFT JOIN el t ON t.run_id = cl.run_id AND t.seq = end_seq LEFT JOIN el n ON n.run_id = cl.run_id AND start_seq = end_seq AND n.seq = end_seq + 1""")
def w02_closed_sections(spark, sf):
    """Stretches of entries of a kind: from the first entry of the kind to the one before the next kind begins (W2), those of one entry widened by one (W3)."""
    e = table(spark, sf, "bundle_entries").where("entry_order IS NOT NULL")
    el = e.where("entry_id IS NOT NULL").groupBy("run_id", F.col("entry_order").alias("seq")).agg(F.min("entry_id").alias("elem"))
    return B.close_boundaries(e.select("run_id", F.coalesce("kind", F.lit("none")).alias("section"), F.col("entry_order").alias("start_seq")), el, "run_id", "section")


@query("SELECT run_id, entry_order, row_id, entry_id FROM bundle_entries WHERE entry_order IS NOT NULL QUALIFY row_number() OVER (PARTITION BY run_id, entry_order ORDER BY row_id) = 1")
def w13_rising(spark, sf):
    """Entries whose order strictly rises: the first delivery of each place."""
    return B.rising(table(spark, sf, "bundle_entries").select("run_id", "entry_order", "row_id", "entry_id"), ["run_id"], "entry_order", "row_id")


@query("""WITH d AS (SELECT run_id, row_id, coalesce(page_start, 1000000000) AS o, coalesce(starts_with(lower(title), 'notes'), false) AS op, coalesce(contains(lower(title), ' of '), false) AS cu, coalesce(confidence < 0.4, false) AS la FROM portions WHERE run_id IS NOT NULL),
 n AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY o, row_id) AS i FROM d), p AS (SELECT run_id, coalesce(min(CASE WHEN op THEN i END), min(CASE WHEN cu THEN i END)) AS pv FROM n GROUP BY 1)
 SELECT row_id, CASE WHEN NOT coalesce(i >= pv, false) THEN 'front' WHEN la THEN 'end' ELSE 'game' END AS phase FROM n JOIN p ON p.run_id = n.run_id""")
def w16_phases(spark, sf):
    """Phases of a run's portions around a pivot: the first title with 'notes', else the first with 'of'."""
    q = table(spark, sf, "portions").where("run_id IS NOT NULL")
    title = F.lower("title")
    d = B.phases(q, "run_id", [F.coalesce("page_start", F.lit(1000000000)), F.col("row_id")], title.startswith("notes"), title.contains(" of "), F.col("confidence") < 0.4)
    return d.select("row_id", "phase")


@query(rf"""WITH {_E}, l AS (SELECT row_id, ordinal, regexp_replace(text, '^[{_BL}]+|[{_BL}]+$', '', 'g') AS t FROM e), w AS (SELECT *, lag(t) OVER (PARTITION BY row_id ORDER BY ordinal) AS p, lead(t) OVER (PARTITION BY row_id ORDER BY ordinal) AS n FROM l),
 g AS (SELECT *, coalesce(p = '' OR regexp_matches(p, '[.!?:;"''”’)]$'), true) OR coalesce(n = '' OR regexp_matches(n, '^\p{{Lu}}'), true) AS calm, regexp_replace(t, '[^0-9]', '', 'g') AS digits FROM w WHERE regexp_matches(t, '[0-9]') AND (length(t) <= 5 OR regexp_matches(t, '^[0-9]+$'))),
 nx AS (SELECT *, unnest(list_distinct(list_concat([t, digits], regexp_extract_all(t, '[0-9]{{1,3}}')))) AS number FROM g), k AS (SELECT DISTINCT row_id, CAST(page_number AS VARCHAR) AS number FROM page_blocks WHERE page_number IS NOT NULL),
 h AS (SELECT row_id, number, ordinal, calm, CASE WHEN t = number THEN 'exact' WHEN digits = number AND length(t) <= 5 THEN 'digits' WHEN digits <> number AND length(t) <= 5 THEN 'part' END AS how FROM nx JOIN k USING (row_id, number))
 SELECT row_id, number, ordinal, how FROM h WHERE how IS NOT NULL AND (how <> 'exact' OR calm)""")
def j09_number_hits(spark, sf):
    """Elements of a page that show its page number."""
    w = table(spark, sf, "page_blocks").where("page_number IS NOT NULL").select("row_id", F.col("page_number").cast("string").alias("number"))
    return B.number_hits(elements(spark, sf).select("row_id", "ordinal", "text"), w, ["row_id"], "ordinal", "text")


@query(r"""WITH d AS (SELECT run_id, row_id, coalesce(entry_id, '') AS old_id, nullif(regexp_extract(coalesce(text, ''), '^\s*([0-9]{1,4})\b', 1), '') AS claim FROM preview_blocks), f AS (SELECT run_id, claim, min(row_id) AS row_id FROM d WHERE claim IS NOT NULL GROUP BY 1, 2)
 SELECT d.run_id, d.row_id, old_id, CASE WHEN f.row_id IS NOT NULL THEN d.claim ELSE old_id END AS new_id FROM d LEFT JOIN f ON f.run_id = d.run_id AND f.row_id = d.row_id""")
def f32_remapped(spark, sf):
    """Preview blocks renamed by the number that their text begins with, first claimant first."""
    p = table(spark, sf, "preview_blocks").withColumn("entry_id", F.coalesce("entry_id", F.lit("")))
    return B.remap_ids(p, ["run_id"], "entry_id", "text", "row_id")


@query(r"""WITH t AS (SELECT row_id, entry_id, text FROM preview_blocks) SELECT row_id, coalesce(regexp_matches(CAST(row_id AS VARCHAR), '^[0-9]+$') AND NOT coalesce(regexp_extract(string_split_regex(regexp_replace(coalesce(text, ''), '^[{BL}]+|[{BL}]+$', '', 'g'), '\r\n|\r|\n')[1], '^\s*([0-9]{1,4})\b', 1) = CAST(row_id AS VARCHAR), false), false) AS mismatch FROM t""".replace("{BL}", _BL))
def f31_number_mismatch(spark, sf):
    """Preview blocks whose first line does not begin with their number."""
    return table(spark, sf, "preview_blocks").select("row_id", T.number_mismatch(F.col("row_id").cast("string"), "text").alias("mismatch"))


@query(rf"""WITH {_BB}, h AS (SELECT run_id, page, row_id, block_order, trim(regexp_replace(text, '[{_BL}]+', ' ', 'g')) AS t, row_number() OVER (PARTITION BY row_id ORDER BY block_order) - 1 AS pos FROM b WHERE block_type = 'h1' AND page BETWEEN 1 AND 5 AND trim(text) <> ''),
 s AS (SELECT *, (6 - page) * 10 + (10 - least(pos, 9)) * 2 + CASE WHEN len(string_split(t, ' ')) BETWEEN 2 AND 5 THEN 20 WHEN len(string_split(t, ' ')) = 1 THEN 5 WHEN len(string_split(t, ' ')) <= 10 THEN 10 ELSE 0 END
  + CASE WHEN regexp_matches(t, '^\p{{Lu}}.*\p{{Lu}}') THEN 15 ELSE 0 END + CASE WHEN length(t) <= 50 THEN 10 WHEN length(t) <= 100 THEN 5 ELSE 0 END AS score FROM h)
 SELECT run_id, t AS title, score FROM s WHERE score >= 20 QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY score DESC, page, row_id, block_order) = 1""")
def f24_titles(spark, sf):
    """The likeliest title of each run among the first headings of its first five pages."""
    from folium.operators.relational import first_per_key

    heads = F.filter("blocks", lambda b: (b.block_type == "h1") & (F.trim(b.text) != ""))
    heads = F.array_sort(heads, lambda a, b: F.when(a.block_order < b.block_order, -1).when(a.block_order > b.block_order, 1).otherwise(0))
    h = table(spark, sf, "page_blocks").where("page BETWEEN 1 AND 5").select("run_id", "page", "row_id", F.posexplode(heads).alias("pos", "b"))
    s = h.select("run_id", "page", "row_id", F.col("b.block_order").alias("o"), T.collapse("b.text").alias("title"), T.title_score(F.col("b.text"), F.col("page"), F.col("pos")).cast("long").alias("score")).where("score >= 20")
    return first_per_key(s, ["run_id"], [-F.col("score"), F.col("page"), F.col("row_id"), F.col("o")]).select("run_id", "title", "score")
