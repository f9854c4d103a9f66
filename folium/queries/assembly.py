"""Queries of assembly, gates and content tagging over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folium.functions import text as T
from folium.operators import gates as Q
from folium.operators import relational as R
from folium.queries.document import _B, _BL, _P1, blocks, first_pages
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


_SIG = r"lower(trim(regexp_replace(text, '\s+', ' ', 'g')))"


@query(f"""WITH {_B}, f AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY block_order) AS a, row_number() OVER (PARTITION BY row_id ORDER BY block_order DESC) AS z FROM b WHERE text <> ''),
 s AS (SELECT run_id, page, CASE WHEN a = 1 THEN 'top' ELSE 'bottom' END AS place, {_SIG} AS signature FROM f WHERE (a = 1 OR z = 1) AND length(text) <= 90),
 p AS (SELECT run_id, greatest(3, CAST(floor(count(DISTINCT page) * 0.2::DOUBLE) AS BIGINT)) AS least FROM page_blocks GROUP BY 1)
 SELECT run_id, place, signature, count(DISTINCT page) AS pages FROM s JOIN p USING (run_id) GROUP BY run_id, place, signature, least HAVING count(DISTINCT page) >= least""")
def c20_repeated_edges(spark, sf):
    """Texts that stand first or last on at least three pages and a fifth of the run's pages."""
    full = F.filter("blocks", lambda b: b.text != "")
    full = F.array_sort(full, lambda a, b: F.when(a.block_order < b.block_order, -1).when(a.block_order > b.block_order, 1).otherwise(0))
    p = table(spark, sf, "page_blocks").where(F.size("blocks") > 0).select("run_id", "page", full.alias("x")).where(F.size("x") > 0)
    one = lambda place, i: F.struct(F.lit(place).alias("place"), F.element_at("x", i).text.alias("text"))
    ends = p.select("run_id", "page", F.explode(F.when(F.size("x") > 1, F.array(one("top", 1), one("bottom", -1))).otherwise(F.array(one("top", 1)))).alias("e")).select("run_id", "page", "e.*").where(F.length("text") <= 90)
    sig = F.lower(F.trim(F.regexp_replace("text", r"\s+", " "))).alias("signature")
    n = table(spark, sf, "page_blocks").groupBy("run_id").agg(F.greatest(F.lit(3), F.floor(F.countDistinct("page") * 0.2)).alias("least"))
    s = ends.groupBy("run_id", "place", sig).agg(F.countDistinct("page").alias("pages"))
    return s.join(n, "run_id").where("pages >= least").drop("least")


@query(f"""WITH {_B}, p AS (SELECT run_id, page, count(*) AS cells FROM b WHERE block_type IN ('td', 'th') GROUP BY ALL), g AS (SELECT *, page - row_number() OVER (PARTITION BY run_id ORDER BY page) AS island FROM p),
 c AS (SELECT run_id, min(page) AS first_page, max(page) AS last_page, max(cells) AS most, CAST(sum(cells) AS BIGINT) AS cells, count(*) AS pages FROM g GROUP BY run_id, island)
 SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY most DESC, cells DESC, pages DESC, first_page) = 1""")
def q05_table_cluster(spark, sf):
    """The best stretch of successive pages with tables of each run."""
    p = blocks(spark, sf).where(F.col("block_type").isin("td", "th")).groupBy("run_id", "page").agg(F.count("*").alias("n"))
    p = materialize(p, "pages")
    g = R.islands_by(R.with_neighbours(p, ["run_id"], "page", ["page"], after=False), ["run_id"], "page", F.col("page") != F.col("prev.page") + 1)
    c = g.groupBy("run_id", "island").agg(F.min("page").alias("first_page"), F.max("page").alias("last_page"), F.max("n").alias("most"), F.sum("n").alias("cells"), F.count("*").alias("pages")).drop("island")
    return R.first_per_key(c, ["run_id"], [-F.col("most"), -F.col("cells"), -F.col("pages"), F.col("first_page")])


@query("SELECT row_id, run_id, row_number() OVER (PARTITION BY run_id ORDER BY confidence NULLS FIRST, row_id) AS turn FROM portions WHERE run_id IS NOT NULL")
def q06_round_robin(spark, sf):
    p = table(spark, sf, "portions").where("run_id IS NOT NULL").select("row_id", "run_id", "confidence")
    return Q.round_robin(p, "run_id", [F.asc_nulls_first("confidence"), F.col("row_id")]).select("row_id", "run_id", F.col("turn").cast("long").alias("turn"))


@query(f"WITH {_P1} SELECT run_id, page, array_to_string(list(page) OVER (PARTITION BY run_id ORDER BY page ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING), ',') AS context FROM p1 WHERE page IS NOT NULL")
def q07_context_pages(spark, sf):
    c = Q.context(first_pages(spark, sf).select("run_id", "page"), ["run_id"], "page", "page", 2, 2)
    return c.select("run_id", "page", F.array_join(F.transform("context", lambda x: x.cast("string")), ",").alias("context"))


@query("""WITH f AS (SELECT run_id, CASE WHEN NOT coalesce(page_start >= 1 AND page_start <= page_end, false) THEN 'fail' WHEN title IS NULL OR portion_type IS NULL THEN 'warn' ELSE 'ok' END AS level FROM portions WHERE run_id IS NOT NULL),
 g AS (SELECT run_id, CAST(sum(CASE WHEN level = 'fail' THEN 1 ELSE 0 END) AS BIGINT) AS failures, CAST(sum(CASE WHEN level = 'warn' THEN 1 ELSE 0 END) AS BIGINT) AS warnings FROM f GROUP BY 1)
 SELECT *, CASE WHEN failures > 0 THEN 'fail' WHEN warnings > 0 THEN 'needs_review' ELSE 'pass' END AS verdict FROM g""")
def q10_conformance(spark, sf):
    p = table(spark, sf, "portions").where("run_id IS NOT NULL")
    ok = F.coalesce(F.expr("page_start >= 1 AND page_start <= page_end"), F.lit(False))
    level = F.when(~ok, "fail").when(F.col("title").isNull() | F.col("portion_type").isNull(), "warn").otherwise("ok")
    return Q.conformance(p.select("run_id", level.alias("level")), ["run_id"])


_TOK = r"list_distinct(list_filter(string_split(regexp_replace(lower(array_to_string(list_transform(blocks, lambda b: b.text), ' ')), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: length(w) >= 3))"


_ALL = r"list_filter(string_split(regexp_replace(lower(array_to_string(list_transform(blocks, lambda b: b.text), ' ')), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: length(w) >= 3)"


@query(f"""WITH fl AS (SELECT run_id, page, min(row_id) AS f, max(row_id) AS l FROM page_blocks WHERE len(blocks) > 0 GROUP BY ALL), m AS (SELECT row_id, {_ALL} AS t, length(array_to_string(list_transform(blocks, lambda b: coalesce(b.text, '')), ' ')) AS chars FROM page_blocks WHERE len(blocks) > 0)
 SELECT run_id, page, f AS old_row_id, CASE WHEN l <> f THEN l END AS new_row_id, CASE WHEN l = f THEN 'no_candidate' WHEN len(n.t) = 0 THEN 'empty' WHEN len(o.t) > 0 AND len(list_filter(o.t, lambda w: list_contains(n.t, w))) / len(o.t) < 0.95::DOUBLE THEN 'lost_text' WHEN o.chars >= 120 AND n.chars / o.chars < 0.9::DOUBLE THEN 'too_short' ELSE 'accepted' END AS decision FROM fl JOIN m o ON o.row_id = f JOIN m n ON n.row_id = l""")
def q01_retention(spark, sf):
    """Whether the last delivery of a page may replace the first: it must keep 95 % of its words, repeated ones counted each, and 90 % of a longer page's length."""
    text = F.array_join(F.transform("blocks", lambda b: F.coalesce(b.text, F.lit(""))), " ")
    words = F.filter(F.split(F.regexp_replace(F.lower(text), r"[^a-z0-9]+", " "), " "), lambda w: F.length(w) >= 3)
    r = table(spark, sf, "page_blocks").where(F.size("blocks") > 0).select("run_id", "page", "row_id", words.alias("t"), F.length(text).alias("chars"))
    first = R.first_per_key(r, ["run_id", "page"], [F.col("row_id")])
    last = R.first_per_key(r, ["run_id", "page"], [-F.col("row_id")]).join(first.select("run_id", "page", F.col("row_id").alias("_f")), ["run_id", "page"]).where("row_id != _f").drop("_f")
    kept = F.when(F.size("old_t") > 0, F.size(F.filter("old_t", lambda w: F.array_contains("new_t", w))) / F.size("old_t")).otherwise(1.0)
    d = Q.decide(first, last, ["run_id", "page"], [("empty", F.size("new_t") == 0), ("lost_text", kept < 0.95), ("too_short", (F.col("old_chars") >= 120) & (F.col("new_chars") / F.col("old_chars") < 0.9))])
    return d.select("run_id", "page", "old_row_id", "new_row_id", "decision")


@query(r"""WITH w AS (SELECT doc_id, t, regexp_extract_all(t, '[^""" + _BL + r"""]+') AS ws, length(regexp_replace(t, '\P{L}+', '', 'g')) AS letters, length(regexp_replace(t, '[^\p{L}\p{N}""" + _BL + r"""]+', '', 'g')) AS plain FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents))
 SELECT doc_id, round(least(1.0::DOUBLE, least(0.3::DOUBLE * len(regexp_extract_all(t, '\|\s*[0-9]+')), 0.8::DOUBLE) + CASE WHEN len(ws) > 0 AND list_sum(list_transform(ws, lambda x: length(x))) > 15 * len(ws) THEN 0.4::DOUBLE ELSE 0 END
  + CASE WHEN plain > 0 AND letters / greatest(plain, 1) < 0.3::DOUBLE THEN 0.3::DOUBLE ELSE 0 END + CASE WHEN len(regexp_extract_all(t, '[^\p{L}\p{M}\p{N}_""" + _BL + r""".,!?]{3,}')) > 2 THEN 0.2::DOUBLE ELSE 0 END), 4) AS score FROM w""")
def a15_corruption(spark, sf):
    """Signs of a broken scan in every document, whatever its language; a null text counts as empty."""
    return table(spark, sf, "documents").select("doc_id", T.corruption_score("text").alias("score"))


@query("""SELECT run_id, page, row_id FROM (SELECT run_id, page, row_id, CAST(coalesce(list_sum(list_transform(blocks, lambda b: length(b.text))), 0) AS BIGINT) AS chars FROM page_blocks) QUALIFY row_number() OVER (PARTITION BY run_id, page ORDER BY chars DESC, row_id) = 1""")
def a19_best_delivery(spark, sf):
    """The delivery of each page that has most text."""
    chars = F.aggregate(F.coalesce("blocks", F.expr("array()")), F.lit(0).cast("long"), lambda acc, b: acc + F.coalesce(F.length(b.text), F.lit(0)))
    p = table(spark, sf, "page_blocks").select("run_id", "page", "row_id", chars.alias("chars"))
    return R.argmax(p, ["run_id", "page"], ["chars"], "row_id").select("run_id", "page", "row_id")


@query("""WITH c AS (SELECT run_id, entry_id, row_id, 0 AS fresh, 0 AS k, next_entry_id AS target, 'next' AS claim_type, kind, path FROM bundle_entries
  UNION ALL SELECT run_id, entry_id, row_id, 1, 0, prev_entry_id, 'prev', kind, path FROM bundle_entries UNION ALL SELECT run_id, entry_id, row_id, 1, 1, next_entry_id, 'next', kind, path FROM bundle_entries),
 f AS (SELECT *, row_number() OVER (PARTITION BY run_id, entry_id, trim(target), claim_type, coalesce(kind, ''), coalesce(path, '') ORDER BY fresh, row_id, k) AS n FROM c WHERE trim(coalesce(target, '')) <> '')
 SELECT run_id, entry_id, string_agg(claim_type || ':' || target, ' ' ORDER BY fresh, row_id, k) AS claims FROM f WHERE n = 1 GROUP BY run_id, entry_id""")
def a32_merged_claims(spark, sf):
    """Claims that each entry's deliveries make of their neighbours, merged in order of first occurrence."""
    claim = lambda kind: F.struct(F.col(f"{kind}_entry_id").alias("target"), F.lit(kind).alias("claim_type"), F.col("kind").alias("module_id"), F.col("path").alias("evidence_path"))
    e = table(spark, sf, "bundle_entries").select("run_id", "entry_id", "row_id", F.array(claim("next")).alias("old"), F.array(claim("prev"), claim("next")).alias("new"))
    every = lambda c: F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("row_id", c))), lambda x: x[c]))
    g = e.groupBy("run_id", "entry_id").agg(every("old").alias("old"), every("new").alias("new")).select("run_id", "entry_id", T.merge_claims(F.col("old"), F.col("new")).alias("c")).where(F.size("c") > 0)
    return g.select("run_id", "entry_id", F.array_join(F.transform("c", lambda x: F.concat(x.claim_type, F.lit(":"), x.target)), " ").alias("claims"))


@query(r"""WITH p AS (SELECT row_id, list_distinct(list_filter(string_split(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: length(w) >= 3)) AS s,
 list_distinct(list_filter(string_split(regexp_replace(lower(regexp_replace(html_text, '<[^>]*>', ' ', 'g')), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: length(w) >= 3)) AS o FROM preview_blocks WHERE html_text IS NOT NULL)
 SELECT row_id, round(CASE WHEN len(s) > 0 THEN len(list_intersect(s, o)) / len(s) ELSE 1.0 END, 6) AS coverage FROM p""")
def a37_token_coverage(spark, sf):
    p = table(spark, sf, "preview_blocks").where("html_text IS NOT NULL")
    return p.select("row_id", F.round(T.token_coverage(T.tokens_of("text", 3), T.tokens_of(F.regexp_replace("html_text", "<[^>]*>", " "), 3)), 6).alias("coverage"))


@query("""WITH q AS (SELECT * FROM bundle_entries WHERE entry_id IS NOT NULL AND printed_page_start IS NOT NULL QUALIFY row_number() OVER (PARTITION BY run_id, entry_id ORDER BY row_id) = 1),
 m AS (SELECT run_id, max(printed_page_end) AS m FROM bundle_entries GROUP BY 1), n AS (SELECT *, lead(printed_page_start) OVER (PARTITION BY run_id ORDER BY printed_page_start, entry_id) AS nx FROM q)
 SELECT n.run_id, entry_id, printed_page_start, CASE WHEN nx > printed_page_start THEN nx - 1 WHEN nx IS NOT NULL THEN printed_page_start ELSE m END AS printed_stop FROM n JOIN m ON m.run_id = n.run_id""")
def w04_printed_ends(spark, sf):
    """End of each entry's printed pages: before the next start if that is later, else its own start; the last ends with the run."""
    e = table(spark, sf, "bundle_entries")
    q = R.first_per_key(e.where("entry_id IS NOT NULL AND printed_page_start IS NOT NULL").select("run_id", "entry_id", "row_id", "printed_page_start"), ["run_id", "entry_id"], [F.col("row_id")])
    m = e.groupBy("run_id").agg(F.max("printed_page_end").alias("m"))
    nx = F.lead("printed_page_start").over(W.partitionBy("run_id").orderBy("printed_page_start", "entry_id"))
    stop = F.when(F.col("nx") > F.col("printed_page_start"), F.col("nx") - 1).when(F.col("nx").isNotNull(), F.col("printed_page_start")).otherwise(F.col("m"))
    return q.withColumn("nx", nx).join(m, "run_id").select("run_id", "entry_id", "printed_page_start", stop.alias("printed_stop"))


@query(f"""WITH {_B}, h AS (SELECT row_id, run_id, page, block_order, lower(trim(text)) AS title FROM b WHERE block_type IN ('h1', 'h2') AND trim(text) <> '' AND NOT regexp_matches(trim(text), '^[0-9]+$')),
 f AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY run_id, page ORDER BY row_id, block_order) = 1), d AS (SELECT *, lag(title) OVER (PARTITION BY run_id ORDER BY page) AS before FROM f),
 k AS (SELECT * FROM d WHERE before IS NULL OR before <> title), l AS (SELECT run_id, max(page) AS last_page FROM page_blocks GROUP BY 1)
 SELECT k.run_id, page AS page_start, coalesce(lead(page) OVER (PARTITION BY k.run_id ORDER BY page) - 1, last_page) AS page_stop, title FROM k JOIN l ON l.run_id = k.run_id""")
def w05_heading_portions(spark, sf):
    """Portions from the first heading of each page; equal titles that follow each other are one."""
    b = blocks(spark, sf).where(F.col("block_type").isin("h1", "h2")).withColumn("title", F.lower(F.trim("text"))).where("title != ''").where(~F.col("title").rlike("^[0-9]+$"))
    f = R.first_per_key(b.select("run_id", "page", "row_id", "block_order", "title"), ["run_id", "page"], [F.col("row_id"), F.col("block_order")])
    f = materialize(f, "headings")
    k = R.with_neighbours(f, ["run_id"], "page", ["title"], after=False).where(F.col("prev.title").isNull() | (F.col("prev.title") != F.col("title"))).drop("prev")
    last = table(spark, sf, "page_blocks").groupBy("run_id").agg(F.max("page").alias("last_page"))
    return R.next_starts(k.join(last, "run_id"), ["run_id"], "page", F.col("last_page"), "page_stop").select("run_id", F.col("page").alias("page_start"), "page_stop", "title")


@query(f"""WITH {_P1}, c AS (SELECT run_id, page, page_number, row_number() OVER (PARTITION BY run_id, page_number ORDER BY page) AS n FROM p1),
 o AS (SELECT run_id, page, row_number() OVER (PARTITION BY run_id ORDER BY CASE WHEN page_number IS NULL THEN 1 ELSE 0 END, page_number, page) AS logical, page_number IS NOT NULL AND n > 1 AS repeated FROM c) SELECT * FROM o""")
def w19_logical_order(spark, sf):
    """Pages by printed number, unnumbered ones last; a number seen before on a page is marked."""
    p = first_pages(spark, sf).select("run_id", "page", "page_number")
    p = p.withColumn("n", F.row_number().over(W.partitionBy("run_id", "page_number").orderBy("page")))
    p = R.running_sum(materialize(p.withColumn("place", F.coalesce("page_number", F.lit(1 << 60))), "pages"), ["run_id"], "place", F.lit(1), "logical", ("page",))
    return p.select("run_id", "page", F.col("logical").cast("long").alias("logical"), (F.col("page_number").isNotNull() & (F.col("n") > 1)).alias("repeated"))


@query(f"""WITH {_B}, t AS (SELECT run_id, page, row_id, block_order, CASE WHEN block_type = 'h1' THEN 1 ELSE 0 END AS title FROM b WHERE NOT starts_with(block_type, '/')), g AS (SELECT *, sum(title) OVER (PARTITION BY run_id ORDER BY page, row_id, block_order ROWS UNBOUNDED PRECEDING) AS slice FROM t)
 SELECT run_id, CAST(slice AS BIGINT) AS slice, count(*) AS blocks, min(page) AS first_page, max(page) AS last_page FROM g GROUP BY run_id, slice""")
def w21_title_slices(spark, sf):
    """Slices of a run at its titles; what stands before the first is slice 0."""
    b = blocks(spark, sf).where(~F.col("block_type").startswith("/"))
    g = R.running_sum(b, ["run_id"], "page", F.when(F.col("block_type") == "h1", 1).otherwise(0), "slice", ("row_id", "block_order"))
    return g.groupBy("run_id", "slice").agg(F.count("*").alias("blocks"), F.min("page").alias("first_page"), F.max("page").alias("last_page"))


@query("""WITH g AS (SELECT run_id, regexp_extract(image, '^(.*)/[^/]*$', 1) AS folder, count(DISTINCT image) AS images, min(image) AS first_image FROM page_blocks WHERE contains(image, '/') GROUP BY ALL) SELECT * FROM g WHERE images >= 2""")
def a28_image_groups(spark, sf):
    p = table(spark, sf, "page_blocks").where(F.col("image").contains("/"))
    g = p.groupBy("run_id", F.regexp_extract("image", "^(.*)/[^/]*$", 1).alias("folder")).agg(F.countDistinct("image").alias("images"), F.min("image").alias("first_image"))
    return g.where("images >= 2")
