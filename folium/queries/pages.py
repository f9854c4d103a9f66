"""Queries of geometry, votes, scores, repairs, gates and chapters over the test tables, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folium.functions import text as T
from folium.operators import chapters as C
from folium.operators import gates as Q
from folium.operators import geometry as G
from folium.operators import relational as R
from folium.operators import repair as P
from folium.operators import scoring as S
from folium.operators import vote as V
from folium.operators.layout import normal_box
from folium.queries.document import _B, _BL, _P1, blocks, first_pages
from folium.queries.elements import _BB
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


# ---------------------------------------------------------------- boxes


def _boxes(spark, sf) -> DataFrame:
    """A box for each provenance block, on a page of 600 by 1000, made from its row number; every fourth run has its axes exchanged."""
    n = lambda a, m, b=0: F.pmod(F.col("row_id") * a, F.lit(m)) + b
    b = table(spark, sf, "provenance_blocks").select("row_id", "run_id", F.col("source_page_number").alias("page"), n(37, 640).alias("ax"), n(53, 920).alias("ay"), n(17, 300, 1).alias("w"), n(29, 70, 1).alias("h"))
    flip = F.pmod(F.length("run_id") + F.ascii(F.substring("run_id", -1, 1)), F.lit(4)) == 0
    pick = lambda x, y: F.when(flip, y).otherwise(x).cast("double")
    ax, ay, bx, by = F.col("ax"), F.col("ay"), F.col("ax") + F.col("w"), F.col("ay") + F.col("h")
    return b.select("row_id", "run_id", "page", pick(ax, ay).alias("x0"), pick(ay, ax).alias("y0"), pick(bx, by).alias("x1"), pick(by, bx).alias("y1"), F.lit(600).alias("width"), F.lit(1000).alias("height"))


_BX = """r AS (SELECT row_id, run_id, source_page_number AS page, (row_id * 37) % 640 AS ax, (row_id * 53) % 920 AS ay, (row_id * 17) % 300 + 1 AS w, (row_id * 29) % 70 + 1 AS h, (length(run_id) + ascii(run_id[-1])) % 4 = 0 AS flip FROM provenance_blocks),
 bx AS (SELECT row_id, run_id, page, CAST(CASE WHEN flip THEN ay ELSE ax END AS DOUBLE) AS x0, CAST(CASE WHEN flip THEN ax ELSE ay END AS DOUBLE) AS y0, CAST(CASE WHEN flip THEN ay + h ELSE ax + w END AS DOUBLE) AS x1, CAST(CASE WHEN flip THEN ax + w ELSE ay + h END AS DOUBLE) AS y1 FROM r)"""


@query(f"""WITH {_BX}, d AS (SELECT *, CASE WHEN greatest(x0, x1) <= 1 THEN 1 WHEN greatest(x0, x1) <= 1000 THEN 1000 ELSE 600 END AS sx, CASE WHEN greatest(y0, y1) <= 1 THEN 1 WHEN greatest(y0, y1) <= 1000 THEN 1000 ELSE 1000 END AS sy FROM bx)
 SELECT row_id, round(least(greatest(x0 / sx, 0), 1), 6) AS x0, round(least(greatest(y0 / sy, 0), 1), 6) AS y0, round(least(greatest(x1 / sx, 0), 1), 6) AS x1, round(least(greatest(y1 / sy, 0), 1), 6) AS y1 FROM d WHERE least(greatest(x0 / sx, 0), 1) < least(greatest(x1 / sx, 0), 1) AND least(greatest(y0 / sy, 0), 1) < least(greatest(y1 / sy, 0), 1)""")
def b01_normal_boxes(spark, sf):
    b = _boxes(spark, sf).select("row_id", normal_box(F.struct("x0", "y0", "x1", "y1"), F.col("width"), F.col("height")).alias("b")).where("b IS NOT NULL")
    return b.select("row_id", *[F.round(F.col("b")[k], 6).alias(k) for k in ("x0", "y0", "x1", "y1")])


def _fit_sql(x0, y0, x1, y1):
    p = {k: f"floor({v} / (CASE WHEN greatest(x0, y0, x1, y1) > 1 THEN 1000.0::DOUBLE ELSE 1.0::DOUBLE END) * {size})" for k, v, size in (("ax", f"least({x0}, {x1})", 600), ("bx", f"greatest({x0}, {x1})", 600), ("ay", f"least({y0}, {y1})", 1000), ("by", f"greatest({y0}, {y1})", 1000))}
    area = f"(({p['bx']} - {p['ax']}) * ({p['by']} - {p['ay']}) / 600000.0::DOUBLE)"
    return f"""CASE WHEN {p['bx']} <= {p['ax']} OR {p['by']} <= {p['ay']} THEN -10.0 ELSE (CASE WHEN {p['bx']} > 612 OR {p['by']} > 1020 THEN -5.0 ELSE 0 END) + (CASE WHEN {area} > 0.005 AND {area} < 0.8 THEN 1.0 ELSE 0 END)
      + (CASE WHEN ({p['ax']} + {p['bx']}) / 1200.0 > 0.1 AND ({p['ax']} + {p['bx']}) / 1200.0 < 0.9 AND ({p['ay']} + {p['by']}) / 2000.0 > 0.1 AND ({p['ay']} + {p['by']}) / 2000.0 < 0.9 THEN 0.5 ELSE 0 END) END"""


@query(f"""WITH {_BX}, s AS (SELECT run_id, page, sum({_fit_sql('y0', 'x0', 'y1', 'x1')}) > sum({_fit_sql('x0', 'y0', 'x1', 'y1')}) AS swapped FROM bx GROUP BY 1, 2)
 SELECT row_id, swapped, CASE WHEN swapped THEN y0 ELSE x0 END AS x0, CASE WHEN swapped THEN x0 ELSE y0 END AS y0, CASE WHEN swapped THEN y1 ELSE x1 END AS x1, CASE WHEN swapped THEN x1 ELSE y1 END AS y1 FROM bx JOIN s USING (run_id, page)""")
def b02_unswapped_boxes(spark, sf):
    """Pages whose boxes fit better with the axes exchanged."""
    return G.unswapped(_boxes(spark, sf), ["run_id", "page"]).select("row_id", "swapped", "x0", "y0", "x1", "y1")


@query(f"""WITH {_BX}, c AS (SELECT row_id, x0, y0, x1, y1, x0 + row_id % 7 AS cx0, y1 - 5 + row_id % 40 AS cy0, x1 - row_id % 90 AS cx1, y1 + 20 + row_id % 40 AS cy1 FROM bx),
 o AS (SELECT *, coalesce(cx1 > cx0 AND cy1 > cy0 AND greatest(0, least(x1, cx1) - greatest(x0, cx0)) / greatest(x1 - x0, 1) >= 0.7, false) AS wide, floor(0.2::DOUBLE * greatest(y1 - y0, 1)) AS reach FROM c),
 l AS (SELECT *, CASE WHEN wide AND cy0 >= y0 AND cy0 <= y1 + reach AND cy0 - 3 > y0 THEN cy0 - 3 ELSE y1 END AS ny1 FROM o)
 SELECT row_id, CASE WHEN wide AND cy1 >= y0 - reach AND cy1 <= ny1 AND cy1 + 3 < ny1 THEN cy1 + 3 ELSE y0 END AS y0, ny1 AS y1 FROM l""")
def b06_trimmed_boxes(spark, sf):
    """Boxes cut at a caption near their lower edge."""
    i = F.col("row_id")
    b = _boxes(spark, sf).withColumn("box", F.struct("x0", "y0", "x1", "y1"))
    caption = F.struct((F.col("x0") + i % 7).alias("x0"), (F.col("y1") - 5 + i % 40).alias("y0"), (F.col("x1") - i % 90).alias("x1"), (F.col("y1") + 20 + i % 40).alias("y1"))
    return b.select("row_id", G.trim_caption(F.col("box"), caption, 3, 0.2).alias("t")).select("row_id", F.col("t.y0").alias("y0"), F.col("t.y1").alias("y1"))


@query(f"""WITH {_BX}, t AS (SELECT row_id, run_id, page, x0, y0, x1, y1, (x1 - x0) * (y1 - y0) AS area, CASE WHEN row_id % 2 = 0 THEN 'card_reference' ELSE 'photo' END AS role, 't' || row_id AS target FROM bx WHERE row_id % 5 = 0 AND page IS NOT NULL),
 c AS (SELECT run_id, page, x0 - 40 AS x0, y0 - 40 AS y0, x1 + 150 AS x1, y1 + 150 AS y1, CASE WHEN row_id % 3 = 0 THEN 't' || (row_id - row_id % 5) || '-' || row_id END AS part FROM bx WHERE row_id % 5 <> 0),
 m AS (SELECT t.*, c.part, coalesce(greatest(0, least(t.x1, c.x1) - greatest(t.x0, c.x0)) * greatest(0, least(t.y1, c.y1) - greatest(t.y0, c.y0)) / area, 0) AS share, coalesce(starts_with(c.part, target || '-'), false) AS own FROM t LEFT JOIN c ON c.run_id = t.run_id AND c.page = t.page WHERE area > 0),
 g AS (SELECT run_id, page, target, role, max(share) AS best, sum(CASE WHEN own THEN 1 ELSE 0 END) AS parts, sum(CASE WHEN own THEN share ELSE 0 END) AS whole FROM m GROUP BY ALL), f AS (SELECT *, role = 'card_reference' AND parts >= 2 AND whole >= 0.2 AS split FROM g)
 SELECT run_id, page, target, round(CASE WHEN split THEN least(1, whole) ELSE best END, 6) AS coverage, CASE WHEN split THEN 'split' WHEN best > 0 THEN 'best' ELSE 'none' END AS mode, split OR best >= 0.7 AS covered FROM f""")
def b07_target_coverage(spark, sf):
    """Every fifth box as a planned target, the others, widened, as crops of their page."""
    b = _boxes(spark, sf)
    i = F.col("row_id")
    t = b.where((i % 5 == 0) & F.col("page").isNotNull()).select("run_id", "page", F.concat(F.lit("t"), i.cast("string")).alias("target"), F.when(i % 2 == 0, "card_reference").otherwise("photo").alias("role"), F.struct("x0", "y0", "x1", "y1").alias("box"))
    part = F.when(i % 3 == 0, F.concat(F.lit("t"), (i - i % 5).cast("string"), F.lit("-"), i.cast("string")))
    c = b.where(i % 5 != 0).select("run_id", "page", F.struct((F.col("x0") - 40).alias("x0"), (F.col("y0") - 40).alias("y0"), (F.col("x1") + 150).alias("x1"), (F.col("y1") + 150).alias("y1")).alias("box"), part.alias("of_target"))
    return G.target_coverage(t, c, ["run_id", "page"], "target", 0.7).withColumn("coverage", F.round("coverage", 6))


@query()
def b05_reading_order(spark, sf):
    """Boxes of each page row by row (checked by brute force in the tests)."""
    p = _boxes(spark, sf).where("page IS NOT NULL").groupBy("run_id", "page").agg(F.sort_array(F.collect_list(F.struct("x0", "y0", "x1", "y1"))).alias("b"))
    return p.select("run_id", "page", F.posexplode(G.in_reading_order(F.col("b"))).alias("place", "b")).select("run_id", "page", "place", "b.*")


# ---------------------------------------------------------------- readings and quality


def _readings(spark, sf) -> DataFrame:
    """Deliveries of the same page as readings d1, d2 and so on: run_id, page, engine, lines."""
    texts = F.flatten(F.transform(F.filter("blocks", lambda b: b.text != ""), lambda b: F.split(b.text, "\n")))
    many = table(spark, sf, "page_blocks").groupBy("run_id", "page").agg(F.count("*").alias("n")).where("n > 1").select("run_id", "page")
    p = table(spark, sf, "page_blocks").join(many, ["run_id", "page"], "left_semi").where(F.size("blocks") > 0)
    n = F.row_number().over(W.partitionBy("run_id", "page").orderBy("row_id"))
    return p.select("run_id", "page", F.concat(F.lit("d"), n.cast("string")).alias("engine"), texts.alias("lines"))


@query()
def v18_voted_lines(spark, sf):
    """One text of several deliveries of a page, line by line."""
    v = V.vote_pages(_readings(spark, sf), ["run_id", "page"], "engine", "lines")
    return v.select("run_id", "page", F.posexplode("lines").alias("n", "v")).select("run_id", "page", "n", "v.text", "v.source", F.round("v.distance", 6).alias("distance"))


@query()
def j11_disagreement(spark, sf):
    r = _readings(spark, sf).withColumn("text", F.array_join("lines", "\n"))
    return V.disagreement(r, ["run_id", "page"], "engine", "text").withColumn("disagreement", F.round("disagreement", 6))


_LINES = "list_filter(flatten(list_transform(list_filter(blocks, lambda b: b.text <> ''), lambda b: string_split(b.text, chr(10)))), lambda t: true)"


@query(rf"""WITH p AS (SELECT row_id, {_LINES} AS ls FROM page_blocks WHERE len(blocks) > 0), f AS (SELECT *, array_to_string(ls, chr(10)) AS t, list_filter(list_transform(ls, lambda x: regexp_replace(x, '^[{_BL}]+|[{_BL}]+$', '', 'g')), lambda x: x <> '') AS fl FROM p),
 k AS (SELECT *, greatest(1, len(fl)) AS k, regexp_extract_all(t, '[^{_BL}]+') AS ws, length(regexp_replace(t, '\P{{L}}+', '', 'g')) AS letters, length(regexp_replace(t, '[^\p{{L}}\p{{N}}{_BL}]+', '', 'g')) AS plain FROM f),
 c AS (SELECT *, round(least(1.0::DOUBLE, least(0.3::DOUBLE * len(regexp_extract_all(t, '\|\s*[0-9]+')), 0.8::DOUBLE) + CASE WHEN len(ws) > 0 AND list_sum(list_transform(ws, lambda x: length(x))) > 15 * len(ws) THEN 0.4::DOUBLE ELSE 0 END
  + CASE WHEN plain > 0 AND letters / greatest(plain, 1) < 0.3::DOUBLE THEN 0.3::DOUBLE ELSE 0 END + CASE WHEN len(regexp_extract_all(t, '[^\p{{L}}\p{{M}}\p{{N}}_{_BL}.,!?]{{3,}}')) > 2 THEN 0.2::DOUBLE ELSE 0 END), 4) AS corruption,
  len(list_filter(fl, lambda x: length(x) < 5)) / k AS short, len(list_filter(fl, lambda x: regexp_matches(regexp_replace(regexp_split_to_array(x, '\s+')[-1], '^[.,!?;:]+|[.,!?;:]+$', '', 'g'), '^\p{{L}}{{1,2}}$'))) / k AS cut FROM k),
 m AS (SELECT row_id, corruption, greatest(CASE WHEN short > 0.15 THEN short ELSE 0 END, CASE WHEN cut > 0.2 THEN cut ELSE 0 END) AS fr, least(1.0::DOUBLE, CASE WHEN len(fl) = 0 THEN 1.0::DOUBLE ELSE 0 END + CASE WHEN len(ls) < 5 THEN 0.4::DOUBLE ELSE 0 END
  + CASE WHEN coalesce(list_sum(list_transform(ls, lambda x: length(x))), 0) / greatest(1, len(ls)) < 10 THEN 0.3::DOUBLE ELSE 0 END + CASE WHEN corruption > 0.5 THEN 0.3::DOUBLE ELSE 0 END) AS mi FROM c)
 SELECT row_id, corruption, round(mi, 4) AS missing, round(fr, 4) AS fragmentation, round(greatest(corruption * 0.25::DOUBLE, mi * 0.25::DOUBLE, fr * 0.2::DOUBLE), 4) AS quality FROM m""")
def a16_page_quality(spark, sf):
    """How bad the text of each page is by corruption, missing text and fragments."""
    lines = F.flatten(F.transform(F.filter("blocks", lambda b: b.text != ""), lambda b: F.split(b.text, "\n")))
    return table(spark, sf, "page_blocks").where(F.size("blocks") > 0).select("row_id", lines.alias("ls")).select("row_id", V.page_quality(F.col("ls")).alias("q")).select("row_id", "q.*")


_SHORT = ", ".join(f"'{w}'" for w in V.SHORT_WORDS)


@query(rf"""WITH p AS (SELECT row_id, {_LINES} AS ls FROM page_blocks WHERE len(blocks) > 0), f AS (SELECT *, list_transform(list_transform(ls, lambda x: regexp_replace(x, '^[{_BL}]+|[{_BL}]+$', '', 'g')), lambda s: s <> '' AND length(s) < 4 AND NOT regexp_matches(s, '^[0-9]+$') AND NOT regexp_matches(s, '^\p{{Lu}}{{1,2}}$') AND lower(s) NOT IN ({_SHORT})) AS fl FROM p),
 t AS (SELECT *, coalesce(nullif(list_position(list_reverse(fl), false), 0) - 1, len(fl)) AS tail, len(list_filter(fl, lambda x: x)) AS n FROM f) SELECT row_id, len(ls) AS lines, CASE WHEN len(ls) >= 5 AND tail >= 3 AND tail >= 0.5 * greatest(n, 1) THEN len(ls) - tail ELSE len(ls) END AS kept FROM t""")
def w18_trimmed_fragments(spark, sf):
    """Lines of each page with and without the fragments at its end."""
    lines = F.flatten(F.transform(F.filter("blocks", lambda b: b.text != ""), lambda b: F.split(b.text, "\n")))
    p = table(spark, sf, "page_blocks").where(F.size("blocks") > 0).select("row_id", lines.alias("ls"))
    return p.select("row_id", F.size("ls").cast("long").alias("lines"), F.size(V.without_fragments(F.col("ls"))).cast("long").alias("kept"))


@query()
def f17_paragraphs(spark, sf):
    """Paragraphs of each page's lines (literal cases in the tests)."""
    lines = F.flatten(F.transform(F.filter("blocks", lambda b: b.text != ""), lambda b: F.split(b.text, "\n")))
    p = table(spark, sf, "page_blocks").where(F.size("blocks") > 0).select("row_id", P.reconstructed(lines).alias("x"))
    return p.select("row_id", F.posexplode("x").alias("n", "text"))


# ---------------------------------------------------------------- scores


_MODELS = "s AS (SELECT coalesce(module_id, 'none') AS model, avg(confidence) AS score, avg(nullif(page_end - page_start, 0)) AS latency, avg(nullif(page_start, 0)) AS cost, count(*) AS cases FROM portions GROUP BY 1), q AS (SELECT * FROM s WHERE score >= 0.5)"


def _models(spark, sf) -> DataFrame:
    p = table(spark, sf, "portions").select(F.coalesce("module_id", F.lit("none")).alias("model"), "confidence", F.expr("page_end - page_start").alias("latency"), F.col("page_start").alias("cost"))
    return S.summaries(p, "model", "confidence", "latency", "cost")


@query(f"WITH {_MODELS} SELECT model, round(score, 6) AS score, round(latency, 6) AS latency, round(cost, 6) AS cost, cases, coalesce(score < 0.5, true) AS disqualified FROM s")
def a36_model_summaries(spark, sf):
    """Mean score, latency and cost of each module's portions, zeros of the last two left out."""
    return _models(spark, sf).select("model", *[F.round(c, 6).alias(c) for c in ("score", "latency", "cost")], "cases", "disqualified")


@query(f"""WITH {_MODELS}, b AS (SELECT * FROM q ORDER BY score DESC, model DESC LIMIT 1), w AS (SELECT * FROM q WHERE score >= 0.95::DOUBLE * (SELECT score FROM b)),
 k AS (SELECT * FROM w WHERE model = (SELECT model FROM b) OR NOT EXISTS (SELECT 1 FROM w o WHERE o.latency > 0 AND o.cost > 0 AND w.latency > 0 AND w.cost > 0 AND o.score >= w.score AND o.latency <= w.latency AND o.cost <= w.cost AND (o.score > w.score OR o.latency < w.latency OR o.cost < w.cost))),
 e AS (SELECT min(CASE WHEN latency > 0 THEN latency END) AS fa, min(CASE WHEN cost > 0 THEN cost END) AS ch FROM k),
 t AS (SELECT k.*, round(0.6::DOUBLE * k.score + 0.25::DOUBLE * coalesce(CASE WHEN latency > 0 THEN fa / latency END, 0) + 0.15::DOUBLE * coalesce(CASE WHEN cost > 0 THEN ch / cost END, 0), 4) AS three, model <> (SELECT model FROM b) AND (coalesce(CASE WHEN cost > 0 AND (SELECT cost FROM b) > 0 THEN (SELECT cost FROM b) / cost END, 0) >= 2 OR coalesce(CASE WHEN latency > 0 AND (SELECT latency FROM b) > 0 THEN (SELECT latency FROM b) / latency END, 0) >= 1.5) AS val FROM k, e)
 SELECT 'quality' AS role, (SELECT model FROM t ORDER BY score DESC, model DESC LIMIT 1) AS model WHERE EXISTS (SELECT 1 FROM t) UNION ALL SELECT 'balanced', (SELECT model FROM t ORDER BY three DESC, model DESC LIMIT 1) WHERE EXISTS (SELECT 1 FROM t)
 UNION ALL SELECT 'value', (SELECT model FROM t WHERE val ORDER BY three DESC, model DESC LIMIT 1) WHERE EXISTS (SELECT 1 FROM t WHERE val)""")
def a34_winners(spark, sf):
    """Quality, balanced and value winner among the modules."""
    return S.winners(S.ranked(_models(spark, sf), "model"), "model")


@query("""WITH t AS (SELECT DISTINCT run_id, entry_id FROM bundle_entries WHERE entry_id IS NOT NULL), f AS (SELECT DISTINCT run_id, entry_id FROM provenance_blocks WHERE entry_id IS NOT NULL),
 s AS (SELECT coalesce(t.run_id, f.run_id) AS run_id, t.entry_id IS NOT NULL AS a, f.entry_id IS NOT NULL AS b FROM t FULL JOIN f ON t.run_id = f.run_id AND t.entry_id = f.entry_id),
 g AS (SELECT run_id, sum(CASE WHEN a AND b THEN 1 ELSE 0 END) AS hits, sum(CASE WHEN a THEN 1 ELSE 0 END) AS ti, sum(CASE WHEN b THEN 1 ELSE 0 END) AS fi FROM s GROUP BY 1)
 SELECT run_id, round(CASE WHEN fi > 0 THEN hits / fi ELSE 0 END, 6) AS precision, round(CASE WHEN ti > 0 THEN hits / ti ELSE 0 END, 6) AS recall, round(CASE WHEN hits > 0 THEN 2 * (hits / fi) * (hits / ti) / (hits / fi + hits / ti) ELSE 0 END, 6) AS f1 FROM g""")
def s14_set_scores(spark, sf):
    """Entries that provenance names against those of the bundle."""
    e, p = table(spark, sf, "bundle_entries").where("entry_id IS NOT NULL"), table(spark, sf, "provenance_blocks").where("entry_id IS NOT NULL")
    return S.set_scores(e, p, ["run_id"], "entry_id").select("run_id", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


@query(r"""WITH t AS (SELECT doc_id, list_filter(regexp_extract_all(coalesce(text, ''), '[\p{L}\p{N}]+'), lambda w: length(w) >= 4 AND NOT regexp_matches(w, '(?i)^[0-9]+(st|nd|rd|th)$|^p{1,2}[0-9]+$')) AS w FROM documents)
 SELECT doc_id, len(list_filter(w, lambda x: regexp_matches(x, '\p{L}') AND regexp_matches(x, '\p{N}'))) AS mixed, len(list_filter(w, lambda x: regexp_matches(x, '^\p{L}+$') AND NOT regexp_matches(x, '[aeiouyAEIOUY]'))) AS mute FROM t""")
def s14_suspicious_tokens(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", S.suspicious_tokens(F.col("text")).alias("s"))
    return d.select("doc_id", F.size("s.mixed").cast("long").alias("mixed"), F.size("s.mute").cast("long").alias("mute"))


@query("""WITH v AS (SELECT portion_type, CASE WHEN confidence >= 0.6 THEN 'pass' ELSE 'fail' END AS truth, CASE WHEN title IS NULL THEN 'fail' WHEN length(title) % 7 = 0 THEN 'unsure' ELSE 'Pass ' END AS verdict FROM portions WHERE confidence IS NOT NULL)
 SELECT portion_type, CASE WHEN lower(trim(verdict)) IN ('pass', 'fail') THEN (CASE WHEN truth = lower(trim(verdict)) THEN 'T' ELSE 'F' END) || (CASE WHEN lower(trim(verdict)) = 'fail' THEN 'P' ELSE 'N' END) END AS class, count(*) AS cases FROM v GROUP BY 1, 2""")
def s14_verdicts(spark, sf):
    """Verdicts on portions against their confidence, by class of hit and miss."""
    p = table(spark, sf, "portions").where("confidence IS NOT NULL")
    truth = F.when(F.col("confidence") >= 0.6, "pass").otherwise("fail")
    verdict = F.when(F.col("title").isNull(), "fail").when(F.length("title") % 7 == 0, "unsure").otherwise("Pass ")
    return p.groupBy("portion_type", S.verdict_class(truth, verdict).alias("class")).agg(F.count("*").alias("cases"))


@query("""WITH n AS (SELECT run_id, portion_type, count(*) AS times, min(row_id) AS seen FROM portions WHERE run_id IS NOT NULL AND portion_type IS NOT NULL GROUP BY ALL), d AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY times DESC, seen) = 1),
 m AS (SELECT run_id, sum(CASE WHEN title IS NULL THEN 1 ELSE 0 END) AS drift FROM portions WHERE run_id IS NOT NULL GROUP BY 1), r AS (SELECT m.run_id, coalesce(portion_type, 'unknown') AS signature, drift FROM m LEFT JOIN d ON d.run_id = m.run_id)
 SELECT signature, count(*) AS members, arg_min(run_id, (drift, run_id)) AS baseline, CAST(min(drift) AS BIGINT) AS baseline_drift FROM r GROUP BY 1""")
def a31_signature_groups(spark, sf):
    """Runs grouped by their dominant portion type, each group's baseline the run of least drift (portions without a title)."""
    p = table(spark, sf, "portions").where("run_id IS NOT NULL")
    d = S.agreed(p, ["run_id"], "portion_type", "row_id").select("run_id", "portion_type")
    m = p.groupBy("run_id").agg(F.sum(F.when(F.col("title").isNull(), 1).otherwise(0)).alias("drift"))
    r = m.join(d, "run_id", "left").select("run_id", F.coalesce("portion_type", F.lit("unknown")).alias("signature"), "drift")
    return r.groupBy("signature").agg(F.count("*").alias("members"), F.min_by("run_id", F.struct("drift", "run_id")).alias("baseline"), F.min("drift").alias("baseline_drift"))


# ---------------------------------------------------------------- repairs


_MO = r"\b(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Sept|Oct|Nov|Dec)\.?\b"


@query(rf"""WITH {_B}, s AS (SELECT row_id, sum(CASE WHEN block_type = 'tr' THEN 1 ELSE 0 END) AS rows, sum(CASE WHEN block_type IN ('td', 'th') THEN 1 ELSE 0 END) AS cells, sum(CASE WHEN block_type IN ('td', 'th') THEN (CASE WHEN regexp_matches(text, '\b[A-Z][a-z]{{2,}}[A-Z][a-z]{{2,}}\b') OR regexp_matches(text, '[0-9][A-Z]') OR regexp_matches(text, '[0-9]{{4}}[A-Za-z]') THEN 1 ELSE 0 END)
  + (CASE WHEN len(regexp_extract_all(text, '{_MO}')) >= 2 OR len(regexp_extract_all(text, '\b[0-9]{{4}}\b')) >= 2 THEN 1 ELSE 0 END) ELSE 0 END) AS suspects FROM b GROUP BY 1)
 SELECT row_id, CAST(cells AS BIGINT) AS cells, CAST(suspects AS BIGINT) AS suspects, array_to_string(list_filter([CASE WHEN rows <= 1 AND cells >= 6 THEN 'one_row' END, CASE WHEN suspects >= 2 THEN 'run_together' END], lambda x: x IS NOT NULL), ',') AS reasons FROM s WHERE cells > 0""")
def f34_suspect_tables(spark, sf):
    """Cells that look run together, per page, and whether its tables want another reading."""
    cell = F.col("block_type").isin("td", "th")
    s = blocks(spark, sf).groupBy("row_id").agg(F.sum((F.col("block_type") == "tr").cast("int")).alias("rows"), F.sum(cell.cast("int")).alias("cells"), F.sum(F.when(cell, P.suspect_signs(F.col("text"))).otherwise(0)).alias("suspects")).where("cells > 0")
    return s.select("row_id", "cells", "suspects", F.array_join(P.table_reasons(F.col("rows"), F.col("cells"), F.col("suspects")), ",").alias("reasons"))


_KEY = r"trim(regexp_replace(regexp_replace(lower(trim(regexp_replace(text, '[" + _BL + r"]+', ' ', 'g'))), '[^\p{L}\p{M}\p{N}_\s-]', '', 'g'), '[" + _BL + r"]+', ' ', 'g'))"


@query(rf"""WITH {_B}, f AS (SELECT *, min(block_order) OVER (PARTITION BY row_id) AS first FROM b WHERE text <> ''), h AS (SELECT run_id, page, row_id * 100000 + block_order AS ordinal, {_KEY} AS k, block_order = first AS lea FROM f WHERE attrs['class'] = 'running-head'),
 g AS (SELECT run_id, page, CAST(block_type[2:2] AS INTEGER) AS level, {_KEY} AS k FROM b WHERE regexp_matches(block_type, '^h[1-6]$')), t AS (SELECT run_id, k, count(*) AS times FROM h WHERE k <> '' GROUP BY ALL), n AS (SELECT DISTINCT run_id, k FROM g WHERE level <= 2 AND k <> ''),
 p AS (SELECT run_id, page, bool_or(level = 1) AS h1, bool_or(level = 2) AS h2, bool_or(level = 3) AS h3 FROM g GROUP BY ALL),
 d AS (SELECT h.*, times, n.k IS NOT NULL AS taken, coalesce(h1, false) AS h1, coalesce(h2, false) AS h2, coalesce(h3, false) AS h3 FROM h LEFT JOIN t ON t.run_id = h.run_id AND t.k = h.k LEFT JOIN n ON n.run_id = h.run_id AND n.k = h.k LEFT JOIN p ON p.run_id = h.run_id AND p.page = h.page),
 r AS (SELECT *, CASE WHEN NOT lea THEN 'not_leading' WHEN k = '' THEN 'empty' WHEN taken THEN 'is_a_heading' WHEN times > 2 THEN 'repeated' WHEN h1 THEN 'page_has_title' WHEN h3 AND NOT h2 THEN 'only_lower_headings' ELSE 'unique' END AS reason FROM d)
 SELECT ordinal, CASE WHEN reason = 'unique' THEN 'promote' ELSE 'remove' END AS action, reason FROM r""")
def f37_promoted_heads(spark, sf):
    """Running heads that become titles of their pages, and why others do not."""
    b = blocks(spark, sf)
    first = b.where("text != ''").groupBy("row_id").agg(F.min("block_order").alias("first"))
    h = b.where((F.element_at("attrs", F.lit("class")) == "running-head") & (F.col("text") != "")).join(first, "row_id").select("run_id", "page", (F.col("row_id") * 100000 + F.col("block_order")).alias("ordinal"), "text", (F.col("block_order") == F.col("first")).alias("leading"))
    g = b.where(F.col("block_type").rlike("^h[1-6]$")).select("run_id", "page", F.substring("block_type", 2, 1).cast("int").alias("level"), "text")
    return P.promoted_heads(h, g, "run_id", "page", "ordinal").select("ordinal", "action", "reason")


@query("""WITH e AS (SELECT run_id, row_id, entry_order, coalesce(kind = 'chapter', false) AS pa, coalesce(kind <> 'chapter', false) AS ch FROM bundle_entries WHERE entry_order IS NOT NULL),
 g AS (SELECT *, sum(CASE WHEN ch THEN 0 ELSE 1 END) OVER (PARTITION BY run_id ORDER BY entry_order, row_id ROWS UNBOUNDED PRECEDING) AS i FROM e), b AS (SELECT *, coalesce(max(CASE WHEN pa THEN 1 ELSE 0 END) OVER (PARTITION BY run_id, i ORDER BY entry_order, row_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS inside FROM g) SELECT run_id, row_id FROM b WHERE inside = 0""")
def w06_absorbed(spark, sf):
    """Entries that are not absorbed by the chapter before them."""
    e = table(spark, sf, "bundle_entries").where("entry_order IS NOT NULL").select("run_id", "row_id", "entry_order", "kind")
    return P.absorbed(e, ["run_id"], "entry_order", ("row_id",), F.col("kind") == "chapter", F.col("kind") != "chapter").select("run_id", "row_id")


@query("""WITH u AS (SELECT 0 AS p, entry_id, row_id, title FROM bundle_entries WHERE deleted_at IS NULL UNION ALL SELECT 1, entry_id, row_id, title FROM bundle_entries WHERE deleted_at IS NOT NULL), k AS (SELECT * FROM u WHERE entry_id IS NULL UNION ALL SELECT * FROM (SELECT * FROM u WHERE entry_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY entry_id ORDER BY p, row_id) = 1))
 SELECT printf('P%03d', row_number() OVER (ORDER BY p, row_id)) AS entry_id, row_id, title FROM k""")
def k07_merged_entries(spark, sf):
    """Live entries before deleted ones, the first of each id, renumbered in order."""
    e = table(spark, sf, "bundle_entries").select("entry_id", "row_id", "title", "deleted_at")
    return P.first_of([e.where("deleted_at IS NULL"), e.where("deleted_at IS NOT NULL")], "entry_id", "row_id", "P").select("entry_id", "row_id", "title")


# ---------------------------------------------------------------- gates


_DL = "dl AS (SELECT *, row_number() OVER (PARTITION BY run_id, page ORDER BY row_id) AS n FROM page_blocks)"
_CNT = "len(list_filter(coalesce(blocks, []), lambda b: b.block_type {c}))"


def _deliveries(spark, sf, **counts) -> tuple[DataFrame, DataFrame]:
    """First and last delivery of each page with counts of blocks."""
    n = lambda kinds: F.coalesce(F.size(F.filter("blocks", lambda b: b.block_type.isin(*kinds))), F.lit(0))
    d = table(spark, sf, "page_blocks").select("run_id", "page", "row_id", *[F.greatest(n(k), F.lit(0)).alias(c) for c, k in counts.items()])
    first = R.first_per_key(d, ["run_id", "page"], [F.col("row_id")])
    last = R.first_per_key(d, ["run_id", "page"], [-F.col("row_id")]).join(first.select("run_id", "page", F.col("row_id").alias("_f")), ["run_id", "page"]).where("row_id != _f").drop("_f")
    return first, last


_FL = "fl AS (SELECT run_id, page, min(row_id) AS f, max(row_id) AS l FROM page_blocks GROUP BY ALL)"


@query(f"""WITH {_FL}, m AS (SELECT row_id, {_CNT.format(c="IN ('header')")} AS he, {_CNT.format(c="IN ('h1', 'h2', 'h3')")} AS hd, {_CNT.format(c="IN ('table')")} AS tb, {_CNT.format(c="IN ('th')")} AS sg FROM page_blocks),
 j AS (SELECT run_id, page, f, l, o.*, 40 * o.he + 25 * o.hd + CASE WHEN o.tb >= 2 THEN 5 * (o.tb - 1) + CASE WHEN o.sg = 0 THEN 15 ELSE 0 END ELSE 0 END AS po, n.he AS nhe, n.hd AS nhd, 40 * n.he + 25 * n.hd + CASE WHEN n.tb >= 2 THEN 5 * (n.tb - 1) + CASE WHEN n.sg = 0 THEN 15 ELSE 0 END ELSE 0 END AS pn FROM fl JOIN m o ON o.row_id = f LEFT JOIN m n ON n.row_id = l AND l <> f)
 SELECT run_id, page, CASE WHEN nhe IS NULL THEN 'no_candidate' WHEN nhe > he THEN 'more_headers' WHEN nhd > hd THEN 'more_headings' WHEN pn > po THEN 'drift_grew' ELSE 'accepted' END AS decision FROM j""")
def q02_drift(spark, sf):
    """Whether the last delivery of a page may replace the first: no more headers, headings or drift penalty."""
    first, last = _deliveries(spark, sf, header=["header"], heading=["h1", "h2", "h3"], tables=["table"], groups=["th"])
    return Q.decide(first, last, ["run_id", "page"], Q.drift_rules()).select("run_id", "page", "decision")


@query(f"""WITH {_FL}, m AS (SELECT row_id, {_CNT.format(c="IN ('th')")} AS h, {_CNT.format(c="IN ('tr')")} AS r, {_CNT.format(c="IN ('li')")} AS li, {_CNT.format(c="IN ('p')")} AS pp FROM page_blocks),
 j AS (SELECT run_id, page, o.h AS oh, n.h AS nh, 120 * o.h + 10 * o.r + 15 * o.li - 18 * o.pp AS so, 120 * n.h + 10 * n.r + 15 * n.li - 18 * n.pp AS sn FROM fl JOIN m o ON o.row_id = f LEFT JOIN m n ON n.row_id = l AND l <> f)
 SELECT run_id, page, CASE WHEN nh IS NULL THEN 'no_candidate' WHEN nh = 0 AND oh > 0 THEN 'lost_header_table' WHEN oh = 0 AND nh > 0 THEN 'accepted' WHEN sn < so + 10 THEN 'score_not_improved' ELSE 'accepted' END AS decision FROM j""")
def q03_rescue(spark, sf):
    """Whether the last delivery's tables are better by a weighted score of heads, rows, labels and lines outside."""
    first, last = _deliveries(spark, sf, headers=["th"], rows=["tr"], labels=["li"], outside=["p"])
    return Q.decide(first, last, ["run_id", "page"], Q.rescue_rules({"headers": 120, "rows": 10, "labels": 15, "outside": -18}, "headers", 10)).select("run_id", "page", "decision")


@query(f"""WITH {_FL}, m AS (SELECT row_id, {_CNT.format(c="= 'table'")} AS t, {_CNT.format(c="= 'h2'")} AS h2, {_CNT.format(c="= 'h3'")} AS h3, list_distinct(list_filter(string_split(regexp_replace(lower(array_to_string(list_transform(coalesce(blocks, []), lambda b: b.text), ' ')), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: w <> '')) AS w FROM page_blocks),
 j AS (SELECT run_id, page, l <> f AS two, o.t AS ot, o.h2 AS o2, o.h3 AS o3, n.t AS nt, n.h2 AS n2, n.h3 AS n3, CASE WHEN len(o.w) > 0 AND len(n.w) > 0 THEN len(list_intersect(o.w, n.w)) / greatest(len(o.w), len(n.w)) END AS sim FROM fl JOIN m o ON o.row_id = f JOIN m n ON n.row_id = l WHERE l <> f),
 r AS (SELECT *, list_filter([CASE WHEN nt < ot THEN 'fewer_tables' WHEN nt > ot THEN 'more_tables' END, CASE WHEN n2 < o2 THEN 'fewer_h2' WHEN n2 > o2 THEN 'more_h2' END, CASE WHEN n3 < o3 THEN 'fewer_h3' WHEN n3 > o3 THEN 'more_h3' END], lambda x: x IS NOT NULL) AS rs FROM j)
 SELECT run_id, page, array_to_string(rs, ',') AS reasons, len(rs) > 0 AND NOT (coalesce(sim >= 0.98, false) AND len(list_filter(rs, lambda x: NOT starts_with(x, 'fewer_'))) = 0) AS regressed FROM r""")
def q09_regressions(spark, sf):
    """Differences in structure between the first and the last delivery; fewer parts are waived if the text is the same for 98 %."""
    n = lambda k: F.coalesce(F.size(F.filter("blocks", lambda b: b.block_type == k)), F.lit(0))
    text = F.array_join(F.transform("blocks", lambda b: F.coalesce(b.text, F.lit(""))), " ")
    d = table(spark, sf, "page_blocks").select("run_id", "page", "row_id", F.greatest(n("table"), F.lit(0)).alias("tables"), F.greatest(n("h2"), F.lit(0)).alias("h2"), F.greatest(n("h3"), F.lit(0)).alias("h3"), T.tokens_of(F.coalesce(text, F.lit("")), 1).alias("w"))
    a = R.first_per_key(d, ["run_id", "page"], [F.col("row_id")])
    z = R.first_per_key(d, ["run_id", "page"], [-F.col("row_id")])
    j = a.select("run_id", "page", *[F.col(c).alias(f"old_{c}") for c in a.columns[2:]]).join(z.select("run_id", "page", *[F.col(c).alias(f"new_{c}") for c in z.columns[2:]]), ["run_id", "page"]).where("old_row_id != new_row_id")
    return Q.structure_regressions(j, ["tables", "h2", "h3"], "old_w", "new_w").select("run_id", "page", F.array_join("reasons", ",").alias("reasons"), "regressed")


@query(r"""WITH q AS (SELECT run_id, row_id, page_start, title, list_distinct(list_filter(string_split(regexp_replace(lower(title), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: length(w) >= 4)) AS t FROM portions WHERE run_id IS NOT NULL AND page_start IS NOT NULL AND title IS NOT NULL),
 l AS (SELECT row_id, lead(row_id) OVER w AS next_row, list_intersect(t, lead(t) OVER w) AS shared FROM q WINDOW w AS (PARTITION BY run_id ORDER BY page_start, row_id)) SELECT row_id, next_row, len(shared) AS shared FROM l WHERE len(shared) > 0""")
def q11_shared_terms(spark, sf):
    """Portions that share a term of their title with the next one of the run."""
    q = table(spark, sf, "portions").where("run_id IS NOT NULL AND page_start IS NOT NULL AND title IS NOT NULL").select("run_id", "row_id", "page_start", T.tokens_of("title", 4).alias("t"))
    return Q.fragmented(q, ["run_id"], "page_start", "row_id", "t").select("row_id", "next_row", F.size("shared").cast("long").alias("shared"))


@query(f"""WITH {_B}, s AS (SELECT run_id, sum(CASE WHEN block_type IN ('h1', 'h2', 'h3') THEN 1 ELSE 0 END) AS headings, sum(CASE WHEN block_type = 'table' THEN 1 ELSE 0 END) AS tables, sum(CASE WHEN block_type = 'th' THEN 1 ELSE 0 END) AS heads, count(DISTINCT page) AS pages FROM b GROUP BY 1)
 SELECT run_id, CAST(headings AS BIGINT) AS headings, CAST(tables AS BIGINT) AS tables, array_to_string(list_filter([CASE WHEN tables >= 5 AND tables / greatest(1, pages) >= 1.25::DOUBLE THEN 'fragmented_tables' END, CASE WHEN tables >= 3 AND heads = 0 THEN 'no_heads' END, CASE WHEN headings = 0 THEN 'no_headings' END], lambda x: x IS NOT NULL), ',') AS issues FROM s""")
def q08_profiles(spark, sf):
    """Counts of structure per run and the issues that they suggest."""
    n = lambda *k: F.sum(F.col("block_type").isin(*k).cast("int"))
    s = blocks(spark, sf).groupBy("run_id").agg(n("h1", "h2", "h3").alias("headings"), n("table").alias("tables"), n("th").alias("heads"), F.countDistinct("page").alias("pages"))
    issues = Q.profile_issues(F.col("tables"), F.col("pages"), F.col("heads"), F.col("headings"))
    return s.select("run_id", "headings", "tables", F.array_join(issues, ",").alias("issues"))


# ---------------------------------------------------------------- chapters


def _chapter_inputs(spark, sf) -> tuple[DataFrame, DataFrame]:
    h1 = F.filter("blocks", lambda b: (b.block_type == "h1") & C.owner_heading(b.text).isNotNull())
    full = F.filter("blocks", lambda b: b.text != "")
    p = first_pages(spark, sf).select("run_id", "row_id", "page", F.col("page_number").alias("printed"), C.owner_heading(F.try_element_at(h1, F.lit(1)).text).alias("heading"), F.try_element_at(full, F.lit(1)).alias("f"))
    p = p.withColumn("opens", F.coalesce((F.col("f.block_type") == "h1") & (T.collapse("f.text") == F.col("heading")), F.lit(False))).drop("f")
    q = table(spark, sf, "portions").where("run_id IS NOT NULL AND page_start >= 1 AND page_start <= coalesce(page_end, page_start)").select("run_id", F.col("row_id").alias("ordinal"), "title", "page_start", "page_end", "source_pages", (F.col("module_id") == "coarse_segment_patterns_v1").alias("by_source"))
    return p, q


@query(f"""WITH {_P1}, q AS (SELECT run_id, row_id AS portion, page_start AS s, coalesce(page_end, page_start) AS e, source_pages AS sp, coalesce(module_id = 'coarse_segment_patterns_v1', false) AS src FROM portions WHERE run_id IS NOT NULL AND page_start >= 1 AND page_start <= coalesce(page_end, page_start)),
 a AS (SELECT q.run_id, portion, p.row_id, CASE WHEN src THEN 1 ELSE 3 END AS way FROM q JOIN p1 p ON p.run_id = q.run_id AND list_contains(sp, p.page) UNION ALL SELECT q.run_id, portion, p.row_id, 2 FROM q JOIN p1 p ON p.run_id = q.run_id AND p.page_number BETWEEN s AND e
  UNION ALL SELECT q.run_id, portion, p.row_id, 4 FROM q JOIN p1 p ON p.run_id = q.run_id AND p.page BETWEEN s AND e) SELECT DISTINCT portion, row_id FROM a QUALIFY way = min(way) OVER (PARTITION BY portion)""")
def j02_portion_pages(spark, sf):
    """Pages of each portion by the four-step rule."""
    return C.pages_of_portions(*_chapter_inputs(spark, sf)).select("portion", "row_id")


@query()
def k04_chapters(spark, sf):
    """Chapters of each run from its pages and portions (literal cases and a plain fold in the tests)."""
    c = C.chapters(*_chapter_inputs(spark, sf))
    return c.select(F.col("run").alias("run_id"), "number", "title", "page_start", "page_end", F.array_join(F.transform("source_pages", lambda x: x.cast("string")), ",").alias("source_pages"), F.size("portions").alias("portions"))


@query()
def k04_bodies(spark, sf):
    """HTML body of each chapter, as a digest and its length (literal cases in the tests)."""
    from folium.functions.html import render_blocks
    pages, portions = _chapter_inputs(spark, sf)
    by_order = F.array_sort("blocks", lambda a, b: F.when(a.block_order < b.block_order, -1).when(a.block_order > b.block_order, 1).otherwise(0))
    html = first_pages(spark, sf).where(F.size("blocks") > 0).select("run_id", "page", render_blocks(by_order).alias("html"))
    b = C.chapter_bodies(materialize(C.chapters(pages, portions), "chapters"), html)
    return b.select(F.col("run").alias("run_id"), "number", F.md5("body").alias("digest"), F.length("body").alias("chars"))


@query()
def k04_uncovered(spark, sf):
    """Pages that no chapter covers, as entries of their own."""
    pages, portions = _chapter_inputs(spark, sf)
    u = C.uncovered_pages(pages, materialize(C.chapters(pages, portions), "chapters"))
    return u.select(F.col("run").alias("run_id"), "title", "page_start")


_DANG = ", ".join(f"'{w}'" for w in C.DANGLING)


@query(rf"""WITH {_P1}, t AS (SELECT run_id, page, list_filter(blocks, lambda b: b.text <> '' AND b.block_type IN ('p', 'li', 'td')) AS x FROM p1 WHERE len(blocks) > 0), s AS (SELECT run_id, page, trim(regexp_replace(x[-1].text, '[{_BL}]+', ' ', 'g')) AS z, trim(regexp_replace(x[1].text, '[{_BL}]+', ' ', 'g')) AS a FROM t WHERE len(x) > 0),
 l AS (SELECT run_id, page, a, lag(z) OVER w AS z, lag(page) OVER w AS pp FROM s WINDOW w AS (PARTITION BY run_id ORDER BY page))
 SELECT run_id, pp AS from_page, page FROM l WHERE pp = page - 1 AND z <> '' AND a <> '' AND NOT regexp_matches(z, '[.!?"'')\]]$') AND (regexp_matches(a, '^\p{{Ll}}') OR lower(regexp_extract(z, '([\p{{L}}\p{{N}}_]+)[^\p{{L}}\p{{N}}_]*$', 1)) IN ({_DANG}))""")
def w20_stitched_pages(spark, sf):
    """Pages whose first paragraph goes on with the last of the page before."""
    x = F.filter("blocks", lambda b: (b.text != "") & b.block_type.isin("p", "li", "td"))
    s = first_pages(spark, sf).where(F.size("blocks") > 0).select("run_id", "page", x.alias("x")).where(F.size("x") > 0).select("run_id", "page", F.element_at("x", -1).text.alias("last_text"), F.element_at("x", 1).text.alias("first_text"))
    s = R.with_neighbours(materialize(s, "ends"), ["run_id"], "page", ["last_text", "page"], after=False)
    return s.where((F.col("prev.page") == F.col("page") - 1) & C.stitches(F.col("prev.last_text"), F.col("first_text"))).select("run_id", F.col("prev.page").alias("from_page"), "page")


@query()
def j13_matched_blocks(spark, sf):
    """The provenance block from which each preview block of an entry comes, by text."""
    src = table(spark, sf, "provenance_blocks").where("entry_id IS NOT NULL AND entry_id != ''").groupBy("run_id", "entry_id").agg(F.array_sort(F.collect_list(F.struct("row_id", "block_id", "block_kind", "text_quote"))).alias("s"))
    out = table(spark, sf, "preview_blocks").where("entry_id IS NOT NULL AND entry_id != ''").groupBy("run_id", "entry_id").agg(F.array_sort(F.collect_list(F.struct("row_id", "kind", "text"))).alias("o"))
    def run(o: pd.Series, s: pd.Series) -> pd.Series:
        return pd.Series([C.matched_blocks([(x["kind"] or "", x["text"] or "") for x in a], [(x["block_id"], x["block_kind"] or "", x["text_quote"] or "") for x in b]) for a, b in zip(o, s)])

    m = out.join(src, ["run_id", "entry_id"]).select("o", F.pandas_udf(run, "array<string>")("o", "s").alias("m"))
    return m.select(F.explode(F.arrays_zip("o.row_id", "m")).alias("x")).select("x.*").toDF("row_id", "block_id")


@query(f"""WITH {_BB}, t AS (SELECT row_id, block_order, text, block_type FROM b WHERE block_type IN ('img', 'figure')) SELECT row_id, block_order, CASE WHEN regexp_matches(lower(text), 'setup|set up') THEN 'setup_diagram' WHEN regexp_matches(lower(text), 'map|board|layout|plan') THEN 'map_or_board' WHEN regexp_matches(lower(text), 'component|icon|token|piece') THEN 'component_reference'
 WHEN regexp_matches(lower(text), 'card|sheet') THEN 'card_reference' WHEN regexp_matches(lower(text), 'example|diagram|step|figure') THEN 'rule_example_diagram' ELSE 'instructional_figure' END AS role, CASE WHEN lower(trim(regexp_replace(coalesce(text, ''), '[{_BL}]+', ' ', 'g'))) IN ('', 'image', 'illustration', 'figure', 'diagram') THEN 'uncertain' ELSE 'essential' END AS importance FROM t""")
def f38_figures(spark, sf):
    """What the images of a page show, by their descriptions."""
    b = blocks(spark, sf).where(F.col("block_type").isin("img", "figure"))
    return b.select("row_id", "block_order", T.figure_role(F.col("text"), F.lit(None).cast("string"), F.lit(None).cast("string")).alias("r")).select("row_id", "block_order", "r.*")


@query(r"""WITH p AS (SELECT row_id, regexp_extract_all('<p>' || coalesce(text, '') || '</p><img alt="a map" data-count="' || row_id % 4 || '"><IMG alt="x">' || coalesce(html_text, ''), '(?is)<img\b[^>]*>') AS tags FROM preview_blocks), t AS (SELECT row_id, unnest(tags) AS tag FROM p),
 c AS (SELECT *, greatest(1, coalesce(try_cast(nullif(regexp_extract(tag, '(?i)data-count\s*=\s*["'']?([0-9]{1,4})', 1), '') AS INTEGER), 1)) AS n FROM t) SELECT row_id, count(*) AS images, CAST(sum(n) AS BIGINT) AS placeholders FROM c GROUP BY 1""")
def f09_placeholders(spark, sf):
    """Image placeholders of preview pages, to which two images are added."""
    t = lambda c: F.coalesce(c, F.lit(""))
    html = F.concat(F.lit("<p>"), t(F.col("text")), F.lit('</p><img alt="a map" data-count="'), (F.col("row_id") % 4).cast("string"), F.lit('"><IMG alt="x">'), t(F.col("html_text")))
    p = table(spark, sf, "preview_blocks").select("row_id", F.explode(T.image_placeholders(html)).alias("i")).select("row_id", "i.*")
    return p.groupBy("row_id").agg(F.sum(F.when(F.col("index") == 1, 1).otherwise(0)).alias("images"), F.count("*").alias("placeholders"))


@query("SELECT row_id, CASE WHEN page BETWEEN 1 AND 4 THEN 'frontmatter' WHEN page BETWEEN 5 AND 60 THEN 'gameplay' WHEN page BETWEEN 50 AND 90 THEN 'endmatter' END AS section FROM page_blocks")
def f11_macro_sections(spark, sf):
    return table(spark, sf, "page_blocks").select("row_id", T.macro_section(F.col("page"), (1, 4), (5, 60), (50, 90)).alias("section"))


@query(r"""WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '\bto the\b', 'tum t0 12 the') AS t FROM documents), m AS (SELECT doc_id, t, regexp_extract(t, '(?i)\b(turn|tum)\b(\s+)(to|t0)\b(\s+)([0-9]{1,4})\b', ['v', 'a', 'o', 'c', 'n']) AS g, regexp_extract(t, '(?i)\b(turn|tum)\b\s+(to|t0)\b\s+[0-9]{1,4}\b') AS whole FROM t)
 SELECT doc_id, md5(CASE WHEN whole <> '' AND (lower(g.v) = 'tum' OR contains(g.o, '0') OR g.o = 'tO') THEN substr(t, 1, instr(t, whole) - 1) || (CASE WHEN upper(g.v) = g.v THEN 'TURN' WHEN regexp_matches(g.v[1], '[A-Z]') THEN 'Turn' ELSE 'turn' END) || ' ' || (CASE WHEN upper(g.o) = g.o AND regexp_matches(g.o, '[A-Z]') THEN 'TO' ELSE 'to' END) || ' ' || g.n
  || substr(t, instr(t, whole) + length(whole)) ELSE t END) AS digest FROM m""")
def f13_repaired_turns(spark, sf):
    """Phrases 'tum t0 N' (made from 'to the') mended in each document, as a digest."""
    t = F.regexp_replace(F.coalesce("text", F.lit("")), F.lit(r"^([\s\S]*?)\bto the\b"), F.lit("$1tum t0 12 the"))
    return table(spark, sf, "documents").select("doc_id", F.md5(T.repaired_turn(t)).alias("digest"))


@query("""WITH h AS (SELECT row_id, '<p>' || coalesce(text, '') || '</p>' || CASE WHEN row_id % 3 = 0 THEN '<table><tr><td>old</td></tr></table>' WHEN row_id % 3 = 1 THEN '<p>Turn to 12 now</p>' ELSE '' END AS h FROM preview_blocks WHERE NOT contains(lower(coalesce(text, '')), 'turn') AND NOT contains(coalesce(text, ''), '<'))
 SELECT row_id, md5(CASE WHEN row_id % 3 = 0 THEN replace(h, '<table><tr><td>old</td></tr></table>', '<table>N</table>') WHEN row_id % 3 = 1 THEN '<table>N</table>' || chr(10) || h ELSE '<table>N</table>' || chr(10) || h END) AS digest FROM h""")
def f35_spliced_tables(spark, sf):
    """A new table put into pages that have one, that say 'turn to', and others, as a digest."""
    t = F.coalesce("text", F.lit(""))
    p = table(spark, sf, "preview_blocks").where(~F.lower(t).contains("turn") & ~t.contains("<"))
    i = F.col("row_id") % 3
    h = F.concat(F.lit("<p>"), t, F.lit("</p>"), F.when(i == 0, "<table><tr><td>old</td></tr></table>").when(i == 1, "<p>Turn to 12 now</p>").otherwise(""))
    return p.select("row_id", F.md5(T.splice_table(h, F.lit("<table>N</table>"))).alias("digest"))


@query("""WITH e AS (SELECT entry_id AS id, 'Note: ```json' || chr(10) || '{"n": ' || entry_order || ', "k": "' || coalesce(kind, '') || '"}' || chr(10) || '```' AS t, row_id, entry_order, kind FROM bundle_entries WHERE entry_order IS NOT NULL) SELECT row_id, entry_order AS n, coalesce(kind, '') AS k FROM e""")
def f40_relaxed_json(spark, sf):
    """JSON objects wrapped in notes and fences, read back."""
    e = table(spark, sf, "bundle_entries").where("entry_order IS NOT NULL")
    t = F.concat(F.lit('Note: ```json\n{"n": '), F.col("entry_order").cast("string"), F.lit(', "k": "'), F.coalesce("kind", F.lit("")), F.lit('"}\n```'))
    return e.select("row_id", T.relaxed_json(t, "n long, k string").alias("j")).select("row_id", "j.n", "j.k")


@query(r"""WITH t AS (SELECT row_id, text, upper(regexp_replace(text, '^\s+|\s+$', '', 'g')) AS u, regexp_replace(text, '^\s+|\s+$', '', 'g') AS t FROM (SELECT row_id, CASE WHEN row_id % 3 = 0 THEN 'Stamina = ' || row_id % 40 WHEN row_id % 3 = 1 THEN 'GIANT RAT  SKILL ' || row_id % 12 || '  STAMINA ' || row_id % 9 ELSE text END AS text FROM preview_blocks)),
 s AS (SELECT row_id, regexp_extract(u, '\bSKILL\s+([0-9]{1,3})\b', 1) AS sk, regexp_extract(u, '\bSTAMINA\s+([0-9]{1,3})\b', 1) AS st, regexp_extract(u, '\b([A-Z][A-Z'' -]{2,30})\s+SKILL\s+[0-9]{1,3}\b', 1) AS en, upper(trim(regexp_replace(regexp_extract(t, '^([A-Za-z][A-Za-z ]{1,24})\s*[:=]\s*([0-9]{1,4})?\s*$', 1), '\s+', ' ', 'g'))) AS k, regexp_extract(t, '^([A-Za-z][A-Za-z ]{1,24})\s*[:=]\s*([0-9]{1,4})?\s*$', 2) AS v, u FROM t)
 SELECT row_id, CASE WHEN contains(u, 'SKILL') AND contains(u, 'STAMINA') AND sk || st <> '' THEN nullif(trim(en), '') END AS entity, CASE WHEN contains(u, 'SKILL') AND contains(u, 'STAMINA') AND sk || st <> '' THEN 'SKILL' || CAST(sk AS INTEGER) || ' STAMINA' || CAST(st AS INTEGER) ELSE k || CASE WHEN v = '' THEN '' ELSE CAST(CAST(v AS INTEGER) AS VARCHAR) END END AS pairs FROM s WHERE (contains(u, 'SKILL') AND contains(u, 'STAMINA') AND sk || st <> '') OR k <> ''""")
def f20_key_values(spark, sf):
    """Assignments and stats of lines, two thirds of them made for the purpose."""
    i = F.col("row_id")
    t = F.when(i % 3 == 0, F.concat(F.lit("Stamina = "), (i % 40).cast("string"))).when(i % 3 == 1, F.concat(F.lit("GIANT RAT  SKILL "), (i % 12).cast("string"), F.lit("  STAMINA "), (i % 9).cast("string"))).otherwise(F.col("text"))
    k = table(spark, sf, "preview_blocks").select("row_id", t.alias("t")).select("row_id", T.key_values("t").alias("k")).where("k IS NOT NULL")
    return k.select("row_id", "k.entity", F.array_join(F.transform("k.pairs", lambda p: F.concat(p.key, F.coalesce(p.value.cast("string"), F.lit("")))), " ").alias("pairs"))


@query(r"""WITH d AS (SELECT run_id, page, row_id, coalesce(module_id, '') AS engine, array_to_string(list_transform(coalesce(blocks, []), lambda b: coalesce(b.text, '')), ' ') AS t FROM page_blocks), s AS (SELECT *, length(t) AS chars, round(1 - length(regexp_replace(t, '[^A-Za-z]', '', 'g')) / greatest(1, length(t)), 6) AS score FROM d)
 SELECT run_id, page, row_id FROM s QUALIFY row_number() OVER (PARTITION BY run_id, page ORDER BY CASE WHEN chars >= 40 THEN 0 ELSE 1 END, score, CASE engine WHEN 'marker_page_html_v1' THEN 1 WHEN 'html_to_blocks_v1' THEN 2 ELSE 3 END, row_id) = 1""")
def a19_best_reading(spark, sf):
    """The delivery of each page with the largest share of letters, of those with 40 characters; ties by module."""
    t = F.array_join(F.transform(F.coalesce("blocks", F.slice("blocks", 1, 0)), lambda b: F.coalesce(b.text, F.lit(""))), " ")
    d = table(spark, sf, "page_blocks").select("run_id", "page", "row_id", F.coalesce("module_id", F.lit("")).alias("engine"), F.coalesce(t, F.lit("")).alias("t"))
    d = d.withColumn("chars", F.length("t")).withColumn("score", F.round(1 - F.length(F.regexp_replace("t", "[^A-Za-z]", "")) / F.greatest(F.lit(1), F.length("t")), 6))
    return V.best_reading(d.drop("t"), ["run_id", "page"], F.col("score"), "engine", ["marker_page_html_v1", "html_to_blocks_v1"], "chars", 40, "row_id").select("run_id", "page", "row_id")
