"""Queries over boxes, made from the line items of orders, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions.series import Layout
from quire.operators import boxes
from quire.plans.registry import dealt, query, table

# one detection a line item, one page an order; pages are 200 wide and 160 high
DETS = """SELECT l_orderkey AS page, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS det,
CASE l_partkey % 4 WHEN 0 THEN 'Picture' WHEN 1 THEN 'Text' WHEN 2 THEN 'Section-header' ELSE 'Picture' END AS label, l_quantity / 50 AS score,
CAST(l_partkey % 150 AS DOUBLE) AS x0, CAST(l_suppkey % 130 AS DOUBLE) AS y0, l_partkey % 150 + 1 + l_quantity AS x1, CAST(l_suppkey % 130 + 1 + l_linenumber * 9 AS DOUBLE) AS y1, l_discount / 10 AS ink, l_returnflag AS flag FROM lineitem"""
PICS = "SELECT *, row_number() OVER (PARTITION BY page ORDER BY y0, x0, det) AS ord FROM d WHERE label = 'Picture'"


def dets(spark: SparkSession, d: str) -> DataFrame:
    i = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"))
    kind = F.col("l_partkey") % 4
    x, y = (F.col("l_partkey") % 150).cast("double"), (F.col("l_suppkey") % 130).cast("double")
    return dealt(table(spark, d, "lineitem"), "l_orderkey").select(
        F.col("l_orderkey").alias("page"), i.cast("long").alias("det"), F.when(kind == 1, "Text").when(kind == 2, "Section-header").otherwise("Picture").alias("label"), (F.col("l_quantity") / 50).alias("score"),
        x.alias("x0"), y.alias("y0"), (x + 1 + F.col("l_quantity")).alias("x1"), (y + 1 + F.col("l_linenumber") * 9).alias("y1"), (F.col("l_discount") / 10).alias("ink"), F.col("l_returnflag").alias("flag"), F.lit("said").alias("text"))


def pages(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("page")).distinct().select("page", F.lit(200.0).alias("width"), F.lit(160.0).alias("height"))


def pics(spark: SparkSession, d: str) -> DataFrame:
    return dets(spark, d).where("label = 'Picture'").withColumn("at", F.row_number().over(Window.partitionBy("page").orderBy("y0", "x0", "det")))


def inside(a: str, b: str) -> str:
    return f"greatest(0, least({a}.x1, {b}.x1) - greatest({a}.x0, {b}.x0)) * greatest(0, least({a}.y1, {b}.y1) - greatest({a}.y0, {b}.y0))"


def size(a: str) -> str:
    return f"(({a}.x1 - {a}.x0) * ({a}.y1 - {a}.y0))"


@query(f"""WITH d AS ({DETS}), p AS (SELECT * FROM d WHERE label = 'Picture' AND ink >= 0.004 AND {size('d')} <= 0.1 * 32000 AND (y0 + y1) / 2 > 16 AND x1 < 190 AND (y0 + y1) / 2 < 152 AND y1 - y0 >= 8),
e AS (SELECT * FROM p WHERE NOT ((x1 - x0) / (y1 - y0) > 0.5 AND EXISTS (SELECT 1 FROM d t WHERE t.page = p.page AND t.label IN ('Text', 'Section-header') AND {inside('p', 't')} > 0.3 * {size('p')}))),
n AS (SELECT * FROM e WHERE NOT EXISTS (SELECT 1 FROM e o WHERE o.page = e.page AND {size('o')} > {size('e')} AND {inside('e', 'o')} >= 0.9 * {size('e')}))
SELECT page, det, row_number() OVER (PARTITION BY page ORDER BY y0, x0, det) AS at FROM n""")
def picture_filters(spark: SparkSession, d: str) -> DataFrame:
    """All filters by place, size, equations and nesting."""
    layout = Layout(max_area=0.1, header=0.1, right_margin=0.05, footer=0.05, min_height=0.05, equation_overlap=0.3, equation_aspect=0.5)
    return boxes.pictures(dets(spark, d), pages(spark, d), layout).select("page", "det", "at")


@query(f"SELECT page, det, CASE WHEN ink < 0.004 THEN NULL WHEN label = 'Picture' THEN 'image' WHEN label = 'Section-header' AND flag = 'A' THEN NULL ELSE 'text' END AS kind FROM ({DETS}) d")
def box_kinds(spark: SparkSession, d: str) -> DataFrame:
    anchor = (F.col("label") == "Section-header") & (F.col("flag") == "A")
    return dets(spark, d).select("page", "det", boxes.kind_of(anchor, F.lit(False), F.lit("")).alias("kind"))


@query(f"SELECT page, det, label <> 'Picture' AND score >= 0.5 AS is_text, label = 'Picture' AND score >= 0.2 AS is_picture, label <> 'Picture' AND score >= 0.4 AS is_equation_text FROM ({DETS}) d WHERE score >= 0.2")
def score_split(spark: SparkSession, d: str) -> DataFrame:
    return boxes.by_score(dets(spark, d), 0.5, 0.2).select("page", "det", "is_text", "is_picture", "is_equation_text")


@query(f"SELECT page, det, row_number() OVER (PARTITION BY page ORDER BY round_even(y0 / 10, 0), x0, det) AS at FROM ({DETS}) d")
def box_order(spark: SparkSession, d: str) -> DataFrame:
    return boxes.reading_order(dets(spark, d)).select("page", "det", "at")


@query(f"""WITH d AS ({DETS}), m AS (SELECT page, y0 AS y, min(det) AS mark FROM d WHERE label = 'Section-header' GROUP BY 1, 2)
SELECT page, det, (SELECT max_by(mark, y) FROM m WHERE m.page = p.page AND m.y <= (p.y0 + p.y1) / 2 + 12) AS owner FROM d p WHERE label = 'Picture'""")
def asof_tolerance(spark: SparkSession, d: str) -> DataFrame:
    """Boxes to the last mark above their middle, with the tolerance of a row."""
    marks = dets(spark, d).where("label = 'Section-header'").groupBy("page", F.col("y0").alias("y")).agg(F.min("det").alias("mark"))
    return boxes.owners(pics(spark, d), marks, "mark").select("page", "det", "owner")


@query(f"""WITH d AS ({DETS}), m AS (SELECT page, CASE WHEN x0 < 75 THEN 0 ELSE 1 END AS col, y0 AS y, min(det) AS mark FROM d WHERE label = 'Section-header' GROUP BY 1, 2, 3),
p AS (SELECT page, det, CASE WHEN (x0 + x1) / 2 < 75 THEN 0 ELSE 1 END AS col, (y0 + y1) / 2 + 12 AS y FROM d WHERE label = 'Picture')
SELECT page, det, (SELECT max_by(mark, struct_pack(a := m.col, b := m.y)) FROM m WHERE m.page = p.page AND (m.col < p.col OR (m.col = p.col AND m.y <= p.y))) AS owner FROM p""")
def asof_columns(spark: SparkSession, d: str) -> DataFrame:
    """The same on pages of two columns."""
    col = F.when(F.col("x0") < 75, 0).otherwise(1)
    marks = dets(spark, d).where("label = 'Section-header'").groupBy("page", col.alias("c"), F.col("y0").alias("y")).agg(F.min("det").alias("mark")).withColumns({"x": F.when(F.col("c") == 0, 0.0).otherwise(100.0), "gutter": F.lit(75.0)})
    return boxes.column_owners(pics(spark, d).withColumn("gutter", F.lit(75.0)), marks, "gutter", "mark").select("page", "det", "owner")


@query(f"""WITH d AS ({DETS}), t AS (SELECT page, det, det % 3 AS k, sum(x1 - x0) OVER w - (x1 - x0) AS at, sum(x1 - x0) OVER (PARTITION BY page) AS total FROM d WHERE label <> 'Picture' WINDOW w AS (PARTITION BY page ORDER BY det)),
p AS (SELECT page, det, (y0 + y1) / 2 / 160 AS share FROM d WHERE label = 'Picture')
SELECT page, det, (SELECT max_by(t.det, t.at) FROM t WHERE t.page = p.page AND t.k > 0 AND t.at <= p.share * t.total) AS owner FROM p""")
def asof_offset(spark: SparkSession, d: str) -> DataFrame:
    """By the share of the page's text that stands before; spans of no problem are passed over."""
    width = (F.col("x1") - F.col("x0")).cast("int")
    spans = dets(spark, d).where("label <> 'Picture'").select("page", F.col("det").alias("item_no"), F.when(F.col("det") % 3 > 0, F.col("det")).alias("problem"), F.repeat(F.lit("x"), width).alias("text"))
    return boxes.offset_owners(pics(spark, d), pages(spark, d), spans).select("page", "det", "owner")


@query(f"""WITH d AS ({DETS}), f AS (SELECT *, CASE WHEN y0 - lag(y1) OVER (PARTITION BY page ORDER BY y0, det) >= 9.6 THEN 1 ELSE 0 END AS fresh FROM d)
SELECT page, det, sum(fresh) OVER (PARTITION BY page ORDER BY y0, det) + 1 AS problem FROM f""")
def gap_groups(spark: SparkSession, d: str) -> DataFrame:
    return boxes.groups_by_gaps(dets(spark, d), pages(spark, d)).select("page", "det", "problem")


@query(f"""WITH RECURSIVE d AS ({DETS}), t AS (SELECT *, min(x0) OVER (PARTITION BY page) AS l FROM d WHERE label = 'Text' AND ink >= 0.004 OR (label = 'Section-header' AND ink >= 0.004 AND NOT EXISTS (SELECT 1 FROM d o WHERE o.page = d.page AND o.label = 'Text' AND o.ink >= 0.004))),
y AS (SELECT page, y0, row_number() OVER (PARTITION BY page ORDER BY y0) AS i FROM (SELECT DISTINCT page, y0 FROM t WHERE x0 <= l + 4) q),
f AS (SELECT page, i, y0, y0 AS last, true AS taken FROM y WHERE i = 1 UNION ALL SELECT y.page, y.i, y.y0, CASE WHEN y.y0 - f.last > 12 THEN y.y0 ELSE f.last END, y.y0 - f.last > 12 FROM f JOIN y ON y.page = f.page AND y.i = f.i + 1)
SELECT page, y0 AS y FROM f WHERE taken""")
def margin_starts(spark: SparkSession, d: str) -> DataFrame:
    """Starts by the left margin; rows near the last start taken are passed over."""
    return boxes.spaced_starts(dets(spark, d), pages(spark, d))


BANDS = "b AS (SELECT *, max({e}) OVER (PARTITION BY page ORDER BY {s}, {e} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM d), c AS (SELECT *, sum(CASE WHEN {s} > before THEN 1 ELSE 0 END) OVER (PARTITION BY page ORDER BY {s}, {e} ROWS UNBOUNDED PRECEDING) AS island FROM b), g AS (SELECT page, island, min({s}) AS lo, max({e}) AS hi FROM c GROUP BY 1, 2), h AS (SELECT *, lag(hi) OVER (PARTITION BY page ORDER BY island) AS before FROM g)"


@query(f"""WITH d AS ({DETS}), {BANDS.format(s='y0', e='y1')}, r AS (SELECT *, row_number() OVER (PARTITION BY page, before IS NULL ORDER BY lo - before DESC, island) AS rank FROM h)
SELECT page, lo AS y FROM r WHERE before IS NULL OR rank < 2""")
def gap_cuts(spark: SparkSession, d: str) -> DataFrame:
    """Pages cut into two parts at their widest gap."""
    return boxes.gap_starts(dets(spark, d), pages(spark, d).select("page", F.lit(2).alias("n")))


@query(f"""WITH d AS (SELECT * FROM ({DETS}) q WHERE x1 - x0 <= 30), {BANDS.format(s='x0', e='x1')} SELECT page, min_by((before + lo) / 2, island) AS gutter FROM h WHERE lo - before >= 1.5 AND (before + lo) / 2 BETWEEN 15 AND 35 GROUP BY page""")
def gutter(spark: SparkSession, d: str) -> DataFrame:
    return boxes.gutters(dets(spark, d), pages(spark, d).withColumn("width", F.lit(50.0)))


@query(f"""WITH d AS ({DETS}), p AS ({PICS}), f AS (SELECT *, CASE WHEN y0 > max(y1) OVER (PARTITION BY page ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 3.2 THEN 1 ELSE 0 END AS fresh FROM p),
c AS (SELECT *, sum(fresh) OVER (PARTITION BY page ORDER BY ord) + 1 AS cluster FROM f), t AS (SELECT page, det, row_number() OVER (PARTITION BY page ORDER BY det) AS i FROM d WHERE label = 'Text')
SELECT c.page, c.det, t.det AS problem FROM c JOIN t ON t.page = c.page AND t.i = c.cluster WHERE (SELECT max(cluster) FROM c o WHERE o.page = c.page) = (SELECT max(i) FROM t o WHERE o.page = c.page)""")
def cluster_zip(spark: SparkSession, d: str) -> DataFrame:
    """The pictures of the i-th cluster with the i-th tag, where both are equally many."""
    found = boxes.clusters(pics(spark, d), pages(spark, d))
    tags = dets(spark, d).where("label = 'Text'").select("page", F.col("det").alias("item_no"), F.col("det").alias("problem"))
    return boxes.zipped(found, tags, "cluster")


@query(f"""WITH d AS ({DETS}), s AS (SELECT page, y0 AS y, row_number() OVER (PARTITION BY page ORDER BY y0) AS rank FROM (SELECT DISTINCT page, y0 FROM d WHERE label = 'Section-header') q),
t AS (SELECT page, det, row_number() OVER (PARTITION BY page ORDER BY det) AS pos FROM d WHERE label = 'Text'),
p AS (SELECT page, det, (y0 + y1) / 2 + 12 AS y, (SELECT max(rank) FROM s WHERE s.page = d.page AND s.y <= (d.y0 + d.y1) / 2 + 12) AS rank, (SELECT count(*) FROM s WHERE s.page = d.page) AS n, (SELECT count(*) FROM t WHERE t.page = d.page) AS m FROM d WHERE label = 'Picture'),
o AS (SELECT p.*, CASE WHEN m = 0 OR (n > 0 AND rank IS NULL) THEN 1000 ELSE (SELECT det FROM t WHERE t.page = p.page AND t.pos = CASE WHEN p.n = 0 THEN 1 ELSE least(p.rank, p.m) END) END AS problem FROM p)
SELECT page, det, problem FROM o""")
def start_assignment(spark: SparkSession, d: str) -> DataFrame:
    """Pictures to problems by the starts of a page; others to the problem carried on."""
    starts = dets(spark, d).where("label = 'Section-header'").select("page", F.col("y0").alias("y")).distinct()
    problems = dets(spark, d).where("label = 'Text'").select("page", F.row_number().over(Window.partitionBy("page").orderBy("det")).alias("pos"), F.col("det").alias("problem"))
    return boxes.by_starts(pics(spark, d), starts, problems, pages(spark, d).select("page", F.lit(1000).cast("long").alias("carry")))


@query(f"""WITH d AS ({DETS}) SELECT p.page, p.det FROM d p WHERE p.label = 'Picture' AND (p.y0 + p.y1) / 2 <= 100 AND NOT EXISTS (SELECT 1 FROM d r WHERE r.page = p.page AND r.label = 'Text'
AND (p.x0 + p.x1) / 2 BETWEEN r.x0 AND r.x1 AND (p.y0 + p.y1) / 2 BETWEEN r.y0 AND r.y1)""")
def picture_regions(spark: SparkSession, d: str) -> DataFrame:
    """Pictures above a floor and outside regions."""
    kept = boxes.above(pics(spark, d), pages(spark, d).select("page", F.lit(100.0).alias("floor")))
    return boxes.outside(kept, dets(spark, d).where("label = 'Text'").select("page", "x0", "y0", "x1", "y1")).select("page", "det")


@query(f"""WITH d AS ({DETS}), l AS (SELECT page, det, row_number() OVER (PARTITION BY page ORDER BY (y0 + y1) / 2 DESC, x1 - x0 DESC, det) AS r FROM d WHERE page % 2 = 0 AND label = 'Picture' AND (y0 + y1) / 2 >= 137.6 AND y1 - y0 <= 12.8 AND x1 - x0 >= 4.5 * (y1 - y0))
SELECT page, det FROM d WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.page = d.page AND l.det = d.det AND l.r = 1)""")
def sponsor_mark(spark: SparkSession, d: str) -> DataFrame:
    return boxes.without_sponsor(dets(spark, d), pages(spark, d), F.col("page") % 2 == 0).select("page", "det")


@query(f"SELECT page, det FROM ({DETS}) d WHERE NOT (page % 3 = 0 AND label = 'Picture' AND x1 - x0 >= 45 AND (y0 + y1) / 2 >= 72)")
def answer_grid(spark: SparkSession, d: str) -> DataFrame:
    """Wide pictures low on pages whose text holds a table of answers; here pages of 90 by 160."""
    told = pages(spark, d).withColumns({"width": F.lit(90.0), "markdown": F.when(F.col("page") % 3 == 0, "x\n**Answers**\n<table><tr></tr></table>").otherwise("Answers without")})
    return boxes.without_answer_table(dets(spark, d), told).select("page", "det")


@query(f"""WITH d AS ({DETS}), p AS (SELECT *, {size('d')} AS a FROM d WHERE label = 'Picture'), w AS (SELECT p.page, p.det, greatest(p.x0, t.x0) AS x0, greatest(p.y0, t.y0) AS y0, least(p.x1, t.x1) AS x1, least(p.y1, t.y1) AS y1 FROM p JOIN d t ON t.page = p.page AND t.label = 'Text' WHERE {inside('p', 't')} > 0),
xs AS (SELECT page, det, x AS a, lead(x) OVER (PARTITION BY page, det ORDER BY x) AS b FROM (SELECT page, det, x0 AS x FROM w UNION SELECT page, det, x1 FROM w) q), ys AS (SELECT page, det, y AS a, lead(y) OVER (PARTITION BY page, det ORDER BY y) AS b FROM (SELECT page, det, y0 AS y FROM w UNION SELECT page, det, y1 FROM w) q),
u AS (SELECT xs.page, xs.det, sum((xs.b - xs.a) * (ys.b - ys.a)) AS area FROM xs JOIN ys ON xs.page = ys.page AND xs.det = ys.det WHERE EXISTS (SELECT 1 FROM w WHERE w.page = xs.page AND w.det = xs.det AND w.x0 <= xs.a AND w.x1 >= xs.b AND w.y0 <= ys.a AND w.y1 >= ys.b) GROUP BY 1, 2)
SELECT p.page, p.det FROM p LEFT JOIN u ON u.page = p.page AND u.det = p.det WHERE NOT (coalesce(u.area, 0) >= 0.2 * p.a AND NOT EXISTS (SELECT 1 FROM d s WHERE s.page = p.page AND s.label = 'Section-header' AND {inside('s', 'p')} > 0.5 * {size('s')}))""")
def set_equations(spark: SparkSession, d: str) -> DataFrame:
    """Pictures that words cover and that hold no drawing."""
    every = dets(spark, d)
    side = lambda label: every.where(F.col("label") == label).select("page", "x0", "y0", "x1", "y1")
    return boxes.without_set_equations(pics(spark, d), side("Text"), side("Section-header"), 0.2).select("page", "det")


@query(f"""WITH d AS ({DETS}), c AS (SELECT DISTINCT page, y0 AS c FROM d) SELECT page, coalesce((c + lag(c) OVER w) / 2, CASE WHEN lead(c) OVER w IS NULL THEN c ELSE c - (lead(c) OVER w - c) / 2 END) AS y FROM c WINDOW w AS (PARTITION BY page ORDER BY c)""")
def marker_borders(spark: SparkSession, d: str) -> DataFrame:
    return boxes.midpoints(dets(spark, d).select("page", F.col("y0").alias("c")).distinct())


@query(f"""WITH d AS ({DETS}), r AS (SELECT DISTINCT page, unnest(generate_series(CAST(y0 AS BIGINT), CAST(y0 AS BIGINT) + 6)) AS y FROM d), f AS (SELECT *, CASE WHEN y - lag(y) OVER (PARTITION BY page ORDER BY y) > 4 THEN 1 ELSE 0 END AS fresh FROM r),
b AS (SELECT page, band, min(y) AS a, max(y) + 1 AS z FROM (SELECT *, sum(fresh) OVER (PARTITION BY page ORDER BY y) AS band FROM f) q GROUP BY 1, 2), k AS (SELECT *, count(*) OVER (PARTITION BY page) AS n FROM b WHERE z - a BETWEEN 6 AND 40)
SELECT page, (a + z) / 2 AS c FROM k WHERE n = 2""")
def ink_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = dets(spark, d).select("page", F.explode(F.sequence(F.col("y0").cast("long"), F.col("y0").cast("long") + 6)).alias("y")).distinct()
    return boxes.ink_bands(rows, pages(spark, d).select("page", F.lit(2).alias("n")))


@query(f"SELECT page, det, det::VARCHAR || CASE WHEN label = 'Text' THEN ':P' || (det + 8) ELSE '' END AS caption, CASE WHEN label = 'Text' THEN (det + 8) % 10 ELSE -1 END AS colour FROM ({DETS}) d")
def overlay_captions(spark: SparkSession, d: str) -> DataFrame:
    return boxes.overlay(dets(spark, d).withColumn("problem", F.when(F.col("label") == "Text", F.col("det") + 8))).select("page", "det", "caption", "colour")
