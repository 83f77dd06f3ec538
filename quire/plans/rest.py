"""Queries over rounds, types, figures in texts, clues, anchors, keys and tags, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions import answers, text
from quire.operators import boxes, documents, segment, sequence
from quire.plans.pages import FLAT, TURNS, turns
from quire.plans.registry import query, table
from quire.plans.spatial import DETS, dets, pages, pics
from quire.sources import files


@query(f"SELECT conv_id, string_agg(CASE i % 3 WHEN 0 THEN 'Round B' ELSE {FLAT} END, chr(10) ORDER BY i) AS text FROM (SELECT *, count(*) OVER (PARTITION BY conv_id) AS n FROM ({TURNS}) t) q WHERE i >= 3 OR n < 3 GROUP BY conv_id")
def round_filter(spark: SparkSession, d: str) -> DataFrame:
    """The sections of a round; every third turn is a header, conversations without one stay whole."""
    line = F.when(F.col("i") % 3 == 0, "Round B").otherwise(F.col("text"))
    rows = turns(spark, d).select("conv_id", F.col("i").alias("pos"), line.alias("line"))
    return documents.round_text(rows, "^Round [A-Z]$", F.col("header_line") == "Round B", ["conv_id"])


@query("SELECT p_partkey AS k, CASE p_partkey % 4 WHEN 0 THEN 'answer_key' WHEN 1 THEN 'integral_answers' WHEN 2 THEN 'solutions' ELSE 'statements' END AS kind FROM part")
def document_types(spark: SparkSession, d: str) -> DataFrame:
    kind = F.col("p_partkey") % 4
    x = F.when(kind == 0, F.concat("p_name", F.lit("\n**Answer Key**"))).when(kind == 1, F.concat(F.lit("Integral 3 Answer: "), "p_name")).when(kind == 2, F.concat(F.lit("Proposed by "), "p_name")).otherwise(F.col("p_name"))
    return table(spark, d, "part").select(F.col("p_partkey").alias("k"), documents.document_type(x).alias("kind"))


@query("SELECT o_orderkey, CASE WHEN EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o_orderkey AND l.l_linenumber = 2) THEN 'l2' ELSE '' END AS statement FROM orders")
def statement_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Solutions with the statement of the same number, empty without one."""
    said = table(spark, d, "lineitem").where("l_linenumber = 2").select(F.col("l_orderkey").alias("o_orderkey"), F.lit("l2").alias("text"))
    return documents.looked_up(table(spark, d, "orders").select("o_orderkey"), said, ["o_orderkey"])


@query("SELECT o_orderkey, trim('a' || CASE WHEN n >= 1 THEN ' 1.png' ELSE ' ' END || ' b', ' ') || CASE WHEN n > 1 THEN chr(10) || array_to_string(list_transform(range(2, n + 1), lambda i: i || '.png'), chr(10)) ELSE '' END AS text FROM (SELECT o_orderkey, o_custkey % 4 AS n FROM orders) q")
def inline_figures(spark: SparkSession, d: str) -> DataFrame:
    """References in the places of placeholders; those over stand behind."""
    rows = table(spark, d, "orders").select("o_orderkey", (F.col("o_custkey") % 4).cast("int").alias("n"))
    refs = rows.where("n > 0").select("o_orderkey", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("figure")).withColumn("ref", F.concat(F.col("figure").cast("string"), F.lit(".png")))
    return documents.with_figures(rows.select("o_orderkey", F.lit(f"a {text.FIGURE} b").alias("text")), refs, ["o_orderkey"])


@query(f"""WITH d AS (SELECT *, CASE WHEN label = 'Text' THEN det % 9 + 1 WHEN label = 'Picture' AND x1 <= 24 THEN det % 7 + 1 END AS n FROM ({DETS}) q), r AS (SELECT *, max(n) OVER (PARTITION BY page ORDER BY y0, det ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM d WHERE n IS NOT NULL)
SELECT page, det, n AS problem, y0 AS y, label = 'Text' AND det % 2 = 0 AS inline FROM r WHERE top IS NULL OR n > top""")
def box_anchors(spark: SparkSession, d: str) -> DataFrame:
    """Boxes that open problems: markers in texts, and digits alone at the margin."""
    said = F.when(F.col("label") == "Text", F.concat((F.col("det") % 9 + 1).cast("string"), F.when(F.col("det") % 2 == 0, F.lit(". the statement follows")).otherwise(". x"))).when(F.col("label") == "Picture", (F.col("det") % 7 + 1).cast("string")).otherwise("no marker")
    rows = dets(spark, d).withColumn("text", said)
    m = text.marker(F.col("text"))
    found = documents.anchors(rows.withColumns({"n": m["number"], "e": m["end"]}), pages(spark, d), F.col("n"), F.col("e"))
    return found.select("page", "det", F.col("problem").cast("long").alias("problem"), "y", "inline")


@query("SELECT p_size AS k, CAST(row_number() OVER (PARTITION BY p_size ORDER BY p_partkey) AS INTEGER) AS number, p_name AS answer FROM (SELECT *, count(*) OVER (PARTITION BY p_size) AS n FROM part) q WHERE n >= 5")
def table_keys(spark: SparkSession, d: str) -> DataFrame:
    """Keys in tables and lists of five entries or more."""
    rows = table(spark, d, "part").select(F.col("p_size").alias("k"), "p_name", F.row_number().over(Window.partitionBy("p_size").orderBy("p_partkey")).alias("i"))
    cell = F.concat(F.lit("<td>"), F.col("i").cast("string"), F.lit("</td><td>"), "p_name", F.lit("</td>"))
    line = F.concat(F.col("i").cast("string"), F.lit(". "), "p_name")
    blocks = sequence.joined(rows.withColumn("line", F.when(F.col("k") % 2 == 0, cell).otherwise(line)), ["k"], "i", "line", "text")
    return documents.key_answers(blocks, ["k"], digits=9)


@query(f"SELECT conv_id, i AS number, {FLAT} || CASE WHEN i % 2 = 0 THEN chr(10) || 'and more' ELSE '' END AS text FROM ({TURNS}) t")
def key_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Entries of a key; furniture closes an entry."""
    line = F.concat(F.col("i").cast("string"), F.lit(". "), "text", F.when(F.col("i") % 2 == 0, F.lit("\nand more\nPage 3\nlost")).otherwise(""))
    docs = sequence.joined(turns(spark, d).withColumn("line", line), ["conv_id"], "i", "line", "text")
    return documents.key_blocks(segment.marked_lines(docs, "conv_id", "text"), ["conv_id"], r"^Page \d+$").select("conv_id", F.col("number").cast("long").alias("number"), "text")


@query("SELECT p_partkey AS k, CASE p_partkey % 3 WHEN 0 THEN p_size::VARCHAR WHEN 1 THEN '7' END AS answer FROM part")
def symbol_answers(spark: SparkSession, d: str) -> DataFrame:
    """Symbols that stand for numbers."""
    kind = F.col("p_partkey") % 3
    said = F.when(kind == 0, F.col("p_size").cast("string")).when(kind == 1, "S").otherwise("Q")
    return table(spark, d, "part").select(F.col("p_partkey").alias("k"), answers.symbol_answers(said, F.create_map(F.lit("S"), F.lit("7"))).alias("answer"))


@query(f"""WITH d AS ({DETS}), p AS (SELECT page, det FROM d WHERE label = 'Picture'), g AS (SELECT page, det, det % 5 AS place, det % 3 AS tag FROM p), c AS (SELECT DISTINCT page, det % 4 AS problem FROM d WHERE label = 'Text')
SELECT page, det, CASE WHEN EXISTS (SELECT 1 FROM c WHERE c.page = g.page AND c.problem = g.tag) AND NOT EXISTS (SELECT 1 FROM c WHERE c.page = g.page AND c.problem = g.place) THEN tag ELSE place END AS problem FROM g""")
def reconciled_tags(spark: SparkSession, d: str) -> DataFrame:
    """A tag wins over the place where only the tag's problem speaks of a figure."""
    p = pics(spark, d)
    cues = dets(spark, d).where("label = 'Text'").select("page", (F.col("det") % 4).alias("problem"))
    return boxes.reconciled(p.select("page", "det", (F.col("det") % 5).alias("problem")), p.select("page", "det", (F.col("det") % 3).alias("problem")), cues)


@query(f"""WITH d AS ({DETS}), t AS (SELECT page, det, label, row_number() OVER (PARTITION BY page ORDER BY det) AS n FROM d), g AS (SELECT *, lag(n) OVER (PARTITION BY page ORDER BY n) AS prev FROM t WHERE label = 'Picture'),
ok AS (SELECT page, count(*) AS n, bool_and((prev IS NULL OR n > prev) AND EXISTS (SELECT 1 FROM t x WHERE x.page = g.page AND x.label <> 'Picture' AND x.n > g.n)) AS good FROM g GROUP BY page)
SELECT g.page, g.det FROM g JOIN ok ON ok.page = g.page WHERE good AND ok.page % 2 = 0""")
def trusted_tags(spark: SparkSession, d: str) -> DataFrame:
    """Pages whose inline tags may stand for their pictures; on odd pages a filter by place took a picture."""
    n = F.row_number().over(Window.partitionBy("page").orderBy("det"))
    items = dets(spark, d).select("page", "det", F.col("det").alias("item_no"), F.when(F.col("label") == "Picture", "image").otherwise("text").alias("kind"), n.alias("problem"))
    found = pics(spark, d)
    first = F.row_number().over(Window.partitionBy("page").orderBy("det"))
    plain = found.unionByName(found.withColumn("__f", first).where("__f = 1 AND page % 2 = 1").drop("__f"))
    return boxes.trusted_tags(items.where("kind = 'image'"), found, plain, items).select("page", "det")


@query("SELECT o_orderkey, round(len(list_filter(range(0, 20), lambda x: (o_custkey * (x + 1)) % 256 < 200)) / 20.0, 6) AS ratio FROM orders")
def ink_shares(spark: SparkSession, d: str) -> DataFrame:
    points = F.transform(F.sequence(F.lit(1), F.lit(20)), lambda i: (F.col("o_custkey") * i) % 256)
    return table(spark, d, "orders").select("o_orderkey", F.round(boxes.ink_ratio(points), 6).alias("ratio"))


@query("SELECT DISTINCT d.source FROM documents d JOIN labels l ON l.doc_id = d.doc_id")
def existing_tests(spark: SparkSession, d: str) -> DataFrame:
    """Tests that have output already."""
    docs = table(spark, d, "documents").select("source", "doc_id")
    done = docs.join(table(spark, d, "labels").select("doc_id"), "doc_id", "left_semi")
    return documents.existing(docs.select("source").distinct(), done, "source")


@query("""WITH l AS (SELECT l_orderkey, l_linenumber AS pos, l_partkey % 4 AS kind, l_suppkey % 90 + 1 AS n FROM (SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey, min(l_suppkey) AS l_suppkey FROM lineitem GROUP BY 1, 2) q),
h AS (SELECT *, last_value(CASE kind WHEN 0 THEN 1000 WHEN 1 THEN 2000 END IGNORE NULLS) OVER (PARTITION BY l_orderkey ORDER BY pos) AS base FROM l)
SELECT l_orderkey, pos, CAST(CASE WHEN kind = 2 THEN base + n END AS INTEGER) AS code FROM h""")
def clue_codes(spark: SparkSession, d: str) -> DataFrame:
    """Line items as lines of a crossword: headings, clues and prose."""
    kind = F.col("l_partkey") % 4
    rows = table(spark, d, "lineitem").groupBy("l_orderkey", F.col("l_linenumber").alias("pos")).agg(F.min("l_partkey").alias("l_partkey"), F.min("l_suppkey").alias("l_suppkey"))
    line = F.when(kind == 0, "**Across**").when(kind == 1, "DOWN:").when(kind == 2, F.concat((F.col("l_suppkey") % 90 + 1).cast("string"), F.lit(") a clue"))).otherwise("prose of no number")
    return documents.clue_numbers(rows.select("l_orderkey", "pos", line.alias("line")), ["l_orderkey"]).select("l_orderkey", "pos", "code")


@query("""SELECT '/d/' || o_custkey || '/' || o_orderkey || '/test.pdf' AS path, CASE WHEN o_orderkey % 3 = 0 THEN '/d/' || o_custkey || '/' || o_orderkey || '/solutions.pdf' END AS found FROM orders
UNION ALL SELECT '/s/' || o_orderkey || '/problems.json', o_orderkey::VARCHAR FROM orders WHERE o_orderkey % 5 = 0""")
def sibling_files(spark: SparkSession, d: str) -> DataFrame:
    """The solution file beside a test (every third order has one), and folders that hold problems."""
    k, base = F.col("o_orderkey").cast("string"), F.concat(F.lit("/d/"), F.col("o_custkey").cast("string"), F.lit("/"), F.col("o_orderkey").cast("string"))
    own = F.array(F.concat(base, F.lit("/test.pdf")), F.when(F.col("o_orderkey") % 3 == 0, F.concat(base, F.lit("/solutions.pdf"))), F.when(F.col("o_orderkey") % 5 == 0, F.concat(F.lit("/s/"), k, F.lit("/problems.json"))), F.concat(F.lit("/s/_"), k, F.lit("/problems.json")), F.concat(F.lit("/s/"), k, F.lit("/other.json")))
    paths = table(spark, d, "orders").select(F.explode(own).alias("path")).where("path IS NOT NULL")
    beside = files.beside(paths.where("path LIKE '/d/%test.pdf'"), paths, "solutions.pdf").select("path", F.col("source").alias("found"))
    return beside.unionByName(files.with_problems(paths, "/s").select("path", F.col("test").alias("found")))
