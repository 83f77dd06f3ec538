"""Queries over pages, documents and answers, with their SQL.  Pages are built from the tables or stated as cases."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions import matching
from quire.functions.series import Layout
from quire.operators import documents, layout, segment, sequence
from quire.plans.registry import query, table


def values(rows: Iterable[tuple], names: list[str]) -> str:
    """SQL of a table of literals."""
    def one(x: object) -> str:
        return "NULL" if x is None else str(x).lower() if isinstance(x, bool) else str(x) if isinstance(x, (int, float)) else "'" + x.replace("'", "''") + "'"

    return "SELECT * FROM (VALUES " + ", ".join("(" + ", ".join(map(one, r)) + ")" for r in rows) + f") v({', '.join(names)})"


TURNS = "SELECT conv_id, turn, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i FROM conversations"


def turns(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "conversations").select("conv_id", "turn", F.regexp_replace("text", r"\s+", " ").alias("text"), F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")).alias("i"))


FLAT = "trim(regexp_replace(text, '\\s+', ' ', 'g'))"


@query(f"SELECT conv_id, i AS problem, '[' || (i % 9 + 1) || '] ' || {FLAT} || chr(10) || (i + 1) || '. stray' AS text FROM ({TURNS}) t")
def layout_points(spark: SparkSession, d: str) -> DataFrame:
    """Turns as problems with point values, each followed by a numbered line that has none."""
    line = F.concat(F.col("i").cast("string"), F.lit(". **["), (F.col("i") % 9 + 1).cast("string"), F.lit("]** "), "text", F.lit("\n"), (F.col("i") + 1).cast("string"), F.lit(". stray"))
    docs = sequence.joined(turns(spark, d).withColumn("line", line), ["conv_id"], "i", "line", "text")
    return layout.items(docs, "conv_id", layout=Layout({"point_values": True, "flat": True})).select("conv_id", "problem", "text")


@query(f"SELECT conv_id, i AS problem, {FLAT} || CASE WHEN i % 2 = 0 AND i < max(i) OVER (PARTITION BY conv_id) THEN chr(10) || 'continued on the next page' ELSE '' END AS text FROM ({TURNS}) t")
def layout_carry(spark: SparkSession, d: str) -> DataFrame:
    """Two turns a page; what a page begins with belongs to the last problem of the page before."""
    line = F.concat(F.when((F.col("i") % 2 == 1) & (F.col("i") > 1), F.lit("continued on the next page\n")).otherwise(""), F.col("i").cast("string"), F.lit(". "), "text")
    pages = sequence.joined(turns(spark, d).withColumns({"line": line, "page": F.floor((F.col("i") - 1) / 2)}), ["conv_id", "page"], "i", "line", "text")
    return layout.statements(layout.paged_items(pages, "conv_id", "page", "text"), ["conv_id"], ["page", "item_no"])


@query("SELECT p_size AS doc, row_number() OVER (PARTITION BY p_size ORDER BY p_partkey) AS problem, p_name AS text FROM part")
def layout_tables(spark: SparkSession, d: str) -> DataFrame:
    """Tables whose rows hold an answer blank and a statement."""
    rows = table(spark, d, "part").select(F.col("p_size").alias("doc"), "p_name", F.row_number().over(Window.partitionBy("p_size").orderBy("p_partkey")).alias("i"))
    row = F.concat(F.lit("<tr><td>"), F.col("i").cast("string"), F.lit(". ____</td><td>"), "p_name", F.lit("</td></tr>"))
    docs = sequence.joined(rows.withColumn("row", row), ["doc"], "i", "row", "body").select("doc", F.concat(F.lit("<table>"), F.regexp_replace("body", "\n", ""), F.lit("</table>")).alias("text"))
    return layout.items(docs, "doc", layout=Layout({"strict": True, "consecutive": True}, table_rows=True)).select("doc", F.col("problem"), "text")


# events of a user in time stand for the pages of a document
EVENTS = "SELECT user_id AS doc, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS page_no, event_type AS kind, event_id FROM events"


def event_pages(spark: SparkSession, d: str) -> DataFrame:
    i = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return table(spark, d, "events").select(F.col("user_id").alias("doc"), i.alias("page_no"), F.col("event_type").alias("kind"), "event_id")


@query(f"""WITH e AS ({EVENTS}), o AS (SELECT *, coalesce(last_value(CASE WHEN kind = 'view' THEN true WHEN kind = 'error' THEN false END IGNORE NULLS) OVER w, false) AS on_ FROM e WINDOW w AS (PARTITION BY doc ORDER BY page_no)),
r AS (SELECT *, last_value(CASE WHEN on_ AND kind = 'click' THEN page_no END IGNORE NULLS) OVER w AS f, last_value(CASE WHEN on_ AND kind = 'click' THEN 't' || event_id % 3 END IGNORE NULLS) OVER w AS base FROM o WINDOW w AS (PARTITION BY doc ORDER BY page_no)),
n AS (SELECT *, dense_rank() OVER (PARTITION BY doc, base ORDER BY f) AS nth FROM r WHERE on_ AND f IS NOT NULL) SELECT doc, page_no, CASE WHEN nth = 1 THEN base ELSE base || '_' || nth END AS test_id FROM n""")
def compendium_pages(spark: SparkSession, d: str) -> DataFrame:
    """A document of many tests: views switch reading on, errors off, clicks open a test."""
    switch = F.when(F.col("kind") == "view", True).when(F.col("kind") == "error", False)
    title = F.when(F.col("kind") == "click", F.concat(F.lit("t"), (F.col("event_id") % 3).cast("string")))
    return documents.compendium(event_pages(spark, d), switch, title)


@query(f"""WITH e AS ({EVENTS}), s AS (SELECT *, max(CASE WHEN event_id % 11 = 0 THEN 1 ELSE 0 END) OVER w AS sol, last_value(CASE WHEN kind IN ('view', 'click') THEN kind END IGNORE NULLS) OVER w AS event FROM e WINDOW w AS (PARTITION BY doc ORDER BY page_no))
SELECT doc, page_no, CASE WHEN sol = 1 THEN 'solution' ELSE 'statement' END AS role FROM s WHERE event IS NULL OR event <> 'click'""")
def packet_pages(spark: SparkSession, d: str) -> DataFrame:
    """Packets: statements up to the first page of solutions, without the pages of an excluded event."""
    return documents.packet(event_pages(spark, d), F.col("event_id") % 11 == 0, F.when(F.col("kind").isin("view", "click"), F.col("kind")), ["click"])


@query(f"""WITH e AS ({EVENTS}), h AS (SELECT doc, dense_rank() OVER (PARTITION BY doc ORDER BY page_no // 5) AS rank, page_no, kind = 'error' AS head, event_id FROM e),
j AS (SELECT *, sum(CASE WHEN head THEN 1 ELSE 0 END) OVER w AS j FROM h WINDOW w AS (PARTITION BY doc ORDER BY page_no)),
m AS (SELECT *, max(CASE WHEN head THEN rank - j END) OVER w + j AS met FROM j WINDOW w AS (PARTITION BY doc ORDER BY page_no)), t AS (SELECT *, greatest(rank, coalesce(met + 1, 0)) AS go FROM m WHERE NOT head),
k AS (SELECT DISTINCT doc, rank, page_no // 5 AS problem FROM h) SELECT t.doc, k.problem, row_number() OVER (PARTITION BY t.doc, t.go ORDER BY t.page_no) AS pos, CAST(t.event_id AS VARCHAR) AS text FROM t LEFT JOIN k ON k.doc = t.doc AND k.rank = t.go""")
def routed_preambles(spark: SparkSession, d: str) -> DataFrame:
    """What follows a section heading goes to the next problem; five pages a problem, errors are headings."""
    rows = event_pages(spark, d).select("doc", F.floor(F.col("page_no") / 5).alias("problem"), F.col("page_no").alias("pos"), F.when(F.col("kind") == "error", "# Section").otherwise(F.col("event_id").cast("string")).alias("text"))
    return documents.routed_preambles(rows, "^# ")


@query("""WITH a AS (SELECT o_custkey AS page, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rung, o_orderkey, o_orderstatus FROM orders),
s AS (SELECT *, CASE WHEN o_orderstatus = 'P' THEN 2 WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS s FROM a), r AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY s, rung) AS n FROM s)
SELECT page, rung, CASE s WHEN 0 THEN 'clean' WHEN 1 THEN 'invalid' ELSE 'runaway' END AS status FROM r WHERE n = 1""")
def attempt_ladder(spark: SparkSession, d: str) -> DataFrame:
    """The orders of a customer as attempts at a page; some loop, some are not valid."""
    rung = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    text = F.when(F.col("o_orderstatus") == "P", F.repeat(F.lit("the same words over and over, and then once more from the start. "), F.lit(40))).otherwise(F.concat(F.lit("plain page "), F.col("o_orderkey").cast("string")))
    numbered = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus").withColumn("rung", rung)
    attempts = numbered.select(F.col("o_custkey").alias("page"), "rung", text.alias("text"), "o_orderkey")
    return documents.ladder(attempts, F.col("o_orderkey") % 3 != 0).select("page", "rung", "status")


@query("""WITH f AS (SELECT l_orderkey, CAST(l_linenumber AS INTEGER) AS n FROM lineitem WHERE l_returnflag <> 'A'), w AS (SELECT DISTINCT l_orderkey, CAST(l_linenumber AS INTEGER) AS n FROM lineitem),
h AS (SELECT w.l_orderkey, count(*) AS want, count(f.n) AS n, string_agg(CASE WHEN f.n IS NULL THEN w.n::VARCHAR END, ',' ORDER BY w.n) AS missing FROM w LEFT JOIN (SELECT DISTINCT * FROM f) f ON f.l_orderkey = w.l_orderkey AND f.n = w.n GROUP BY 1)
SELECT l_orderkey, n, coalesce(missing, '') AS missing, CASE WHEN n = 0 THEN 'empty' WHEN n < want THEN 'incomplete' WHEN n = 1 THEN 'lone' ELSE 'ok' END AS verdict FROM h""")
def page_verdicts(spark: SparkSession, d: str) -> DataFrame:
    """Markers found on a page against those its text layer shows."""
    rows = table(spark, d, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("int").alias("problem"), "l_returnflag")
    return documents.verdicts(rows.where("l_returnflag <> 'A'"), rows, "l_orderkey").withColumns({"missing": F.array_join("missing", ","), "n": F.col("n").cast("long")})


@query(f"SELECT conv_id, i AS number, i || '. ' || {FLAT} AS block FROM ({TURNS}) t WHERE conv_id % 3 > 0")
def marker_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Texts cut at their markers; every third text repeats a number and gives nothing."""
    line = F.concat(F.col("i").cast("string"), F.lit(". "), "text", F.when((F.col("conv_id") % 3 == 0) & (F.col("i") == 1), F.lit("\n1. again")).otherwise(""))
    docs = sequence.joined(turns(spark, d).withColumn("line", line), ["conv_id"], "i", "line", "text")
    return documents.marker_blocks(docs, "conv_id", "text")


@query(f"SELECT conv_id, CAST(i AS BIGINT) AS number FROM ({TURNS}) t WHERE i % 2 = 0 OR conv_id % 2 = 0")
def labelled_markers(spark: SparkSession, d: str) -> DataFrame:
    """Where a document is labelled at all, only markers with a label before the next marker count."""
    line = F.concat(F.col("i").cast("string"), F.lit(". x"), F.when((F.col("i") % 2 == 0) & (F.col("conv_id") % 2 == 1), F.lit("\nAnswer: 5")).otherwise(F.lit("\nnothing")))
    docs = sequence.joined(turns(spark, d).withColumn("line", line), ["conv_id"], "i", "line", "text")
    lone = docs.where("conv_id % 2 = 0 OR text LIKE '%Answer:%'")
    return documents.labelled_markers(segment.marked_lines(lone, "conv_id", "text"), r"^Answer:", key="conv_id").select("conv_id", F.col("number").cast("long").alias("number"))


@query("""SELECT o_orderkey, 'Solution ' || i AS head, CASE i WHEN 1 THEN 'intro ' || o_orderkey || chr(10) || 'first' ELSE 'second' END AS text, CAST(i AS INTEGER) AS part FROM orders, (VALUES (1), (2)) v(i) WHERE o_orderkey % 2 = 0
UNION ALL SELECT o_orderkey, 'Solution ' || i, CASE i WHEN 1 THEN 'intro ' || o_orderkey WHEN 2 THEN 'first' ELSE 'second' END, i FROM orders, (VALUES (1), (2), (3)) v(i) WHERE o_orderkey % 2 = 1""")
def solution_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Solutions cut at headers; a secondary header closes what stands before it."""
    head = F.when(F.col("o_orderkey") % 2 == 0, "Solution 1").otherwise("Second Solution")
    text = F.concat(F.lit("intro "), F.col("o_orderkey").cast("string"), F.lit("\n"), head, F.lit("\nfirst\nSolution 2\nsecond"))
    blocks = table(spark, d, "orders").select("o_orderkey", text.alias("text"))
    out = documents.solution_blocks(blocks, ["o_orderkey"], "text", r"^Solution \d", r"^Second Solution")
    return out.select("o_orderkey", F.concat(F.lit("Solution "), F.col("part").cast("string")).alias("head"), "text", "part")


@query("SELECT user_id AS doc, CAST(max(event_id) AS BIGINT) AS last_id, count(*) AS n FROM events GROUP BY user_id")
def last_pages(spark: SparkSession, d: str) -> DataFrame:
    """The problem that is open at the end of a document, all of whose pages open one."""
    rows = table(spark, d, "events").select(F.col("user_id").alias("doc"), F.col("event_id").alias("page"), F.concat(F.col("event_id").cast("string"), F.lit(". x")).alias("text"))
    found = layout.paged_items(rows, "doc", "page", "text", layout=Layout({"flat": True}))
    return found.groupBy("doc").agg(F.max("problem").alias("last_id"), F.count(F.lit(1)).alias("n"))


@query(f"SELECT conv_id, turn, {FLAT} AS text FROM conversations")
def statements_off(spark: SparkSession, d: str) -> DataFrame:
    """Solutions that begin with their statement, spaces aside."""
    said = turns(spark, d).withColumn("statement", F.concat(F.lit("Let $x$ (a.b) be  given, "), "turn", F.lit("\n times?")))
    body = F.concat(F.regexp_replace("statement", r"\s+", "  "), F.lit(" "), "text")
    return said.select("conv_id", "turn", F.trim(matching.exact_statement_off(body, F.col("statement"))).alias("text"))


@query(f"WITH q AS (SELECT conv_id, i, {FLAT} AS text, row_number() OVER (PARTITION BY conv_id, {FLAT} ORDER BY i) AS r FROM ({TURNS}) t) SELECT conv_id, count(*) AS n FROM q GROUP BY conv_id HAVING bool_and(r = 1)")
def assigned_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Blocks in another order come back to their own problems, in conversations whose turns differ; counted."""
    t = turns(spark, d)
    whole = t.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("text").alias("k")).where("n = k").select("conv_id")
    t = t.join(whole, "conv_id")
    pairs = matching.assigned(t.select("conv_id", F.col("i").cast("long").alias("problem"), "text"), t.select("conv_id", (100 - F.col("i")).cast("long").alias("block_no"), "text"), "conv_id")
    return pairs.where("problem + block_no = 100").groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH a AS (SELECT o_custkey, o_orderkey, o_orderkey % 3 + 1 AS tier, CASE WHEN o_orderkey % 5 = 0 THEN ' ' ELSE o_orderpriority END AS answer FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY tier, o_orderkey) AS n FROM a WHERE trim(answer) <> '') SELECT o_custkey, answer, tier FROM r WHERE n = 1""")
def answer_tiers(spark: SparkSession, d: str) -> DataFrame:
    answer = F.when(F.col("o_orderkey") % 5 == 0, " ").otherwise(F.col("o_orderpriority"))
    rows = table(spark, d, "orders").select("o_custkey", (F.col("o_orderkey") % 3 + 1).alias("tier"), F.col("o_orderkey").alias("pos"), answer.alias("answer"))
    return documents.tiers(rows, ["o_custkey"])


@query("""WITH l AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem), o AS (SELECT o_orderkey, v.n FROM orders, (VALUES (1), (9)) v(n))
SELECT o.o_orderkey, CAST(o.n AS INTEGER) AS problem FROM o WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.l_orderkey = o.o_orderkey) OR EXISTS (SELECT 1 FROM l WHERE l.l_orderkey = o.o_orderkey AND l.l_linenumber = o.n)""")
def known_problems(spark: SparkSession, d: str) -> DataFrame:
    """Only numbers of the statements stay; without statements all do."""
    found = table(spark, d, "orders").select("o_orderkey", F.explode(F.array(F.lit(1), F.lit(9))).alias("problem"))
    known = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linenumber").cast("int").alias("problem"))
    return documents.unlisted(found, known, ["o_orderkey", "problem"])


@query("SELECT source, min(doc_id) AS page, count(*) AS copies FROM documents GROUP BY source, sha256(coalesce(text, ''))")
def page_copies(spark: SparkSession, d: str) -> DataFrame:
    """The first of pages with the same bytes."""
    docs = table(spark, d, "documents").select("source", F.col("doc_id").alias("page"), F.coalesce("text", F.lit("")).alias("text"))
    copies = docs.groupBy("source", F.sha2("text", 256).alias("h")).agg(F.count(F.lit(1)).alias("copies"))
    return documents.first_pages(docs, "source", "page", "text").withColumn("h", F.sha2("text", 256)).join(copies, ["source", "h"]).select("source", "page", "copies")


@query(f"SELECT conv_id, turn AS pos, CASE WHEN i % 2 = 0 THEN (i + 100) || '. ' ELSE 'x' || i || '. ' END || 'y' AS line FROM ({TURNS}) t")
def renumbered_lines(spark: SparkSession, d: str) -> DataFrame:
    line = F.concat(F.when(F.col("i") % 2 == 0, F.col("i").cast("string")).otherwise(F.concat(F.lit("x"), F.col("i").cast("string"))), F.lit(". y"))
    return documents.renumbered(turns(spark, d).select("conv_id", F.col("turn").alias("pos"), line.alias("line")), F.lit(100), "conv_id")


@query("""SELECT l_orderkey, string_agg(l_linenumber || ':' || inner_, ';' ORDER BY l_linenumber) AS figures FROM (SELECT l_orderkey, l_linenumber, string_agg(DISTINCT l_returnflag, '+' ORDER BY l_returnflag) AS inner_ FROM lineitem GROUP BY 1, 2) q GROUP BY 1""")
def figure_maps(spark: SparkSession, d: str) -> DataFrame:
    """Figures by problem and solution, as nested maps; here flattened."""
    rows = table(spark, d, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("problem"), F.lit(1).alias("solution"), F.col("l_returnflag").alias("figure"), F.col("l_returnflag").alias("path")).distinct()
    nested = documents.nested_figures(rows, ["l_orderkey"])
    entry = F.transform(F.array_sort(F.map_keys("figures")), lambda k: F.concat(k.cast("string"), F.lit(":"), F.array_join(F.col("figures")[k][1], "+")))
    return nested.select("l_orderkey", F.array_join(entry, ";").alias("figures"))


@query("SELECT p_partkey AS k, CASE WHEN p_partkey % 2 = 0 THEN p_name END AS body FROM part")
def page_section(spark: SparkSession, d: str) -> DataFrame:
    """What stands between a heading and the next."""
    text = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("intro\nContest A\n"), "p_name", F.lit("\nContest B\nmore"))).otherwise(F.concat(F.lit("Contest C\n"), "p_name"))
    return table(spark, d, "part").select(F.col("p_partkey").alias("k"), documents.section(text, r"Contest A\n", r"\nContest [A-Z]").alias("body"))


@query("SELECT p_partkey AS k, CAST(v.n AS INTEGER) AS number, CASE v.n WHEN 1 THEN p_size::VARCHAR ELSE p_brand END AS answer FROM part, (VALUES (1), (2)) v(n)")
def bracketed_answers(spark: SparkSession, d: str) -> DataFrame:
    text = F.concat(F.lit("(1) "), F.col("p_size").cast("string"), F.lit("\n(2) "), "p_brand", F.lit(" \nend"))
    return table(spark, d, "part").select(F.col("p_partkey").alias("k"), F.explode(documents.bracketed_answers(F.regexp_replace(text, "\nend", "\n"))).alias("x")).select("k", "x.*")


@query("SELECT p_partkey AS k, CAST(1 AS INTEGER) AS number, p_name AS answer FROM part UNION ALL SELECT p_partkey, 2, p_brand FROM part")
def line_answers(spark: SparkSession, d: str) -> DataFrame:
    """`Solution N. value`, the value on the line or the next."""
    lines = F.split(F.concat(F.lit("Solution 1. "), "p_name", F.lit("\nSolution 2.\n"), "p_brand", F.lit("\nSolution 2. other")), "\n")
    rows = table(spark, d, "part").select(F.col("p_partkey").alias("k"), F.posexplode(lines).alias("pos", "line"))
    return documents.line_answers(rows, ["k"])


@query("SELECT r_regionkey, n_name FROM (SELECT r_regionkey, n_name, row_number() OVER (PARTITION BY r_regionkey ORDER BY CASE WHEN lower(n_name) LIKE '%ia%' THEN 0 WHEN lower(n_name) LIKE '%an%' THEN 1 ELSE 2 END, n_nationkey) AS i FROM nation JOIN region ON n_regionkey = r_regionkey) q WHERE i = 1 AND r_regionkey = 0")
def preferred_name(spark: SparkSession, d: str) -> DataFrame:
    """The first name that holds a preferred keyword."""
    names = table(spark, d, "nation").where("n_regionkey = 0").select(F.col("n_regionkey").alias("r_regionkey"), "n_name", "n_nationkey")
    return documents.first_match(names, ["ia", "an"], "n_name", "n_nationkey").select("r_regionkey", "n_name")


@query(f"""WITH t AS (SELECT conv_id, i, {FLAT} AS t FROM ({TURNS}) q)
SELECT conv_id, CAST(i * 10 AS BIGINT) AS pos, i || '. ' || t || CASE WHEN i % 3 = 0 THEN ': 1. a 2. b 3. c' ELSE '' END AS line FROM t""")
def list_runs(spark: SparkSession, d: str) -> DataFrame:
    """Numbered turns, of which every third holds a list of its own; the list joins the line before it."""
    from quire.functions.text import marker

    own = F.concat(F.col("i").cast("string"), F.lit(". "), "text", F.when(F.col("i") % 3 == 0, ":").otherwise(""))
    lines = F.when(F.col("i") % 3 == 0, F.array(own, F.lit("1. a"), F.lit("2. b"), F.lit("3. c"))).otherwise(F.array(own))
    rows = turns(spark, d).select("conv_id", "i", F.posexplode(lines).alias("n", "line")).select(F.col("conv_id").alias("doc_id"), (F.col("i") * 10 + F.col("n")).cast("long").alias("pos"), "line")
    found = documents.without_lists(rows.withColumn("number", marker(F.col("line"))["number"]))
    return found.select(F.col("doc_id").alias("conv_id"), "pos", "line")


@query("SELECT p_partkey AS k, CAST(CASE p_partkey % 5 WHEN 0 THEN p_size WHEN 1 THEN 3 WHEN 3 THEN 1 WHEN 4 THEN p_size + 1 END AS INTEGER) AS n FROM part")
def solution_indexes(spark: SparkSession, d: str) -> DataFrame:
    """The number of the last heading of a solution."""
    size, kind = F.col("p_size").cast("string"), F.col("p_partkey") % 5
    x = F.when(kind == 0, F.concat(F.lit("Solution 1\nx\n**Solution "), size, F.lit("** y"))).when(kind == 1, F.concat(F.lit("Solution "), size, F.lit("\nThird Solution: z"))).when(kind == 2, F.col("p_name")).when(kind == 3, F.concat(F.lit("### First Solution "), "p_name")).otherwise(F.concat(F.lit("Alternate Solution "), (F.col("p_size") + 1).cast("string")))
    return table(spark, d, "part").select(F.col("p_partkey").alias("k"), documents.solution_index(x).alias("n"))


@query("SELECT p_partkey AS k, CAST(v.n AS INTEGER) AS number, CASE v.n WHEN 1 THEN p_size::VARCHAR ELSE p_brand END AS answer FROM part, (VALUES (1), (2)) v(n) WHERE p_partkey % 2 = 0")
def answer_keys(spark: SparkSession, d: str) -> DataFrame:
    """Keys of answers behind a heading, up to the first longer line; every second part has none."""
    key = F.concat(F.lit("1. What\nAnswer Key\n1. "), F.col("p_size").cast("string"), F.lit("\n\n2. "), "p_brand", F.lit("\nand a longer line\n3. 7"))
    x = F.when(F.col("p_partkey") % 2 == 0, key).otherwise(F.concat("p_name", F.lit("\n1. 5")))
    found = table(spark, d, "part").select(F.col("p_partkey").alias("k"), documents.answer_key(x).alias("x"))
    return found.select("k", F.explode("x.answers").alias("e")).select("k", "e.*")


@query("""SELECT p_partkey AS k, CASE p_partkey % 4 WHEN 0 THEN '1. ' || p_name || chr(10) || '2. B' || chr(10) || '3. ' || p_brand || chr(10) || '4. d' WHEN 1 THEN '1. ' || p_name || chr(10) || '2. b' WHEN 2 THEN '1. ' || p_name || chr(10) || '2. b' ELSE '0. ' || p_brand || chr(10) || '1. ' || p_name END AS t FROM part""")
def repaired_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages with the problems that only a reading in slices found."""
    kind = F.col("p_partkey") % 4
    whole = F.concat(F.lit("1. "), "p_name", F.when(kind == 0, "\n2. b lost c\n4. d").when(kind == 3, "").otherwise("\n2. b"))
    sliced = F.when(kind == 0, F.concat(F.lit("1. A\n2. B\n3. "), "p_brand", F.lit("\n4. D"))).when(kind == 1, "1. x\n2. y").when(kind == 2, "1. x").otherwise(F.concat(F.lit("0. "), "p_brand", F.lit("\n1. a")))
    return table(spark, d, "part").select(F.col("p_partkey").alias("k"), documents.repaired_page(whole, sliced).alias("t"))


@query("""SELECT o_orderkey % 90 + 1 || CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN '_' || o_custkey ELSE '_solution_' || o_custkey || '_2' END || '.png' AS path, CAST(o_orderkey % 90 + 1 AS INTEGER) AS problem,
CAST(CASE WHEN o_orderkey % 3 = 2 THEN o_custkey END AS INTEGER) AS solution, CAST(CASE o_orderkey % 3 WHEN 0 THEN 1 WHEN 1 THEN o_custkey ELSE 2 END AS INTEGER) AS figure FROM orders""")
def crop_names(spark: SparkSession, d: str) -> DataFrame:
    """Names of figures say problem, solution and number; other files are none."""
    n, c, kind = (F.col("o_orderkey") % 90 + 1).cast("string"), F.col("o_custkey").cast("string"), F.col("o_orderkey") % 3
    name = F.concat(n, F.when(kind == 0, "").when(kind == 1, F.concat(F.lit("_"), c)).otherwise(F.concat(F.lit("_solution_"), c, F.lit("_2"))), F.lit(".png"))
    return documents.crops(table(spark, d, "orders").select(F.explode(F.array(name, F.concat(F.lit("cover"), c, F.lit(".png")))).alias("path")))
