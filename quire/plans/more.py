"""Further queries: sets, runs, edges of texts, references, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import answers, cleaners, text
from quire.operators import boxes, dedup, layout, sequence, sinks
from quire.plans.pages import EVENTS, event_pages, values
from quire.plans.registry import MARKS, dealt, marks, query, table
from quire.plans.spatial import DETS, pages, pics


@query(f"SELECT l_orderkey, i, coalesce(max(CASE WHEN raw % 2 = 0 THEN raw END) OVER (PARTITION BY l_orderkey ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) <= raw, true) AS last_of_all FROM ({MARKS}) m")
def nothing_later(spark: SparkSession, d: str) -> DataFrame:
    """Items after which no text of a later problem stands."""
    return sequence.nothing_above_later(marks(spark, d), ["l_orderkey"], "i", "raw", F.col("raw") % 2 == 0).select("l_orderkey", "i", "last_of_all")


@query(f"""WITH f AS (SELECT *, kind = 'click' AS flag FROM ({EVENTS}) e), p AS (SELECT *, sum(CASE WHEN flag THEN 0 ELSE 1 END) OVER (PARTITION BY doc ORDER BY page_no) AS part FROM f)
SELECT doc, page_no, flag AND sum(CASE WHEN flag THEN 1 ELSE 0 END) OVER (PARTITION BY doc, part) >= 2 AS in_run FROM p""")
def flag_runs(spark: SparkSession, d: str) -> DataFrame:
    """Rows in runs of two flagged ones or more."""
    rows = event_pages(spark, d).withColumn("flag", F.col("kind") == "click")
    return sequence.runs(rows, ["doc"], "page_no", "flag").select("doc", "page_no", "in_run")


@query("""WITH a AS (SELECT l_orderkey, list_sort(list(DISTINCT l_linenumber)) AS s FROM lineitem WHERE l_returnflag <> 'A' GROUP BY 1), b AS (SELECT l_orderkey, list_sort(list(DISTINCT l_linenumber)) AS s FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1)
SELECT coalesce(a.l_orderkey, b.l_orderkey) AS l_orderkey, array_to_string(list_sort(list_filter(coalesce(b.s, []), lambda x: NOT list_contains(coalesce(a.s, []), x))), ',') AS added, array_to_string(list_sort(list_filter(coalesce(a.s, []), lambda x: NOT list_contains(coalesce(b.s, []), x))), ',') AS gone, coalesce(a.s, []) = coalesce(b.s, []) AS same FROM a FULL JOIN b ON a.l_orderkey = b.l_orderkey""")
def set_gate(spark: SparkSession, d: str) -> DataFrame:
    """Numbers of two sources compared as sets."""
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    found = sequence.same_sets(rows.where("l_returnflag <> 'A'"), rows.where("l_linestatus = 'F'"), ["l_orderkey"], "l_linenumber")
    return found.select("l_orderkey", F.array_join("added", ",").alias("added"), F.array_join("gone", ",").alias("gone"), "same")


@query("SELECT source AS scope, norm, count(*) AS n FROM (SELECT substr(source, 1, 3) AS source, trim(regexp_replace(lower(coalesce(text, '')), '[^a-z0-9]+', ' ', 'g')) AS norm FROM documents WHERE doc_id % 2 = 0) q WHERE norm <> '' GROUP BY 1, 2 HAVING count(*) > 1")
def dedup_scopes(spark: SparkSession, d: str) -> DataFrame:
    """Equal forms within the scopes that test ids give; ids of series that do not compare are left out."""
    test = F.concat(F.substring("source", 1, 3), F.lit("_"), F.col("doc_id").cast("string"))
    scope = F.when(F.col("doc_id") % 2 == 0, dedup.scope_of(test, True)).otherwise(dedup.scope_of(test, False))
    rows = table(spark, d, "documents").select(scope.alias("scope"), F.col("doc_id").alias("id"), "text")
    return dedup.distinct_forms(rows).where("n > 1").select("scope", "norm", "n")


@query("SELECT p_partkey AS k, p_name || ' ￼ b ￼' AS t FROM part")
def image_placeholders(spark: SparkSession, d: str) -> DataFrame:
    x = F.concat(F.col("p_name"), F.lit(" <img>a <b>c</b></img> b <img src='x'/>"))
    return table(spark, d, "part").select(F.col("p_partkey").alias("k"), cleaners.placeholders(x).alias("t"))


@query("SELECT p_partkey AS k, CASE p_partkey % 3 WHEN 0 THEN p_name || chr(10) || 'a.png b.png' WHEN 1 THEN 'x a.png y b.png z' ELSE 'x a.png y b.png z  w' END AS t FROM part")
def figure_references(spark: SparkSession, d: str) -> DataFrame:
    """References in the places of placeholders; those over go behind, places over go."""
    hole, kind = text.FIGURE, F.col("p_partkey") % 3
    x = F.when(kind == 0, F.col("p_name")).when(kind == 1, f"x {hole} y {hole} z").otherwise(f"x {hole} y {hole} z {hole} w")
    refs = F.when(kind == 0, F.array(F.lit("a.png b.png"))).otherwise(F.array(F.lit("a.png"), F.lit("b.png")))
    return table(spark, d, "part").select(F.col("p_partkey").alias("k"), text.place_refs(x, refs).alias("t"))


@query("SELECT p_partkey AS k, trim(replace(p_name, ' ', '  ') || ' x') AS t, CASE p_partkey % 2 WHEN 0 THEN 'kept' ELSE 'kept' END AS s FROM part")
def line_cleaning(spark: SparkSession, d: str) -> DataFrame:
    """Answer blanks out of lines; everything from a heading on out of sections."""
    line = F.concat(F.replace("p_name", F.lit(" "), F.lit(" ____ ")), F.lit(" x____"))
    body = F.when(F.col("p_partkey") % 2 == 0, "kept\n## Remarks\nmore").otherwise("kept")
    return table(spark, d, "part").select(F.col("p_partkey").alias("k"), F.trim(F.regexp_replace(line, "_{2,}", "")).alias("t"), text.strip_tail(body, "## Remarks").alias("s"))


PROMPTS = "'Problem:' || chr(10) || p_name || CASE p_partkey % 2 WHEN 0 THEN ' [figure omitted]' ELSE '' END || chr(10) || chr(10)"


@query(f"SELECT p_partkey AS k, starts_with(p, {PROMPTS}) AS starts, p LIKE '%answer is: 7%' AS told FROM (SELECT p_partkey, p_name, {PROMPTS} || CASE WHEN p_partkey % 3 = 0 THEN 'answer is: 7' ELSE '' END AS p FROM part) q")
def solver_prompts(spark: SparkSession, d: str) -> DataFrame:
    """What a solver is asked: figures told as left out, known answers stated."""
    x = F.concat("p_name", F.when(F.col("p_partkey") % 2 == 0, " ![f](a.png)").otherwise(""))
    prompt = cleaners.solver_prompt(x, F.when(F.col("p_partkey") % 3 == 0, "7").otherwise(""))
    start = F.concat(F.lit("Problem:\n"), "p_name", F.when(F.col("p_partkey") % 2 == 0, " [figure omitted]").otherwise(""), F.lit("\n\n"))
    return table(spark, d, "part").select(F.col("p_partkey").alias("k"), F.startswith(prompt, start).alias("starts"), F.contains(prompt, F.lit("answer is: 7")).alias("told"))


@query(f"""WITH d AS ({DETS}), p AS (SELECT * FROM d WHERE label = 'Picture') SELECT page, det, x0 * 2 AS x0, y0 * 4 AS y0, x1 * 2 AS x1, y1 * 4 AS y1 FROM p""")
def scaled_boxes(spark: SparkSession, d: str) -> DataFrame:
    sizes = pages(spark, d).withColumns({"pdf_width": F.lit(100.0), "pdf_height": F.lit(40.0)})
    return boxes.scaled(pics(spark, d), sizes).select("page", "det", "x0", "y0", "x1", "y1")


@query("SELECT o_orderkey, CASE WHEN o_custkey % 3 = 0 THEN 'collision' WHEN o_custkey % 3 = 1 THEN 'skip' ELSE 'write' END AS action FROM orders")
def export_plan(spark: SparkSession, d: str) -> DataFrame:
    """What an export does with each source: collisions, unchanged targets, writes."""
    kind, k = F.col("o_custkey") % 3, F.col("o_orderkey").cast("string")
    base = table(spark, d, "orders").select("o_orderkey", kind.alias("kind"), k.alias("source"), k.alias("target"), k.alias("sha256"), F.lit("v1").alias("algorithm"))
    twin = base.where("kind = 0").withColumn("source", F.concat("source", F.lit("'")))
    done = base.where("kind = 1").select("target", "sha256", "algorithm").unionByName(base.where("kind = 2").select("target", "sha256", F.lit("v0").alias("algorithm")))
    plan = sinks.export_plan(base.drop("o_orderkey", "kind").unionByName(twin.drop("o_orderkey", "kind")), done)
    return plan.where("source NOT LIKE '%''%'").select(F.col("source").cast("long").alias("o_orderkey"), "action")


@query("SELECT conv_id, string_agg(turn || ':' || role, ';' ORDER BY turn) AS json FROM conversations GROUP BY conv_id")
def problem_json(spark: SparkSession, d: str) -> DataFrame:
    """Statements of a test as one JSON object, read back."""
    rows = table(spark, d, "conversations").select("conv_id", F.col("turn").cast("int").alias("turn"), "role")
    made = sinks.problem_maps(rows, "conv_id", "turn", "role")
    entry = F.transform(F.map_entries(F.from_json("json", "map<string,string>")), lambda x: F.concat(x["key"].cast("string"), F.lit(":"), x["value"]))
    return made.select("conv_id", F.array_join(entry, ";").alias("json"))


@query("SELECT p_partkey AS k, p_name || CASE WHEN p_partkey % 2 = 0 THEN '' ELSE '!' END AS t FROM part")
def noise_commands(spark: SparkSession, d: str) -> DataFrame:
    """Images with nested brackets and content-free commands leave no trace in normal forms."""
    x = F.concat(F.lit(r"![a [b] c](x(1)(2).png) \quad "), F.upper("p_name"), F.lit(r" \left <img src=x>"))
    same = F.when(text.normalize(x) == text.normalize(F.col("p_name")), F.col("p_name"))
    return table(spark, d, "part").select(F.col("p_partkey").alias("k"), F.concat(same, F.when(F.col("p_partkey") % 2 == 0, "").otherwise("!")).alias("t"))


@query("""SELECT o_orderkey AS page, d.det FROM orders, (VALUES (1), (2), (3), (4)) d(det)
WHERE NOT (d.det = 1 AND o_orderkey % 3 <> 0) AND NOT (d.det = 2 AND o_orderkey % 2 = 0)""")
def answer_boxes(spark: SparkSession, d: str) -> DataFrame:
    """Boxed answers go: on an answer row (two of three pages have one), or in a drawn frame around a word (every second page)."""
    k, o = F.col("o_orderkey"), dealt(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", 50_000)
    at = lambda names, *v: [F.lit(float(x)).alias(n) for n, x in zip(names, v)]
    edges = ["x0", "y0", "x1", "y1"]
    word = lambda block, x, *v: F.struct(F.lit(block).alias("block"), x.alias("word"), *at(edges, *v))
    words = o.select(k.alias("page"), F.explode(F.array(word(1, F.when(k % 3 != 0, "Answer:").otherwise("Other:"), 10, 10, 30, 20), word(1, k.cast("string"), 35, 11, 45, 19), word(3, k.cast("string"), 62, 62, 66, 68))).alias("w")).select("page", "w.*")
    ends = ["ax", "ay", "bx", "by"]
    frame = [F.struct(*at(ends, *v)) for v in [(60, 60, 70, 60), (60, 70, 70, 70), (60, 60, 60, 70), (70, 60, 70, 70)]]
    lines = o.where("o_orderkey % 2 = 0").select(k.alias("page"), F.explode(F.array(*frame)).alias("l")).select("page", "l.*")
    box = lambda i, *v: F.struct(F.lit(i).alias("det"), *at(edges, *v))
    found = o.select(k.alias("page"), F.explode(F.array(box(1, 34, 10, 46, 20), box(2, 59, 59, 71, 71), box(3, 0, 0, 95, 20), box(4, 80, 80, 90, 99))).alias("b")).select("page", "b.*")
    size = o.select(k.alias("page"), *at(["width", "height", "pdf_width", "pdf_height"], 100, 150, 100, 150))
    return boxes.without_answer_boxes(found, words, lines, size).select("page", "det")


@query("""SELECT p_partkey AS k, CASE p_partkey % 4 WHEN 0 THEN p_name || ' <img></img>' || chr(10) || chr(10) || '5. x' WHEN 1 THEN p_name || ' <img></img>' WHEN 2 THEN '<img></img></td>' || p_name ELSE '<img>' || p_name || '</img> y' END AS t FROM part""")
def closed_images(spark: SparkSession, d: str) -> DataFrame:
    """Images that were never closed."""
    forms = ["{t} <img> d\n\n5. x", "{t} <img> d", "<img>x</td>{t}", "<img>{t}</img> y"]
    form = F.element_at(F.array(*map(F.lit, forms)), (F.col("p_partkey") % 4).cast("int") + 1)
    rows = table(spark, d, "part").select(F.col("p_partkey").alias("k"), F.replace(form, F.lit("{t}"), F.col("p_name")).alias("t"))
    return rows.select("k", layout.closed_images(F.col("t")).alias("t"))


@query("""WITH n AS (SELECT l_orderkey, l_linenumber AS n, max(l_linenumber) OVER (PARTITION BY l_orderkey) AS most FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) q),
h AS (SELECT l_orderkey, n, most, n % 3 = 2 AND n < most AS lost FROM n)
SELECT l_orderkey, string_agg(CASE WHEN lost AND NOT EXISTS (SELECT 1 FROM h b WHERE b.l_orderkey = h.l_orderkey AND b.n = h.n - 1) THEN 'null' WHEN lost AND NOT EXISTS (SELECT 1 FROM h a WHERE a.l_orderkey = h.l_orderkey AND a.n = h.n + 1 AND NOT a.lost) THEN 'null' ELSE n::VARCHAR END, ',' ORDER BY n) AS numbers FROM h GROUP BY 1""")
def key_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Cells of keys, made of the line numbers of orders: every third number was not read, and its neighbours may prove it."""
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber").distinct().groupBy("l_orderkey").agg(F.array_sort(F.collect_list("l_linenumber")).alias("n"))
    read = F.transform("n", lambda x: F.when((x % 3 == 2) & (x < F.array_max("n")), F.lit(None)).otherwise(x).cast("int"))
    filled = rows.select("l_orderkey", answers.filled_gaps(read).alias("n"))
    return filled.select("l_orderkey", F.array_join(F.transform("n", lambda x: F.coalesce(x.cast("string"), F.lit("null"))), ",").alias("numbers"))
