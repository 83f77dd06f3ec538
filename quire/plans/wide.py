"""Queries over crosswords, page expectations, relays, headerless solutions, cascades of all series and the joined job."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire import jobs
from quire.functions import answers, cleaners
from quire.functions.series import Layout
from quire.operators import crosswords, dedup, documents, expectations, layout, sequence, sinks
from quire.plans.pages import FLAT, TURNS, turns
from quire.plans.registry import query, table
from quire.sources import commits, files

# One turn a page: headings, bare clues under them and clues that name their direction, by turns.
CLUE_PAGE = {0: "PUMaC 2012\\n## 2.1 Across\\n{n}. {t}", 1: "**{n}.** {t}\\nPage 1 of 9", 2: "Down and to the left\\nsome prose", 3: "{n}) {t}", 4: "{n} Down: {t}"}


@query(f"""WITH RECURSIVE t AS (SELECT conv_id, i, i % 5 AS kind, i % 90 + 1 AS n, {FLAT} AS t, conv_id % 2 = 0 AS bare FROM ({TURNS}) q),
s AS (SELECT conv_id, i, kind, n, t, bare, CASE kind WHEN 0 THEN 'across' WHEN 2 THEN 'down_left' END AS now FROM t WHERE i = 1
  UNION ALL SELECT t.conv_id, t.i, t.kind, t.n, t.t, t.bare, CASE t.kind WHEN 0 THEN 'across' WHEN 2 THEN 'down_left' ELSE s.now END FROM s JOIN t ON t.conv_id = s.conv_id AND t.i = s.i + 1),
c AS (SELECT *, CASE WHEN kind = 4 THEN 'down' WHEN kind <> 2 AND bare THEN now END AS dir FROM s)
SELECT conv_id, i, CASE WHEN kind = 2 THEN (CASE WHEN bare THEN '## Down-left' ELSE 'Down and to the left' END) || chr(10) || 'some prose' ELSE
  CASE WHEN kind = 0 THEN (CASE WHEN bare THEN '## Across' ELSE '## 2.1 Across' END) || chr(10) ELSE '' END
  || CASE WHEN dir IS NULL THEN CASE kind WHEN 1 THEN '**' || n || '.** ' WHEN 3 THEN n || ') ' ELSE n || '. ' END
     ELSE (n + CASE dir WHEN 'across' THEN 1000 ELSE 2000 END) || '. [' || n || ' ' || CASE dir WHEN 'across' THEN 'Across' WHEN 'down' THEN 'Down' ELSE 'Down-left' END || '] ' END || t END AS text FROM c""")
def crossword_pages(spark: SparkSession, d: str) -> DataFrame:
    """Clues by the direction that pages carry on: every second conversation numbers its clues under headings."""
    rows = turns(spark, d).withColumns({"n": (F.col("i") % 90 + 1).cast("string"), "kind": F.col("i") % 5})
    page = F.lit("")
    for kind, form in CLUE_PAGE.items():
        page = F.when(F.col("kind") == kind, F.replace(F.replace(F.lit(form.replace("\\n", "\n")), F.lit("{n}"), F.col("n")), F.lit("{t}"), F.col("text"))).otherwise(page)
    found = crosswords.clue_pages(rows.select("conv_id", "i", page.alias("text")), ["conv_id"], "i", "text", F.col("conv_id") % 2 == 0)
    return found.select("conv_id", "i", "text")


KINDS = [("pumac", "statement"), ("pumac", "solution"), ("farml", "statement"), ("hmmt", "statement"), ("hmmt", "solution"), ("cmimc", "statement"), ("mathcounts", "statement"), ("usamts", "statement")]
ROLE = "CASE o_orderkey % 8 " + " ".join(f"WHEN {i} THEN '{s}:{r}'" for i, (s, r) in enumerate(KINDS)) + " END"


@query(f"""WITH l AS (SELECT l_orderkey, array_agg(DISTINCT l_linenumber) AS want, coalesce(array_agg(DISTINCT l_linenumber) FILTER (l_partkey % 7 <> 0), []) AS have, sum(length(' said ')::INT + 1) AS x FROM lineitem GROUP BY 1),
o AS (SELECT o_orderkey, {ROLE} AS kind, want, have, o_custkey % 4 AS cut, list_sort(list_filter(want, lambda x: NOT list_contains(have, x))) AS gone, CASE WHEN o_custkey % 4 = 0 THEN 1 ELSE 0 END AS poor FROM orders JOIN l ON l_orderkey = o_orderkey)
SELECT o_orderkey, kind, array_to_string(list_filter([
 CASE WHEN kind IN ('pumac:statement', 'pumac:solution', 'farml:statement') AND len(gone) > 0 THEN 'numbers' END,
 CASE WHEN kind IN ('hmmt:statement', 'cmimc:statement') AND len(have) < len(want) THEN 'count' END,
 CASE WHEN kind = 'pumac:solution' AND poor = 1 THEN 'labels' END,
 CASE WHEN kind = 'hmmt:solution' AND poor = 1 THEN 'share' END,
 CASE WHEN kind = 'mathcounts:statement' AND len(have) = 1 THEN 'batch' END], lambda x: x IS NOT NULL), ',') AS broken FROM o""")
def page_expectations(spark: SparkSession, d: str) -> DataFrame:
    """Pages of orders whose line items are the problems: each seventh part was not read, of every fourth customer most text and the last label are missing."""
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("page_key"), F.col("l_linenumber").alias("problem"), "l_partkey")
    held = lines.groupBy("page_key").agg(F.array_join(F.transform(F.array_sort(F.collect_set("problem")), lambda n: F.concat(n.cast("string"), F.lit(". said"))), "\n").alias("numbers"))
    kind = F.element_at(F.array(*[F.struct(F.lit(s).alias("s"), F.lit(r).alias("r")) for s, r in KINDS]), (F.col("o_orderkey") % 8).cast("int") + 1)
    poor = F.col("o_custkey") % 4 == 0
    pages = table(spark, d, "orders").join(held, F.col("o_orderkey") == F.col("page_key")).withColumn("k", kind)
    words = F.repeat(F.lit("words and more words of a page "), F.lit(60))
    layer = F.concat("numbers", F.lit("\nSolution: x\nSolution: y\n"), words)
    read = F.when(poor, F.lit("Solution: x")).otherwise(F.concat(F.lit("Solution: x\nAnswer: y\n"), words))
    pages = pages.select("page_key", F.col("k.s").alias("series"), F.col("k.r").alias("role"), read.alias("text"), layer.alias("layer"))
    found = expectations.judged(pages, lines.where("l_partkey % 7 <> 0"))
    return found.select(F.col("page_key").alias("o_orderkey"), F.concat_ws(":", "series", "role").alias("kind"), F.array_join("broken", ",").alias("broken"))


@query("""WITH b AS (SELECT l_orderkey, l_partkey % 10 + 1 AS pair, l_linenumber % 2 + 1 AS leg, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS pos FROM lineitem)
SELECT l_orderkey, CAST(pair + CASE WHEN (pair <= 5) = (leg = 1) THEN 0 ELSE 10 END AS INTEGER) AS problem, string_agg('body ' || pos, chr(10) ORDER BY pos) AS text FROM b GROUP BY 1, 2""")
def relay_groups(spark: SparkSession, d: str) -> DataFrame:
    """Orders as relay papers, whose line items are blocks under the labels of pairs and legs."""
    pos = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))
    rows = table(spark, d, "lineitem").withColumn("pos", pos.cast("long"))
    label = F.concat(F.when(F.col("pos") % 2 == 0, "**").otherwise("  "), (F.col("l_partkey") % 10 + 1).cast("string"), F.lit("-"), (F.col("l_linenumber") % 2 + 1).cast("string"), F.lit(". body "), F.col("pos").cast("string"))
    docs = sequence.joined(rows.withColumn("line", label), ["l_orderkey"], "pos", "line", "text")
    return documents.relay_blocks(docs.withColumn("text", F.concat(F.lit("Relay round\n"), "text")), ["l_orderkey"])


@query(f"""WITH t AS (SELECT conv_id, i, {FLAT} AS t, count(*) OVER (PARTITION BY conv_id) AS n FROM ({TURNS}) q),
k AS (SELECT *, CASE WHEN i > 1 AND i % 4 = 2 THEN 'This problem came from ' || t WHEN i > 1 AND i % 4 = 3 THEN 'We thank ' || t ELSE t END AS p, i > 1 AND i % 4 IN (2, 3) AS told FROM t),
f AS (SELECT *, min(CASE WHEN i > 1 AND NOT told THEN i END) OVER (PARTITION BY conv_id) AS start FROM k)
SELECT conv_id, coalesce(string_agg(CASE WHEN n = 1 OR i >= start THEN p END, chr(10) || chr(10) ORDER BY i), '') AS text FROM f GROUP BY conv_id""")
def headerless_solutions(spark: SparkSession, d: str) -> DataFrame:
    """Conversations as blocks of paragraphs: the first is the statement, then come some on where it is from."""
    told = F.when((F.col("i") > 1) & (F.col("i") % 4 == 2), F.concat(F.lit("This problem came from "), "text")).when((F.col("i") > 1) & (F.col("i") % 4 == 3), F.concat(F.lit("We thank "), "text")).otherwise(F.col("text"))
    docs = sequence.joined(turns(spark, d).withColumn("line", F.concat(told, F.lit("\n"))), ["conv_id"], "i", "line", "text")
    return docs.select("conv_id", documents.headerless_solution(F.col("text")).alias("text"))


# By series: blocks by turns ({k} is the order's key), and how SQL reads the tiers of the series off them.
BLOCKS = {
    "pumac": ["**Answer:** ${k}$.\nwork", "x\n[Answer] {k}", "x (ANS: {k} CB: A. B.)", "so there are [{k}] ways", "\\boxed{3} then \\boxed{{k}}. Also accepted", "Solution. {k}. We see", "Solution. We see"],
    "hmmt": ["Answer: ${k}$ since it is so", "Answer:\n{k}\nSolution: x", "Solution: ${k}$", "we get \\boxed{{k}}", "{k}", "What is {k}?", "Answer: 5 and a proof of {k}"],
    "smt": ["Find it. Answer: {k} Solution: do", "so \\boxed{{k}}", "nothing {k}"],
    "bmt": ["Answer: N/A", "**Answer:** {k}/7", "so {k}"],
    "omo": ["Answer.\n\n{k}.\nProposed by X", "Hence the answer is {k}.5.", "Answer. ☐", "x \\boxed{{k}} y"],
    "mpfg": ["Problem 3 x Answer: **{k}/25**\nMath Solution: y", "no label {k}"],
    "chmm": ["a\nour total sum is ${k}$.", "Solution 1: {k}", "Answers are {k}", "it takes {k} moves.", "the maximum value of x = {k}."],
    "cmimc": ["Answer. $11 - 1 = \\boxed{{k}}$", "so the answer is ${k}$. Then", "x \\boxed{{k}}", "Answer:\nSolution: x \\boxed{{k}}"],
}
LABEL = r"regexp_extract(b, '(?:Answer|ANSWER)[*]*[:.][*]*\s+\**\$?([0-9]+(?:/[0-9]+)?)', 1)"
BOX = r"regexp_extract(b, '.*boxed\{([0-9]+)\}', 1)"
SAID = r"regexp_extract(b, 'nswers? (?:is|are) \$?([0-9]+(?:\.[0-9]+)?)', 1)"
READ = {
    "pumac": [("label", LABEL), ("row", r"regexp_extract(b, '\[Answer\] ([0-9]+)', 1)"), ("tag", r"regexp_extract(b, 'ANS: ([0-9]+)', 1)"), ("bracket", r"regexp_extract(b, 'are \[([0-9]+)\]', 1)"), ("box", f"CASE WHEN contains(b, 'Also accepted') THEN CASE WHEN {BOX} = '3' THEN '3' ELSE '3, ' || {BOX} END ELSE {BOX} END"), ("opening", r"regexp_extract(b, 'Solution\. ([0-9]+)', 1)")],
    "hmmt": [("label", f"CASE WHEN contains(b, 'a proof of') THEN '' WHEN contains(b, 'Answer:' || chr(10)) THEN regexp_extract(b, 'Answer:\\n([0-9]+)', 1) ELSE {LABEL} END"), ("solution", r"regexp_extract(b, '^Solution: \$([0-9]+)', 1)"), ("box", BOX), ("bare", r"regexp_extract(b, '^([0-9]+)$', 1)")],
    "smt": [("label", LABEL), ("box", BOX)],
    "bmt": [("label", LABEL)],
    "omo": [("label", r"regexp_extract(b, 'Answer\.\n\n([0-9]+)\.', 1)"), ("prose", r"regexp_extract(b, 'answer is ([0-9]+\.5)', 1)"), ("box", BOX)],
    "mpfg": [("label", LABEL)],
    "chmm": [("prose", SAID), ("tail", r"coalesce(nullif(regexp_extract(b, 'total sum is \$?([0-9]+)', 1), ''), nullif(regexp_extract(b, 'value of x = ([0-9]+)', 1), ''), nullif(regexp_extract(b, '([0-9]+) moves', 1), ''), '')"), ("solution", r"regexp_extract(b, 'Solution 1: ([0-9]+)', 1)")],
    "cmimc": [("label", r"CASE WHEN contains(b, 'Answer.') THEN regexp_extract(b, 'boxed\{([0-9]+)\}', 1) ELSE '' END"), ("prose", SAID), ("box", f"CASE WHEN contains(b, 'Answer:') THEN '' ELSE {BOX} END")],
}


def _block(series: str) -> Column:
    forms = BLOCKS[series]
    form = F.element_at(F.array(*[F.lit(x) for x in forms]), (F.col("o_orderkey") % len(forms)).cast("int") + 1)
    return F.replace(form, F.lit("{k}"), F.col("o_orderkey").cast("string"))


def _cascade_sql() -> str:
    out = []
    for series, forms in BLOCKS.items():
        cases = " ".join("WHEN {} THEN '{}'".format(i, x.replace("'", "''")) for i, x in enumerate(forms))
        tiers = " ".join(f"WHEN coalesce({sql}, '') <> '' THEN {{{{'a': {sql}, 't': '{tier}'}}}}".replace("{{", "{").replace("}}", "}") for tier, sql in READ[series])
        out.append(f"SELECT '{series}' AS series, o_orderkey, CASE {tiers} END AS r FROM (SELECT o_orderkey, replace(CASE o_orderkey % {len(forms)} {cases} END, '{{k}}', o_orderkey::VARCHAR) AS b FROM orders) x")
    return "SELECT series, o_orderkey, r.a AS answer, r.t AS tier FROM (" + " UNION ALL ".join(out) + ") u"


@query(_cascade_sql())
def answer_cases(spark: SparkSession, d: str) -> DataFrame:
    """Answers and tiers of eight series' cascades, over blocks written for the orders."""
    out = None
    for series in BLOCKS:
        rows = table(spark, d, "orders").select("o_orderkey", answers.answer(series)(_block(series)).alias("a")).select(F.lit(series).alias("series"), "o_orderkey", "a.answer", "a.tier")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("""SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN o_custkey::VARCHAR WHEN 1 THEN o_orderkey::VARCHAR WHEN 2 THEN o_orderkey::VARCHAR || o_custkey::VARCHAR WHEN 3 THEN (o_custkey + 1)::VARCHAR END AS answer FROM orders""")
def derived_answers(spark: SparkSession, d: str) -> DataFrame:
    """Answers worked out of solutions that print none."""
    k, c = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    block = _fifth(F.concat(F.lit("Thus x is "), k, F.lit(". Then 3 = "), c), F.concat(F.lit("= 7 and therefore it is "), k), F.concat(F.lit("(a, b) = ("), k, F.lit(", "), c, F.lit(")")), F.concat(F.lit("we get "), (F.col("o_custkey") + 1).cast("string"), F.lit(" = 11")), F.concat(F.lit(r"then n \neq "), k))
    said = F.when(F.col("o_orderkey") % 5 == 2, "Concatenate the numbers").otherwise("Find it")
    return table(spark, d, "orders").select("o_orderkey", answers.derived_answer(said, block).alias("answer"))


@query("""SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN o_orderkey::VARCHAR || o_custkey::VARCHAR WHEN 1 THEN o_custkey::VARCHAR WHEN 3 THEN o_custkey::VARCHAR WHEN 4 THEN o_orderkey::VARCHAR END AS answer FROM orders""")
def fitted_answers(spark: SparkSession, d: str) -> DataFrame:
    """Answers brought into the form that their statements ask for."""
    k, c = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    value = _fifth(F.concat(F.lit("$("), k, F.lit(", "), c, F.lit(")$")), F.concat(F.lit("a = b = "), c), F.lit("no solution"), F.concat(F.lit("$"), c, F.lit("$.")), F.concat(F.lit(r"so \boxed{"), k, F.lit("}")))
    asked = _fifth(*[F.lit(x) for x in ("concatenate them", "Find the value", "Find x", "", "")])
    return table(spark, d, "orders").select("o_orderkey", answers.fitted_answer(value, asked, F.lit("")).alias("answer"))


def _fifth(*forms: Column) -> Column:
    """One of five forms, by the order's key."""
    return F.element_at(F.array(*forms), (F.col("o_orderkey") % 5).cast("int") + 1)


# name: (options of the layout, series of the markers, problem carried on, page, items expected); {k} is the order's key
LAYOUT_PAGES: dict[str, tuple[dict, str, int | None, str, list[tuple[str, int | None, str]]]] = {
    "plain": ({}, "default", None, "head\n1. one\nmore <img>fig</img> tail\n2. two n{k}", [("text", None, "head"), ("text", 1, "one\nmore"), ("image", 1, "fig"), ("text", 1, "tail"), ("text", 2, "two n{k}")]),
    "restart_at_one": ({}, "default", None, "1. a\n2. b\n1. c n{k}", [("text", 1, "a"), ("text", 2, "b"), ("text", 3, "c n{k}")]),
    "strict_needs_heading": ({"numbering": {"strict": True}}, "default", None, "1. a\n2. b\n1. c\n# Round\n1. d n{k}", [("text", 1, "a"), ("text", 2, "b\n1. c\n# Round"), ("text", 3, "d n{k}")]),
    "flat": ({"numbering": {"flat": True}}, "default", None, "1. a\n# Part\n1. b\n2. c n{k}", [("text", 1, "a\n# Part\n1. b"), ("text", 2, "c n{k}")]),
    "consecutive": ({"numbering": {"consecutive": True}}, "default", None, "1. a\n7. b\n2. c n{k}", [("text", 1, "a\n7. b"), ("text", 2, "c n{k}")]),
    "backward": ({"numbering": {"backward": True}}, "default", None, "4. a\n2. b\n5. c n{k}", [("text", 4, "a"), ("text", 2, "b"), ("text", 5, "c n{k}")]),
    "carried": ({}, "default", 6, "rest of six\n7. seven n{k}", [("text", 6, "rest of six"), ("text", 7, "seven n{k}")]),
    "carried_restart": ({}, "default", 6, "3. three n{k}", [("text", 9, "three n{k}")]),
    "points": ({"numbering": {"point_values": True}}, "default", None, "1. [3] a\n2. list\n2. [4] b n{k}", [("text", 1, "[3] a\n2. list"), ("text", 2, "[4] b n{k}")]),
    "points_in_bold": ({}, "default", None, "27. **[13]** statement n{k}", [("text", 27, "[13] statement n{k}")]),
    "page_restart": ({"numbering": {"strict": True, "page_restart": True}}, "default", 10, "1. [5] a\n2. [6] b n{k}", [("text", 11, "[5] a"), ("text", 12, "[6] b n{k}")]),
    "page_restart_not_first": ({"numbering": {"strict": True, "page_restart": True}}, "default", 10, "tail\n1. [5] a n{k}", [("text", 10, "tail\n1. [5] a n{k}")]),
    "list_items": ({"list_items": True}, "default", None, "<ol><li>first n{k}</li>\n<li>second<br>line</li></ol>", [("text", 1, "first n{k}"), ("text", 2, "second line")]),
    "point_items": ({"point_items": True}, "default", None, "<li>[7] statement</li>\n<li>\n[8] other n{k}</li>\n<li>plain</li>", [("text", 1, "[7] statement"), ("text", 2, "[8] other n{k}\nplain")]),
    "titles": ({"titles": True}, "default", None, "# Balance\n1. do this\n2. or that n{k}\n# Solutions\n# Two\n2. y", [("text", 1, "# Balance\ndo this\n2. or that n{k}\n# Solutions"), ("text", 2, "# Two\ny")]),
    "column_of_blanks": ({}, "default", None, "1. ____ dollars\n2. ____ cm\n3. What\n4. ____\nWho n{k}", [("text", 3, "What"), ("text", 4, "Who n{k}")]),
    "repeated_blank": ({}, "default", None, "4. a\n4. ____\n5. b n{k}", [("text", 4, "a"), ("text", 5, "b n{k}")]),
    "points_alone": ({}, "default", None, "1. a\n(5)\n①\nb ____ c n{k}", [("text", 1, "a\nb  c n{k}")]),
    "glued_word": ({}, "default", None, "1. a $$x$$ **Problem 2** The $$y$$ 3. Now n{k}", [("text", 1, "a $$x$$"), ("text", 2, "The $$y$$ 3. Now n{k}")]),
    "glued_bare": ({"glued_bare": True}, "default", None, "1. a $$x$$ 2. The b n{k}", [("text", 1, "a $$x$$"), ("text", 2, "The b n{k}")]),
    "image_as_statement": ({}, "default", None, "5. <img>5. A drawn n{k} one</img>", [("text", 5, "A drawn n{k} one"), ("image", 5, "5. A drawn n{k} one")]),
    "furniture": ({}, "default", None, "<watermark>x</watermark>1. a n{k}<page_number>3</page_number>", [("text", 1, "a n{k}")]),
    "table_kept": ({}, "default", None, "1. a\n<table>\n<tr><td>2. x</td></tr></table>\nb n{k}", [("text", 1, "a\n<table> <tr><td>2. x</td></tr></table>\nb n{k}")]),
    "table_rows": ({"table_rows": True}, "default", None, "<table><tr><td>1. ____</td><td>What n{k}?</td></tr><tr><td>2. ____ cm</td><td>How<br>long</td></tr><tr><td>a</td><td>b</td></tr><tr><td>①</td></tr></table>", [("text", 1, "What n{k}?"), ("text", 2, "How\nlong\n<table><tr><td>a</td><td>b</td></tr></table>")]),
    "table_of_data": ({"table_rows": True, "numbering": {"consecutive": True, "strict": True}}, "default", None, "1. a\n<table><tr><td>9. x</td><td>y n{k}</td></tr></table>", [("text", 1, "a\n<table><tr><td>9. x</td><td>y n{k}</td></tr></table>")]),
    "table_lists": ({"table_rows": True}, "default", None, "<table><tr><td><ol><li>What</li><li>Who n{k}</li></ol></td><td><ol><li>____</li><li>___</li></ol></td></tr></table>", [("text", 1, "What"), ("text", 2, "Who n{k}")]),
    "table_packed": ({"table_rows": True}, "default", None, "<table><tr><td>1. What is 3? 2. Who n{k}? 12. no</td><td>1. ____<br>2. ____</td></tr></table>", [("text", 1, "What is 3?"), ("text", 2, "Who n{k}? 12. no")]),
    "table_image": ({"table_rows": True}, "default", None, "<table><tr><td>3. ____</td><td><img>Find n{k} <b>x</b></img></td></tr></table>", [("text", 3, "Find n{k} x")]),
    "relay": ({}, "cmimc", None, "1-1. a\n6-2. b\n7-1. c n{k}", [("text", 1, "a"), ("text", 6, "b"), ("text", 17, "c n{k}")]),
    "instructions": ({}, "cmimc", None, "1. Do not look\n2. Find n{k} x", [("text", None, "1. Do not look"), ("text", 2, "Find n{k} x")]),
    "appendix": ({"numbering": {"backward": True}}, "farml_solutions", None, "T8 a\nT9 b\nAppendix to T8 c n{k}", [("text", 8, "a"), ("text", 9, "b"), ("text", 8, "c n{k}")]),
    "crossword": ({}, "pumac", None, "12 Across x\n7 Down y n{k}", [("text", 1012, "Across x"), ("text", 2007, "Down y n{k}")]),
    "byline": ({}, "nimo", None, "1. *(Ann Lee)* x\n2. (n = 2) y n{k}", [("text", 1, "(Ann Lee)* x\n2. (n = 2) y n{k}")]),
}


def _layout_sql() -> str:
    said = lambda x: "'" + x.replace("'", "''") + "'"
    rows = [(i, said("page_" + name), at, said(kind), "NULL" if problem is None else problem, said(text)) for i, (name, case) in enumerate(LAYOUT_PAGES.items()) for at, (kind, problem, text) in enumerate(case[4])]
    values = ", ".join("({})".format(", ".join(map(str, r))) for r in rows)
    return f"SELECT s.options, o_orderkey AS l_orderkey, CAST(s.item_no AS INTEGER) AS item_no, s.kind, CAST(s.problem AS BIGINT) AS problem, replace(s.text, '{{k}}', o_orderkey::VARCHAR) AS text FROM orders JOIN (VALUES {values}) s(form, options, item_no, kind, problem, text) ON o_orderkey % {len(LAYOUT_PAGES)} = s.form"


LINES = "SELECT l_orderkey, l_linenumber AS pos, min(l_partkey) % 8 + 1 AS n FROM lineitem GROUP BY 1, 2"


@query(f"""WITH l AS ({LINES}), m AS (SELECT *, max(n) OVER (PARTITION BY l_orderkey ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top, lag(n) OVER (PARTITION BY l_orderkey ORDER BY pos) AS before FROM l),
k AS (SELECT 'flat' AS options, l_orderkey, pos, n, top IS NULL OR n > top AS opens FROM m UNION ALL SELECT 'backward', l_orderkey, pos, n, before IS NULL OR n <> before FROM m),
g AS (SELECT *, sum(opens::INT) OVER (PARTITION BY options, l_orderkey ORDER BY pos) - 1 AS item FROM k)
SELECT options, l_orderkey, CAST(item AS INTEGER) AS item_no, 'text' AS kind, CAST(min(n) FILTER (opens) AS BIGINT) AS problem, string_agg(CASE WHEN opens THEN '' ELSE n || '. ' END || 'said ' || pos, chr(10) ORDER BY pos) AS text FROM g GROUP BY 1, 2, 3
UNION ALL {_layout_sql()}""")
def layout_cases(spark: SparkSession, d: str) -> DataFrame:
    """Orders as pages whose line items bear numbers in any order: which open problems if pages are flat, or may turn back;
    and orders as pages of LAYOUT_PAGES by turns: every rule by which markers, lists, titles, tables and images become items."""
    lines = table(spark, d, "lineitem").groupBy("l_orderkey", F.col("l_linenumber").alias("pos")).agg((F.min("l_partkey") % 8 + 1).alias("n"))
    lines = lines.withColumn("line", F.concat(F.col("n").cast("string"), F.lit(". said "), F.col("pos").cast("string")))
    docs, out = sequence.joined(lines, ["l_orderkey"], "pos", "line", "text"), None
    for name, options in (("flat", {"flat": True}), ("backward", {"flat": True, "backward": True})):
        found = layout.items(docs, "l_orderkey", "text", layout=Layout(options)).select(F.lit(name).alias("options"), "l_orderkey", "item_no", "kind", "problem", "text")
        out = found if out is None else out.unionByName(found)
    # pages that are read alike in one run
    alike: dict[str, list[int]] = {}
    for i, (options, rules, first, _, _) in enumerate(LAYOUT_PAGES.values()):
        alike.setdefault(repr((options, rules, first)), []).append(i)
    form, cases = (F.col("o_orderkey") % len(LAYOUT_PAGES)).cast("int"), list(LAYOUT_PAGES.values())
    one = lambda values: F.element_at(F.array(*map(F.lit, values)), form + 1)
    for forms in alike.values():
        options, rules, first = cases[forms[0]][:3]
        key = F.struct("o_orderkey", one([f"page_{x}" for x in LAYOUT_PAGES]).alias("options")).alias("key")
        pages = table(spark, d, "orders").where(form.isin(forms)).select(key, F.replace(one([x[3] for x in cases]), F.lit("{k}"), F.col("o_orderkey").cast("string")).alias("text"))
        found = layout.items(pages, "key", "text", rules, Layout(**options), first)
        out = out.unionByName(found.select("key.options", F.col("key.o_orderkey").alias("l_orderkey"), "item_no", "kind", "problem", "text"))
    return out


COVERS = {
    "mathcounts": "DO NOT BEGIN  until you\nare instructed to", "mpfg": "Do not open this test now", "omo": "Acknowledgements\nthanks to", "farml": "\n\nAnswer Key\nof", "hmmt": "Answer Sheet\nname", "cmimc": "Do not look at the test before the proctor says so",
}


@query("SELECT o_orderkey, s AS series, o_custkey % 3 = 0 AS skipped FROM orders, (SELECT unnest(" + str(list(COVERS)) + ") AS s) x")
def page_skips(spark: SparkSession, d: str) -> DataFrame:
    """Pages of orders: every third customer's is a cover of its series."""
    out = None
    for series, cover in COVERS.items():
        page = F.when(F.col("o_custkey") % 3 == 0, F.concat(F.lit(cover + " "), "o_orderpriority")).otherwise(F.concat(F.lit("1. What is the sum of the numbers from one to "), F.col("o_orderkey").cast("string"), F.lit("?")))
        rows = table(spark, d, "orders").select("o_orderkey", F.lit(series).alias("series"), cleaners.skip_page(series, page).alias("skipped"))
        out = rows if out is None else out.unionByName(rows)
    return out


# By series: what stands before and behind the text, and what is left of it.
DRESS = {
    "usamts": ("<img>USAMTS</img>{t}\n*****\nrest", "{t}"), "mandelbrot": ("{t}\n© Proof School 2018\naddress", "{t}"), "hmmt": ("```html\n<div>1. <b>{t}</b></div>\n```\n© 2019 HMMT\n\n\n\n2. y  ", "1. {t}\n\n2. y"),
    "cmimc": ("## CMIMC 2019\n<h2>Team</h2>\n1. {t}", "Team\n\n1. {t}"), "mathcounts": ("| 1. ____ | {t} |\n| a | b |", "1. {t}\n| a | b |"), "chmm": ("3.\n4. {t}", "3. [No statement was printed in the source.]\n4. {t}"),
    "smt": ("<img>the SMT logo</img>\nSMT 2019 Algebra\n1. {t}\nPage 3\n17", "1. {t}"), "mpfg": ("Math Prize for Girls 2015\n1. {t}\nAdvantage Testing Foundation\nOlympiad 2015 Solutions", "1. {t}"),
    "omo": ("Spring 2018\n**OMO 2018**\n1. {t}\npage 3", "1. {t}"), "nimo": ("The NIMO Compendium\n1. {t}\nMay 2014\n17", "1. {t}"), "farml": ("FARML 2014\n**TEAM EVENT**\nT1 {t}\n(figures)", "T1 {t}"), "bmt": ("BMT 2019 Algebra\nTeam Round Solutions\n1. {t}", "1. {t}"),
}


@query("SELECT p_partkey, s.series, replace(s.want, '{t}', p_name) AS text FROM part, (SELECT * FROM (VALUES " + ", ".join("('{}', '{}')".format(k, v[1]) for k, v in DRESS.items()) + ") v(series, want)) s")
def page_cleaners(spark: SparkSession, d: str) -> DataFrame:
    """Names of parts within what each series prints around its pages."""
    out = None
    for series, (page, _) in DRESS.items():
        rows = table(spark, d, "part").select("p_partkey", F.lit(series).alias("series"), cleaners.clean_page(series, F.replace(F.lit(page), F.lit("{t}"), F.col("p_name"))).alias("text"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query(f"SELECT CAST(conv_id AS VARCHAR) AS test_id, i AS problem, {FLAT} || CASE WHEN i % 2 = 0 THEN chr(10) || 'problem_' || i || '_image_1.png' ELSE '' END AS text, CAST(CASE WHEN i % 2 = 0 THEN 1 ELSE 0 END AS BIGINT) AS figures FROM ({TURNS}) t")
def job_figures(spark: SparkSession, d: str) -> DataFrame:
    """Pages of two turns to statements with figures.  The first attempt at every third page loses a problem, at others of
    them it runs away; a picture stands by every second turn, between noise that the filters take away."""
    dedup.shared_folder(spark)
    rows = turns(spark, d).withColumn("page_no", F.floor((F.col("i") - 1) / 2))
    shown = F.when(F.col("i") % 2 == 0, "\n<img>a drawing</img>").otherwise("")
    rows = rows.withColumns({"line": F.concat(F.col("i").cast("string"), F.lit(". "), "text", shown), "layer": F.concat(F.col("i").cast("string"), F.lit(". "), "text")})
    keys = ["conv_id", "page_no"]
    good = sequence.joined(rows, keys, "i", "line", "markdown").join(sequence.joined(rows, keys, "i", "layer", "text_layer"), keys)
    lossy = F.when(F.col("page_no") % 3 == 0, F.regexp_replace("markdown", r"(?s)^\d+\. ", "")).when(F.col("page_no") % 3 == 1, F.repeat(F.lit("the same words over and over again, once more from the start. "), F.lit(96))).otherwise(F.col("markdown"))
    attempts = good.select(*keys, "text_layer", F.explode(F.array(F.struct(F.lit(0).alias("rung"), lossy.alias("markdown")), F.struct(F.lit(1).alias("rung"), F.col("markdown").alias("markdown")))).alias("x")).select(*keys, "text_layer", "x.*")
    named = lambda df: df.withColumns({"series": F.lit("pumac"), "test_id": F.col("conv_id").cast("string")}).drop("conv_id")
    box = lambda i, label, x0, y0, x1, y1, ink: F.struct(F.lit(i).alias("det"), F.lit(label).alias("label"), *[F.lit(float(v)).alias(n) for n, v in (("x0", x0), ("y0", y0), ("x1", x1), ("y1", y1), ("score", 0.9), ("ink", ink))], F.lit("said").alias("text"))
    pictures = good.where(F.contains("markdown", F.lit("<img>"))).select(*keys, F.explode(F.array(box(1, "Picture", 40, 60, 90, 110, 0.2), box(2, "Picture", 10, 10, 30, 30, 0.0), box(3, "Text", 10, 120, 150, 140, 0.1))).alias("b")).select(*keys, "b.*")
    sizes = good.select(*keys, F.lit(200.0).alias("width"), F.lit(260.0).alias("height"))
    found = jobs.illustrated(named(attempts), named(pictures), named(sizes), "pumac")
    return found.select("test_id", "problem", "text", F.col("figures").cast("long").alias("figures"))


@query(f"SELECT CAST(conv_id AS VARCHAR) AS test_id, i AS problem, CASE WHEN i % 3 = 0 THEN 'k' || i ELSE CAST(i * 7 AS VARCHAR) END AS answer, CASE WHEN i % 3 = 0 THEN 'key' ELSE 'label' END AS tier FROM ({TURNS}) t")
def keyed_answers(spark: SparkSession, d: str) -> DataFrame:
    """Answers from solutions, and from lines of a key file for every third problem."""
    from quire.plans.jobs import solved

    lines = turns(spark, d).where("i % 3 = 0").select(F.lit("cmimc").alias("series"), F.col("conv_id").cast("string").alias("test_id"), F.concat(F.col("i").cast("string"), F.lit("  k"), F.col("i").cast("string"), F.lit(" more")).alias("value"))
    return jobs.answer_table(solved(spark, d), "cmimc", files.spaced_answers(lines)).select("test_id", "problem", "answer", "tier")


@query("""WITH f AS (SELECT o_custkey AS y, CASE o_custkey % 4 WHEN 0 THEN ['packet', 'test', 'team'] WHEN 1 THEN ['solutions', 'other'] WHEN 2 THEN ['team', 'indy', 'Solutions'] ELSE ['relay', 'answers'] END AS names FROM orders GROUP BY 1)
SELECT CASE y % 4 WHEN 0 THEN y::VARCHAR WHEN 1 THEN y::VARCHAR ELSE y || '_' || n END AS test_id, '/d/' || y || '/' || n || '.pdf' AS path FROM (SELECT y, unnest(names) AS n FROM f) q
WHERE CASE y % 4 WHEN 0 THEN n = 'packet' WHEN 1 THEN n = 'solutions' ELSE lower(n) NOT IN ('answers', 'solutions') END""")
def yearly_tests(spark: SparkSession, d: str) -> DataFrame:
    """Tests in folders of years (here customers): whole contests, solutions that stand for one, parts."""
    y, kind = F.col("o_custkey").cast("string"), F.col("o_custkey") % 4
    names = F.when(kind == 0, F.array(*map(F.lit, ["packet", "test", "team"]))).when(kind == 1, F.array(*map(F.lit, ["solutions", "other"]))).when(kind == 2, F.array(*map(F.lit, ["team", "indy", "Solutions"]))).otherwise(F.array(*map(F.lit, ["relay", "answers"])))
    rows = table(spark, d, "orders").select(F.explode(names).alias("n"), y.alias("y"))
    return files.by_year(rows.select(F.concat(F.lit("/d/"), "y", F.lit("/"), "n", F.lit(".pdf")).alias("path")), "/d")


def _folder(spark: SparkSession, name: str) -> str:
    dedup.shared_folder(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


@query("""SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'c' WHEN doc_id % 3 = 0 THEN 'b' WHEN doc_id % 2 = 0 THEN 'a' END || doc_id AS text, doc_id % 5 = 0 OR doc_id % 3 = 0 OR doc_id % 2 = 0 AS hit FROM documents""")
def cached_pages(spark: SparkSession, d: str) -> DataFrame:
    """Documents looked up in a cache that was written in three batches and compacted after the second."""
    docs, cache = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("key"), "doc_id"), commits.PageCache(spark, _folder(spark, "cache"))
    for n, mark in ((2, "a"), (3, "b"), (5, "c")):
        cache.append(docs.where(F.col("doc_id") % n == 0).select("key", F.concat(F.lit(mark), "key").alias("value")))
        if n == 3:
            cache.compact()
    hits, misses = files.cached(docs, cache.read(), "key", "value", "version")
    return hits.select("doc_id", F.col("value").alias("text"), F.lit(True).alias("hit")).unionByName(misses.select("doc_id", F.lit(None).cast("string").alias("text"), F.lit(False).alias("hit")))


@query("""SELECT conv_id::VARCHAR AS test_id, CASE WHEN conv_id % 4 = 1 THEN 'new' ELSE 'old' END AS state, count(*) AS problems FROM conversations WHERE conv_id % 4 <> 2 GROUP BY 1, 2""")
def published_tests(spark: SparkSession, d: str) -> DataFrame:
    """Conversations as outputs of tests: all are published, then some anew while others are removed; a run from an old version is refused."""
    out = commits.TestOutputs(spark, _folder(spark, "outputs"))
    turns_ = table(spark, d, "conversations").select(F.col("conv_id").cast("string").alias("test_id"), F.col("turn").cast("int").alias("problem"), "conv_id")
    maps = lambda state, rows: sinks.problem_maps(rows.withColumn("text", F.lit(state)))
    base = out.publish(maps("old", turns_))
    gone = turns_.where("conv_id % 4 = 2").select("test_id").distinct()
    out.publish(maps("new", turns_.where("conv_id % 4 = 1")), removed=gone, base=base)
    try:
        out.publish(maps("late", turns_), base=base)
        raise AssertionError("a late run was not refused")
    except commits.Conflict:
        pass
    entries = files.json_map(out.read().withColumnRenamed("json", "value")).withColumnRenamed("value", "state")
    return entries.groupBy("test_id", "state").agg(F.count(F.lit(1)).alias("problems"))
