"""Cases stated as literals, each held against what it must give."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions import answers, cleaners, text
from quire.functions.series import DISCOVERY, Layout
from quire.operators import boxes, documents, layout
from quire.sources import files


def check(df, rows, names):
    assert sorted((tuple(r[n] for n in names) for r in df.collect()), key=str) == sorted(map(tuple, rows), key=str)


# (series, block, answer expected, tier expected)
CASES = [
    ("pumac", "**Answer:** $42$.\nwork", "42", "label"), ("pumac", "x\n[Answer] 7", "7", "row"), ("pumac", "x (ANS: 12 CB: A. B.)", "12", "tag"), ("pumac", "so there are [15] ways", "15", "bracket"),
    ("pumac", r"\boxed{3} then \boxed{4}. Also accepted", "3, 4", "box"), ("pumac", r"\boxed{\frac{1}{2}}", r"\frac{1}{2}", "box"), ("pumac", "Solution. 28. We see", "28", "opening"), ("pumac", "Solution. We see", None, None),
    ("hmmt", "Answer: 17 and a proof of it", None, None), ("hmmt", "Answer: $\\frac{1}{3}$ since it is so here", "\\frac{1}{3}", "label"), ("hmmt", "Answer:\n8\nSolution: x", "8", "label"), ("hmmt", "Solution: $9$", "9", "solution"), ("hmmt", "we get \\boxed{5}", "5", "box"), ("hmmt", "2019", "2019", "bare"), ("hmmt", "What is it?", None, None),
    ("cmimc", "Answer. $11 - 1 = \\boxed{10}$", "10", "label"), ("cmimc", "so the answer is $6$. Then", "6", "prose"), ("cmimc", "x \\boxed{2}", "2", "box"), ("cmimc", "Answer:\nSolution: x \\boxed{2}", None, None), ("cmimc_key", "12", "12", "bare"),
    ("chmm", "a\nour total sum is $55$.", "55", "tail"), ("chmm", "Solution 1: 14", "14", "solution"), ("chmm", "Answers are 3", "3", "prose"),
    ("smt", "Find it. Answer: 21 Solution: do", "21", "label"), ("smt", "so \\boxed{8}", "8", "box"), ("bmt", "Answer: N/A", None, None), ("bmt", "**Answer:** 3/4", "3/4", "label"),
    ("omo", "Answer.\n\n100.\nProposed by X", "100", "label"), ("omo", "Hence the answer is 3.5.", "3.5", "prose"), ("omo", "Answer. ☐", None, None), ("mpfg", "Problem 3 x Answer: **27/25**\nMath Solution: y", "27/25", "label"), ("mpfg", "no label", None, None),
]


def answer_cases(spark):
    """Every tier of every series' cascade."""
    out = None
    for name in dict.fromkeys(c[0] for c in CASES):
        rows = spark.createDataFrame([(i, c[1]) for i, c in enumerate(CASES) if c[0] == name], "i int, block string").coalesce(1)
        got = rows.select("i", answers.answer(name)("block").alias("a")).select("i", "a.answer", "a.tier")
        out = got if out is None else out.unionByName(got)
    return out


def test_answer_cases(spark):
    check(answer_cases(spark), [(i, *c[2:]) for i, c in enumerate(CASES)], ["i", "answer", "tier"])


DERIVED = [
    (None, "Thus x is 5. Then 3 = 4", "4"), (None, "= 7 and therefore it is 9", "9"), (None, "we get 12 = 11", "12"), (None, r"\sum_{i=3}^{9} then n \neq 4", None), ("Concatenate the numbers", "(a, b) = (3, 14)", "314"), (None, "nothing", None), (None, r"so $x \approx 2.5$", "2.5"),
]


def derived_answers(spark):
    rows = spark.createDataFrame([(i, s, b) for i, (s, b, _) in enumerate(DERIVED)], "i int, s string, b string")
    return rows.select("i", answers.derived_answer("s", "b").alias("answer"))


def test_derived_answers(spark):
    check(derived_answers(spark), [(i, c[2]) for i, c in enumerate(DERIVED)], ["i", "answer"])


FITTED = [("no solution", "Find x", "", None), ("$(3, 14)$", "concatenate them", "", "314"), ("a = b = 7", "Find the value", "", "7"), ("a = b = 7", "Find it", "the answer is 8", "8"), ("a = b = c", "Prove it", "", "a = b = c"), ("$12$.", None, "", "12")]


def fitted_answers(spark):
    rows = spark.createDataFrame([(i, v, s, b) for i, (v, s, b, _) in enumerate(FITTED)], "i int, v string, s string, b string")
    return rows.select("i", answers.fitted_answer("v", "s", "b").alias("answer"))


def test_fitted_answers(spark):
    check(fitted_answers(spark), [(i, c[3]) for i, c in enumerate(FITTED)], ["i", "answer"])


EDGES = [("---\nbody\n* * *", "body"), ("-\nbody\n==", "-\nbody\n=="), ("# \nx", "# \nx"), ("** whole **", "whole"), ("** odd", "odd"), ("odd **", "odd"), ("text\n***\n![](a.png)", "text\n![](a.png)"), ("**Claim.** x", "**Claim.** x"), ("a\n---\nb", "a\n---\nb"), ("\n\n", "")]


def entry_edges(spark):
    """Edges of entries: rules and bare emphasis go, images are looked through."""
    return spark.createDataFrame([(i, x) for i, (x, _) in enumerate(EDGES)], "i int, x string").select("i", text.boundary_clean(F.col("x")).alias("t"))


def test_entry_edges(spark):
    check(entry_edges(spark), [(i, w) for i, (_, w) in enumerate(EDGES)], ["i", "t"])


SKIPPED = [
    ("mathcounts", "DO NOT BEGIN  until you\nare instructed", True), ("mathcounts", "1. What", False), ("mpfg", "Do not open this test now", True), ("omo", "Acknowledgements\nthanks", True), ("omo", "The Online Math Open\nSpring", True), ("omo", "The Online Math Open\n1. What", False),
    ("farml", "\n\nAnswer Key\n1. 5", True), ("farml", "T1 What", False), ("hmmt", "Answer Sheet\nname", True), ("hmmt", "Name: School: \n1. ____\n2. ____\n3. ____\n4. ____\n5. ____\n6. ____", True), ("hmmt", "1. [3]\n2. [3]\n3. [3]\n4. [3]\n5. [3]\n6. [3]", True),
    ("hmmt", "This test consists of ten problems. Enjoy!", True), ("hmmt", "1. [3] What is the sum?", False), ("cmimc", "Do not look at the test before the proctor says so", True), ("cmimc_statements", "Proposed by X", True), ("cmimc", "Proposed by X", False), ("omo", "  ", False), ("usamts", "anything", False),
]


def page_skips(spark):
    """Covers, forms and instructions, by series."""
    out = None
    for name in dict.fromkeys(x[0] for x in SKIPPED):
        rows = spark.createDataFrame([(i, x[1]) for i, x in enumerate(SKIPPED) if x[0] == name], "i int, t string").select("i", cleaners.skip_page(name, F.col("t")).alias("skip"))
        out = rows if out is None else out.unionByName(rows)
    return out


def test_page_skips(spark):
    check(page_skips(spark), [(i, s) for i, (_, _, s) in enumerate(SKIPPED)], ["i", "skip"])


CLEANED = [
    ("usamts", "<img>USAMTS</img>1/2/3. Find\n*****\nrest", "1/2/3. Find"), ("usamts", "1/2/3. a\nComplete, well-written solutions are", "1/2/3. a"), ("mandelbrot", "last line\n© Proof School 2018\naddress", "last line"),
    ("hmmt", "```html\n<div>1. <b>x</b></div>\n```\n© 2019 HMMT\n\n\n\n2. y  ", "1. x\n\n2. y"), ("cmimc", "## CMIMC 2019\n<h2>Team</h2>\n1. x", "Team\n\n1. x"), ("cmimc", "a <img><img>b</img></img> c", "a <img>b</img> c"),
    ("mathcounts", "| 1. ____ | What? |\n| a | b |", "1. What?\n| a | b |"), ("mathcounts", "Forms of Answers\nx", ""), ("chmm", "Rules\nbe quiet", ""), ("chmm", "3.\n4. x", "3. [No statement was printed in the source.]\n4. x"),
    ("omo", "Spring 2018\n**OMO 2018**\n1. x\npage 3", "1. x"), ("nimo", "The NIMO Compendium\n1. x\nMay 2014\n17", "1. x"), ("farml", "FARML 2014\n**TEAM EVENT**\nT1 x\n(figures)", "T1 x"), ("bmt", "BMT 2019 Algebra\nTeam Round Solutions\n1. x", "1. x"), ("purplecomet", "as it is", "as it is"),
]


def page_cleaners(spark):
    out = None
    for name in dict.fromkeys(x[0] for x in CLEANED):
        rows = spark.createDataFrame([(i, x[1]) for i, x in enumerate(CLEANED) if x[0] == name], "i int, t string").select("i", cleaners.clean_page(name, F.col("t")).alias("t"))
        out = rows if out is None else out.unionByName(rows)
    return out


def test_page_cleaners(spark):
    check(page_cleaners(spark), [(i, w) for i, (_, _, w) in enumerate(CLEANED)], ["i", "t"])


PATHS = ["/d/2019/1/test.pdf", "/d/2019/A/algebra/test.pdf", "/d/2019/A/power/test.pdf", "/d/2019/team/test.pdf", "/d/feb/2019/guts/test.pdf", "/d/2019/math-talk/test.pdf", "/d/2010/round1-test.pdf", "/d/2019/state/sprint.pdf", "/d/2019/state/answers.pdf", "/d/out/fall/problems.pdf", "/d/2019/1/solutions.pdf"]
TESTS = {
    "usamts": ["2019_1", "2019_team", "2019_math-talk"], "pumac": ["2019_A_algebra", "2019_team"], "hmmt": ["2019_1", "2019_A_algebra", "2019_A_power", "2019_team", "2019_math-talk", "feb_2019_guts"], "chmm": ["2019_1", "2019_A_algebra", "2019_team", "feb_2019_guts"],
    "mandelbrot": ["2010_round1-test"], "mathcounts": ["2019_state_sprint"], "omo": ["fall"],
}


def discovered_tests(spark):
    """Tests among paths, by the rules of seven series."""
    paths, out = spark.createDataFrame([(p,) for p in PATHS], "path string"), None
    for name in [n for n in DISCOVERY if n in TESTS]:
        rows = files.discovered(paths, "/d", name).select(F.lit(name).alias("series"), "test_id")
        out = rows if out is None else out.unionByName(rows)
    return out


def test_discovered_tests(spark):
    check(discovered_tests(spark), [(name, t) for name, found in TESTS.items() for t in found], ["series", "test_id"])


WORDS = [("p", 1, "Answer:", 10, 10, 30, 20), ("p", 1, "42", 35, 11, 45, 19), ("p", 2, "43", 35, 11, 45, 19), ("p", 1, "below", 35, 30, 45, 38), ("p", 3, "7", 62, 62, 66, 68)]
LINES = [("p", 60, 60, 70, 60), ("p", 60, 70, 70, 70), ("p", 60, 60, 60, 70), ("p", 70, 60, 70, 70), ("p", 10, 90, 90, 90)]
PICTURES = [("p", 1, 34, 10, 46, 20), ("p", 2, 34, 29, 46, 39), ("p", 3, 59, 59, 71, 71), ("p", 4, 0, 0, 95, 20), ("p", 5, 80, 80, 90, 99)]


def answer_boxes(spark):
    """Boxed answers: on an answer row, or in a drawn frame around a word."""
    number = lambda names: ", ".join(f"{n} double" for n in names)
    words = spark.createDataFrame([(p, b, w, *map(float, x)) for p, b, w, *x in WORDS], f"page string, block int, word string, {number(['x0', 'y0', 'x1', 'y1'])}")
    lines = spark.createDataFrame([(p, *map(float, x)) for p, *x in LINES], f"page string, {number(['ax', 'ay', 'bx', 'by'])}")
    found = spark.createDataFrame([(p, i, *map(float, x)) for p, i, *x in PICTURES], f"page string, det int, {number(['x0', 'y0', 'x1', 'y1'])}")
    size = spark.createDataFrame([("p", 100.0, 150.0, 100.0, 150.0)], f"page string, {number(['width', 'height', 'pdf_width', 'pdf_height'])}")
    return boxes.without_answer_boxes(found, words, lines, size).select("page", "det")


def test_answer_boxes(spark):
    check(answer_boxes(spark), [("p", 2), ("p", 4), ("p", 5)], ["page", "det"])


def closed_images(spark):
    """Images that were never closed."""
    rows = [("a", "a <img> d\n\n5. x"), ("b", "a <img> d"), ("c", "<img>x</td>y"), ("d", "<img>x</img> y")]
    return spark.createDataFrame([(k, layout.repaired(t)) for k, t in rows], "k string, t string")


def test_closed_images(spark):
    check(closed_images(spark), [("a", "a <img></img>\n\n5. x"), ("b", "a <img></img>"), ("c", "<img></img></td>y"), ("d", "<img>x</img> y")], ["k", "t"])


def key_gaps(spark):
    """Numbers of key cells that their neighbours prove."""
    rows = [(0, [1, None, 3, 4]), (1, [5, None, None]), (2, [None, 1])]
    return spark.createDataFrame([(i, ",".join(map(str, answers.gap_numbers(x)))) for i, x in rows], "i int, n string")


def test_key_gaps(spark):
    check(key_gaps(spark), [(0, "1,2,3,4"), (1, "5,None,None"), (2, "None,1")], ["i", "n"])


CLUES = [("d", 0, "Intro 3"), ("d", 1, "**Across**"), ("d", 2, "1. one"), ("d", 3, "12 two"), ("d", 4, "DOWN:"), ("d", 5, "2) three"), ("d", 6, "more")]


def clue_codes(spark):
    return documents.clue_numbers(spark.createDataFrame(CLUES, "k string, pos int, line string"), ["k"])


def test_clue_codes(spark):
    check(clue_codes(spark), [(k, p, x, c) for (k, p, x), c in zip(CLUES, [None, None, 1001, 1012, None, 2002, None])], ["k", "pos", "line", "code"])


SIBLINGS = [("/d/2019/a/test.pdf",), ("/d/2019/a/solutions.pdf",), ("/d/2019/b/test.pdf",), ("/s/2019-a/problems.json",), ("/s/_old/problems.json",), ("/s/2019-b/other.json",)]


def sibling_files(spark):
    """The solution file beside a test, and folders that hold problems."""
    paths = spark.createDataFrame(SIBLINGS, "path string")
    beside = files.beside(paths.where("path LIKE '%test.pdf'"), paths, "solutions.pdf").select("path", F.col("source").alias("found"))
    return beside.unionByName(files.with_problems(paths, "/s").select("path", F.col("test").alias("found")))
LISTS = [("d", 0, "1. Find all"), ("d", 1, "that hold:"), ("d", 2, "1. a"), ("d", 3, "2. b"), ("d", 4, "3. c"), ("d", 5, "2. Next"), ("e", 0, "1. a"), ("e", 1, "2. b"), ("e", 2, "3. c"), ("f", 0, "x"), ("f", 1, "1. a"), ("f", 2, "2. b")]


def test_sibling_files(spark):
    check(sibling_files(spark), [("/d/2019/a/test.pdf", "/d/2019/a/solutions.pdf"), ("/d/2019/b/test.pdf", None), ("/s/2019-a/problems.json", "2019-a")], ["path", "found"])


def list_runs(spark):
    """Lists within statements join the line before them."""
    from quire.functions.text import marker

    lines = spark.createDataFrame(LISTS, "doc_id string, pos int, line string").withColumn("number", marker(F.col("line"))["number"])
    return documents.without_lists(lines)


def test_list_runs(spark):
    check(list_runs(spark), [("d", 0, "1. Find all"), ("d", 1, "that hold: 1. a 2. b 3. c"), ("d", 5, "2. Next"), ("e", 0, "1. a"), ("e", 1, "2. b"), ("e", 2, "3. c"), ("f", 0, "x"), ("f", 1, "1. a"), ("f", 2, "2. b")], ["doc_id", "pos", "line"])


def solution_indexes(spark):
    rows = [("a", "Solution 1\nx\n**Solution 2** y"), ("b", "Solution 1\nThird Solution: z"), ("c", "no solution here"), ("d", "### First Solution")]
    return spark.createDataFrame(rows, "k string, t string").select("k", documents.solution_index(F.col("t")).alias("n"))


def test_solution_indexes(spark):
    check(solution_indexes(spark), [("a", 2), ("b", 3), ("c", None), ("d", 1)], ["k", "n"])


def answer_keys(spark):
    """Keys of answers behind a heading, up to the first longer line."""
    rows = [("a", "1. What\nAnswer Key\n1. 5\n\n2. x^2\nand a longer line\n3. 7"), ("b", "no key\n1. 5")]
    found = spark.createDataFrame(rows, "k string, t string").select("k", documents.answer_key("t").alias("x"))
    return found.select("k", F.explode("x.answers").alias("e")).select("k", "e.*")


def test_answer_keys(spark):
    check(answer_keys(spark), [("a", 1, "5"), ("a", 2, "x^2")], ["k", "number", "answer"])


def repaired_pages(spark):
    """Pages with the problems that only a reading in slices found."""
    rows = [("gap", "1. a\n2. b lost c\n4. d", "1. A\n2. B\n3. C\n4. D"), ("same", "1. a\n2. b", "1. x\n2. y"), ("less", "1. a\n2. b", "1. x"), ("lead", "1. a", "0. z\n1. a")]
    return spark.createDataFrame(rows, "k string, w string, s string").select("k", documents.repaired_page("w", "s").alias("t"))


def test_repaired_pages(spark):
    check(repaired_pages(spark), [("gap", "1. a\n2. B\n3. C\n4. d"), ("same", "1. a\n2. b"), ("less", "1. a\n2. b"), ("lead", "0. z\n1. a")], ["k", "t"])


def crop_names(spark):
    rows = [("3.png",), ("12_2.png",), ("4_solution_2_1.png",), ("cover.png",)]
    return documents.crops(spark.createDataFrame(rows, "path string"))


def test_crop_names(spark):
    check(crop_names(spark), [("3.png", 3, None, 1), ("12_2.png", 12, None, 2), ("4_solution_2_1.png", 4, 2, 1)], ["path", "problem", "solution", "figure"])


# name: (options of the layout, series of the markers, problem carried on, page, items expected)
LAYOUT_CASES: dict[str, tuple[dict, str, int | None, str, list[tuple[str, int | None, str]]]] = {
    "plain": ({}, "default", None, "head\n1. one\nmore <img>fig</img> tail\n2. two", [("text", None, "head"), ("text", 1, "one\nmore"), ("image", 1, "fig"), ("text", 1, "tail"), ("text", 2, "two")]),
    "restart_at_one": ({}, "default", None, "1. a\n2. b\n1. c", [("text", 1, "a"), ("text", 2, "b"), ("text", 3, "c")]),
    "strict_needs_heading": ({"numbering": {"strict": True}}, "default", None, "1. a\n2. b\n1. c\n# Round\n1. d", [("text", 1, "a"), ("text", 2, "b\n1. c\n# Round"), ("text", 3, "d")]),
    "flat": ({"numbering": {"flat": True}}, "default", None, "1. a\n# Part\n1. b\n2. c", [("text", 1, "a\n# Part\n1. b"), ("text", 2, "c")]),
    "consecutive": ({"numbering": {"consecutive": True}}, "default", None, "1. a\n7. b\n2. c", [("text", 1, "a\n7. b"), ("text", 2, "c")]),
    "backward": ({"numbering": {"backward": True}}, "default", None, "4. a\n2. b\n5. c", [("text", 4, "a"), ("text", 2, "b"), ("text", 5, "c")]),
    "carried": ({}, "default", 6, "rest of six\n7. seven", [("text", 6, "rest of six"), ("text", 7, "seven")]),
    "carried_restart": ({}, "default", 6, "3. three", [("text", 9, "three")]),
    "points": ({"numbering": {"point_values": True}}, "default", None, "1. [3] a\n2. list\n2. [4] b", [("text", 1, "[3] a\n2. list"), ("text", 2, "[4] b")]),
    "points_in_bold": ({}, "default", None, "27. **[13]** statement", [("text", 27, "[13] statement")]),
    "page_restart": ({"numbering": {"strict": True, "page_restart": True}}, "default", 10, "1. [5] a\n2. [6] b", [("text", 11, "[5] a"), ("text", 12, "[6] b")]),
    "page_restart_not_first": ({"numbering": {"strict": True, "page_restart": True}}, "default", 10, "tail\n1. [5] a", [("text", 10, "tail\n1. [5] a")]),
    "list_items": ({"list_items": True}, "default", None, "<ol><li>first</li>\n<li>second<br>line</li></ol>", [("text", 1, "first"), ("text", 2, "second line")]),
    "point_items": ({"point_items": True}, "default", None, "<li>[7] statement</li>\n<li>\n[8] other</li>\n<li>plain</li>", [("text", 1, "[7] statement"), ("text", 2, "[8] other\nplain")]),
    "titles": ({"titles": True}, "default", None, "# Balance\n1. do this\n2. or that\n# Solutions\n# Two\n2. y", [("text", 1, "# Balance\ndo this\n2. or that\n# Solutions"), ("text", 2, "# Two\ny")]),
    "column_of_blanks": ({}, "default", None, "1. ____ dollars\n2. ____ cm\n3. What\n4. ____\nWho", [("text", 3, "What"), ("text", 4, "Who")]),
    "repeated_blank": ({}, "default", None, "4. a\n4. ____\n5. b", [("text", 4, "a"), ("text", 5, "b")]),
    "points_alone": ({}, "default", None, "1. a\n(5)\n①\nb ____ c", [("text", 1, "a\nb  c")]),
    "glued_word": ({}, "default", None, "1. a $$x$$ **Problem 2** The $$y$$ 3. Now", [("text", 1, "a $$x$$"), ("text", 2, "The $$y$$ 3. Now")]),
    "glued_bare": ({"glued_bare": True}, "default", None, "1. a $$x$$ 2. The b", [("text", 1, "a $$x$$"), ("text", 2, "The b")]),
    "image_as_statement": ({}, "default", None, "5. <img>5. A drawn one</img>", [("text", 5, "A drawn one"), ("image", 5, "5. A drawn one")]),
    "furniture": ({}, "default", None, "<watermark>x</watermark>1. a<page_number>3</page_number>", [("text", 1, "a")]),
    "table_kept": ({}, "default", None, "1. a\n<table>\n<tr><td>2. x</td></tr></table>\nb", [("text", 1, "a\n<table> <tr><td>2. x</td></tr></table>\nb")]),
    "table_rows": ({"table_rows": True}, "default", None, "<table><tr><td>1. ____</td><td>What?</td></tr><tr><td>2. ____ cm</td><td>How<br>long</td></tr><tr><td>a</td><td>b</td></tr><tr><td>①</td></tr></table>", [("text", 1, "What?"), ("text", 2, "How\nlong\n<table><tr><td>a</td><td>b</td></tr></table>")]),
    "table_of_data": ({"table_rows": True, "numbering": {"consecutive": True, "strict": True}}, "default", None, "1. a\n<table><tr><td>9. x</td><td>y</td></tr></table>", [("text", 1, "a\n<table><tr><td>9. x</td><td>y</td></tr></table>")]),
    "table_lists": ({"table_rows": True}, "default", None, "<table><tr><td><ol><li>What</li><li>Who</li></ol></td><td><ol><li>____</li><li>___</li></ol></td></tr></table>", [("text", 1, "What"), ("text", 2, "Who")]),
    "table_packed": ({"table_rows": True}, "default", None, "<table><tr><td>1. What is 3? 2. Who? 12. no</td><td>1. ____<br>2. ____</td></tr></table>", [("text", 1, "What is 3?"), ("text", 2, "Who? 12. no")]),
    "table_image": ({"table_rows": True}, "default", None, "<table><tr><td>3. ____</td><td><img>Find <b>x</b></img></td></tr></table>", [("text", 3, "Find x")]),
    "relay": ({}, "cmimc", None, "1-1. a\n6-2. b\n7-1. c", [("text", 1, "a"), ("text", 6, "b"), ("text", 17, "c")]),
    "instructions": ({}, "cmimc", None, "1. Do not look\n2. Find x", [("text", None, "1. Do not look"), ("text", 2, "Find x")]),
    "appendix": ({"numbering": {"backward": True}}, "farml_solutions", None, "T8 a\nT9 b\nAppendix to T8 c", [("text", 8, "a"), ("text", 9, "b"), ("text", 8, "c")]),
    "crossword": ({}, "pumac", None, "12 Across x\n7 Down y", [("text", 1012, "Across x"), ("text", 2007, "Down y")]),
    "byline": ({}, "nimo", None, "1. *(Ann Lee)* x\n2. (n = 2) y", [("text", 1, "(Ann Lee)* x\n2. (n = 2) y")]),
}


def layout_cases(spark):
    """Every rule by which markers, lists, titles, tables and images become items."""
    out = None
    for name, (options, rules, first, page, _) in LAYOUT_CASES.items():
        got = layout.items(spark.createDataFrame([(name, page)], "name string, text string").coalesce(1), "name", "text", rules, Layout(**options), first)
        out = got if out is None else out.unionByName(got)
    return out


def test_layout_cases(spark):
    check(layout_cases(spark), [(name, i, *item) for name, case in LAYOUT_CASES.items() for i, item in enumerate(case[4])], ["name", "item_no", "kind", "problem", "text"])
