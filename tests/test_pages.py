from __future__ import annotations

from pyspark.sql import functions as F

from quire import jobs
from quire.operators import crosswords, documents, expectations


def clues(spark, pages, bare):
    df = spark.createDataFrame(pages, "k string, page int, text string")
    return {(r["k"], r["page"]): r["text"] for r in crosswords.clue_pages(df, ["k"], "page", "text", F.lit(bare)).collect()}


def test_crossword_pages(spark):
    pages = [("a", 1, "PUMaC 2012\n2.1 Across\n1. one\nprose"), ("a", 2, "2) two\nDown and to the right\n---\n**3.** three"), ("a", 10, "4. four"), ("b", 1, "5. no heading\n7 Down: seven\n8 Across"), ("c", 1, None), ("c", 2, "")]
    got = clues(spark, pages, True)
    assert got == {
        ("a", 1): "## Across\n1001. [1 Across] one\nprose", ("a", 2): "1002. [2 Across] two\n## Down-right\n3003. [3 Down-right] three", ("a", 10): "3004. [4 Down-right] four",
        ("b", 1): "5. no heading\n2007. [7 Down] seven\n## Across", ("c", 2): "",
    }
    plain = clues(spark, pages, False)
    assert plain["a", 2] == "2) two\nDown and to the right\n**3.** three" and plain["b", 1] == "5. no heading\n2007. [7 Down] seven\n## Across"
    assert clues(spark, [], True) == {}


def test_expectations_by_rule(spark):
    layer = "1. a\n2. b\n3. c\n" + "words " * 200
    cases = [
        ("all", "pumac", "statement", "x", layer, [1, 2, 3], []), ("one lost", "pumac", "statement", "x", layer, [1, 3, 9], ["numbers"]), ("no layer", "pumac", "statement", None, None, [], []), ("no words", "farml", "statement", "", "no number", [5], []),
        ("labels", "pumac", "solution", "Solution: a", layer + "\nSolution: a\nAnswer. b", [1, 2, 3], ["labels"]), ("both", "pumac", "solution", None, "1. a\nSolution: b", [], ["numbers", "labels"]),
        ("count", "hmmt", "statement", "x", layer, [7, 8, 9], []), ("fewer", "cmimc", "statement", "x", layer, [1, 2], ["count"]), ("thin", "hmmt", "solution", "short", layer, [], ["share"]), ("short layer", "hmmt", "solution", "", "few words", [], []),
        ("lone", "mathcounts", "statement", "Target Round", "", [1], ["batch"]), ("pair", "mathcounts", "statement", "Target Round", "", [1, 2], []), ("target", "mathcounts", "statement", "the Target  Round", "", [], ["batch"]), ("cover", "mathcounts", "statement", "Forms of   answers", "", [1], []), ("none", "usamts", "statement", "", layer, [], []),
    ]
    pages = spark.createDataFrame([c[:5] for c in cases], "page_key string, series string, role string, text string, layer string")
    found = spark.createDataFrame([(c[0], n) for c in cases for n in [*c[5], None]], "page_key string, problem int")
    got = {r["page_key"]: (r["broken"], r["valid"]) for r in expectations.judged(pages.union(pages), found).collect()}
    assert got == {c[0]: (c[6], not c[6]) for c in cases}
    assert expectations.judged(pages.where("false"), found).count() == 0


def test_relays_and_headerless_solutions(spark):
    docs = spark.createDataFrame([("a", "head\n1-1. x\n**6-2.** y\n 1-2. z\n1-1. w"), ("b", "no label"), ("c", None), ("d", "")], "k string, text string")
    assert sorted(map(tuple, documents.relay_blocks(docs, ["k"]).collect())) == [("a", 1, "x\nw"), ("a", 6, "** y"), ("a", 11, "z")]
    blocks = [(0, "stated\n\nThis problem is from X\n\nWe thank Y\nfor it\n\nso\nthus\n\nThe problem is done"), (1, "one paragraph\nonly"), (2, "stated\n \nComment: none"), (3, ""), (4, None), (5, "\n\na\n\n\n\nb\n")]
    got = spark.createDataFrame(blocks, "i int, t string").select("i", documents.headerless_solution(F.col("t")).alias("s"))
    assert {r["i"]: r["s"] for r in got.collect()} == {0: "so\nthus\n\nThe problem is done", 1: "one paragraph\nonly", 2: "", 3: "", 4: None, 5: "b"}


def test_pictures_without_tags_go_to_the_problem_above(spark):
    """Two pictures and one tag: place decides; the attempt that holds all problems is taken."""
    keys = ("pumac", "t", 1)
    attempts = spark.createDataFrame([(*keys, 0, "1. one", "1. one\n2. two"), (*keys, 1, "1. one <img>x</img>\n2. two", "1. one\n2. two")], "series string, test_id string, page_no long, rung int, markdown string, text_layer string")
    box = "det long, label string, score double, ink double, x0 double, y0 double, x1 double, y1 double, text string"
    dets = spark.createDataFrame([(*keys, i, label, 0.9, 0.3, *map(float, at), text) for i, label, at, text in [(1, "Text", (5, 10, 150, 20), "1. the first of all"), (2, "Picture", (20, 30, 60, 60), ""), (3, "Text", (5, 100, 150, 110), "2. the second of all"), (4, "Picture", (20, 120, 60, 160), "")]], f"series string, test_id string, page_no long, {box}")
    sizes = spark.createDataFrame([(*keys, 200.0, 260.0)], "series string, test_id string, page_no long, width double, height double")
    got = {r["problem"]: (r["text"], r["figures"]) for r in jobs.illustrated(attempts, dets, sizes, "pumac").collect()}
    assert got == {1: ("one\nproblem_1_image_1.png", 1), 2: ("two\nproblem_2_image_1.png", 1)}
    assert [(r["status"], r["markdown"]) for r in jobs.believed(attempts, "pumac").collect()] == [("clean", "1. one <img>x</img>\n2. two")]
    assert jobs.illustrated(attempts.where("false"), dets, sizes, "pumac").count() == 0
