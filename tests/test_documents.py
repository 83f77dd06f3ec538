from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from quire.functions import text
from quire.functions.series import series
from quire.operators import segment, sequence, sinks
from quire.sources import files


def number(spark, name, line):
    m = spark.createDataFrame([(line,)], "x string").select(series(name).marker(F.col("x")).alias("m")).first()["m"]
    return m and (m["number"], line[m["end"]:])


@pytest.mark.parametrize(("name", "line", "want"), [
    ("usamts", "3/2/19. x", 3), ("usamts", "3. x", None), ("hmmt", "<p>Question Four x", 4), ("hmmt", "Power Question", 1), ("hmmt", "Problem B7 x", 7),
    ("cmimc", "2-1. x", 2), ("cmimc", "2-2. x", 12), ("cmimc", "6-2. x", 6), ("cmimc", "6-1. x", 16), ("cmimc", "3. Do not look at it", None), ("cmimc", "3. Look", 3), ("smt", "JZ03 4. x", 4), ("cmimc", "2013. x", None), ("chmm", "3.5 x", None), ("chmm", "Problem 0.4", 4), ("chmm", "7. x", 7),
    ("farml", "T10 x", 10), ("farml", "I3 x", 13), ("farml", "R2/3 x", 26), ("farml", "TB2", 28), ("farml", "Tiebreaker event", None),
    ("farml", "Appendix to T8 x", None), ("farml_solutions", "Appendix to T8 x", 8), ("pumac", "Bonus: x", 0), ("pumac", "12 Across x", 1012), ("pumac", "7 down. x", 2007), ("pumac", "2 B11 x", 11), ("pumac", "4. x", 4),
    ("nimo", "3. *(Ann Lee)* x", 3), ("nimo", "3. (n = 2) x", None), ("nimo", "3. x", None), ("nimo_solutions", "8. x", 8), ("nimo_solutions", "9. x", None), ("grid", "3C. x", 13), ("bmt", "**LL28** 14. x", 14), ("mpfg_solutions", "**Problem 6", 6), ("mpfg_solutions", "6. x", None)])
def test_series_markers(spark, name, line, want):
    got = number(spark, name, line)
    assert (got and got[0]) == want


def test_problems(spark):
    docs = spark.createDataFrame([(1, "head\n1. one\nmore\n5) five\n3. kept in five"), (2, None), (3, ""), (4, "1. a\n2. b\n1. c")], "doc_id long, text string")
    got = lambda mode: {(r.doc_id, r.problem): r.text for r in segment.problems(docs, mode=mode).collect()}
    assert got("rising") == {(1, 1): "one\nmore", (1, 5): "five\n3. kept in five", (4, 1): "a", (4, 2): "b\n1. c"}
    assert got("restart")[(4, 3)] == "c"
    assert got("consecutive")[(1, 1)] == "one\nmore\n5) five\n3. kept in five"
    with pytest.raises(ValueError):
        segment.problems(docs, mode="none")


def expected_numbers(events, flat, strict, consecutive, backward, first):
    """Problem of each (number, heading) by the rules of sequence.numbered, one event at a time."""
    found, last, top, shift, heading = [], first, first or 0, 0, False
    for n, h in events:
        heading = heading or bool(h)
        found.append(None)
        if n is None:
            continue
        if last is not None and n < last and backward:
            found[-1] = n
        elif last is None or n > last:
            if consecutive and last is not None and n - last != 1:
                continue
            top, found[-1] = max(top, n), n + shift
        elif not flat and (heading or (not strict and (n == 1 or n < (first or 0)))):
            shift, top = shift + top, n
            found[-1] = n + shift
        else:
            continue
        last, heading = n, False
    return found


@pytest.mark.parametrize("layout", [{}, {"flat": True}, {"strict": True}, {"consecutive": True}, {"backward": True, "first": 4}, {"first": 3}, {"strict": True, "consecutive": True, "first": 2}])
def test_numbered(spark, layout):
    r = random.Random(7)
    runs = {k: [(r.choice([None, *range(1, 7)]), r.choice([True, False, False, False, None])) for _ in range(r.randint(1, 14))] for k in range(60)}
    rows = [(k, i, n, h) for k, events in runs.items() for i, (n, h) in enumerate(events)]
    got = {(x.k, x.i): x.problem for x in sequence.numbered(spark.createDataFrame(rows, "k int, i int, n int, h boolean"), ["k"], "i", "n", "h", **layout).collect()}
    full = {"flat": False, "strict": False, "consecutive": False, "backward": False, "first": None} | layout
    assert got == {(k, i): v for k, events in runs.items() for i, v in enumerate(expected_numbers(events, **full))}


def test_sections(spark):
    docs = spark.createDataFrame([(1, "1. a\n2. b\n# Round two\n2. c\n1. d")], "doc_id long, text string")
    got = {x.problem: x.text for x in segment.problems(docs, mode="sections", strict=True).collect()}
    assert got == {1: "a", 2: "b\n# Round two", 4: "c\n1. d"}


def test_solution_parts_and_completeness(spark):
    block = spark.createDataFrame([(1, "intro\nSolution 1\na\nSolution 2\nb")], "p int, text string")
    assert sorted((r.part, r.text) for r in segment.solution_parts(block, ["p"], "text", "^Solution").collect()) == [(1, "intro\na"), (2, "b")]
    found, want = spark.createDataFrame([("t", 1)], "test_id string, problem int"), spark.createDataFrame([("t", 1), ("t", 2)], "test_id string, problem int")
    assert segment.incomplete(found, want, "test_id").first()["missing"] == [2]


def test_answers(spark):
    rows = [("Answer: 7\nrest",), (r"so \boxed{3}",), ("thus the answer is 12.",), ("nothing",), ("Answer: a=b=c\nthe answer is 4.",)]
    got = [r.a and (r.a.answer, r.a.tier) for r in spark.createDataFrame(rows, "x string").select(text.answer_cascade(F.col("x")).alias("a")).collect()]
    assert got == [("7", "label"), ("3", "box"), ("12", "prose"), None, ("4", "prose")]
    one = lambda v, f: spark.createDataFrame([(v,)], "x string").select(f(F.col("x")).alias("y")).first()["y"]
    assert one("---\n**\nbody\n***", text.boundary_clean) == "body"
    assert one("Answer: 7\nSolution: do it", text.solution_body) == "do it"
    assert one("Answer: 7\nthen", text.solution_body) == "then"


def test_sources_and_sinks(spark, tmp_path):
    for name in ("2020/a/p10.txt", "2020/a/p9.txt", "2021/b/p1.txt"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("x")
    order = [r.path.rsplit("/", 1)[1] for r in files.pages(spark, str(tmp_path), "*.txt").where("folder LIKE '%/a'").orderBy("page_no").collect()]
    assert order == ["p9.txt", "p10.txt"]
    assert {r.test_id for r in files.tests(spark, str(tmp_path), "p1*.txt", 2).collect()} == {"2020_a", "2021_b"}
    lines = spark.createDataFrame([("number\tanswer",), ("1\t5",), ("2\t6\t7",)], "value string")
    assert [tuple(r) for r in files.tab_answers(lines).collect()] == [(1, "5")]
    rows = spark.createDataFrame([("t", 10, 'say "x"\n'), ("t", 2, "b"), ("t", 3, " ")], "test_id string, problem int, text string")
    made = sinks.problem_maps(rows)
    assert list(json.loads(made.first()["json"]).items()) == [("2", "b"), ("10", 'say "x"\n')]
    sinks.write_by_test(made, str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).count() == 1
    jobs = spark.createDataFrame([("a", "x", "1", "v1"), ("b", "x", "2", "v1"), ("c", "y", "3", "v1"), ("d", "z", "4", "v1")], "source string, target string, sha256 string, algorithm string")
    done = spark.createDataFrame([("y", "3", "v1"), ("z", "4", "v0")], "target string, sha256 string, algorithm string")
    assert {r.source: r.action for r in sinks.export_plan(jobs, done).collect()} == {"a": "collision", "b": "collision", "c": "skip", "d": "write"}
    with pytest.raises(Exception, match="no such page"):
        files.page_range(spark.createDataFrame([(1,)], "page int"), spark.createDataFrame([(2,)], "page int"), ["page"]).collect()
