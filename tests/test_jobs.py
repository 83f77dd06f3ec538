from __future__ import annotations

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire import jobs
from quire.functions import guards, matching, text
from quire.functions.series import REGISTRY, series
from quire.operators import dedup, documents
from quire.sources import files
from quire.sources.commits import TestOutputs


def test_lifecycle(spark, tmp_path):
    """Cached pages to statements, solutions, answers and duplicates; a second run changes nothing, a forced one only its own tests."""
    root = str(tmp_path)
    same = "Find the number of ways in which seven knights can be placed on a board of nine squares"
    pages = [("cmimc", "2018_a", "statement", 1, f"CMIMC 2018\n1. {same}\n2. Next"), ("cmimc", "2018_a", "statement", 2, "more of two\n3. <img>fig</img> Last"), ("cmimc", "2018_b", "statement", 1, f"1. {same} again"),
             ("cmimc", "2018_a", "solution", 1, "1. " + same + "\nAnswer: $7$.\nSolution 1: so\nSolution 2: thus\n2. Answer: 9\nSolution: y\n8. Answer: 1\nSolution: z")]
    spark.createDataFrame([(*p, "") for p in pages], "series string, test_id string, role string, page_no int, markdown string, text_layer string").write.parquet(f"{root}/pages")
    command = lambda *a: jobs.run(spark, jobs.arguments().parse_args([*a, "--root", root, "--series", "cmimc"]))
    assert command("parse") == {"tests": 2, "written": 4}
    said = {(r.test_id, r.problem): r.text for r in spark.read.parquet(f"{root}/statements").collect()}
    assert said[("2018_a", 2)] == "Next\nmore of two" and said[("2018_a", 3)] == text.FIGURE + "\nLast"
    assert command("parse") == {"tests": 0, "written": 4}
    assert command("parse", "--force", "--test", "2018_b") == {"tests": 1, "written": 4}
    with pytest.raises(ValueError, match="no test"):
        command("parse", "--force", "--test", "none")
    assert command("solutions") == {"tests": 1, "written": 2}
    assert {r.problem: r.texts for r in spark.read.parquet(f"{root}/solutions").collect()} == {1: ["so", "thus"], 2: ["y"]}
    assert {(r.problem, r.answer, r.tier) for r in spark.read.parquet(f"{root}/answers").collect()} == {(1, "7", "label"), (2, "9", "label"), (8, "1", "label")}
    told = {r.test_id: json.loads(r.json) for r in TestOutputs(spark, f"{root}/problems/series=cmimc").read().collect()}
    assert {t: sorted(x) for t, x in told.items()} == {"2018_a": ["1", "2", "3"], "2018_b": ["1"]} and told["2018_a"]["2"] == "Next\nmore of two"
    cached = lambda *a: jobs.run(spark, jobs.arguments().parse_args(["cache", "--root", root, *a]))
    spark.createDataFrame([("p1", "x"), ("p2", "y")], "key string, value string").write.parquet(f"{root}/rows")
    assert cached("--rows", f"{root}/rows") == {"pages": 2} == cached("--compact")
    assert command("dedup", "--across") == {"groups": 1}
    assert command("dedup") == {"groups": 1}


def test_small_rules(spark, tmp_path):
    assert jobs.options("mandelbrot").temperature == 0.1 and jobs.options("mandelbrot", 0.4).temperature == 0.4
    assert (jobs.backoff(0), jobs.backoff(9), jobs.backoff(3, retry_after=2)) == (1000, 30_000, 2000)
    assert [jobs.source_kind(p) for p in (["a.pdf"], ["a.pdf", "b.PDF"], ["1.png", "2.jpg"])] == ["pdf", "batch", "images"]
    for paths, name in (([], None), (["a.pdf", "b.png"], None), (["a.txt"], None), (["a.pdf", "b.pdf"], "x")):
        with pytest.raises(ValueError):
            jobs.source_kind(paths, name)
    rows = spark.createDataFrame([(2, "b"), (1, "a")], "n int, t string")
    assert jobs.sidecar(rows, str(tmp_path / "s"), ["n", "t"]) and [r.n for r in spark.read.json(str(tmp_path / "s")).collect()] == [1, 2]
    assert not jobs.sidecar(rows.where("false"), str(tmp_path / "s"), ["n", "t"]) and not (tmp_path / "s").exists()


def test_cache_lookup(spark):
    loop = "the same words over and over again, once more from the start. " * 40
    cache = spark.createDataFrame([("a", "old", 1), ("a", "new", 2), ("b", loop, 1), ("c", "", 1)], "k string, v string, at int")
    hits, misses = files.cached(spark.createDataFrame([(x,) for x in "abcd"], "k string"), cache, "k", "v", "at")
    assert [tuple(r) for r in hits.select("k", "v").collect()] == [("a", "new")]
    assert {r.k for r in misses.collect()} == {"b", "c", "d"}


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_marker_column_and_value_agree(spark, name):
    r = random.Random(name)
    parts = ["1", "12", "3", "T", "T8", "I3", "R1/2", ".", ")", " ", "/", "-", "Problem ", "Question ", "Four", "Across", "Down", "A", "*(Ann Lee)*", "Do not look", "<b>", "TB", "Solution ", "x", "7. ", "2-1. ", "Bonus: "]
    lines = ["".join(r.choice(parts) for _ in range(r.randint(1, 5))) for _ in range(300)]
    got = spark.createDataFrame([(x,) for x in lines], "x string").select("x", series(name).marker(F.col("x")).alias("m")).collect()
    assert [x.m and (x.m["number"], x.m["end"]) for x in got] == [series(name).match(x.x) for x in got]


def test_pairs_against_brute_force(spark):
    """Shingle prefixes and sketches lose no pair."""
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcd") for _ in range(3))
    base = [[word() for _ in range(r.choice([12, 30, 80]))] for _ in range(12)]
    texts = []
    for _ in range(90):
        w = list(r.choice(base))
        for _ in range(r.randint(0, 3)):
            w[r.randrange(len(w))] = word()
        texts.append(" ".join(w))
    texts = list(dict.fromkeys(texts))
    df = spark.createDataFrame([("s" if i % 7 else "t", i, t) for i, t in enumerate(texts)], "scope string, id bigint, text string")
    got = {(x.a, x.b): round(x.similarity, 9) for x in dedup.similar_pairs(df, 0.7).collect()}
    sets, want = [{t[i : i + 4] for i in range(len(t) - 3)} for t in texts], {}
    for i in range(len(texts)):
        for j in range(i + 1, len(texts)):
            s = len(sets[i] & sets[j]) / len(sets[i] | sets[j])
            if (i % 7 == 0) == (j % 7 == 0) and s >= 0.7 and min(len(texts[i]), len(texts[j])) >= 40:
                want[i, j] = round(s, 9)
    assert got == want and len(want) > 20


def test_best_pairs_against_brute_force():
    from itertools import permutations

    r = np.random.default_rng(1)
    for _ in range(60):
        n, m = r.integers(1, 6, 2)
        table = r.random((n, m)).round(3)
        got = matching.best_pairs(table, 0.12)
        total = sum(table[i, j] for i, j in got)
        wide = np.zeros((max(n, m), max(n, m)))
        wide[:n, :m] = np.where(table >= 0.12, table, 0)
        assert abs(total - max(sum(wide[i, p[i]] for i in range(len(wide))) for p in permutations(range(len(wide))))) < 1e-9
        assert len({i for i, _ in got}) == len({j for _, j in got}) == len(got)


def test_texts_of_any_length(spark):
    long = "![" + "a" * 100_000 + "](x) y " + "![" * 20_000
    row = spark.createDataFrame([(long,)], "x string").select(text.normalize(F.col("x")).alias("n")).first()
    assert row.n == "y"
    assert guards.is_runaway("intro " + (" ".join(f"w{i}" for i in range(70)) + " ") * 8)
    assert not guards.is_runaway("x" * 10 + "=" * 47) and not guards.is_runaway(" ".join(str(i * 7919 % 10007) for i in range(900)))


def test_recovered_statements(spark):
    rows = [("d", 1, 0, "one"), ("d", 1, 1, "Solution 1"), ("d", 1, 2, "a"), ("d", 1, 3, "Solution 1"), ("d", 1, 4, "b"), ("d", 3, 5, "three")]
    df = spark.createDataFrame(rows, "doc string, problem int, pos int, text string")
    got = {(x.pos, x.problem) for x in documents.recovered_statements(df, "^Solution 1$").collect()}
    assert got == {(0, 1), (1, 1), (2, 1), (3, 2), (4, 2), (5, 3)}
