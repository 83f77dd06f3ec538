from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quire.functions import guards, text
from quire.operators import dedup, sequence


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "x string").select(expr(F.col("x")).alias("y")).first()["y"]


def test_marker(spark):
    assert one(spark, "1/3/37. x", text.marker)["number"] == 37
    assert one(spark, "Problem 12 foo", text.marker)["number"] == 12
    assert one(spark, "no marker", text.marker) is None
    assert one(spark, "7) rest", text.strip_marker) == "rest"


def test_key_entries(spark):
    assert [(e["number"], e["answer"]) for e in one(spark, "1. 5   5. 3025", text.key_entries)] == [(1, "5"), (5, "3025")]
    assert one(spark, "12.5", text.key_entries) == []
    assert one(spark, "2023. x", text.key_entries) == []


def test_shingles_and_jaccard(spark):
    assert one(spark, "abcabc", lambda x: text.shingles(x, 4)) == ["abca", "bcab", "cabc"]
    assert one(spark, "abc", lambda x: text.shingles(x, 4)) == ["abc"]
    assert one(spark, "", lambda x: text.shingles(x, 4)) == []


def test_normalize(spark):
    assert one(spark, "A ![](fig/(draft)/p.png) \\quad B<img src=x> C!", text.normalize) == "a b c"


def test_boxed_and_answers(spark):
    assert one(spark, r"\boxed{1} and \boxed{\frac{1}{2}} x", text.last_boxed) == r"\frac{1}{2}"
    assert one(spark, r"\frac{1}{2}", text.answer_form) != one(spark, "1/2", text.answer_form)
    assert one(spark, r"2\pi", text.answer_form) == one(spark, "2", text.answer_form)


def test_guards():
    assert guards.is_runaway("x" * 900 + "_" * 400)
    assert not guards.is_runaway("x y z " * 3 + "_" * 100)
    assert guards.is_runaway(" ".join(f"then to point {i}" for i in range(21)))
    assert guards.is_runaway("The numbers are written in the dodecagon again and so on. " * 40)
    assert not guards.is_runaway(None)


def test_folds(spark):
    def run(f, numbers):
        df = spark.createDataFrame([("d", i, n) for i, n in enumerate(numbers)], "doc string, i int, n int")
        return [r[-1] for r in f(df).orderBy("i").collect()]

    assert run(lambda d: sequence.restarting(d, ["doc"], "i", "n"), [1, 2, 1, 3]) == [1, 2, 3, 5]
    assert run(lambda d: sequence.consecutive(d, ["doc"], "i", "n"), [1, 2, 7, 3]) == [1, 1, 0, 1]
    assert run(lambda d: sequence.rising(d, ["doc"], ["i"], "n"), [1, 2, 1, 3]) == [True, True, False, True]


def test_duplicate_groups_chain(spark):
    base = "the quick brown fox jumps over the lazy dog while seven wizards wait near the old stone bridge at dawn "
    rows = [("s", 1, base * 2), ("s", 2, base * 2 + "and leave"), ("s", 3, "something else entirely, long enough to have its own shingles here"), ("s", 4, base * 2)]
    got = dedup.duplicate_groups(spark.createDataFrame(rows, "scope string, id bigint, text string")).collect()
    assert [(g["members"], g["ids"]) for g in got] == [(3, [1, 2, 4])]


def test_entry_without_llm(spark, tmp_path):
    import __spark_entry__

    assert __spark_entry__.queries()
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", ["seg_restart", "asof_owner", "union_area"])
def test_registry_runs(spark, name):
    from quire.plans import registry

    assert registry.queries()[name](spark, "/root/testdata/sf0.001").count() > 0
