"""What the findings of round 3 were about."""

from __future__ import annotations

import re
from difflib import SequenceMatcher

import numpy as np
from pyspark.sql import functions as F

from quire.functions import matching
from quire.llm import common
from quire.functions.series import Layout, series
from quire.operators import dedup, documents, expectations, layout
from quire.plans import registry
from quire.streaming import guard

FOLDER = "/root/testdata/sf0.001"


def shuffled(df):
    """Columns of the rows that a plan's shuffles carry."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return [line for line in plan.splitlines() if "Aggregate" in line or "Window" in line]


def test_keys_of_more_than_999_entries(spark):
    lines = "\n".join(f"{i}. a{i}" for i in range(1, 1203))
    cells = "\n".join(f"<td>{i}</td><td>a{i}</td>" for i in range(1, 1203))
    blocks = spark.createDataFrame([(1, lines), (2, cells)], "k long, text string")
    got = {(r["k"], r["number"], r["answer"]) for r in documents.key_answers(blocks, ["k"], digits=9).collect()}
    assert got == {(k, i, f"a{i}") for k in (1, 2) for i in range(1, 1203)}
    assert documents.key_answers(blocks, ["k"]).agg(F.max("number")).first()[0] == 999


def test_rules_of_pages_carry_no_texts(spark):
    pages = spark.createDataFrame([(1, "pumac", "solution", "Solution: x", "1. a\n2. b\nSolution: x\nAnswer: y")] * 2, "page_key long, series string, role string, text string, layer string")
    found = expectations.judged(pages, spark.createDataFrame([(1, 1)], "page_key long, problem int"))
    assert [(r["broken"], r["valid"]) for r in found.collect()] == [(["numbers", "labels"], False)]
    assert not any("max(text" in line or "max(layer" in line for line in shuffled(found))


def test_ladder_of_attempts_carries_no_texts(spark):
    assert not any("text#" in line for line in shuffled(registry.queries()["attempt_ladder"](spark, FOLDER)))
    attempts = spark.createDataFrame([(1, 1, "b"), (1, 1, "a"), (1, 2, "c"), (2, 1, None)], "page long, rung int, text string")
    got = {tuple(r) for r in documents.ladder(attempts, F.col("rung") == 1).collect()}
    assert got == {(1, 1, "a", "clean"), (2, 1, None, "clean")}


def test_scores_of_all_pairs_are_those_of_single_pairs(monkeypatch):
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(["a", "b1", "the", "of", "Root", "x", "zz"], n)) for n in (0, 1, 5, 40, 90, 250, 400)] + [None, "..."]
    texts += [texts[5], texts[6] + " more"]
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            x, y = matching.words(a), matching.words(b)
            ratio = SequenceMatcher(None, " ".join(x[:180]), " ".join(y[:180])).ratio()
            want = 0.7 * ratio + (1 - 0.7) * len(set(x) & set(y)) / len(set(x) | set(y)) if x and y else 0.0
            assert matching.match_scores(texts, texts)[i, j] == want == matching.match_score(a, b)
    read, words = [], matching.words
    monkeypatch.setattr(matching, "words", lambda x: read.append(x) or words(x))
    matching.match_scores(texts, texts)
    assert len(read) == 2 * len(texts)


def test_parts_of_a_table_grow_with_its_rows(spark):
    rows = spark.range(1000).withColumnRenamed("id", "k")
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert [registry.dealt(rows, "k", each).rdd.getNumPartitions() for each in (10, 1000)] == [100, least]


def test_kept_steps_of_dedup_are_files_that_go(spark):
    paths = []
    kept = dedup._kept(spark.range(5), paths)
    assert kept.count() == 5 and kept.inputFiles()[0].endswith(".parquet") and len(paths) == 1
    dedup._deleted(spark, paths)
    assert not spark.createDataFrame([(1,)], "a int").sparkSession._jvm.java.io.File(paths[0].removeprefix("file:")).exists()


def test_a_settled_driver_gives_native_memory_back(spark, monkeypatch):
    done, give = [], common.trim_jvm
    monkeypatch.setattr(common, "trim_jvm", lambda s: done.append(give(s)))
    common.settle(spark)
    assert done == [True]


def test_pages_of_a_stream_share_groups_and_states(spark, tmp_path):
    """Forty open pages are two states; each page's words are its own, over a restart too."""
    spark.conf.set(guard.PROVIDER, guard.ROCKS)
    rows = [(f"p{k}", i, "again and again " * 50 if k % 4 == 0 else f"{k} {i} {k * 7919 % 1009}. " * (i + 1), i == 3) for k in range(40) for i in range(4)]
    schema = "page_key string, seq long, chunk string, last boolean"
    try:
        for n, (lo, hi, states) in enumerate([(0, 2, 2), (2, 4, 0)]):
            spark.createDataFrame([r for r in rows if lo <= r[1] < hi], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            run = guard.write_guarded(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp"), buckets=2)
            assert run.awaitTermination(120)
            assert run.lastProgress["stateOperators"][0]["numRowsTotal"] == states
    finally:
        spark.conf.unset(guard.PROVIDER)
    got = {r["page_key"]: (r["chars"], r["runaway"]) for r in guard.last_words(spark, str(tmp_path / "out")).collect()}
    size = lambda k: sum(len(x[2]) for x in rows if x[0] == k)
    assert got == {k: (1600, True) if int(k[1:]) % 4 == 0 else (size(k), False) for k in {x[0] for x in rows}}


def test_boxes_of_answers_are_dealt_once(spark):
    """All joins of a page use the deal whose parts grow with the pages: no other shuffle has a fixed number of them."""
    name, was = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(name, "-1")
    try:
        plan = registry.queries()["answer_boxes"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(name, was)
    assert "REPARTITION_BY_NUM" in plan and "ENSURE_REQUIREMENTS" not in plan


def test_pages_without_tags_are_not_searched_for_them(monkeypatch):
    """A plain page costs no search for tags, and a line no look-up of patterns; what is read stays the same."""
    page, rules = "1. said 1\n3. said 2\n\n2. said 3", series("default")
    read = lambda x: layout.Reader(rules, Layout({"flat": True})).read(x)
    want = read(page + "\n<br/>")
    monkeypatch.setattr(layout, "IMAGE", None)
    monkeypatch.setattr(layout, "FURNITURE", None)
    monkeypatch.setattr(re, "match", None)
    assert read(page) == [("text", 1, "said 1"), ("text", 3, "said 2\n2. said 3")]
    assert want[0] == ("text", 1, "said 1")
