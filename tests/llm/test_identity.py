from __future__ import annotations

import os
import random
import threading

import pytest
from pyspark.sql import functions as F

from quire.llm import common, line_dedup, ngram_join

DOCS = "doc_id bigint, text string"


def test_an_id_with_several_texts_keeps_all_its_links(spark):
    r = random.Random(7)
    a, b, c = (" ".join(f"w{r.randrange(10**6)}" for _ in range(60)) for _ in range(3))
    rows = [(5, a), (5, b), (7, b + " more"), (8, a + " more"), (9, c)]
    got = {(x["doc_id"]): (x["class_id"], x["class_size"], x["n_links"]) for x in ngram_join.near_duplicates(spark.createDataFrame(rows, DOCS).repartition(3)).collect()}
    assert got == {5: (5, 4, 1), 7: (5, 4, 1), 8: (5, 4, 1), 9: (9, 1, 0)}
    left = ngram_join.drop_near_duplicates(spark.createDataFrame(rows, DOCS)).select("doc_id").collect()
    assert sorted(x["doc_id"] for x in left) == [5, 9]


def test_row_keys_have_128_bits_and_tell_nulls_apart(spark):
    rows = [(1, "a"), (1, None), (None, "a"), (None, None), (1, ""), (11, "a"), (1, "1a"), (1, "a")]
    keys = [bytes(x["k"]) for x in spark.createDataFrame(rows, DOCS).select(common.row_key("doc_id", "text").alias("k")).collect()]
    assert {len(k) for k in keys} == {16} and len(set(keys)) == 7 and keys[0] == keys[-1]


def test_runs_in_one_driver_keep_their_own_scratch(spark):
    seen, wait = {}, threading.Barrier(2)

    def work(name):
        with common.scratch_run() as paths:
            df = common.saved(spark.range(5).withColumn("name", F.lit(name)), name)
            wait.wait()
            seen[name] = list(paths)
            if name == "one":
                common.release(spark, paths)
            wait.wait()
            seen[name, "rows"] = df.count() if name == "two" else len(paths)

    threads = [threading.Thread(target=work, args=(n,)) for n in ("one", "two")]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(seen["one"]) == len(seen["two"]) == 1 and not os.path.exists(seen["one"][0])
    assert seen["one", "rows"] == 0 and seen["two", "rows"] == 5


def test_patience_decides_where_lines_are_unique(monkeypatch):
    """Plain, moved and repeated passages need no automaton; without patience diff nothing of this is found."""
    a = [f"l{i}" for i in range(40)]
    b = a[20:32] + ["x"] + a[:9] + ["y"] + a[20:30] + ["z"]
    words = [5] * len(b)
    want = [k for k, x in enumerate(b) if x in set(a)]
    monkeypatch.setattr(line_dedup, "copied_runs", lambda *x: pytest.fail("automaton"))
    monkeypatch.setattr(line_dedup, "_stretches", lambda *x: [])
    assert line_dedup.common_blocks(a, b, words, 25) == want
    monkeypatch.setattr(line_dedup, "align", lambda *x: [])
    assert line_dedup.common_blocks(a, b, words, 25) == []


def test_automaton_is_for_lines_that_repeat(monkeypatch):
    a = ["p", "q", "p", "q", "p", "q", "s", "t", "u"]
    b = ["q", "p", "q", "n", "s", "t", "u"]
    words = [10] * len(b)
    assert line_dedup.common_blocks(a, b, words, 25) == [0, 1, 2, 4, 5, 6]
    monkeypatch.setattr(line_dedup, "copied_runs", lambda *x: [])
    assert line_dedup.common_blocks(a, b, words, 25) == [4, 5, 6]


def test_blocks_equal_runs_of_an_earlier_text():
    r = random.Random(2)
    for _ in range(1500):
        a = [r.choice("abcdefgh") for _ in range(r.randint(0, 14))]
        b = [r.choice("abcdefghi") for _ in range(r.randint(0, 14))]
        words = [r.randint(1, 12) for _ in b]
        want = set()
        for i in range(len(b)):
            for z in range(i + 1, len(b) + 1):
                if sum(words[i:z]) >= 15 and any(a[k : k + z - i] == b[i:z] for k in range(len(a))):
                    want.update(range(i, z))
        assert line_dedup.common_blocks(a, b, words, 15) == sorted(want)


def test_a_collection_of_many_documents_passages(spark):
    """One later document that holds a passage of each of 300 others."""
    own = ["\n".join(f"d{i} line {j} of this document has some words" for j in range(5)) for i in range(300)]
    rows = [*enumerate(own), (1000, "\n".join(own)), (1001, "clean " * 40)]
    got = {x["doc_id"]: x["n_deleted"] for x in line_dedup.line_dedup(spark.createDataFrame(rows, DOCS).repartition(3)).collect()}
    assert got.pop(1000) == 1500 and set(got.values()) == {0}
