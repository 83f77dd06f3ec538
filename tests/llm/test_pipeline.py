from __future__ import annotations

import random
import re

import corpus_pipeline
from pyspark.sql import functions as F

from quire.llm import common
from quire.llm.packing import word_count

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def corpus():
    """(id, text, lang): prose of two languages, copies, near copies, a shared passage, personal data, and odd rows."""
    r = random.Random(4)
    english = "the of and to in is that for it was with as his on be at by this had not are but from or have an they which one you were all her she there would their we him been has when who will no more if out so".split()
    french = "le de un être et à il avoir ne je son que se qui ce dans en du elle au pour pas sur on avec tout faire mettre autre mais nous comme ou si leur y dire devoir avant deux même prendre aussi celui donner bien où fois vous".split()
    prose = lambda words, n: " ".join(r.choice(words) + r.choice(["", "", "s"]) for _ in range(n))
    rows = [(i, prose(english if i % 3 else french, 80), "en" if i % 3 else "fr") for i in range(40)]
    rows += [(40, rows[4][1], "en"), (41, rows[5][1] + " changed", "en")]
    passage = "\n".join(prose(english, 15) for _ in range(3))
    rows += [(50, prose(english, 60) + "\n" + passage, "en"), (51, prose(english, 60) + "\n" + passage, "en"), (52, passage, "en")]
    rows += [(60, prose(english, 40) + " mail anna.b@mail.example.org, Mr. John Smith and Smith", "en")]
    return rows + [(70, None, "en"), (71, "", None), (72, "123 !!!", "en")], passage


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], DOCS).withColumns({c: F.lit(c) for c in ("score", "held_out", "n_lines", "n_deleted", "kinds", "kept", "row")})


def test_stages_one_by_one(spark):
    rows, passage = corpus()
    docs = frame(spark, rows).repartition(3)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "lines", "near_duplicates", "surrogates", "packing"]
    stage = dict(corpus_pipeline.STAGES)
    texts = {i: t for i, t, _ in rows}
    for name, gone, changed in (
        ("language", {70, 71, 72}, {}),
        ("lines", {40, 52}, {51: texts[51].removesuffix("\n" + passage)}),
        ("near_duplicates", {41}, {}),
        ("surrogates", set(), None),
    ):
        was = {x["doc_id"]: x["text"] for x in docs.collect()}
        out = common.saved(stage[name](spark, docs, ""), name)
        assert out.columns == docs.columns
        now = {x["doc_id"]: x["text"] for x in out.collect()}
        if changed is None:
            new = now.pop(60)
            assert "John" not in new and "Smith" not in new and "anna.b" not in new and re.search(r"\S+@mail\.example\.org, Mr\. (\w+) (\w+) and \2$", new)
            was.pop(60)
            changed = {}
        assert now == {i: changed.get(i, t) for i, t in was.items() if i not in gone}
        if name in ("lines", "surrogates"):
            assert all(x["n_chars"] == len(x["text"]) for x in out.collect())
        docs = out
    words = {x["doc_id"]: x["n"] for x in docs.select("doc_id", word_count(F.col("text")).alias("n")).collect()}
    packed = stage["packing"](spark, docs, "").collect()
    assert {x["doc_id"]: x["n_tokens"] for x in packed} == words


def test_run_and_empty_table(spark, tmp_path):
    rows, _ = corpus()
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(x["doc_id"] for x in got.collect()) == sorted(set(range(40)) | {50, 51, 60})
    frame(spark, rows).where("false").write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
