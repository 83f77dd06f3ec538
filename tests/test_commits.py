from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from quire.operators import export, sinks
from quire.sources import files
from quire.sources.commits import Commits, Conflict, PageCache, TestOutputs


def held(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def rows(spark, *pairs, schema="key string, value string"):
    return spark.createDataFrame(list(pairs), schema)


def test_cache_last_batch_wins(spark, tmp_path):
    cache = PageCache(spark, str(tmp_path / "c"))
    assert cache.read().count() == 0
    assert [cache.append(rows(spark, ("a", "1"), ("b", "1"))), cache.append(rows(spark, ("b", "2"), ("c", "2")))] == [1, 2]
    want = [("a", "1"), ("b", "2"), ("c", "2")]
    assert held(cache.read(), "key", "value") == want
    assert cache.compact() == 3 and held(cache.read(), "key", "value") == want
    cache.append(rows(spark, ("a", "4"), (None, "x")))
    assert held(cache.read().where("key IS NOT NULL"), "key", "value") == [("a", "4"), *want[1:]]
    assert len(cache.clean()) == 2 and held(cache.read().where("key = 'a'"), "key", "value") == [("a", "4")]
    hits, misses = files.cached(spark.createDataFrame([("a",), ("z",)], "key string"), cache.read(), "key", "value", "version")
    assert held(hits, "key", "value") == [("a", "4")] and held(misses, "key") == [("z",)]


def test_cache_after_a_crash(spark, tmp_path, monkeypatch):
    """A writer that dies between data and marker changes nothing, nor does a marker torn in the middle."""
    cache = PageCache(spark, str(tmp_path / "c"))
    cache.append(rows(spark, ("a", "1")))

    def die(self, version, said):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(Commits, "commit", die)
        with pytest.raises(KeyboardInterrupt):
            cache.append(rows(spark, ("a", "lost")))
    assert held(cache.read(), "key", "value") == [("a", "1")]
    (tmp_path / "c/_commits/00000002.json").write_text('{"fold')
    assert held(cache.read(), "key", "value") == [("a", "1")]
    assert cache.append(rows(spark, ("a", "3"))) == 3
    assert len(cache.clean()) == 1 and held(cache.read(), "key", "value") == [("a", "3")]


def test_cache_with_another_writer(spark, tmp_path, monkeypatch):
    cache, other = PageCache(spark, str(tmp_path / "c")), PageCache(spark, str(tmp_path / "c"))
    cache.append(rows(spark, ("a", "1")))
    real, done = Commits.commit, []

    def late(self, version, said):
        if not done:
            done.append(1)
            other.append(rows(spark, ("a", "2"), ("b", "2")))
        real(self, version, said)

    monkeypatch.setattr(Commits, "commit", late)
    assert cache.append(rows(spark, ("a", "3"))) == 3
    assert held(cache.read(), "key", "value") == [("a", "3"), ("b", "2")]
    done.clear()
    with pytest.raises(Conflict):
        cache.compact()
    assert held(cache.read(), "key", "value") == [("a", "2"), ("b", "2")]


def maps(spark, **texts):
    df = spark.createDataFrame([(t, i, x) for t, own in texts.items() for i, x in enumerate(own)], "test_id string, problem int, text string")
    return sinks.problem_maps(df)


def told(out):
    return {r["test_id"]: list(json.loads(r["json"]).values()) for r in out.read().collect()}


def test_outputs_change_all_at_once(spark, tmp_path, monkeypatch):
    out = TestOutputs(spark, str(tmp_path / "o"))
    assert told(out) == {}
    out.publish(maps(spark, a=["x", "y"], b=["z"]))
    with monkeypatch.context() as m:  # killed between the data and the marker
        m.setattr(Commits, "commit", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            out.publish(maps(spark, a=["half"]))
    assert told(out) == {"a": ["x", "y"], "b": ["z"]}
    assert out.publish(maps(spark, a=["new"]), removed=spark.createDataFrame([("b",)], "test_id string")) == 2
    assert told(out) == {"a": ["new"]}
    back = files.json_map(out.read().withColumnRenamed("json", "value"))
    assert held(back.select("test_id", "key", F.col("value").alias("v")), "test_id", "key", "v") == [("a", "0", "new")]
    assert len(out.clean()) == 1 and told(out) == {"a": ["new"]}


def test_two_writers_of_outputs(spark, tmp_path):
    one, two = TestOutputs(spark, str(tmp_path / "o")), TestOutputs(spark, str(tmp_path / "o"))
    base = one.version()
    two.publish(maps(spark, a=["two"]))
    with pytest.raises(Conflict):
        one.publish(maps(spark, a=["one"]), base=base)
    assert told(one) == {"a": ["two"]}


def test_export_goes_on_over_a_broken_file(spark, tmp_path):
    src, dst = tmp_path / "src", tmp_path / "dst"
    src.mkdir()
    (dst / "old").mkdir(parents=True)
    for n in "ab":
        (src / f"{n}.png").write_bytes(n.encode() * 3_000_000)
    (src / "bad.png").mkdir()
    (dst / "old/gone.png").write_bytes(b"x")
    jobs = spark.createDataFrame([(str(src / s), str(dst / t), "h", "v1") for s, t in [("a.png", "x/a.png"), ("b.png", "b.png"), ("bad.png", "bad.png"), ("none.png", "none.png"), ("a.png", "twice"), ("b.png", "twice")]], "source string, target string, sha256 string, algorithm string")
    plan = sinks.export_plan(jobs, jobs.where("false").select("target", "sha256", "algorithm"))
    orphans = spark.createDataFrame([(str(dst / "old/gone.png"),)], "target string")
    dry = export.carry_out(plan, orphans, dry_run=True)
    assert not any(r["done"] for r in dry.collect()) and sorted(os.listdir(dst)) == ["old"]
    report = export.carry_out(plan, orphans).cache()
    found = {os.path.relpath(r["target"], dst): (r["action"], r["done"], r["error"] is None) for r in report.collect()}
    assert found == {"x/a.png": ("write", True, True), "b.png": ("write", True, True), "bad.png": ("write", False, False), "none.png": ("write", False, False), "twice": ("collision", False, True), "old/gone.png": ("delete", True, True)}
    assert (dst / "x/a.png").read_bytes() == b"a" * 3_000_000 and not (dst / "old/gone.png").exists()
    assert sorted(p.name for p in dst.rglob("*") if p.is_file()) == ["a.png", "b.png"]
    assert held(export.summary(report), "action", "n", "done", "failed") == [("collision", 2, 0, 0), ("delete", 1, 1, 0), ("write", 4, 2, 2)]
    report.unpersist()
