"""Sinks: one JSON object per test, sidecars that vanish when empty, and planned exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import boundary_clean


def problem_maps(rows: DataFrame, test: str = "test_id", problem: str = "problem", text: str = "text") -> DataFrame:
    """test, n, json: texts by problem number in rising order; blank texts are not written."""
    held = rows.where(F.length(F.trim(text)) > 0).groupBy(test).agg(F.array_sort(F.collect_list(F.struct(F.col(problem).alias("p"), F.col(text).alias("t")))).alias("e"))
    entry = F.transform("e", lambda x: F.concat(F.to_json(F.array(x["p"].cast("string"))).substr(F.lit(2), F.length(F.to_json(F.array(x["p"].cast("string")))) - 2), F.lit(": "), F.to_json(F.array(x["t"])).substr(F.lit(2), F.length(F.to_json(F.array(x["t"]))) - 2)))
    return held.select(test, F.size("e").cast("long").alias("n"), F.concat(F.lit("{"), F.array_join(entry, ", "), F.lit("}")).alias("json"))


def solution_lists(rows: DataFrame, test: str = "test_id", problem: str = "problem", texts: str = "texts") -> DataFrame:
    """Solutions cleaned at their edges, empty ones out; problems left without any do not appear."""
    clean = F.filter(F.transform(texts, boundary_clean), lambda x: x != "")
    return rows.select(test, problem, clean.alias(texts)).where(F.size(texts) > 0)


def write_by_test(maps: DataFrame, path: str, test: str = "test_id") -> None:
    """Each test's JSON in its own folder; tests not in `maps` keep what they have, so a rerun changes only its own."""
    maps.select(test, "json").repartition(test).write.partitionBy(test).option("partitionOverwriteMode", "dynamic").mode("overwrite").text(path)


def todo(tests: DataFrame, done: DataFrame, key: str = "test_id", force: bool = False) -> DataFrame:
    """Tests still to do: all of them under force, else those without output."""
    return tests if force else tests.join(done.select(key).distinct(), key, "left_anti")


def orphans(have: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """What lies in the destination and is no longer expected."""
    return have.join(expected.select(key), key, "left_anti")


def export_plan(jobs: DataFrame, done: DataFrame, force: bool = False) -> DataFrame:
    """source, target, action: `collision` when several sources share a target, `skip` when the target was made of
    the same bytes by the same algorithm, else `write`."""
    shared = jobs.groupBy("target").agg(F.count_distinct("source").alias("__sources"))
    was = done.select("target", F.col("sha256").alias("__sha"), F.col("algorithm").alias("__algorithm"))
    same: Column = (F.col("sha256") == F.col("__sha")) & (F.col("algorithm") == F.col("__algorithm")) & ~F.lit(force)
    action = F.when(F.col("__sources") > 1, "collision").when(same, "skip").otherwise("write")
    return jobs.join(shared, "target").join(was, "target", "left").select("source", "target", action.alias("action"))


def collisions(jobs: DataFrame, target: str = "target", source: str = "source") -> DataFrame:
    """target, sources: targets that several sources would be written to."""
    return jobs.groupBy(target).agg(F.count_distinct(source).alias("sources")).where("sources > 1")
