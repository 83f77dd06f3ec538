"""Sources: folder scans, key files, JSON maps, page ranges and a read-through cache, all as DataFrames."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.guards import runaway
from quire.functions.series import DISCOVERY, IGNORED

# Fixed value: what one component of an output path may look like.
SAFE_NAME = r"^[A-Za-z0-9][A-Za-z0-9._-]*$"


def stem(path: Column) -> Column:
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")


def natural_key(path: Column) -> Column:
    """Numbers of the file name, so that page 10 sorts after page 9."""
    return F.transform(F.regexp_extract_all(stem(path), F.lit(r"\d+"), F.lit(0)), lambda x: x.cast("long"))


def is_safe(name: Column) -> Column:
    return F.coalesce(name.rlike(SAFE_NAME), F.lit(False))


def files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """path, length, modified of every file under root that fits the glob; contents are not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(root)
    return found.select("path", "length", F.col("modificationTime").alias("modified"))


def tests(spark: SparkSession, root: str, glob: str, parts: int, ignored: list[str] = ()) -> DataFrame:
    """test_id, path: one row per source file; the id joins the last `parts` folder names (0: the file's own stem).
    Ids holding an ignored substring, whatever its case, do not appear."""
    split = F.split("path", "/")
    named = F.array_join(F.slice(split, F.size(split) - parts, parts), "_") if parts else stem(F.col("path"))
    out = files(spark, root, glob).select(named.alias("test_id"), "path")
    for word in ignored:
        out = out.where(~F.contains(F.lower("test_id"), F.lit(word.lower())))
    return out


def discovered(paths: DataFrame, root: str, name: str, path: str = "path") -> DataFrame:
    """test_id, path of a series' tests among file paths, by its discovery rules; ignored ids do not appear."""
    found = None
    start = F.instr(path, root.rstrip("/") + "/") + len(root.rstrip("/"))
    for rule in DISCOVERY[name]:
        rel = F.regexp_replace(F.col(path).substr(start + 1, F.length(path)), "^out/", "")
        pattern = "^" + re.escape(rule.glob).replace(r"\*\*/", "(?:.*/)?").replace(r"\*", "[^/]*") + "$"
        folders = F.slice(F.split(rel, "/"), 1, F.size(F.split(rel, "/")) - 1)
        own = folders if rule.parts is None else F.slice(folders, F.greatest(F.size(folders) - rule.parts + 1, F.lit(1)), rule.parts)
        last = stem(F.col(path)) if rule.stem else F.element_at(folders, -1)
        rows = paths.where(rel.rlike(pattern)).where(last.isin(*rule.only) if rule.only else ~last.isin(*rule.never) if rule.never else F.lit(True))
        rows = rows.select(F.array_join(F.concat(own, F.array(stem(F.col(path)))) if rule.stem else own, "_").alias("test_id"), path)
        found = rows if found is None else found.unionByName(rows)
    for word in IGNORED.get(name, []):
        found = found.where(~F.contains(F.lower("test_id"), F.lit(word)))
    return found


# Files that hold a whole contest, the first there counts; parts beside which solutions are no contest; what is never a part.
WHOLE = ["packet", "test", "0514"]
SPLIT = ["team", "indy"]
NO_PART = ["answers", "solutions", "solution", "packet", "test"]


def by_year(paths: DataFrame, root: str, path: str = "path") -> DataFrame:
    """test_id, path of tests in folders of years right below root: the file of the whole contest; else its solutions, where
    it has no parts; else every part, with its name."""
    year = F.regexp_extract(path, "^" + re.escape(root.rstrip("/")) + r"/([^/]+)/[^/]+\.pdf$", 1)
    held = paths.select(year.alias("year"), stem(F.col(path)).alias("name"), F.col(path).alias("path")).where("year <> ''").distinct()
    rank = F.coalesce(*[F.when(F.col("name") == n, F.lit(i)) for i, n in enumerate(WHOLE)])
    whole = held.groupBy("year").agg(F.min(F.struct(rank.alias("r"), "path")).alias("w"), F.min(F.when(rank.isNotNull(), F.struct(rank.alias("r"), "path"))).alias("best"), F.max((F.col("name") == "solutions").cast("int")).alias("told"), F.max(F.col("name").isin(*SPLIT).cast("int")).alias("split")).drop("w")
    rows = held.join(whole, "year")
    alone = F.col("best").isNull() & (F.col("told") == 1) & (F.col("split") == 0)
    take = F.when(F.col("best").isNotNull(), F.col("path") == F.col("best.path")).when(alone, F.col("name") == "solutions").otherwise(~F.lower("name").isin(*NO_PART))
    part = F.col("best").isNull() & ~alone
    return rows.where(take).select(F.when(part, F.concat_ws("_", "year", "name")).otherwise(F.col("year")).alias("test_id"), "path")


def beside(tests: DataFrame, paths: DataFrame, file: str, path: str = "path") -> DataFrame:
    """tests with `source`: the file of that name in a test's folder, null without one."""
    folder = F.regexp_replace(path, "/[^/]*$", "")
    there = paths.where(F.element_at(F.split(path, "/"), -1) == file).select(folder.alias("__folder"), F.col(path).alias("source"))
    return tests.withColumn("__folder", folder).join(there, "__folder", "left").drop("__folder")


def with_problems(paths: DataFrame, root: str, path: str = "path") -> DataFrame:
    """test, path of folders right below root that hold problems.json, but for those that begin with `_`."""
    name = F.regexp_extract(path, re.escape(root.rstrip("/")) + r"/([^/_][^/]*)/problems\.json$", 1)
    return paths.select(name.alias("test"), path).where("test <> ''").orderBy("test")


def pages(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """folder, page_no, path: page files of each folder in natural order."""
    folder = F.regexp_replace("path", "/[^/]*$", "")
    held = files(spark, root, glob).groupBy(folder.alias("folder")).agg(F.array_sort(F.collect_list(F.struct(natural_key(F.col("path")).alias("k"), "path"))).alias("all"))
    return held.select("folder", F.posexplode("all").alias("page_no", "x")).select("folder", "page_no", F.col("x.path").alias("path"))


def page_range(have: DataFrame, wanted: DataFrame, on: list[str]) -> DataFrame:
    """The wanted pages; a page that does not exist is an error when the row is read."""
    hit = wanted.select(*on).join(have.withColumn("__hit", F.lit(True)), on, "left")
    missing = F.when(F.col("__hit").isNull(), F.raise_error(F.concat_ws(" ", F.lit("no such page:"), *[F.col(c).cast("string") for c in on])))
    return hit.where(F.coalesce(missing.cast("boolean"), F.lit(True))).drop("__hit")


def tab_answers(lines: DataFrame, line: str = "value") -> DataFrame:
    """problem, answer of lines with exactly two tabbed fields, the first a number (which leaves the header out)."""
    cut = F.split(line, "\t", -1)
    rows = lines.where(F.size(cut) == 2).withColumn("__n", F.trim(cut[0])).where(F.col("__n").rlike(r"^\d+$"))
    return rows.select(*[c for c in lines.columns if c != line], F.col("__n").cast("int").alias("problem"), F.trim(cut[1]).alias("answer"))


def spaced_answers(lines: DataFrame, line: str = "value") -> DataFrame:
    """problem, answer: the first two words of each line that begins with a number."""
    words = F.regexp_extract_all(F.col(line), F.lit(r"\S+"), F.lit(0))
    rows = lines.where((F.size(words) >= 2) & F.get(words, F.lit(0)).rlike(r"^\d+$"))
    return rows.select(*[c for c in lines.columns if c != line], F.get(words, F.lit(0)).cast("int").alias("problem"), F.get(words, F.lit(1)).alias("answer"))


def json_map(docs: DataFrame, text: str = "value") -> DataFrame:
    """key, value rows of JSON objects; invalid or empty JSON gives none."""
    kept = [c for c in docs.columns if c != text]
    return docs.select(*kept, F.explode(F.from_json(text, "map<string,string>")).alias("key", "value"))


def cached(wanted: DataFrame, cache: DataFrame, key: str, value: str, order: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(hits with the cached value, misses).  Of several values the one with the largest `order` (else the largest)
    counts; an empty one and one that runs away are misses."""
    good = cache.where(F.length(value) > 0).groupBy(key).agg(F.max_by(value, order or value).alias(value))
    good = good.where(~runaway(value))
    return wanted.join(good, key), wanted.join(good, key, "left_anti")
