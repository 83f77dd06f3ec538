"""Queries over whole jobs, page rules and discovery, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire import jobs
from quire.functions.series import DISCOVERY
from quire.operators import sequence
from quire.plans.pages import FLAT, TURNS, turns
from quire.plans.registry import query, table
from quire.sources import files

def cached(spark: SparkSession, d: str) -> DataFrame:
    """Conversations as tests of two problems a page, each page with a line that runs along."""
    line = F.concat(F.when(F.col("i") % 2 == 1, F.lit("Spring 2018\n")).otherwise(""), F.col("i").cast("string"), F.lit(". "), "text")
    rows = turns(spark, d).withColumns({"line": line, "page_no": F.floor((F.col("i") - 1) / 2)})
    pages = sequence.joined(rows, ["conv_id", "page_no"], "i", "line", "markdown")
    return pages.select(F.lit("omo").alias("series"), F.col("conv_id").cast("string").alias("test_id"), "page_no", "markdown", F.lit("text").alias("text_layer"))


@query(f"SELECT CAST(conv_id AS VARCHAR) AS test_id, i AS problem, {FLAT} AS text FROM ({TURNS}) t")
def job_parse(spark: SparkSession, d: str) -> DataFrame:
    """Cached pages to statements."""
    return jobs.parse(cached(spark, d), "omo").select("test_id", "problem", "text")


def solved(spark: SparkSession, d: str) -> DataFrame:
    line = F.concat(F.col("i").cast("string"), F.lit(". restated\nAnswer: $"), (F.col("i") * 7).cast("string"), F.lit("$.\nSolution 1: begin\n"), "text")
    pages = sequence.joined(turns(spark, d).withColumn("line", line), ["conv_id"], "i", "line", "markdown")
    return pages.select(F.lit("cmimc").alias("series"), F.col("conv_id").cast("string").alias("test_id"), F.lit(0).alias("page_no"), "markdown", F.lit("").alias("text_layer"))


@query(f"SELECT CAST(conv_id AS VARCHAR) AS test_id, i AS problem, CAST(i * 7 AS VARCHAR) AS answer, 'label' AS tier FROM ({TURNS}) t")
def job_answers(spark: SparkSession, d: str) -> DataFrame:
    """Cached pages of solutions to answers."""
    return jobs.answer_table(solved(spark, d), "cmimc").select("test_id", "problem", "answer", "tier")


@query(f"SELECT CAST(conv_id AS VARCHAR) AS test_id, i AS problem, 'begin' || chr(10) || {FLAT} AS text, CAST(1 AS BIGINT) AS n FROM ({TURNS}) t WHERE i <> 2")
def job_solutions(spark: SparkSession, d: str) -> DataFrame:
    """Cached pages to the bodies of solutions; numbers that no statement has are left out."""
    known = turns(spark, d).where("i <> 2").select(F.lit("cmimc").alias("series"), F.col("conv_id").cast("string").alias("test_id"), F.col("i").cast("long").alias("problem"))
    return jobs.solutions(solved(spark, d), "cmimc", known).select("test_id", "problem", F.array_join("texts", "|").alias("text"), F.size("texts").cast("long").alias("n"))


@query("SELECT conv_id, min(turn) AS problem FROM conversations WHERE turn % 2 = 1 GROUP BY conv_id")
def job_to_solve(spark: SparkSession, d: str) -> DataFrame:
    """The first problem of each test that is not solved."""
    rows = table(spark, d, "conversations").select(F.lit("x").alias("series"), F.col("conv_id").alias("test_id"), F.col("turn").alias("problem"), "text")
    known = rows.select("series", "test_id", "problem", F.lit("5").alias("answer"))
    return jobs.to_solve(rows, rows.where("problem % 2 = 0"), known, 1).select(F.col("test_id").alias("conv_id"), "problem")


@query("SELECT p_partkey AS k, CASE p_partkey % 4 WHEN 0 THEN 'match' WHEN 1 THEN 'mismatch' WHEN 2 THEN 'derived' ELSE 'no answer' END AS verdict FROM part")
def solver_checks(spark: SparkSession, d: str) -> DataFrame:
    kind = F.col("p_partkey") % 4
    said = F.when(kind == 3, F.lit("no box")).otherwise(F.concat(F.lit(r"so $\boxed{"), F.col("p_size").cast("string"), F.lit("}$")))
    known = F.when(kind == 0, F.concat(F.lit(" $"), F.col("p_size").cast("string"), F.lit("$"))).when(kind != 2, F.lit("-1"))
    return jobs.checked(table(spark, d, "part").select(F.col("p_partkey").alias("k"), said.alias("text"), known.alias("known"))).select("k", "verdict")


# By series: paths of a test for a customer {c} and an order {k}, and what SQL makes of them.
TREES = {
    "usamts": ("/d/{c}/{k}/test.pdf", "{c}_{k}"), "pumac": ("/d/{c}x{k}/A/algebra/test.pdf", "{c}x{k}_A_algebra"), "hmmt": ("/d/feb/{c}/guts{k}/test.pdf", "feb_{c}_guts{k}"), "chmm": ("/d/{c}/x{k}/test.pdf", "{c}_x{k}"),
    "mandelbrot": ("/d/{c}/round{k}-test.pdf", "{c}_round{k}-test"), "omo": ("/d/out/fall{k}/problems.pdf", "fall{k}"),
}


@query("SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{s}' AS series, replace(replace('{name}', '{{c}}', o_custkey::VARCHAR), '{{k}}', o_orderkey::VARCHAR) AS test_id FROM orders" for s, (_, name) in TREES.items()) + ") q")
def discovered_tests(spark: SparkSession, d: str) -> DataFrame:
    """A test for each order among its own and other files of a folder, by the rules of six series."""
    out = None
    for name, (path, _) in TREES.items():
        own = F.replace(F.replace(F.lit(path), F.lit("{c}"), F.col("o_custkey").cast("string")), F.lit("{k}"), F.col("o_orderkey").cast("string"))
        paths = table(spark, d, "orders").select(F.explode(F.array(own, F.regexp_replace(own, r"[^/]*[.]pdf$", "solutions.pdf"), F.regexp_replace(own, r"[.]pdf$", ".txt"))).alias("path"))
        rows = files.discovered(paths, "/d", name).select(F.lit(name).alias("series"), "test_id")
        out = rows if out is None else out.unionByName(rows)
    return out
