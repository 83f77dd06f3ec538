"""Queries over answers, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import answers, matching, text
from quire.plans.registry import query, table

@query("SELECT o_orderkey, CASE o_custkey % 4 WHEN 3 THEN NULL ELSE o_orderkey::VARCHAR END AS answer, CASE o_custkey % 4 WHEN 0 THEN 'label' WHEN 1 THEN 'box' WHEN 2 THEN 'prose' END AS tier FROM orders")
def cascade_orders(spark: SparkSession, d: str) -> DataFrame:
    k, kind = F.col("o_orderkey").cast("string"), F.col("o_custkey") % 4
    block = F.when(kind == 0, F.concat(F.lit("work\n**Answer:** $"), k, F.lit("$.\nmore"))).when(kind == 1, F.concat(F.lit(r"so \boxed{"), k, F.lit("} it is"))).when(kind == 2, F.concat(F.lit("hence the answer is "), k, F.lit(". Done"))).otherwise("nothing is said here")
    return table(spark, d, "orders").select("o_orderkey", answers.answer("cmimc")(block).alias("a")).select("o_orderkey", "a.answer", "a.tier")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 5 = 0 THEN 'fixed' WHEN o_orderkey % 2 = 0 THEN o_orderpriority WHEN o_orderkey % 3 = 0 THEN 'told' ELSE 'worked' END AS answer FROM orders")
def resolved_answers(spark: SparkSession, d: str) -> DataFrame:
    """Overrides, removals, and the first valid of three sources."""
    k = F.col("o_orderkey")
    printed = F.when(k % 2 == 0, F.col("o_orderpriority")).otherwise(r"a \iff b")
    told = F.when(k % 3 == 0, "told").otherwise("")
    return table(spark, d, "orders").select("o_orderkey", answers.resolved(printed, told, F.lit("worked"), F.when(k % 5 == 0, "fixed"), k % 7 == 0).alias("answer"))


@query("SELECT o_orderkey, o_orderpriority AS answer FROM orders WHERE o_custkey % 5 <> 1 AND o_custkey % 5 <> 2 AND o_custkey % 5 <> 3")
def answer_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Blank values, foreign sections and long prose go; headers behind a value go."""
    kind, p = F.col("o_custkey") % 5, F.col("o_orderpriority")
    value = F.when(kind == 0, F.concat(p, F.lit("\nPage 3"))).when(kind == 1, " ").when(kind == 2, F.concat(F.lit("Solution 2: "), p)).when(kind == 3, F.concat(F.lit("We see that\n"), p)).otherwise(p)
    return answers.clean_candidates(table(spark, d, "orders").select("o_orderkey", value.alias("answer")))


@query("SELECT o_orderkey, o_custkey % 3 <> 0 AS usable, o_custkey % 2 = 0 AS deferred, o_custkey % 4 <> 1 AS alone FROM orders")
def answer_quality(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("o_custkey")
    value = F.when(c % 3 == 0, "☐").otherwise("5")
    block = F.when(c % 2 == 0, "hard to solve, wait").otherwise("plain")
    alone = F.when(c % 4 == 1, "5 because it must be").otherwise(r"$\frac{1}{2}$ cm")
    return table(spark, d, "orders").select("o_orderkey", answers.usable(value).alias("usable"), answers.deferred(block).alias("deferred"), answers.standalone(alone).alias("alone"))


@query("SELECT p_partkey AS k, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_name || ' is another thing entirely, so we go on from there' END AS body FROM part")
def restatements(spark: SparkSession, d: str) -> DataFrame:
    """Bodies that only say the statement again are none."""
    said = F.concat(F.lit("let "), "p_name", F.lit(" be one of many"))
    body = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("Let "), "p_name", F.lit(" be one of many."))).otherwise(F.concat("p_name", F.lit(" is another thing entirely, so we go on from there")))
    return table(spark, d, "part").select(F.col("p_partkey").alias("k"), matching.without_restatement(body, said).alias("body"))


@query("SELECT p_partkey AS k, 'the proof of it' AS body, CAST(1 AS DOUBLE) AS same FROM part")
def prefixes_off(spark: SparkSession, d: str) -> DataFrame:
    """Bodies without the statement they begin with, by words."""
    said = F.concat(F.lit("Let there be a thing called "), "p_name", F.lit(" and show that it holds for all n at once"))
    body = F.concat(F.upper(said), F.lit(". the proof of it"))
    return table(spark, d, "part").select(F.col("p_partkey").alias("k"), matching.statement_off(body, said).alias("body"), F.round(matching.score(said, said), 4).alias("same"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'so it is 1.5' ELSE '1,000' END AS answer FROM orders")
def stated_numbers(spark: SparkSession, d: str) -> DataFrame:
    """A dot or comma within a number is no end of the sentence."""
    block = F.when(F.col("o_orderkey") % 2 == 0, "The answer is so it is 1.5. Done").otherwise("thus the answer is 1,000, as said")
    return table(spark, d, "orders").select("o_orderkey", text.stated_answer(block).alias("answer"))


@query("""SELECT p_partkey AS k, CASE p_partkey % 8 WHEN 0 THEN p_name WHEN 1 THEN '-' || chr(10) || p_name || chr(10) || '==' WHEN 2 THEN '# ' || chr(10) || p_name WHEN 3 THEN p_name WHEN 4 THEN p_name WHEN 5 THEN p_name || chr(10) || '![](a.png)' WHEN 6 THEN '**' || p_name || '.** x' ELSE p_name || chr(10) || '---' || chr(10) || p_brand END AS t FROM part""")
def entry_edges(spark: SparkSession, d: str) -> DataFrame:
    """Edges of entries: rules and bare emphasis go, images are looked through."""
    forms = ["---\n{t}\n* * *", "-\n{t}\n==", "# \n{t}", "** {t} **", "{t} **", "{t}\n***\n![](a.png)", "**{t}.** x", "{t}\n---\n{b}"]
    form = F.element_at(F.array(*map(F.lit, forms)), (F.col("p_partkey") % 8).cast("int") + 1)
    x = F.replace(F.replace(form, F.lit("{t}"), F.col("p_name")), F.lit("{b}"), F.col("p_brand"))
    return table(spark, d, "part").select(F.col("p_partkey").alias("k"), text.boundary_clean(x).alias("t"))
