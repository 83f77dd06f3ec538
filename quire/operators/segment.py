"""Marked documents to problems: lines, markers, a choice of which markers count, spans, text per problem."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.series import series
from quire.operators import sequence


# Fixed value: line openings that end a section.
HEADING = r"^#|^\*\*.*(?:\[|Section|Round|Division|Part)"


def marked_lines(docs: DataFrame, key: str, text: str, rules: str = "default") -> DataFrame:
    """key, pos, line, number, end: every line, with its marker if it opens a problem."""
    lines = docs.select(F.col(key), F.posexplode(F.split(text, r"\r\n|[\n\r]", -1)).alias("pos", "line"))
    return lines.withColumn("m", series(rules).marker(F.col("line"))).select(key, "pos", "line", F.col("m.number").alias("number"), F.col("m.end").alias("end"))


def problems(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: str = "default", mode: str = "rising", **layout: object) -> DataFrame:
    """key, problem, text: a marker that counts opens a problem, all other lines belong to the one before them.

    mode: `rising` (over every number so far), `consecutive` (by one), `restart` (numbers that begin again at 1 go on
    from the section before) or `sections` (headings count too; `layout` are the options of sequence.numbered).  Lines before the first problem and null texts give nothing; only (position, number) pairs
    meet in the fold, texts never do."""
    lines = marked_lines(docs.where(F.col(text).isNotNull()), key, text, rules)
    marks = lines.where("number IS NOT NULL").select(key, "pos", "number")
    if mode == "rising":
        picked = sequence.rising(marks, [key], ["pos"], "number").where("kept").select(key, "pos", F.col("number").cast("long").alias("problem"))
    elif mode == "consecutive":
        kept = sequence.consecutive(marks, [key], "pos", "number").where("kept = 1").select(key, F.col("pos").cast("int").alias("pos"))
        picked = kept.join(marks, [key, "pos"]).select(key, "pos", F.col("number").cast("long").alias("problem"))
    elif mode == "restart":
        picked = sequence.restarting(marks, [key], "pos", "number").where("problem IS NOT NULL").select(key, F.col("pos").cast("int").alias("pos"), "problem")
    elif mode == "sections":
        events = lines.withColumn("heading", F.col("line").rlike(HEADING)).where("number IS NOT NULL OR heading")
        picked = sequence.numbered(events, [key], "pos", "number", "heading", **layout).where("problem IS NOT NULL").select(key, F.col("pos").cast("int").alias("pos"), "problem")
    else:
        raise ValueError(f"unknown mode {mode!r}")
    w = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = lines.join(picked, [key, "pos"], "left").withColumn("opens", F.col("problem").isNotNull()).withColumn("problem", F.last("problem", ignorenulls=True).over(w))
    body = F.when(F.col("opens"), F.ltrim(F.expr("substring(line, end + 1)"))).otherwise(F.col("line"))
    parts = F.array_sort(F.collect_list(F.struct("pos", body.alias("t"))))
    return whole.where("problem IS NOT NULL").groupBy(key, "problem").agg(F.trim(F.array_join(F.transform(parts, lambda x: x["t"]), "\n")).alias("text"))


def solution_parts(blocks: DataFrame, keys: list[str], text: str, header: str) -> DataFrame:
    """keys + part, text: a block cut at header lines (dropped); what precedes the first header stays with the first part."""
    lines = blocks.select(*keys, F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"))
    w = Window.partitionBy(*keys).orderBy("pos")
    at = lines.withColumn("head", F.col("line").rlike(header)).withColumn("part", F.greatest(F.sum(F.col("head").cast("int")).over(w), F.lit(1)))
    parts = F.array_sort(F.collect_list(F.struct("pos", "line")))
    return at.where("NOT head").groupBy(*keys, "part").agg(F.trim(F.array_join(F.transform(parts, lambda x: x["line"]), "\n")).alias(text)).where(F.length(text) > 0)


def incomplete(found: DataFrame, expected: DataFrame, key: str, number: str = "problem") -> DataFrame:
    """key, missing: expected numbers that were not found, for documents that lack any."""
    gone = expected.select(key, number).distinct().join(found.select(key, number), [key, number], "left_anti")
    return gone.groupBy(key).agg(F.array_sort(F.collect_set(number)).alias("missing"))


def too_short(pages: DataFrame, text: str, layer: str, least: int = 800, share: float = 0.35) -> DataFrame:
    """Pages whose text is under `share` of a text layer of `least` characters or more."""
    return pages.where((F.length(layer) >= least) & (F.length(F.coalesce(text, F.lit(""))) < F.length(layer) * share))
