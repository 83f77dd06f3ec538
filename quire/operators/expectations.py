"""What a page must hold to be believed: rules by series and kind of page, worked out in one aggregation.

A rule compares what was read off a page with what its text layer says: the numbers of problems, how many there are, how
many labels of solutions, how much text.  A page without a text layer (or one that says nothing) passes; so do pages of
series without rules.  A page that breaks a rule is to be read again."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.cleaners import COVER_PHRASES, compact

# Least length of a text layer that is compared, least share of it, round whose pages hold pairs.
LEAST_LAYER, LEAST_SHARE = 800, 0.35
PAIRED = r"(?i)\btarget\s+round\b"
#: (series, kind of page): rules
RULES: dict[tuple[str, str], list[str]] = {
    ("pumac", "statement"): ["numbers"],
    ("pumac", "solution"): ["numbers", "labels"],
    ("farml", "statement"): ["numbers"],
    ("hmmt", "statement"): ["count"],
    ("hmmt", "solution"): ["share"],
    ("cmimc", "statement"): ["count"],
    ("mathcounts", "statement"): ["batch"],
}
NUMBER = r"(?m)^\s*(\d{1,3})\s*[.)]\s"
LABEL = r"(?m)^[ \t*_#>\[\]]*(?i:solution|answer)\b[*_]*[ \t]*[.:]"


def numbers_of(text: Column) -> Column:
    """Distinct numbers that begin lines."""
    return F.array_distinct(F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(NUMBER), F.lit(1)), lambda x: x.cast("int")))


def labels_of(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(LABEL))


def asked(*names: str) -> Column:
    """Whether one of these rules holds for the page's series and kind."""
    hits = [(F.col("series") == s) & (F.col("role") == r) for (s, r), own in RULES.items() if set(own) & set(names)]
    return functools.reduce(lambda a, b: a | b, hits)


def read_facts(text: Column) -> Column:
    """What the page's rules compare of its text; what none of them asks for is null."""
    said = F.coalesce(text, F.lit(""))
    cover = F.lit(False)
    for phrase in COVER_PHRASES:
        cover = cover | F.contains(compact(said), F.lit(phrase))
    batch = asked("batch")
    return F.struct(F.length(said).alias("length"), F.when(asked("labels"), labels_of(text)).alias("labels"), F.when(batch, cover).alias("cover"), F.when(batch, said.rlike(PAIRED)).alias("paired"))


def layer_facts(layer: Column) -> Column:
    """What the page's rules compare of its text layer."""
    return F.struct(F.length(F.coalesce(layer, F.lit(""))).alias("length"), F.when(asked("labels"), labels_of(layer)).alias("labels"), F.when(asked("numbers", "count"), numbers_of(layer)).alias("numbers"))


def broken(have: Column, read: Column, layer: Column) -> dict[str, Column]:
    """Whether each rule is broken: `have` are the numbers read off the page, `read` and `layer` the facts of its text and text layer."""
    return {
        "numbers": F.size(F.array_except(layer["numbers"], have)) > 0,
        "count": F.size(have) < F.size(layer["numbers"]),
        "labels": read["labels"] < layer["labels"],
        "share": (layer["length"] >= LEAST_LAYER) & (read["length"] < LEAST_SHARE * layer["length"]),
        "batch": ~read["cover"] & ((F.size(have) == 1) | (read["paired"] & (F.size(have) < 2))),
    }


def judged(pages: DataFrame, found: DataFrame, key: str = "page_key", number: str = "problem") -> DataFrame:
    """key, series, role, broken (names of broken rules, in order), valid for every page.

    pages: key, series, role, text, layer.  found: key, number of what was read; pages of which nothing was read have no
    row there.  Repeated rows of a page give one (the longest text and layer count).  Texts stay where they are: only what
    the rules compare is shuffled."""
    have = found.where(F.col(number).isNotNull()).groupBy(key).agg(F.collect_set(F.col(number).cast("int")).alias("__have"))
    facts = pages.select(key, "series", "role", read_facts(F.col("text")).alias("__read"), layer_facts(F.col("layer")).alias("__layer"))
    rows = facts.groupBy(key, "series", "role").agg(F.max("__read").alias("__read"), F.max("__layer").alias("__layer")).join(have, key, "left")
    none = F.array().cast("array<int>")
    rules = broken(F.coalesce("__have", none), F.col("__read"), F.col("__layer"))
    own = F.array().cast("array<string>")
    for (series, role), names in RULES.items():
        hit = (F.col("series") == series) & (F.col("role") == role)
        own = F.when(hit, F.array(*[F.when(rules[n], F.lit(n)) for n in names])).otherwise(own)
    rows = rows.withColumn("broken", F.filter(own, lambda x: x.isNotNull()))
    return rows.select(key, "series", "role", "broken", (F.size("broken") == 0).alias("valid"))
