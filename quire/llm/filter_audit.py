"""Audit of how filters interact, by a Walsh-Hadamard transform (DataFrame functions only).

Every document gets a mask of the filters it fails.  For each part, 32 signed parity sums (the sum of +1 or -1 over its
documents, by the parity of mask AND s) are aggregated for all documents, for those of good quality and for toxic ones.
The transform is its own inverse up to 1/32, so the sums give back, exactly and in integers, the number of documents of
each mask; from these cells follow all 120 orders of the filters and the Shapley shares (a document failing k filters is
removed by each of them in 120/k of the orders).

Filters: A too few words; B few different words; C many capitals; D holds a sign of code or tables; E text identical to
that of a smaller id, anywhere in the table.

Defined results: null text counts as empty, null part as the empty string; repeated rows count each; an id of several
rows is no smaller than itself; a null id is never smaller than another nor larger; of several labels of one id any
quality or toxic mark of 1 counts; documents without label are neither good nor toxic; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hot_join, saved

FILTERS = "ABCDE"
CELLS = 1 << len(FILTERS)
ORDERS = ["".join(p) for p in permutations(FILTERS)]

MIN_WORDS = 50
#: Of 100 words so many must differ.
MIN_DISTINCT = 65
#: Of 100 characters at most so many may be capitals.
MAX_CAPITALS = 5
SIGNS = r"[#$%&*|]"
SPACE = r"[\x20\x09-\x0D]+"


def own_failures(text: Column) -> Column:
    """Mask of the filters A to D that a text fails."""
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    n, capitals = F.size(words), F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = [
        n < MIN_WORDS,
        100 * F.size(F.array_distinct(words)).cast("long") < MIN_DISTINCT * n.cast("long"),
        100 * capitals.cast("long") > MAX_CAPITALS * F.length(text).cast("long"),
        text.rlike(SIGNS),
    ]
    mask = F.lit(0)
    for i, bad in enumerate(fails):
        mask = mask + F.when(bad, F.lit(1 << i)).otherwise(F.lit(0))
    return mask


def masks(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """part, mask, good, toxic for every document."""
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), whole.alias("t"))
    rows = saved(rows.select("id", "part", F.unhex(F.sha2("t", 256)).alias("digest"), own_failures(F.col("t")).alias("own")), "filters")
    first = rows.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = hot_join(rows, saved(first, "copies"), "digest", "n", rows.count())
    later = F.coalesce(F.col("id") > F.col("first"), F.lit(False))
    rows = rows.select("id", "part", (F.col("own") + F.when(later, F.lit(1 << 4)).otherwise(F.lit(0))).alias("mask"))
    marked = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(*[F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0)).alias(to) for c, to in (("quality", "good"), ("toxic", "toxic"))])
    return rows.join(marked, "id", "left").select("part", "mask", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")])


def _sign(s: int) -> Column:
    """+1 or -1 by the parity of mask AND s."""
    return F.lit(1) - 2 * F.bit_count(F.col("mask").bitwiseAND(F.lit(s))).bitwiseAND(F.lit(1))


def _inverse(sums: Column) -> Column:
    """The cells of 32 signed sums: the same transform once more, divided by 32 without rest."""
    sign = lambda m, s: F.lit(1) - 2 * F.bit_count(m.bitwiseAND(s)).bitwiseAND(F.lit(1))
    cell = lambda m: F.aggregate(F.transform(sums, lambda w, s: w * sign(m, s)), F.lit(0).cast("long"), lambda a, x: a + x)
    return F.transform(F.sequence(F.lit(0), F.lit(CELLS - 1)), lambda m: F.shiftright(cell(m), len(FILTERS)))


def cells(masked: DataFrame) -> DataFrame:
    """part, n, good, toxic: for each part arrays of 32 counts by mask, got back from parity sums."""
    kinds = {"n": F.lit(1), "good": F.col("good"), "toxic": F.col("toxic")}
    sums = masked.groupBy("part").agg(*[F.sum(_sign(s) * weight).alias(f"{kind}{s}") for kind, weight in kinds.items() for s in range(CELLS)])
    sums = sums.select("part", *[F.array(*[F.col(f"{kind}{s}") for s in range(CELLS)]).alias(kind) for kind in kinds])
    return sums.select("part", *[_inverse(F.col(kind)).alias(kind) for kind in kinds])


def _steps() -> list[tuple[str, int, int, int]]:
    """(order, step, mask of the filters before, mask of its own filter)."""
    out = []
    for order in ORDERS:
        before = 0
        for step, letter in enumerate(order, 1):
            own = 1 << FILTERS.index(letter)
            out.append((order, step, before, own))
            before |= own
    return out


def filter_audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    found = cells(masks(docs, labels, key, text, part))
    # passing[S]: documents that fail no filter of S
    passing = lambda c: F.transform(F.sequence(F.lit(0), F.lit(CELLS - 1)), lambda s: F.aggregate(F.transform(F.col(c), lambda x, m: F.when(m.bitwiseAND(s) == 0, x).otherwise(F.lit(0))), F.lit(0).cast("long"), lambda a, x: a + x))
    share = lambda own: F.aggregate(F.transform(F.col("n"), lambda x, m: F.when(m.bitwiseAND(own) > 0, x * (F.lit(len(ORDERS)) / F.bit_count(m)).cast("long")).otherwise(F.lit(0))), F.lit(0).cast("long"), lambda a, x: a + x)
    shares = F.array(*[share(F.lit(1 << i)) for i in range(len(FILTERS))])
    found = found.select("part", "n", shares.alias("shares"), *[passing(c).alias(f"{c}_left") for c in ("n", "good", "toxic")])
    steps = F.from_json(F.lit("[" + ",".join(f'{{"o":"{o}","k":{k},"b":{b},"f":{f}}}' for o, k, b, f in _steps()) + "]"), "array<struct<o:string,k:int,b:int,f:int>>")
    rows = found.withColumn("x", F.explode(steps)).select("*", "x.*")
    left = lambda c, s: F.get(F.col(c), s)
    after, zero = F.col("b").bitwiseOR(F.col("f")), F.lit(0)
    lost = lambda c: left(c, F.col("b")) - left(c, after)
    return rows.select(
        "part", F.col("o").alias("filter_order"), F.col("k").alias("step"), left("n_left", after).alias("kept"), lost("n_left").alias("removed"),
        (left("n_left", zero) - left("n_left", F.col("f")) - lost("n_left")).alias("redundant"), left("n", F.col("f")).alias("unique_fails"),
        lost("good_left").alias("good_lost"), lost("toxic_left").alias("toxic_lost"), F.get("shares", F.bit_count(F.col("f") - 1)).alias("shapley"))
