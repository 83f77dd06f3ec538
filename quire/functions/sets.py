"""Membership of a large set as a bitmap of a fixed size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a bitmap: 512 KB, whatever the size of the set.
BITS = 1 << 22


def bitmap(keys: DataFrame, key: str, bits: int = BITS) -> DataFrame:
    """One row, one array of bits/64 longs that marks the place of every key (a number)."""
    place = F.pmod(F.col(key), F.lit(bits).cast("long"))
    marks = keys.where(F.col(key).isNotNull()).select(F.shiftright(place, 6).alias("w"), F.lit(1).cast("long").alias("one"), place.bitwiseAND(F.lit(63)).cast("int").alias("b"))
    marks = marks.selectExpr("w", "shiftleft(one, b) AS v").unionByName(keys.sparkSession.range(bits // 64).select(F.col("id").alias("w"), F.lit(0).cast("long").alias("v")))
    words = marks.groupBy("w").agg(F.bit_or("v").alias("v"))
    return words.agg(F.transform(F.array_sort(F.collect_list(F.struct("w", "v"))), lambda x: x["v"]).alias("bitmap"))


def may_hold(words: Column, key: Column, bits: int = BITS) -> Column:
    """True for every key of the bitmap and for few others."""
    place = F.pmod(key, F.lit(bits).cast("long"))
    return F.getbit(F.get(words, F.shiftright(place, 6).cast("int")), place.bitwiseAND(F.lit(63)).cast("int")) == 1
