r"""Exact deduplication through a log-structured merge index of digests (DataFrame functions only).

Inserting documents flushes memtables: the digests a group of tasks has read become one sorted run of level 0, in files
of at most `memtable_rows` rows.  `fanout` runs of a level are compacted into one of the next: (digest, keep_id, n), n
the number of rows and keep_id their smallest id.  From level 1 on each run has a Bloom filter beside it.  When such runs
are compacted, a digest that no other run's filter may hold goes into the new run as it is; only the rest is shuffled
and merged.  The last compaction leaves one run, and its digests of several rows are hits.

A filter over the hits picks the texts to verify: they are grouped by digest and bytes.  Where all texts of a hit are
equal, the index's keep_id and n stand; where they are not (a collision of digests) the bytes decide row by row.

Defined results: null text counts as empty; texts are equal when identical after every run of [\x20\x09-\x0D] becomes
one space; of equal texts the smallest doc_id stays (nulls last).  Rows repeated with the same doc_id and text are
separate rows of which one stays.  An empty table gives no rows.  Other columns are not read.  `docs` must hold every
document of the index, as hits are verified on the texts.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bitmap, bits_for, hot_join, may_hold, saved, scratch

SPACE = r"[\x20\x09-\x0D]+"
PROBES = 2


def normal(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


@dataclass
class Run:
    """A sorted run, and from level 1 on its filter."""

    path: str
    filter: DataFrame | None = None
    bits: int = 0


class DigestIndex:
    """Runs by level in the shared folder.  Level 0 holds (digest, id) as inserted, higher levels (digest, keep_id, n)."""

    def __init__(self, spark: SparkSession, path: str | None = None, fanout: int = 4, memtable_rows: int = 1_000_000, digest_bits: int = 256) -> None:
        self.spark, self.path = spark, path or scratch(spark, "lsm")
        self.fanout, self.memtable_rows, self.digest_bits = fanout, memtable_rows, digest_bits
        self.entries: list[str] = []
        self.fresh: list[str] = []
        self.levels: list[list[Run]] = []
        self.made = 0

    def digest(self, full: Column) -> Column:
        """The first bits of a SHA-256; fewer than all only to test collisions."""
        return full if self.digest_bits == 256 else F.substring(full, 1, self.digest_bits // 8)

    def _write(self, df: DataFrame, level: int, order: list[str], by: list[str] = ()) -> str:
        self.made += 1
        path = f"{self.path}/level{level}/run{self.made:06d}"
        df.sortWithinPartitions(*by, *order).write.option("maxRecordsPerFile", self.memtable_rows).partitionBy(*by).parquet(path)
        return path

    def insert(self, docs: DataFrame, key: str = "doc_id", text: str = "text", memtables: int = 1) -> None:
        """Flush the digests of docs as `memtables` runs."""
        full = F.unhex(F.sha2(normal(F.col(text)), 256))
        memtable = F.pmod(F.spark_partition_id(), F.lit(memtables)).alias("memtable")
        path = self._write(docs.select(full.alias("full"), F.col(key).alias("id"), memtable), 0, ["full"], ["memtable"])
        self.entries.append(path)
        # A table of few files fills fewer memtables than asked for.
        held = {r["memtable"] for r in self.spark.read.schema(f"id {docs.schema[key].dataType.simpleString()}, memtable int").parquet(path).select("memtable").distinct().collect()}
        for m in sorted(held):
            self.fresh.append(f"{path}/memtable={m}")
            if len(self.fresh) >= self.fanout:
                self._absorb()

    def _absorb(self) -> None:
        """Level 0 to level 1, and on while a level is full."""
        if self.fresh:
            rows = reduce(DataFrame.unionByName, [self.spark.read.parquet(path) for path in self.fresh])
            rows = rows.select(self.digest(F.col("full")).alias("digest"), "id")
            self.fresh = []
            self._add(self._run(rows.groupBy("digest").agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("n")), 1), 0)

    def _run(self, df: DataFrame, level: int) -> Run:
        path = self._write(df, level, ["digest"])
        held = self.spark.read.parquet(path)
        bits = bits_for(held.count())
        return Run(path, saved(bitmap(held, "digest", bits, PROBES), "filter"), bits)

    def _add(self, run: Run, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._add(self._run(self._merged(full), level + 2), level + 1)

    def _merged(self, runs: list[Run]) -> DataFrame:
        """The runs as one: what only one of them holds, as the filters tell, is not shuffled."""
        alone, met = [], []
        for run in runs:
            rows = self.spark.read.parquet(run.path)
            elsewhere = reduce(Column.__or__, [may_hold(x.filter, F.col("digest"), x.bits, PROBES) for x in runs if x is not run])
            alone.append(rows.where(~elsewhere))
            met.append(rows.where(elsewhere))
        merged = reduce(DataFrame.unionByName, met).groupBy("digest").agg(F.min("keep_id").alias("keep_id"), F.sum("n").alias("n"))
        return reduce(DataFrame.unionByName, alone).unionByName(merged)

    def compact(self) -> DataFrame | None:
        """Merge everything into one run: (digest, keep_id, n); None without any row."""
        self._absorb()
        runs = [r for level in self.levels for r in level]
        if len(runs) > 1:
            runs = [self._run(self._merged(runs), len(self.levels) + 1)]
            self.levels = [*([] for _ in self.levels), runs]
        return self.spark.read.parquet(runs[0].path) if runs else None

    def rows(self) -> DataFrame:
        """One row for each inserted row: digest, full, id."""
        held = [self.spark.read.parquet(path) for path in self.entries]
        return reduce(DataFrame.unionByName, held).select(self.digest(F.col("full")).alias("digest"), "full", "id")


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", batches: list[DataFrame] | None = None, index: DigestIndex | None = None, memtables: int = 8) -> DataFrame:
    """One row per document: key, keep_id, group_size, kept, text_sha256.  `batches` inserts docs in several parts."""
    index = index or DigestIndex(docs.sparkSession)
    for part in batches or [docs]:
        index.insert(part, key, text, memtables)
    merged = index.compact()
    if merged is None:
        one = F.lit(1).cast("long")
        return docs.select(F.col(key), F.col(key).alias("keep_id"), one.alias("group_size"), F.lit(True).alias("kept"), F.sha2(normal(F.col(text)), 256).alias("text_sha256"))
    hits = merged.where("n > 1")
    bits = bits_for(hits.count())
    seen = saved(bitmap(hits, "digest", bits, PROBES), "hits")
    maybe = may_hold(seen, F.col("digest"), bits, PROBES)
    rows = index.rows()
    total = rows.count()

    # Byte verification.  Equal texts of a task become one row before the shuffle, so a large group of copies sends one
    # row from each task.
    texts = docs.select(F.col(key).alias("id"), normal(F.col(text)).alias("norm")).withColumn("digest", index.digest(F.unhex(F.sha2("norm", 256))))
    groups = texts.where(maybe).groupBy("digest", "norm").agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    checked = saved(groups.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")), "verified")
    sure = hits.join(checked.where("texts = 1"), "digest").select("digest", "keep_id", "n")
    clash = hits.join(checked.where("texts > 1"), "digest").select("digest", "n")

    met, parts = rows.where(maybe), [rows.where(~maybe).select("full", "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("n"))]
    if not clash.isEmpty():
        # Different texts under one digest.
        held = hot_join(met, clash.withColumn("clash", F.lit(True)), "digest", "n", total)
        met = held.where("clash IS NULL").select(*rows.columns)
        full = texts.join(clash.select("digest"), "digest", "left_semi")
        exact = full.groupBy("digest", "norm").agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
        parts.append(full.join(exact, ["digest", "norm"]).select(F.unhex(F.sha2("norm", 256)).alias("full"), "id", "keep_id", "n"))
    parts.append(hot_join(met, sure, "digest", "n", total).select("full", "id", "keep_id", "n"))
    out = reduce(DataFrame.unionByName, parts)
    out = out.select("id", F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("n", F.lit(1).cast("long")).alias("group_size"), F.lower(F.hex("full")).alias("text_sha256"))
    is_head = F.col("id").eqNullSafe(F.col("keep_id"))
    # Repeated rows of one id: only heads of groups can repeat as kept rows, so only those are counted.
    alone = out.where(is_head & (F.col("group_size") == 1)).withColumn("kept", F.lit(True))
    copies = out.where(is_head & (F.col("group_size") > 1)).groupBy("id", "keep_id", "group_size", "text_sha256").agg(F.count(F.lit(1)).alias("copies"))
    ranked = copies.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")).withColumn("kept", F.col("copy") == 1)
    cols = [F.col("id").alias(key), "keep_id", "group_size", "kept", "text_sha256"]
    return out.where(~is_head).withColumn("kept", F.lit(False)).select(*cols).unionByName(alone.select(*cols)).unionByName(ranked.select(*cols))
