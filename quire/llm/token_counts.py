"""Token counts as delta-maintained rollups.

A store in the shared folder holds, by committed batch, the signed totals the batch adds by source, language and
tokenizer version, and the counts of the documents it touched.  A batch of inserts, revisions and deletes is joined to
the documents' standing counts; each change retracts the old count and adds the new one.  Totals are the sum of the
committed deltas.  A batch's files are written whole and its commit marker last, so committing it again does nothing and
a batch that broke off is simply written anew.  Every SNAPSHOT batches the standing counts and the totals are written
out, so a commit and a reading look at no more than SNAPSHOT batches beside the last snapshot; of the snapshot only
documents that a filter over the batch's ids lets pass are shuffled.  One writer commits at a time.

Defined results: inserting or revising a document that stands replaces its count; deleting one that does not stand
changes nothing; of several changes to a document in one batch the one with the highest `seq` counts (ties: the largest
row); null ids are counted on insert and cannot be revised or deleted; null text has no tokens; null source or language
is a group of its own; groups whose documents are all gone are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import encoder
from .common import bitmap, bits_for, may_hold, saved, scratch

KEYS = ["source", "lang", "tokenizer"]
SUMS = ["n_docs", "n_tokens", "n_chars"]
CHANGE = "op string, doc_id bigint, seq bigint, source string, lang string, tokenizer string, n_tokens bigint, n_chars bigint"
STATE = "doc_id bigint, tokenizer string, source string, lang string, n_tokens bigint, n_chars bigint, live boolean, number int"
DELTA = "source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint, n_chars bigint"

#: Batches between snapshots.
SNAPSHOT = 8


class RollupStore:
    def __init__(self, spark: SparkSession, path: str | None = None) -> None:
        self.spark, self.path = spark, path or scratch(spark, "rollup")

    def _exists(self, path: str) -> bool:
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

    def _marker(self, batch: str) -> str:
        return f"{self.path}/commits/{hashlib.sha256(batch.encode()).hexdigest()}"

    def last(self) -> int:
        """Number of the last committed batch, 0 without any; batches are numbered from 1 without gaps."""
        if not self._exists(f"{self.path}/commits"):
            return 0
        return self.spark.read.schema("number int, batch string").parquet(f"{self.path}/commits/*").agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]

    def _since(self, kind: str, last: int) -> list[str]:
        """Paths whose rows together say what stands after batch `last`: a snapshot and the batches after it."""
        at = last // SNAPSHOT * SNAPSHOT
        return ([f"{self.path}/{kind}_snapshot/{at:08d}"] if at else []) + [f"{self.path}/{kind}/{n:08d}" for n in range(at + 1, last + 1)]

    def standing(self, last: int | None = None, only: Callable[[DataFrame], DataFrame] = lambda log: log) -> DataFrame | None:
        """doc_id, tokenizer and the counts of the documents that stand; `only` narrows the log to some documents."""
        paths = self._since("state", self.last() if last is None else last)
        if not paths:
            return None
        log = only(self.spark.read.schema(STATE).parquet(*paths))
        latest = log.groupBy("doc_id", "tokenizer").agg(F.max_by(F.struct("source", "lang", "n_tokens", "n_chars", "live", "number"), "number").alias("s"))
        return latest.select("doc_id", "tokenizer", "s.*").where("live")

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Apply a batch of CHANGE rows; False if it is already in."""
        if self._exists(f"{self._marker(batch)}/_SUCCESS"):
            return False
        done = self.last()
        number = done + 1
        cols = ["source", "lang", "n_tokens", "n_chars"]
        changes.select([F.col(f.split()[0]) for f in CHANGE.split(", ")]).write.mode("overwrite").parquet(f"{self.path}/changes/{number:08d}")
        changes = self.spark.read.schema(CHANGE).parquet(f"{self.path}/changes/{number:08d}")
        keyed, loose = changes.where("doc_id IS NOT NULL"), changes.where("doc_id IS NULL AND op <> 'delete'")
        last = keyed.groupBy("doc_id", "tokenizer").agg(F.max(F.struct("seq", "op", *cols)).alias("c")).select("doc_id", "tokenizer", "c.op", *[f"c.{c}" for c in cols])
        state = last.select("doc_id", "tokenizer", *cols, (F.col("op") != "delete").alias("live"), F.lit(number).alias("number"))
        state.write.mode("overwrite").parquet(f"{self.path}/state/{number:08d}")
        new = self.spark.read.schema(STATE).parquet(f"{self.path}/state/{number:08d}")
        rows = new.where("live").select("tokenizer", *cols, F.lit(1).alias("sign")).unionByName(loose.select("tokenizer", *cols, F.lit(1).alias("sign")))
        touched, bits = new.select("doc_id"), bits_for(new.count())
        old = self.standing(done, lambda log: log.where(may_hold(bitmap(touched, "doc_id", bits), F.col("doc_id"), bits)))
        if old is not None:
            rows = rows.unionByName(old.join(new.select("doc_id", "tokenizer"), ["doc_id", "tokenizer"], "left_semi").select("tokenizer", *cols, F.lit(-1).alias("sign")))
        signed = [F.sum(F.col("sign") * x).alias(c) for c, x in zip(SUMS, (F.lit(1).cast("long"), F.col("n_tokens"), F.col("n_chars")))]
        rows.groupBy(*KEYS).agg(*signed).write.mode("overwrite").parquet(f"{self.path}/delta/{number:08d}")
        if number % SNAPSHOT == 0:
            # Written before the marker, from what stood before and this batch.
            log = self.spark.read.schema(STATE).parquet(*self._since("state", done), f"{self.path}/state/{number:08d}")
            latest = log.groupBy("doc_id", "tokenizer").agg(F.max_by(F.struct(*cols, "live", "number"), "number").alias("s")).select("doc_id", "tokenizer", "s.*").where("live")
            latest.write.mode("overwrite").parquet(f"{self.path}/state_snapshot/{number:08d}")
            deltas = self.spark.read.schema(DELTA).parquet(*self._since("delta", done), f"{self.path}/delta/{number:08d}")
            deltas.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS]).write.mode("overwrite").parquet(f"{self.path}/delta_snapshot/{number:08d}")
        self.spark.createDataFrame([(number, batch)], "number int, batch string").coalesce(1).write.mode("overwrite").parquet(self._marker(batch))
        return True

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, n_docs, n_tokens, n_chars over the committed batches."""
        paths = self._since("delta", self.last())
        if not paths:
            return self.spark.createDataFrame([], DELTA)
        return self.spark.read.schema(DELTA).parquet(*paths).groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS]).where(" OR ".join(f"{c} <> 0" for c in SUMS))


def counted(docs: DataFrame, tokenizers: dict[str, str], op: str = "insert", seq: int = 0, carried: str | None = None) -> DataFrame:
    """CHANGE rows for documents (doc_id, text, source, lang), one for each tokenizer version; text goes through the tokenizer
    whole.  A numeric column of docs may be carried along."""
    versions = list(tokenizers.items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, path in versions:
                n = pa.array([len(ids) // 4 for ids, _ in encoder(path).encode_all_in_groups(batch.column(1))], pa.int64())
                rows = batch.num_rows
                columns = [pa.array([op] * rows), batch.column(0), pa.array([seq] * rows, pa.int64()), batch.column(2), batch.column(3), pa.array([name] * rows), n, batch.column(4)]
                names = ["op", "doc_id", "seq", "source", "lang", "tokenizer", "n_tokens", "n_chars"]
                yield pa.RecordBatch.from_arrays([*columns, *batch.columns[5:]], names=names + ([carried] if carried else []))

    chars = F.coalesce(F.char_length("text"), F.lit(0)).cast("long").alias("n_chars")
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), chars, *([F.col(carried).cast("long").alias(carried)] if carried else []))
    return source.mapInArrow(run, CHANGE + (f", {carried} bigint" if carried else ""))


def token_counts(docs: DataFrame, tokenizers: dict[str, str], path: str | None = None) -> DataFrame:
    """Totals over docs, kept by four batches: a load in which every 16th document has a provisional count (of words), a
    withdrawal of every 16th other one, its return together with the revised counts, and the load committed once more,
    which changes nothing."""
    store = RollupStore(docs.sparkSession, path)
    words = F.coalesce(F.regexp_count("text", F.lit(r"\S+")), F.lit(0))
    counts = saved(counted(docs.withColumn("__words", words), tokenizers, carried="__words"), "changes")
    turn = F.pmod(F.col("doc_id"), F.lit(16))
    load = counts.withColumn("n_tokens", F.when(turn == 1, F.col("__words")).otherwise(F.col("n_tokens")))
    changes = counts.drop("__words")
    again = changes.where(turn <= 1).withColumns({"op": F.when(turn == 1, "revise").otherwise("insert"), "seq": F.lit(1).cast("long")})
    store.commit("load", load)
    store.commit("withdraw", changes.where(turn == 0).withColumn("op", F.lit("delete")))
    store.commit("return", again)
    store.commit("load", load)
    return store.totals()
