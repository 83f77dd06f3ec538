"""A training-data pipeline: language ID, line dedup, near-duplicate removal, surrogates for personal data, packing.

Each stage is a function of (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
documents.  run() writes each stage's result to the shared folder, reads it again for the next one and deletes all
that was written there before.  Rows keep their other columns, whatever their names; null texts and texts without letters go
with the language stage; an empty table gives no rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import release, saved, scratch_run, settle
from quire.llm.langid import identify
from quire.llm.line_dedup import line_dedup
from quire.llm.ngram_join import drop_near_duplicates
from quire.llm.packing import pack
from quire.llm.pii import replace_pii, surrogate_key

#: No SQL: models, MinHash and keyed surrogates have no SQL form; tests hold each stage against a plain one on small tables.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any letters go; the others get the predicted language."""
    settle(spark)
    own = docs.columns
    out = identify(docs, keep=[c for c in own if c != "doc_id"])
    out = out.where("lang_pred <> 'und'").withColumn("_keep_lang", F.col("lang_pred"))
    return out.select(*[F.col("doc_id") if c == "doc_id" else F.col(f"_keep_{c}").alias(c) for c in own])


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Common blocks of lines go from the later document; documents of which nothing is left go."""
    settle(spark)
    out = line_dedup(docs.withColumn("__quire_said", F.col("text").rlike(r"\S")), counts=False)
    emptied = F.col("__quire_said") & ~F.col("text").rlike(r"\S")
    return out.where(~F.coalesce(emptied, F.lit(False))).withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    settle(spark)
    return drop_near_duplicates(docs)


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets are replaced."""
    settle(spark)
    return replace_pii(docs, surrogate_key(spark), counts=False).withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Buckets and batches."""
    settle(spark)
    return pack(docs)


STAGES = [("language", language), ("lines", lines), ("near_duplicates", near_duplicates), ("surrogates", surrogates), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with scratch_run() as paths:
        for name, stage in STAGES[:-1]:
            docs = saved(stage(spark, docs, sf_dir), name)
            release(spark, paths, docs)
        return STAGES[-1][1](spark, docs, sf_dir)
