"""The queries of the training-data operators: names, functions of (spark, sf_dir), and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """The vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ngram_join import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import line_dedup

    return line_dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import replace_pii, surrogate_key

    return replace_pii(_table(spark, sf_dir, "documents").select("doc_id", "text"), surrogate_key(spark))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(_table(spark, sf_dir, "documents"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe import encode

    return encode(_table(spark, sf_dir, "documents"), tokenizer_path(), digests_only=True)


def op6_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ann import neighbours

    return neighbours(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .exact_dedup import exact_dedup

    return exact_dedup(_table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_counts import token_counts

    return token_counts(_table(spark, sf_dir, "documents"), {"word_bpe_49k": tokenizer_path()})


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .license_scan import license_scan

    return license_scan(_table(spark, sf_dir, "documents"))


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import identify

    return identify(_table(spark, sf_dir, "documents"))


def op11_katz_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .katz import score

    return score(_table(spark, sf_dir, "documents"))


def op12_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .maxscore import search

    return search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .filter_audit import filter_audit

    return filter_audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def queries() -> dict[str, Query]:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}
