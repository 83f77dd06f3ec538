"""Packing with optimal length buckets.

A dynamic programme over the global length histogram chooses the bucket boundaries that minimise padding; inside each
bucket documents form batches of at most `token_budget` padded tokens.

The programme runs over the distinct lengths themselves.  d distinct lengths need at least d(d-1)/2 words, so the
histogram has at most about the square root of twice the words of the table, however long a single text is.  A bucket is
cut into shards by a hash of the document, as many as its histogram count calls for, so no task orders more than about
`shard_rows` documents; each shard leaves at most one batch partly filled.

Defined results: null text and text without words have length 0; a document longer than the budget is a batch of its
own; ties order by document id; repeated rows are packed like other rows; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved


def word_count(text: Column) -> Column:
    """Words as runs of non-space characters."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def optimal_boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> tuple[list[int], int]:
    """Boundaries (upper lengths) of at most `buckets` buckets with the least total padding, and that padding.

    best[k][j] = min over i of best[k-1][i] + padding(i, j).  The padding satisfies the quadrangle inequality, so the
    best i never decreases with j and each layer is solved by divide and conquer."""
    m = len(lengths)
    if not m:
        return [], 0
    ends = lengths.astype(np.int64)
    docs = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
    tokens = np.concatenate([[0], np.cumsum(counts.astype(np.int64) * ends)])
    big = np.iinfo(np.int64).max // 4
    best = np.full(m + 1, big, dtype=np.int64)
    best[0] = 0
    choices = []
    for _ in range(min(buckets, m)):
        new, choice = np.full(m + 1, big, dtype=np.int64), np.zeros(m + 1, dtype=np.int64)
        todo = [(1, m, 0, m - 1)]
        while todo:
            lo, hi, first, last = todo.pop()
            if lo > hi:
                continue
            j = (lo + hi) // 2
            i = np.arange(first, min(last, j - 1) + 1)
            cost = best[i] + ends[j - 1] * (docs[j] - docs[i]) - (tokens[j] - tokens[i])
            k = int(np.argmin(cost))
            new[j], choice[j] = cost[k], i[k]
            todo += [(lo, j - 1, first, int(i[k])), (j + 1, hi, int(i[k]), last)]
        choices.append(choice)
        new = np.minimum(new, big)
        best = new
    bounds, j = [], m
    for choice in reversed(choices):
        if j == 0:
            break
        bounds.append(int(ends[j - 1]))
        j = int(choice[j])
    return bounds[::-1], int(best[m])


def pack(docs: DataFrame, buckets: int = 16, token_budget: int = 16_384, shard_rows: int = 50_000, key: str = "doc_id", text: str = "text", length: Column | None = None) -> DataFrame:
    """One row per document: key, n_tokens, bucket_len, bucket, shard, batch, slot, batch_docs, pad_tokens."""
    rows = docs.select(F.col(key), (length if length is not None else word_count(F.col(text))).cast("long").alias("n_tokens"), F.xxhash64(F.col(key), F.col(text)).alias("h"))
    rows = saved(rows, "lengths")
    hist = rows.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n"))
    bins = hist.orderBy("n_tokens").collect()
    lens, counts = (np.array([b[c] for b in bins], dtype=np.int64) for c in ("n_tokens", "n"))
    bounds, _ = optimal_boundaries(lens, counts, buckets)
    if not bounds:
        return rows.select(F.col(key), "n_tokens", *[F.lit(0).cast("long").alias(c) for c in ("bucket_len", "bucket", "shard", "batch", "slot", "batch_docs", "pad_tokens")])
    held = np.add.reduceat(counts, np.searchsorted(lens, [-1, *bounds[:-1]], side="right")).tolist()
    shards = [max(1, -(-n // shard_rows)) for n in held]
    bucket = F.coalesce(*[F.when(F.col("n_tokens") <= b, F.lit(i)) for i, b in enumerate(bounds)])
    pick = lambda values: F.element_at(F.array(*[F.lit(int(v)).cast("long") for v in values]), F.col("bucket") + 1)
    rows = rows.withColumn("bucket", bucket).withColumns({"bucket_len": pick(bounds), "batch_docs": pick([max(1, token_budget // max(1, b)) for b in bounds]), "shards": pick(shards)})
    rows = rows.withColumn("shard", F.pmod(F.col("h"), F.col("shards")))
    at = F.row_number().over(Window.partitionBy("bucket", "shard").orderBy("n_tokens", key, "h")) - 1
    rows = rows.withColumn("at", at.cast("long"))
    return rows.select(F.col(key), "n_tokens", "bucket_len", F.col("bucket").cast("long").alias("bucket"), "shard", F.floor(F.col("at") / F.col("batch_docs")).alias("batch"), (F.col("at") % F.col("batch_docs")).alias("slot"), "batch_docs", (F.col("bucket_len") - F.col("n_tokens")).alias("pad_tokens"))
