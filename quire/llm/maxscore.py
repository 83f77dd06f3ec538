"""Ranked lexical search by MaxScore per shard.

All documents are read and reduced to postings of the terms that queries hold; from these, document frequencies and
weights follow.  A shard is a run of documents of one partition, cut when its postings reach a bound.  In a shard each
term's list has an upper bound.  For a query, the terms whose bounds together stay below the score of the k-th best
document so far are non-essential: documents are found through the essential lists only, and the others are probed from
the highest bound down, as long as a document can still qualify.  The threshold rises from block to block of documents
and is kept from shard to shard of a task.  The best k of each task are merged by rank.

A document's score sums weight * ((10^9 * tf) div (1000 * tf + 20 * m)); m grows with its length against the mean.

Queries come in blocks whose vocabularies are bounded, so that what is broadcast is; each block reads the documents again.

Defined results: null texts hold no term; each row of documents is a document of its own, also when rows repeat; rows
of one item are one query; null items and items without hits have no rows; equal scores go by ascending id, a null id
first; empty tables give no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

TOP = 50
#: Postings of a shard, some 16 bytes each.
SHARD_POSTINGS = 2_000_000
#: Documents looked at between two thresholds.
BLOCK_DOCS = 4096
#: Bound of a block of queries: terms of all its items.
BLOCK_TERMS = 500_000
#: A text is cut into pieces of about this many bytes, between terms.
PIECE = 1 << 20
#: Of UTF-8, A-Z lower-cased before: every byte of a character beyond ASCII belongs to a term.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
GAP = re.compile(rb"[^0-9a-z\x80-\xff]")


def terms(text: bytes) -> Counter:
    """How often each term stands in a text."""
    text, found, at = text.lower(), Counter(), 0
    while at < len(text):
        gap = GAP.search(text, at + PIECE) if len(text) - at > PIECE else None
        end = gap.start() if gap else len(text)
        found.update(TERM.findall(text, at, end))
        at = end
    return found


def queries_of(items: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """item, term: the distinct terms of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [list(terms(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.repeat(np.arange(len(own)), [len(x) for x in own]), pa.int64())), pa.array([t for x in own for t in x], pa.binary())], names=["item", "term"])

    known = items.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).alias("item"), F.col(text).cast("binary").alias("t"))
    return known.mapInArrow(run, f"item {items.schema[key].dataType.simpleString()}, term binary").distinct()


def postings(docs: DataFrame, vocabulary: dict[bytes, int], key: str, text: str) -> DataFrame:
    """doc, n (terms with repeats), term (numbers), tf: for every document with a term; only terms of the vocabulary are listed."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = known.value
        for batch in batches:
            rows, sizes, numbers, counts = [], [], [], []
            for i, value in enumerate(batch.column(1)):
                found = terms(value.as_buffer().to_pybytes())
                if found:
                    own = [(number[t], c) for t, c in found.items() if t in number]
                    rows.append(i)
                    sizes.append(found.total())
                    numbers.append([x for x, _ in own])
                    counts.append([c for _, c in own])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(sizes, pa.int64()), pa.array(numbers, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))], names=["doc", "n", "term", "tf"])

    source = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("doc"), F.col(text).cast("binary").alias("t"))
    return source.mapInArrow(run, f"doc {docs.schema[key].dataType.simpleString()}, n bigint, term array<int>, tf array<bigint>")


class Best:
    """The k best (score, document) of a query; of equal scores those with the smaller id."""

    def __init__(self, k: int) -> None:
        self.k, self.score, self.doc = k, np.zeros(0, np.int64), []

    @property
    def least(self) -> int:
        """A document below this score cannot enter."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, doc: list) -> None:
        if len(doc) > 4 * self.k:  # those that equal the k-th best stay for the order of ids
            cut = np.partition(score, len(score) - self.k)[len(score) - self.k]
            keep = np.flatnonzero(score >= cut)
            score, doc = score[keep], [doc[i] for i in keep]
        every = sorted(zip([*self.score.tolist(), *score.tolist()], [*self.doc, *doc]), key=lambda x: (-x[0], x[1] is not None, x[1] or 0))[: self.k]
        self.score, self.doc = np.array([s for s, _ in every], dtype=np.int64), [d for _, d in every]


class Shard:
    """Lists of a run of documents: by term ascending documents and what the term adds to each."""

    def __init__(self, ids: list, doc: np.ndarray, term: np.ndarray, gain: np.ndarray, weight: np.ndarray) -> None:
        order = np.lexsort((doc, term))
        self.ids, self.doc, term = ids, doc[order], term[order]
        self.gain = gain[order] * weight[term]
        names, start = np.unique(term, return_index=True)
        self.lists = {int(t): (int(a), int(z)) for t, a, z in zip(names, start, [*start[1:], len(term)])}
        self.bound = {t: int(self.gain[a:z].max()) for t, (a, z) in self.lists.items()}

    def search(self, query: list[int], best: Best) -> None:
        own = sorted((t for t in query if self.bound.get(t)), key=lambda t: (self.bound[t], t))
        if not own:
            return
        total = np.cumsum([self.bound[t] for t in own]).tolist()
        for low in range(0, len(self.ids), BLOCK_DOCS):
            # The terms before `split` cannot lift a document over the threshold by themselves.
            split = int(np.searchsorted(total, best.least, side="left"))
            if split == len(own):
                return
            spans = []
            for t in own:
                a, z = self.lists[t]
                spans.append((a + int(np.searchsorted(self.doc[a:z], low)), a + int(np.searchsorted(self.doc[a:z], low + BLOCK_DOCS))))
            score = np.zeros(min(BLOCK_DOCS, len(self.ids) - low), dtype=np.int64)
            for a, z in spans[split:]:
                score[self.doc[a:z] - low] += self.gain[a:z]
            found = np.flatnonzero(score)
            score = score[found]
            for k in range(split - 1, -1, -1):
                may = score + total[k] >= best.least
                found, score = found[may], score[may]
                if not len(found):
                    break
                a, z = spans[k]
                at = a + np.searchsorted(self.doc[a:z], found + low)
                hit = at < z
                hit[hit] = self.doc[at[hit]] == found[hit] + low
                score[hit] += self.gain[at[hit]]
            may = score >= best.least
            if may.any():
                best.add(score[may], [self.ids[i] for i in (found[may] + low).tolist()])


def _searched(lists: DataFrame, weight: np.ndarray, queries: dict, n_docs: int, n_terms: int, k: int, shard_postings: int) -> DataFrame:
    """item, doc, score: each task's best k of each query."""
    spark = lists.sparkSession
    shared = spark.sparkContext.broadcast((weight, queries))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, queries = shared.value
        best = {item: Best(k) for item in queries}
        ids, parts, held, kind = [], [], 0, None

        def flush() -> None:
            nonlocal ids, parts, held
            if held:
                shard = Shard(ids, *(np.concatenate(x) for x in zip(*parts)), weight)
                for item, query in queries.items():
                    shard.search(query, best[item])
            ids, parts, held = [], [], 0

        for batch in batches:
            kind = batch.schema.field(0).type
            at = 0
            sizes = np.diff(batch.column(2).offsets.to_numpy())
            while at < batch.num_rows:
                end = at + max(1, int(np.searchsorted(np.cumsum(sizes[at:]), shard_postings - held, side="right")))
                piece = batch.slice(at, end - at)
                size = sizes[at:end]
                m = 50 + (50 * piece.column(1).to_numpy() * n_docs) // n_terms
                tf = piece.column(3).flatten().to_numpy()
                gain = (1_000_000_000 * tf) // (1000 * tf + 20 * np.repeat(m, size))
                parts.append((np.repeat(np.arange(len(ids), len(ids) + len(size)), size), piece.column(2).flatten().to_numpy(), gain))
                ids += piece.column(0).to_pylist()
                held += int(size.sum())
                at = end
                if held >= shard_postings:
                    flush()
        flush()
        rows = [(item, d, int(s)) for item, b in best.items() for s, d in zip(b.score, b.doc)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], kind), pa.array([r[2] for r in rows], pa.int64())], names=["item", "doc", "score"])

    return lists.mapInArrow(run, f"item bigint, doc {lists.schema['doc'].dataType.simpleString()}, score bigint")


def search(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", k: int = TOP, shard_postings: int = SHARD_POSTINGS, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_key (long), rank, key, score: the k best documents of every item."""
    asked = saved(queries_of(items.withColumn(item_key, F.col(item_key).cast("long")), item_key, item_text), "queries")
    blocks = max(1, -(-asked.count() // block_terms))
    out = None
    for block in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block)
        found = _block(docs, own, key, text, k, shard_postings)
        out = found if out is None else out.unionByName(found)
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc")))
    return out.withColumn("rank", rank).where(F.col("rank") <= k).select(F.col("item").alias(item_key), "rank", F.col("doc").alias(key), "score")


def _block(docs: DataFrame, asked: DataFrame, key: str, text: str, k: int, shard_postings: int) -> DataFrame:
    """One block of queries, whose terms number about BLOCK_TERMS."""
    pairs = sorted(asked.toLocalIterator(), key=lambda r: (r["item"], bytes(r["term"])))
    vocabulary: dict[bytes, int] = {}
    queries: dict[int, list[int]] = {}
    for r in pairs:
        queries.setdefault(r["item"], []).append(vocabulary.setdefault(bytes(r["term"]), len(vocabulary)))
    lists = saved(postings(docs, vocabulary, key, text), "postings")
    size = lists.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("l")).first()
    frequency = np.zeros(len(vocabulary), dtype=np.int64)
    # One row for each term of the block, so its size is bounded.
    for r in lists.select(F.explode("term").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).toLocalIterator():
        frequency[r["term"]] = r["df"]
    weight = np.floor(1000 * np.log((2 * size["n"] + 2) / (2 * frequency + 1))).astype(np.int64)
    return _searched(lists.where(F.size("term") > 0), weight, queries, size["n"], max(1, size["l"]), k, shard_postings)
