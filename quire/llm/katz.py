"""Scores of texts under a Katz backoff model of word pairs, learned from the corpus on Spark.

Tokens are words, then one end for each text.  Unigrams are counted as strings; of each pair (context, word) the count
decides: a pair that training holds has its Good-Turing discounted share, any other one backs off to its word with the
weight that makes the context's probabilities sum to one exactly, and a word that training lacks backs off to the mass
that unigram discounts leave (one class of unknown words).

How it runs: a task turns its documents into blocks; a block's distinct pairs, with the documents that hold them, are
dealt over buckets by the word (frequent words by the whole pair, so that no bucket is hot).  A bucket so holds every
count of its pairs and words.  It gives each document its sums, each context the discounts and the unigram mass of its
pairs, and asks the contexts for the backoff weights of unseen pairs.  The results are written as a table partitioned by
kind; contexts are summed by bucket of the context and answer there, and a block gathers its documents' sums.  Since log
probabilities add up, no token becomes a row.  Contexts of frequent words are few (under HOT_PARTS) and broadcast.

Discounts: Good-Turing ratios for counts up to 5 (fewer where they are not between 0 and 1).  Katz leaves larger counts
whole; here they keep the ratio of the last one, because a context whose pairs are all frequent would else have no mass
for unseen words, and their logarithm would not exist.

Words are 64-bit hashes; the seed is changed until no two words of training share one.  Of words outside training, one
in 2^64 / vocabulary is taken for a known one.

Defined results: null texts count as empty (one end); rows of a null id are scored, not held out and never learned from;
repeated rows are learned from and scored once each; without training rows all scores are 0; an empty table gives no rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import HOT_PARTS, saved, scratch, shuffles_deleted

#: Counts with a Good-Turing ratio of their own.
LARGEST = 5
#: Tokens of a block of documents, at least.
BLOCK_TOKENS = 1_500_000
#: Documents after which a block's tokens are counted.
BATCH_ROWS = 256
#: Tokens of a bucket of pairs, about.
BUCKET_TOKENS = 2_000_000
#: Stand for the start and end of a text; words are hashed with seeds, so these are as unlikely as any collision.
START, END = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)
#: Kinds of rows between the steps.
PAIRS, SUMS, CONTEXTS, UNSEEN, COUNTS, DOCUMENTS = range(6)
ROWS = "kind int, bucket int, block bigint, data binary"


def held_out(key: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(5)) == 1, F.lit(False))


def _packed(*arrays) -> bytes:
    small = [a.astype(np.min_scalar_type(int(a.max()))) if isinstance(a, np.ndarray) and a.dtype.kind in "iu" and a.dtype != np.uint64 and len(a) else a for a in arrays]
    return zstandard.compress(pickle.dumps(small, 5), 1)


def _opened(data) -> list:
    return pickle.loads(zstandard.decompress(data))


def _row(kind: int, bucket: int, block: int, data: bytes) -> tuple:
    return kind, bucket, block, data


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int32(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=["kind", "bucket", "block", "data"])


@dataclass
class Tokens:
    """Words of a run of texts: the distinct ones, and for each text, one after the other, their numbers."""

    words: pa.Array
    number: np.ndarray
    sizes: np.ndarray
    columns: list = field(default_factory=list)


def blocks(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[Tokens]:
    """Runs of documents with at least so many tokens; the texts are column 0, the other columns go along."""
    held: list[pa.RecordBatch] = []
    texts: list[pa.Array] = []
    n = 0

    def made() -> Tokens:
        lists = pa.concat_arrays(texts)
        sizes = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten()
        full = pc.greater(pc.binary_length(flat), 0)
        owner = np.repeat(np.arange(len(sizes)), sizes)[full.to_numpy(zero_copy_only=False)]
        coded = flat.filter(full).dictionary_encode()
        columns = [pa.chunked_array([b.column(i) for b in held]).combine_chunks() for i in range(1, held[0].num_columns)]
        return Tokens(coded.dictionary, coded.indices.to_numpy(), np.bincount(owner, minlength=len(sizes)), columns)

    for batch in (b.slice(at, BATCH_ROWS) for b in batches for at in range(0, b.num_rows, BATCH_ROWS)):
        if batch.num_rows:
            held.append(batch)
            texts.append(pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(batch.column(0), ""))))
            n += len(texts[-1].flatten()) + batch.num_rows
        if n >= least:
            yield made()
            held, texts, n = [], [], 0
    if held:
        yield made()


def _hashes(words: pa.Array, seed: int) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w, seed) for w in words.cast(pa.binary()).to_pylist()), dtype=np.uint64, count=len(words))


def unigrams(docs: DataFrame, text: str) -> DataFrame:
    """word, n: counts of the words of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in blocks(batches, BLOCK_TOKENS):
            yield pa.RecordBatch.from_arrays([t.words, pa.array(np.bincount(t.number, minlength=len(t.words)), pa.int64())], names=["word", "n"])

    return docs.select(F.col(text).alias("t")).mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Discounts:
    """Ratios of discounted to full counts: `low` for the counts 1 to LARGEST, `high` beyond."""

    low: list[float]
    high: float

    @staticmethod
    def of(n: list[int]) -> Discounts:
        """From the numbers of items that occur 1, 2, ... LARGEST + 1 times."""
        for k in range(LARGEST, 0, -1):
            if all(n[: k + 1]):
                common = (k + 1) * n[k] / n[0]
                if common < 1:
                    ratios = [((r + 1) * n[r] / (r * n[r - 1]) - common) / (1 - common) for r in range(1, k + 1)]
                    if all(0 < d < 1 for d in ratios):
                        return Discounts([*ratios, *[ratios[-1]] * (LARGEST - k)], ratios[-1])
        return Discounts([0.75] * LARGEST, 0.75)

    def counts(self, c: np.ndarray) -> np.ndarray:
        """Discounted counts."""
        return c * np.array([0.0, *self.low, self.high])[np.minimum(c, LARGEST + 1)]


@dataclass
class Words:
    """What all tasks know of the unigrams: all of it of bounded size."""

    seed: int
    total: int
    kinds: int
    texts: int
    discounts: Discounts
    unknown: float
    hot: np.ndarray
    hot_count: np.ndarray

    def log_share(self, c: np.ndarray) -> np.ndarray:
        """log10 of the discounted share of words with these counts; 0 is the class of unknown words."""
        return np.log10(np.where(c > 0, self.discounts.counts(c) / max(1, self.total), self.unknown))


def learn_words(train: DataFrame, text: str) -> Words:
    counted = saved(unigrams(train, text), "unigrams")
    texts = train.count()
    kinds = counted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("sum"), F.count(F.lit(1)).alias("kinds"), *[F.count(F.when(F.col("n") == r, 1)).alias(f"n{r}") for r in range(1, LARGEST + 2)]).first()
    once = [kinds[f"n{r}"] + (texts == r) for r in range(1, LARGEST + 2)]
    total = kinds["sum"] + texts
    for seed in range(1, 100):

        def hashed(batches: Iterator[pa.RecordBatch], seed: int = seed) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array(_hashes(batch.column(0), seed).view(np.int64))], names=["h"])

        if counted.select("word").mapInArrow(hashed, "h bigint").groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
            break
    # Fewer than HOT_PARTS words have more than 1/HOT_PARTS of all tokens.
    hot = counted.where(F.col("n") > total // HOT_PARTS).collect()
    names = np.concatenate([_hashes(pa.array([r["word"] for r in hot], pa.string()), seed), [END, START]]).astype(np.uint64)
    counts = np.array([*[r["n"] for r in hot], texts, 0], dtype=np.int64)
    order = np.argsort(names)
    discounts = Discounts.of(once)
    few = sum(r * n for r, n in zip(range(1, LARGEST + 1), once))
    kept = sum(r * n * d for r, n, d in zip(range(1, LARGEST + 1), once, discounts.low)) + (total - few) * discounts.high
    return Words(seed, total, kinds["kinds"] + (texts > 0), texts, discounts, 1 - kept / total if total else 1.0, names[order], counts[order])


def _member(values: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which values stand in the sorted array `of`, where)."""
    at = np.minimum(np.searchsorted(of, values), max(0, len(of) - 1))
    return (of[at] == values if len(of) else np.zeros(len(values), bool)), at


def _bucket(h: np.ndarray, also: np.ndarray, spread: np.ndarray, n: int) -> np.ndarray:
    mixed = np.where(spread, h ^ (also * np.uint64(0xC2B2AE3D27D4EB4F)), h)
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((mixed >> np.uint64(33)) % np.uint64(n)).astype(np.int32)


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where a new value begins in arrays that are sorted together."""
    new = np.ones(len(keys[0]), dtype=bool)
    if len(new):
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(new)


def _pairs_of(t: Tokens, learn: np.ndarray, words: Words, buckets: int) -> Iterator[tuple[int, bytes]]:
    """Of a block, for each bucket: its words, contexts, pairs with their counts in training, and the documents that hold them."""
    name = np.concatenate([_hashes(t.words, words.seed), [END, START]]).astype(np.uint64)
    sizes = t.sizes + 1
    last = np.cumsum(sizes) - 1
    target = np.full(int(sizes.sum()), len(name) - 2, dtype=np.int64)
    inner = np.ones(len(target), dtype=bool)
    inner[last] = False
    target[inner] = t.number
    context = np.empty_like(target)
    context[1:] = target[:-1]
    context[last - sizes + 1] = len(name) - 1
    doc = np.repeat(np.arange(len(sizes)), sizes)
    pair = target * len(name) + context
    del target, context, inner
    if len(name) ** 2 * len(sizes) < 2**62:
        pair *= len(sizes)
        pair += doc
        pair.sort()
        at = _starts(pair)
        m = np.diff(at, append=len(pair))
        pair, doc = np.divmod(pair[at], len(sizes))
    else:
        order = np.lexsort((doc, pair))
        pair, doc = pair[order], doc[order]
        at = _starts(pair, doc)
        m = np.diff(at, append=len(pair))
        pair, doc = pair[at], doc[at]
    at = _starts(pair)
    held = np.diff(at, append=len(pair))
    count = np.add.reduceat(np.where(learn[doc], m, 0), at)
    target, context = np.divmod(pair[at], len(name))
    hot = np.isin(name, words.hot)
    bucket = _bucket(name[target], name[context], hot[target], buckets)
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in range(buckets):
        own = order[edges[b] : edges[b + 1]]
        if len(own):
            first = _starts(target[own])
            context_names, c = np.unique(context[own], return_inverse=True)
            where = np.repeat(at[own], held[own]) + (np.arange(int(held[own].sum())) - np.repeat(np.cumsum(held[own]) - held[own], held[own]))
            yield b, _packed(name[target[own][first]], np.diff(first, append=len(own)), name[context_names], c, count[own], held[own], doc[where], m[where])


def _counted(pieces: list[tuple[int, bytes]], words: Words, buckets: int) -> Iterator[tuple]:
    """All that one bucket has to say: sums of documents, sums of contexts, questions of unseen pairs, counts of counts."""
    blocks_, parts = [b for b, _ in pieces], [_opened(d) for _, d in pieces]
    targets = np.concatenate([np.repeat(p[0], p[1]) for p in parts])
    contexts = np.concatenate([p[2][p[3]] for p in parts])
    order = np.lexsort((contexts, targets))
    t, c = targets[order], contexts[order]
    first = _starts(t, c)
    t, c = t[first], c[first]
    r = np.add.reduceat(np.concatenate([p[4] for p in parts]).astype(np.int64)[order], first)
    word = _starts(t)
    size = np.diff(word, append=len(t))
    count = np.add.reduceat(r, word)
    is_hot, at = _member(t[word], words.hot)
    count = np.repeat(np.where(is_hot, words.hot_count[at] if len(at) else 0, count), size)
    share = words.log_share(count)
    kind_of = np.empty(len(order), dtype=np.int64)
    kind_of[order] = np.repeat(np.arange(len(first)), np.diff(first, append=len(order)))

    base = np.log10(count + 0.5)
    own = np.where(r > LARGEST, np.log10(np.maximum(r, 1)), 0.0) + np.where(r == 0, share, 0.0) - np.where(t == END, 0.0, np.log10(np.maximum(count, 1)))
    start, asked = 0, []
    for block, p in zip(blocks_, parts):
        kind = np.repeat(kind_of[start : start + len(p[3])], p[5])
        start += len(p[3])
        docs, doc = np.unique(p[6], return_inverse=True)
        m = p[7].astype(np.float64)
        add = lambda v, doc=doc, m=m, docs=docs: np.bincount(doc, v * m, len(docs))
        group = np.minimum(r[kind], LARGEST + 1)
        seen = [add(group == g).astype(np.int64) for g in range(1, LARGEST + 2)]
        yield _row(SUMS, 0, block, _packed(docs, add(base[kind]), add(own[kind]), add(count[kind] > 0).astype(np.int64), *seen))
        new = np.flatnonzero(group == 0)
        if len(new):
            asked.append((c[kind[new]], np.full(len(new), block), p[6][new].astype(np.int64), p[7][new].astype(np.int64)))
    if asked:
        ask, block, doc, m = (np.concatenate(x) for x in zip(*asked))
        to = _bucket(ask, block.astype(np.uint64), np.isin(ask, words.hot), buckets)
        for b in np.unique(to).tolist():
            k = np.flatnonzero(to == b)
            yield _row(UNSEEN, b, 0, _packed(ask[k], block[k], doc[k], m[k]))

    known = np.flatnonzero(r > 0)
    known = known[np.argsort(c[known], kind="stable")]
    if len(known):
        first = _starts(c[known])
        r, name, mass = r[known], c[known][first], np.add.reduceat(10.0 ** share[known], first)
        few = [np.add.reduceat((r == g).astype(np.int64), first) for g in range(1, LARGEST + 1)]
        many = np.add.reduceat(np.where(r > LARGEST, r, 0), first)
        to = np.where(np.isin(name, words.hot), -1, _bucket(name, name, np.zeros(len(name), bool), buckets))
        for b in np.unique(to).tolist():
            k = np.flatnonzero(to == b)
            yield _row(CONTEXTS, b, 0, _packed(name[k], *[x[k] for x in few], many[k], mass[k]))
        yield _row(COUNTS, 0, 0, _packed(np.bincount(np.minimum(r, LARGEST + 2), minlength=LARGEST + 3)))


def _weights(data: list[bytes], discounts: Discounts) -> tuple[np.ndarray, np.ndarray]:
    """Contexts and log10 of the mass left to them (as a count) over the unigram mass that their pairs leave."""
    parts = [_opened(d) for d in data]
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0)
    name, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    total = lambda i: np.bincount(at, np.concatenate([p[i] for p in parts]).astype(np.float64), len(name))
    left = sum(total(r) * r * (1 - d) for r, d in zip(range(1, LARGEST + 1), discounts.low)) + total(LARGEST + 1) * (1 - discounts.high)
    return name, np.log10(left) - np.log10(1 - total(LARGEST + 2))


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", block_tokens: int = BLOCK_TOKENS, bucket_tokens: int = BUCKET_TOKENS) -> DataFrame:
    """key, held_out, n_tokens, n_known, train_tokens, base_score, score for every row."""
    with shuffles_deleted(docs.sparkSession):
        return _score(docs, key, text, block_tokens, bucket_tokens)


def _score(docs: DataFrame, key: str, text: str, block_tokens: int, bucket_tokens: int) -> DataFrame:
    spark = docs.sparkSession
    rows = docs.select(F.col(text).alias("t"), F.col(key).alias("key"), held_out(key).alias("held"), (F.col(key).isNotNull() & ~held_out(key)).alias("learn"))
    words = learn_words(rows.where("learn").select("t"), "t")
    shared = spark.sparkContext.broadcast(words)
    # held-out texts are a fifth of all
    buckets = max(1, -(-5 * words.total // (4 * bucket_tokens)))

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        for n, t in enumerate(blocks(batches, block_tokens)):
            ids, held, learn = t.columns
            yield _batch([_row(DOCUMENTS, (part + n) % buckets, part + n, _packed(ids, held.to_numpy(zero_copy_only=False), t.sizes + 1))])
            for b, data in _pairs_of(t, learn.to_numpy(zero_copy_only=False), shared.value, buckets):
                yield _batch([_row(PAIRS, b, part + n, data)])

    def counted(table: pa.Table) -> pa.Table:
        own = table.to_pylist()
        out = [_row(DOCUMENTS, 0, x["block"], x["data"]) for x in own if x["kind"] == DOCUMENTS]
        pieces = [(x["block"], x["data"]) for x in own if x["kind"] == PAIRS]
        if pieces:
            out += _counted(pieces, shared.value, buckets)
        return pa.Table.from_batches([_batch(out)])

    path = scratch(spark, "pairs")
    rows.mapInArrow(pairs, ROWS).groupBy("bucket").applyInArrow(counted, ROWS).write.partitionBy("kind").parquet(path)
    found = spark.read.schema(ROWS).parquet(path)
    seen = sum((np.pad(_opened(r["data"])[0].astype(np.int64), (0, LARGEST + 3))[: LARGEST + 3] for r in found.where(F.col("kind") == COUNTS).toLocalIterator()), np.zeros(LARGEST + 3, np.int64))
    discounts = Discounts.of(seen[1 : LARGEST + 2].tolist())

    def hot_sums(table: pa.Table) -> pa.Table:
        name, weight = _weights(table["data"].to_pylist(), discounts)
        return pa.table({"h": pa.array(name.view(np.int64)), "w": pa.array(weight)})

    hot = found.where((F.col("kind") == CONTEXTS) & (F.col("bucket") == -1)).groupBy("bucket").applyInArrow(hot_sums, "h bigint, w double").collect()
    hot_name = np.array([r["h"] for r in hot], dtype=np.int64).view(np.uint64)
    hot_weight = np.array([r["w"] for r in hot], dtype=np.float64)

    def answered(table: pa.Table) -> pa.Table:
        kind, data = np.array(table["kind"]), table["data"].to_pylist()
        name, weight = _weights([d for d, k in zip(data, kind) if k == CONTEXTS], discounts)
        out = []
        parts = [_opened(d) for d, k in zip(data, kind) if k == UNSEEN]
        if parts:
            ask, block, doc, m = (np.concatenate(x) for x in zip(*parts))
            here, at = _member(ask, name)
            value = np.zeros(len(ask))
            value[here] = weight[at[here]]
            there, at = _member(ask, hot_name)
            value[there] = hot_weight[at[there]]
            order = np.lexsort((doc, block))
            block, doc = block[order], doc[order]
            first = _starts(block, doc)
            total = np.add.reduceat((value * m)[order], first)
            block, doc = block[first].astype(np.int64), doc[first]
            for b in np.unique(block).tolist():
                k = np.flatnonzero(block == b)
                out.append(_row(UNSEEN, 0, b, _packed(doc[k], total[k])))
        return pa.Table.from_batches([_batch(out)])

    answers = found.where(F.col("kind").isin(CONTEXTS, UNSEEN) & (F.col("bucket") >= 0)).groupBy("bucket").applyInArrow(answered, ROWS)
    ratio = np.log10([*discounts.low, discounts.high]) + np.log10([*range(1, LARGEST + 1), 1])
    starts = float(np.log10(max(1, words.texts)))
    base_total = float(np.log10(words.total + 0.5 * (words.kinds + 1)))

    def gathered(table: pa.Table) -> pa.Table:
        kind, data = table["kind"].to_pylist(), table["data"].to_pylist()
        ids, held, sizes = _opened(data[kind.index(DOCUMENTS)])
        base, own, known = np.zeros(len(ids)), np.full(len(ids), -starts), np.zeros(len(ids), np.int64)
        for k, d in zip(kind, data):
            if k == SUMS:
                docs_, b, x, n, *seen_ = _opened(d)
                base[docs_] += b
                known[docs_] += n.astype(np.int64)
                own[docs_] += x + sum(r * s for r, s in zip(ratio, seen_))
            elif k == UNSEEN:
                docs_, x = _opened(d)
                own[docs_] += x
        sizes = sizes.astype(np.int64)
        return pa.table({key: ids, "held_out": pa.array(held, pa.bool_()), "n_tokens": sizes, "n_known": known, "train_tokens": np.full(len(ids), words.total), "base_score": base - sizes * base_total, "score": own})

    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return found.where(F.col("kind").isin(SUMS, DOCUMENTS)).unionByName(answers).groupBy("block").applyInArrow(gathered, schema)
