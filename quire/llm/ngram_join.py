"""Near-duplicate documents by an n-gram Jaccard join with MinHash banding.

Each text's set of word n-grams (hashed to 64 bits) gets a MinHash signature; bands of it are hashed, and the shuffle is
on band hashes.  Identical texts are one node.  In a bucket of few nodes all pairs are candidates; in a larger one every
node is paired with the bucket's centre (the node that meets most others over all its buckets).  Candidates are verified
on the full n-gram sets, verified links give components, and nodes of large buckets that are still in different
components are then compared with each other block by block: signatures first, then again the full sets.  So a large
group costs as many rows as it has members, yet links between its members that the centre does not show are found.

The number of bands is the least that finds a pair at the threshold with probability `recall`.

Defined results: words are runs of letters and digits, lower-cased; a text of fewer words than n has its words as its
one n-gram; null texts and texts without words link to nothing; null ids get a class of null; rows that share an id are
one document, so the classes of all its texts are one; class_id is the smallest id of the class; n_links is the number of other texts of the class that are
similar enough, each compared on the full n-gram sets (see link_counts), for an id of several texts that of the text
with most; of each class one row is kept.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ROW, components, hot_join, rejoin, row_key, saved, shuffled, spread_join, trim

NGRAM = 5
THRESHOLD = 0.8
RECALL = 0.9995
BAND_ROWS = 6
#: Buckets up to this many nodes give all their pairs.
SMALL = 6
#: Nodes in a block when large buckets are compared.
BLOCK = 512
#: Nodes, and characters of text, in a block when the links of a component are counted.
LINK_BLOCK = 1024
LINK_CHARS = 8_000_000
#: Further MinHashes for nodes of large buckets, so that few pairs below the threshold pass on signatures.
EXTRA = 640
_words = re.compile(r"[^\W_]+").findall


def bands_for(threshold: float, rows: int, recall: float) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted distinct n-gram hashes of a text; word hashes are kept between texts up to a bound."""

    def __init__(self, n: int, most: int = 200_000) -> None:
        self.n, self.most = n, most
        self.known: dict[str, int] = {}

    def words(self, text: str) -> np.ndarray:
        found = _words(text.lower())
        known = self.known
        new = set(found).difference(known)
        if new:
            if len(known) + len(new) > self.most:
                known.clear()
                new = set(found)
            for w in new:
                known[w] = int.from_bytes(hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
        return np.array([known[w] for w in found], dtype=np.uint64)

    def grams(self, word: np.ndarray) -> np.ndarray:
        if not len(word):
            return word
        n = min(self.n, len(word))
        total = np.zeros(len(word) - n + 1, dtype=np.uint64)
        for k in range(n):
            total = _mix(total + word[k : len(word) - n + 1 + k])
        return np.unique(total)

    def __call__(self, text: str | None) -> np.ndarray:
        return self.grams(self.words(text or ""))


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if both else 0.0


def signatures(docs: DataFrame, key: str, text: str, n: int, bands: int, rows: int) -> DataFrame:
    """row, id, digest (of the words), sig (one byte of each MinHash), bands (hashes) for each document with words."""
    rng = np.random.default_rng(20240)
    mult = rng.integers(1, 1 << 62, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    add = rng.integers(0, 1 << 62, bands * rows, dtype=np.uint64)
    weight = rng.integers(1, 1 << 62, rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(n)
        number = np.arange(bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for batch in batches:
            at, digests, sigs, keys = [], [], [], []
            for i, value in enumerate(batch.column(2)):
                word = shingle.words(value.as_py() or "")
                if not len(word):
                    continue
                grams = shingle.grams(word)
                low = _minhash(grams, mult, add)
                low64 = low.astype(np.uint64)
                band = _mix((low64.reshape(bands, rows) * weight).sum(axis=1, dtype=np.uint64) + number)
                at.append(i)
                digests.append(hashlib.blake2b(word.tobytes(), digest_size=16).digest())
                sigs.append((low & 0xFF).astype(np.uint8).tobytes())
                keys.append(band.view(np.int64))
            yield pa.RecordBatch.from_arrays([*[c.take(pa.array(at, pa.int64())) for c in batch.columns[:2]], pa.array(digests, pa.binary()), pa.array(sigs, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], names=["row", "id", "digest", "sig", "bands"])
        del shingle
        trim()

    source = docs.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(row_key(key, text).alias("row"), F.col(key).cast("long").alias("id"), F.col(text).alias("t"))
    return source.mapInArrow(run, "row binary, id bigint, digest binary, sig binary, bands array<bigint>")


def _minhash(grams: np.ndarray, mult: np.ndarray, add: np.ndarray) -> np.ndarray:
    low = np.full(len(mult), np.iinfo(np.uint32).max, dtype=np.uint32)
    for at in range(0, len(grams), 2048):
        part = ((grams[at : at + 2048, None] * mult + add) >> np.uint64(32)).astype(np.uint32)
        low = np.minimum(low, part.min(axis=0))
    return low


def _wider(texts: DataFrame, n: int) -> DataFrame:
    """node, more: EXTRA further MinHash bytes, for the few nodes that large buckets leave to compare."""
    rng = np.random.default_rng(20241)
    mult = rng.integers(1, 1 << 62, EXTRA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    add = rng.integers(0, 1 << 62, EXTRA, dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(n)
        for batch in batches:
            more = [(_minhash(shingle(t.as_py()), mult, add) & 0xFF).astype(np.uint8).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(more, pa.binary())], names=["node", "more"])

    return texts.mapInArrow(run, "node bigint, more binary")


def _verified(pairs: DataFrame, texts: DataFrame, n: int, threshold: float) -> DataFrame:
    """Of (a, b) pairs those whose full n-gram sets are similar enough: a, b, similarity."""
    both, total = pairs, pairs.count()
    for side in "ab":  # a node may be in many pairs on either side
        count = pairs.groupBy(side).agg(F.count(F.lit(1)).alias("n"))
        both = spread_join(both, count.join(shuffled(texts.select(F.col("id").alias(side), F.col("t").alias(f"t{side}"))), side), side, "n", total).drop("n")
    both = both.select("a", "b", "ta", "tb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, last, grams = Shingler(n), None, None
        for batch in batches:
            keep, score = [], []
            a = batch.column(0).to_pylist()
            for i in sorted(range(batch.num_rows), key=a.__getitem__):
                if a[i] != last:
                    last, grams = a[i], shingle(batch.column(2)[i].as_py())
                s = jaccard(grams, shingle(batch.column(3)[i].as_py()))
                if s >= threshold:
                    keep.append(i)
                    score.append(s)
            take = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(score, pa.float64())], names=["a", "b", "similarity"])
        del shingle, grams
        trim()

    return both.mapInArrow(run, "a bigint, b bigint, similarity double")


def links(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = NGRAM, threshold: float = THRESHOLD, recall: float = RECALL, band_rows: int = BAND_ROWS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(members: id, node), (roots: node, root, for linked nodes), (texts: id (the node), t, of at least those).

    A node is a text (its words), whatever ids it has; nodes of one id are linked."""
    bands = bands_for(threshold, band_rows, recall)
    signed = saved(signatures(docs, key, text, n, bands, band_rows), "signatures")
    nodes = saved(signed.groupBy("digest").agg(F.min("row").alias("row"), F.count(F.lit(1)).alias("n"), F.min("sig").alias("sig"), F.min("bands").alias("bands")).withColumn("node", F.monotonically_increasing_id()), "nodes")
    members = hot_join(signed.select("id", "digest"), nodes.select("digest", "node", "n"), "digest", "n", signed.count()).select("id", "node")
    several = members.groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a <> z")
    same_id = saved(members.join(shuffled(several), "id").where("node <> a").select("a", F.col("node").alias("b")).distinct(), "same_id")

    band = nodes.select("node", F.posexplode("bands").alias("band", "bucket")).distinct()
    sized = band.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    total = nodes.count() * bands
    meets = saved(hot_join(band, sized, "bucket", "n", total).where("n IS NOT NULL"), "buckets")
    weight = meets.groupBy("node").agg(F.sum("n").alias("weight"))
    centre = meets.join(shuffled(weight), "node").groupBy("bucket").agg(F.max_by("node", F.struct("weight", -F.col("node"))).alias("centre"), F.max("n").alias("n"))
    star = hot_join(meets.select("bucket", "node"), centre, "bucket", "n", total).where("centre <> node").select("centre", "node")
    few = meets.where(F.col("n") <= SMALL).groupBy("bucket").agg(F.array_sort(F.collect_set("node")).alias("all"))
    few = few.select(F.posexplode("all").alias("at", "x"), "all").select("x", F.explode(F.expr("slice(all, at + 2, size(all))")).alias("y"))
    pairs = saved(star.select(F.least("centre", "node").alias("a"), F.greatest("centre", "node").alias("b")).unionByName(few.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))).distinct(), "pairs")

    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).unionByName(meets.where(F.col("n") > SMALL).select("node"))
    wanted = wanted.unionByName(same_id.select(F.col("a").alias("node"))).unionByName(same_id.select(F.col("b").alias("node"))).distinct()
    source = docs.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(row_key(key, text).alias(ROW), F.col(text).alias("t"))
    texts = rejoin(source, nodes.join(shuffled(wanted), "node").select(F.col("row").alias(ROW), "node"), "left").where("node IS NOT NULL")
    texts = saved(texts.groupBy(F.col("node").alias("id")).agg(F.min("t").alias("t")), "texts")
    edges = saved(_verified(pairs, texts, n, threshold), "edges")
    roots = components(edges.select("a", "b").unionByName(same_id))

    # Large buckets whose nodes are not all in one component yet.
    large = meets.where(F.col("n") > SMALL).join(shuffled(roots), "node", "left").select("bucket", "band", "node", "n", F.coalesce("root", "node").alias("root"))
    parts = large.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("m")).groupBy("bucket").agg(F.count(F.lit(1)).alias("parts"), F.max_by("root", F.struct("m", "root")).alias("main"), F.sum("m").alias("n")).where("parts > 1")
    if not parts.isEmpty():
        rest = saved(hot_join(large.select("bucket", "band", "node", "root"), parts, "bucket", "n", total).where("main IS NOT NULL").join(shuffled(nodes.select("node", "sig", "bands")), "node"), "rest")
        wide = _wider(texts.join(shuffled(rest.select(F.col("node").alias("id")).distinct()), "id", "left_semi").select(F.col("id").alias("node"), "t"), n)
        rest = saved(rest.join(shuffled(saved(wide, "wide")), "node").withColumn("sig", F.concat("sig", "more")).drop("more"), "rest")
        block = F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / BLOCK).cast("long"))
        held = F.collect_list(F.struct("node", "root", "sig", "bands", (F.col("root") != F.col("main")).alias("odd")))
        every = rest.groupBy("bucket", "band", block.alias("k")).agg(held.alias("all"))
        odd = rest.where("root <> main").groupBy("bucket", "band", block.alias("j")).agg(held.alias("some"))
        least = threshold - 4 * math.sqrt(threshold * (1 - threshold) / (bands * band_rows + EXTRA))

        def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Pairs across components that the signatures let pass, each only in the first band whose hash (hence bucket) the two share."""
            for batch in batches:
                a, b = [], []
                for i in range(batch.num_rows):
                    band, one, two = batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), batch.column(2)[i].as_py()
                    sig = np.frombuffer(b"".join(x["sig"] for x in two), dtype=np.uint8).reshape(len(two), -1)
                    hashes = np.array([x["bands"] for x in two], dtype=np.int64)
                    roots, ids, odds = (np.array([x[c] for x in two]) for c in ("root", "node", "odd"))
                    for x in one:
                        same = sig == np.frombuffer(x["sig"], dtype=np.uint8)
                        good = (roots != x["root"]) & (~odds | (ids > x["node"])) & (same.mean(axis=1) >= least)
                        near = np.flatnonzero(good)
                        near = near[(hashes[near] == np.array(x["bands"], dtype=np.int64)).argmax(axis=1) == band]
                        for j in ids[near].tolist():
                            a.append(min(x["node"], j))
                            b.append(max(x["node"], j))
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        more = odd.join(shuffled(every), ["bucket", "band"]).select("band", "some", "all").mapInArrow(near, "a bigint, b bigint").distinct().join(shuffled(pairs), ["a", "b"], "left_anti")
        found = saved(_verified(saved(more, "more"), texts, n, threshold), "edges2")
        if not found.isEmpty():
            edges = edges.unionByName(found)
            roots = components(edges.select("a", "b").unionByName(same_id))
    return members, roots, texts


def shared_grams(a: list[np.ndarray], b: list[np.ndarray] | None = None) -> np.ndarray:
    """len(a) x len(b) sizes of the intersections of n-gram sets; without b, of a with itself."""
    every = a + (b or [])
    _, code = np.unique(np.concatenate(every), return_inverse=True)
    often = np.bincount(code) > 1
    keep = often[code]
    col = (np.cumsum(often) - 1)[code[keep]]
    row = np.repeat(np.arange(len(every)), [len(x) for x in every])[keep]
    order = np.argsort(col, kind="stable")
    col, row = col[order], row[order]
    total = np.zeros((len(a), len(b or a)), dtype=np.float32)
    for at in range(0, int(often.sum()), 2048):
        part = slice(*np.searchsorted(col, [at, at + 2048]))
        m = np.zeros((len(every), 2048), dtype=np.float32)
        m[row[part], col[part] - at] = 1
        total += m[: len(a)] @ (m[len(a) :] if b else m).T
    return total


def link_counts(roots: DataFrame, texts: DataFrame, n: int = NGRAM, threshold: float = THRESHOLD) -> DataFrame:
    """node, n_links: the other nodes of its component that are similar enough, all of them, on the full n-gram sets.

    A component is cut into blocks of bounded size; two blocks meet in one task, as matrices whose product holds all
    intersections, and only counts leave the task.  So no pair becomes a row."""
    length = texts.select(F.col("id").alias("node"), F.length("t").alias("chars"))
    sized = roots.join(shuffled(length), "node").groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"))
    sized = saved(sized.select("root", "n", F.ceil(F.greatest(F.col("n") / LINK_BLOCK, F.col("chars") / LINK_CHARS)).cast("int").alias("blocks")), "components")
    placed = hot_join(roots, sized, "root", "n", roots.count()).where("n > 2").select("node", "root", "blocks")

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(n)
        for batch in batches:
            found = pa.array([shingle(t.as_py()).tobytes() for t in batch.column(3)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], found], names=["node", "root", "blocks", "grams"])

    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    held = placed.join(shuffled(texts.select(F.col("id").alias("node"), "t")), "node").select("node", "root", "blocks", "t").mapInArrow(grams, "node bigint, root bigint, blocks int, grams binary")
    held = held.withColumn("own", own).select("root", "node", "own", "grams", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    held = held.select("root", "node", "own", "grams", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"))

    def meet(table: pa.Table) -> pa.Table:
        node, block = (np.asarray(table[c].to_numpy()) for c in ("node", "own"))
        sets = [np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in table["grams"]]
        size = np.array([len(x) for x in sets], dtype=np.float64)
        lo, hi = table["lo"][0].as_py(), table["hi"][0].as_py()
        one, two = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
        count = np.zeros(len(node), dtype=np.int64)
        if len(one) and len(two):
            both = shared_grams([sets[i] for i in one], None if lo == hi else [sets[i] for i in two]).astype(np.float64)
            good = both / (size[one][:, None] + size[two][None, :] - both) >= threshold
            if lo == hi:
                np.fill_diagonal(good, False)
            else:
                count[two] = good.sum(axis=0)
            count[one] = good.sum(axis=1)
        return pa.table({"node": pa.array(node, pa.int64()), "n_links": pa.array(count, pa.int64())})

    many = held.groupBy("root", "lo", "hi").applyInArrow(meet, "node bigint, n_links bigint").groupBy("node").agg(F.sum("n_links").alias("n_links"))
    pair = hot_join(roots, sized, "root", "n", roots.count()).where("n = 2").select("node", F.lit(1).cast("long").alias("n_links"))
    return many.unionByName(pair)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = NGRAM, threshold: float = THRESHOLD, recall: float = RECALL, count_links: bool = True) -> DataFrame:
    """key, class_id, class_size, n_links (0 without count_links), kept for every row."""
    members, roots, texts = links(docs, key, text, n, threshold, recall)
    degree = link_counts(roots, texts, n, threshold) if count_links else roots.select("node", F.lit(0).cast("long").alias("n_links"))
    classed = members.join(shuffled(roots), "node", "left").join(shuffled(degree), "node", "left").select("id", F.coalesce("root", "node").alias("root"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))
    # Nodes of one id share a root.
    one = saved(classed.groupBy("id").agg(F.min("root").alias("root"), F.max("n_links").alias("n_links")), "members")
    named = one.groupBy("root").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("n"))
    one = hot_join(one, named, "root", "n", one.count()).select("id", "class_id", "n_links")
    rows = docs.select(F.col(key).cast("long").alias("id")).join(shuffled(one), "id", "left").select("id", F.coalesce("class_id", "id").alias("class_id"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))
    rows = saved(rows, "classed")
    sizes = rows.groupBy("class_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    out = hot_join(rows, sizes.where("class_id IS NOT NULL"), "class_id", "n", rows.count())
    out = out.withColumn("class_size", F.coalesce("n", F.lit(1).cast("long")))
    head = F.col("id").eqNullSafe(F.col("class_id")) & (F.col("class_size") > 1)
    first = out.where(head).withColumn("kept", F.row_number().over(Window.partitionBy("class_id").orderBy("id")) == 1)
    rest = out.where(~head).withColumn("kept", (F.col("class_size") == 1))
    return first.unionByName(rest).select(F.col("id").alias(key), "class_id", "class_size", "n_links", "kept")


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The input with one document of each class: the one with the smallest id (of repeated rows of it, one)."""
    found = saved(near_duplicates(docs, key, text, count_links=False), "classes")
    gone = found.where(f"NOT kept AND `{key}` <> class_id").select(F.col(key).alias(ROW)).distinct()
    out = rejoin(docs.withColumn(ROW, F.col(key).cast("long")), gone, "left_anti")
    again = found.where(f"NOT kept AND `{key}` = class_id").select(F.col(key).alias(ROW)).distinct()
    if not again.isEmpty():  # an id with several rows
        twice = out.join(shuffled(again), ROW, "left_semi").withColumn("__quire_at", F.row_number().over(Window.partitionBy(ROW).orderBy(row_key(key, text)))).where("__quire_at = 1")
        out = out.join(shuffled(again), ROW, "left_anti").unionByName(twice.drop("__quire_at"))
    return out.select(*docs.columns)
