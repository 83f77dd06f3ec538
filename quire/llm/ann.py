"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard, results merged.

Equal vectors are one node (the `k + 1` smallest ids stand for all: no query can need more of them).  Nodes go to shards
by a hash of the vector; a shard holds about `shard_bytes` of vectors, so the number of shards, through each of which every
query runs, depends on memory.  A shard's nodes are ordered by descending level, so the nodes of level l are a prefix and
each level's links are one flat array of fixed width.  Nodes are inserted one after the other, each by a search of the
graph so far.  Every query runs through every shard's graph, in blocks of queries, and the shards' results are merged.

Defined results: vectors that are null, zero, of another length than most, or that hold null or non-finite components
take no part, neither as queries nor as candidates; ties go to the smaller id; rows that share the query's id count as
its own; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

LINKS = 16
CANDIDATES = 48
#: Bytes of vectors in a shard.
SHARD_BYTES = 8 << 20


def _diverse(near: np.ndarray, dist: np.ndarray, vectors: np.ndarray, most: int) -> np.ndarray:
    """Of candidates in order of distance, those nearer to the node than to any taken one; then the nearest others."""
    if len(near) <= most:
        return near
    own = vectors[near]
    sq = np.einsum("ij,ij->i", own, own)
    between = sq[:, None] + sq[None, :] - 2 * (own @ own.T)
    taken, nearest = [], np.full(len(near), np.inf)
    for i in range(len(near)):
        if dist[i] < nearest[i]:
            taken.append(i)
            if len(taken) == most:
                break
            nearest = np.minimum(nearest, between[i])
    if len(taken) < most:
        chosen = set(taken)
        taken += [i for i in range(len(near)) if i not in chosen][: most - len(taken)]
    return near[np.sort(np.array(taken))]


def _wide(vectors: np.ndarray) -> np.ndarray:
    """Vectors with their squared lengths behind: their product with (-2 q, 1) orders them by distance from q."""
    return np.concatenate([vectors, np.einsum("ij,ij->i", vectors, vectors)[:, None]], axis=1)


def build(vectors: np.ndarray, seed: int = 7) -> tuple[np.ndarray, list[np.ndarray]]:
    """Order of the nodes, and for each level its flat links (level 0 first), by inserting one node after the other.

    A node searches the graph so far from the top: greedily above its own level, then in breadth CANDIDATES on each of its
    levels, where it is linked to diverse ones of the nodes found and they to it; lists that grow too long are trimmed."""
    n = len(vectors)
    rng = np.random.default_rng(seed)
    level = np.floor(-np.log(1 - rng.random(n)) / np.log(LINKS)).astype(int)
    order = np.argsort(-level, kind="stable")
    vectors, level = vectors[order], level[order].tolist()
    wide = _wide(vectors)
    held = [sum(x >= at for x in level) for at in range(level[0] + 1 if n else 0)]
    widths = [2 * LINKS if not at else LINKS for at in range(len(held))]
    links: list[list[list[int]]] = [[[] for _ in range(m)] for m in held]

    def trim(at: int, j: int) -> None:
        near = np.array(links[at][j])
        gap = vectors[near] - vectors[j]
        dist = np.einsum("ij,ij->i", gap, gap)
        rank = np.argsort(dist, kind="stable")
        links[at][j] = _diverse(near[rank], dist[rank], vectors, widths[at]).tolist()

    for i in range(1, n):
        query = np.append(-2 * vectors[i], 1.0)
        entry = [(float(wide[0] @ query), 0)]
        for at in range(len(held) - 1, -1, -1):
            entry = look(query, wide, links[at], entry, CANDIDATES if at <= level[i] else 1)
            if at > level[i]:
                continue
            near, dist = np.array([x[1] for x in entry]), np.array([x[0] for x in entry]) + wide[i, -1]
            for j in _diverse(near, dist, vectors, LINKS).tolist():
                links[at][i].append(j)
                links[at][j].append(i)
                if len(links[at][j]) > 2 * widths[at]:
                    trim(at, j)
    levels = []
    for at, w in enumerate(widths):
        flat = np.full((held[at], w), -1, dtype=np.int32)
        for j in range(held[at]):
            if len(links[at][j]) > w:
                trim(at, j)
            flat[j, : len(links[at][j])] = links[at][j]
        levels.append(flat)
    return order, levels


def look(query: np.ndarray, wide: np.ndarray, links: list[list[int]], entry: list[tuple[float, int]], breadth: int) -> list[tuple[float, int]]:
    """The `breadth` nearest nodes that a best-first walk over one level finds from `entry`, as (distance, node) in order.

    The query is (-2 q, 1), see _wide: distances are squared and less by the query's squared length."""
    seen = {x[1] for x in entry}
    todo = list(entry)
    heapq.heapify(todo)
    best = [(-d, -i) for d, i in entry]
    heapq.heapify(best)
    while todo:
        d, i = heapq.heappop(todo)
        if len(best) >= breadth and d > -best[0][0]:
            break
        near = [j for j in links[i] if j not in seen]
        if not near:
            continue
        seen.update(near)
        for dist, j in zip((wide[near] @ query).tolist(), near):
            if len(best) < breadth:
                heapq.heappush(best, (-dist, -j))
                heapq.heappush(todo, (dist, j))
            elif dist < -best[0][0]:
                heapq.heapreplace(best, (-dist, -j))
                heapq.heappush(todo, (dist, j))
    return sorted((-d, -i) for d, i in best)


class Graph:
    """A built graph ready for searches."""

    def __init__(self, vectors: np.ndarray, levels: list[np.ndarray]) -> None:
        self.vectors, self.wide = vectors, _wide(vectors)
        self.links = [[[j for j in own if j >= 0] for own in x.tolist()] for x in levels]

    def search(self, query: np.ndarray, k: int, ef: int) -> list[tuple[float, int]]:
        """The k nearest nodes found, as (distance, node); the distances are those of the vectors themselves."""
        if not len(self.vectors):
            return []
        wide_query = np.append(-2 * query, 1.0)
        entry = [(float(self.wide[0] @ wide_query), 0)]
        for at in range(len(self.links) - 1, -1, -1):
            entry = look(wide_query, self.wide, self.links[at], entry, max(ef, k) if at == 0 else 8)
        near = [i for _, i in entry]
        gap = self.vectors[near] - query
        return sorted(zip(np.sqrt(np.einsum("ij,ij->i", gap, gap)).tolist(), near))[:k]


def _usable(rows: DataFrame, vector: str) -> DataFrame:
    ok = F.col(vector).isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(vector, lambda x: x != 0)
    return rows.where(F.coalesce(ok, F.lit(False)))


def neighbours(rows: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding", shard_bytes: int = SHARD_BYTES, ef: int = 96, query_block: int = 8192) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k nearest rows by Euclidean distance; other columns are not read."""
    good = saved(_usable(rows.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), is_query.alias("q")), "v").where("id IS NOT NULL"), "vectors")
    mode = good.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    empty = "query_id bigint, rank int, vec_id bigint, score double"
    if mode is None:
        return rows.sparkSession.createDataFrame([], empty)
    good = good.where(F.size("v") == mode["dim"])
    # Of equal vectors at most k + 1 ids; the limit is applied before and after the shuffle.
    few = good.withColumn("at", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("at") <= k + 1)
    nodes = saved(few.groupBy("v").agg(F.array_sort(F.collect_set("id")).alias("ids")), "nodes")
    shards = max(1, -(-nodes.count() * mode["dim"] * 8 // shard_bytes))

    def index(table: pa.Table) -> pa.Table:
        vectors = np.array(table.column("v").combine_chunks().flatten(), dtype=np.float64).reshape(table.num_rows, -1)
        order, levels = build(vectors)
        ids = table.column("ids").to_pylist()
        return pa.table({
            "shard": pa.array([table.column("shard")[0].as_py()], pa.int64()), "dim": pa.array([vectors.shape[1]], pa.int64()), "ids": pa.array([[ids[i] for i in order]], pa.list_(pa.list_(pa.int64()))),
            "vectors": pa.array([vectors[order].tobytes()], pa.binary()), "links": pa.array([[x.tobytes() for x in levels]], pa.list_(pa.binary())), "widths": pa.array([[x.shape[1] for x in levels]], pa.list_(pa.int64())),
        })

    graphs = saved(nodes.withColumn("shard", F.pmod(F.xxhash64("v"), F.lit(shards).cast("long"))).groupBy("shard").applyInArrow(index, "shard bigint, dim bigint, ids array<array<bigint>>, vectors binary, links array<binary>, widths array<bigint>"), "graphs")
    asked = good.where("q").select("id", "v").distinct()
    blocks = max(1, -(-asked.count() // query_block))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks).cast("long"))).withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
    held = graphs.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))

    def ask(graph: pa.Table, block: pa.Table) -> pa.Table:
        q, found, score = [], [], []
        if graph.num_rows:
            dim = graph.column("dim")[0].as_py()
            vectors = np.frombuffer(graph.column("vectors")[0].as_py(), dtype=np.float64).reshape(-1, graph.column("dim")[0].as_py())
            levels = [np.frombuffer(x, dtype=np.int32).reshape(-1, w) for x, w in zip(graph.column("links")[0].as_py(), graph.column("widths")[0].as_py())]
            held = Graph(vectors, levels)
            ids = graph.column("ids")[0].as_py()
            for own, v in zip(block.column("id").to_pylist(), block.column("v").to_pylist()):
                for d, node in held.search(np.array(v, dtype=np.float64), k + 1, ef):
                    for other in ids[node]:
                        if other != own:
                            q.append(own)
                            found.append(other)
                            score.append(d)
        return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(found, pa.int64()), "score": pa.array(score, pa.float64())})

    hits = held.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInArrow(ask, "query_id bigint, vec_id bigint, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def exact_neighbours(vectors: dict[int, list[float]], queries: list[int], k: int = 10) -> Iterator[tuple[int, int, int, float]]:
    """Brute force, for tests and recall."""
    ids = np.array(sorted(vectors))
    rows = np.array([vectors[i] for i in ids], dtype=np.float64)
    for q in queries:
        d = np.sqrt(((rows - np.array(vectors[q], dtype=np.float64)) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((ids, d)) if ids[i] != q][:k]
        for r, i in enumerate(order):
            yield q, r + 1, int(ids[i]), float(d[i])
