"""Approximate nearest neighbours: a robust-pruned directed graph per shard, searched with a beam.

Vectors are dealt into shards of about `shard` by a hash of their content; equal vectors are one node that keeps its
smallest ids, as many as a search can return. A shard's graph starts from random edges. In batches, every node searches the
graph greedily for itself, the nodes visited and its present neighbours are candidates, and relaxed pruning keeps the
nearest candidate and drops those that are `alpha` times nearer to a kept one than to the node, again and again. Edges also
run back, and a node with too many is pruned the same way. Queries search every shard with a beam, in blocks, and the
results of all shards are merged. Inside a shard all searches of a batch step together in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelmart.llm.staging import staged

DEGREE, BEAM, ALPHA, BATCH = 24, 48, 1.2, 512


def _squared(x: np.ndarray, points: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Squared distances of x[i] to points[ids[i, :]]."""
    d = points[ids] - x[:, None, :]
    return np.einsum("ijk,ijk->ij", d, d)


def beam_search(x: np.ndarray, points: np.ndarray, edges: np.ndarray, entry: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids (-1: none) and squared distances of the beam's nodes for every row of x, nearest first. Edges of -1 are none."""
    n = len(x)
    ids = np.full((n, beam), -1)
    far = np.full((n, beam), np.inf, np.float32)
    first = entry[:beam]
    ids[:, : len(first)] = first
    far[:, : len(first)] = _squared(x, points, np.broadcast_to(first, (n, len(first))))
    order = np.argsort(far, axis=1)
    ids, far = np.take_along_axis(ids, order, 1), np.take_along_axis(far, order, 1)
    done = ids < 0
    live = np.arange(n)
    while len(live):
        open_ = ~done[live]
        live = live[open_.any(axis=1)]
        if not len(live):
            break
        at = np.argmax(~done[live], axis=1)
        done[live, at] = True
        near = edges[ids[live, at]]
        known = (near[:, :, None] == ids[live][:, None, :]).any(axis=2) | (near < 0)
        d = _squared(x[live], points, np.maximum(near, 0)).astype(np.float32)
        d[known] = np.inf
        near = np.where(known, -1, near)
        all_ids = np.concatenate([ids[live], near], axis=1)
        all_far = np.concatenate([far[live], d], axis=1)
        all_done = np.concatenate([done[live], known], axis=1)
        order = np.argsort(all_far, axis=1, kind="stable")[:, :beam]
        ids[live], far[live], done[live] = (np.take_along_axis(v, order, 1) for v in (all_ids, all_far, all_done))
    return ids, far


def _pruned(nodes: np.ndarray, candidates: np.ndarray, points: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Robust pruning of each node's candidates (-1: none) down to `degree`, for all nodes at once."""
    candidates = np.where(candidates == nodes[:, None], -1, candidates)
    candidates = np.sort(candidates, axis=1)
    candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = -1
    own = points[np.maximum(candidates, 0)]
    far = np.einsum("ijk,ijk->ij", own - points[nodes][:, None], own - points[nodes][:, None])
    far[candidates < 0] = np.inf
    norm = np.einsum("ijk,ijk->ij", own, own)
    apart = norm[:, :, None] + norm[:, None, :] - 2 * np.matmul(own, own.transpose(0, 2, 1))
    out = np.full((len(nodes), degree), -1)
    row = np.arange(len(nodes))
    for k in range(degree):
        best = np.argmin(far, axis=1)
        ok = np.isfinite(far[row, best])
        out[ok, k] = candidates[row, best][ok]
        far[(alpha * alpha * apart[row, best] <= far) & ok[:, None]] = np.inf
        far[row, best] = np.inf
    return out


def build(points: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node by degree, -1: none) and entry nodes of the graph over all points."""
    n = len(points)
    rng = np.random.default_rng(seed)
    edges = np.full((n, degree), -1)
    if n > 1:
        edges[:, : min(degree, 8)] = rng.integers(0, n, (n, min(degree, 8)))
    middle = int(np.argmin(((points - points.mean(axis=0)) ** 2).sum(axis=1))) if n else 0
    entry = np.unique(np.append(rng.integers(0, max(n, 1), min(n, 15)), middle)) if n else np.zeros(0, np.int64)
    for a in (1.0, alpha):
        order = rng.permutation(n)
        for s in range(0, n, BATCH):
            nodes = order[s : s + BATCH]
            seen, _ = beam_search(points[nodes], points, edges, entry, beam)
            edges[nodes] = _pruned(nodes, np.concatenate([seen, edges[nodes]], axis=1), points, degree, a)
            to, back = edges[nodes].ravel(), np.repeat(nodes, degree)
            back, to = back[to >= 0], to[to >= 0]
            by = np.argsort(to, kind="stable")
            to, back = to[by], back[by]
            over = []
            for t, group in zip(*_groups(to, back), strict=True):
                room = np.unique(np.concatenate([edges[t][edges[t] >= 0], group]))
                if len(room) <= degree:
                    edges[t] = -1
                    edges[t, : len(room)] = room
                else:
                    over.append((t, room))
            over.sort(key=lambda x: len(x[1]))
            for x in range(0, len(over), 128):
                part = over[x : x + 128]
                wide = np.full((len(part), len(part[-1][1])), -1)
                for y, (_, room) in enumerate(part):
                    wide[y, : len(room)] = room
                targets = np.array([t for t, _ in part])
                edges[targets] = _pruned(targets, wide, points, degree, a)
    return edges, entry


def _groups(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    start = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1)) if len(keys) else np.zeros(0, np.int64)
    return keys[start], np.split(values, start[1:]) if len(keys) else []


def _graph(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("ids", key=lambda s: s.map(lambda x: x[0])).reset_index(drop=True)
    points = np.stack(rows.vector.to_numpy()).astype(np.float32)
    edges, entry = build(points)
    is_entry = np.zeros(len(rows), bool)
    is_entry[entry] = True
    return pd.DataFrame(
        {"shard": rows.shard, "node": np.arange(len(rows)), "vector": rows.vector, "ids": rows.ids, "edges": list(edges.astype(np.int32)), "is_entry": is_entry}
    )


def build_index(vectors: DataFrame, k: int = 10, shard: int = 8192) -> DataFrame:
    """(shard, node, vector, ids, edges, is_entry): the graphs over all usable rows of vectors (vec_id, embedding).

    Null or zero vectors and those that hold a null or a non-finite component, and null ids, take no part. Vectors of
    different length are never compared. ids: the k + 1 smallest of a vector's distinct vec_ids.
    """
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.where("vec_id is not null and embedding is not null").where(fine).select("vec_id", v.alias("vector"))
    rows = rows.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))  # -0.0 and 0.0 are one value
    name = [F.xxhash64("vector").alias("h1"), F.xxhash64("vector", F.lit(5)).alias("h2")]
    rows = rows.select("vec_id", "vector", *name)
    # at most k + 1 rows of a vector leave each task: the row limit is applied before the shuffle as well
    ranked = rows.withColumn("nth", F.row_number().over(Window.partitionBy("h1", "h2").orderBy("vec_id"))).where(F.col("nth") <= k + 1)
    nodes = ranked.groupBy("h1", "h2").agg(F.first("vector").alias("vector"), F.sort_array(F.collect_set("vec_id")).alias("ids"))
    nodes = staged(nodes, "vectors")
    size = nodes.groupBy(F.size("vector").alias("dim")).count()
    dealt = nodes.join(staged(size, "sizes"), F.size("vector") == F.col("dim"))
    shards = F.greatest(F.ceil(F.col("count") / shard), F.lit(1))
    dealt = dealt.select(F.xxhash64("dim", F.pmod("h1", shards)).alias("shard"), "vector", "ids")
    kind = "shard long, node int, vector array<double>, ids array<long>, edges array<int>, is_entry boolean"
    return staged(dealt.groupBy("shard").applyInPandas(_graph, kind), "graph")


def _search(key, graph: pd.DataFrame, queries: pd.DataFrame, k: int, beam: int) -> pd.DataFrame:
    out = []
    if len(graph) and len(queries):
        graph = graph.sort_values("node")
        exact = np.stack(graph.vector.to_numpy())
        edges, points = np.stack(graph.edges.to_numpy()), exact.astype(np.float32)
        ids = graph.ids.to_numpy()
        for s in range(0, len(queries), BATCH):
            part = queries.iloc[s : s + BATCH]
            x = np.stack(part.vector.to_numpy())
            found, _ = beam_search(x.astype(np.float32), points, edges, np.flatnonzero(graph.is_entry.to_numpy()), beam)
            d = np.sqrt(_squared(x, exact, np.maximum(found, 0)))
            d[found < 0] = np.inf
            for q, near, far in zip(part.query_id, found, d, strict=True):
                best = sorted((float(f), int(i)) for n, f in zip(near, far, strict=True) if n >= 0 for i in ids[n] if i != q)[:k]
                out += [(q, i, f) for f, i in best]
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})


def search(index: DataFrame, queries: DataFrame, k: int = 10, beam: int = 128, block: int = 4096) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest found by Euclidean distance, never the row of its own id.

    queries: query_id, vector (array<double>); ties go to the smaller vec_id. Each block of queries meets every shard once.
    """
    blocks = max(1, -(-queries.count() // block))
    shards = index.select("shard", F.size("vector").alias("dim")).distinct()
    asked = queries.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks))).join(shards, F.size("vector") == F.col("dim"))
    asked = asked.select(F.col("shard").alias("q_shard"), F.col("block").alias("q_block"), "query_id", queries["vector"])
    spread = index.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    pairs = spread.groupBy("shard", "block").cogroup(asked.groupBy("q_shard", "q_block"))
    found = pairs.applyInPandas(lambda key, g, q: _search(key, g, q, k, beam), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def neighbours(vectors: DataFrame, every: int = 100, k: int = 10, shard: int = 8192, beam: int = 128) -> DataFrame:
    """The k nearest of every row whose vec_id is divisible by `every`, among all rows; rules as in build_index and search."""
    index = build_index(vectors, k, shard)
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    asked = vectors.where(F.col("vec_id") % every == 0).where("embedding is not null").where(fine)
    asked = asked.select(F.col("vec_id").cast("long").alias("query_id"), v.alias("vector")).dropDuplicates(["query_id"])
    return search(index, staged(asked, "queries"), k, beam)
