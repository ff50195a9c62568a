"""Nearest neighbours by cosine in robust-pruned directed graphs, one per shard.

Equal vectors are one node with the smallest ids that can be asked for. The nodes are dealt
into shards of about `SHARD_NODES` by a hash. A shard's graph is built in batches of
growing size: a greedy beam search on the graph so far proposes neighbours for each new
node, relaxed distance pruning keeps the nearest and drops those that a kept one is
closer to by the factor `ALPHA`, and reverse edges are added and pruned the same way. Every
row is indexed. A query walks the graph of each shard with a beam, and the best of all
shards are ranked by the cosine in double precision on the vectors as given.

Queries are dealt into blocks of bounded size, and a task holds one shard's graph and one
block. Vectors that are null, zero, or hold a null or a non-finite number take no part, as
candidates or as queries; rows without an id neither. Vectors of different lengths are never
compared. Rows that repeat an id and its vector count once. With fewer candidates than asked
for, all are returned; an empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskgraph.session import materialise

SHARD_NODES = 4096
QUERY_BLOCK = 1024
DEGREE, BEAM, ALPHA = 32, 96, 1.2
BATCH = 256
SALTS = 16


def beam_search(queries: np.ndarray, vectors: np.ndarray, edges: np.ndarray, start: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, squared distances), nearest first, -1 and inf behind; unit vectors, all queries at once."""
    q, n = len(queries), len(vectors)
    seen = np.zeros((q, n), bool)
    seen[:, start] = True
    beam = np.full((q, width), -1, np.int64)
    far = np.full((q, width), np.inf, np.float32)
    done = np.ones((q, width), bool)
    beam[:, 0], far[:, 0], done[:, 0] = start, 2 - 2 * (queries @ vectors[start]), False
    live = np.arange(q)
    while len(live):
        at = np.where(done[live], np.inf, far[live]).argmin(axis=1)
        open_ = ~done[live, at]
        live, at = live[open_], at[open_]
        if not len(live):
            break
        done[live, at] = True
        near = edges[beam[live, at]]
        new = (near >= 0) & ~seen[live[:, None], near]
        rows, cols = np.nonzero(new)
        seen[live[rows], near[rows, cols]] = True
        d = np.full(near.shape, np.inf, np.float32)
        d[rows, cols] = 2 - 2 * np.einsum("ij,ij->i", queries[live[rows]], vectors[near[rows, cols]])
        all_d = np.concatenate([far[live], d], axis=1)
        best = np.argsort(all_d, axis=1, kind="stable")[:, :width]
        far[live] = np.take_along_axis(all_d, best, axis=1)
        beam[live] = np.take_along_axis(np.concatenate([beam[live], near], axis=1), best, axis=1)
        done[live] = np.take_along_axis(np.concatenate([done[live], ~np.isfinite(d)], axis=1), best, axis=1)
    beam[~np.isfinite(far)] = -1
    return beam, far


def prune(nodes: np.ndarray, near: np.ndarray, vectors: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA) -> np.ndarray:
    """At most `degree` diverse neighbours of each node among its candidates `near` (-1: none)."""
    near = np.where(near == nodes[:, None], -1, near)
    own = vectors[nodes]
    these = vectors[np.maximum(near, 0)]
    d = np.where(near >= 0, 2 - 2 * np.einsum("ijk,ik->ij", these, own), np.inf)
    out = np.full((len(nodes), degree), -1, np.int64)
    rows = np.arange(len(nodes))
    alive = np.isfinite(d)
    for k in range(degree):
        best = np.where(alive, d, np.inf).argmin(axis=1)
        ok = alive[rows, best]
        if not ok.any():
            break
        out[ok, k] = near[rows[ok], best[ok]]
        chosen = these[rows, best]
        between = 2 - 2 * np.einsum("ijk,ik->ij", these, chosen)
        alive &= ~(ok[:, None] & (alpha * between <= d))
        alive[rows, best] = False
    return out


def build_graph(vectors: np.ndarray, seed: int = 1) -> tuple[np.ndarray, int]:
    """(edges, start) over unit vectors: the start is the node nearest to their mean."""
    n = len(vectors)
    edges = np.full((n, DEGREE), -1, np.int64)
    start = int((vectors @ vectors.mean(axis=0)).argmax())
    order = np.random.default_rng(seed).permutation(n)
    order = np.r_[start, order[order != start]]
    for again in range(2):  # the second round joins early nodes to those that came later
        at = 1 - again
        while at < n:
            size = BATCH if again else min(BATCH, max(1, at))
            batch = order[at:at + size]
            found, _ = beam_search(vectors[batch], vectors, edges, start, BEAM // 2)
            near = np.concatenate([found, edges[batch]], axis=1)
            near = _once(near)
            edges[batch] = prune(batch, near, vectors)
            _add_reverse(edges, batch, vectors)
            at += size
    return edges, start


def _once(near: np.ndarray) -> np.ndarray:
    near = np.sort(near, axis=1)
    near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
    return near


def _add_reverse(edges: np.ndarray, batch: np.ndarray, vectors: np.ndarray) -> None:
    to = edges[batch].ravel()
    source = np.repeat(batch, DEGREE)[to >= 0]
    to = to[to >= 0]
    order = np.argsort(to, kind="stable")
    to, source = to[order], source[order]
    nodes, first, count = np.unique(to, return_index=True, return_counts=True)
    while len(nodes):  # at most DEGREE new edges to a node at a time
        take = np.minimum(count, DEGREE)
        extra = np.full((len(nodes), DEGREE), -1, np.int64)
        place = np.arange(DEGREE)[None, :] < take[:, None]
        extra[place] = source[(first[:, None] + np.arange(DEGREE))[place]]
        near = _once(np.concatenate([edges[nodes], extra], axis=1))
        fits = (near >= 0).sum(axis=1) <= DEGREE
        edges[nodes[fits]] = np.sort(near[fits], axis=1)[:, ::-1][:, :DEGREE]
        if (~fits).any():
            edges[nodes[~fits]] = prune(nodes[~fits], near[~fits], vectors)
        first, count = first + take, count - take
        nodes, first, count = nodes[count > 0], first[count > 0], count[count > 0]


def _usable(column: Column) -> Column:
    real = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return column.isNotNull() & F.forall(column, real) & F.exists(column, lambda x: x != 0)


def _smallest_ids(rows: DataFrame, count: int) -> DataFrame:
    """(embedding, ids): the `count` smallest ids of each vector; a vector that many rows share is salted."""
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)))
    for keys in (["embedding", "_salt"], ["embedding"]):
        salted = salted.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy("vec_id"))).where(F.col("_n") <= count)
    return salted.groupBy("embedding").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # no overflow of the squares
    return (rows / np.linalg.norm(rows, axis=1, keepdims=True)).astype(np.float32)


def _index(key: tuple, nodes: pd.DataFrame) -> pd.DataFrame:
    vectors = np.stack(nodes["embedding"].to_numpy()).astype(np.float64)
    edges, start = build_graph(_unit(vectors))
    ids = [np.asarray(i, np.int64) for i in nodes["ids"]]
    return pd.DataFrame({
        "dim": [key[0]], "shard": [key[1]], "start": [start], "vectors": [vectors.tobytes()],
        "edges": [edges.astype(np.int32).tobytes()], "ids": [np.concatenate(ids).tobytes()],
        "counts": [np.array([len(i) for i in ids], np.int32).tobytes()],
    })


INDEX_SCHEMA = "dim int, shard long, start long, vectors binary, edges binary, ids binary, counts binary"


def build_index(rows: DataFrame, most: int, shard_nodes: int = SHARD_NODES) -> tuple[DataFrame, int]:
    """(index, number of shards): one row per length of vector and shard, written once.

    `most` is how many ids of equal vectors can be asked for.
    """
    nodes = materialise(_smallest_ids(rows.where("vec_id is not null").where(_usable(F.col("embedding"))).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).distinct(), most))
    shards = max(1, -(-nodes.count() // shard_nodes))
    dealt = nodes.select(F.size("embedding").alias("dim"), F.pmod(F.xxhash64("embedding"), F.lit(shards)).alias("shard"), "embedding", "ids")
    return materialise(dealt.groupBy("dim", "shard").applyInPandas(_index, INDEX_SCHEMA)), shards


def _searcher(k: int):
    def run(key: tuple, index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(index) or not len(queries):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        row = index.iloc[0]
        dim = int(row["dim"])
        vectors = np.frombuffer(row["vectors"], np.float64).reshape(-1, dim)
        edges = np.frombuffer(row["edges"], np.int32).reshape(-1, DEGREE).astype(np.int64)
        counts = np.frombuffer(row["counts"], np.int32)
        ids, first = np.frombuffer(row["ids"], np.int64), np.r_[0, np.cumsum(counts)]
        given = np.stack(queries["embedding"].to_numpy()).astype(np.float64)
        units, own = _unit(vectors), _unit(given)
        out = []
        for at in range(0, len(given), BATCH):
            found, _ = beam_search(own[at:at + BATCH], units, edges, int(row["start"]), BEAM)
            for j, near in enumerate(found):
                near = near[near >= 0][:4 * k]
                q, v = given[at + j], vectors[near]
                score = (v @ q) / (np.linalg.norm(v, axis=1) * np.linalg.norm(q))
                query_id = int(queries["query_id"].iloc[at + j])
                best = sorted((-s, int(i)) for s, node in zip(score, near) for i in ids[first[node]:first[node + 1]] if i != query_id)[:k]
                out += [(query_id, i, -s) for s, i in best]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    return run


def nearest(rows: DataFrame, queries: DataFrame, k: int = 5, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """(query_id, rank, vec_id, score): the `k` nearest found of each row of `queries` among `rows`, itself left out."""
    index, shards = build_index(rows, k + 1, shard_nodes)
    asked = queries.where("vec_id is not null").where(_usable(F.col("embedding"))).select(
        F.col("vec_id").cast("bigint").alias("query_id"), F.col("embedding").cast("array<double>").alias("embedding")).distinct()
    asked = materialise(asked)
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
    left = index.withColumn("block", every(blocks)).groupBy("dim", "shard", "block")
    right = asked.select("query_id", "embedding", F.size("embedding").alias("dim"),
                         F.pmod(F.xxhash64("query_id"), F.lit(blocks)).alias("block")).withColumn("shard", every(shards))
    found = left.cogroup(right.groupBy("dim", "shard", "block")).applyInPandas(_searcher(k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
