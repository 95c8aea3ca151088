"""Approximate nearest neighbours on robust-pruned directed graphs.

Vectors are dealt by hash into shards of about SHARD distinct ones. In each shard, greedy searches over the graph so
far propose neighbours for every vector, and relaxed distance pruning keeps those that no kept neighbour is much
nearer to; reverse edges are added and pruned in the same way. A query is answered by a beam search in every shard,
and the answers of all shards are merged by exact distance in double precision.

Copies of a vector are one node with its smallest ids: a query needs at most k answers besides itself, so k + 1 ids of
equal distance, smallest first, hold every id that could be among them. Every row is thereby indexed. Queries go to
shards in blocks.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components take no part; vectors of
different lengths are kept in shards of their own length, and are no candidates of each other; ties go to the smaller
vec_id; fewer candidates than k give fewer rows; repeated rows with one vec_id count as one; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lorekit.llm.common import grouped, settle

SHARD, DEGREE, BEAM, ALPHA = 4096, 28, 48, 1.2
QUERY_BLOCK, BUILD_BLOCK, SALTS = 512, 256, 64


def _distances(points: np.ndarray, norms: np.ndarray, query: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Squared distances of each query to its row of ids, but for the query's own square."""
    return norms[ids] - 2 * np.einsum("brd,bd->br", points[ids], query, optimize=False)


def beam_search(points: np.ndarray, norms: np.ndarray, edges: np.ndarray, start: np.ndarray, query: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and distances, nearest first, of the beam of each query; an id of len(points) fills empty places.

    edges has a last row for that filler; all queries step together, each to its nearest unvisited place.
    """
    n, b = len(points), len(query)
    far = np.vstack([points, np.zeros((1, points.shape[1]), points.dtype)])
    size = np.append(norms, np.inf).astype(points.dtype)
    ids = np.full((b, beam), n)
    ids[:, : len(start)] = start
    dist = np.full((b, beam), np.inf, points.dtype)
    dist[:, : len(start)] = _distances(far, size, query, ids[:, : len(start)])
    done = ids == n
    for _ in range(4 * beam):
        near = np.where(done, np.inf, dist)
        at = near.argmin(axis=1)
        live = np.flatnonzero(np.isfinite(near[np.arange(b), at]))
        if not len(live):
            break
        done[live, at[live]] = True
        new = edges[ids[live, at[live]]]
        known = (new[:, :, None] == ids[live][:, None, :]).any(axis=2)
        new = np.where(known, n, new)
        d = _distances(far, size, query[live], new)
        all_ids, all_d, all_done = np.hstack([ids[live], new]), np.hstack([dist[live], d]), np.hstack([done[live], new == n])
        best = np.argpartition(all_d, beam - 1, axis=1)[:, :beam]
        row = np.arange(len(live))[:, None]
        ids[live], dist[live], done[live] = all_ids[row, best], all_d[row, best], all_done[row, best]
    order = np.argsort(dist, axis=1, kind="stable")
    row = np.arange(b)[:, None]
    return ids[row, order], dist[row, order]


def robust_prune(points: np.ndarray, own: np.ndarray, pool: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """For each of own, up to degree of its row of pool: nearest first, without those that a kept one is nearer to.

    len(points) fills empty places of pool and of the result.
    """
    n = len(points)
    far = np.vstack([points, np.full((1, points.shape[1]), 1e6, points.dtype)])
    pool = np.sort(np.where(pool == own[:, None], n, pool), axis=1)
    pool[:, 1:][pool[:, 1:] == pool[:, :-1]] = n
    near = ((far[pool] - points[own][:, None, :]) ** 2).sum(axis=2)
    near[pool == n] = np.inf
    order = np.argsort(near, axis=1, kind="stable")
    row = np.arange(len(own))
    pool, near = pool[row[:, None], order], near[row[:, None], order]
    body, out = far[pool], np.full((len(own), degree), n)
    for k in range(degree):
        at = near.argmin(axis=1)
        best = near[row, at]
        good = np.isfinite(best)
        if not good.any():
            break
        out[good, k] = pool[row, at][good]
        apart = ((body - body[row, at][:, None, :]) ** 2).sum(axis=2)
        near[alpha * alpha * apart <= near] = np.inf
        near[row, at] = np.inf
    return out


def build(points: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA) -> tuple[np.ndarray, np.ndarray]:
    """Edges (n + 1, degree), filled up with n, and the places where searches start."""
    n = len(points)
    norms = (points**2).sum(axis=1)
    rng = np.random.default_rng(n)
    if n <= degree + 1:
        edges = np.tile(np.arange(n), (n + 1, 1))
        edges[np.arange(n), np.arange(n)] = n
        edges[n] = n
        return edges, np.arange(min(n, 1))
    edges = rng.integers(0, n, (n + 1, degree))
    edges[n] = n
    start = np.unique(np.r_[((points - points.mean(axis=0)) ** 2).sum(axis=1).argmin(), rng.integers(0, n, 7)])
    for relax in (1.0, alpha):
        turn = rng.permutation(n)
        for i in range(0, n, BUILD_BLOCK):
            own = turn[i : i + BUILD_BLOCK]
            found, _ = beam_search(points, norms, edges, start, points[own], beam)
            edges[own] = robust_prune(points, own, np.hstack([found, edges[own]]), degree, relax)
            to, back = edges[own].ravel(), np.repeat(own, degree)
            to, back = to[to < n], back[to < n]
            order = np.argsort(to, kind="stable")
            to, back = to[order], back[order]
            nodes, first, count = np.unique(to, return_index=True, return_counts=True)
            more = np.full((len(nodes), count.max(initial=1)), n)
            more[np.repeat(np.arange(len(nodes)), count), np.arange(len(to)) - np.repeat(first, count)] = back
            for j in range(0, len(nodes), BUILD_BLOCK):
                part = slice(j, j + BUILD_BLOCK)
                width = max(1, int(count[part].max()))
                edges[nodes[part]] = robust_prune(points, nodes[part], np.hstack([edges[nodes[part]], more[part, :width]]), degree, relax)
    return edges, start


def _vectors(values: pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.array(values.combine_chunks().flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dim)


def _index(t: pa.Table) -> dict:
    """A shard's vectors, ids, edges and starts, packed in one row."""
    dim = t.column("dim")[0].as_py()
    points = _vectors(t.column("v"), dim)
    order = np.lexsort(points.T)
    points = points[order]
    centre = points.mean(axis=0)
    edges, start = build((points - centre).astype(np.float32))
    held = t.column("ids").to_pylist()
    ids = [held[i] for i in order]
    return {"shard": [t.column("shard")[0].as_py()], "dim": [dim], "points": [points.tobytes()], "ids": [ids], "edges": [edges.astype("<i4").tobytes()], "start": [start.astype("<i4").tobytes()]}


def build_index(vectors: DataFrame, k: int = 10, shard: int = SHARD) -> DataFrame:
    """A row for each shard of vectors (vec_id, v): every distinct vector with its k + 1 smallest ids, and the graph."""
    same = vectors.groupBy("v", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)).alias("salt")).agg(F.slice(F.array_sort(F.collect_set("vec_id")), 1, k + 1).alias("ids"))
    nodes = same.groupBy("v").agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k + 1).alias("ids"))
    nodes = settle(nodes.withColumn("dim", F.size("v")), "nodes")
    sizes = nodes.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / shard).alias("shards"))
    dealt = nodes.join(F.broadcast(sizes), "dim")  # a row for each length of vectors
    dealt = dealt.withColumn("shard", F.xxhash64("dim", F.pmod(F.xxhash64("v"), F.col("shards")))).drop("shards")
    dealt = dealt.withColumn("ids", F.col("ids").cast("array<long>"))
    return settle(grouped(dealt, "shard", _index, "shard long, dim int, points binary, ids array<array<long>>, edges binary, start binary"), "graph")


def _answers(k: int, beam: int):
    def run(t: pa.Table) -> dict | None:
        """The k nearest ids that each query of a block finds in one shard."""
        out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
        for r in t.to_pylist():
            dim = r["dim"]
            points = np.frombuffer(r["points"], np.float64).reshape(-1, dim)
            edges = np.frombuffer(r["edges"], "<i4").reshape(len(points) + 1, -1).astype(np.int64)
            start = np.frombuffer(r["start"], "<i4").astype(np.int64)
            query = np.array(r["queries"], np.float64).reshape(-1, dim)
            centre = points.mean(axis=0)
            flat = (points - centre).astype(np.float32)
            wide = max(beam, k + 1, len(start))
            found, _ = beam_search(flat, (flat**2).sum(axis=1), edges, start, (query - centre).astype(np.float32), wide)
            for q, qid, row in zip(query, r["query_ids"], found, strict=True):
                row = row[row < len(points)]
                d = np.sqrt(((points[row] - q) ** 2).sum(axis=1))
                best = sorted((float(x), i) for x, p in zip(d, row.tolist(), strict=True) for i in r["ids"][p] if i != qid)[:k]
                out["query_id"] += [qid] * len(best)
                out["vec_id"] += [i for _, i in best]
                out["score"] += [x for x, _ in best]
        return out

    return run


def clean(embeddings: DataFrame) -> DataFrame:
    """vec_id and v, the vector in double precision, of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    ok = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return embeddings.where(F.col("vec_id").isNotNull() & F.coalesce(ok, F.lit(False))).select(F.col("vec_id").cast("long"), F.transform(v, lambda x: x + 0.0).alias("v"))


def nearest(embeddings: DataFrame, queries: DataFrame, k: int = 10, beam: int = 2 * BEAM, shard: int = SHARD) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows of embeddings (vec_id, embedding) to each row of queries."""
    index = build_index(clean(embeddings), k, shard)
    asked = clean(queries).dropDuplicates(["vec_id"]).withColumn("dim", F.size("v"))
    block = F.pmod(F.xxhash64("vec_id"), F.col("blocks"))
    many = asked.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).alias("blocks"))
    asked = asked.join(F.broadcast(many), "dim").withColumn("block", block)  # a row for each length of vectors
    blocks = asked.groupBy("dim", "block").agg(F.collect_list("vec_id").alias("query_ids"), F.collect_list("v").alias("vs")).select("dim", "block", "query_ids", F.flatten("vs").alias("queries"))
    shards = index.select("dim", "shard")
    jobs = blocks.select("dim", "block").join(shards, "dim")  # names only: every block is searched in every shard
    jobs = jobs.join(blocks, ["dim", "block"]).drop("dim").withColumn("job", F.xxhash64("shard", "block"))
    found = grouped(jobs.join(index, "shard").drop("block", "shard"), "job", _answers(k, beam), "query_id long, vec_id long, score double")
    order = W.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
