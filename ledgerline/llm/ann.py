"""Approximate nearest neighbours over robust-pruned directed graphs.

Equal vectors form one class, represented once with its smallest ids (a query
can need no more than k + 1 of them), so a vector that a third of all rows
share is one node.  Classes are dealt to shards by a hash; a shard of about
``shard_size`` nodes builds a directed graph: nodes are inserted in batches, a
greedy beam search from the medoid proposes neighbours, and robust pruning
keeps the nearest candidate and drops every other one that the kept one is
closer to by the factor ``alpha``, until ``degree`` edges are chosen; edges are
added back from the neighbours and pruned alike.  A second pass over all nodes
with the relaxed ``alpha`` adds the diverse long edges.  The index is a table of shards.

A query beam-searches every shard; distances of what it finds are exact
(double precision on the original vectors), ties go to the smaller id.  The queries
meet a shard in blocks of about ``query_block``, so neither a shard nor the set
of queries has to be in one task whole.

Vectors are read as single-precision floats.  Edge cases: rows whose id is NULL or whose vector is NULL, empty, zero, or
holds a NULL or non-finite component take no part; vectors of different
lengths never meet; a repeated (id, vector) row counts once; a query's own id is never
an answer; with fewer than k candidates all of them are returned.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import staged

DEGREE, SLACK, BEAM, QUERY_BEAM, ALPHA, SHARD_SIZE = 24, 8, 64, 160, 1.2, 4096
QUERY_BLOCK = 8192
_BATCH, _EXPAND = 256, 4


def _square(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of rows a[i] to b[i, j]."""
    d = b - a[:, None, :]
    return np.einsum("ijk,ijk->ij", d, d)


def beam_search(vecs: np.ndarray, graph: np.ndarray, entry: int, queries: np.ndarray, beam: int):
    """Per query the ``beam`` nearest nodes found (ids ascending by distance,
    -1 padded) and their squared distances."""
    q, rows = len(queries), np.arange(len(queries))
    ids = np.full((q, beam), -1, np.int64)
    dist = np.full((q, beam), np.inf, np.float32)
    done = np.zeros((q, beam), bool)
    seen = np.zeros((q, len(vecs)), bool)
    ids[:, 0], seen[:, entry] = entry, True
    dist[:, 0] = ((vecs[entry] - queries) ** 2).sum(axis=1)
    while True:
        open_dist = np.where(done | (ids < 0), np.inf, dist)
        pick = np.argsort(open_dist, axis=1, kind="stable")[:, :_EXPAND]
        live = np.isfinite(np.take_along_axis(open_dist, pick, 1))
        act = np.flatnonzero(live[:, 0])
        if not len(act):
            return ids, dist
        pick, live = pick[act], live[act]
        done[act[:, None], pick] |= live
        nodes = np.where(live, ids[act[:, None], pick], -1)
        near = np.where(nodes[:, :, None] >= 0, graph[nodes], -1).reshape(len(act), -1)
        near[seen[act[:, None], near]] = -1
        order = np.sort(near, axis=1)  # a node proposed twice counts once
        order[:, 1:][order[:, 1:] == order[:, :-1]] = -1
        near = order
        r, c = np.nonzero(near >= 0)
        seen[act[r], near[r, c]] = True
        d = np.full(near.shape, np.inf, np.float32)
        diff = vecs[near[r, c]] - queries[act[r]]
        d[r, c] = np.einsum("ij,ij->i", diff, diff)
        all_ids = np.concatenate([ids[act], near], axis=1)
        all_d = np.concatenate([dist[act], d], axis=1)
        all_done = np.concatenate([done[act], np.zeros(near.shape, bool)], axis=1)
        keep = np.argsort(all_d, axis=1, kind="stable")[:, :beam]
        ids[act], dist[act] = np.take_along_axis(all_ids, keep, 1), np.take_along_axis(all_d, keep, 1)
        done[act] = np.take_along_axis(all_done, keep, 1)
        ids[~np.isfinite(dist)] = -1


def robust_prune(vecs: np.ndarray, points: np.ndarray, cands: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Up to ``degree`` diverse neighbours of each point among its candidates
    (-1 padded rows)."""
    cands = np.where(cands == points[:, None], -1, cands)
    cands = -np.sort(-cands, axis=1)
    cands[:, 1:][cands[:, 1:] == cands[:, :-1]] = -1
    v = vecs[np.maximum(cands, 0)]
    d = _square(vecs[points], v)
    d[cands < 0] = np.inf
    order = np.argsort(d, axis=1, kind="stable")
    cands, d, v = np.take_along_axis(cands, order, 1), np.take_along_axis(d, order, 1), np.take_along_axis(v, order[:, :, None], 1)
    norm = np.einsum("ijk,ijk->ij", v, v)
    between = norm[:, :, None] + norm[:, None, :] - 2 * np.matmul(v, v.transpose(0, 2, 1))
    out = np.full((len(points), degree), -1, np.int64)
    alive, rows = np.isfinite(d), np.arange(len(points))
    for k in range(degree):
        some = alive.any(axis=1)
        if not some.any():
            break
        first = alive.argmax(axis=1)
        out[some, k] = cands[rows, first][some]
        alive &= alpha * alpha * between[rows, first] > d
        alive[rows, first] = False
    return out


def _add_back(vecs, graph, sources, targets, degree, alpha):
    """Add source -> target edges; a full row is pruned again."""
    order = np.lexsort((targets, sources))
    sources, targets = sources[order], targets[order]
    nodes, first, n = np.unique(sources, return_index=True, return_counts=True)
    width = graph.shape[1]
    have = (graph[nodes] >= 0).sum(axis=1)
    roomy = have + n <= width
    at = np.arange(len(sources)) - np.repeat(first, n)
    fits = np.repeat(roomy, n)
    graph[sources[fits], (np.repeat(have, n) + at)[fits]] = targets[fits]
    for size, lo in ((16, 0), (64, 16), (1 << 30, 64)):
        group = np.flatnonzero(~roomy & (n > lo) & (n <= size))
        step = 256 if size <= 16 else 32 if size <= 64 else 1
        for i in range(0, len(group), step):
            g = group[i:i + step]
            new = np.full((len(g), int(n[g].max())), -1, np.int64)
            for r, k in enumerate(g):
                new[r, :n[k]] = targets[first[k]:first[k] + n[k]]
            pruned = robust_prune(vecs, nodes[g], np.concatenate([graph[nodes[g]], new], axis=1), degree, alpha)
            graph[nodes[g]] = -1
            graph[nodes[g], :degree] = pruned


def build_graph(vecs: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA, seed: int = 0):
    """(n, degree + SLACK) neighbour rows, -1 padded, and the entry node."""
    n = len(vecs)
    graph = np.full((n, degree + SLACK), -1, np.int64)
    entry = int(((vecs - vecs.mean(axis=0)) ** 2).sum(axis=1).argmin())
    order = np.random.default_rng(seed).permutation(n)
    order = np.concatenate(([entry], order[order != entry]))
    start = min(n, 2 * degree)
    graph[order[:start], :degree] = robust_prune(vecs, order[:start], np.tile(order[:start], (start, 1)), degree, 1.0)
    for factor, todo in ((1.0, order[start:]), (alpha, order)):
        i, step = 0, start if factor == 1.0 else _BATCH
        while i < len(todo):
            points = todo[i:i + min(step, _BATCH)]
            found, _ = beam_search(vecs, graph, entry, vecs[points], beam)
            cands = np.concatenate([found, graph[points]], axis=1)
            chosen = robust_prune(vecs, points, cands, degree, factor)
            graph[points] = -1
            graph[points, :degree] = chosen
            r, c = np.nonzero(chosen >= 0)
            back, to = chosen[r, c], points[r]
            new = ~(graph[back] == to[:, None]).any(axis=1)
            _add_back(vecs, graph, back[new], to[new], degree, factor)
            i += len(points)
            step *= 2
    return graph, entry


# ---------------------------------------------------------------- tables

def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the rows that take part, each once."""
    e = F.col("embedding").cast("array<float>")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), e.alias("embedding"))
    return rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0)
                      & finite & F.exists("embedding", lambda x: x != 0)).distinct()


def classes(rows: DataFrame, k: int) -> DataFrame:
    """(embedding, ids): distinct vectors with their k + 1 smallest ids."""
    place = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    return rows.withColumn("place", place).where(F.col("place") <= k + 1) \
        .groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


INDEX_SCHEMA = "shard int, dim int, entry long, vectors binary, graph binary, ids array<array<long>>"


def build_index(rows: DataFrame, k: int, shard_size: int = SHARD_SIZE, degree: int = DEGREE, beam: int = BEAM,
                alpha: float = ALPHA) -> tuple[DataFrame, int]:
    """One row a shard and vector length, and the number of shards."""
    nodes = staged(classes(rows, k).withColumn("dim", F.size("embedding")), "ann-classes")
    shards = max(1, -(-nodes.count() // shard_size))
    dealt = nodes.withColumn("shard", F.pmod(F.xxhash64(F.element_at("ids", 1)), F.lit(shards)).cast("int"))

    def build(group: pa.Table) -> pa.Table:
        group = group.combine_chunks().sort_by([("first_id", "ascending")])
        dim = group["dim"][0].as_py()
        vecs = group["embedding"].combine_chunks().flatten().to_numpy().astype(np.float32).reshape(-1, dim)
        graph, entry = build_graph(vecs, degree, beam, alpha)
        return pa.table({"shard": group["shard"].slice(0, 1), "dim": group["dim"].slice(0, 1), "entry": pa.array([entry], pa.int64()),
                         "vectors": [vecs.tobytes()], "graph": [graph.astype(np.int32).tobytes()],
                         "ids": pa.array([group["ids"].to_pylist()], pa.list_(pa.list_(pa.int64())))})

    index = dealt.withColumn("first_id", F.element_at("ids", 1)).groupBy("shard", "dim").applyInArrow(build, INDEX_SCHEMA)
    return staged(index, "ann-index"), shards


def search(index: DataFrame, shards: int, queries: DataFrame, k: int, beam: int = QUERY_BEAM,
           query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest found."""
    def probe(shard: pa.Table, asked: pa.Table) -> pa.Table:
        q_ids, out_id, score = [], [], []
        if shard.num_rows and asked.num_rows:
            dim = shard["dim"][0].as_py()
            vecs = np.frombuffer(shard["vectors"][0].as_py(), np.float32).reshape(-1, dim)
            graph = np.frombuffer(shard["graph"][0].as_py(), np.int32).reshape(len(vecs), -1).astype(np.int64)
            members, entry = shard["ids"][0].as_py(), shard["entry"][0].as_py()
            asked = asked.combine_chunks()
            wanted = asked["embedding"].combine_chunks().flatten().to_numpy().astype(np.float32).reshape(-1, dim)
            names = asked["vec_id"].to_numpy()
            wide = max(beam, k + 1)
            for i in range(0, len(names), _BATCH):
                part = wanted[i:i + _BATCH]
                found = np.tile(np.arange(len(vecs)), (len(part), 1)) if len(vecs) <= wide else \
                    beam_search(vecs, graph, entry, part, wide)[0]
                for name, q, nodes in zip(names[i:i + _BATCH].tolist(), part.astype(np.float64), found):
                    nodes = nodes[nodes >= 0]
                    far = np.sqrt(((vecs[nodes].astype(np.float64) - q) ** 2).sum(axis=1))
                    near = np.argsort(far, kind="stable")[:k + 1]
                    # every class as near as the last one kept, for ties
                    near = np.flatnonzero(far <= far[near[-1]])
                    rows = sorted((float(far[j]), m) for j in near for m in members[nodes[j]] if m != name)[:k]
                    q_ids += [name] * len(rows)
                    score += [r[0] for r in rows]
                    out_id += [r[1] for r in rows]
        return pa.table({"query_id": pa.array(q_ids, pa.int64()), "vec_id": pa.array(out_id, pa.int64()),
                         "score": pa.array(score, pa.float64())})

    blocks = max(1, -(-queries.count() // query_block))
    asked = queries.select("vec_id", "embedding", F.size("embedding").alias("dim"),
                           F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(blocks)).cast("int").alias("block"),
                           F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    met = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = met.groupBy("shard", "dim", "block").cogroup(asked.groupBy("shard", "dim", "block")) \
        .applyInArrow(probe, "query_id long, vec_id long, score double").distinct()
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, query_beam: int = QUERY_BEAM,
            query_block: int = QUERY_BLOCK, **options) -> DataFrame:
    rows = staged(usable(vectors), "ann-rows")
    index, shards = build_index(rows, k, **options)
    return search(index, shards, rows.where(is_query), k, query_beam, query_block)
