"""Nearest neighbours by largest inner product on robust-pruned directed graphs.

Vectors are dealt into shards of bounded size whose norms lie within half an octave, and each shard gets a graph. A
vector gets one more component, sqrt(largest norm**2 - norm**2), which makes the order by inner product one by
distance; as norms differ little, no vector of a shard is hidden behind a far larger one. Points join the graph
in batches that double: greedy searches from the middle propose neighbours, pruning keeps a near one and
drops those it leads to (closer to it by `ALPHA`), backward edges are added and pruned again. A beam search
of every query visits each shard; its best rows are scored again in double precision on the original vectors.

Equal vectors are one node, with the smallest ids only: more than k + 1 equal vectors cannot all be among
the k nearest of a query, since ties go to smaller ids, so no result is lost.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components take no part, nor
do rows with a null id; vectors of different lengths never meet, so a query finds those of its own length;
rows of one id with several vectors count as one candidate each, the query's own id never; a repeated row
counts once; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiquarry.llm import arrays as ar
from lexiquarry.llm.storage import settle

DEGREE = 24
BEAM = 64
SEARCH_BEAM = 96
ALPHA = 1.2
SHARD_ROWS = 4096
QUERY_BLOCK = 1024


def beam_search(x: np.ndarray, graph: np.ndarray, start: int, queries: np.ndarray, beam: int) -> np.ndarray:
    """Nodes nearest to each query that a beam search reaches, nearest first; -1 pads.

    `graph` holds the neighbours of each node, -1 pads. All queries take their steps together.
    """
    n, rows = len(x), np.arange(len(queries))
    norm = (x * x).sum(axis=1)
    seen = np.zeros((len(queries), n + 1), bool)
    seen[:, [start, n]] = True
    ids = np.full((len(queries), beam), n)
    far = np.full((len(queries), beam), np.inf, np.float32)
    open_ = np.zeros((len(queries), beam), bool)
    ids[:, 0], far[:, 0], open_[:, 0] = start, norm[start] - 2 * queries @ x[start], True
    live = rows
    while len(live):
        at = np.where(open_[live], far[live], np.inf).argmin(axis=1)
        open_[live, at] = False
        near = graph[ids[live, at]]
        near = np.where(near < 0, n, near)
        fresh = ~seen[live[:, None], near]
        seen[live[:, None], near] = True
        inside = np.where(fresh, near, 0)
        d = norm[inside] - 2 * np.einsum("qd,qrd->qr", queries[live], x[inside])
        d = np.where(fresh, d, np.inf).astype(np.float32)
        every = np.concatenate([far[live], d], axis=1)
        best = np.argpartition(every, beam - 1, axis=1)[:, :beam]
        far[live] = np.take_along_axis(every, best, 1)
        ids[live] = np.take_along_axis(np.concatenate([ids[live], near], axis=1), best, 1)
        new = np.concatenate([open_[live], fresh], axis=1)
        open_[live] = np.take_along_axis(new, best, 1) & np.isfinite(far[live])
        live = live[open_[live].any(axis=1)]
    order = np.argsort(far, axis=1, kind="stable")
    ids = np.take_along_axis(ids, order, 1)
    return np.where(np.isfinite(np.take_along_axis(far, order, 1)), ids, -1)


def robust_prune(x: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Neighbours of each node: the nearest candidate stays, candidates that are closer to it by alpha go."""
    out = np.full((len(nodes), degree), -1)
    for at in range(0, len(nodes), 256):
        own, c = nodes[at:at + 256], candidates[at:at + 256]
        valid = (c >= 0) & (c != own[:, None])
        points = x[np.where(valid, c, 0)]
        d = ((points - x[own][:, None, :])**2).sum(axis=2)
        norm = (points * points).sum(axis=2)
        between = norm[:, :, None] + norm[:, None, :] - 2 * np.matmul(points, points.transpose(0, 2, 1))
        d = np.where(valid, d, np.inf)
        rows = np.arange(len(own))
        for k in range(degree):
            best = d.argmin(axis=1)
            ok = np.isfinite(d[rows, best])
            if not ok.any():
                break
            out[at + rows[ok], k] = c[rows[ok], best[ok]]
            covered = alpha**2 * between[rows, best] <= d
            d[covered & ok[:, None]] = np.inf
            d[rows, best] = np.inf
    return out


def build_graph(x: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA) -> tuple[np.ndarray, int]:
    """(neighbours of each point, start point)."""
    n = len(x)
    graph = np.full((n, degree), -1)
    order = np.random.default_rng(0).permutation(n)
    start = int(((x - x.mean(axis=0))**2).sum(axis=1).argmin())
    order = np.concatenate([[start], order[order != start]])
    done = 1
    while done < n:
        for batch in np.array_split(order[done:2 * done], max(1, min(done, n - done) // 1024)):
            found = beam_search(x, graph, start, x[batch], beam)
            graph[batch] = robust_prune(x, batch, found, degree, alpha)
            _add_backward(x, graph, batch, degree, alpha)
        done = min(2 * done, n)
    return graph, start


def _add_backward(x: np.ndarray, graph: np.ndarray, batch: np.ndarray, degree: int, alpha: float) -> None:
    source = np.repeat(batch, degree)
    target = graph[batch].ravel()
    source, target = source[target >= 0], target[target >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    nodes, first, counts = np.unique(target, return_index=True, return_counts=True)
    # At most 3 * degree newcomers of a node are weighed at once; the rest follow in further rounds.
    for at in range(0, int(counts.max(initial=0)), 3 * degree):
        take = np.flatnonzero(counts > at)
        place = at + np.arange(3 * degree)
        index = np.minimum(first[take][:, None] + place, len(source) - 1)
        new = np.where(place < counts[take][:, None], source[index], -1)
        graph[nodes[take]] = robust_prune(x, nodes[take], np.concatenate([graph[nodes[take]], new], axis=1), degree, alpha)


def _usable(v: Column) -> Column:
    sound = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.coalesce(sound & F.exists(v, lambda c: c != 0), F.lit(False))


def _pack(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in vectors])


def build_index(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 20,
                shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(shard, dim, n, ids, vectors, graph, start): one row per shard, every usable vector in one of them.

    `ids` has the smallest k + 1 ids of each node. The table is written to the shared folder.
    """
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).where(
        F.col("id").isNotNull() & _usable(F.col("v")))
    # The limit acts inside the tasks before the shuffle, so a very common vector stays small.
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    nodes = (rows.distinct().withColumn("place", place).where(F.col("place") <= k + 1)
             .groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")))
    nodes = settle(nodes.withColumn("dim", F.size("v")), "nodes")
    nodes = nodes.withColumn("band", norm_band(F.col("v")))
    # One row for each length of vectors and band of norms, of which doubles have below 5000, so it may be broadcast.
    sizes = nodes.groupBy("dim", "band").agg(F.ceil(F.count("*") / shard_rows).alias("shards"))
    dealt = nodes.join(F.broadcast(sizes), ["dim", "band"]).withColumn(
        "shard", F.col("band") * F.lit(1 << 32) + F.pmod(F.xxhash64("v"), "shards"))

    def build(group: pd.DataFrame) -> pd.DataFrame:
        group = group.assign(first=[i[0] for i in group["ids"]]).sort_values("first")
        x = _pack(group["v"])
        graph, start = build_graph(extended(x))
        ids = np.full((len(x), k + 1), -1, np.int64)
        for i, own in enumerate(group["ids"]):
            ids[i, :len(own)] = own
        return pd.DataFrame({"shard": group["shard"].iloc[:1], "dim": group["dim"].iloc[:1], "n": [len(x)],
                             "ids": [ids.tobytes()], "vectors": [x.tobytes()],
                             "graph": [graph.astype(np.int32).tobytes()], "start": [start]})

    # A group has about shard_rows rows: vectors are dealt out by their hash.
    schema = "shard long, dim int, n int, ids binary, vectors binary, graph binary, start int"
    return settle(dealt.groupBy("dim", "shard").applyInPandas(build, schema), "graphs")


def norm_band(v: Column) -> Column:
    """Half octave that the norm of a vector lies in; norms near 1 share one."""
    largest = F.array_max(F.transform(v, lambda c: F.abs(c)))
    rest = F.aggregate(v, F.lit(0.0), lambda s, c: s + (c / largest) * (c / largest))
    return F.floor(2 * F.log2(largest) + F.log2(rest) + 0.5)


def directions(x: np.ndarray) -> np.ndarray:
    """Rows divided by their norms."""
    scaled = x / np.abs(x).max(axis=1, keepdims=True, initial=1e-300)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def extended(x: np.ndarray) -> np.ndarray:
    """Points whose distances order inner products with a query that has a zero as its last component.

    They are divided by the largest norm, so single precision does for vectors of any size.
    """
    scaled = x / np.abs(x).max()
    norm = (scaled * scaled).sum(axis=1)
    points = np.concatenate([scaled, np.sqrt(norm.max() - norm)[:, None]], axis=1)
    return (points / np.sqrt(norm.max())).astype(np.float32)


def nearest(index: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 20,
            beam: int = SEARCH_BEAM) -> DataFrame:
    """(query_id, rank, <key>, score): the k nearest found for every usable query, its own id left out."""
    usable = queries.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).where(
        F.col("id").isNotNull() & _usable(F.col("v"))).distinct().withColumn("dim", F.size("v"))
    # Queries travel in blocks, each block to each shard of its length.
    total = usable.groupBy("dim").agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("blocks"))
    packed = (usable.join(F.broadcast(total), "dim").withColumn("block", F.pmod(F.xxhash64("id", "v"), "blocks"))
              .groupBy("dim", "block").agg(F.sort_array(F.collect_list(F.struct("id", "v"))).alias("q")))
    shards = index.select("dim", "shard")
    met = packed.join(shards, "dim").join(index, ["dim", "shard"])

    def search(batch: pa.RecordBatch) -> Iterator[dict]:
        for i in range(batch.num_rows):
            row = {name: batch.column(j)[i] for j, name in enumerate(batch.schema.names)}
            n, dim = row["n"].as_py(), row["dim"].as_py()
            x = np.frombuffer(row["vectors"].as_py(), np.float64).reshape(n, dim)
            ids = np.frombuffer(row["ids"].as_py(), np.int64).reshape(n, k + 1)
            graph = np.frombuffer(row["graph"].as_py(), np.int32).reshape(n, -1)
            own = np.array(row["q"].values.field("id"))
            q = np.array(row["q"].values.field("v").flatten()).reshape(len(own), dim)
            zero = np.zeros((len(q), 1))
            found = beam_search(extended(x), graph, row["start"].as_py(), np.hstack([directions(q), zero]).astype(np.float32), beam)
            for j in range(len(own)):
                node = found[j][found[j] >= 0]
                score = np.repeat(x[node] @ q[j], k + 1)
                member = ids[node].ravel()
                ok = (member >= 0) & (member != own[j])
                score, member = score[ok], member[ok]
                best = np.lexsort((member, -score))[:k]
                yield {"query_id": np.full(len(best), own[j]), "id": member[best], "score": score[best]}

    hits = ar.map_arrow(met.select("dim", "n", "ids", "vectors", "graph", "start", "q"), search,
                        "query_id long, id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return hits.distinct().withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(key), "score")
