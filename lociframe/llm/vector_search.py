"""Approximate nearest neighbours by inner product: a robust-pruned directed graph a shard, beam search in each."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from lociframe.llm.common import Kept

#: Out-edges of a node; candidates of a search while building, and while querying; how much nearer than the
#: node itself a kept neighbour must be to an edge's end to make the edge needless.
DEGREE, BUILD_BEAM, QUERY_BEAM, RELAXED = 32, 64, 128, 1.2
#: Vectors of a shard, queries that one task searches for, and shards at least (for small tables to use all cores).
SHARD_ROWS, QUERY_ROWS, SHARDS = 8192, 4096, 8
#: Nodes that a search looks at together, and points searched for together.
WIDTH, LANES = 4, 256


def lifted(x: np.ndarray) -> np.ndarray:
    """One more component makes all vectors equally long, so that the largest inner product is the nearest point."""
    norm = (x * x).sum(1)
    most = norm.max(initial=0.0)
    return np.concatenate((x, np.sqrt(np.maximum(most - norm, 0))[:, None]), 1)


def beam_search(points: np.ndarray, edges: np.ndarray, start: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """For each query the ``beam`` best points found from start along edges: (places, inner products), best first.

    edges has the places of each point's neighbours, filled up by the number of points, which also
    stands for no place in what is returned.
    """
    n, b = len(points), len(queries)
    padded = np.concatenate((points, np.zeros((1, points.shape[1]), points.dtype)))
    seen = np.zeros((b, n + 1), bool)
    seen[:, n] = seen[:, start] = True
    ids = np.full((b, beam), n)
    near = np.full((b, beam), -np.inf)
    open_ = np.zeros((b, beam), bool)
    ids[:, 0], near[:, 0], open_[:, 0] = start, queries @ points[start], True
    live = np.arange(b)
    while len(live):
        best = np.where(open_[live], near[live], -np.inf)
        at = np.argpartition(-best, min(WIDTH, beam) - 1, axis=1)[:, :WIDTH]
        some = np.isfinite(np.take_along_axis(best, at, 1))
        keep = some.any(1)
        live, at, some = live[keep], at[keep], some[keep]
        if not len(live):
            break
        rows = live[:, None]
        open_[rows, at] = False
        now = np.where(some, ids[rows, at], n)
        nb = np.sort(edges[now].reshape(len(live), -1), 1)
        nb[:, 1:][nb[:, 1:] == nb[:, :-1]] = n
        nb = np.where(seen[rows, nb], n, nb)
        seen[rows, nb] = True
        ip = np.where(nb < n, np.matmul(padded[nb], queries[live][:, :, None])[:, :, 0], -np.inf)
        all_ids = np.concatenate((ids[live], nb), 1)
        all_near = np.concatenate((near[live], ip), 1)
        all_open = np.concatenate((open_[live], nb < n), 1)
        top = np.argpartition(-all_near, beam - 1, axis=1)[:, :beam]
        ids[live], near[live], open_[live] = (np.take_along_axis(a, top, 1) for a in (all_ids, all_near, all_open))
    order = np.argsort(-near, 1, kind="stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(near, order, 1)


def robust_prune(points: np.ndarray, own: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """For each point up to DEGREE of its candidates, nearest first, leaving out what a kept one is much nearer to.

    ``own`` has places of points, ``candidates`` a row of places for each, filled up by the number of points.
    """
    n, m = len(points), len(own)
    out = np.full((m, DEGREE), n)
    padded = np.concatenate((points, np.zeros((1, points.shape[1]), points.dtype)))
    length = (points[:1] * points[:1]).sum()  # of all points
    wide = candidates.shape[1]
    for at in range(0, m, max(1, 4_000_000 // (wide * wide + wide * points.shape[1]))):
        step = slice(at, at + max(1, 4_000_000 // (wide * wide + wide * points.shape[1])))
        c = np.sort(candidates[step], 1)
        c[:, 1:][c[:, 1:] == c[:, :-1]] = n
        c[c == own[step][:, None]] = n
        x = padded[c]
        far = np.where(c < n, 2 * length - 2 * np.matmul(x, padded[own[step]][:, :, None])[:, :, 0], np.inf)
        order = np.argsort(far, 1, kind="stable")
        c, far = np.take_along_axis(c, order, 1), np.take_along_axis(far, order, 1)
        x = padded[c]
        apart = 2 * length - 2 * np.matmul(x, x.transpose(0, 2, 1))
        alive = c < n
        rows = np.arange(len(c))
        for k in range(DEGREE):
            first = alive.argmax(1)
            ok = alive[rows, first]
            if not ok.any():
                break
            out[step][ok, k] = c[rows, first][ok]
            alive &= ~(ok[:, None] & (RELAXED**2 * apart[rows, first] <= far))
            alive[rows, first] = False
    return out


def build(vectors: np.ndarray, seed: int = 0) -> tuple[np.ndarray, int]:
    """(edges, start) of the graph over the rows of ``vectors``.

    Points come in batches of growing size: a search in the graph so far proposes a point's neighbours,
    pruning keeps diverse ones, and these get an edge back, pruned likewise.
    """
    points = lifted(vectors.astype(np.float32))
    n = len(points)
    edges = np.full((n + 1, DEGREE), n)
    start = int((points @ points.mean(0)).argmax())
    order = np.random.default_rng(seed).permutation(n)
    order = np.concatenate(([start], order[order != start]))
    done = min(n, 2 * DEGREE)
    edges[order[:done]] = robust_prune(points, order[:done], np.tile(order[:done], (done, 1)))
    while done < n:
        new = order[done : done + min(LANES, done)]
        proposed, _ = beam_search(points, edges, start, points[new], BUILD_BEAM)
        mates = np.argsort(-(points[new] @ points[new].T), 1)[:, : DEGREE // 2]  # of the same batch
        edges[new] = robust_prune(points, new, np.concatenate((proposed, new[mates]), 1))
        to, by = edges[new].ravel(), np.repeat(new, DEGREE)
        to, by = to[to < n], by[to < n]
        rank = np.argsort(to, kind="stable")
        targets, first, count = np.unique(to[rank], return_index=True, return_counts=True)
        for wide in np.unique(-(-count // 16)).tolist():  # targets with about as many new edges together
            some = -(-count // 16) == wide
            place = np.arange(wide * 16)
            inside = place < count[some][:, None]
            more = np.where(inside, by[rank][np.minimum(first[some][:, None] + place, len(by) - 1)], n)
            edges[targets[some]] = robust_prune(points, targets[some], np.concatenate((edges[targets[some]], more), 1))
        done += len(new)
    return edges[:n], start


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vec, dim) of rows whose id is not null and whose vector is not null, empty, zero or with a null or non-finite component."""
    v = F.col("vec")
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vec")).where("vec_id IS NOT NULL AND vec IS NOT NULL")
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return rows.where(~bad & F.exists(v, lambda c: c != 0)).withColumn("dim", F.size("vec"))


def index(df: DataFrame, neighbours: int, id_col: str = "vec_id", vector_col: str = "embedding") -> Kept:
    """The graphs of all shards, kept: (dim, shard, place, vec, ids, edges, start).

    Equal vectors are one point with its smallest ids, as many as a query can need. Vectors of other
    lengths are in shards of their own. A shard has about SHARD_ROWS points whatever the input's size.
    """
    rows = usable(df, id_col, vector_col)
    nth = F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))
    few = rows.distinct().withColumn("nth", nth).where(F.col("nth") <= neighbours + 1)
    points = Kept(few.groupBy("dim", "vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "points")
    shards = max(SHARDS, -(-points.df.count() // SHARD_ROWS))
    dealt = points.df.withColumn("shard", F.pmod(F.xxhash64(F.col("ids")[0]), F.lit(shards)).cast("int"))

    def graph(pdf):
        pdf = pdf.sort_values("ids", key=lambda s: s.map(lambda x: x[0])).reset_index(drop=True)
        edges, start = build(np.stack(pdf["vec"].to_numpy()))
        n = len(pdf)
        return pdf.assign(place=range(n), edges=[[int(j) for j in e if j < n] for e in edges], start=start)

    schema = "dim int, vec array<double>, ids array<bigint>, shard int, place int, edges array<int>, start int"
    return Kept(dealt.groupBy("dim", "shard").applyInPandas(graph, schema), "graphs")


def nearest(df: DataFrame, queries: DataFrame, neighbours: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank from 1, vec_id, score): the ``neighbours`` rows of df of largest inner product found for each query.

    Both have id_col and vector_col. A query's own id is no candidate; score is the inner product of the
    vectors themselves in double precision; equal scores go by the smaller id. Vectors that are null,
    empty, zero or hold a null or non-finite component take no part, nor do null ids; vectors meet those
    of their own length only; rows that repeat an id and vector count once. Fewer candidates give fewer
    rows, empty tables none. Every shard is searched for every query, QUERY_ROWS queries in a task.
    """
    kept = index(df, neighbours, id_col, vector_col)
    graphs = kept.df
    asked = Kept(usable(queries, id_col, vector_col).distinct(), "queries")
    chunks = max(1, -(-asked.df.count() // QUERY_ROWS))
    where = kept.read().select("dim", "shard").distinct()
    q = asked.df.withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).cast("int"))
    q = q.join(where, "dim")  # to each shard of its length
    g = graphs.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))

    def search(points, q):
        import pandas as pd

        if not len(points) or not len(q):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        points = points.sort_values("place")
        vectors = np.stack(points["vec"].to_numpy())
        n = len(vectors)
        edges = np.full((n + 1, DEGREE), n)
        for i, e in enumerate(points["edges"]):
            edges[i, : len(e)] = e
        ids = points["ids"].to_numpy()
        lengths = np.array([len(x) for x in ids])
        flat, first = np.concatenate(ids), np.concatenate(([0], np.cumsum(lengths)))
        single, start = vectors.astype(np.float32), int(points["start"].iloc[0])
        own = q["vec_id"].to_numpy()
        asked = np.stack(q["vec"].to_numpy())
        out = []
        for at in range(0, len(own), LANES):
            mine = asked[at : at + LANES]
            found, _ = beam_search(single, edges, start, mine.astype(np.float32), max(QUERY_BEAM, 4 * neighbours))
            for i in range(len(mine)):
                f = found[i][found[i] < n]
                score = (vectors[f] * mine[i]).sum(1)
                best = np.lexsort((flat[first[f]], -score))[: neighbours + 1]
                f, score = f[best], score[best]
                to = np.concatenate([flat[first[j] : first[j + 1]] for j in f])
                score = np.repeat(score, lengths[f])
                ok = to != own[at + i]
                to, score = to[ok], score[ok]
                best = np.lexsort((to, -score))[:neighbours]
                out.append((np.full(len(best), own[at + i]), to[best], score[best]))
        a, b, c = (np.concatenate(x) for x in zip(*out))
        return pd.DataFrame({"query_id": a, "vec_id": b, "score": c})

    found = g.groupBy("dim", "shard", "chunk").cogroup(q.groupBy("dim", "shard", "chunk")).applyInPandas(search, "query_id bigint, vec_id bigint, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return found.withColumn("rank", rank).where(F.col("rank") <= neighbours).select("query_id", "rank", "vec_id", "score")
