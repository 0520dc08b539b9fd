"""Approximate nearest neighbours by inner product: a robust-pruned directed graph for each shard, and beam search."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medloom.llm.shared import drop_stored, store
from medloom.llm.vectors import classes, matrix, usable

#: Distinct vectors of a shard, about.
SHARD = 4096
#: Out-neighbours of a node at most.
DEGREE = 32
#: How much further a neighbour may be before a kept one covers it.
ALPHA = 1.2
#: Widths of the beam while building and while searching.
BUILD_BEAM, SEARCH_BEAM = 64, 128
#: Queries that are searched together; a block of queries and a shard are one task's work.
QUERY_BLOCK = 4096


class Graph:
    """Points (rows of unequal norm get one more coordinate, so that distance ranks as the inner product does), a list
    of out-neighbours per point (-1: none) and the point where searches begin."""

    def __init__(self, points: np.ndarray, neighbours: np.ndarray, entry: int):
        self.points, self.neighbours, self.entry = points, neighbours, entry

    @classmethod
    def build(cls, points: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA) -> Graph:
        """Insert the points in rounds that double, each searched in the graph as it was before its round."""
        n = len(points)
        graph = cls(points, np.full((n, degree), -1, np.int32), 0)
        if n:
            graph.entry = int(((points - points.mean(axis=0)) ** 2).sum(axis=1).argmin())
        order = np.random.default_rng(5).permutation(n)
        order = np.concatenate([[graph.entry], order[order != graph.entry]]) if n else order
        done = 1
        while done < n:
            batch = order[done : done + min(done, 256)]
            found, _ = graph.search(points[batch], beam)
            graph._link(batch, found, alpha)
            done += len(batch)
        graph._attach(beam)
        return graph

    def reached(self) -> np.ndarray:
        """Which points a search that begins at the entry can come to."""
        out = np.zeros(len(self.points), bool)
        front = np.array([self.entry], np.int64)[: len(out)]
        while len(front):
            out[front] = True
            front = np.unique(self.neighbours[front])
            front = front[front >= 0]
            front = front[~out[front]]
        return out

    def _attach(self, beam: int) -> None:
        """Give every point that can't be reached an edge from a near one that can: pruning may cut the last one."""
        while len(left := np.flatnonzero(~self.reached())):
            near = int(self.search(self.points[left[:1]], beam)[0][0, 0])
            free = np.flatnonzero(self.neighbours[near] < 0)
            if not len(free):
                self.neighbours = np.concatenate([self.neighbours, np.full((len(self.points), 1), -1, np.int32)], axis=1)
                free = [self.neighbours.shape[1] - 1]
            self.neighbours[near, free[0]] = left[0]

    def _link(self, batch: np.ndarray, candidates: np.ndarray, alpha: float) -> None:
        degree = self.neighbours.shape[1]
        self.neighbours[batch] = self.prune(batch, candidates, degree, alpha)
        # the edges back
        out = self.neighbours[batch]
        to, frm = out.ravel(), np.repeat(batch, degree)
        real = to >= 0
        to, frm = to[real], frm[real]
        order = np.argsort(to, kind="stable")
        to, frm = to[order], frm[order]
        target, first, many = np.unique(to, return_index=True, return_counts=True)
        wide = np.full((len(target), degree + int(many.max(initial=0))), -1, np.int64)
        wide[:, :degree] = self.neighbours[target]
        wide[np.repeat(np.arange(len(target)), many), degree + np.arange(len(to)) - np.repeat(first, many)] = frm
        held = (wide >= 0).sum(axis=1)
        fits = held <= degree
        for rows, full in ((np.flatnonzero(fits), False), (np.flatnonzero(~fits), True)):
            for at in range(0, len(rows), 512):
                some = rows[at : at + 512]
                if full:
                    self.neighbours[target[some]] = self.prune(target[some], wide[some], degree, alpha)
                else:
                    self.neighbours[target[some]] = -np.sort(-wide[some], axis=1)[:, :degree]

    def prune(self, nodes: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
        """Of each node's candidates (-1: none) the nearest, then the nearest that none of the kept covers, and so on:
        a kept k covers c if alpha * |k - c| <= |node - c|."""
        x = self.points
        candidates = np.where((candidates < 0) | (candidates == nodes[:, None]), -1, candidates)
        candidates = np.sort(candidates, axis=1)
        candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = -1
        c = x[np.maximum(candidates, 0)]
        to_node = np.maximum(0, ((c - x[nodes][:, None, :]) ** 2).sum(axis=2))
        to_node[candidates < 0] = np.inf
        order = np.argsort(to_node, axis=1, kind="stable")[:, : 4 * degree]
        rows = np.arange(len(nodes))[:, None]
        candidates, to_node, c = candidates[rows, order], to_node[rows, order], c[rows, order]
        square = (c**2).sum(axis=2)
        between = np.maximum(0, square[:, :, None] + square[:, None, :] - 2 * (c @ c.transpose(0, 2, 1)))
        covered = alpha**2 * between <= to_node[:, None, :]  # [i, k, c]
        alive = np.isfinite(to_node)
        kept = np.zeros_like(alive)
        count = np.zeros(len(nodes), np.int64)
        for k in range(candidates.shape[1]):
            take = alive[:, k] & (count < degree)
            kept[:, k] = take
            count += take
            alive &= ~(covered[:, k, :] & take[:, None])
        out = np.full((len(nodes), degree), -1, np.int32)
        i, k = np.nonzero(kept)
        out[i, np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count)] = candidates[i, k]
        return out

    def search(self, queries: np.ndarray, beam: int, step: int = 4) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` nearest points found for each query, nearest first, and their squared distances (less the
        query's own norm); -1 where there are fewer."""
        n, q = len(self.points), len(queries)
        square = (self.points**2).sum(axis=1)
        ids = np.full((q, beam), -1, np.int64)
        dist = np.full((q, beam), np.inf)
        fresh = np.zeros((q, beam), bool)
        seen = np.zeros((q, n), bool)
        ids[:, 0], dist[:, 0], fresh[:, 0] = self.entry, square[self.entry] - 2 * queries @ self.points[self.entry], True
        seen[:, self.entry] = True
        rows = np.arange(q)
        while len(rows):
            # the nearest fresh points of every query that still has one
            rank = np.where(fresh[rows], np.arange(beam), beam)
            pick = np.sort(rank, axis=1)[:, :step]
            has = pick < beam
            r, c = np.nonzero(has)
            fresh[rows[r], pick[r, c]] = False
            nodes = np.where(has, ids[rows[:, None], np.minimum(pick, beam - 1)], -1)
            next_ids = np.where((nodes >= 0)[:, :, None], self.neighbours[np.maximum(nodes, 0)], -1).reshape(len(rows), -1)
            next_ids = np.sort(next_ids, axis=1)
            new = next_ids >= 0
            new[:, 1:] &= next_ids[:, 1:] != next_ids[:, :-1]
            new &= ~seen[rows[:, None], np.maximum(next_ids, 0)]
            i, k = np.nonzero(new)
            found = next_ids[i, k]
            seen[rows[i], found] = True
            d = np.full(next_ids.shape, np.inf)
            d[i, k] = square[found] - 2 * np.einsum("ij,ij->i", queries[rows[i]], self.points[found])
            all_ids = np.concatenate([ids[rows], next_ids], axis=1)
            all_dist = np.concatenate([dist[rows], d], axis=1)
            all_fresh = np.concatenate([fresh[rows], new], axis=1)
            order = np.argsort(all_dist, axis=1, kind="stable")[:, :beam]
            at = np.arange(len(rows))[:, None]
            ids[rows], dist[rows], fresh[rows] = all_ids[at, order], all_dist[at, order], all_fresh[at, order]
            fresh[rows] &= np.isfinite(dist[rows])
            rows = rows[fresh[rows].any(axis=1)]
        ids[~np.isfinite(dist)] = -1
        return ids, dist


def lifted(points: np.ndarray) -> np.ndarray:
    """One more coordinate: then all norms are equal, and the nearest point has the largest inner product."""
    square = (points**2).sum(axis=1)
    return np.concatenate([points, np.sqrt(np.maximum(0, square.max(initial=0) - square))[:, None]], axis=1)


def nearest(rows: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vector: str = "embedding", beam: int = SEARCH_BEAM) -> DataFrame:
    """For each row whose id is divisible by ``every``: the ``k`` rows of other ids with the largest inner product, as
    query_id, rank (from 1), ``id_col``, score (double, of the original vectors); ties to the smaller id.  Rows that
    repeat are one row; of an id with several vectors the best score counts.

    Vectors that are null, empty, zero or hold null or non-finite components take no part, nor do null ids; vectors of
    different lengths never meet.  Measured recall is 0.99 on vectors of equal norm and about 0.95 where norms vary by a
    factor of four (there the beam is three times as wide).  Equal vectors are one point that carries its ``k`` + 1 smallest ids, which is all
    that a result can hold.  Points are dealt to shards of about ``SHARD`` by hash; a shard's graph is built once and
    sent to every block of queries.  What is found in each shard is scored exactly, and ranks are cut in every task
    before the last shuffle.
    """
    spark = rows.sparkSession
    part = store(rows.where(usable(vector) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vec")), "vectors")
    points = store(classes(part, "vec", "id", k + 1).withColumn("dim", F.size("vec")), "points")
    per_dim = points.groupBy("dim").count().withColumn("shards", F.ceil(F.col("count") / SHARD))
    dims = {r["dim"]: r["shards"] for r in per_dim.collect()}
    if not dims:
        return spark.createDataFrame([], f"query_id bigint, rank int, `{id_col}` bigint, score double")
    count = F.element_at(F.create_map(*[F.lit(int(x)) for pair in dims.items() for x in pair]), F.col("dim"))
    dealt = points.withColumn("shard", F.pmod(F.xxhash64("vec"), count)).select("dim", "shard", "vec", "ids")

    def build(key, table):
        table = table.sort_by([("first", "ascending")])
        x = matrix(table.column("vec").combine_chunks())
        graph = Graph.build(lifted(x))
        ids = table.column("ids").to_pylist()
        flat = np.array([i for some in ids for i in some], np.int64)
        return pa.table({"dim": [key[0].as_py()], "shard": [key[1].as_py()], "vecs": [x.tobytes()], "edges": [graph.neighbours.tobytes()], "entry": [graph.entry], "ids": [flat.tobytes()], "many": [np.array([len(i) for i in ids], np.int32).tobytes()]}).cast(pa.schema([("dim", pa.int32()), ("shard", pa.int64()), ("vecs", pa.binary()), ("edges", pa.binary()), ("entry", pa.int32()), ("ids", pa.binary()), ("many", pa.binary())]))

    graphs = store(dealt.withColumn("first", F.col("ids")[0]).groupBy("dim", "shard").applyInArrow(build, "dim int, shard bigint, vecs binary, edges binary, entry int, ids binary, many binary"), "graphs")
    queries = part.where(F.pmod(F.col("id"), F.lit(every)) == 0).distinct().withColumn("dim", F.size("vec"))
    n_queries = queries.count()
    blocks = max(1, -(-n_queries // QUERY_BLOCK))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("id", "vec"), F.lit(blocks)).cast("int"))

    def pack(key, table):
        return pa.table({"dim": pa.array([key[0].as_py()], pa.int32()), "block": pa.array([key[1].as_py()], pa.int32()), "qids": [table.column("id").to_numpy().tobytes()], "qvecs": [matrix(table.column("vec").combine_chunks()).tobytes()]})

    packed = store(queries.groupBy("dim", "block").applyInArrow(pack, "dim int, block int, qids binary, qvecs binary"), "queries")
    # a stated set of queries against all shards, in blocks: each block is sent to every shard of its length
    sent = packed.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("bigint"), count - 1)))
    cells = graphs.join(sent, ["dim", "shard"])

    def search(batches):
        for batch in batches:
            for row in batch.to_pylist():
                x = np.frombuffer(row["vecs"]).reshape(-1, row["dim"])
                graph = Graph(lifted(x), np.frombuffer(row["edges"], np.int32).reshape(len(x), -1), row["entry"])
                # unequal norms put queries outside the points, which takes a wider beam
                wide = max(beam, k + 1) if graph.points[:, -1].max() ** 2 < 0.1 * (graph.points[0] ** 2).sum() else 3 * max(beam, k + 1)
                many = np.frombuffer(row["many"], np.int32)
                ids, start = np.frombuffer(row["ids"], np.int64), np.cumsum(many) - many
                qids, qvecs = np.frombuffer(row["qids"], np.int64), np.frombuffer(row["qvecs"]).reshape(-1, row["dim"])
                for at in range(0, len(qids), 256):
                    q, qid = qvecs[at : at + 256], qids[at : at + 256]
                    found, _ = graph.search(np.concatenate([q, np.zeros((len(q), 1))], axis=1), wide)
                    i, c = np.nonzero(found >= 0)
                    node = found[i, c]
                    score = np.einsum("ij,ij->i", q[i], x[node])
                    i, score = np.repeat(i, many[node]), np.repeat(score, many[node])
                    offset = np.arange(len(i)) - np.repeat(np.cumsum(many[node]) - many[node], many[node])
                    vec = ids[np.repeat(start[node], many[node]) + offset]
                    real = vec != qid[i]
                    i, vec, score = i[real], vec[real], score[real]
                    # the same id may stand behind several vectors: its best score counts
                    order = np.lexsort((-score, vec, i))
                    i, vec, score = i[order], vec[order], score[order]
                    new = np.ones(len(i), bool)
                    new[1:] = (i[1:] != i[:-1]) | (vec[1:] != vec[:-1])
                    i, vec, score = i[new], vec[new], score[new]
                    order = np.lexsort((vec, -score, i))
                    i, vec, score = i[order], vec[order], score[order]
                    place = np.arange(len(i)) - np.repeat(np.searchsorted(i, np.arange(len(q))), np.bincount(i, minlength=len(q)))
                    top = place < k
                    yield pa.RecordBatch.from_arrays([pa.array(qid[i[top]]), pa.array(vec[top]), pa.array(score[top])], names=["query_id", "vec", "score"])

    hits = cells.mapInArrow(search, "query_id bigint, vec bigint, score double").groupBy("query_id", "vec").agg(F.max("score").alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec")
    ranked = hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    out = store(ranked.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("vec").alias(id_col), "score"), "nearest")
    drop_stored(part, points, graphs, packed)
    return out
