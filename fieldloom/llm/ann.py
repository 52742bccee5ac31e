"""Approximate nearest neighbours: a robust-pruned directed graph for each shard, searched by beams."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import written

#: Points inserted at once, and searches run side by side.
BLOCK = 256


def _distances(points: np.ndarray, norms: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Squared distance of each vector (a row) to its own points (the same row of ids)."""
    found = points[ids]
    out = norms[ids] + np.einsum("qd,qd->q", vectors, vectors)[:, None] - 2 * np.matmul(found, vectors[:, :, None])[:, :, 0]
    return np.maximum(out, 0)


class Graph:
    """A directed graph over points: greedy search proposes neighbours, pruning keeps diverse ones.

    degree: edges of a point at most.  beam: candidates a search holds.  alpha: a candidate is dropped if a neighbour already
    chosen is nearer to it than the point is, by this factor.  Searches start from points spread over the
    shard, so that a dense cluster can't hide the rest.
    """

    def __init__(self, points: np.ndarray, degree: int = 32, beam: int = 64, alpha: float = 1.2, entries: int = 48, seed: int = 1, edges: np.ndarray | None = None):
        self.size = max(float(np.abs(points).max(initial=0)), np.finfo(float).tiny)
        self.centre = (points / self.size).mean(axis=0) if len(points) else np.zeros(points.shape[1])
        self.reach = max(float(np.abs(points / self.size - self.centre).max(initial=0)), 1e-300)
        self.points = self._placed(points)
        self.norms = np.einsum("nd,nd->n", self.points, self.points)
        self.degree, self.beam, self.alpha = degree, beam, alpha
        n = len(points)
        order = np.random.default_rng(seed).permutation(n)
        self.entries = order[: min(n, entries)]
        self.edges = np.full((n, degree), -1, np.int32) if edges is None else edges
        if edges is None:
            self._build(order)

    def _placed(self, vectors: np.ndarray) -> np.ndarray:
        """Single precision, around the points' centre and in their scale, so that neither large components nor a
        common offset cost digits.  Vectors far outside are brought to where squares are still finite."""
        with np.errstate(over="ignore"):
            return np.clip((vectors / self.size - self.centre) / self.reach, -1e15, 1e15).astype(np.float32)

    def _build(self, order: np.ndarray) -> None:
        first = order[: min(len(order), max(len(self.entries), 2 * self.degree))]
        every = np.broadcast_to(first, (len(first), len(first)))
        self._insert(first, every.copy())
        at = len(first)
        while at < len(order):
            block = order[at : at + min(BLOCK, at)]
            at += len(block)
            found, _ = self._searched(self.points[block], self.beam, 4)
            self._insert(block, np.concatenate((found, self.edges[np.maximum(found[:, 0], 0)]), axis=1))

    def _insert(self, block: np.ndarray, proposed: np.ndarray) -> None:
        chosen = self._prune(block, proposed)
        self.edges[block] = chosen
        source, target = np.repeat(block, self.degree), chosen.ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        heads, begins, counts = np.unique(target, return_index=True, return_counts=True)
        back = np.full((len(heads), int(counts.max(initial=0))), -1, np.int64)
        back[np.repeat(np.arange(len(heads)), counts), np.arange(len(target)) - np.repeat(begins, counts)] = source
        for i in range(0, len(heads), BLOCK):
            h = heads[i : i + BLOCK]
            self.edges[h] = self._prune(h, np.concatenate((self.edges[h], back[i : i + BLOCK]), axis=1))

    def _prune(self, block: np.ndarray, proposed: np.ndarray) -> np.ndarray:
        """For each point of the block, its neighbours among those proposed (-1: none)."""
        out = np.full((len(block), self.degree), -1, np.int64)
        for i in range(0, len(block), BLOCK):
            p, c = block[i : i + BLOCK], proposed[i : i + BLOCK]
            d = _distances(self.points, self.norms, np.maximum(c, 0), self.points[p])
            d[(c < 0) | (c == p[:, None])] = np.inf
            order = np.lexsort((c, d), axis=1)
            c, d = np.take_along_axis(c, order, 1), np.take_along_axis(d, order, 1)
            d[:, 1:][c[:, 1:] == c[:, :-1]] = np.inf
            width = min(c.shape[1], 3 * self.degree)
            order = np.argsort(d, axis=1, kind="stable")[:, :width]
            c, d = np.take_along_axis(c, order, 1), np.take_along_axis(d, order, 1)
            found = self.points[np.maximum(c, 0)]
            alive, rows = np.isfinite(d), np.arange(len(p))
            keep = np.zeros_like(alive)
            factor = self.alpha * self.alpha
            for _ in range(self.degree):
                if not alive.any():
                    break
                k = alive.argmax(axis=1)
                some = alive[rows, k]
                keep[rows[some], k[some]] = True
                star = c[rows, k]
                between = self.norms[np.maximum(c, 0)] + self.norms[star][:, None] - 2 * np.matmul(found, self.points[star][:, :, None])[:, :, 0]
                alive &= (factor * between > d) | ~some[:, None]
                alive[rows, k] = False
            order = np.argsort(~keep, axis=1, kind="stable")[:, : self.degree]  # those kept, nearest first; what was pruned stays out
            best = np.where(np.take_along_axis(keep, order, 1), np.take_along_axis(c, order, 1), -1)
            out[i : i + BLOCK, : best.shape[1]] = best
        return out

    def search(self, vectors: np.ndarray, beam: int, wide: int = 4) -> tuple[np.ndarray, np.ndarray]:
        """Places of up to `beam` points near each vector (-1: none) and squared distances (in the points' scale), nearest first."""
        return self._searched(self._placed(vectors), beam, wide)

    def _searched(self, placed: np.ndarray, beam: int, wide: int) -> tuple[np.ndarray, np.ndarray]:
        parts = [self._search(placed[i : i + BLOCK], beam, wide) for i in range(0, len(placed), BLOCK)]
        return tuple(np.concatenate(x) for x in zip(*parts))

    def _search(self, vectors: np.ndarray, beam: int, wide: int) -> tuple[np.ndarray, np.ndarray]:
        q = len(vectors)
        ids = np.broadcast_to(self.entries, (q, len(self.entries))).astype(np.int64)
        d = _distances(self.points, self.norms, ids, vectors)
        done = np.zeros(ids.shape, bool)
        ids, d, done = self._best(ids, d, done, beam)
        rows = np.arange(q)
        while True:
            waiting = np.where(done | (ids < 0), np.inf, d)
            active = rows[np.isfinite(waiting.min(axis=1))]
            if not len(active):
                return ids, d
            pick = np.argsort(waiting[active], axis=1, kind="stable")[:, :wide]
            usable = np.isfinite(np.take_along_axis(waiting[active], pick, 1))
            here = done[active]
            np.put_along_axis(here, pick, np.take_along_axis(here, pick, 1) | usable, 1)
            done[active] = here
            next_ids = self.edges[np.where(usable, np.take_along_axis(ids[active], pick, 1), 0)].astype(np.int64)
            next_ids[~usable] = -1
            next_ids = next_ids.reshape(len(active), -1)
            new = _distances(self.points, self.norms, np.maximum(next_ids, 0), vectors[active])
            new[next_ids < 0] = np.inf
            merged = self._best(np.concatenate((ids[active], next_ids), 1), np.concatenate((d[active], new), 1), np.concatenate((done[active], np.zeros(next_ids.shape, bool)), 1), beam)
            ids[active], d[active], done[active] = merged

    @staticmethod
    def _best(ids: np.ndarray, d: np.ndarray, done: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The nearest, each once; one that is done stays so."""
        order = np.lexsort((~done, ids), axis=1)
        ids, d, done = (np.take_along_axis(x, order, 1) for x in (ids, d, done))
        again = np.zeros(ids.shape, bool)
        again[:, 1:] = ids[:, 1:] == ids[:, :-1]
        d = np.where(again | (ids < 0), np.inf, d)
        order = np.argsort(d, axis=1, kind="stable")[:, :beam]
        ids, d, done = (np.take_along_axis(x, order, 1) for x in (ids, d, done))
        ids = np.where(np.isfinite(d), ids, -1)
        if ids.shape[1] < beam:
            fill = beam - ids.shape[1]
            ids = np.pad(ids, ((0, 0), (0, fill)), constant_values=-1)
            d = np.pad(d, ((0, 0), (0, fill)), constant_values=np.inf)
            done = np.pad(done, ((0, 0), (0, fill)), constant_values=True)
        return ids, d, done


def _matrix(column: pa.ChunkedArray, dim: int, kind) -> np.ndarray:
    lists = column.combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks)
    return lists.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, dim)


INDEX = "dim int, shard int, node int, vec_ids array<long>, vector array<double>, edges array<int>"
_INDEX = pa.schema([("dim", pa.int32()), ("shard", pa.int32()), ("node", pa.int32()), ("vec_ids", pa.list_(pa.int64())), ("vector", pa.list_(pa.float64())), ("edges", pa.list_(pa.int32()))])


def _lists(values: np.ndarray, cuts: np.ndarray, kind) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(values, kind))


def _index(options: dict):
    def build(table: pa.Table) -> pa.Table:
        dim, shard = table.column("dim")[0].as_py(), table.column("shard")[0].as_py()
        ids = table.column("vec_id").to_numpy()
        vectors = _matrix(table.column("vector"), dim, np.float64)
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], vectors[order]
        points, node = np.unique(vectors, axis=0, return_inverse=True)
        node = node.ravel()
        graph = Graph(points, **options)
        order = np.argsort(node, kind="stable")
        cuts = np.concatenate(([0], np.cumsum(np.bincount(node, minlength=len(points)))))
        n = len(points)
        wide = np.arange(n + 1)
        return pa.table([pa.array(np.full(n, dim, np.int32)), pa.array(np.full(n, shard, np.int32)), pa.array(np.arange(n, dtype=np.int32)), _lists(ids[order], cuts, pa.int64()), _lists(points.ravel(), wide * dim, pa.float64()), _lists(graph.edges.ravel().astype(np.int32), wide * graph.degree, pa.int32())], schema=_INDEX)

    return build


def usable(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """vec_id, vector (doubles) and dim of the rows that can be compared; exact repeats once.

    Not: a null id or vector, an empty or zero one, one with a component that is null, NaN or infinite.
    """
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()).filter(~bad & F.exists("vector", lambda x: x != 0))
    return rows.dropDuplicates(["vec_id", "vector"]).withColumn("dim", F.size("vector"))


def build_index(rows: DataFrame, shard_rows: int = 4096, **options) -> DataFrame:
    """A graph for each shard of usable() rows: one row for each different vector, with the ids that have it.

    shard_rows bounds what one task holds: the number of shards follows the number of rows, and a hash of id
    and vector deals rows to them evenly, whatever vectors are common.  Every row is indexed.
    """
    shards = max(1, math.ceil(rows.count() / shard_rows))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(shards)).cast("int"))
    return dealt.groupBy("dim", "shard").applyInArrow(_index(options), INDEX)


def _found(k: int, beam: int, options: dict):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def search(index: pa.Table, queries: pa.Table) -> pa.Table:
        if not index.num_rows or not queries.num_rows:
            return schema.empty_table()
        dim = index.column("dim")[0].as_py()
        index = index.sort_by("node")
        points = _matrix(index.column("vector"), dim, np.float64)
        edges = _matrix(index.column("edges"), len(index.column("edges")[0]), np.int32)
        members = index.column("vec_ids").to_pylist()
        graph = Graph(points, edges=edges, **{**options, "degree": edges.shape[1]})
        asked = queries.column("query_id").to_numpy()
        vectors = _matrix(queries.column("vector"), dim, np.float64)
        ids, _ = graph.search(vectors, max(beam, k + 1))
        out = []
        for query, vector, near in zip(asked.tolist(), vectors, ids):
            near = near[near >= 0]
            difference = points[near] - vector
            total = np.zeros(len(near))
            for j in range(dim):  # in order of components, so that every engine gets the same sum
                total += difference[:, j] * difference[:, j]
            scores = np.sqrt(total)
            order = np.argsort(scores, kind="stable")
            pairs = [(s, v) for s, i in zip(scores[order].tolist(), near[order].tolist()) for v in sorted(members[i])[: k + 1] if v != query]
            pairs.sort()
            out += [(query, v, s) for s, v in pairs[: 4 * k]]
        columns = list(zip(*out)) or [(), (), ()]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return search


def search(index: DataFrame, queries: DataFrame, k: int = 10, beam: int = 128, block_rows: int = 16_384, **options) -> DataFrame:
    """query_id, rank, vec_id and score: the k nearest found of each query (usable() rows), nearest first.

    Every shard of the index is searched for every query of its dimension, queries in blocks of bounded size; the
    shards' answers (a few times k rows each) meet by query.  score: the Euclidean distance in double precision.
    Ties go to the smaller vec_id.  A row of the query's own id is no answer; where an id has several vectors, the
    nearest counts.  Fewer candidates than k: all of them.  Options are those of Graph, as the index was built.
    """
    blocks = max(1, math.ceil(queries.count() / block_rows))
    shards = index.select(F.col("dim").alias("of_dim"), F.col("shard").alias("of_shard")).distinct()
    asked = queries.select(F.col("vec_id").alias("query_id"), "vector", "dim", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(blocks)).cast("int").alias("block"))
    asked = asked.join(shards, F.col("dim") == F.col("of_dim")).select("query_id", "vector", F.col("of_dim").alias("dim"), F.col("of_shard").alias("shard"), "block")
    held = index.select("*", F.explode(F.array(*map(F.lit, range(blocks)))).alias("block")) if blocks > 1 else index.withColumn("block", F.lit(0))
    key = ["dim", "shard", "block"]
    near = held.groupBy(*key).cogroup(asked.groupBy(*key)).applyInArrow(_found(k, beam, options), "query_id long, vec_id long, score double")
    each = near.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return each.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def neighbours(vectors: DataFrame, queries: DataFrame, k: int = 10, shard_rows: int = 4096, beam: int = 128, **options) -> DataFrame:
    """Index vectors and search for queries (both tables have vec_id and embedding); see search().

    Rows that usable() leaves out take no part, on either side.  Empty tables: an empty result.
    """
    rows, _ = written(usable(vectors), "vectors")
    index, _ = written(build_index(rows, shard_rows, **options), "index")
    return search(index, usable(queries), k, beam, **options)


def neighbours_sql(k: int = 10, every: int = 100) -> str:
    """The exact answer, by comparing all; the graph's answer is this one wherever its beams find all."""
    return f"""
with v as (select vec_id, cast(embedding as double[]) as x from embeddings
           where vec_id is not null and embedding is not null and len(embedding) > 0
             and len(list_filter(embedding, lambda e: e is null or isnan(e) or isinf(e))) = 0
             and len(list_filter(embedding, lambda e: e <> 0)) > 0),
each as (select q.vec_id as query_id, c.vec_id,
                sqrt(list_reduce(list_transform(list_zip(c.x, q.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])), lambda a, b: a + b)) as score
         from v q join v c on q.vec_id <> c.vec_id and len(q.x) = len(c.x) where q.vec_id % {every} = 0),
best as (select query_id, vec_id, min(score) as score from each group by 1, 2),
ranked as (select *, row_number() over (partition by query_id order by score, vec_id) as rank from best)
select query_id, cast(rank as int) as rank, vec_id, score from ranked where rank <= {k}
"""
