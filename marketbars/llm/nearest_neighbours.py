"""Approximate nearest neighbours by robust-pruned directed graphs.

Vectors are dealt into shards at random; equal ones are one, with their smallest
ids. In a shard, batches of vectors are inserted into a graph: a greedy search
proposes neighbours, pruning keeps the diverse ones among them, and edges back
are pruned where a node has too many. A second pass links all nodes again and
prunes less, so that edges of all lengths stay. Queries pass every shard's graph in
a beam search; the best of all shards are the result.

Near copies would fill a beam and hide what lies beyond. A vector within a small
distance of a node therefore joins that node, and a search opens the nodes whose
members can be among the nearest.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketbars.llm.shared import saved
from marketbars.llm.vectors import finite, in_shards, matrix, shard_by_shard

DEGREE = 32
BUILD_BEAM = 64
BEAM = 128
RELAXED = 1.2
SHARD_ROWS = 4096
# Of the median distance between vectors: members are closer to their node.
NEAR = 0.15
_BATCH = 512
_ENTRIES = 16
_WIDTH = 4
_SAMPLE = 256


def _ranges(counts: np.ndarray) -> np.ndarray:
    """0, 1, .. for each count, one after another."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def _padded(rows: np.ndarray, values: np.ndarray, n: int, fill: float) -> np.ndarray:
    """Values of sorted rows as a matrix of n rows."""
    counts = np.bincount(rows, minlength=n)
    out = np.full((n, int(counts.max(initial=0))), fill, values.dtype)
    out[rows, _ranges(counts)] = values
    return out


def _sorted_by(key: np.ndarray, *others: np.ndarray) -> list[np.ndarray]:
    order = np.argsort(key, axis=1, kind="stable")
    return [np.take_along_axis(x, order, 1) for x in (key, *others)]


class Graph:
    """A graph over the rows of a matrix."""

    def __init__(self, points: np.ndarray, near: float = NEAR) -> None:
        self.points = points
        n = len(points)
        self.edges = np.full((n, DEGREE), -1, np.int32)
        self.node = np.full(n, -1, np.int64)
        rng = np.random.default_rng(7)
        order = rng.permutation(n)
        sample = points[order[:_SAMPLE]]
        apart = ((sample[:, None, :] - sample[None, :, :]) ** 2).sum(2)
        apart = apart[np.triu_indices(len(sample), 1)]
        self._near = near * near * float(np.median(apart)) if len(apart) else 0.0
        self.entries = np.empty(0, np.int64)
        at, size = 0, 64
        while at < n:
            self._insert(order[at : at + size])
            at, size = at + size, min(2 * size, _BATCH)
        nodes = np.flatnonzero(self.node == np.arange(n))
        for at in range(0, len(nodes), _BATCH):
            some = nodes[at : at + _BATCH]
            near_ids, _ = self.search(points[some], BUILD_BEAM)
            self._link(some, near_ids, RELAXED)
        self._members(nodes)

    def _insert(self, batch: np.ndarray) -> None:
        found = np.empty((len(batch), 0), np.int64)
        if len(self.entries):
            found, distance = self.search(self.points[batch], BUILD_BEAM)
            joins = distance[:, 0] <= self._near
            self.node[batch[joins]] = found[joins, 0]
            batch, found = batch[~joins], found[~joins]
        x = self.points[batch]
        mates = np.array([((x - y) ** 2).sum(1) for y in x]).reshape(len(x), len(x))
        free = np.ones(len(batch), bool)
        chosen = []
        for i in range(len(batch)):
            if free[i]:
                close = free & (mates[i] <= self._near)
                self.node[batch[close]] = batch[i]
                self.node[batch[i]] = batch[i]
                free &= ~close
                chosen.append(i)
        if not chosen:
            return
        new = batch[chosen]
        apart = mates[np.ix_(chosen, chosen)]
        nearest = new[np.argsort(apart, axis=1, kind="stable")[:, : _ENTRIES + 1]]
        if len(self.entries) < _ENTRIES:
            self.entries = np.r_[self.entries, new[: _ENTRIES - len(self.entries)]]
        self._link(new, np.concatenate([found[chosen], nearest], 1), 1.0)

    def _members(self, nodes: np.ndarray) -> None:
        order = np.argsort(self.node, kind="stable")
        self._order = order
        self._first = np.searchsorted(self.node[order], np.arange(len(self.points)))
        self._count = np.bincount(self.node, minlength=len(self.points))
        away = np.sqrt(((self.points - self.points[self.node]) ** 2).sum(1))
        self._radius = np.zeros(len(self.points))
        np.maximum.at(self._radius, self.node, away)

    def _prune(self, nodes: np.ndarray, near: np.ndarray, relaxed: float) -> np.ndarray:
        """At most DEGREE of the candidates: the nearest, less what is nearer to one kept."""
        away = ((self.points[np.maximum(near, 0)] - self.points[nodes][:, None]) ** 2).sum(2)
        near = np.where(near == nodes[:, None], -1, near)
        away[near < 0] = np.inf
        by_id = np.lexsort((near, away), axis=1)
        away, near = np.take_along_axis(away, by_id, 1), np.take_along_axis(near, by_id, 1)
        left = near >= 0
        left[:, 1:] &= near[:, 1:] != near[:, :-1]
        x, rows = self.points[np.maximum(near, 0)], np.arange(len(nodes))
        # Nodes are apart, so that differences of products keep their digits.
        product = x @ x.transpose(0, 2, 1)
        square = np.einsum("ijj->ij", product)
        between = square[:, :, None] + square[:, None, :] - 2 * product
        between *= relaxed * relaxed
        kept = np.full((len(nodes), DEGREE), -1, np.int32)
        for k in range(DEGREE):
            some = left.any(1)
            if not some.any():
                break
            at = left.argmax(1)
            kept[some, k] = near[rows, at][some]
            left &= between[rows, at] > away
            left[rows, at] = False
        return kept

    def _link(self, nodes: np.ndarray, near: np.ndarray, relaxed: float) -> None:
        both = np.concatenate([near, self.edges[nodes].astype(np.int64)], 1)
        for at in range(0, len(nodes), 128):
            some = nodes[at : at + 128]
            self.edges[some] = self._prune(some, both[at : at + 128], relaxed)
        # Edges back.
        rows, columns = np.nonzero(self.edges[nodes] >= 0)
        to, back = self.edges[nodes][rows, columns].astype(np.int64), nodes[rows]
        order = np.argsort(to, kind="stable")
        to, back = to[order], back[order]
        ends, place = np.unique(to, return_inverse=True)
        more = _padded(place, back, len(ends), -1)
        for at in range(0, len(ends), 128):
            some = ends[at : at + 128]
            every = np.concatenate([self.edges[some].astype(np.int64), more[at : at + 128]], 1)
            every = -np.sort(-every, axis=1)
            every[:, 1:][every[:, 1:] == every[:, :-1]] = -1
            full = (every >= 0).sum(1) > DEGREE
            self.edges[some[~full]] = -np.sort(-every[~full], axis=1)[:, :DEGREE]
            if full.any():
                self.edges[some[full]] = self._prune(some[full], every[full], relaxed)

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Nodes near each query, nearest first, and their squared distances.

        The beam holds the nearest nodes met so far; the nearest four of which the
        edges were not followed are next, until there are none.
        """
        n, b = len(self.points), len(queries)
        start = ((self.points[self.entries][None] - queries[:, None]) ** 2).sum(2)
        away, ids = _sorted_by(start, np.broadcast_to(self.entries, start.shape))
        done, seen = np.zeros(ids.shape, bool), np.zeros((b, n), bool)
        seen[:, self.entries] = True
        wider = beam - ids.shape[1]
        ids = np.pad(ids, ((0, 0), (0, wider)), constant_values=-1)
        away = np.pad(away, ((0, 0), (0, wider)), constant_values=np.inf)
        done = np.pad(done, ((0, 0), (0, wider)), constant_values=True)
        active = np.arange(b)
        while True:
            rank = np.cumsum(~done[active], axis=1)
            going = rank[:, -1] > 0
            active, rank = active[going], rank[going]
            if not len(active):
                return ids, away
            next_ = ~done[active] & (rank <= _WIDTH)
            done[active] |= next_
            rows, columns = np.nonzero(next_)
            near = self.edges[ids[active][rows, columns]]
            rows = np.repeat(rows, DEGREE)
            near = near.reshape(-1).astype(np.int64)
            fresh = (near >= 0) & ~seen[active[rows], np.maximum(near, 0)]
            key = np.unique(rows[fresh] * n + near[fresh])
            rows, near = key // n, key % n
            seen[active[rows], near] = True
            distance = ((self.points[near] - queries[active[rows]]) ** 2).sum(1)
            new_ids = _padded(rows, near, len(active), -1)
            new_away = _padded(rows, distance, len(active), np.inf)
            merged = _sorted_by(
                np.concatenate([away[active], new_away], 1),
                np.concatenate([ids[active], new_ids], 1),
                np.concatenate([done[active], new_ids < 0], 1),
            )
            away[active], ids[active], done[active] = (x[:, :beam] for x in merged)

    def nearest(self, query: np.ndarray, nodes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Points of the nodes that can be among the k nearest, and their distances."""
        nodes = nodes[nodes >= 0]
        away = np.sqrt(((self.points[nodes] - query) ** 2).sum(1))
        bound = np.sort(away)[min(k, len(away)) - 1] if len(away) >= k else np.inf
        # A little more, for rounding.
        nodes = nodes[away - self._radius[nodes] <= bound * (1 + 1e-9)]
        count = self._count[nodes]
        points = self._order[np.repeat(self._first[nodes], count) + _ranges(count)]
        return points, np.sqrt(((self.points[points] - query) ** 2).sum(1))


_FOUND = pa.schema(
    [("query_id", pa.int64()), ("query", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]
)


def _answers(k: int, beam: int):
    def build(items: pa.Table) -> tuple[Graph, list[list[int]]]:
        return Graph(matrix(items.column("vector"))), items.column("ids").to_pylist()

    def answer(built: tuple[Graph, list[list[int]]], asked: pa.Table) -> pa.RecordBatch:
        graph, ids = built
        queries = matrix(asked.column("vector"))
        near, _ = graph.search(queries, beam)
        rows = []
        names = zip(asked.column("query_id").to_pylist(), asked.column("query").to_pylist(), strict=True)
        for i, (query_id, query) in enumerate(names):
            points, away = graph.nearest(queries[i], near[i], k + 1)
            found, last, enough = [], None, 0
            for j in np.argsort(away, kind="stable").tolist():
                if enough >= k and away[j] > last:
                    break
                others = [x for x in ids[points[j]] if x != query_id]
                found += [(float(away[j]), x) for x in others]
                last, enough = away[j], enough + len(others)
            rows += [(query_id, query, x, s) for s, x in sorted(found)[:k]]
        return pa.record_batch([list(x) for x in zip(*rows, strict=True)] or [[]] * 4, schema=_FOUND)

    return build, answer


def nearest_neighbours(
    embeddings: DataFrame,
    queries: DataFrame,
    k: int = 10,
    *,
    beam: int = BEAM,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """The k nearest rows found for each query, by Euclidean distance.

    Both frames have `vec_id` and `embedding`; further columns are not read. Out
    come `query_id`, `rank` from 1, `vec_id` and `score`, the distance in double
    precision; ties go to the smaller `vec_id`. Rows of the query's own `vec_id` are
    not candidates. Rows without `vec_id`, and vectors that are null, empty, zero
    or hold a null or non-finite component, take no part. Equal rows count once;
    of equal vectors, the k + 1 smallest ids can be a result, and are kept. Rows
    that share a `vec_id` but not the vector are candidates, and queries, of their
    own. Vectors of different length do not meet.

    Every row is in the graph of its shard and every query searches every shard.
    The distance below which vectors are near copies comes from 256 rows a shard.
    """
    items = _vectors(embeddings).distinct()
    smallest = Window.partitionBy("vector").orderBy("vec_id")
    items = items.withColumn("place", F.row_number().over(smallest)).where(F.col("place") <= k + 1)
    items = items.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    items = saved(items.withColumn("dimension", F.size("vector").cast("long")))
    asked = _vectors(queries).distinct().withColumnRenamed("vec_id", "query_id")
    asked = asked.withColumn("query", F.xxhash64("vector"))
    asked = saved(asked.withColumn("dimension", F.size("vector").cast("long")))
    dealt = in_shards(items, asked, shard_rows, ["vector"])
    run = shard_by_shard(*_answers(k, beam), _BATCH)
    schema = "query_id long, query long, vec_id long, score double"
    found = saved(dealt.mapInArrow(run, schema))
    best = Window.partitionBy("query_id", "query").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _vectors(rows: DataFrame) -> DataFrame:
    vector = F.col("embedding").cast("array<double>")
    used = F.col("vec_id").isNotNull() & finite(vector) & F.exists(vector, lambda x: x != 0)
    return rows.where(used).select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))


def nearest_of_hundredths(embeddings: DataFrame) -> DataFrame:
    """The 10 nearest rows of every row whose `vec_id` is divisible by 100."""
    return nearest_neighbours(embeddings, embeddings.where(F.col("vec_id") % 100 == 0))
