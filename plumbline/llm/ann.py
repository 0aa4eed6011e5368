"""Approximate nearest neighbours by inner product with vantage-point trees.

Each shard has a tree. Inner products become distances by one more coordinate, sqrt(M * M - |x| * |x|) with M the longest
length of the shard, which is 0 for queries; the order within the shard stays the same. A side of a vantage point is
left out when its distance bound, times a factor, exceeds the distance of the k-th best so far: with factor one nothing
that could be nearer is left out, and larger factors search less.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settled
from .vectors import SHARD_ROWS, top_k, usable

LEAF = 64
FACTOR = 4.0  # measured recall on the given tables is above 0.99: see the README
SLACK = 4  # more candidates than asked for, as sums in another order may round differently


class VantageTree:
    """Nodes hold a vantage point, the median distance to it, and two sides; leaves hold rows."""

    def __init__(self, vectors: np.ndarray, leaf: int = LEAF):
        lengths = (vectors * vectors).sum(axis=1)
        self.points = np.column_stack([vectors, np.sqrt(np.maximum(lengths.max() - lengths, 0))])
        self.random = np.random.default_rng(len(vectors))
        self.root = self._node(np.arange(len(vectors)), leaf)

    def _node(self, rows: np.ndarray, leaf: int):
        if len(rows) <= leaf:
            return rows, None
        vantage = self.points[self.random.choice(rows)]
        distance = np.sqrt(((self.points[rows] - vantage) ** 2).sum(axis=1))
        order = np.argsort(distance, kind="stable")
        half = len(rows) // 2
        inner, outer = order[:half], order[half:]
        return vantage, (distance[inner].max(), distance[outer].min(),
                         self._node(rows[inner], leaf), self._node(rows[outer], leaf))


class Search:
    def __init__(self, tree: VantageTree, queries: np.ndarray, k: int, factor: float):
        self.tree, self.k, self.factor = tree, min(k, len(tree.points)), factor
        self.queries = np.column_stack([queries, np.zeros(len(queries))])
        self.distance = np.full((len(queries), self.k), np.inf)
        self.place = np.full((len(queries), self.k), -1)
        self.home = np.full(len(queries), -1)
        self._descend(tree.root, np.arange(len(queries)))
        self._visit(tree.root, np.arange(len(queries)))

    def _from(self, vantage: np.ndarray, active: np.ndarray) -> np.ndarray:
        return np.sqrt(((self.queries[active] - vantage) ** 2).sum(axis=1))

    def _leaf(self, rows: np.ndarray, active: np.ndarray) -> None:
        points, queries = self.tree.points[rows], self.queries[active]
        squares = (queries**2).sum(axis=1)[:, None] + (points**2).sum(axis=1)[None] - 2 * queries @ points.T
        distance = np.concatenate([self.distance[active], np.sqrt(np.maximum(squares, 0))], axis=1)
        place = np.concatenate([self.place[active], np.broadcast_to(rows, (len(active), len(rows)))], axis=1)
        best = np.lexsort((place, distance), axis=1)[:, : self.k]
        self.distance[active] = np.take_along_axis(distance, best, axis=1)
        self.place[active] = np.take_along_axis(place, best, axis=1)

    def _descend(self, node, active: np.ndarray) -> None:
        """Every query first searches the leaf that it falls into."""
        at, sides = node
        if not len(active):
            return
        if sides is None:
            self.home[active] = at[0] if len(at) else -1
            self._leaf(at, active)
            return
        near = self._from(at, active) <= (sides[0] + sides[1]) / 2
        self._descend(sides[2], active[near])
        self._descend(sides[3], active[~near])

    def _visit(self, node, active: np.ndarray) -> None:
        at, sides = node
        if sides is None:
            active = active[self.home[active] != at[0]] if len(at) else active[:0]
            if len(active):
                self._leaf(at, active)
            return
        if not len(active):
            return
        away = self._from(at, active)
        for bound, side in ((away - sides[0], sides[2]), (sides[1] - away, sides[3])):
            self._visit(side, active[bound * self.factor <= self.distance[active, -1]])


def search_shard(factor: float):
    def search(queries: np.ndarray, vectors: np.ndarray, k: int):
        queries, vectors = queries.astype(np.float64) + 0.0, vectors.astype(np.float64) + 0.0
        # equal vectors are one point of the tree; points and the rows of each are in order of rows
        _, first, point, times = np.unique(vectors, axis=0, return_index=True, return_inverse=True, return_counts=True)
        place = np.argsort(np.argsort(first))
        points = vectors[np.sort(first)]
        rows, times = np.argsort(place[point.ravel()], kind="stable"), times[np.argsort(first)]
        begin = np.cumsum(times) - times
        found = Search(VantageTree(points), queries, k + SLACK, factor)
        q, c = np.nonzero(found.place >= 0)
        p = found.place[q, c]
        score = np.einsum("ij,ij->i", queries[q], points[p])
        each = np.minimum(times[p], k)
        r = rows[np.repeat(begin[p], each) + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)]
        q, score = np.repeat(q, each), np.repeat(score, each)
        best = np.lexsort((r, -score, q))
        best = best[np.arange(len(best)) - np.searchsorted(q[best], q[best]) < k]
        return q[best], r[best], score[best]

    return search


def nearest(vectors: DataFrame, asked: Column, k: int = 20, factor: float = FACTOR) -> DataFrame:
    """(query_id, rank, vec_id, score) of vectors (vec_id, embedding): the k nearest found of each row where `asked` holds.

    The score is the inner product in double precision, ties go to the smaller vec_id. Null and zero vectors and those
    with null or non-finite components take no part, nor do null ids; only vectors of the same length are compared. Rows
    that repeat a vec_id are each a candidate of other ids, and one query. No vectors, or no queries, give no rows.
    """
    vector = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector")).where(
        F.col("vec_id").isNotNull() & usable("vector")).where(F.exists("vector", lambda x: x != 0))
    rows = settled(rows, "vectors")
    n_shards = max(1, -(-rows.count() // SHARD_ROWS))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(n_shards)).cast("int"))
    return top_k(rows, asked, n_shards, search_shard(factor), k, "double")
