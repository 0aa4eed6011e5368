"""Searches of a stated query set against all vectors: a block of queries meets a shard of vectors in one task."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SHARD_ROWS = 4096
BLOCK_ROWS = 2048


def usable(vector: str) -> Column:
    """Neither null nor empty, and without null or non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(F.size(vector) > 0, F.lit(False)) & ~F.coalesce(bad, F.lit(False))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _distinct(ids: np.ndarray, vectors: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first of the rows that are equal in id and vector, in order of id, and how many each stands for."""
    order = rows[np.lexsort((*vectors[rows].T[::-1], ids[rows]))]
    new = np.ones(len(order), bool)
    new[1:] = (ids[order[1:]] != ids[order[:-1]]) | (vectors[order[1:]] != vectors[order[:-1]]).any(axis=1)
    at = np.flatnonzero(new)
    return order[at], np.diff(np.append(at, len(order)))


def _pairs(search: Callable, k: int, kind: pa.DataType):
    def run(group: pa.Table) -> pa.Table:
        asked, ids = group.column("asked").to_numpy(), group.column("vec_id").to_numpy()
        rows, queries = np.flatnonzero(~asked), np.flatnonzero(asked)
        out = ([], [], [])
        if len(rows) and len(queries):
            vectors = _matrix(group.column("vector"))
            rows, times = _distinct(ids, vectors, rows)
            # a query's own rows are among those found: one, unless its id comes with several vectors
            own = np.searchsorted(ids[rows], ids[queries], "right") - np.searchsorted(ids[rows], ids[queries], "left")
            more = 1 << np.ceil(np.log2(np.maximum(own, 1))).astype(np.int64)
            parts = []
            for m in np.unique(more):
                some = queries[more == m]
                q, r, s = search(vectors[some], vectors[rows], k + int(m))
                other = ids[some[q]] != ids[rows[r]]
                q, r, s = some[q[other]], r[other], s[other]
                each = np.minimum(times[r], k)
                parts.append((np.repeat(ids[q], each), np.repeat(ids[rows[r]], each), np.repeat(s, each)))
            out = tuple(np.concatenate(x) for x in zip(*parts))
        return pa.table({"query_id": pa.array(out[0], pa.int64()), "vec_id": pa.array(out[1], pa.int64()),
                         "score": pa.array(out[2], kind)})

    return run


def top_k(rows: DataFrame, asked: Column, n_shards: int, search: Callable, k: int, score: str) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of each query among all rows but its own.

    rows has vec_id, vector and shard (from 0 to n_shards - 1). search(queries, vectors, k) gives, for a block and a
    shard, query places, row places and scores of at least the k best of each query; rows come in order of vec_id.
    """
    queries = rows.where(asked).groupBy("vec_id").agg(F.min("vector").alias("vector"))  # one for each id
    blocks = max(1, -(-queries.count() // BLOCK_ROWS))
    dim = F.size("vector").alias("dim")
    left = rows.select("vec_id", "vector", dim, "shard", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
                       F.lit(False).alias("asked"))
    right = queries.select("vec_id", "vector", dim, F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))).alias("shard"),
                           F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"), F.lit(True).alias("asked"))
    found = left.union(right).groupBy("dim", "shard", "block").applyInArrow(
        _pairs(search, k, pa.int64() if score == "long" else pa.float64()), f"query_id long, vec_id long, score {score}")
    best = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", best.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
