"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are grouped by length, and a large group is split. In a bucket the longest vectors give each query a first
lower bound for its k-th score. That bound over the product of lengths is the local cosine threshold: above one the
rest of the bucket is left out; where it is high, the query's largest coordinates bound the score of each vector; where
it is low, only lengths do. What is left is verified by whole products.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import settled
from .vectors import SHARD_ROWS, top_k, usable

FIRST = 256  # longest vectors of a bucket that give the first bound
FOCUS = 12  # coordinates of a partial product
COSINE = 0.4  # local threshold from which coordinates are used
PER_DOUBLING = 8  # length buckets for each doubling of the length
EXACT = float(1 << 53)


def _products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    most = np.abs(queries).max(initial=0) * np.abs(vectors).max(initial=0) * vectors.shape[1]
    if most < EXACT:
        return queries @ vectors.T
    whole = np.vectorize(int, otypes=[object])
    return whole(queries) @ whole(vectors).T


def search_bucket(queries: np.ndarray, vectors: np.ndarray, k: int):
    """All of the k greatest products of each query, with ties; vectors are whole numbers held as doubles."""
    lengths = np.sqrt((vectors * vectors).sum(axis=1))
    order = np.argsort(-lengths, kind="stable")
    vectors, lengths = vectors[order], lengths[order]
    first = vectors[: max(FIRST, k)]
    scores = _products(queries, first)
    at = min(k, scores.shape[1])
    bound = -np.partition(-scores.astype(np.float64), at - 1, axis=1)[:, at - 1] if len(vectors) >= k else np.full(len(queries), -np.inf)
    if scores.dtype == object:  # products beyond 53 bits: the bound was rounded
        bound = bound - np.abs(bound) * 1e-12
    q, r = np.nonzero((scores >= bound[:, None]).astype(bool))
    found = [(q, r, scores[q, r])]
    rest, rest_lengths = vectors[len(first) :], lengths[len(first) :]
    if len(rest):
        own = np.sqrt((queries * queries).sum(axis=1))
        slack = 1e-9 * own * rest_lengths[0] + 1e-9  # rounding of the bounds
        threshold = bound / np.maximum(own * rest_lengths[0], 1e-300)
        squares = rest * rest
        for i in np.flatnonzero(threshold <= 1 + 1e-9):
            keep = int(np.searchsorted(-rest_lengths, -(bound[i] - slack[i]) / max(own[i], 1e-300), "right"))
            some = np.arange(keep)
            if threshold[i] >= COSINE:
                focus = np.argsort(-np.abs(queries[i]), kind="stable")[:FOCUS]
                partial = rest[:keep][:, focus] @ queries[i, focus]
                left = np.sqrt(np.maximum(rest_lengths[:keep] ** 2 - squares[:keep][:, focus].sum(axis=1), 0))
                mine = np.sqrt(max(own[i] ** 2 - (queries[i, focus] ** 2).sum(), 0))
                some = np.flatnonzero(partial + left * mine >= bound[i] - slack[i])
            if len(some):
                exact = _products(queries[i : i + 1], rest[some])[0]
                good = (exact >= bound[i]).astype(bool)
                found.append((np.full(good.sum(), i), some[good] + len(first), exact[good]))
    q, r, s = (np.concatenate(x) for x in zip(*found))
    # the k best of each query; ties to the row that comes first
    place = np.array(sorted(range(len(s)), key=lambda i: (q[i], -s[i], order[r[i]])), np.int64)
    rank = np.arange(len(place)) - np.searchsorted(q[place], q[place])
    place = place[rank < k]
    return q[place], order[r[place]], np.array([int(x) for x in s[place]], dtype=object)


def best_products(vectors: DataFrame, asked: Column, k: int = 5, scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score) of vectors (vec_id, embedding): the k greatest products of each asked row.

    A component x counts as floor(scale * x). Ties go to the smaller vec_id. Null vectors and those with null or
    non-finite components take no part, nor do null ids; zero vectors do. Only vectors of the same length are compared.
    Rows that repeat a vec_id are each a candidate of other ids. Scores beyond 64 bits are an error.
    """
    vector = F.transform(F.col("embedding").cast("array<double>"), lambda x: F.floor(x * scale).cast("double"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(
        F.col("vec_id").isNotNull() & usable("embedding")).select("vec_id", vector.alias("vector"))
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
    bucket = F.when(length > 0, F.floor(F.log2(length) * PER_DOUBLING)).otherwise(F.lit(-1 << 20)).cast("int")
    rows = settled(rows.withColumn("bucket", bucket), "integers")
    sizes = rows.groupBy("bucket").agg(F.ceil(F.count("*") / SHARD_ROWS).cast("int").alias("parts"))
    before = F.coalesce(F.sum("parts").over(W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    sizes = settled(sizes.withColumn("before", before.cast("int")), "buckets")
    n_shards = sizes.agg(F.sum("parts")).first()[0] or 1
    shard = F.col("before") + F.pmod(F.xxhash64("vec_id", "vector"), F.col("parts")).cast("int")
    rows = rows.join(F.broadcast(sizes), "bucket").select("vec_id", "vector", shard.alias("shard"))
    return top_k(rows, asked, int(n_shards), search_bucket, k, "long")
