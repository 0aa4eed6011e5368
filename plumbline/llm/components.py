"""Connected components of a graph given as edges, by rounds of star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settled


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Hangs each node's larger (or smaller) neighbours on the smallest node it sees.

    The smallest is a partial aggregate and the neighbours meet it in a join, so a node
    with very many neighbours is never gathered in one task.
    """
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    joined = both.join(least, "a")
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", F.col("m").alias("b"))
        )
    return out.where("a <> b").distinct()


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Edges (a, b) of longs to (node, component): the smallest node reachable.

    Null ends and loops are ignored; no edges give no rows. Rounds grow with the logarithm of a
    component's size, and each is written to the shared folder.
    """
    now = settled(edges.where("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    mark = None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == mark or seen[0] == 0:
            break
        mark = seen
        now = settled(_stars(_stars(now, True), False), name)
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component"))
    ).distinct()
