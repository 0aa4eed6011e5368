"""Joins against fitted tables: broadcast behind a size check, skew-safe beyond it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .columns import col

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 * 1024 * 1024
MAP_VALUES = 64  # of one feature that are part of an expression rather than of a join


@dataclass
class Lookup:
    """A keyed table with a measured size; ``weight`` counts the fitted rows per key."""

    table: DataFrame
    small: bool
    weight: str | None = None


def _row_bytes(df: DataFrame) -> Column:
    """About how long a row is: texts as they are, nested values as JSON, 16 bytes for anything else."""
    size = F.lit(16 * len(df.columns)).cast("long")
    for f in df.schema:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(col(f.name)), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(col(f.name)))), F.lit(0))
    return size


def settle(df: DataFrame, weight: str | None = None) -> Lookup:
    """Computes ``df`` once: held as a local relation when small, checkpointed otherwise."""
    once = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # measured before anything is collected
        rows, size = once.agg(F.count(F.lit(1)), F.coalesce(F.sum(_row_bytes(once)), F.lit(0))).first()
        if rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES:
            return Lookup(df.sparkSession.createDataFrame(once.toArrow(), schema=df.schema), True, weight)
        return Lookup(cut_lineage(once), False, weight)
    finally:
        once.unpersist()


def literal_map(values: dict) -> Column:
    """A small dict as a map column."""
    items = []
    for key, value in values.items():
        items += [F.lit(key), F.lit(value)]
    return F.create_map(*items)


def small_maps(lookup: Lookup, key: Column, value: str) -> dict[str, dict]:
    """Values by key of every feature that has few of them, from a small table (feature, ...); these need no join."""
    if not lookup.small:
        return {}
    table = lookup.table.select("feature", key.alias("key"), F.col(value).alias("value")).toArrow()
    maps: dict[str, dict] = {}
    for feature, k, v in zip(*(c.to_pylist() for c in table.columns)):
        maps.setdefault(feature, {})[k] = v
    return {f: {k: v for k, v in m.items() if v is not None} for f, m in maps.items() if len(m) <= MAP_VALUES}


def mapped(values: dict, key: Column, fallback: Column) -> Column:
    return F.coalesce(F.try_element_at(literal_map(values), key), fallback) if values else fallback


def _hot_rows(lookup: Lookup) -> DataFrame:
    """Keys holding more than one average partition of rows: at most one per partition."""
    table = lookup.table
    parts = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = table.agg(F.sum(lookup.weight)).first()[0] or 0
    return table.filter(F.col(lookup.weight) > total / parts)


def lookup_join(
    left: DataFrame, lookup: Lookup, on: list[str], values: list[str], spread_by: list[str]
) -> DataFrame:
    """Left join of a table unique on ``on``; adds ``values``, NULL where unmatched.

    A small table is broadcast. Otherwise only the hot keys are: their count is
    bounded by the number of partitions because each holds more than an average
    partition. Hot and NULL-keyed rows then carry a random second key, so the
    shuffle spreads them, while the other rows meet the full table.
    """
    keys = [col(c) for c in on]
    if lookup.small:
        return left.join(F.broadcast(lookup.table.select(*keys, *[col(v) for v in values])), on, "left")
    if lookup.weight is None:
        return left.join(lookup.table.select(*keys, *[col(v) for v in values]), on, "left")
    pack = F.struct(*[col(v) for v in values])
    hot = F.broadcast(_hot_rows(lookup).select(*keys, pack.alias("_hot")))
    cold = lookup.table.select(*keys, F.lit(0).alias("_spread"), pack.alias("_cold"))
    unkeyed = F.col("_hot").isNotNull()
    for k in keys:
        unkeyed = unkeyed | k.isNull()
    spread = 1 + F.pmod(F.hash(*[col(c) for c in spread_by]), F.lit(1 << 20))
    joined = (
        left.join(hot, on, "left")
        .withColumn("_spread", F.when(unkeyed, spread).otherwise(F.lit(0)))
        .join(cold, [*on, "_spread"], "left")
    )
    found = [F.coalesce(F.col("_hot")[v], F.col("_cold")[v]).alias(v) for v in values]
    return joined.select(*[col(c) for c in left.columns], *found)
