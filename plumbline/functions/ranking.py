"""Global positions without a window over the whole table."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

# monotonically_increasing_id keeps the partition above this bit
_ROW_BITS = 33


def global_rank(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """Adds the 0-based position of every row in the total order ``order``.

    One range-partitioned sort. The sorted rows are checkpointed, so the positions
    cannot change when a lost partition is computed again, and each partition's
    offset is added from a table with one row per sort partition.
    """
    slots = cut_lineage(df.orderBy(*order).withColumn("_slot", F.monotonically_increasing_id()))
    part = F.shiftright("_slot", _ROW_BITS).cast("int")
    sizes = slots.groupBy(part.alias("_part")).count().toArrow().sort_by("_part")
    offsets, total = [], 0
    for n in sizes.column("count").to_pylist():
        offsets.append(total)
        total += n
    table = pa.table({"_part": sizes.column("_part"), "_offset": pa.array(offsets, pa.int64())})
    within = F.col("_slot") - F.shiftleft(F.col("_part").cast("long"), _ROW_BITS)
    return (
        slots.withColumn("_part", part)
        .join(F.broadcast(df.sparkSession.createDataFrame(table)), "_part")
        .withColumn(name, F.col("_offset") + within)
        .drop("_slot", "_part", "_offset")
    )
