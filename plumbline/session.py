"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# AQE coalesces, splits skewed partitions and turns small sides into broadcasts
# at run time; the rest keeps oracle comparisons stable.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName("plumbline")
    if master is not None:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder named by the session; a temporary one only in local mode."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the executors")
        named = tempfile.mkdtemp(prefix="plumbline-checkpoint-")
    context.setCheckpointDir(named)
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result is in shared storage and outlives executors."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """The rows as Parquet in the checkpoint folder, for tables that are read often, and by few of their columns.

    A fraction of a checkpoint's size; shuffles that made the rows are let go of. Names are kept apart from the files, where
    they need not differ by more than case. What Parquet does not hold is checkpointed.
    """
    spark = df.sparkSession
    if not df.columns or re.search(r"\b(void|interval)\b|struct<>", df.schema.simpleString()):
        return cut_lineage(df)
    path = f"{checkpoint_folder(spark).rstrip('/')}/stored-{uuid.uuid4().hex}"
    names = [f"c{i}" for i in range(len(df.columns))]
    df.toDF(*names).write.parquet(path)
    spark.sparkContext._jvm.System.gc()  # shuffle files go when the driver's references to them do
    held = spark.read.schema(T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, df.schema)])).parquet(path)
    return held.select(*[F.col(n).alias(f.name, metadata=f.metadata) for n, f in zip(names, df.schema)])
