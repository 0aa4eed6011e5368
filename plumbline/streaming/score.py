"""Scoring new rows as they arrive, with a fitted recipe and model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Transformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.transforms import carry_columns, restore_columns
from ..sources.sinks import prediction_table


def score_rows(rows: DataFrame, model: Transformer, id_cols: Sequence[str], label: str | None = None) -> DataFrame:
    """Scores of a batch or a stream: fitted stages are projections and stream-static joins, so either passes through.

    A recipe fills a missing target like any column; the target as it arrived is carried past it, so that rows without
    one have no actual price and no error.
    """
    if label is None or label not in rows.columns:
        return prediction_table(model.transform(rows), id_cols)
    return prediction_table(restore_columns(model.transform(carry_columns(rows, [label]))), id_cols, label)


def score_files(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    model: Transformer,
    sink: str,
    checkpoint: str,
    id_cols: Sequence[str],
    label: str | None = None,
    max_files: int | None = None,
) -> StreamingQuery:
    """Scores every Parquet file not scored yet, then stops; the checkpoint makes it exactly once."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    scored = score_rows(reader.parquet(source), model, id_cols, label)
    return (
        scored.writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
