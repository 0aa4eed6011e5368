"""Result sinks."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import as_double, col


def write_delimited(df: DataFrame, path: str, sep: str = ",") -> str:
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)
    return path


def write_parquet(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path


def prediction_table(
    scored: DataFrame, id_cols: Sequence[str], label: str | None = None, prediction: str = "prediction"
) -> DataFrame:
    """id, actual_price, predicted_price, error = predicted - actual; no actuals without a label."""
    p = as_double(scored, prediction)
    keys = [col(c) for c in id_cols]
    if label is None or label not in scored.columns:
        return scored.select(*keys, p.alias("predicted_price"))
    y = as_double(scored, label)
    return scored.select(
        *keys, y.alias("actual_price"), p.alias("predicted_price"), (p - y).alias("error")
    )


def write_predictions(scored: DataFrame, path: str, id_cols: Sequence[str], label: str | None = None) -> str:
    return write_delimited(prediction_table(scored, id_cols, label), path)


def write_json(df: DataFrame, path: str) -> str:
    """Report rows as JSON lines; structs stay nested."""
    df.write.mode("overwrite").json(path)
    return path


def write_best_params(spark: SparkSession, best: dict, path: str) -> str:
    """One JSON document; ``{}`` before any search."""
    text = spark.createDataFrame([(json.dumps(best, sort_keys=True),)], "value string")
    text.coalesce(1).write.mode("overwrite").text(path)
    return path


def read_best_params(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).agg(F.max("value")).first()[0])
