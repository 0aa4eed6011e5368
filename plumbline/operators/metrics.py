"""Regression metrics, reports, prediction intervals and cross-validated error."""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from statistics import NormalDist

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FIT, QUALITY
from ..functions.columns import as_double, col
from ..functions.order_stats import exact_quantiles

METRICS = ["RMSE", "MAE", "R2", "MAPE", "Max_Error"]


def metric_columns(df: DataFrame, label: str, prediction: str) -> list[Column]:
    y, p = as_double(df, label), as_double(df, prediction)
    e = y - p
    sse = F.sum(e * e)
    sst = F.var_pop(y) * F.count(y)
    r2 = F.when(sst > 0, 1 - sse / sst).when(sse == 0, 1.0).otherwise(0.0)
    share = F.avg(F.when(y != 0, F.abs(e / y)))
    return [
        F.sqrt(F.avg(e * e)).alias("RMSE"),
        F.avg(F.abs(e)).alias("MAE"),
        r2.alias("R2"),
        F.coalesce(share * 100, F.lit(float("nan"))).alias("MAPE"),
        F.max(F.abs(e)).alias("Max_Error"),
    ]


def regression_metrics(
    df: DataFrame, label: str, prediction: str = "prediction", by: list[str] | None = None
) -> DataFrame:
    """All five metrics in one aggregation, per group when ``by`` is given."""
    exprs = metric_columns(df, label, prediction)
    return df.groupBy(*[col(c) for c in by]).agg(*exprs) if by else df.agg(*exprs)


def performance_report(
    df: DataFrame, label: str, prediction: str = "prediction", split: str = "split", model_name: str = "model"
) -> DataFrame:
    """One row: model name, train and test metric structs, R2 gap and overfit verdict."""
    metrics = F.struct(*METRICS)
    sets = regression_metrics(df, label, prediction, [split])
    row = sets.agg(
        F.any_value(F.when(col(split) == "train", metrics), True).alias("train_metrics"),
        F.any_value(F.when(col(split) == "test", metrics), True).alias("test_metrics"),
    )
    gap = F.col("train_metrics.R2") - F.col("test_metrics.R2")
    return row.select(
        F.lit(model_name).alias("model_name"),
        "train_metrics",
        "test_metrics",
        gap.alias("r2_gap"),
        (gap > QUALITY.overfit_gap).alias("overfit"),
    )


def meets_targets(metrics: DataFrame) -> DataFrame:
    return metrics.withColumn("meets_targets", (F.col("R2") > QUALITY.r2) & (F.col("RMSE") < QUALITY.rmse))


def prediction_intervals(
    df: DataFrame,
    residuals: DataFrame,
    prediction: str = "prediction",
    residual: str = "residual",
    confidence: float = 0.95,
    method: str = "normal",
) -> DataFrame:
    """Adds ``lower`` and ``upper``: one band for all rows from the spread of ``residuals``."""
    if not 0 < confidence < 1:
        raise ValueError(f"confidence must be in (0, 1), got {confidence}")
    p = as_double(df, prediction)
    if method == "normal":
        z = NormalDist().inv_cdf((1 + confidence) / 2)
        margin = residuals.select(F.stddev_pop(as_double(residuals, residual)) * z).scalar()
        low, high = p - margin, p + margin
    elif method == "empirical":
        tail = (1 - confidence) / 2
        cuts = exact_quantiles(residuals, {"r": as_double(residuals, residual)}, [tail, 1 - tail])["r"]
        low, high = p + F.lit(cuts[0]), p + F.lit(cuts[1])
    else:
        raise ValueError(f"method must be 'normal' or 'empirical', got {method!r}")
    return df.withColumns({"lower": low, "upper": high})


def minmax_normalize(df: DataFrame, column: str, name: str) -> DataFrame:
    """Scales to [0, 1]; a flat column becomes 0."""
    span = df.select(F.struct(F.min(col(column)).alias("low"), F.max(col(column)).alias("high"))).scalar()
    width = span["high"] - span["low"]
    return df.withColumn(name, F.when(width == 0, 0.0).otherwise((col(column) - span["low"]) / width))


def run_together(tasks: list, parallelism: int = FIT.parallelism) -> list:
    """Runs driver-side closures that submit Spark jobs, a few at a time, in order."""
    if len(tasks) == 1 or parallelism <= 1:
        return [t() for t in tasks]
    with ThreadPoolExecutor(parallelism) as pool:
        inherit = inheritable_thread_target(SparkSession.active())
        return [f.result() for f in [pool.submit(inherit(t)) for t in tasks]]


def held_out_predictions(
    df: DataFrame, estimator, fold: str = "fold", folds: int | None = None, parallelism: int = FIT.parallelism
) -> DataFrame:
    """Each row scored by a model fitted on the other folds; a union, no join."""
    folds = folds or FIT.folds

    def task(f):
        model = estimator.fit(df.filter(col(fold) != f))
        return model.transform(df.filter(col(fold) == f))

    parts = run_together([lambda f=f: task(f) for f in range(folds)], parallelism)
    return reduce(DataFrame.unionByName, parts)


def fold_errors(df: DataFrame, label: str, prediction: str = "prediction", fold: str = "fold") -> DataFrame:
    """(fold, mse, rmse)."""
    e = as_double(df, label) - as_double(df, prediction)
    return df.groupBy(col(fold).alias("fold")).agg(F.avg(e * e).alias("mse")).withColumn("rmse", F.sqrt("mse"))


def cv_summary(errors: DataFrame) -> DataFrame:
    """Mean of fold roots and its spread, beside the root of the mean fold error."""
    return errors.agg(
        F.avg("rmse").alias("rmse_mean"),
        F.stddev_pop("rmse").alias("rmse_std"),
        F.sqrt(F.avg("mse")).alias("rmse_of_mean"),
    )


def search_objective(df: DataFrame, estimator, label: str, fold: str, folds: int, parallelism: int) -> float:
    """Root of the mean fold error, the value a search minimises."""
    scored = held_out_predictions(df, estimator, fold, folds, parallelism)
    value = cv_summary(fold_errors(scored, label, fold=fold)).first()["rmse_of_mean"]
    return math.inf if value is None else float(value)
