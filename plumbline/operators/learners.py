"""Base learners: Spark ML tree ensembles over named feature columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import FIT, LEARNERS
from ..functions.columns import col
from ..functions.lookups import settle
from .boosting import HistogramBoosting
from .metrics import regression_metrics, run_together

LEARNER_NAMES = ("gbt_a", "gbt_b", "rf")
_KINDS = {"gbt_a": GBTRegressor, "gbt_b": GBTRegressor, "rf": RandomForestRegressor}


def assembler(features: Sequence[str], output: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=output)


def base_learner(
    name: str, label: str, params: dict | None = None, features_col: str = "features", prediction: str = "prediction"
) -> Estimator:
    """A learner with its defaults, any of which ``params`` replaces.

    Parameters of ``BoostParams`` make the boosted learners grow with penalties and a leaf budget instead of as Spark's trees.
    """
    if name != "rf" and {"n_estimators", "learning_rate"} & set(params or {}):
        return HistogramBoosting(None, label, params=params, vector=features_col, prediction=prediction)
    settings = {**getattr(LEARNERS, name), **(params or {})}
    return _KINDS[name](featuresCol=features_col, labelCol=label, predictionCol=prediction, **settings)


def base_learners(label: str, params: dict[str, dict] | None = None) -> list[tuple[str, Estimator]]:
    """Ordered (name, learner) pairs; ``params`` is keyed by learner name."""
    unknown = set(params or {}) - set(LEARNER_NAMES)
    if unknown:
        raise ValueError(f"unknown learner(s) {sorted(unknown)}; use {LEARNER_NAMES}")
    return [(n, base_learner(n, label, (params or {}).get(n))) for n in LEARNER_NAMES]


class ColumnRegressor(Estimator):
    """Fits any Spark ML regressor on named columns; the model reads the same columns.

    The fitted ``PipelineModel`` turns feature columns into a ``prediction`` column,
    the form every explainer here accepts.
    """

    def __init__(self, regressor: Estimator, features: Sequence[str], persist: bool = False):
        super().__init__()
        self.regressor = regressor
        self.features = list(features)
        self.persist = persist  # for inputs with joins or shuffles above them: fits read rows more than once

    def _fit(self, df: DataFrame) -> PipelineModel:
        vectors = assembler(self.features)
        rows = vectors.transform(df).select("features", col(self.regressor.getLabelCol()))
        if not self.persist:
            return PipelineModel([vectors, self.regressor.fit(rows)])
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            return PipelineModel([vectors, self.regressor.fit(rows)])
        finally:
            rows.unpersist()


def linear_regressor(features: Sequence[str], label: str, persist: bool = False) -> ColumnRegressor:
    """Least squares by the normal equations, from tree-aggregated moments."""
    return ColumnRegressor(LinearRegression(labelCol=label, solver="normal"), features, persist)


def evaluate_learners(
    train: DataFrame,
    test: DataFrame,
    learners: Sequence[tuple[str, Estimator]],
    features: Sequence[str],
    label: str,
    parallelism: int = FIT.parallelism,
) -> DataFrame:
    """(model, train_rmse, test_rmse, train_r2, test_r2), one row per learner."""
    kept = [col(c) for c in [*features, label]]
    both = train.select(*kept, F.lit("train").alias("_set")).unionByName(
        test.select(*kept, F.lit("test").alias("_set"))
    )
    both = both.persist(StorageLevel.MEMORY_AND_DISK)

    def task(name, learner):
        model = ColumnRegressor(learner, features).fit(both.filter("_set = 'train'"))
        sets = regression_metrics(model.transform(both), label, by=["_set"])
        return sets.agg(
            *[
                F.max(F.when(F.col("_set") == s, F.col(m))).alias(f"{s}_{m.lower()}")
                for m in ("RMSE", "R2")
                for s in ("train", "test")
            ]
        ).select(F.lit(name).alias("model"), "*")

    try:
        tables = run_together([lambda n=n, e=e: task(n, e) for n, e in learners], parallelism)
        out = tables[0]
        for table in tables[1:]:
            out = out.unionByName(table)
        return settle(out).table
    finally:
        both.unpersist()
