"""Local linear surrogates around single rows."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.ml import Transformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import FIT, LIME, default
from ..functions.columns import as_double, col, id_hash
from ..functions.lookups import settle
from ..functions.numeric import (
    CENTRAL_DEN,
    CENTRAL_NUM,
    FAR_DEN,
    FAR_NUM,
    NEAR_DEN,
    NEAR_NUM,
    polynomial,
)
from ..functions.order_stats import exact_quantiles
from .splits import sample_n

CHUNK = 1000
DRAWN_CHUNKS = 8  # handed on together
# Spread floor, selection and surrogate penalties, greedy selection limit, kernel width
SPREAD_FLOOR = 1e-11
SELECTION_PENALTY = 0.01
SURROGATE_PENALTY = 1.0
GREEDY_FEATURES = 6
KERNEL_WIDTH = 0.75


def bin_profile(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, bin, edges, n, mean, spread, low, high): quartile bins of every feature.

    Bins are right-closed between the distinct quartiles. All features are profiled in
    one partially aggregated pass after the quartiles are known.
    """
    quartiles = exact_quantiles(df, {f: as_double(df, f) for f in features}, [0.25, 0.5, 0.75])
    cells = []
    for f in features:
        edges = sorted({q for q in quartiles[f] if q is not None})
        cells.append(
            F.struct(
                F.lit(f).alias("feature"),
                as_double(df, f).alias("x"),
                F.array(*[F.lit(e) for e in edges]).cast("array<double>").alias("edges"),
            )
        )
    x = F.col("x")
    return (
        df.select(F.inline(F.array(*cells)))
        .filter(x.isNotNull())
        .withColumn("bin", F.size(F.filter("edges", lambda e: e < F.col("x"))))
        .groupBy("feature", "bin", "edges")
        .agg(
            F.count(x).alias("n"),
            F.avg(x).alias("mean"),
            F.stddev_pop(x).alias("spread"),
            F.min(x).alias("low"),
            F.max(x).alias("high"),
        )
    )


@dataclass
class BinModel:
    """The profile as dense arrays: features x bins."""

    features: list[str]
    edges: list[np.ndarray]
    share: np.ndarray
    mean: np.ndarray
    spread: np.ndarray
    low: np.ndarray
    high: np.ndarray
    low_p: np.ndarray
    high_p: np.ndarray

    @classmethod
    def from_profile(cls, profile: DataFrame, features: Sequence[str]) -> "BinModel":
        rows = {}
        for r in profile.collect():
            rows.setdefault(r["feature"], []).append(r)
        shape = (len(features), 4)
        share, mean, low_p, high_p = (np.zeros(shape) for _ in range(4))
        spread = np.full(shape, SPREAD_FLOOR)
        low, high, edges = np.zeros(shape), np.zeros(shape), []
        for j, f in enumerate(features):
            found = rows[f]
            cut = np.array(found[0]["edges"])
            edges.append(cut)
            total = sum(r["n"] for r in found)
            lowest, highest = min(r["low"] for r in found), max(r["high"] for r in found)
            for b in range(len(cut) + 1):
                low[j, b] = lowest if b == 0 else cut[b - 1]
                high[j, b] = highest if b == len(cut) else cut[b]
            for r in found:
                b = r["bin"]
                share[j, b], mean[j, b] = r["n"] / total, r["mean"]
                spread[j, b] = r["spread"] + SPREAD_FLOOR
            for b in range(len(cut) + 1):
                z = NormalDist(mean[j, b], spread[j, b])
                low_p[j, b], high_p[j, b] = z.cdf(low[j, b]), z.cdf(high[j, b])
        return cls(list(features), edges, share, mean, spread, low, high, low_p, high_p)

    def bins_of(self, x: np.ndarray) -> np.ndarray:
        return np.array([np.searchsorted(e, v) for e, v in zip(self.edges, x)])

    def label(self, j: int, b: int) -> str:
        name, cut = self.features[j], self.edges[j]
        if b == 0:
            return f"{name} <= {cut[0]:.2f}"
        if b == len(cut):
            return f"{name} > {cut[-1]:.2f}"
        return f"{cut[b - 1]:.2f} < {name} <= {cut[b]:.2f}"


def _quantile(p: np.ndarray) -> np.ndarray:
    """Inverse normal distribution of an array, from the same coefficients as the Column form."""
    q = p - 0.5
    c = 0.180625 - q * q
    r = np.sqrt(-np.log(np.minimum(p, 1 - p)))
    central = q * polynomial(CENTRAL_NUM, c) / polynomial(CENTRAL_DEN, c)
    near = polynomial(NEAR_NUM, r - 1.6) / polynomial(NEAR_DEN, r - 1.6)
    far = polynomial(FAR_NUM, r - 5.0) / polynomial(FAR_DEN, r - 5.0)
    return np.where(np.abs(q) <= 0.425, central, np.sign(q) * np.where(r <= 5.0, near, far))


def perturb(bins: BinModel, x: np.ndarray, n: int, rng) -> tuple[np.ndarray, np.ndarray]:
    """(same-bin indicators, perturbed rows): a bin by its share, then a truncated normal inside it."""
    m = len(bins.features)
    cumulative = np.cumsum(bins.share, axis=1)
    cumulative[:, -1] = 1.0
    drawn = (rng.random((n, m))[:, :, None] > cumulative[None]).sum(axis=2)
    j = np.arange(m)
    a, z = bins.low_p[j, drawn], bins.high_p[j, drawn]
    p = np.clip(a + rng.random((n, m)) * (z - a), 1e-16, 1 - 1e-16)
    rows = bins.mean[j, drawn] + bins.spread[j, drawn] * _quantile(p)
    rows = np.clip(rows, bins.low[j, drawn], bins.high[j, drawn])
    return (drawn == bins.bins_of(x)).astype(float), rows


def _ridge(gram: np.ndarray, target: np.ndarray, keep: list[int], penalty: float) -> np.ndarray:
    sub = gram[np.ix_(keep, keep)] + penalty * np.eye(len(keep))
    return np.linalg.lstsq(sub, target[keep], rcond=None)[0]


def _select(gram: np.ndarray, target: np.ndarray, count: int) -> list[int]:
    """Features of the surrogate: greedy for few, by penalised weight for many."""
    m = len(target)
    if count > GREEDY_FEATURES:
        w = _ridge(gram, target, list(range(m)), SELECTION_PENALTY)
        return sorted(range(m), key=lambda j: (-abs(w[j]), j))[:count]
    kept: list[int] = []
    while len(kept) < min(count, m):
        gains = []
        for j in range(m):
            if j not in kept:
                trial = [*kept, j]
                w = _ridge(gram, target, trial, 0.0)
                gains.append((2 * w @ target[trial] - w @ gram[np.ix_(trial, trial)] @ w, -j))
        kept.append(-max(gains)[1])
    return kept


def surrogate(z: np.ndarray, y: np.ndarray, count: int) -> tuple[list[int], np.ndarray, float, float, float]:
    """(features, weights, intercept, local prediction, R2) of the weighted ridge fit."""
    m = z.shape[1]
    distance2 = (1 - z).sum(axis=1)
    w = np.sqrt(np.exp(-distance2 / (KERNEL_WIDTH**2 * m)))
    w_sum = w.sum()
    z_mean, y_mean = w @ z / w_sum, w @ y / w_sum
    zc, yc = z - z_mean, y - y_mean
    gram, target = (zc.T * w) @ zc, (zc.T * w) @ yc
    kept = _select(gram, target, count)
    beta = _ridge(gram, target, kept, SURROGATE_PENALTY)
    intercept = float(y_mean - z_mean[kept] @ beta)
    total = float(w @ (yc * yc))
    rest = yc - zc[:, kept] @ beta
    r2 = 1 - float(w @ (rest * rest)) / total if total > 0 else 0.0
    return kept, beta, intercept, float(intercept + beta.sum()), r2


def lime_explain(
    model: Transformer,
    instances: DataFrame,
    profile: DataFrame,
    features: Sequence[str],
    id_cols: Sequence[str],
    num_features: int | None = None,
    num_samples: int | None = None,
    seed: int | None = None,
    prediction: str = "prediction",
) -> DataFrame:
    """(id, rank, feature, bin_label, weight, intercept, local_prediction, r2, prediction).

    All instances are explained in one job. Perturbations are drawn on executors from
    a generator seeded by (seed, row id, chunk), so they do not depend on
    partitioning. The model scores them in one ``transform``. Each instance's
    surrogate sees exactly ``num_samples`` rows.
    """
    count, samples = default(num_features, LIME.num_features), default(num_samples, LIME.num_samples)
    seed = default(seed, FIT.seed)
    spark = instances.sparkSession
    bins = BinModel.from_profile(profile, features)  # a few numbers per feature, shipped with the task
    chunks = math.ceil(samples / CHUNK)
    keys = [instances.schema[c] for c in id_cols]
    names = list(id_cols)

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for start in range(0, len(pdf), DRAWN_CHUNKS):
                part = pdf.iloc[start : start + DRAWN_CHUNKS]
                chunk = part["_chunk"].to_numpy()
                sizes = np.minimum(CHUNK, samples - chunk * CHUNK)
                drawn = [
                    perturb(bins, np.asarray(x, dtype=float), int(n),
                            np.random.default_rng([seed & 0xFFFFFFFF, int(h) & (2**63 - 1), int(k)]))
                    for x, h, k, n in zip(part["_x"], part["_h"], chunk, sizes)
                ]
                z, rows = (np.concatenate(arrays) for arrays in zip(*drawn))
                first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                own = first[chunk == 0]  # the first draw of an instance is the instance
                z[own] = 1.0
                rows[own] = np.array(part["_x"][chunk == 0].tolist(), dtype=float).reshape(len(own), z.shape[1])
                out = part[names].loc[part.index.repeat(sizes)].reset_index(drop=True)
                place = np.arange(sizes.sum()) - np.repeat(first, sizes)
                out["_sample"] = place + np.repeat(chunk * CHUNK, sizes)
                out["_z"], out["_row"] = list(z), list(rows)
                yield out

    array = T.ArrayType(T.DoubleType())
    drawn_schema = T.StructType(
        [*keys, T.StructField("_sample", T.LongType()), T.StructField("_z", array), T.StructField("_row", array)]
    )
    rows = instances.select(
        *[col(c) for c in names],
        F.array(*[as_double(instances, f) for f in features]).alias("_x"),
        id_hash(id_cols, seed).alias("_h"),
        F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("_chunk"),
    ).repartition(spark.sparkContext.defaultParallelism)
    drawn = rows.mapInPandas(draw, drawn_schema)
    scored = model.transform(
        drawn.select(
            *[col(c) for c in names], "_sample", "_z", F.when(F.col("_sample") == 0, F.col("_row")).alias("_x"),
            *[F.col("_row")[j].alias(f) for j, f in enumerate(features)],
        )
    ).select(*[col(c) for c in names], "_sample", "_x", "_z", col(prediction).cast("double").alias("_y"))

    def explain(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_sample")
        z, y = np.array(pdf["_z"].tolist()), pdf["_y"].to_numpy()
        kept, beta, intercept, local, r2 = surrogate(z, y, count)
        here = bins.bins_of(np.array(pdf["_x"].iloc[0], dtype=float))
        placed = sorted(range(len(kept)), key=lambda i: (-abs(beta[i]), kept[i]))
        out = pd.DataFrame(
            {
                "rank": range(1, len(kept) + 1),
                "feature": [bins.features[kept[i]] for i in placed],
                "bin_label": [bins.label(kept[i], here[kept[i]]) for i in placed],
                "weight": [float(beta[i]) for i in placed],
                "intercept": intercept,
                "local_prediction": local,
                "r2": r2,
                "prediction": float(y[0]),
            }
        )
        for i, c in enumerate(names):
            out.insert(i, c, [pdf[c].iloc[0]] * len(out))
        return out

    doubles = ["weight", "intercept", "local_prediction", "r2", "prediction"]
    schema = T.StructType(
        [*keys, T.StructField("rank", T.IntegerType()), T.StructField("feature", T.StringType()),
         T.StructField("bin_label", T.StringType()), *[T.StructField(c, T.DoubleType()) for c in doubles]]
    )
    return scored.groupBy(*[col(c) for c in names]).applyInPandas(explain, schema)


def explain_first(
    model: Transformer, df: DataFrame, profile: DataFrame, features: Sequence[str], id_cols: Sequence[str],
    label: str | None = None, n: int = 5, **options,
) -> DataFrame:
    """Explanations of the first ``n`` rows in id order, with the actual value when known."""
    first = settle(sample_n(df, n, id_cols, order=[col(c) for c in id_cols])).table
    out = lime_explain(model, first, profile, features, id_cols, **options)
    if label is None:
        return out
    actual = first.select(*[col(c) for c in id_cols], as_double(first, label).alias("actual"))
    return out.join(F.broadcast(actual), list(id_cols))  # n rows


def compare_predictions(
    model: Transformer, df: DataFrame, id_cols: Sequence[str], label: str | None = None, prediction: str = "prediction"
) -> DataFrame:
    """(id, Prediction[, Actual, Error]) with the absolute error."""
    scored = model.transform(df)
    p = as_double(scored, prediction)
    keys = [col(c) for c in id_cols]
    if label is None:
        return scored.select(*keys, p.alias("Prediction"))
    y = as_double(scored, label)
    return scored.select(*keys, p.alias("Prediction"), y.alias("Actual"), F.abs(p - y).alias("Error"))
