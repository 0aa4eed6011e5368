"""Residual columns, summaries, curve tables and assumption tests."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import QUALITY
from ..functions.columns import as_double, col
from ..functions.lookups import settle
from ..functions.numeric import normal_density, normal_quantile, with_intervals
from ..functions.order_stats import DIRECT_ROWS, Intervals, exact_quantiles
from ..functions.ranking import global_rank
from ..functions.tails import chi2_sf, f_sf, normal_sf
from .splits import sample_n

SHAPIRO_ROWS = 5000


def with_residual(df: DataFrame, label: str, prediction: str = "prediction", name: str = "residual") -> DataFrame:
    return df.withColumn(name, as_double(df, label) - as_double(df, prediction))


def standardized_residuals(
    df: DataFrame, residual: str = "residual", name: str = "std_residual"
) -> DataFrame:
    """Residual over its population spread; all zero when there is no spread."""
    spread = df.select(F.stddev_pop(col(residual))).scalar()
    return df.withColumn(name, F.when(spread == 0, 0.0).otherwise(col(residual) / spread))


def residual_summary(df: DataFrame, residual: str = "residual") -> DataFrame:
    r = as_double(df, residual)
    return df.agg(
        F.avg(r).alias("mean_residual"),
        F.stddev_pop(r).alias("std_residual"),
        F.min(r).alias("min_residual"),
        F.max(r).alias("max_residual"),
        F.skewness(r).alias("skewness"),
        F.kurtosis(r).alias("kurtosis"),
    )


def residual_histogram(df: DataFrame, residual: str = "residual", bins: int = 50) -> DataFrame:
    """(bin, left, right, n, density) for every equal-width bin, empty ones included.

    Without spread all values fall into the first bin, whose width and the rest are 0 and its density NULL.
    """
    r = as_double(df, residual)
    span = df.select(
        F.struct(F.min(r).alias("low"), F.max(r).alias("high"), F.count(r).alias("n"))
    ).scalar()
    width = (span["high"] - span["low"]) / bins
    number = F.when(width == 0, 0).otherwise(F.least(F.floor(F.try_divide(r - span["low"], width)), F.lit(bins - 1)))
    counted = (
        df.filter(r.isNotNull())
        .select(number.cast("int").alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    frame = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    full = frame.join(counted, "bin", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return full.select(
        "bin",
        (span["low"] + F.col("bin") * width).alias("left"),
        (span["low"] + (F.col("bin") + 1) * width).alias("right"),
        "n",
        F.try_divide(F.col("n"), span["n"] * width).alias("density"),
    )


def normal_curve(df: DataFrame, residual: str = "residual", points: int = 100) -> DataFrame:
    """(point, x, density) of the fitted normal between the residual extremes."""
    r = as_double(df, residual)
    fit = df.select(
        F.struct(
            F.min(r).alias("low"), F.max(r).alias("high"), F.avg(r).alias("mean"), F.stddev_pop(r).alias("spread")
        )
    ).scalar()
    x = fit["low"] + F.col("point") * (fit["high"] - fit["low"]) / (points - 1)
    grid = df.sparkSession.range(points).select(F.col("id").cast("int").alias("point"))
    return grid.select("point", x.alias("x"), normal_density(x, fit["mean"], fit["spread"]).alias("density"))


def qq_table(df: DataFrame, id_cols: Sequence[str], residual: str = "residual") -> DataFrame:
    """(id, rank, ordered, theoretical, fitted): ordered residuals against normal quantiles.

    Plotting positions are the Filliben medians; the line is the least-squares fit.
    """
    rows = df.select(*[col(c) for c in id_cols], as_double(df, residual).alias("ordered"))
    ranked = global_rank(rows.filter("ordered IS NOT NULL"), [F.col("ordered"), *[col(c) for c in id_cols]])
    n = ranked.select(F.count(F.lit(1))).scalar()
    i = F.col("rank") + 1
    last = F.pow(F.lit(0.5), F.lit(1.0) / n)
    position = F.when(i == n, last).when(i == 1, 1 - last).otherwise((i - 0.3175) / (n + 0.365))
    placed = ranked.withColumn("position", position).withColumn("theoretical", normal_quantile(F.col("position")))
    line = placed.select(
        F.struct(
            F.regr_slope("ordered", "theoretical").alias("slope"),
            F.regr_intercept("ordered", "theoretical").alias("intercept"),
        )
    ).scalar()
    return placed.withColumn("fitted", line["intercept"] + line["slope"] * F.col("theoretical")).drop("position")


def scale_location(
    df: DataFrame, prediction: str = "prediction", residual: str = "residual", name: str = "sqrt_abs_std_residual"
) -> DataFrame:
    table = standardized_residuals(df, residual, "_std")
    return table.withColumn(name, F.sqrt(F.abs("_std"))).drop("_std")


# ---- LOWESS on a grid ---------------------------------------------------------


def lowess_anchors(df: DataFrame, x: str, frac: float, anchors: int) -> list[tuple]:
    """(anchor, x0, h): evenly spaced quantiles of x and the distance to the k-th neighbour.

    ``df`` is read several times and should be persisted.
    """
    value = as_double(df, x)
    shares = [i / (anchors - 1) for i in range(anchors)]
    n = df.agg(F.count(value)).first()[0]
    k = max(int(frac * n + 1e-10), 1)
    if n > DIRECT_ROWS:
        counted = Intervals(df.select(value.alias("x")).dropna(), "x")
        points = sorted(set(counted.quantiles(shares)))
        return [(i, p, h) for i, (p, h) in enumerate(zip(points, counted.kth_distances(points, k)))]
    points = sorted({q for q in exact_quantiles(df, {"x": value}, shares)["x"] if q is not None})
    if n:
        held = df.select(value.alias("x")).toArrow().column("x").to_numpy()
        return [(i, p, float(np.partition(np.abs(held - p), k - 1)[k - 1])) for i, p in enumerate(points)]
    return []


DEGREE = 9  # of tricube weights in the distance; local lines need two more


class _MicroBins:
    """Intervals of x between the ends and centres of all windows.

    Inside one interval every anchor's weight is one polynomial of x, so sums of powers by interval give the sums of
    every anchor, and a row is in one interval, however many windows hold it. Powers are of places in the interval,
    from -1 to 1. An anchor without width has an interval of its own point.
    """

    def __init__(self, grid: list[tuple], low: float, high: float):
        self.grid = grid
        self.flat = sorted({x0 for _, x0, h in grid if h == 0})
        self.cuts = sorted({c for _, x0, h in grid for c in (x0 - h, x0, x0 + h) if low < c < high})
        ends = [low, *self.cuts, high]
        self.middle = [(a + b) / 2 for a, b in zip(ends, ends[1:])] + self.flat
        self.half = [(b - a) / 2 or 1.0 for a, b in zip(ends, ends[1:])] + [1.0] * len(self.flat)

    def sums(self, rows: DataFrame) -> np.ndarray:
        """Sums of w t^p and w y t^p by interval, of rows (x, y, robust)."""
        x = F.col("x")
        rows = _numbered(rows, self.cuts, "bin")
        number = F.col("bin")
        for i, point in enumerate(self.flat):
            number = F.when(x == F.lit(point), len(self.cuts) + 1 + i).otherwise(number)
        place = rows.withColumn("bin", number).withColumn("t", (x - F.get(F.array(*map(F.lit, self.middle)), F.col("bin"))) / F.get(
            F.array(*map(F.lit, self.half)), F.col("bin")))
        powers, w = [], F.col("robust")
        for p in range(DEGREE + 3):
            powers.append(F.sum(w).alias(f"w{p}"))
            if p <= DEGREE + 1:
                powers.append(F.sum(w * F.col("y")).alias(f"y{p}"))
            w = w * F.col("t")
        out = np.zeros((len(self.middle), 2, DEGREE + 3))
        for r in place.groupBy("bin").agg(*powers).collect():
            out[r["bin"], 0] = [r[f"w{p}"] for p in range(DEGREE + 3)]
            out[r["bin"], 1, : DEGREE + 2] = [r[f"y{p}"] for p in range(DEGREE + 2)]
        return out

    def lines(self, sums: np.ndarray) -> list[float]:
        """The weighted straight line around each anchor, at the anchor."""
        return [self._level(x0, h, sums) for _, x0, h in self.grid]

    def _level(self, x0: float, h: float, sums: np.ndarray) -> float:
        total = np.zeros(5)  # w, w d, w d d, w y, w d y
        for (middle, half), own in zip(zip(self.middle, self.half), sums):
            if abs(middle - x0) > h or not own[0, 0]:
                continue
            d = np.array([middle - x0, half])
            u = d / h * (1 if middle >= x0 else -1) if h else np.zeros(1)
            cube = np.convolve(np.convolve(u, u), u)
            once = -cube
            once[0] += 1
            weight = np.convolve(np.convolve(once, once), once)
            for k, (moments, power) in enumerate(((own[0], 0), (own[0], 1), (own[0], 2), (own[1], 0), (own[1], 1))):
                poly = weight
                for _ in range(power):
                    poly = np.convolve(poly, d)
                total[k] += poly @ moments[: len(poly)]
        s0, s1, s2, t0, t1 = total
        det = s0 * s2 - s1 * s1
        if not s0:
            return math.nan
        return float(t0 / s0 if det <= 1e-12 * s0 * s2 else (s2 * t0 - s1 * t1) / det)


def lowess_grid(
    df: DataFrame,
    x: str,
    y: str,
    frac: float = 0.3,
    anchors: int = 50,
    iterations: int = 3,
) -> DataFrame:
    """(anchor, x0, smooth): tricube local lines on a grid, with bisquare re-weighting.

    A pass reduces every row to the sums of its interval between window ends, in one aggregate without fanning out.
    """
    points = df.select(as_double(df, x).alias("x"), as_double(df, y).alias("y")).dropna()
    points = points.persist(StorageLevel.MEMORY_AND_DISK)
    schema = "anchor int, x0 double, smooth double"
    try:
        low, high = points.agg(F.min("x"), F.max("x")).first()
        if low is None:
            return df.sparkSession.createDataFrame([], schema)
        grid = lowess_anchors(points, "x", frac, anchors)
        bins = _MicroBins(grid, low, high)
        smooth = bins.lines(bins.sums(points.withColumn("robust", F.lit(1.0))))
        for _ in range(iterations):
            knots = [(x0, v) for (_, x0, _), v in zip(grid, smooth)]
            scored = _interpolated(points, knots, "curve").withColumn("off", F.abs(F.col("y") - F.col("curve")))
            spread = exact_quantiles(scored, {"off": F.col("off")}, [0.5])["off"][0] or 0.0
            u = F.col("off") / F.lit(6 * spread if spread > 0 else math.inf)
            robust = F.when(u < 1, F.pow(1 - u * u, 2)).otherwise(0.0)
            smooth = bins.lines(bins.sums(scored.withColumn("robust", robust)))
    finally:
        points.unpersist()
    return df.sparkSession.createDataFrame([(i, float(x0), v) for (i, x0, _), v in zip(grid, smooth)], schema)


def _numbered(rows: DataFrame, cuts: Sequence[float], name: str) -> DataFrame:
    """Adds the number of the cuts below x."""
    found = with_intervals(rows, {name: (F.col("x"), cuts)}) if cuts else rows.withColumn(name, F.lit(0))
    return found.withColumn(name, F.col(name).cast("int"))


def _interpolated(rows: DataFrame, knots: list[tuple[float, float]], name: str) -> DataFrame:
    """Adds the piecewise-linear curve through the anchors, at x."""
    slopes = [(y1 - y0) / (x1 - x0) for (x0, y0), (x1, y1) in zip(knots, knots[1:])] + [0.0]
    placed = _numbered(rows, [x0 for x0, _ in knots[1:]], "_line")
    start, level, slope = (F.get(F.array(*map(F.lit, column)), F.col("_line")) for column in (*zip(*knots), slopes))
    return placed.withColumn(name, level + (F.col("x") - start) * slope).drop("_line")


# ---- tests --------------------------------------------------------------------


def moments(df: DataFrame, columns: Sequence[str]) -> tuple[int, np.ndarray, np.ndarray]:
    """(n, mean, covariance) of the columns: tree-aggregated in the JVM, k x k on the driver."""
    names = [f"c{i}" for i in range(len(columns))]
    narrow = df.select(*[as_double(df, c).alias(n) for c, n in zip(columns, names)]).dropna()
    vectors = VectorAssembler(inputCols=names, outputCol="v").transform(narrow).select("v")
    vectors = vectors.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        stats = vectors.select(Summarizer.metrics("count", "mean", "variance").summary(F.col("v")).alias("s")).first()["s"]
        spread = np.sqrt(np.asarray(stats["variance"].toArray(), dtype=float))
        matrix = np.nan_to_num(Correlation.corr(vectors, "v").first()[0].toArray())
    finally:
        vectors.unpersist()
    np.fill_diagonal(matrix, np.where(spread > 0, 1.0, 0.0))
    return int(stats["count"]), np.asarray(stats["mean"].toArray()), matrix * np.outer(spread, spread)


def regression_r2(covariance: np.ndarray, means: np.ndarray) -> tuple[float, int]:
    """R2 and rank of regressing the last column on the others, from their covariance."""
    spread = np.sqrt(np.diag(covariance))
    # a constant column keeps rounding noise in its variance: judge it by its mean
    used = [j for j in range(len(spread) - 1) if spread[j] > 1e-10 * max(1.0, abs(means[j]))]
    if not used or spread[-1] == 0:
        return 0.0, 0
    scale = spread[used]
    corr = covariance[np.ix_(used, used)] / np.outer(scale, scale)
    with_y = covariance[used, -1] / (scale * spread[-1])
    values, vectors = np.linalg.eigh(corr)
    kept = values > 1e-10 * values.max()
    projected = vectors[:, kept].T @ with_y
    return float(np.clip((projected**2 / values[kept]).sum(), 0.0, 1.0)), int(kept.sum())


def breusch_pagan(df: DataFrame, features: Sequence[str], residual: str = "residual") -> dict:
    """Regression of squared residuals on the features; constants never count twice.

    Degrees of freedom are the rank of the varying features, so a constant or
    duplicated column changes nothing.
    """
    squared = df.withColumn("_r2", as_double(df, residual) * as_double(df, residual))
    n, means, covariance = moments(squared, [*features, "_r2"])
    r2, rank = regression_r2(covariance, means)
    lm = n * r2
    rest = n - rank - 1
    f = (r2 / rank) / ((1 - r2) / rest) if rank and rest > 0 and r2 < 1 else math.inf if rank else 0.0
    p = chi2_sf(lm, rank) if rank else 1.0
    return {
        "lm_statistic": lm,
        "lm_pvalue": p,
        "f_statistic": f,
        "f_pvalue": f_sf(f, rank, rest) if rank and rest > 0 else 1.0,
        "df": rank,
        "n": n,
        "homoscedastic": p > QUALITY.p_value,
    }


# Royston (1995), AS R94, ascending coefficients.
WEIGHT_LAST = (0.0, 0.221157, -0.147981, -2.071190, 4.434685, -2.706056)
WEIGHT_NEXT = (0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633)
SMALL_GAMMA = (-2.273, 0.459)
SMALL_MEAN = (0.5440, -0.39978, 0.025054, -6.714e-4)
SMALL_SPREAD = (1.3822, -0.77857, 0.062767, -0.0020322)
LARGE_MEAN = (-1.5861, -0.31082, -0.083751, 0.0038915)
LARGE_SPREAD = (-0.4803, -0.082676, 0.0030302)


def _poly(coefficients, x: float) -> float:
    return sum(c * x**i for i, c in enumerate(coefficients))


def shapiro_wilk_statistic(
    df: DataFrame,
    id_cols: Sequence[str],
    residual: str = "residual",
    seed: int | None = None,
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """One row (n, statistic) over a seeded sample of at most 5000 rows, the test's domain."""
    rows = df.select(*[col(c) for c in id_cols], as_double(df, residual).alias("x")).filter("x IS NOT NULL")
    sample = sample_n(rows, SHAPIRO_ROWS, id_cols, seed, order)
    # the sample is bounded, so one ordered window may hold it
    ranked = sample.select(
        "x",
        F.row_number().over(Window.orderBy("x")).alias("i"),
        F.count(F.lit(1)).over(Window.partitionBy()).alias("n"),
    ).withColumn("m", normal_quantile((F.col("i") - 0.375) / (F.col("n") + 0.25)))
    scores = F.collect_list(F.struct("i", "x", "m"))
    whole = ranked.agg(
        F.max("n").alias("n"),
        F.sum(F.col("m") * F.col("m")).alias("mm"),
        F.max("m").alias("m1"),
        F.max(F.when(F.col("i") == F.col("n") - 1, F.col("m"))).alias("m2"),
        (F.var_pop("x") * F.count("x")).alias("ss"),
        scores.alias("rows"),
    )
    u = 1 / F.sqrt("n")
    root = F.sqrt("mm")
    last = F.col("m1") / root + _column_poly(WEIGHT_LAST, u)
    following = F.col("m2") / root + _column_poly(WEIGHT_NEXT, u)
    # up to five values only the outermost weight is corrected
    two = F.col("n") > 5
    rest = F.when(
        two,
        (F.col("mm") - 2 * F.col("m1") ** 2 - 2 * F.col("m2") ** 2) / (1 - 2 * last**2 - 2 * following**2),
    ).otherwise((F.col("mm") - 2 * F.col("m1") ** 2) / (1 - 2 * last**2))
    weighted = whole.select(
        "n", "ss", last.alias("last"), following.alias("following"), F.sqrt(rest).alias("scale"), F.explode("rows").alias("r")
    ).select("n", "ss", "last", "following", "scale", "r.i", "r.x", "r.m")
    edge = F.least(F.col("i"), F.col("n") - F.col("i") + 1)
    side = F.signum(F.col("m"))
    weight = (
        F.when(F.col("n") == 3, side * math.sqrt(0.5))
        .when(edge == 1, side * F.col("last"))
        .when((edge == 2) & (F.col("n") > 5), side * F.col("following"))
        .otherwise(F.col("m") / F.col("scale"))
    )
    return weighted.agg(
        F.max("n").alias("n"), F.try_divide(F.sum(weight * F.col("x")) ** 2, F.max("ss")).alias("statistic")
    )


def _column_poly(coefficients, x: Column) -> Column:
    total = F.lit(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        total = total * x + c
    return total


def shapiro_pvalue(w: float, n: int) -> float:
    """Royston's normal approximation; exact for three values."""
    if n == 3:
        return max(0.0, 6 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75))))
    if w >= 1:
        return 1.0
    y = math.log(1 - w)
    if n <= 11:
        gamma = _poly(SMALL_GAMMA, n)
        if y >= gamma:
            return 1e-99
        y, mean, spread = -math.log(gamma - y), _poly(SMALL_MEAN, n), math.exp(_poly(SMALL_SPREAD, n))
    else:
        size = math.log(n)
        mean, spread = _poly(LARGE_MEAN, size), math.exp(_poly(LARGE_SPREAD, size))
    return normal_sf((y - mean) / spread)


def shapiro_wilk(
    df: DataFrame,
    id_cols: Sequence[str],
    residual: str = "residual",
    seed: int | None = None,
    order: Sequence[Column] | None = None,
) -> dict:
    row = shapiro_wilk_statistic(df, id_cols, residual, seed, order).first()
    n, w = row["n"], row["statistic"]
    if n is None or n < 3:
        raise ValueError("the test needs at least 3 residuals")
    w = 1.0 if w is None else min(w, 1.0)
    p = shapiro_pvalue(w, n)
    return {"statistic": w, "pvalue": p, "n": n, "normal": p > QUALITY.p_value}


def residual_report(
    df: DataFrame,
    id_cols: Sequence[str],
    label: str,
    prediction: str = "prediction",
    features: Sequence[str] | None = None,
    seed: int | None = None,
) -> dict:
    """Tests, one-row summary and the tables behind the usual residual plots."""
    table = with_residual(df, label, prediction)
    tests = {"shapiro_wilk": shapiro_wilk(table, id_cols, seed=seed)}
    if features is not None:
        tests["breusch_pagan"] = breusch_pagan(table, features)
    spread = scale_location(table, prediction)
    return {
        "tests": tests,
        "summary": residual_summary(table),
        "tables": {
            "residuals_vs_fitted": table.select(*[col(c) for c in id_cols], col(prediction), "residual"),
            "residuals_smooth": lowess_grid(table, prediction, "residual"),
            "qq": qq_table(table, id_cols),
            "histogram": residual_histogram(table),
            "normal_curve": normal_curve(table),
            "scale_location": spread.select(*[col(c) for c in id_cols], col(prediction), "sqrt_abs_std_residual"),
            "scale_smooth": lowess_grid(spread, prediction, "sqrt_abs_std_residual"),
        },
    }
