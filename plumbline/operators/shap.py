"""Shapley explanations: kernel method for any model, exact method for tree ensembles."""

from __future__ import annotations

import itertools
import math
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Model, PipelineModel, Transformer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import SHAP, default
from ..functions.columns import as_double, col
from ..functions.lookups import settle
from ..session import checkpoint_folder, cut_lineage
from .permutation import top_features
from .splits import sample_n

MAX_BACKGROUND = 10_000


@dataclass
class ShapValues:
    """Long table (id, feature, feature_value, shap_value) and the base value it adds to."""

    values: DataFrame
    base_value: float
    id_cols: list[str]
    features: list[str]


def background_sample(
    df: DataFrame, id_cols: Sequence[str], n: int | None = None, seed: int | None = None,
    order: Sequence[Column] | None = None,
) -> DataFrame:
    return sample_n(df, default(n, SHAP.sample_size), id_cols, seed, order)


# ---- kernel method --------------------------------------------------------------


def coalitions(m: int, budget: int | None = None, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """Proper non-empty feature subsets and their Shapley kernel weights.

    All of them when they fit the budget. Otherwise whole subset sizes are taken from
    the outside in, where the kernel weight lies, and the rest of the budget draws
    complementary pairs of the remaining sizes.
    """
    budget = default(budget, 2 * m + 2048)
    if m < 2:
        return np.zeros((0, m)), np.zeros(0)
    size_weight = {s: (m - 1) / (s * (m - s)) for s in range(1, m)}
    subsets: dict[tuple[int, ...], float] = {}
    open_sizes = set(size_weight)
    for small in range(1, m // 2 + 1):
        pair = {small, m - small}
        if len(subsets) + len(pair) * math.comb(m, small) > budget:
            break
        for s in pair:
            for chosen in itertools.combinations(range(m), s):
                subsets[chosen] = size_weight[s] / math.comb(m, s)
        open_sizes -= pair
    if open_sizes:
        rng = np.random.default_rng(seed)
        sizes = sorted(open_sizes)
        share = np.array([size_weight[s] for s in sizes])
        left = share.sum()
        drawn: dict[tuple[int, ...], int] = {}
        for _ in range(max((budget - len(subsets)) // 2, m)):
            s = int(rng.choice(sizes, p=share / left))
            chosen = tuple(sorted(rng.choice(m, s, replace=False).tolist()))
            other = tuple(sorted(set(range(m)) - set(chosen)))
            for c in (chosen, other):
                drawn[c] = drawn.get(c, 0) + 1
        total = sum(drawn.values())
        subsets.update({c: left * k / total for c, k in drawn.items()})
    z = np.zeros((len(subsets), m))
    for i, chosen in enumerate(subsets):
        z[i, list(chosen)] = 1.0
    return z, np.array(list(subsets.values()))


def projection(z: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Matrix turning coalition values into Shapley values.

    Columns are the coalitions, then the full and the empty one. The last feature is
    eliminated by the additivity constraint, so contributions always sum to the
    prediction minus the base value.
    """
    n, m = z.shape
    out = np.zeros((m, n + 2))
    if m > 1:
        a = z[:, :-1] - z[:, -1:]
        p = np.linalg.pinv((a.T * weights) @ a) @ (a.T * weights)
        out[:-1, :n] = p
        out[:-1, n] = -p @ z[:, -1]
        out[:-1, n + 1] = -p @ (1 - z[:, -1])
    out[-1, n], out[-1, n + 1] = 1.0, -1.0
    out[-1] -= out[:-1].sum(axis=0)
    return out


def _background_table(background: DataFrame, features: Sequence[str]) -> DataFrame:
    rows = background.select(*[as_double(background, f).alias(f"b{j}") for j, f in enumerate(features)])
    table = rows.limit(MAX_BACKGROUND + 1).toArrow()
    if table.num_rows == 0:
        raise ValueError("the kernel method needs a background sample")
    if table.num_rows > MAX_BACKGROUND:
        raise ValueError(f"background has more than {MAX_BACKGROUND} rows; take background_sample() first")
    return background.sparkSession.createDataFrame(
        table.append_column("bid", pa.array(range(table.num_rows), pa.int32()))
    )


def kernel_shap(
    model: Transformer,
    explained: DataFrame,
    background: DataFrame,
    features: Sequence[str],
    id_cols: Sequence[str],
    budget: int | None = None,
    seed: int = 42,
    prediction: str = "prediction",
) -> ShapValues:
    """Contributions of every feature for every row of ``explained``.

    Rows fan out over coalitions and background rows through bounded, broadcast
    tables joined on an index; the model scores the masked rows in one ``transform``;
    averaging and the weighted least-squares projection are two aggregations.
    """
    spark, m = explained.sparkSession, len(features)
    z, weights = coalitions(m, budget, seed)
    matrix = projection(z, weights)
    masks = np.vstack([z, np.ones(m), np.zeros(m)]).astype(bool)
    plan = {"cid": pa.array(range(len(masks)), pa.int32())}
    plan.update({f"z{j}": pa.array(masks[:, j]) for j in range(m)})
    solve = {"cid": plan["cid"]}
    solve.update({f"p{j}": pa.array(matrix[j]) for j in range(m)})
    mask_table = F.broadcast(spark.createDataFrame(pa.table(plan)))
    solve_table = F.broadcast(spark.createDataFrame(pa.table(solve)))
    base_rows = _background_table(background, features)
    n_base = base_rows.count()

    rows = explained.select(
        F.struct(*[col(c) for c in id_cols]).alias("key"),
        *[as_double(explained, f).alias(f"x{j}") for j, f in enumerate(features)],
    )
    rows = settle(rows).table  # used twice below: draw the sample once
    parallelism = spark.sparkContext.defaultParallelism
    fanned = (
        rows.withColumn("cid", F.explode(F.sequence(F.lit(0), F.lit(len(masks) - 1))))
        .repartition(max(parallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))
        .join(mask_table, "cid")
        .withColumn("bid", F.explode(F.sequence(F.lit(0), F.lit(n_base - 1))))
        .join(F.broadcast(base_rows), "bid")
    )
    masked = fanned.select(
        "key", "cid",
        *[F.when(F.col(f"z{j}"), F.col(f"x{j}")).otherwise(F.col(f"b{j}")).alias(f) for j, f in enumerate(features)],
    )
    valued = model.transform(masked).groupBy("key", "cid").agg(F.avg(prediction).alias("v"))
    solved = (
        valued.join(solve_table, "cid")
        .groupBy("key")
        .agg(
            F.max(F.when(F.col("cid") == len(masks) - 1, F.col("v"))).alias("base"),
            *[F.sum(F.col(f"p{j}") * F.col("v")).alias(f"s{j}") for j in range(m)],
        )
    )
    whole = settle(
        solved.join(rows, "key").select(
            "key", "base",
            F.inline(
                F.array(
                    *[
                        F.struct(
                            F.lit(f).alias("feature"),
                            F.col(f"x{j}").alias("feature_value"),
                            F.col(f"s{j}").alias("shap_value"),
                        )
                        for j, f in enumerate(features)
                    ]
                )
            ),
        )
    ).table
    first = whole.select("base").first()
    values = whole.select("key.*", "feature", "feature_value", "shap_value")
    return ShapValues(values, float(first[0]) if first else math.nan, list(id_cols), list(features))


def base_value(model: Transformer, background: DataFrame, prediction: str = "prediction") -> DataFrame:
    """Mean prediction over the background, one row."""
    return model.transform(background).agg(F.avg(col(prediction)).alias("base_value"))


# ---- tree method ----------------------------------------------------------------


def node_table(model: Model, spark) -> tuple[DataFrame, dict[int, float]]:
    """Saved nodes of a tree model, one row per node, and the weight of each tree."""
    path = f"{checkpoint_folder(spark)}/tree-nodes-{uuid.uuid4().hex}"
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    if "nodeData" in nodes.columns:
        nodes = nodes.select(F.col("treeID").alias("tree"), "nodeData.*")
    else:
        nodes = nodes.select(F.lit(0).alias("tree"), "*")
    weights = getattr(model, "treeWeights", [1.0])
    scale = 1.0
    if "RandomForest" in type(model).__name__:
        scale = 1.0 / len(weights)
    flat = nodes.select(
        "tree", "id", "prediction", F.col("rawCount").alias("cover"), "leftChild", "rightChild",
        F.col("split.featureIndex").alias("feature"),
        F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
        F.col("split.numCategories").alias("categories"),
    )
    return flat, {i: w * scale for i, w in enumerate(weights)}


LEAF_BYTES = 32 * 1024 * 1024  # leaf paths that one pass over the rows ships
WORK_BYTES = 48 * 1024 * 1024  # arrays of one step in a task
CELLS = 4  # of a path: feature, low, high, cover share
PLACES = 1 << 14  # of a tree whose contributions a task keeps


def _tree_leaves(pdf: pd.DataFrame) -> pd.DataFrame:
    """Packed leaf paths of one tree, a row for each number of distinct path features."""
    nodes = {r.id: r for r in pdf.itertuples(index=False)}
    grouped: dict[int, tuple[list, list]] = {}
    todo: list = [(nodes[0], {})]
    base = 0.0
    while todo:
        node, path = todo.pop()
        if node.leftChild < 0:
            base += node.weight * node.prediction * math.prod(p[3] for p in path.values())
            cells, values = grouped.setdefault(len(path), ([], []))
            cells.append(list(path.values()))
            values.append(node.weight * node.prediction)
            continue
        if node.categories >= 0:
            raise ValueError("tree splits on nominal features are not supported; encode them as numbers")
        _, low, high, cover = path.get(node.feature, (node.feature, -math.inf, math.inf, 1.0))
        for child, bounds in (
            (nodes[node.leftChild], (low, min(high, node.threshold))),
            (nodes[node.rightChild], (max(low, node.threshold), high)),
        ):
            share = cover * child.cover / node.cover
            todo.append((child, {**path, node.feature: (node.feature, *bounds, share)}))
    rows = [
        (int(pdf["tree"].iloc[0]), d, np.array(cells, float).tobytes(), np.array(values).tobytes())
        for d, (cells, values) in grouped.items()
    ]
    out = pd.DataFrame(rows, columns=["tree", "depth", "cells", "leaves"])
    out["base"] = [base] + [0.0] * (len(out) - 1)
    return out


def leaf_paths(nodes: DataFrame, weights: dict[int, float]) -> DataFrame:
    """(tree, depth, cells, leaves, base): paths are followed where a tree's nodes are, one tree at a time."""
    spark = nodes.sparkSession
    scale = spark.createDataFrame([(int(t), float(w)) for t, w in weights.items()], "tree int, weight double")
    rows = nodes.withColumn("tree", F.col("tree").cast("int")).fillna({"categories": -1, "feature": -1}).join(
        F.broadcast(scale), "tree")  # a number for each tree
    return rows.groupBy("tree").applyInPandas(
        _tree_leaves, "tree int, depth int, cells binary, leaves binary, base double")


def _unpacked(rows: list) -> list[list[tuple[np.ndarray, np.ndarray]]]:
    """For each tree: (cells, values) of all its leaves with equally many path features."""
    trees: dict[int, list] = {}
    for r in rows:
        if r["depth"]:
            d = r["depth"]
            trees.setdefault(r["tree"], []).append(
                (np.frombuffer(r["cells"]).reshape(-1, d, CELLS), np.frombuffer(r["leaves"])))
    return [sorted(own, key=lambda t: t[0].shape[1]) for _, own in sorted(trees.items())]


def _leaf_terms(x: np.ndarray, cells: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Shapley values of leaves with d path features each, summed by feature.

    The weight of a subset of size k is the integral of t^k (1 - t)^(d - 1 - k) over [0, 1], so the weighted sum over all
    subsets is the integral of a product with one factor for each other feature: a polynomial in t, which a Gauss rule of
    d / 2 points integrates exactly. The factor left out is divided away; no factor is 0 inside the interval.
    """
    out = np.zeros_like(x)
    d = cells.shape[1]
    feature, low, high, cover = cells[:, :, 0].astype(int), cells[:, :, 1], cells[:, :, 2], cells[:, :, 3]
    held = x[:, feature]
    one = ((held > low) & (held <= high)).astype(float)
    points, weights = np.polynomial.legendre.leggauss((d + 1) // 2)
    inner = np.zeros_like(one)
    for t, w in zip((points + 1) / 2, weights / 2):
        factors = (1 - t) * cover + t * one
        inner += (w * factors.prod(axis=2))[:, :, None] / factors
    inner *= one - cover
    inner *= value[:, None]
    order = np.argsort(feature.ravel(), kind="stable")
    present, at = np.unique(feature.ravel()[order], return_index=True)
    out[:, present] = np.add.reduceat(inner.reshape(len(x), -1)[:, order], at, axis=1)
    return out


def _direct(x: np.ndarray, tables: list, batch: int = 256) -> np.ndarray:
    """Shapley values of product games: one term per leaf, exact for path-dependent trees.

    Rows and leaves are taken in steps whose arrays stay below WORK_BYTES.
    """
    out = np.zeros_like(x)
    for cells, value in tables:
        step = max(1, WORK_BYTES // (8 * batch * 6 * cells.shape[1]))  # rows x leaves x path features, six of them
        for a in range(0, len(x), batch):
            for i in range(0, len(value), step):
                out[a : a + batch] += _leaf_terms(x[a : a + batch], cells[i : i + step], value[i : i + step])
    return out


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """The rows of a list column of `width` numbers each; null is NaN."""
    return np.array(column.flatten().to_numpy(zero_copy_only=False), dtype=float).reshape(len(column), width)


class _Tree:
    """Contributions of one tree, worked out once for rows that lie between the same thresholds."""

    def __init__(self, tables: list):
        self.tables = tables
        cells = np.concatenate([c.reshape(-1, CELLS) for c, _ in tables])
        self.cuts = {}
        for f in np.unique(cells[:, 0]).astype(int):
            ends = cells[cells[:, 0] == f, 1:3]
            self.cuts[f] = np.unique(ends[np.isfinite(ends)])
        self.countable = math.prod(len(c) + 2 for c in self.cuts.values()) < 1 << 62
        self.forget()

    def forget(self) -> None:
        self.places, self.phi = np.zeros(0, np.int64), None

    def contributions(self, x: np.ndarray) -> np.ndarray:
        if not self.countable:
            return _direct(x, self.tables)
        place = np.zeros(len(x), np.int64)
        for f, cuts in self.cuts.items():
            held = x[:, f]
            own = np.where(held > -math.inf, np.searchsorted(cuts, held), len(cuts) + 1)  # NaN is in no interval
            place = place * (len(cuts) + 2) + own
        found, first, back = np.unique(place, return_index=True, return_inverse=True)
        new = ~np.isin(found, self.places)
        if new.any():
            if len(self.places) + new.sum() > PLACES:
                self.forget()
                new[:] = True
            phi = _direct(x[first[new]], self.tables)
            places = np.concatenate([self.places, found[new]])
            phi = phi if self.phi is None else np.concatenate([self.phi, phi])
            order = np.argsort(places)
            self.places, self.phi = places[order], phi[order]
        return self.phi[np.searchsorted(self.places, found)][back]


def tree_shap(
    model: Model, explained: DataFrame, features: Sequence[str], id_cols: Sequence[str]
) -> ShapValues:
    """Exact contributions for decision trees, forests and boosted trees.

    ``model`` is the tree model or a ``PipelineModel`` ending in one. Leaf paths are built on
    executors, tree by tree, and shipped in passes of bounded size; rows are scored where they
    are, without a shuffle. A usual model is one pass; sums of a large forest are written
    between passes.
    """
    tree = model.stages[-1] if isinstance(model, PipelineModel) else model
    spark = explained.sparkSession
    leaves = cut_lineage(leaf_paths(*node_table(tree, spark)))
    sizes = leaves.groupBy("tree").agg(
        F.sum(F.length("cells") + F.length("leaves")).alias("size"), F.sum("base").alias("base")).orderBy("tree").collect()
    passes, filled = [[]], 0
    for r in sizes:
        if filled and filled + r["size"] > LEAF_BYTES:
            passes.append([])
            filled = 0
        passes[-1].append(r["tree"])
        filled += r["size"]

    keys = [explained.schema[c] for c in id_cols]
    array = T.ArrayType(T.DoubleType())
    schema = T.StructType([*keys, T.StructField("x", array), T.StructField("phi", array)])
    rows = explained.select(
        *[col(c) for c in id_cols],
        F.array(*[as_double(explained, f) for f in features]).alias("x"),
        F.array(*[F.lit(0.0) for _ in features]).alias("phi"),
    )
    for i, trees in enumerate(passes):
        between = F.col("tree").between(trees[0], trees[-1]) if trees else F.lit(False)
        shared = spark.sparkContext.broadcast(_unpacked(leaves.filter(between).collect()))

        def score(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            trees = [_Tree(tables) for tables in shared.value]
            for part in batches:
                x, phi = (_matrix(part.column(c), len(features)) for c in ("x", "phi"))
                for tree in trees:
                    phi = phi + tree.contributions(x)
                at = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(features))
                done = pa.ListArray.from_arrays(at, pa.array(phi.ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], done], names=part.schema.names)

        rows = rows.mapInArrow(score, schema)
        if i + 1 < len(passes):
            rows = cut_lineage(rows)
    long = rows.select(
        *[col(c) for c in id_cols],
        F.inline(F.arrays_zip(F.array(*[F.lit(f) for f in features]), F.col("x"), F.col("phi"))),
    )
    values = long.toDF(*id_cols, "feature", "feature_value", "shap_value")
    return ShapValues(values, float(sum(r["base"] for r in sizes)), list(id_cols), list(features))


def _is_tree(model: Model) -> bool:
    last = model.stages[-1] if isinstance(model, PipelineModel) else model
    return any(kind in type(last).__name__ for kind in ("DecisionTree", "RandomForest", "GBT"))


def shap_values(
    model: Model,
    df: DataFrame,
    features: Sequence[str],
    id_cols: Sequence[str],
    background: DataFrame | None = None,
    max_samples: int | None = None,
    seed: int | None = None,
    order: Sequence[Column] | None = None,
    budget: int | None = None,
) -> ShapValues:
    """The tree method where it applies, else the kernel method over a background sample.

    Without ``max_samples`` the tree method explains every row, and the kernel method, which
    scores hundreds of copies of a row, the usual sample.
    """
    tree = _is_tree(model)
    if not tree and background is None:
        raise ValueError("a background sample is required for this model")
    count = max_samples if tree else default(max_samples, SHAP.sample_size)
    rows = df if count is None else sample_n(df, count, id_cols, seed, order)
    if tree:
        return tree_shap(model, rows, features, id_cols)
    return kernel_shap(model, rows, background, features, id_cols, budget)


# ---- tables ---------------------------------------------------------------------


def shap_importance(shap: ShapValues) -> DataFrame:
    """(feature, importance): mean absolute contribution, largest first."""
    return (
        shap.values.groupBy("feature")
        .agg(F.avg(F.abs("shap_value")).alias("importance"))
        .orderBy(F.desc("importance"), "feature")
    )


def shap_bar(shap: ShapValues, max_display: int | None = None) -> DataFrame:
    return top_features(shap_importance(shap), default(max_display, SHAP.max_display), "importance")


def shap_summary(shap: ShapValues, max_display: int | None = None) -> DataFrame:
    """Contributions and values of the top features, row by row, with the feature's position."""
    top = shap_bar(shap, max_display)
    placed = top.withColumn("position", F.row_number().over(Window.orderBy(F.desc("importance"), "feature")))
    return shap.values.join(F.broadcast(placed.select("feature", "position")), "feature")


def shap_dependence(shap: ShapValues, feature: str | int) -> DataFrame:
    """(id, feature_value, shap_value) of one feature, by name or position."""
    name = shap.features[feature] if isinstance(feature, int) else feature
    if name not in shap.features:
        raise ValueError(f"unknown feature {name!r}")
    return shap.values.filter(F.col("feature") == name).drop("feature")


def shap_force(shap: ShapValues, row: dict) -> DataFrame:
    """Contributions of one row, strongest first, as running totals from the base value."""
    one = shap.values
    for c in shap.id_cols:
        one = one.filter(col(c) == row[c])
    ordered = Window.orderBy(F.desc(F.abs("shap_value")), "feature")  # one row per feature
    running = F.sum("shap_value").over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    return one.select(
        *[col(c) for c in shap.id_cols],
        F.row_number().over(ordered).alias("position"),
        "feature", "feature_value", "shap_value",
        F.lit(shap.base_value).alias("base_value"),
        (F.lit(shap.base_value) + running).alias("running_value"),
    )


def shap_report(
    model: Model, df: DataFrame, features: Sequence[str], id_cols: Sequence[str],
    background: DataFrame | None = None, seed: int | None = None,
) -> dict:
    """Sample, contributions, importance, summary, and dependence of the strongest features."""
    shap = shap_values(model, df, features, id_cols, background, SHAP.sample_size, seed)
    shap.values = cut_lineage(shap.values)  # every table below reads them
    importance = shap_importance(shap)
    strongest = [r["feature"] for r in importance.limit(SHAP.dependence_features).collect()]
    return {
        "shap": shap,
        "importance": importance,
        "summary": shap_summary(shap),
        "bar": shap_bar(shap),
        "dependence": {f: shap_dependence(shap, f) for f in strongest},
    }
