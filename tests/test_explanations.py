"""Diagnostics, permutation importance, SHAP and LIME against closed forms and brute force."""

import itertools
import math

import numpy as np
import pytest
from conftest import FEATURES
from pyspark.sql import functions as F

from plumbline.functions import order_stats
from plumbline.operators import permutation, residuals, shap
from plumbline.operators import permutation as permutation_module
from plumbline.operators.learners import ColumnRegressor, base_learner, linear_regressor
from plumbline.operators.lime import bin_profile, compare_predictions, explain_first, lime_explain


@pytest.fixture(scope="module")
def linear(linear_data):
    return linear_regressor(FEATURES, "y").fit(linear_data)


@pytest.fixture(scope="module")
def forest(linear_data):
    return ColumnRegressor(base_learner("rf", "y", {"numTrees": 5, "maxDepth": 4}), FEATURES).fit(linear_data)


@pytest.fixture(scope="module")
def residual_rows(spark):
    rng = np.random.default_rng(71)
    x = rng.uniform(-2, 2, size=(300, 3))
    y = 40 + 12 * x[:, 0] + rng.gumbel(0, 6, 300)
    miss = rng.laplace(0, 2, 300) * (1 + np.abs(x[:, 1]))
    rows = [(i, float(a), float(a + e), *map(float, v)) for i, (a, e, v) in enumerate(zip(y, miss, x))]
    df = spark.createDataFrame(rows, "id long, y double, prediction double, a double, b double, c double")
    return residuals.with_residual(df, "y").persist()


# ---- residuals ----------------------------------------------------------------


@pytest.mark.parametrize("shift", [0.0, 2.5])
def test_report_of_residuals_without_spread(spark, shift):
    rows = [(i, float(i), float(i - shift), float(i % 7)) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, y double, prediction double, a double")
    report = residuals.residual_report(df, ["id"], "y", features=["a"])
    assert report["tests"]["shapiro_wilk"]["statistic"] == 1.0 and report["tests"]["breusch_pagan"]["homoscedastic"]
    assert report["summary"].first()["std_residual"] == 0.0
    bins = report["tables"]["histogram"].orderBy("bin").collect()
    assert bins[0]["n"] == 60 and sum(r["n"] for r in bins) == 60 and bins[0]["density"] is None
    for table in report["tables"].values():
        table.write.format("noop").mode("overwrite").save()


def test_zero_spread_residuals(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0)], "y double, prediction double")
    out = residuals.standardized_residuals(residuals.with_residual(df, "y"))
    assert [r["std_residual"] for r in out.collect()] == [0.0, 0.0]


def test_standardized_spread_is_one(residual_rows):
    out = residuals.standardized_residuals(residual_rows)
    assert out.select(F.stddev_pop("std_residual")).first()[0] == pytest.approx(1.0)


def test_shapiro_wilk_known_example(spark):
    """Weights of 11 men, a published worked example."""
    values = [148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236]
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "id long, residual double")
    found = residuals.shapiro_wilk(df, ["id"])
    assert found["statistic"] == pytest.approx(0.7888, abs=2e-4)
    assert found["pvalue"] == pytest.approx(0.006704, abs=2e-5)
    assert not found["normal"]


def test_shapiro_wilk_of_normal_rows_and_seeds(spark, residual_rows):
    assert residuals.shapiro_wilk(residual_rows, ["id"])["pvalue"] < 0.001  # spread that changes is not normal
    few = spark.createDataFrame([(i, float(v)) for i, v in enumerate(np.random.default_rng(5).normal(3, 2, 300))], "id long, residual double")
    assert residuals.shapiro_wilk(few, ["id"])["pvalue"] > 0.05
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(rng.normal(size=6000))], "id long, residual double")
    one, again, other = (residuals.shapiro_wilk(df, ["id"], seed=s)["pvalue"] for s in (1, 1, 2))
    assert one == again != other


def test_breusch_pagan_equals_direct_regression(residual_rows):
    found = residuals.breusch_pagan(residual_rows, ["a", "b", "c"])
    rows = np.array(residual_rows.select("a", "b", "c", "residual").collect())
    x, y = np.column_stack([np.ones(len(rows)), rows[:, :3]]), rows[:, 3] ** 2
    fit = x @ np.linalg.lstsq(x, y, rcond=None)[0]
    r2 = 1 - ((y - fit) ** 2).sum() / ((y - y.mean()) ** 2).sum()
    assert found["lm_statistic"] == pytest.approx(300 * r2, rel=1e-8) and found["df"] == 3
    assert 0 <= found["lm_pvalue"] <= 1 and 0 <= found["f_pvalue"] <= 1


def test_breusch_pagan_ignores_constant_and_duplicate_columns(residual_rows):
    plain = residuals.breusch_pagan(residual_rows, ["a", "b", "c"])
    more = residual_rows.withColumn("k", F.lit(-3.0)).withColumn("d", 1 - 5 * F.col("a"))
    again = residuals.breusch_pagan(more, ["a", "b", "c", "k", "d"])
    assert again["lm_pvalue"] == pytest.approx(plain["lm_pvalue"], rel=1e-8) and again["df"] == 3
    assert residuals.breusch_pagan(more, ["k"])["lm_pvalue"] == 1.0


def brute_lowess(x, y, anchors, frac, iterations):
    k = int(frac * len(x) + 1e-10)
    robust = np.ones(len(x))
    for step in range(iterations + 1):
        fitted = []
        for x0 in anchors:
            d = np.abs(x - x0)
            h = np.sort(d)[k - 1]
            w = np.where(d <= h, (1 - (d / h) ** 3) ** 3, 0) * robust
            coefficients = np.linalg.lstsq(np.column_stack([np.ones(len(x)), x - x0]) * np.sqrt(w)[:, None], y * np.sqrt(w), rcond=None)
            fitted.append(coefficients[0][0])
        if step < iterations:
            off = np.abs(y - np.interp(x, anchors, fitted))
            u = off / (6 * np.median(off))
            robust = np.where(u < 1, (1 - u**2) ** 2, 0)
    return np.array(fitted)


@pytest.mark.parametrize("iterations", [0, 2])
def test_lowess_equals_brute_force(spark, iterations):
    rng = np.random.default_rng(3)
    x = rng.uniform(0, 10, 250)
    y = np.sin(x) + rng.normal(0, 0.1, 250)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double").repartition(3)
    got = residuals.lowess_grid(df, "x", "y", frac=0.3, anchors=11, iterations=iterations).orderBy("anchor").collect()
    anchors = np.quantile(x, np.linspace(0, 1, 11))
    np.testing.assert_allclose([r["x0"] for r in got], anchors)
    np.testing.assert_allclose([r["smooth"] for r in got], brute_lowess(x, y, anchors, 0.3, iterations), rtol=1e-6)


@pytest.mark.parametrize("spread_rows", [2_000_000, 150])
def test_lowess_anchors_of_many_rows_come_from_one_count(spark, monkeypatch, spread_rows):
    """Ranks and distances of all anchors are read off counted intervals, ties included; nothing is counted for each anchor."""
    def refuse(*_):
        raise AssertionError("rows were counted for each anchor")

    monkeypatch.setattr(order_stats, "_narrow", refuse)
    monkeypatch.setattr(residuals, "DIRECT_ROWS", 100)
    monkeypatch.setattr(order_stats, "INTERVALS", 16)
    monkeypatch.setattr(order_stats, "SPREAD_ROWS", spread_rows)
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(0, 3, 1500), np.repeat(1.25, 700), np.arange(-400, 400) / 100])
    df = spark.createDataFrame([(float(v),) for v in x], "x double").repartition(3)
    found = residuals.lowess_anchors(df, "x", 0.3, 21)
    points = np.unique(np.quantile(x, np.linspace(0, 1, 21)))
    np.testing.assert_allclose([p for _, p, _ in found], points, rtol=1e-12)
    assert [h for _, _, h in found] == [np.sort(np.abs(x - p))[int(0.3 * len(x) + 1e-10) - 1] for _, p, _ in found]


def test_lowess_of_ties_and_few_rows(spark):
    df = spark.createDataFrame([(float(i % 3), float(i % 3) * 2 + (i % 2)) for i in range(60)], "x double, y double")
    got = residuals.lowess_grid(df, "x", "y", frac=0.3, anchors=2).orderBy("x0").collect()
    assert [r["x0"] for r in got] == [0.0, 2.0]  # every window is one point: the level there
    np.testing.assert_allclose([r["smooth"] for r in got], [0.5, 4.5])
    assert residuals.lowess_grid(df.limit(0), "x", "y").count() == 0
    one = residuals.lowess_grid(spark.createDataFrame([(3.0, 5.0)], "x double, y double"), "x", "y").collect()
    assert [(r["x0"], r["smooth"]) for r in one] == [(3.0, 5.0)]


def test_residual_report_has_all_parts(residual_rows):
    report = residuals.residual_report(residual_rows.drop("residual"), ["id"], "y", features=["a", "b", "c"])
    assert set(report["tests"]) == {"shapiro_wilk", "breusch_pagan"}
    assert set(report["tables"]) == {
        "residuals_vs_fitted", "residuals_smooth", "qq", "histogram", "normal_curve", "scale_location", "scale_smooth",
    }
    assert report["tables"]["histogram"].agg(F.sum("n")).first()[0] == 300
    assert abs(report["summary"].first()["mean_residual"]) < 2000


# ---- permutation ----------------------------------------------------------------


def test_permutation_keeps_the_multiset_and_moves_rows(linear_data):
    out = permutation.permute_column(linear_data, ["id"], "f0")
    both = out.select("id", F.col("f0").alias("p"), "f1").join(linear_data.select("id", "f0", F.col("f1").alias("g1")), "id")
    rows = both.collect()
    assert sorted(r["p"] for r in rows) == sorted(r["f0"] for r in rows)
    assert all(r["f1"] == r["g1"] for r in rows) and sum(r["p"] == r["f0"] for r in rows) < 40
    again = permutation.permute_column(linear_data.coalesce(1), ["id"], "f0")
    assert sorted(again.collect()) == sorted(out.collect())
    other = permutation.permute_column(linear_data, ["id"], "f0", repeat=1)
    assert sorted(other.collect()) != sorted(out.collect())


@pytest.mark.parametrize("n", [1, 2, 3, 7, 10, 99, 1000, 4001])
def test_ranks_are_permuted_as_a_whole(spark, n):
    rows = spark.range(n).select(F.col("id").alias("_rank"), F.explode(F.array(F.lit(0), F.lit(1))).alias("_repeat"))
    found = permutation.donor_ranks(rows, n, 5, [0, 1]).collect()
    for repeat in (0, 1):
        donors = {r["_rank"]: r["_donor"] for r in found if r["_repeat"] == repeat}
        assert sorted(donors.values()) == list(range(n))
        if n > 900:  # spread over the table, not near where they were
            assert np.corrcoef(list(donors), list(donors.values()))[0, 1] == pytest.approx(0, abs=0.1)
            assert sum(a == b for a, b in donors.items()) < 10


def importance(df, model, **options):
    table = permutation.permutation_importance(df, model, FEATURES, "y", ["id"], **options)
    return {r["feature"]: r["importance_mean"] for r in table.collect()}


def test_importance_of_a_linear_model_matches_theory(linear_data, linear):
    found = importance(linear_data, linear, n_repeats=8)
    beta = linear.stages[-1].coefficients[0]
    variance = linear_data.select(F.var_pop("f0")).first()[0]
    assert found["f0"] == pytest.approx(2 * beta**2 * variance, rel=0.15)
    assert list(found)[0] == "f0" and all(abs(found[f]) < 0.02 for f in FEATURES[1:])


def test_importance_follows_the_seed_only(linear_data, linear):
    zero = importance(linear_data, linear, n_repeats=2, seed=0)
    assert importance(linear_data.repartition(2), linear, n_repeats=2, seed=0) == pytest.approx(zero, rel=1e-9)
    assert importance(linear_data, linear, n_repeats=2) != pytest.approx(zero, rel=1e-6)


def test_noise_features_and_comparison(spark, linear_data, linear):
    table = permutation.permutation_importance(linear_data, linear, FEATURES, "y", ["id"], n_repeats=3)
    noisy = {r["feature"] for r in permutation.low_importance(table, 0.02).collect()}
    assert noisy == {"f1", "f2", "f3"}
    other = spark.createDataFrame([(f, float(4 - i)) for i, f in enumerate(FEATURES)] + [("only_here", 0.5)], "feature string, importance double")
    rows = permutation.compare_importance(table, other, 5).collect()
    assert rows[0]["feature"] == "f0" and rows[0]["avg_importance"] == 1.0
    assert {r["feature"]: r["permutation"] for r in rows}["only_here"] == 0.0


# ---- SHAP -------------------------------------------------------------------------


def predict_all(spark, model, matrix):
    rows = [(i, *map(float, v)) for i, v in enumerate(matrix)]
    df = spark.createDataFrame(rows, "i long, f0 double, f1 double, f2 double, f3 double")
    return np.array([r["prediction"] for r in model.transform(df).orderBy("i").collect()])


def brute_shapley(spark, model, x, background):
    m, masks = len(x), list(itertools.product([0, 1], repeat=len(x)))
    stacked = np.vstack([np.where(np.array(z, bool), x, background) for z in masks])
    value = dict(zip(masks, predict_all(spark, model, stacked).reshape(len(masks), -1).mean(axis=1)))
    phi = np.zeros(m)
    for z in masks:
        for j in range(m):
            if not z[j]:
                s = sum(z)
                grown = tuple(1 if i == j else b for i, b in enumerate(z))
                phi[j] += math.factorial(s) * math.factorial(m - s - 1) / math.factorial(m) * (value[grown] - value[z])
    return phi, value[(0,) * m]


def shap_rows(found):
    out = {}
    for r in found.values.collect():
        out.setdefault(r["id"], {})[r["feature"]] = r["shap_value"]
    return {i: np.array([v[f] for f in FEATURES]) for i, v in out.items()}


def test_kernel_method_equals_brute_force(spark, linear_data, forest):
    explained, background = linear_data.filter("id < 2"), linear_data.filter("id >= 350")
    found = shap.kernel_shap(forest, explained, background, FEATURES, ["id"])
    bg = np.array(background.select(*FEATURES).collect())
    for r in explained.collect():
        phi, base = brute_shapley(spark, forest, np.array([r[f] for f in FEATURES]), bg)
        np.testing.assert_allclose(shap_rows(found)[r["id"]], phi, atol=1e-8)
        assert found.base_value == pytest.approx(base)


def test_sampled_coalitions_stay_additive_and_exact_for_linear_models(linear_data, linear):
    """A budget below 2^4 - 2 forces sampling."""
    z, weights = shap.coalitions(4, budget=9)
    assert len(z) == len(weights) <= 14 and (weights > 0).all()
    background = linear_data.filter("id >= 300")
    found = shap.kernel_shap(linear, linear_data.filter("id < 3"), background, FEATURES, ["id"], budget=9)
    beta = np.array(linear.stages[-1].coefficients)
    mean = np.array(background.select(*[F.avg(f) for f in FEATURES]).first())
    for r in linear_data.filter("id < 3").collect():
        np.testing.assert_allclose(shap_rows(found)[r["id"]], beta * (np.array([r[f] for f in FEATURES]) - mean), atol=1e-9)


def test_many_features_use_a_bounded_plan():
    z, weights = shap.coalitions(40)
    assert len(z) <= 2 * 40 + 2048 and z.sum(axis=1).min() == 1
    p = shap.projection(z, weights)
    np.testing.assert_allclose(p.sum(axis=0)[:-2], 0, atol=1e-9)
    assert p.sum(axis=0)[-2:] == pytest.approx([1, -1])


def test_single_feature(linear_data):
    model = linear_regressor(["f0"], "y").fit(linear_data)
    found = shap.kernel_shap(model, linear_data.filter("id = 1"), linear_data.filter("id > 300"), ["f0"], ["id"])
    one = model.transform(linear_data.filter("id = 1")).first()["prediction"]
    assert found.values.first()["shap_value"] + found.base_value == pytest.approx(one)


def tree_expectation(nodes, x, known, node=0):
    n = nodes[node]
    if n["leftChild"] < 0:
        return n["prediction"]
    left, right = n["leftChild"], n["rightChild"]
    if n["feature"] in known:
        return tree_expectation(nodes, x, known, left if x[n["feature"]] <= n["threshold"] else right)
    total = n["cover"]
    return sum(nodes[c]["cover"] / total * tree_expectation(nodes, x, known, c) for c in (left, right))


def test_tree_passes_and_steps_change_nothing(linear_data, forest, monkeypatch):
    rows = linear_data.filter("id < 40")
    whole = shap_rows(shap.tree_shap(forest, rows, FEATURES, ["id"]))
    monkeypatch.setattr(shap, "LEAF_BYTES", 3000)
    monkeypatch.setattr(shap, "WORK_BYTES", 300_000)
    split = shap_rows(shap.tree_shap(forest, rows, FEATURES, ["id"]))
    for i, phi in whole.items():
        np.testing.assert_allclose(split[i], phi, atol=1e-9)


@pytest.mark.parametrize("kind", ["rf", "gbt_a"])
def test_tree_method_equals_brute_force(spark, linear_data, kind):
    params = {"rf": {"numTrees": 3, "maxDepth": 4}, "gbt_a": {"maxIter": 3, "maxDepth": 3, "stepSize": 0.5}}[kind]
    model = ColumnRegressor(base_learner(kind, "y", params), FEATURES).fit(linear_data)
    rows = linear_data.filter("id < 3")
    found = shap.shap_values(model, rows, FEATURES, ["id"])
    flat, weights = shap.node_table(model.stages[-1], spark)
    trees = {}
    for n in flat.collect():
        trees.setdefault(n["tree"], {})[n["id"]] = n
    for r in model.transform(rows).collect():
        x, phi = [r[f] for f in FEATURES], np.zeros(4)
        for t, w in weights.items():
            for known in itertools.chain.from_iterable(itertools.combinations(range(4), s) for s in range(4)):
                for j in set(range(4)) - set(known):
                    s = len(known)
                    share = math.factorial(s) * math.factorial(3 - s) / 24
                    gain = tree_expectation(trees[t], x, {*known, j}) - tree_expectation(trees[t], x, set(known))
                    phi[j] += w * share * gain
        np.testing.assert_allclose(shap_rows(found)[r["id"]], phi, atol=1e-9)
        assert found.base_value + phi.sum() == pytest.approx(r["prediction"])


def test_rows_between_the_same_thresholds_share_their_contributions(linear_data, forest, monkeypatch):
    spark = linear_data.sparkSession
    flat = shap.leaf_paths(*shap.node_table(forest.stages[-1], spark)).collect()
    rng = np.random.default_rng(2)
    x = rng.normal(size=(6000, 4))
    x[:40, 0], x[40:60, 1], x[60:80, 2] = np.nan, -np.inf, np.inf
    asked = []
    terms = shap._leaf_terms
    monkeypatch.setattr(shap, "_leaf_terms", lambda rows, *more: asked.append(len(rows)) or terms(rows, *more))
    for tables in shap._unpacked(flat):
        tree = shap._Tree(tables)
        cuts = np.concatenate([c for c in tree.cuts.values()])
        x[100 : 100 + len(cuts)] = cuts[:, None]  # rows on the thresholds
        want = sum(terms(x, *t) for t in tables)
        asked.clear()
        for a in range(0, len(x), 1000):
            np.testing.assert_allclose(tree.contributions(x[a : a + 1000]), want[a : a + 1000], atol=1e-9)
        assert sum(asked) <= len(tables) * math.prod(len(c) + 2 for c in tree.cuts.values()) and sum(asked) < len(tables) * len(x)
        monkeypatch.setattr(shap, "PLACES", 5)
        again = np.concatenate([tree.contributions(x[a : a + 1000]) for a in range(0, len(x), 1000)])
        np.testing.assert_allclose(again, want, atol=1e-9)
        monkeypatch.undo()
        monkeypatch.setattr(shap, "_leaf_terms", lambda rows, *more: asked.append(len(rows)) or terms(rows, *more))
        tree.countable = False
        np.testing.assert_allclose(tree.contributions(x), want, atol=1e-9)


def test_shap_tables(linear_data, linear):
    with pytest.raises(ValueError):
        shap.shap_values(linear, linear_data, FEATURES, ["id"])
    background = shap.background_sample(linear_data, ["id"], 50)
    report = shap.shap_report(linear, linear_data, FEATURES, ["id"], background)
    found = report["shap"]
    assert found.values.count() == 400  # 100 sampled rows of 4 features
    assert report["importance"].first()["feature"] == "f0" and len(report["dependence"]) == 3
    assert abs(found.base_value - linear_data.agg(F.avg("y")).first()[0]) < 2
    assert {r["position"] for r in shap.shap_summary(found, 2).select("position").distinct().collect()} == {1, 2}
    one = found.values.first()["id"]
    force = shap.shap_force(found, {"id": one}).orderBy("position").collect()
    target = linear.transform(linear_data.filter(F.col("id") == one)).first()["prediction"]
    assert force[-1]["running_value"] == pytest.approx(target)
    assert shap.shap_dependence(found, 0).count() == shap.shap_dependence(found, "f0").count() == 100
    with pytest.raises(ValueError):
        shap.shap_dependence(found, "absent")


# ---- LIME ---------------------------------------------------------------------------


def lime(df, model, **options):
    profile = bin_profile(df, FEATURES)
    options = {"n": 2, "num_samples": 1500, **options}
    return explain_first(model, df, profile, FEATURES, ["id"], "y", **options)


def test_lime_finds_the_driving_feature(linear_data, forest):
    rows = lime(linear_data, forest).filter("rank = 1").collect()
    assert len(rows) == 2 and all(r["feature"] == "f0" and "f0" in r["bin_label"] for r in rows)
    scored = {r["id"]: r["prediction"] for r in forest.transform(linear_data).collect()}
    assert all(r["prediction"] == pytest.approx(scored[r["id"]]) for r in rows)


def test_lime_follows_the_seed_only(linear_data, forest):
    first = lime(linear_data, forest, num_samples=2100).orderBy("id", "rank").collect()
    assert lime(linear_data.coalesce(1), forest, num_samples=2100).orderBy("id", "rank").collect() == first
    assert lime(linear_data, forest, num_samples=2100, seed=1).orderBy("id", "rank").collect() != first


@pytest.mark.parametrize("count", [2, 8])
def test_lime_feature_count(linear_data, forest, count):
    rows = lime(linear_data, forest, n=1, num_features=count).collect()
    assert len(rows) == min(count, 4)


def test_lime_keeps_odd_names_and_constant_columns(spark):
    grid = np.linspace(-1, 1, 90)
    rows = [(i, float(v), 4.0, float(v - 7)) for i, v in enumerate(grid)]
    names = ["größe (m²)", "fixed"]
    df = spark.createDataFrame(rows, "id long, `größe (m²)` double, fixed double, y double")
    model = linear_regressor(names, "y").fit(df)
    out = lime_explain(model, df.filter("id = 11"), bin_profile(df, names), names, ["id"], num_samples=500).collect()
    assert names[0] in out[0]["bin_label"] and all(math.isfinite(r["weight"]) for r in out)


def test_compare_predictions(linear_data, linear):
    row = compare_predictions(linear, linear_data, ["id"], "y").filter("id = 3").first()
    assert row["Error"] == pytest.approx(abs(row["Prediction"] - row["Actual"]))
    assert compare_predictions(linear, linear_data, ["id"]).columns == ["id", "Prediction"]


def test_comparing_importances_computes_each_once(spark):
    runs = spark.sparkContext.accumulator(0)

    def counted(batches):
        runs.add(1)
        yield from batches

    made = [
        spark.createDataFrame([("a", 4.0), ("b", 1.0)], f"feature string, {c} double").coalesce(1).mapInPandas(counted, f"feature string, {c} double")
        for c in ("importance_mean", "importance")]
    found = permutation_module.compare_importance(*made).collect()
    assert ([r["feature"] for r in found], runs.value) == (["a", "b"], 2)
