"""Metrics, learners, meta-learner, stacking, search, recipes and streaming."""

import math
import time

import numpy as np
import pytest
from conftest import FEATURES
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from plumbline.config import BAYES, LEARNERS, SEARCH, BayesianRidgeConfig
from plumbline.operators import blocks, metrics, residuals
from plumbline.operators.bayes_ridge import BayesianRidge
from plumbline.operators.encoders import TargetEncoder
from plumbline.operators.learners import ColumnRegressor, base_learner, base_learners, evaluate_learners, linear_regressor
from plumbline.operators.search import SPACES, RandomSearch, Whole, search_summary, spark_params
from plumbline.operators.stacking import StackedModel, StackedRegressor, cross_validate
from plumbline.plans import catalog_models, recipes
from plumbline.session import stored
from plumbline.streaming.score import score_files

SMALL = {"gbt_a": {"maxIter": 3}, "gbt_b": {"maxIter": 3, "minInstancesPerNode": 2}, "rf": {"numTrees": 4, "maxDepth": 5}}


def scored(spark, pairs):
    return spark.createDataFrame(pairs, "y double, prediction double")


def test_known_metrics(spark):
    row = metrics.regression_metrics(scored(spark, [(100.0, 110.0), (200.0, 180.0)]), "y").first()
    assert (row["MAE"], row["MAPE"], row["Max_Error"]) == (15.0, pytest.approx(10.0), 20.0)
    assert row["RMSE"] == pytest.approx(math.sqrt(250)) and row["R2"] == pytest.approx(1 - 500 / 5000)


def test_zero_targets(spark):
    assert metrics.regression_metrics(scored(spark, [(100.0, 110.0), (0.0, 5.0)]), "y").first()["MAPE"] == pytest.approx(10.0)
    assert math.isnan(metrics.regression_metrics(scored(spark, [(0.0, 1.0), (0.0, 2.0)]), "y").first()["MAPE"])


def test_intervals(spark):
    df = spark.createDataFrame([(100.0, -5.0), (200.0, 0.0), (300.0, 5.0)], "prediction double, residual double")
    row = metrics.prediction_intervals(df, df).filter("prediction = 100").first()
    assert row["upper"] - 100 == pytest.approx(1.959964 * math.sqrt(50 / 3), rel=1e-6)
    row = metrics.prediction_intervals(df, df, confidence=0.5, method="empirical").filter("prediction = 100").first()
    assert (row["lower"], row["upper"]) == (97.5, 102.5)
    with pytest.raises(ValueError):
        metrics.prediction_intervals(df, df, confidence=1.0)
    with pytest.raises(ValueError):
        metrics.prediction_intervals(df, df, method="bogus")


def test_flat_scores_normalise_to_zero(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "s double")
    assert [r["n"] for r in metrics.minmax_normalize(df, "s", "n").collect()] == [0.0, 0.0]


def test_report_flags_overfitting(spark):
    rows = [("train", 1.0, 1.0), ("train", 3.0, 3.0), ("test", 1.0, 2.5), ("test", 3.0, 1.5)]
    df = spark.createDataFrame(rows, "split string, y double, prediction double")
    row = metrics.performance_report(df, "y").first()
    assert row["overfit"] and row["train_metrics"]["R2"] == 1.0
    table = metrics.meets_targets(metrics.regression_metrics(df, "y", by=["split"])).filter("split = 'train'").first()
    assert table["meets_targets"]


def test_root_of_mean_is_at_least_mean_of_roots(spark):
    row = metrics.cv_summary(spark.createDataFrame([(1.0, 1.0), (9.0, 3.0)], "mse double, rmse double")).first()
    assert row["rmse_of_mean"] >= row["rmse_mean"] and row["rmse_std"] == 1.0


def test_learners_keep_order_and_take_overrides():
    learners = dict(base_learners("y", {"rf": {"numTrees": 7}}))
    assert list(learners) == ["gbt_a", "gbt_b", "rf"]
    assert learners["rf"].getNumTrees() == 7 and learners["rf"].getMaxDepth() == 15
    assert learners["gbt_a"].getMaxIter() == 1000
    with pytest.raises(ValueError):
        base_learners("y", {"unknown": {}})


def test_evaluate_learners(linear_data):
    table = evaluate_learners(linear_data, linear_data, base_learners("y", SMALL)[2:], FEATURES, "y").collect()
    assert table[0]["model"] == "rf" and table[0]["test_r2"] > 0.8


def direct_bayesian_ridge(x, y, p):
    """Textbook iteration on the rows themselves."""
    xm, ym = x.mean(0), y.mean()
    x, y = x - xm, y - ym
    n = len(y)
    eig, v = np.linalg.eigh(x.T @ x)
    alpha, lam = 1 / (y.var() + np.finfo(float).eps), 1.0
    old = None
    for _ in range(p.max_iter):
        w = v @ ((v.T @ x.T @ y) / (eig + lam / alpha))
        gamma = np.sum(alpha * eig / (lam + alpha * eig))
        lam = (gamma + 2 * p.lambda_1) / (w @ w + 2 * p.lambda_2)
        alpha = (n - gamma + 2 * p.alpha_1) / (np.sum((y - x @ w) ** 2) + 2 * p.alpha_2)
        if old is not None and np.abs(old - w).sum() < p.tol:
            break
        old = w
    w = v @ ((v.T @ x.T @ y) / (eig + lam / alpha))
    return w, ym - xm @ w


def test_bayesian_ridge_equals_direct_iteration(linear_data):
    model = BayesianRidge(FEATURES, "y").fit(linear_data)
    rows = np.array(linear_data.select(*FEATURES, "y").collect())
    weights, intercept = direct_bayesian_ridge(rows[:, :4], rows[:, 4], BAYES)
    np.testing.assert_allclose(model.state["weights"], weights, rtol=1e-7, atol=1e-9)
    assert model.state["intercept"] == pytest.approx(intercept, rel=1e-9)
    few = BayesianRidge(FEATURES, "y", BayesianRidgeConfig(max_iter=1)).fit(linear_data)
    assert few.state["iterations"] == 1


def test_stack_learns_and_round_trips(spark, linear_data, tmp_path):
    model = StackedRegressor(FEATURES, "y", ["id"], SMALL, folds=3).fit(linear_data)
    out = model.transform(linear_data)
    assert out.select(F.corr("y", "prediction")).first()[0] > 0.9
    assert model.info() == {"base_learners": ["gbt_a", "gbt_b", "rf"], "meta_learner": "BayesianRidge", "n_features": 4}
    assert {"p_gbt_a", "p_gbt_b", "p_rf"} <= set(model.base_predictions(linear_data).columns)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = StackedModel.load(str(tmp_path / "m"))
    both = out.select("id", "prediction").join(again.transform(linear_data).select("id", F.col("prediction").alias("p")), "id")
    assert both.agg(F.max(F.abs(F.col("prediction") - F.col("p")))).first()[0] < 1e-9


def test_stack_cross_validation(linear_data):
    learners = [("rf", base_learner("rf", "y", SMALL["rf"]))]
    stack = StackedRegressor(FEATURES, "y", ["id"], folds=2, learners=learners)
    errors = cross_validate(linear_data, stack, ["id"], folds=2).collect()
    assert len(errors) == 2 and all(r["rmse"] > 0 for r in errors)


def test_grids_run_over_own_estimators(linear_data, tmp_path):
    rf = base_learner("rf", "y", SMALL["rf"])
    stack = StackedRegressor(FEATURES, "y", ["id"], folds=2, learners=[("rf", rf)])
    grid = ParamGridBuilder().addGrid(stack.numFolds, [2, 3]).addGrid(rf.maxDepth, [1, 4]).build()
    found = CrossValidator(estimator=stack, estimatorParamMaps=grid, evaluator=RegressionEvaluator(labelCol="y"), numFolds=2, seed=1).fit(linear_data)
    assert len(found.avgMetrics) == 4 and len(set(found.avgMetrics)) == 4
    assert max(m for m, g in zip(found.avgMetrics, grid) if g[rf.maxDepth] == 4) < min(m for m, g in zip(found.avgMetrics, grid) if g[rf.maxDepth] == 1)
    other = stack.copy({stack.numFolds: 4, rf.maxDepth: 2})
    assert (other.folds, other.learners[0][1].getMaxDepth(), stack.folds, rf.getMaxDepth()) == (4, 2, 2, 5)
    other.write().save(str(tmp_path / "stack"))
    again = StackedRegressor.load(str(tmp_path / "stack"))
    assert (again.folds, again.features, again.label, again.id_cols, again.uid) == (4, FEATURES, "y", ["id"], other.uid)
    assert again.learners[0][0] == "rf" and again.learners[0][1].getMaxDepth() == 2


def test_encoders_take_parameters(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"c{i % 4}", float(i % 4 + i % 3)) for i in range(120)], "id long, c string, y double")
    encoder = TargetEncoder("y", ["id"], ["c"])
    pipe = Pipeline(stages=[encoder, VectorAssembler(inputCols=["c_encoded"], outputCol="features"), LinearRegression(labelCol="y", fitIntercept=False)])
    grid = ParamGridBuilder().addGrid(encoder.smoothingWeight, [0.0, 500.0]).build()
    found = CrossValidator(estimator=pipe, estimatorParamMaps=grid, evaluator=RegressionEvaluator(labelCol="y"), numFolds=2, seed=1).fit(rows)
    assert found.avgMetrics[0] < found.avgMetrics[1]
    other = encoder.copy({encoder.smoothingWeight: 3.0, encoder.numFolds: 7})
    other.save(str(tmp_path / "encoder"))
    again = TargetEncoder.load(str(tmp_path / "encoder"))
    assert (again.smoothing, again.folds, again.columns, again.id_cols, again.label) == (3.0, 7, ["c"], ["id"], "y")
    assert encoder.smoothing == 10.0


TINY = {"rf": {"numTrees": Whole(2, 4), "maxDepth": Whole(2, 4)}}


def test_search_bounds():
    assert RandomSearch([], "y", []).n_trials == SEARCH.n_trials
    assert RandomSearch([], "y", [], quick=True).n_trials == SEARCH.n_trials_quick
    assert RandomSearch([], "y", [], n_trials=3, quick=True).n_trials == 3
    assert RandomSearch([], "y", []).timeout == SEARCH.timeout
    assert RandomSearch([], "y", [], timeout=0).timeout == 0


def test_search_is_reproducible_and_records_trials(spark, linear_data):
    def run():
        s = RandomSearch(FEATURES, "y", ["id"], n_trials=2, folds=2, spaces=TINY)
        return s.optimize(linear_data, "rf"), s

    (first, search), (second, _) = run(), run()
    assert first == second and len(search.trials) == 2
    row = search_summary(search.trial_table(spark)).first()
    assert row["n_trials"] == 2 and row["best_value"] == min(t[3] for t in search.trials) > 0


def test_time_bound_stops_the_study(linear_data):
    none = RandomSearch(FEATURES, "y", ["id"], n_trials=5, timeout=0, spaces=TINY)
    assert none.optimize(linear_data, "rf") == {} and none.trials == []
    some = RandomSearch(FEATURES, "y", ["id"], n_trials=100_000, timeout=1, folds=2, spaces=TINY)
    some.optimize(linear_data, "rf")
    assert 0 < len(some.trials) < 100_000


def test_bound_cuts_trees_and_then_folds(spark, linear_data):
    RandomSearch(FEATURES, "y", ["id"], n_trials=1, folds=2, spaces=TINY).optimize(linear_data, "rf")  # code is loaded before time counts
    began = time.monotonic()
    search = RandomSearch(FEATURES, "y", ["id"], quick=True, timeout=5)
    search.optimize(linear_data, "rf")
    assert time.monotonic() - began < 10 and 0 < len(search.results) <= 10
    assert all(t.trees < 200 and t.rmse > 0 for t in search.results)
    assert spark.sparkContext.getLocalProperty("spark.jobGroup.id") is None and linear_data.count() == 400


def test_boosted_trials_are_scored_at_every_number_of_trees(linear_data):
    space = {"gbt_b": {**SPACES["gbt_b"], "n_estimators": Whole(3, 4), "max_depth": Whole(2, 3), "min_child_weight": Whole(1, 4)}}
    search = RandomSearch(FEATURES, "y", ["id"], n_trials=2, folds=2, spaces=space)
    best = search.optimize(linear_data, "gbt_b")
    assert len(search.results) == 2 and all(t.folds == 2 and 1 <= t.trees == t.params["n_estimators"] <= 5 for t in search.results)
    assert {"num_leaves", "reg_alpha", "reg_lambda"} <= set(best)
    model = ColumnRegressor(base_learner("gbt_b", "y", best), FEATURES).fit(linear_data)
    stack = StackedRegressor(FEATURES, "y", ["id"], folds=2, learners=[("gbt_b", base_learner("gbt_b", "y", best))]).fit(linear_data)
    assert model.transform(linear_data).select("prediction").distinct().count() > 2 < stack.transform(linear_data).select("p_gbt_b").distinct().count()


def test_drawn_values_become_spark_parameters():
    params = spark_params({"maxDepth": 9, "num_leaves": 20, "featureSubsetStrategy": 0.75})
    assert params == {"maxDepth": 5, "featureSubsetStrategy": "0.750000"}
    assert SPACES["rf"]["maxDepth"].high == 30


@pytest.fixture(scope="module")
def houses(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(240):
        area, quality = float(rng.normal(1500, 400)), int(rng.integers(1, 11))
        rows.append((i, quality, None if i % 9 == 0 else area, int(rng.integers(2006, 2011)), str(rng.choice(["N1", "N2", "N3"])),
                     str(rng.choice(["Brick", "Wood"])), 50_000 + 60 * area + 9_000 * quality + float(rng.normal(0, 3000))))
    return spark.createDataFrame(
        rows, "id long, `Overall Qual` int, `Gr Liv Area` double, `Yr Sold` int, Neighborhood string, Exterior string, SalePrice double"
    ).persist()


@pytest.fixture(scope="module")
def trained(houses):
    return recipes.train(recipes.prepare_dataset(houses)[0], ["id"], params=SMALL, check_ids=True)


def test_training_recipe_explains_the_target(trained):
    row = recipes.evaluate(trained).first()
    assert row["test_metrics"]["R2"] > 0.5
    assert row["train_metrics"]["RMSE"] > 0


def test_saved_recipe_scores_new_rows_in_batch_and_stream(spark, trained, houses, tmp_path):
    path = recipes.save_model(trained, str(tmp_path / "model"))
    rows = recipes.prepare_dataset(houses)[0]
    batch = recipes.predict(spark, path, rows, ["id"], "SalePrice")
    assert batch.count() == 240 and batch.columns == ["id", "actual_price", "predicted_price", "error"]
    assert recipes.predict(spark, path, rows.drop("SalePrice"), ["id"]).count() == 240
    unknown = rows.withColumn("SalePrice", F.when(F.col("id") % 2 == 0, F.col("SalePrice")))
    open_ = recipes.predict(spark, path, unknown, ["id"], "SalePrice").where("actual_price IS NULL")
    assert open_.count() == open_.where("error IS NULL AND predicted_price IS NOT NULL").count() == unknown.where("id % 2 <> 0").count()
    with pytest.raises(FileNotFoundError):
        recipes.load_model(spark, str(tmp_path / "absent"))
    rows.write.parquet(str(tmp_path / "in"))
    stream = score_files(spark, str(tmp_path / "in"), rows.schema, recipes.load_model(spark, path), str(tmp_path / "out"),
                         str(tmp_path / "state"), ["id"], "SalePrice", max_files=1)
    stream.awaitTermination()
    streamed = spark.read.parquet(str(tmp_path / "out"))
    unknown.write.parquet(str(tmp_path / "in2"))
    score_files(spark, str(tmp_path / "in2"), rows.schema, recipes.load_model(spark, path), str(tmp_path / "out2"),
                str(tmp_path / "state2"), ["id"], "SalePrice").awaitTermination()
    late = spark.read.parquet(str(tmp_path / "out2")).where("actual_price IS NULL")
    assert late.count() == late.where("error IS NULL AND predicted_price IS NOT NULL").count() == open_.count()
    joined = streamed.join(batch.select("id", F.col("predicted_price").alias("p")), "id")
    assert joined.count() == 240
    assert joined.agg(F.max(F.abs(F.col("p") - F.col("predicted_price")))).first()[0] < 1e-6


def test_explain_and_validate(trained):
    explained = recipes.explain(trained, lime_rows=2, lime_samples=300)
    assert explained["importance"].count() == len(trained.features)
    assert {r["id"] for r in explained["lime"].select("id").distinct().collect()} == {
        r["id"] for r in trained.test.orderBy("id").limit(2).select("id").collect()
    }
    checks = recipes.validate(trained, explained["importance"], n_repeats=2)
    assert set(checks["residuals"]["tests"]) == {"shapiro_wilk", "breusch_pagan"}
    comparison = checks["permutation"]["comparison"].collect()
    assert comparison and all(r["permutation"] is not None and r["shap"] is not None for r in comparison)


def test_linear_regressor_recovers_the_slope(linear_data):
    model = linear_regressor(FEATURES, "y").fit(linear_data)
    assert model.stages[-1].coefficients[0] == pytest.approx(3, abs=0.05)


def test_trees_on_blocks_of_rows_are_trees_on_rows(spark):
    """Many rows in few bins: fits read a bounded count of them and find the same splits."""
    rows = spark.range(40_000).select(
        "id", (F.col("id") % 7).cast("double").alias("f0"), (F.col("id") % 11).cast("double").alias("f1"),
        (F.pow(F.col("id") % 7, 2) + F.col("id") % 11 * 5 + F.col("id") % 13 / 10).alias("y"))
    tree = DecisionTreeRegressor(labelCol="y", maxDepth=4, minInstancesPerNode=600)
    bins = blocks.fit_bins(rows, ["f0", "f1"], 32, "v")
    coded = bins.coded(rows, ["c0", "c1"]).withColumn("deal", F.lit(0))
    found = blocks.blocks_of(blocks.count_blocks(coded, ["c0", "c1"], "y", [], "deal"), ["c0", "c1"], "y", "v")
    assert (found.count(), found.agg(F.sum(blocks.WEIGHT)).first()[0]) == (77, 40_000)
    ours = blocks.on_blocks(tree, 40_000, featuresCol="v").fit(found).transform(bins.transform(rows))
    plain = ColumnRegressor(tree, ["f0", "f1"]).fit(rows).transform(rows).withColumnRenamed("prediction", "q")
    assert ours.join(plain, "id").agg(F.max(F.abs(F.col("prediction") - F.col("q")))).first()[0] < 1e-9


def test_meta_learner_reads_blocks_where_all_learners_are_trees(spark, linear_data, monkeypatch):
    """Moments of blocks are those of the rows behind them, so that held-out rows need not be scored one by one."""
    rows = linear_data.select("y", (F.col("id") % 3).cast("double").alias("c0")).unionByName(
        spark.createDataFrame([(None, 1.0), (float("nan"), 2.0)], "y double, c0 double"))
    counts = blocks.count_blocks(rows.withColumn("deal", F.lit(0)), ["c0"], "y", [], "deal")
    n, mean, cross = blocks.block_moments(counts.withColumn("p", F.col("c0") * 2 + 1), ["p"])
    m, expected, covariance = residuals.moments(rows.withColumn("p", F.col("c0") * 2 + 1), ["p", "y"])
    assert n == m == linear_data.count()
    np.testing.assert_allclose(mean, expected)
    np.testing.assert_allclose(cross, covariance * (n - 1))

    def refuse(*_):
        raise AssertionError("rows were read for the meta-learner")

    monkeypatch.setattr(BayesianRidge, "_fit", refuse)
    learners = [("a", DecisionTreeRegressor(labelCol="y", maxDepth=2)), ("b", DecisionTreeRegressor(labelCol="y", maxDepth=4))]
    model = StackedRegressor(FEATURES, "y", ["id"], folds=2, learners=learners).fit(linear_data)
    assert model.meta.state["n"] == linear_data.count()


def test_kernel_shap_query_builds_its_rows_once(spark, monkeypatch):
    """The fit and both samples read written rows, not the joins above the tables."""
    class Fit:
        def fit(self, rows):
            return rows

    class Seen(Exception):
        pass

    def sample(rows, *_):
        raise Seen(rows.inputFiles())

    monkeypatch.setattr(catalog_models, "stacked", Fit)
    monkeypatch.setattr(catalog_models, "background_sample", sample)
    with pytest.raises(Seen) as found:
        catalog_models.kernel_shap_importance(spark, "/root/testdata/sf0.001")
    assert found.value.args[0] == []


class Asked(Exception):
    """What a query asks for, raised before the work begins."""


def test_ensemble_performance_has_all_trees(spark, monkeypatch):
    def learners(df, id_cols, target, params=None, **options):
        raise Asked(dict(base_learners(target, params)))

    monkeypatch.setattr(catalog_models, "train", learners)
    monkeypatch.setattr(catalog_models, "valuation_frame", lambda *_: None)
    with pytest.raises(Asked) as asked:
        catalog_models.ensemble_performance(spark, "")
    found = asked.value.args[0]
    for name in ("gbt_a", "gbt_b"):
        assert found[name].getMaxIter() == getattr(LEARNERS, name)["maxIter"] == 1000
    assert found["rf"].getNumTrees() == LEARNERS.rf["numTrees"] == 500
    assert found["rf"].getMaxDepth() == LEARNERS.rf["maxDepth"]


def test_search_summary_has_all_trials(spark, monkeypatch):
    def studies(search, rows, learners):
        raise Asked(search, learners)

    monkeypatch.setattr(RandomSearch, "optimize_all", studies)
    with pytest.raises(Asked) as asked:
        catalog_models.best_trials(spark, "/root/testdata/sf0.001")
    search, learners = asked.value.args
    assert learners == ["gbt_a", "gbt_b"]
    assert search.n_trials == SEARCH.n_trials == 100
    assert search.spaces == SPACES and search.folds == 5
    assert search.timeout == math.inf


def test_a_study_without_a_time_bound_grows_every_tree(spark, linear_data):
    space = {"gbt_a": {"n_estimators": Whole(4, 4), "learning_rate": Whole(1, 1), "max_depth": Whole(2, 2)}}
    search = RandomSearch(FEATURES, "y", ["id"], n_trials=12, folds=2, spaces=space, timeout=math.inf)
    search.optimize(linear_data, "gbt_a")
    assert [(t.number, t.folds) for t in search.results] == [(n, 2) for n in range(12)]


def test_preparation_makes_its_rows_once(spark):
    """The search of the split, the fills, the trim and both parts read written rows."""
    made = spark.sparkContext.accumulator(0)

    def counted(parts):
        for part in parts:
            made.add(len(part))
            yield part

    rows = spark.range(60).selectExpr("id", "id * 1.5D as y", "IF(id % 7 = 0, NULL, id * 1.0D) as x", "CAST(id % 3 AS STRING) as t")
    train, test, _ = recipes.preprocess(rows.mapInPandas(counted, rows.schema), ["id"], "y")
    assert (train.count(), test.count()) == (48, 12)
    assert made.value == 60
    assert sorted(r["id"] for r in train.unionByName(test).collect()) == list(range(60))


def test_stored_rows_keep_names_types_and_values(spark):
    rows = spark.sql("SELECT 1 AS a, 'x' AS `A b`, CAST('NaN' AS DOUBLE) AS `a.c` UNION ALL SELECT NULL, NULL, -0.0D")
    rows = rows.select("a", F.col("A b").alias("A"), F.col("`a.c`"))  # names that differ by case, and one with a dot
    held = stored(rows)
    assert [(f.name, f.dataType) for f in held.schema] == [(f.name, f.dataType) for f in rows.schema]
    assert sorted(map(str, held.collect())) == sorted(map(str, rows.collect()))
    assert stored(spark.sql("SELECT 1 AS a, NULL AS b")).collect() == [(1, None)]  # no type that Parquet has
    assert held.inputFiles() and stored(rows.limit(0)).columns == rows.columns


def test_saved_model_scores_makes_its_frame_once(spark, monkeypatch):
    def seen(df, *_, **options):
        raise Asked(df.inputFiles(), options["held"])

    monkeypatch.setattr(catalog_models, "train", seen)
    with pytest.raises(Asked) as asked:
        catalog_models.saved_model_scores(spark, "/root/testdata/sf0.001")
    files, held = asked.value.args
    assert held and files and all("/stored-" in f for f in files)


def test_edges_of_many_features_are_those_of_each(spark):
    wide = spark.range(500).select(*[(F.xxhash64("id", F.lit(i)) % (10 if i % 2 else 300)).cast("double").alias(f"f{i}") for i in range(130)])
    names = wide.columns
    edges = blocks.fit_bins(wide, names, 32, "v").state["edges"]
    for i in (0, 1, 98, 99, 100, 101, 129):
        assert edges[i] == blocks.fit_bins(wide, [names[i]], 32, "v").state["edges"][0]
    empty = wide.withColumn("f0", F.lit(None).cast("double")).filter("f1 > 99")
    assert blocks.fit_bins(empty, ["f0", "f1"], 32, "v").state["edges"] == [[], []]
