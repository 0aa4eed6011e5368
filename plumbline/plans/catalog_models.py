"""Registered queries of the model layer.

Tree ensembles are iterative fits, checked by rows and by tests; their tree counts are small so that a check stays
short, but in `ensemble_performance` and `search_summary`, which have all trees; every query reads whole tables. The same operators over linear learners, a stump, and derived trials have
closed forms, and SQL.
"""

from __future__ import annotations

import math
import uuid

from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
from pyspark.sql import functions as F

from ..operators.learners import ColumnRegressor, base_learner, base_learners, evaluate_learners
from ..operators.lime import bin_profile, explain_first
from ..operators.metrics import cv_summary
from ..operators.search import RandomSearch, search_summary
from ..operators.shap import background_sample, shap_importance, shap_values, tree_shap
from ..operators.stacking import StackedModel, StackedRegressor, cross_validate
from ..session import checkpoint_folder, cut_lineage, stored
from .catalog import FEATURES, FRAME, LINEAR, linear_model, linear_sql, query, r, rounded
from .recipes import Trained, evaluate, load_model, preprocess, save_model, train
from .valuation import ID, TARGET, table, valuation_frame

SMALL = {
    "gbt_a": {"maxIter": 8, "stepSize": 0.3},
    "gbt_b": {"maxIter": 8, "stepSize": 0.3},
    "rf": {"numTrees": 8, "maxDepth": 8},
}
SEARCH_SECONDS = 75  # for the study of search_trials
INPUTS = ["n_lines", "avg_price", "sum_qty", "max_price"]


def model_rows(spark, sf_dir):
    return valuation_frame(spark, sf_dir).select(ID, TARGET, *INPUTS)


def stacked(parallelism: int = 4) -> StackedRegressor:
    return StackedRegressor(INPUTS, TARGET, [ID], SMALL, folds=5, parallelism=parallelism)


@query()
def base_learner_eval(spark, sf_dir):
    """Train and test error of each base learner."""
    fitted, held_out, _ = preprocess(model_rows(spark, sf_dir), [ID], TARGET)
    return evaluate_learners(fitted, held_out, base_learners(TARGET, SMALL), INPUTS, TARGET)


@query()
def stacked_predict(spark, sf_dir):
    rows = model_rows(spark, sf_dir)
    return stacked().fit(rows).transform(rows).select(ID, TARGET, "prediction")


@query()
def base_predictions(spark, sf_dir):
    rows = model_rows(spark, sf_dir)
    out = stacked().fit(rows).base_predictions(rows)
    return out.select(ID, "p_gbt_a", "p_gbt_b", "p_rf")


@query()
def stacked_cv(spark, sf_dir):
    """Cross-validated error of the whole ensemble over outer folds."""
    return cv_summary(cross_validate(model_rows(spark, sf_dir), stacked(), [ID]))


@query()
def search_trials(spark, sf_dir):
    """Seeded trials of the default space, each a cross-validation over the whole frame, with what trees the time allows."""
    search = RandomSearch(INPUTS, TARGET, [ID], quick=True, timeout=SEARCH_SECONDS)
    search.optimize(model_rows(spark, sf_dir), "rf")
    return search.trial_table(spark)


@query(name="search_summary")
def best_trials(spark, sf_dir):
    """The best of a hundred trials of each boosted learner, with all its penalties; no bound on their time."""
    search = RandomSearch(INPUTS, TARGET, [ID], timeout=math.inf)
    search.optimize_all(model_rows(spark, sf_dir), ["gbt_a", "gbt_b"])
    return search_summary(search.trial_table(spark))


@query()
def tree_shap_values(spark, sf_dir):
    """Exact contributions of a boosted model for every row of the frame."""
    rows = model_rows(spark, sf_dir)
    model = ColumnRegressor(base_learner("gbt_a", TARGET, SMALL["gbt_a"]), INPUTS, persist=True).fit(rows)
    return tree_shap(model, rows, INPUTS, [ID]).values


@query()
def kernel_shap_importance(spark, sf_dir):
    """Kernel method over the stacked model: sampled rows against a sampled background."""
    rows = cut_lineage(model_rows(spark, sf_dir))  # the fit and two samples read them, each sample three times
    model = stacked().fit(rows)
    background = background_sample(rows, [ID])
    return shap_importance(shap_values(model, rows, INPUTS, [ID], background, max_samples=100))


@query()
def lime_explanations(spark, sf_dir):
    rows = model_rows(spark, sf_dir)
    model = ColumnRegressor(base_learner("rf", TARGET, SMALL["rf"]), INPUTS, persist=True).fit(rows)
    return explain_first(model, rows, bin_profile(rows, INPUTS), INPUTS, [ID], TARGET, n=3)


def trained(frame, params: dict[str, dict] | None, held: bool = False) -> Trained:
    return train(
        frame, [ID], TARGET, params, held=held,
        interactions=[("n_lines", "avg_price")], high_cardinality=["n_name"],
    )


@query()
def ensemble_performance(spark, sf_dir):
    """Split, impute, encode, stack and report: the complete training recipe, with all trees of the default learners."""
    report = evaluate(trained(valuation_frame(spark, sf_dir), None))
    return report.select("model_name", "train_metrics.*", F.col("test_metrics.R2").alias("test_R2"),
                         F.col("test_metrics.RMSE").alias("test_RMSE"), "r2_gap", "overfit")


@query()
def saved_model_scores(spark, sf_dir):
    """A saved recipe scoring raw rows after loading: no training data is needed."""
    frame = stored(valuation_frame(spark, sf_dir))  # trained on and scored
    path = f"{checkpoint_folder(spark)}/model-{uuid.uuid4().hex}"
    save_model(trained(frame, SMALL, held=True), path)
    return load_model(spark, path).transform(frame).select(ID, "prediction")


# ---- the same operators where SQL has the result --------------------------------

STACKED_LINEAR = f"""WITH RECURSIVE {FRAME}, {linear_sql("vf", "lin")},
fm AS (SELECT f, avg(n_lines) AS m1, avg(avg_price) AS m2, avg(sale_price) AS my, var_pop(n_lines) AS v1, var_pop(avg_price) AS v2,
       covar_pop(n_lines, avg_price) AS c12, covar_pop(n_lines, sale_price) AS c1, covar_pop(avg_price, sale_price) AS c2
       FROM vf, range(5) g(f) WHERE o_orderkey % 5 <> f GROUP BY f),
fb AS (SELECT *, (c1 * v2 - c2 * c12) / (v1 * v2 - c12 * c12) AS b1, (c2 * v1 - c1 * c12) / (v1 * v2 - c12 * c12) AS b2 FROM fm),
held AS (SELECT sale_price AS y, my + b1 * (n_lines - m1) + b2 * (avg_price - m2) AS p FROM vf JOIN fb ON f = o_orderkey % 5),
g AS (SELECT count(*)::DOUBLE AS n, avg(p) AS mp, avg(y) AS my, var_pop(p) * count(*) AS g11, covar_pop(p, y) * count(*) AS s1,
      var_pop(y) * count(*) AS yy FROM held),
it AS (SELECT 0 AS i, n / yy AS alpha, 1.0::DOUBLE AS lam, NULL::DOUBLE AS before, FALSE AS done FROM g
  UNION ALL
  SELECT i + 1, (n - gamma + 2e-6) / (greatest(yy - 2 * w * s1 + w * w * g11, 0) + 2e-6), (gamma + 2e-6) / (w * w + 2e-6), w,
         before IS NOT NULL AND abs(w - before) < 1e-3
  FROM (SELECT it.*, g.*, s1 / (g11 + lam / alpha) AS w, alpha * g11 / (lam + alpha * g11) AS gamma FROM it, g WHERE NOT done AND i < 300)),
z AS (SELECT s1 / (g11 + lam / alpha) AS w, mp, my FROM it, g WHERE i = (SELECT max(i) FROM it)),
st AS (SELECT o_orderkey, b0 + b1 * n_lines + b2 * avg_price AS p FROM vf, lin)
SELECT o_orderkey, {r("p", 1)} AS p_linear, {r("my + w * (p - mp)", 1)} AS prediction FROM st, z"""


def stacked_linear_model(frame) -> StackedModel:
    learner = LinearRegression(labelCol=TARGET)
    return StackedRegressor(FEATURES, TARGET, [ID], learners=[("linear", learner)], folds=5, fold_key=F.col(ID)).fit(frame)


@query(STACKED_LINEAR)
def stacked_linear(spark, sf_dir):
    """Out-of-fold predictions of a linear learner, the meta-learner on them, and the learner fitted again."""
    frame = valuation_frame(spark, sf_dir).select(ID, TARGET, *FEATURES)
    return rounded(stacked_linear_model(frame).transform(frame).select(ID, "p_linear", "prediction"), p_linear=1, prediction=1)


@query(STACKED_LINEAR)
def stacked_linear_saved(spark, sf_dir):
    """The same ensemble after saving and loading."""
    frame = valuation_frame(spark, sf_dir).select(ID, TARGET, *FEATURES)
    path = f"{checkpoint_folder(spark)}/stack-{uuid.uuid4().hex}"
    stacked_linear_model(frame).write().save(path)
    return rounded(StackedModel.load(path).transform(frame).select(ID, "p_linear", "prediction"), p_linear=1, prediction=1)


@query(f"""WITH {FRAME}, b AS (SELECT o_orderkey, sale_price, (n_lines > 3)::INT::DOUBLE AS big FROM vf)
SELECT o_orderkey, 'big' AS feature, big AS feature_value,
       {r("avg(sale_price) OVER (PARTITION BY big) - avg(sale_price) OVER ()", 2)} AS shap_value FROM b""")
def tree_shap_stump(spark, sf_dir):
    """A tree of one split on a two-valued feature: each side's mean against the mean of all."""
    rows = valuation_frame(spark, sf_dir).select(ID, TARGET, (F.col("n_lines") > 3).cast("double").alias("big"))
    model = ColumnRegressor(DecisionTreeRegressor(labelCol=TARGET, maxDepth=1), ["big"], persist=True).fit(rows)
    return rounded(tree_shap(model, rows, ["big"], [ID]).values, shap_value=2)


@query("""WITH t AS (SELECT l_returnflag AS model, l_linenumber AS trial, 'd' || l_linenumber AS params,
       round(sqrt(avg(l_discount * l_discount)), 6) AS rmse FROM lineitem GROUP BY 1, 2)
SELECT model, min(rmse) AS best_value, (SELECT u.params FROM t u WHERE u.model = t.model ORDER BY u.rmse, u.trial LIMIT 1) AS best_params,
       count(*) AS n_trials FROM t GROUP BY model""")
def search_summary_trials(spark, sf_dir):
    """Best trial of each model among trials derived from the lines."""
    lines = table(spark, sf_dir, "lineitem")
    error = F.round(F.sqrt(F.avg(F.col("l_discount") * F.col("l_discount"))), 6)
    trials = lines.groupBy(F.col("l_returnflag").alias("model"), F.col("l_linenumber").alias("trial")).agg(error.alias("rmse"))
    return search_summary(trials.withColumn("params", F.concat(F.lit("d"), F.col("trial").cast("string"))))


@query(LINEAR + f"""SELECT o_orderkey, {r("prediction", 1)} AS prediction, {r("sale_price", 6)} AS actual
FROM sc ORDER BY o_orderkey LIMIT 3""")
def lime_predictions(spark, sf_dir):
    """What the explanations of the first three rows say about the model and the truth."""
    frame = valuation_frame(spark, sf_dir).select(ID, TARGET, *FEATURES)
    found = explain_first(linear_model(frame), frame, bin_profile(frame, FEATURES), FEATURES, [ID], TARGET, n=3)
    return rounded(found.select(ID, "prediction", "actual").distinct(), prediction=1, actual=6)
