"""Registered queries over the benchmark tables, each beside the SQL of the same result.

Row order keys here are integer arithmetic on the row id, so that SQL can draw the
same folds and samples; the library's own default is a seeded hash. Permutations use
the library's own rule.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import numeric
from ..functions.lookups import settle
from ..operators import cleaning, encoders, impute, metrics, outliers, permutation, residuals, splits, transforms
from ..operators.features import FeatureStages
from ..operators.learners import linear_regressor
from ..operators.lime import bin_profile, compare_predictions
from ..operators.permutation import (
    compare_importance,
    importance_from_errors,
    low_importance,
    permuted_errors,
    top_features,
)
from ..operators.bayes_ridge import BayesianRidge, sufficient_statistics
from ..operators.shap import (
    ShapValues,
    base_value,
    kernel_shap,
    shap_dependence,
    shap_force,
    shap_importance,
    shap_summary,
)
from ..session import checkpoint_folder
from ..sources.readers import read_delimited
from ..sources.sinks import prediction_table, write_delimited
from ..streaming.score import score_files
from .recipes import prepare_dataset, preprocess
from .valuation import ID, NUMERIC, TARGET, TEXT, table, valuation_frame

FEATURES = ["n_lines", "avg_price"]
QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def keep(f):
        QUERIES[name or f.__name__] = f
        if sql is not None:
            SQL[name or f.__name__] = sql
        return f

    return keep


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), d) for c, d in digits.items()})


def order_key(name: str = ID, seed: int = 42):
    return [F.pmod(F.col(name) * 7919 + seed, F.lit(100003)), F.col(name)]


def fold_key(name: str = ID):
    return F.col(name)




def r(expr: str, digits: int) -> str:
    """SQL rounding without a negative zero."""
    return f"(round({expr}, {digits}) + 0.0)"


# ---- shared SQL -------------------------------------------------------------------

FRAME = """
lt AS (SELECT l_orderkey AS o_orderkey,
              sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)) AS sale_price, count(*) AS n_lines,
              sum(l_quantity) AS sum_qty, avg(l_extendedprice) AS avg_price,
              max(l_extendedprice) AS max_price, avg(l_discount) AS avg_disc
       FROM lineitem GROUP BY l_orderkey),
vf AS (SELECT o_orderkey, sale_price, n_lines, sum_qty, avg_price, max_price,
              CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE avg_disc END AS avg_disc,
              n_name, c_mktsegment, o_orderpriority, o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS yr_sold
       FROM orders JOIN lt USING (o_orderkey) JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey)"""


def linear_sql(source: str, name: str, x1: str = "n_lines", x2: str = "avg_price", y: str = "sale_price") -> str:
    """Least squares of y on two columns, from covariances."""
    return f"""
{name}_m AS (SELECT avg({x1}) AS m1, avg({x2}) AS m2, avg({y}) AS my,
                    covar_pop({x1}, {x1}) AS v1, covar_pop({x2}, {x2}) AS v2, covar_pop({x1}, {x2}) AS c12,
                    covar_pop({x1}, {y}) AS c1, covar_pop({x2}, {y}) AS c2 FROM {source}),
{name}_b AS (SELECT *, (c1 * v2 - c2 * c12) / (v1 * v2 - c12 * c12) AS b1,
                    (c2 * v1 - c1 * c12) / (v1 * v2 - c12 * c12) AS b2 FROM {name}_m),
{name} AS (SELECT b1, b2, my - b1 * m1 - b2 * m2 AS b0 FROM {name}_b)"""


LINEAR = f"""WITH {FRAME}, {linear_sql("vf", "lin")},
sc AS (SELECT vf.*, b0 + b1 * n_lines + b2 * avg_price AS prediction,
              sale_price - (b0 + b1 * n_lines + b2 * avg_price) AS residual FROM vf, lin)
"""
ORDERED = "(o_orderkey * 7919 + 42) % 100003"


def linear_model(frame: DataFrame):
    return linear_regressor(FEATURES, TARGET, persist=True).fit(frame)


def linear_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(model, rows with prediction and residual) of the two-feature linear model."""
    frame = valuation_frame(spark, sf_dir)
    model = linear_model(frame.select(TARGET, *FEATURES))
    return model, residuals.with_residual(model.transform(frame).drop("features"), TARGET)


def sql_normal_quantile(p: str) -> str:
    """The same rational approximations as the Column form."""

    def poly(coefficients, x):
        text = repr(coefficients[-1])
        for c in reversed(coefficients[:-1]):
            text = f"({text} * {x} + {c!r})"
        return text

    q, tail = f"({p} - 0.5)", f"sqrt(-ln(least({p}, 1 - {p})))"
    c = f"(0.180625 - {q} * {q})"
    near, far = f"({tail} - 1.6)", f"({tail} - 5.0)"
    n = numeric
    return (
        f"CASE WHEN abs({q}) <= 0.425 THEN {q} * {poly(n.CENTRAL_NUM, c)} / {poly(n.CENTRAL_DEN, c)} "
        f"WHEN {tail} <= 5.0 THEN sign({q}) * {poly(n.NEAR_NUM, near)} / {poly(n.NEAR_DEN, near)} "
        f"ELSE sign({q}) * {poly(n.FAR_NUM, far)} / {poly(n.FAR_DEN, far)} END"
    )


# ---- sources and sinks ------------------------------------------------------------


@query("SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size, p_retailprice FROM part")
def delimited_scan(spark, sf_dir):
    """The part table written as tab-separated text and scanned back with inferred types."""
    path = f"{checkpoint_folder(spark)}/delimited-{uuid.uuid4().hex}"
    write_delimited(table(spark, sf_dir, "part"), path, sep="\t")
    return read_delimited(spark, path)


@query(LINEAR + f"""SELECT o_orderkey, {r("sale_price", 6)} AS actual_price, {r("prediction", 1)} AS predicted_price,
       {r("-residual", 1)} AS error FROM sc""")
def predictions_with_error(spark, sf_dir):
    _, scored = linear_rows(spark, sf_dir)
    return rounded(prediction_table(scored, [ID], TARGET), actual_price=6, predicted_price=1, error=1)


@query(f"""WITH {FRAME} SELECT count(*) AS n_rows, 15 AS n_columns, 11 AS n_numeric, 4 AS n_categorical,
       CAST(sum(CASE WHEN avg_disc IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_values,
       round(avg(sale_price), 4) AS target_mean, round(median(sale_price), 6) AS target_median,
       round(stddev_samp(sale_price), 4) AS target_std FROM vf""", name="prepare_dataset")
def prepared_summary(spark, sf_dir):
    """Clean, add macro columns, summarise: the composed preparation step."""
    frame = valuation_frame(spark, sf_dir)
    _, summary = prepare_dataset(frame, TARGET, "yr_sold", identifiers=[ID, "PID"])
    return rounded(summary, target_mean=4, target_median=6, target_std=4)


# ---- projections and filters ------------------------------------------------------


@query("SELECT p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def initial_cleaning(spark, sf_dir):
    return cleaning.drop_identifiers(table(spark, sf_dir, "part"), ["p_partkey", "PID"])


@query(f"""WITH {FRAME} SELECT o_orderkey, yr_sold, 6.5 AS "Mortgage_Rate_30yr", 320.0 AS "CPI",
       CAST(2026 - yr_sold AS INTEGER) AS "Years_Since_Sale",
       round((320.0 / 230.0) * (4.0 / 6.5), 6) AS "Market_Adjustment_Factor" FROM vf""".replace(
    '6.5 AS "Mort', 'CAST(6.5 AS DOUBLE) AS "Mort').replace('320.0 AS "CPI"', 'CAST(320 AS DOUBLE) AS "CPI"')
    .replace("round((320.0 / 230.0) * (4.0 / 6.5), 6)", "round((320.0::DOUBLE / 230.0) * (4.0::DOUBLE / 6.5), 6)"))
def macro_features(spark, sf_dir):
    frame = valuation_frame(spark, sf_dir).select(ID, "yr_sold")
    return rounded(cleaning.add_macro_features(frame, year_sold="yr_sold"), Market_Adjustment_Factor=6)


@query(f"""WITH {FRAME} SELECT o_orderkey, n_lines, sum_qty, {r("avg_price", 5)} AS avg_price, max_price,
       {r("avg_disc", 7)} AS avg_disc, n_name, c_mktsegment, o_orderpriority, o_orderstatus, yr_sold FROM vf""")
def features_target(spark, sf_dir):
    features, _ = cleaning.split_features_target(valuation_frame(spark, sf_dir), TARGET)
    return rounded(features, avg_price=5, avg_disc=7)


@query(f"""WITH {FRAME} SELECT o_orderkey, {r("n_lines * avg_price", 4)} AS n_lines_x_avg_price,
       {r("sum_qty * max_price", 4)} AS sum_qty_x_max_price FROM vf""")
def interaction_terms(spark, sf_dir):
    pairs = [("n_lines", "avg_price"), ("sum_qty", "max_price"), ("n_lines", "absent")]
    out = transforms.InteractionTerms(pairs).transform(valuation_frame(spark, sf_dir))
    out = out.select(ID, "n_lines_x_avg_price", "sum_qty_x_max_price")
    return rounded(out, n_lines_x_avg_price=4, sum_qty_x_max_price=4)


@query(f"""WITH {FRAME} SELECT o_orderkey, n_lines, CAST(0 AS DOUBLE) AS absent_feature, sum_qty FROM vf""")
def align_schema(spark, sf_dir):
    frame = valuation_frame(spark, sf_dir)
    return transforms.AlignSchema(["n_lines", "absent_feature", "sum_qty"], [ID]).transform(frame)


@query(LINEAR + f"SELECT o_orderkey, {r('residual', 1)} AS residual FROM sc", name="residuals")
def residual_rows(spark, sf_dir):
    return rounded(linear_rows(spark, sf_dir)[1].select(ID, "residual"), residual=1)


@query(LINEAR + f"""SELECT o_orderkey, {r("residual / s", 4)} AS std_residual
       FROM sc, (SELECT stddev_pop(residual) AS s FROM sc)""")
def standardized_residuals(spark, sf_dir):
    scored = linear_rows(spark, sf_dir)[1]
    return rounded(residuals.standardized_residuals(scored).select(ID, "std_residual"), std_residual=4)


@query("""WITH q AS (SELECT quantile_cont(value, 0.25) AS a1, quantile_cont(value, 0.75) AS a3,
       quantile_cont(user_id, 0.25) AS b1, quantile_cont(user_id, 0.75) AS b3 FROM events)
SELECT event_id, value < a1 - 1.5 * (a3 - a1) OR value > a3 + 1.5 * (a3 - a1)
       OR user_id < b1 - 1.5 * (b3 - b1) OR user_id > b3 + 1.5 * (b3 - b1) AS is_outlier FROM events, q""")
def outlier_mask_iqr(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    columns = ["value", "user_id", "event_type", "absent"]
    return outliers.outlier_mask(events, columns).select("event_id", "is_outlier")


@query("""WITH q AS (SELECT quantile_cont(value, 0.25) AS a1, quantile_cont(value, 0.75) AS a3 FROM events)
SELECT event_id, value FROM events, q
WHERE NOT (value < a1 - 3 * (a3 - a1) OR value > a3 + 3 * (a3 - a1))""")
def remove_extreme_outliers(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "value")
    return outliers.remove_extreme_outliers(events, "value")


@query(f"""WITH {FRAME} SELECT o_orderkey, {r("coalesce(avg_disc, (SELECT median(avg_disc) FROM vf))", 7)} AS avg_disc,
       coalesce(CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE c_mktsegment END,
                (SELECT c_mktsegment FROM vf WHERE o_orderkey % 11 <> 0 GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1))
       AS c_mktsegment FROM vf""")
def impute_apply(spark, sf_dir):
    frame = with_text_gaps(spark, sf_dir)
    return rounded(impute.MissingValueImputer().fit(frame).transform(frame), avg_disc=7)


def with_text_gaps(spark, sf_dir):
    gap = F.when(F.col(ID) % 11 != 0, F.col("c_mktsegment")).alias("c_mktsegment")
    return valuation_frame(spark, sf_dir).select(ID, "avg_disc", gap)


@query("SELECT event_id, " + r("(pow(1 + value, 0.15) - 1) / 0.15", 4) + " AS value FROM events")
def boxcox_apply(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "value")
    model = transforms.BoxCox(columns=["value"]).fit(events)
    return rounded(model.transform(events), value=4)


@query(f"""WITH {FRAME} SELECT o_orderkey, n_lines, yr_sold, CAST(2026 - yr_sold AS INTEGER) AS "Years_Since_Sale" FROM vf""")
def drop_constant_features(spark, sf_dir):
    frame = valuation_frame(spark, sf_dir).select(ID, "n_lines", "yr_sold")
    return transforms.drop_constant_features(cleaning.add_macro_features(frame, year_sold="yr_sold"), [ID])


@query(f"""SELECT p_partkey, {r("(p_retailprice - lo) / (hi - lo)", 5)} AS score
       FROM part, (SELECT min(p_retailprice) AS lo, max(p_retailprice) AS hi FROM part)""")
def minmax_normalize(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    return rounded(metrics.minmax_normalize(part, "p_retailprice", "score").drop("p_retailprice"), score=5)


@query(LINEAR + f"""SELECT o_orderkey, {r("prediction - 1.959963984540054 * s", 1)} AS lower,
       {r("prediction + 1.959963984540054 * s", 1)} AS upper
       FROM sc, (SELECT stddev_pop(residual) AS s FROM sc)""")
def prediction_interval_normal(spark, sf_dir):
    scored = linear_rows(spark, sf_dir)[1]
    out = metrics.prediction_intervals(scored, scored).select(ID, "lower", "upper")
    return rounded(out, lower=1, upper=1)


@query(LINEAR + f"""SELECT o_orderkey, {r("prediction + q1", 1)} AS lower, {r("prediction + q2", 1)} AS upper
       FROM sc, (SELECT quantile_cont(residual, 0.05) AS q1, quantile_cont(residual, 0.95) AS q2 FROM sc)""")
def prediction_interval_empirical(spark, sf_dir):
    scored = linear_rows(spark, sf_dir)[1]
    out = metrics.prediction_intervals(scored, scored, confidence=0.9, method="empirical")
    return rounded(out.select(ID, "lower", "upper"), lower=1, upper=1)


# ---- joins and encodings ----------------------------------------------------------

ENCODED = """
tr AS (SELECT *, CAST(o_custkey AS VARCHAR) AS cust FROM orders WHERE o_orderkey % 5 <> 0),
pr AS (SELECT avg(o_totalprice) AS prior FROM tr),
e1 AS (SELECT cust AS category, count(*) AS n, (sum(o_totalprice) + 10 * any_value(prior)) / (count(*) + 10) AS enc
       FROM tr, pr GROUP BY cust),
e2 AS (SELECT o_orderpriority AS category, count(*) AS n,
       (sum(o_totalprice) + 10 * any_value(prior)) / (count(*) + 10) AS enc FROM tr, pr GROUP BY o_orderpriority)"""


def order_encoder():
    return encoders.TargetEncoder("o_totalprice", [ID], ["o_custkey", "o_orderpriority"], fold_key=fold_key())


def training_orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").filter(F.col(ID) % 5 != 0)


@query(f"""WITH {ENCODED} SELECT 'o_custkey' AS feature, category, n, {r("enc", 3)} AS encoding FROM e1
UNION ALL SELECT 'o_orderpriority', category, n, {r("enc", 3)} FROM e2""")
def target_encode_fit(spark, sf_dir):
    model = order_encoder().fit(training_orders(spark, sf_dir))
    return rounded(model.encodings.select("feature", "category", "n", "encoding"), encoding=3)


@query(f"""WITH {ENCODED} SELECT o_orderkey, {r("coalesce(e1.enc, prior)", 3)} AS o_custkey_encoded,
       {r("coalesce(e2.enc, prior)", 3)} AS o_orderpriority_encoded
FROM orders CROSS JOIN pr LEFT JOIN e1 ON e1.category = CAST(o_custkey AS VARCHAR)
LEFT JOIN e2 ON e2.category = o_orderpriority""")
def target_encode_transform(spark, sf_dir):
    """Fitted on four fifths of the orders, applied to all: some customers are unseen."""
    model = order_encoder().fit(training_orders(spark, sf_dir))
    rows = table(spark, sf_dir, "orders").select(ID, "o_custkey", "o_orderpriority")
    return rounded(model.transform(rows), o_custkey_encoded=3, o_orderpriority_encoded=3)


OOF = """
SELECT o_orderkey, (round(coalesce((a.s - f.s + 10 * p.prior) / (a.n - f.n + 10), p.prior), 3) + 0.0) AS {c}_encoded
FROM vf JOIN p ON p.fold = o_orderkey % 5
LEFT JOIN (SELECT {c}, o_orderkey % 5 AS fold, sum(sale_price) AS s, count(*) AS n FROM vf GROUP BY 1, 2) f
  ON f.{c} = vf.{c} AND f.fold = vf.o_orderkey % 5
LEFT JOIN (SELECT {c}, sum(sale_price) AS s, count(*) AS n FROM vf GROUP BY 1) a ON a.{c} = vf.{c} AND a.n > f.n"""
PRIORS = """p AS (SELECT fold, (t.s - f.s) / (t.n - f.n) AS prior FROM
  (SELECT o_orderkey % 5 AS fold, sum(sale_price) AS s, count(*) AS n FROM vf GROUP BY 1) f,
  (SELECT sum(sale_price) AS s, count(*) AS n FROM vf) t)"""


@query(f"""WITH {FRAME}, {PRIORS}, x1 AS ({OOF.format(c="n_name")}), x2 AS ({OOF.format(c="c_mktsegment")})
SELECT * FROM x1 JOIN x2 USING (o_orderkey)""")
def target_encode_oof(spark, sf_dir):
    """Out-of-fold encoding: one partially aggregated shuffle, then total minus own fold."""
    frame = valuation_frame(spark, sf_dir).select(ID, TARGET, "n_name", "c_mktsegment")
    encoder = encoders.TargetEncoder(TARGET, [ID], ["n_name", "c_mktsegment"], fold_key=fold_key())
    _, out = encoder.fit_transform(frame)
    return rounded(out.drop(TARGET), n_name_encoded=3, c_mktsegment_encoded=3)


LABELS = """
tr AS (SELECT * FROM part WHERE p_partkey % 5 <> 0),
cnt AS (SELECT 'p_name' AS feature, p_name AS value, count(*) AS n FROM tr GROUP BY p_name
        UNION ALL SELECT 'p_type', p_type, count(*) FROM tr GROUP BY p_type
        UNION ALL SELECT 'price_text', price_text, count(*) FROM
          (SELECT CAST(p_size AS VARCHAR) || '/' || CAST(p_partkey % 97 AS VARCHAR) AS price_text FROM tr) GROUP BY 2),
codes AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY value) - 1 AS code FROM cnt),
modal AS (SELECT feature, code FROM codes QUALIFY row_number() OVER (PARTITION BY feature ORDER BY n DESC, value) = 1),
px AS (SELECT *, CAST(p_size AS VARCHAR) || '/' || CAST(p_partkey % 97 AS VARCHAR) AS price_text FROM part)"""


def labelled_parts(spark, sf_dir):
    text = F.concat_ws("/", F.col("p_size").cast("string"), (F.col("p_partkey") % 97).cast("string"))
    return table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", text.alias("price_text"))


def fitted_labels(spark, sf_dir):
    rows = labelled_parts(spark, sf_dir)
    return encoders.LabelEncoder(id_cols=["p_partkey"]).fit(rows.filter(F.col("p_partkey") % 5 != 0)), rows


@query(f"WITH {LABELS} SELECT feature, value, n, code FROM codes")
def label_encode_fit(spark, sf_dir):
    return fitted_labels(spark, sf_dir)[0].codes


@query(f"""WITH {LABELS} SELECT p_partkey, coalesce(a.code, (SELECT code FROM modal WHERE feature = 'p_name')) AS p_name,
       coalesce(b.code, (SELECT code FROM modal WHERE feature = 'p_type')) AS p_type,
       coalesce(c.code, (SELECT code FROM modal WHERE feature = 'price_text')) AS price_text
FROM px LEFT JOIN codes a ON a.feature = 'p_name' AND a.value = p_name
LEFT JOIN codes b ON b.feature = 'p_type' AND b.value = p_type
LEFT JOIN codes c ON c.feature = 'price_text' AND c.value = px.price_text""")
def label_encode_transform(spark, sf_dir):
    """Values unseen in training get the modal code."""
    model, rows = fitted_labels(spark, sf_dir)
    return model.transform(rows)


@query(f"""WITH {LABELS} SELECT 'price_text' AS feature, price_text AS value, count(*) AS n FROM px
WHERE price_text NOT IN (SELECT value FROM codes WHERE feature = 'price_text') GROUP BY price_text
UNION ALL SELECT 'p_name', p_name, count(*) FROM px WHERE p_name NOT IN
  (SELECT value FROM codes WHERE feature = 'p_name') GROUP BY p_name
UNION ALL SELECT 'p_type', p_type, count(*) FROM px WHERE p_type NOT IN
  (SELECT value FROM codes WHERE feature = 'p_type') GROUP BY p_type""")
def unseen_categories(spark, sf_dir):
    model, rows = fitted_labels(spark, sf_dir)
    return model.unseen(rows)


# ---- aggregations -----------------------------------------------------------------

FRAME_COLUMNS = [ID, TARGET, *NUMERIC, *TEXT]


@query(f"WITH {FRAME}, c AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing FROM vf" for c in FRAME_COLUMNS
) + ") SELECT column_name, missing, CAST(sum(missing) OVER () AS BIGINT) AS total_missing FROM c")
def missing_counts(spark, sf_dir):
    return cleaning.missing_counts(valuation_frame(spark, sf_dir))


@query("""SELECT count(*) AS n_rows, 6 AS n_columns, 3 AS n_numeric, 2 AS n_categorical,
       CAST(0 AS BIGINT) AS missing_values, round(avg(value), 6) AS target_mean,
       round(median(value), 4) AS target_median, round(stddev_samp(value), 6) AS target_std FROM events""")
def data_summary(spark, sf_dir):
    out = cleaning.data_summary(table(spark, sf_dir, "events"), "value")
    return rounded(out, target_mean=6, target_median=4, target_std=6)


@query(f"WITH {FRAME} " + " UNION ALL ".join(
    [f"SELECT '{c}' AS feature, round(CAST(median({c}) AS DOUBLE), 6) AS numeric_fill, CAST(NULL AS VARCHAR) AS text_fill FROM vf"
     for c in [TARGET, *NUMERIC]]
    + [f"SELECT '{c}', NULL, (SELECT {c} FROM vf GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)" for c in TEXT]))
def impute_median_mode(spark, sf_dir):
    model = impute.MissingValueImputer(exclude=[ID]).fit(valuation_frame(spark, sf_dir))
    return rounded(model.fill_table(spark), numeric_fill=6)


PROFILED = [("events", "value"), ("events", "user_id"), ("customer", "c_acctbal"), ("part", "p_size"), ("part", "p_retailprice")]


def _profile_sql(extra: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, {r(f"avg(pow({c} - m, 3)) / pow(avg(pow({c} - m, 2)), 1.5)", 6)} AS skewness,
        CAST(min({c}) AS DOUBLE) AS minimum, min({c}) = max({c}) AS is_constant {extra.format(c=c)}
        FROM {t}, (SELECT avg({c}) AS m FROM {t})""" for t, c in PROFILED
    )


def profiles(spark, sf_dir):
    frames = [
        transforms.column_profile(table(spark, sf_dir, t), [c for s, c in PROFILED if s == t])
        for t in ("events", "customer", "part")
    ]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query(_profile_sql(""))
def skewness_profile(spark, sf_dir):
    return rounded(profiles(spark, sf_dir), skewness=6)


_SKEW = "abs(avg(pow({c} - m, 3)) / pow(avg(pow({c} - m, 2)), 1.5)) > 0.75"


@query(_profile_sql(f", {_SKEW} AS is_skewed, {_SKEW} AND min({{c}}) > -1 AS selected"))
def boxcox_select(spark, sf_dir):
    return rounded(transforms.boxcox_selection(profiles(spark, sf_dir)), skewness=6)


@query(f"WITH {FRAME} " + " UNION ALL ".join(
    [f"SELECT '{c}' AS feature, (SELECT count(DISTINCT {c}) + CAST(count(*) > count({c}) AS INTEGER) <= 1 FROM vf) AS is_constant"
     for c in [*NUMERIC, *TEXT]]
    + [f"SELECT '{c}', TRUE" for c in ("Mortgage_Rate_30yr", "CPI", "Market_Adjustment_Factor")]
    + ["SELECT 'Years_Since_Sale', FALSE"]))
def constant_features(spark, sf_dir):
    frame = cleaning.add_macro_features(valuation_frame(spark, sf_dir).drop(ID, TARGET), year_sold="yr_sold")
    return transforms.constant_features(frame)


def _metric_sql(where: str = "") -> str:
    return f"""SELECT sqrt(avg(residual * residual)) AS "RMSE", avg(abs(residual)) AS "MAE",
       1 - sum(residual * residual) / (var_pop(sale_price) * count(*)) AS "R2",
       avg(CASE WHEN sale_price <> 0 THEN abs(residual / sale_price) END) * 100 AS "MAPE",
       max(abs(residual)) AS "Max_Error" FROM sc {where}"""


@query(LINEAR + f""", m AS ({_metric_sql()}) SELECT round("RMSE", 3) AS "RMSE", round("MAE", 3) AS "MAE",
       round("R2", 8) AS "R2", round("MAPE", 5) AS "MAPE", round("Max_Error", 3) AS "Max_Error" FROM m""")
def regression_metrics(spark, sf_dir):
    out = metrics.regression_metrics(linear_rows(spark, sf_dir)[1], TARGET)
    return rounded(out, RMSE=3, MAE=3, R2=8, MAPE=5, Max_Error=3)


@query(LINEAR + f""", a AS ({_metric_sql("WHERE o_orderkey % 5 <> 0")}), b AS ({_metric_sql("WHERE o_orderkey % 5 = 0")})
SELECT 'linear' AS model_name, """ + ", ".join(
    f'round({t}."{m}", {d}) AS {s}_{m.lower()}' for t, s in (("a", "train"), ("b", "test"))
    for m, d in (("RMSE", 3), ("MAE", 3), ("R2", 8), ("MAPE", 5), ("Max_Error", 3))
) + """, (round(a."R2" - b."R2", 8) + 0.0) AS r2_gap, a."R2" - b."R2" > 0.1 AS overfit FROM a, b""")
def performance_report(spark, sf_dir):
    scored = splits.assign_folds(linear_rows(spark, sf_dir)[1], [ID], key=fold_key())
    marked = scored.withColumn("split", F.when(F.col("fold") == 0, "test").otherwise("train"))
    report = metrics.performance_report(marked, TARGET, model_name="linear")
    digits = {"RMSE": 3, "MAE": 3, "R2": 8, "MAPE": 5, "Max_Error": 3}
    parts = [
        F.round(F.col(f"{s}_metrics.{m}"), d).alias(f"{s}_{m.lower()}")
        for s in ("train", "test") for m, d in digits.items()
    ]
    return report.select("model_name", *parts, F.round("r2_gap", 8).alias("r2_gap"), "overfit")


@query(LINEAR + """SELECT round(avg(residual), 3) + 0.0 AS mean_residual, round(stddev_pop(residual), 3) AS std_residual,
       round(min(residual), 3) AS min_residual, round(max(residual), 3) AS max_residual,
       round(avg(pow(residual, 3)) / pow(avg(pow(residual, 2)), 1.5), 5) + 0.0 AS skewness,
       round(avg(pow(residual, 4)) / pow(avg(pow(residual, 2)), 2) - 3, 5) + 0.0 AS kurtosis FROM sc""")
def residual_summary(spark, sf_dir):
    out = residuals.residual_summary(linear_rows(spark, sf_dir)[1])
    return rounded(out, mean_residual=3, std_residual=3, min_residual=3, max_residual=3, skewness=5, kurtosis=5)


@query("""WITH s AS (SELECT min(value) AS lo, max(value) AS hi, count(*) AS n, (max(value) - min(value)) / 50 AS w FROM events),
c AS (SELECT CAST(least(floor((value - lo) / w), 49) AS INTEGER) AS bin, count(*) AS n FROM events, s GROUP BY 1)
SELECT CAST(i AS INTEGER) AS bin, round(lo + i * w, 5) AS "left", round(lo + (i + 1) * w, 5) AS "right",
       coalesce(c.n, 0) AS n, round(coalesce(c.n, 0) / (s.n * w), 8) AS density
FROM range(50) g(i) CROSS JOIN s LEFT JOIN c ON c.bin = i""")
def residual_histogram(spark, sf_dir):
    out = residuals.residual_histogram(table(spark, sf_dir, "events"), "value")
    return rounded(out, left=5, right=5, density=8)


@query("""WITH s AS (SELECT min(value) AS lo, max(value) AS hi, avg(value) AS m, stddev_pop(value) AS d FROM events)
SELECT CAST(i AS INTEGER) AS point, round(lo + i * (hi - lo) / 99, 5) AS x,
       round(exp(-pow((lo + i * (hi - lo) / 99 - m) / d, 2) / 2) / (d * sqrt(2 * pi())), 8) AS density
FROM range(100) g(i), s""")
def normal_curve(spark, sf_dir):
    return rounded(residuals.normal_curve(table(spark, sf_dir, "events"), "value"), x=5, density=8)


@query(LINEAR + f""", folds AS (SELECT f AS fold FROM range(5) g(f)),
m AS (SELECT f.fold, avg(n_lines) AS m1, avg(avg_price) AS m2, avg(sale_price) AS my,
      covar_pop(n_lines, n_lines) AS v1, covar_pop(avg_price, avg_price) AS v2, covar_pop(n_lines, avg_price) AS c12,
      covar_pop(n_lines, sale_price) AS c1, covar_pop(avg_price, sale_price) AS c2
      FROM folds f JOIN vf ON vf.o_orderkey % 5 <> f.fold GROUP BY f.fold),
b AS (SELECT *, (c1 * v2 - c2 * c12) / (v1 * v2 - c12 * c12) AS b1, (c2 * v1 - c1 * c12) / (v1 * v2 - c12 * c12) AS b2 FROM m),
e AS (SELECT fold, avg(pow(sale_price - my - b1 * (n_lines - m1) - b2 * (avg_price - m2), 2)) AS mse
      FROM vf JOIN b ON b.fold = vf.o_orderkey % 5 GROUP BY fold)
SELECT round(avg(sqrt(mse)), 3) AS rmse_mean, round(stddev_pop(sqrt(mse)), 3) AS rmse_std,
       round(sqrt(avg(mse)), 3) AS rmse_of_mean FROM e""")
def cv_rmse(spark, sf_dir):
    """Both cross-validated error definitions: mean of roots, and root of the mean."""
    frame = valuation_frame(spark, sf_dir).select(ID, TARGET, *FEATURES)
    folded = splits.assign_folds(frame, [ID], key=fold_key()).persist()
    scored = metrics.held_out_predictions(folded, linear_regressor(FEATURES, TARGET))
    out = metrics.cv_summary(settle(metrics.fold_errors(scored, TARGET)).table)
    folded.unpersist()
    return rounded(out, rmse_mean=3, rmse_std=3, rmse_of_mean=3)


# ---- bins, splits, ranks ----------------------------------------------------------


@query(f"""WITH {FRAME}, q AS (SELECT quantile_cont(sale_price, [0.2, 0.4, 0.6, 0.8]) AS e FROM vf)
SELECT o_orderkey, (sale_price > e[1])::INTEGER + (sale_price > e[2])::INTEGER + (sale_price > e[3])::INTEGER
       + (sale_price > e[4])::INTEGER AS bin FROM vf, q""")
def quantile_bins(spark, sf_dir):
    return splits.quantile_bins(valuation_frame(spark, sf_dir), TARGET).select(ID, "bin")


def _split_sql(source: str, key: str, y: str, ordered: str) -> str:
    return f"""
q AS (SELECT quantile_cont({y}, [0.2, 0.4, 0.6, 0.8]) AS e FROM {source}),
bn AS (SELECT {key}, {y}, ({y} > e[1])::INTEGER + ({y} > e[2])::INTEGER + ({y} > e[3])::INTEGER + ({y} > e[4])::INTEGER AS bin
       FROM {source}, q),
cb AS (SELECT bin, count(*) AS n FROM bn GROUP BY bin),
tot AS (SELECT sum(n) AS t, ceil(sum(n) * 0.2) AS d FROM cb),
fl AS (SELECT bin, floor(d * n / t) AS k, d * n / t - floor(d * n / t) AS rest, d FROM cb, tot),
qt AS (SELECT bin, k + CAST(row_number() OVER (ORDER BY rest DESC, bin) <= d - sum(k) OVER () AS INTEGER) AS quota FROM fl),
sp AS (SELECT {key}, CASE WHEN row_number() OVER (PARTITION BY bn.bin ORDER BY {ordered}, {key}) <= quota
       THEN 'test' ELSE 'train' END AS split FROM bn JOIN qt USING (bin))"""


@query(f"WITH {FRAME}, {_split_sql('vf', ID, TARGET, ORDERED)} SELECT * FROM sp")
def stratified_split(spark, sf_dir):
    """Exact proportional quotas, selected by order statistics of the draw key: no window."""
    frame = valuation_frame(spark, sf_dir).select(ID, TARGET)
    return splits.mark_split(frame, [ID], TARGET, order=order_key()).select(ID, "split")


@query("SELECT o_orderkey, CAST(o_orderkey % 5 AS INTEGER) AS fold FROM orders")
def kfold_assign(spark, sf_dir):
    return splits.assign_folds(table(spark, sf_dir, "orders").select(ID), [ID], 5, key=fold_key())


@query("""WITH x AS (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS i, count(*) OVER () AS n FROM events)
SELECT event_id, CAST(CASE WHEN i < (n % 7) * (n // 7 + 1) THEN i // (n // 7 + 1)
       ELSE n % 7 + (i - (n % 7) * (n // 7 + 1)) // (n // 7) END AS INTEGER) AS fold FROM x""")
def kfold_contiguous(spark, sf_dir):
    """Unshuffled folds from a range-partitioned sort with partition offsets."""
    return splits.contiguous_folds(table(spark, sf_dir, "events").select("event_id"), ["event_id"], 7)


@query(f"""SELECT o_orderkey, o_totalprice FROM orders ORDER BY {ORDERED}, o_orderkey LIMIT 500""")
def sample_n(spark, sf_dir):
    return splits.sample_n(table(spark, sf_dir, "orders").select(ID, "o_totalprice"), 500, [ID], order=order_key())


def donors_sql(frame: str, id_: str, repeats: int, values: str) -> str:
    """SQL of whole-table permutations: (rep, rank, donor, values) of every row of a frame in every repeat."""
    def by(x: str) -> str:
        return "CASE rep " + " ".join(f"WHEN {r} THEN {permutation.network(x, 'da', 'db', 42, r, '//')}" for r in range(repeats)) + " END"

    return f"""SELECT rep, rank, {values}, CASE WHEN donor < n THEN donor ELSE list_reduce(list_prepend(donor, range({permutation.STEPS})),
  lambda x, i : CASE WHEN x < n THEN x ELSE {by("x")} END) END AS donor
FROM (SELECT *, {by("rank")} AS donor FROM (
  SELECT *, (-(-n // da))::BIGINT AS db FROM (
    SELECT *, row_number() OVER (ORDER BY {id_}) - 1 AS rank, count(*) OVER () AS n, ceil(sqrt(count(*) OVER ()))::BIGINT AS da FROM {frame})),
  range({repeats}) g(rep))""".replace("(-(-n // da))::BIGINT", "((n + da - 1) // da)")


@query(f"""WITH o AS (SELECT o_orderkey, o_totalprice FROM orders),
x AS ({donors_sql("o", "o_orderkey", 1, "o_orderkey, o_totalprice")})
SELECT x.o_orderkey, d.o_totalprice FROM x JOIN x d ON d.rank = x.donor""")
def permute_column(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(ID, "o_totalprice")
    return permutation.permute_column(rows, [ID], "o_totalprice", seed=42)


# ---- residual tables and tests ----------------------------------------------------


@query(LINEAR + f"SELECT o_orderkey, {r('prediction', 1)} AS prediction, {r('residual', 1)} AS residual FROM sc")
def residuals_vs_fitted(spark, sf_dir):
    return rounded(linear_rows(spark, sf_dir)[1].select(ID, "prediction", "residual"), prediction=1, residual=1)


@query(LINEAR + f"""SELECT o_orderkey, {r("prediction", 1)} AS prediction,
       {r("sqrt(abs(residual / s))", 4)} AS sqrt_abs_std_residual FROM sc, (SELECT stddev_pop(residual) AS s FROM sc)""")
def scale_location(spark, sf_dir):
    scored = linear_rows(spark, sf_dir)[1]
    out = residuals.scale_location(scored).select(ID, "prediction", "sqrt_abs_std_residual")
    return rounded(out, prediction=1, sqrt_abs_std_residual=4)


@query(f"""WITH x AS (SELECT event_id, value AS ordered, row_number() OVER (ORDER BY value, event_id) - 1 AS rank,
       count(*) OVER () AS n FROM events),
y AS (SELECT *, CASE WHEN rank = n - 1 THEN pow(0.5, 1.0 / n) WHEN rank = 0 THEN 1 - pow(0.5, 1.0 / n)
      ELSE (rank + 1 - 0.3175) / (n + 0.365) END::DOUBLE AS p FROM x),
z AS (SELECT *, {sql_normal_quantile("p")} AS theoretical FROM y),
l AS (SELECT regr_slope(ordered, theoretical) AS slope, regr_intercept(ordered, theoretical) AS icpt FROM z)
SELECT event_id, ordered, rank, {r("theoretical", 6)} AS theoretical, {r("icpt + slope * theoretical", 5)} AS fitted FROM z, l""")
def qq_table(spark, sf_dir):
    out = residuals.qq_table(table(spark, sf_dir, "events"), ["event_id"], "value")
    return rounded(out, theoretical=6, fitted=5)


def lowess_sql(anchors: int, passes: int) -> str:
    """Local lines on a grid and their robust passes, each from the rows' distance to the curve before."""
    lines = """SELECT anchor, x0, (s2 * t0 - s1 * t1) / (s0 * s2 - s1 * s1) AS smooth FROM (
  SELECT anchor, x0, sum(w) AS s0, sum(w * d) AS s1, sum(w * d * d) AS s2, sum(w * y) AS t0, sum(w * d * y) AS t1 FROM (
    SELECT anchor, x0, x - x0 AS d, y, r * pow(1 - pow(abs(x - x0) / h, 3), 3) AS w FROM h JOIN {rows} ON abs(x - x0) <= h) GROUP BY anchor, x0)"""
    steps = f""", an AS (SELECT unnest(range({anchors})) AS anchor,
       unnest(quantile_cont(prediction, [{", ".join(repr(i / (anchors - 1)) for i in range(anchors))}])) AS x0 FROM sc),
h AS (SELECT anchor, x0, list_sort(list(abs(prediction - x0)))[CAST(floor(0.3 * count(*) + 1e-10) AS BIGINT)] AS h
      FROM an, sc GROUP BY anchor, x0),
r0 AS (SELECT prediction AS x, residual AS y, 1.0::DOUBLE AS r FROM sc),
c0 AS ({lines.format(rows="r0")})"""
    for k in range(1, passes + 1):
        steps += f""",
g{k} AS (SELECT CASE WHEN anchor = 0 THEN '-inf'::DOUBLE ELSE x0 END AS a, x0, smooth, lead(x0) OVER (ORDER BY x0) AS b, lead(smooth) OVER (ORDER BY x0) AS next FROM c{k - 1}),
o{k} AS (SELECT x, y, abs(y - (smooth + (x - x0) * ((next - smooth) / (b - x0)))) AS off FROM r0 JOIN g{k} ON x > a AND x <= b),
r{k} AS (SELECT x, y, CASE WHEN off < 6 * m THEN pow(1 - pow(off / (6 * m), 2), 2) ELSE 0 END AS r FROM o{k}, (SELECT quantile_cont(off, 0.5) AS m FROM o{k})),
c{k} AS ({lines.format(rows=f"r{k}")})"""
    return steps + f" SELECT CAST(anchor AS INTEGER) AS anchor, round(x0, 2) AS x0, round(smooth, 2) AS smooth FROM c{passes}"


@query(LINEAR + lowess_sql(50, 3))
def lowess_grid(spark, sf_dir):
    """Tricube local lines on 50 anchors with three robust passes."""
    scored = linear_rows(spark, sf_dir)[1].select("prediction", "residual")
    return rounded(residuals.lowess_grid(scored, "prediction", "residual"), x0=2, smooth=2)


@query(LINEAR + """, t AS (SELECT regr_r2(residual * residual, prediction) AS r2, count(*) AS n FROM sc)
SELECT n, 1 AS df, round(n * r2, 5) AS lm_statistic, round(r2 / ((1 - r2) / (n - 2)), 5) AS f_statistic FROM t""")
def breusch_pagan_1(spark, sf_dir):
    scored = linear_rows(spark, sf_dir)[1]
    found = residuals.breusch_pagan(scored.select("prediction", "residual"), ["prediction"])
    row = [(found["n"], found["df"], round(found["lm_statistic"], 5), round(found["f_statistic"], 5))]
    return spark.createDataFrame(row, "n long, df int, lm_statistic double, f_statistic double")


def _weights(name: str, x: str) -> str:
    text = repr(name[-1])
    for c in reversed(name[:-1]):
        text = f"({text} * {x} + {c!r})"
    return text


@query(LINEAR + f""", sm AS (SELECT residual AS x FROM sc ORDER BY {ORDERED}, o_orderkey LIMIT 5000),
rk AS (SELECT x, row_number() OVER (ORDER BY x) AS i, count(*) OVER () AS n FROM sm),
m AS (SELECT *, {sql_normal_quantile("((i - 0.375)::DOUBLE / (n + 0.25))")} AS m FROM rk),
g AS (SELECT sum(m * m) AS mm, max(m) AS m1, max(CASE WHEN i = n - 1 THEN m END) AS m2, 1 / sqrt(max(n)) AS u FROM m),
a AS (SELECT *, m1 / sqrt(mm) + {_weights(residuals.WEIGHT_LAST, "u")} AS a1,
      m2 / sqrt(mm) + {_weights(residuals.WEIGHT_NEXT, "u")} AS a2 FROM g),
e AS (SELECT *, sqrt((mm - 2 * m1 * m1 - 2 * m2 * m2) / (1 - 2 * a1 * a1 - 2 * a2 * a2)) AS eps FROM a)
SELECT max(n) AS n, round(pow(sum(x * CASE WHEN i = n THEN a1 WHEN i = 1 THEN -a1 WHEN i = n - 1 THEN a2
       WHEN i = 2 THEN -a2 ELSE m / eps END), 2) / (var_pop(x) * count(*)), 8) AS statistic FROM m, e""")
def shapiro_wilk(spark, sf_dir):
    """The statistic over the seeded sample of 5000 residuals that the test allows."""
    scored = linear_rows(spark, sf_dir)[1]
    return rounded(residuals.shapiro_wilk_statistic(scored, [ID], order=order_key()), statistic=8)


# ---- models with closed forms -----------------------------------------------------

_TERMS = {"1": "1.0::DOUBLE", "n_lines": "n_lines", "avg_price": "avg_price", "sale_price": "sale_price"}


@query(f"WITH {FRAME} " + " UNION ALL ".join(
    f"SELECT '{a}' AS row_name, '{b}' AS col_name, round(sum({_TERMS[a]} * {_TERMS[b]} / 1e6)::DOUBLE, 4) AS cross_m FROM vf"
    for i, a in enumerate(_TERMS) for b in list(_TERMS)[i:]))
def sufficient_stats(spark, sf_dir):
    out = sufficient_statistics(valuation_frame(spark, sf_dir), FEATURES, TARGET)
    return out.select("row_name", "col_name", F.round(F.col("cross") / 1e6, 4).alias("cross_m"))


def _step(alpha: str, lam: str) -> tuple[str, str]:
    """Ridge weights of two centred features at the given precisions."""
    ratio = f"({lam} / {alpha})"
    det = f"((g11 + {ratio}) * (g22 + {ratio}) - g12 * g12)"
    return f"((s1 * (g22 + {ratio}) - s2 * g12) / {det})", f"((s2 * (g11 + {ratio}) - s1 * g12) / {det})"


_W1, _W2 = _step("alpha", "lam")


@query(f"""WITH RECURSIVE {FRAME},
m AS (SELECT count(*)::DOUBLE AS n, avg(n_lines) AS m1, avg(avg_price) AS m2, avg(sale_price) AS my,
      var_pop(n_lines) * count(*) AS g11, var_pop(avg_price) * count(*) AS g22, covar_pop(n_lines, avg_price) * count(*) AS g12,
      covar_pop(n_lines, sale_price) * count(*) AS s1, covar_pop(avg_price, sale_price) * count(*) AS s2,
      var_pop(sale_price) * count(*) AS yy FROM vf),
g AS (SELECT *, (g11 + g22) / 2 + sqrt(pow((g11 - g22) / 2, 2) + g12 * g12) AS e1,
      (g11 * g22 - g12 * g12) / ((g11 + g22) / 2 + sqrt(pow((g11 - g22) / 2, 2) + g12 * g12)) AS e2 FROM m),
it AS (SELECT 0 AS i, n / yy AS alpha, 1.0::DOUBLE AS lam, NULL::DOUBLE AS p1, NULL::DOUBLE AS p2, FALSE AS done FROM g
  UNION ALL
  SELECT i + 1, (n - gamma + 2e-6) / (greatest(yy - 2 * (w1 * s1 + w2 * s2) + w1 * w1 * g11 + 2 * w1 * w2 * g12 + w2 * w2 * g22, 0) + 2e-6),
         (gamma + 2e-6) / (w1 * w1 + w2 * w2 + 2e-6), w1, w2, p1 IS NOT NULL AND abs(w1 - p1) + abs(w2 - p2) < 1e-3
  FROM (SELECT it.*, g.*, {_W1} AS w1, {_W2} AS w2,
               alpha * e1 / (lam + alpha * e1) + alpha * e2 / (lam + alpha * e2) AS gamma
        FROM it, g WHERE NOT done AND i < 300)),
z AS (SELECT {_W1} AS w1, {_W2} AS w2, m1, m2, my FROM it, g WHERE i = (SELECT max(i) FROM it))
SELECT 'n_lines' AS term, round(w1, 3) AS coefficient FROM z UNION ALL SELECT 'avg_price', round(w2, 6) FROM z
UNION ALL SELECT 'intercept', round(my - w1 * m1 - w2 * m2, 2) FROM z""")
def bayesian_ridge(spark, sf_dir):
    """Evidence maximisation from sufficient statistics of the whole frame."""
    frame = valuation_frame(spark, sf_dir).select(TARGET, *FEATURES)
    out = BayesianRidge(FEATURES, TARGET).fit(frame).coefficient_table(spark)
    value = F.col("coefficient")
    digits = F.when(F.col("term") == "n_lines", F.round(value, 3)).when(F.col("term") == "avg_price", F.round(value, 6))
    return out.withColumn("coefficient", digits.otherwise(F.round(value, 2)))


@query(LINEAR + f"""SELECT o_orderkey, {r("prediction", 1)} AS "Prediction", {r("sale_price", 6)} AS "Actual",
       {r("abs(residual)", 1)} AS "Error" FROM sc""", name="compare_predictions")
def compared(spark, sf_dir):
    frame = valuation_frame(spark, sf_dir)
    model = linear_model(frame.select(TARGET, *FEATURES))
    return rounded(compare_predictions(model, frame, [ID], TARGET), Prediction=1, Actual=6, Error=1)


@query(f"""WITH {linear_sql("part", "lin", "p_size", "p_retailprice % 7", "p_retailprice").replace("part", "part")}
SELECT p_partkey, p_retailprice AS actual_price,
       {r("b0 + b1 * p_size + b2 * (p_retailprice % 7)", 4)} AS predicted_price,
       {r("b0 + b1 * p_size + b2 * (p_retailprice % 7) - p_retailprice", 4)} AS error FROM part, lin""")
def streamed_scores(spark, sf_dir):
    """A fitted model applied to a file stream of parts; the sink is read back."""
    rest = (F.col("p_retailprice") % 7).alias("rest")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice", rest)
    model = linear_regressor(["p_size", "rest"], "p_retailprice").fit(parts)
    out = f"{checkpoint_folder(spark)}/stream-{uuid.uuid4().hex}"
    parts.write.parquet(f"{out}/source")
    query_run = score_files(
        spark, f"{out}/source", parts.schema, model, f"{out}/sink", f"{out}/state", ["p_partkey"], "p_retailprice"
    )
    query_run.awaitTermination()
    return rounded(spark.read.parquet(f"{out}/sink"), predicted_price=4, error=4)


# ---- recipes ----------------------------------------------------------------------

GAPPED = """ev AS (SELECT event_id, value, CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(user_id AS DOUBLE) END AS user_score,
       CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_type END AS kind FROM events)"""


@query(f"""WITH {GAPPED}, {_split_sql("ev", "event_id", "value", "(event_id * 7919 + 42) % 100003")},
tr AS (SELECT ev.* FROM ev JOIN sp USING (event_id) WHERE split = 'train'),
fills AS (SELECT median(user_score) AS u, (SELECT kind FROM tr WHERE kind IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS k,
          quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM tr)
SELECT event_id, value, coalesce(user_score, u) AS user_score, coalesce(kind, k) AS kind, split
FROM ev JOIN sp USING (event_id), fills
WHERE split = 'test' OR NOT (value < q1 - 3 * (q3 - q1) OR value > q3 + 3 * (q3 - q1))""")
def preprocess_recipe(spark, sf_dir):
    """Split, fills learned on train only, extreme targets trimmed in train only."""
    score = F.when(F.col("event_id") % 7 != 0, F.col("user_id").cast("double")).alias("user_score")
    kind = F.when(F.col("event_id") % 11 != 0, F.col("event_type")).alias("kind")
    rows = table(spark, sf_dir, "events").select("event_id", "value", score, kind)
    train, test, _ = preprocess(rows, ["event_id"], "value", order=order_key("event_id"))
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


_BOXED = ["n_lines", "sum_qty", "avg_price", "max_price", "yr_sold", "n_lines_x_avg_price"]
_CODED = ["c_mktsegment", "o_orderpriority", "o_orderstatus"]


def _boxed(c: str) -> str:
    return f"CASE WHEN abs(k_{c}) > 0.75 AND l_{c} > -1 THEN (pow(1 + {c}, 0.15) - 1) / 0.15 ELSE {c} END"


@query(f"""WITH {FRAME}, v AS (SELECT *, n_lines * avg_price AS n_lines_x_avg_price FROM vf),
tr AS (SELECT * FROM v WHERE o_orderkey % 5 <> 0), pr AS (SELECT avg(sale_price) AS prior FROM tr),
en AS (SELECT n_name, (sum(sale_price) + 10 * any_value(prior)) / (count(*) + 10) AS enc FROM tr, pr GROUP BY n_name),
mu AS (SELECT {", ".join(f"avg({c}) AS m_{c}" for c in _BOXED)} FROM tr),
sk AS (SELECT {", ".join(f"avg(pow({c} - m_{c}, 3)) / pow(avg(pow({c} - m_{c}, 2)), 1.5) AS k_{c}, min({c}) AS l_{c}" for c in _BOXED)}
       FROM tr, mu),
""" + ", ".join(
    f"d_{c} AS (SELECT {c}, row_number() OVER (ORDER BY {c}) - 1 AS code FROM (SELECT DISTINCT {c} FROM tr))" for c in _CODED
) + f""" SELECT o_orderkey, {r("sale_price", 6)} AS sale_price,
       {", ".join(f"{r(_boxed(c), 5)} AS {c}" for c in _BOXED)}, {r("enc", 3)} AS n_name_encoded,
       {", ".join(f"d_{c}.code AS {c}" for c in _CODED)}
FROM v JOIN en USING (n_name), sk, {", ".join(f"d_{c}" for c in _CODED)}
WHERE {" AND ".join(f"d_{c}.{c} = v.{c}" for c in _CODED)}""")
def feature_stages_transform(spark, sf_dir):
    """The whole feature recipe, fitted on four fifths of the orders and applied to all."""
    frame = valuation_frame(spark, sf_dir).drop("avg_disc")
    stages = FeatureStages([ID], TARGET, [("n_lines", "avg_price")], ["n_name"], fold_key=fold_key())
    model, _ = stages.fit_transform(frame.filter(F.col(ID) % 5 != 0))
    out = model.transform(frame)
    return out.select(
        ID, F.round(TARGET, 6).alias(TARGET),
        *[F.round(F.col(c).cast("double"), 5).alias(c) for c in _BOXED],
        F.round("n_name_encoded", 3).alias("n_name_encoded"), *_CODED,
    )


# ---- explanations of the linear model ---------------------------------------------

SHAP_SQL = LINEAR + f""", ex AS (SELECT * FROM sc ORDER BY {ORDERED}, o_orderkey LIMIT 100),
bg AS (SELECT * FROM sc ORDER BY (o_orderkey * 7919 + 99) % 100003, o_orderkey LIMIT 100),
mb AS (SELECT avg(n_lines) AS m1, avg(avg_price) AS m2, avg(prediction) AS base FROM bg),
sh AS (SELECT o_orderkey, 'n_lines' AS feature, CAST(n_lines AS DOUBLE) AS feature_value, b1 * (n_lines - m1) AS shap_value, base FROM ex, mb, lin
       UNION ALL SELECT o_orderkey, 'avg_price', avg_price, b2 * (avg_price - m2), base FROM ex, mb, lin)
"""


def linear_shap(spark, sf_dir) -> ShapValues:
    frame = valuation_frame(spark, sf_dir).select(ID, TARGET, *FEATURES)
    model = linear_model(frame)
    explained = splits.sample_n(frame, 100, [ID], order=order_key())
    background = splits.sample_n(frame, 100, [ID], order=order_key(seed=99))
    return kernel_shap(model, explained, background, FEATURES, [ID])


@query(SHAP_SQL + f"SELECT o_orderkey, feature, {r('feature_value', 5)} AS feature_value, {r('shap_value', 2)} AS shap_value FROM sh")
def shap_values_linear(spark, sf_dir):
    """Kernel method; a linear model has the closed form beta * (x - background mean)."""
    return rounded(linear_shap(spark, sf_dir).values, feature_value=5, shap_value=2)


@query(SHAP_SQL + "SELECT round(base, 2) AS base_value FROM mb", name="shap_base_value")
def background_mean(spark, sf_dir):
    frame = valuation_frame(spark, sf_dir).select(ID, TARGET, *FEATURES)
    background = splits.sample_n(frame, 100, [ID], order=order_key(seed=99))
    return rounded(base_value(linear_model(frame), background), base_value=2)


@query(SHAP_SQL + "SELECT feature, round(avg(abs(shap_value)), 3) AS importance FROM sh GROUP BY feature", name="shap_importance")
def mean_absolute_shap(spark, sf_dir):
    return rounded(shap_importance(linear_shap(spark, sf_dir)), importance=3)


@query(SHAP_SQL + f""", im AS (SELECT feature, avg(abs(shap_value)) AS v FROM sh GROUP BY feature),
tp AS (SELECT feature, CAST(row_number() OVER (ORDER BY v DESC, feature) AS INTEGER) AS position FROM im ORDER BY position LIMIT 1)
SELECT o_orderkey, feature, {r("feature_value", 5)} AS feature_value, {r("shap_value", 2)} AS shap_value, position
FROM sh JOIN tp USING (feature)""", name="shap_summary")
def shap_summary_top(spark, sf_dir):
    return rounded(shap_summary(linear_shap(spark, sf_dir), 1), feature_value=5, shap_value=2)


@query(SHAP_SQL + f"""SELECT o_orderkey, {r("feature_value", 5)} AS feature_value, {r("shap_value", 2)} AS shap_value
       FROM sh WHERE feature = 'avg_price'""", name="shap_dependence")
def shap_of_avg_price(spark, sf_dir):
    return rounded(shap_dependence(linear_shap(spark, sf_dir), 1), feature_value=5, shap_value=2)


@query(SHAP_SQL + f""", one AS (SELECT * FROM sh WHERE o_orderkey = (SELECT min(o_orderkey) FROM ex))
SELECT o_orderkey, CAST(row_number() OVER w AS INTEGER) AS position, feature, {r("feature_value", 5)} AS feature_value,
       {r("shap_value", 2)} AS shap_value, round(base, 2) AS base_value,
       {r("base + sum(shap_value) OVER (w ROWS UNBOUNDED PRECEDING)", 2)} AS running_value
FROM one WINDOW w AS (ORDER BY abs(shap_value) DESC, feature)""", name="shap_force")
def shap_of_first_row(spark, sf_dir):
    shap = linear_shap(spark, sf_dir)
    first = shap.values.agg(F.min(ID)).first()[0]
    return rounded(shap_force(shap, {ID: first}), feature_value=5, shap_value=2, base_value=2, running_value=2)


@query(f"WITH {FRAME}, " + ", ".join(
    f"q_{c} AS (SELECT quantile_cont({c}, [0.25, 0.5, 0.75]) AS e FROM vf)" for c in ("avg_price", "sum_qty")
) + " " + " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, CAST(({c} > e[1])::INTEGER + ({c} > e[2])::INTEGER + ({c} > e[3])::INTEGER AS INTEGER) AS bin,
        count(*) AS n, round(avg({c}), 4) AS mean, round(stddev_pop({c}), 4) AS spread, round(min({c}), 5) AS low,
        round(max({c}), 5) AS high FROM vf, q_{c} GROUP BY 2""" for c in ("avg_price", "sum_qty")))
def lime_bin_profile(spark, sf_dir):
    profile = bin_profile(valuation_frame(spark, sf_dir), ["avg_price", "sum_qty"]).drop("edges")
    return rounded(profile, mean=4, spread=4, low=5, high=5)


# ---- permutation importance of the linear model -----------------------------------

PERMUTED = LINEAR + f""", rw AS ({donors_sql("vf", "o_orderkey", 10, "sale_price AS y, n_lines, avg_price")}),
er AS (SELECT 'n_lines' AS feature, x.rep, avg(pow(x.y - b0 - b1 * d.n_lines - b2 * x.avg_price, 2)) AS mse
       FROM lin, rw x JOIN rw d ON d.rep = x.rep AND d.rank = x.donor GROUP BY x.rep
       UNION ALL SELECT 'avg_price', x.rep, avg(pow(x.y - b0 - b1 * x.n_lines - b2 * d.avg_price, 2))
       FROM lin, rw x JOIN rw d ON d.rep = x.rep AND d.rank = x.donor GROUP BY x.rep),
pi AS (SELECT feature, avg(mse - b) AS importance_mean, stddev_pop(mse - b) AS importance_std FROM er,
       (SELECT avg(pow(sale_price - b0 - b1 * n_lines - b2 * avg_price, 2)) AS b FROM lin, vf) GROUP BY 1)
"""


def linear_importance(spark, sf_dir) -> DataFrame:
    frame = valuation_frame(spark, sf_dir).select(ID, TARGET, *FEATURES)
    errors = permuted_errors(
        frame, linear_model(frame), FEATURES, TARGET, [ID], n_repeats=10, seed=42)
    return importance_from_errors(errors)


def _in_millions(df: DataFrame) -> DataFrame:
    return df.select(
        "feature",
        F.round(F.col("importance_mean") / 1e6, 4).alias("importance_mean_m"),
        F.round(F.col("importance_std") / 1e6, 4).alias("importance_std_m"),
    )


_MILLIONS = "feature, round(importance_mean / 1e6, 4) AS importance_mean_m, round(importance_std / 1e6, 4) AS importance_std_m"


@query(PERMUTED + f"SELECT {_MILLIONS} FROM pi")
def permutation_importance(spark, sf_dir):
    """Mean and spread of the error increase; one shuffle serves all features and repeats."""
    return _in_millions(linear_importance(spark, sf_dir))


@query(PERMUTED + f"SELECT {_MILLIONS} FROM pi ORDER BY importance_mean DESC, feature LIMIT 1", name="top_features")
def top_feature(spark, sf_dir):
    return _in_millions(top_features(linear_importance(spark, sf_dir), 1))


@query(PERMUTED + f"SELECT {_MILLIONS} FROM pi WHERE importance_mean <= (SELECT avg(importance_mean) FROM pi)")
def low_importance_features(spark, sf_dir):
    """Features at or below the mean importance, as a threshold that scales with the data."""
    importance = settle(linear_importance(spark, sf_dir)).table
    threshold = importance.agg(F.avg("importance_mean")).first()[0]
    return _in_millions(low_importance(importance, threshold))


@query(SHAP_SQL.replace("WITH ", "WITH ", 1).rstrip() + PERMUTED[len(LINEAR):].rstrip() + """,
im AS (SELECT feature, avg(abs(shap_value)) AS v FROM sh GROUP BY feature),
nz AS (SELECT feature, (importance_mean - min(importance_mean) OVER ()) / (max(importance_mean) OVER () - min(importance_mean) OVER ()) AS permutation,
       (v - min(v) OVER ()) / (max(v) OVER () - min(v) OVER ()) AS shap FROM pi JOIN im USING (feature))
SELECT feature, round(permutation, 6) AS permutation, round(shap, 6) AS shap,
       round((permutation + shap) / 2, 6) AS avg_importance FROM nz""")
def importance_compare(spark, sf_dir):
    out = compare_importance(linear_importance(spark, sf_dir), shap_importance(linear_shap(spark, sf_dir)))
    return rounded(out, permutation=6, shap=6, avg_importance=6)
