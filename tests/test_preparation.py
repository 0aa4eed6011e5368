"""Sources, cleaning, imputation, outliers, splits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.config import MACRO
from plumbline.operators import cleaning, impute, outliers, splits
from plumbline.plans.recipes import load_dataset, preprocess
from plumbline.sources.readers import read_delimited
from plumbline.sources.sinks import prediction_table, read_best_params, write_best_params, write_json


@pytest.fixture
def raw(spark, rng):
    kinds = ["Elm St", "Oak St", "Mill Rd"]
    rows = [(i, 9000 - 3 * i, 2006 + i % 5, 900 + 37 * i, kinds[i % 3], 95_000.0 + 4_100 * i) for i in range(20)]
    return spark.createDataFrame(
        rows, "Order long, PID long, `Yr Sold` int, `Gr Liv Area` int, Neighborhood string, SalePrice double"
    )


def test_delimited_scan_infers_types_and_missing(spark, tmp_path):
    path = tmp_path / "t.tsv"
    path.write_text("Order\tLot Area\tAlley\tPrice\n1\t31770\tNA\t215000.5\n2\tNA\tPave\t\n3\t100\tGrvl\t10\n")
    df = read_delimited(spark, str(path))
    assert dict(df.dtypes) == {"Order": "bigint", "Lot Area": "bigint", "Alley": "string", "Price": "double"}
    rows = df.orderBy("Order").collect()
    assert rows[0]["Alley"] is None and rows[1]["Lot Area"] is None and rows[1]["Price"] is None
    typed = read_delimited(spark, str(path), schema="Order int, `Lot Area` double, Alley string, Price double")
    assert dict(typed.dtypes)["Lot Area"] == "double"


def test_only_plain_numbers_become_numbers(spark, tmp_path):
    path = tmp_path / "t.tsv"
    path.write_text("a\tb\tc\td\te\n1D\t3f\ttrue\t1e3\t+7\n2D\t7D\tfalse\t.5\t-2\n")
    df = read_delimited(spark, str(path))
    assert dict(df.dtypes) == {"a": "string", "b": "string", "c": "string", "d": "double", "e": "bigint"}
    assert [tuple(r) for r in df.orderBy("a").collect()] == [("1D", "3f", "true", 1000.0, 7), ("2D", "7D", "false", 0.5, -2)]


def test_load_dataset_composes(spark, raw, tmp_path):
    path = str(tmp_path / "raw")
    raw.write.option("header", True).option("sep", "\t").csv(path)
    df, summary = load_dataset(spark, path, save_to=str(tmp_path / "ready"))
    assert "Order" not in df.columns and "PID" not in df.columns and "CPI" in df.columns
    row = summary.first()
    assert row["n_rows"] == 20 and row["n_columns"] == 8 and row["n_categorical"] == 1
    assert spark.read.parquet(str(tmp_path / "ready")).count() == 20


def test_macro_columns(spark, raw):
    row = cleaning.add_macro_features(raw).filter("Order = 0").first()
    assert row["Years_Since_Sale"] == MACRO.reference_year - row["Yr Sold"]
    assert row["Market_Adjustment_Factor"] == pytest.approx(320 / 230 * 4 / 6.5)
    with pytest.raises(KeyError):
        cleaning.add_macro_features(raw.drop("Yr Sold"))


def test_summary_without_target(raw):
    row = cleaning.data_summary(raw.drop("SalePrice")).first()
    assert row["target_mean"] is None and row["target_std"] is None and row["target_median"] is None
    approximate = cleaning.data_summary(raw, accuracy=1000).first()
    assert approximate["target_median"] is not None


def test_cleaning_tolerates_absent_identifiers(raw):
    once = cleaning.drop_identifiers(raw)
    assert cleaning.drop_identifiers(once).columns == once.columns


@pytest.fixture
def gaps(spark):
    rows = [(1.0, "a", 10.0), (None, "a", 20.0), (3.0, None, 30.0), (float("nan"), "b", 40.0)]
    return spark.createDataFrame(rows, "num double, cat string, SalePrice double")


def test_imputer_learns_median_and_mode(gaps):
    model = impute.MissingValueImputer().fit(gaps)
    assert model.fills == {"num": 2.0, "SalePrice": 25.0, "cat": "a"}
    out = model.transform(gaps).collect()
    assert [r["num"] for r in out] == [1.0, 2.0, 3.0, 2.0] and [r["cat"] for r in out] == ["a", "a", "a", "b"]


def test_imputer_reuses_training_values(spark, gaps):
    train = spark.createDataFrame([(1.0, "x", 1.0), (5.0, "x", 2.0), (9.0, "y", 3.0)], gaps.schema)
    model = impute.MissingValueImputer(exclude=["SalePrice"]).fit(train)
    row = model.transform(spark.createDataFrame([(None, None, None)], gaps.schema)).first()
    assert row["num"] == 5.0 and row["cat"] == "x" and row["SalePrice"] is None


def test_imputer_without_any_value(spark):
    df = spark.createDataFrame([(None, None), (None, None)], "e double, c string")
    assert impute.MissingValueImputer().fit(df).fills == {"e": 0.0, "c": "Missing"}


def test_imputer_mode_tie_takes_the_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",)], "c string")
    assert impute.MissingValueImputer().fit(df).fills == {"c": "a"}


def test_imputer_round_trip(gaps, tmp_path):
    model = impute.MissingValueImputer().fit(gaps)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = impute.MissingValueImputerModel.load(str(tmp_path / "m"))
    assert again.fills == model.fills and again.uid == model.uid


@pytest.mark.parametrize("kind", ["double", "bigint", "int", "float", "smallint"])
def test_outliers_in_every_numeric_type(spark, kind):
    df = spark.createDataFrame([(v,) for v in (71, 64, 69, 66, 73, 68, 9001)], "SalePrice long")
    df = df.select(F.col("SalePrice").cast(kind).alias("SalePrice"))
    assert outliers.outlier_mask(df, ["SalePrice", "absent"]).filter("is_outlier").count() == 1


def test_missing_values_are_not_outliers(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,)], "x double")
    assert outliers.remove_extreme_outliers(df, "x").count() == 4


def test_extreme_target_without_spread(spark):
    df = spark.createDataFrame([(42.0,)] * 15 + [(7e6,)], "SalePrice double")
    assert outliers.remove_extreme_outliers(df).count() == 15


@pytest.fixture
def priced(spark, rng):
    rows = [(i, float(rng.normal(180_000, 40_000))) for i in range(503)]
    return spark.createDataFrame(rows, "id long, SalePrice double")


def test_split_is_exact_disjoint_and_proportional(priced):
    train, test = splits.stratified_split(priced, ["id"])
    assert test.count() == 101 and train.count() == 402
    assert train.join(test, "id").count() == 0
    binned = splits.quantile_bins(priced, "SalePrice").join(test.select("id"), "id")
    assert {r["count"] for r in binned.groupBy("bin").count().collect()} <= {20, 21}


def test_split_ignores_partitioning_and_follows_the_seed(priced):
    def drawn(df, seed):
        return {r["id"] for r in splits.stratified_split(df, ["id"], seed=seed)[1].collect()}

    assert drawn(priced.coalesce(1), 42) == drawn(priced.repartition(8, "SalePrice"), 42)
    assert drawn(priced, 42) != drawn(priced, 7)


def test_equal_edges_are_merged(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([0] * 6 + [5, 10, 20, 30])], "id long, y double")
    assert splits.quantile_edges(df, "y") == sorted(set(np.quantile([0] * 6 + [5, 10, 20, 30], [0, 0.2, 0.4, 0.6, 0.8, 1.0])))
    assert splits.quantile_bins(df, "y").filter("y = 0 AND bin <> 0").count() == 0


def test_first_k_moves_through_ties(spark):
    df = spark.range(200).select("id", (F.col("id") % 4).alias("k"))
    picked = df.filter(splits.first_k(df, [F.col("k"), F.col("id")], {0: (F.lit(True), 70)}))
    rows = sorted((r["k"], r["id"]) for r in picked.collect())
    assert rows == sorted((i % 4, i) for i in range(200))[:70]


def test_samples_and_splits_of_repeated_ids_end(spark):
    rows = spark.range(0, 45_000, 1, 6).select((F.col("id") % 3).alias("id"), (F.col("id") % 1009).cast("double").alias("y"))
    assert splits.sample_n(rows, 4_000, ["id"]).count() == 4_000
    assert splits.sample_n(rows, 12_000, ["id"]).count() == 12_000 and splits.sample_n(rows, 20_000, ["id"]).count() == 20_000
    assert splits.sample_n(rows, 50_000, ["id"]).count() == 45_000 and splits.sample_n(rows, 0, ["id"]).count() == 0
    marked = splits.mark_split(rows, ["id"], "y")
    assert marked.count() == 45_000


def test_sample_beyond_top_k_equals_ordered_sample(priced, monkeypatch):
    small = {r["id"] for r in splits.sample_n(priced, 100, ["id"]).collect()}
    monkeypatch.setattr(splits, "BOTTOM_K", 10)
    assert {r["id"] for r in splits.sample_n(priced, 100, ["id"]).collect()} == small
    assert splits.sample_n(priced, 10_000, ["id"]).count() == 503


@pytest.mark.parametrize("bottom", [10_000, 3])
def test_samples_follow_any_order(spark, monkeypatch, bottom):
    monkeypatch.setattr(splits, "BOTTOM_K", bottom)
    values = [None, 5, 5, None, 1, 9, 5, 7, 2, 2]
    rows = spark.createDataFrame([(i, v, f"t{i % 3}") for i, v in enumerate(values)], "id long, v int, t string").repartition(4)
    want = sorted(range(10), key=lambda i: (values[i] is not None, values[i] or 0, i))
    for n in (1, 2, 3, 5, 9, 10, 11):
        got = splits.sample_n(rows, n, ["id"], order=[F.col("v"), F.col("id")])
        assert sorted(r["id"] for r in got.collect()) == sorted(want[:n])
        assert splits.sample_n(rows, n, ["id"], order=[F.col("v")]).count() == min(n, 10)


def test_folds(priced):
    folded = splits.assign_folds(priced, ["id"], 5)
    assert {r["fold"] for r in folded.select("fold").distinct().collect()} == set(range(5))
    blocks = splits.contiguous_folds(priced, ["id"], 4).groupBy("fold").agg(F.count("*").alias("n"), F.min("id").alias("a"))
    assert [(r["n"], r["a"]) for r in blocks.orderBy("fold").collect()] == [(126, 0), (126, 126), (126, 252), (125, 378)]


def test_preprocess_learns_from_train_only(priced):
    rows = priced.withColumn("area", F.when(F.col("id") % 5 == 0, F.lit(None)).otherwise(F.col("id").cast("double")))
    train, test, imputer = preprocess(rows, ["id"])
    raw_train, _ = splits.stratified_split(rows, ["id"])
    assert imputer.fills["area"] == raw_train.select(F.median("area")).first()[0]
    assert train.filter("area IS NULL").count() == 0 and test.filter("area IS NULL").count() == 0
    assert test.count() == 101


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, 100.0, 110.0)], "id long, y double, prediction double")
    row = prediction_table(df, ["id"], "y").first()
    assert (row["actual_price"], row["predicted_price"], row["error"]) == (100.0, 110.0, 10.0)
    assert prediction_table(df, ["id"]).columns == ["id", "predicted_price"]
    assert spark.read.json(write_json(df, str(tmp_path / "j"))).count() == 1
    path = str(tmp_path / "best")
    assert read_best_params(spark, write_best_params(spark, {}, path)) == {}
    assert read_best_params(spark, write_best_params(spark, {"rf": {"numTrees": 3}}, path)) == {"rf": {"numTrees": 3}}
