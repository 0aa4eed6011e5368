"""Order statistics, ranks, lookups and numeric functions."""

import math
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.functions import lookups, order_stats
from plumbline.functions.columns import missing, numeric_columns, require, require_unique
from plumbline.functions.lookups import Lookup, lookup_join, settle
from plumbline.functions.numeric import boxcox1p, normal_quantile, uniform
from plumbline.functions.order_stats import exact_quantiles, kth_values
from plumbline.functions.ranking import global_rank
from plumbline.functions.tails import chi2_sf, f_sf, normal_sf


def frame(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, x double").repartition(5)


@pytest.fixture
def tight(monkeypatch):
    """Forces the bracketing passes on small data."""
    monkeypatch.setattr(order_stats, "DIRECT_ROWS", 10)
    monkeypatch.setattr(order_stats, "GATHER_ROWS", 5)


SHARES = [0.0, 0.1, 0.25, 0.333, 0.5, 0.9, 1.0]


@pytest.mark.parametrize("kind", ["normal", "ties", "constant", "skewed", "two"])
def test_bracketed_quantiles_are_exact(spark, tight, rng, kind):
    values = {
        "normal": rng.normal(size=3000),
        "ties": np.where(rng.random(3000) < 0.4, 0.0, rng.normal(size=3000).round(1)),
        "constant": np.full(500, 2.5),
        "skewed": np.exp(rng.normal(0, 40, 2000)),
        "two": np.array([1.0] * 700 + [2.0] * 300),
    }[kind]
    df = frame(spark, values.tolist() + [None, None])
    found = exact_quantiles(df, {"x": F.col("x")}, SHARES)["x"]
    np.testing.assert_allclose(found, np.quantile(values, SHARES), rtol=1e-12)


def test_direct_and_bracketed_agree(spark, rng, monkeypatch):
    df = frame(spark, rng.normal(size=2000).tolist())
    direct = exact_quantiles(df, {"x": F.col("x")}, SHARES)
    monkeypatch.setattr(order_stats, "DIRECT_ROWS", 10)
    assert exact_quantiles(df, {"x": F.col("x")}, SHARES)["x"] == pytest.approx(direct["x"], rel=1e-12)


def test_kth_values_of_longs_are_exact(spark, tight):
    df = spark.range(4000).select(F.xxhash64("id").alias("h"))
    ordered = sorted(r[0] for r in df.collect())
    assert kth_values(df, {"h": F.col("h")}, {"h": [0, 17, 2000, 3999]})["h"] == [ordered[i] for i in (0, 17, 2000, 3999)]


def test_empty_column_has_no_quantile(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert exact_quantiles(df, {"x": F.col("x")}, [0.5])["x"] == [None]


def test_global_rank_splits_a_heavy_tie(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("v")).repartition(7)
    rows = global_rank(df, [F.col("v"), F.col("id")]).orderBy("rank").collect()
    assert [r["rank"] for r in rows] == list(range(1000))
    assert [(r["v"], r["id"]) for r in rows] == sorted((r["v"], r["id"]) for r in rows)


@pytest.mark.parametrize("small", [True, False])
def test_lookup_join_equals_plain_join(spark, small):
    """One key holds a third of the rows, some keys are NULL, some are unknown."""
    left = spark.range(3000).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 11 == 0, None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
    )
    table = left.filter("k IS NOT NULL AND k <> 'k7'").groupBy("k").agg(F.count("*").alias("n"), F.avg("id").alias("v"))
    got = lookup_join(left, Lookup(table, small, "n"), ["k"], ["v"], ["id"])
    want = left.join(table.select("k", "v"), "k", "left")
    assert sorted(map(repr, got.select("id", "k", "v").collect())) == sorted(map(repr, want.select("id", "k", "v").collect()))


def test_settle_measures_size(spark, monkeypatch):
    df = spark.range(50)
    assert settle(df).small
    monkeypatch.setattr(lookups, "BROADCAST_ROWS", 10)
    large = settle(df)
    assert not large.small and large.table.count() == 50


@pytest.mark.parametrize("p", [1e-12, 1e-5, 0.02, 0.3, 0.5, 0.77, 0.999, 1 - 1e-9])
def test_normal_quantile(spark, p):
    got = spark.range(1).select(normal_quantile(F.lit(p))).first()[0]
    assert got == pytest.approx(NormalDist().inv_cdf(p), rel=1e-12, abs=1e-12)


def test_boxcox_clips_and_keeps_nulls(spark):
    df = spark.createDataFrame([(0.0,), (3.0,), (-5.0,), (None,)], "x double")
    got = [r[0] for r in df.select(boxcox1p(F.col("x"), 0.15)).collect()]
    assert got[0] == 0 and got[1] == pytest.approx((4**0.15 - 1) / 0.15)
    assert math.isfinite(got[2]) and got[3] is None
    assert df.select(boxcox1p(F.col("x"), 0)).collect()[1][0] == pytest.approx(math.log1p(3))


def test_uniform_is_in_range(spark):
    low, high, mean = spark.range(5000).select(uniform(F.xxhash64("id")).alias("u")).agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 <= low and high < 1 and mean == pytest.approx(0.5, abs=0.02)


def test_upper_tails():
    assert chi2_sf(3.841458820694124, 1) == pytest.approx(0.05, rel=1e-9)
    assert chi2_sf(18.307038053275146, 10) == pytest.approx(0.05, rel=1e-9)
    assert chi2_sf(100.0, 2) == pytest.approx(math.exp(-50), rel=1e-10)
    assert f_sf(4.964602743730711, 1, 10) == pytest.approx(0.05, rel=1e-7)
    assert f_sf(1.0, 7, 7) == pytest.approx(0.5, rel=1e-9)
    assert normal_sf(1.959963984540054) == pytest.approx(0.025, rel=1e-9)


def test_column_helpers(spark):
    df = spark.createDataFrame([(1, "a", float("nan")), (2, None, 1.0)], "`1st Flr SF` int, s string, `a.b` double")
    assert numeric_columns(df) == ["1st Flr SF", "a.b"]
    assert df.select(F.count_if(missing(df, "a.b"))).first()[0] == 1
    with pytest.raises(KeyError):
        require(df, ["absent"])
    with pytest.raises(ValueError):
        require_unique(df.select(F.lit(1).alias("k")), ["k"])
