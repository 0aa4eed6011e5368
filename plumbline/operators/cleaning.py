"""Cleaning, macro columns and dataset summaries."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import IDENTIFIERS, MACRO, TARGET, YEAR_SOLD, MacroConfig
from ..functions.columns import as_double, batches, col, missing, numeric_columns, require, string_columns
from ..functions.order_stats import exact_quantiles


def drop_identifiers(df: DataFrame, names: Iterable[str] = IDENTIFIERS) -> DataFrame:
    """Identifier columns carry no signal; absent ones are tolerated."""
    return df.drop(*names)


def add_macro_features(df: DataFrame, macro: MacroConfig = MACRO, year_sold: str = YEAR_SOLD) -> DataFrame:
    require(df, [year_sold])
    return df.withColumns(
        {
            "Mortgage_Rate_30yr": F.lit(macro.mortgage_rate_30yr),
            "CPI": F.lit(macro.cpi),
            "Years_Since_Sale": F.lit(macro.reference_year) - col(year_sold),
            "Market_Adjustment_Factor": F.lit(macro.adjustment_factor),
        }
    )


def split_features_target(df: DataFrame, target: str = TARGET) -> tuple[DataFrame, DataFrame]:
    """Features and target as projections of the same rows."""
    require(df, [target])
    return df.drop(target), df.select(col(target))


def missing_counts(df: DataFrame) -> DataFrame:
    """(column_name, missing, total_missing): one aggregation over all columns."""
    counts = df.agg(*[F.count_if(missing(df, c)).alias(f"m{i}") for i, c in enumerate(df.columns)])
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"m{i}").alias("missing"))
            for i, c in enumerate(df.columns)
        ]
    )
    total = F.aggregate(pairs, F.lit(0).cast("long"), lambda acc, p: acc + p["missing"])
    return counts.select(F.explode(pairs).alias("p"), total.alias("total_missing")).select(
        "p.column_name", "p.missing", "total_missing"
    )


def data_summary(df: DataFrame, target: str = TARGET, accuracy: int | None = None) -> DataFrame:
    """One row: shape, type counts, missing values and target mean, median and sample spread."""
    shape = [
        F.lit(len(df.columns)).alias("n_columns"),
        F.lit(len(numeric_columns(df))).alias("n_numeric"),
        F.lit(len(string_columns(df))).alias("n_categorical"),
    ]
    blanks = F.lit(0).cast("long")
    for part in batches(df.columns, 100):
        for c in part:
            blanks = blanks + F.count_if(missing(df, c))
    aggregates = [F.count(F.lit(1)).alias("n_rows"), blanks.alias("missing_values")]
    if target in df.columns:
        y = as_double(df, target)
        if accuracy is None:
            median = F.lit(exact_quantiles(df, {"y": y}, [0.5])["y"][0]).cast("double")
        else:
            median = F.percentile_approx(y, 0.5, accuracy)
        aggregates += [F.avg(y).alias("target_mean"), F.stddev_samp(y).alias("target_std")]
    else:
        median = F.lit(None).cast("double")
        aggregates += [
            F.any_value(median).alias("target_mean"),
            F.any_value(median).alias("target_std"),
        ]
    if accuracy is not None and target in df.columns:
        aggregates.append(median.alias("target_median"))
        return df.agg(*aggregates).select("*", *shape)
    return df.agg(*aggregates).select("*", median.alias("target_median"), *shape)
