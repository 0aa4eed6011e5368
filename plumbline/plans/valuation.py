"""The valuation frame: one row per order that has lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ID = "o_orderkey"
TARGET = "sale_price"
NUMERIC = ["n_lines", "sum_qty", "avg_price", "max_price", "avg_disc", "yr_sold"]
TEXT = ["n_name", "c_mktsegment", "o_orderpriority", "o_orderstatus"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def line_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines reduced to one row per order before any join."""
    amount = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias(ID))
        .agg(
            F.sum(amount).alias(TARGET),
            F.count(F.lit(1)).alias("n_lines"),
            F.sum("l_quantity").alias("sum_qty"),
            F.avg("l_extendedprice").alias("avg_price"),
            F.max("l_extendedprice").alias("max_price"),
            F.avg("l_discount").alias("avg_disc"),
        )
    )


def valuation_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders x customer x nation x line totals.

    Customer and nation join by size: Spark broadcasts them below the threshold and
    otherwise shuffles, where AQE splits a customer holding many orders. Lines meet
    orders on the unique order key after aggregation, so that join cannot skew.
    """
    orders = table(spark, sf_dir, "orders").select(
        ID, "o_custkey", "o_orderpriority", "o_orderstatus", F.year("o_orderdate").alias("yr_sold")
    )
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_nationkey"
    )
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    gap = F.when(F.col(ID) % 7 == 0, F.lit(None)).otherwise(F.col("avg_disc"))
    return (
        orders.join(line_totals(spark, sf_dir), ID)
        .join(customer, "o_custkey")
        .join(nation, "c_nationkey")
        .withColumn("avg_disc", gap)
        .select(ID, TARGET, *NUMERIC[:5], *TEXT, "yr_sold")
    )
