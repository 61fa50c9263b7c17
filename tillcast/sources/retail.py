"""The retail Parquet tables seen as the two source systems of the warehouse.

Clients and products sit in source 1 or 2 by the parity of their key, and in both when it divides by 5; sales are split
by the parity of the line number. Keys stay bigint: at a large scale factor they pass the int range. Prices, and so
sales and revenue, are whole cents: exact like decimals, at the cost of integer sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def _in_source(key: str, number: int) -> Column:
    return (F.col(key) % 2 == number - 1) | (F.col(key) % 5 == 0)


def clients(spark: SparkSession, folder: str, number: int) -> DataFrame:
    nation = read(spark, folder, "nation").select("n_nationkey", "n_name")
    customer = read(spark, folder, "customer").where(_in_source("c_custkey", number))
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("clientID"),
        F.col("c_name").alias("clientName"),
        F.col("n_name").alias("clientCountry"),
    )


def products(spark: SparkSession, folder: str, number: int) -> DataFrame:
    return (
        read(spark, folder, "part")
        .where(_in_source("p_partkey", number))
        .select(
            F.col("p_partkey").alias("productID"),
            F.col("p_name").alias("productName"),
            F.round(F.col("p_retailprice") * 100).cast("bigint").alias("price"),
        )
    )


def sales(spark: SparkSession, folder: str, number: int | None = None) -> DataFrame:
    """Sales of one source, or of both read in one scan when no number is given."""
    lines = read(spark, folder, "lineitem")
    if number is not None:
        lines = lines.where(F.col("l_linenumber") % 2 == number % 2)
    orders = read(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("clientID"),
        F.col("l_partkey").alias("productID"),
        F.col("o_orderdate").cast("date").alias("date"),
        F.col("l_quantity").cast("int").alias("amount"),
    )


def source(spark: SparkSession, folder: str, number: int) -> dict:
    return {
        "clients": clients(spark, folder, number),
        "products": products(spark, folder, number),
        "sales": sales(spark, folder, number),
    }


def past_predictions(revenue: DataFrame) -> DataFrame:
    """A predictions table for the revenue months up to the newest, with a model change, and with holes by client and
    month: no client and no month is complete."""
    hole = (F.col("clientID") * 31 + F.year("month") * 12 + F.month("month")) % 13 == 5
    value = F.col("revenue").cast("double") * F.lit(0.9) + F.lit(100.0) * F.col("clientID")
    return revenue.where(~hole).select(
        "clientID",
        "month",
        value.alias("predictedRevenue"),
        F.when(F.col("month") < F.lit("2001-06-01").cast("date"), "models:/m/1")
        .otherwise("models:/m/2")
        .alias("modelURI"),
    )
