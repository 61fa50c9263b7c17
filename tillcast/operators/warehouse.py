"""Warehouse models: stacked sources, dimensions, priced sales and monthly revenue."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.functions.dates import month_start


def stack_sources(*frames: DataFrame) -> DataFrame:
    """UNION ALL by name; duplicates stay."""
    return reduce(DataFrame.unionByName, frames)


def dim_clients(*clients: DataFrame) -> DataFrame:
    return stack_sources(*[c.select("clientID", "clientName", "clientCountry") for c in clients]).distinct()


def dim_products(*products: DataFrame) -> DataFrame:
    """Distinct whole rows: a product with two prices stays as two rows."""
    return stack_sources(*[p.select("productID", "productName", "price") for p in products]).distinct()


def raw_sales(*sales: DataFrame) -> DataFrame:
    return stack_sources(*[s.select("clientID", "productID", "date", "amount") for s in sales])


def fact_sales(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Sales with their price; a sale of an unknown product keeps its row with a NULL total."""
    priced = sales.join(products.select("productID", "price"), "productID", "left")
    return priced.select(
        "clientID", "productID", "date", "amount", (F.col("price") * F.col("amount")).alias("totalPrice")
    )


def clients_total_revenue(fact: DataFrame) -> DataFrame:
    """Revenue per client and month: one row per (clientID, month)."""
    return fact.groupBy("clientID", month_start(F.col("date")).alias("month")).agg(
        F.sum("totalPrice").alias("revenue")
    )
