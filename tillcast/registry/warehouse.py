"""Warehouse models and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillcast.functions import dates
from tillcast.operators import warehouse as models
from tillcast.registry import common
from tillcast.registry.common import FACT, PRODUCTS, REVENUE, SALES, in_dollars
from tillcast.sources import retail


def raw_sales_union(spark, folder):
    return models.raw_sales(retail.sales(spark, folder, 1), retail.sales(spark, folder, 2))


def dim_clients(spark, folder):
    return models.dim_clients(retail.clients(spark, folder, 1), retail.clients(spark, folder, 2))


def dim_products(spark, folder):
    return in_dollars(common.products(spark, folder), "price")


def fact_sales(spark, folder):
    return in_dollars(common.fact(spark, folder), "totalPrice")


def clients_total_revenue(spark, folder):
    return common.revenue(spark, folder)


def scalar_dates(spark, folder):
    text = F.date_format("o_orderdate", "yyyy-MM-dd")
    day = text.cast("date")
    return retail.read(spark, folder, "orders").select(
        "o_orderkey",
        day.alias("day"),
        F.date_format(day, "yyyy-MM").alias("yearMonth"),
        dates.month_start(day).alias("monthStart"),
        dates.month_start_from_text(day).alias("monthStartText"),
        dates.shift_months(day, 1).alias("oneLater"),
        dates.shift_months(day, -1).alias("oneEarlier"),
        dates.shift_months(day, -3).alias("threeEarlier"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        dates.epoch_ms(F.col("o_orderdate")).alias("epochMs"),
    )


def month_from_parts(spark, folder):
    revenue = common.revenue(spark, folder).select("clientID", F.year("month").alias("y"), F.month("month").alias("m"))
    return revenue.select("clientID", "y", "m", dates.month_from_parts(F.col("y"), F.col("m")).alias("month"))


QUERIES = {
    "raw_sales_union": raw_sales_union,
    "dim_clients": dim_clients,
    "dim_products": dim_products,
    "fact_sales": fact_sales,
    "clients_total_revenue": clients_total_revenue,
    "scalar_dates": scalar_dates,
    "month_from_parts": month_from_parts,
}

ORACLE = {
    "raw_sales_union": f"WITH {SALES} SELECT clientID, productID, date, amount FROM raw_sales",
    "dim_clients": """
WITH all_clients AS (
    SELECT c_custkey AS clientID, c_name AS clientName, n_name AS clientCountry
    FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 2 = 0 OR c_custkey % 5 = 0
    UNION ALL
    SELECT c_custkey, c_name, n_name
    FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 2 = 1 OR c_custkey % 5 = 0
)
SELECT DISTINCT clientID, clientName, clientCountry FROM all_clients""",
    "dim_products": f"WITH {PRODUCTS} SELECT productID, productName, CAST(price AS DOUBLE) AS price FROM dim_products",
    "fact_sales": f"""
WITH {FACT} SELECT clientID, productID, date, amount, CAST(totalPrice AS DOUBLE) AS totalPrice FROM fact_sales""",
    "clients_total_revenue": f"""
WITH {REVENUE} SELECT clientID, month, CAST(revenue AS DOUBLE) AS revenue FROM revenue""",
    "scalar_dates": """
WITH o AS (SELECT o_orderkey, o_orderdate, CAST(strftime(o_orderdate, '%Y-%m-%d') AS DATE) AS day FROM orders)
SELECT o_orderkey, day, strftime(day, '%Y-%m') AS "yearMonth",
       CAST(date_trunc('month', day) AS DATE) AS "monthStart",
       CAST(strftime(day, '%Y-%m') || '-01' AS DATE) AS "monthStartText",
       CAST(day + INTERVAL 1 MONTH AS DATE) AS "oneLater",
       CAST(day - INTERVAL 1 MONTH AS DATE) AS "oneEarlier",
       CAST(day - INTERVAL 3 MONTH AS DATE) AS "threeEarlier",
       CAST(year(day) AS INTEGER) AS year, CAST(month(day) AS INTEGER) AS month,
       epoch_ms(o_orderdate) AS "epochMs"
FROM o""",
    "month_from_parts": f"""
WITH {REVENUE}
SELECT clientID, CAST(year(month) AS INTEGER) AS y, CAST(month(month) AS INTEGER) AS m, month FROM revenue""",
}
