"""Inputs shared by the registered queries, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.operators import warehouse as models
from tillcast.sources import retail

TRAIN_RANGE = ("1995-01-01", "2001-05-01")
EVALUATION_RANGE = ("1995-03-01", "2001-08-01")


def products(spark: SparkSession, folder: str) -> DataFrame:
    return models.dim_products(*[retail.products(spark, folder, number) for number in (1, 2)])


def fact(spark: SparkSession, folder: str) -> DataFrame:
    """Priced sales; both sources' sales come from one scan of the shared table."""
    return models.fact_sales(models.raw_sales(retail.sales(spark, folder)), products(spark, folder))


def in_dollars(df: DataFrame, column: str) -> DataFrame:
    """Whole cents as dollars: the double next to the exact amount."""
    return df.withColumn(column, F.col(column) / F.lit(100.0))


def digits(column: str, count: int = 9) -> Column:
    """A number rounded to so many significant digits."""
    value = F.col(column)
    unit = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(value))) - (count - 1))
    return F.when(value == 0, value).otherwise(F.round(value / unit) * unit)


def digits_sql(value: str, count: int = 9) -> str:
    """The same in SQL."""
    unit = f"pow(CAST(10 AS DOUBLE), floor(log10(abs({value}))) - {count - 1})"
    return f"CASE WHEN {value} = 0 THEN 0 ELSE round({value} / {unit}) * {unit} END"


def revenue(spark: SparkSession, folder: str) -> DataFrame:
    """Revenue per client and month."""
    return in_dollars(models.clients_total_revenue(fact(spark, folder)), "revenue")


SALES = """
sales AS (
    SELECT o.o_custkey AS clientID, l.l_partkey AS productID, CAST(o.o_orderdate AS DATE) AS date,
           CAST(l.l_quantity AS INTEGER) AS amount, l.l_linenumber
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
raw_sales AS (
    SELECT clientID, productID, date, amount FROM sales WHERE l_linenumber % 2 = 1
    UNION ALL
    SELECT clientID, productID, date, amount FROM sales WHERE l_linenumber % 2 = 0
)"""

PRODUCTS = """
all_products AS (
    SELECT p_partkey AS productID, p_name AS productName, CAST(p_retailprice AS DECIMAL(12,2)) AS price
    FROM part WHERE p_partkey % 2 = 0 OR p_partkey % 5 = 0
    UNION ALL
    SELECT p_partkey, p_name, CAST(p_retailprice AS DECIMAL(12,2))
    FROM part WHERE p_partkey % 2 = 1 OR p_partkey % 5 = 0
),
dim_products AS (SELECT DISTINCT productID, productName, price FROM all_products)"""

FACT = f"""{SALES},{PRODUCTS},
priced AS (
    SELECT *, amount * (SELECT max(price) FROM dim_products known WHERE known.productID = raw_sales.productID) AS paid
    FROM raw_sales
),
fact_sales AS (SELECT clientID, productID, date, amount, paid AS totalPrice FROM priced)"""

REVENUE = f"""{FACT},
revenue AS (
    SELECT clientID, CAST(strftime(date, '%Y-%m') || '-01' AS DATE) AS month, SUM(totalPrice) AS revenue
    FROM fact_sales GROUP BY clientID, CAST(strftime(date, '%Y-%m') || '-01' AS DATE)
)"""

PREDICTIONS = f"""{REVENUE},
predictions AS (
    SELECT clientID, month,
           CAST(revenue AS DOUBLE) * CAST(0.9 AS DOUBLE) + CAST(100 AS DOUBLE) * clientID AS predictedRevenue,
           CASE WHEN month < DATE '2001-06-01' THEN 'models:/m/1' ELSE 'models:/m/2' END AS modelURI
    FROM revenue
    WHERE (clientID * 31 + year(month) * 12 + month(month)) % 13 <> 5
)"""

# Revenue months that no prediction follows.
WAITING = """
waiting AS (
    SELECT clientID, CAST(month + INTERVAL 1 MONTH AS DATE) AS due, CAST(revenue AS DOUBLE) AS known FROM revenue r
    WHERE NOT EXISTS (
        SELECT 1 FROM predictions done
        WHERE done.clientID = r.clientID AND done.month = CAST(r.month + INTERVAL 1 MONTH AS DATE))
)"""

PAIRS = f"""{REVENUE},
pairs AS (
    SELECT n.clientID, p.month, n.month AS nextMonth, p.revenue AS revenueLastMonth, n.revenue
    FROM revenue p JOIN revenue n
      ON n.clientID = p.clientID AND n.month = CAST(p.month + INTERVAL 1 MONTH AS DATE)
)"""
