"""Warehouse build."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillcast.contracts import TABLES, table_name
from tillcast.operators import warehouse as models
from tillcast.sources import sinks


def build_warehouse(sources: list[dict]) -> dict[str, DataFrame]:
    """Model name -> frame, from sources with ``clients``, ``products`` and ``sales``; nothing runs yet."""
    clients = models.dim_clients(*[s["clients"] for s in sources])
    products = models.dim_products(*[s["products"] for s in sources])
    sales = models.raw_sales(*[s["sales"] for s in sources])
    fact = models.fact_sales(sales, products)
    return {
        "dim_clients": clients,
        "dim_products": products,
        "raw_sales": sales,
        "fact_sales": fact,
        "fact_clients_total_revenue": models.clients_total_revenue(fact),
    }


def create_schemas(spark: SparkSession, prefix: str = "", root: str | None = None) -> None:
    """The layer schemas; under ``root`` when given, else where the catalog puts them."""
    for schema in sorted({name.split(".")[0] for name in TABLES.values()}):
        sinks.create_schema(spark, prefix + schema, f"{root}/{schema}" if root else None)


def write_warehouse(
    spark: SparkSession,
    sources: list[dict],
    prefix: str = "",
    root: str | None = None,
    revenue_layout: sinks.Layout = sinks.PLAIN,
) -> dict[str, DataFrame]:
    """Rebuild every warehouse table; each model reads the stored tables of the models before it."""
    create_schemas(spark, prefix, root)

    def store(model: str, df: DataFrame, layout: sinks.Layout = sinks.PLAIN) -> DataFrame:
        return sinks.rebuild_table(df, table_name(model, prefix), layout)

    clients = store("dim_clients", models.dim_clients(*[s["clients"] for s in sources]))
    products = store("dim_products", models.dim_products(*[s["products"] for s in sources]))
    sales = store("raw_sales", models.raw_sales(*[s["sales"] for s in sources]))
    fact = store("fact_sales", models.fact_sales(sales, products))
    revenue = store("fact_clients_total_revenue", models.clients_total_revenue(fact), revenue_layout)
    return {
        "dim_clients": clients,
        "dim_products": products,
        "raw_sales": sales,
        "fact_sales": fact,
        "fact_clients_total_revenue": revenue,
    }
