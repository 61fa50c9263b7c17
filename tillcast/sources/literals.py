"""The two example source systems as literal rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession

from tillcast import contracts
from tillcast.sources.tables import literal_rows

# Both sources hold the same clients and products.
CLIENT_ROWS = [(1, "client_1", "USA"), (2, "client_2", "France"), (3, "client_3", "Australia")]
PRODUCT_ROWS = [(1, "product_1", 1), (2, "product_2", 2)]
# clientID, productID, date, amount in source 1, amount in source 2.
SALES_ROWS = [
    (1, 1, dt.date(2025, 1, 1), 10, 5),
    (1, 2, dt.date(2025, 2, 1), 2, 4),
    (2, 1, dt.date(2025, 3, 1), 5, 2),
    (3, 2, dt.date(2025, 4, 1), 4, 8),
    (3, 2, dt.date(2025, 5, 1), 4, 4),
    (3, 2, dt.date(2025, 6, 1), 4, 4),
]


def example_source(spark: SparkSession, number: int) -> dict:
    """Frames ``clients``, ``products`` and ``sales`` of source 1 or 2."""
    sales = [(client, product, date, amounts[number - 1]) for client, product, date, *amounts in SALES_ROWS]
    return {
        "clients": literal_rows(spark, CLIENT_ROWS, contracts.CLIENTS),
        "products": literal_rows(spark, PRODUCT_ROWS, contracts.PRODUCTS),
        "sales": literal_rows(spark, sales, contracts.SALES),
    }
