"""Table contracts: column lists and the schema each model is written to."""

# Table columns.
CLIENTS = "clientID int, clientName string, clientCountry string"
PRODUCTS = "productID int, productName string, price int"
SALES = "clientID int, productID int, date date, amount int"
FACT_SALES = "clientID int, productID int, date date, amount int, totalPrice int"
REVENUE = "clientID int, month date, revenue bigint"
PREDICTIONS = "clientID int, month date, predictedRevenue float, modelURI string"
LEGACY_PREDICTIONS = "clientID int, month date, predictedRevenue float"
METRICS = "month date, RMSE_1 double, RMSE_2 double, RMSE_3 double, maxErrorLastMonth double, modelURI string"

# Sums that monitoring keeps for each month and model, and how many rows both tables had for the month then.
METRIC_PARTS = (
    "modelURI string, compared bigint, squares double, largest double, revenueRows bigint, predictionRows bigint, month date"
)

# Model name -> schema and alias it is written to.
TABLES = {
    "source1_clients": "dwh_source1.clients",
    "source1_products": "dwh_source1.products",
    "source1_sales": "dwh_source1.sales",
    "source2_clients": "dwh_source2.clients",
    "source2_products": "dwh_source2.products",
    "source2_sales": "dwh_source2.sales",
    "raw_sales": "dwh_raw.sales",
    "dim_clients": "dwh_dim.clients",
    "dim_products": "dwh_dim.products",
    "fact_sales": "dwh_fact.sales",
    "fact_clients_total_revenue": "dwh_fact.clients_total_revenue",
    "predictions": "dwh_fact.clients_total_revenue_predictions",
    "legacy_predictions": "dwh_fact.client_total_revenue_predictions",
    "metrics": "dwh_ml_metrics.clients_total_revenue_predictions_metrics",
}

# Column order of model features.
FEATURES = ["clientID", "revenueLastMonth"]
LABEL = "revenue"


def table_name(model: str, prefix: str = "") -> str:
    """``schema.alias`` of a model; ``prefix`` keeps several warehouses apart in one catalog."""
    schema, alias = TABLES[model].split(".")
    return f"{prefix}{schema}.{alias}"
