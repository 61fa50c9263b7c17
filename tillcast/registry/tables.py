"""Scans and sinks over catalog tables, written to a schema of their own in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tillcast.contracts import table_name
from tillcast.operators import regression
from tillcast.plans import monitoring, prediction, warehouse
from tillcast.registry import common
from tillcast.registry.common import PREDICTIONS, PRODUCTS, REVENUE, WAITING, in_dollars
from tillcast.registry.monitoring import METRICS, METRICS_COLUMNS, METRICS_SQL
from tillcast.session import new_folder, stage
from tillcast.sources import literals, retail, sinks, tables

PREDICTION_COLUMNS = "clientID bigint, month date, predictedRevenue double, modelURI string"


def _schema(spark) -> str:
    name = f"tc_{uuid.uuid4().hex[:12]}"
    sinks.create_schema(spark, name, new_folder(spark, name))
    return name


def _client_tables(spark, folder):
    revenue = stage(common.revenue(spark, folder), "revenue")
    return revenue, retail.past_predictions(revenue)


def _stored_predictions(df):
    value = F.col("predictedRevenue").cast("double").alias("predictedRevenue")
    return df.select("clientID", "month", value, "modelURI")


def src_literal_rows(spark, folder):
    """The example clients as literal rows, stacked by position on the clients of both sources."""
    example = literals.example_source(spark, 1)["clients"]
    return tables.stack_by_position(example, *[retail.clients(spark, folder, number) for number in (1, 2)])


def scan_model_table(spark, folder):
    table = f"{_schema(spark)}.products"
    sinks.rebuild_table(common.products(spark, folder), table)
    return in_dollars(tables.scan_table(spark, table), "price")


def scan_external_source(spark, folder):
    table = f"{_schema(spark)}.predictions"
    sinks.rebuild_table(_client_tables(spark, folder)[1], table)
    return tables.scan_source(spark, table, PREDICTION_COLUMNS)


def read_query_dates(spark, folder):
    query = """SELECT clientID, add_months(month, 1) AS nextMonth, CAST(revenue AS double) AS revenueLastMonth
               FROM {revenue}"""
    return tables.read_query(spark, query, ["nextMonth"], revenue=common.revenue(spark, folder))


def rename_positional(spark, folder):
    revenue = common.revenue(spark, folder)
    scored = revenue.select("clientID", F.add_months("month", 1), F.col("revenue").cast("double") * F.lit(0.5))
    return scored.toDF("clientID", "month", "predictedRevenue")


def frame_from_local(spark, folder):
    """The nations collected as local rows and made a frame again, beside how many clients each has."""
    nations = [tuple(r) for r in retail.read(spark, folder, "nation").select("n_nationkey", "n_name").collect()]
    local = tables.frame_from_local(spark, nations, ["nationID", "nationName"])
    clients = retail.read(spark, folder, "customer").groupBy(F.col("c_nationkey").cast("bigint").alias("nationID"))
    return local.join(clients.agg(F.count("*").alias("n")), "nationID", "left")


def sink_rebuild_table(spark, folder):
    """All warehouse tables from both sources; the revenue table is then rebuilt from itself."""
    name = f"tc_{uuid.uuid4().hex[:12]}_"
    sources = [retail.source(spark, folder, number) for number in (1, 2)]
    warehouse.write_warehouse(spark, sources, name, new_folder(spark, name), sinks.monthly(8))
    table = table_name("fact_clients_total_revenue", name)
    return in_dollars(sinks.rebuild_table(spark.table(table), table), "revenue")


def sink_incremental_append(spark, folder):
    """The metrics row added twice, and left alone the third time."""
    revenue, predictions = _client_tables(spark, folder)
    table = f"{_schema(spark)}.metrics"
    monitoring.add_metrics(revenue, predictions, table)
    monitoring.add_metrics(revenue, predictions, table)
    monitoring.add_metrics(revenue, predictions, table, if_absent=True)
    return spark.table(table).withColumns({name: F.round(name, 4) for name in METRICS})


def ddl_create_if_absent(spark, folder):
    """A table made once and asked for again keeps its rows: predictions per month."""
    table = f"{_schema(spark)}.predictions"
    sinks.create_table_if_absent(spark, table, PREDICTION_COLUMNS)
    sinks.append(_client_tables(spark, folder)[1], table)
    sinks.create_table_if_absent(spark, table, PREDICTION_COLUMNS)
    return spark.table(table).groupBy("month").agg(F.count(F.lit(1)).alias("n"))


def sink_append(spark, folder):
    """Past predictions, then the scored backlog, stored as int, date and 32-bit float."""
    revenue, predictions = _client_tables(spark, folder)
    table = f"{_schema(spark)}.predictions"
    columns = "clientID int, month date, predictedRevenue float, modelURI string"
    sinks.create_table_if_absent(spark, table, columns)
    sinks.append(predictions.withColumn("month", F.col("month").cast("timestamp_ntz")), table)
    model = regression.LinearModel(True, False, 0, 1000.0, (2.0, 0.5))
    prediction.predict_backlog(spark, revenue, table, model, "models:/m/3", columns)
    return _stored_predictions(spark.table(table))


def sink_overwrite_partitions(spark, folder):
    """Predictions partitioned by model; those of one model are replaced, the others stay."""
    revenue, predictions = _client_tables(spark, folder)
    table = f"{_schema(spark)}.predictions"
    sinks.create_table_if_absent(spark, table, PREDICTION_COLUMNS, sinks.Layout(("modelURI",)))
    sinks.append(predictions, table)
    newer = predictions.where(F.col("modelURI") == "models:/m/2")
    sinks.overwrite_partitions(newer.withColumn("predictedRevenue", F.col("predictedRevenue") * 2), table)
    return _stored_predictions(spark.table(table))


def sink_rebuild_partitioned(spark, folder):
    """The table partitioned by model rebuilt from itself, twice; model names hold colons and slashes."""
    revenue, predictions = _client_tables(spark, folder)
    table = f"{_schema(spark)}.predictions"
    sinks.create_table_if_absent(spark, table, PREDICTION_COLUMNS, sinks.Layout(("modelURI",)))
    sinks.append(predictions, table)
    for _ in range(2):
        half = spark.table(table).withColumn("predictedRevenue", F.col("predictedRevenue") / 2)
        sinks.rebuild_table(half, table)
    return _stored_predictions(spark.table(table))


def sink_legacy_overwrite(spark, folder):
    """The table dropped, made again and filled with a prediction for every revenue row."""
    table = f"{_schema(spark)}.predictions"
    model = regression.LinearModel(True, False, 0, 10.0, (0.5, 2.0, 0.25))
    revenue = stage(common.revenue(spark, folder), "revenue")
    columns = "clientID bigint, month date, predictedRevenue float"
    for _ in range(2):
        prediction.rebuild_predictions(spark, revenue, table, model, columns)
    return spark.table(table).withColumn("predictedRevenue", F.col("predictedRevenue").cast("double"))


QUERIES = {
    "src_literal_rows": src_literal_rows,
    "scan_model_table": scan_model_table,
    "scan_external_source": scan_external_source,
    "read_query_dates": read_query_dates,
    "rename_positional": rename_positional,
    "frame_from_local": frame_from_local,
    "sink_rebuild_table": sink_rebuild_table,
    "sink_incremental_append": sink_incremental_append,
    "ddl_create_if_absent": ddl_create_if_absent,
    "sink_append": sink_append,
    "sink_overwrite_partitions": sink_overwrite_partitions,
    "sink_rebuild_partitioned": sink_rebuild_partitioned,
    "sink_legacy_overwrite": sink_legacy_overwrite,
}

_PREDICTION = 'clientID, month, predictedRevenue AS "predictedRevenue", modelURI AS "modelURI"'

ORACLE = {
    "src_literal_rows": """
SELECT * FROM (VALUES (CAST(1 AS BIGINT), 'client_1', 'USA'), (2, 'client_2', 'France'), (3, 'client_3', 'Australia'))
    t("clientID", "clientName", "clientCountry")
UNION ALL
SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE c_custkey % 2 = 0 OR c_custkey % 5 = 0
UNION ALL
SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE c_custkey % 2 = 1 OR c_custkey % 5 = 0""",
    "scan_model_table": f"""
WITH {PRODUCTS} SELECT productID, productName, CAST(price AS DOUBLE) AS price FROM dim_products""",
    "scan_external_source": f"WITH {PREDICTIONS} SELECT {_PREDICTION} FROM predictions",
    "read_query_dates": f"""
WITH {REVENUE}
SELECT clientID, month + INTERVAL 1 MONTH AS "nextMonth", CAST(revenue AS DOUBLE) AS "revenueLastMonth" FROM revenue""",
    "rename_positional": f"""
WITH {REVENUE}
SELECT clientID, CAST(month + INTERVAL 1 MONTH AS DATE) AS month, CAST(revenue AS DOUBLE) * 0.5 AS "predictedRevenue"
FROM revenue""",
    "frame_from_local": """
SELECT CAST(n_nationkey AS BIGINT) AS "nationID", n_name AS "nationName",
       CASE WHEN count(c_custkey) > 0 THEN count(c_custkey) END AS n
FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY n_nationkey, n_name""",
    "sink_rebuild_table": f"WITH {REVENUE} SELECT clientID, month, CAST(revenue AS DOUBLE) AS revenue FROM revenue",
    "sink_incremental_append": f"""
WITH {METRICS_SQL} SELECT {METRICS_COLUMNS} FROM metrics UNION ALL SELECT {METRICS_COLUMNS} FROM metrics""",
    "ddl_create_if_absent": f"WITH {PREDICTIONS} SELECT month, count(*) AS n FROM predictions GROUP BY month",
    "sink_append": f"""
WITH {PREDICTIONS},{WAITING},
done AS (
    SELECT clientID, month, predictedRevenue, modelURI FROM predictions
    UNION ALL
    SELECT clientID, due, 1000 + 2 * CAST(clientID AS DOUBLE) + CAST(0.5 AS DOUBLE) * known, 'models:/m/3' FROM waiting
)
SELECT CAST(clientID AS INTEGER) AS clientID, month,
       CAST(CAST(predictedRevenue AS FLOAT) AS DOUBLE) AS "predictedRevenue", modelURI AS "modelURI" FROM done""",
    "sink_overwrite_partitions": f"""
WITH {PREDICTIONS}
SELECT clientID, month,
       CASE WHEN modelURI = 'models:/m/2' THEN predictedRevenue * 2 ELSE predictedRevenue END AS "predictedRevenue",
       modelURI AS "modelURI" FROM predictions""",
    "sink_rebuild_partitioned": f"""
WITH {PREDICTIONS}
SELECT clientID, month, predictedRevenue / 4 AS "predictedRevenue", modelURI AS "modelURI" FROM predictions""",
    "sink_legacy_overwrite": f"""
WITH {REVENUE}
SELECT clientID, month, CAST(CAST(10 + 0.5 * clientID + 2 * year(month) + 0.25 * month(month) AS FLOAT) AS DOUBLE)
       AS "predictedRevenue"
FROM revenue""",
}
