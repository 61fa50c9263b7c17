"""Monitoring of predictions and the retraining gate."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillcast.operators import monitoring
from tillcast.registry import common
from tillcast.registry.common import PREDICTIONS
from tillcast.session import stage
from tillcast.sources import retail

THRESHOLDS = (1000.0, 1e12)
METRICS = ["RMSE_1", "RMSE_2", "RMSE_3", "maxErrorLastMonth"]


def _tables(spark, folder):
    """Revenue as a stored table, which monitoring reads several times, and the predictions over it."""
    revenue = stage(common.revenue(spark, folder), "revenue")
    return revenue, retail.past_predictions(revenue)


def _rounded(df, *names):
    return df.withColumns({name: F.round(name, 4) for name in names})


def latest_model_uri(spark, folder):
    return monitoring.latest_model_uri(_tables(spark, folder)[1])


def predictions_latest_model(spark, folder):
    return monitoring.latest_model_predictions(_tables(spark, folder)[1])


def revenue_last_months(spark, folder):
    revenue = stage(common.revenue(spark, folder), "revenue")
    return monitoring.last_months(revenue, 3)


def revenue_vs_prediction(spark, folder):
    return monitoring.revenue_with_prediction(*_tables(spark, folder))


def rmse_windows(spark, folder):
    return _rounded(monitoring.rmse_by_window(*_tables(spark, folder)), "RMSE")


def max_error_last_month(spark, folder):
    return _rounded(monitoring.max_error_last_month(*_tables(spark, folder)), "maxErrorLastMonth")


def monitor_metrics(spark, folder):
    return _rounded(monitoring.monitor_metrics(*_tables(spark, folder)), *METRICS)


def monitor_error_parts(spark, folder):
    return _rounded(monitoring.error_parts(*_tables(spark, folder)), "largest").withColumn("squares", common.digits("squares"))


def monitor_metrics_from_parts(spark, folder):
    """The sums as they were before the newest month came and half the clients' predictions of the month before it, then
    brought up to date."""
    revenue, predictions = _tables(spark, folder)
    newest = F.lit(revenue.agg(F.max("month")).first()[0])
    late = (F.col("month") >= F.add_months(newest, -1)) & (F.col("clientID") % 2 == 0)
    before = monitoring.error_parts(revenue.where(F.col("month") < newest), predictions.where(~late))
    before = stage(before, "parts")
    held = monitoring.merged_parts(before, monitoring.new_parts(revenue, predictions, before))
    return _rounded(monitoring.metrics_from_parts(revenue, predictions, held), *METRICS)


def _decisions(spark, folder):
    """The decision under a threshold below the error and one above it."""
    metrics = monitoring.monitor_metrics(*_tables(spark, folder))
    low, high = (monitoring.decide(metrics, t).withColumn("threshold", F.lit(t).cast("double")) for t in THRESHOLDS)
    return low.unionByName(high)


def gate_should_retrain(spark, folder):
    return _decisions(spark, folder)


def gate_any_match(spark, folder):
    return monitoring.should_continue(_decisions(spark, folder), {"should_retrain": True, "forced": True})


QUERIES = {
    "latest_model_uri": latest_model_uri,
    "predictions_latest_model": predictions_latest_model,
    "revenue_last_months": revenue_last_months,
    "revenue_vs_prediction": revenue_vs_prediction,
    "rmse_windows": rmse_windows,
    "max_error_last_month": max_error_last_month,
    "monitor_metrics": monitor_metrics,
    "monitor_error_parts": monitor_error_parts,
    "monitor_metrics_from_parts": monitor_metrics_from_parts,
    "gate_should_retrain": gate_should_retrain,
    "gate_any_match": gate_any_match,
}

# Ranks count months back from the newest of a table: 0 is the newest.
_LATEST = f"""{PREDICTIONS},
ends AS (SELECT max(month) AS last_paid FROM revenue),
predicted_ends AS (SELECT max(month) AS last_told FROM predictions),
newest_model AS (
    SELECT min(modelURI) AS uri FROM predictions, predicted_ends WHERE month = last_told
),
told AS (
    SELECT p.clientID, p.month, p.predictedRevenue AS guess, p.modelURI = uri AS by_newest,
           datediff('month', p.month, last_told) AS told_back
    FROM predictions p, predicted_ends, newest_model
),
judged AS (
    SELECT r.month, datediff('month', r.month, last_paid) AS back, by_newest AND told_back < 3 AS counts,
           CAST(r.revenue AS DOUBLE) - guess AS miss
    FROM revenue r JOIN told USING (clientID, month) CROSS JOIN ends
    WHERE datediff('month', r.month, last_paid) < 3
),
figures AS (
    SELECT sqrt(avg(miss * miss) FILTER (WHERE back = 0)) AS one,
           sqrt(avg(miss * miss) FILTER (WHERE back < 2 AND counts)) AS two,
           sqrt(avg(miss * miss) FILTER (WHERE counts)) AS three,
           max(abs(miss)) FILTER (WHERE back = 0) AS worst
    FROM judged
)"""
METRICS_SQL = f"""{_LATEST},
metrics AS (
    SELECT last_paid AS month, one, two, three, worst, uri FROM figures, ends, newest_model WHERE one IS NOT NULL
)"""
METRICS_COLUMNS = """month, round(one, 4) AS "RMSE_1", round(two, 4) AS "RMSE_2", round(three, 4) AS "RMSE_3",
       round(worst, 4) AS "maxErrorLastMonth", uri AS "modelURI\""""

_GATE = f"""
WITH {METRICS_SQL},
limits AS (SELECT unnest([{', '.join(f'CAST({t!r} AS DOUBLE)' for t in THRESHOLDS)}]) AS threshold),
gate AS (
    SELECT threshold, one > threshold AS go,
           '{{"should_retrain":' || CASE WHEN one > threshold THEN 'true' ELSE 'false' END || '}}' AS message
    FROM metrics, limits
)"""

ORACLE = {
    "latest_model_uri": f'WITH {_LATEST} SELECT uri AS "modelURI" FROM newest_model',
    "predictions_latest_model": f"""
WITH {_LATEST}
SELECT clientID, month, CASE WHEN by_newest THEN guess END AS "predictedRevenue" FROM told WHERE told_back < 3""",
    "revenue_last_months": f"""
WITH {common.REVENUE}
SELECT clientID, month, CAST(revenue AS DOUBLE) AS revenue FROM revenue
WHERE month >= (SELECT CAST(max(month) - INTERVAL 2 MONTH AS DATE) FROM revenue)""",
    "revenue_vs_prediction": f"""
WITH {PREDICTIONS}
SELECT clientID, month, CAST(revenue AS DOUBLE) AS revenue, told."predictedRevenue" AS "predictedRevenue"
FROM revenue LEFT JOIN predictions AS told USING (month, clientID)""",
    "rmse_windows": f"""
WITH {_LATEST}
SELECT unnest([1, 2, 3]) AS months, unnest([round(one, 4), round(two, 4), round(three, 4)]) AS "RMSE" FROM figures""",
    "max_error_last_month": f"""
WITH {_LATEST} SELECT round(worst, 4) AS "maxErrorLastMonth" FROM figures""",
    "monitor_metrics": f"WITH {METRICS_SQL} SELECT {METRICS_COLUMNS} FROM metrics",
    "monitor_error_parts": f"""
WITH {PREDICTIONS},
paid AS (SELECT month, count(*) AS "revenueRows" FROM revenue GROUP BY month),
told AS (SELECT month, count(*) AS "predictionRows" FROM predictions GROUP BY month),
missed AS (
    SELECT month, "modelURI", CAST(revenue AS DOUBLE) - "predictedRevenue" AS miss
    FROM predictions JOIN revenue USING (clientID, month)
),
sums AS (
    SELECT month, "modelURI", count(*) AS compared, sum(miss * miss) AS total, max(abs(miss)) AS worst
    FROM missed GROUP BY month, "modelURI"
)
SELECT month, "modelURI", coalesce(compared, 0) AS compared, {common.digits_sql("total")} AS squares,
       round(worst, 4) AS largest, "revenueRows", coalesce("predictionRows", 0) AS "predictionRows"
FROM paid LEFT JOIN told USING (month) LEFT JOIN sums USING (month)""",
    "monitor_metrics_from_parts": f"WITH {METRICS_SQL} SELECT {METRICS_COLUMNS} FROM metrics",
    "gate_should_retrain": f"{_GATE} SELECT message, threshold FROM gate",
    "gate_any_match": f"{_GATE} SELECT message, threshold, go AS should_continue FROM gate",
}
