"""Predict the months that have no prediction yet, or all of them again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast import contracts
from tillcast.operators.ledger import PRODUCTION, Ledger, latest_in_stage
from tillcast.operators.regression import LinearModel
from tillcast.operators.scoring import backlog, rescore_all, score
from tillcast.sources import sinks


def production_model(ledger: Ledger, name: str, stage: str = PRODUCTION) -> tuple[LinearModel, str]:
    """Coefficients and versioned URI of the newest version of a name in a stage."""
    version = latest_in_stage(ledger, stage).where(F.col("name") == name)
    row = version.join(
        ledger.logged_models.select(F.col("model_uri").alias("source"), "intercept", "coefficients"), "source"
    ).first()
    if row is None:
        raise ValueError(f"no version of '{name}' in stage {stage}")
    return LinearModel(True, False, 0, row.intercept, tuple(row.coefficients)), row.model_uri


def predict_backlog(
    spark: SparkSession,
    revenue: DataFrame,
    table: str,
    model: LinearModel,
    model_uri: str,
    columns: str = contracts.PREDICTIONS,
    layout: sinks.Layout = sinks.PLAIN,
) -> None:
    """Append predictions for the backlog. Backlog, scoring and append are one plan; no row leaves the executors."""
    sinks.create_table_if_absent(spark, table, columns, layout)
    sinks.append(score(backlog(revenue, spark.table(table)), model, model_uri), table)


def rebuild_predictions(
    spark: SparkSession, revenue: DataFrame, table: str, model: LinearModel, columns: str = contracts.LEGACY_PREDICTIONS
) -> None:
    """Drop the table and fill it with predictions for every revenue row."""
    sinks.drop_table(spark, table)
    sinks.create_table_if_absent(spark, table, columns)
    sinks.overwrite_partitions(rescore_all(revenue, model), table)
