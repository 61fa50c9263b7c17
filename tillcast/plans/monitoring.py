"""Append the metrics row of the newest month."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame

from tillcast.contracts import METRIC_PARTS
from tillcast.operators import monitoring
from tillcast.sources import sinks


def _append(metrics: DataFrame, table: str, if_absent: bool) -> None:
    spark = metrics.sparkSession
    if if_absent and spark.catalog.tableExists(table):
        metrics = monitoring.metrics_to_add(metrics, spark.table(table))
    sinks.append_incremental(metrics, table)


def add_metrics(revenue: DataFrame, predictions: DataFrame, table: str, if_absent: bool = False) -> None:
    """Each run appends again; with ``if_absent`` a month the table has is left alone."""
    _append(monitoring.monitor_metrics(revenue, predictions), table, if_absent)


def update_parts(revenue: DataFrame, predictions: DataFrame, parts: str, redo: Sequence[dt.date] = ()) -> DataFrame:
    """Bring the stored error sums of the newest months up to date, month by month, and read them.

    The table is partitioned by month; a month's partition is replaced whole, so a run that is repeated adds nothing.
    """
    spark = revenue.sparkSession
    sinks.create_table_if_absent(spark, parts, METRIC_PARTS, sinks.Layout(partition_by=("month",)))
    new = monitoring.new_parts(revenue, predictions, spark.table(parts), redo)
    if new is not None:
        sinks.overwrite_partitions(new, parts)
        spark.catalog.refreshTable(parts)
    return spark.table(parts)


def add_metrics_by_parts(
    revenue: DataFrame,
    predictions: DataFrame,
    parts: str,
    table: str,
    if_absent: bool = False,
    redo: Sequence[dt.date] = (),
) -> None:
    """``add_metrics``, which joins only months that are new or have got rows since their sums were stored."""
    held = update_parts(revenue, predictions, parts, redo)
    _append(monitoring.metrics_from_parts(revenue, predictions, held), table, if_absent)
