"""Pairs of consecutive months of one client: last month's revenue beside the next month's."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.functions.dates import date_value, shift_months

Date = str | dt.date


def _pair_up(revenue: DataFrame) -> DataFrame:
    """Self join of (client, month) with (client, next month), done in one shuffle.

    Revenue holds one row per client and month, so the only candidate partner of a row is the client's following row
    and a window finds it without shuffling and sorting the table twice. A client's group is as long as the calendar.
    A second row for the same client and month would break that reasoning and fails the job.
    """
    following = Window.partitionBy("clientID").orderBy("month")
    repeated = F.raise_error(F.lit("revenue holds two rows for one clientID and month")).cast("boolean")
    return (
        revenue.where(F.col("clientID").isNotNull() & F.col("month").isNotNull())
        .select(
            "clientID",
            "month",
            F.lead("month").over(following).alias("nextMonth"),
            F.col("revenue").alias("revenueLastMonth"),
            F.lead("revenue").over(following).alias("revenue"),
            F.row_number().over(following).alias("_row"),
            F.dense_rank().over(following).alias("_month"),
        )
        .where(
            F.when(F.col("_row") > F.col("_month"), repeated).otherwise(
                F.col("nextMonth") == shift_months(F.col("month"))
            )
        )
        .drop("_row", "_month")
    )


def training_pairs(revenue: DataFrame, start: Date, end: Date) -> DataFrame:
    """Pairs whose previous month lies in [start, end]; the label month may lie after ``end``."""
    start, end = date_value(start), date_value(end)
    needed = revenue.where(F.col("month").between(start, shift_months(end)))
    return _pair_up(needed).where(F.col("month") <= end)


def evaluation_pairs(revenue: DataFrame, start: Date, end: Date) -> DataFrame:
    """Pairs whose next month lies in [start, end]."""
    start, end = date_value(start), date_value(end)
    needed = revenue.where(F.col("month").between(shift_months(start, -1), end))
    return _pair_up(needed).where(F.col("nextMonth") >= start)


def all_pairs(revenue: DataFrame) -> DataFrame:
    return _pair_up(revenue)
