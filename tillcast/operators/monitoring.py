"""How good past predictions were, and whether to retrain."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.functions import errors
from tillcast.functions.dates import shift_months
from tillcast.functions.text import any_pair_matches, json_object

KEYS = ["clientID", "month"]


def latest_model_uri(predictions: DataFrame) -> DataFrame:
    """URI on the newest month's predictions, among several the first by name; no row without predictions.

    The newest month is found first, so that only its rows are read for the URI.
    """
    newest = predictions.where(F.col("month") == predictions.select(F.max("month")).scalar())
    return newest.groupBy("month").agg(F.min("modelURI").alias("modelURI")).select("modelURI")


def latest_model_predictions(predictions: DataFrame) -> DataFrame:
    """Predictions of the three newest predicted months, nulled where another model made them.

    A NULL URI is not known to differ, so its prediction stays.
    """
    latest = latest_model_uri(predictions).scalar()
    cutoff = predictions.select(shift_months(F.max("month"), -3)).scalar()
    return predictions.where(F.col("month") > cutoff).select(
        *KEYS, F.when(latest != F.col("modelURI"), None).otherwise(F.col("predictedRevenue")).alias("predictedRevenue")
    )


def newest_month(revenue: DataFrame, months_back: int = 0):
    """Newest revenue month, moved back, as a scalar subquery: it is known before the scan it filters starts."""
    return revenue.select(shift_months(F.max("month"), -months_back)).scalar()


def last_months(revenue: DataFrame, months: int = 1) -> DataFrame:
    """Revenue rows of the newest months."""
    return revenue.where(F.col("month") >= newest_month(revenue, months - 1))


def revenue_with_prediction(revenue: DataFrame, predictions: DataFrame) -> DataFrame:
    """Revenue rows beside their prediction, NULL where there is none."""
    return revenue.join(predictions.select(*KEYS, "predictedRevenue"), KEYS, "left")


def _error():
    return errors.difference(F.col("revenue"), F.col("predictedRevenue"))


def _window_metrics(revenue: DataFrame, predictions: DataFrame) -> DataFrame:
    """One row with the month, the four figures (NULL where nothing could be compared) and the latest model's URI.

    RMSE_1 and the maximum error take every model's predictions, RMSE_2 and RMSE_3 only the latest model's. The two
    newest months and the URI are looked up first, so that plain values bound both scans; then one join over three months
    feeds all figures. It is an inner join because a row without a prediction adds to no figure.
    """
    newest = F.lit(revenue.agg(F.max("month")).first()[0]).cast("date")
    newest_predicted = F.lit(predictions.agg(F.max("month")).first()[0]).cast("date")
    found = predictions.where(F.col("month") == newest_predicted).agg(F.min("modelURI")).first()[0]
    latest = F.lit(found).cast("string")

    in_three = F.col("month") >= shift_months(newest, -2)
    compared = (
        revenue.where(in_three)
        .join(predictions.where(in_three).select(*KEYS, "predictedRevenue", "modelURI"), KEYS)
        .select("month", "modelURI", _error().alias("error"))
    )
    in_two = F.col("month") >= shift_months(newest, -1)
    in_newest = F.col("month") >= newest
    other_model = F.coalesce(latest != F.col("modelURI"), F.lit(False))
    by_latest = (F.col("month") > shift_months(newest_predicted, -3)) & ~other_model
    return compared.agg(
        newest.alias("month"),
        errors.rmse(F.when(in_newest, F.col("error"))).alias("RMSE_1"),
        errors.rmse(F.when(in_two & by_latest, F.col("error"))).alias("RMSE_2"),
        errors.rmse(F.when(by_latest, F.col("error"))).alias("RMSE_3"),
        errors.max_abs_error(F.when(in_newest, F.col("error"))).alias("maxErrorLastMonth"),
        latest.alias("modelURI"),
    )


def monitor_metrics(revenue: DataFrame, predictions: DataFrame) -> DataFrame:
    """One metrics row for the newest revenue month, or none when that month has no prediction.

    Both tables are read several times: pass stored tables.
    """
    return _window_metrics(revenue, predictions).where(F.col("RMSE_1").isNotNull())


def _sizes(revenue: DataFrame, predictions: DataFrame) -> DataFrame:
    """month, and how many rows each table has for it; only the month is read."""
    rows = revenue.select("month", F.lit(1).alias("r"), F.lit(0).alias("p"))
    rows = rows.unionByName(predictions.select("month", F.lit(0).alias("r"), F.lit(1).alias("p")))
    return rows.groupBy("month").agg(F.sum("r").alias("revenueRows"), F.sum("p").alias("predictionRows"))


def error_parts(revenue: DataFrame, predictions: DataFrame) -> DataFrame:
    """A row for each month and model: count, sum of squares and maximum of the errors, and the month's row counts in both
    tables. A month in which nothing can be compared has one row without a model that counts none."""
    compared = revenue.join(predictions.select(*KEYS, "predictedRevenue", "modelURI"), KEYS)
    sums = compared.withColumn("error", _error()).groupBy("month", "modelURI")
    sums = sums.agg(
        F.count("error").alias("compared"),
        F.sum(F.pow("error", F.lit(2))).alias("squares"),
        errors.max_abs_error(F.col("error")).alias("largest"),
    )
    return (
        _sizes(revenue, predictions)
        .join(sums, "month", "left")
        .select(
            "modelURI", F.coalesce("compared", F.lit(0)).alias("compared"), "squares", "largest", "revenueRows",
            "predictionRows", "month",
        )
    )


def _window(newest: Column) -> Column:
    return F.col("month").between(shift_months(newest, -2), newest)


def new_parts(
    revenue: DataFrame, predictions: DataFrame, parts: DataFrame, redo: Sequence[dt.date] = ()
) -> DataFrame | None:
    """Parts of those of the three newest months that ``parts`` lacks or has from other row counts, and of the months in
    ``redo`` (whose values were changed in place); None where there are none.

    Only row counts are read of months whose parts hold; at most three months and ``redo`` are looked at on the driver.
    """
    newest = F.lit(revenue.agg(F.max("month")).first()[0]).cast("date")
    now = _sizes(revenue.where(_window(newest)), predictions.where(_window(newest)))
    held = parts.where(_window(newest)).select("month", "revenueRows", "predictionRows").distinct()
    months = {r.month for r in now.exceptAll(held.select(now.columns)).collect()} | set(redo)
    if not months:
        return None
    asked = F.col("month").isin(sorted(months))
    return error_parts(revenue.where(asked), predictions.where(asked))


def merged_parts(parts: DataFrame, new: DataFrame | None) -> DataFrame:
    """``parts`` with the months of ``new`` replaced."""
    if new is None:
        return parts
    return parts.join(new.select("month").distinct(), "month", "left_anti").select(new.columns).unionByName(new)


def metrics_from_parts(revenue: DataFrame, predictions: DataFrame, parts: DataFrame) -> DataFrame:
    """``monitor_metrics`` from the parts of the three newest months; of the two tables only the newest months are looked
    up, and the URI on the newest predictions."""
    newest = F.lit(revenue.agg(F.max("month")).first()[0]).cast("date")
    newest_predicted = F.lit(predictions.agg(F.max("month")).first()[0]).cast("date")
    found = predictions.where(F.col("month") == newest_predicted).agg(F.min("modelURI")).first()[0]
    latest = F.lit(found).cast("string")
    in_newest = F.col("month") == newest
    in_two = F.col("month") >= shift_months(newest, -1)
    other_model = F.coalesce(latest != F.col("modelURI"), F.lit(False))
    by_latest = (F.col("month") > shift_months(newest_predicted, -3)) & ~other_model

    def rmse(wanted: Column) -> Column:
        return errors.rmse_from_parts(F.when(wanted, F.col("squares")), F.when(wanted, F.col("compared")))

    row = parts.where(_window(newest)).agg(
        newest.alias("month"),
        rmse(in_newest).alias("RMSE_1"),
        rmse(in_two & by_latest).alias("RMSE_2"),
        rmse(by_latest).alias("RMSE_3"),
        F.max(F.when(in_newest, F.col("largest"))).alias("maxErrorLastMonth"),
        latest.alias("modelURI"),
    )
    return row.where(F.col("RMSE_1").isNotNull())


def rmse_by_window(revenue: DataFrame, predictions: DataFrame) -> DataFrame:
    """RMSE over the newest 1, 2 and 3 months, NULL where nothing could be compared."""
    names = ["RMSE_1", "RMSE_2", "RMSE_3"]
    long_rows = _window_metrics(revenue, predictions).select(*names).unpivot([], names, "name", "RMSE")
    return long_rows.select(F.substring("name", -1, 1).cast("int").alias("months"), "RMSE")


def max_error_last_month(revenue: DataFrame, predictions: DataFrame) -> DataFrame:
    return revenue_with_prediction(last_months(revenue), predictions).agg(
        errors.max_abs_error(_error()).alias("maxErrorLastMonth")
    )


def metrics_to_add(metrics: DataFrame, existing: DataFrame) -> DataFrame:
    """Metrics rows of months the metrics table does not have yet."""
    return metrics.join(existing.select("month").distinct(), "month", "left_anti").select(*metrics.columns)


def decide(metrics: DataFrame, threshold: float | str) -> DataFrame:
    """One row ``message``: JSON that tells whether the newest RMSE_1 lies above the threshold."""
    limit = F.lit(str(threshold)).cast("double")
    above = (F.col("RMSE_1") > limit) & ~F.isnan("RMSE_1")
    return (
        metrics.orderBy(F.desc("month"), F.desc_nulls_last("RMSE_1"))
        .limit(1)
        .select(json_object(should_retrain=F.coalesce(above, F.lit(False))).alias("message"))
    )


def should_retrain(metrics: DataFrame, threshold: float | str) -> str:
    """The decision message; an empty metrics table is an error."""
    row = decide(metrics, threshold).first()
    if row is None:
        raise ValueError("the metrics table is empty")
    return row.message


def should_continue(decisions: DataFrame, wanted: dict[str, object] | None) -> DataFrame:
    """Decisions with ``should_continue``: whether any wanted key/value pair is in the message."""
    return decisions.withColumn("should_continue", any_pair_matches(F.col("message"), wanted))
