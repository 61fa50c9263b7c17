"""Error measures as aggregate and scalar expressions. NULL pairs are left out by the aggregates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def difference(actual: Column, predicted: Column) -> Column:
    """Actual minus predicted, in double whatever the two types are."""
    return actual.cast("double") - predicted.cast("double")


def rmse(error: Column) -> Column:
    return F.sqrt(F.avg(F.pow(error, 2)))


def rmse_from_parts(squares: Column, rows: Column) -> Column:
    """The same from sums of squared errors and counts of errors, NULL without errors."""
    return F.sqrt(F.sum(squares) / F.nullif(F.sum(rows), F.lit(0)))


def max_abs_error(error: Column) -> Column:
    return F.max(F.abs(error))


def mse(actual: Column, predicted: Column) -> Column:
    return F.avg(F.pow(difference(actual, predicted), 2))


def r2_from_parts(rows: Column, mean_squared_error: Column, label_variance: Column) -> Column:
    """1 - MSE / var(y). Under two rows NaN; a constant label gives 1 for an exact fit, else 0."""
    constant_label = F.when(mean_squared_error == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    return (
        F.when(rows < 2, F.lit(float("nan")))
        .when(label_variance == 0, constant_label)
        .otherwise(1 - mean_squared_error / label_variance)
    )


def r2(actual: Column, predicted: Column) -> Column:
    return r2_from_parts(F.count(actual), mse(actual, predicted), F.var_pop(actual.cast("double")))
