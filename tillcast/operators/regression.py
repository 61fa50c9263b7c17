"""Linear least squares from moments, and the error of linear models from the same moments.

One aggregate gives count, means and covariances; a fit needs nothing else, and neither does the error of any linear
model on those rows. So fitting two settings and scoring thousands of models costs one pass over the rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, GroupedData, Row, SparkSession
from pyspark.sql import functions as F

from tillcast.contracts import FEATURES, LABEL
from tillcast.functions.errors import r2_from_parts

MODEL_COLUMNS = "fit_intercept boolean, positive boolean, n bigint, intercept double, coefficients array<double>"


@dataclass(frozen=True)
class LinearModel:
    fit_intercept: bool
    positive: bool
    n: int
    intercept: float
    coefficients: tuple[float, ...]


@dataclass(frozen=True)
class Setting:
    fit_intercept: bool = True
    positive: bool = True


@dataclass(frozen=True)
class Moments:
    """Count, incomplete rows, means and covariances of features and label; the label comes last."""

    n: int
    incomplete: int
    means: tuple[float, ...]
    covariances: tuple[tuple[float, ...], ...]

    def check(self) -> None:
        if not self.n:
            raise ValueError("no rows to fit or evaluate a model on")
        if self.incomplete:
            raise ValueError(f"{self.incomplete} rows have no value for a feature or the label")


# The two candidates that every retraining compares.
CANDIDATES = (Setting(True, True), Setting(False, False))


def moments(
    rows: DataFrame | GroupedData, features: Sequence[str] = FEATURES, label: str = LABEL
) -> DataFrame:
    """Columns of ``Moments``: one row, or one per group."""
    columns = [F.col(c).cast("double") for c in [*features, label]]
    complete = F.lit(True)
    for column in columns:
        complete = complete & column.isNotNull()

    def covariance(i: int, j: int) -> Column:
        # Equal up to rounding of the last digit; written once per unordered pair so that it is computed once.
        return F.covar_pop(columns[min(i, j)], columns[max(i, j)])

    width = range(len(columns))
    return rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(~complete).alias("incomplete"),
        F.array(*[F.avg(c) for c in columns]).alias("means"),
        F.array(*[F.array(*[covariance(i, j) for j in width]) for i in width]).alias("covariances"),
    )


def as_moments(row: Row) -> Moments:
    return Moments(row.n, row.incomplete, tuple(row.means), tuple(map(tuple, row.covariances)))


def collect_moments(rows: DataFrame, features: Sequence[str] = FEATURES, label: str = LABEL) -> Moments:
    """The one row of moments, all that a fit or an evaluation brings to the driver."""
    return as_moments(moments(rows, features, label).first())


def _solve(gram: np.ndarray, cross: np.ndarray) -> np.ndarray:
    """Solution of the normal equations; the shortest one when they leave a choice."""
    if not len(cross):
        return cross
    scale = np.sqrt(np.diag(gram))
    if np.all(scale > 0):
        # Features differ by many orders of magnitude, so the rank is judged on their correlations.
        scaled = gram / np.outer(scale, scale)
        if np.linalg.matrix_rank(scaled, tol=1e-12, hermitian=True) == len(cross):
            return np.linalg.solve(scaled, cross / scale) / scale
    return np.linalg.pinv(gram, rcond=1e-12, hermitian=True) @ cross


def _solve_positive(gram: np.ndarray, cross: np.ndarray) -> np.ndarray:
    """Best solution without negative entries, by an active set: entries join where the error falls fastest, and leave
    where the unbounded solution of the joined ones would take them below zero."""
    solution, joined = np.zeros(len(cross)), np.zeros(len(cross), bool)
    scale = np.sqrt(np.maximum(np.diag(gram), np.finfo(float).tiny))
    level = 1e-12 * max(1e-300, float(np.max(np.abs(cross) / scale, initial=0.0)))
    for _ in range(3 * len(cross) + 1):
        fall = np.where(joined, -np.inf, (cross - gram @ solution) / scale)
        if joined.all() or fall.max() <= level:
            break
        joined[int(fall.argmax())] = True
        while joined.any():
            kept = np.flatnonzero(joined)
            free = np.zeros(len(cross))
            free[kept] = _solve(gram[np.ix_(kept, kept)], cross[kept])
            below = joined & (free <= 0)
            if not below.any():
                solution = free
                break
            step = np.min(solution[below] / (solution[below] - free[below]))
            solution = np.where(joined, solution + step * (free - solution), 0.0)
            joined &= ~(below & (solution <= 1e-15 * np.max(np.abs(free))))
            solution[~joined] = 0.0
    return solution


def solve(found: Moments, setting: Setting) -> LinearModel:
    found.check()
    means, covariances = np.array(found.means), np.array(found.covariances)
    feature_means, label_mean = means[:-1], means[-1]
    gram, cross = covariances[:-1, :-1], covariances[:-1, -1]
    if not setting.fit_intercept:
        gram = gram + np.outer(feature_means, feature_means)
        cross = cross + feature_means * label_mean
    coefficients = (_solve_positive if setting.positive else _solve)(gram, cross)
    intercept = label_mean - coefficients @ feature_means if setting.fit_intercept else 0.0
    return LinearModel(
        setting.fit_intercept, setting.positive, found.n, float(intercept), tuple(float(c) for c in coefficients)
    )


def fit_linear(
    rows: DataFrame,
    settings: Sequence[Setting] = CANDIDATES,
    features: Sequence[str] = FEATURES,
    label: str = LABEL,
) -> list[LinearModel]:
    """One model per setting from one pass over ``rows``."""
    found = collect_moments(rows, features, label)
    return [solve(found, setting) for setting in settings]


def models_frame(spark: SparkSession, models: Sequence[LinearModel]) -> DataFrame:
    rows = [(m.fit_intercept, m.positive, m.n, m.intercept, list(m.coefficients)) for m in models]
    return spark.createDataFrame(rows, MODEL_COLUMNS)


#: Residual variance, as a share of the label's, below which moments have too few digits left for it.
SMALL = 1e-9


def _merge(factors: Iterator[np.ndarray], width: int) -> np.ndarray:
    """The triangle of all rows of the given blocks: R of QR, with as many rows as columns, zeros if there are fewer."""
    triangle = np.zeros((width, width))
    for block in factors:
        found = np.linalg.qr(np.vstack([triangle, block]), mode="r")
        triangle = np.zeros((width, width))
        triangle[: len(found)] = found
    return triangle


#: Triangles that come to the driver at most; those of more partitions are merged in Spark first.
MOST_TRIANGLES = 64


def triangle_of(rows: DataFrame, features: Sequence[str] = FEATURES, label: str = LABEL) -> np.ndarray:
    """The triangular factor of the matrix (1, features, label) of all rows, by tall-skinny QR.

    Every partition folds its rows into a triangle of its own, and triangles are merged like rows. As R = Q'A keeps
    lengths, the residuals of a linear model over all rows are as long as R (-intercept, -coefficients, 1): nothing is
    squared before it is subtracted, so models that fit to many digits have exact errors too.
    """
    columns = [F.lit(1.0).alias("one"), *(F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate([*features, label]))]
    width = len(columns)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = (np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns]) for b in batches if b.num_rows)
        yield pa.RecordBatch.from_pydict({"r": [_merge(blocks, width).ravel().tolist()]})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = (np.reshape(r, (width, width)) for b in batches for r in b.column("r").to_pylist())
        yield pa.RecordBatch.from_pydict({"r": [_merge(blocks, width).ravel().tolist()]})

    folded = rows.select(*columns).mapInArrow(fold, "r array<double>")
    merged = folded.repartition(MOST_TRIANGLES).mapInArrow(merge, "r array<double>")
    return _merge((np.reshape(row.r, (width, width)) for row in merged.collect()), width)


def linear_errors(
    models: DataFrame,
    found: Moments,
    rows: DataFrame | None = None,
    features: Sequence[str] = FEATURES,
    label: str = LABEL,
) -> DataFrame:
    """Adds ``n``, ``mse`` and ``r2`` to models (``intercept``, ``coefficients``) for the rows behind the moments.

    With residual r = y - a - b.x: mse = mean(r)^2 + var(r), and var(r) = var(y) - 2 b.cov(x, y) + b'.cov(x).b.
    The moments are plain numbers here, so this is a projection of the models: rows + models of work, not rows x models.
    The errors of models whose residual variance is below ``SMALL`` of the label's come from the triangular factor of
    the rows, made once and for any number of them; without rows they are an error. So is a model with other than one
    coefficient a feature.
    """
    found.check()
    *feature_means, label_mean = found.means
    last = len(feature_means)
    fits = F.coalesce(F.size("coefficients") == last, F.lit(False))
    about = F.col("model_uri") if "model_uri" in models.columns else F.lit("a model")
    wrong = F.concat(about, F.lit(f" has not the {last} coefficients of the features"))
    checked = F.when(fits, F.col("coefficients")).otherwise(F.raise_error(wrong).cast("array<double>"))
    models = models.withColumn("coefficients", checked)
    b = [F.get("coefficients", F.lit(i)) for i in range(last)]
    bias = F.lit(label_mean) - F.col("intercept")
    spread = F.lit(found.covariances[last][last])
    for i in range(last):
        bias = bias - b[i] * F.lit(feature_means[i])
        spread = spread - b[i] * F.lit(2 * found.covariances[i][last])
        for j in range(last):
            spread = spread + b[i] * b[j] * F.lit(found.covariances[i][j])
    variance = F.lit(found.covariances[last][last])
    measured = models.withColumn("n", F.lit(found.n).cast("bigint")).withColumns(
        {"mse": bias * bias + F.greatest(spread, F.lit(0.0)), "_small": spread < SMALL * variance}
    )
    if measured.where("_small").limit(1).count():
        if rows is None:
            raise ValueError("models fit too closely for moments; give rows")
        weights = [-F.col("intercept"), *(-c for c in b), F.lit(1.0)]
        length = F.lit(0.0)
        for line in triangle_of(rows, features, label).tolist():
            part = F.lit(0.0)
            for value, weight in zip(line, weights, strict=True):
                if value:
                    part = part + F.lit(value) * weight
            length = length + part * part
        measured = measured.withColumn("mse", F.when(F.col("_small"), length / found.n).otherwise(F.col("mse")))
    return measured.drop("_small").withColumn("r2", r2_from_parts(F.col("n"), F.col("mse"), variance))
