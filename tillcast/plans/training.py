"""Train candidates and evaluate models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.contracts import FEATURES
from tillcast.operators.ledger import Ledger, experiment_id, find_latest_model
from tillcast.operators.ledger_write import evaluation_rows, training_rows
from tillcast.operators.pairs import Date, evaluation_pairs, training_pairs
from tillcast.operators.regression import (
    CANDIDATES,
    LinearModel,
    Setting,
    as_moments,
    collect_moments,
    linear_errors,
    models_frame,
    moments,
    solve,
)
from tillcast.operators.scoring import evaluate_scored, linear_prediction
from tillcast.operators.split import TEST_SIZE, find_split, is_training
from tillcast.session import stage


def train(
    pairs: DataFrame,
    settings: Sequence[Setting] = CANDIDATES,
    holdout: str = "oldest",
    test_size: float = TEST_SIZE,
) -> DataFrame:
    """Models fitted on the training part with ``mse`` and ``r2`` on the test part.

    The pairs are stored once; after the split point is known a single aggregate gives the moments of both parts.
    """
    pairs = stage(pairs, "pairs")
    point = find_split(pairs, holdout, test_size)
    by_part = moments(pairs.groupBy(is_training(point).alias("training")))
    parts = {row.training: as_moments(row) for row in by_part.collect()}
    if True not in parts:
        raise ValueError(f"{point.rows} pairs leave no training rows")
    if False not in parts:
        raise ValueError(f"{point.rows} pairs leave no test rows")
    models = [solve(parts[True], setting) for setting in settings]
    tested = pairs.where(~is_training(point))
    trained = linear_errors(models_frame(pairs.sparkSession, models), parts[False], tested)
    return trained.withColumn("n", F.lit(parts[True].n).cast("bigint"))


def run_training(
    ledger: Ledger,
    revenue: DataFrame,
    start: Date,
    end: Date,
    experiment: str,
    model_name: str,
    start_time: int,
    settings: Sequence[Setting] = CANDIDATES,
    holdout: str = "oldest",
) -> dict[str, DataFrame]:
    """Train on a range of months; the ledger rows with run, metrics, tag and model of each setting."""
    number = experiment_id(ledger, experiment)
    trained = train(training_pairs(revenue, start, end), settings, holdout)
    return training_rows(trained, number, model_name, start_time)


def evaluate_models(models: DataFrame, pairs: DataFrame) -> DataFrame:
    """``n``, ``mse`` and ``r2`` of every linear model over the same pairs."""
    return linear_errors(models, collect_moments(pairs), pairs)


def run_evaluation(
    ledger: Ledger, revenue: DataFrame, start: Date, end: Date, experiment: str, start_time: int
) -> dict[str, DataFrame]:
    """Evaluate every logged model of the experiment; the ledger rows, one run per model."""
    models = ledger.logged_models.where(F.col("experiment_id") == experiment_id(ledger, experiment))
    return evaluation_rows(evaluate_models(models, evaluation_pairs(revenue, start, end)), start_time)


def evaluate_latest(ledger: Ledger, experiment: str, rows: DataFrame, features=FEATURES, label="revenue") -> DataFrame:
    """The newest model of the experiment scored on any rows: model_uri, source_run_id, n, mse, r2."""
    latest = find_latest_model(ledger, experiment)
    model = LinearModel(True, False, 0, latest.intercept, tuple(latest.coefficients))
    scored = rows.select(F.col(label).alias("revenue"), linear_prediction(model, features).alias("predictedRevenue"))
    return evaluate_scored(scored).select(
        F.lit(latest.model_uri).alias("model_uri"), F.lit(latest.source_run_id).alias("source_run_id"), "n", "mse", "r2"
    )
