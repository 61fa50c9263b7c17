"""Promotion, and the whole model update."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.functions.text import any_pair_matches
from tillcast.operators.ledger import Ledger, best_model_uri
from tillcast.operators.ledger_write import add_versions, next_versions, set_alias, transition_stage
from tillcast.operators.monitoring import should_retrain
from tillcast.operators.pairs import Date
from tillcast.operators.regression import CANDIDATES, Setting
from tillcast.plans.ledger_store import append_rows, finish_step, finished_steps, open_ledger, replace_tables
from tillcast.plans.training import run_evaluation, run_training
from tillcast.session import stage

# Order in which runs are compared.
METRICS = {"mse": "lowest", "r2": "highest"}


def promote_models(ledger: Ledger, new: DataFrame) -> Ledger:
    """Register ``new`` (distinct name, source, run_id), put each new version in Production and alias it."""
    # Stored: used three times, and a join with a stored table splits a name that holds very many versions.
    return promote_versions(ledger, stage(next_versions(ledger, new), "new-versions"))


def promote_versions(ledger: Ledger, versions: DataFrame) -> Ledger:
    """Add numbered versions, one per name, put them in Production and alias them."""
    return set_alias(transition_stage(add_versions(ledger, versions), versions), versions)


def promote(ledger: Ledger, experiment: str, model_name: str, metrics: dict[str, str] = METRICS) -> Ledger:
    """Register the best model of the experiment under a name and move it to Production."""
    return promote_models(ledger, _best(ledger, experiment, model_name, metrics))


def _best(ledger: Ledger, experiment: str, model_name: str, metrics: dict[str, str] = METRICS) -> DataFrame:
    """(name, source, run_id) of the experiment's best model."""
    uri = best_model_uri(ledger, experiment, metrics)
    source = ledger.logged_models.where(F.col("model_uri") == uri).select("source_run_id").first()
    return ledger.runs.sparkSession.createDataFrame(
        [(model_name, uri, source.source_run_id if source else None)], "name string, source string, run_id string"
    )


def update_model(
    spark: SparkSession,
    schema: str,
    revenue: DataFrame,
    metrics: DataFrame,
    threshold: float | str,
    train_range: tuple[Date, Date],
    evaluation_range: tuple[Date, Date],
    experiment: str,
    model_name: str,
    start_time: int,
    settings: Sequence[Setting] = CANDIDATES,
) -> str:
    """Gate, train the candidates, evaluate every model, promote the best. Returns the decision message.

    The ledger is the stored one of ``schema``: runs are appended, and only the registry tables are rewritten. Finished
    steps are recorded there under a hash of the arguments that say what the update is about, so a call that is
    repeated after a stop keeps the first decision, goes on at the step that failed, and promotes under the version
    number chosen first; a call repeated after the end changes nothing. Another ``start_time`` is another update.
    """
    about = (train_range, evaluation_range, experiment, model_name, start_time, list(settings))
    job = hashlib.sha256(repr(about).encode()).hexdigest()[:32]
    done = finished_steps(spark, schema, job)

    def once(step: str, work: Callable[[], str | None]) -> str:
        """What the step told when it finished, now or in an earlier call."""
        if step not in done:
            done[step] = work() or ""
            finish_step(spark, schema, job, step, done[step])
        return done[step]

    def evaluate() -> None:
        ledger = open_ledger(spark, schema)
        append_rows(run_evaluation(ledger, revenue, *evaluation_range, experiment, start_time), schema)

    def train() -> None:
        ledger = open_ledger(spark, schema)
        append_rows(run_training(ledger, revenue, *train_range, experiment, model_name, start_time, settings), schema)

    def choose() -> str:
        ledger = open_ledger(spark, schema)
        return next_versions(ledger, _best(ledger, experiment, model_name)).select(F.to_json(F.struct("*"))).first()[0]

    def switch() -> None:
        ledger = open_ledger(spark, schema)
        told = spark.createDataFrame([(chosen,)], "told string")
        version = told.select(F.from_json("told", ledger.model_versions.schema).alias("v")).select("v.*")
        version = stage(version, "new-versions")
        # A switch that was stopped may have added it.
        others = ledger.model_versions.join(version.select("name", "version"), ["name", "version"], "left_anti")
        others = others.select(*ledger.model_versions.columns)
        replace_tables(ledger, promote_versions(ledger.with_tables(model_versions=others), version), schema)

    message = should_retrain(metrics, threshold) if "gate" not in done else done["gate"]
    wanted = any_pair_matches(F.lit(message), {"should_retrain": True})
    if not spark.range(1).select(wanted.alias("go")).first().go:
        return message  # not recorded: the next call decides by the metrics there are then
    once("gate", lambda: message)
    once("train", train)
    once("evaluate", evaluate)
    chosen = once("choose", choose)
    once("promote", switch)
    return message
