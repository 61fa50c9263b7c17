"""Logging runs, registering versions and promoting them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.operators.ledger import (
    ACTIVE,
    ARCHIVED,
    COLUMNS,
    CREATED,
    EVALUATED,
    NO_STAGE,
    PRODUCTION,
    SOURCE_RUN,
    Ledger,
)


def _add(table: DataFrame, rows: DataFrame) -> DataFrame:
    return table.unionByName(rows.select(*table.columns))


def run_id_for(kind: str, *columns: str) -> Column:
    """Id of a new run, made from what the run is about: a recomputed task gives the same id again."""
    return F.substring(F.sha2(F.concat_ws("|", F.lit(kind), *[F.col(c).cast("string") for c in columns]), 256), 1, 32)


def _long(new: DataFrame, columns: list[str]) -> DataFrame:
    """One (run_uuid, key, value) row per listed column."""
    return new.unpivot("run_uuid", columns, "key", "value")


def evaluation_rows(evaluations: DataFrame, start_time: int) -> dict[str, DataFrame]:
    """New ledger rows for evaluated models, each in a run of its own.

    ``evaluations`` has experiment_id, model_uri, source_run_id, mse and r2.
    """
    new = (
        evaluations.withColumn("start_time", F.lit(start_time).cast("bigint"))
        .withColumn("run_uuid", run_id_for("evaluate", "model_uri", "start_time"))
        .withColumn("lifecycle_stage", F.lit(ACTIVE))
        .withColumn("artifact_uri", F.concat_ws("/", F.lit("runs:"), F.col("run_uuid"), F.lit("artifacts")))
    )
    metrics = _long(new, ["mse", "r2"])
    tagged = new.withColumnsRenamed({"model_uri": EVALUATED, "source_run_id": SOURCE_RUN})
    return {"runs": new, "metrics": metrics, "latest_metrics": metrics, "tags": _long(tagged, [EVALUATED, SOURCE_RUN])}


def training_rows(trained: DataFrame, experiment: int, model_name: str, start_time: int) -> dict[str, DataFrame]:
    """New ledger rows for trained models, each in a run of its own.

    ``trained`` has fit_intercept, positive, n, intercept, coefficients, mse and r2.
    """
    new = (
        trained.withColumn("experiment_id", F.lit(experiment).cast("bigint"))
        .withColumn("start_time", F.lit(start_time).cast("bigint"))
        .withColumn("name", F.lit(model_name))
        .withColumn("run_uuid", run_id_for("train", "name", "fit_intercept", "positive", "start_time"))
        .withColumn("model_id", F.concat(F.lit("m-"), run_id_for("model", "run_uuid")))
        .withColumn("model_uri", F.concat(F.lit("models:/"), F.col("model_id")))
        .withColumn("lifecycle_stage", F.lit(ACTIVE))
        .withColumn("artifact_uri", F.concat_ws("/", F.lit("runs:"), F.col("run_uuid"), F.lit("artifacts")))
        .withColumn("artifact_location", F.concat_ws("/", F.lit("artifacts:"), F.col("model_id")))
        .withColumn("source_run_id", F.col("run_uuid"))
        .withColumn("creation_timestamp", F.col("start_time"))
    )
    metrics = _long(new, ["mse", "r2"])
    settings = [F.col(c).cast("string").alias(c) for c in ("fit_intercept", "positive")]
    return {
        "runs": new,
        "metrics": metrics,
        "latest_metrics": metrics,
        "params": _long(new.select("run_uuid", *settings), ["fit_intercept", "positive"]),
        "tags": new.select("run_uuid", F.lit(CREATED).alias("key"), F.col("model_uri").alias("value")),
        "logged_models": new,
    }


def next_versions(ledger: Ledger, new: DataFrame) -> DataFrame:
    """Version rows for ``new`` (distinct name, source, run_id): the number after the highest one of the name."""
    highest = ledger.model_versions.groupBy("name").agg(F.max("version").alias("highest"))
    return new.join(highest, "name", "left").select(
        "name",
        (F.coalesce(F.col("highest"), F.lit(0)) + 1).cast("int").alias("version"),
        "source",
        "run_id",
        F.lit(NO_STAGE).alias("current_stage"),
        F.lit("READY").alias("status"),
    )


def register(ledger: Ledger, new: DataFrame) -> Ledger:
    """Add one version per name of ``new`` (distinct name, source, run_id)."""
    return add_versions(ledger, next_versions(ledger, new))


def add_versions(ledger: Ledger, versions: DataFrame) -> Ledger:
    """Add numbered versions, one per name, and the names that are new; a name deleted before shows again."""
    names = versions.select("name")
    others = ledger.registered_models.join(names, "name", "left_anti").select(*ledger.registered_models.columns)
    return ledger.with_tables(
        model_versions=_add(ledger.model_versions, versions),
        registered_models=_add(others, names.withColumn("lifecycle_stage", F.lit(ACTIVE))),
    )


def transition_stage(
    ledger: Ledger, chosen: DataFrame, stage: str = PRODUCTION, archive_existing: bool = True
) -> Ledger:
    """Move the chosen (name, version), one per name, to a stage; versions that were there go to Archived."""
    target = chosen.select("name", F.col("version").alias("_chosen"))
    was_there = F.col("_chosen").isNotNull() & (F.col("current_stage") == stage) & F.lit(archive_existing)
    moved = (
        F.when(F.col("version") == F.col("_chosen"), F.lit(stage))
        .when(was_there, F.lit(ARCHIVED))
        .otherwise(F.col("current_stage"))
    )
    versions = ledger.model_versions
    return ledger.with_tables(
        model_versions=versions.join(target, "name", "left")
        .withColumn("current_stage", moved)
        .select(*versions.columns)
    )


def set_alias(ledger: Ledger, chosen: DataFrame, alias: str = PRODUCTION) -> Ledger:
    """Point an alias of each chosen name at the chosen version."""
    new = chosen.select("name", F.lit(alias).alias("alias"), "version")
    others = ledger.aliases.join(new, ["name", "alias"], "left_anti").select(*ledger.aliases.columns)
    return ledger.with_tables(aliases=_add(others, new))


def empty_ledger(spark: SparkSession) -> Ledger:
    return Ledger(**{table: spark.createDataFrame([], columns) for table, columns in COLUMNS.items()})
