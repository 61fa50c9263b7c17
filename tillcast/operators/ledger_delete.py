"""Soft and hard deletes and restores. Each returns a new ledger; nothing is changed in place.

Ids to delete come as a frame, joined with ``left_anti``: there is no list of ids in a query text, and a run that holds
a large share of a table is on the side of the join whose oversized partitions are split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.functions.text import name_of, version_of
from tillcast.operators.ledger import (
    ACTIVE,
    DELETED,
    DELETED_STAGE,
    OPTIONAL,
    RUN_TABLES,
    Ledger,
    by_view,
    experiment_id,
    registered_names,
    visible_versions,
)
from tillcast.session import stage


def _mark(df: DataFrame, ids: DataFrame, key: str, column: str, value: Column) -> DataFrame:
    """``df`` with ``column`` set to ``value`` in the rows whose ``key`` is in ``ids``, which holds no key twice."""
    marked = ids.select(key).withColumn("_hit", F.lit(True))
    return (
        df.join(marked, key, "left")
        .withColumn(column, F.when(F.col("_hit"), value).otherwise(F.col(column)))
        .select(*df.columns)
    )


def _without(df: DataFrame, ids: DataFrame, **keys: str) -> DataFrame:
    """``df`` without the rows whose columns (keyword names) equal the given columns of ``ids``."""
    wanted = ids.select(*[F.col(theirs).alias(ours) for ours, theirs in keys.items()])
    return df.join(wanted, list(keys), "left_anti").select(*df.columns)


# ---- runs --------------------------------------------------------------------------------------------------------


def soft_delete_runs(ledger: Ledger, run_ids: DataFrame) -> Ledger:
    """Hide runs and the registered models, all versions, whose name was found for them; ``restore_runs`` undoes it."""
    run_ids = run_ids.select("run_uuid").distinct()
    names = stage(registered_names(ledger, run_ids), "names")
    hidden = ledger.with_tables(runs=_mark(ledger.runs, run_ids, "run_uuid", "lifecycle_stage", F.lit(DELETED)))
    after = soft_delete_names(hidden, names)
    return after.with_tables(changes=_changes(after, "run", names))


def soft_delete_names(ledger: Ledger, names: DataFrame) -> Ledger:
    # Stored: used several times, and a join with a stored table splits a name that holds very many versions.
    names = stage(names.select("name").distinct(), "names")
    return ledger.with_tables(
        aliases=_without(ledger.aliases, names, name="name"),
        registered_models=_mark(ledger.registered_models, names, "name", "lifecycle_stage", F.lit(DELETED)),
        model_versions=_mark(ledger.model_versions, names, "name", "current_stage", F.lit(DELETED_STAGE)),
        changes=_changes(ledger, "name", _state(ledger, names, ["name"])),
    )


def _state(ledger: Ledger, hidden: DataFrame, keys: list[str]) -> DataFrame:
    """(name, version, stage, alias): the stages of the visible versions that go, and their aliases."""
    stages = visible_versions(ledger.model_versions).join(hidden, keys, "left_semi")
    stages = stages.select("name", "version", F.col("current_stage").alias("stage"))
    gone = ledger.aliases.join(hidden, keys, "left_semi").select("name", "version", "alias")
    return stages.unionByName(gone, allowMissingColumns=True)


def _changes(ledger: Ledger, kind: str, rows: DataFrame) -> DataFrame:
    """The ledger's changes with further rows, whose other columns are NULL."""
    columns = [field.split() for field in OPTIONAL["changes"].split(", ")]
    rows = rows.withColumn("kind", F.lit(kind))
    new = rows.select(*[(F.col(c) if c in rows.columns else F.lit(None)).cast(t).alias(c) for c, t in columns])
    new = stage(new, "changes")  # read by every table that an undo gives back
    return new if ledger.changes is None else ledger.changes.unionByName(new)


def _undo(ledger: Ledger, kind: str, hidden: DataFrame, keys: list[str]) -> Ledger:
    """Give back the stages and aliases that changes of a kind tell of ``hidden`` (distinct keys), and forget these
    changes. An alias that points elsewhere by now stays there."""
    told = stage(ledger.changes.where(F.col("kind") == kind).join(hidden, keys, "left_semi"), "changes")
    stages = told.where("stage IS NOT NULL").groupBy("name", "version").agg(F.max("stage").alias("_stage"))
    versions = ledger.model_versions.join(stages, ["name", "version"], "left")
    back = F.when(F.col("current_stage") == DELETED_STAGE, F.col("_stage"))
    versions = versions.withColumn("current_stage", F.coalesce(back, "current_stage"))
    lost = told.where("alias IS NOT NULL").groupBy("name", "alias").agg(F.max("version").alias("version"))
    lost = lost.join(ledger.aliases.select("name", "alias").distinct(), ["name", "alias"], "left_anti")
    kinds = [kind, "run"] if kind == "name" else [kind]
    over = ledger.changes.where(F.col("kind").isin(kinds)).join(hidden, keys, "left_anti")
    return ledger.with_tables(
        model_versions=versions.select(*ledger.model_versions.columns),
        aliases=ledger.aliases.unionByName(lost.select(*ledger.aliases.columns)),
        changes=ledger.changes.where(~F.col("kind").isin(kinds)).unionByName(over.select(*ledger.changes.columns)),
    )


def hard_delete_runs(ledger: Ledger, run_ids: DataFrame) -> Ledger:
    """Remove runs from the five run tables."""
    gone = {table: _without(getattr(ledger, table), run_ids, run_uuid="run_uuid") for table in RUN_TABLES}
    if ledger.changes is not None:
        gone["changes"] = _without(ledger.changes, run_ids, run_uuid="run_uuid")
    return ledger.with_tables(**gone)


def hard_delete_models(ledger: Ledger, models: DataFrame) -> Ledger:
    """Remove logged models, the versions made from them, and names left without versions."""
    kept = _without(ledger.logged_models, models, model_id="model_id")
    return delete_versions_by_source(ledger.with_tables(logged_models=kept), models)


def artifact_paths(models: DataFrame, runs: DataFrame) -> DataFrame:
    """Where the files of models and runs lie, for deleting them by hand."""
    return models.select(F.col("artifact_location").alias("path")).union(runs.select("artifact_uri"))


def delete_run(ledger: Ledger, run_id: str, experiment: str, hard_delete: bool = False) -> tuple[Ledger, DataFrame]:
    """The ledger without (or with hidden) run, and the artifact paths."""
    number = experiment_id(ledger, experiment)
    run = ledger.runs.where(F.col("run_uuid") == run_id)
    if run.isEmpty():
        raise ValueError(f"no run has the id {run_id!r}")
    models = ledger.logged_models.where((F.col("experiment_id") == number) & (F.col("source_run_id") == run_id))
    paths = artifact_paths(models, run)
    result = soft_delete_runs(ledger, run)
    if hard_delete:
        result = hard_delete_models(hard_delete_runs(result, run), models)
    return result, paths


# ---- experiments -------------------------------------------------------------------------------------------------


def delete_experiment(ledger: Ledger, experiment: str, hard_delete: bool = False) -> tuple[Ledger, DataFrame]:
    """The ledger without (or with hidden) experiment, runs and models, and the artifact paths."""
    number = experiment_id(ledger, experiment)
    runs = by_view(ledger.runs).where(F.col("experiment_id") == number)
    models = ledger.logged_models.where(F.col("experiment_id") == number)
    paths = artifact_paths(models, runs)
    result = soft_delete_runs(ledger, runs)
    hit = F.col("experiment_id") == number
    if not hard_delete:
        hidden = F.when(hit, F.lit(DELETED)).otherwise(F.col("lifecycle_stage"))
        return result.with_tables(experiments=ledger.experiments.withColumn("lifecycle_stage", hidden)), paths
    result = hard_delete_models(hard_delete_runs(result, runs), models)
    return result.with_tables(experiments=ledger.experiments.where(~hit)), paths


def restore_runs(ledger: Ledger, run_ids: DataFrame) -> Ledger:
    """Show runs again, and the names that were hidden with them: versions get the stages that they had, and aliases
    come back."""
    run_ids = run_ids.select("run_uuid").distinct()
    shown = ledger.with_tables(runs=_mark(ledger.runs, run_ids, "run_uuid", "lifecycle_stage", F.lit(ACTIVE)))
    if ledger.changes is None:
        return shown
    names = ledger.changes.where("kind = 'run'").join(run_ids, "run_uuid", "left_semi").select("name").distinct()
    names = stage(names, "names")
    models = _mark(ledger.registered_models, names, "name", "lifecycle_stage", F.lit(ACTIVE))
    return _undo(shown.with_tables(registered_models=models), "name", names, ["name"])


def restore_version(ledger: Ledger, name: str, version: int) -> Ledger:
    """Show one version again that was hidden alone, with the stage and the aliases that it had."""
    if ledger.changes is None:
        return ledger
    one = ledger.model_versions.where((F.col("name") == name) & (F.col("version") == version))
    return _undo(ledger, "version", one.select("name", "version").distinct(), ["name", "version"])


def restore_experiment(ledger: Ledger, experiment: str) -> Ledger:
    """Show a soft-deleted experiment again; its runs are restored on their own."""
    number = experiment_id(ledger, experiment, view=DELETED)
    shown = F.when(F.col("experiment_id") == number, F.lit(ACTIVE)).otherwise(F.col("lifecycle_stage"))
    return ledger.with_tables(experiments=ledger.experiments.withColumn("lifecycle_stage", shown))


# ---- registry ----------------------------------------------------------------------------------------------------


def orphan_names(ledger: Ledger) -> DataFrame:
    """Names of registered models without any version."""
    return ledger.registered_models.join(_names_with_versions(ledger), "name", "left_anti").select("name").distinct()


def _names_with_versions(ledger: Ledger) -> DataFrame:
    """Distinct before the shuffle: a name may hold a large share of all versions."""
    return ledger.model_versions.select("name").distinct()


def drop_orphans(ledger: Ledger) -> Ledger:
    """Without names that have no version, and without aliases of versions that are not there."""
    models, aliases = ledger.registered_models, ledger.aliases
    kept = models.join(_names_with_versions(ledger), "name", "left_semi").select(*models.columns)
    versions = ledger.model_versions.select("name", "version")
    pointing = aliases.join(versions, ["name", "version"], "left_semi").select(*aliases.columns)
    return ledger.with_tables(registered_models=kept, aliases=pointing)


def delete_versions_by_source(ledger: Ledger, models: DataFrame) -> Ledger:
    """Remove the versions registered from the given models (``model_uri``), then orphans."""
    kept = _without(ledger.model_versions, models, source="model_uri")
    return drop_orphans(ledger.with_tables(model_versions=kept))


def delete_versions_by_name(ledger: Ledger, names_versions: DataFrame) -> Ledger:
    """Remove versions listed as ``name:version`` in column ``name_version``, then orphans."""
    pairs = names_versions.select(
        name_of(F.col("name_version")).alias("name"), version_of(F.col("name_version")).alias("version")
    )
    kept = _without(ledger.model_versions, pairs, name="name", version="version")
    return drop_orphans(ledger.with_tables(model_versions=kept))


def delete_registry_models(
    ledger: Ledger, models: DataFrame | None = None, names_versions: DataFrame | None = None
) -> Ledger:
    if models is not None:
        return delete_versions_by_source(ledger, models)
    if names_versions is not None:
        return delete_versions_by_name(ledger, names_versions)
    raise ValueError("give models or names_versions")


def delete_registered_version(ledger: Ledger, name: str, version: int, hard_delete: bool = False) -> Ledger:
    """Hide one version, or remove it together with a name it leaves without versions; its aliases go either way."""
    hit = (F.col("name") == name) & (F.col("version") == version)
    if hard_delete:
        return drop_orphans(ledger.with_tables(model_versions=ledger.model_versions.where(~hit)))
    hidden = F.when(hit, F.lit(DELETED_STAGE)).otherwise(F.col("current_stage"))
    one = ledger.model_versions.where(hit).select("name", "version").distinct()
    return ledger.with_tables(
        model_versions=ledger.model_versions.withColumn("current_stage", hidden),
        aliases=ledger.aliases.where(~hit),
        changes=_changes(ledger, "version", _state(ledger, one, ["name", "version"])),
    )
