"""The experiment ledger as tables, and searches over it.

Deleted rows are hidden from searches unless the view says otherwise.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, fields, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.functions.dates import epoch_ms_value
from tillcast.functions.text import registered_uri

# Lifecycle and stage names, tag keys.
ACTIVE, DELETED = "active", "deleted"
PRODUCTION, ARCHIVED, NO_STAGE, DELETED_STAGE = "Production", "Archived", "None", "Deleted_Internal"
EVALUATED, CREATED, SOURCE_RUN = "evaluated_model_uri", "created_model_uri", "evaluated_model_source_run_id"

COLUMNS = {
    "experiments": "experiment_id bigint, name string, lifecycle_stage string",
    "runs": "run_uuid string, experiment_id bigint, start_time bigint, lifecycle_stage string, artifact_uri string",
    "metrics": "run_uuid string, key string, value double",
    "latest_metrics": "run_uuid string, key string, value double",
    "params": "run_uuid string, key string, value string",
    "tags": "run_uuid string, key string, value string",
    "logged_models": "model_id string, experiment_id bigint, source_run_id string, model_uri string, "
    "artifact_location string, creation_timestamp bigint, intercept double, coefficients array<double>",
    "model_versions": "name string, version int, source string, run_id string, current_stage string, status string",
    "registered_models": "name string, lifecycle_stage string",
    "aliases": "name string, alias string, version int",
}
#: Tables that a ledger may lack: what soft deletes changed. Of kind ``run`` (which run hid which name), ``name`` and
#: ``version`` (the stage or the alias that a version had when its name, or it alone, was hidden).
OPTIONAL = {"changes": "kind string, run_uuid string, name string, version int, stage string, alias string"}
RUN_TABLES = ("metrics", "params", "tags", "latest_metrics", "runs")


@dataclass(frozen=True)
class Ledger:
    experiments: DataFrame
    runs: DataFrame
    metrics: DataFrame
    latest_metrics: DataFrame
    params: DataFrame
    tags: DataFrame
    logged_models: DataFrame
    model_versions: DataFrame
    registered_models: DataFrame
    aliases: DataFrame
    changes: DataFrame | None = None

    def with_tables(self, **tables: DataFrame) -> Ledger:
        return replace(self, **tables)

    def tables(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self) if getattr(self, f.name) is not None}


def by_view(df: DataFrame, view: str = ACTIVE) -> DataFrame:
    """Rows by lifecycle: ``active``, ``deleted`` or ``all``."""
    if view not in (ACTIVE, DELETED, "all"):
        raise ValueError(f"view is 'active', 'deleted' or 'all', not {view!r}")
    return df if view == "all" else df.where(F.col("lifecycle_stage") == view)


def visible_versions(versions: DataFrame) -> DataFrame:
    return versions.where(F.col("current_stage") != DELETED_STAGE)


# ---- experiments -------------------------------------------------------------------------------------------------


def experiments_by_name(ledger: Ledger, names: Sequence[str], view: str = ACTIVE) -> DataFrame:
    return by_view(ledger.experiments, view).where(F.col("name").isin(*names))


def experiment_id(ledger: Ledger, name: str, view: str = ACTIVE) -> int:
    row = experiments_by_name(ledger, [name], view).first()
    if row is None:
        raise ValueError(f"no experiment is called {name!r}")
    return row.experiment_id


# ---- runs --------------------------------------------------------------------------------------------------------


def runs_of_experiments(ledger: Ledger, experiments: DataFrame, view: str = ACTIVE) -> DataFrame:
    """Runs of the given experiments, with the experiment's name."""
    named = experiments.select("experiment_id", F.col("name").alias("experiment"))
    return by_view(ledger.runs, view).join(named, "experiment_id")


def run_by_id(ledger: Ledger, run_ids: DataFrame) -> DataFrame:
    """Runs, deleted ones too, of a frame with ``run_uuid``."""
    return ledger.runs.join(run_ids.select("run_uuid").distinct(), "run_uuid", "left_semi")


def runs_after(runs: DataFrame, moment: dt.datetime) -> DataFrame:
    return runs.where(F.col("start_time") >= epoch_ms_value(moment))


def latest_runs(runs: DataFrame) -> DataFrame:
    """Newest run of each experiment; of several started together the first by id."""
    newest = F.min_by("run_uuid", F.struct(-F.col("start_time"), F.col("run_uuid")))
    return runs.groupBy("experiment_id").agg(newest.alias("run_uuid"), F.max("start_time").alias("start_time"))


def _wide(long_rows: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    """One row per run with a column per key; keys are known, so one aggregate does it."""
    return (
        long_rows.where(F.col("key").isin(*keys))
        .groupBy("run_uuid")
        .agg(*[F.max(F.when(F.col("key") == key, F.col("value"))).alias(prefix + key) for key in keys])
    )


KINDS = {"metrics": "latest_metrics", "params": "params", "tags": "tags"}
#: Columns that discovered keys may become at most; maps take any number of keys.
MOST_COLUMNS = 2000


def runs_wide(
    ledger: Ledger,
    runs: DataFrame,
    metrics: Sequence[str] = (),
    tags: Sequence[str] = (),
    params: Sequence[str] = (),
) -> DataFrame:
    """Runs with ``metrics_<key>``, ``params_<key>`` and ``tags_<key>`` columns; NULL where a run lacks the key."""
    for kind, keys in (("metrics", metrics), ("params", params), ("tags", tags)):
        if keys:
            runs = runs.join(_wide(getattr(ledger, KINDS[kind]), keys, f"{kind}_"), "run_uuid", "left")
    return runs


def run_keys(ledger: Ledger, runs: DataFrame) -> DataFrame:
    """(kind, key) of every metric, param and tag that the runs have, distinct before the shuffle."""
    found = None
    for kind, table in KINDS.items():
        rows = getattr(ledger, table).join(runs.select("run_uuid"), "run_uuid", "left_semi")
        keys = rows.select(F.lit(kind).alias("kind"), "key").distinct()
        found = keys if found is None else found.unionByName(keys)
    return found


def runs_with_all_keys(ledger: Ledger, runs: DataFrame, most: int = MOST_COLUMNS) -> DataFrame:
    """Runs with a column for every key that any of them has, by kind and name; more than ``most`` keys are an error, as
    no frame takes any number of columns (``runs_with_maps`` does with keys)."""
    found = run_keys(ledger, runs).orderBy("kind", "key").limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"the runs have more than {most} keys; take them as maps")
    return runs_wide(ledger, runs, **{kind: [r.key for r in found if r.kind == kind] for kind in KINDS})


def runs_with_maps(ledger: Ledger, runs: DataFrame) -> DataFrame:
    """Runs with their metrics, params and tags, one map column each, whatever keys there are; empty where a run has
    none. One value a key, the greatest, as in columns."""
    for kind, table in KINDS.items():
        values = getattr(ledger, table).groupBy("run_uuid", "key").agg(F.max("value").alias("value"))
        maps = values.groupBy("run_uuid").agg(F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias(kind))
        of_type = maps.schema[kind].dataType
        runs = runs.join(maps, "run_uuid", "left").withColumn(kind, F.coalesce(kind, F.create_map().cast(of_type)))
    return runs


def search_runs(
    ledger: Ledger,
    experiments: Sequence[int] | None = None,
    view: str = ACTIVE,
    metrics: Sequence[str] = (),
    tags: Sequence[str] = (),
    condition: Column | None = None,
    order_by: Sequence[Column] = (),
    max_results: int | None = None,
) -> DataFrame:
    """Wide runs by experiment, lifecycle and any condition on their columns, in order, up to a number of results."""
    runs = by_view(ledger.runs, view)
    if experiments is not None:
        runs = runs.where(F.col("experiment_id").isin(*experiments))
    found = runs_wide(ledger, runs, metrics, tags)
    if condition is not None:
        found = found.where(condition)
    if order_by:
        found = found.orderBy(*order_by)
    return found if max_results is None else found.limit(max_results)


def _rank_columns(metrics: dict[str, str]) -> list[Column]:
    """Sort keys that are all ascending: values, then NaN, then NULL, for both directions."""
    if not metrics:
        raise ValueError("name at least one metric")
    wrong = sorted(set(metrics.values()) - {"highest", "lowest"})
    if wrong:
        raise ValueError(f"metrics are 'highest' or 'lowest', not {wrong}")
    columns = []
    for key, direction in metrics.items():
        value = F.col(f"metrics_{key}")
        columns += [value.isNull(), -value if direction == "highest" else value]
    return columns


def best_runs(ledger: Ledger, runs: DataFrame, metrics: dict[str, str]) -> DataFrame:
    """Best run of each experiment and the URI of its model: the evaluated one, else the created one.

    The winner is a minimum over a struct of sort keys, which is partly computed before the shuffle: no experiment's
    runs gather in one task. The winners, one row per experiment, are used once: the tags of the two keys are joined
    with them and folded by run.
    """
    rank = [c.alias(f"k{i}") for i, c in enumerate([*_rank_columns(metrics), F.col("run_uuid")])]
    kept = ["run_uuid", *[f"metrics_{key}" for key in metrics]]
    measured = runs.select("run_uuid", "experiment_id").join(
        _wide(ledger.latest_metrics, list(metrics), "metrics_"), "run_uuid", "left"
    )
    winner = F.min_by(F.struct(*kept), F.struct(*rank)).alias("best")
    best = measured.groupBy("experiment_id").agg(winner).select("experiment_id", "best.*")
    tags = ledger.tags.where(F.col("key").isin(EVALUATED, CREATED))
    uri = [F.max(F.when(F.col("key") == key, F.col("value"))) for key in (EVALUATED, CREATED)]
    found = tags.join(best, "run_uuid", "right").groupBy("experiment_id", *kept)
    return found.agg(F.coalesce(*uri).alias("model_uri"))


def best_model_uri(ledger: Ledger, experiment: str, metrics: dict[str, str]) -> str:
    _rank_columns(metrics)
    number = experiment_id(ledger, experiment)
    row = best_runs(ledger, by_view(ledger.runs).where(F.col("experiment_id") == number), metrics).first()
    if row is None:
        raise ValueError(f"experiment {experiment!r} holds no runs to choose from")
    if row.model_uri is None:
        raise ValueError(f"run {row.run_uuid} has neither tag {EVALUATED} nor {CREATED}")
    return row.model_uri


# ---- models ------------------------------------------------------------------------------------------------------


def models_of_runs(ledger: Ledger, run_ids: DataFrame) -> DataFrame:
    """Logged models whose source run is in a frame of distinct ``run_uuid``."""
    return ledger.logged_models.join(
        run_ids.select(F.col("run_uuid").alias("source_run_id")), "source_run_id", "left_semi"
    )


def search_models(
    ledger: Ledger,
    experiments: Sequence[int] | None = None,
    condition: Column | None = None,
    order_by: Sequence[Column] = (),
    max_results: int | None = None,
) -> DataFrame:
    """Logged models by experiment and any condition on their columns, in order, up to a number of results."""
    found = ledger.logged_models
    if experiments is not None:
        found = found.where(F.col("experiment_id").isin(*experiments))
    if condition is not None:
        found = found.where(condition)
    if order_by:
        found = found.orderBy(*order_by)
    return found if max_results is None else found.limit(max_results)


def latest_models(logged_models: DataFrame) -> DataFrame:
    """Newest logged model of each experiment; of several made together the first by id."""
    order = F.struct(-F.col("creation_timestamp"), F.col("model_id"))
    row = F.struct(*[F.col(c) for c in logged_models.columns if c != "experiment_id"])
    return logged_models.groupBy("experiment_id").agg(F.min_by(row, order).alias("m")).select("experiment_id", "m.*")


def find_latest_model(ledger: Ledger, experiment: str):
    number = experiment_id(ledger, experiment)
    row = latest_models(ledger.logged_models.where(F.col("experiment_id") == number)).first()
    if row is None:
        raise ValueError(f"experiment '{experiment}' has no models")
    return row


def versions_by_name(ledger: Ledger, names: DataFrame) -> DataFrame:
    """Review listing of the versions of a frame of distinct ``name``."""
    return (
        visible_versions(ledger.model_versions)
        .join(names.select("name"), "name", "left_semi")
        .select("name", "version", "current_stage", "status", "run_id", "source")
    )


def registered_with_aliases(ledger: Ledger, view: str = ACTIVE) -> DataFrame:
    """Registered models and their aliases, one row per alias; a model without any keeps a row."""
    models = by_view(ledger.registered_models, view)
    bare = models.join(ledger.aliases.select("name").distinct(), "name", "left_anti")
    # Not one left join: a name with very many aliases is split over tasks by an inner join only.
    return ledger.aliases.join(models, "name").unionByName(bare, allowMissingColumns=True)


def registered_names(ledger: Ledger, run_ids: DataFrame) -> DataFrame:
    """(run_uuid, name) per run with a registered version; of several the highest version's name."""
    found = visible_versions(ledger.model_versions).select(F.col("run_id").alias("run_uuid"), "name", "version")
    return (
        found.join(run_ids.select("run_uuid"), "run_uuid", "left_semi")
        .groupBy("run_uuid")
        .agg(F.min_by("name", F.struct(-F.col("version"), F.col("name"))).alias("name"))
    )


def registered_model_names(
    ledger: Ledger, experiment: str | None = None, run_id: str | None = None
) -> DataFrame:
    """Names by experiment or by run; a name found for several runs is repeated."""
    if experiment is None and run_id is None:
        raise ValueError("give an experiment or a run")
    if experiment is not None:
        runs = by_view(ledger.runs).where(F.col("experiment_id") == experiment_id(ledger, experiment))
        return registered_names(ledger, runs).select("name")
    of_run = visible_versions(ledger.model_versions).where(F.col("run_id") == run_id)
    return of_run.orderBy(F.desc("version"), "name").limit(1).select("name")


def latest_in_stage(ledger: Ledger, stage: str = PRODUCTION) -> DataFrame:
    """Newest version of each name in a stage, with its URI."""
    return (
        ledger.model_versions.where(F.col("current_stage") == stage)
        .groupBy("name")
        .agg(F.max("version").alias("version"), F.max_by("source", "version").alias("source"))
        .withColumn("model_uri", registered_uri(F.col("name"), F.col("version")))
    )
