"""Experiment-ledger searches, deletes, registration and promotion."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from tillcast.operators import ledger as search
from tillcast.operators import ledger_delete as delete
from tillcast.operators import ledger_search as texts
from tillcast.operators import ledger_write as write
from tillcast.operators.pairs import evaluation_pairs
from tillcast.plans import ledger_store, training, update
from tillcast.registry.common import EVALUATION_RANGE, digits, revenue
from tillcast.registry.forecast import EVALUATED
from tillcast.session import new_folder, stage
from tillcast.sources import sinks
from tillcast.sources.retail_ledger import ledger

EXPERIMENT = "1-URGENT"
METRICS = {"mse": "lowest", "r2": "highest"}
AFTER = dt.datetime(1998, 1, 1)
START = 1_700_000_000_000
# A brand in the middle of the names, and the tables beside those of runs.
SOME = "Brand#20"
FEWER = "Brand#15"
REGISTRY_TABLES = ("experiments", "logged_models", "model_versions", "registered_models", "aliases")


def _deleted_runs(tables):
    return search.by_view(tables.runs, "deleted")


# What tells the rows of a table apart, as text.
IDS = {
    "experiments": ["experiment_id"],
    "logged_models": ["model_id"],
    "model_versions": ["name", "version"],
    "registered_models": ["name"],
    "aliases": ["name", "alias", "version"],
    "runs": ["run_uuid"],
}


def _ids(tables, *names):
    """(table_name, id) of every row of ledger tables; rows of runs by run and key."""
    frames = [
        getattr(tables, name).select(
            F.lit(name).alias("table_name"),
            F.concat_ws(":", *[F.col(c).cast("string") for c in IDS.get(name, ["run_uuid", "key"])]).alias("id"),
        )
        for name in names
    ]
    frame = frames[0]
    for other in frames[1:]:
        frame = frame.union(other)
    return frame


# ---- searches ----------------------------------------------------------------------------------------------------


def ledger_experiment_by_name(spark, folder):
    return search.experiments_by_name(ledger(spark, folder), [EXPERIMENT, "5-LOW", "unknown"])


def ledger_experiment_runs(spark, folder):
    tables = ledger(spark, folder)
    return search.runs_of_experiments(tables, tables.experiments).select("experiment", "run_uuid")


def ledger_run_by_id(spark, folder):
    tables = ledger(spark, folder)
    sources = tables.logged_models.select(F.col("source_run_id").alias("run_uuid"))
    return search.run_by_id(tables, sources).select("run_uuid", "experiment_id", "artifact_uri")


def ledger_runs_by_view(spark, folder):
    runs = ledger(spark, folder).runs
    active, deleted, both = [
        search.by_view(runs, view).select(F.lit(view).alias("view"), "run_uuid") for view in ("active", "deleted", "all")
    ]
    return active.union(deleted).union(both)


def ledger_runs_after(spark, folder):
    return search.runs_after(search.by_view(ledger(spark, folder).runs), AFTER).select("run_uuid", "start_time")


def ledger_latest_run(spark, folder):
    return search.latest_runs(search.by_view(ledger(spark, folder).runs))


def ledger_runs_wide(spark, folder):
    tables = ledger(spark, folder)
    return search.runs_wide(
        tables, search.by_view(tables.runs), ["mse", "r2"], ["evaluated_model_uri", "created_model_uri"]
    )


def ledger_search_runs(spark, folder):
    """The hundred runs with the least error of all active runs whose R2 is below one half."""
    return search.search_runs(
        ledger(spark, folder),
        metrics=["mse", "r2"],
        tags=["evaluated_model_uri"],
        condition=F.col("metrics_r2") < 0.5,
        order_by=[F.asc_nulls_last("metrics_mse"), F.asc("run_uuid")],
        max_results=100,
    )


def ledger_find_runs(spark, folder):
    """Active and hidden runs of three experiments by a filter text over attributes, metrics, params and tags."""
    return texts.find_runs(
        ledger(spark, folder),
        [1, 2, 3],
        "attributes.start_time >= 800000000000 AND metrics.r2 < 0.5 AND metrics.`mse` > 1000.5"
        " AND params.status IN ('O', 'F') AND tags.evaluated_model_uri LIKE 'models:/m-%2'",
        ["metrics.r2 DESC", "metrics.mse"],
        500,
        view="all",
    )


def ledger_find_models(spark, folder):
    return texts.find_models(
        ledger(spark, folder), [1, 3], "intercept > 905 AND source_run_id LIKE '%2'", ["intercept DESC"], 100
    ).select("model_id", "experiment_id", "intercept", "creation_timestamp")


def ledger_find_versions(spark, folder):
    tables = ledger(spark, folder)
    found = texts.find_versions(tables, "name LIKE 'Brand#1%' AND version <= 3", ["version DESC", "name"], 40)
    return found.select("name", "version", "current_stage", "run_id")


def ledger_find_registered(spark, folder):
    return texts.find_registered(ledger(spark, folder), "name NOT LIKE 'Brand%' OR name = 'Brand#23'")


def ledger_runs_all_keys(spark, folder):
    """Active runs with a column for each key that they have; no key is named."""
    tables = ledger(spark, folder)
    return search.runs_with_all_keys(tables, search.by_view(tables.runs))


def ledger_runs_maps(spark, folder):
    """Every entry of the maps of the active runs, and a row for each run of how many it has."""
    tables = ledger(spark, folder)
    maps = search.runs_with_maps(tables, search.by_view(tables.runs))
    sizes = F.size("metrics") + F.size("params") + F.size("tags")
    out = maps.select("run_uuid", F.lit("all").alias("kind"), F.lit("").alias("key"), sizes.cast("double").alias("number"))
    out = out.withColumn("text", F.lit(None).cast("string"))
    for kind in ("metrics", "params", "tags"):
        entries = maps.select("run_uuid", F.lit(kind).alias("kind"), F.explode(kind).alias("key", "value"))
        number = F.col("value") if kind == "metrics" else F.lit(None).cast("double")
        words = F.lit(None).cast("string") if kind == "metrics" else F.col("value")
        out = out.unionByName(entries.select("run_uuid", "kind", "key", number.alias("number"), words.alias("text")))
    return out


def ledger_best_run(spark, folder):
    tables = ledger(spark, folder)
    return search.best_runs(tables, search.by_view(tables.runs), METRICS)


def ledger_models_of_run(spark, folder):
    tables = ledger(spark, folder)
    return search.models_of_runs(tables, search.by_view(tables.runs)).select("model_id", "source_run_id", "model_uri")


def ledger_latest_model(spark, folder):
    return search.latest_models(ledger(spark, folder).logged_models).select(
        "experiment_id", "model_id", "model_uri", "creation_timestamp"
    )


def ledger_versions_by_name(spark, folder):
    tables = ledger(spark, folder)
    return search.versions_by_name(tables, tables.registered_models)


def ledger_registered_aliases(spark, folder):
    return search.registered_with_aliases(ledger(spark, folder))


def ledger_registered_names(spark, folder):
    tables = ledger(spark, folder)
    return search.registered_names(tables, search.by_view(tables.runs))


def ledger_production_uri(spark, folder):
    return search.latest_in_stage(ledger(spark, folder)).select("name", "version", "model_uri")


# ---- deletes -----------------------------------------------------------------------------------------------------


def ledger_soft_delete_run(spark, folder):
    """Runs of some brands' models, deleted softly: state of every run, name and version afterwards."""
    tables = ledger(spark, folder)
    made = tables.model_versions.where(F.col("name") < SOME).select(F.col("run_id").alias("run_uuid"))
    after = delete.soft_delete_runs(tables, made)
    versions = F.concat_ws(":", "name", F.col("version").cast("string"))
    runs = after.runs.select(F.lit("run"), "run_uuid", "lifecycle_stage").toDF("kind", "id", "state")
    return (
        runs.union(after.registered_models.select(F.lit("name"), "name", "lifecycle_stage"))
        .union(after.model_versions.select(F.lit("version"), versions, "current_stage"))
    )


def ledger_hard_delete_runs(spark, folder):
    """The softly deleted runs removed from all five tables: what remains of each."""
    tables = ledger(spark, folder)
    return _ids(delete.hard_delete_runs(tables, _deleted_runs(tables)), *search.RUN_TABLES)


def ledger_delete_slices(spark, folder):
    """The ledger stored with its run tables in slices, and the softly deleted runs removed slice by slice: what remains
    of each run table."""
    tables = ledger(spark, folder)
    schema = f"tc_{uuid.uuid4().hex[:12]}"
    sinks.create_schema(spark, schema, new_folder(spark, schema))
    ledger_store.create_ledger(spark, schema, slices=8)
    ledger_store.append_rows({table: getattr(tables, table) for table in search.RUN_TABLES}, schema)
    gone = stage(_deleted_runs(tables).select("run_uuid"), "gone")
    ledger_store.change_runs(spark, schema, gone, lambda x: delete.hard_delete_runs(x, gone), removing=True)
    return _ids(ledger_store.open_ledger(spark, schema), *search.RUN_TABLES)


def ledger_hard_delete_models(spark, folder):
    """Models of the softly deleted runs removed, with their versions."""
    tables = ledger(spark, folder)
    models = search.models_of_runs(tables, _deleted_runs(tables))
    return delete.hard_delete_models(tables, models).model_versions.select("name", "version", "source")


def ledger_delete_name_versions(spark, folder):
    """Versions of the softly deleted runs removed by ``name:version``."""
    tables = ledger(spark, folder)
    listed = tables.model_versions.join(
        _deleted_runs(tables).select(F.col("run_uuid").alias("run_id")), "run_id", "left_semi"
    ).select(F.concat_ws(":", "name", F.col("version").cast("string")).alias("name_version"))
    return delete.delete_versions_by_name(tables, listed).model_versions.select("name", "version", "run_id")


def ledger_orphan_models(spark, folder):
    return delete.orphan_names(ledger(spark, folder))


def ledger_delete_experiment(spark, folder):
    kept, _ = delete.delete_experiment(ledger(spark, folder), EXPERIMENT, hard_delete=True)
    return _ids(kept, *REGISTRY_TABLES, *search.RUN_TABLES)


def ledger_delete_run(spark, folder):
    """One run deleted for good, by its id: what remains of the registry."""
    tables = ledger(spark, folder)
    mine = tables.experiments.where("experiment_id = 5").first().name  # the experiment of the model of run 4
    kept, _ = delete.delete_run(tables, "4", mine, hard_delete=True)
    return _ids(kept, *REGISTRY_TABLES, "runs")


def ledger_delete_version(spark, folder):
    """One version of a name deleted for good and one softly: versions and aliases afterwards."""
    tables = ledger(spark, folder)
    kept = delete.delete_registered_version(tables, SOME, 1, hard_delete=True)
    kept = delete.delete_registered_version(kept, SOME, 2)
    versions = kept.model_versions.select("name", "version", F.col("current_stage").alias("state"))
    return versions.unionByName(kept.aliases.select("name", "version", F.col("alias").alias("state")))


def ledger_aliases_after_deletes(spark, folder):
    """Aliases after names were hidden, models deleted, and a new version registered under every name left."""
    tables = ledger(spark, folder)
    hidden = delete.soft_delete_names(tables, tables.registered_models.where(F.col("name") < SOME))
    first = tables.logged_models.join(
        tables.model_versions.where("version = 1").select(F.col("source").alias("model_uri")), "model_uri", "left_semi"
    )
    first = first.where(F.col("experiment_id") != 1)
    kept = delete.hard_delete_models(hidden, first)
    return search.registered_with_aliases(write.register(kept, _newest_model_of_each_name(kept)))


def ledger_restore_experiment(spark, folder):
    """An experiment hidden and shown again: the experiments, and how many of its runs stay hidden."""
    tables = ledger(spark, folder)
    hidden, _ = delete.delete_experiment(tables, EXPERIMENT)
    shown = delete.restore_experiment(hidden, EXPERIMENT)
    runs = shown.runs.groupBy("experiment_id").agg(F.count_if(F.col("lifecycle_stage") == "deleted").alias("hidden"))
    return shown.experiments.join(runs, "experiment_id", "left")


def ledger_search_models(spark, folder):
    """The newest hundred models of two experiments with a part of the intercepts."""
    return search.search_models(
        ledger(spark, folder), [1, 3], F.col("intercept") > 910, [F.desc("creation_timestamp"), F.col("model_id")], 100
    ).select("model_id", "experiment_id", "intercept", "creation_timestamp")


def ledger_artifact_paths(spark, folder):
    tables = ledger(spark, folder)
    mine = F.col("experiment_id") == search.experiment_id(tables, EXPERIMENT)
    return delete.artifact_paths(tables.logged_models.where(mine), search.by_view(tables.runs).where(mine))


def ledger_restore(spark, folder):
    """All hidden runs shown again."""
    tables = ledger(spark, folder)
    return delete.restore_runs(tables, _deleted_runs(tables)).runs.select("run_uuid", "lifecycle_stage")


def ledger_undo(spark, folder):
    """The runs of some brands' models hidden, and those of half of these brands shown again: runs, names, versions with
    their stages, and aliases."""
    tables = ledger(spark, folder)
    made = tables.model_versions.where(F.col("name") < SOME).select(F.col("run_id").alias("run_uuid"))
    again = tables.model_versions.where(F.col("name") < FEWER).select(F.col("run_id").alias("run_uuid"))
    after = delete.restore_runs(delete.soft_delete_runs(tables, made), again)
    version = F.concat_ws(":", "name", F.col("version").cast("string"))
    runs = after.runs.select(F.lit("run"), "run_uuid", "lifecycle_stage").toDF("kind", "id", "state")
    return (
        runs.union(after.registered_models.select(F.lit("name"), "name", "lifecycle_stage"))
        .union(after.model_versions.select(F.lit("version"), version, "current_stage"))
        .union(after.aliases.select(F.lit("alias"), version, "alias"))
    )


# ---- writes ------------------------------------------------------------------------------------------------------


def _newest_model_of_each_name(tables):
    """For every registered name its highest version's model again; a name without versions gets a new model."""
    newest = tables.model_versions.groupBy("name").agg(
        F.max_by("source", "version").alias("source"), F.max_by("run_id", "version").alias("run_id")
    )
    return tables.registered_models.join(newest, "name", "left").select(
        "name",
        F.coalesce("source", F.concat(F.lit("models:/m-new-"), F.col("name"))).alias("source"),
        F.coalesce("run_id", F.lit("none")).alias("run_id"),
    )


def ledger_register(spark, folder):
    tables = ledger(spark, folder)
    return write.register(tables, _newest_model_of_each_name(tables)).model_versions


def ledger_promote(spark, folder):
    """A new version of every name promoted: name, version, stage and the alias that points at it."""
    tables = ledger(spark, folder)
    promoted = update.promote_models(tables, _newest_model_of_each_name(tables))
    return promoted.model_versions.join(promoted.aliases, ["name", "version"], "left").select(
        "name", "version", "current_stage", "alias"
    )


def ledger_promote_best(spark, folder):
    """The best run's model of an experiment registered under a new name and under a known one, and in Production."""
    tables = ledger(spark, folder)
    for name in ("forecast", SOME):
        tables = update.promote(tables, EXPERIMENT, name, METRICS)
    mine = tables.model_versions.where(F.col("name").isin("forecast", SOME))
    return mine.join(tables.aliases, ["name", "version"], "left").select(
        "name", "version", "source", "current_stage", "alias"
    )


def ledger_log_run(spark, folder):
    """Every model evaluated, each in a run of its own: the metric and tag rows that are logged."""
    tables = ledger(spark, folder)
    pairs = evaluation_pairs(revenue(spark, folder), *EVALUATION_RANGE)
    rows = write.evaluation_rows(training.evaluate_models(tables.logged_models, pairs), START)
    rounded = F.when(F.col("key") == "mse", digits("value")).otherwise(F.round("value", 6))
    return rows["metrics"].select("run_uuid", "key", rounded.alias("metric")).unionByName(
        rows["tags"].select("run_uuid", "key", F.col("value").alias("tag")), allowMissingColumns=True
    )


QUERIES = {
    name: query
    for name, query in globals().copy().items()
    if name.startswith("ledger_") and callable(query)
}

EXPERIMENTS = """
experiments AS (
    SELECT row_number() OVER (ORDER BY name) AS experiment_id, name, 'active' AS lifecycle_stage
    FROM (SELECT DISTINCT o_orderpriority AS name FROM orders)
)"""
RUNS = f"""{EXPERIMENTS},
runs AS (
    SELECT CAST(o_orderkey AS VARCHAR) AS run_uuid, experiment_id, epoch_ms(o_orderdate) AS start_time,
           CASE WHEN o_orderstatus = 'P' THEN 'deleted' ELSE 'active' END AS lifecycle_stage,
           'runs:/' || o_orderkey AS artifact_uri
    FROM orders JOIN experiments ON name = o_orderpriority
)"""
LONG = f"""{RUNS},
metrics AS (
    SELECT CAST(o_orderkey AS VARCHAR) AS run_uuid, 'mse' AS key, o_totalprice AS value FROM orders
    WHERE o_orderkey % 10 <> 0
    UNION ALL
    SELECT CAST(o_orderkey AS VARCHAR), 'r2', CAST(1 AS DOUBLE) / (1 + o_orderkey % 97) FROM orders
),
params AS (SELECT CAST(o_orderkey AS VARCHAR) AS run_uuid, 'status' AS key, o_orderstatus AS value FROM orders),
tags AS (
    SELECT CAST(o_orderkey AS VARCHAR) AS run_uuid,
           CASE WHEN o_orderkey % 2 = 0 THEN 'evaluated_model_uri' ELSE 'created_model_uri' END AS key,
           'models:/m-' || o_orderkey AS value
    FROM orders WHERE o_orderkey % 11 <> 0
)"""
MODELS = """
logged_models AS (
    SELECT 'm-' || p_partkey AS model_id, p_partkey % 5 + 1 AS experiment_id,
           CAST(p_partkey AS VARCHAR) AS source_run_id, 'models:/m-' || p_partkey AS model_uri,
           'artifacts:/m-' || p_partkey AS artifact_location, p_partkey AS creation_timestamp FROM part
),
model_versions AS (
    SELECT p_brand AS name, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS INTEGER) AS version,
           'models:/m-' || p_partkey AS source, CAST(p_partkey AS VARCHAR) AS run_id,
           CASE WHEN row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) = 1
                THEN 'Production' ELSE 'None' END AS current_stage,
           'READY' AS status FROM part
),
registered_models AS (
    SELECT DISTINCT p_brand AS name, 'active' AS lifecycle_stage FROM part
    UNION ALL SELECT n_name, 'active' FROM nation
),
aliases AS (SELECT DISTINCT p_brand AS name, 'Production' AS alias, 1 AS version FROM part)"""
ALL = f"{LONG},{MODELS}"
NEW = """
new_versions AS (
    SELECT r.name, CAST(coalesce(max(v.version), 0) + 1 AS INTEGER) AS version,
           coalesce(arg_max(v.source, v.version), 'models:/m-new-' || r.name) AS source,
           coalesce(arg_max(v.run_id, v.version), 'none') AS run_id, 'None' AS current_stage, 'READY' AS status
    FROM registered_models r LEFT JOIN model_versions v ON v.name = r.name GROUP BY r.name
)"""


def _ids_sql(*tables: tuple[str, str]) -> str:
    ids = {table: " || ':' || ".join(IDS.get(table, ["run_uuid", "key"])) for table, _ in tables}
    return "\nUNION ALL ".join(
        f"SELECT '{table}' AS table_name, CAST({ids[table]} AS VARCHAR) AS id FROM {table} WHERE {condition}"
        for table, condition in tables
    )


_RUN_OK = "run_uuid NOT IN (SELECT run_uuid FROM runs WHERE lifecycle_stage = 'deleted')"
_NOT_URGENT = "run_uuid NOT IN (SELECT run_uuid FROM runs WHERE lifecycle_stage = 'active' AND experiment_id = 1)"
_URGENT_NAMES = """
SELECT arg_max(name, version) FROM model_versions JOIN runs ON run_id = run_uuid
WHERE lifecycle_stage = 'active' AND experiment_id = 1 GROUP BY run_uuid"""
_SOURCE_OK = "source NOT IN (SELECT model_uri FROM logged_models WHERE experiment_id = 1)"
_SHA = f"substring(sha256('evaluate|models:/m-' || p_partkey || '|{START}'), 1, 32)"

ORACLE = {
    "ledger_experiment_by_name": f"""
WITH {EXPERIMENTS} SELECT * FROM experiments WHERE name IN ('{EXPERIMENT}', '5-LOW', 'unknown')""",
    "ledger_experiment_runs": f"""
WITH {RUNS}
SELECT e.name AS experiment, run_uuid FROM runs JOIN experiments e USING (experiment_id)
WHERE runs.lifecycle_stage = 'active'""",
    "ledger_run_by_id": f"""
WITH {ALL}
SELECT run_uuid, experiment_id, artifact_uri FROM runs WHERE run_uuid IN (SELECT source_run_id FROM logged_models)""",
    "ledger_runs_by_view": f"""
WITH {RUNS}
SELECT 'active' AS view, run_uuid FROM runs WHERE lifecycle_stage = 'active'
UNION ALL SELECT 'deleted', run_uuid FROM runs WHERE lifecycle_stage = 'deleted'
UNION ALL SELECT 'all', run_uuid FROM runs""",
    "ledger_runs_after": f"""
WITH {RUNS}
SELECT run_uuid, start_time FROM runs
WHERE lifecycle_stage = 'active' AND start_time >= epoch_ms(TIMESTAMP '1998-01-01 00:00:00')""",
    "ledger_latest_run": f"""
WITH {RUNS}, placed AS (
    SELECT *, row_number() OVER (PARTITION BY experiment_id ORDER BY start_time DESC, run_uuid) AS place
    FROM runs WHERE lifecycle_stage = 'active')
SELECT experiment_id, run_uuid, start_time FROM placed WHERE place = 1""",
    "ledger_runs_wide": f"""
WITH {LONG}
SELECT r.*, m.value AS metrics_mse, q.value AS metrics_r2, te.value AS tags_evaluated_model_uri,
       tc.value AS tags_created_model_uri
FROM runs r
LEFT JOIN metrics m ON m.run_uuid = r.run_uuid AND m.key = 'mse'
LEFT JOIN metrics q ON q.run_uuid = r.run_uuid AND q.key = 'r2'
LEFT JOIN tags te ON te.run_uuid = r.run_uuid AND te.key = 'evaluated_model_uri'
LEFT JOIN tags tc ON tc.run_uuid = r.run_uuid AND tc.key = 'created_model_uri'
WHERE r.lifecycle_stage = 'active'""",
    "ledger_search_runs": f"""
WITH {LONG}
SELECT r.*, m.value AS metrics_mse, q.value AS metrics_r2, te.value AS tags_evaluated_model_uri
FROM runs r
LEFT JOIN metrics m ON m.run_uuid = r.run_uuid AND m.key = 'mse'
LEFT JOIN metrics q ON q.run_uuid = r.run_uuid AND q.key = 'r2'
LEFT JOIN tags te ON te.run_uuid = r.run_uuid AND te.key = 'evaluated_model_uri'
WHERE r.lifecycle_stage = 'active' AND q.value < 0.5
ORDER BY m.value ASC NULLS LAST, r.run_uuid LIMIT 100""",
    "ledger_find_runs": f"""
WITH {LONG}
SELECT r.*, m.value AS metrics_mse, q.value AS metrics_r2, p.value AS params_status, te.value AS tags_evaluated_model_uri
FROM runs r JOIN metrics m ON m.run_uuid = r.run_uuid AND m.key = 'mse'
JOIN metrics q ON q.run_uuid = r.run_uuid AND q.key = 'r2'
JOIN params p ON p.run_uuid = r.run_uuid AND p.key = 'status'
JOIN tags te ON te.run_uuid = r.run_uuid AND te.key = 'evaluated_model_uri'
WHERE r.experiment_id IN (1, 2, 3) AND r.start_time >= 800000000000 AND q.value < 0.5 AND m.value > 1000.5
  AND p.value IN ('O', 'F') AND te.value LIKE 'models:/m-%2'
ORDER BY q.value DESC, m.value, r.start_time DESC, r.run_uuid LIMIT 500""",
    "ledger_find_models": """
SELECT 'm-' || p_partkey AS model_id, p_partkey % 5 + 1 AS experiment_id, p_retailprice AS intercept,
       p_partkey AS creation_timestamp
FROM part WHERE p_partkey % 5 + 1 IN (1, 3) AND p_retailprice > 905 AND p_partkey % 10 = 2
ORDER BY p_retailprice DESC, p_partkey DESC LIMIT 100""",
    "ledger_find_versions": f"""
WITH {MODELS}
SELECT name, version, current_stage, run_id FROM model_versions
WHERE starts_with(name, 'Brand#1') AND version <= 3 ORDER BY version DESC, name LIMIT 40""",
    "ledger_find_registered": f"""
WITH {MODELS}
SELECT name, lifecycle_stage FROM registered_models WHERE NOT starts_with(name, 'Brand') OR name = 'Brand#23'""",
    "ledger_runs_all_keys": f"""
WITH {LONG}
SELECT r.*, m.value AS metrics_mse, q.value AS metrics_r2, p.value AS params_status,
       tc.value AS tags_created_model_uri, te.value AS tags_evaluated_model_uri
FROM runs r
LEFT JOIN metrics m ON m.run_uuid = r.run_uuid AND m.key = 'mse'
LEFT JOIN metrics q ON q.run_uuid = r.run_uuid AND q.key = 'r2'
LEFT JOIN params p ON p.run_uuid = r.run_uuid AND p.key = 'status'
LEFT JOIN tags tc ON tc.run_uuid = r.run_uuid AND tc.key = 'created_model_uri'
LEFT JOIN tags te ON te.run_uuid = r.run_uuid AND te.key = 'evaluated_model_uri'
WHERE r.lifecycle_stage = 'active'""",
    "ledger_runs_maps": f"""
WITH {LONG},
entries AS (
    SELECT run_uuid, 'metrics' AS kind, key, value AS number, NULL::VARCHAR AS text FROM metrics
    UNION ALL SELECT run_uuid, 'params', key, NULL, value FROM params
    UNION ALL SELECT run_uuid, 'tags', key, NULL, value FROM tags
)
SELECT e.* FROM entries e JOIN runs r USING (run_uuid) WHERE r.lifecycle_stage = 'active'
UNION ALL
SELECT r.run_uuid, 'all', '', count(e.kind)::DOUBLE, NULL FROM runs r LEFT JOIN entries e USING (run_uuid)
WHERE r.lifecycle_stage = 'active' GROUP BY r.run_uuid""",
    "ledger_best_run": f"""
WITH {LONG}, placed AS (
    SELECT r.run_uuid, r.experiment_id, m.value AS mse, q.value AS r2,
           row_number() OVER (PARTITION BY experiment_id
               ORDER BY m.value ASC NULLS LAST, q.value DESC NULLS LAST, r.run_uuid) AS place
    FROM runs r
    LEFT JOIN metrics m ON m.run_uuid = r.run_uuid AND m.key = 'mse'
    LEFT JOIN metrics q ON q.run_uuid = r.run_uuid AND q.key = 'r2'
    WHERE r.lifecycle_stage = 'active')
SELECT p.experiment_id, p.run_uuid, mse AS metrics_mse, r2 AS metrics_r2,
       coalesce(te.value, tc.value) AS model_uri
FROM placed p
LEFT JOIN tags te ON te.run_uuid = p.run_uuid AND te.key = 'evaluated_model_uri'
LEFT JOIN tags tc ON tc.run_uuid = p.run_uuid AND tc.key = 'created_model_uri'
WHERE place = 1""",
    "ledger_models_of_run": f"""
WITH {ALL}
SELECT model_id, source_run_id, model_uri FROM logged_models
WHERE source_run_id IN (SELECT run_uuid FROM runs WHERE lifecycle_stage = 'active')""",
    "ledger_latest_model": f"""
WITH {MODELS}, placed AS (
    SELECT *, row_number() OVER (PARTITION BY experiment_id ORDER BY creation_timestamp DESC, model_id) AS place
    FROM logged_models)
SELECT experiment_id, model_id, model_uri, creation_timestamp FROM placed WHERE place = 1""",
    "ledger_versions_by_name": f"""
WITH {MODELS} SELECT name, version, current_stage, status, run_id, source FROM model_versions
WHERE name IN (SELECT name FROM registered_models)""",
    "ledger_registered_aliases": f"""
WITH {MODELS}
SELECT r.name, r.lifecycle_stage, a.alias, a.version FROM registered_models r LEFT JOIN aliases a ON a.name = r.name""",
    "ledger_registered_names": f"""
WITH {ALL}
SELECT run_uuid, arg_max(name, version) AS name FROM runs JOIN model_versions ON run_id = run_uuid
WHERE lifecycle_stage = 'active' GROUP BY run_uuid""",
    "ledger_production_uri": f"""
WITH {MODELS}
SELECT name, max(version) AS version, 'models:/' || name || '/' || max(version) AS model_uri
FROM model_versions WHERE current_stage = 'Production' GROUP BY name""",
    "ledger_soft_delete_run": f"""
WITH {ALL}
SELECT 'run' AS kind, run_uuid AS id,
       CASE WHEN run_uuid IN (SELECT run_id FROM model_versions WHERE name < '{SOME}') THEN 'deleted'
            ELSE lifecycle_stage END AS state FROM runs
UNION ALL
SELECT 'name', name, CASE WHEN name < '{SOME}' AND name IN (SELECT name FROM model_versions) THEN 'deleted'
                          ELSE lifecycle_stage END FROM registered_models
UNION ALL
SELECT 'version', name || ':' || version, CASE WHEN name < '{SOME}' THEN 'Deleted_Internal' ELSE current_stage END
FROM model_versions""",
    "ledger_hard_delete_runs": f"""
WITH {LONG}, latest_metrics AS (SELECT * FROM metrics)
{_ids_sql(*[(table, _RUN_OK) for table in search.RUN_TABLES])}""",
    "ledger_delete_slices": f"""
WITH {LONG}, latest_metrics AS (SELECT * FROM metrics)
{_ids_sql(*[(table, _RUN_OK) for table in search.RUN_TABLES])}""",
    "ledger_hard_delete_models": f"""
WITH {ALL}
SELECT name, version, source FROM model_versions WHERE source NOT IN (
    SELECT model_uri FROM logged_models
    WHERE source_run_id IN (SELECT run_uuid FROM runs WHERE lifecycle_stage = 'deleted'))""",
    "ledger_delete_name_versions": f"""
WITH {ALL}
SELECT name, version, run_id FROM model_versions
WHERE run_id NOT IN (SELECT run_uuid FROM runs WHERE lifecycle_stage = 'deleted')""",
    "ledger_orphan_models": f"""
WITH {MODELS}
SELECT name FROM registered_models EXCEPT SELECT name FROM model_versions""",
    "ledger_delete_experiment": f"""
WITH {ALL}, latest_metrics AS (SELECT * FROM metrics)
{_ids_sql(("experiments", "experiment_id <> 1"), ("logged_models", "experiment_id <> 1"),
          ("model_versions", _SOURCE_OK),
          ("registered_models", f"name IN (SELECT name FROM model_versions WHERE {_SOURCE_OK})"),
          ("aliases", f"name NOT IN ({_URGENT_NAMES}) AND version IN "
                      f"(SELECT version FROM model_versions v WHERE v.name = aliases.name AND {_SOURCE_OK})"),
          *[(table, _NOT_URGENT) for table in search.RUN_TABLES])}""",
    "ledger_delete_run": f"""
WITH {ALL}
{_ids_sql(("experiments", "true"), ("logged_models", "model_id <> 'm-4'"), ("model_versions", "run_id <> '4'"),
          ("registered_models", "name IN (SELECT name FROM model_versions WHERE run_id <> '4')"),
          ("aliases", "name NOT IN (SELECT name FROM model_versions WHERE run_id = '4')"),
          ("runs", "run_uuid <> '4'"))}""",
    "ledger_delete_version": f"""
WITH {MODELS}
SELECT name, version, CASE WHEN name = '{SOME}' AND version = 2 THEN 'Deleted_Internal' ELSE current_stage END AS state
FROM model_versions WHERE name <> '{SOME}' OR version <> 1
UNION ALL SELECT name, version, alias FROM aliases WHERE name <> '{SOME}'""",
    "ledger_aliases_after_deletes": f"""
WITH {MODELS},
gone AS (
    SELECT v.name, v.version FROM model_versions v JOIN logged_models m ON m.model_uri = v.source
    WHERE v.version = 1 AND m.experiment_id <> 1
),
kept AS (SELECT name, version FROM model_versions EXCEPT SELECT name, version FROM gone),
pointing AS (
    SELECT a.name, a.alias, a.version FROM aliases a JOIN kept USING (name, version) WHERE a.name >= '{SOME}'
)
SELECT k.name, 'active' AS lifecycle_stage, p.alias, p.version
FROM (SELECT DISTINCT name FROM kept) k LEFT JOIN pointing p ON p.name = k.name""",
    "ledger_restore_experiment": f"""
WITH {ALL},
found AS (
    SELECT runs.run_uuid FROM runs WHERE experiment_id = 1 AND lifecycle_stage = 'active'
)
SELECT e.experiment_id, e.name, e.lifecycle_stage,
       count(*) FILTER (WHERE r.lifecycle_stage = 'deleted' OR r.run_uuid IN (SELECT run_uuid FROM found)) AS hidden
FROM experiments e LEFT JOIN runs r ON r.experiment_id = e.experiment_id
GROUP BY e.experiment_id, e.name, e.lifecycle_stage""",
    "ledger_search_models": """
SELECT 'm-' || p_partkey AS model_id, p_partkey % 5 + 1 AS experiment_id, p_retailprice AS intercept,
       p_partkey AS creation_timestamp
FROM part WHERE p_partkey % 5 + 1 IN (1, 3) AND p_retailprice > 910
ORDER BY p_partkey DESC, model_id LIMIT 100""",
    "ledger_artifact_paths": f"""
WITH {ALL}
SELECT artifact_location AS path FROM logged_models WHERE experiment_id = 1
UNION ALL SELECT artifact_uri FROM runs WHERE experiment_id = 1 AND lifecycle_stage = 'active'""",
    "ledger_restore": f"WITH {RUNS} SELECT run_uuid, 'active' AS lifecycle_stage FROM runs",
    "ledger_undo": f"""
WITH {ALL},
away AS (SELECT DISTINCT name FROM model_versions WHERE name >= '{FEWER}' AND name < '{SOME}')
SELECT 'run' AS kind, run_uuid AS id, CASE
    WHEN run_uuid IN (SELECT run_id FROM model_versions WHERE name IN (SELECT * FROM away)) THEN 'deleted'
    WHEN run_uuid IN (SELECT run_id FROM model_versions WHERE name < '{FEWER}') THEN 'active'
    ELSE lifecycle_stage END AS state FROM runs
UNION ALL
SELECT 'name', name, CASE WHEN name IN (SELECT * FROM away) THEN 'deleted' ELSE lifecycle_stage END FROM registered_models
UNION ALL
SELECT 'version', name || ':' || version,
    CASE WHEN name IN (SELECT * FROM away) THEN 'Deleted_Internal' ELSE current_stage END FROM model_versions
UNION ALL
SELECT 'alias', name || ':' || version, alias FROM aliases WHERE name NOT IN (SELECT * FROM away)""",
    "ledger_register": f"WITH {MODELS},{NEW} SELECT * FROM model_versions UNION ALL SELECT * FROM new_versions",
    "ledger_promote": f"""
WITH {MODELS},{NEW}
SELECT name, version, CASE WHEN current_stage = 'Production' THEN 'Archived' ELSE current_stage END AS current_stage,
       NULL AS alias FROM model_versions
UNION ALL SELECT name, version, 'Production', 'Production' FROM new_versions""",
    "ledger_promote_best": f"""
WITH {ALL},
best AS (
    SELECT r.run_uuid FROM runs r
    LEFT JOIN metrics m ON m.run_uuid = r.run_uuid AND m.key = 'mse'
    LEFT JOIN metrics q ON q.run_uuid = r.run_uuid AND q.key = 'r2'
    WHERE r.lifecycle_stage = 'active' AND r.experiment_id = 1
    ORDER BY m.value ASC NULLS LAST, q.value DESC NULLS LAST, r.run_uuid LIMIT 1
),
uri AS (SELECT value FROM tags JOIN best USING (run_uuid))
SELECT name, version, source, CASE current_stage WHEN 'Production' THEN 'Archived' ELSE current_stage END AS current_stage,
       NULL AS alias FROM model_versions WHERE name = '{SOME}'
UNION ALL
SELECT '{SOME}', CAST((SELECT max(version) FROM model_versions WHERE name = '{SOME}') + 1 AS INTEGER), value, 'Production',
       'Production' FROM uri
UNION ALL SELECT 'forecast', 1, value, 'Production', 'Production' FROM uri""",
    "ledger_log_run": f"""
WITH {EVALUATED}
SELECT {_SHA} AS run_uuid, 'mse' AS key, mse AS metric, CAST(NULL AS VARCHAR) AS tag FROM evaluated
UNION ALL SELECT {_SHA}, 'r2', r2, NULL FROM evaluated
UNION ALL SELECT {_SHA}, 'evaluated_model_uri', NULL, 'models:/m-' || p_partkey FROM evaluated
UNION ALL SELECT {_SHA}, 'evaluated_model_source_run_id', NULL, CAST(p_partkey AS VARCHAR) FROM evaluated""",
}
