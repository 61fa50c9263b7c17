import datetime as dt

import pytest
from compare import connect
from pyspark.sql import functions as F

from tillcast.operators import ledger as search
from tillcast.operators import ledger_delete as delete
from tillcast.operators import ledger_write as write
from tillcast.operators.ledger import COLUMNS, Ledger
from tillcast.plans import prediction, update
from tillcast.registry.ledger import ORACLE, ledger_restore
from tillcast.sources import retail_ledger, sinks
from tillcast.sources.tables import literal_rows

SF = "/root/testdata/sf0.001"
NAN = float("nan")
ROWS = {
    "experiments": [(1, "revenue", "active"), (2, "other", "active"), (3, "gone", "deleted"), (4, "bare", "active")],
    "runs": [
        ("r1", 1, 1000, "active", "runs:/r1"),
        ("r2", 1, 2000, "active", "runs:/r2"),
        ("r3", 1, 3000, "deleted", "runs:/r3"),
        ("r4", 2, 4000, "active", "runs:/r4"),
        ("r5", 1, 2000, "active", "runs:/r5"),
    ],
    "latest_metrics": [
        ("r1", "mse", 5.0), ("r1", "r2", 0.5),
        ("r2", "mse", 5.0), ("r2", "r2", 0.7),
        ("r3", "mse", 1.0), ("r3", "r2", 0.9),
        ("r4", "mse", 9.0),
        ("r5", "mse", NAN), ("r5", "r2", 0.99),
    ],
    "params": [("r1", "positive", "true"), ("r4", "positive", "false")],
    "tags": [
        ("r1", "created_model_uri", "models:/m1"),
        ("r2", "evaluated_model_uri", "models:/m1"),
        ("r2", "created_model_uri", "models:/m2"),
    ],
    "logged_models": [
        ("m1", 1, "r1", "models:/m1", "artifacts:/m1", 10, 16.0, [0.0, 0.0]),
        ("m2", 1, "r2", "models:/m2", "artifacts:/m2", 20, 1.0, [0.5, 0.25]),
        ("m4", 2, "r4", "models:/m4", "artifacts:/m4", 30, 0.0, [1.0, 1.0]),
    ],
    "model_versions": [
        ("sales", 1, "models:/m1", "r1", "Production", "READY"),
        ("sales", 2, "models:/m2", "r2", "None", "READY"),
        ("alt", 7, "models:/m1", "r1", "None", "READY"),
    ],
    "registered_models": [("sales", "active"), ("alt", "active"), ("orphan", "active")],
    "aliases": [("sales", "Production", 1), ("sales", "old", 1)],
}


@pytest.fixture(scope="module")
def ledger(spark):
    tables = {**ROWS, "metrics": ROWS["latest_metrics"]}
    return Ledger(**{name: literal_rows(spark, tables[name], COLUMNS[name]) for name in COLUMNS})


def ids(spark, *run_ids):
    return literal_rows(spark, [(r,) for r in run_ids], "run_uuid string")


def names(df, *columns):
    return sorted(tuple(row) for row in df.select(*columns).collect())


def test_experiments(ledger):
    assert search.experiment_id(ledger, "revenue") == 1
    for hidden in ("gone", "never"):
        with pytest.raises(ValueError, match="no experiment is called"):
            search.experiment_id(ledger, hidden)
    assert search.experiment_id(ledger, "gone", view="all") == 3


def test_views(ledger):
    assert search.by_view(ledger.runs).count() == 4
    assert names(search.by_view(ledger.runs, "deleted"), "run_uuid") == [("r3",)]
    assert search.by_view(ledger.runs, "all").count() == 5
    with pytest.raises(ValueError):
        search.by_view(ledger.runs, "hidden")


def test_best_run(ledger):
    """Least error, then highest R2; deleted runs do not count and NaN comes after every value."""
    best = search.best_runs(ledger, search.by_view(ledger.runs), {"mse": "lowest", "r2": "highest"})
    found = {row.experiment_id: row for row in best.collect()}
    assert found[1].run_uuid == "r2" and found[1].model_uri == "models:/m1"
    assert found[2].run_uuid == "r4" and found[2].model_uri is None
    assert search.best_model_uri(ledger, "revenue", {"mse": "lowest", "r2": "highest"}) == "models:/m1"
    highest = search.best_runs(ledger, search.by_view(ledger.runs), {"mse": "highest"})
    assert {row.experiment_id: row.run_uuid for row in highest.collect()} == {1: "r1", 2: "r4"}


def test_best_model_errors(ledger):
    with pytest.raises(ValueError, match="neither tag"):
        search.best_model_uri(ledger, "other", {"mse": "lowest"})
    with pytest.raises(ValueError, match="no runs to choose"):
        search.best_model_uri(ledger, "bare", {"mse": "lowest"})
    with pytest.raises(ValueError, match="highest"):
        search.best_model_uri(ledger, "revenue", {"mse": "smallest"})
    with pytest.raises(ValueError, match="metric"):
        search.best_model_uri(ledger, "revenue", {})


def test_created_tag_alone_is_enough(ledger):
    without = ledger.with_tables(tags=ledger.tags.where("key = 'created_model_uri'"))
    assert search.best_model_uri(without, "revenue", {"mse": "lowest", "r2": "highest"}) == "models:/m2"


def test_wide_runs(ledger):
    wide = search.runs_wide(ledger, ledger.runs, ["mse", "r2"], ["created_model_uri", "evaluated_model_uri"])
    row = wide.where("run_uuid = 'r4'").first()
    assert (row.metrics_mse, row.metrics_r2, row.tags_created_model_uri) == (9.0, None, None)
    assert wide.count() == 5


def test_search_runs(ledger):
    small = F.col("metrics_mse") < 6
    found = search.search_runs(ledger, [1], metrics=["mse"], condition=small, order_by=[F.desc("run_uuid")])
    assert [r.run_uuid for r in found.collect()] == ["r2", "r1"]
    newest = search.search_runs(ledger, view="all", order_by=[F.desc("start_time")], max_results=2)
    assert [r.run_uuid for r in newest.collect()] == ["r4", "r3"]
    assert newest.columns == ledger.runs.columns


def test_run_searches(spark, ledger):
    runs = search.by_view(ledger.runs)
    latest = {r.experiment_id: r.run_uuid for r in search.latest_runs(runs).collect()}
    assert latest == {1: "r2", 2: "r4"}
    after = search.runs_after(runs, dt.datetime(1970, 1, 1, 0, 0, 2))
    assert names(after, "run_uuid") == [("r2",), ("r4",), ("r5",)]
    with_zone = dt.datetime(1970, 1, 1, 1, 0, 2, tzinfo=dt.timezone(dt.timedelta(hours=1)))
    assert search.runs_after(runs, with_zone).count() == 3
    assert names(search.run_by_id(ledger, ids(spark, "r3", "none")), "run_uuid", "artifact_uri") == [("r3", "runs:/r3")]
    assert search.runs_of_experiments(ledger, ledger.experiments).count() == 4


def test_model_searches(spark, ledger):
    assert search.find_latest_model(ledger, "revenue").model_id == "m2"
    with pytest.raises(ValueError, match="no models"):
        search.find_latest_model(ledger, "bare")
    assert names(search.models_of_runs(ledger, ids(spark, "r1")), "model_id") == [("m1",)]
    assert names(search.registered_names(ledger, ids(spark, "r1", "r2")), "run_uuid", "name") == [
        ("r1", "alt"),
        ("r2", "sales"),
    ]
    assert names(search.registered_model_names(ledger, run_id="r1"), "name") == [("alt",)]
    assert names(search.registered_model_names(ledger, experiment="revenue"), "name") == [("alt",), ("sales",)]
    with pytest.raises(ValueError, match="experiment or a run"):
        search.registered_model_names(ledger)
    production = search.latest_in_stage(ledger).first()
    assert (production.model_uri, production.source) == ("models:/sales/1", "models:/m1")
    model, uri = prediction.production_model(ledger, "sales")
    assert (model.intercept, uri) == (16.0, "models:/sales/1")
    with pytest.raises(ValueError, match="no version"):
        prediction.production_model(ledger, "orphan")
    assert search.registered_with_aliases(ledger).count() == 4


def test_delete_run_softly(ledger):
    """Every version of the name found for the run goes with it."""
    result, paths = delete.delete_run(ledger, "r2", "revenue")
    assert names(search.by_view(result.runs), "run_uuid") == [("r1",), ("r4",), ("r5",)]
    assert names(search.by_view(result.registered_models), "name") == [("alt",), ("orphan",)]
    assert names(search.visible_versions(result.model_versions), "name", "version") == [("alt", 7)]
    assert names(paths, "path") == [("artifacts:/m2",), ("runs:/r2",)]
    assert result.metrics.count() == ledger.metrics.count()
    with pytest.raises(ValueError, match="no run has the id"):
        delete.delete_run(ledger, "r9", "revenue")
    restored = delete.restore_runs(result, result.runs.where("run_uuid = 'r2'"))
    assert search.by_view(restored.runs).count() == 4


def test_delete_run_for_good(ledger):
    result, _ = delete.delete_run(ledger, "r1", "revenue", hard_delete=True)
    for table in search.RUN_TABLES:
        assert getattr(result, table).where("run_uuid = 'r1'").count() == 0
        assert getattr(result, table).count() < getattr(ledger, table).count()
    assert names(result.logged_models, "model_id") == [("m2",), ("m4",)]
    assert names(result.model_versions, "name", "version") == [("sales", 2)]
    assert names(result.registered_models, "name") == [("sales",)]


@pytest.mark.parametrize("hard", [False, True])
def test_delete_experiment(ledger, hard):
    result, paths = delete.delete_experiment(ledger, "revenue", hard_delete=hard)
    with pytest.raises(ValueError):
        search.experiment_id(result, "revenue")
    assert names(search.by_view(result.runs), "run_uuid") == [("r4",)]
    assert paths.count() == 2 + 3
    assert result.experiments.count() == (3 if hard else 4)
    assert result.logged_models.count() == (1 if hard else 3)
    assert result.model_versions.count() == (0 if hard else 3)
    if not hard:
        assert search.experiment_id(delete.restore_experiment(result, "revenue"), "revenue") == 1


def test_delete_versions(spark, ledger):
    listed = literal_rows(spark, [("alt:7",), ("sales:1",)], "name_version string")
    result = delete.delete_registry_models(ledger, names_versions=listed)
    assert names(result.model_versions, "name", "version") == [("sales", 2)]
    assert names(result.registered_models, "name") == [("sales",)]
    by_uri = delete.delete_registry_models(ledger, models=ledger.logged_models.where("model_id = 'm1'"))
    assert names(by_uri.model_versions, "name", "version") == [("sales", 2)]
    with pytest.raises(ValueError):
        delete.delete_registry_models(ledger)
    hidden = delete.delete_registered_version(ledger, "alt", 7)
    assert names(search.visible_versions(hidden.model_versions), "name") == [("sales",), ("sales",)]
    gone = delete.delete_registered_version(ledger, "alt", 7, hard_delete=True)
    assert names(gone.registered_models, "name") == [("sales",)]
    assert names(delete.orphan_names(ledger), "name") == [("orphan",)]


def test_register_and_promote(spark, ledger):
    rows = [("sales", "models:/m2", "r2"), ("fresh", "models:/m4", "r4")]
    new = literal_rows(spark, rows, "name string, source string, run_id string")
    promoted = update.promote_models(ledger, new)
    assert names(promoted.model_versions, "name", "version", "current_stage") == [
        ("alt", 7, "None"),
        ("fresh", 1, "Production"),
        ("sales", 1, "Archived"),
        ("sales", 2, "None"),
        ("sales", 3, "Production"),
    ]
    assert names(promoted.aliases, "name", "alias", "version") == [
        ("fresh", "Production", 1),
        ("sales", "Production", 3),
        ("sales", "old", 1),
    ]
    assert names(promoted.registered_models, "name") == [("alt",), ("fresh",), ("orphan",), ("sales",)]
    kept = write.transition_stage(ledger, new.selectExpr("name", "2 AS version"), archive_existing=False)
    assert names(kept.model_versions.where("name = 'sales'"), "version", "current_stage") == [
        (1, "Production"),
        (2, "Production"),
    ]


def test_promote_the_best(ledger):
    result = update.promote(ledger, "revenue", "sales")
    production = result.model_versions.where("current_stage = 'Production'").collect()
    assert [(v.name, v.version, v.source, v.run_id) for v in production] == [("sales", 3, "models:/m1", "r1")]


def test_versions_are_numbered_across_blocks(spark, monkeypatch):
    """Numbers of a brand with many key blocks, and gaps between them."""
    monkeypatch.setattr(retail_ledger, "BLOCK", 4)
    keys = [k for k in range(0, 300) if k % 7 and not 40 < k < 90]
    part = literal_rows(spark, [("b" if k % 3 else "a", k) for k in keys], "p_brand string, p_partkey bigint")
    found = {(v.name, int(v.run_id)): v.version for v in retail_ledger.model_versions(part).collect()}
    for brand in "ab":
        mine = [k for k in keys if ("b" if k % 3 else "a") == brand]
        assert [found[brand, k] for k in mine] == list(range(1, len(mine) + 1))


def all_rows(ledger):
    tables = {name: df for name, df in ledger.tables().items() if name != "changes"}
    return {name: sorted(repr(tuple(r)) for r in df.select(*sorted(df.columns)).collect()) for name, df in tables.items()}


def test_delete_then_restore_is_the_same_ledger(ledger):
    """Stages and aliases come back with a run, also after a second delete, and the log is empty again."""
    shown = delete.restore_runs(ledger, ledger.runs)
    hidden = delete.soft_delete_runs(delete.soft_delete_runs(shown, shown.runs.where("run_uuid = 'r1'")), shown.runs)
    assert search.visible_versions(hidden.model_versions).count() < search.visible_versions(shown.model_versions).count()
    again = delete.restore_runs(hidden, hidden.runs)
    assert all_rows(again) == all_rows(shown)
    assert again.changes.count() == 0


def test_restoring_one_run_leaves_other_names_hidden(ledger):
    hidden = delete.soft_delete_runs(ledger, ledger.runs)
    one = delete.restore_runs(hidden, hidden.runs.where("run_uuid = 'r1'"))
    shown = {r.name for r in search.registered_names(ledger, ledger.runs.where("run_uuid = 'r1'")).collect()}
    visible = search.visible_versions(one.model_versions)
    assert {r.name for r in visible.collect()} == shown
    before = {(r.name, r.version): r.current_stage for r in ledger.model_versions.collect()}
    assert all(before[r.name, r.version] == r.current_stage for r in visible.collect())


def test_restore_query_shows_the_hidden_runs_of_all_experiments(spark, rows):
    runs = retail_ledger.ledger(spark, SF).runs
    hidden = search.by_view(runs, "deleted").select("experiment_id").distinct()
    assert rows(hidden) == [(1,), (2,), (3,), (4,), (5,)]
    expected = sorted((r.run_uuid, "active") for r in runs.collect())
    assert rows(ledger_restore(spark, SF)) == expected
    assert sorted(connect(SF).execute(ORACLE["ledger_restore"]).fetchall()) == expected


def test_restoring_some_runs_leaves_the_others_hidden(spark, rows):
    """The query restores all hidden runs, which a constant would too; here only those of two experiments."""
    tables = retail_ledger.ledger(spark, SF)
    some = search.by_view(tables.runs, "deleted").where("experiment_id <= 2")
    shown = delete.restore_runs(tables, some).runs
    left = search.by_view(tables.runs, "deleted").where("experiment_id > 2")
    assert not left.isEmpty() and not some.isEmpty()
    assert rows(search.by_view(shown, "deleted").select(*left.columns)) == rows(left)
    assert shown.count() == tables.runs.count()


def test_one_version_hidden_and_shown_again(ledger):
    hidden = delete.delete_registered_version(ledger, "sales", 1)
    assert all_rows(hidden) != all_rows(ledger)
    assert all_rows(delete.restore_version(hidden, "sales", 1)) == all_rows(ledger)
    # A name restored leaves a version hidden that was hidden on its own before.
    run = ledger.model_versions.where("name = 'sales' AND version = 2").select(F.col("run_id").alias("run_uuid"))
    both = delete.restore_runs(delete.soft_delete_runs(hidden, run), run)
    assert names(search.visible_versions(both.model_versions), "name", "version") == names(
        search.visible_versions(hidden.model_versions), "name", "version"
    )


def test_undo_after_a_new_alias(spark, ledger):
    """An alias given to another version meanwhile stays with it."""
    first = ledger.aliases.first()
    hidden = delete.delete_registered_version(ledger, first.name, first.version)
    moved = literal_rows(spark, [(first.name, first.alias, 99)], COLUMNS["aliases"])
    hidden = hidden.with_tables(aliases=hidden.aliases.unionByName(moved))
    shown = delete.restore_version(hidden, first.name, first.version)
    same = shown.aliases.where((F.col("name") == first.name) & (F.col("alias") == first.alias))
    assert [r.version for r in same.collect()] == [99]


def test_stored_ledger_keeps_its_changes(spark, schema, ledger):
    from tillcast.plans import ledger_store

    ledger_store.create_ledger(spark, schema)
    for table, rows in ledger.tables().items():
        sinks.append(rows, f"{schema}.{table}")
    opened = ledger_store.open_ledger(spark, schema)
    ledger_store.replace_tables(opened, delete.soft_delete_runs(opened, opened.runs.where("run_uuid = 'r1'")), schema)
    opened = ledger_store.open_ledger(spark, schema)
    assert opened.changes.count() > 0
    ledger_store.replace_tables(opened, delete.restore_runs(opened, opened.runs.where("run_uuid = 'r1'")), schema)
    assert all_rows(ledger_store.open_ledger(spark, schema)) == all_rows(ledger)
