"""The whole model update on the example warehouse."""

import datetime as dt
import uuid

import pytest

from tillcast import session
from tillcast.contracts import METRICS, PREDICTIONS
from tillcast.operators import scoring
from tillcast.operators import ledger_delete as delete
from tillcast.operators import ledger_write as write
from tillcast.operators.ledger import COLUMNS, RUN_TABLES, Ledger
from tillcast.operators.pairs import evaluation_pairs
from tillcast.plans import ledger_store, prediction, training, update
from tillcast.sources import sinks
from tillcast.sources.tables import literal_rows, random_frame

START = 1_750_000_000_000
RANGES = (("2025-01-01", "2025-06-01"), ("2025-05-01", "2025-06-01"))


@pytest.fixture(scope="module")
def store(spark):
    """A stored ledger with one experiment."""
    name = "ledger_" + uuid.uuid4().hex[:8]
    sinks.create_schema(spark, name, session.new_folder(spark, name))
    ledger_store.create_ledger(spark, name)
    ledger_store.create_ledger(spark, name)
    rows = literal_rows(spark, [(1, "revenue", "active")], COLUMNS["experiments"])
    ledger_store.append_rows({"experiments": rows}, name)
    return name


def kept(spark, store):
    """The ledger as it is now, apart from later changes."""
    tables = ledger_store.open_ledger(spark, store).tables()
    return Ledger(**{name: session.stage(df, name) for name, df in tables.items()})


@pytest.fixture(scope="module")
def updated(spark, store, revenue):
    metrics = literal_rows(spark, [(dt.date(2025, 6, 1), 50.0, None, None, 60.0, "u")], METRICS)

    def update_once(threshold, start):
        return update.update_model(
            spark, store, revenue, metrics, threshold, *RANGES, "revenue", "revenue_model", start
        )

    assert update_once(99999999, START) == '{"should_retrain":false}'
    assert ledger_store.open_ledger(spark, store).runs.count() == 0
    assert update_once(10, START) == '{"should_retrain":true}'
    first = kept(spark, store)
    update_once(10, START + 1)
    return first, kept(spark, store)


def test_first_update(updated):
    first, _ = updated
    assert first.logged_models.count() == 2
    assert first.runs.count() == 4
    assert first.params.count() == 4
    tags = {(t.key, t.value) for t in first.tags.collect()}
    assert sum(key == "evaluated_model_uri" for key, _ in tags) == 2
    best = first.logged_models.where("intercept = 16").first()
    production = first.model_versions.where("current_stage = 'Production'").collect()
    assert [(v.name, v.version, v.source, v.run_id) for v in production] == [
        ("revenue_model", 1, best.model_uri, best.source_run_id)
    ]
    assert [tuple(a) for a in first.aliases.collect()] == [("revenue_model", "Production", 1)]


def test_second_update_archives_the_first(updated):
    _, second = updated
    stages = {v.version: v.current_stage for v in second.model_versions.collect()}
    assert stages == {1: "Archived", 2: "Production"}
    assert second.logged_models.count() == 4
    # Two training runs, then one evaluation run per model, old models included.
    assert second.runs.count() == 4 + 2 + 4
    assert second.runs.select("run_uuid").distinct().count() == second.runs.count()
    assert [tuple(a) for a in second.aliases.collect()] == [("revenue_model", "Production", 2)]
    assert second.registered_models.count() == 1


def test_predictions_of_the_promoted_model(spark, updated, revenue, schema):
    model, uri = prediction.production_model(updated[0], "revenue_model")
    assert uri == "models:/revenue_model/1" and model.intercept == 16
    table = f"{schema}.predictions"
    prediction.predict_backlog(spark, revenue, table, model, uri)
    assert {(p.predictedRevenue, p.modelURI) for p in spark.table(table).collect()} == {(16.0, uri)}
    assert scoring.backlog(revenue, spark.table(table)).count() == 0
    assert spark.createDataFrame([], PREDICTIONS).schema == spark.table(table).schema


def test_latest_model(spark, updated, revenue):
    pairs = evaluation_pairs(revenue, *RANGES[1])
    found = training.evaluate_latest(updated[0], "revenue", pairs).first()
    assert found.n == 2 and found.model_uri.startswith("models:/m-")
    frame = random_frame(spark, 20)
    on_random = training.evaluate_latest(updated[0], "revenue", frame, ["x0", "x1"], "y").first()
    assert on_random.n == 20 and on_random.mse > 0


def test_stored_ledger_after_a_delete(spark, store, updated):
    """Rebuilt tables that are read from each other: run tables without the deleted runs, the rest whole."""
    before = ledger_store.open_ledger(spark, store)
    runs = before.tags.where("key = 'evaluated_model_uri'").select("run_uuid")
    ids = [row.run_uuid for row in runs.collect()]
    ledger_store.replace_tables(before, delete.hard_delete_runs(before, runs), store)
    after = ledger_store.open_ledger(spark, store)
    for table in RUN_TABLES:
        assert getattr(after, table).where(getattr(after, table).run_uuid.isin(ids)).count() == 0
    assert after.runs.count() == updated[1].runs.count() - len(ids) == 4
    assert after.logged_models.count() == 4


def test_rows_are_appended_once_and_runs_last(spark, monkeypatch):
    name = "ledger_" + uuid.uuid4().hex[:8]
    sinks.create_schema(spark, name, session.new_folder(spark, name))
    ledger_store.create_ledger(spark, name)
    trained = literal_rows(
        spark,
        [(True, False, 3, 1.0, [0.5, 2.0], 4.0, 0.5), (False, False, 3, 0.0, [0.5, 1.0], 5.0, 0.4)],
        "fit_intercept boolean, positive boolean, n bigint, intercept double, coefficients array<double>, "
        "mse double, r2 double",
    )
    rows = write.training_rows(trained, 1, "m", START)
    real, written = sinks.append, []

    def stops_at_tags(df, table):
        if table.endswith(".tags"):
            raise RuntimeError("stopped")
        written.append(table)
        real(df, table)

    monkeypatch.setattr(sinks, "append", stops_at_tags)
    with pytest.raises(RuntimeError):
        ledger_store.append_rows(rows, name)
    assert written and ledger_store.open_ledger(spark, name).runs.count() == 0
    monkeypatch.setattr(sinks, "append", real)
    for _ in range(2):
        ledger_store.append_rows(rows, name)
        counts = {table: df.count() for table, df in ledger_store.open_ledger(spark, name).tables().items()}
        assert {t: n for t, n in counts.items() if n} == {
            "runs": 2, "metrics": 4, "latest_metrics": 4, "params": 4, "tags": 2, "logged_models": 2
        }


def _files(spark, table):
    """What lies in a table's folder: name and time of change."""
    import os

    found = {}
    for path in spark.table(table).inputFiles():
        path = path.removeprefix("file://").removeprefix("file:")
        found[path] = os.stat(path).st_mtime_ns
    return found


@pytest.fixture
def many_runs(spark):
    """A stored ledger of 60 runs in eight slices, every third one with a registered version and an alias."""
    name = "ledger_" + uuid.uuid4().hex[:8]
    sinks.create_schema(spark, name, session.new_folder(spark, name))
    ledger_store.create_ledger(spark, name, slices=8)
    ids = [f"run{i}" for i in range(60)]
    rows = {
        "experiments": [(1, "revenue", "active")],
        "runs": [(i, 1, START, "active", f"runs:/{i}") for i in ids],
        "metrics": [(i, "mse", 1.0) for i in ids],
        "latest_metrics": [(i, "mse", 1.0) for i in ids],
        "params": [(i, "positive", "true") for i in ids],
        "tags": [(i, "team", "x") for i in ids],
        "model_versions": [(f"m{i}", 1, f"models:/{i}", i, "Production", "READY") for i in ids[::3]],
        "registered_models": [(f"m{i}", "active") for i in ids[::3]],
        "aliases": [(f"m{i}", "best", 1) for i in ids[::3]],
    }
    ledger_store.append_rows({t: literal_rows(spark, r, COLUMNS[t]) for t, r in rows.items()}, name)
    return name


def _slices(spark, store, ids):
    wanted = spark.createDataFrame([(i,) for i in ids], "run_uuid string")
    from pyspark.sql import functions as F

    return wanted, {r[0] for r in wanted.select(ledger_store.slice_of(F.col("run_uuid"), 8)).collect()}


def test_a_delete_leaves_the_files_of_other_slices_alone(spark, many_runs):
    gone, hit = _slices(spark, many_runs, ["run0", "run1"])
    before = {t: _files(spark, f"{many_runs}.{t}") for t in RUN_TABLES}
    ledger_store.change_runs(
        spark, many_runs, gone, lambda ledger: delete.hard_delete_runs(ledger, gone), removing=True
    )
    for table in RUN_TABLES:
        after = _files(spark, f"{many_runs}.{table}")
        others = {p: t for p, t in before[table].items() if not any(f"slice={n}/" in p for n in hit)}
        assert others and others == {p: t for p, t in after.items() if not any(f"slice={n}/" in p for n in hit)}
        left = spark.table(f"{many_runs}.{table}")
        assert left.count() == 58 and left.where("run_uuid IN ('run0', 'run1')").isEmpty()


def test_slices_left_without_runs_are_empty(spark, many_runs):
    """Every run of a slice deleted: its partition goes, and no other row."""
    runs = spark.table(f"{many_runs}.runs")
    first = runs.first()["slice"]
    gone = session.stage(runs.where(runs["slice"] == first).select("run_uuid"), "gone")
    change = lambda ledger: delete.hard_delete_runs(ledger, gone)
    for _ in range(2):
        ledger_store.change_runs(spark, many_runs, gone, change, removing=True)
        for table in RUN_TABLES:
            assert spark.table(f"{many_runs}.{table}").count() == 60 - gone.count()
            assert spark.table(f"{many_runs}.{table}").where(f"slice = {first}").isEmpty()
    nothing = gone.limit(0)
    ledger_store.change_runs(spark, many_runs, nothing, change, removing=True)


def test_soft_delete_and_restore_of_slices_give_the_same_ledger(spark, many_runs, rows):
    def all_rows():
        return {t: rows(df) for t, df in ledger_store.open_ledger(spark, many_runs).tables().items()}

    before = all_rows()
    ids, _ = _slices(spark, many_runs, ["run3", "run4"])
    ledger_store.change_runs(spark, many_runs, ids, lambda x: delete.soft_delete_runs(x, ids), removing=True)
    hidden = ledger_store.open_ledger(spark, many_runs)
    assert hidden.runs.where("lifecycle_stage = 'deleted'").count() == 2
    assert hidden.aliases.where("name = 'mrun3'").isEmpty() and hidden.aliases.count() == 19
    ledger_store.change_runs(spark, many_runs, ids, lambda x: delete.restore_runs(x, ids), removing=False)
    assert all_rows() == before


@pytest.mark.parametrize("stops_at", [2, 5, 9])
def test_a_stopped_delete_is_finished_by_a_second_call(spark, many_runs, rows, monkeypatch, stops_at):
    """Stopped before the second, fifth and last table; no alias or version is left that points at nothing."""
    ids, _ = _slices(spark, many_runs, ["run6", "run7"])

    def change(ledger):
        hidden = delete.soft_delete_runs(ledger, ids)
        return delete.hard_delete_runs(delete.delete_versions_by_source(
            hidden, ledger.model_versions.where("run_id = 'run6'").selectExpr("source AS model_uri")), ids)

    calls, rebuild, overwrite = [], sinks.rebuild_tables, sinks.overwrite_partitions

    def counted(real):
        def call(*args):
            calls.append(1)
            if len(calls) == stops_at:
                raise RuntimeError("stopped")
            return real(*args)

        return call

    monkeypatch.setattr(sinks, "rebuild_tables", counted(rebuild))
    monkeypatch.setattr(sinks, "overwrite_partitions", counted(overwrite))
    with pytest.raises(RuntimeError):
        ledger_store.change_runs(spark, many_runs, ids, change, removing=True)
    half = ledger_store.open_ledger(spark, many_runs)
    assert half.aliases.join(half.model_versions, ["name", "version"], "left_anti").isEmpty()
    ledger_store.change_runs(spark, many_runs, ids, change, removing=True)
    whole = ledger_store.open_ledger(spark, many_runs)
    assert whole.model_versions.where("name = 'mrun6'").isEmpty() and whole.model_versions.count() == 19
    assert whole.aliases.count() == whole.registered_models.count() == 19
    assert {t: getattr(whole, t).count() for t in RUN_TABLES} == dict.fromkeys(RUN_TABLES, 58)


def test_an_update_goes_on_where_it_stopped(spark, revenue, monkeypatch):
    """Stopped in every step and in the middle of the switch; steps that were finished do not run again, and the ledger
    in the end is that of an update without a stop."""
    metrics = literal_rows(spark, [(dt.date(2025, 6, 1), 50.0, None, None, 60.0, "u")], METRICS)
    better = literal_rows(spark, [(dt.date(2025, 6, 1), 1.0, None, None, 1.0, "u")], METRICS)

    def new_store():
        name = "ledger_" + uuid.uuid4().hex[:8]
        sinks.create_schema(spark, name, session.new_folder(spark, name))
        ledger_store.create_ledger(spark, name, slices=4)
        experiment = literal_rows(spark, [(1, "revenue", "active")], COLUMNS["experiments"])
        ledger_store.append_rows({"experiments": experiment}, name)
        return name

    def run(store, metrics):
        return update.update_model(spark, store, revenue, metrics, 10, *RANGES, "revenue", "revenue_model", START)

    def held(store):
        tables = ledger_store.open_ledger(spark, store).tables()
        return {t: sorted(map(tuple, df.collect()), key=repr) for t, df in tables.items()}

    smooth, store = new_store(), new_store()
    message = run(smooth, metrics)
    ran, stopping = [], None

    def watched(module, name):
        real = getattr(module, name)

        def call(*args, **more):
            ran.append(name)
            if stopping == name:
                raise RuntimeError(name)
            return real(*args, **more)

        monkeypatch.setattr(module, name, call)

    for name in ("run_training", "run_evaluation", "next_versions", "replace_tables"):
        watched(update, name)
    watched(sinks, "_take_place")
    for stopping in ("run_training", "run_evaluation", "next_versions", "replace_tables", "_take_place"):
        with pytest.raises(RuntimeError, match=stopping):
            run(store, metrics)
    stopping = None
    # The decision was made by the first call.
    assert run(store, better) == message == '{"should_retrain":true}'
    assert ran.count("run_training") == ran.count("run_evaluation") == ran.count("next_versions") == 2
    assert held(store) == held(smooth)
    ran.clear()
    assert run(store, metrics) == message
    assert ran == [] and held(store) == held(smooth)
