"""Searches by filter and order texts, and runs with keys that nobody has named."""

import pytest
from pyspark.sql import functions as F
from tillcast.operators import ledger as search
from tillcast.operators import ledger_search as texts
from tillcast.sources import retail_ledger

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def ledger(spark):
    found = retail_ledger.ledger(spark, SF)
    odd = spark.sql(
        "SELECT run_uuid, k AS key, v AS value FROM VALUES ('1', 'a b', 'x''y'), ('1', 'a.b', 'dotted'), ('2', 'a b', 'z')"
        " AS t(run_uuid, k, v)"
    )
    nan = spark.sql("SELECT '1' AS run_uuid, 'odd' AS key, double('NaN') AS value UNION ALL SELECT '2', 'odd', 3.0D")
    return found.with_tables(
        tags=found.tags.unionByName(odd), latest_metrics=found.latest_metrics.unionByName(nan)
    )


def ids(df):
    return [r.run_uuid for r in df.collect()]


@pytest.mark.parametrize(
    "text, condition",
    [
        ("metrics.mse < 100000", "mse < 100000"),
        ("metric.mse >= 100000 and attributes.start_time > 800000000000", "mse >= 100000 AND start_time > 800000000000"),
        ("params.status = 'O'", "status = 'O'"),
        ('params."status" IN ("O", "F") AND metrics.`r2` < 0.1', "status IN ('O', 'F') AND r2 < 0.1"),
        ("param.status LIKE '%F' AND start_time < 900000000000", "status LIKE '%F' AND start_time < 900000000000"),
        ("run_id != '7' AND attribute.artifact_uri LIKE 'runs:/1%'", "run_uuid != '7' AND artifact_uri LIKE 'runs:/1%'"),
        ("tags.evaluated_model_uri ILIKE 'MODELS:/M-%4'", "uri LIKE 'models:/m-%4'"),
    ],
)
def test_filters(spark, ledger, text, condition):
    def value(table, key, name):
        return getattr(ledger, table).where(F.col("key") == key).select("run_uuid", F.col("value").alias(name))

    plain = search.by_view(ledger.runs)
    for table, key, name in [
        ("latest_metrics", "mse", "mse"), ("latest_metrics", "r2", "r2"), ("params", "status", "status"),
        ("tags", "evaluated_model_uri", "uri"),
    ]:
        plain = plain.join(value(table, key, name), "run_uuid", "left")
    expected = sorted(ids(plain.where(condition)))
    assert expected and sorted(ids(texts.find_runs(ledger, filter_text=text))) == expected


def test_keys_of_odd_characters_and_names_in_strings(ledger):
    assert ids(texts.find_runs(ledger, filter_text="tags.`a b` = 'x''y'", view="all")) == ["1"]
    assert ids(texts.find_runs(ledger, filter_text='tags."a b" LIKE \'z\'', view="all")) == ["2"]
    assert ids(texts.find_runs(ledger, filter_text="tags.a.b = 'dotted'", view="all")) == ["1"]
    assert ids(texts.find_runs(ledger, filter_text="tags.`a b` = 'tags.x and start_time'", view="all")) == []


def test_order_puts_nan_and_null_last(ledger):
    for text in ("metrics.odd", "metrics.odd DESC", "metrics.odd asc"):
        found = texts.find_runs(ledger, filter_text="run_id IN ('1', '2', '3')", order_by=[text], view="all")
        assert ids(found) == ["2", "1", "3"]


def test_order_ties_and_limit(ledger):
    found = texts.find_runs(ledger, [1], order_by=["params.status", "start_time DESC"], max_results=7)
    status = ledger.params.where("key = 'status'").select("run_uuid", F.col("value").alias("s"))
    plain = search.by_view(ledger.runs).where("experiment_id = 1").join(status, "run_uuid")
    assert ids(found) == ids(plain.orderBy("s", F.desc("start_time"), "run_uuid").limit(7))


@pytest.mark.parametrize(
    "text", ["metrics.mse <", "mse < 1", "colour.x = 1", "start_time", "params.status = = 'O'", "attributes.nothing = 1", "("]
)
def test_wrong_filters_are_value_errors(ledger, text):
    with pytest.raises(ValueError):
        texts.find_runs(ledger, filter_text=text)


@pytest.mark.parametrize("text", ["", "metrics.mse SIDEWAYS", "nothing DESC", "metrics.mse DESC DESC"])
def test_wrong_orders_are_value_errors(ledger, text):
    with pytest.raises(ValueError):
        texts.find_runs(ledger, order_by=[text])


def test_models_versions_and_names(ledger):
    found = texts.find_models(ledger, [2], "creation_timestamp <= 90 AND intercept > 900", ["intercept DESC"], 5).collect()
    rows = [r for r in ledger.logged_models.where("experiment_id = 2").collect() if r.creation_timestamp <= 90]
    rows = sorted((r for r in rows if r.intercept > 900), key=lambda r: (-r.intercept, -r.creation_timestamp))
    assert found and [r.model_id for r in found] == [r.model_id for r in rows[:5]]
    versions = texts.find_versions(ledger, "name = 'Brand#11'", ["version DESC"]).collect()
    assert [r.version for r in versions] == list(range(len(versions), 0, -1)) and versions
    names = [r.name for r in texts.find_registered(ledger, "name NOT LIKE 'Brand%'", ["name DESC"], 3).collect()]
    every = {r.name for r in ledger.registered_models.collect()}
    assert names == sorted((n for n in every if not n.startswith("Brand")), reverse=True)[:3]
    with pytest.raises(ValueError, match="only runs"):
        texts.find_models(ledger, filter_text="metrics.mse < 1")


def test_conditions_reach_the_scans(ledger):
    plan = texts.find_runs(ledger, [1], "params.status = 'O' AND run_id = '5'")._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftOuter" not in plan  # a condition on a key leaves out runs without it
    plan = texts.find_runs(ledger, filter_text="start_time > 5")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan  # no key named, no table of keys read


def test_all_keys_and_maps(ledger):
    runs = ledger.runs.where("run_uuid IN ('1', '2', '3', '999999')")
    wide = {r.run_uuid: r.asDict() for r in search.runs_with_all_keys(ledger, runs).collect()}
    assert set(wide["1"]) >= {"metrics_odd", "tags_a b", "tags_a.b", "params_status"}
    assert wide["1"]["tags_a b"] == "x'y" and wide["2"]["metrics_odd"] == 3.0 and wide["3"]["tags_a b"] is None
    maps = {r.run_uuid: r for r in search.runs_with_maps(ledger, ledger.runs).collect()}
    assert len(maps) == ledger.runs.count()
    assert maps["1"].tags["a.b"] == "dotted" and maps["2"].metrics["odd"] == 3.0 and "a b" not in maps["3"].tags
    for run, row in wide.items():
        for kind in ("metrics", "params", "tags"):
            own = {k.removeprefix(f"{kind}_"): v for k, v in row.items() if k.startswith(f"{kind}_") and v is not None}
            assert {k: v for k, v in own.items() if v == v} == {k: v for k, v in maps[run][kind].items() if v == v}


def test_runs_without_keys_and_too_many_keys(spark, ledger):
    nothing = ledger.with_tables(tags=ledger.tags.limit(0), params=ledger.params.limit(0))
    row = search.runs_with_maps(nothing, ledger.runs.where("run_uuid = '1'")).first()
    assert row.tags == {} and row.params == {} and row.metrics
    with pytest.raises(ValueError, match="more than 2 keys"):
        search.runs_with_all_keys(ledger, ledger.runs, most=2)
