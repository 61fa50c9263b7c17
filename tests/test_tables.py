import datetime as dt

import pytest

from tillcast import session
from tillcast.contracts import CLIENTS, PREDICTIONS, TABLES, table_name
from tillcast.functions.dates import epoch_ms_value
from tillcast.operators import pairs
from tillcast.plans.warehouse import create_schemas
from tillcast.sources import sinks, tables

ROWS = [(1, dt.date(2025, 1, 1), 1.5, "a"), (2, dt.date(2025, 2, 1), 2.5, "b")]


def test_scan_of_declared_source(spark, schema):
    name = f"{schema}.predictions"
    sinks.create_table_if_absent(spark, name, PREDICTIONS)
    assert tables.scan_source(spark, name, PREDICTIONS).columns == ["clientID", "month", "predictedRevenue", "modelURI"]
    with pytest.raises(ValueError, match="clientName string, clientCountry string"):
        tables.scan_source(spark, name, CLIENTS)
    assert tables.list_tables(spark, schema) == ["predictions"]


def test_query_with_dates(spark):
    df = tables.read_query(spark, "SELECT '2025-01-31' AS a, date '2025-02-01' AS b, 1 AS c", ["a", "b"])
    assert tuple(df.first()) == (dt.datetime(2025, 1, 31), dt.datetime(2025, 2, 1), 1)


def test_statement_without_result(spark, schema):
    assert tables.run_query(spark, f"CREATE TABLE {schema}.t (x int) USING parquet") is None
    assert tables.list_tables(spark, schema) == ["t"]


def test_jdbc_needs_bounds_and_a_driver(spark):
    with pytest.raises(ValueError, match="bound"):
        tables.read_jdbc_query(spark, "jdbc:none:db", "SELECT 1", split_column="id")
    with pytest.raises(Exception, match="(?i)driver"):
        tables.read_jdbc_query(spark, "jdbc:none:db", "SELECT 1")


def test_random_frame_is_seeded(spark):
    first, again = tables.random_frame(spark), tables.random_frame(spark)
    assert first.collect() == again.collect() and first.count() == 20
    assert first.where("x0 < 0 or x0 >= 10 or x1 < 0 or x1 >= 10").count() == 0
    assert tables.random_frame(spark, seed=4).collect() != first.collect()


def test_rebuild_reads_the_table_it_replaces(spark, schema, rows):
    name = f"{schema}.t"
    data = tables.literal_rows(spark, ROWS, PREDICTIONS)
    sinks.rebuild_table(data, name)
    sinks.rebuild_table(spark.table(name).where("clientID = 2"), name)
    assert rows(spark.table(name)) == [ROWS[1]]
    sinks.rebuild_table(spark.table(name).union(data), name, sinks.Layout(("month",)))
    assert spark.table(name).count() == 3
    assert dict(spark.table(name).dtypes)["month"] == "date"


def test_failed_rebuild_keeps_the_old_table(spark, schema, rows):
    name = f"{schema}.t"
    sinks.rebuild_table(tables.literal_rows(spark, ROWS, PREDICTIONS), name)
    with pytest.raises(Exception):
        sinks.rebuild_table(spark.table(name).selectExpr("cast(modelURI as int) AS x"), name)
    assert rows(spark.table(name)) == ROWS
    assert tables.list_tables(spark, schema) == ["t"]


def test_bucketed_revenue_pairs_up_without_a_shuffle(spark, schema, revenue, rows):
    layout = sinks.Layout(bucket_by=("clientID",), buckets=4, sort_by=("clientID", "month"))
    for _ in range(2):
        stored = sinks.rebuild_table(revenue, f"{schema}.revenue", layout)
    found = pairs.all_pairs(stored)
    assert rows(found) == rows(pairs.all_pairs(revenue))
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()


def test_append_casts_and_matches_by_name(spark, schema, rows):
    name = f"{schema}.t"
    sinks.create_table_if_absent(spark, name, PREDICTIONS)
    given = spark.sql(
        "SELECT 'u' AS modelURI, 2.5D AS predictedRevenue, 7L AS clientID, timestamp_ntz'2025-03-01' AS month"
    )
    sinks.append(given, name)
    assert rows(spark.table(name)) == [(7, dt.date(2025, 3, 1), 2.5, "u")]
    with pytest.raises(Exception, match="(?i)overflow"):
        sinks.append(given.withColumn("clientID", given.clientID + 3_000_000_000), name)
    assert spark.table(name).count() == 1


def test_incremental_append_creates_then_adds(spark, schema):
    name = f"{schema}.t"
    data = tables.literal_rows(spark, ROWS, PREDICTIONS)
    sinks.append_incremental(data, name)
    sinks.append_incremental(data, name)
    assert spark.table(name).count() == 4


def test_overwrite_replaces_only_given_partitions(spark, schema, rows):
    name = f"{schema}.t"
    sinks.create_table_if_absent(spark, name, PREDICTIONS, sinks.Layout(("modelURI",)))
    sinks.append(tables.literal_rows(spark, ROWS, PREDICTIONS), name)
    sinks.overwrite_partitions(tables.literal_rows(spark, [(9, dt.date(2025, 3, 1), 9.0, "b")], PREDICTIONS), name)
    assert rows(spark.table(name)) == [ROWS[0], (9, dt.date(2025, 3, 1), 9.0, "b")]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_overwrite_of_an_unpartitioned_table_replaces_all(spark, schema, rows):
    name = f"{schema}.t"
    sinks.append_incremental(tables.literal_rows(spark, ROWS, PREDICTIONS), name)
    sinks.overwrite_partitions(tables.literal_rows(spark, ROWS[:1], PREDICTIONS), name)
    assert rows(spark.table(name)) == ROWS[:1]


def test_layers(spark):
    create_schemas(spark, "lay_", session.new_folder(spark, "layers"))
    found = {database.name for database in spark.catalog.listDatabases()}
    assert {"lay_" + name.split(".")[0] for name in TABLES.values()} <= found
    assert table_name("raw_sales", "lay_") == "lay_dwh_raw.sales"


def test_shared_folder_is_the_one_the_session_names(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_shuffles_are_sized_by_their_bytes():
    assert session.shuffle_partitions(0) == 200
    assert session.shuffle_partitions(20 * 2**40) == 104858


def test_stage_keeps_rows_and_types(spark, rows):
    data = tables.literal_rows(spark, ROWS, PREDICTIONS)
    stored = session.stage(data, "t")
    assert rows(stored) == ROWS and stored.dtypes == data.dtypes
    assert session.stage(data.where("false"), "t").count() == 0


def test_epoch_of_naive_datetime_is_utc():
    assert epoch_ms_value(dt.datetime(1970, 1, 2)) == 86_400_000


ODD_NAMES = ["models:/m/1", "it's", "a=b", "50%", "x y", None, "plain", "ü\\n"]


def odd_rows(spark):
    return tables.literal_rows(spark, [(i, dt.date(2025, 1, 1), float(i), u) for i, u in enumerate(ODD_NAMES * 2)], PREDICTIONS)


def test_partitioned_rebuild_with_odd_values(spark, schema, rows):
    name = f"{schema}.t"
    data = odd_rows(spark)
    for layout in (sinks.Layout(("modelURI",)), None, None):
        sinks.rebuild_table(data, name, layout)
        assert rows(spark.table(name)) == rows(data)
    sinks.rebuild_table(spark.table(name).where("clientID < 10"), name)
    assert rows(spark.table(name)) == rows(data.where("clientID < 10"))
    assert sinks.layout_of(spark, name) == sinks.Layout(("modelURI",))
    sinks.append(data.where("clientID >= 10"), name)
    assert rows(spark.table(name)) == rows(data)
    assert rows(spark.table(name).where("modelURI = 'models:/m/1'")) == rows(data.where("modelURI = 'models:/m/1'"))
    assert tables.list_tables(spark, schema) == ["t"]


def test_managed_partitioned_table_is_rebuilt(spark, schema, rows):
    name = f"{schema}.t"
    sinks.create_table_if_absent(spark, name, PREDICTIONS, sinks.Layout(("modelURI",)))
    sinks.append(odd_rows(spark), name)
    for _ in range(2):
        sinks.rebuild_table(spark.table(name), name)
        assert rows(spark.table(name)) == rows(odd_rows(spark))


@pytest.mark.parametrize("stop_at", [1, 2, 3])
def test_a_stop_while_names_change_leaves_all_rows(spark, schema, rows, monkeypatch, stop_at):
    """After a stop the table has all its old rows, or all new ones."""
    name = f"{schema}.t"
    old, new = odd_rows(spark), odd_rows(spark).where("clientID < 3")
    sinks.rebuild_table(old, name, sinks.Layout(("modelURI",)))
    calls = []
    real = type(spark).sql

    def sql(self, text, *args, **kwargs):
        if text.startswith(("ALTER TABLE", "DROP TABLE")):
            calls.append(text)
            if len(calls) == stop_at:
                raise RuntimeError("stopped")
        return real(self, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", sql)
    with pytest.raises(RuntimeError, match="stopped"):
        sinks.rebuild_table(new, name)
    monkeypatch.undo()
    spark.catalog.refreshTable(name)
    assert rows(spark.table(name)) == rows(old if stop_at < 3 else new)
