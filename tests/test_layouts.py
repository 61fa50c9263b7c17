"""Layouts of stored tables: kept by rebuilds and appends, and used by the monthly jobs."""

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from tillcast import session
from tillcast.contracts import PREDICTIONS, REVENUE
from tillcast.operators import monitoring, pairs, scoring
from tillcast.sources import sinks
from tillcast.sources.tables import literal_rows

MONTHS = [dt.date(2020 + m // 12, m % 12 + 1, 1) for m in range(24)]


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def folder_of(spark, table):
    return sinks._described(spark, table)["Location"].removeprefix("file:")


def files(folder):
    return [os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.startswith("part-")]


@pytest.fixture
def stored(spark, schema):
    """Revenue and predictions in equal buckets of the client, sorted by month first."""
    revenue = [(c, month, 10 * c + i) for c in range(1, 41) for i, month in enumerate(MONTHS)]
    predictions = [(c, month, 9.0 * c, "models:/m/1") for c in range(1, 41) for month in MONTHS[1:] if (c + month.month) % 5]
    for name, rows, columns in (("revenue", revenue, REVENUE), ("predictions", predictions, PREDICTIONS)):
        sinks.rebuild_table(literal_rows(spark, rows, columns), f"{schema}.{name}", sinks.monthly(4))
    return f"{schema}.revenue", f"{schema}.predictions"


@pytest.mark.parametrize(
    "layout", [sinks.PLAIN, sinks.monthly(4), sinks.Layout(("month",)), sinks.Layout((), ("clientID", "month"), 3)]
)
def test_rebuild_keeps_layout_name_and_rows(spark, schema, rows, layout):
    table = f"{schema}.t"
    columns = "clientID bigint, revenue bigint, month date"
    first = literal_rows(spark, [(c, c * i, m) for c in range(9) for i, m in enumerate(MONTHS[:3])], columns)
    sinks.rebuild_table(first, table, layout)
    before = folder_of(spark, table)
    assert sinks.layout_of(spark, table) == layout
    sinks.rebuild_table(spark.table(table).where("clientID < 5").withColumn("revenue", F.col("revenue") + 1), table)
    assert sinks.layout_of(spark, table) == layout
    assert rows(spark.table(table).select("clientID", "revenue", "month")) == rows(
        first.where("clientID < 5").withColumn("revenue", F.col("revenue") + 1)
    )
    assert not os.path.exists(before) and [t.name for t in spark.catalog.listTables(schema) if not t.isTemporary] == ["t"]
    sinks.append(first.where("clientID > 6"), table)
    assert spark.table(table).count() == 5 * 3 + 2 * 3


def test_one_append_writes_at_most_one_file_a_bucket(spark, stored):
    revenue, _ = stored
    before = len(files(folder_of(spark, revenue)))
    more = spark.table(revenue).withColumn("clientID", F.col("clientID") + 100).repartition(20)
    sinks.append(more, revenue)
    assert len(files(folder_of(spark, revenue))) - before <= 4


def test_a_new_layout_replaces_the_old_one(spark, stored, rows):
    revenue, _ = stored
    old, was = folder_of(spark, revenue), rows(spark.table(revenue))
    sinks.rebuild_table(spark.table(revenue), revenue, sinks.Layout(bucket_by=("month",), buckets=2))
    assert sinks.layout_of(spark, revenue).buckets == 2 and rows(spark.table(revenue)) == was
    assert not os.path.exists(old)


def test_monthly_jobs_do_not_shuffle(spark, stored, no_broadcast):
    revenue, predictions = map(spark.table, stored)
    for df in (
        scoring.backlog(revenue, predictions),
        pairs.all_pairs(revenue),
        monitoring.revenue_with_prediction(revenue, predictions),
    ):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_a_month_filter_skips_row_groups(spark, schema, monkeypatch):
    """Sorted by month first, a month's rows lie in few row groups, and the others are not read."""
    table = f"{schema}.wide"
    rows = spark.range(40_000).select(
        (F.col("id") % 2000).alias("clientID"),
        F.add_months(F.lit("2020-01-01").cast("date"), (F.col("id") / 2000).cast("int")).alias("month"),
        F.col("id").alias("revenue"),
    )
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size", "16384")
    try:
        sinks.rebuild_table(rows, table, sinks.monthly(2))
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.block.size")
    newest = spark.table(table).where(F.col("month") >= dt.date(2021, 8, 1))
    assert newest.count() == 2000
    plan = newest.select("clientID", "month", "revenue")._jdf.queryExecution().executedPlan()
    newest.select("clientID", "month", "revenue").foreachPartition(lambda part: list(part))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(month,2021-08-01\)", plan.toString())
    plan.execute().count()
    leaf = plan.collectLeaves().head()
    assert leaf.metrics().apply("numOutputRows").value() < 40_000


def test_staged_tables_go_with_clean_up(spark):
    staged = session.new_folder(spark, "x")
    assert spark.sparkContext.applicationId in staged
