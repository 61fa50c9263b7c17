"""One key holds a third of all rows: oversized join partitions are split, and the results stay whole."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillcast.operators import ledger_delete as delete
from tillcast.operators import ledger_write as write
from tillcast.operators import warehouse
from tillcast.operators.ledger_write import empty_ledger
from tillcast.session import stage

ROWS = 300_000

SETTINGS = {
    "spark.sql.shuffle.partitions": "32",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def large(spark):
    """The session as it behaves when no side of a join is small enough to broadcast."""
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot_key(rows: int = ROWS):
    """A third of the ids share key 1, the others have many keys."""
    return F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 1009 + 2)


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    rows = df.collect()
    return df._jdf.queryExecution().executedPlan().toString(), rows


def test_hot_product(large):
    sales = stage(
        large.range(ROWS).repartition(8).select(
            (F.col("id") % 5000).cast("int").alias("clientID"),
            hot_key().cast("int").alias("productID"),
            F.lit(dt.date(2025, 1, 1)).alias("date"),
            (F.col("id") % 7).cast("int").alias("amount"),
        ),
        "sales",
    )
    products = stage(
        large.range(1, 1012).select(
            F.col("id").cast("int").alias("productID"), F.lit("p").alias("productName"), F.lit(3).alias("price")
        ),
        "products",
    )
    fact = warehouse.fact_sales(sales, warehouse.dim_products(products, products))
    plan, rows = final_plan(fact.select("totalPrice"))
    assert "skew=true" in plan
    assert len(rows) == ROWS
    assert sum(r.totalPrice for r in rows) == sum(3 * (i % 7) for i in range(ROWS))


@pytest.fixture
def ledger(large):
    """A run with a third of all tags, and a name with a third of all versions."""
    tags = large.range(ROWS).repartition(8).select(
        hot_key().cast("string").alias("run_uuid"), F.lit("t").alias("key"), F.col("id").cast("string").alias("value")
    )
    versions = large.range(ROWS).repartition(8).select(
        hot_key().cast("string").alias("name"),
        F.col("id").cast("int").alias("version"),
        F.col("id").cast("string").alias("source"),
        F.lit("r").alias("run_id"),
        F.when(F.col("id") == 3, "Production").otherwise("None").alias("current_stage"),
        F.lit("READY").alias("status"),
    )
    names = large.range(1, 1012).select(
        F.col("id").cast("string").alias("name"), F.lit("active").alias("lifecycle_stage")
    )
    return empty_ledger(large).with_tables(
        tags=stage(tags, "tags"), model_versions=stage(versions, "versions"), registered_models=stage(names, "names")
    )


def test_hot_run_is_deleted(large, ledger):
    ids = stage(large.range(1, 500).select(F.col("id").cast("string").alias("run_uuid")), "ids")
    plan, rows = final_plan(delete.hard_delete_runs(ledger, ids).tags)
    assert "skew=true" in plan
    assert len(rows) == sum(1 for i in range(ROWS) if i % 3 and i % 1009 + 2 >= 500)


def test_hot_name_is_hidden(ledger):
    names = ledger.registered_models.where("cast(name AS int) < 500")
    plan, rows = final_plan(delete.soft_delete_names(ledger, names).model_versions)
    assert "skew=true" in plan
    assert len(rows) == ROWS
    hidden = sum(r.current_stage == "Deleted_Internal" for r in rows)
    assert hidden == sum(1 for i in range(ROWS) if not i % 3 or i % 1009 + 2 < 500)


def test_hot_name_is_promoted(ledger):
    chosen = stage(ledger.registered_models.select("name", F.lit(6).alias("version")), "chosen")
    plan, rows = final_plan(write.transition_stage(ledger, chosen).model_versions)
    assert "skew=true" in plan
    assert len(rows) == ROWS
    stages = {(r.name, r.version): r.current_stage for r in rows}
    assert stages["1", 6] == "Production" and stages["1", 3] == "Archived"


def test_hot_client_is_summed_before_the_shuffle(large):
    fact = large.range(ROWS).select(
        hot_key().cast("int").alias("clientID"), F.lit(dt.date(2025, 1, 1)).alias("date"), F.lit(2).alias("totalPrice")
    )
    plan, rows = final_plan(warehouse.clients_total_revenue(fact))
    assert "partial_sum" in plan
    assert {r.clientID: r.revenue for r in rows}[1] == 2 * ROWS // 3
