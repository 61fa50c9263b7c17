"""The retail Parquet tables seen as an experiment ledger: orders are runs, parts are models, brands are names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillcast.functions.dates import epoch_ms
from tillcast.operators.ledger import Ledger
from tillcast.sources.retail import read

# Keys per numbered block: a (brand, block) group has at most this many parts.
BLOCK = 65536


def _text(column: str):
    return F.col(column).cast("string")


def _experiment():
    """The priority's leading digit, which numbers the five priorities by name."""
    return F.substring("o_orderpriority", 1, 1).cast("bigint")


def experiments(orders: DataFrame) -> DataFrame:
    return orders.select(
        _experiment().alias("experiment_id"),
        F.col("o_orderpriority").alias("name"),
        F.lit("active").alias("lifecycle_stage"),
    ).distinct()


def runs(orders: DataFrame) -> DataFrame:
    return orders.select(
        _text("o_orderkey").alias("run_uuid"),
        _experiment().alias("experiment_id"),
        epoch_ms(F.col("o_orderdate")).alias("start_time"),
        F.when(F.col("o_orderstatus") == "P", "deleted").otherwise("active").alias("lifecycle_stage"),
        F.concat_ws("/", F.lit("runs:"), _text("o_orderkey")).alias("artifact_uri"),
    )


def metrics(orders: DataFrame) -> DataFrame:
    return (
        orders.select(
            _text("o_orderkey").alias("run_uuid"),
            F.when(F.col("o_orderkey") % 10 != 0, F.col("o_totalprice")).alias("mse"),
            (1 / (1 + F.col("o_orderkey") % 97)).alias("r2"),
        )
        .unpivot("run_uuid", ["mse", "r2"], "key", "value")
        .where(F.col("value").isNotNull())
    )


def params(orders: DataFrame) -> DataFrame:
    return orders.select(
        _text("o_orderkey").alias("run_uuid"), F.lit("status").alias("key"), F.col("o_orderstatus").alias("value")
    )


def tags(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("o_orderkey") % 11 != 0).select(
        _text("o_orderkey").alias("run_uuid"),
        F.when(F.col("o_orderkey") % 2 == 0, "evaluated_model_uri").otherwise("created_model_uri").alias("key"),
        F.concat(F.lit("models:/m-"), _text("o_orderkey")).alias("value"),
    )


def logged_models(part: DataFrame) -> DataFrame:
    """Models that predict about half to one and a half of last month's revenue."""
    return part.select(
        F.concat(F.lit("m-"), _text("p_partkey")).alias("model_id"),
        (F.col("p_partkey") % 5 + 1).alias("experiment_id"),
        _text("p_partkey").alias("source_run_id"),
        F.concat(F.lit("models:/m-"), _text("p_partkey")).alias("model_uri"),
        F.concat(F.lit("artifacts:/m-"), _text("p_partkey")).alias("artifact_location"),
        F.col("p_partkey").alias("creation_timestamp"),
        F.col("p_retailprice").alias("intercept"),
        F.array(F.lit(0.25) * (F.col("p_partkey") % 9), F.lit(0.03125) * F.col("p_size")).alias("coefficients"),
    )


def model_versions(part: DataFrame) -> DataFrame:
    """One version per part, numbered by key inside its brand.

    A brand may hold a third of all parts, so the number is the position inside a block of keys plus the sizes of the
    brand's earlier blocks.
    """
    part = part.select("p_brand", "p_partkey", F.expr(f"p_partkey div {BLOCK}L").alias("block"))
    earlier = Window.partitionBy("p_brand").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        part.groupBy("p_brand", "block")
        .count()
        .select("p_brand", "block", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    )
    inside = F.row_number().over(Window.partitionBy("p_brand", "block").orderBy("p_partkey"))
    version = (F.col("before") + F.col("inside")).cast("int")
    return (
        part.withColumn("inside", inside)
        .join(offsets, ["p_brand", "block"])
        .select(
            F.col("p_brand").alias("name"),
            version.alias("version"),
            F.concat(F.lit("models:/m-"), _text("p_partkey")).alias("source"),
            _text("p_partkey").alias("run_id"),
            F.when(version == 1, "Production").otherwise("None").alias("current_stage"),
            F.lit("READY").alias("status"),
        )
    )


def registered_models(part: DataFrame, nation: DataFrame) -> DataFrame:
    """Brands, and nations as names without versions."""
    names = part.select(F.col("p_brand").alias("name")).distinct().union(nation.select("n_name"))
    return names.withColumn("lifecycle_stage", F.lit("active"))


def aliases(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_brand").alias("name"), F.lit("Production").alias("alias"), F.lit(1).alias("version")
    ).distinct()


def ledger(spark: SparkSession, folder: str) -> Ledger:
    orders, part = read(spark, folder, "orders"), read(spark, folder, "part")
    return Ledger(
        experiments=experiments(orders),
        runs=runs(orders),
        metrics=metrics(orders),
        latest_metrics=metrics(orders),
        params=params(orders),
        tags=tags(orders),
        logged_models=logged_models(part),
        model_versions=model_versions(part),
        registered_models=registered_models(part, read(spark, folder, "nation")),
        aliases=aliases(part),
    )
