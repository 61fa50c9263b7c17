"""The physical plans that the operators are built for."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from tillcast.contracts import PREDICTIONS, REVENUE
from tillcast.operators import ledger as search
from tillcast.operators import monitoring, pairs, regression, scoring, split
from tillcast.operators.regression import LinearModel, Moments
from tillcast.plans import training
from tillcast.session import stage
from tillcast.sources.tables import literal_rows


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(autouse=True)
def no_broadcast(spark):
    """Plans as for tables that are too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(scope="module")
def stored(spark):
    """Revenue of nine months and predictions a month ahead of it."""
    months = [(dt.date(2025, m, 1), dt.date(2025, m + 1, 1), m) for m in range(1, 10)]
    data = [(c, month, 10 * c + m) for c in range(1, 9) for month, _, m in months]
    predictions = [(c, following, 10.0 * c + m, "models:/m/1") for c in range(1, 8) for _, following, m in months]
    return (
        stage(literal_rows(spark, data, REVENUE), "revenue"),
        stage(literal_rows(spark, predictions, PREDICTIONS), "predictions"),
    )


def test_pairs_shuffle_once_and_push_the_range_down(stored):
    plan = plan_of(pairs.training_pairs(stored[0], "2025-02-01", "2025-05-01"))
    assert plan.count("Exchange") == 1 and plan.count("FileScan") == 1
    assert "GreaterThanOrEqual(month,2025-02-01)" in plan and "LessThanOrEqual(month,2025-06-01)" in plan


def test_split_does_not_shuffle_the_pairs(stored):
    paired = stage(pairs.all_pairs(stored[0]), "pairs")
    plan = plan_of(split.train_test_split(paired))
    assert "Exchange" not in plan and "Window" not in plan and "Sort" not in plan


def test_backlog_is_an_anti_join(stored):
    plan = plan_of(scoring.backlog(*stored))
    assert "LeftAnti" in plan and "LeftOuter" not in plan
    # One shuffle per side: the distinct predictions are already where the join wants them.
    assert plan.count("Exchange hashpartitioning") == 2
    scored = plan_of(scoring.score(scoring.backlog(*stored), LinearModel(True, True, 0, 1.0, (0.0, 1.0)), "u"))
    assert scored.count("Exchange") == 2


def test_monitoring_reads_three_months_of_both_tables_once(stored):
    plan = plan_of(monitoring.monitor_metrics(*stored))
    assert plan.count("FileScan") == 2 and plan.count("SortMergeJoin") == 1 and "Subquery" not in plan
    assert plan.count("GreaterThanOrEqual(month,2025-07-01)") == 2


def test_newest_months_are_known_before_the_scan(stored):
    plan = plan_of(monitoring.last_months(stored[0], 2))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(month,ScalarSubquery", plan)


def test_fit_is_one_aggregate_over_three_columns(stored):
    plan = plan_of(regression.moments(stage(pairs.all_pairs(stored[0]), "pairs")))
    assert plan.count("Exchange SinglePartition") == 1 and plan.count("FileScan") == 1
    assert "ReadSchema: struct<clientID:int,revenueLastMonth:bigint,revenue:bigint>" in plan


def test_models_are_evaluated_without_a_join(spark, stored):
    models = stage(regression.models_frame(spark, [LinearModel(True, True, 0, 1.0, (0.0, 1.0))]), "models")
    plan = plan_of(training.evaluate_models(models, pairs.all_pairs(stored[0])))
    assert "Join" not in plan and "Exchange" not in plan


def test_no_window_over_an_experiment(spark):
    runs = spark.range(100).select(
        F.col("id").cast("string").alias("run_uuid"),
        (F.col("id") % 2).alias("experiment_id"),
        F.col("id").alias("start_time"),
    )
    plan = plan_of(search.latest_runs(runs))
    assert "Window" not in plan and "partial_min_by" in plan


def test_moments_of_equal_rows_are_exact(spark):
    rows = literal_rows(spark, [(3, 16, 16)] * 7, "clientID int, revenueLastMonth int, revenue int")
    found = regression.collect_moments(rows)
    assert found == Moments(7, 0, (3.0, 16.0, 16.0), ((0.0,) * 3,) * 3)
