"""Pairs, split, fits, evaluation and predictions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tillcast.operators import pairs, regression, scoring, split
from tillcast.plans import training
from tillcast.registry import common
from tillcast.registry.common import EVALUATION_RANGE, PAIRS, PREDICTIONS, REVENUE, TRAIN_RANGE, WAITING, digits, digits_sql
from tillcast.session import stage
from tillcast.sources import retail, retail_ledger


def _training_pairs(spark, folder):
    return pairs.training_pairs(common.revenue(spark, folder), *TRAIN_RANGE)


def _evaluation_pairs(spark, folder):
    return pairs.evaluation_pairs(common.revenue(spark, folder), *EVALUATION_RANGE)


def train_pairs(spark, folder):
    return _training_pairs(spark, folder)


def eval_pairs(spark, folder):
    return _evaluation_pairs(spark, folder)


def train_test_split(spark, folder):
    stored = stage(_training_pairs(spark, folder), "pairs")
    return split.train_test_split(stored)


def train_test_split_newest(spark, folder):
    stored = stage(_training_pairs(spark, folder), "pairs")
    return split.train_test_split(stored, holdout="newest")


def _rounded_models(df):
    return df.select(
        "fit_intercept",
        "positive",
        "n",
        F.round("intercept", 2).alias("intercept"),
        F.round(F.col("coefficients")[0], 5).alias("coefficient_client"),
        F.round(F.col("coefficients")[1], 6).alias("coefficient_revenue"),
    )


def _fit(*settings):
    def query(spark, folder):
        models = regression.fit_linear(_training_pairs(spark, folder), settings)
        return _rounded_models(regression.models_frame(spark, models))

    return query


def train_report(spark, folder):
    report = training.train(_training_pairs(spark, folder))
    return report.select(
        "fit_intercept",
        "positive",
        "n",
        digits("mse").alias("mse"),
        F.round("r2", 6).alias("r2"),
    )


def evaluate_all_models(spark, folder):
    models = retail_ledger.ledger(spark, folder).logged_models
    evaluated = training.evaluate_models(models, _evaluation_pairs(spark, folder))
    return evaluated.select(
        "experiment_id", "model_uri", "n", digits("mse").alias("mse"), F.round("r2", 6).alias("r2")
    )


def _as_function(model_uri, intercept, coefficients):
    """A logged model as a function that tells nothing about itself."""
    weights = np.array(coefficients)

    def predict(x):
        told = x.to_numpy() @ weights
        told += intercept
        return told

    return predict


def evaluate_opaque_models(spark, folder):
    """Every logged model, evaluated as a Python function in one job over models and pairs."""
    models = retail_ledger.ledger(spark, folder).logged_models
    rows = stage(_evaluation_pairs(spark, folder), "pairs")
    evaluated = scoring.evaluate_opaque(models, rows, _as_function, ["model_uri", "intercept", "coefficients"])
    return evaluated.select(
        "experiment_id", "model_uri", "n", digits("mse").alias("mse"), F.round("r2", 6).alias("r2")
    )


def evaluate_close_models(spark, folder):
    """A model for each part that is off by a few millionths of a label that is exactly linear in the features."""
    exact = F.lit(3.0) + 2.0 * F.col("clientID") + 0.5 * F.col("revenueLastMonth")
    rows = stage(_evaluation_pairs(spark, folder).withColumn("revenue", exact), "pairs")
    key = F.col("p_partkey") % 100_003
    models = spark.read.parquet(f"{folder}/part.parquet").select(
        F.concat(F.lit("models:/m-"), F.col("p_partkey").cast("string")).alias("model_uri"),
        (3.0 + 0.001 * key).alias("intercept"),
        F.array(2.0 + 0.000001 * (key % 89), 0.5 + 0.0000001 * (1 + key % 7)).alias("coefficients"),
    )
    evaluated = training.evaluate_models(models, rows)
    return evaluated.select("model_uri", "n", F.round(F.col("mse") * 1e4).cast("bigint").alias("mse_per_10000"))


def evaluate_latest_model(spark, folder):
    ledger = retail_ledger.ledger(spark, folder)
    report = training.evaluate_latest(ledger, "1-URGENT", _evaluation_pairs(spark, folder))
    return report.withColumns({"mse": digits("mse"), "r2": F.round("r2", 6)})


def _revenue_and_predictions(spark, folder):
    revenue = stage(common.revenue(spark, folder), "revenue")
    return revenue, retail.past_predictions(revenue)


def backlog_pairs(spark, folder):
    return scoring.backlog(*_revenue_and_predictions(spark, folder))


def score_backlog(spark, folder):
    """The backlog scored with the model fitted on all pairs."""
    revenue, predictions = _revenue_and_predictions(spark, folder)
    model = regression.fit_linear(pairs.all_pairs(revenue), [regression.Setting(True, False)])[0]
    scored = scoring.score(scoring.backlog(revenue, predictions), model, "models:/m/3")
    return scored.withColumn("predictedRevenue", F.round("predictedRevenue", 2))


def score_pandas_udf(spark, folder):
    """Every client month scored by a model that is only known as a Python function."""
    rows = common.revenue(spark, folder).select(
        "clientID", F.add_months("month", 1).alias("month"), F.col("revenue").alias("revenueLastMonth")
    )
    scored = scoring.score_opaque(rows, lambda x: 1000.0 + 2.0 * x["clientID"] + 0.5 * x["revenueLastMonth"])
    return scored


def legacy_rescore(spark, folder):
    model = regression.LinearModel(True, False, 0, 10.0, (0.5, 2.0, 0.25))
    return scoring.rescore_all(common.revenue(spark, folder), model)


QUERIES = {
    "train_pairs": train_pairs,
    "eval_pairs": eval_pairs,
    "train_test_split": train_test_split,
    "train_test_split_newest": train_test_split_newest,
    "ols_intercept": _fit(regression.Setting(True, False)),
    "ols_no_intercept": _fit(regression.Setting(False, False)),
    "ols_positive": _fit(regression.Setting(True, True), regression.Setting(False, True)),
    "train_candidates": _fit(*regression.CANDIDATES),
    "train_report": train_report,
    "evaluate_all_models": evaluate_all_models,
    "evaluate_opaque_models": evaluate_opaque_models,
    "evaluate_close_models": evaluate_close_models,
    "evaluate_latest_model": evaluate_latest_model,
    "backlog_pairs": backlog_pairs,
    "score_backlog": score_backlog,
    "score_pandas_udf": score_pandas_udf,
    "legacy_rescore": legacy_rescore,
}

_TRAIN = f"""{PAIRS},
train_pairs AS (
    SELECT * FROM pairs WHERE month >= DATE '{TRAIN_RANGE[0]}' AND month <= DATE '{TRAIN_RANGE[1]}'
)"""
_EVAL = f"""{PAIRS},
eval_pairs AS (
    SELECT * FROM pairs WHERE nextMonth >= DATE '{EVALUATION_RANGE[0]}' AND nextMonth <= DATE '{EVALUATION_RANGE[1]}'
)"""


def _split_sql(direction: str) -> str:
    return f"""{_TRAIN},
split AS (
    SELECT *, row_number() OVER (ORDER BY month {direction}, clientID)
              <= floor((CAST(1 AS DOUBLE) - CAST(0.34 AS DOUBLE)) * count(*) OVER ()) AS isTraining
    FROM train_pairs
)"""


def _fits_sql(rows: str) -> str:
    """All four fits over ``rows``: normal equations, Cramer's rule, and the best of the sign patterns."""
    return f"""
xy AS (SELECT CAST(clientID AS DOUBLE) AS x1, CAST(revenueLastMonth AS DOUBLE) AS x2, CAST(revenue AS DOUBLE) AS y
       FROM {rows}),
centred AS (
    SELECT true AS fit_intercept, count(*) AS n, avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my,
           var_pop(x1) AS g11, var_pop(x2) AS g22, covar_pop(x1, x2) AS g12,
           covar_pop(x1, y) AS c1, covar_pop(x2, y) AS c2 FROM xy
),
raw AS (
    SELECT false AS fit_intercept, count(*) AS n, 0.0::DOUBLE AS m1, 0.0::DOUBLE AS m2, 0.0::DOUBLE AS my,
           avg(x1 * x1) AS g11, avg(x2 * x2) AS g22, avg(x1 * x2) AS g12, avg(x1 * y) AS c1, avg(x2 * y) AS c2 FROM xy
),
normal AS (SELECT * FROM centred UNION ALL SELECT * FROM raw),
free AS (
    SELECT *, (c1 * g22 - c2 * g12) / (g11 * g22 - g12 * g12) AS b1,
              (c2 * g11 - c1 * g12) / (g11 * g22 - g12 * g12) AS b2 FROM normal
),
patterns AS (
    SELECT fit_intercept, n, m1, m2, my, g11, g22, g12, c1, c2, b1, b2 FROM free WHERE b1 >= 0 AND b2 >= 0
    UNION ALL SELECT fit_intercept, n, m1, m2, my, g11, g22, g12, c1, c2, greatest(c1 / g11, 0), 0 FROM free
    UNION ALL SELECT fit_intercept, n, m1, m2, my, g11, g22, g12, c1, c2, 0, greatest(c2 / g22, 0) FROM free
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY fit_intercept
        ORDER BY b1*b1*g11 + 2*b1*b2*g12 + b2*b2*g22 - 2*(b1*c1 + b2*c2)) AS place FROM patterns
),
fits AS (
    SELECT fit_intercept, false AS positive, n, my - b1 * m1 - b2 * m2 AS intercept, b1, b2 FROM free
    UNION ALL
    SELECT fit_intercept, true, n, my - b1 * m1 - b2 * m2, b1, b2 FROM ranked WHERE place = 1
)"""


def _fit_oracle(where: str) -> str:
    return f"""
WITH {_TRAIN},{_fits_sql("train_pairs")}
SELECT fit_intercept, positive, n, round(intercept, 2) AS intercept,
       round(b1, 5) AS coefficient_client, round(b2, 6) AS coefficient_revenue
FROM fits WHERE {where}"""


_PAIR_COLUMNS = """clientID, month, nextMonth, CAST(revenueLastMonth AS DOUBLE) AS "revenueLastMonth",
       CAST(revenue AS DOUBLE) AS revenue"""

_ERRORS = f"""{digits_sql("avg(pow(revenue - p, 2))")} AS mse,
       round(1 - sum(pow(revenue - p, 2)) / (var_pop(revenue) * count(*)), 6) AS r2"""

EVALUATED = f"""{_EVAL},
scored AS (
    SELECT p_partkey, CAST(e.revenue AS DOUBLE) AS revenue,
           p_retailprice + 0.25 * (p_partkey % 9) * e.clientID
           + CAST(0.03125 * p_size AS DOUBLE) * CAST(e.revenueLastMonth AS DOUBLE) AS p
    FROM eval_pairs e CROSS JOIN part
),
evaluated AS (SELECT p_partkey, count(*) AS n, {_ERRORS} FROM scored GROUP BY p_partkey)"""

ORACLE = {
    "train_pairs": f"WITH {_TRAIN} SELECT {_PAIR_COLUMNS} FROM train_pairs",
    "eval_pairs": f"WITH {_EVAL} SELECT {_PAIR_COLUMNS} FROM eval_pairs",
    "train_test_split": f"""WITH {_split_sql("DESC")} SELECT {_PAIR_COLUMNS}, isTraining AS "isTraining" FROM split""",
    "train_test_split_newest": f"""
WITH {_split_sql("ASC")} SELECT {_PAIR_COLUMNS}, isTraining AS "isTraining" FROM split""",
    "ols_intercept": _fit_oracle("fit_intercept AND NOT positive"),
    "ols_no_intercept": _fit_oracle("NOT fit_intercept AND NOT positive"),
    "ols_positive": _fit_oracle("positive"),
    "train_candidates": _fit_oracle("fit_intercept = positive"),
    "train_report": f"""
WITH {_split_sql("DESC")},
training AS (SELECT * FROM split WHERE isTraining),{_fits_sql("training")},
scored AS (
    SELECT f.fit_intercept, f.positive, f.n, CAST(t.revenue AS DOUBLE) AS revenue,
           f.intercept + f.b1 * t.clientID + f.b2 * CAST(t.revenueLastMonth AS DOUBLE) AS p
    FROM split t CROSS JOIN fits f WHERE NOT t.isTraining AND f.fit_intercept = f.positive
)
SELECT fit_intercept, positive, n, {_ERRORS} FROM scored GROUP BY fit_intercept, positive, n""",
    "evaluate_all_models": f"""
WITH {EVALUATED}
SELECT p_partkey % 5 + 1 AS experiment_id, 'models:/m-' || p_partkey AS model_uri, n, mse, r2 FROM evaluated""",
    "evaluate_opaque_models": f"""
WITH {EVALUATED}
SELECT p_partkey % 5 + 1 AS experiment_id, 'models:/m-' || p_partkey AS model_uri, n, mse, r2 FROM evaluated""",
    "evaluate_close_models": f"""
WITH {_EVAL},
missed AS (
    SELECT p_partkey, 3 + 2 * CAST(e.clientID AS DOUBLE) + CAST(0.5 AS DOUBLE) * CAST(e.revenueLastMonth AS DOUBLE)
           - ((3 + CAST(0.001 AS DOUBLE) * (p_partkey % 100003))
           + (2 + CAST(0.000001 AS DOUBLE) * (p_partkey % 100003 % 89)) * e.clientID
           + (CAST(0.5 AS DOUBLE) + CAST(0.0000001 AS DOUBLE) * (1 + p_partkey % 100003 % 7))
             * CAST(e.revenueLastMonth AS DOUBLE)) AS miss
    FROM eval_pairs e CROSS JOIN part
),
means AS (SELECT p_partkey, count(*) AS n, avg(miss * miss) AS mse FROM missed GROUP BY p_partkey)
SELECT 'models:/m-' || p_partkey AS model_uri, n, CAST(round(mse * 1e4) AS BIGINT) AS mse_per_10000 FROM means""",
    "evaluate_latest_model": f"""
WITH {EVALUATED}
SELECT 'models:/m-' || p_partkey AS model_uri, CAST(p_partkey AS VARCHAR) AS source_run_id, n, mse, r2
FROM evaluated WHERE p_partkey = (SELECT max(p_partkey) FROM part WHERE p_partkey % 5 + 1 = 1)""",
    "backlog_pairs": f"""
WITH {PREDICTIONS},{WAITING}
SELECT clientID, due AS "nextMonth", known AS "revenueLastMonth" FROM waiting""",
    "score_backlog": f"""
WITH {PREDICTIONS},
pairs AS (
    SELECT n.clientID, p.revenue AS revenueLastMonth, n.revenue
    FROM revenue p JOIN revenue n
      ON n.clientID = p.clientID AND n.month = CAST(p.month + INTERVAL 1 MONTH AS DATE)
),{WAITING},{_fits_sql("pairs")}
SELECT clientID, due AS month, round(intercept + b1 * clientID + b2 * known, 2) AS "predictedRevenue",
       'models:/m/3' AS "modelURI"
FROM waiting JOIN fits ON fit_intercept AND NOT positive""",
    "score_pandas_udf": f"""
WITH {REVENUE}
SELECT clientID, CAST(month + INTERVAL 1 MONTH AS DATE) AS month, CAST(revenue AS DOUBLE) AS "revenueLastMonth",
       1000 + 2 * CAST(clientID AS DOUBLE) + CAST(0.5 AS DOUBLE) * CAST(revenue AS DOUBLE) AS "predictedRevenue"
FROM revenue""",
    "legacy_rescore": f"""
WITH {REVENUE}
SELECT clientID, month, CAST(10 + 0.5 * clientID + 2 * year(month) + 0.25 * month(month) AS DOUBLE)
       AS "predictedRevenue"
FROM revenue""",
}
