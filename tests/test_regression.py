import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillcast.operators import pairs, regression, scoring
from tillcast.operators.regression import LinearModel, Setting
from tillcast.plans import training
from tillcast.sources.tables import frame_from_local, literal_rows

PAIR = "clientID bigint, revenueLastMonth double, revenue double"
OPEN = Setting(fit_intercept=True, positive=False)
THROUGH_ZERO = Setting(fit_intercept=False, positive=False)


@pytest.fixture(scope="module")
def train_pairs(revenue):
    return pairs.training_pairs(revenue, "2025-01-01", "2025-06-01")


def report(train_pairs, holdout):
    rows = training.train(train_pairs, holdout=holdout).collect()
    return {(r.fit_intercept, r.positive): r for r in rows}


def test_example_training_holdout_oldest(train_pairs):
    found = report(train_pairs, "oldest")
    first, second = found[True, True], found[False, False]
    assert list(first.coefficients) == [0, 0] and first.intercept == 16 and first.n == 1
    assert (first.mse, first.r2) == pytest.approx((8, -1))
    assert list(second.coefficients) == pytest.approx([0.181132, 0.966038], abs=1e-6)
    assert second.intercept == 0
    assert (second.mse, second.r2) == pytest.approx((33.432310, -7.358078), abs=1e-5)


def test_example_training_holdout_newest(train_pairs):
    first = report(train_pairs, "newest")[True, True]
    assert list(first.coefficients) == [0, 0] and first.intercept == 12
    assert (first.mse, first.r2) == (16, 0)


def test_example_fit_on_all_pairs(train_pairs):
    with_intercept, without = regression.fit_linear(train_pairs, [OPEN, THROUGH_ZERO])
    assert with_intercept.coefficients == pytest.approx((2, 0), abs=1e-9)
    assert with_intercept.intercept == pytest.approx(10)
    assert without.coefficients == pytest.approx((1.860065, 0.538213), abs=1e-6)


def test_example_evaluation(spark, revenue):
    chosen = pairs.evaluation_pairs(revenue, "2025-05-01", "2025-06-01")
    models = regression.models_frame(
        spark, [LinearModel(True, True, 1, 16.0, (0.0, 0.0)), LinearModel(False, False, 1, 0.0, (48 / 265, 256 / 265))]
    )
    first, second = training.evaluate_models(models, chosen).orderBy("mse").collect()
    assert (first.n, first.mse, first.r2) == (2, 0, 1)
    assert (second.mse, second.r2) == pytest.approx((29.863325, 0), abs=1e-5)
    scored = scoring.score(chosen, LinearModel(False, False, 1, 0.0, (48 / 265, 256 / 265)), "u")
    assert sorted(r.predictedRevenue for r in scored.collect()) == pytest.approx([16, 23.728302], abs=1e-6)


def test_r2_of_a_single_row_is_nan(spark):
    rows = literal_rows(spark, [(1, 2.0, 3.0)], PAIR)
    models = regression.models_frame(spark, [LinearModel(True, True, 1, 3.0, (0.0, 0.0))])
    assert math.isnan(training.evaluate_models(models, rows).first().r2)
    scored = rows.withColumn("predictedRevenue", F.lit(3.0))
    assert math.isnan(scoring.evaluate_scored(scored).first().r2)


def test_incomplete_rows_are_an_error(spark):
    rows = literal_rows(spark, [(1, 2.0, None), (2, 3.0, 4.0)], PAIR)
    with pytest.raises(ValueError, match="1 rows"):
        regression.fit_linear(rows)


def test_no_training_rows_is_an_error(spark):
    columns = "month date, " + PAIR
    with pytest.raises(ValueError, match="no training rows"):
        training.train(spark.createDataFrame([], columns))
    empty = spark.createDataFrame([], PAIR)
    with pytest.raises(ValueError, match="no rows"):
        regression.fit_linear(empty)
    with pytest.raises(ValueError, match="no rows"):
        training.evaluate_models(spark.createDataFrame([], regression.MODEL_COLUMNS), empty)


def test_many_models_by_moments_equal_row_by_row(spark):
    rng = random.Random(5)
    data = [(c, rng.uniform(0, 1e5), rng.uniform(0, 1e5)) for c in range(200)]
    rows = literal_rows(spark, data, PAIR)
    models = [
        LinearModel(True, False, 0, rng.uniform(-1e4, 1e4), (rng.uniform(-9, 9), rng.uniform(-2, 2))) for _ in range(40)
    ]
    x = np.array([row[:2] for row in data])
    y = np.array([row[2] for row in data])
    found = training.evaluate_models(regression.models_frame(spark, models), rows).collect()
    assert len(found) == 40
    for row in found:
        residual = y - row.intercept - x @ np.array(row.coefficients)
        assert row.mse == pytest.approx(np.mean(residual**2), rel=1e-9)
        assert row.r2 == pytest.approx(1 - np.sum(residual**2) / np.sum((y - y.mean()) ** 2), rel=1e-9)


def moments_of(data):
    return regression.Moments(len(data), 0, data.mean(axis=0), np.cov(data.T, bias=True))


@pytest.mark.parametrize("fit_intercept", [True, False])
def test_fits_against_brute_force(fit_intercept):
    """Free fits equal numpy's least squares; positive fits equal projected gradient descent."""
    rng = np.random.default_rng(11)
    for _ in range(40):
        x, y = rng.normal(size=(12, 2)) * [3, 1], rng.normal(size=12)
        data = np.column_stack([x, y])
        free = regression.solve(moments_of(data), Setting(fit_intercept, False))
        design = np.column_stack([np.ones(12), x]) if fit_intercept else x
        expected = np.linalg.lstsq(design, y, rcond=None)[0]
        assert free.coefficients == pytest.approx(expected[-2:], abs=1e-9)
        positive = regression.solve(moments_of(data), Setting(fit_intercept, True))
        xc, yc = (x - x.mean(axis=0), y - y.mean()) if fit_intercept else (x, y)
        b = np.zeros(2)
        step = 1 / np.linalg.eigvalsh(xc.T @ xc).max()
        for _ in range(3000):
            b = np.maximum(0, b - step * (xc.T @ (xc @ b - yc)))
        assert positive.coefficients == pytest.approx(b, abs=1e-6)


def test_features_of_very_different_size_keep_full_rank():
    """Client keys of ten digits beside revenues of three."""
    rng = np.random.default_rng(2)
    x = np.column_stack([rng.integers(1, 15_000_000_000, 500), rng.uniform(0, 900, 500)]).astype(float)
    y = 5 + 1e-9 * x[:, 0] + 0.7 * x[:, 1]
    data = np.column_stack([x, y])
    model = regression.solve(moments_of(data), OPEN)
    assert model.coefficients == pytest.approx((1e-9, 0.7), rel=1e-4)


def test_opaque_model_in_batches(spark):
    rows = literal_rows(spark, [(1, 10.0, 0.0), (2, 20.0, 0.0)], PAIR)
    scored = scoring.score_opaque(rows, lambda x: x["clientID"] * 100 + x["revenueLastMonth"])
    assert sorted(r.predictedRevenue for r in scored.collect()) == [110, 220]


def test_local_rows_by_position(spark):
    frame = frame_from_local(spark, [[1, 1], [2, 2]], ["clientID", "predictedRevenue"])
    assert frame.columns == ["clientID", "predictedRevenue"] and frame.count() == 2


def test_a_model_of_other_features_is_an_error(spark):
    pairs_ = frame_from_local(spark, [(1, 2.0, 3.0), (2, 4.0, 9.0)], ["clientID", "revenueLastMonth", "revenue"])
    found = regression.collect_moments(pairs_)
    for coefficients in ([0.0, 1.0, 999.0], [1.0], None):
        models = literal_rows(
            spark, [("models:/m", 0.0, coefficients)], "model_uri string, intercept double, coefficients array<double>"
        )
        with pytest.raises(Exception, match="models:/m has not the 2 coefficients"):
            regression.linear_errors(models, found, pairs_).collect()


def test_small_errors_keep_their_digits(spark):
    rows = [(c, 1e5 + c, 1e5 + c + 1e-5 * (-1) ** c) for c in range(1, 101)]
    pairs_ = literal_rows(spark, rows, PAIR)
    models = literal_rows(spark, [(0.0, [0.0, 1.0]), (5.0, [0.0, 1.0])], "intercept double, coefficients array<double>")
    found = regression.collect_moments(pairs_)
    errors = sorted(r.mse for r in regression.linear_errors(models, found, pairs_).collect())
    assert errors == [pytest.approx(1e-10, rel=1e-3), pytest.approx(25, rel=1e-6)]
    with pytest.raises(ValueError, match="too closely"):
        regression.linear_errors(models, found).collect()


def test_no_test_rows_is_an_error(train_pairs):
    with pytest.raises(ValueError, match="no test rows"):
        training.train(train_pairs, test_size=0)


def test_positive_fit_is_the_best_of_all_choices():
    draw = np.random.default_rng(5)
    for width in (1, 2, 3, 5):
        for _ in range(40):
            x = draw.normal(size=(30, width))
            gram, cross = x.T @ x, x.T @ draw.normal(size=30)
            best = np.zeros(width)
            for mask in range(1, 2**width):
                kept = [i for i in range(width) if mask >> i & 1]
                candidate = np.zeros(width)
                candidate[kept] = np.linalg.solve(gram[np.ix_(kept, kept)], cross[kept])
                if (candidate >= 0).all() and candidate @ gram @ candidate - 2 * candidate @ cross < (
                    best @ gram @ best - 2 * best @ cross
                ):
                    best = candidate
            assert regression._solve_positive(gram, cross) == pytest.approx(best, abs=1e-9)


def test_thousands_of_close_models_are_exact(spark):
    """More than any fixed number of models, each off by parts of a millionth, against exact fractions."""
    from fractions import Fraction

    rows = [(c, 1e5 + 7 * c, 3.0 + 2 * c + 0.5 * (1e5 + 7 * c)) for c in range(1, 101)]
    pairs_ = literal_rows(spark, rows, PAIR).repartition(5)
    given = [(3.0 + 1e-4 * i, [2.0, 0.5 + 1e-9 * (i % 13)]) for i in range(3000)]
    models = literal_rows(spark, given, "intercept double, coefficients array<double>")
    found = regression.collect_moments(pairs_)
    got = {(r.intercept, r.coefficients[1]): r for r in regression.linear_errors(models, found, pairs_).collect()}
    assert len(got) == 3000
    for intercept, (b1, b2) in given[1::71]:
        exact = [Fraction(y) - Fraction(intercept) - Fraction(b1) * c - Fraction(b2) * Fraction(x) for c, x, y in rows]
        row = got[(intercept, b2)]
        assert row.mse == pytest.approx(float(sum(e * e for e in exact) / len(rows)), rel=1e-6) and row.n == 100


def test_triangles_merge_alike(spark):
    rows = [(c % 17, float(c * c % 101), float(c)) for c in range(400)]
    one = regression.triangle_of(literal_rows(spark, rows, PAIR).repartition(1))
    many = regression.triangle_of(literal_rows(spark, rows, PAIR).repartition(37))
    a = np.column_stack([np.ones(400), *np.array(rows).T])
    for r in (one, many):
        assert np.allclose(r.T @ r, a.T @ a, rtol=1e-12)
    few = regression.triangle_of(literal_rows(spark, rows[:2], PAIR))
    assert np.allclose(few.T @ few, a[:2].T @ a[:2]) and few.shape == (4, 4)


def test_opaque_models(spark, monkeypatch):
    monkeypatch.setattr(scoring, "BLOCK_OF_MODELS", 4)
    rows = [(c % 5, float(c), float(3 * c + c % 5)) for c in range(60)]
    pairs_ = literal_rows(spark, rows, PAIR).repartition(6)
    models = literal_rows(spark, [(f"m{i}", float(i), i % 2) for i in range(10)] + [(None, 1.0, 0)], "model_uri string, a double, kind int")

    def load(uri, a, kind):
        return (lambda x: np.full(len(x), a)) if kind else (lambda x: a * x["revenueLastMonth"] + x["clientID"])

    found = scoring.evaluate_opaque(models, pairs_, load, ["model_uri", "a", "kind"])
    assert found.columns[:3] == models.columns
    got = {r.model_uri: r for r in found.collect()}
    assert len(got) == 11
    label = np.array([r[2] for r in rows])
    for r in got.values():
        told = np.array([r.a if r.kind else r.a * x + c for c, x, _ in rows])
        mse = ((label - told) ** 2).mean()
        assert (r.n, r.mse, r.r2) == (60, pytest.approx(mse), pytest.approx(1 - mse / label.var(), abs=1e-9))
    empty = scoring.evaluate_opaque(models.limit(0), pairs_, load, ["model_uri", "a", "kind"])
    assert empty.count() == 0
    with pytest.raises(ValueError):
        scoring.evaluate_opaque(models, pairs_.limit(0), load)


def test_opaque_models_take_one_job(spark, monkeypatch):
    """However many blocks of models there are: as many jobs, and every model loaded once."""
    monkeypatch.setattr(scoring, "BLOCK_OF_MODELS", 4)
    rows = [(c % 5, float(c), float(3 * c)) for c in range(60)]
    pairs_ = literal_rows(spark, rows, PAIR).repartition(6)
    loads = spark.sparkContext.accumulator(0)

    def load(a):
        loads.add(1)
        return lambda x: a * x["revenueLastMonth"]

    def jobs(count):
        models = literal_rows(spark, [(float(i),) for i in range(count)], "a double")
        group = f"opaque-{count}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            found = {r.a: r.mse for r in scoring.evaluate_opaque(models, pairs_, load, ["a"]).collect()}
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert found == {float(a): pytest.approx(np.mean([(y - a * x) ** 2 for _, x, y in rows])) for a in range(count)}
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    assert jobs(8) == jobs(96)
    assert loads.value == 8 + 96


def test_opaque_models_in_parts(spark, monkeypatch):
    """Rows and models in many blocks and parts; equal models, arrays and nulls among what tells models apart."""
    monkeypatch.setattr(scoring, "BLOCK_OF_MODELS", 3)
    monkeypatch.setattr(scoring, "BLOCK_BYTES", 7 * 24)
    monkeypatch.setattr(scoring, "BLOCKS_OF_TASK", 2)
    monkeypatch.setattr(scoring, "PREDICTIONS_OF_TASK", 90)
    assert scoring._parts(23, 100, 7, 8) == (4, 8)
    rows = [(c % 7, float(c * c % 53), float(c % 11)) for c in range(100)]
    given = [(i, None if i == 5 else f"m{i}", [0.1 * i, 1.0 - i]) for i in range(23)]
    models = literal_rows(spark, [*given, *given[3:6]], "number int, model_uri string, weights array<double>")

    def load(uri, weights):
        assert isinstance(weights, tuple)
        return lambda x: x["clientID"] * weights[0] + x["revenueLastMonth"] * weights[1] + (uri is None)

    pairs_ = literal_rows(spark, rows, PAIR).repartition(5)
    found = scoring.evaluate_opaque(models, pairs_, load, ["model_uri", "weights"]).collect()
    assert sorted(r.number for r in found) == sorted([*range(23), 3, 4, 5])
    for r in found:
        told = [c * r.weights[0] + x * r.weights[1] + (r.model_uri is None) for c, x, _ in rows]
        assert r.n == 100 and r.mse == pytest.approx(np.mean([(y - p) ** 2 for p, (_, _, y) in zip(told, rows)]))


def test_opaque_models_get_values_without_a_copy(spark):
    rows = literal_rows(spark, [(c, float(c), 1.0) for c in range(50)], PAIR)
    models = literal_rows(spark, [("m",)], "model_uri string")
    shared = scoring.evaluate_opaque(
        models, rows, lambda uri: lambda x: np.full(len(x), float(np.shares_memory(x.to_numpy(), x.to_numpy())))
    )
    assert shared.first().mse == 0
