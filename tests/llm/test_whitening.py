import math
from fractions import Fraction

import numpy as np
import pytest
from texts import SF

from tillcast.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x string, n long"


@pytest.fixture(scope="module")
def build(spark):
    return lambda vectors: spark.createDataFrame([(i, v, 1, "x", 5) for i, v in vectors], SCHEMA)


def whole(vector):
    return [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in vector]


def white(df):
    points = whitening.points(df)
    return whitening.whiten(points, whitening.fit(points))


def compare(vectors, found):
    """Against exact sums and numpy's eigenvectors of the exactly centred covariance, row by row."""
    good = [(i, whole(v)) for i, v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fitted = sorted({tuple(x) for _, x in good})
    n, sums = len(fitted), [sum(c) for c in zip(*fitted)]
    d = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(x, sums)] for x in fitted])
    values, vectors = np.linalg.eigh(d.T @ d / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(16, len(values))
    by_row = {}
    for r in found:
        by_row.setdefault((r["vec_id"], r["deviation"]), []).append(r)
    expected = {}
    for i, x in good:
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        expected[(i, deviation)] = np.array([float(Fraction(n * c - s, n)) for c, s in zip(x, sums)])
    assert set(by_row) == set(expected)
    signs = {}
    for key, centred in expected.items():
        z = centred @ vectors[:, :k] / np.sqrt(values[:k])
        for r in by_row[key]:
            j = r["component"] - 1
            assert r["n"] == n and r["explained"] == pytest.approx(values[j] / values.sum(), rel=1e-9)
            assert r["identity_error"] < 1e-9
            assert abs(r["whitened"]) == pytest.approx(abs(z[j]), abs=1e-8)
            if abs(z[j]) > 1e-3:
                assert signs.setdefault(j, np.sign(r["whitened"] * z[j])) == np.sign(r["whitened"] * z[j])
    return k


def test_query_is_brute_force(spark):
    found = queries.op13_embedding_whitening(spark, SF).collect()
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    assert compare([tuple(r) for r in rows], found) == 16
    assert len(found) == 16 * len(rows)


def test_odd_rows_go_and_copies_count_once(build):
    random = np.random.default_rng(0)
    vectors = [(i, random.normal(size=5).astype(np.float32).tolist()) for i in range(300)]
    hot = vectors[0][1]
    odd = [(None, hot), (7, vectors[7][1]), (900, None), (901, [1.0, None, 1.0, 1.0, 1.0]), (902, [float("nan")] * 5)]
    odd += [(903, [float("inf")] * 5), (904, [])] + [(1000 + i, hot) for i in range(200)]
    found = white(build(vectors + odd)).collect()
    ids = {r["vec_id"] for r in found}
    assert not ids & {900, 901, 902, 903, 904} and None in ids and len(found) == 5 * (300 + 2 + 200)
    compare([(i, v) for i, v in vectors + odd if v != []], found)


def test_other_lengths_and_huge_entries_go(build):
    vectors = [(i, [float(i % 7), float(i % 3)]) for i in range(21)] + [(50, [1.0]), (51, [1e30, 0.0])]
    assert {r["vec_id"] for r in white(build(vectors)).collect()} == set(range(21))


def test_large_entries_stay_exact(build):
    random = np.random.default_rng(1)
    vectors = [(i, (random.normal(size=3) * 1e8).astype(np.float32).tolist()) for i in range(50)]
    points = whitening.points(build(vectors))
    model = whitening.fit(points)
    fitted = [whole(v) for _, v in vectors]
    sums = [sum(c) for c in zip(*fitted)]
    assert [c * model.n + r for c, r in zip(model.centre.tolist(), model.rest)] == sums
    for r in whitening.whiten(points, model).collect():
        exact = sum((50 * c - s) ** 2 for c, s in zip(fitted[r["vec_id"]], sums))
        assert r["deviation"] == (exact if exact < 2**63 else None)
        assert r["identity_error"] < 1e-9


def test_no_variance(build):
    found = white(build([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert [(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in found] == [
        (1, 0, None, 0.0, 0.0)
    ] * 4
    found = white(build([(i, [float(i), 2.0 * i]) for i in range(9)])).collect()
    assert {r["component"]: r["whitened"] is None for r in found} == {1: False, 2: True}


def test_empty(build):
    assert white(build([])).collect() == [] and white(build([(1, None), (2, [])])).collect() == []


@pytest.mark.parametrize(
    "values",
    [
        np.ones(20),
        np.r_[np.ones(10), np.linspace(2, 3, 10)],
        np.r_[1 + 1e-9 * np.arange(10), np.linspace(2, 3, 10)],
        np.r_[1 + 1e-13 * np.arange(10), 5 + 1e-5 * np.arange(10)],
        np.r_[np.zeros(10), 10.0 ** -np.arange(10)],
    ],
)
def test_eigenvectors_of_clustered_values(values):
    high = np.longdouble
    turn, _ = np.linalg.qr(np.random.default_rng(2).normal(size=(20, 20)))
    turn = turn.astype(high)
    for _ in range(3):
        turn = turn + turn @ (np.eye(20, dtype=high) - turn.T @ turn) / 2
    a = (turn * values.astype(high)) @ turn.T
    a = (a + a.T) / 2
    found, x = whitening.eigenvectors(a)
    assert np.allclose(np.sort(values)[::-1].astype(float), found.astype(float), rtol=0, atol=1e-16)
    assert float(np.abs(a @ x - x * found).max()) < 1e-17 and float(np.abs(x.T @ x - np.eye(20)).max()) < 1e-17


def test_products_in_halves_are_exact():
    random = np.random.default_rng(3)
    for size in (100, 2**24, 2**37):
        x = random.integers(-size, size, (1000, 4))
        total = np.zeros((5, 4), object)
        for exponent, table in whitening._products(np.array([1, 2, 3, 4]))(x):
            total += table.astype(object) << exponent
        y = x.astype(object) - np.array([1, 2, 3, 4], object)
        assert (total[0] == y.sum(axis=0)).all() and (total[1:] == y.T.dot(y)).all()
