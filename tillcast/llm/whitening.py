"""Whitening of embeddings by the eigenvectors of their covariance, in mixed precision.

1. Entries become whole numbers, ``floor(scale * c) + offset``, and the fit list is each distinct vector once, written as a
   table. Sums and products are sums of whole numbers, exact in every order: entries are centred by the rounded mean
   first, products are summed a batch at a time by float64 matrix products that stay below 2**53 (larger entries in two
   halves), and Spark adds the partial sums up. So the covariance has no error but the last rounding.
2. Its eigenvectors are found in float32, and corrected by Ogita and Aishima's iteration: a few matrix products in higher
   precision (extended doubles where the machine has them), each squaring the error. Eigenvalues closer than the
   iteration can tell apart form a cluster; the covariance, shifted by the cluster's mean and seen in its vectors, is a
   small problem of its own, whose solution turns the vectors inside the cluster before the iteration goes on.
3. Rows are projected on the leading components and scaled to unit variance, and the covariance of the whitened fit list
   is measured in one more pass.

Only the covariance and the components, whose size is set by the dimension, are on the driver. Rows without a vector, or
with an entry that is null, not finite or of 2**31 or more in size, are dropped, as are vectors of another length than
most vectors of the fit list (of equally frequent lengths the greatest counts). Repeated vectors are fitted once and
whitened each; ids are handed on, null or repeated. A component without variance has no whitened value (null). An empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.llm import words as W
from tillcast.session import stage

#: How entries become whole numbers, and how many components are kept.
SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16

_BOUND = 2.0**31
_HALF = 20  # bits of the lower half of an entry
_CHUNK = 2**12  # rows whose products of halves stay below 2**53
_FLUSH = 2**9  # partial sums below 2**53 that a 64-bit sum holds
_HIGH = np.longdouble
_ROUNDS = 30


class Whitening(NamedTuple):
    """n vectors with sums ``centre * n + rest``; eigenvalues fall, vectors are columns."""

    n: int
    centre: np.ndarray
    rest: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("x")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _partials(part: Callable[[np.ndarray], Iterator[tuple[int, np.ndarray]]]):
    """Arrow function: the sums over a partition of ``part(x)``, tables of whole numbers below 2**53 in size with their
    binary exponent, as rows (exponent, i, j, total)."""

    def rows(totals: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for exponent, table in totals.items():
            i, j = np.nonzero(table)
            columns = np.full(len(i), exponent, np.int32), i.astype(np.int32), j.astype(np.int32), table[i, j]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["exponent", "i", "j", "total"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        added = 0
        for batch in batches:
            x = _matrix(batch)
            for at in range(0, len(x), _CHUNK):
                for exponent, table in part(x[at : at + _CHUNK]):
                    totals[exponent] = totals.get(exponent, 0) + table
                added += 1
                if added % _FLUSH == 0:
                    yield from rows(totals)
                    totals = {}
        yield from rows(totals)

    return run


def _total(fitted: DataFrame, part: Callable, shape: tuple[int, int]) -> np.ndarray:
    """The sum of ``part`` over all vectors, as Python's whole numbers."""
    partial = W.by_batch(fitted, _partials(part), "exponent int, i int, j int, total long")
    summed = partial.groupBy("exponent", "i", "j").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    out = np.zeros(shape, object)
    for row in summed.collect():  # at most four tables of this shape
        out[row["i"], row["j"]] += int(row["total"]) << row["exponent"]
    return out


def _sums(x: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Columns' sums, and the number of rows after them."""
    yield 0, np.append(x.sum(axis=0), len(x))[None]


def _products(centre: np.ndarray):
    """Sums, and products of all pairs of columns below them, of vectors less ``centre``."""

    def part(x: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        y = x - centre
        largest = int(np.abs(y).max(initial=0))
        table = np.zeros((y.shape[1] + 1, y.shape[1]), np.int64)
        table[0] = y.sum(axis=0)
        if largest * largest * len(y) < 2**53:
            own = y.astype(np.float64)
            table[1:] = (own.T @ own).astype(np.int64)
            yield 0, table
            return
        low, high = (y & (2**_HALF - 1)).astype(np.float64), (y >> _HALF).astype(np.float64)
        table[1:] = (low.T @ low).astype(np.int64)
        yield 0, table
        mixed, squares = np.zeros_like(table), np.zeros_like(table)
        crossed = (high.T @ low).astype(np.int64)
        mixed[1:], squares[1:] = crossed + crossed.T, (high.T @ high).astype(np.int64)
        yield _HALF, mixed
        yield 2 * _HALF, squares

    return part


def _high(whole: np.ndarray) -> np.ndarray:
    """Python's whole numbers in higher precision."""
    sign, left, out = np.sign(whole).astype(np.float64), np.abs(whole), np.zeros(whole.shape, _HIGH)
    place = _HIGH(1)
    while left.any():
        out += (left % 2**48).astype(np.float64).astype(_HIGH) * place
        left, place = left // 2**48, place * _HIGH(2.0**48)
    return out * sign


def _clusters(values: np.ndarray, gap: float) -> Iterator[np.ndarray]:
    """Indices of eigenvalues that follow each other closer than ``gap``, two at least."""
    order = np.argsort(values)
    for group in np.split(order, np.flatnonzero(np.diff(values[order]) > gap) + 1):
        if len(group) > 1:
            yield group


def eigenvectors(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors of a symmetric matrix in higher precision; the entry of a vector that
    is largest in size is positive."""
    size = len(a)
    norm = np.abs(a).max(initial=0)
    if not norm:
        return np.zeros(size, _HIGH), np.eye(size, dtype=_HIGH)
    a = a / norm
    _, x = np.linalg.eigh(a.astype(np.float32))
    x, unit = x.astype(_HIGH), np.eye(size, dtype=_HIGH)
    bound = np.abs(a).sum(axis=0).max()  # of the largest eigenvalue
    noise = 16 * size * np.finfo(_HIGH).eps  # of an entry of x' a x
    for _ in range(_ROUNDS):
        rest, seen = unit - x.T @ x, x.T @ a @ x
        values = np.diag(seen) / (1 - np.diag(rest))
        apart = values[None, :] - values[:, None]
        gap = 2 * (np.linalg.norm((seen - np.diag(np.diag(seen))).astype(float)) + bound * np.linalg.norm(rest.astype(float)))
        told = np.abs(apart) > gap
        change = np.where(told, (seen + values[None, :] * rest) / np.where(told, apart, 1), rest / 2)
        x = x + x @ change
        settled = bool((np.abs(change) <= noise / np.where(told, np.abs(apart), 1)).all())
        for group in _clusters(values, gap):
            own = x[:, group]
            inner = own.T @ (a @ own) - values[group].mean() * (own.T @ own)
            scale = np.abs(inner).max()
            if scale > noise:  # else the eigenvalues are equal
                _, turn = np.linalg.eigh(((inner + inner.T) / (2 * scale)).astype(np.float64))
                x[:, group] = own @ turn.astype(_HIGH)
                settled &= bool(np.abs(inner - np.diag(np.diag(inner))).max() <= noise)
        if settled:
            break
    for _ in range(3):  # what is left of turns in lower precision
        x = x + x @ (unit - x.T @ x) / 2
    values = np.diag(x.T @ a @ x) / np.diag(x.T @ x)
    order = np.argsort(-values, kind="stable")
    x = x[:, order] / np.sqrt((x[:, order] ** 2).sum(axis=0))
    signs = np.sign(x[np.abs(x).argmax(axis=0), np.arange(size)])
    return values[order] * norm, x * signs


def _whole(vectors: Column, scale: int, offset: int) -> Column:
    return F.transform(vectors, lambda c: (F.floor(c * F.lit(float(scale))) + F.lit(offset)).cast("long"))


def points(rows: DataFrame, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """(vec_id, x) of the rows (vec_id, embedding) that have a vector of finite entries."""
    rows = rows.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("e"))
    # A comparison with null is not true, and nan is larger than any bound.
    rows = rows.where(F.col("e").isNotNull() & F.forall("e", lambda c: c.isNotNull() & (F.abs(c) < F.lit(_BOUND))))
    return rows.select("vec_id", _whole(F.col("e"), scale, offset).alias("x"))


def _projected(x: np.ndarray, model: Whitening) -> np.ndarray:
    """Whitened values of the components with variance; nan for the others."""
    centred = (x - model.centre).astype(np.float64) - np.array([r / model.n for r in model.rest])
    scales = np.sqrt(np.where(model.values > 0, model.values, np.nan))
    return centred @ model.vectors / scales


def _white_moments(model: Whitening):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0.0
        for batch in batches:
            z = _projected(_matrix(batch), model)
            total = total + np.vstack([z.sum(axis=0), z.T @ z])
        if np.ndim(total):
            i, j = np.indices(total.shape)
            columns = i.ravel().astype(np.int32), j.ravel().astype(np.int32), total.ravel()
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["i", "j", "total"])

    return run


def _identity_error(fitted: DataFrame, model: Whitening) -> float:
    known = int((model.values > 0).sum())
    if not known:
        return 0.0
    model = model._replace(values=model.values[:known], vectors=model.vectors[:, :known])
    partial = W.by_batch(fitted, _white_moments(model), "i int, j int, total double")
    moments = np.zeros((known + 1, known))
    for row in partial.groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
        moments[row["i"], row["j"]] = row["total"] / model.n
    return float(np.abs(moments[1:] - np.outer(moments[0], moments[0]) - np.eye(known)).max())


def fit(points: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the distinct vectors ``x`` of ``points``; None where there are none."""
    fitted = stage(points.select("x").distinct(), "fit-list")
    lengths = fitted.groupBy(F.size("x").alias("size")).count()
    most = lengths.where("size > 0").agg(F.max(F.struct("count", "size")).alias("m")).first()["m"]
    if most is None:
        return None
    size = most["size"]
    fitted = fitted.where(F.size("x") == size)

    *sums, n = _total(fitted, _sums, (1, size + 1))[0]
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    found = _total(fitted, _products(centre), (size + 1, size))
    rest, squares = found[0], found[1:]
    covariance = _high(n * squares - np.outer(rest, rest)) / _HIGH(n) / _HIGH(n)
    values, vectors = eigenvectors(covariance)
    trace = np.diag(covariance).sum()
    # Below the rounding of a sum over all entries, an eigenvalue is none.
    values = np.where(values > size * np.finfo(np.float64).eps * trace, values, 0)[:components]
    model = Whitening(
        n, centre, rest.tolist(), values.astype(float), vectors[:, :components].astype(float), float(trace), 0.0
    )
    return model._replace(identity_error=_identity_error(fitted, model))


def _deviations(x: np.ndarray, model: Whitening) -> list[int | None]:
    """Sums of squares of n x - S; null above what a long holds."""
    y = x - model.centre
    rest = np.array(model.rest, object)
    bound = model.n * int(np.abs(y).max(initial=0)) + max(map(abs, model.rest), default=0)
    if bound * bound * max(1, len(rest)) < 2**63:
        whole = model.n * y - rest.astype(np.int64)
        return (whole * whole).sum(axis=1).tolist()
    whole = model.n * y.astype(object) - rest
    return [d if d < 2**63 else None for d in (whole * whole).sum(axis=1).tolist()]


_WHITE = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _whiten(model: Whitening):
    explained = model.values / model.trace if model.trace else np.zeros(len(model.values))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch)
            count, kept = len(x), len(model.values)
            z = _projected(x, model).ravel()
            every = count * kept
            yield pa.RecordBatch.from_pydict(
                {
                    "vec_id": batch.column("vec_id").take(pa.array(np.repeat(np.arange(count), kept))),
                    "component": pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), count)),
                    "n": pa.array(np.full(every, model.n, np.int64)),
                    "deviation": pa.array(_deviations(x, model), pa.int64()).take(pa.array(np.repeat(np.arange(count), kept))),
                    "whitened": pa.array(z, mask=np.isnan(z)),
                    "explained": pa.array(np.tile(explained, count)),
                    "identity_error": pa.array(np.full(every, model.identity_error)),
                }
            )

    return run


def whiten(points: DataFrame, model: Whitening | None) -> DataFrame:
    """One row per row of ``points`` and component: vec_id, component (from 1), n, deviation, whitened, explained and
    identity_error."""
    if model is None:
        return points.sparkSession.createDataFrame([], _WHITE)
    rows = points.select("vec_id", "x").where(F.size("x") == len(model.centre))
    return W.by_batch(rows, _whiten(model), _WHITE)
