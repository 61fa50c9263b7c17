"""Predictions as columns, and the months still without one."""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.contracts import FEATURES, LABEL
from tillcast.functions import errors
from tillcast.functions.dates import month_from_parts, shift_months
from tillcast.operators.regression import LinearModel, collect_moments
from tillcast.session import stage


def backlog(revenue: DataFrame, predictions: DataFrame) -> DataFrame:
    """(clientID, nextMonth, revenueLastMonth) of every revenue row whose next month has no prediction."""
    wanted = revenue.select(
        "clientID", shift_months(F.col("month")).alias("nextMonth"), F.col("revenue").alias("revenueLastMonth")
    )
    # Distinct before the shuffle: many predictions for one client and month must not meet in one task.
    done = predictions.select("clientID", F.col("month").alias("nextMonth")).distinct()
    return wanted.join(done, ["clientID", "nextMonth"], "left_anti")


def linear_prediction(model: LinearModel, features: Sequence[str] = FEATURES) -> Column:
    value = F.lit(model.intercept)
    for coefficient, feature in zip(model.coefficients, features, strict=True):
        value = value + F.lit(coefficient) * F.col(feature).cast("double")
    return value


def score(rows: DataFrame, model: LinearModel, model_uri: str, features: Sequence[str] = FEATURES) -> DataFrame:
    """Backlog rows as prediction rows: clientID, month, predictedRevenue, modelURI."""
    return rows.select(
        "clientID",
        F.col("nextMonth").alias("month"),
        linear_prediction(model, features).alias("predictedRevenue"),
        F.lit(model_uri).alias("modelURI"),
    )


def score_opaque(
    rows: DataFrame,
    predict: Callable[[pd.DataFrame], Sequence[float]],
    features: Sequence[str] = FEATURES,
    name: str = "predictedRevenue",
) -> DataFrame:
    """Adds the predictions of any model that takes a frame of features, one Arrow batch at a time."""

    @F.pandas_udf("double")
    def predict_batch(batch: pd.DataFrame) -> pd.Series:
        return pd.Series(predict(batch), dtype="float64")

    return rows.withColumn(name, predict_batch(F.struct(*[F.col(f).cast("double").alias(f) for f in features])))


def evaluate_scored(rows: DataFrame, actual: str = "revenue", predicted: str = "predictedRevenue") -> DataFrame:
    """One row ``n``, ``mse``, ``r2`` from rows that carry a prediction."""
    y, p = F.col(actual), F.col(predicted)
    return rows.agg(F.count(y).alias("n"), errors.mse(y, p).alias("mse"), errors.r2(y, p).alias("r2"))


#: Models that a worker has loaded at a time.
BLOCK_OF_MODELS = 1000
#: Bytes of features and label that a model gets at a time: many enough to make a call worth its while, few enough for
#: a core's share of the cache.
BLOCK_BYTES = 2**21
#: Blocks of rows, and predictions, of one task at most.
BLOCKS_OF_TASK = 16
PREDICTIONS_OF_TASK = 2**31
_BOUND = "spark.sql.execution.arrow.maxBytesPerBatch"

#: The models that a worker loaded last.
_LOADED: dict[tuple, list[Callable]] = {}


def _in_blocks(most: int, pack: Callable[[pa.Table], bytes]):
    """Arrow function: rows to blocks of at most ``most`` rows, each a row (first, block) with its first value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(rows: pa.Table) -> pa.RecordBatch:
            first = rows.column(0).slice(0, 1).combine_chunks()
            return pa.RecordBatch.from_pydict({"first": first, "block": [pack(rows)]})

        held = None
        for batch in batches:
            more = pa.Table.from_batches([batch])
            held = more if held is None else pa.concat_tables([held, more])
            while held.num_rows >= most:
                yield packed(held.slice(0, most))
                held = held.slice(most)
        if held is not None and held.num_rows:
            yield packed(held)

    return run


def _pack_rows(rows: pa.Table) -> bytes:
    """Doubles, one column after the other."""
    return np.stack([column.to_numpy() for column in rows.columns]).tobytes()


def _pack_models(rows: pa.Table) -> bytes:
    return pickle.dumps((rows.column(0).to_numpy(), rows.column(1).to_pylist()))


def _loaded(told: str, first: int, models: Sequence[bytes], load: Callable) -> list[Callable]:
    """The functions of a block of models; they stay with the worker until it gets another block."""
    if (told, first) not in _LOADED:
        _LOADED.clear()
        _LOADED[told, first] = [load(*pickle.loads(model)) for model in models]
    return _LOADED[told, first]


def _partial_errors(load: Callable, told: str, names: Sequence[str], most: int):
    """Arrow function: blocks of models beside blocks of rows to (_place, total), a model's sum of squared errors."""

    def missed_by(functions: Sequence[Callable], blocks: Sequence[np.ndarray]) -> np.ndarray:
        data = np.concatenate(blocks, axis=1)
        # One array under the whole frame: a model that asks for its values gets them without a copy.
        inputs, actual = pd.DataFrame(data[:-1].T, columns=list(names)), data[-1]
        missed, totals = np.empty_like(actual), np.empty(len(functions))
        for place, function in enumerate(functions):
            np.subtract(actual, np.asarray(function(inputs), dtype=float), out=missed)
            totals[place] = missed @ missed
        return totals

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, places, functions, waiting = None, None, (), []

        def found() -> pa.RecordBatch:
            totals = missed_by(functions, waiting)
            waiting.clear()
            return pa.RecordBatch.from_pydict({"_place": places, "total": totals})

        for batch in batches:
            for first, models, data in zip(*batch.columns, strict=True):
                if block != first.as_py():
                    if waiting:
                        yield found()
                    block, (places, packed) = first.as_py(), pickle.loads(models.as_buffer())
                    functions = _loaded(told, block, packed, load)
                waiting.append(np.frombuffer(data.as_py()).reshape(len(names) + 1, -1))
                if sum(rows.shape[1] for rows in waiting) >= most:
                    yield found()
        if waiting:
            yield found()

    return run


def _parts(models: int, rows: int, most: int, cores: int) -> tuple[int, int]:
    """Parts of the models and of the rows; each part of the one meets each of the other in a task.

    Few parts of the rows, as every one loads all models; many of the models, as every one reads all rows.
    """
    by_rows = max(-(-rows // (most * BLOCKS_OF_TASK)), min(-(-rows // most), 2 * cores // max(1, models)), 1)
    tasks = max(-(-models * rows // PREDICTIONS_OF_TASK), 2 * cores)
    return max(1, min(models, -(-tasks // by_rows))), by_rows


def evaluate_opaque(
    models: DataFrame,
    rows: DataFrame,
    load: Callable,
    by: Sequence[str] = ("model_uri",),
    features: Sequence[str] = FEATURES,
    label: str = LABEL,
) -> DataFrame:
    """Adds ``n``, ``mse`` and ``r2`` to models that are only known as Python functions, any number of them.

    ``load`` makes a function of a frame of features from a model's columns ``by``. One job evaluates all models: a
    task takes some blocks of models and some of rows, loads a block of models once, runs it over all its rows and
    gives each model's sums of squared errors, which Spark adds up. Neither models, rows nor predictions come to the
    driver, and predictions are not shuffled. Rows without a feature or label, or no rows at all, are an error.
    """
    spark, told = rows.sparkSession, uuid.uuid4().hex
    spread = collect_moments(rows, features, label)
    spread.check()
    named = stage(models.select(*by).distinct().withColumn("_place", F.monotonically_increasing_id()), "models")
    count, most = named.count(), max(1, BLOCK_BYTES // (8 * (len(features) + 1)))
    by_models, by_rows = _parts(count, spread.n, most, spark.sparkContext.defaultParallelism)

    @F.udf("binary")
    def one_model(*model) -> bytes:
        return pickle.dumps(tuple(tuple(v) if isinstance(v, list) else v for v in model))

    in_block = max(1, min(BLOCK_OF_MODELS, -(-count // by_models)))
    model_blocks = (
        named.select("_place", one_model(*by))
        .mapInArrow(_in_blocks(in_block, _pack_models), "first bigint, block binary")
        .select("first", F.col("block").alias("models"))
        .repartition(by_models)
    )
    inputs = [F.col(c).cast("double").alias(c) for c in features]
    row_blocks = (
        rows.select(*inputs, F.col(label).cast("double").alias("actual"))
        .mapInArrow(_in_blocks(most, _pack_rows), "first double, block binary")
        .select(F.col("block").alias("rows"))
        .repartition(by_rows)
    )
    # Every model meets every row: a task for each part of the blocks of models and each of the blocks of rows.
    met = model_blocks.hint("shuffle_replicate_nl").crossJoin(row_blocks)
    partial = met.mapInArrow(_partial_errors(load, told, features, most), "_place bigint, total double")
    totals = partial.groupBy("_place").agg((F.sum("total") / F.lit(spread.n)).alias("mse"))
    bound = spark.conf.get(_BOUND, None)
    spark.conf.set(_BOUND, str(BLOCK_BYTES))  # a block of rows is a batch of its own
    try:
        found = stage(named.join(totals, "_place").select(*by, "mse"), "errors")
    finally:
        spark.conf.unset(_BOUND) if bound is None else spark.conf.set(_BOUND, bound)
    named = found.select(*(F.col(c).alias(f"_{c}") for c in by), "mse")
    same = F.lit(True)
    for c in by:
        same = same & models[c].eqNullSafe(named[f"_{c}"])
    n, variance = F.lit(spread.n).cast("bigint"), F.lit(spread.covariances[-1][-1])
    found = models.join(named, same).drop(*(f"_{c}" for c in by)).withColumn("n", n)
    return found.withColumn("r2", errors.r2_from_parts(F.col("n"), F.col("mse"), variance))


def rescore_all(revenue: DataFrame, model: LinearModel) -> DataFrame:
    """Every revenue row scored on client, year and month number; the month is put together again from its parts."""
    parts = revenue.select("clientID", F.year("month").alias("year"), F.month("month").alias("month"))
    prediction = linear_prediction(model, ["clientID", "year", "month"])
    return parts.withColumn("predictedRevenue", prediction).select(
        "clientID", month_from_parts(F.col("year"), F.col("month")).alias("month"), "predictedRevenue"
    )
