"""Toxicity by cumulative-link ordinal regression on sparse text features.

``P(grade > k) = sigmoid(w.x - cut_k)`` with the same weights for every cut and ordered cuts; the expected severity is
the sum of these over k. Features are words and word beginnings, chosen by chi-square on the sample.

The labels say toxic or not. Grades follow from them and the text: 0 is not toxic; toxic documents are 1 or, if the
density of features that speak for toxicity lies above the median of the toxic sample, 2.

The model is fitted on at most ``SAMPLE`` labelled documents, those with the smallest hashes of their ids; every document
is scored, whole. Null and empty texts have no features and the severity of the intercept. Without labels of both
classes the severity is 0 and nothing is toxic. Repeated rows score alike; several labels of an id count as its largest.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm import sparse
from tillcast.llm import words as W
from tillcast.session import stage

#: Labelled documents that the model is fitted on, at most, and features that it has, at most.
SAMPLE = 12_000
FEATURES = 4096
#: Log ratio of rates from which a feature speaks for toxicity.
STRONG = 2.0
#: Probability of a grade above 0 from which a document is toxic.
TOXIC = 0.25

OCCURRENCES = sparse.word_features(prefixes=(5, 6, 7, 8))


class Model(NamedTuple):
    features: np.ndarray
    weights: np.ndarray
    cuts: np.ndarray

    def above(self, texts: pa.Array) -> np.ndarray:
        """P(grade > k) for each text (rows) and cut (columns)."""
        if not len(self.features):
            return np.zeros((len(texts), len(self.cuts)))
        rows = sparse.rows_of(texts, OCCURRENCES, self.features)
        return sparse.sigmoid(rows.times(self.weights)[:, None] - self.cuts[None, :])


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, bound: int) -> DataFrame:
    """(doc_id, text, y) of at most ``bound`` labelled ids, by the hash of the id; written once, read often. An id on
    several rows has one, the first text by code points, so that rows are bounded too."""
    chosen = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    chosen = chosen.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(label).cast("int").alias("y"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    sample = rows.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    return stage(sample.select("doc_id", "text", "y"), "sample")


def grades(y: np.ndarray, rows: sparse.Rows, ratios: np.ndarray, length: np.ndarray) -> np.ndarray:
    """0 for other than toxic texts; 1 or 2 by the density of strong features against the toxic median."""
    strong = rows.times((ratios > STRONG).astype(float)) / np.maximum(1, length)
    median = np.median(strong[y == 1]) if (y == 1).any() else 0
    return np.where(y == 1, 1 + (strong > median), 0)


def fit_ordinal(rows: sparse.Rows, grade: np.ndarray, features: int, penalty: float = 1e-4) -> tuple[np.ndarray, ...]:
    """Weights and ordered cuts that maximise the likelihood of the grades."""
    top = int(grade.max())
    reached = (grade[:, None] > np.arange(top)[None, :]).astype(float)

    def cuts_of(at: np.ndarray) -> np.ndarray:
        return at[features] + np.concatenate([[0], np.cumsum(np.exp(at[features + 1 :]))])

    def gradient(at: np.ndarray) -> np.ndarray:
        above = sparse.sigmoid(rows.times(at[:features])[:, None] - cuts_of(at)[None, :])
        edge = np.hstack([np.ones((len(grade), 1)), above, np.zeros((len(grade), 1))])
        slope = np.hstack([np.zeros((len(grade), 1)), above * (1 - above), np.zeros((len(grade), 1))])
        each = np.arange(len(grade))
        likely = np.maximum(edge[each, grade] - edge[each, grade + 1], 1e-12)
        # The likelihood of grade g is above[g - 1] - above[g].
        by_score = (slope[each, grade] - slope[each, grade + 1]) / likely
        by_cut = np.zeros_like(reached)
        inner = grade > 0
        by_cut[each[inner], grade[inner] - 1] -= slope[each[inner], grade[inner]] / likely[inner]
        inner = grade < top
        by_cut[each[inner], grade[inner]] += slope[each[inner], grade[inner] + 1] / likely[inner]
        cut = by_cut.sum(axis=0)
        steps = np.exp(at[features + 1 :])
        later = np.cumsum(cut[::-1])[::-1]
        whole = np.concatenate([rows.back(by_score, features), [cut.sum()], later[1:] * steps])
        decay = np.concatenate([penalty * at[:features], np.zeros(top)])
        return -whole / len(grade) + decay

    start = np.zeros(features + top)
    start[features] = 1.0
    at = sparse.descend(gradient, start)
    return at[:features], cuts_of(at)


def _collect(sample: DataFrame, chosen: np.ndarray) -> tuple[np.ndarray, sparse.Rows, np.ndarray]:
    """Labels, rows of chosen features and lengths of a bounded sample; texts stay in the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = sparse.rows_of(batch.column("text"), OCCURRENCES, chosen)
            bounds = np.searchsorted(rows.row, np.arange(rows.count + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(bounds), pa.array(x)) for x in (rows.feature, rows.value)]
            lengths = pc.fill_null(pc.binary_length(batch.column("text")), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("y"), lengths, *lists], names=["y", "n", "f", "v"])

    got = W.by_batch(sample.select("text", "y"), run, "y int, n long, f array<long>, v array<double>").toArrow()
    sizes = pc.list_value_length(got["f"]).to_numpy()
    rows = sparse.Rows(
        got.num_rows,
        np.repeat(np.arange(got.num_rows), sizes),
        pc.list_flatten(got["f"]).to_numpy(),
        pc.list_flatten(got["v"]).to_numpy(),
    )
    return got["y"].to_numpy(), rows, got["n"].to_numpy()


def train(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE, features: int = FEATURES) -> Model:
    """A model from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic: 0 or 1)."""
    sample = labelled_sample(docs, labels, "toxic", bound)
    chosen, ratios = sparse.select(sample, OCCURRENCES, features)
    if not len(chosen):
        return Model(chosen, np.zeros(0), np.zeros(2))
    y, rows, length = _collect(sample, chosen)
    weights, cuts = fit_ordinal(rows, grades(y, rows, ratios, length), len(chosen))
    return Model(chosen, weights, cuts)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, severity (expected grade), grade (cuts passed with a probability of a half) and toxic, for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            above = model.above(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(above.sum(axis=1)),
                    pa.array((above >= 0.5).sum(axis=1).astype(np.int32)),
                    pa.array(above[:, 0] >= TOXIC),
                ],
                names=["doc_id", "severity", "grade", "toxic"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return W.by_batch(rows, run, "doc_id long, severity double, grade int, toxic boolean")


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not toxic, with the same columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(model.above(batch.column(0))[:, 0] < TOXIC))

    others = [name for name in docs.columns if name != "text"]
    rows = docs.select("text", *others)
    return W.by_batch(rows, run, rows.schema).select(*docs.columns)
