"""Sparse text features, their selection over a labelled sample, and linear models on them."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm import words as W

#: (index of the text, feature) of every occurrence in a slice of texts.
Occurrences = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]


def word_features(prefixes: tuple[int, ...] = (), suffixes: tuple[int, ...] = ()) -> Occurrences:
    """Words (A-Z lowered), and the first or last so many bytes of longer ones, as 64-bit hashes."""

    def run(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        words = W.split(texts)
        doc = np.repeat(np.arange(len(texts)), np.diff(words.first))
        length = words.stop - words.start
        docs, found = [doc], [W.word_hashes(words)]
        for size in prefixes:
            long = length > size
            docs.append(doc[long])
            found.append(W.hash_spans(words.data, words.start[long], words.start[long] + size))
        for size in suffixes:
            long = length > size
            docs.append(doc[long])
            found.append(W.hash_spans(words.data, words.stop[long] - size, words.stop[long]) ^ np.uint64(size))
        return np.concatenate(docs), np.concatenate(found)

    return run


class Rows(NamedTuple):
    """Sparse rows: row, feature (its index) and value of each entry."""

    count: int
    row: np.ndarray
    feature: np.ndarray
    value: np.ndarray

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.feature] * self.value, self.count)

    def back(self, errors: np.ndarray, features: int) -> np.ndarray:
        return np.bincount(self.feature, errors[self.row] * self.value, features)


def rows_of(texts: pa.Array, occurrences: Occurrences, chosen: np.ndarray) -> Rows:
    """The counts of the chosen features (sorted hashes) in each text, as ``log(1 + count)``."""
    rows, features, values = [], [], []
    for at, part in W.slices(texts):
        doc, found = occurrences(part)
        place = np.searchsorted(chosen, found)
        place[place == len(chosen)] = 0
        hit = chosen[place] == found if len(chosen) else np.zeros(len(found), bool)
        pairs, counts = np.unique((doc[hit] + at) * max(1, len(chosen)) + place[hit], return_counts=True)
        rows.append(pairs // max(1, len(chosen)))
        features.append(pairs % max(1, len(chosen)))
        values.append(np.log1p(counts))
    joined = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (rows, features, values)]
    return Rows(len(texts), joined[0].astype(np.int64), joined[1].astype(np.int64), joined[2].astype(float))


def _tally(occurrences: Occurrences):
    """Arrow function: (text, y) to (feature, positive, negative): in how many texts of each class it occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column("y").to_numpy(zero_copy_only=False)
            found, classes = [], []
            for at, part in W.slices(batch.column("text")):
                doc, hashes = occurrences(part)
                order = np.lexsort((hashes, doc))
                doc, hashes = doc[order], hashes[order]
                new = np.ones(len(doc), bool)
                new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
                found.append(hashes[new])
                classes.append(label[doc[new] + at])
            if not found:
                continue
            features, place = np.unique(np.concatenate(found), return_inverse=True)
            label = np.concatenate(classes)
            both = np.bincount(place, minlength=len(features))
            positive = np.bincount(place, label, len(features)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(features.view(np.int64)), pa.array(positive), pa.array(both - positive)],
                names=["feature", "positive", "negative"],
            )

    return run


def select(sample: DataFrame, occurrences: Occurrences, most: int, least_docs: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` features that tell the classes of a sample (text, y: 0 or 1) apart best, by chi-square, as sorted
    hashes, and each one's log ratio of smoothed rates."""
    totals = sample.agg(F.sum("y"), F.count("y")).first()
    positive, total = totals[0] or 0, totals[1] or 0
    if not 0 < positive < total:
        return np.zeros(0, np.uint64), np.zeros(0)
    counts = W.by_batch(sample.select("text", "y"), _tally(occurrences), "feature long, positive long, negative long")
    counts = counts.groupBy("feature").agg(F.sum("positive").alias("a"), F.sum("negative").alias("b"))
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    c, d = float(positive) - a, float(total - positive) - b
    both, none = a + b, c + d
    square = F.when(none > 0, total * (a * d - b * c) ** 2 / (both * none * positive * (total - positive)))
    chosen = counts.where((F.col("a") + F.col("b")) >= least_docs).withColumn("x", square).where("x > 6.6")
    got = chosen.orderBy(F.desc("x"), "feature").limit(most).select("feature", "a", "b").collect()
    features = np.array([r["feature"] for r in got], np.int64).view(np.uint64)
    rates = np.array([(r["a"] + 0.5) / (positive + 1) / ((r["b"] + 0.5) / (total - positive + 1)) for r in got])
    order = np.argsort(features)
    return features[order], np.log(rates)[order] if len(got) else rates


def descend(gradient: Callable[[np.ndarray], np.ndarray], start: np.ndarray, steps: int = 400) -> np.ndarray:
    """Adam with a falling rate."""
    at, first, second = start.astype(float), np.zeros(len(start)), np.zeros(len(start))
    for step in range(1, steps + 1):
        slope = gradient(at)
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        rate = 0.1 * (1 - step / (steps + 1))
        at = at - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    return at


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def logistic(
    rows: Rows, label: np.ndarray, features: int, penalty: float = 1e-3, start: np.ndarray | None = None, steps: int = 400
) -> np.ndarray:
    """Weights and, last, the intercept of a logistic regression; from weights of a like one, fewer steps are enough."""

    def gradient(w: np.ndarray) -> np.ndarray:
        error = (sigmoid(rows.times(w[:-1]) + w[-1]) - label) / max(1, len(label))
        return np.append(rows.back(error, features) + penalty * w[:-1], error.sum())

    return descend(gradient, np.zeros(features + 1) if start is None else start, steps)
