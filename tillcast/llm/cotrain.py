"""Quality by co-training of two views.

The text view sees words and word endings. The metadata view sees what is known about a document without reading it:
source, language, size, and its layout (lines, their length and repetition, shares of letters, digits and marks), each
as a bin. Each view starts from the labelled sample; in every round each scores every unlabelled document and labels for
the other those that it is most sure of, in the classes' proportion. Both views are calibrated on labelled documents that
took no part (Platt), where a logistic regression of their log odds also says how to combine them. All documents are
scored.

The features of all unlabelled documents are a stored table. A round is two passes over it: one counts documents by how
sure a view is, which gives the bound from which it hands on; the other brings the documents to fit on. What earlier
rounds handed on follows again from their weights and bounds, so there is no table of labels to keep. A fit sees at most
``SAMPLE`` documents of ``labels`` and about as many, drawn by hash, of those that the other view has labelled.

Identical rows without a label are one in the exchange. Null and empty texts are scored by their bins and the intercepts.
Null sources and languages are bins of their own. Without labels of both classes every score is 0.5 and every document is
kept. Repeated rows score alike. Tables without ``source`` or ``lang`` are taken as if these were null; other columns are
not read.
"""

from __future__ import annotations

import hashlib
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

#: Documents of ``labels``, and about as many that the other view labelled, for a fit; features of the text view at most.
SAMPLE = 8_000
FEATURES = 4096
ROUNDS = 3
#: Steps of a first fit; later ones start from its weights and take a quarter.
STEPS = 400
#: Probability from which a view hands on a pseudo-label, and the share of the unlabelled it hands on a round at most.
SURE = 0.95
SHARE = 0.1
#: Sureness is counted in so many bins a unit of log odds, up to so many units.
BINS, UNITS = 64, 40
#: Score from which a document is kept.
KEPT = 0.35
METADATA = 2**12

OCCURRENCES = sparse.word_features(suffixes=(3,))
TEXT = ("text", "source", "lang")


def _bin(name: str, value) -> int:
    return int.from_bytes(hashlib.blake2b(f"{name}={value}".encode(), digest_size=8).digest(), "little") % METADATA


_BINS: dict = {}


def metadata_rows(batch: pa.RecordBatch) -> sparse.Rows:
    """The bins of each row of (text, source, lang)."""
    texts = batch.column("text")
    columns: list[list] = []
    for name in ("source", "lang"):
        columns.append([(name, value) for value in batch.column(name).to_pylist()])
    measures: dict[str, list] = {}
    for _, part in W.slices(texts):
        data, offsets = W.text_bytes(part)
        kinds = {
            "size": None,
            "lines": data == 0x0A,
            "spaces": data == 0x20,
            "digits": (data >= 0x30) & (data <= 0x39),
            "capitals": (data >= 0x41) & (data <= 0x5A),
            "marks": ((data > 0x20) & (data < 0x30)) | ((data > 0x39) & (data < 0x41)) | ((data > 0x5A) & (data < 0x61))
            | ((data > 0x7A) & (data < 0x7F)),
        }
        size = np.diff(offsets)
        for name, hit in kinds.items():
            if hit is None:
                bins = np.log2(size + 1).astype(int)
            else:
                sums = np.concatenate([[0], np.cumsum(hit)])
                count = sums[offsets[1:]] - sums[offsets[:-1]]
                bins = np.round(4 * np.log2(1 + 1000 * count / np.maximum(1, size))).astype(int)
            measures.setdefault(name, []).append(bins)
        repeated = [
            round(10 * (1 - len(set(lines)) / len(lines))) for t in part.to_pylist() for lines in [(t or "").split("\n")]
        ]
        measures.setdefault("repeated lines", []).append(np.array(repeated))
    for name, parts in measures.items():
        columns.append([(name, value) for value in np.concatenate(parts).tolist()])
    features = np.empty((len(texts), len(columns)), np.int64)
    for place, column in enumerate(columns):
        for row, key in enumerate(column):
            if key not in _BINS:
                if len(_BINS) > 100_000:
                    _BINS.clear()
                _BINS[key] = _bin(*key)
            features[row, place] = _BINS[key]
    row = np.repeat(np.arange(len(texts)), len(columns))
    return sparse.Rows(len(texts), row, features.ravel(), np.ones(features.size))


class Model(NamedTuple):
    features: np.ndarray
    text: np.ndarray
    metadata: np.ndarray
    calibration: np.ndarray  # slope and intercept of the text view, of the metadata view, and weights of both and 1

    def odds(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """Calibrated log odds of both views."""
        text = sparse.rows_of(batch.column("text"), OCCURRENCES, self.features)
        return self._calibrated(text, metadata_rows(batch))

    def _calibrated(self, text: sparse.Rows, metadata: sparse.Rows) -> tuple[np.ndarray, np.ndarray]:
        a, b, c, d = self.calibration[:4]
        first = text.times(self.text[:-1]) + self.text[-1]
        second = metadata.times(self.metadata[:-1]) + self.metadata[-1]
        return a * first + b, c * second + d

    def score(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        u, v, w = self.calibration[4:]
        return sparse.sigmoid(u * first + v * second + w)


def _platt(odds: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Slope and intercept, or a weight of each column and an intercept."""
    odds = odds.reshape(len(label), -1)
    each = np.repeat(np.arange(len(label)), odds.shape[1])
    rows = sparse.Rows(len(label), each, np.tile(np.arange(odds.shape[1]), len(label)), odds.ravel())
    return sparse.logistic(rows, label, odds.shape[1])


class Exchange(NamedTuple):
    """What both views handed on in a round: their weights, and for each view and class the bin of sureness that is
    handed on in part, and that part; surer bins are handed on whole."""

    weights: tuple[np.ndarray, np.ndarray]
    least: dict[tuple[int, int], tuple[int, float]]


class Features(NamedTuple):
    """A batch of the pool: hash of each row, and its features in both views."""

    hashes: np.ndarray
    views: tuple[sparse.Rows, sparse.Rows]

    @classmethod
    def read(cls, batch: pa.RecordBatch | pa.Table) -> Features:
        def rows(feature: str, value: str | None) -> sparse.Rows:
            sizes = pc.list_value_length(batch[feature]).to_numpy(zero_copy_only=False)
            flat = pc.list_flatten(batch[feature]).to_numpy(zero_copy_only=False).astype(np.int64)
            ones = np.ones(len(flat))
            values = ones if value is None else pc.list_flatten(batch[value]).to_numpy(zero_copy_only=False).astype(float)
            return sparse.Rows(batch.num_rows, np.repeat(np.arange(batch.num_rows), sizes), flat, values)

        return cls(batch["h"].to_numpy(zero_copy_only=False).view(np.uint64), (rows("f", "v"), rows("g", None)))

    def odds(self, weights: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
        return [rows.times(w[:-1]) + w[-1] for rows, w in zip(self.views, weights, strict=True)]

    def part(self, salt: int) -> np.ndarray:
        """A number from 0 to below 1 for each row, by its hash."""
        return (W.mix(self.hashes ^ np.uint64(salt)) >> np.uint64(11)).astype(float) / 2**53

    def given(self, exchanges: list[Exchange]) -> np.ndarray:
        """The label that each view (row 0, row 1) was given in these rounds, or -1."""
        given = np.full((2, len(self.hashes)), -1)
        for turn, exchange in enumerate(exchanges):
            part = self.part(turn)
            for view, odds in enumerate(self.odds(exchange.weights)):
                other = given[1 - view]
                free = other < 0
                for value in (0, 1):
                    bins, sure = sureness(odds, value)
                    least, share = exchange.least[view, value]
                    other[free & sure & ((bins > least) | ((bins == least) & (part < share)))] = value
        return given


def sureness(odds: np.ndarray, value: int) -> tuple[np.ndarray, np.ndarray]:
    """How sure log odds are of a class, as a bin, and whether they are sure enough to be handed on."""
    own = odds if value else -odds
    return np.floor(BINS * np.clip(own, 0, UNITS)).astype(np.int64), sparse.sigmoid(own) >= SURE


def bound_of(counts: dict[int, int], most: int) -> tuple[int, float, int]:
    """The bin from which ``most`` documents are handed on, surest first, the part of it that is, and how many in all."""
    taken = 0
    for place in sorted(counts, reverse=True):
        if taken + counts[place] >= most:
            return place, (most - taken) / counts[place], most
        taken += counts[place]
    return -1, 0.0, taken


def _features(docs: DataFrame, chosen: np.ndarray, *others: str) -> DataFrame:
    """``others`` and the features of both views: f and v of the text, g of the metadata."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = []
            for rows in (sparse.rows_of(batch.column("text"), OCCURRENCES, chosen), metadata_rows(batch)):
                bounds = pa.array(np.searchsorted(rows.row, np.arange(rows.count + 1)).astype(np.int32))
                flat = (pa.array(rows.feature.astype(np.int32)), pa.array(rows.value.astype(np.float32)))
                lists += [pa.ListArray.from_arrays(bounds, x) for x in flat]
            columns = [*(batch.column(name) for name in others), *lists[:3]]
            yield pa.RecordBatch.from_arrays(columns, names=[*others, "f", "v", "g"])

    kept = ", ".join(f"{name} {docs.schema[name].dataType.simpleString()}" for name in others)
    return W.by_batch(docs.select(*others, *TEXT), run, f"{kept}, f array<int>, v array<float>, g array<int>")


def _pool(docs: DataFrame, labels: DataFrame, chosen: np.ndarray) -> DataFrame:
    """(h, f, v, g): every document without a label, identical rows once."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").select(F.col("doc_id").cast("long")).distinct()
    # Hashes of 64 bits tell rows apart; the last column tells null texts from empty ones and the like.
    nulls = F.concat_ws("", *[F.col(c).isNull().cast("string") for c in ("doc_id", *TEXT)])
    rows = _view(docs).withColumn("h", F.xxhash64("doc_id", *TEXT, nulls))
    # Only ids and hashes meet the labels; features are shuffled once, by h, for both the grouping and the join.
    free = rows.select("doc_id", "h").join(known, "doc_id", "left_anti").select("h").distinct()
    return stage(_features(rows, chosen, "h").dropDuplicates(["h"]).join(free, "h", "left_semi"), "pool")


def _counts(pool: DataFrame, done: list[Exchange], weights: tuple[np.ndarray, np.ndarray]) -> dict:
    """How many documents, not yet labelled for the other view, lie in each bin of sureness: by (view, class), by bin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 2, BINS * UNITS + 1), np.int64)
        for batch in batches:
            rows = Features.read(batch)
            given = rows.given(done)
            for view, odds in enumerate(rows.odds(weights)):
                for value in (0, 1):
                    bins, sure = sureness(odds, value)
                    free = sure & (given[1 - view] < 0)
                    total[view, value] += np.bincount(bins[free], minlength=total.shape[2])
        found = np.nonzero(total)
        columns = [pa.array(x.astype(np.int32)) for x in found]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(total[found])], names=["view", "value", "bin", "n"])

    counts = W.by_batch(pool.select("h", "f", "v", "g"), run, "view int, value int, bin int, n long").groupBy("view", "value", "bin")
    out: dict = {(view, value): {} for view in (0, 1) for value in (0, 1)}
    for row in counts.agg(F.sum("n").alias("n")).collect():  # at most 4 * BINS * UNITS rows
        out[row["view"], row["value"]][row["bin"]] = row["n"]
    return out


def _drawn(pool: DataFrame, done: list[Exchange], rates: list[float], bound: int) -> list[tuple[sparse.Rows, np.ndarray]]:
    """For each view the documents that the other has labelled, drawn by hash at its rate, and their labels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = Features.read(batch)
            part = rows.part(len(done) << 8 | 0xFF)
            labels = [np.where(part < rate, given, -1) for rate, given in zip(rates, rows.given(done), strict=True)]
            hit = pa.array((labels[0] >= 0) | (labels[1] >= 0))
            columns = [*batch.columns, *(pa.array(x.astype(np.int32)) for x in labels)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "y0", "y1"]).filter(hit)

    schema = "h long, f array<int>, v array<float>, g array<int>, y0 int, y1 int"
    got = W.by_batch(pool.select("h", "f", "v", "g"), run, schema).toArrow().sort_by("h")
    out = []
    for view in (0, 1):
        own = got.filter(pc.greater_equal(got[f"y{view}"], 0)).slice(0, bound)
        out.append((Features.read(own).views[view], own[f"y{view}"].to_numpy()))
    return out


def _fit(parts: list[tuple[sparse.Rows, np.ndarray]], features: int, start: np.ndarray | None) -> np.ndarray:
    """A logistic regression on all parts, from the weights of the round before."""
    starts = np.cumsum([0, *(rows.count for rows, _ in parts)])
    joined = [np.concatenate([rows.row + at for (rows, _), at in zip(parts, starts, strict=False)])]
    joined += [np.concatenate([getattr(rows, name) for rows, _ in parts]) for name in ("feature", "value")]
    label = np.concatenate([y for _, y in parts]).astype(float)
    steps = STEPS if start is None else STEPS // 4
    return sparse.logistic(sparse.Rows(int(starts[-1]), *joined), label, features, start=start, steps=steps)


def co_train(
    known: pa.Table, pool: DataFrame, features: int, bound: int, rounds: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[Exchange]]:
    """Weights of both views, the calibration, and what was handed on, from the features of labelled documents (h, y)
    and of the pool."""
    label = known["y"].to_numpy()
    apart = np.arange(len(label)) % 5 == 0  # for calibration
    used = Features.read(known.filter(pa.array(~apart)))
    aside = Features.read(known.filter(pa.array(apart)))
    sizes, rate, total = (features, METADATA), label.mean(), pool.count()
    own = [[(rows, label[~apart])] for rows in used.views]
    done: list[Exchange] = []
    number = [0, 0]  # labelled for each view so far
    weights: tuple = (None, None)
    while True:
        weights = tuple(_fit(*view) for view in zip(own, sizes, weights, strict=True))
        if len(done) == rounds or not total:
            break
        least = {}
        for (view, value), counts in _counts(pool, done, weights).items():
            most = int(np.ceil(SHARE * (rate if value else 1 - rate) * total))
            *least[view, value], handed = bound_of(counts, most)
            number[1 - view] += handed
        done.append(Exchange(weights, least))
        drawn = _drawn(pool, done, [min(1.0, bound / max(1, n)) for n in number], bound)
        own = [[parts[0], more] for parts, more in zip(own, drawn, strict=True)]
    truth = label[apart].astype(float)
    odds = aside.odds(weights)
    first, second = (_platt(o, truth) for o in odds)
    both = np.stack([first[0] * odds[0] + first[1], second[0] * odds[1] + second[1]], axis=1)
    return weights[0], weights[1], np.concatenate([first, second, _platt(both, truth)]), done


def _view(docs: DataFrame) -> DataFrame:
    named = [F.col(c).cast("string").alias(c) if c in docs.columns else F.lit(None).cast("string").alias(c)
             for c in ("source", "lang")]
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *named)


def _sample(docs: DataFrame, labels: DataFrame, bound: int) -> DataFrame:
    """(h, y, text, source, lang): at most ``bound`` labelled documents, in the order of h."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("y"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    # An id on several rows has one, so that rows are bounded too.
    rows = _view(docs).join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "y").agg(F.min(F.struct(*TEXT)).alias("r"))
    return stage(rows.select(F.xxhash64("doc_id").alias("h"), "y", "r.*"), "sample")


def train(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE, rounds: int = ROUNDS) -> Model:
    """A model from ``docs`` (doc_id, text, source, lang) and ``labels`` (doc_id, quality: 0 or 1)."""
    sample = _sample(docs, labels, bound)
    chosen, _ = sparse.select(sample, OCCURRENCES, FEATURES)
    if not len(chosen):
        return Model(chosen, np.zeros(1), np.zeros(METADATA + 1), np.zeros(7))
    known = _features(sample, chosen, "h", "y").toArrow().sort_by("h")
    return Model(chosen, *co_train(known, _pool(docs, labels, chosen), len(chosen), bound, rounds)[:3])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, text_score, metadata_score, quality (the combined probability) and kept, for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, second = model.odds(batch)
            both = model.score(first, second)
            columns = [pa.array(x) for x in (sparse.sigmoid(first), sparse.sigmoid(second), both, both >= KEPT)]
            names = ["doc_id", "text_score", "metadata_score", "quality", "kept"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=names)

    schema = "doc_id long, text_score double, metadata_score double, quality double, kept boolean"
    return W.by_batch(_view(docs), run, schema)
