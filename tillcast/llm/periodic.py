"""Periodic runs of words, by an online sparse DP over the diagonals of equal words.

A cell (i, q) of the table says that word i equals word i - q; cells that follow each other on the diagonal of lag q make
a stretch of period q. A text is read word by word: the earlier occurrences of a word move the diagonals of their lags
on by one, a diagonal that no occurrence moves on ends there, and its stretch is a run if it is long enough.

Of all earlier occurrences only a few can belong to a run, and only their cells are made. In a run of smallest period q
and at least 4 q words, a window of q to 2 q words comes again after q words and not before, since its first q words are
not a power of anything shorter. So for each power of two w only the nearest earlier occurrence of the window of the last
w words counts, and only if its lag is over w / 2 and at most w; every run has such a cell for each of its words from the
first repeated window on, so its diagonal runs through without a gap. A word has at most one cell a power of two, there
are at most that many open diagonals, and windows that occur once are not looked at again in the next power. That bounds
the work to n log n for any text, however often a word occurs.

Words are compared by 64-bit hashes. A null text has no words. Repeated rows are judged alike, each on its own; a null id
is handed on. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm import words as W

#: A run has at least this many words, and at least so many times its period.
LEAST = 6
POWER = 4

_FOUND = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def _cells(hashes: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """For each window size: the places and the lags of the cells that can belong to runs. ``first[d]:first[d + 1]`` are
    the words of text d."""
    lengths = np.diff(first)
    text = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(hashes)) - first[text]
    longest = (lengths // POWER)[text]  # the largest period a run of this text may have
    ends = W.mix(hashes + text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    at = np.flatnonzero(longest >= 1)
    width = 1
    while len(at):
        order = np.argsort(ends[at], kind="stable")
        at = at[order]
        same = ends[at[1:]] == ends[at[:-1]]
        lag = at[1:] - at[:-1]
        near = same & (2 * lag > width) & (lag <= np.minimum(width, longest[at[1:]]))
        yield at[1:][near], lag[near], width

        again = np.zeros(len(hashes), bool)  # ends of windows that occur more than once
        again[at[1:][same]] = True
        again[at[:-1][same]] = True
        at = np.flatnonzero(again & (place >= 2 * width - 1) & (longest > width))
        at = at[again[at - width]]
        longer = ends.copy()
        longer[at] = W.mix(ends[at - width] * np.uint64(0xFF51AFD7ED558CCD) + ends[at])
        ends, width = longer, 2 * width


def _diagonals(cells: Iterable[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
    """(start, length, period) of every run, from cells (place, lag, window) in order of places."""

    def ended(diagonals: dict[int, int], end: int) -> Iterator[tuple[int, int, int]]:
        for lag, start in diagonals.items():
            if end - start >= max(LEAST, POWER * lag):
                yield start, end - start, lag

    before: dict[int, int] = {}  # diagonals of the word before that nothing has moved on yet: lag, start of the stretch
    now: dict[int, int] = {}
    at = -1
    for place, lag, width in cells:
        if place != at:
            yield from ended(before, at)
            if place > at + 1:
                yield from ended(now, at + 1)
                now = {}
            before, now, at = now, {}, place
        now[lag] = before.pop(lag, place - width + 1 - lag)
    yield from ended(before, at)
    yield from ended(now, at + 1)


def runs_of(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) of the runs of all texts, by start, then period; starts count from the first text on."""
    found = [(p, q, np.full(len(p), w)) for p, q, w in _cells(hashes, first)]
    if not found:
        return np.zeros((0, 3), np.int64)
    place, lag, width = map(np.concatenate, zip(*found, strict=True))
    order = np.argsort(place, kind="stable")
    cells = zip(place[order].tolist(), lag[order].tolist(), width[order].tolist(), strict=True)
    runs = np.array(list(_diagonals(cells)), np.int64).reshape(-1, 3)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _kept(words: W.Words, runs: np.ndarray) -> np.ndarray:
    """Whether each word stays: those in a run after its first period go."""
    change = np.zeros(len(words.start) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:-1]) == 0


def _joined(words: W.Words, kept: np.ndarray) -> pa.Array:
    """The kept words of each text with one space between them."""
    count = np.concatenate([[0], np.cumsum(kept)])
    own = np.searchsorted(words.first, np.arange(len(kept)), "right") - 1
    opens = count[:-1] == count[words.first[own]]  # no kept word of the text before this one
    change = np.zeros(len(words.data) + 1, np.int64)  # +1 where bytes begin to be taken, -1 where they end
    np.add.at(change, words.start[kept] - ~opens[kept], 1)  # with the space before the word
    np.add.at(change, words.stop[kept], -1)
    taken = np.cumsum(change[:-1]) > 0
    data = np.where(W.is_space(words.data), np.uint8(0x20), words.data)[taken]
    upto = np.concatenate([[0], np.cumsum(taken)])[words.offsets]
    buffers = [None, pa.py_buffer(upto.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.string(), len(upto) - 1, buffers)


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, part in W.slices(batch.column("text")):
            words = W.split(part, lower=False)
            runs = runs_of(W.word_hashes(words), words.first)
            text = np.searchsorted(words.first, runs[:, 0], "right") - 1
            bounds = np.searchsorted(text, np.arange(len(part) + 1)).astype(np.int32)
            columns = runs[:, 0] - words.first[text], runs[:, 1], runs[:, 2]
            structs = pa.StructArray.from_arrays([pa.array(c) for c in columns], names=["start", "length", "period"])
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id").slice(at, len(part)),
                    "n_words": pa.array(np.diff(words.first)),
                    "runs": pa.ListArray.from_arrays(pa.array(bounds), structs),
                    "collapsed": _joined(words, _kept(words, runs)),
                }
            )


def find(docs: DataFrame) -> DataFrame:
    """For every row of ``docs`` (doc_id, text): doc_id, n_words, runs (start, length, period; by start, then period) and
    collapsed, the words without what a run repeats, joined by one space."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return W.by_batch(rows, _find, _FOUND)


def report(docs: DataFrame) -> DataFrame:
    """For every row of ``docs`` (doc_id, text): doc_id, n_words, n_runs, the longest run (of equal ones the first, then
    the one of the smallest period; nulls without a run), and digests of all runs and of the collapsed text."""
    found = find(docs)
    by_length = F.transform(
        "runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select("doc_id", "n_words", "collapsed", "runs", F.array_max(by_length).alias("best")).select(
        "doc_id",
        "n_words",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("best.length * 1000 div -best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
