"""Words of whole texts as numpy arrays, straight from the bytes of an Arrow column.

A word is a run of bytes other than space and tab to carriage return, which is the same as ``[^\\x20\\x09-\\x0D]+`` on
UTF-8 text. Nothing here is per word in Python: an Arrow batch is cut into slices of bounded size, and a slice's words
are positions in its bytes. Null texts count as empty ones.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text that are worked on together; a longer text makes a slice of its own.
SLICE_BYTES = 2**19
_SEGMENT = 2**20
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse among 64-bit numbers

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


#: Bytes of an Arrow batch where the session sets no bound: rows are texts, and some are very long.
BATCH_BYTES = 2 * 2**20
_BOUND = "spark.sql.execution.arrow.maxBytesPerBatch"


def by_batch(df: DataFrame, function: Callable, schema, size: int = BATCH_BYTES) -> DataFrame:
    """``df.mapInArrow`` with batches of bounded bytes, so that memory does not grow with the length of texts.

    A worker serves many tasks; what Arrow has kept for one of them goes back when it ends.
    """
    spark = df.sparkSession
    if spark.conf.get(_BOUND, None) is None:
        spark.conf.set(_BOUND, str(size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def digest(text: str | None) -> bytes | None:
    """The first 16 bytes of a text's SHA-256, which tell rows apart by what they hold; null for null."""
    return None if text is None else hashlib.sha256(text.encode()).digest()[:16]


def digest_column(text: Column) -> Column:
    """``digest`` as built-in functions."""
    return F.unhex(F.substring(F.sha2(text.cast("string").cast("binary"), 256), 1, 32))


class Words(NamedTuple):
    """Words of a slice of texts: bytes, where each word starts and stops in them, and the words of text i as
    ``first[i]:first[i + 1]``; ``offsets`` are the texts' own bounds in the bytes."""

    data: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    first: np.ndarray
    offsets: np.ndarray


def slices(texts: pa.Array, size: int = SLICE_BYTES, most: int = 2**31) -> Iterator[tuple[int, pa.Array]]:
    """Runs of at most ``most`` texts of bounded bytes, with the index of their first text."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        done = sizes[at - 1] if at else 0
        stop = max(at + 1, min(at + most, int(np.searchsorted(sizes, done + size, "right"))))
        yield at, texts.slice(at, stop - at)
        at = stop


def is_space(data: np.ndarray) -> np.ndarray:
    """Which bytes divide words."""
    return _SPACE[data]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, and each text's bounds in them."""
    texts = pa.concat_arrays([pc.fill_null(texts, "").cast(pa.large_string())])
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def split(texts: pa.Array, lower: bool = True) -> Words:
    data, offsets = text_bytes(texts)
    data = _LOWER[data] if lower else data
    word = np.zeros(len(data) + 2, bool)
    word[1:-1] = ~_SPACE[data]
    starts = word[1:-1] & ~word[:-2]
    stops = word[1:-1] & ~word[2:]
    inner = offsets[1:-1]  # a text's end also ends its last word
    inner = inner[(inner > 0) & (inner < len(data))]
    starts[inner] = word[1:-1][inner]
    stops[inner - 1] = word[1:-1][inner - 1]
    start = np.flatnonzero(starts)
    return Words(data, start, np.flatnonzero(stops) + 1, np.searchsorted(start, offsets), offsets)


def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 2**64)
    power, back = (np.full(count, b, np.uint64) for b in (_BASE, inverse))
    power[0] = back[0] = 1
    return np.cumprod(power, dtype=np.uint64), np.cumprod(back, dtype=np.uint64)


_TABLE: list = []


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers over all 64 bits, one to one."""
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def hash_spans(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes; starts ascend."""
    out = np.zeros(len(start), np.uint64)
    at = 0
    while at < len(start):
        base = start[at]
        to = max(at + 1, int(np.searchsorted(start, base + _SEGMENT)))
        end = int(stop[at:to].max())
        if not _TABLE or len(_TABLE[0]) < end - base + 1:
            _TABLE[:] = _powers(max(_SEGMENT + 4096, int(end - base) + 1))
        power, back = _TABLE
        sums = np.zeros(end - base + 1, np.uint64)
        np.cumsum((data[base:end].astype(np.uint64) + np.uint64(1)) * power[: end - base], out=sums[1:])
        a, b = start[at:to] - base, stop[at:to] - base
        out[at:to] = (sums[b] - sums[a]) * back[a] + (b - a).astype(np.uint64)
        at = to
    if len(_TABLE) and len(_TABLE[0]) > 16 * _SEGMENT:
        _TABLE.clear()
    return mix(out)


def word_hashes(words: Words) -> np.ndarray:
    return hash_spans(words.data, words.start, words.stop)


def shingle_sets(words: Words, size: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of ``size`` words; fewer words make one run, none makes an
    empty set."""
    hashes = word_hashes(words)
    count = max(0, len(hashes) - size + 1)
    runs = np.zeros(count, np.uint64)
    for place in range(size):
        runs = mix(runs + hashes[place : place + count] * np.uint64(2 * place + 1))
    for first, last in zip(words.first[:-1], words.first[1:], strict=True):
        if last - first >= size:
            yield np.unique(runs[first : last - size + 1])
        elif last > first:
            whole = np.uint64(last - first) + np.zeros(1, np.uint64)
            for value in hashes[first:last]:
                whole = mix(whole * np.uint64(31) + value)
            yield whole
        else:
            yield np.zeros(0, np.uint64)
