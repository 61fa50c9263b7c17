"""Elias-Fano sequences and an n-gram trie of them, in a memory-mapped file."""

from __future__ import annotations

import os
import tempfile
from typing import NamedTuple

import numpy as np

_ONE = np.uint64(1)
_BYTE_ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)
#: For a byte and k, the place of its k-th set bit.
_BYTE_SELECT = np.array(
    [[*(p for p in range(8) if b >> p & 1), *[0] * (8 - bin(b).count("1"))] for b in range(256)], np.uint8
)


def _ones(words: np.ndarray) -> np.ndarray:
    return _BYTE_ONES[words.view(np.uint8).reshape(-1, 8)].sum(axis=1, dtype=np.int64)


def _select_in_word(words: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The place of the rank-th set bit (from 0) of each word."""
    octets = np.ascontiguousarray(words).view(np.uint8).reshape(-1, 8)
    sums = np.cumsum(_BYTE_ONES[octets], axis=1, dtype=np.uint8)
    byte = (sums <= rank[:, None]).sum(axis=1)
    before = np.where(byte > 0, np.take_along_axis(sums, np.maximum(byte - 1, 0)[:, None], 1)[:, 0], 0).astype(np.int64)
    each = np.arange(len(words))
    return byte * 8 + _BYTE_SELECT[octets[each, np.minimum(byte, 7)], np.minimum(rank - before, 7)]


class EliasFano(NamedTuple):
    """A non-decreasing sequence of 64-bit numbers: packed low bits, high bits as gaps, and ranks of the high words."""

    count: int
    low_bits: int
    low: np.ndarray
    high: np.ndarray
    ones: np.ndarray  # set bits before each word of high

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        count = len(values)
        top = int(values[-1]) if count else 0
        low_bits = max(0, (top // max(1, count)).bit_length() - 1)
        shift = np.uint64(low_bits)
        low = np.zeros(count * low_bits // 64 + 2, np.uint64)
        if low_bits:
            rest = values & ((_ONE << shift) - _ONE)
            place = np.arange(count, dtype=np.int64) * low_bits
            word, bit = place >> 6, (place & 63).astype(np.uint64)
            np.bitwise_or.at(low, word, rest << bit)
            over = bit + shift > np.uint64(64)
            np.bitwise_or.at(low, word[over] + 1, rest[over] >> (np.uint64(64) - bit[over]))
        parts = (values >> shift).astype(np.int64) + np.arange(count)
        high = np.zeros(((top >> low_bits) + count) // 64 + 2, np.uint64)
        np.bitwise_or.at(high, parts >> 6, _ONE << (parts & 63).astype(np.uint64))
        ones = np.concatenate([[0], np.cumsum(_ones(high))]).astype(np.uint64)
        return cls(count, low_bits, low, high, ones)

    def lows(self, index: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(index), np.uint64)
        place = index * self.low_bits
        word, bit = place >> 6, (place & 63).astype(np.uint64)
        value = self.low[word] >> bit
        over = bit > 0
        value[over] |= self.low[word[over] + 1] << (np.uint64(64) - bit[over])
        return value & ((_ONE << np.uint64(self.low_bits)) - _ONE)

    def access(self, index: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.ones, index.astype(np.uint64), "right") - 1
        place = word * 64 + _select_in_word(self.high[word], index - self.ones[word].astype(np.int64))
        return ((place - index).astype(np.uint64) << np.uint64(self.low_bits)) | self.lows(index)

    def _ends(self, part: np.ndarray) -> np.ndarray:
        """How many values have a high part of at most this: ones before the (part + 1)-th zero."""
        zeros = np.arange(len(self.ones), dtype=np.int64) * 64 - self.ones.astype(np.int64)
        word = np.minimum(np.searchsorted(zeros, part, "right") - 1, len(self.high) - 1)
        place = word * 64 + _select_in_word(~self.high[word], part - zeros[word])
        return place - part

    def find(self, values: np.ndarray, first: np.ndarray | None = None, stop: np.ndarray | None = None) -> np.ndarray:
        """The index of each value, or -1; with bounds, searched only between them (successor search)."""
        found = np.full(len(values), -1, np.int64)
        if not self.count:
            return found
        part = (values >> np.uint64(self.low_bits)).astype(np.int64)
        largest = int(self.access(np.array([self.count - 1]))[0]) >> self.low_bits
        ask = np.flatnonzero(part <= largest)
        part, low = part[ask], values[ask] & ((_ONE << np.uint64(self.low_bits)) - _ONE)
        right = self._ends(part)
        left = np.where(part > 0, self._ends(np.maximum(part - 1, 0)), 0)
        if first is not None:
            left, right = np.maximum(left, first[ask]), np.minimum(right, stop[ask])
        end = right.copy()
        while (open_ := np.flatnonzero(left < right)).size:
            middle = (left[open_] + right[open_]) >> 1
            less = self.lows(middle) < low[open_]
            left[open_] = np.where(less, middle + 1, left[open_])
            right[open_] = np.where(less, right[open_], middle)
        there = np.flatnonzero(left < end)
        there = there[self.lows(left[there]) == low[there]]
        found[ask[there]] = left[there]
        return found

    @property
    def arrays(self) -> tuple[np.ndarray, ...]:
        return self.low, self.high, self.ones


#: Bits of a child's key; a node's children are keys after ``node << CHILD_BITS``, so one sequence holds them all.
CHILD_BITS = 40
#: Steps per unit of quantised base-10 logarithms, and the least value.
STEPS, LEAST = 2048, -24.0
#: Lookups made together.
BLOCK = 2**16


def quantise(logs: np.ndarray) -> np.ndarray:
    return np.clip(np.round((logs - LEAST) * STEPS), 0, 2**16 - 1).astype(np.uint16)


def restore(codes: np.ndarray) -> np.ndarray:
    return codes / STEPS + LEAST


class Trie:
    """Two levels: keys, and under each key its children with a quantised value.

    Levels lie in one temporary file that is mapped to memory and goes with ``close``; what a level needs besides are a
    few numbers. A lookup finds the key, takes the bounds of its children from two monotone pointers, and searches the
    child between them.
    """

    def __init__(self, keys: np.ndarray, sizes: np.ndarray, children: np.ndarray, values: np.ndarray):
        """Sorted keys (64 bits), the number of children of each, children (below 2**40, sorted within a key)."""
        pointers = np.concatenate([[0], np.cumsum(sizes)])
        node = np.repeat(np.arange(len(keys), dtype=np.uint64), sizes)
        levels = [
            EliasFano.encode(keys),
            EliasFano.encode(pointers),
            EliasFano.encode((node << np.uint64(CHILD_BITS)) | children.astype(np.uint64)),
        ]
        handle, self.path = tempfile.mkstemp(prefix="trie-")
        with os.fdopen(handle, "wb") as out:
            for level in levels:
                for array in level.arrays:
                    out.write(array.tobytes())
            out.write(quantise(values).tobytes() + b"\0" * 8)
        whole = np.memmap(self.path, np.uint8, "r")
        at = 0

        def mapped(like: np.ndarray) -> np.ndarray:
            nonlocal at
            part = whole[at : at + like.nbytes].view(np.uint64)
            at += like.nbytes
            return part

        self.keys, self.pointers, self.children = (
            EliasFano(level.count, level.low_bits, *(mapped(array) for array in level.arrays)) for level in levels
        )
        self.codes = whole[at : at + 2 * len(values)].view(np.uint16)
        self.bytes = len(whole)

    def find(self, keys: np.ndarray, children: np.ndarray) -> np.ndarray:
        """The value of each (key, child), or nan where there is none; so many at a time that little memory is used."""
        parts = [self._find(keys[at : at + BLOCK], children[at : at + BLOCK]) for at in range(0, len(keys), BLOCK)]
        return np.concatenate([np.zeros(0), *parts])

    def _find(self, keys: np.ndarray, children: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), np.nan)
        node = self.keys.find(keys)
        hit = np.flatnonzero(node >= 0)
        first, stop = (self.pointers.access(node[hit] + more).astype(np.int64) for more in (0, 1))
        asked = (node[hit].astype(np.uint64) << np.uint64(CHILD_BITS)) | children[hit].astype(np.uint64)
        place = self.children.find(asked, first, stop)
        out[hit[place >= 0]] = restore(self.codes[place[place >= 0]])
        return out

    def close(self) -> None:
        os.unlink(self.path)
