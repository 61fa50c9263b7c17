"""Benchmark decontamination: items found in documents with a bounded number of edits.

Texts are lowered (A-Z) and runs of white space and ASCII punctuation become one space. An item of n bytes may be off by
``n * percent / 100`` edits. It is cut into one piece more than that, so at least one piece occurs unchanged wherever
the item occurs within its budget (pigeonhole). An Aho-Corasick automaton finds all pieces of all items in one pass over
a document; around each hit the item is verified by Myers' bit-parallel edit distance.

Items go out in blocks of bounded bytes, whatever the size of the benchmark: each block is one broadcast and one pass
over the documents, which are neither shuffled nor collected. An item too short for an edit (under 13 bytes at 8 %) is
found anywhere in a document, unchanged and between word boundaries. No item is too short to be looked for.

Null and empty texts, documents or items, match nothing. Repeated documents are reported once each, repeated item ids
with one text once. A null id takes part. Very long documents are scanned whole. Other columns are not read.
"""

from __future__ import annotations

import math
import re
import string
import unicodedata
import uuid
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm import words as W
from tillcast.session import stage

#: Texts up to which the leaking ones are broadcast: digests of 16 bytes, about 60 bytes each.
BROADCAST_ROWS = 500_000
#: Edits per 100 bytes of an item, rounded down.
PERCENT = 8
#: Bytes of items in one broadcast.
BLOCK_BYTES = 4 * 2**20

_TABLE = bytearray(range(256))
for _mark in string.punctuation + string.whitespace:
    _TABLE[ord(_mark)] = 0x20
for _letter in string.ascii_uppercase:
    _TABLE[ord(_letter)] = ord(_letter.lower())
_TABLE = bytes(_TABLE)


def normal(text: str | None) -> str:
    """The normal form, one character a byte."""
    return b" ".join((text or "").encode().translate(_TABLE).split()).decode("latin-1")


class Item(NamedTuple):
    item_id: int | None
    text: str
    budget: int


def cut(text: str, budget: int) -> list[tuple[int, str]]:
    """``budget + 1`` pieces of nearly equal length, with their places."""
    bounds = [len(text) * i // (budget + 1) for i in range(budget + 2)]
    return [(a, text[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def pattern_masks(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = defaultdict(int)
    for i, letter in enumerate(pattern):
        masks[letter] |= 1 << i
    return masks


def least_distance(masks: dict[str, int], length: int, text: str) -> int:
    """The smallest edit distance between a pattern and any part of ``text`` (Myers 1999, one word of ``length`` bits)."""
    ones, top = (1 << length) - 1, 1 << (length - 1)
    plus, minus, score, best = ones, 0, length, length
    get = masks.get
    for letter in text:
        same = get(letter, 0)
        vertical = same | minus
        horizontal = (((same & plus) + plus) ^ plus) | same
        up = minus | (ones & ~(horizontal | plus))
        down = plus & horizontal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
            if score < best:
                best = score
        up = (up << 1) & ones
        down = (down << 1) & ones
        plus = down | (ones & ~(vertical | up))
        minus = up & vertical
    return best


#: Scripts written without spaces, where a word may begin or end between any two letters.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


def _in_word(letter: str) -> bool:
    return (letter.isalnum() or unicodedata.category(letter)[0] == "M") and not _UNSPACED.match(letter)


def _joined(text: str, at: int) -> bool:
    """Whether a word goes on over place ``at`` of a text in normal form."""
    sides = text[max(0, at - 4) : at], text[at : at + 4]
    before, after = (side.encode("latin-1").decode(errors="ignore") for side in sides)
    return bool(before and after) and _in_word(before[-1]) and _in_word(after[0])


class Finder:
    """The automaton of a block of items."""

    def __init__(self, items: list[Item]):
        import ahocorasick

        self.items = items
        places: dict[str, list[tuple[int, int | None]]] = defaultdict(list)
        for index, item in enumerate(items):
            if not item.budget:
                places[item.text].append((index, None))
            else:
                for at, piece in cut(item.text, item.budget):
                    places[piece].append((index, at))
        self.masks: dict[int, dict[str, int]] = {}
        self.automaton = ahocorasick.Automaton()
        for piece, owners in places.items():
            self.automaton.add_word(piece, (len(piece), owners))
        if places:
            self.automaton.make_automaton()

    def find(self, text: str) -> Iterator[tuple[int, int]]:
        """(index of an item, edits) for every item within its budget in a text in normal form."""
        if not len(self.automaton):
            return
        starts: dict[int, set[int]] = defaultdict(set)
        short: set[int] = set()
        for end, (length, owners) in self.automaton.iter(text):
            for index, at in owners:
                if at is not None:
                    starts[index].add(end + 1 - length - at)
                elif index not in short and not _joined(text, end + 1 - length) and not _joined(text, end + 1):
                    short.add(index)
                    yield index, 0
        for index, found in starts.items():
            item = self.items[index]
            size, budget = len(item.text), item.budget
            best, window = size, None
            for start in sorted(found):
                low, high = max(0, start - budget), start + size + budget
                if window and low <= window[1]:
                    window[1] = high
                    continue
                if window:
                    best = min(best, self._distance(index, text[window[0] : window[1]]))
                window = [low, high]
            best = min(best, self._distance(index, text[window[0] : window[1]]))
            if best <= budget:
                yield index, best

    def _distance(self, index: int, text: str) -> int:
        pattern = self.items[index].text
        if pattern in text:
            return 0
        if index not in self.masks:
            self.masks[index] = dict(pattern_masks(pattern))
        return least_distance(self.masks[index], len(pattern), text)


_SCHEMA = "doc_id long, item_id long, edits long, budget long"
#: A worker's automaton, by the block it was made from.
_FINDERS: dict[str, Finder] = {}


def _finder(shared, key: str) -> Finder:
    if key not in _FINDERS:
        _FINDERS.clear()
        _FINDERS[key] = Finder([Item(*x) for x in shared.value])
    return _FINDERS[key]


def _search(shared, key: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = _finder(shared, key)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                for index, edits in finder.find(normal(text.as_py())):
                    rows.append((doc_id, finder.items[index].item_id, edits, finder.items[index].budget))
            columns = list(zip(*rows, strict=True)) or [()] * 4
            arrays = [pa.array(list(column), pa.int64()) for column in columns]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "item_id", "edits", "budget"])

    return run


def _leaking(shared, key: str):
    """Arrow function: (text) to the digests of the texts that hold an item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = _finder(shared, key)
        for batch in batches:
            texts = (text.as_py() for text in batch.column("text"))
            found = [W.digest(text) for text in texts if next(finder.find(normal(text)), None) is not None]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["leaking"])

    return run


def _by_block(rows: DataFrame, benchmark: DataFrame, percent: int, block_bytes: int, search, schema: str):
    """What ``search`` finds in ``rows``, with one pass for each block of items."""
    spark = rows.sparkSession
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("length(text) > 0")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = math.ceil(total / block_bytes) or 1
    out = None
    for block in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).distinct()
        found = sorted({(r["item_id"], normal(r["text"])) for r in mine.collect()}, key=repr)
        known = [(i, text, len(text) * percent // 100) for i, text in found if text]
        part = W.by_batch(rows, search(spark.sparkContext.broadcast(known), uuid.uuid4().hex), schema)
        out = part if out is None else out.unionByName(part)
    return out


def leaks(
    docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """doc_id, item_id, edits and budget for every item of ``benchmark`` (item_id, text) found in a row of ``docs``
    (doc_id, text) within its budget; with the fewest edits found."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return _by_block(rows, benchmark, percent, block_bytes, _search, _SCHEMA)


def without_leaks(
    docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The rows of ``docs`` without those that have an item in their text; the columns stay. Every row is judged by its
    own text, whatever its doc_id: rows go by the digest of their text."""
    rows = docs.select(F.col("text").cast("string"))
    found = _by_block(rows, benchmark, percent, block_bytes, _leaking, "leaking binary")
    found = stage(found.distinct(), "leaks")
    if found.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        found = F.broadcast(found)
    return docs.join(found, W.digest_column(docs["text"]) == found["leaking"], "left_anti")
