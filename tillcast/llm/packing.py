"""Best-fit packing by sums of squares: every document goes where the open sequences stay most evenly spread.

A document's tokens and one end token are cut into pieces of at most ``capacity``; only longer documents are cut. The
piece lengths (no texts, no ids) are then dealt over tasks, evenly and in shares that Spark sizes by bytes, and each
task packs its share: with ``n[g]`` open sequences of residual gap g, a piece goes where the sum of ``n[g]**2`` becomes
smallest, into a gap that holds it or into a new sequence. Longer pieces go first. A task's state is one
counter and one stack per gap, and what it leaves half empty does not grow with its share, so the share of unused places
falls with the size of the data. A share is sorted before it is packed, so a task that runs again gives the same
sequences.

A null text is an empty one and has the end token alone. Repeated rows are packed once each. Very long documents become
pieces like any other. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm import words as W

CAPACITY = 4096
END_ID = 1
#: Words whose ids a worker remembers; then it starts anew.
REMEMBERED = 200_000
#: Runs of these after a word's letters are a token run of their own, whatever the letters are.
_MARKS = ".,;:!?&$%*#|"

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _byte_letters() -> dict[int, str]:
    """Byte-level letters: printable Latin-1 stands for itself, the other bytes follow from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (b for b in range(256) if b not in plain)
    return {b: chr(256 + i) for i, b in enumerate(others)}


class WordTokenizer(dict):
    """Ids of words as little-endian bytes, for a lower-casing byte-level tokenizer that divides at white space.

    The ids of a text are those of its words one after the other, and words come again and again, so they are looked up
    here. A new word of Latin-1 letters goes straight to the tokenizer's model, as its normaliser only lowers such a
    word; marks after it are looked up on their own; any other word takes the tokenizer's whole way.
    """

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.byte_letters = _byte_letters()
        for sample in ("straßenbahnübergang", "Élan,", "over%%%", "a b\nc"):
            if b"".join(self.ids([sample])) != self._whole(sample):
                raise ValueError("the tokenizer does not work word by word")

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        letters = word.rstrip(_MARKS)
        # Lowered too they must be letters: a mark left by lowering would join the marks after it.
        if len(letters) < len(word) and letters.isalpha() and letters.lower().isalpha():
            found = self[letters] + self[word[len(letters) :]]
        elif word.isascii() and word.isalpha():
            found = b"".join([token.id.to_bytes(4, "little") for token in self.model.tokenize(word.lower())])
        elif word.isalpha() and max(word) <= "ÿ":
            spelled = word.lower().encode().decode("latin-1").translate(self.byte_letters)
            found = b"".join([token.id.to_bytes(4, "little") for token in self.model.tokenize(spelled)])
        else:
            found = self._whole(word)
        self[word] = found
        return found

    def ids(self, texts: list[str]) -> Iterator[bytes]:
        if len(self) > REMEMBERED:
            self.clear()
        for text in texts:
            yield b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


_TOKENIZERS: dict[str, WordTokenizer] = {}


def _pieces(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _TOKENIZERS:
            _TOKENIZERS[path] = WordTokenizer(path)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            rows = []
            for at, part in W.slices(batch.column("text")):
                texts = [text or "" for text in part.to_pylist()]
                ids = batch.column("doc_id").slice(at, len(part)).to_pylist()
                for doc_id, tokens in zip(ids, _TOKENIZERS[path].ids(texts), strict=True):
                    tokens += end
                    for piece, start in enumerate(range(0, len(tokens), 4 * capacity)):
                        own = tokens[start : start + 4 * capacity]
                        rows.append((doc_id, piece, start // 4, len(own) // 4, zlib.crc32(own)))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            arrays = [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """A vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every piece of every document (doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return W.by_batch(rows, _pieces(tokenizer_path, capacity), _PIECES)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For lengths in packing order: the sequence and the offset of each.

    Placing a piece of length l into a gap g changes the sum of squares by ``1 - 2 n[g]`` and, if something of the gap
    remains, by ``2 n[g - l] + 1``; a new sequence adds ``2 n[capacity - l] + 1``. Ties go to the smallest gap, a new
    sequence last.
    """
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    counts = np.zeros(capacity + 1, np.int64)  # open sequences by gap
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    used = 0
    for at, length in enumerate(lengths.tolist()):
        gaps = counts[length:capacity]
        change = 2 * (counts[: capacity - length] - gaps) + 2
        if length < capacity:
            change[0] = 1 - 2 * gaps[0]  # a perfect fit leaves no gap
            change[gaps == 0] = np.iinfo(np.int64).max
            best = int(change.argmin())
            new = 2 * counts[capacity - length] + 1
        if length < capacity and gaps[best] and change[best] <= new:
            gap = best + length
            own = stacks[gap].pop()
            counts[gap] -= 1
        else:
            gap, own, used = capacity, used, used + 1
        sequence[at], offset[at] = own, capacity - gap
        if gap > length:
            counts[gap - length] += 1
            stacks[gap - length].append(own)
    return sequence, offset


def _pack(capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share_of_rows = list(batches)
        if not share_of_rows:
            return
        table = pa.Table.from_batches(share_of_rows)
        order = [("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")]
        table = table.sort_by(order)
        sequence, offset = sum_of_squares(table["length"].to_numpy(), capacity)
        share = TaskContext.get().partitionId()
        table = table.append_column("sequence_id", pa.array(sequence + (share << 40)))
        yield from table.append_column("offset", pa.array(offset)).to_batches()

    return run


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of all documents with ``sequence_id`` and ``offset``: as few sequences of at most ``capacity`` tokens
    as the method finds, each filled without gaps from 0."""
    dealt = pieces(docs, tokenizer_path, capacity).hint("rebalance")
    return W.by_batch(dealt, _pack(capacity), f"{_PIECES}, sequence_id long, offset long")
