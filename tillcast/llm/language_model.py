"""Language-model scores from an Elias-Fano n-gram trie, sharded over the corpus.

Bigram model over all words of the training documents, with one end token a document:

    P(w | u) = (c(uw) + MU P(w)) / (c(u) + MU),   P(w) = (c(w) + 0.5) / (N + 0.5 (V + 1))

which sums to one after every u. The formula is the same for all words and at every size of the corpus.

One pass counts the words. A second deals every token with its context to a shard: by the word, or if the word is
frequent, by word and context, so no word makes a large shard. A word is frequent if it makes up 2**-20 of the corpus
(and occurs 64 times); at most 2**20 are, whatever the corpus, so every task knows their counts. Which words are
frequent decides where a token is counted, not its score. Tokens travel as packed arrays, each distinct pair of a
run of documents once with the list of its documents. A shard has all tokens of its pairs: it counts those of training
documents, builds a trie of them (word, then contexts as 40-bit keys, with quantised smoothed log probabilities) in a
memory-mapped temporary file, looks up every pair of every document in it, and sums per document. Pairs not in the trie
back off to P(w). The sum of logarithms is split so that each part is known where it is taken: log(c(u) + MU) of a
rare u is taken where u itself is counted. All sums then meet per run of documents.

Null and empty texts have the end token alone. A null doc_id counts as an empty text in the choice of held-out
documents. Repeated rows are scored and, in training, counted each. Without training documents P(w) alone decides.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm import words as W
from tillcast.llm.elias_fano import Trie
from tillcast.session import stage

#: Of 5 to 3000, close to the best on held-out texts of a hundredth and of a tenth of the test scale.
MU = 200.0
FREQUENT_SHARE, FREQUENT_COUNT = 2.0**-20, 64
#: Bytes of text and documents of a run, tokens of a shard, and tokens of it that are worked on together.
RUN_BYTES, RUN_DOCS = 8 * 2**20, 30_000
#: Bytes of an Arrow batch, which a run is made from: the larger, the fewer pairs travel twice.
BATCH_BYTES = 6 * 2**20
SHARD_TOKENS = 2_000_000
RANGE_TOKENS = 300_000

END = np.uint64(0x00E4D00000000001)
START = np.uint64(0x0057A67000000001)
_FREQUENT_BIT = np.uint64(1 << 39)


def held_out(ids: list[int | None]) -> np.ndarray:
    return np.array([zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1 for i in ids], bool)


class Counts(NamedTuple):
    tokens: int  # N
    types: int  # V
    documents: int  # training documents, which is how often the start is a context
    frequent: np.ndarray  # sorted hashes, start and end among them
    often: np.ndarray  # their counts

    @property
    def norm(self) -> float:
        return self.tokens + 0.5 * (self.types + 1)


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n): words of training documents, once a run."""
    for batch in batches:
        training = pa.array(~held_out(batch.column("doc_id").to_pylist()))
        for _, part in W.slices(batch.column("text").filter(training), RUN_BYTES):
            words, counts = np.unique(W.word_hashes(W.split(part)), return_counts=True)
            words, counts = np.append(words, END), np.append(counts, len(part))
            yield pa.RecordBatch.from_arrays(
                [pa.array(words.view(np.int64)), pa.array(counts.astype(np.int64))], names=["word", "n"]
            )


def count_words(docs: DataFrame) -> Counts:
    """Counts over all training documents (doc_id, text)."""
    words = W.by_batch(docs, _tally, "word long, n long", BATCH_BYTES).groupBy("word").agg(F.sum("n").alias("n"))
    words = stage(words.where("n > 0"), "words")
    total = words.agg(F.sum("n").alias("tokens"), F.count("*").alias("types")).first()
    tokens, end = total["tokens"] or 0, int(END.view(np.int64))
    least = max(FREQUENT_COUNT, tokens * FREQUENT_SHARE)
    often = words.where((F.col("n") >= least) & (F.col("word") != end)).toArrow()
    documents = (words.where(F.col("word") == end).first() or {"n": 0})["n"]
    hashes = np.append(often["word"].to_numpy().view(np.uint64), [START, END])
    counts = np.append(often["n"].to_numpy(), [documents, documents])
    order = np.argsort(hashes)
    return Counts(tokens, total["types"], documents, hashes[order], counts[order].astype(np.int64))


def _place(frequent: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    place = np.minimum(np.searchsorted(frequent, hashes), len(frequent) - 1)
    return place, frequent[place] == hashes


_DEALT = (
    "shard int, run long, words binary, pairs binary, contexts binary, sizes binary, docs binary, "
    "ids array<long>, lengths binary, held binary"
)
_PARTS = "run long, docs binary, base binary, score binary, known binary, ids array<long>, lengths binary, held binary"


def _five(codes: np.ndarray) -> bytes:
    """40-bit numbers, five bytes each."""
    return np.ascontiguousarray(codes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _wide(data: np.ndarray) -> np.ndarray:
    out = np.zeros((len(data) // 5, 8), np.uint8)
    out[:, :5] = data.reshape(-1, 5)
    return out.view("<u8")[:, 0]


def _deal(counts: Counts, shards: int):
    """Arrow function: (doc_id, text) to the tokens of each shard, and a row with a run's documents."""

    def rows(run: int, part: pa.Array, ids: list[int | None]) -> Iterator[dict]:
        words = W.split(part)
        hashes = W.word_hashes(words)
        each = np.diff(words.first) + 1
        stop = np.cumsum(each)
        target, context = np.empty((2, stop[-1]), np.uint64)
        word = np.ones(stop[-1], bool)
        word[stop - 1] = False
        target[word], target[~word] = hashes, END
        word[:] = True
        word[stop - each] = False
        context[word], context[~word] = hashes, START
        held = held_out(ids)
        doc = np.repeat(np.arange(len(part), dtype=np.uint16), each) | np.repeat((~held).astype(np.uint16) << 15, each)
        _, common = _place(counts.frequent, target)
        place, known = _place(counts.frequent, context)
        code = np.where(known, place.astype(np.uint64) | _FREQUENT_BIT, context >> np.uint64(25))
        shard = W.mix(np.where(common, target ^ (code * np.uint64(0x9E3779B97F4A7C15)), target)) % np.uint64(shards)
        order = np.lexsort((code, target, shard))
        target, code, shard, doc = target[order], code[order], shard[order].astype(np.int64), doc[order]
        new_word = np.ones(len(target), bool)
        new_word[1:] = (target[1:] != target[:-1]) | (shard[1:] != shard[:-1])
        new_pair = new_word.copy()
        new_pair[1:] |= code[1:] != code[:-1]
        pair, first = np.flatnonzero(new_pair), np.flatnonzero(new_word)
        sizes = np.diff(np.append(pair, len(target))).astype("<u4")
        pairs = np.diff(np.append(np.searchsorted(pair, first), len(pair))).astype("<u4")
        bounds = np.searchsorted(shard, np.arange(shards + 1))
        for s in np.unique(shard).tolist():
            a, b = bounds[s], bounds[s + 1]
            w = slice(np.searchsorted(first, a), np.searchsorted(first, b))
            p = slice(np.searchsorted(pair, a), np.searchsorted(pair, b))
            yield {
                "shard": s, "run": run, "words": target[first[w]].astype("<u8").tobytes(), "pairs": pairs[w].tobytes(),
                "contexts": _five(code[pair[p]]), "sizes": sizes[p].tobytes(), "docs": doc[a:b].astype("<u2").tobytes(),
            }
        yield {"shard": run % shards, "run": run, "ids": ids, "lengths": each.astype("<i8").tobytes(),
               "held": held.tobytes()}

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        run = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for at, part in W.slices(batch.column("text"), RUN_BYTES, RUN_DOCS):
                found = list(rows(run, part, ids[at : at + len(part)]))
                yield pa.RecordBatch.from_pylist(found, _arrow(_DEALT))
                run += 1

    return go


def _arrow(schema: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split(" ") for x in schema.split(", "))])


def _sum_shard(counts: Counts):
    """Arrow function of a shard's rows: per run, the sums of its documents' tokens in this shard."""

    def go(table: pa.Table) -> pa.Table:
        about = table.filter(pc.is_valid(table["ids"])).select(["run", "ids", "lengths", "held"])
        rows = [Dealt.read(r) for batch in table.to_batches() for r in range_rows(batch)]
        out = [{"run": r["run"], "ids": r["ids"], "lengths": r["lengths"], "held": r["held"]} for r in about.to_pylist()]
        out += _sums(sorted(rows, key=lambda r: r.run), counts)
        return pa.Table.from_pylist(out, _arrow(_PARTS))

    def range_rows(batch: pa.RecordBatch) -> Iterator[dict]:
        for i in range(len(batch)):
            if not batch.column("ids")[i].is_valid:
                yield {name: batch.column(name)[i] for name in ("run", "words", "pairs", "contexts", "sizes", "docs")}

    return go


class Dealt(NamedTuple):
    """The tokens of a run in a shard, views of the bytes they came in: distinct words, how many pairs each has, the
    contexts of the pairs, how many tokens each pair has, and the tokens' documents; and where each part starts."""

    run: int
    words: np.ndarray
    pairs: np.ndarray
    contexts: np.ndarray
    sizes: np.ndarray
    docs: np.ndarray
    first_pair: np.ndarray
    first_token: np.ndarray

    @classmethod
    def read(cls, row: dict) -> Dealt:
        words, pairs, contexts, sizes, docs = (
            np.frombuffer(row[name].as_buffer(), kind)
            for name, kind in (("words", "<u8"), ("pairs", "<u4"), ("contexts", "u1"), ("sizes", "<u4"), ("docs", "<u2"))
        )
        starts = (np.concatenate([[0], np.cumsum(x, dtype=np.int64)]) for x in (pairs, sizes))
        return cls(row["run"].as_py(), words, pairs, contexts, sizes, docs, *starts)

    def part(self, low: int, high: int) -> Dealt:
        """The words with hashes from low to below high."""
        a, b = (len(self.words) if x >= 2**64 else int(np.searchsorted(self.words, np.uint64(x))) for x in (low, high))
        p, q = self.first_pair[a], self.first_pair[b]
        t, u = self.first_token[p], self.first_token[q]
        own = (self.words[a:b], self.pairs[a:b], self.contexts[5 * p : 5 * q], self.sizes[p:q], self.docs[t:u])
        return Dealt(self.run, *own, self.first_pair[:0], self.first_token[:0])


def _sums(rows: list[Dealt], counts: Counts) -> list[dict]:
    """Sums per document of each run; the words of the shard are worked on in ranges of hashes, one after the other."""
    if not rows:
        return []
    width = [int((r.docs & 0x7FFF).max()) + 1 for r in rows]
    totals = [np.zeros((3, n)) for n in width]
    ranges = 1 + sum(len(r.docs) for r in rows) // RANGE_TOKENS
    bounds = [2**64 * i // ranges for i in range(ranges + 1)]
    for low, high in zip(bounds[:-1], bounds[1:], strict=True):
        parts = [r.part(low, high) for r in rows]
        if any(len(part.docs) for part in parts):
            _add_range(parts, totals, counts)
    out = []
    for row, (base, score, known) in zip(rows, totals, strict=True):
        docs = np.unique(row.docs & 0x7FFF)
        out.append({
            "run": row.run, "docs": docs.astype("<u2").tobytes(), "base": base[docs].astype("<f8").tobytes(),
            "score": score[docs].astype("<f4").tobytes(), "known": known[docs].astype("<i4").tobytes(),
        })
    return out


def _add_range(rows: list[Dealt], totals: list[np.ndarray], counts: Counts) -> None:
    """Count, build the trie, look up, and add to the totals of each run's documents."""
    word = np.repeat(np.concatenate([r.words for r in rows]), np.concatenate([r.pairs for r in rows]))
    code = np.concatenate([_wide(r.contexts) for r in rows])
    size = np.concatenate([r.sizes for r in rows]).astype(np.int64)
    trained = np.add.reduceat(np.concatenate([r.docs >> 15 for r in rows]), np.cumsum(size) - size, dtype=np.int64)

    order = np.lexsort((code, word))
    word, code, trained = word[order], code[order], trained[order]
    new_word, new_pair = np.ones((2, len(word)), bool)
    new_word[1:] = word[1:] != word[:-1]
    new_pair[1:] = new_word[1:] | (code[1:] != code[:-1])
    first, pair = np.flatnonzero(new_word), np.flatnonzero(new_pair)
    count = np.add.reduceat(trained, pair)  # c(uw) of each distinct pair
    words, contexts = word[pair], code[pair]
    of_word = np.cumsum(new_word[pair]) - 1
    alone = np.add.reduceat(trained, first)  # c(w) of words that are in this shard only
    place, frequent = _place(counts.frequent, word[first])
    single = np.where(frequent, counts.often[place], alone)
    share = (single + 0.5) / counts.norm

    known = (contexts & _FREQUENT_BIT) != 0
    at = np.where(known, contexts & ~_FREQUENT_BIT, 0).astype(np.int64)
    context = np.where(known, counts.often[at], 0)  # c(u) of frequent contexts
    prior = MU * share[of_word]
    whole = np.where(known, context + MU, 1.0)
    value = np.log10(prior / whole)
    stored = np.flatnonzero(count > 0)
    if len(stored):
        _, per_key = np.unique(of_word[stored], return_counts=True)
        keys = words[stored][np.cumsum(per_key) - per_key]
        trie = Trie(keys, per_key, contexts[stored], np.log10((count[stored] + prior[stored]) / whole[stored]))
        try:
            found = trie.find(words, contexts)
        finally:
            trie.close()
        value = np.where(np.isnan(found), value, found)
    # As a context, a rare word takes log(c + MU) here, where it is counted.
    value = value - np.where(frequent, 0.0, np.log10(single + MU))[of_word]

    back = np.empty(len(order), np.int64)
    back[order] = np.cumsum(new_pair) - 1  # the distinct pair of each run's pair
    base, hit = np.log10(single + 0.5), single > 0
    at = 0
    for row, total in zip(rows, totals, strict=True):
        token = np.repeat(back[at : at + len(row.sizes)], row.sizes)
        at += len(row.sizes)
        own = of_word[token]
        for line, added in zip(total, (base[own], value[token], hit[own]), strict=True):
            line += np.bincount(row.docs & 0x7FFF, added, total.shape[1])


_SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def _gather(counts: Counts):
    """Arrow function of a run's rows: the scores of its documents."""

    def go(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        about = next(r for r in rows if r["ids"] is not None)
        length = np.frombuffer(about["lengths"], "<i8")
        base, score, known = np.zeros((3, len(length)))
        # In one order whatever comes first, so a task that runs again sums alike.
        for row in sorted((r for r in rows if r["ids"] is None), key=lambda r: (r["docs"], r["base"])):
            docs = np.frombuffer(row["docs"], "<u2")
            base[docs] += np.frombuffer(row["base"], "<f8")
            score[docs] += np.frombuffer(row["score"], "<f4")
            known[docs] += np.frombuffer(row["known"], "<i4")
        arrays = [
            pa.array(about["ids"], pa.int64()),
            pa.array(np.frombuffer(about["held"], bool)),
            pa.array(length),
            pa.array(known.astype(np.int64)),
            pa.array(np.full(len(length), counts.tokens)),
            pa.array(base - length * np.log10(counts.norm)),
            pa.array(score),
        ]
        return pa.Table.from_arrays(arrays, names=[x.split(" ")[0] for x in _SCORES.split(", ")])

    return go


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score (words alone) and score (the model's log10
    probability) for every row of ``docs`` (doc_id, text); documents that are not held out are learnt from."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    counts = count_words(rows)
    shards = 1 + counts.tokens // SHARD_TOKENS
    dealt = W.by_batch(rows, _deal(counts, shards), _DEALT, BATCH_BYTES)
    parts = dealt.groupBy("shard").applyInArrow(_sum_shard(counts), _PARTS)
    return parts.groupBy("run").applyInArrow(_gather(counts), _SCORES)
