import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from texts import EDGES

from tillcast.llm import packing


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


def expected(rows, plain, capacity):
    out = []
    for doc_id, text in rows:
        ids = plain(text)
        for piece, start in enumerate(range(0, len(ids), capacity)):
            own = ids[start : start + capacity]
            out.append((doc_id, piece, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
    return sorted(out, key=repr)


def check_places(rows, capacity):
    """Gapless sequences within the capacity; returns how many there are."""
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


@pytest.mark.parametrize("capacity", [16, 4096])
def test_edges(edges, plain, capacity):
    got = packing.pack(edges, packing.tokenizer_path(), capacity).collect()
    fields = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted((tuple(r[f] for f in fields) for r in got), key=repr) == expected(EDGES, plain, capacity)
    check_places(got, capacity)


def test_whole_table_is_packed_closely(table, plain):
    docs = table("documents")
    got = packing.pack(docs, packing.tokenizer_path()).collect()
    fields = ("doc_id", "piece", "start", "length", "ids_crc32")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert sorted((tuple(r[f] for f in fields) for r in got), key=repr) == expected(rows, plain, 4096)
    least = -(-sum(r["length"] for r in got) // 4096)
    assert check_places(got, 4096) <= least * 1.02 + 1


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("aAzÉßİıſK\u0301\u0307\u0345ΣςǅŉΐΑ日9 .,;%!-\n", max_size=12), min_size=1, max_size=8))
def test_ids_are_the_tokenizers(plain, words):
    text = " ".join([*words, "ALİ, VELİ. geldi İ, x\u0307."])
    ids = packing.WordTokenizer(packing.tokenizer_path()).ids([text])
    assert np.frombuffer(b"".join(ids), "<u4").tolist() == plain(text)[:-1]


def test_empty_table(empty):
    assert packing.pack(empty, packing.tokenizer_path()).collect() == []


def test_sum_of_squares_takes_the_best_place():
    lengths = np.array([7, 7, 5, 3, 3, 2, 10, 1])
    sequence, offset = packing.sum_of_squares(lengths, 10)
    counts, gaps, used = [0] * 11, {}, 0
    for i, length in enumerate(lengths.tolist()):
        def squares(gap):
            after = list(counts)
            if gap < 10:
                after[gap] -= 1
            if gap > length:
                after[gap - length] += 1
            return sum(n * n for n in after[1:10])

        choices = [g for g in range(length, 10) if counts[g]] + [10]
        best = min(choices, key=lambda g: (squares(g), g))
        assert 10 - best == offset[i]
        if best < 10:
            counts[best] -= 1
        if best > length:
            counts[best - length] += 1
        used += best == 10
    assert sequence.max() + 1 == used
