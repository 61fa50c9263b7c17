import re

import pyarrow as pa
from texts import lowered
from hypothesis import given, settings
from hypothesis import strategies as st

from tillcast.llm import words as W


def by_regex(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lowered(text))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=" \n\taAbZé日.\x1f", max_size=30)), max_size=8))
def test_words_are_those_of_the_regular_expression(texts):
    words = W.split(pa.array(texts, pa.string()))
    hashes = W.word_hashes(words)
    seen = {}
    for i, text in enumerate(texts):
        own = range(words.first[i], words.first[i + 1])
        assert [words.data[words.start[j] : words.stop[j]].tobytes().decode() for j in own] == by_regex(text)
        for j in own:
            word = words.data[words.start[j] : words.stop[j]].tobytes()
            assert seen.setdefault(word, hashes[j]) == hashes[j]
    assert len(set(seen.values())) == len(seen)


def test_slices_cover_all_texts_in_order():
    texts = pa.array(["a" * n for n in (5, 0, 2_000_000, 7)] + [None])
    parts = list(W.slices(texts))
    assert [at for at, _ in parts][0] == 0 and sum(len(p) for _, p in parts) == len(texts)
    assert pa.concat_arrays([p for _, p in parts]).equals(texts)
    assert [len(p) for _, p in W.slices(texts, most=1)] == [1] * 5


def test_words_hash_alike_wherever_they_stand():
    text = "x" * 3_000_000
    words = W.split(pa.array([f"a {text} b", f"{text} a"]))
    hashes = W.word_hashes(words)
    assert hashes[0] == hashes[4] and hashes[1] == hashes[3] and len(set(hashes.tolist())) == 3


def test_shingle_sets_of_short_texts():
    sets = list(W.shingle_sets(W.split(pa.array(["", "A b", "a B c", "a b c a b c", None])), 3))
    assert [len(s) for s in sets] == [0, 1, 1, 3, 0]
    assert sets[2][0] in sets[3] and sets[1][0] not in sets[3]
