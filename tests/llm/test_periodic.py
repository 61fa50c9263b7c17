import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from texts import LONG, words

from tillcast.llm import periodic, queries
from tillcast.llm import words as W


def brute(seq):
    """(start, length, period) of all runs, by looking at every start and period."""
    found = []
    n = len(seq)
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            if seq[i] != seq[i - q]:
                i += 1
                continue
            j = i
            while j < n and seq[j] == seq[j - q]:
                j += 1
            start, length = i - q, j - i + q
            if length >= max(6, 4 * q) and not any(
                all(seq[x] == seq[x - d] for x in range(start + d, start + length)) for d in range(1, q)
            ):
                found.append((start, length, q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(seq, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(seq) if i not in gone)


def runs_of(*texts):
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    ids = np.array([zlib.crc32(str(w).encode()) for t in texts for w in t], np.uint64)
    return [tuple(r) for r in periodic.runs_of(W.mix(ids), first).tolist()], first


sequences = st.one_of(
    st.lists(st.sampled_from("ab"), max_size=60),
    st.lists(st.sampled_from("abc"), max_size=60),
    st.tuples(
        st.lists(st.sampled_from("abcd"), min_size=1, max_size=9),
        st.integers(1, 12),
        st.lists(st.sampled_from("abcd"), max_size=8),
    ).map(lambda t: t[2] + t[0] * t[1] + t[2][::-1] + t[0] * 3),
)


@settings(max_examples=400, deadline=None)
@given(st.lists(sequences, min_size=1, max_size=4))
def test_runs_are_those_of_brute_force(texts):
    found, first = runs_of(*texts)
    expected = [(s + a, length, q) for a, t in zip(first.tolist(), texts) for s, length, q in brute(t)]
    assert found == expected


def test_powers_of_a_word_have_its_period_only():
    assert runs_of("ab" * 8)[0] == [(0, 16, 2)]
    assert runs_of("aaaaa")[0] == [] and runs_of("aaaaaa")[0] == [(0, 6, 1)]
    assert runs_of("aabaabaabaab")[0] == [(0, 12, 3)]
    # Runs inside the period of another one.
    assert runs_of("aaaaaab" * 4)[0] == [(0, 6, 1), (0, 28, 7), (7, 6, 1), (14, 6, 1), (21, 6, 1)]


def test_texts_do_not_touch():
    assert runs_of("aaa", "aaa", "aaaaaa")[0] == [(6, 6, 1)]


def test_work_does_not_grow_with_the_square_of_a_frequent_word():
    random.seed(1)
    seq = [random.choice("aaaaaaab") for _ in range(300_000)]
    found, _ = runs_of(seq)
    assert len(found) > 1000


def test_report_of_odd_texts(spark, edges):
    found = {(r["doc_id"], r["n_words"]): r for r in periodic.report(edges).collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    for key in [(1, 0), (2, 0), (3, 0)]:
        assert found[key]["n_runs"] == 0 and found[key]["runs_sha256"] == found[key]["collapsed_sha256"] == nothing
        assert found[key]["start"] is found[key]["length"] is found[key]["period"] is found[key]["exponent_milli"] is None
    long = found[(6, 48000)]
    assert (long["start"], long["length"], long["period"], long["exponent_milli"]) == (0, 48000, 6, 8_000_000)
    assert long["collapsed_sha256"] == hashlib.sha256(" ".join(words(LONG)[:6]).encode()).hexdigest()
    assert periodic.report(edges).count() == 10 and any(i is None for i, _ in found)


def test_empty_table(empty):
    assert periodic.report(empty).collect() == [] and periodic.find(empty).collect() == []


def planted(doc_id, text):
    seq = words(text)
    h, n = zlib.crc32(str(doc_id).encode()), len(seq)
    if doc_id is None or h % 10 or not n:
        return seq
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [seq[i if i < a else a + (i - a) % p] for i in range(n)]


@pytest.fixture(scope="module")
def some(make):
    random.seed(5)
    rows = [(i, " ".join(random.choices(["a", "b", "\tc", "dé", "E e"], k=random.randint(0, 120)))) for i in range(400)]
    return make(rows + [(None, "a a a a a a a"), (7, rows[7][1])])


def test_query_is_brute_force(some):
    rows = some.collect()
    found = periodic.report(queries.with_planted_runs(some)).collect()
    expected = []
    for row in rows:
        seq = planted(row["doc_id"], row["text"])
        runs = brute(seq)
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        milli = 1000 * best[1] // best[2] if runs else None
        digests = (hashlib.sha256(t.encode()).hexdigest() for t in (lines, collapsed(seq, runs)))
        expected.append((row["doc_id"], len(seq), len(runs), *best, milli, *digests))
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


def test_real_outputs(some):
    texts = {r["doc_id"]: r["text"] for r in some.collect()}
    for row in periodic.find(some).where("doc_id < 50").collect():
        seq = words(texts[row["doc_id"]])
        assert row["collapsed"] == collapsed(seq, [tuple(r) for r in row["runs"]])
