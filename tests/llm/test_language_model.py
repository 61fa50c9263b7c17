import math
import zlib
from collections import Counter

import numpy as np
import pytest
from texts import EDGES, lowered, words

from tillcast.llm import elias_fano as E
from tillcast.llm import language_model as M


def brute(rows):
    """(doc_id, held out, tokens, known, N, base, score) by counting in dictionaries."""
    own = [(i, zlib.crc32(str("" if i is None else i).encode()) % 5 == 1, [*words(lowered(t)), "\0"]) for i, t in rows]
    uni, bi, starts = Counter(), Counter(), 0
    for _, held, tokens in own:
        if not held:
            uni.update(tokens)
            bi.update(zip(["\1", *tokens], tokens))
            starts += 1
    total = sum(uni.values())
    norm = total + 0.5 * (len(uni) + 1)
    out = []
    for i, held, tokens in own:
        base = score = 0.0
        for u, w in zip(["\1", *tokens], tokens):
            p = (uni[w] + 0.5) / norm
            c = starts if u == "\1" else uni[u]
            base += math.log10(p)
            score += math.log10((bi[u, w] + M.MU * p) / (c + M.MU))
        out.append((i, held, len(tokens), sum(uni[w] > 0 for w in tokens), total, base, score))
    return sorted(out, key=repr)


def check(docs, rows):
    got = sorted(map(tuple, M.score(docs).collect()), key=lambda r: repr(r[:5]))
    expected = sorted(brute(rows), key=lambda r: repr(r[:5]))
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    for g, e in zip(sorted(got, key=lambda r: (repr(r[:5]), r[5])), sorted(expected, key=lambda r: (repr(r[:5]), r[5]))):
        assert g[5] == pytest.approx(e[5], rel=1e-9)
        assert abs(g[6] - e[6]) <= 5e-4 * e[2]


def test_edges(edges, empty):
    check(edges, EDGES)
    assert M.score(empty).count() == 0


def test_nothing_to_learn_from(make):
    held = [(i, "some words of a text") for i in range(40) if zlib.crc32(str(i).encode()) % 5 == 1]
    check(make(held), held)


@pytest.mark.parametrize("tokens", [3_000_000, 20_000])
def test_whole_table(table, monkeypatch, tokens):
    monkeypatch.setattr(M, "SHARD_TOKENS", tokens)
    docs = table("documents")
    check(docs, [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])


@pytest.mark.parametrize("count, share", [(64, 0.5), (10**9, 0.0), (2, 0.0)])
def test_scores_do_not_depend_on_which_words_are_frequent(make, monkeypatch, count, share):
    """As on a corpus so large that a context seen hundreds of times is rare, and on one where every word is frequent."""
    monkeypatch.setattr(M, "FREQUENT_COUNT", count)
    monkeypatch.setattr(M, "FREQUENT_SHARE", share)
    draw = np.random.default_rng(7)
    rows = [(i, " ".join(f"w{n}" for n in draw.zipf(1.5, 60) % 300)) for i in range(200)]
    check(make(rows), rows)


def test_held_out_texts_are_likelier_than_by_words_alone(table):
    held = M.score(table("documents")).where("held_out").toPandas()
    assert held.score.sum() > held.base_score.sum()


@pytest.mark.parametrize("count, top", [(0, 1), (1, 1), (5, 3), (1000, 10**6), (1000, 2**63), (20000, 30000)])
def test_sequences(count, top):
    draw = np.random.default_rng(count)
    values = np.sort(draw.integers(0, top, count, dtype=np.uint64))
    sequence = E.EliasFano.encode(values)
    assert (sequence.access(np.arange(count)) == values).all()
    asked = np.unique(np.concatenate([values, draw.integers(0, min(2 * top, 2**63), 300, dtype=np.uint64)]))
    held = set(values.tolist())
    for value, place in zip(asked.tolist(), sequence.find(asked).tolist()):
        assert (place >= 0) == (value in held) and (place < 0 or values[place] == value)


def test_trie(tmp_path, monkeypatch):
    monkeypatch.setenv("TMPDIR", str(tmp_path))
    draw = np.random.default_rng(1)
    keys = np.unique(draw.integers(0, 2**64 - 1, 2000, dtype=np.uint64))
    sizes = draw.integers(1, 9, len(keys))
    sizes[5] = 30_000
    children = np.concatenate([np.unique(draw.integers(0, 2**40, 2 * n + 9))[:n] for n in sizes])
    values = draw.uniform(-12, 0, len(children))
    trie = E.Trie(keys, sizes, children, values)
    of_key = np.repeat(keys, sizes)
    assert np.abs(trie.find(of_key, children) - values).max() <= 0.5 / E.STEPS + 1e-9
    assert np.isnan(trie.find(of_key, children + 1)).mean() > 0.99
    assert np.isnan(trie.find(keys + np.uint64(1), np.zeros(len(keys), np.int64))).all()
    trie.close()
