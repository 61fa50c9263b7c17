import random
from collections import Counter, defaultdict

import pytest
from texts import words

from tillcast.llm import mixing

SCHEMA = "doc_id long, text string, source string, key long, copies int, own string"


def brute_targets(sizes, weights=(1, 2, 3), most=3):
    names = sorted((s for s in sizes if s is not None), key=str.encode) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total = sum(sizes.values())
    capped = set()
    while True:
        spare = total - sum(most * sizes[s] for s in capped)
        share = sum(weight[s] for s in names if s not in capped)
        target = {s: most * sizes[s] if s in capped else spare * weight[s] / share for s in names}
        above = {s for s in names if target[s] > most * sizes[s]}
        if not above:
            return target
        capped |= above


@pytest.fixture(scope="module")
def build(spark):
    return lambda rows: spark.createDataFrame([(i, t, s, 1, 2, "x") for i, t, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def some():
    random.seed(3)
    rows = []
    for i in range(6000):
        source = random.choice(["hot"] * 10 + ["b", "é", "zz", "\U0001f600", "c"])
        rows.append((i, " ".join(["w"] * min(900, int(random.paretovariate(0.8)))), source))
    rows += [(10_000 + i, "two words", None) for i in range(300)]
    rows += [(20_000, "a b c", "tiny"), (20_001, None, "none"), (20_002, " \n", "none"), (None, "x y", "c")]
    return rows


def taken_by_source(rows, found):
    source = {i: s for i, _, s in rows}
    taken, sizes = Counter(), Counter()
    for r in found:
        taken[source[r["doc_id"]]] += r["taken"]
        sizes[source[r["doc_id"]]] += r["size"]
    return taken, sizes


def test_targets_and_taken(build, some):
    found = mixing.mix(build(some)).collect()
    taken, sizes = taken_by_source(some, found)
    expected = brute_targets(dict(sizes))
    source = {i: s for i, _, s in some}
    for r in found:
        own = source[r["doc_id"]]
        assert r["source_size"] == sizes[own]
        assert r["target"] == pytest.approx(expected[own], rel=1e-12)
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
    assert len(found) == len(some)
    assert sum(expected.values()) == pytest.approx(sum(sizes.values()))
    for own, target in expected.items():
        assert target - 5 <= taken[own] <= target  # rows of one word and more are among those that fill it


def test_sizes_are_words(build):
    rows = [(1, "a b c\x0bd", "s"), (2, None, "s"), (3, "", "s"), (4, "x" * 100_000, "s"), (5, "y " * 100_000, "s")]
    found = {r["doc_id"]: r["size"] for r in mixing.mix(build(rows)).collect()}
    assert found == {i: len(words(t)) for i, t, _ in rows}


def test_runs_agree_whatever_the_order(build, some):
    first = sorted(map(tuple, mixing.mix(build(some)).collect()), key=repr)
    turned = build(some[::-1]).repartition(13)
    assert sorted(map(tuple, mixing.mix(turned).collect()), key=repr) == first


def test_smaller_budgets_are_nested(build, some):
    """With more weight for others, what a source gives is part of what it gave, but for the rows that fill the rest."""
    copies = [
        {r["doc_id"]: r["copies"] for r in mixing.mix(build(some), weights=w, fill=1).collect()}
        for w in [(1, 9, 3), (1, 10, 3), (1, 14, 3)]
    ]
    source = {i: s for i, _, s in some}
    for more, less in zip(copies, copies[1:]):
        wrong = Counter(source[i] for i in more if source[i] == "hot" and less[i] > more[i])
        assert sum(wrong.values()) <= 1


def test_many_equal_rows_are_taken_in_part(build):
    """A third of all rows are one row, whose key is one key."""
    rows = [(1, "a b c d", "s")] * 500 + [(i, "a b", "t") for i in range(500)] + [(None, "one", "u")] * 500
    found = mixing.mix(build(rows)).collect()
    by_source = defaultdict(int)
    for r in found:
        by_source[r["source_size"]] += r["taken"]
    assert len(found) == len(rows)
    # 3500 words, weights 1, 2, 3: 583.3, 1166.7, 1750 of which 1500 are there, and the rest goes to the others.
    assert brute_targets({"s": 2000, "t": 1000, "u": 500}) == pytest.approx({"s": 2000 / 3, "t": 4000 / 3, "u": 1500})
    assert by_source == {2000: 664, 1000: 1332, 500: 1500}


def test_mixed_rows(build, some):
    rows = build(some + [(20_000, "a b c", "tiny")])
    expected = Counter()
    for r in mixing.mix(rows).collect():
        expected[r["doc_id"]] += r["copies"]
    got = mixing.mixed(rows)
    assert got.columns == rows.columns
    assert Counter(r["doc_id"] for r in got.collect()) == +expected


def test_no_words_and_no_rows(build):
    found = mixing.mix(build([(1, None, None), (2, "", "a"), (2, "", "a")])).collect()
    assert [(r["size"], r["source_size"], r["target"], r["taken"]) for r in found] == [(0, 0, 0.0, 0)] * 3
    assert mixing.mix(build([])).collect() == [] and mixing.mixed(build([])).collect() == []


def test_edges(edges):
    assert mixing.mix(edges).count() == 10


def test_many_sources_are_numbered(spark):
    rows = spark.range(5000).selectExpr("id AS doc_id", "'a b' AS text", "lpad(id, 5, '0') AS source")
    found = {r["doc_id"]: r["target"] for r in mixing.mix(rows, weights=(1, 2)).collect()}
    assert found == {i: 2 * 2 / 3 * (1 + i % 2) for i in range(5000)}
