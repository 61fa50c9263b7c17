import random
from collections import defaultdict

import pytest
from texts import EDGES, lowered, words

from tillcast.llm import graph, near_dup


def brute(rows, size, percent=80):
    sets = []
    for _, text in rows:
        own = words(lowered(text))
        many = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)}
        sets.append(many if len(own) >= size else {tuple(own)} if own else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = defaultdict(list)
    for i, own in enumerate(sets):
        shared = defaultdict(int)
        for shingle in own:
            for j in holders[shingle]:
                shared[j] += 1
            holders[shingle].append(i)
        for j, n in shared.items():
            if 100 * n >= percent * (len(own) + len(sets[j]) - n):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        component = least.get(root(i))
        out.append((doc_id, len(sets[i]), component, doc_id == component))
    return sorted(out, key=repr)


def found(docs, size, percent=80):
    return sorted(map(tuple, near_dup.near_duplicates(docs, size, percent).collect()), key=repr)


@pytest.mark.parametrize("size", [2, 5])
def test_edges(edges, empty, size):
    assert found(edges, size) == brute(EDGES, size)
    assert found(empty, size) == []


def families(seed=7):
    """Copies with a few changed words in groups large and small, one passage in many texts, short texts."""
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = draw.choices(vocabulary, k=40)
    rows = []
    for group in (150, 30, 5, 2, 2):
        text = draw.choices(vocabulary, k=draw.randrange(40, 120))
        for _ in range(group):
            own = list(text)
            for _ in range(draw.randrange(6)):
                own[draw.randrange(len(own))] = draw.choice(vocabulary)
            rows.append(" ".join(own))
    for _ in range(150):
        rows.append(" ".join(passage + draw.choices(vocabulary, k=draw.randrange(0, 30))))
    rows += [" ".join(draw.choices(vocabulary[:6], k=draw.randrange(1, 6))) for _ in range(150)]
    rows += rows[:40]
    draw.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("size, short", [(2, 2), (5, 8)])
def test_families_against_brute_force(make, monkeypatch, size, short):
    monkeypatch.setattr(near_dup, "SHORT_LIST", short)
    monkeypatch.setattr(near_dup, "HOT_LIST", 4 * short)
    rows = families()
    assert found(make(rows), size) == brute(rows, size)


def copies(count, words_each, edits, seed, with_base):
    """Copies of one text, each with some of its words replaced."""
    draw = random.Random(seed)
    text = [f"w{draw.randrange(5000)}" for _ in range(words_each)]
    rows = []
    for _ in range(count):
        own = list(text)
        for _ in range(draw.choice(edits)):
            own[draw.randrange(len(own))] = f"v{draw.randrange(3000)}"
        rows.append(" ".join(own))
    rows.insert(count * 2 // 3, " ".join(text) if with_base else "something else")
    return list(enumerate(rows))


@pytest.mark.parametrize("edits", [(2, 3, 4, 5), (0, 1, 2, 4, 8, 12)])
def test_pairs_do_not_grow_with_the_square_of_a_family(make, monkeypatch, edits):
    """Copies edited in different places are near their text and not each other; the text is somewhere among them."""
    compared = []
    real = near_dup._confirmed

    def confirmed(pairs, sets, percent):
        compared.append(pairs.count())
        return real(pairs, sets, percent)

    monkeypatch.setattr(near_dup, "_confirmed", confirmed)
    rows = copies(1000, 150, edits, 5, True)
    assert found(make(rows), 5) == brute(rows, 5)
    assert sum(compared) < 20 * len(rows)


def test_copies_of_an_absent_text(make):
    rows = copies(200, 150, (2, 3, 4, 5), 5, False)
    assert found(make(rows), 5) == brute(rows, 5)


def test_whole_table(table):
    docs = table("documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert found(docs, 2) == brute(rows, 2)


def test_keep_first(make):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(3, text), (1, text.upper()), (1, text.upper()), (2, text + " more"), (9, "else"), (None, "other text"), (7, None)]
    docs = make(rows)
    kept = near_dup.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted([1, 9, None, 7], key=repr)


def test_keep_first_goes_by_rows(make):
    def text(name):
        return " ".join(f"{name}{i}" for i in range(60))

    rows = [(None, text("a")), (None, text("a") + " more"), (None, text("a")), (None, text("b")), (4, text("b") + " more")]
    rows += [(5, text("c")), (5, text("c") + " more"), (5, text("d")), (3, text("d") + " more"), (5, text("e"))]
    rows += [(None, text("f")), (None, text("f")), (6, text("f")), (6, text("f")), (None, None), (None, None), (None, "")]
    kept = sorted(((r["doc_id"], r["text"]) for r in near_dup.keep_first(make(rows)).collect()), key=repr)
    one_of = {(None, text("a")), (None, text("a") + " more")}, {(5, text("c")), (5, text("c") + " more")}
    for group in one_of:
        assert sum(row in group for row in kept) == 1
    rest = [row for row in kept if not any(row in group for group in one_of)]
    expected = [(4, text("b") + " more"), (3, text("d") + " more"), (5, text("e")), (6, text("f"))]
    assert rest == sorted([*expected, (None, None), (None, None), (None, "")], key=repr)


def test_components(spark):
    draw = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 90)] + [(200, i) for i in range(201, 260)] + [(300, 301), (301, 300), (5, 5)]
    edges += [(draw.randrange(400, 500), draw.randrange(400, 500)) for _ in range(60)]
    got = dict(graph.components(spark.createDataFrame(edges, "u long, v long")).collect())
    parent = {}

    def root(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i

    for u, v in edges:
        if u != v:
            a, b = sorted((root(u), root(v)))
            parent[b] = a
    assert got == {i: root(i) for i in parent}
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0
