import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillcast.llm import decontaminate as D

ITEM = "What is the boiling point of water at the summit of a very high mountain, in degrees?"


def by_table(pattern, text):
    """Least edit distance of a pattern to any part of a text, by the plain table."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


@settings(max_examples=200, deadline=None)
@given(st.text("abc", min_size=1, max_size=12), st.text("abc", max_size=25))
def test_bit_parallel_distance(pattern, text):
    assert D.least_distance(D.pattern_masks(pattern), len(pattern), text) == by_table(pattern, text)


@settings(max_examples=60, deadline=None)
@given(st.text("ab ", min_size=8, max_size=20), st.integers(0, 3), st.integers(0, 10**6))
def test_edited_items_are_found(text, edits, seed):
    text = D.normal(text + "xyz")
    draw = random.Random(seed)
    changed = list(text)
    for _ in range(edits):
        at = draw.randrange(len(changed) + 1)
        changed[at : at + draw.randrange(2)] = draw.choice(["", "q", "b"])
    whole = "".join(draw.choice("ab ") for _ in range(30)) + "".join(changed) + "ba ab"
    finder = D.Finder([D.Item(1, text, 3)])
    assert dict(finder.find(whole)).get(0) == (d if (d := by_table(text, whole)) <= 3 else None)


def test_edges(spark, make, edges):
    bench = spark.createDataFrame(
        [(1, ITEM), (1, ITEM), (2, None), (3, ""), (4, "word"), (None, "lorem ipsum dolor sit amet consectetur lorem")],
        "item_id long, text string",
    )
    near = ITEM.lower().replace("summit", "sumit").replace(" ", "\n")
    docs = edges.unionByName(make([(20, f"Well. {near} Yes."), (21, ITEM[: len(ITEM) // 2]), (22, f"x{ITEM}y")]))
    got = sorted(map(tuple, D.leaks(docs, bench).collect()), key=repr)
    budget = len(D.normal(ITEM)) * D.PERCENT // 100
    assert got == [(20, 1, 1, budget), (22, 1, 0, budget), (6, None, 0, 3), (8, 4, 0, 0)]
    blocks = sorted(map(tuple, D.leaks(docs, bench, block_bytes=40).collect()), key=repr)
    assert blocks == got
    kept = D.without_leaks(docs, bench)
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=repr)
    assert ids == sorted([1, 2, 3, 4, 4, 5, None, 7, 21], key=repr)


@pytest.mark.parametrize("block_bytes", [D.BLOCK_BYTES, 40])
def test_rows_are_judged_by_their_own_text(spark, make, block_bytes):
    bench = spark.createDataFrame([(1, ITEM), (2, ITEM[::-1])], "item_id long, text string")
    clean = [(None, "clean"), (None, None), (None, ""), (5, "also clean"), (6, "clean"), (None, "clean")]
    leaking = [(None, f"Well. {ITEM}"), (5, ITEM), (7, f"Well. {ITEM}"), (None, f"{ITEM[::-1]} more")]
    kept = D.without_leaks(make(clean + leaking), bench, block_bytes=block_bytes)
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr) == sorted(clean, key=repr)


SHORT = "What is the capital of France?"


@pytest.mark.parametrize(
    "item, text, found",
    [(SHORT, SHORT, True), (SHORT, f"Quiz: {SHORT} Paris.", True), (SHORT, f"“{SHORT[:-1]}”", True),
     (SHORT, "what is  the CAPITAL of france", True), (SHORT, "What is the capital of Frances?", False),
     (SHORT, "What is the capital of Francé?", False), (SHORT, "What is the capital of Frence?", False),
     ("word", "in a word.", True), ("word", "words and sword, wörd, wordé, éword", False),
     ("word", "sword word", True), ("été", "un été chaud", True), ("été", "étés", False),
     ("日本", "今日本屋", True)],
)
def test_short_items_are_found_inside_documents(item, text, found):
    finder = D.Finder([D.Item(1, D.normal(item), 0), D.Item(2, D.normal(ITEM), 6)])
    assert list(finder.find(D.normal(text))) == [(0, 0)] * found
    assert list(finder.find(D.normal(f"{text} {ITEM}"))) == [(0, 0)] * found + [(1, 0)]


def test_documents_with_short_items_go(spark, make):
    bench = spark.createDataFrame([(1, SHORT), (2, "a b")], "item_id long, text string")
    docs = make(
        [(1, f"Quiz. {SHORT} Paris."), (2, "What is the capital of Frances?"), (3, "A, b!"), (None, "a bc"),
         (4, "What was the capital of Greece?")]
    )
    # One rule for all lengths: 29 bytes may be off by two edits, three bytes by none.
    assert sorted(map(tuple, D.leaks(docs, bench).collect())) == [(1, 1, 0, 2), (2, 1, 0, 2), (3, 2, 0, 0)]
    assert sorted((r["doc_id"] for r in D.without_leaks(docs, bench).collect()), key=repr) == [4, None]


def test_empty_tables(spark, empty, edges):
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert D.leaks(edges, nothing).count() == 0
    assert D.without_leaks(edges, nothing).count() == edges.count()
    assert D.leaks(empty, spark.createDataFrame([(1, ITEM)], "item_id long, text string")).count() == 0


def test_whole_table_against_brute_force(table):
    docs = [(r["doc_id"], D.normal(r["text"])) for r in table("documents").collect()]
    items = [(r["item_id"], D.normal(r["text"])) for r in table("benchmark").collect()]
    planted = {(d, i) for d, text in docs for i, item in items if item in text}
    got = D.leaks(table("documents"), table("benchmark")).collect()
    assert planted and {(r["doc_id"], r["item_id"]) for r in got if r["edits"] == 0} == planted
    texts, tests = dict(docs), dict(items)
    assert all(r["edits"] <= r["budget"] for r in got)
    for r in [r for r in got if r["edits"]][:5]:
        assert by_table(tests[r["item_id"]], texts[r["doc_id"]]) == r["edits"]


@pytest.mark.parametrize("budget", [0, 1, 7])
def test_pieces_cover_the_item(budget):
    pieces = D.cut(ITEM, budget)
    assert len(pieces) == budget + 1 and "".join(p for _, p in pieces) == ITEM
