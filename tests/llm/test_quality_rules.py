import re

from texts import EDGES, words

from tillcast.llm import quality_rules as Q


def brute(text):
    own = words(text)
    lines = [line for line in (text or "").split("\n") if words(line)]
    windows = [tuple(own[i : i + 5]) for i in range(len(own) - 4)]
    twice = {w for w in windows if windows.count(w) > 1} if len(windows) < 3000 else set(windows)
    covered = {i + j for i, w in enumerate(windows) if w in twice for j in range(5)}
    return (
        len(own), sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)
    )


FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_statistics(make, edges):
    more = [
        (30, "a b c d e a b c d e f g"),
        (31, "x x x x x x x"),
        (32, "same line\nsame line\n\n \nother\nsame line \n"),
        (33, "## a *b* 1 < 2 & 3 > 2 | $5 50%"),
        (34, "a b c d e f g h i j k a b c d e f z c d e f z"),
    ]
    got = Q.judge(edges.unionByName(make(more))).collect()
    rows = sorted(((r["doc_id"], *(r[f] for f in FIELDS)) for r in got), key=repr)
    assert rows == sorted(((i, *brute(t)) for i, t in EDGES + more), key=repr)
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])


def test_rules(make):
    good = "the cat and the dog sat in the sun for a while and it was good"
    rows = [(1, good), (2, good.replace(" ", "*** ")), (3, "1 2 3 4 5 6 7 8 9 10 11 12"), (4, "qq ww ee " + good)]
    assert {r["doc_id"]: r["kept"] for r in Q.judge(make(rows)).collect()} == {1: True, 2: False, 3: False, 4: True}
    none = (Q.Rule("no words at all", "n_words", "n_words", None, 0),)
    assert not any(r["kept"] for r in Q.judge(make(rows), none).collect())


def test_plan_is_one_projection(edges, empty):
    plan = Q.judge(edges)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    assert Q.judge(empty).count() == 0
