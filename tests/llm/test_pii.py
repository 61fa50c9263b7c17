import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from texts import EDGES

from tillcast.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def by_regex(text):
    found = []
    for place, (kind, pattern) in enumerate(PATTERNS.items()):
        for match in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", match[0])
            if kind == "ip" and max(map(int, match[0].split("."))) > 255:
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            found.append((match.start(), place, kind, match.end()))
    return [(start, kind, end) for start, _, kind, end in sorted(found)]


def base(text):
    return [span for span in pii.find(text) if span[1] in pii.BASE]


@settings(max_examples=600, deadline=None)
@given(st.text("0123456789012345678901234..--  ++()@@aZ_%é\n:/", max_size=60))
def test_base_spans_are_those_of_the_patterns(text):
    assert base(text) == by_regex(text)


def test_cards_of_the_pattern_inside_other_text():
    for text in ("4111 1111-1111 1111", "id4111111111111111x", "4111111111111112", "1 4111111111111111"):
        assert base(text) == by_regex(text)
    assert pii.written(base("4111 1111-1111 1111")) == "card:0:19"


def test_added_kinds():
    text = 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" ftp://bob:pw@example.org/x IBAN DE89 3704 0044 0532 0130 00.'
    kinds = [(kind, text[a:b]) for a, kind, b in pii.find(text) if kind not in pii.BASE]
    assert kinds == [
        ("secret", "04dbebab91ab85687d33eeaaf9ac699e1188f962"),
        ("login", "ftp://bob:pw@example.org"),
        ("account", "DE89 3704 0044 0532 0130 00"),
    ]
    assert not [k for _, k, _ in pii.find("a token of thanks, IBAN DE88 3704 0044 0532 0130 00") if k not in pii.BASE]


def added(text):
    return [(kind, text[a:b]) for a, kind, b in pii.find(text) if kind not in pii.BASE]


@pytest.mark.parametrize(
    "text, secret",
    [
        ("password=hunter2 and", "hunter2"), ("token: abcdefghij12345.", "abcdefghij12345."), ("secret = 7", "7"),
        ("password hunter2", None), ("the secret: silence", None), ("Token 1 of 2", None),
    ],
)
def test_short_secrets(text, secret):
    assert added(text) == ([("secret", secret)] if secret else [])


def test_schemes_of_any_length():
    scheme = "averylongscheme+of-many.parts"
    assert added(f"see {scheme}://bob:pw@example.org now") == [("login", f"{scheme}://bob:pw@example.org")]
    assert added("1+://bob@example.org") == [] and added("2ftp://bob@x.org") == [("login", "ftp://bob@x.org")]


@pytest.mark.parametrize("size", [16, 512, 513, 900, 100_000])
def test_secrets_end_with_their_characters(size):
    secret = ("a1b2C3_-" * (size // 8 + 1))[:size]
    assert added(f"Authorization: Bearer {secret} and more") == [("secret", secret)]
    assert added("token=" * (size // 6 + 3) + "7") == [("secret", "token=" * (size // 6 + 2) + "7")]


@pytest.mark.parametrize("cue", ["IBAN ", "", "(", "Konto: "])
@pytest.mark.parametrize("after", ["", ".", " BIC COBADEFFXXX", " EUR 20", " 20 EUR", " 0130", "\n12", ", DE"])
@pytest.mark.parametrize(
    "number",
    ["DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "GB29 NWBK 6016 1331 9268 19", "NO9386011117947",
     "FR1420041010050500013M02606"],
)
def test_ibans_end_by_their_country(cue, after, number):
    assert added(f"pay {cue}{number}{after}") == [("account", number)]
    wrong = number[:3] + str((int(number[3]) + 1) % 10) + number[4:]
    assert added(f"pay {cue}{wrong}{after}") == []


def test_ibans_need_bounds_without_a_cue():
    assert added("xDE89370400440532013000") == added("DE89370400440532013000x") == added("DE8937040044053201300") == []
    assert added("IBAN XX46 3704 0044 0532 0130 00 EUR") == [("account", "XX46 3704 0044 0532 0130 00")]
    assert added("account 123456789012345678901234") == [("account", "123456789012345678901234")]


def check(rows, got):
    assert len(got) == len(rows)
    texts = sorted(rows, key=repr)
    for (doc_id, text), r in zip(texts, sorted(got, key=lambda r: repr((r["doc_id"], ""))), strict=True):
        spans = by_regex(text)
        assert r["doc_id"] == doc_id
        assert [r[f"n_{k}"] for k in pii.BASE] == [sum(s[1] == k for s in spans) for k in pii.BASE]
        assert r["base_sha256"] == hashlib.sha256(pii.written(spans).encode()).hexdigest()
        assert r["spans"] == pii.written(pii.find(text or ""))


def test_edges(edges, empty, make):
    rows = [(i, t) for i, t in EDGES if i != 4 and i is not None] + [(50, "1" * 100_000), (51, "a@" * 20_000 + "b.co +" * 9)]
    check(rows, pii.report(make(rows)).collect())
    assert pii.report(edges).count() == len(EDGES)
    assert pii.report(empty).count() == 0


def test_whole_table(table):
    rows = [(r["doc_id"], r["text"]) for r in table("documents").select("doc_id", "text").collect()]
    got = {r["doc_id"]: r for r in pii.report(table("documents")).collect()}
    assert sum(r["n_email"] for r in got.values()) > 0
    for doc_id, text in rows:
        spans = by_regex(text)
        assert got[doc_id]["base_sha256"] == hashlib.sha256(pii.written(spans).encode()).hexdigest()


def test_masked(make):
    rows = [(1, "mail a.b@c.org or +49 (30) 1234-5678."), (2, None), (3, "nothing")]
    docs = make(rows)
    got = pii.masked(docs)
    assert got.columns == docs.columns and got.schema == docs.schema
    texts = {r["doc_id"]: (r["text"], r["n_chars"]) for r in got.collect()}
    assert texts == {1: ("mail <EMAIL> or <PHONE>.", 24), 2: (None, None), 3: ("nothing", 7)}


@pytest.mark.parametrize("spans, out", [([(1, "ip", 3), (2, "card", 5)], "a<IP>f"), ([], "abcdef")])
def test_overlaps_are_masked_once(spans, out):
    assert pii.mask("abcdef", spans) == out
