"""Texts and plain-Python helpers of the tests."""

import re

SF = "/root/testdata/sf0.01"

LONG = "lorem ipsum dolor sit amet consectetur " * 8000

#: Null and empty texts, white space alone, a null id, repeated rows, a very long text, odd characters.
EDGES = [
    (1, None),
    (2, ""),
    (3, " \t\n\x0b\f\r"),
    (4, "One two, three. FOUR five\nsix"),
    (4, "One two, three. FOUR five\nsix"),
    (5, "one two, three. four five six"),
    (None, "a text without a number of its own, which is long enough to be kept by every rule there is"),
    (6, LONG),
    (7, "Straße ÉLAN 日本語 \U0001f600 \u00a0 \x1f x\u0301 İstanbul <|endoftext|>"),
    (8, "word"),
]


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
