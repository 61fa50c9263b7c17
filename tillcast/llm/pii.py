"""Personal data by anchor expansion.

One Aho-Corasick pass over a whole text finds anchors: at-signs, plus signs, digits, URL schemes, country codes before a
digit and words that announce an identifier. A local parser at each anchor expands to the boundaries of what it may be
and validates it. Parsers of one kind never look behind what that kind has already taken, so each reads a text once from
left to right.

Kinds, in this order: email, ip, card, phone; then what the method adds: login (a URL that carries a user name),
secret (a value with a digit after a word like ``token`` or ``password``, to the end of its characters: of any length
after a colon or an equals sign, of 16 characters and more after a space alone), account (an account number after a word
that announces one, or, anywhere, an IBAN of its country's length whose check digits are right). Places are code points,
ends exclusive.

A null text is an empty one and has no spans. Very long texts are read whole. Repeated rows give the same spans each.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm import words as W

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "login", "secret", "account")
_ORDER = {kind: i for i, kind in enumerate(KINDS)}

#: Words that announce a secret or an account number.
SECRET_CUES = ("token", "secret", "password", "passwd", "api_key", "apikey", "access_key", "Bearer")
ACCOUNT_CUES = ("iban", "account", "konto", "compte", "cuenta")

#: Characters of an IBAN by its country.
IBAN_LENGTHS = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
        25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_FOUR = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOGIN = re.compile(r"[A-Za-z0-9._~%!$&'*+,;=-]+(?::[^\s/@:]*)?@[A-Za-z0-9.-]+")
_SECRET = re.compile(r"[A-Za-z_]{0,16}[\"']?([ ]{0,2}[:= ][ ]{0,2})[\"']?([A-Za-z0-9_+/=.~-])")
_SECRET_RUN = re.compile(r"[A-Za-z0-9_+/=.~-]+")
#: Characters from which a value with a digit is a secret after a space alone; after a colon or an equals sign any is.
_SECRET_ALONE = 16
_DIGIT = re.compile(r"[0-9]")
_ACCOUNT = re.compile(
    r"(?:[ ](?:number|no|nummer|nr))?[.:#]{0,2}[ ]{0,2}([A-Z]{2}[0-9]{2}|[0-9](?:[ -]?[0-9]){5,17}[0-9]*)"
)
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]){11,30}")
_SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def iban(text: str) -> bool:
    plain = text.replace(" ", "")
    if not 15 <= len(plain) <= 34:
        return False
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def iban_end(text: str, at: int) -> int | None:
    """Where the IBAN that starts at ``at`` ends, if its check digits are right. Its country gives its length; that of
    a country not listed is the longest one that ends where a group does."""
    run = _IBAN.match(text, at)
    if not run:
        return None
    ends = [i + 1 for i in range(at, run.end()) if text[i] != " "]
    length = IBAN_LENGTHS.get(text[at : at + 2])
    if length:
        ends = ends[length - 1 : length]
    else:
        ends = [end for end in reversed(ends[14:]) if not text[end : end + 1].isalnum()]
    return next((end for end in ends if iban(text[at:end])), None)


def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for anchor, kind in [("@", "email"), ("+", "phone"), ("://", "login"), *((d, "digit") for d in "0123456789")]:
        found.add_word(anchor, (kind, len(anchor)))
    for cues, kind in ((SECRET_CUES, "secret"), (ACCOUNT_CUES, "account")):
        for cue in cues:
            for form in {cue, cue.lower(), cue.capitalize(), cue.upper()}:
                found.add_word(form, (kind, len(form)))
    for country in IBAN_LENGTHS:
        for digit in "0123456789":
            found.add_word(country + digit, ("iban", 3))
    found.make_automaton()
    return found


_ANCHORS: list = []


def find(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of all spans, by start and then kind."""
    if not _ANCHORS:
        _ANCHORS.append(_automaton())
    spans: list[tuple[int, str, int]] = []
    email_end = phone_end = card_end = dotted_end = secret_end = login_end = 0
    for last, (kind, length) in _ANCHORS[0].iter(text):
        at = last + 1 - length
        if kind == "digit":
            if at >= dotted_end:
                run = _DOTTED.match(text, at)
                dotted_end = run.end()
                if dotted_end - at >= 7:
                    for four in _FOUR.finditer(text, at, dotted_end):
                        if all(len(part.lstrip("0")) <= 3 and int(part) <= 255 for part in four.groups()):
                            spans.append((four.start(), "ip", four.end()))
            if at >= card_end:
                chain = _CHAIN.match(text, at)
                card_end = chain.end() if chain else at + 1
                if chain and chain.end() - at >= 14:
                    digits = chain.group().replace(" ", "").replace("-", "")
                    if 14 <= len(digits) <= 19 and luhn(digits):
                        spans.append((at, "card", card_end))
        elif kind == "email":
            start = at
            while start > email_end and text[start - 1] in _LOCAL:
                start -= 1
            domain = _DOMAIN.match(text, at + 1) if start < at else None
            if domain:
                email_end = domain.end()
                spans.append((start, "email", email_end))
        elif kind == "phone":
            number = _PHONE.match(text, at) if at >= phone_end else None
            if number:
                phone_end = number.end()
                if 10 <= sum(c.isdigit() for c in number.group()) <= 15:
                    spans.append((at, "phone", phone_end))
        elif kind == "login":
            start = at
            while start > login_end and text[start - 1] in _SCHEME:
                start -= 1
            while start < at and not (text[start].isascii() and text[start].isalpha()):
                start += 1
            login_end, user = last + 1, _LOGIN.match(text, last + 1)
            if start < at and user:
                spans.append((start, "login", user.end()))
        elif kind == "secret":
            value = _SECRET.match(text, last + 1)
            if value and value.start(2) >= secret_end:
                start, named = value.start(2), value[1].strip()
                secret_end = _SECRET_RUN.match(text, start).end()
                long_enough = named or secret_end - start >= _SECRET_ALONE
                if long_enough and _DIGIT.search(text, start, secret_end):
                    spans.append((start, "secret", secret_end))
        elif kind == "account":
            value = _ACCOUNT.match(text, last + 1)
            if value:
                end = value.end(1) if value[1][0] in "0123456789" else iban_end(text, value.start(1))
                if end:
                    spans.append((value.start(1), "account", end))
        elif kind == "iban" and not text[at - 1 : at].isalnum():
            end = iban_end(text, at)
            if end and not text[end : end + 1].isalnum():
                spans.append((at, "account", end))
    return sorted(set(spans), key=lambda s: (s[0], _ORDER[s[1]], s[2]))


def written(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


def mask(text: str, spans: list[tuple[int, str, int]]) -> str:
    """The text with each span, or run of overlapping spans, as the name of its first kind."""
    parts, done = [], 0
    for start, kind, end in spans:
        if start >= done:
            parts += [text[done:start], f"<{kind.upper()}>"]
        done = max(done, end)
    return "".join([*parts, text[done:]])


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", *(f"n_{kind}" for kind in BASE), "base_sha256", "spans"]
    for batch in batches:
        columns: list[list] = [[] for _ in names[1:]]
        for text in batch.column("text"):
            spans = find(text.as_py() or "")
            base = [span for span in spans if span[1] in BASE]
            counts = [sum(span[1] == kind for span in base) for kind in BASE]
            digest = hashlib.sha256(written(base).encode()).hexdigest()
            for column, value in zip(columns, [*counts, digest, written(spans)], strict=True):
                column.append(value)
        types = [pa.int64()] * len(BASE) + [pa.string()] * 2
        arrays = [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))]
        yield pa.RecordBatch.from_arrays(arrays, names=names)


def report(docs: DataFrame) -> DataFrame:
    """doc_id, the counts of the four base kinds, base_sha256 (of the base spans as text) and spans (all, as text:
    ``kind:start:end``, by start and then kind) of every row of ``docs`` (doc_id, text)."""
    counts = ", ".join(f"n_{kind} long" for kind in BASE)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return W.by_batch(rows, _report, f"doc_id long, {counts}, base_sha256 string, spans string")


def _masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [None if (t := text.as_py()) is None else mask(t, find(t)) for text in batch.column(0)]
        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), *batch.columns[1:]], names=batch.schema.names)


def masked(docs: DataFrame) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind's name; ``n_chars``, if there, follows the text. Other
    columns pass unread."""
    others = [name for name in docs.columns if name != "text"]
    rows = W.by_batch(docs.select("text", *others), _masked, docs.select("text", *others).schema)
    if "n_chars" in others:
        rows = rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return rows.select(*docs.columns)
