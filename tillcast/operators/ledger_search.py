"""Searches by filter and order texts, such as ``metrics.mse < 5 AND tags.owner LIKE 'a%'`` and ``metrics.r2 DESC``.

A text names attributes, bare or as ``attributes.<name>``, and keys, as ``metrics.<key>``, ``params.<key>`` or
``tags.<key>``; a key of other characters than letters, digits, ``_`` and ``.`` stands in double quotes or backticks. The
keys that a text names become columns of the runs, each read by its key; everything else in the text is Spark's own
expression language, so conditions reach the scans like any other. Runs without a key have NULL there, which meets no
comparison.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.operators.ledger import ACTIVE, Ledger, by_view, runs_wide, visible_versions

# Kinds of keys and the names they go by in texts, and names of attributes that columns have others for.
KINDS = {
    "metrics": "metrics", "metric": "metrics", "params": "params", "param": "params", "parameters": "params",
    "parameter": "params", "tags": "tags", "tag": "tags", "attributes": "", "attribute": "", "attr": "", "run": "",
}
ATTRIBUTES = {"run_id": "run_uuid", "start_time": "start_time", "created": "start_time"}

_REFERENCE = re.compile(
    r"""(?P<string>'(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.)*")"""
    r"""|(?<![\w.`"])(?P<kind>[A-Za-z]+)\s*\.\s*(?P<key>`[^`]+`|"[^"]+"|[A-Za-z_][\w.]*)"""
    r"""|(?<![\w.`"])(?P<word>[A-Za-z_]\w*)(?![\w(`"])"""
)
_ORDER = re.compile(r"(?P<what>.+?)(?:\s+(?P<way>ASC|DESC))?", re.IGNORECASE | re.DOTALL)


@dataclass
class Text:
    """A text with keys as columns, and the keys that it names."""

    text: str
    keys: dict[str, list[str]] = field(default_factory=lambda: {"metrics": [], "params": [], "tags": []})


def read_text(text: str, attributes: dict[str, str] | None = None) -> Text:
    out = Text("")

    def column(found: re.Match) -> str:
        if found["string"]:
            return found["string"]
        if found["word"]:
            return (attributes or {}).get(found["word"], found["word"])
        kind = KINDS.get(found["kind"].lower())
        if kind is None:
            raise ValueError(f"{found.group()!r} names neither an attribute nor a metric, a param or a tag")
        key = found["key"].strip('`"')
        if not kind:
            return f"`{(attributes or {}).get(key, key)}`"
        if key not in out.keys[kind]:
            out.keys[kind].append(key)
        return f"`{kind}_{key}`"

    out.text = _REFERENCE.sub(column, text)
    return out


def _merged(texts: Sequence[Text]) -> dict[str, list[str]]:
    return {kind: list(dict.fromkeys(key for text in texts for key in text.keys[kind])) for kind in ("metrics", "params", "tags")}


def _ordered(text: Text) -> list[Column]:
    """Sort keys: values, then NaN, then NULL, whatever the direction."""
    parts = _ORDER.fullmatch(text.text.strip())
    if not parts:
        raise ValueError("an order text is empty")
    value = F.expr(f"({parts['what']})")
    if (parts["way"] or "asc").lower() == "asc":
        return [value.asc_nulls_last()]
    nan = F.coalesce(F.isnan(value.try_cast("double")), F.lit(False))
    return [value.isNull().asc(), nan.asc(), value.desc()]


def _found(
    frame: DataFrame, condition: Text | None, order: Sequence[Text], ties: Sequence[Column], max_results: int | None
) -> DataFrame:
    said = condition.text if condition else None
    try:
        if said:
            frame = frame.where(said)
        for text in order:
            said = text.text
            frame.select(*_ordered(text))
    except (ParseException, AnalysisException) as wrong:
        raise ValueError(f"{said!r} is no text to search by: {wrong.getMessage()}") from wrong
    if order or max_results is not None:
        frame = frame.orderBy(*(c for text in order for c in _ordered(text)), *ties)
    return frame if max_results is None else frame.limit(max_results)


def find_runs(
    ledger: Ledger,
    experiments: Sequence[int] | None = None,
    filter_text: str = "",
    order_by: Sequence[str] = (),
    max_results: int | None = None,
    view: str = ACTIVE,
) -> DataFrame:
    """Runs by experiment, lifecycle and filter text, in order (equal ones: newest first, then by id), with a column for
    each key that the texts name."""
    runs = by_view(ledger.runs, view)
    if experiments is not None:
        runs = runs.where(F.col("experiment_id").isin(*experiments))
    condition = read_text(filter_text, ATTRIBUTES) if filter_text.strip() else None
    order = [read_text(text, ATTRIBUTES) for text in order_by]
    keys = _merged([*order, *([condition] if condition else [])])
    ties = [F.desc("start_time"), F.asc("run_uuid")]
    return _found(runs_wide(ledger, runs, **keys), condition, order, ties, max_results)


def _by_attributes(frame: DataFrame, filter_text: str, order_by: Sequence[str], ties, max_results) -> DataFrame:
    condition = read_text(filter_text) if filter_text.strip() else None
    order = [read_text(text) for text in order_by]
    if any(_merged([*order, *([condition] if condition else [])]).values()):
        raise ValueError("only runs have metrics, params and tags")
    return _found(frame, condition, order, ties, max_results)


def find_models(
    ledger: Ledger,
    experiments: Sequence[int] | None = None,
    filter_text: str = "",
    order_by: Sequence[str] = (),
    max_results: int | None = None,
) -> DataFrame:
    """Logged models by experiment and filter text, in order (equal ones: newest first, then by id)."""
    found = ledger.logged_models
    if experiments is not None:
        found = found.where(F.col("experiment_id").isin(*experiments))
    ties = [F.desc("creation_timestamp"), F.asc("model_id")]
    return _by_attributes(found, filter_text, order_by, ties, max_results)


def find_versions(
    ledger: Ledger, filter_text: str = "", order_by: Sequence[str] = (), max_results: int | None = None
) -> DataFrame:
    """Versions that are not hidden, by filter text, in order (equal ones: by name, newest first)."""
    found = visible_versions(ledger.model_versions)
    return _by_attributes(found, filter_text, order_by, [F.asc("name"), F.desc("version")], max_results)


def find_registered(
    ledger: Ledger,
    filter_text: str = "",
    order_by: Sequence[str] = (),
    max_results: int | None = None,
    view: str = ACTIVE,
) -> DataFrame:
    """Registered models by lifecycle and filter text, in order (equal ones: by name)."""
    return _by_attributes(by_view(ledger.registered_models, view), filter_text, order_by, [F.asc("name")], max_results)
