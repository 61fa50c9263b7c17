"""Quality rules: a table of thresholds compiled into one projection of text statistics.

Only built-in functions. ``statistics`` gives the counts of every text, ``RULES`` bounds ratios of them, and
``compile_rules`` turns such a table into a column. Nothing is shuffled: each row is judged where it is read.

A null text is an empty one: no words, no lines, ``base_failed``. Very long texts are rows like others; their work grows
with their length (times its logarithm where windows repeat). Repeated rows are judged alike. Other columns are not read.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 5
_SPACE = r"[\x20\x09-\x0D]+"

#: Frequent words of four languages.
STOP_WORDS = (
    "the of and to in a is that for it was on with as be at by this are from or an "
    "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch "
    "de la le et les des en un une du dans que est pour qui par sur pas au avec "
    "el los y del las por con una su para lo como más"
).split()


class Rule(NamedTuple):
    """``low <= 100 * part / whole <= high`` (None: no bound) where ``whole`` is at least ``least``."""

    name: str
    part: str
    whole: str
    low: int | None
    high: int | None
    least: int = 1


RULES = (
    Rule("mean word length", "word_chars", "n_words", 200, 1500),
    Rule("symbols per word", "n_symbols", "n_words", None, 30),
    Rule("stop words", "n_stop_words", "n_words", 2, None, 50),
    Rule("repeated lines", "n_dup_lines", "n_lines", None, 40),
    Rule("lines that end in an ellipsis", "n_ellipsis_lines", "n_lines", None, 50),
    Rule("bulleted lines", "n_bullet_lines", "n_lines", None, 90),
    Rule("words with a letter", "n_letter_words", "n_words", 70, None),
)


def _long(column: Column) -> Column:
    return column.cast("long")


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of its text, one row per row of ``docs``.

    Arrays that later steps look into are columns of their own, so that they are made once a row. Repeated windows are
    looked for by hashes first; only a text whose hashes repeat has its windows sorted as text, so counts are exact.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.select("doc_id", text.alias("t"))
    base = base.withColumn("w", F.array_remove(F.split("t", _SPACE), ""))
    lines = F.filter(F.split("t", "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    base = base.withColumn("l", lines)

    def window_hash(_, i):
        return F.xxhash64(*(F.get("w", i + place) for place in range(WINDOW)))

    enough = F.size("w") >= WINDOW
    whole = F.slice("w", 1, F.size("w") - (WINDOW - 1))
    base = base.withColumn("h", F.when(enough, F.transform(whole, window_hash)))
    repeats = F.size(F.array_distinct("h")) < F.size("h")
    windows = F.transform(
        whole, lambda _, i: F.struct(F.array_join(F.slice("w", i + 1, WINDOW), " ").alias("s"), i.alias("i"))
    )
    base = base.withColumn("s", F.when(repeats, F.array_sort(windows)))

    def same(x, j):
        return F.get("s", j - 1)["s"].eqNullSafe(x["s"]) | F.get("s", j + 1)["s"].eqNullSafe(x["s"])

    places = F.array_sort(F.transform(F.filter("s", same), lambda x: x["i"]))
    start = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
    covered = F.aggregate(
        places,
        start,
        lambda acc, i: F.struct((acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n"), i.alias("last")),
        lambda acc: acc["n"],
    )
    return base.select(
        "doc_id",
        _long(F.size("w")).alias("n_words"),
        _long(F.length(F.array_join("w", ""))).alias("word_chars"),
        _long(F.length(F.regexp_replace("t", r"[^#*$%&|<>]+", ""))).alias("n_symbols"),
        _long(F.size("l") - F.size(F.array_distinct("l"))).alias("n_dup_lines"),
        _long(F.coalesce(F.when(F.col("s").isNotNull(), covered), F.lit(0))).alias("n_repeat_words"),
        _long(F.size("l")).alias("n_lines"),
        _long(F.size(F.filter("w", lambda w: w.isin(*STOP_WORDS)))).alias("n_stop_words"),
        _long(F.size(F.filter("l", lambda line: line.endswith("...") | line.endswith("…")))).alias("n_ellipsis_lines"),
        _long(F.size(F.filter("l", lambda line: line.rlike(r"^[\x20\x09]*[-*•]\x20")))).alias("n_bullet_lines"),
        _long(F.size(F.filter("w", lambda w: w.rlike(r"\p{L}")))).alias("n_letter_words"),
    )


def compile_rules(rules: tuple[Rule, ...] = RULES) -> Column:
    """True where every rule holds; integers on both sides, so no rounding decides."""
    out = F.lit(True)
    for rule in rules:
        share, whole = 100 * F.col(rule.part), F.col(rule.whole)
        for bound, holds in ((rule.low, lambda b: share >= b * whole), (rule.high, lambda b: share <= b * whole)):
            if bound is not None:
                out = out & ((whole < rule.least) | holds(bound))
    return out


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The statistics, ``base_failed`` (under ten words, or more than a fifth of them in repeated windows) and
    ``kept`` for every row of ``docs`` (doc_id, text)."""
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    out = statistics(docs).withColumn("base_failed", failed)
    return out.withColumn("kept", ~F.col("base_failed") & compile_rules(rules))
