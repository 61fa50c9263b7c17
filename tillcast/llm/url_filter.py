"""URL filter: rules on hosts and paths, then a blocked Bloom filter of listed URLs before an exact hash join.

Only built-in functions on DataFrames. The Bloom filter is a table of blocks, each of eight 64-bit lanes; a URL is one
block and one bit in each lane. Probing is an equi-join on the block number, so the filter may be larger than any
executor; Spark broadcasts it where its own size check allows. What passes goes to an exact join on the canonical URL,
which removes the false positives; what does not pass is in no list.

Null URLs and URLs without ``://`` have an empty host, path and canonical form and are never listed. Repeated URLs are
judged alike. Of the input, the id and ``url`` are read; other columns may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LANES = 8
BITS_PER_URL = 12
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Query parameters that name a visit and not a page.
VISIT_PARAMETERS = r"^(utm_[a-z]+|ref|gclid|fbclid)="


def _rest(url: Column) -> Column:
    return F.substr(url, F.instr(url, "://") + 3)


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered; else empty."""
    found = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.when(F.instr(url, "://") > 0, F.translate(found, _UPPER, _LOWER)).otherwise("")


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    found = F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)
    return F.when(F.instr(url, "://") > 0, found).otherwise("")


def canonical(url: Column) -> Column:
    """Host, path without trailing slashes, and the query without parameters of a visit; no scheme, no fragment."""
    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    own = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(VISIT_PARAMETERS))
    tail = F.when(F.size(own) > 0, F.concat(F.lit("?"), F.array_join(F.array_sort(own), "&"))).otherwise("")
    whole = F.concat(host(url), F.regexp_replace(path(url), "/+$", ""), tail)
    return F.when(F.instr(url, "://") > 0, whole).otherwise("")


def rule_of(rules: Sequence[tuple[str, str]], host_name: Column, url_path: Column) -> Column:
    """The longest rule (action, ``host/path``) that fits, as text, else null."""
    chosen = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, start = rule.partition("/")
        fits = ((host_name == name) | host_name.endswith(f".{name}")) & url_path.startswith(slash + start)
        chosen = F.when(fits, rule).otherwise(chosen)
    return chosen


def _bits(url: Column) -> list[Column]:
    """One bit in each lane, from a hash of its own."""
    chosen = F.xxhash64(url, F.lit("lane"))
    return [
        F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(chosen, 6 * lane).bitwiseAND(63).cast("int"))
        for lane in range(LANES)
    ]


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(blocks))


def bloom_blocks(urls: DataFrame, blocks: int) -> DataFrame:
    """(block, lane_0 .. lane_7) of the column ``canonical``."""
    lanes = [F.bit_or(bit).alias(f"lane_{i}") for i, bit in enumerate(_bits(F.col("canonical")))]
    return urls.groupBy(_block(F.col("canonical"), blocks).alias("block")).agg(*lanes)


def judge(
    pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str]], id_column: str = "page_id"
) -> DataFrame:
    """id, host, path, rule, verdict and listed for every row of ``pages``; ``listed`` has the blocked URLs in ``url``.

    verdict: the rule's action; without a rule ``block`` for a listed URL and else ``allow``. An empty list blocks
    nothing.
    """
    for action, rule in rules:
        if action not in ("allow", "block") or "/" not in rule:
            raise ValueError(f"not a rule: {action} {rule}")
    known = listed.select(canonical(F.col("url")).alias("canonical")).where("canonical != ''").distinct()
    blocks = max(1, math.ceil(known.count() * BITS_PER_URL / (64 * LANES)))
    url = F.col("url")
    rows = pages.select(id_column, host(url).alias("host"), path(url).alias("path"), canonical(url).alias("canonical"))
    rows = rows.withColumn("block", _block(F.col("canonical"), blocks))
    probed = rows.join(bloom_blocks(known, blocks), "block", "left")
    set_bits = [F.col(f"lane_{i}").bitwiseAND(bit) != 0 for i, bit in enumerate(_bits(F.col("canonical")))]
    maybe = F.lit(True)
    for bit in set_bits:
        maybe = maybe & F.coalesce(bit, F.lit(False))
    probed = probed.withColumn("maybe", maybe).drop("block", *(f"lane_{i}" for i in range(LANES)))
    exact = known.withColumn("listed", F.lit(True))
    hits = probed.where("maybe").join(exact, "canonical", "left").withColumn("listed", F.coalesce("listed", F.lit(False)))
    rest = probed.where("NOT maybe").withColumn("listed", F.lit(False))
    out = hits.unionByName(rest).withColumn("rule", rule_of(rules, F.col("host"), F.col("path")))
    verdict = F.when(F.col("listed"), "block").otherwise("allow")
    for action, rule in rules:
        verdict = F.when(F.col("rule") == rule, action).otherwise(verdict)
    return out.select(id_column, "host", "path", "rule", verdict.alias("verdict"), "listed")
