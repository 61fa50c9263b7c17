"""Sources mixed to target weights, by histograms over hash thresholds.

1. Every row gets its size (words) and a key, 60 bits of a digest of its id and text, so the choice depends on neither
   the order of rows nor on earlier runs. Sizes, keys and sources are written once; texts are read once.
2. A source's share of all words follows its weight, up to ``most`` times its own words; what is above goes to the others
   by weight, until none is above. Whole passes over a source come first, the rest is its budget.
3. The budget is a threshold on keys, and thresholds of smaller budgets are nested in it. Words are summed by source and
   4096 ranges of keys; only the range in which the budget ends is summed again, by the next twelve bits. When the
   range of the threshold holds at most ``fill`` rows, the shortest such prefix of keys is filled by its rows, the longest
   first, all that still fit. Nothing is sorted but those few rows of a source.

Documents are taken whole: a source ends below its target by less than the shortest row of that range that is left out.
Rows that are equal in id and text have one key and are told apart by their number in the written table, so any number
of copies of a row can be taken in part. A null text has no words. Null sources are one source, the last one. A null id counts as none, and the text tells
its rows apart. An empty table gives an empty result. Other columns are not read, or handed on by ``mixed``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.session import stage

#: Weights of sources in the order of their names, repeating, and how often a row may be taken at most.
WEIGHTS = (1, 2, 3)
MOST = 3
#: Rows of a source among which the last words of its budget are found.
FILL = 64
SEED = "mix"

_KEY_BITS = 60
_STEP = 12
_WORD = r"[^\x20\x09-\x0D]+"


def _key(seed: str) -> Column:
    told = F.md5(F.concat_ws("|", F.lit(seed), F.col("doc_id").cast("string"), F.col("text").cast("string")))
    return F.conv(F.substring(told, 1, _KEY_BITS // 4), 16, 10).cast("long")


def _sized(docs: DataFrame, seed: str) -> DataFrame:
    """doc_id, source, size, key and ordinal (a number of its own) of every row, written."""
    size = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(_WORD)), F.lit(0)).cast("long").alias("size")
    names = F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source")
    rows = docs.select(*names, size, _key(seed).alias("key"))
    return stage(rows.withColumn("ordinal", F.monotonically_increasing_id()), "sized")


def _numbered(df: DataFrame, by: str) -> DataFrame:
    """``df`` with ``place``, from 0, in ascending order of a column that has no value twice, nulls last.

    Ranges of values are numbered each on their own, and the rows of the ranges before are added.
    """
    ranges = df.repartitionByRange(F.col(by).asc_nulls_last()).sortWithinPartitions(F.col(by).asc_nulls_last())
    ranges = stage(ranges.withColumn("n", F.monotonically_increasing_id()), "ranges")
    in_range = ranges.withColumn("range", F.shiftright("n", 33)).withColumn("n", F.col("n").bitwiseAND(2**33 - 1))
    # One row a shuffle partition.
    before = F.sum("rows").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = in_range.groupBy("range").agg(F.count("*").alias("rows"))
    offsets = offsets.select("range", F.coalesce(before, F.lit(0)).alias("offset"))
    return in_range.join(offsets, "range").withColumn("place", F.col("n") + F.col("offset")).drop("range", "n", "offset")


def targets(rows: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from rows (source, size): all sizes shared by weight, none above ``most`` times its
    source's own."""
    sources = _numbered(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "source")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    sources = stage(sources.select("source", "source_size", weight.cast("long").alias("weight")), "sources")
    total, share = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    total = spare = total or 0
    full, before = F.lit(most) * F.col("source_size"), -1
    while True:  # every turn but the last finds further sources above
        wide = "decimal(38,0)"
        above = full * F.lit(share or 0).cast(wide) <= F.col("weight") * F.lit(spare).cast(wide)
        capped = sources.agg(
            F.sum(F.when(above, full).otherwise(0)), F.sum(F.when(above, 0).otherwise(F.col("weight"))), F.count_if(above)
        )
        taken, left, count = capped.first()
        if count == before or not count:
            break
        spare, share, before = total - taken, left, count
    by_weight = (F.col("weight") * spare).cast("double") / F.lit(share).cast("double")
    return sources.select("source", "source_size", F.when(above, full.cast("double")).otherwise(by_weight).alias("target"))


def _filled(inside: DataFrame, closed: DataFrame) -> DataFrame:
    """(source, first_key, first_ordinal, chosen): of a few rows a source, the longest first, all that still fit."""
    few = inside.join(closed, inside["source"].eqNullSafe(closed["own"]))
    few = few.where("shiftright(digit, shift) = shiftright(hit, shift)").groupBy("source", "rest")
    few = few.agg(
        F.sort_array(F.collect_list(F.struct((-F.col("size")).alias("minus"), "key", "ordinal"))).alias("few"),
        F.min(F.struct("key", "ordinal")).alias("first"),
    )

    def take(state: Column, row: Column) -> Column:
        left, chosen = state["rest"] + row["minus"], F.concat(state["chosen"], F.array(row["ordinal"]))
        return F.when(left >= 0, F.struct(left.alias("rest"), chosen.alias("chosen"))).otherwise(state)

    start = F.struct(F.col("rest"), F.array().cast("array<long>").alias("chosen"))
    first = F.col("first.key").alias("first_key"), F.col("first.ordinal").alias("first_ordinal")
    return few.select("source", *first, F.aggregate("few", start, take)["chosen"].alias("chosen"))


def _prefix(shift: int) -> Column:
    """Of a prefix of the digit in which a budget ends: what is left of the budget before it, and its rows."""
    own, hit = F.shiftright("digit", shift), F.shiftright("hit", shift)
    rest = F.col("left") - F.sum(F.when(own < hit, F.col("words")).otherwise(0))
    n = F.sum(F.when(own == hit, F.col("n")).otherwise(0))
    return F.struct(F.lit(shift).alias("shift"), rest.alias("rest"), n.alias("n"))


def _thresholds(rows: DataFrame, budgets: DataFrame, fill: int) -> DataFrame:
    """Where the budgets (own source, left) end: of a source with words to take, rows before (first_key, first_ordinal)
    are taken, and the rows whose ordinals are ``chosen``."""
    found = None
    inside = rows.join(budgets, rows["source"].eqNullSafe(budgets["own"]))
    inside = inside.select("source", "key", "ordinal", "size", "left")
    for bits in range(0, 2 * _KEY_BITS, _STEP):
        column, done = ("key", bits) if bits < _KEY_BITS else ("ordinal", bits - _KEY_BITS)
        digit = F.shiftright(column, _KEY_BITS - _STEP - done).bitwiseAND(F.lit(2**_STEP - 1))
        inside = stage(inside.withColumn("digit", digit), "inside")

        sums = inside.groupBy("source", "left", "digit").agg(F.sum("size").alias("words"), F.count("*").alias("n"))
        sums = stage(sums, "sums")  # at most 4096 rows a source
        upto = F.sum("words").over(Window.partitionBy("source").orderBy("digit"))
        hits = sums.withColumn("upto", upto).where("upto > left").groupBy(F.col("source").alias("own"))
        hits = hits.agg(F.min("digit").alias("hit"))
        ends = sums.join(hits, sums["source"].eqNullSafe(hits["own"])).groupBy("own", "left", "hit")
        ends = ends.agg(F.array(*map(_prefix, range(_STEP, -1, -1))).alias("prefixes"))  # shortest first
        ends = stage(ends.withColumn("p", F.get(F.filter("prefixes", lambda p: p["n"] <= fill), F.lit(0))), "ends")

        closed = ends.where("p IS NOT NULL").select("own", "hit", "p.shift", "p.rest")
        filled = stage(_filled(inside, closed), "filled")
        found = filled if found is None else found.unionByName(filled)
        open_ = ends.where("p IS NULL").select("own", "hit", F.element_at("prefixes", -1)["rest"].alias("left"))
        if not open_.limit(1).count():
            break
        goes_on = inside["source"].eqNullSafe(open_["own"]) & (inside["digit"] == open_["hit"])
        inside = inside.drop("left").join(open_, goes_on).select("source", "key", "ordinal", "size", "left")
    return found


def _mix(docs: DataFrame, weights: Sequence[int], most: int, fill: int, seed: str) -> DataFrame:
    rows = _sized(docs, seed)
    passes = F.when(F.col("source_size") > 0, F.least(F.lit(most), F.floor(F.col("target") / F.col("source_size"))))
    sources = targets(rows, weights, most).withColumn("passes", F.coalesce(passes, F.lit(0)).cast("long"))
    budget = F.floor(F.col("target") - F.col("passes") * F.col("source_size")).cast("long")
    sources = stage(sources.withColumn("budget", budget), "targets")

    budgets = sources.where("budget > 0").select(F.col("source").alias("own"), F.col("budget").alias("left"))
    ends = _thresholds(rows, budgets, fill).withColumnRenamed("source", "own")
    known = sources.join(ends, sources["source"].eqNullSafe(ends["own"]), "left").drop("own")
    known = stage(known.withColumnRenamed("source", "own"), "known")
    rows = rows.join(known, rows["source"].eqNullSafe(known["own"]))
    before = F.struct("key", "ordinal") < F.struct("first_key", "first_ordinal")
    once_more = F.col("first_key").isNotNull() & (before | F.array_contains("chosen", F.col("ordinal")))
    return rows.withColumn("copies", F.col("passes") + once_more.cast("long"))


def mix(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, fill: int = FILL, seed: str = SEED
) -> DataFrame:
    """For every row of ``docs`` (doc_id, text, source): doc_id, size, source_size, target (its source's), copies and
    taken, the words that the mix takes from it."""
    rows = _mix(docs, weights, most, fill, seed)
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return rows.select("doc_id", "size", "source_size", "target", "copies", taken)


def mixed(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, fill: int = FILL, seed: str = SEED
) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken, in no order. Of rows that are equal in id and
    text, one stands for all."""
    by_key = _mix(docs, weights, most, fill, seed).groupBy("key")
    by_key = by_key.agg(F.sum("copies").cast("int").alias("copies"), F.count("*").alias("rows"))
    by_key = stage(by_key.where("copies > 0"), "copies")
    rows = docs.select(F.struct(*docs.columns).alias("row"), _key(seed).alias("key")).join(by_key, "key")
    rows = rows.where("rows = 1").unionByName(rows.where("rows > 1").dropDuplicates(["key"]))
    return rows.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select("row.*")
