"""Positional time split of the pairs into a training and a test part, without a global sort.

The order is month (newest first), then client. Month counts give the month in which the split index falls; inside that
month the client at the wanted position is found by counting ranges of client keys. Every row is then on one side of
(month, client), so the pairs themselves are never shuffled or ranked.
"""

from __future__ import annotations

import datetime as dt
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TEST_SIZE = 0.34
RANGES = 65536


@dataclass(frozen=True)
class SplitPoint:
    """The last training row; ``month`` is None when no row is for training."""

    rows: int
    training_rows: int
    holdout: str
    month: dt.date | None = None
    client: int | None = None


def split_index(rows: int, test_size: float = TEST_SIZE) -> int:
    """Rounded down in binary floating point: 50 rows give 32, not 33."""
    return math.floor((1 - test_size) * rows)


def key_at_position(keys: DataFrame, column: str, position: int, low: int, high: int) -> int:
    """The key at ``position`` (1-based) of the ascending order of integers in [low, high], by narrowing that range.

    Each pass returns at most RANGES counts and divides the range by RANGES: two passes for a 32-bit key span, four for
    64 bits, however the keys are spread.
    """
    while low < high:
        width = -(-(high - low + 1) // RANGES)
        counts = (
            keys.where(F.col(column).between(low, high))
            .groupBy(F.expr(f"({column} - ({low}L)) div {width}L").alias("number"))
            .count()
            .orderBy("number")
            .collect()
        )
        for number, count in counts:
            if position <= count:
                low, high = low + number * width, min(high, low + (number + 1) * width - 1)
                break
            position -= count
    return low


def find_split(pairs: DataFrame, holdout: str = "oldest", test_size: float = TEST_SIZE) -> SplitPoint:
    """Where the training rows end. ``pairs`` is read a few times: pass a stored table.

    ``holdout="oldest"`` tests on the oldest rows, ``"newest"`` on the newest.
    """
    if holdout not in ("oldest", "newest"):
        raise ValueError(f"holdout is 'oldest' or 'newest', not {holdout!r}")
    # One row per calendar month.
    months = sorted(
        pairs.groupBy("month").agg(F.count(F.lit(1)), F.min("clientID"), F.max("clientID")).collect(),
        reverse=holdout == "oldest",
    )
    rows = sum(count for _, count, _, _ in months)
    left = training_rows = split_index(rows, test_size)
    for month, count, low, high in months:
        if 0 < left <= count:
            keys = pairs.where(F.col("month") == F.lit(month)).select("clientID")
            client = key_at_position(keys, "clientID", left, low, high)
            return SplitPoint(rows, training_rows, holdout, month, client)
        left -= count
    return SplitPoint(rows, training_rows, holdout)


def is_training(point: SplitPoint) -> Column:
    if point.month is None:
        return F.lit(False)
    month, client = F.col("month"), F.col("clientID")
    before = month > F.lit(point.month) if point.holdout == "oldest" else month < F.lit(point.month)
    return before | ((month == F.lit(point.month)) & (client <= F.lit(point.client)))


def train_test_split(pairs: DataFrame, holdout: str = "oldest", test_size: float = TEST_SIZE) -> DataFrame:
    """The pairs with a column ``isTraining``."""
    return pairs.withColumn("isTraining", is_training(find_split(pairs, holdout, test_size)))
