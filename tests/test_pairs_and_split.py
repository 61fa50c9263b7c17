import datetime as dt
import random

import pytest

from tillcast.contracts import REVENUE
from tillcast.operators import pairs, split
from tillcast.sources.tables import literal_rows

COLUMNS = ["clientID", "revenueLastMonth", "revenue"]


def test_example_pairs(revenue, rows):
    found = pairs.training_pairs(revenue, "2025-01-01", "2025-06-01").select(*COLUMNS)
    assert rows(found) == [(1, 15, 12), (3, 16, 16), (3, 24, 16)]
    evaluated = pairs.evaluation_pairs(revenue, "2025-05-01", "2025-06-01").select(*COLUMNS)
    assert rows(evaluated) == [(3, 16, 16), (3, 24, 16)]


def test_training_label_may_lie_after_the_end(revenue, rows):
    found = pairs.training_pairs(revenue, "2025-05-01", "2025-05-01").select("clientID", "month", "nextMonth")
    assert rows(found) == [(3, dt.date(2025, 5, 1), dt.date(2025, 6, 1))]


@pytest.mark.parametrize(
    "start,end", [("1995-01-15", "1996-02-10"), ("1995-02-01", "1995-02-01"), ("1995-01-01", "1999-01-01")]
)
def test_pairs_equal_the_self_join(spark, rows, start, end):
    """Brute force over random gaps, NULL keys and NULL revenue."""
    rng = random.Random(7)
    data = [
        (client, dt.date(1995 + m // 12, m % 12 + 1, 1), rng.choice([None, rng.randrange(100)]))
        for client in [None, *range(30)]
        for m in range(30)
        if rng.random() < 0.6
    ]
    revenue = literal_rows(spark, data, REVENUE)
    revenue.createOrReplaceTempView("brute_revenue")
    join = """SELECT n.clientID, p.month, n.month AS nextMonth, p.revenue AS revenueLastMonth, n.revenue
              FROM brute_revenue p JOIN brute_revenue n
              ON n.clientID = p.clientID AND n.month = add_months(p.month, 1)"""
    previous = spark.sql(f"{join} WHERE p.month >= '{start}' AND p.month <= '{end}'")
    following = spark.sql(f"{join} WHERE n.month >= '{start}' AND n.month <= '{end}'")
    assert rows(pairs.training_pairs(revenue, start, end)) == rows(previous)
    assert rows(pairs.evaluation_pairs(revenue, start, end)) == rows(following)
    assert rows(pairs.all_pairs(revenue)) == rows(spark.sql(join))


def test_repeated_month_is_an_error(spark, day):
    revenue = literal_rows(spark, [(1, day(1), 5), (1, day(1), 6), (1, day(2), 7)], REVENUE)
    with pytest.raises(Exception, match="two rows for one clientID and month"):
        pairs.all_pairs(revenue).collect()


def test_split_index_is_binary_floating_point():
    assert [split.split_index(n) for n in (0, 1, 2, 3, 50, 100)] == [0, 0, 1, 1, 32, 65]


@pytest.mark.parametrize("holdout,expected", [("oldest", (3, 16, 16)), ("newest", (1, 15, 12))])
def test_example_split(revenue, rows, holdout, expected):
    found = split.train_test_split(pairs.training_pairs(revenue, "2025-01-01", "2025-06-01"), holdout)
    assert rows(found.where("isTraining").select(*COLUMNS)) == [expected]
    assert found.where("not isTraining").count() == 2


def test_unknown_holdout(revenue):
    with pytest.raises(ValueError, match="holdout"):
        split.find_split(revenue, "middle")


@pytest.mark.parametrize("holdout", ["oldest", "newest"])
@pytest.mark.parametrize("clients", ["dense", "spread", "one_month"])
def test_split_equals_a_global_row_number(spark, rows, holdout, clients):
    """Brute force, with keys far apart, negative keys, and one month that holds nearly everything."""
    rng = random.Random(3)
    months = 1 if clients == "one_month" else 5
    pool = range(-40, 60) if clients == "dense" else [rng.randrange(-(2**60), 2**60) for _ in range(100)]
    data = [
        (client, dt.date(2020, month + 1, 1))
        for month in range(months)
        for client in pool
        if rng.random() < 0.7
    ]
    frame = literal_rows(spark, data, "clientID bigint, month date")
    found = split.train_test_split(frame, holdout)
    order = sorted(data, key=lambda r: (-r[1].toordinal() if holdout == "oldest" else r[1].toordinal(), r[0]))
    cut = split.split_index(len(data))
    assert rows(found.where("isTraining").select("clientID", "month")) == sorted(order[:cut], key=repr)
    assert found.where("not isTraining").count() == len(data) - cut


def test_too_few_rows_train_on_nothing(spark, day):
    frame = literal_rows(spark, [(1, day(1))], "clientID bigint, month date")
    assert split.train_test_split(frame).where("isTraining").count() == 0
