"""Calendar expressions. A month is the DATE of its first day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_value(value: str | dt.date | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("date")


def month_start(date: Column) -> Column:
    return F.trunc(date, "MM")


def month_start_from_text(date: Column) -> Column:
    """The same day by way of the text ``yyyy-MM-01``."""
    return F.concat(F.date_format(date, "yyyy-MM"), F.lit("-01")).cast("date")


def shift_months(date: Column, months: int = 1) -> Column:
    return F.add_months(date, months)


def month_from_parts(year: Column, month: Column) -> Column:
    two_digits = F.lpad(month.cast("string"), 2, "0")
    return F.to_date(F.concat(year.cast("string"), F.lit("-"), two_digits, F.lit("-01")))


def epoch_ms(moment: Column) -> Column:
    """Milliseconds since 1970 of a zone-less timestamp, read as UTC whatever the session zone is."""
    start = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
    return F.timestamp_diff("MILLISECOND", start, moment.cast("timestamp_ntz"))


def epoch_ms_value(moment: dt.datetime) -> int:
    """The same for a driver-side value; a naive datetime is UTC."""
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=dt.timezone.utc)
    return (moment - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(milliseconds=1)
