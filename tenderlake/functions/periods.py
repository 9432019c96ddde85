"""Reference months held as ``yyyyMM`` strings, whose order is the calendar order."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: format of a period.
PERIOD_PATTERN = r"^\d{4}(0[1-9]|1[0-2])$"


def is_period(c: Column) -> Column:
    return c.rlike(PERIOD_PATTERN)


def first_day(period: Column) -> Column:
    return F.make_date(F.substring(period, 1, 4).cast("int"), month(period).cast("int"), F.lit(1))


def shift(period: Column, months: Column | int) -> Column:
    """The period ``months`` later (earlier when negative), in integer arithmetic."""
    at = index(period) + months
    year = F.floor(at / 12).cast("int")
    return F.lpad((year * 100 + at - year * 12 + 1).cast("string"), 6, "0")


def from_date(day: Column) -> Column:
    return F.date_format(day, "yyyyMM")


def index(period: Column) -> Column:
    """Months since year 0, so that differences count months."""
    return F.substring(period, 1, 4).cast("int") * 12 + month(period).cast("int") - 1


def month(period: Column) -> Column:
    return F.substring(period, 5, 2)


def span(start: Column, end: Column) -> Column:
    """Array with the first day of every period from ``start`` to ``end``; inverted bounds fail."""
    inverted = F.raise_error(F.concat_ws(" ", F.lit("inverted period range:"), start, end))
    months = F.sequence(first_day(start), first_day(end), F.expr("interval 1 month"))
    return F.when(start > end, inverted.cast("array<date>")).otherwise(months)


def parse(period: str) -> str:
    """Validate a job argument."""
    if not re.match(PERIOD_PATTERN, period):
        raise ValueError(f"{period!r} is not a period: four digits of the year, two of the month")
    return period


def listing(start: str, end: str) -> list[str]:
    """Periods named by two job arguments."""
    parse(start), parse(end)
    if start > end:
        raise ValueError(f"the range would end ({end}) before it starts ({start})")
    first, last = (int(p[:4]) * 12 + int(p[4:]) - 1 for p in (start, end))
    return [f"{m // 12:04d}{m % 12 + 1:02d}" for m in range(first, last + 1)]
