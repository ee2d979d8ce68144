"""Period texts: a year, a month or a day."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from areapulse.functions.text import month_start

YEAR = r"^\d{4}$"


def parse_period(text: Column, prefer_end: bool = False) -> Column:
    """``YYYY`` to its first or last day, ``YYYY-MM`` to day 1, a full date as it is."""
    t = F.trim(text)
    edge = "1231" if prefer_end else "0101"
    return F.coalesce(
        F.when(t.rlike(YEAR), F.try_to_date(F.concat(t, F.lit(edge)), "yyyyMMdd")),
        F.when(t.rlike(r"^\d{4}-\d{2}$"), F.try_to_date(F.concat(t, F.lit("-01")), "yyyy-MM-dd")),
        F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(t, "yyyy-MM-dd")),
        F.when(t.rlike(r"^\d{8}$"), F.try_to_date(t, "yyyyMMdd")),
    )


def period_range(period_from: Column, period_to: Column) -> tuple[Column, Column]:
    """Start and end of a range, swapped when given in reverse."""
    start, end = parse_period(period_from), parse_period(period_to, prefer_end=True)
    reverse = start > end
    return (
        F.when(reverse, end).otherwise(start),
        F.when(reverse, start).otherwise(end),
    )


def single_period(date_start: Column, date_end: Column) -> Column:
    """The end of a request's range, else its start, moved to the month's first day."""
    return month_start(F.coalesce(parse_period(date_end), parse_period(date_start)))


def between(date: Column, start: str | None, end: str | None) -> Column:
    """Inclusive range test with open ends; the bounds are constants to the optimizer."""
    low, high = period_range(F.lit(start).cast("string"), F.lit(end).cast("string"))
    test = F.lit(True)
    if start:
        test = test & (low.isNull() | (date >= low))
    if end:
        test = test & (high.isNull() | (date <= high))
    return test
