"""Guarded arithmetic: nothing here raises on text, zero or constant input."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def parse_number(text: Column) -> Column:
    """Text to double; NULL for anything that is not a finite number.

    The form is checked before the cast: a failing cast raises and catches an
    exception per value, and it would let through ``NaN``, ``inf`` and ``1d``.
    """
    t = F.trim(text.cast("string"))
    value = F.when(t.rlike(NUMBER), t.try_cast("double"))
    return F.nullif(F.nullif(value, F.lit(float("inf"))), F.lit(float("-inf")))


def to_number(text: Column) -> Column:
    """Text to double with anything that is not a number counted as 0."""
    return F.coalesce(parse_number(text), F.lit(0.0))


def sum_columns(columns: list[str]) -> Column:
    """Row-wise sum of text measure columns (0.0 for an empty list)."""
    return reduce(lambda a, b: a + b, [to_number(F.col(f"`{c}`")) for c in columns], F.lit(0.0))


def change(current: Column, previous: Column) -> Column:
    """(current - previous) / previous; NULL when previous is NULL or 0."""
    return F.try_divide(current - previous, previous)


def ratio(part: Column, whole: Column) -> Column:
    return F.try_divide(part, whole)


def zscore(value: Column, mean: Column, std: Column) -> Column:
    return F.try_divide(value - mean, std)


def correlation(y: Column, x: Column) -> Column:
    """Pearson correlation; NULL when either side is constant."""
    return F.try_divide(F.regr_sxy(y, x), F.sqrt(F.regr_sxx(y, x) * F.regr_syy(y, x)))


def slope(y: Column, x: Column) -> Column:
    """Least squares slope of y on x; NULL when x is constant."""
    return F.try_divide(F.regr_sxy(y, x), F.regr_sxx(y, x))


def drop_nan(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def fixed_point(value: Column, places: int) -> Column:
    """Plain decimal text; ties are judged on the exact value and go to the even digit."""
    return F.call_function("format_number", value, F.lit("0." + "0" * places))
