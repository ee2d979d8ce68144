"""Registration of queries with their SQL, and the rounding both sides share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def round_double(value: Column) -> Column:
    """Two places from 1000 on, five below; never a negative zero.

    Sums are added in no fixed order, so the last bits differ between engines.
    The small shift keeps values that end exactly half-way, such as means of
    prices, off the rounding boundary. ``sqltext.round_double`` says the same.
    """
    large = F.round(value + 0.00137, 2)
    small = F.round(value + 0.00000137, 5)
    return F.when(F.abs(value) >= 1000, large).otherwise(small) + 0.0


def rounded(df: DataFrame) -> DataFrame:
    return df.select(*[
        round_double(F.col(f"`{f.name}`")).alias(f.name)
        if isinstance(f.dataType, T.DoubleType)
        else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is the statement that must give the same rows."""

    def add(query: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: rounded(query(spark, sf_dir))
        if sql is not None:
            SQL[name] = sql
        return query

    return add
