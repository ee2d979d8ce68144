"""Running sums and exact order statistics without a whole group in one task.

Rows are range-partitioned once by (group, order), so that a group with a third of
all rows lies in many partitions. Totals per group and partition, at most as many
rows as there are groups and partitions together, give what lies ahead of each
partition; the rest is a window inside one group's part of a partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from areapulse.session import stage

#: How a running value and what lies ahead of its partition become one.
MERGES = {
    "sum": lambda ahead, here: F.coalesce(ahead, F.lit(0)) + here,
    "bit_xor": lambda ahead, here: F.coalesce(ahead, F.lit(0).cast("long")).bitwiseXOR(here),
}
RANGE = "_range"
#: Rows that one task may merge and hand on.
AT_ONCE = 10_000


def in_ranges(df: DataFrame, groups: list[str], order: list[Column], name: str = "ranges") -> DataFrame:
    """``df`` stored in ranges of (group, order) with the number of each row's range as ``_range``.

    Equal rows share a range. Which range a row falls into is sampled, so the rows
    are stored before several branches of a plan read them.
    """
    keys = [F.col(f"`{g}`").asc() for g in groups]
    return stage(df.sparkSession, df.repartitionByRange(*keys, *order).withColumn(RANGE, F.spark_partition_id()), name)


def running(
    ranged: DataFrame, groups: list[str], order: list[Column], measures: dict[str, tuple[str, str]], totals: dict[str, str] | None = None,
) -> DataFrame:
    """Rows of :func:`in_ranges` with running values per group, up to and with each row, in a total order.

    ``measures`` names a new column and gives the merge and the column it runs
    over; ``totals`` names columns for the whole group's sum of a measure.
    """
    totals = totals or {}
    merged = lambda how, column: getattr(F, how)(column)
    columns = [c for c in ranged.columns if c != RANGE]
    # equal structs may hold NULLs, so that a NULL group is met like any other
    rows = ranged.select(F.struct(*groups).alias("_group"), RANGE, *[c for c in columns if c not in groups])
    keys = ["_group", RANGE]
    parts = rows.groupBy(*keys).agg(*[merged(how, column).alias(name) for name, (how, column) in measures.items()])
    earlier = Window.partitionBy("_group").orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_group")
    ahead = parts.select(
        *keys,
        *[merged(how, F.col(name)).over(earlier).alias(f"_ahead_{name}") for name, (how, _) in measures.items()],
        *[F.sum(measure).over(whole).alias(name) for name, measure in totals.items()],
    )
    here = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.join(ahead, keys).select(
        *[F.col(f"_group.{c}").alias(c) if c in groups else F.col(c) for c in columns], *totals,
        *[MERGES[how](F.col(f"_ahead_{name}"), merged(how, F.col(f"`{column}`")).over(here)).alias(name) for name, (how, column) in measures.items()],
    )


def numbered(df: DataFrame, groups: list[str], order: list[Column], number: str = "position") -> DataFrame:
    """``df`` with the place of each row in its group, from 0 on; ``order`` must be total but for equal rows."""
    one = in_ranges(df.withColumn("_one", F.lit(1).cast("long")), groups, order)
    return running(one, groups, order, {number: ("sum", "_one")}).withColumn(number, F.col(number) - 1).drop("_one")


def leading(df: DataFrame, order: list[Column], count: int, at_once: int = AT_ONCE) -> DataFrame:
    """The first ``count`` rows in a total order, in no order.

    A few are merged from the first of every task. More are found by their places:
    rows per range tell in which range the last one lies, and the rows stay where
    they are, in as many partitions as they need.
    """
    if count <= at_once:
        return df.orderBy(*order).limit(count)
    placed = numbered(df.withColumn("_all", F.lit(0)), ["_all"], order, "_place")
    return placed.where(F.col("_place") < count).drop("_all", "_place")


def in_blocks(df: DataFrame, groups: list[str], order: list[Column], rows: int, before: int) -> DataFrame:
    """``df`` in blocks of at most ``rows`` rows of a group that follow each other, with ``_block`` and ``_halo``.

    The last ``before`` rows of a block also come, marked by ``_halo``, with the
    next one, so that a window inside a block sees that many rows back.
    """
    if before > rows:
        raise ValueError("a window may not reach back further than a block")
    placed = numbered(df, groups, order, "_place")
    number, at = F.floor(F.col("_place") / rows).cast("long"), F.pmod(F.col("_place"), F.lit(rows))
    copies = F.array(F.struct(number.alias("_block"), F.lit(False).alias("_halo")))
    if before:
        again = F.array(F.struct((number + 1).alias("_block"), F.lit(True).alias("_halo")))
        copies = F.when(at >= rows - before, F.concat(copies, again)).otherwise(copies)
    return placed.select(*df.columns, "_place", F.inline(copies))


def value_positions(df: DataFrame, groups: list[str], value: str, descending: bool = False) -> DataFrame:
    """One row per (group, non-null value): its ``copies``, rows ``before`` it, and the ``size`` of its group.

    Equal values are counted together first, with map-side combine.
    """
    order = [F.col(value).desc() if descending else F.col(value).asc()]
    counts = df.where(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.count(F.lit(1)).alias("copies"))
    placed = running(in_ranges(counts, groups, order, "values"), groups, order, {"_upto": ("sum", "copies")}, {"size": "_upto"})
    return placed.select(*groups, value, "copies", "size", (F.col("_upto") - F.col("copies")).alias("before"))


def group_medians(df: DataFrame, groups: list[str], value: str) -> DataFrame:
    """Exact median of the non-null values per group, as ``median``."""
    low, high = F.floor((F.col("size") - 1) / 2), F.floor(F.col("size") / 2)
    holds: Column = lambda place: (F.col("before") <= place) & (place < F.col("before") + F.col("copies"))
    return (
        value_positions(df, groups, value)
        .where(holds(low) | holds(high))
        .groupBy(*groups)
        .agg(((F.min(value) + F.max(value)) / 2).alias("median"))
    )
