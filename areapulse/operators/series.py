"""Baselines, uplift, volatility and trend over the series of one place.

Rows are summed to one per time first. Series are cut into blocks of time, which
carry over the few rows that a window looks back on, and whose moments are merged,
so that the history of one place is several tasks' work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from areapulse.functions.numbers import change, ratio
from areapulse.functions.ordering import in_blocks, numbered
from areapulse.functions.text import parse_date
from areapulse.operators.records import source_totals
from areapulse.session import stage

# Measure, time unit, baseline length and metrics per domain. An event
# domain has no fixed length; :func:`dynamic_baseline` serves it.
DOMAIN_CONFIG = {
    "telco": {"measure": "foot_traffic", "time_unit": "day", "baseline": 7,
              "metrics": ["uplift", "volatility", "rate_of_change"]},
    "sales": {"measure": "sales", "time_unit": "month", "baseline": 3,
              "metrics": ["uplift", "rate_of_change", "volatility"]},
}
KEYS = ["source", "spatial_key"]
TREND_POINTS = 3
BLOCK_ROWS = 65_536
#: Parts of windows that one task of a dynamic baseline joins, and rows of a series whose small blocks it adds up together.
PARTS_AT_ONCE = 1 << 20
CHUNK_ROWS = 1 << 14


def domain_series(records: DataFrame, config: dict = DOMAIN_CONFIG) -> DataFrame:
    """One value per source, place and time for the domains that have a measure."""
    value = F.lit(None).cast("double")
    for source, settings in config.items():
        value = F.when(F.col("source") == source, F.col(settings["measure"])).otherwise(value)
    return (
        source_totals(records)
        .where(F.col("source").isin(list(config)) & F.col("time_key").isNotNull())
        .select(*KEYS, "time_key", value.alias("current"), parse_date(F.col("time_key")).alias("_date"))
        .where(F.col("current").isNotNull())
    )


def in_time(keys: list[str] = KEYS) -> Window:
    return Window.partitionBy(*keys).orderBy("_date", "time_key")


def blocks_of(series: DataFrame, keys: list[str] = KEYS, before: int = 0, rows: int = BLOCK_ROWS) -> DataFrame:
    """The series in blocks of time, each with the last ``before`` rows ahead of it; a place's history is several tasks' work."""
    return in_blocks(series, keys, [F.col("_date").asc(), F.col("time_key").asc()], rows, before)


def trailing_mean(value: str, size: int, keys: list[str] = KEYS) -> Column:
    """Mean of the ``size`` values before the current one, in rows of :func:`blocks_of`; NULL if there are fewer.

    A series of one point is its own history.
    """
    before = in_time([*keys, "_block"]).rowsBetween(-size, -1)
    mean = F.when(F.count(value).over(before) == size, F.avg(value).over(before))
    if size == 1:
        mean = F.when(F.col("_place") == 0, F.col(value)).otherwise(mean)
    return mean


def dynamic_baseline(series: DataFrame, duration: str, value: str = "current", keys: list[str] = KEYS) -> DataFrame:
    """Mean of as many earlier values as the row's ``duration`` says.

    The series is added up in blocks of 1, 2, 4, ... rows, and a window of d rows
    is the sum of at most two blocks of each size: additions only, so that long
    series of large values lose no digits, and work in proportion to the logarithm
    of a duration.
    """
    order = [F.col("_date").asc(), F.col("time_key").asc()]
    spark = series.sparkSession
    placed = stage(spark, numbered(series, keys, order, "_row").withColumn("_series", F.struct(*keys)), "numbered_series")
    asked = (F.col(duration) > 0) & (F.col("_row") >= F.col(duration))
    longest = placed.where(asked).agg(F.max(duration)).first()[0] or 1
    levels = list(range(int(longest).bit_length()))

    def parts(level: int) -> Column:
        """The odd blocks at both ends of what is left of the window at a level."""
        size = 1 << level
        first, end = F.ceil((F.col("_row") - F.col(duration)) / size), F.floor(F.col("_row") / size)
        left = F.when((first < end) & (first % 2 == 1), first)
        right = F.when((first < end) & (end % 2 == 1), end - 1)
        return F.transform(
            F.filter(F.array(left.cast("long"), right.cast("long")), lambda b: b.isNotNull()),
            lambda b: F.struct(F.lit(level).alias("_level"), b.alias("_block")),
        )

    # every join and sum is dealt by its own key to tasks of a bounded size; files say little of how many rows they hold
    tasks = max(1, -(-placed.count() * len(levels) // PARTS_AT_ONCE))
    part, row = ["_series", "_level", "_block"], ["_series", "_row"]
    windows = placed.where(asked).select(*row, F.inline(F.concat(*[parts(n) for n in levels])))
    # a chunk holds whole blocks, and larger blocks are made of whole chunks
    chunks = placed.select("_series", F.floor(F.col("_row") / CHUNK_ROWS).cast("long").alias("_chunk"), "_row", F.col(value).alias("_value"))
    chunked = chunks.repartition(tasks, "_series", "_chunk")

    def of_levels(wanted: list[int]) -> Column:
        return F.inline(F.array(*[F.struct(F.lit(n).alias("_level"), F.floor(F.col("_row") / (1 << n)).cast("long").alias("_block")) for n in wanted]))

    top = CHUNK_ROWS.bit_length() - 1
    sums = chunked.select("_series", "_chunk", "_value", of_levels([n for n in levels if n <= top])).groupBy("_series", "_chunk", "_level", "_block").agg(
        F.sum("_value").alias("_part")).select(*part, "_part")
    higher = [n for n in levels if n > top]
    if higher:
        whole = chunked.groupBy("_series", "_chunk").agg(F.sum("_value").alias("_value")).withColumn("_row", F.col("_chunk") * CHUNK_ROWS)
        sums = sums.union(whole.select("_series", "_value", of_levels(higher)).groupBy(*part).agg(F.sum("_value").alias("_part")))
    met = windows.repartition(tasks, *part).join(sums.repartition(tasks, *part).hint("merge"), part)
    added = met.select(*row, "_part").repartition(tasks, *row).groupBy(*row).agg(F.sum("_part").alias("_sum"))
    own = (F.col("_row") == 0) & (F.col(duration) == 1)
    mean = ratio(F.col("_sum"), F.col(duration))
    return placed.repartition(tasks, *row).join(added.hint("merge"), row, "left").withColumn(
        "baseline", F.when(own, F.col(value)).otherwise(mean)
    ).select(*series.columns, "baseline")


def _moments(value: Column) -> list[Column]:
    """Count, mean and squared deviations, which can be merged."""
    return [F.count(value).alias("_n"), F.avg(value).alias("_mean"), (F.var_pop(value) * F.count(value)).alias("_spread")]


def volatility(blocks: DataFrame, value: str, keys: list[str] = KEYS) -> DataFrame:
    """Rows of :func:`blocks_of` with ``volatility``: population deviation over mean of all values to date; NULL below two points.

    Moments of whole blocks are merged over the blocks ahead, then with those of
    the rows to date inside the block. Deviations are taken from the mean of the
    place, so that merging loses no digits.
    """
    spark = blocks.sparkSession
    own = F.col(value)
    # equal structs may hold NULLs
    rows = blocks.withColumn("_series", F.struct(*keys))
    whole = stage(spark, rows.where("not _halo").groupBy("_series", "_block").agg(*_moments(own)), "block_moments")
    centre = whole.groupBy("_series").agg(F.try_divide(F.sum(F.col("_n") * F.col("_mean")), F.sum("_n")).alias("_centre"))
    earlier = Window.partitionBy("_series").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    off = F.col("_mean") - F.col("_centre")
    ahead = whole.join(centre, "_series").select(
        "_series", "_block", "_centre",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n0"),
        F.coalesce(F.sum(F.col("_n") * off).over(earlier), F.lit(0.0)).alias("_sum0"),
        F.coalesce(F.sum(F.col("_spread") + F.col("_n") * off * off).over(earlier), F.lit(0.0)).alias("_square0"),
    )
    to_date = in_time(["_series", "_block"]).rowsBetween(Window.unboundedPreceding, 0)
    here = F.when(~F.col("_halo"), own - F.col("_centre"))
    n = F.col("_n0") + F.count(here).over(to_date)
    total = F.col("_sum0") + F.coalesce(F.sum(here).over(to_date), F.lit(0.0))
    square = F.col("_square0") + F.coalesce(F.sum(here * here).over(to_date), F.lit(0.0))
    mean = total / n
    spread = F.sqrt(F.greatest(square / n - mean * mean, F.lit(0.0)))
    found = rows.join(ahead, ["_series", "_block"]).withColumn("volatility", F.when(n >= 2, ratio(spread, F.col("_centre") + mean)))
    return found.select(*blocks.columns, "volatility")


def domain_metrics(records: DataFrame, config: dict = DOMAIN_CONFIG, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Baseline, uplift, volatility and rate of change per source, place and time."""
    series = domain_series(records, config)

    def by_domain(pick) -> Column:
        choice = F.lit(None)
        for source, settings in config.items():
            choice = F.when(F.col("source") == source, pick(settings)).otherwise(choice)
        return choice

    def only_where(metric: str, column: Column) -> Column:
        return by_domain(lambda s: column if metric in s["metrics"] else F.lit(None).cast("double"))

    reach = max(1, *[s["baseline"] for s in config.values()])
    blocks = stage(series.sparkSession, blocks_of(series, KEYS, reach, block_rows), "series_blocks")
    rows = volatility(blocks, "current").withColumns({
        "baseline": by_domain(lambda s: trailing_mean("current", s["baseline"])),
        "_previous": F.lag("current").over(in_time([*KEYS, "_block"])),
        "volatility": only_where("volatility", F.col("volatility")),
        "time_unit": by_domain(lambda s: F.lit(s["time_unit"])),
    }).where("not _halo")
    return rows.select(
        *KEYS, "time_key", "baseline", "current", "time_unit",
        only_where("uplift", change(F.col("current"), F.col("baseline"))).alias("uplift"),
        only_where("rate_of_change", change(F.col("current"), F.col("_previous"))).alias("rate_of_change"),
        "volatility",
    )


def trend(rows: DataFrame, value: str, keys: list[str], time: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Slope and direction over the latest three known values of each series; NULL for an unknown one."""
    placed = rows.withColumns({"_date": parse_date(F.col(time)), "_known": F.col(value).isNotNull()})
    series = [*keys, "_known"]
    blocks = in_blocks(placed, series, [F.col("_date").asc_nulls_first(), F.col(time).asc()], block_rows, TREND_POINTS - 1)
    order = Window.partitionBy(*series, "_block").orderBy("_place")
    latest = order.rowsBetween(1 - TREND_POINTS, 0)
    y, x = F.col(value), F.col("_place").cast("double")
    slope = F.try_divide(F.regr_sxy(y, x).over(latest), F.regr_sxx(y, x).over(latest))
    limit = F.greatest(F.lit(1e-6), F.abs(F.avg(y).over(latest)) * 0.01)
    found = blocks.withColumns({"slope": slope, "_limit": limit}).where("not _halo").withColumn(
        "direction",
        F.when(F.col("slope") > F.col("_limit"), "increase")
        .when(F.col("slope") < -F.col("_limit"), "decrease")
        .when(F.col("slope").isNotNull(), "stable"),
    )
    return found.select(*rows.columns, "slope", "direction")


def composition_shift(before: DataFrame, after: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Relative change of each part between two compositions."""
    later = after.select(*keys, F.col(value).alias("_after"))
    return before.join(later, keys, "left").select(
        *keys, change(F.col("_after"), F.col(value)).alias("shift")
    )


def elasticity(traffic_uplift: Column, sales_uplift: Column) -> Column:
    return ratio(sales_uplift, traffic_uplift)
