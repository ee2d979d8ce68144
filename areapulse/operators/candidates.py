"""Insight candidates: a monthly series with lags, z-scores, ranks and leaders."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from areapulse.functions.numbers import change, correlation, ratio, slope, zscore
from areapulse.functions.ordering import value_positions
from areapulse.operators.rollups import LEVELS, monthly, trend_levels
from areapulse.session import stage

COLUMNS = [
    "spatial_label", "date", "foot_traffic", "sales",
    "ft_prev", "ft_mom_pct", "ft_prev_year", "ft_yoy_pct",
    "sales_prev", "sales_mom_pct", "sales_prev_year", "sales_yoy_pct",
    "ft_avg", "sales_avg", "ft_std", "sales_std", "ft_zscore", "sales_zscore",
    "ft_avg_date", "sales_avg_date", "ft_rank", "sales_rank",
    "dominant_group", "dominant_share",
]
SHORT = {"foot_traffic": "ft", "sales": "sales"}


def lags(series: DataFrame, keys: list[str], steps: int, suffix: str, pct: str) -> DataFrame:
    """Value ``steps`` rows earlier in the series of ``keys``, and the change since.

    A row offset, not a calendar offset: a missing month shifts it. Rows of one
    date are in order of their type.
    """
    ties = ["spatial_type"] if "spatial_type" in series.columns else []
    order = Window.partitionBy(*keys).orderBy("date", *ties)
    before = {f"{s}_{suffix}": F.lag(c, steps).over(order) for c, s in SHORT.items()}
    rates = {f"{s}_{pct}": change(F.col(c), F.col(f"{s}_{suffix}")) for c, s in SHORT.items()}
    return series.withColumns(before).withColumns(rates)


def standardise(series: DataFrame, keys: list[str]) -> DataFrame:
    """Whole-series mean, sample deviation and z-score per ``keys``."""
    whole = Window.partitionBy(*keys)
    stats = {}
    for column, short in SHORT.items():
        stats[f"{short}_avg"] = F.avg(column).over(whole)
        stats[f"{short}_std"] = F.stddev_samp(column).over(whole)
    scores = {f"{s}_zscore": zscore(F.col(c), F.col(f"{s}_avg"), F.col(f"{s}_std")) for c, s in SHORT.items()}
    return series.withColumns(stats).withColumns(scores)


def series_columns(base: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Everything that depends on one label's own series (one row per month)."""
    keys = keys or ["spatial_label"]
    with_lags = lags(lags(base, keys, 1, "prev", "mom_pct"), keys, 12, "prev_year", "yoy_pct")
    return standardise(with_lags, keys)


def date_averages(base: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Mean of each measure over all labels of a date, with non-null counts."""
    stats = []
    for column, short in SHORT.items():
        stats += [F.avg(column).alias(f"{short}_avg_date"), F.count(column).alias(f"_{short}_known")]
    return base.groupBy(*(by or ["date"])).agg(*stats)


def with_date_averages(base: DataFrame) -> DataFrame:
    return base.join(date_averages(base), "date").drop("_ft_known", "_sales_known")


def with_date_columns(rows: DataFrame, base: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Mean and rank of both measures per date, without gathering a date in one window.

    Means and counts are aggregates, and ranks are positions in the value counts
    of the date (see :mod:`areapulse.functions.ordering`). Missing values share
    the rank after the last known one. ``by`` names what is compared with each
    other, a date by default.
    """
    by = by or ["date"]
    measures = base.unpivot(by, list(SHORT), "_measure", "_value")
    positions = value_positions(measures, ["_measure", *by], "_value", descending=True)
    ranked = rows.join(date_averages(base, by), by)
    for column, short in SHORT.items():
        place = positions.where(F.col("_measure") == column).select(
            *by, F.col("_value").alias(column), (F.col("before") + 1).alias("_place")
        )
        rank = F.coalesce("_place", F.col(f"_{short}_known") + 1).cast("long")
        ranked = ranked.join(place, [*by, column], "left").withColumn(f"{short}_rank", rank).drop("_place")
    return ranked.select(*rows.columns, *[f"{s}_{what}" for s in SHORT.values() for what in ("avg_date", "rank")])


def demographic_base(demographics: DataFrame, dim: DataFrame) -> DataFrame:
    """Demographic values summed per label, month, sex and age group."""
    per_key = (
        monthly(demographics)
        .groupBy("spatial_key", "date", "sex", "age_group")
        .agg(F.sum("value").alias("value"))
    )
    return (
        per_key.join(dim.select("spatial_key", "spatial_label"), "spatial_key")
        .groupBy("spatial_label", "date", "sex", "age_group")
        .agg(F.sum("value").alias("value"))
    )


def dominant_groups(demographics: DataFrame, dim: DataFrame) -> DataFrame:
    """Leading group and its share per label and month.

    Unknown values lead and ties go to the first sex and age group. One
    aggregate finds both the leader and the total.
    """
    base = demographic_base(demographics, dim)
    place = F.struct(
        F.col("value").isNotNull().alias("known"), (-F.col("value")).alias("v"), F.col("sex"), F.col("age_group")
    )
    leader = F.min_by(F.struct("sex", "age_group", "value"), place)
    return (
        base.groupBy("spatial_label", "date")
        .agg(leader.alias("_top"), F.sum("value").alias("_total"))
        .select(
            "spatial_label",
            "date",
            F.concat("_top.sex", F.lit("_"), "_top.age_group").alias("dominant_group"),
            ratio(F.col("_top.value"), F.col("_total")).alias("dominant_share"),
        )
    )


def candidates_of(gold, levels: tuple[str, ...], dedupe: bool | None = None) -> DataFrame:
    """The candidate columns of all ``levels`` with ``level``: one roll-up, one set of ranks and series for all."""
    spark = gold.activity.sparkSession
    base = trend_levels(gold, levels, dedupe).select("level", "spatial_label", "spatial_type", "date", "foot_traffic", "sales")
    # Ranks, means and series all start from the roll-up, so it is computed once.
    base = stage(spark, base, "trend_levels", ("date",))
    rows = with_date_columns(series_columns(base, ["level", "spatial_label"]), base, ["level", "date"])
    units = [level for level in levels if level in ("norm", "emd")]
    if units:
        # districts and provinces have no leading group
        leaders = dominant_groups(gold.demographics, gold.dim).withColumn("level", F.explode(F.array(*map(F.lit, units))))
        rows = rows.join(leaders, ["level", "spatial_label", "date"], "left")
    else:
        rows = rows.withColumns({
            "dominant_group": F.lit(None).cast("string"),
            "dominant_share": F.lit(None).cast("double"),
        })
    return rows.select("level", *COLUMNS)


def candidates(gold, level: str, dedupe: bool | None = None) -> DataFrame:
    """The 24 candidate columns at ``norm``, ``emd`` (units only), ``sig`` or ``sido``."""
    return candidates_of(gold, (level,), dedupe).select(*COLUMNS)


def candidates_all(gold, levels: tuple[str, ...] = LEVELS, dedupe: bool | None = None) -> DataFrame:
    """Candidates of several levels under one another, with their ``level``."""
    return candidates_of(gold, levels, dedupe)


def advanced(rows: DataFrame) -> DataFrame:
    """Correlation, slope and mean absolute z-scores per level and label."""
    return (
        rows.where(F.col("sales").isNotNull() & F.col("foot_traffic").isNotNull())
        .groupBy("level", "spatial_label")
        .agg(
            correlation(F.col("sales"), F.col("foot_traffic")).alias("corr_sales_foot_traffic"),
            slope(F.col("sales"), F.col("foot_traffic")).alias("sales_impact_slope"),
            F.avg(F.abs("sales_zscore")).alias("sales_impact_score"),
            F.avg(F.abs("ft_zscore")).alias("foot_traffic_impact_score"),
        )
    )


def advanced_input(gold, levels: tuple[str, ...] = LEVELS, dedupe: bool | None = None) -> DataFrame:
    """The candidate columns that :func:`advanced` reads, without ranks and leaders."""
    base = trend_levels(gold, levels, dedupe).select("level", "spatial_label", "date", "foot_traffic", "sales")
    return standardise(base, ["level", "spatial_label"])


def with_advanced(rows: DataFrame, measures: DataFrame, by_level: bool = True) -> DataFrame:
    """Attach the advanced measures by level and label, or by label alone."""
    if by_level:
        return rows.join(measures, ["level", "spatial_label"], "left")
    return rows.join(measures.drop("level"), "spatial_label", "left")
