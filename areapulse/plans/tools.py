"""The parameterised analysis tools: rankings, comparison, anomalies, look-ups."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from areapulse.functions.ordering import leading
from areapulse.functions.periods import between, parse_period
from areapulse.operators import candidates as cand
from areapulse.operators.rollups import LEVELS, demographic_share, monthly, trend, year_on_year
from areapulse.session import stage

METRICS = {"activity_volume": "foot_traffic", "foot_traffic": "foot_traffic", "sales": "sales"}
DOMAINS = {"population": "foot_traffic", "sales": "sales"}
SHORT = cand.SHORT
DEFAULT_LEVEL = "sig"


def _level(level: str | None) -> str:
    level = level or DEFAULT_LEVEL
    if level not in (*LEVELS, "emd"):
        raise ValueError("level must be one of: norm, emd, sig, sido")
    return level


def _domains(domains: list[str]) -> list[str]:
    valid = [d for d in domains if d in DOMAINS]
    if not valid:
        raise ValueError("domains must include at least one of: population, sales")
    return valid


def series_at(gold, level: str, region: str | None = None) -> DataFrame:
    """The roll-up of a level from the shared tables, or from itself if it is already at hand."""
    rows = gold if isinstance(gold, DataFrame) else trend(gold, level).select("spatial_label", "spatial_type", "date", "foot_traffic", "sales")
    return rows if region is None else rows.where(F.col("spatial_label") == region)


def resolve_period(rows: DataFrame, period: str) -> DataFrame:
    """One row with the date a period means: for a year, its latest date with data."""
    text = period.strip()
    wanted = parse_period(F.lit(text))
    if len(text) == 4 and text.isdigit():
        return rows.where(F.year("date") == int(text)).agg(F.max("date").alias("date"))
    return rows.sparkSession.range(1).select(wanted.alias("date"))


def latest_by_year(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The date each year means, per group: what ``YYYY`` resolves to."""
    return rows.groupBy(*keys, F.year("date").alias("year")).agg(F.max("date").alias("date"))


def _on_period(rows: DataFrame, period: str) -> DataFrame:
    """Rows of the resolved date, for a year the latest one among ``rows``; it stays a scalar subquery of the plan."""
    text = period.strip()
    if len(text) == 4 and text.isdigit():
        return rows.where(F.col("date") == resolve_period(rows, text).scalar())
    if not re.fullmatch(r"\d{4}-\d{2}(-\d{2})?|\d{8}", text):
        raise ValueError("a period is a year, a month (YYYY-MM) or a day")
    digits = text.replace("-", "").ljust(8, "x").replace("xx", "01")
    return rows.where(F.col("date") == F.lit(datetime.strptime(digits, "%Y%m%d").date()))


def rankings(gold, metric: str, period: str, top_k: int = 10, level: str | None = None) -> DataFrame:
    """The ``top_k`` leading labels of one date, however many are asked for; ties are listed by label."""
    if metric not in METRICS:
        raise ValueError("metric must be one of: activity_volume, foot_traffic, sales")
    if top_k <= 0:
        raise ValueError("top_k must be greater than 0")
    column = METRICS[metric]
    rows = _on_period(series_at(gold, _level(level)), period)
    order = [F.col("value").desc_nulls_last(), F.col("spatial_label").asc()]
    values = rows.select("spatial_label", "date", F.lit(column).alias("metric"), F.col(column).alias("value"))
    return leading(values, order, top_k).orderBy(*order)


def latest_row(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """The columns of the latest date per group, as one aggregate."""
    latest = F.max_by(F.struct("date", *columns), "date").alias("_latest")
    return rows.groupBy(*keys).agg(latest).select(*keys, "_latest.*")


# The words of the two functions below are fixed values of the tool interface.
def trend_word(rate: Column) -> Column:
    return F.when(rate > 0, "up").when(rate < 0, "down").otherwise("flat")


def signal_word(rate: Column) -> Column:
    size = F.abs(rate)
    return (
        F.when(rate.isNull(), "insufficient_data")
        .when(size >= 0.2, "strong_change")
        .when(size >= 0.05, "moderate_change")
        .otherwise("minor_change")
    )


def compare_domains(
    gold,
    domains: list[str],
    period_from: str | None = None,
    period_to: str | None = None,
    region: str | None = None,
    level: str | None = None,
) -> DataFrame:
    """Direction and strength of each domain's latest monthly change.

    For one region there is a row per domain even without data; without a region
    every label is compared.
    """
    chosen = _domains(domains)
    rows = cand.lags(series_at(gold, _level(level), region), ["spatial_label"], 1, "prev", "mom_pct")
    rows = rows.where(between(F.col("date"), period_from, period_to))
    keys = [] if region else ["spatial_label"]
    latest = latest_row(rows, keys, ["ft_mom_pct", "sales_mom_pct"])
    if region:
        latest = latest.withColumn("spatial_label", F.lit(region))
    rates = F.array(*[
        F.struct(
            F.lit(d).alias("domain"),
            F.lit(DOMAINS[d]).alias("metric"),
            F.col(f"{SHORT[DOMAINS[d]]}_mom_pct").alias("change_rate"),
        )
        for d in chosen
    ])
    rate = F.col("change_rate")
    return latest.select("spatial_label", F.inline(rates)).select(
        "spatial_label", "domain", "metric",
        trend_word(rate).alias("trend"), "change_rate", signal_word(rate).alias("signal"),
    )


def detect_anomaly(
    gold,
    domain: str,
    region: str | None = None,
    period: str | None = None,
    z_threshold: float = 2.0,
    level: str | None = None,
) -> DataFrame:
    """Value, z-score and flag; every label and date unless narrowed down."""
    if domain not in DOMAINS:
        raise ValueError("domain must be one of: population, sales")
    if z_threshold <= 0:
        raise ValueError("z_threshold must be greater than 0")
    metric = DOMAINS[domain]
    rows = cand.standardise(series_at(gold, _level(level), region), ["spatial_label"]).select(
        "spatial_label", "date", F.col(metric).alias("value"), F.col(f"{SHORT[metric]}_zscore").alias("zscore")
    )
    if period:
        rows = _on_period(rows, period)
    if region and period:
        rows = rows.agg(F.max("date").alias("date"), F.max("value").alias("value"), F.max("zscore").alias("zscore"))
        rows = rows.withColumn("spatial_label", F.lit(region))
    return rows.select(
        "spatial_label", F.lit(metric).alias("metric"), "date", "value", "zscore",
        F.lit(float(z_threshold)).alias("threshold"),
        F.coalesce(F.abs("zscore") >= z_threshold, F.lit(False)).alias("is_anomaly"),
    )


def advanced_insight(gold, domains: list[str], region: str | None = None, level: str | None = None) -> DataFrame:
    """Correlation and impact measures; a period does not change them."""
    chosen = ",".join(_domains(domains))
    level = _level(level)
    base = series_at(gold, level, region)
    rows = cand.standardise(base, ["spatial_label"]).withColumn("level", F.lit(level))
    return cand.advanced(rows).withColumn("domains", F.lit(chosen))


def report(
    gold, region: str, period_from: str | None, period_to: str | None, level: str | None = None
) -> dict[str, DataFrame]:
    """The four tool results for one region, as separate frames.

    Anomaly and ranking look at the month the period ends in (the latest month
    with data when it ends with a year). The roll-up is stored once for all four.
    """
    end = (period_to or period_from or "").strip()
    if not end:
        raise ValueError("period is required")
    month = end[:7] if "-" in end else end
    both, series = list(DOMAINS), stage(gold.activity.sparkSession, series_at(gold, _level(level)), "report_series")
    return {
        "compare_domains": compare_domains(series, both, period_from, period_to, region, level),
        "detect_anomaly": detect_anomaly(series, "sales", region, month, level=level),
        "get_rankings": rankings(series, "sales", month, 10, level),
        "get_advanced_insight": advanced_insight(series, both, region, level),
    }


def report_rows(parts: dict[str, DataFrame]) -> DataFrame:
    """A report as (section, item, value) rows."""
    compare, anomaly = parts["compare_domains"], parts["detect_anomaly"]
    ranks, measures = parts["get_rankings"], parts["get_advanced_insight"]

    def section(df: DataFrame, name: str, item: Column, value: Column) -> DataFrame:
        return df.select(F.lit(name).alias("section"), item.alias("item"), value.cast("double").alias("value"))

    return (
        section(compare, "compare_domains", F.concat_ws(":", "domain", "trend", "signal"), F.col("change_rate"))
        .unionByName(section(anomaly, "detect_anomaly", F.concat_ws(":", "metric", F.col("is_anomaly").cast("string")), F.col("zscore")))
        .unionByName(section(ranks, "get_rankings", F.col("spatial_label"), F.col("value")))
        .unionByName(
            measures.unpivot(
                [], ["corr_sales_foot_traffic", "sales_impact_slope", "sales_impact_score", "foot_traffic_impact_score"],
                "item", "value",
            ).select(F.lit("get_advanced_insight").alias("section"), "item", "value")
        )
    )


def _place_filter(df: DataFrame, dim: DataFrame, spatial_key: str | None, spatial_label: str | None) -> DataFrame:
    """Filter a keyed frame by key, or by the label its key has in the dimension."""
    if spatial_key:
        return df.where(F.col("spatial_key") == spatial_key)
    if spatial_label:
        keys = dim.where(F.col("spatial_label") == spatial_label).select("spatial_key")
        return df.join(keys, "spatial_key", "left_semi")
    return df


def time_series(
    gold,
    query_type: str = "trend",
    level: str = "norm",
    spatial_key: str | None = None,
    spatial_label: str | None = None,
    start: str | None = None,
    end: str | None = None,
    sex: str | None = None,
    age_like: str | None = None,
) -> DataFrame:
    """Rows of the trend, year-on-year or demographic share view under filters, by date."""
    if query_type == "yoy":
        rows = _place_filter(year_on_year(gold.activity), gold.dim, spatial_key, spatial_label)
        return rows.where(between(F.col("date"), start, end)).orderBy("date", "spatial_key")
    if query_type == "demographics":
        rows = _place_filter(demographic_share(gold.demographics), gold.dim, spatial_key, spatial_label)
        rows = rows.where(between(F.col("date"), start, end))
        if sex:
            rows = rows.where(F.col("sex") == sex)
        if age_like:
            rows = rows.where(F.col("age_group").like(age_like))
        return rows.orderBy("date", "spatial_key", "sex", "age_group")
    if query_type != "trend":
        raise ValueError("query type must be one of: trend, yoy, demographics")
    place = spatial_label or spatial_key
    rows = trend(gold, level)
    rows = rows.where(between(F.col("date"), start, end))
    return (rows.where(F.col("spatial_label") == place) if place else rows).orderBy("date", "spatial_label")


def insight_rows(
    gold, level: str = "norm", place: str | None = None, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Candidate rows of a level under filters, by date."""
    rows = cand.candidates(gold, level)
    rows = rows.where(between(F.col("date"), start, end))
    return (rows.where(F.col("spatial_label") == place) if place else rows).orderBy("date", "spatial_label")


def top_labels(
    gold, level: str = "norm", place: str | None = None, start: str | None = None, end: str | None = None, top: int = 10
) -> DataFrame:
    """Labels with the most foot traffic over the filtered dates."""
    rows = trend(gold, level).where(between(F.col("date"), start, end))
    if place:
        rows = rows.where(F.col("spatial_label") == place)
    return (
        rows.groupBy("spatial_label")
        .agg(F.sum("foot_traffic").alias("foot_traffic"), F.sum("sales").alias("sales"))
        .orderBy(F.col("foot_traffic").desc_nulls_last(), "spatial_label")
        .limit(top)
    )


def geo_totals(
    gold,
    level: str = "norm",
    spatial_label: str | None = None,
    spatial_key: str | None = None,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Mean position (over fact rows) and measure totals per label.

    Facts are summed per key first; the number of rows of a key weighs its
    coordinates.
    """
    facts = (
        monthly(gold.activity)
        .where(between(F.col("date"), start, end))
        .groupBy("spatial_key")
        .agg(F.sum("foot_traffic").alias("foot_traffic"), F.sum("sales").alias("sales"), F.count(F.lit(1)).alias("_n"))
    )
    dim = gold.dim.select("spatial_key", F.col("spatial_label").alias("_label"), "code", "lat", "lon")
    admin = gold.admin_sig.select("sig_code", "sig_name", "sido_name")
    rows = facts.join(dim, "spatial_key", "left").join(admin, F.substring("code", 1, 5) == F.col("sig_code"), "left")
    if spatial_label:
        rows = rows.where(F.col("_label") == spatial_label)
    elif spatial_key:
        rows = rows.where((F.col("_label") == spatial_key) | (F.col("spatial_key") == spatial_key))
    names = {"sido": ["sido_name"], "sig": ["sig_name"]}.get(level, [])
    label = F.coalesce(*names, "_label", "spatial_key")

    def mean_position(column: str) -> Column:
        weight = F.when(F.col(column).isNotNull(), F.col("_n"))
        return F.try_divide(F.sum(F.col(column) * F.col("_n")), F.sum(weight)).alias(column)

    return rows.groupBy(label.alias("spatial_label")).agg(
        mean_position("lat"), mean_position("lon"),
        F.sum("foot_traffic").alias("foot_traffic"), F.sum("sales").alias("sales"),
    )
