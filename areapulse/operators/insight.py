"""Insight records: impact, correlation, leading groups, highlights, narrative."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from areapulse.functions.numbers import correlation, fixed_point, ratio
from areapulse.operators.records import fuse, normalise, source_label
from areapulse.operators.series import domain_metrics, trend
from areapulse.session import stage

BUCKET = ["spatial_key", "time_key"]
TOP_GROUPS = 5


def impact_class(score: Column) -> Column:
    return F.when(score >= 0.2, "high").when(score >= 0.05, "moderate").when(score.isNotNull(), "low")


def _impact_columns() -> list[Column]:
    return [F.avg("uplift").alias("impact_score"), F.count("uplift").alias("impact_sources")]


def _with_impact_class(rows: DataFrame) -> DataFrame:
    return rows.withColumns({
        "classification": impact_class(F.col("impact_score")),
        "cross_domain_score": F.when(F.col("impact_sources") >= 2, F.col("impact_score")),
    })


def impact(metrics: DataFrame) -> DataFrame:
    """Mean uplift per bucket, its class, and the score of buckets with two domains or more."""
    return _with_impact_class(metrics.groupBy(*BUCKET).agg(*_impact_columns()))


def correlation_strength(value: Column) -> Column:
    size = F.abs(value)
    return F.when(size >= 0.75, "strong").when(size >= 0.4, "moderate").when(value.isNotNull(), "weak")


def with_correlation(buckets: DataFrame) -> DataFrame:
    """Correlation of foot traffic and sales over all buckets of a place, on each of them.

    Places are added up first and met by their buckets, so that none is one task's.
    """
    both = F.col("foot_traffic").isNotNull() & F.col("sales").isNotNull()
    y, x = F.when(both, F.col("foot_traffic")), F.when(both, F.col("sales"))
    places = buckets.groupBy(F.col("spatial_key").alias("_place")).agg(
        F.count(y).alias("sample_size"), F.when(F.count(y) >= 3, correlation(y, x)).alias("correlation")
    )
    met = buckets.join(places, F.col("spatial_key").eqNullSafe(F.col("_place")), "left").drop("_place")
    return met.withColumn("interpretation", correlation_strength(F.col("correlation")))


def place_correlation(buckets: DataFrame) -> DataFrame:
    """Correlation of foot traffic and sales over the buckets of a place."""
    known = buckets.where(F.col("foot_traffic").isNotNull() & F.col("sales").isNotNull())
    return known.groupBy("spatial_key").agg(
        F.count(F.lit(1)).alias("sample_size"),
        correlation(F.col("foot_traffic"), F.col("sales")).alias("_r"),
    ).select(
        "spatial_key", "sample_size",
        F.when(F.col("sample_size") >= 3, F.col("_r")).alias("correlation"),
    ).withColumn("interpretation", correlation_strength(F.col("correlation")))


def group_values(records: DataFrame) -> DataFrame:
    """Sum of each demographic group per bucket, over all records; added up in tasks before the shuffle."""
    return (
        records.select(*BUCKET, F.explode("population.demographics").alias("group", "value"))
        .groupBy(*BUCKET, "group")
        .agg(F.sum("value").alias("value"))
    )


def leading_groups(records: DataFrame, top: int = TOP_GROUPS) -> DataFrame:
    """Dominant group, its share, and the ``top`` largest groups per bucket.

    The total is an aggregate and only the leading rows are gathered: a row-number
    filter drops the others before the shuffle, so a bucket may have any number
    of groups.
    """
    values = group_values(records)
    order = Window.partitionBy(*BUCKET).orderBy(F.col("value").desc_nulls_first(), "group")
    leading = values.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= top)
    lists = leading.groupBy(*BUCKET).agg(F.array_sort(F.collect_list(F.struct("_place", "group", "value"))).alias("_groups"))
    totals = values.groupBy(*BUCKET).agg(F.sum("value").alias("_total"))
    return lists.join(totals, BUCKET).select(
        *BUCKET,
        F.col("_groups")[0]["group"].alias("dominant_group"),
        ratio(F.col("_groups")[0]["value"], F.col("_total")).alias("dominant_share"),
        F.transform("_groups", lambda g: F.struct(g["group"].alias("group"), g["value"].alias("value"))).alias("top_groups"),
    )


def listed_demographics(records: DataFrame, limit: int | None = None) -> DataFrame:
    """The demographic maps of each record of a bucket in order; with ``limit``, the first of them. No measure reads this list."""
    order = Window.partitionBy(*BUCKET).orderBy(
        "source", F.to_json("population.demographics"), "population.foot_traffic", "economic.sales"
    )
    rows = records.where(F.size("population.demographics") > 0).withColumn("_place", F.row_number().over(order))
    kept = rows if limit is None else rows.where(F.col("_place") <= limit)
    return kept.select(*BUCKET, F.col("population.demographics").alias("demographics"), "_place")


def bucket_summary(records: DataFrame, limit: int | None = None) -> DataFrame:
    """Totals, sources and the listed demographics of each bucket."""
    lists = listed_demographics(records, limit).groupBy(*BUCKET).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("_place", F.map_entries("demographics").alias("_entries")))),
            lambda r: F.map_from_entries(r["_entries"]),
        ).alias("demographics")
    )
    return fuse(records).withColumn("source", source_label(F.col("sources"))).join(lists, BUCKET, "left")


def highlights(metrics: DataFrame) -> DataFrame:
    """Known volatility and rate of change per domain, as a list per bucket, with its impact.

    A bucket has one metrics row per domain.
    """
    known = F.col("volatility").isNotNull() | F.col("rate_of_change").isNotNull()
    entry = F.struct(F.col("source").alias("domain"), "rate_of_change", "volatility")
    return _with_impact_class(metrics.groupBy(*BUCKET).agg(
        *_impact_columns(),
        F.array_sort(F.collect_list(F.when(known, entry))).alias("metrics_summary"),
        F.min_by("time_unit", "source").alias("temporal_unit"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("source", F.struct(
            "baseline", "current", "uplift", "volatility", "rate_of_change", "time_unit"
        ).alias("values"))))).alias("metrics"),
    ))


def two_places(value: Column) -> Column:
    return fixed_point(value, 2)


def narrative() -> Column:
    """One sentence from the structured fields.

    Its words are fixed values: they are the report's wording.
    """
    none = F.lit("None")
    first = F.try_element_at("metrics_summary", F.lit(1))
    parts = F.concat_ws(
        "/",
        F.when(first["rate_of_change"].isNotNull(), F.concat(F.lit("Δ="), two_places(first["rate_of_change"]))),
        F.when(first["volatility"].isNotNull(), F.concat(F.lit("vol="), two_places(first["volatility"]))),
    )
    linked = F.when(
        F.col("correlation").isNotNull(),
        F.concat(two_places(F.col("correlation")), F.lit(" ("), "interpretation", F.lit(")")),
    ).otherwise("not enough observations")
    return F.concat(
        F.coalesce("spatial_key", none), F.lit(" @ "), F.coalesce("time_key", none),
        F.lit(": trend="), F.coalesce("direction", F.lit("insufficient data")),
        F.lit(", traffic-sales correlation="), linked,
        F.lit(", impact="), F.coalesce("classification", F.lit("unknown")),
        F.lit(", leading demographic="), F.coalesce("dominant_group", F.lit("no dominant group")),
        F.lit(", metrics="), F.coalesce(F.concat(first["domain"], F.lit(" "), parts), F.lit("n/a")),
        F.lit("."),
    )


def insights(records: DataFrame, metrics: DataFrame) -> DataFrame:
    """One insight row per place and time from normalised records and their metrics."""
    rows = with_correlation(trend(fuse(records), "sales", ["spatial_key"], "time_key"))
    rows = (
        rows.join(highlights(metrics), BUCKET, "left")
        .join(leading_groups(records), BUCKET, "left")
    )
    return rows.withColumns({
        "source": source_label(F.col("sources")),
        "temporal_unit": F.coalesce("temporal_unit", F.lit("time_series")),
        "impact_sources": F.coalesce("impact_sources", F.lit(0)),
        "narrative": narrative(),
    })


def run(raw_records: DataFrame) -> DataFrame:
    """Normalise, fuse, measure and describe records of any mix of domains; normalised once, as four branches read them."""
    records = stage(raw_records.sparkSession, normalise(raw_records), "normalised_records")
    return insights(records, domain_metrics(records))
