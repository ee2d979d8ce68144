"""Insight payloads: series tails, extremes and anomalies, one row per label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

RECENT = 12
STRONGEST = 5
Z_LIMIT = 2
# Payload domain: (value, month change, year change, z-score, mean, deviation).
DOMAIN_FIELDS = {
    "foot_traffic": ("foot_traffic", "ft_mom_pct", "ft_yoy_pct", "ft_zscore", "ft_avg", "ft_std"),
    "sales": ("sales", "sales_mom_pct", "sales_yoy_pct", "sales_zscore", "sales_avg", "sales_std"),
}


def extreme(field: str, largest: bool, *columns: str) -> Column:
    """Struct of the row where ``field`` is largest or smallest; the earliest wins ties."""
    row = F.struct(F.col("date"), F.col(field).alias("value"), *columns)
    known = F.col(field).isNotNull()
    if largest:
        return F.max_by(row, F.when(known, F.struct(F.col(field), -F.unix_date("date"))))
    return F.min_by(row, F.when(known, F.struct(F.col(field), F.col("date"))))


def anomalies(field: str, *columns: str) -> Column:
    """The strongest deviations of a label's series, strongest first.

    A label has one row per date, so the list is bounded by the calendar.
    """
    row = F.struct((-F.abs(field)).alias("_order"), F.col("date"), F.col(field).alias("zscore"), *columns)
    picked = F.slice(F.array_sort(F.collect_list(F.when(F.abs(field) >= Z_LIMIT, row))), 1, STRONGEST)
    return F.transform(picked, lambda r: r.dropFields("_order"))


def tail(rows: DataFrame, keys: list[str], size: int = RECENT) -> DataFrame:
    """The latest rows of each series; within a date, the later types first."""
    ties = [F.desc("spatial_type")] if "spatial_type" in rows.columns else []
    newest = Window.partitionBy(*keys).orderBy(F.desc("date"), *ties)
    return rows.withColumn("_place", F.row_number().over(newest)).where(F.col("_place") <= size).drop("_place")


def recent(*columns: Column | str) -> Column:
    """The last rows of a label's series as an array in date order."""
    ordered = F.array_sort(F.collect_list(F.struct("date", *columns)))
    return F.slice(ordered, F.greatest(F.size(ordered) - RECENT + 1, F.lit(1)), RECENT)


def region_payload(rows: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One payload row per label from candidate rows."""
    keys = keys or ["level", "spatial_label"]
    others = [c for c in rows.columns if c not in ("date", *keys)]
    highlights, domains = [], []
    for domain, (value, mom, yoy, z, mean, std) in DOMAIN_FIELDS.items():
        for name, field in (("mom", mom), ("yoy", yoy)):
            for word, largest in (("max", True), ("min", False)):
                highlights.append(extreme(field, largest, "foot_traffic", "sales").alias(f"{domain}_{name}_{word}"))
        highlights.append(anomalies(z, "foot_traffic", "sales").alias(f"{domain}_anomalies"))
        own_value = F.col(value).alias("series_value")
        series = recent(
            F.col(value).alias("value"), F.col(mom).alias("mom_pct"), F.col(yoy).alias("yoy_pct"),
            F.col(mean).alias("avg"), F.col(std).alias("std"), F.col(z).alias("zscore"),
        )
        domains.append(
            F.struct(
                series.alias("series"),
                F.struct(
                    extreme(mom, True, own_value).alias("mom_max"),
                    extreme(mom, False, own_value).alias("mom_min"),
                    extreme(yoy, True, own_value).alias("yoy_max"),
                    extreme(yoy, False, own_value).alias("yoy_min"),
                    anomalies(z, F.col(value).alias("value")).alias("anomalies"),
                ).alias("highlights"),
            ).alias(domain)
        )
    return rows.groupBy(*keys).agg(
        F.min("date").alias("date_min"),
        F.max("date").alias("date_max"),
        recent(*others).alias("series"),
        F.struct(*highlights).alias("highlights"),
        F.struct(*domains).alias("domains"),
        F.max_by("dominant_group", "date").alias("dominant_group"),
        F.max_by("dominant_share", "date").alias("dominant_share"),
    )


def global_payload(series: DataFrame) -> DataFrame:
    """The payload of the global series, which has neither ranks nor leaders."""
    filler = {
        "ft_avg_date": "double", "sales_avg_date": "double", "ft_rank": "long", "sales_rank": "long",
        "dominant_group": "string", "dominant_share": "double",
    }
    return region_payload(series.withColumns({n: F.lit(None).cast(t) for n, t in filler.items()}), ["level"])


def features(geo: DataFrame) -> DataFrame:
    """A GeoJSON feature and its fingerprint per label with coordinates."""
    point = F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates"))
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct("spatial_label", "foot_traffic", "sales").alias("properties"),
        point.alias("geometry"),
    )
    return (
        geo.where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
        .select("spatial_label", F.to_json(feature, {"ignoreNullFields": "false"}).alias("feature"))
        .withColumn("fingerprint", F.sha2("feature", 256))
    )
