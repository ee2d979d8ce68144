"""Dataset profile: ranges, counts, leaders, totals and the global series."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from areapulse.functions.numbers import ratio
from areapulse.operators.candidates import series_columns
from areapulse.operators.rollups import monthly


def totals_by_date(activity: DataFrame) -> DataFrame:
    """Foot traffic and sales per month over all places."""
    return monthly(activity).groupBy("date").agg(
        F.sum("foot_traffic").alias("foot_traffic"), F.sum("sales").alias("sales")
    )


def overview(activity: DataFrame) -> DataFrame:
    return activity.agg(
        F.min("date").alias("date_min"),
        F.max("date").alias("date_max"),
        F.count(F.lit(1)).alias("row_count"),
        F.countDistinct("spatial_key").alias("spatial_count"),
        F.countDistinct("date").alias("date_count"),
    )


def row_counts(activity: DataFrame) -> DataFrame:
    """Rows per date, per date and source, and per source, in one pass.

    The rows are counted per date and source once; the other two come from
    those counts.
    """
    cells = activity.groupBy("date", "source").agg(F.count(F.lit(1)).alias("n"))
    no_date, no_source = F.lit(None).cast("date"), F.lit(None).cast("string")
    total = F.sum("n").alias("n")
    return (
        cells.select(F.lit("date_source").alias("kind"), "date", "source", "n")
        .unionByName(cells.groupBy("date").agg(total).select(F.lit("date").alias("kind"), "date", no_source.alias("source"), "n"))
        .unionByName(cells.groupBy("source").agg(total).select(F.lit("source").alias("kind"), no_date.alias("date"), "source", "n"))
    )


def _counted(df: DataFrame, kind: str, name: Column) -> DataFrame:
    return df.groupBy(name.alias("name")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("kind"), "name", "n")


def _leaders(df: DataFrame, kind: str, name: Column, top: int) -> DataFrame:
    return _counted(df, kind, name).orderBy(F.desc("n"), "name").limit(top)


def dim_with_admin(dim: DataFrame, admin_sig: DataFrame) -> DataFrame:
    """Places whose code starts with a known district code."""
    code = F.substring(F.coalesce(dim["emd_code"], dim["code"]), 1, 5)
    return dim.join(admin_sig, code == admin_sig["sig_code"]).select(
        "spatial_key", admin_sig["sig_name"], admin_sig["sido_name"]
    )


def dimension_counts(dim: DataFrame, admin_sig: DataFrame, admin_sido: DataFrame, top: int = 10) -> DataFrame:
    """Most frequent labels, districts and provinces; counts by type and of the admin tables."""
    placed = dim_with_admin(dim, admin_sig)
    parts = [
        _leaders(dim.where(F.col("spatial_label").isNotNull()), "label", F.col("spatial_label"), top),
        _counted(dim, "type", F.coalesce("spatial_type", F.lit("unknown"))),
        _leaders(placed, "sig", F.col("sig_name"), top),
        _leaders(placed, "sido", F.col("sido_name"), top),
        _counted(admin_sig, "table", F.lit("admin_sig")),
        _counted(admin_sido, "table", F.lit("admin_sido")),
    ]
    return reduce(DataFrame.unionByName, parts)


def grand_totals(activity: DataFrame) -> DataFrame:
    return activity.agg(
        F.coalesce(F.sum("foot_traffic"), F.lit(0.0)).alias("sum_foot_traffic"),
        F.coalesce(F.sum("sales"), F.lit(0.0)).alias("sum_sales"),
    )


def global_series(activity: DataFrame) -> DataFrame:
    """The global series with lags, changes and z-scores.

    The window holds one row per month of the whole data set.
    """
    return series_columns(totals_by_date(activity).withColumn("level", F.lit("total")), ["level"])


def global_baseline(activity: DataFrame, months: int = 12) -> DataFrame:
    """Mean, trend and volatile months of each measure over the latest months."""
    recent = totals_by_date(activity).orderBy(F.desc("date")).limit(months)
    cells = recent.unpivot("date", ["foot_traffic", "sales"], "domain", "value")
    whole = Window.partitionBy("domain")
    z = ratio(F.col("value") - F.avg("value").over(whole), F.stddev_samp("value").over(whole))
    known = F.when(F.col("value").isNotNull(), F.col("date"))
    stats = cells.withColumn("_z", z).groupBy("domain").agg(
        F.avg("value").alias("avg"),
        F.count("value").alias("_n"),
        F.min_by("value", known).alias("first_value"),
        F.max_by("value", known).alias("last_value"),
        F.array_sort(F.collect_list(F.when(F.abs("_z") >= 2, F.col("date")))).alias("volatile_months"),
    )
    rate = F.when(F.col("_n") >= 2, ratio(F.col("last_value") - F.col("first_value"), F.abs("first_value")))
    trend = (
        F.when(F.abs("change_pct") < 0.02, "flat")
        .when(F.col("change_pct") > 0, "upward")
        .when(F.col("change_pct").isNotNull(), "downward")
    )
    return (
        stats.withColumn("change_pct", rate)
        .withColumn("trend", trend)
        .select(
            F.lit(f"recent_{months}_months").alias("period"),
            "domain", "avg", "trend", "change_pct", "volatile_months", "first_value", "last_value",
        )
    )
