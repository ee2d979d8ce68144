"""Merging new rows into the shared tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from areapulse.schemas import ACTIVITY_KEY, DEMOGRAPHICS_KEY, DIM_SPATIAL, MEASURES, SPATIAL_COLUMNS


def add_activity(target: DataFrame, delta: DataFrame) -> DataFrame:
    """Measures of equal keys added up; a measure nobody set stays NULL."""
    both = target.select(*ACTIVITY_KEY, *MEASURES).unionByName(delta.select(*ACTIVITY_KEY, *MEASURES))
    return both.groupBy(*ACTIVITY_KEY).agg(*[F.sum(m).alias(m) for m in MEASURES])


def add_demographics(target: DataFrame, delta: DataFrame) -> DataFrame:
    both = target.select(*DEMOGRAPHICS_KEY, "value").unionByName(delta.select(*DEMOGRAPHICS_KEY, "value"))
    return both.groupBy(*DEMOGRAPHICS_KEY).agg(F.sum("value").alias("value"))


def last_per_key(batch: DataFrame, order: str) -> DataFrame:
    """The last row of each key within a batch."""
    columns = [c for c in batch.columns if c not in ("spatial_key", order)]
    return (
        batch.groupBy("spatial_key")
        .agg(F.max_by(F.struct(*columns), F.col(order)).alias("_last"))
        .select("spatial_key", "_last.*")
    )


def fill_spatial(dim: DataFrame, batch: DataFrame) -> DataFrame:
    """Known values of the dimension win; the batch fills gaps and adds keys.

    One aggregate over both sides: the first non-null value per column, the
    dimension before the batch.
    """
    names = [n for n in DIM_SPATIAL.names if n != "spatial_key"]
    fresh = batch.select(
        "spatial_key",
        *[F.col(n) if n in SPATIAL_COLUMNS and n in batch.columns else F.lit(None).cast(DIM_SPATIAL[n].dataType).alias(n) for n in names],
    )
    both = dim.select("spatial_key", *names, F.lit(0).alias("_age")).unionByName(fresh.withColumn("_age", F.lit(1)))
    first_known = [F.min_by(n, F.when(F.col(n).isNotNull(), F.col("_age"))).alias(n) for n in names]
    return both.groupBy("spatial_key").agg(*first_known)
