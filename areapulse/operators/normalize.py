"""Raw wide files to fact rows: one function per domain.

Every function takes an all-text frame and gives a :class:`Normalised`. Measures
are added up across columns first, then per (place, month), so one shuffle with
map-side combine serves a domain. ``keep`` names further columns, such as the
file a row came from, that stay part of the key.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from areapulse.functions.numbers import parse_number, sum_columns
from areapulse.functions.text import (
    bucket_date, clean, coord_label_parts, day_or_month_text, first_non_empty, parse_date, sex_age, strip_prefix,
)
from areapulse.operators import domains as d
from areapulse.schemas import GOLD_ACTIVITY, GOLD_DEMOGRAPHICS, MEASURES

Keep = tuple[str, ...]


@dataclass(frozen=True)
class Normalised:
    """Fact rows of one domain; ``demographics`` is None where it has none.

    ``sums`` are those that ``facts`` makes both kinds of fact rows from, if it does.
    """

    activity: DataFrame
    spatial: DataFrame
    demographics: DataFrame | None = None
    sums: DataFrame | None = None
    facts: Callable[[DataFrame], tuple[DataFrame, DataFrame]] | None = None

    def stored(self, store: Callable[[DataFrame], DataFrame]) -> Normalised:
        """The same rows, made from sums that ``store`` has added up once for both tables."""
        if self.sums is None:
            return self
        activity, demographics = self.facts(store(self.sums))
        return replace(self, activity=activity, demographics=demographics, sums=None, facts=None)


def from_sums(sums: DataFrame, spatial: DataFrame, facts: Callable[[DataFrame], tuple[DataFrame, DataFrame]]) -> Normalised:
    activity, demographics = facts(sums)
    return Normalised(activity, spatial, demographics, sums, facts)


def prefixed(df: DataFrame, *prefixes: str) -> list[str]:
    """Measure columns found in the header by prefix, in header order per prefix."""
    return [c for p in prefixes for c in df.columns if c.startswith(p)]


def prefixed_any_case(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if strip_prefix(c, prefix) is not None]


def complete(df: DataFrame) -> DataFrame:
    return df.where(F.col("spatial_key").isNotNull() & F.col("date").isNotNull())


def total(rows: DataFrame, keys: list[str], *measures: str) -> DataFrame:
    return rows.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])


def as_activity(df: DataFrame, source: str, granularity: str, keep: Keep = ()) -> DataFrame:
    measures = [F.col(m) if m in df.columns else F.lit(None).cast("double").alias(m) for m in MEASURES]
    tags = [F.lit(granularity).alias("granularity"), F.lit(source).alias("source")]
    return df.select("spatial_key", "date", *tags, *measures, *keep).select(*GOLD_ACTIVITY.names, *keep)


def as_demographics(df: DataFrame, source: str, granularity: str, keep: Keep = ()) -> DataFrame:
    tags = {"granularity": F.lit(granularity), "source": F.lit(source)}
    return df.withColumns(tags).select(*GOLD_DEMOGRAPHICS.names, *keep)


def places_from_keys(rows: DataFrame) -> DataFrame:
    """Dimension rows of keys alone; a coordinate label carries its own position."""
    parts = coord_label_parts(F.col("spatial_key"))
    return (
        rows.select("spatial_key").distinct()
        .select("spatial_key", F.col("spatial_key").alias("spatial_label"), parts.alias("_p"))
        .select("spatial_key", "spatial_label", "_p.spatial_type", "_p.code", "_p.lat", "_p.lon")
    )


def places_from_cells(raw: DataFrame, key: Column, x: str, y: str) -> DataFrame:
    """Dimension rows of coded cells; one known position per code."""
    lon = parse_number(F.col(x)) if x in raw.columns else F.lit(None).cast("double")
    lat = parse_number(F.col(y)) if y in raw.columns else F.lit(None).cast("double")
    position = F.when(lon.isNotNull() & lat.isNotNull(), F.struct(lat.alias("lat"), lon.alias("lon")))
    # texts that come again are few against the rows; the maximum of a struct would sort all of them
    return (
        raw.select(key.alias("spatial_key"), *[c for c in (x, y) if c in raw.columns]).distinct()
        .select("spatial_key", position.alias("_position"))
        .where(F.col("spatial_key").isNotNull())
        .groupBy("spatial_key")
        .agg(F.max("_position").alias("_position"))
        .select(
            "spatial_key",
            F.col("spatial_key").alias("spatial_label"),
            F.when(F.col("_position").isNotNull(), "coord").alias("spatial_type"),
            F.col("spatial_key").alias("code"),
            "_position.lat",
            "_position.lon",
        )
    )


def sales_rows(raw: DataFrame, granularity: str = "month", keep: Keep = ()) -> DataFrame:
    """Sales amount and count of each raw row."""
    return complete(raw.select(
        first_non_empty([c for c in d.SALES["places"] if c in raw.columns]).alias("spatial_key"),
        bucket_date(F.col(d.SALES["time"]), granularity).alias("date"),
        sum_columns(prefixed(raw, *d.SALES["amounts"])).alias("sales"),
        sum_columns(prefixed(raw, *d.SALES["counts"])).alias("sales_count"),
        *keep,
    ))


def sales(raw: DataFrame, granularity: str = "month", keep: Keep = ()) -> Normalised:
    rows = sales_rows(raw, granularity, keep)
    if not prefixed(raw, *d.SALES["amounts"]):
        rows = rows.where(F.lit(False))
    facts = total(rows, ["spatial_key", "date", *keep], "sales", "sales_count")
    return Normalised(as_activity(facts, "sales", granularity, keep), places_from_keys(facts))


def telco_rows(raw: DataFrame, granularity: str = "month", keep: Keep = ()) -> DataFrame:
    """Male, female and all visitors of each raw row."""
    rows = raw.select(
        clean(F.col(d.TELCO["place"])).alias("spatial_key"),
        bucket_date(F.col(d.TELCO["time"]), granularity).alias("date"),
        sum_columns(prefixed(raw, d.TELCO["male"])).alias("male_total"),
        sum_columns(prefixed(raw, d.TELCO["female"])).alias("female_total"),
        *keep,
    )
    return complete(rows).withColumn("foot_traffic", F.col("male_total") + F.col("female_total"))


def telco(raw: DataFrame, granularity: str = "month", keep: Keep = ()) -> Normalised:
    facts = total(telco_rows(raw, granularity, keep), ["spatial_key", "date", *keep], "foot_traffic")
    return Normalised(as_activity(facts, "telco", granularity, keep), places_from_keys(facts))


def wide_demographics(rows: DataFrame, male: dict[str, str], female: dict[str, str], keep: Keep = ()) -> DataFrame:
    """Sums per (place, month) with one ``male_<age>`` or ``female_<age>`` column each."""
    sums = [
        F.sum(sum_columns([column])).alias(f"{sex}_{age}")
        for sex, columns in (("male", male), ("female", female))
        for column, age in columns.items()
    ]
    return rows.groupBy("spatial_key", "date", *keep).agg(F.count(F.lit(1)).alias("_rows"), *sums).drop("_rows")


def demographic_columns(wide: DataFrame) -> list[str]:
    return [c for c in wide.columns if c.startswith(("male_", "female_"))]


def with_foot_traffic(wide: DataFrame) -> DataFrame:
    parts = [F.col(f"`{c}`") for c in demographic_columns(wide)]
    return wide.withColumn("foot_traffic", reduce(lambda a, b: a + b, parts, F.lit(0.0)))


def long_demographics(wide: DataFrame, keep: Keep = ()) -> DataFrame:
    """One row per sex and age group; zeros are kept."""
    columns = demographic_columns(wide)
    if not columns:
        none = {"sex": F.lit(""), "age_group": F.lit(""), "value": F.lit(0.0)}
        return wide.withColumns(none).where(F.lit(False))
    long = wide.unpivot(["spatial_key", "date", *keep], columns, "_column", "value")
    return long.select(
        "spatial_key", "date", *keep,
        F.regexp_extract("_column", "^(male|female)_", 1).alias("sex"),
        F.regexp_replace("_column", "^(male|female)_", "").alias("age_group"),
        "value",
    )


def _by_sex_and_age(
    rows: DataFrame, spatial: DataFrame, male: dict, female: dict, source: str, granularity: str, keep: Keep
) -> Normalised:
    wide = wide_demographics(complete(rows), male, female, keep)
    return from_sums(wide, spatial, lambda sums: (
        as_activity(with_foot_traffic(sums), source, granularity, keep),
        as_demographics(long_demographics(sums, keep), source, granularity, keep),
    ))


def telco_grid_rows(raw: DataFrame, granularity: str = "month") -> DataFrame:
    month = F.col(d.TELCO_GRID["month"]) if d.TELCO_GRID["month"] in raw.columns else None
    day = F.col(d.TELCO_GRID["day"])
    return raw.withColumns({
        "spatial_key": clean(F.col(d.TELCO_GRID["place"])),
        "date": bucket_date(day_or_month_text(day, month), granularity),
    })


def telco_grid_columns(raw: DataFrame) -> tuple[dict[str, str], dict[str, str]]:
    male = {c: strip_prefix(c, d.TELCO_GRID["male"]) for c in prefixed(raw, d.TELCO_GRID["male"])}
    female = {c: strip_prefix(c, d.TELCO_GRID["female"]) for c in prefixed(raw, d.TELCO_GRID["female"])}
    return male, female


def telco_grid(raw: DataFrame, granularity: str = "month", keep: Keep = ()) -> Normalised:
    spatial = places_from_cells(raw, clean(F.col(d.TELCO_GRID["place"])), d.TELCO_GRID["x"], d.TELCO_GRID["y"])
    return _by_sex_and_age(
        telco_grid_rows(raw, granularity), spatial, *telco_grid_columns(raw), "telco_grid", granularity, keep
    )


def _city_rows(raw: DataFrame, place: str, granularity: str) -> DataFrame:
    return raw.withColumns({
        "spatial_key": clean(F.col(place)), "date": bucket_date(F.col(d.CITY_TIME), granularity),
    })


def city_inflow(raw: DataFrame, granularity: str = "month", keep: Keep = ()) -> Normalised:
    """Home, work and visiting population over all hours and inflow codes."""
    rows = complete(_city_rows(raw, d.CITY_PLACE, granularity))
    rows = rows.withColumn("foot_traffic", sum_columns(d.CITY_POPULATION))
    facts = total(rows, ["spatial_key", "date", *keep], "foot_traffic")
    return Normalised(as_activity(facts, d.CITY_SOURCES["inflow"], granularity, keep), places_from_keys(facts))


def city_sex_age(raw: DataFrame, granularity: str = "month", keep: Keep = ()) -> Normalised:
    """Population by sex and age token; rows with an invalid token are left out.

    The activity is the sum of the demographic rows, so both come from one shuffle
    of the raw rows.
    """
    source = d.CITY_SOURCES["sex_age"]
    rows = complete(_city_rows(raw, d.CITY_PLACE, granularity)).select(
        "spatial_key", "date", *keep,
        sex_age(F.col(d.CITY_SEX_AGE)).alias("_token"),
        sum_columns(d.CITY_POPULATION).alias("value"),
    )
    rows = rows.select("*", "_token.sex", "_token.age_group").where(F.col("sex").isNotNull())
    groups = total(rows, ["spatial_key", "date", *keep, "sex", "age_group"], "value")
    def facts(sums: DataFrame) -> DataFrame:
        return total(sums, ["spatial_key", "date", *keep], "value").withColumnRenamed("value", "foot_traffic")

    return from_sums(groups, places_from_keys(facts(groups)), lambda sums: (
        as_activity(facts(sums), source, granularity, keep), as_demographics(sums, source, granularity, keep)))


def _city_age_columns(raw: DataFrame) -> tuple[dict[str, str], dict[str, str]]:
    return tuple(
        {c: strip_prefix(c, p) for c in prefixed_any_case(raw, p)} for p in (d.CITY_MALE, d.CITY_FEMALE)
    )


def city_cell_sex_age(raw: DataFrame, granularity: str = "month", keep: Keep = ()) -> Normalised:
    spatial = places_from_cells(raw, clean(F.col(d.CITY_PLACE)), d.CITY_X, d.CITY_Y)
    return _by_sex_and_age(
        _city_rows(raw, d.CITY_PLACE, granularity), spatial, *_city_age_columns(raw),
        d.CITY_SOURCES["pcell_sex_age"], granularity, keep,
    )


def city_cell(raw: DataFrame, granularity: str = "month", keep: Keep = ()) -> Normalised:
    """Hourly columns of coded cells added up."""
    hours = prefixed(raw, d.CITY_HOUR_PREFIX)
    rows = complete(_city_rows(raw, d.CITY_PLACE, granularity)).withColumn("foot_traffic", sum_columns(hours))
    if not hours:
        rows = rows.where(F.lit(False))
    facts = total(rows, ["spatial_key", "date", *keep], "foot_traffic")
    spatial = places_from_cells(raw, clean(F.col(d.CITY_PLACE)), d.CITY_X, d.CITY_Y)
    return Normalised(as_activity(facts, d.CITY_SOURCES["pcell"], granularity, keep), spatial)


def city_unique(raw: DataFrame, granularity: str = "month", keep: Keep = ()) -> Normalised:
    rows = _city_rows(raw, d.CITY_UNIQUE_PLACE, granularity)
    male, female = _city_age_columns(raw)
    return _by_sex_and_age(
        rows, places_from_keys(complete(rows)), male, female, d.CITY_SOURCES["unique"], granularity, keep
    )


NORMALISERS = {
    "sales": sales,
    "telco": telco,
    "telco_grid": telco_grid,
    "inflow": city_inflow,
    "sex_age": city_sex_age,
    "pcell_sex_age": city_cell_sex_age,
    "pcell": city_cell,
    "unique": city_unique,
}


def register(source: str, normaliser: Callable[..., Normalised], pattern: str) -> None:
    """Add a domain: ``normaliser(raw, granularity, keep)`` makes its fact rows and places from the files like ``pattern``.

    Ingests, streams and :meth:`IngestStore.ingest_all` know it from then on.
    """
    if source in NORMALISERS:
        raise ValueError(f"domain {source} exists")
    NORMALISERS[source] = normaliser
    d.FILE_PATTERNS[source] = pattern


def unregister(source: str) -> None:
    del NORMALISERS[source], d.FILE_PATTERNS[source]


def detect_table(file_name: Column) -> Column:
    """City table a file belongs to, by its name; NULL when it is none of them."""
    name = F.lower(file_name)
    choice = F.lit(None).cast("string")
    for mark, table in reversed(d.CITY_FILE_MARKS.items()):
        choice = F.when(name.contains(mark), table).otherwise(choice)
    return choice


def bronze(raw: DataFrame, time: Column) -> DataFrame:
    """Raw rows with their month as ``dt``; rows without one are dropped."""
    return raw.withColumn("dt", bucket_date(time)).where(F.col("dt").isNotNull())


def silver(rows: DataFrame) -> DataFrame:
    """Normalised rows with their date as ``dt``."""
    return rows.withColumn("dt", parse_date(F.col("date").cast("string"))).where(F.col("dt").isNotNull())
