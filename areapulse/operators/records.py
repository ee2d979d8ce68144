"""Standard records: one nested row per place, time and source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from areapulse.functions.numbers import sum_columns
from areapulse.functions.text import (
    clean, coord_label, day_or_month, day_or_month_text, first_non_empty, parse_date, region_name, time_label,
)
from areapulse.functions.numbers import parse_number
from areapulse.operators import domains as d
from areapulse.operators.normalize import prefixed, telco_grid_columns, wide_demographics

RECORD = {
    "spatial_key": "string",
    "time_key": "string",
    "population": "struct<foot_traffic:double,demographics:map<string,double>>",
    "economic": "struct<sales:double,sales_count:double,"
                "category:struct<large:string,medium:string,small:string,label:string>,sector:string>",
    "behavior": "struct<day_index:int>",
    "events": "array<string>",
    "source": "string",
}
REQUIRED = list(RECORD)


def build_records(df: DataFrame, source: str | Column, **fields: Column) -> DataFrame:
    """Records with the given fields; absent fields are NULL."""
    tag = F.lit(source) if isinstance(source, str) else source
    given = {**fields, "source": tag}
    return df.select(*[given.get(n, F.lit(None)).cast(t).alias(n) for n, t in RECORD.items()])


def population(foot_traffic: Column | None = None, demographics: Column | None = None) -> Column:
    none = F.lit(None)
    return F.struct(
        (none if foot_traffic is None else foot_traffic).cast("double").alias("foot_traffic"),
        (none if demographics is None else demographics).cast("map<string,double>").alias("demographics"),
    )


def economic(sales: Column, sales_count: Column, category: Column | None = None, sector: Column | None = None) -> Column:
    none = F.lit(None)
    kind = RECORD["economic"].split("category:")[1].split(",sector")[0]
    return F.struct(
        sales.cast("double").alias("sales"),
        sales_count.cast("double").alias("sales_count"),
        (none if category is None else category).cast(kind).alias("category"),
        (none if sector is None else sector).cast("string").alias("sector"),
    )


def category(df: DataFrame) -> tuple[Column, Column]:
    """Category struct and the most specific category of a sales row.

    Where no sized category is known, the plain category column gives the label.
    """
    def value(column: str) -> Column:
        if column not in df.columns:
            return F.lit(None).cast("string")
        text = clean(F.col(column))
        return F.when(F.lower(text) != "nan", text)

    sizes = {size: value(column) for size, column in d.SALES["categories"].items()}
    label = F.when(F.coalesce(*sizes.values()).isNull(), value(d.SALES["category"]))
    sector = F.coalesce(sizes["small"], sizes["medium"], sizes["large"], label)
    struct = F.struct(*[c.alias(n) for n, c in sizes.items()], label.alias("label"))
    return F.when(sector.isNotNull(), struct), sector


def sales_records(raw: DataFrame) -> DataFrame:
    text = F.trim(F.col(d.SALES["time"]).cast("string"))
    month = F.when(text.rlike(r"^.{4}-.{2}$"), F.replace(text, F.lit("-"))).otherwise(text)
    kind, sector = category(raw)
    return build_records(
        raw, "sales",
        spatial_key=first_non_empty([c for c in d.SALES["places"] if c in raw.columns]),
        time_key=month,
        population=population(),
        economic=economic(
            sum_columns(prefixed(raw, *d.SALES["amounts"])), sum_columns(prefixed(raw, *d.SALES["counts"])), kind, sector
        ),
        events=F.array().cast("array<string>"),
    )


def telco_records(raw: DataFrame) -> DataFrame:
    male, female = (sum_columns(prefixed(raw, d.TELCO[sex])) for sex in ("male", "female"))
    month = F.lpad(parse_number(F.col(d.TELCO["time"])).try_cast("int").cast("string"), 6, "0")
    return build_records(
        raw, "telco",
        spatial_key=clean(F.col(d.TELCO["place"])),
        time_key=F.date_format(parse_date(month), "yyyy-MM"),
        population=population(male + female, F.create_map(F.lit("male"), male, F.lit("female"), female)),
        behavior=F.struct(F.coalesce(parse_number(F.col(d.TELCO["day"])).try_cast("int"), F.lit(0)).alias("day_index")),
        events=F.array().cast("array<string>"),
    )


def telco_grid_records(raw: DataFrame) -> DataFrame:
    """One record per cell and time, with visitors by sex and age as a map."""
    lon, lat = (parse_number(F.col(d.TELCO_GRID[c])) for c in ("x", "y"))
    month = F.col(d.TELCO_GRID["month"]) if d.TELCO_GRID["month"] in raw.columns else None
    male, female = telco_grid_columns(raw)
    place, day = clean(F.col(d.TELCO_GRID["place"])), F.col(d.TELCO_GRID["day"])
    # what makes a label and a date not empty; a filter on these themselves would make them twice
    known = (place.isNotNull() | (lon.isNotNull() & lat.isNotNull())) & day_or_month_text(day, month).isNotNull()
    rows = raw.where(known).select(
        coord_label(place, lon, lat).alias("spatial_key"), day_or_month(day, month).alias("date"),
        *[F.col(f"`{c}`") for c in (*male, *female)],
    )
    wide = wide_demographics(rows, male, female)
    entries, visitors = [], F.lit(0.0)
    for sex, ages in (("male", male), ("female", female)):
        for age in ages.values():
            value = F.col(f"`{sex}_{age}`")
            entries += [F.lit(f"{sex}_by_age.{age}"), value]
            visitors = visitors + value
    demographics = F.create_map(*entries) if entries else F.lit(None)
    return build_records(
        wide, "telco_grid",
        spatial_key=F.col("spatial_key"), time_key=F.col("date"),
        population=population(visitors, demographics), events=F.array().cast("array<string>"),
    )


def fill_missing(records: DataFrame) -> DataFrame:
    """Defaults for fields a domain left out."""
    zero = F.lit(0.0)
    return records.withColumns({
        "population": F.struct(
            F.coalesce("population.foot_traffic", zero).alias("foot_traffic"), F.col("population.demographics")
        ),
        "economic": F.struct(
            F.coalesce("economic.sales", zero).alias("sales"),
            F.coalesce("economic.sales_count", zero).alias("sales_count"),
            F.col("economic.category"), F.col("economic.sector"),
        ),
        "behavior": F.coalesce("behavior", F.struct(F.lit(None).cast("int").alias("day_index"))),
        "events": F.coalesce("events", F.array().cast("array<string>")),
        "source": F.coalesce("source", F.lit("unknown")),
    })


def common_axes(records: DataFrame) -> DataFrame:
    """Common place names and time labels; measures reduced to the shared fields."""
    return records.withColumns({
        "time_key": time_label(F.col("time_key")),
        "spatial_key": region_name(F.col("spatial_key")),
        "population": F.struct(F.col("population.foot_traffic"), F.col("population.demographics")),
        "economic": F.struct(F.col("economic.sales"), F.col("economic.sales_count")),
    })


def validate(records: DataFrame) -> DataFrame:
    """The records themselves; raises when a required field does not exist."""
    missing = [name for name in REQUIRED if name not in records.columns]
    if missing:
        raise ValueError(f"missing record fields: {', '.join(missing)}")
    return records


def incomplete(records: DataFrame) -> DataFrame:
    """Records with an empty place, time or source, with the names of the empty fields."""
    empty = [F.when(F.col(n).isNull() | (F.col(n) == ""), F.lit(n)) for n in ("spatial_key", "time_key", "source")]
    return records.withColumn("empty_fields", F.array_compact(F.array(*empty))).where(F.size("empty_fields") > 0)


def normalise(records: DataFrame) -> DataFrame:
    return validate(common_axes(fill_missing(records)))


def source_totals(records: DataFrame) -> DataFrame:
    """Measures per place, time and source; the only shuffle of single records."""
    return records.groupBy("spatial_key", "time_key", "source").agg(
        F.sum("population.foot_traffic").alias("foot_traffic"),
        F.sum("economic.sales").alias("sales"),
        F.count(F.lit(1)).alias("records"),
    )


def fuse(records: DataFrame) -> DataFrame:
    """Records of all sources per place and time, one array entry per source.

    The records of a source are added up first, so an entry count never exceeds
    the number of sources, however many records a bucket has.
    """
    entry = F.struct("source", "foot_traffic", "sales", "records")
    return source_totals(records).groupBy("spatial_key", "time_key").agg(
        F.array_sort(F.collect_list(entry)).alias("by_source"),
        F.sum("foot_traffic").alias("foot_traffic"),
        F.sum("sales").alias("sales"),
        F.array_sort(F.collect_set("source")).alias("sources"),
    )


def source_label(sources: Column) -> Column:
    """Distinct sources in order, joined with ``+``; NULL when there are none."""
    return F.when(F.size(sources) > 0, F.array_join(F.array_sort(sources), "+"))
