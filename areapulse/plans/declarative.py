"""Declarative queries over insight rows: a dictionary becomes a DataFrame plan.

A query names a target path, aggregations, filters, grouping paths and an
optional period comparison. Paths are resolved against the schema. Where the time
is a date, its range reaches the scan. Only a summary, whose parts all start from
the same kept rows, stores these while it is built.
"""

from __future__ import annotations

import calendar
import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from areapulse.functions.numbers import drop_nan
from areapulse.functions.ordering import group_medians, leading
from areapulse.functions.text import parse_date
from areapulse.session import stage

AGGREGATIONS = ["sum", "avg", "min", "max", "median", "count"]
DEFAULT_AGGREGATIONS = ["avg"]
WEEKDAYS = ["MON", "TUE", "WED", "THU", "FRI", "SAT", "SUN"]
COMPARISONS = ["yoy", "mom", "dod", "custom"]


# Validation ----------------------------------------------------------------------------------


def _known(value: dict, allowed: list[str], where: str) -> None:
    if not isinstance(value, dict):
        raise ValueError(f"{where} must be an object")
    unknown = sorted(set(value) - set(allowed))
    if unknown:
        raise ValueError(f"unknown keys in {where}: {', '.join(unknown)}")


def _strings(value, where: str, allowed: list[str] | None = None) -> None:
    if not isinstance(value, list) or not all(isinstance(v, str) for v in value):
        raise ValueError(f"{where} must be a list of strings")
    wrong = [v for v in value if allowed and v not in allowed]
    if wrong:
        raise ValueError(f"{where} must be among: {', '.join(allowed)}")


def validate_query(query: dict) -> dict:
    """The query itself; raises on unknown keys, values or types."""
    _known(query, ["target", "aggregations", "filters", "group_by", "compare"], "query")
    if not isinstance(query.get("target"), str) or not query["target"]:
        raise ValueError("query.target is required")
    _strings(query.get("aggregations", []), "aggregations", AGGREGATIONS)
    _strings(query.get("group_by", []), "group_by")
    filters = query.get("filters", {})
    if not isinstance(filters, dict):
        raise ValueError("filters must be an object")
    time = filters.get("time", {})
    _known(time, ["start", "end", "month", "weekdays"], "filters.time")
    month = time.get("month", 1)
    if not isinstance(month, int) or isinstance(month, bool) or not 1 <= month <= 12:
        raise ValueError("filters.time.month must be 1 to 12")
    _strings(time.get("weekdays", []), "filters.time.weekdays", WEEKDAYS)
    _strings(filters.get("spatial", []), "filters.spatial")
    demographics = filters.get("demographics", {})
    _known(demographics, ["age", "gender"], "filters.demographics")
    _strings(demographics.get("age", []), "filters.demographics.age")
    _strings(demographics.get("gender", []), "filters.demographics.gender", ["male", "female"])
    if "compare" in query:
        _known(query["compare"], ["type", "interval"], "compare")
        if query["compare"].get("type") not in COMPARISONS:
            raise ValueError(f"compare.type must be among: {', '.join(COMPARISONS)}")
    return query


# Paths ---------------------------------------------------------------------------------------


def path_type(schema: T.StructType, path: str) -> T.DataType | None:
    """Type at a dotted path, None where the schema has nothing there."""
    cursor: T.DataType = schema
    for name in path.split("."):
        if isinstance(cursor, T.StructType) and name in cursor.names:
            cursor = cursor[name].dataType
        elif isinstance(cursor, T.MapType):
            cursor = cursor.valueType
        else:
            return None
    return cursor


def dig(df: DataFrame, path: str) -> Column:
    """Column at a dotted path; NULL where there is none."""
    if path_type(df.schema, path) is None:
        return F.lit(None)
    head, *rest = path.split(".")
    return reduce(lambda column, name: column[name], rest, F.col(f"`{head}`"))


def numeric(df: DataFrame, path: str) -> Column:
    """Number at a dotted path; text, flags and NaN are NULL."""
    kind = path_type(df.schema, path)
    if not isinstance(kind, T.NumericType):
        return F.lit(None).cast("double")
    return drop_nan(dig(df, path).cast("double"))


# Filters -------------------------------------------------------------------------------------


def read_date(text: str | None) -> dt.date | None:
    try:
        return dt.datetime.fromisoformat(text).date() if text else None
    except ValueError:
        return None


def time_filter(time: Column, wanted: dict, is_date: bool = False) -> Column:
    """Range, month and weekday test of a date or a text; an unreadable or missing time passes."""
    day = time if is_date else parse_date(time)
    tests = [F.lit(True)]
    start, end = read_date(wanted.get("start")), read_date(wanted.get("end"))
    if start:
        tests.append(day >= F.lit(start))
    if end:
        tests.append(day <= F.lit(end))
    if wanted.get("month"):
        tests.append(F.month(day) == wanted["month"])
    if wanted.get("weekdays"):
        tests.append(F.weekday(day).isin([WEEKDAYS.index(w) for w in wanted["weekdays"]]))
    return day.isNull() | reduce(lambda a, b: a & b, tests)


def _names(column: Column, kind: T.DataType, prefix: str) -> Column | None:
    """Text array: text values as they are, known numbers by their dotted name."""
    if isinstance(kind, T.StringType):
        return F.array_compact(F.array(column))
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return F.array_compact(F.array(F.when(column.isNotNull(), F.lit(prefix))))
    if isinstance(kind, T.MapType) and isinstance(kind.valueType, T.NumericType):
        keys = F.map_keys(F.map_filter(column, lambda _, v: v.isNotNull()))
        return F.transform(keys, lambda k: F.concat(F.lit(f"{prefix}." if prefix else ""), k))
    if isinstance(kind, T.MapType) and isinstance(kind.valueType, T.StringType):
        return F.array_compact(F.map_values(column))
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType):
        return F.array_compact(column)
    if isinstance(kind, T.ArrayType):
        return F.flatten(F.transform(column, lambda item: _names(item, kind.elementType, prefix)))
    if isinstance(kind, T.StructType):
        parts = [
            _names(column[f.name], f.dataType, f"{prefix}.{f.name}" if prefix else f.name) for f in kind.fields
        ]
        empty = F.array().cast("array<string>")
        return F.concat(*[F.coalesce(p, empty) for p in parts if p is not None])
    return None


def demographic_names(df: DataFrame) -> Column:
    """All demographic names and values of a row, from the record or its analysis.

    A group such as ``female_20_29`` also answers to its sex, its age group and
    the decade of its age group.
    """
    empty = F.array().cast("array<string>")
    found = empty
    for path in ("analysis.demographics", "population.demographics"):
        kind = path_type(df.schema, path)
        if kind is not None:
            names = F.coalesce(_names(dig(df, path), kind, ""), empty)
            found = F.when(F.size(names) > 0, names).otherwise(found)
    group = r"^(male|female)_(.+)$"
    parts = F.transform(found, lambda n: F.when(n.rlike(group), F.array(
        F.regexp_extract(n, group, 1),
        F.regexp_extract(n, group, 2),
        F.concat(F.regexp_extract(n, r"^(?:male|female)_(\d)\d", 1), F.lit("0s")),
    )).otherwise(empty))
    return F.array_distinct(F.concat(found, F.flatten(parts)))


def demographic_filter(df: DataFrame, wanted: dict) -> Column:
    if not wanted:
        return F.lit(True)
    names = demographic_names(df)
    tests = [F.size(names) > 0]
    tests += [
        F.arrays_overlap(names, F.array(*[F.lit(str(v)) for v in values])) for values in wanted.values() if values
    ]
    return reduce(lambda a, b: a & b, tests)


def _has_dates(df: DataFrame) -> bool:
    return isinstance(path_type(df.schema, "time"), T.DateType)


def apply_filters(df: DataFrame, filters: dict) -> DataFrame:
    if filters.get("spatial"):
        df = df.where(F.col("spatial").isin(filters["spatial"]))
    if filters.get("time"):
        df = df.where(time_filter(F.col("time"), filters["time"], _has_dates(df)))
    if filters.get("demographics"):
        df = df.where(demographic_filter(df, filters["demographics"]))
    return df


def apply_top_n(df: DataFrame, filters: dict, target: str) -> DataFrame:
    """The first rows by a numeric path; rows without a value come last."""
    wanted = filters.get("top_n")
    if not wanted:
        return df
    wanted = wanted if isinstance(wanted, dict) else {"count": wanted}
    count = int(wanted.get("count", 0))
    if count <= 0:
        return df
    value = numeric(df, wanted.get("sort_by") or target)
    ascending = str(wanted.get("order", "desc")).lower() == "asc"
    order = value.asc_nulls_last() if ascending else value.desc_nulls_last()
    ties = [F.col(c) for c in ("spatial", "time", "level") if c in df.columns]
    return leading(df, [order, *ties], count)


# Aggregates ----------------------------------------------------------------------------------

_SIMPLE = {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max}


def aggregate(df: DataFrame, target: str, aggregations: list[str], group_by: list[str] = ()) -> DataFrame:
    """Aggregates of a numeric path, per group when paths are given.

    ``rows`` counts all rows, ``count`` the numeric ones (NULL when none are).
    The median is exact; it is found by position, not by gathering a group.
    """
    keys = {f"group_{i}": path for i, path in enumerate(group_by)} or {"_all": None}
    values = df.select(
        *[(dig(df, p).cast("string") if p else F.lit(0)).alias(k) for k, p in keys.items()],
        numeric(df, target).alias("_value"),
    ).withColumns({k: F.coalesce(F.col(k).cast("string"), F.lit("None")) for k in keys})
    stats = [F.count(F.lit(1)).alias("rows")]
    stats += [function("_value").alias(name) for name, function in _SIMPLE.items() if name in aggregations]
    if "count" in aggregations:
        stats.append(F.nullif(F.count("_value"), F.lit(0)).alias("count"))
    result = values.groupBy(*keys).agg(*stats)
    if "median" in aggregations:
        result = result.join(group_medians(values, list(keys), "_value"), list(keys), "left")
    names = [F.col(k).alias(p) for k, p in keys.items() if p]
    return result.select(*names, "rows", *aggregations)


def shift_months(day: dt.date, months: int) -> dt.date:
    """Month arithmetic that stays within the month's last day."""
    index = day.year * 12 + day.month - 1 + months
    year, month = divmod(index, 12)
    return day.replace(year=year, month=month + 1, day=min(day.day, calendar.monthrange(year, month + 1)[1]))


def shifted_period(time: dict, compare: dict) -> dict | None:
    """The earlier period a comparison means; None without a full period."""
    start, end = read_date(time.get("start")), read_date(time.get("end"))
    kind, interval = compare.get("type"), (compare.get("interval") or "").strip().lower()
    if not start or not end:
        return None
    fixed = {"yoy": (12, "m"), "mom": (1, "m"), "dod": (1, "d")}
    if kind in fixed:
        amount, unit = fixed[kind]
    elif kind == "custom" and interval:
        unit = interval[-1]
        if unit not in "dwmy":
            raise ValueError(f"unsupported interval: {interval}")
        amount = int(interval[:-1] or "1")
    else:
        return None
    if unit in "my":
        months = amount * (12 if unit == "y" else 1)
        return {"start": shift_months(start, -months).isoformat(), "end": shift_months(end, -months).isoformat()}
    days = dt.timedelta(days=amount * (7 if unit == "w" else 1))
    return {"start": (start - days).isoformat(), "end": (end - days).isoformat()}


def compare_periods(df: DataFrame, query: dict) -> DataFrame | None:
    """Each aggregate for the period and the earlier one, with the difference.

    No rows when the earlier period has none. The rows are read once: each is
    tagged with the periods it lies in, one, both or, for an unreadable time,
    both, and the tag is the group.
    """
    filters = query.get("filters") or {}
    aggregations = query.get("aggregations") or DEFAULT_AGGREGATIONS
    earlier = shifted_period(filters.get("time") or {}, query.get("compare") or {})
    if earlier is None:
        return None

    rows = apply_filters(df, {k: v for k, v in filters.items() if k != "time"})
    inside = {
        name: time_filter(F.col("time"), period, _has_dates(df))
        for name, period in (("current", filters["time"]), ("previous", earlier))
    }
    tags = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in inside.items()]))
    tagged = rows.where(inside["current"] | inside["previous"]).withColumn("_period", F.explode(tags))
    found = aggregate(tagged, query["target"], aggregations, ["_period"])
    long = found.select("_period", *[F.col(a).cast("double").alias(a) for a in aggregations]).unpivot(
        ["_period"], aggregations, "aggregation", "value"
    )

    def side(name: str) -> Column:
        return F.max(F.when(F.col("_period") == name, F.col("value"))).alias(name)

    both = long.groupBy("aggregation").agg(
        side("current"), side("previous"), F.max(F.col("_period") == "previous").alias("_known")
    )
    return both.where("_known").select(
        "aggregation", "current", "previous", (F.col("current") - F.col("previous")).alias("delta")
    )


def project(df: DataFrame, target: str) -> DataFrame:
    """The reported fields of a row, with the target path and its value."""
    optional = [
        (F.col(c) if c in df.columns else F.lit(None).cast("string")).alias(c) for c in ("source", "analysis", "narrative")
    ]
    found = F.struct(F.lit(target).alias("path"), dig(df, target).alias("value")).alias("target")
    return df.select("spatial", F.col("time").cast("string").alias("time"), optional[0], found, *optional[1:])


@dataclass(frozen=True)
class Summary:
    records: DataFrame
    aggregations: DataFrame
    groups: DataFrame | None
    comparison: DataFrame | None


def summarize(df: DataFrame, query: dict) -> Summary:
    """All parts of a query; the kept rows are stored once for them. The comparison ignores ``top_n``."""
    validate_query(query)
    filters, target = query.get("filters") or {}, query["target"]
    aggregations = query.get("aggregations") or DEFAULT_AGGREGATIONS
    kept = stage(df.sparkSession, apply_top_n(apply_filters(df, filters), filters, target), "kept_insights")
    group_by = query.get("group_by") or []
    groups = aggregate(kept, target, aggregations, group_by) if group_by else None
    return Summary(
        records=project(kept, target),
        aggregations=aggregate(kept, target, aggregations),
        groups=groups.orderBy(*[f"`{g}`" for g in group_by]) if group_by else None,
        comparison=compare_periods(df, query) if query.get("compare") else None,
    )


# Insight rows --------------------------------------------------------------------------------


def nested_insights(rows: DataFrame) -> DataFrame:
    """Candidate rows with advanced measures as nested insight records."""
    def measures(name: str, short: str) -> Column:
        fields = {
            name: name, f"{name}_prev": f"{short}_prev", f"{name}_mom_pct": f"{short}_mom_pct",
            f"{name}_prev_year": f"{short}_prev_year", f"{name}_yoy_pct": f"{short}_yoy_pct",
            f"{name}_avg": f"{short}_avg", f"{name}_std": f"{short}_std", f"{name}_rank": f"{short}_rank",
            f"{name}_zscore": f"{short}_zscore", f"{name}_avg_date": f"{short}_avg_date",
        }
        return F.struct(*[F.col(column).alias(field) for field, column in fields.items()])

    def part(**fields: str) -> Column:
        return F.struct(*[F.col(column).alias(field) for field, column in fields.items()])

    level = F.col("level") if "level" in rows.columns else F.lit(None).cast("string")
    impact = ["corr_sales_foot_traffic", "sales_impact_slope", "sales_impact_score", "foot_traffic_impact_score"]
    return rows.select(
        F.col("spatial_label").alias("spatial"),
        F.col("date").alias("time"),
        level.alias("level"),
        measures("foot_traffic", "ft").alias("population"),
        measures("sales", "sales").alias("economic"),
        F.struct(
            part(foot_traffic_mom_pct="ft_mom_pct", foot_traffic_yoy_pct="ft_yoy_pct",
                 sales_mom_pct="sales_mom_pct", sales_yoy_pct="sales_yoy_pct").alias("trend"),
            part(foot_traffic_zscore="ft_zscore", sales_zscore="sales_zscore").alias("anomalies"),
            F.struct(*impact).alias("impact"),
            F.struct("dominant_group", "dominant_share").alias("demographics"),
        ).alias("analysis"),
    )


def read_results(spark: SparkSession, path: str, schema: T.StructType, single_document: bool = False) -> DataFrame:
    """Insight rows from JSON: one per line, or one document with a list of them."""
    if not single_document:
        return spark.read.schema(schema).json(path)
    document = T.StructType([T.StructField("generated_at", T.StringType()), T.StructField("insights", T.ArrayType(schema))])
    return spark.read.schema(document).option("multiLine", True).json(path).select(F.inline("insights"))


def latest_batch(stored: DataFrame, schema: T.StructType) -> DataFrame:
    """Insight rows of the newest batch of a (generated_at, payload text) table."""
    newest = stored.agg(F.max("generated_at"))
    return (
        stored.where(F.col("generated_at") == newest.scalar())
        .select(F.from_json("payload", schema).alias("_insight"))
        .select("_insight.*")
    )
