"""Declarative queries over the candidate rows of all levels."""

from pyspark.sql import functions as F

from areapulse.checks.registry import check
from areapulse.checks.sqltext import ALL_VIEWS, statement
from areapulse.operators import candidates as cand
from areapulse.plans import declarative as dq
from areapulse.session import new_folder, stage
from areapulse.sources.staging import gold

VIEW = ALL_VIEWS + """, ins AS (SELECT v.*, a.* EXCLUDE (level, spatial_label) FROM candidate_all v
  LEFT JOIN advanced a ON a.level = v.level AND a.spatial_label = v.spatial_label)"""
_staged = {}


def insights(spark, sf):
    """Insight rows of all levels, kept as a table because every query reads them."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _staged:
        tables = gold(spark, sf)
        rows = cand.with_advanced(cand.candidates_all(tables), cand.advanced(cand.advanced_input(tables)))
        _staged[key] = stage(spark, dq.nested_insights(rows), "insights", ("time",))
    return _staged[key]


FLAT = {"spatial_label": "spatial", "date": "time", "level": "level", "sales": "economic.sales", "foot_traffic": "population.foot_traffic"}


def flat(df):
    return df.select(*[(dq.dig(df, p).cast("string") if p == "time" else dq.dig(df, p)).alias(n) for n, p in FLAT.items()])


ROWS = "spatial_label date level"
CAST_DATE = "SELECT spatial_label, CAST(date AS VARCHAR) AS date, level, sales, foot_traffic FROM ins"
ALL = ["sum", "avg", "min", "max", "median", "count"]

check("q2_spatial_filter", statement(f"{CAST_DATE} WHERE spatial_label IN ('ASIA', 'NATION_4', 'NATION_9 BUILDING')", ROWS, "sales foot_traffic", VIEW))(
    lambda spark, sf: flat(dq.apply_filters(insights(spark, sf), {"spatial": ["ASIA", "NATION_4", "NATION_9 BUILDING"]})))

check("q3_time_filter", statement(
    f"{CAST_DATE} WHERE date BETWEEN DATE '1995-06-01' AND DATE '2000-12-31' AND month(date) = 6 AND isodow(date) IN (6, 7, 1)",
    ROWS, "sales foot_traffic", VIEW))(lambda spark, sf: flat(dq.apply_filters(insights(spark, sf), {
        "time": {"start": "1995-06-01", "end": "2000-12-31", "month": 6, "weekdays": ["SAT", "SUN", "MON"]}})))

check("q4_demographic_filter", statement(
    f"{CAST_DATE} WHERE dominant_group IN ('female_20_29', 'female_30_39')", ROWS, "sales foot_traffic", VIEW))(
    lambda spark, sf: flat(dq.apply_filters(insights(spark, sf), {"demographics": {"gender": ["female"], "age": ["20s", "30_39"]}})))

check("u3_overlap", statement(f"{CAST_DATE} WHERE dominant_group IN ('male_10_19', 'female_50_59')", ROWS, "sales foot_traffic", VIEW))(
    lambda spark, sf: flat(insights(spark, sf).where(F.arrays_overlap(
        dq.demographic_names(insights(spark, sf)), F.array(F.lit("male_10_19"), F.lit("female_50_59"))))))

check("k3_top_n", statement(
    f"{CAST_DATE} ORDER BY sales ASC NULLS LAST, spatial_label, date, level LIMIT 50", ROWS, "sales foot_traffic", VIEW))(
    lambda spark, sf: flat(dq.apply_top_n(insights(spark, sf), {"top_n": {"count": 50, "sort_by": "economic.sales", "order": "asc"}}, "x")))

STATS = "sum(sales) AS sum, avg(sales) AS avg, min(sales) AS min, max(sales) AS max, median(sales) AS median, nullif(count(sales), 0) AS count"
check("a19_aggregates", statement(f"SELECT count(*) AS rows, {STATS} FROM ins", "rows count", "sum avg min max median", VIEW))(
    lambda spark, sf: dq.aggregate(insights(spark, sf), "economic.sales", ALL))

check("a20_grouped_aggregates", statement(
    f"SELECT level, coalesce(dominant_group, 'None') AS dominant_group, count(*) AS rows, {STATS} FROM ins GROUP BY 1, 2",
    "level dominant_group rows count", "sum avg min max median", VIEW))(
    lambda spark, sf: dq.aggregate(insights(spark, sf), "economic.sales", ALL, ["level", "analysis.demographics.dominant_group"])
    .withColumnRenamed("analysis.demographics.dominant_group", "dominant_group"))

QUERY = {
    "target": "economic.sales", "aggregations": ALL, "group_by": ["level"],
    "filters": {"time": {"start": "1996-01-01", "end": "1999-12-31"}, "top_n": {"count": 3000}},
    "compare": {"type": "yoy"},
}
KEPT = "(SELECT * FROM ins WHERE date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' ORDER BY sales DESC NULLS LAST, spatial_label, date, level LIMIT 3000)"
check("q5_summary_groups", statement(f"SELECT level, count(*) AS rows, {STATS} FROM {KEPT} GROUP BY 1", "level rows count", "sum avg min max median", VIEW))(
    lambda spark, sf: dq.summarize(insights(spark, sf), QUERY).groups)
check("q5_summary", statement(f"SELECT count(*) AS rows, {STATS} FROM {KEPT}", "rows count", "sum avg min max median", VIEW))(
    lambda spark, sf: dq.summarize(insights(spark, sf), QUERY).aggregations)

check("q1_validated_query", statement(f"SELECT count(*) AS rows, avg(sales) AS avg FROM ins", "rows", "avg", VIEW))(
    lambda spark, sf: dq.aggregate(insights(spark, sf), dq.validate_query({"target": "economic.sales"})["target"], dq.DEFAULT_AGGREGATIONS))


def _long(alias: str, low: str, high: str) -> str:
    return (f"{alias} AS (UNPIVOT (SELECT sum(sales) AS sum, avg(sales) AS avg, min(sales) AS min, max(sales) AS max, median(sales) AS median, "
            f"CAST(count(sales) AS DOUBLE) AS count FROM ins WHERE date BETWEEN DATE '{low}' AND DATE '{high}') "
            f"ON sum, avg, min, max, median, count INTO NAME aggregation VALUE value)")


COMPARED = ("SELECT p.aggregation, c.value AS current, p.value AS previous, c.value - p.value AS delta "
            "FROM prev p LEFT JOIN cur c ON c.aggregation = p.aggregation")
for _kind, _compare, _from, _to in (
    ("yoy", {"type": "yoy"}, "1995-01-01", "1998-12-31"), ("mom", {"type": "mom"}, "1995-12-01", "1999-11-30"),
    ("custom", {"type": "custom", "interval": "26w"}, "1995-07-03", "1999-07-02"),
):
    check(f"q6_compare_{_kind}", statement(COMPARED, "aggregation", "current previous delta",
          VIEW + ", " + _long("cur", "1996-01-01", "1999-12-31") + ", " + _long("prev", _from, _to)))(
        lambda spark, sf, compare=_compare: dq.compare_periods(insights(spark, sf), {**QUERY, "compare": compare}))

check("q7_projection", statement(
    "SELECT spatial_label AS spatial, CAST(date AS VARCHAR) AS time, 'population.foot_traffic' AS path, foot_traffic AS value, "
    "dominant_group FROM ins", "spatial time path dominant_group", "value", VIEW))(
    lambda spark, sf: dq.project(insights(spark, sf), "population.foot_traffic").select(
        "spatial", "time", "target.path", "target.value", "analysis.demographics.dominant_group"))

check("q8_nested_insights", statement(
    "SELECT spatial_label AS spatial, CAST(date AS VARCHAR) AS time, level, sales_rank, ft_prev AS foot_traffic_prev, sales_yoy_pct, "
    "ft_zscore AS foot_traffic_zscore, corr_sales_foot_traffic FROM ins", "spatial time level sales_rank",
    "foot_traffic_prev sales_yoy_pct foot_traffic_zscore corr_sales_foot_traffic", VIEW))(
    lambda spark, sf: insights(spark, sf).select(
        "spatial", F.col("time").cast("string").alias("time"), "level", "economic.sales_rank", "population.foot_traffic_prev", "analysis.trend.sales_yoy_pct",
        "analysis.anomalies.foot_traffic_zscore", "analysis.impact.corr_sales_foot_traffic"))


@check("d9_stored_results", statement("SELECT 'file' AS origin, * FROM (" + CAST_DATE + ") UNION ALL SELECT 'batch', * FROM (" + CAST_DATE + ")",
                                      "origin " + ROWS, "sales foot_traffic", VIEW))
def stored_results(spark, sf):
    """The same insight rows from a JSON folder and as the newest batch of a table."""
    rows = insights(spark, sf)
    path = new_folder(spark, "results")
    rows.write.json(path)
    payload = rows.select(F.to_json(F.struct(*rows.columns)).alias("payload"))
    batches = payload.withColumn("generated_at", F.lit("2025-01-02")).unionByName(
        payload.where(F.col("payload").contains('"level":"sig"')).withColumn("generated_at", F.lit("2025-01-01")))
    return flat(dq.read_results(spark, path, rows.schema)).withColumn("origin", F.lit("file")).unionByName(
        flat(dq.latest_batch(batches, rows.schema)).withColumn("origin", F.lit("batch")))
