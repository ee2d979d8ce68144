"""Records, metrics and insights; daily records come from the events table."""

from pyspark.sql import functions as F

from areapulse.checks.ingest_checks import SALES_AMOUNTS, SALES_COUNTS, SALES_KEY, num, text
from areapulse.checks.registry import check
from areapulse.checks.sqltext import statement
from areapulse.functions.text import DISTRICT_NAMES, age_label, region_name
from areapulse.operators import insight, records as rec, series
from areapulse.sources.rawdata import raw_frame, raw_sql
from areapulse.sources.staging import table

# Records from raw files ----------------------------------------------------------------------


def known(column: str) -> str:
    return f"CASE WHEN lower(trim({column})) NOT IN ('', 'nan', 'none') THEN trim({column}) END"


check("n17_categories", f"""SELECT STD_YM, SGG_CODE, large, medium, small, coalesce(small, medium, large) AS sector, count(*) AS n
  FROM (SELECT *, {known('LCLS_NM')} AS large, {known('MCLS_NM')} AS medium, {known('SCLS_NM')} AS small FROM ({raw_sql('sales')})) GROUP BY ALL""")(
    lambda spark, sf: _categories(raw_frame(spark, sf, "sales")))


def _categories(raw):
    kind, sector = rec.category(raw)
    names = [F.col(f"k.{c}").alias(c) for c in ("large", "medium", "small")]
    return raw.select("STD_YM", "SGG_CODE", kind.alias("k"), sector.alias("sector")).groupBy(
        "STD_YM", "SGG_CODE", *names, "sector").agg(F.count(F.lit(1)).alias("n"))


check("n18_sales_records", statement(
    f"SELECT {SALES_KEY} AS spatial_key, STD_YM AS time_key, {num(*SALES_AMOUNTS)} AS sales, {num(*SALES_COUNTS)} AS sales_count, "
    f"'sales' AS source FROM ({raw_sql('sales')})", "spatial_key time_key source", "sales sales_count", "",
))(lambda spark, sf: rec.sales_records(raw_frame(spark, sf, "sales")).select(
    "spatial_key", "time_key", "source", "economic.sales", "economic.sales_count"))

check("n18_telco_records", statement(
    f"SELECT {text('VST_SGG_CD')} AS spatial_key, left(CRTR_YM, 4) || '-' || right(CRTR_YM, 2) AS time_key, 'telco' AS source, "
    f"CAST(DAY_CNT AS INTEGER) AS day_index, {num('ML_VST_PPLTN_10', 'ML_VST_PPLTN_20')} AS male, {num('FM_VST_PPLTN_10')} AS female, "
    f"{num('ML_VST_PPLTN_10', 'ML_VST_PPLTN_20', 'FM_VST_PPLTN_10')} AS foot_traffic FROM ({raw_sql('telco')})",
    "spatial_key time_key source day_index", "male female foot_traffic", "",
))(lambda spark, sf: rec.telco_records(raw_frame(spark, sf, "telco")).select(
    "spatial_key", "time_key", "source", "behavior.day_index", F.col("population.demographics")["male"].alias("male"),
    F.col("population.demographics")["female"].alias("female"), "population.foot_traffic"))

GRID_NUMBERS = ["VST_ML_PPLTN_CNT_20_24", "VST_ML_PPLTN_CNT_70_ABV", "VST_FM_PPLTN_CNT_20_24"]
check("n18_telco_grid_records", statement(f"""
  SELECT CASE WHEN isfinite(TRY_CAST(COORD_X AS DOUBLE)) AND isfinite(TRY_CAST(COORD_Y AS DOUBLE))
    THEN printf('%.5f,%.5f', TRY_CAST(COORD_Y AS DOUBLE), TRY_CAST(COORD_X AS DOUBLE)) || ' (' || SM_LC_CD || ')' ELSE SM_LC_CD END AS spatial_key,
    CASE WHEN regexp_full_match(CRTR_YMD, '\\d{{8}}') THEN left(CRTR_YMD, 4) || '-' || substr(CRTR_YMD, 5, 2) || '-' || right(CRTR_YMD, 2)
         WHEN CRTR_YMD <> '' THEN CRTR_YMD ELSE left(CRTR_YM, 4) || '-' || right(CRTR_YM, 2) || '-01' END AS time_key,
    sum({num(*GRID_NUMBERS)}) AS foot_traffic, sum({num(GRID_NUMBERS[1])}) AS male_70, sum({num(GRID_NUMBERS[2])}) AS female_20
  FROM ({raw_sql('telco_grid')}) GROUP BY 1, 2""", "spatial_key time_key", "foot_traffic male_70 female_20", "",
))(lambda spark, sf: rec.telco_grid_records(raw_frame(spark, sf, "telco_grid")).select(
    "spatial_key", "time_key", "population.foot_traffic", F.col("population.demographics")["male_by_age.70_ABV"].alias("male_70"),
    F.col("population.demographics")["female_by_age.20_24"].alias("female_20")))

# Daily records from events -------------------------------------------------------------------

EVENTS = """SELECT event_id, CAST(44100 + user_id AS STRING) || '.0' AS spatial_key, CAST(CAST(ts AS DATE) AS STRING) AS time_key,
  CASE WHEN event_type IN ('view', 'click') THEN 'telco' WHEN event_type IN ('purchase', 'signup') THEN 'sales' END AS source,
  CASE WHEN event_type NOT IN ('purchase', 'signup') THEN CAST(1 AS DOUBLE) END AS foot_traffic,
  CASE WHEN event_type IN ('purchase', 'signup') THEN value END AS sales, event_type, value FROM {events}"""


def event_records(spark, sf):
    rows = spark.sql(EVENTS, events=table(spark, sf, "events"))
    group = F.when(F.col("source").isNull() | (F.col("source") == "telco"), F.create_map("event_type", "value"))
    return rec.build_records(
        rows, F.col("source"), spatial_key=F.col("spatial_key"), time_key=F.col("time_key"),
        population=rec.population(F.col("foot_traffic"), group), economic=rec.economic(F.col("sales"), F.lit(None)))


def normal_records(spark, sf):
    return rec.normalise(event_records(spark, sf))


DISTRICTS = "districts(code, name) AS (VALUES " + ", ".join(f"('{c}', '{n}')" for c, n in DISTRICT_NAMES.items()) + ")"
RECORDS = f"""{DISTRICTS},
raw_events AS ({EVENTS.format(events='events')}),
rec AS (SELECT event_id, coalesce(name, left(spatial_key, 5)) AS spatial_key, CAST(time_key AS DATE) AS d,
    CASE WHEN time_key LIKE '%-01' THEN left(time_key, 7) ELSE time_key END AS time_key, coalesce(source, 'unknown') AS source,
    coalesce(foot_traffic, 0) AS foot_traffic, coalesce(sales, 0) AS sales, event_type, value
  FROM raw_events LEFT JOIN districts ON code = left(spatial_key, 5)),
buckets AS (SELECT spatial_key, time_key, d, sum(foot_traffic) AS foot_traffic, sum(sales) AS sales,
    string_agg(DISTINCT source, '+' ORDER BY source) AS source FROM rec GROUP BY 1, 2, 3),
series AS (SELECT source, spatial_key, time_key, d, sum(CASE source WHEN 'telco' THEN foot_traffic ELSE sales END) AS current
  FROM rec WHERE source IN ('telco', 'sales') GROUP BY ALL),
windows AS (SELECT *, lag(current) OVER w AS previous, count(*) OVER w AS points, avg(current) OVER w AS mean, stddev_pop(current) OVER w AS spread,
    CASE WHEN source = 'telco' AND count(*) OVER t7 = 7 THEN avg(current) OVER t7
         WHEN source = 'sales' AND count(*) OVER t3 = 3 THEN avg(current) OVER t3 END AS baseline
  FROM series WINDOW w AS (PARTITION BY source, spatial_key ORDER BY d ROWS UNBOUNDED PRECEDING),
    t7 AS (PARTITION BY source, spatial_key ORDER BY d ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING),
    t3 AS (PARTITION BY source, spatial_key ORDER BY d ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)),
metrics AS (SELECT source, spatial_key, time_key, d, current, baseline, CASE source WHEN 'telco' THEN 'day' ELSE 'month' END AS time_unit,
    (current - baseline) / nullif(baseline, 0) AS uplift, (current - previous) / nullif(previous, 0) AS rate_of_change,
    CASE WHEN points >= 2 THEN spread / nullif(mean, 0) END AS volatility FROM windows),
impact AS (SELECT spatial_key, time_key, avg(uplift) AS impact_score, count(uplift) AS impact_sources FROM metrics GROUP BY 1, 2),
placed AS (SELECT *, CAST(row_number() OVER (PARTITION BY spatial_key, sales IS NULL ORDER BY d) AS DOUBLE) AS x FROM buckets),
slopes AS (SELECT *, CASE WHEN count(*) OVER w >= 2 THEN regr_slope(sales, x) OVER w END AS slope,
    greatest(1e-6, abs(avg(sales) OVER w) * 0.01) AS lim
  FROM placed WINDOW w AS (PARTITION BY spatial_key, sales IS NULL ORDER BY d ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)),
trends AS (SELECT *, CASE WHEN slope > lim THEN 'increase' WHEN slope < -lim THEN 'decrease' WHEN slope IS NOT NULL THEN 'stable' END AS direction
  FROM slopes),
corrs AS (SELECT spatial_key, count(*) AS sample_size, CASE WHEN count(*) >= 3 AND count(DISTINCT foot_traffic) > 1 AND count(DISTINCT sales) > 1
    THEN corr(foot_traffic, sales) END AS correlation FROM buckets GROUP BY 1),
group_sums AS (SELECT spatial_key, time_key, event_type AS grp, sum(value) AS value FROM rec WHERE source <> 'sales' GROUP BY 1, 2, 3),
leaders AS (SELECT spatial_key, time_key, arg_min(grp, (-value, grp)) AS dominant_group, max(value) / nullif(sum(value), 0) AS dominant_share,
    string_agg(grp, ',' ORDER BY value DESC, grp) AS top_groups FROM group_sums GROUP BY 1, 2)
"""
METRIC_VALUES = "baseline current uplift volatility rate_of_change"

check("n19_missing_fields", statement(
    "SELECT spatial_key, time_key, coalesce(source, 'unknown') AS source, coalesce(foot_traffic, 0) AS foot_traffic, "
    "coalesce(sales, 0) AS sales, CAST(0 AS DOUBLE) AS sales_count FROM raw_events", "spatial_key time_key source",
    "foot_traffic sales sales_count", RECORDS,
))(lambda spark, sf: rec.fill_missing(event_records(spark, sf)).select(
    "spatial_key", "time_key", "source", "population.foot_traffic", "economic.sales", "economic.sales_count"))

check("n20_common_axes", statement("SELECT * FROM rec", "spatial_key time_key source", "foot_traffic sales", RECORDS))(
    lambda spark, sf: normal_records(spark, sf).select("spatial_key", "time_key", "source", "population.foot_traffic", "economic.sales"))

PLACES = """SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN CAST(44100 + c_nationkey * 10 AS STRING)
  WHEN 'FURNITURE' THEN CAST(46110 + c_nationkey AS STRING) || '.0' WHEN 'MACHINERY' THEN '서울 ' || c_name
  WHEN 'HOUSEHOLD' THEN c_name || '시' ELSE ' ' || c_name || '군 ' END AS place FROM {customer}"""
check("n21_region_names", f"""WITH {DISTRICTS} SELECT c_custkey, CASE
    WHEN code IS NOT NULL THEN coalesce(name, code) WHEN regexp_matches(plain, '(구|시|군)$') THEN plain ELSE plain || '구' END AS place
  FROM (SELECT c_custkey, trim(replace(trim(place), '서울', '')) AS plain,
    CASE WHEN regexp_full_match(place, '\\d+(\\.0)?') THEN replace(place, '.0', '') END AS code FROM ({PLACES.format(customer='customer')})) p
  LEFT JOIN districts ON districts.code = p.code""".replace("CASE\n    WHEN code IS", "CASE\n    WHEN p.code IS").replace(
    "coalesce(name, code)", "coalesce(name, p.code)"))(
    lambda spark, sf: spark.sql(PLACES, customer=table(spark, sf, "customer")).select("c_custkey", region_name(F.col("place")).alias("place")))

check("n22_age_labels", """SELECT p_partkey, CAST(p_size // 10 AS VARCHAR) || '0s' AS age,
  CAST(p_size // 10 AS VARCHAR) || '0s' || CASE WHEN p_type = 'ECONOMY' THEN '' ELSE '_' || p_brand END AS age_sex FROM part""")(
    lambda spark, sf: table(spark, sf, "part").select("p_partkey", age_label(F.col("p_size")).alias("age"), age_label(
        F.col("p_size"), F.when(F.col("p_type") != "ECONOMY", F.col("p_brand"))).alias("age_sex")))

check("n23_incomplete_records", """SELECT count(*) AS n, sum(CAST(source IS NULL AS INTEGER)) AS without_source FROM (
  SELECT CASE WHEN event_type IN ('view', 'click') THEN 'telco' WHEN event_type IN ('purchase', 'signup') THEN 'sales' END AS source FROM events)
  WHERE source IS NULL""".replace("sum(CAST(source IS NULL AS INTEGER))", "CAST(count(*) AS BIGINT)"))(
    lambda spark, sf: rec.incomplete(rec.validate(event_records(spark, sf))).agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.array_contains("empty_fields", "source"), 1)).alias("without_source")))

check("j10_fused_buckets", statement("SELECT * FROM buckets", "spatial_key time_key source", "foot_traffic sales", RECORDS))(
    lambda spark, sf: rec.fuse(normal_records(spark, sf)).select(
        "spatial_key", "time_key", rec.source_label(F.col("sources")).alias("source"), "foot_traffic", "sales"))

check("w10_trailing_baseline", statement("SELECT * FROM metrics", "source spatial_key time_key", "current baseline", RECORDS))(
    lambda spark, sf: series.domain_metrics(normal_records(spark, sf)).select("source", "spatial_key", "time_key", "current", "baseline"))

check("w11_dynamic_baseline", statement("""
  SELECT source, spatial_key, time_key, duration, CASE WHEN rn = 1 AND duration = 1 THEN current
    WHEN rn > duration THEN list_sum(list_slice(before, rn - duration, rn - 1)) / duration END AS baseline
  FROM (SELECT *, row_number() OVER w AS rn, 1 + day(d) // 8 AS duration,
      array_agg(current) OVER (PARTITION BY source, spatial_key ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
    FROM series WINDOW w AS (PARTITION BY source, spatial_key ORDER BY d))""",
    "source spatial_key time_key duration", "baseline", RECORDS,
))(lambda spark, sf: series.dynamic_baseline(series.domain_series(normal_records(spark, sf)).withColumn(
    "duration", (1 + F.floor(F.dayofmonth("_date") / 8)).cast("long")), "duration").select(
        "source", "spatial_key", "time_key", "duration", "baseline"))

ONE_PLACE = """SELECT 'sales' AS source, 'all' AS spatial_key, CAST(event_id AS STRING) AS time_key, ts AS _date, value AS current,
  1 + event_id % 10000 AS duration FROM {events}"""


def one_place(spark, sf):
    """All events as the history of one place."""
    return spark.sql(ONE_PLACE, events=table(spark, sf, "events"))


check("w11_long_durations", statement(f"""
  SELECT time_key, duration, CASE WHEN rn = 1 AND duration = 1 THEN current WHEN rn > duration THEN
    sum(current) OVER (ORDER BY rn ROWS BETWEEN duration PRECEDING AND 1 PRECEDING) / duration END AS baseline
  FROM (SELECT *, row_number() OVER (ORDER BY _date, time_key) AS rn FROM ({ONE_PLACE.format(events='events')}))""",
    "time_key duration", "baseline", "",
))(lambda spark, sf: series.dynamic_baseline(one_place(spark, sf), "duration").select("time_key", "duration", "baseline"))

check("w13_one_place", statement(f"""
  SELECT time_key, CASE WHEN count(*) OVER w >= 2 THEN stddev_pop(current) OVER w / nullif(avg(current) OVER w, 0) END AS volatility,
    CASE WHEN count(*) OVER b = 3 THEN avg(current) OVER b END AS baseline
  FROM ({ONE_PLACE.format(events='events')})
  WINDOW w AS (ORDER BY _date, time_key ROWS UNBOUNDED PRECEDING), b AS (ORDER BY _date, time_key ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)""",
    "time_key", "volatility baseline", "",
))(lambda spark, sf: series.volatility(series.blocks_of(one_place(spark, sf), before=3, rows=512), "current").withColumn(
    "baseline", series.trailing_mean("current", 3)).where("not _halo").select("time_key", "volatility", "baseline"))

check("w12_uplift_and_rate", statement("SELECT * FROM metrics", "source spatial_key time_key", "uplift rate_of_change", RECORDS))(
    lambda spark, sf: series.domain_metrics(normal_records(spark, sf)).select("source", "spatial_key", "time_key", "uplift", "rate_of_change"))

check("w13_volatility", statement("SELECT * FROM metrics", "source spatial_key time_key", "volatility", RECORDS))(
    lambda spark, sf: series.domain_metrics(normal_records(spark, sf)).select("source", "spatial_key", "time_key", "volatility"))

check("w14_trend", statement("SELECT * FROM trends", "spatial_key time_key direction", "slope", RECORDS))(
    lambda spark, sf: series.trend(rec.fuse(normal_records(spark, sf)), "sales", ["spatial_key"], "time_key").select(
        "spatial_key", "time_key", "direction", "slope"))

check("m1_domain_metrics", statement("SELECT * FROM metrics", "source spatial_key time_key time_unit", METRIC_VALUES, RECORDS))(
    lambda spark, sf: series.domain_metrics(normal_records(spark, sf)))

check("m2_cross_domain_score", statement(
    "SELECT spatial_key, time_key, CASE WHEN impact_sources >= 2 THEN impact_score END AS cross_domain_score FROM impact",
    "spatial_key time_key", "cross_domain_score", RECORDS,
))(lambda spark, sf: insight.impact(series.domain_metrics(normal_records(spark, sf))).select("spatial_key", "time_key", "cross_domain_score"))

CLASS = "CASE WHEN impact_score >= 0.2 THEN 'high' WHEN impact_score >= 0.05 THEN 'moderate' WHEN impact_score IS NOT NULL THEN 'low' END"
check("m3_impact_class", statement(
    f"SELECT *, {CLASS} AS classification FROM impact", "spatial_key time_key impact_sources classification", "impact_score", RECORDS,
))(lambda spark, sf: insight.impact(series.domain_metrics(normal_records(spark, sf))).drop("cross_domain_score"))

STRENGTH = "CASE WHEN abs(correlation) >= 0.75 THEN 'strong' WHEN abs(correlation) >= 0.4 THEN 'moderate' WHEN correlation IS NOT NULL THEN 'weak' END"
check("m4_place_correlation", statement(
    f"SELECT *, {STRENGTH} AS interpretation FROM corrs", "spatial_key sample_size interpretation", "correlation", RECORDS,
))(lambda spark, sf: insight.place_correlation(rec.fuse(normal_records(spark, sf))))

check("m5_highlights", statement(
    "SELECT spatial_key, time_key, source AS domain, rate_of_change, volatility FROM metrics WHERE rate_of_change IS NOT NULL OR volatility IS NOT NULL",
    "spatial_key time_key domain", "rate_of_change volatility", RECORDS,
))(lambda spark, sf: insight.highlights(series.domain_metrics(normal_records(spark, sf))).select(
    "spatial_key", "time_key", F.inline("metrics_summary")))

check("m6_composition_shift", statement("""
  SELECT b.event_type, b.hour, (a.n - b.n) / nullif(b.n, 0) AS shift FROM
    (SELECT event_type, hour(ts) AS hour, CAST(count(*) AS DOUBLE) AS n FROM events WHERE ts < TIMESTAMP '2024-01-16' GROUP BY 1, 2) b LEFT JOIN
    (SELECT event_type, hour(ts) AS hour, CAST(count(*) AS DOUBLE) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-16' GROUP BY 1, 2) a
  ON a.event_type = b.event_type AND a.hour = b.hour""", "event_type hour", "shift", "",
))(lambda spark, sf: series.composition_shift(*[
    table(spark, sf, "events").where(half).groupBy("event_type", F.hour("ts").cast("long").alias("hour")).agg(
        F.count(F.lit(1)).cast("double").alias("n"))
    for half in ("ts < timestamp_ntz'2024-01-16'", "ts >= timestamp_ntz'2024-01-16'")
], ["event_type", "hour"], "n"))

check("m7_elasticity", statement(
    "SELECT t.spatial_key, t.time_key, s.uplift / nullif(t.uplift, 0) AS elasticity FROM metrics t JOIN metrics s "
    "ON s.spatial_key = t.spatial_key AND s.time_key = t.time_key AND s.source = 'sales' WHERE t.source = 'telco'",
    "spatial_key time_key", "elasticity", RECORDS,
))(lambda spark, sf: _elasticity(series.domain_metrics(normal_records(spark, sf))))


def _elasticity(metrics):
    def uplift(source):
        return F.max(F.when(F.col("source") == source, F.col("uplift")))
    both = metrics.groupBy("spatial_key", "time_key").agg(
        uplift("telco").alias("t"), uplift("sales").alias("s"), F.countDistinct("source").alias("n"))
    return both.where("n = 2").select("spatial_key", "time_key", series.elasticity(F.col("t"), F.col("s")).alias("elasticity"))


check("a22_bucket_summary", statement(
    "SELECT b.*, coalesce(n, 0) AS lists FROM buckets b LEFT JOIN (SELECT spatial_key, time_key, count(*) AS n FROM rec "
    "WHERE source <> 'sales' GROUP BY 1, 2) l ON l.spatial_key = b.spatial_key AND l.time_key = b.time_key",
    "spatial_key time_key lists", "foot_traffic sales", RECORDS,
))(lambda spark, sf: insight.bucket_summary(normal_records(spark, sf)).select(
    "spatial_key", "time_key", "foot_traffic", "sales", F.coalesce(F.size("demographics"), F.lit(0)).cast("long").alias("lists")))

check("a23_source_labels", statement("SELECT source, count(*) AS n FROM buckets GROUP BY 1", "source n", "", RECORDS))(
    lambda spark, sf: rec.fuse(normal_records(spark, sf)).groupBy(rec.source_label(F.col("sources")).alias("source")).agg(
        F.count(F.lit(1)).alias("n")))

check("a24_leading_groups", statement("SELECT * FROM leaders", "spatial_key time_key dominant_group top_groups", "dominant_share", RECORDS))(
    lambda spark, sf: insight.leading_groups(normal_records(spark, sf)).withColumn(
        "top_groups", F.array_join(F.transform("top_groups", lambda g: g["group"]), ",")))

FULL = f"""SELECT b.spatial_key, b.time_key, b.source, b.foot_traffic, b.sales, t.direction, t.slope, c.sample_size, c.correlation,
    {STRENGTH.replace('correlation', 'c.correlation')} AS interpretation, i.impact_score, coalesce(i.impact_sources, 0) AS impact_sources,
    {CLASS} AS classification, l.dominant_group, l.dominant_share,
    coalesce(m.temporal_unit, 'time_series') AS temporal_unit, h.domain, h.rate_of_change, h.volatility
  FROM buckets b JOIN trends t USING (spatial_key, time_key) LEFT JOIN corrs c USING (spatial_key)
  LEFT JOIN impact i USING (spatial_key, time_key) LEFT JOIN leaders l USING (spatial_key, time_key)
  LEFT JOIN (SELECT spatial_key, time_key, arg_min(time_unit, source) AS temporal_unit FROM metrics GROUP BY 1, 2) m USING (spatial_key, time_key)
  LEFT JOIN (SELECT spatial_key, time_key, source AS domain, rate_of_change, volatility FROM metrics
      WHERE rate_of_change IS NOT NULL OR volatility IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY spatial_key, time_key ORDER BY source) = 1) h USING (spatial_key, time_key)"""
check("m8_narratives", statement(f"""SELECT spatial_key, time_key, spatial_key || ' @ ' || time_key || ': trend=' || coalesce(direction, 'insufficient data')
    || ', traffic-sales correlation=' || coalesce(printf('%.2f', correlation) || ' (' || interpretation || ')', 'not enough observations')
    || ', impact=' || coalesce(classification, 'unknown') || ', leading demographic=' || coalesce(dominant_group, 'no dominant group')
    || ', metrics=' || coalesce(domain || ' ' || concat_ws('/', 'Δ=' || printf('%.2f', rate_of_change), 'vol=' || printf('%.2f', volatility)), 'n/a')
    || '.' AS narrative FROM ({FULL})""", "spatial_key time_key narrative", "", RECORDS,
))(lambda spark, sf: insight.run(event_records(spark, sf)).select("spatial_key", "time_key", "narrative"))

check("m9_insights", statement(
    FULL, "spatial_key time_key source direction sample_size interpretation impact_sources classification dominant_group temporal_unit",
    "foot_traffic sales slope correlation impact_score dominant_share", RECORDS,
))(lambda spark, sf: insight.run(event_records(spark, sf)).select(
    "spatial_key", "time_key", "source", "direction", "sample_size", "interpretation", F.col("impact_sources").cast("long"), "classification",
    "dominant_group", "temporal_unit", "foot_traffic", "sales", "slope", "correlation", "impact_score", "dominant_share"))
