"""Tools, payloads and the dataset profile."""

from pyspark.sql import functions as F

from areapulse.checks.registry import check
from areapulse.checks.sqltext import ALL_VIEWS, GOLD, TREND_NORM, YEAR_AGO, YEAR_ON_YEAR, change, statement, trend_admin
from areapulse.functions.periods import period_range, single_period
from areapulse.operators import candidates as cand, profile, rollups
from areapulse.plans import payloads, tools
from areapulse.sources.staging import gold, table

SIG = GOLD + "," + trend_admin("sig")
BOTH = ["population", "sales"]

# Profile -------------------------------------------------------------------------------------

TOTALS = """totals AS (SELECT date, sum(foot_traffic) AS foot_traffic, sum(sales) AS sales
FROM gold_activity WHERE granularity = 'month' GROUP BY 1)"""
check("a11_totals_by_date", statement("SELECT * FROM totals", "date", "foot_traffic sales", GOLD + "," + TOTALS))(
    lambda spark, sf: profile.totals_by_date(gold(spark, sf).activity))

check("a12_top_labels", statement(
    "SELECT spatial_label, sum(foot_traffic) AS foot_traffic, sum(sales) AS sales FROM trend_norm "
    "WHERE date >= DATE '1996-01-01' AND date <= DATE '2000-12-31' GROUP BY 1 "
    "ORDER BY foot_traffic DESC NULLS LAST, spatial_label LIMIT 10",
    "spatial_label", "foot_traffic sales", GOLD + "," + TREND_NORM,
))(lambda spark, sf: tools.top_labels(gold(spark, sf), start="1996", end="2000"))

for _level, _name in (("norm", "coalesce(d.spatial_label, a.spatial_key)"),
                      ("sig", "coalesce(s.sig_name, d.spatial_label, a.spatial_key)"),
                      ("sido", "coalesce(s.sido_name, d.spatial_label, a.spatial_key)")):
    _geo = f"""SELECT {_name} AS spatial_label, avg(d.lat) AS lat, avg(d.lon) AS lon,
      sum(a.foot_traffic) AS foot_traffic, sum(a.sales) AS sales
      FROM gold_activity a LEFT JOIN dim_spatial d ON d.spatial_key = a.spatial_key
      LEFT JOIN admin_sig s ON s.sig_code = left(d.code, 5) WHERE a.granularity = 'month' GROUP BY 1"""
    check(f"a13_geo_totals_{_level}", statement(_geo, "spatial_label", "lat lon foot_traffic sales"))(
        lambda spark, sf, level=_level: tools.geo_totals(gold(spark, sf), level))
    if _level == "norm":
        check("r10_geojson_features", statement(
            f"SELECT 'Feature' AS type, 'Point' AS geometry_type, * FROM ({_geo}) WHERE lat IS NOT NULL AND lon IS NOT NULL",
            "type geometry_type spatial_label", "lon lat foot_traffic sales",
        ))(lambda spark, sf: payloads.features(tools.geo_totals(gold(spark, sf))).select(F.from_json(
            "feature", "type string, properties struct<spatial_label:string,foot_traffic:double,sales:double>, "
            "geometry struct<type:string,coordinates:array<double>>").alias("f")).select(
            "f.type", F.col("f.geometry.type").alias("geometry_type"), "f.properties.*",
            F.col("f.geometry.coordinates")[0].alias("lon"), F.col("f.geometry.coordinates")[1].alias("lat")))

check("a14_overview", statement(
    "SELECT min(date) AS date_min, max(date) AS date_max, count(*) AS row_count, "
    "count(DISTINCT spatial_key) AS spatial_count, count(DISTINCT date) AS date_count FROM gold_activity",
    "date_min date_max row_count spatial_count date_count"))(lambda spark, sf: profile.overview(gold(spark, sf).activity))

check("a15_row_counts", statement(
    "SELECT 'date' AS kind, date, CAST(NULL AS VARCHAR) AS source, count(*) AS n FROM gold_activity GROUP BY date "
    "UNION ALL SELECT 'date_source', date, source, count(*) FROM gold_activity GROUP BY date, source "
    "UNION ALL SELECT 'source', NULL, source, count(*) FROM gold_activity GROUP BY source",
    "kind date source n"))(lambda spark, sf: profile.row_counts(gold(spark, sf).activity))

PLACED = "(SELECT s.sig_name, s.sido_name FROM dim_spatial d JOIN admin_sig s ON s.sig_code = left(coalesce(d.emd_code, d.code), 5))"
check("a16_dimension_counts", statement(
    f"""(SELECT 'label' AS kind, spatial_label AS name, count(*) AS n FROM dim_spatial WHERE spatial_label IS NOT NULL
         GROUP BY 2 ORDER BY n DESC, name LIMIT 10)
    UNION ALL SELECT 'type', coalesce(spatial_type, 'unknown'), count(*) FROM dim_spatial GROUP BY 2
    UNION ALL (SELECT 'sig', sig_name, count(*) AS n FROM {PLACED} GROUP BY 2 ORDER BY n DESC, sig_name LIMIT 10)
    UNION ALL (SELECT 'sido', sido_name, count(*) AS n FROM {PLACED} GROUP BY 2 ORDER BY n DESC, sido_name LIMIT 10)
    UNION ALL SELECT 'table', 'admin_sig', count(*) FROM admin_sig
    UNION ALL SELECT 'table', 'admin_sido', count(*) FROM admin_sido""", "kind name n",
))(lambda spark, sf: profile.dimension_counts(gold(spark, sf).dim, gold(spark, sf).admin_sig, gold(spark, sf).admin_sido))

check("j7_dim_with_admin", statement(
    "SELECT d.spatial_key, s.sig_name, s.sido_name FROM dim_spatial d JOIN admin_sig s "
    "ON s.sig_code = left(coalesce(d.emd_code, d.code), 5)", "spatial_key sig_name sido_name",
))(lambda spark, sf: profile.dim_with_admin(gold(spark, sf).dim, gold(spark, sf).admin_sig))

check("j11_geo_join", statement(
    "SELECT a.spatial_key, a.date, a.source, d.spatial_label, s.sig_name, s.sido_name FROM gold_activity a "
    "LEFT JOIN dim_spatial d ON d.spatial_key = a.spatial_key LEFT JOIN admin_sig s ON s.sig_code = left(d.code, 5)",
    "spatial_key date source spatial_label sig_name sido_name",
))(lambda spark, sf: gold(spark, sf).activity.select("spatial_key", "date", "source")
   .join(gold(spark, sf).dim.select("spatial_key", "spatial_label", "code"), "spatial_key", "left")
   .join(gold(spark, sf).admin_sig.drop("sido_code"), F.substring("code", 1, 5) == F.col("sig_code"), "left")
   .drop("code", "sig_code"))

check("a17_grand_totals", statement(
    "SELECT sum(coalesce(foot_traffic, 0)) AS sum_foot_traffic, sum(coalesce(sales, 0)) AS sum_sales FROM gold_activity",
    "", "sum_foot_traffic sum_sales"))(lambda spark, sf: profile.grand_totals(gold(spark, sf).activity))

check("a21_global_baseline", statement(
    """SELECT 'recent_12_months' AS period, domain, avg, change_pct, first_value, last_value, volatile_months,
      CASE WHEN abs(change_pct) < 0.02 THEN 'flat' WHEN change_pct > 0 THEN 'upward'
           WHEN change_pct IS NOT NULL THEN 'downward' END AS trend
    FROM (SELECT domain, avg(value) AS avg, arg_min(value, date) AS first_value, arg_max(value, date) AS last_value,
        (arg_max(value, date) - arg_min(value, date)) / nullif(abs(arg_min(value, date)), 0) AS change_pct,
        coalesce(string_agg(CASE WHEN abs(z) >= 2 THEN CAST(date AS VARCHAR) END, ',' ORDER BY date), '') AS volatile_months
      FROM (SELECT *, (value - avg(value) OVER (PARTITION BY domain)) / nullif(stddev_samp(value) OVER (PARTITION BY domain), 0) AS z
        FROM (UNPIVOT (SELECT * FROM totals ORDER BY date DESC LIMIT 12) ON foot_traffic, sales INTO NAME domain VALUE value))
      GROUP BY domain)""",
    "period domain trend volatile_months", "avg change_pct first_value last_value", GOLD + "," + TOTALS,
))(lambda spark, sf: profile.global_baseline(gold(spark, sf).activity).withColumn(
    "volatile_months", F.array_join(F.transform("volatile_months", lambda d: d.cast("string")), ",")))

GLOBAL = f"""series AS (SELECT 'total' AS level, *, lag(foot_traffic) OVER w AS ft_prev, lag(sales) OVER w AS sales_prev,
  lag(foot_traffic, 12) OVER w AS ft_prev_year, lag(sales, 12) OVER w AS sales_prev_year,
  avg(foot_traffic) OVER () AS ft_avg, avg(sales) OVER () AS sales_avg,
  stddev_samp(foot_traffic) OVER () AS ft_std, stddev_samp(sales) OVER () AS sales_std
  FROM totals WINDOW w AS (ORDER BY date)),
global_series AS (SELECT *, {change('foot_traffic', 'ft_prev')} AS ft_mom_pct, {change('sales', 'sales_prev')} AS sales_mom_pct,
  {change('foot_traffic', 'ft_prev_year')} AS ft_yoy_pct, {change('sales', 'sales_prev_year')} AS sales_yoy_pct,
  (foot_traffic - ft_avg) / nullif(ft_std, 0) AS ft_zscore, (sales - sales_avg) / nullif(sales_std, 0) AS sales_zscore,
  CAST(NULL AS VARCHAR) AS dominant_group FROM series)"""
GLOBAL_VIEWS = ",".join([GOLD, TOTALS, GLOBAL])
SERIES = ("foot_traffic sales ft_prev sales_prev ft_prev_year sales_prev_year ft_avg sales_avg ft_std sales_std "
          "ft_mom_pct sales_mom_pct ft_yoy_pct sales_yoy_pct ft_zscore sales_zscore")
check("w15_global_series", statement("SELECT * FROM global_series", "level date", SERIES, GLOBAL_VIEWS))(
    lambda spark, sf: profile.global_series(gold(spark, sf).activity))

# Tools ---------------------------------------------------------------------------------------

check("k1_rankings", statement(
    "SELECT spatial_label, date, 'sales' AS metric, sales AS value FROM trend_sig WHERE date = DATE '1998-05-01' "
    "ORDER BY sales DESC NULLS LAST, spatial_label LIMIT 10", "spatial_label date metric", "value", SIG,
))(lambda spark, sf: tools.rankings(gold(spark, sf), "sales", "1998-05", 10, "sig"))

check("r2_rankings_of_year", statement(
    "SELECT spatial_label, date, 'foot_traffic' AS metric, foot_traffic AS value FROM trend_sig "
    "WHERE date = (SELECT max(date) FROM gold_activity WHERE year(date) = 1999) "
    "ORDER BY foot_traffic DESC NULLS LAST, spatial_label LIMIT 500", "spatial_label date metric", "value", SIG,
))(lambda spark, sf: tools.rankings(gold(spark, sf), "activity_volume", "1999", 500, "sig"))

check("k2_latest_row", statement(
    "SELECT * FROM candidate_sig QUALIFY row_number() OVER (PARTITION BY spatial_label ORDER BY date DESC) = 1",
    "spatial_label date", "foot_traffic sales ft_mom_pct sales_mom_pct", ALL_VIEWS,
))(lambda spark, sf: tools.latest_row(
    cand.lags(tools.series_at(gold(spark, sf), "sig"), ["spatial_label"], 1, "prev", "mom_pct"),
    ["spatial_label"], ["foot_traffic", "sales", "ft_mom_pct", "sales_mom_pct"]))

check("k8_latest_date_of_year", statement(
    "SELECT spatial_label, year(date) AS year, max(date) AS date FROM trend_sig GROUP BY 1, 2",
    "spatial_label year date", "", SIG,
))(lambda spark, sf: tools.latest_by_year(tools.series_at(gold(spark, sf), "sig"), ["spatial_label"]).select(
    "spatial_label", F.col("year").cast("long"), "date"))

check("r1_compare_domains", statement(
    """SELECT spatial_label, domain, metric, change_rate,
      CASE WHEN change_rate > 0 THEN 'up' WHEN change_rate < 0 THEN 'down' ELSE 'flat' END AS trend,
      CASE WHEN change_rate IS NULL THEN 'insufficient_data' WHEN abs(change_rate) >= 0.2 THEN 'strong_change'
           WHEN abs(change_rate) >= 0.05 THEN 'moderate_change' ELSE 'minor_change' END AS signal
    FROM (SELECT spatial_label, 'population' AS domain, 'foot_traffic' AS metric, ft_mom_pct AS change_rate FROM latest
          UNION ALL SELECT spatial_label, 'sales', 'sales', sales_mom_pct FROM latest)""",
    "spatial_label domain metric trend signal", "change_rate",
    ALL_VIEWS + """, latest AS (SELECT * FROM candidate_sig WHERE date BETWEEN DATE '1996-01-01' AND DATE '2000-06-30'
      QUALIFY row_number() OVER (PARTITION BY spatial_label ORDER BY date DESC) = 1)""",
))(lambda spark, sf: tools.compare_domains(gold(spark, sf), BOTH, "1996", "2000-06-30", level="sig"))

check("r3_detect_anomaly", statement(
    "SELECT spatial_label, 'foot_traffic' AS metric, date, foot_traffic AS value, ft_zscore AS zscore, 1.5 AS threshold, "
    "coalesce(abs(ft_zscore) >= 1.5, false) AS is_anomaly FROM candidate_norm",
    "spatial_label metric date is_anomaly", "value zscore threshold", ALL_VIEWS,
))(lambda spark, sf: tools.detect_anomaly(gold(spark, sf), "population", z_threshold=1.5, level="norm"))

ADVANCED = "corr_sales_foot_traffic sales_impact_slope sales_impact_score foot_traffic_impact_score"
check("r4_advanced_insight", statement(
    "SELECT *, 'population,sales' AS domains FROM advanced WHERE level = 'sido'", "level spatial_label domains", ADVANCED, ALL_VIEWS,
))(lambda spark, sf: tools.advanced_insight(gold(spark, sf), BOTH, level="sido"))

check("r5_report", statement(
    """SELECT * FROM (
      SELECT 'compare_domains' AS section, domain || ':' || CASE WHEN rate > 0 THEN 'up' WHEN rate < 0 THEN 'down' ELSE 'flat' END
        || ':' || CASE WHEN rate IS NULL THEN 'insufficient_data' WHEN abs(rate) >= 0.2 THEN 'strong_change'
           WHEN abs(rate) >= 0.05 THEN 'moderate_change' ELSE 'minor_change' END AS item, rate AS value
      FROM (SELECT 'population' AS domain, ft_mom_pct AS rate FROM latest UNION ALL SELECT 'sales', sales_mom_pct FROM latest)
      UNION ALL SELECT 'detect_anomaly', 'sales:' || CAST(coalesce(abs(sales_zscore) >= 2, false) AS VARCHAR), sales_zscore
        FROM candidate_sig WHERE spatial_label = 'NATION_3' AND date = DATE '2000-03-01'
      UNION ALL (SELECT 'get_rankings', spatial_label, sales FROM candidate_sig WHERE date = DATE '2000-03-01'
        ORDER BY sales DESC NULLS LAST, spatial_label LIMIT 10)
      UNION ALL SELECT 'get_advanced_insight', item, value FROM (UNPIVOT (SELECT * EXCLUDE (level, spatial_label) FROM advanced
        WHERE level = 'sig' AND spatial_label = 'NATION_3') ON COLUMNS(*) INTO NAME item VALUE value))""",
    "section item", "value", ALL_VIEWS + """, latest AS (SELECT * FROM candidate_sig
      WHERE spatial_label = 'NATION_3' AND date BETWEEN DATE '1999-01-01' AND DATE '2000-03-01' ORDER BY date DESC LIMIT 1)""",
))(lambda spark, sf: tools.report_rows(tools.report(gold(spark, sf), "NATION_3", "1999", "2000-03-01", "sig")))

RANGE = "date >= DATE '1997-01-01' AND date <= DATE '1999-12-31'"
check("r6_series_trend", statement(f"SELECT * FROM trend_sig WHERE {RANGE}", "spatial_label spatial_type date", "foot_traffic sales sales_count", SIG))(
    lambda spark, sf: tools.time_series(gold(spark, sf), "trend", "sig", start="1997", end="1999"))
check("r6_series_yoy", statement(
    f"SELECT * FROM ({YEAR_ON_YEAR}) WHERE {RANGE}",
    "spatial_key date", "foot_traffic foot_traffic_prev_year foot_traffic_yoy sales sales_prev_year sales_yoy", GOLD + "," + YEAR_AGO,
))(lambda spark, sf: tools.time_series(gold(spark, sf), "yoy", start="1997", end="1999"))
check("r6_series_demographics", statement(
    f"""SELECT d.spatial_key, d.date, d.source, d.sex, d.age_group, d.value, d.value / nullif(t, 0) AS share
    FROM (SELECT *, sum(value) OVER (PARTITION BY spatial_key, date, source) AS t FROM gold_demographics) d
    WHERE {RANGE} AND sex = 'female' AND age_group LIKE '20_%'""",
    "spatial_key date source sex age_group", "value share",
))(lambda spark, sf: tools.time_series(gold(spark, sf), "demographics", start="1997", end="1999", sex="female", age_like="20_%"))

check("r7_insight_rows", statement(
    f"SELECT * FROM candidate_sido WHERE {RANGE}", "spatial_label date ft_rank sales_rank",
    "foot_traffic sales ft_yoy_pct sales_yoy_pct ft_zscore sales_zscore", ALL_VIEWS,
))(lambda spark, sf: tools.insight_rows(gold(spark, sf), "sido", start="1997", end="1999").select(
    "spatial_label", "date", "ft_rank", "sales_rank", "foot_traffic", "sales", "ft_yoy_pct", "sales_yoy_pct",
    "ft_zscore", "sales_zscore"))

PERIODS = """SELECT o_orderkey,
  CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN strftime(o_orderdate, '%Y') WHEN '2' THEN strftime(o_orderdate, '%Y-%m')
    WHEN '3' THEN strftime(o_orderdate, '%Y%m%d') WHEN '4' THEN 'soon' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS period_from,
  CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%Y') WHEN 'O' THEN '1998-06' ELSE '1997-02-30' END AS period_to FROM orders"""


def _sql_period(column: str, end: bool) -> str:
    edge = "12-31" if end else "01-01"
    return (f"CASE WHEN regexp_full_match({column}, '\\d{{4}}') THEN CAST({column} || '-{edge}' AS DATE) "
            f"WHEN regexp_full_match({column}, '\\d{{4}}-\\d{{2}}') THEN CAST(try_strptime({column} || '-01', '%Y-%m-%d') AS DATE) "
            f"WHEN regexp_full_match({column}, '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN CAST(try_strptime({column}, '%Y-%m-%d') AS DATE) "
            f"WHEN regexp_full_match({column}, '\\d{{8}}') THEN CAST(try_strptime({column}, '%Y%m%d') AS DATE) END")


@check("r13_periods", f"""SELECT o_orderkey, CASE WHEN s > e THEN e ELSE s END AS period_start,
  CASE WHEN s > e THEN s ELSE e END AS period_end, CAST(date_trunc('month', coalesce(e1, s)) AS DATE) AS month
  FROM (SELECT o_orderkey, {_sql_period('period_from', False)} AS s, {_sql_period('period_to', True)} AS e,
        {_sql_period('period_to', False)} AS e1 FROM ({PERIODS}))""")
def periods(spark, sf):
    day, priority = F.col("o_orderdate"), F.substring("o_orderpriority", 1, 1)
    first = (
        F.when(priority == "1", F.date_format(day, "yyyy")).when(priority == "2", F.date_format(day, "yyyy-MM"))
        .when(priority == "3", F.date_format(day, "yyyyMMdd")).when(priority == "4", F.lit("soon"))
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
    )
    last = F.when(F.col("o_orderstatus") == "F", F.date_format(day, "yyyy")).when(
        F.col("o_orderstatus") == "O", F.lit("1998-06")).otherwise(F.lit("1997-02-30"))
    start, end = period_range(first, last)
    return table(spark, sf, "orders").select(
        "o_orderkey", start.alias("period_start"), end.alias("period_end"), single_period(first, last).alias("month"))


# Payloads ------------------------------------------------------------------------------------

EXTREMES = {"ft_mom_pct": "foot_traffic_mom", "ft_yoy_pct": "foot_traffic_yoy", "sales_mom_pct": "sales_mom", "sales_yoy_pct": "sales_yoy"}


def _sql_extremes(view: str, keys: str) -> str:
    picks = []
    for field, name in EXTREMES.items():
        for word, order in (("max", "DESC"), ("min", "ASC")):
            where = f"FILTER (WHERE {field} IS NOT NULL)"
            picks.append(f"(list(date ORDER BY {field} {order}, date) {where})[1] AS {name}_{word}_date, "
                         f"{word}({field}) AS {name}_{word}_value")
    return f"SELECT {keys}, {', '.join(picks)} FROM {view} GROUP BY {keys}"


EXTREME_DATES = [f"{n}_{w}_date" for n in EXTREMES.values() for w in ("max", "min")]
EXTREME_VALUES = [f"{n}_{w}_value" for n in EXTREMES.values() for w in ("max", "min")]


def flat_extremes(payload):
    return [F.col(f"highlights.{n}_{w}.{p}").alias(f"{n}_{w}_{p}")
            for n in EXTREMES.values() for w in ("max", "min") for p in ("date", "value")]


check("k4_extremes", statement(_sql_extremes("candidate_all", "level, spatial_label"),
      " ".join(["level", "spatial_label", *EXTREME_DATES]), " ".join(EXTREME_VALUES), ALL_VIEWS))(
    lambda spark, sf: payloads.region_payload(cand.candidates_all(gold(spark, sf))).select(
        "level", "spatial_label", *flat_extremes(None)))


def _sql_anomalies(view: str, keys: str, field: str) -> str:
    return (f"SELECT {keys}, string_agg(CAST(date AS VARCHAR), ',' ORDER BY abs({field}) DESC, date) AS dates FROM ("
            f"SELECT * FROM {view} WHERE abs({field}) >= 2 "
            f"QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY abs({field}) DESC, date) <= 5) GROUP BY {keys}")


def joined_dates(column: str):
    return F.array_join(F.transform(column, lambda r: r["date"].cast("string")), ",")


check("k5_anomalies", statement(
    "SELECT 'ft' AS measure, * FROM (" + _sql_anomalies("candidate_all", "level, spatial_label", "ft_zscore")
    + ") UNION ALL SELECT 'sales', * FROM (" + _sql_anomalies("candidate_all", "level, spatial_label", "sales_zscore") + ")",
    "measure level spatial_label dates", "", ALL_VIEWS,
))(lambda spark, sf: payloads.region_payload(cand.candidates_all(gold(spark, sf))).select(
    "level", "spatial_label",
    F.inline(F.array(
        F.struct(F.lit("ft").alias("measure"), joined_dates("highlights.foot_traffic_anomalies").alias("dates")),
        F.struct(F.lit("sales").alias("measure"), joined_dates("highlights.sales_anomalies").alias("dates")),
    ))).where(F.col("dates") != ""))

check("k6_series_tail", statement(
    "SELECT * FROM trend_norm QUALIFY row_number() OVER (PARTITION BY spatial_label ORDER BY date DESC, spatial_type DESC NULLS LAST) <= 12",
    "spatial_label spatial_type date", "foot_traffic sales", GOLD + "," + TREND_NORM,
))(lambda spark, sf: payloads.tail(tools.series_at(gold(spark, sf), "norm"), ["spatial_label"]))

check("r8_region_payload", statement(
    f"""SELECT x.*, s.date_min, s.date_max, s.months, s.tail_sales, s.dominant_group, s.dominant_share,
      coalesce(f.dates, '') AS foot_traffic_anomalies, coalesce(q.dates, '') AS sales_anomalies
    FROM ({_sql_extremes('candidate_norm', 'spatial_label')}) x
    JOIN (SELECT spatial_label, min(date) AS date_min, max(date) AS date_max, least(count(*), 12) AS months,
            sum(CASE WHEN back <= 12 THEN sales END) AS tail_sales, max(CASE WHEN back = 1 THEN dominant_group END) AS dominant_group,
            max(CASE WHEN back = 1 THEN dominant_share END) AS dominant_share
          FROM (SELECT *, row_number() OVER (PARTITION BY spatial_label ORDER BY date DESC) AS back FROM candidate_norm)
          GROUP BY 1) s ON s.spatial_label = x.spatial_label
    LEFT JOIN ({_sql_anomalies('candidate_norm', 'spatial_label', 'ft_zscore')}) f ON f.spatial_label = x.spatial_label
    LEFT JOIN ({_sql_anomalies('candidate_norm', 'spatial_label', 'sales_zscore')}) q ON q.spatial_label = x.spatial_label""",
    " ".join(["spatial_label date_min date_max months dominant_group foot_traffic_anomalies sales_anomalies", *EXTREME_DATES]),
    " ".join(["tail_sales dominant_share", *EXTREME_VALUES]), ALL_VIEWS,
))(lambda spark, sf: payloads.region_payload(cand.candidates(gold(spark, sf), "norm"), ["spatial_label"]).select(
    "spatial_label", "date_min", "date_max", F.size("series").cast("long").alias("months"),
    F.when(F.exists("domains.sales.series", lambda r: r["value"].isNotNull()), F.aggregate(
        "domains.sales.series", F.lit(0.0), lambda a, r: a + F.coalesce(r["value"], F.lit(0.0)))).alias("tail_sales"),
    "dominant_group", "dominant_share", joined_dates("highlights.foot_traffic_anomalies").alias("foot_traffic_anomalies"),
    joined_dates("domains.sales.highlights.anomalies").alias("sales_anomalies"), *flat_extremes(None)))

check("r9_global_payload", statement(
    f"SELECT x.*, d.date_min, d.date_max FROM ({_sql_extremes('global_series', 'level')}) x, "
    "(SELECT min(date) AS date_min, max(date) AS date_max FROM totals) d",
    " ".join(["level date_min date_max", *EXTREME_DATES]), " ".join(EXTREME_VALUES), GLOBAL_VIEWS,
))(lambda spark, sf: payloads.global_payload(profile.global_series(gold(spark, sf).activity)).select(
    "level", "date_min", "date_max", *flat_extremes(None)))
