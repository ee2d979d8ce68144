"""Trends, year-on-year, shares, name joins, candidates and advanced measures."""

from dataclasses import replace

from pyspark.sql import functions as F

from areapulse.checks.registry import check
from areapulse.checks.sqltext import (
    ALL_VIEWS, GOLD, GROUP_SHARES, LEADERS, TREND_NORM, YEAR_AGO, YEAR_ON_YEAR, candidate, statement, trend_admin,
    trend_admin_repeated,
)
from areapulse.operators import candidates as cand, rollups
from areapulse.session import new_folder, stage
from areapulse.sources.measures import MeasureStore
from areapulse.sources.staging import gold

SUMS = "foot_traffic sales sales_count"
TREND = "SELECT * FROM trend_{}"

check("a1_monthly_trend", statement(
    "SELECT spatial_key, date, sum(foot_traffic) AS foot_traffic, sum(sales) AS sales, sum(sales_count) AS sales_count "
    "FROM gold_activity WHERE granularity = 'month' GROUP BY 1, 2", "spatial_key date", SUMS,
))(lambda spark, sf: rollups.monthly_trend(gold(spark, sf).activity))

check("a2_trend_norm", statement("SELECT * FROM trend_norm", "spatial_label spatial_type date", SUMS, GOLD + "," + TREND_NORM))(
    lambda spark, sf: rollups.trend(gold(spark, sf), "norm"))

check("a3_trend_emd", statement(
    "SELECT * FROM trend_norm WHERE spatial_type = 'emd'", "spatial_label spatial_type date", SUMS, GOLD + "," + TREND_NORM,
))(lambda spark, sf: rollups.trend_emd(gold(spark, sf).activity, gold(spark, sf).dim))

for _id, _level in (("a4", "sig"), ("a5", "sido")):
    check(f"{_id}_trend_{_level}", statement(
        f"SELECT * FROM trend_{_level}", "spatial_label spatial_type date", SUMS, GOLD + "," + trend_admin(_level),
    ))(lambda spark, sf, level=_level: rollups.trend(gold(spark, sf), level))
    check(f"{_id}_trend_{_level}_repeated", statement(
        f"SELECT * FROM trend_{_level}", "spatial_label spatial_type date", SUMS, GOLD + "," + trend_admin_repeated(_level),
    ))(lambda spark, sf, level=_level: rollups.trend(gold(spark, sf), level, dedupe=False))

YOY_VALUES = "foot_traffic foot_traffic_prev_year foot_traffic_yoy sales sales_prev_year sales_yoy"
check("a6_year_on_year", statement(YEAR_ON_YEAR, "spatial_key date", YOY_VALUES, GOLD + "," + YEAR_AGO))(
    lambda spark, sf: rollups.year_on_year(gold(spark, sf).activity))

check("a7_top_spatial", statement(
    "SELECT date, spatial_key, sum(foot_traffic) AS foot_traffic, sum(sales) AS sales FROM gold_activity "
    "WHERE granularity = 'month' GROUP BY 1, 2", "date spatial_key", "foot_traffic sales",
))(lambda spark, sf: rollups.top_spatial(gold(spark, sf).activity))

check("a8_demographic_share", statement(GROUP_SHARES, "spatial_key date source sex age_group", "value share"))(
    lambda spark, sf: rollups.demographic_share(gold(spark, sf).demographics))

check("j1_names_by_dim", statement(
    """SELECT a.spatial_key, a.date, a.source, coalesce(d1.spatial_label, d2.spatial_label, a.spatial_key) AS spatial_label,
       coalesce(d1.spatial_type, d2.spatial_type) AS spatial_type, a.foot_traffic, a.sales
       FROM gold_activity a LEFT JOIN dim_spatial d1 ON d1.spatial_key = a.spatial_key
       LEFT JOIN dim_spatial d2 ON d2.spatial_label = a.spatial_key""",
    "spatial_key date source spatial_label spatial_type", "foot_traffic sales",
))(lambda spark, sf: rollups.named_by_dim(gold(spark, sf).activity, gold(spark, sf).dim).select(
    "spatial_key", "date", "source", "spatial_label", "spatial_type", "foot_traffic", "sales"))

check("j2_names_by_admin", statement(
    """SELECT a.spatial_key, a.date, a.source,
       coalesce(s.sido_name, n.sido_name, d.spatial_label, a.spatial_key) AS spatial_label, a.foot_traffic, a.sales
       FROM gold_activity a LEFT JOIN dim_spatial d ON d.spatial_key = a.spatial_key
       LEFT JOIN admin_sig s ON s.sig_code = left(d.code, 5)
       LEFT JOIN admin_sig n ON n.sig_name = d.spatial_label""",
    "spatial_key date source spatial_label", "foot_traffic sales",
))(lambda spark, sf: rollups.named_by_admin(
    gold(spark, sf).activity, gold(spark, sf).dim, gold(spark, sf).admin_sig, "sido",
).select("spatial_key", "date", "source", "spatial_label", "foot_traffic", "sales"))

check("j3_year_ago_pairs", statement(
    "SELECT spatial_key, date, CAST(date - INTERVAL 1 YEAR AS DATE) AS previous_date FROM year_ago WHERE months_back > 0",
    "spatial_key date previous_date", "", GOLD + "," + YEAR_AGO,
))(lambda spark, sf: rollups.year_on_year(gold(spark, sf).activity).where(
    F.col("foot_traffic_prev_year").isNotNull() | F.col("sales_prev_year").isNotNull()
).select("spatial_key", "date", F.add_months("date", -12).alias("previous_date")))

check("j4_group_totals", statement(GROUP_SHARES, "spatial_key date source sex age_group", "value total_value"))(
    lambda spark, sf: rollups.group_totals(gold(spark, sf).demographics).select(
        "spatial_key", "date", "source", "sex", "age_group", "value", "total_value"))

# Series, ranks and leaders -------------------------------------------------------------------

NORM = ",".join([GOLD, TREND_NORM, LEADERS, candidate("norm")])
BASE = ["spatial_label", "date", "foot_traffic", "sales"]


def base(spark, sf, level="norm"):
    return rollups.trend(gold(spark, sf), level).select(*BASE)


check("w1_lag1_month_on_month", statement(
    "SELECT * FROM candidate_norm", "spatial_label date", "ft_prev ft_mom_pct sales_prev sales_mom_pct", NORM,
))(lambda spark, sf: cand.lags(base(spark, sf), ["spatial_label"], 1, "prev", "mom_pct").drop("foot_traffic", "sales"))

check("w2_lag12_year_on_year", statement(
    "SELECT * FROM candidate_norm", "spatial_label date", "ft_prev_year ft_yoy_pct sales_prev_year sales_yoy_pct", NORM,
))(lambda spark, sf: cand.lags(base(spark, sf), ["spatial_label"], 12, "prev_year", "yoy_pct").drop("foot_traffic", "sales"))

check("w3_label_zscores", statement(
    "SELECT * FROM candidate_norm", "spatial_label date", "ft_avg ft_std sales_avg sales_std ft_zscore sales_zscore", NORM,
))(lambda spark, sf: cand.standardise(base(spark, sf), ["spatial_label"]).drop("foot_traffic", "sales"))

check("w4_date_averages", statement(
    "SELECT * FROM candidate_norm", "spatial_label date", "ft_avg_date sales_avg_date", NORM,
))(lambda spark, sf: cand.with_date_averages(base(spark, sf)).drop("foot_traffic", "sales"))

check("w5_date_ranks", statement(
    "SELECT * FROM candidate_norm", "spatial_label date ft_rank sales_rank", "", NORM,
))(lambda spark, sf: _ranks(stage(spark, base(spark, sf), "trend_norm", ("date",))))


def _ranks(rows):
    return cand.with_date_columns(rows, rows).select("spatial_label", "date", "ft_rank", "sales_rank")



check("w6_dominant_group", statement(
    "SELECT * FROM label_leaders", "spatial_label date dominant_group", "dominant_share", NORM,
))(lambda spark, sf: cand.dominant_groups(gold(spark, sf).demographics, gold(spark, sf).dim))

check("a18_demographic_base", statement(
    "SELECT * FROM label_groups", "spatial_label date sex age_group", "value", NORM,
))(lambda spark, sf: cand.demographic_base(gold(spark, sf).demographics, gold(spark, sf).dim))

check("j5_leader_join", statement(
    "SELECT * FROM candidate_norm", "spatial_label date dominant_group", "foot_traffic sales dominant_share", NORM,
))(lambda spark, sf: base(spark, sf).join(
    cand.dominant_groups(gold(spark, sf).demographics, gold(spark, sf).dim), ["spatial_label", "date"], "left"))

CAND_KEEP = "spatial_label date ft_rank sales_rank dominant_group"
CAND_DOUBLES = " ".join(c for c in cand.COLUMNS if c not in CAND_KEEP.split())
for _id, _level in (("w7", "norm"), ("w8", "sig"), ("w9", "sido")):
    check(f"{_id}_candidates_{_level}", statement(f"SELECT * FROM candidate_{_level}", CAND_KEEP, CAND_DOUBLES, ALL_VIEWS))(
        lambda spark, sf, level=_level: cand.candidates(gold(spark, sf), level))

for _id, _level in (("w8", "sig"), ("w9", "sido")):
    check(f"{_id}_candidates_{_level}_repeated", statement(
        f"SELECT * FROM candidate_{_level}", CAND_KEEP, CAND_DOUBLES,
        ",".join([GOLD, trend_admin_repeated(_level), candidate(_level)]),
    ))(lambda spark, sf, level=_level: cand.candidates(replace(gold(spark, sf), dedupe=False), level))

check("u1_candidates_all", statement("SELECT * FROM candidate_all", "level " + CAND_KEEP, CAND_DOUBLES, ALL_VIEWS))(
    lambda spark, sf: cand.candidates_all(gold(spark, sf)))

ADVANCED = "corr_sales_foot_traffic sales_impact_slope sales_impact_score foot_traffic_impact_score"
check("a9_advanced", statement("SELECT * FROM advanced", "level spatial_label", ADVANCED, ALL_VIEWS))(
    lambda spark, sf: cand.advanced(cand.advanced_input(gold(spark, sf))))

@check("a10_saved_advanced", statement("SELECT * FROM advanced", "level spatial_label", ADVANCED, ALL_VIEWS))
def saved_advanced(spark, sf):
    store = MeasureStore(spark, new_folder(spark, "advanced"))
    store.refresh(gold(spark, sf))
    return store.read()


@check("a10_refreshed_advanced", statement("SELECT * FROM advanced", "level spatial_label", ADVANCED, ALL_VIEWS))
def refreshed_advanced(spark, sf):
    """Stored without the sales of one market segment, then refreshed for the places that get them."""
    tables, store = gold(spark, sf), MeasureStore(spark, new_folder(spark, "advanced"))
    late = F.col("spatial_key").endswith("BUILDING") & (F.col("source") == "sales")
    store.refresh(replace(tables, activity=tables.activity.where(~late)))
    store.refresh(tables, tables.activity.where(late).select("spatial_key"))
    return store.read()


check("j6_candidates_with_advanced", statement(
    "SELECT v.*, a.* EXCLUDE (level, spatial_label) FROM candidate_all v LEFT JOIN advanced a "
    "ON a.level = v.level AND a.spatial_label = v.spatial_label",
    "level spatial_label date", "foot_traffic sales " + ADVANCED, ALL_VIEWS,
))(lambda spark, sf: cand.with_advanced(
    cand.candidates_all(gold(spark, sf)).select("level", *BASE), cand.advanced(cand.advanced_input(gold(spark, sf)))))
