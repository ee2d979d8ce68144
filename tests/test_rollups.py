import datetime as dt
import random
from types import SimpleNamespace

import pytest
from pyspark.sql import Window, functions as F

from areapulse.operators import candidates as cand, profile, rollups
from areapulse.plans import payloads, tools
from areapulse.schemas import ADMIN_SIG, DIM_SPATIAL, GOLD_ACTIVITY, GOLD_DEMOGRAPHICS

D = dt.date


def activity(spark, *rows):
    """Rows of (key, date, source, foot traffic, sales[, granularity])."""
    full = [(k, d, (*g, "month")[0], s, ft, sales, None) for k, d, s, ft, sales, *g in rows]
    return spark.createDataFrame(full, GOLD_ACTIVITY)


def dim(spark, *rows):
    """Rows of (key, label, type, code)."""
    return spark.createDataFrame([(k, lb, t, c, *[None] * 8) for k, lb, t, c in rows], DIM_SPATIAL)


def gold(spark, facts, places, admin=(), demographics=()):
    sig = spark.createDataFrame(list(admin), ADMIN_SIG)
    return SimpleNamespace(
        activity=facts, dim=places, admin_sig=sig, admin_sido=sig.select("sido_code", "sido_name").distinct(),
        demographics=spark.createDataFrame(list(demographics), GOLD_DEMOGRAPHICS),
    )


SIG = [("11680", "Gangnam", "11", "Seoul"), ("26110", "Jung", "26", "Busan"), ("11140", "Jung", "11", "Seoul")]


def test_other_granularities_are_left_out(spark, rows):
    facts = activity(spark, ("a", D(2024, 1, 1), "s", 1.0, 2.0), ("a", D(2024, 1, 1), "s", 5.0, 5.0, "day"))
    assert rows(rollups.monthly_trend(facts), "foot_traffic", "sales") == [(1.0, 2.0)]


def test_two_sources_of_one_key_and_month(spark, rows):
    """A roll-up that pairs source rows doubles every sum; one name per key does not."""
    facts = activity(spark, ("a", D(2024, 1, 1), "sales", None, 10.0), ("a", D(2024, 1, 1), "telco", 4.0, None))
    places = dim(spark, ("a", "x", "emd", "1168010100"))
    data = gold(spark, facts, places, SIG)
    assert rows(rollups.trend(data, "sig"), "spatial_label", "foot_traffic", "sales") == [("Gangnam", 4.0, 10.0)]
    assert rows(rollups.trend(data, "sig", dedupe=False), "spatial_label", "foot_traffic", "sales") == [("Gangnam", 8.0, 20.0)]
    data.dedupe = False
    assert rows(tools.rankings(data, "sales", "2024", level="sig"), "value") == [(20.0,)]


def test_district_names_that_occur_twice(spark, rows):
    facts = activity(spark, ("a", D(2024, 1, 1), "sales", None, 10.0))
    data = gold(spark, facts, dim(spark, ("a", "Jung", None, None)), SIG)
    assert rows(rollups.trend(data, "sido"), "spatial_label", "sales") == [("Seoul", 10.0)]
    assert rows(rollups.trend(data, "sido", dedupe=False), "spatial_label", "sales") == [("Busan", 10.0), ("Seoul", 10.0)]
    assert rows(rollups.trend(data, "sig", dedupe=False), "spatial_label", "sales") == [("Jung", 20.0)]


def test_labels_equal_to_a_key(spark, rows):
    facts = activity(spark, ("k", D(2024, 1, 1), "s", 1.0, None))
    places = dim(spark, ("p", "k", "emd", None), ("q", "k", "sig", None))
    assert rows(rollups.trend_norm(facts, places), "spatial_label", "spatial_type", "foot_traffic") == [("k", "emd", 1.0)]
    assert rows(rollups.trend_norm(facts, places, dedupe=False), "spatial_type", "foot_traffic") == [("emd", 1.0), ("sig", 1.0)]


def test_row_offset_and_calendar_disagree_on_a_missing_month(spark, rows):
    months = [D(2023, m, 1) for m in range(1, 13) if m != 3] + [D(2024, m, 1) for m in (1, 2, 4)]
    facts = activity(spark, *[("a", m, "s", float(i), None) for i, m in enumerate(months)])
    by_calendar = rollups.year_on_year(facts).where("date = '2024-04-01'")
    assert rows(by_calendar, "foot_traffic_prev_year") == [(2.0,)]
    series = rollups.trend_norm(facts, dim(spark)).select("spatial_label", "date", "foot_traffic", "sales")
    by_row = cand.lags(series, ["spatial_label"], 12, "prev_year", "yoy_pct").where("date = '2024-04-01'")
    assert rows(by_row, "ft_prev_year") == [(1.0,)]


def test_year_ago_of_a_leap_day(spark, rows):
    facts = activity(spark, ("a", D(2024, 2, 29), "s", 2.0, None), ("a", D(2023, 2, 28), "s", 1.0, None))
    assert rows(rollups.year_on_year(facts).where("date = '2024-02-29'"), "foot_traffic_yoy") == [(1.0,)]


def test_change_from_zero_or_nothing_is_unknown(spark, rows):
    facts = activity(spark, ("a", D(2023, 1, 1), "s", 0.0, None), ("a", D(2024, 1, 1), "s", 5.0, 3.0))
    assert rows(rollups.year_on_year(facts).where("date = '2024-01-01'"), "foot_traffic_yoy", "sales_yoy") == [(None, None)]


def test_share_of_a_zero_total_is_unknown(spark, rows):
    facts = spark.createDataFrame([("a", D(2024, 1, 1), "month", "s", "male", "20", 0.0)], GOLD_DEMOGRAPHICS)
    assert rows(rollups.demographic_share(facts), "share") == [(None,)]


def test_constant_sides_have_no_correlation_or_slope(spark, rows):
    line = [("norm", label, v, s, 0.0, 0.0) for label, pairs in {
        "flat": [(1.0, 1.0), (1.0, 2.0)], "level": [(1.0, 5.0), (2.0, 5.0)], "single": [(1.0, 1.0)], "up": [(1.0, 2.0), (2.0, 4.0)],
    }.items() for v, s in pairs]
    frame = spark.createDataFrame(line, "level string, spatial_label string, foot_traffic double, sales double, ft_zscore double, sales_zscore double")
    assert rows(cand.advanced(frame), "spatial_label", "corr_sales_foot_traffic", "sales_impact_slope") == [
        ("flat", None, None), ("level", None, 0.0), ("single", None, None), ("up", 1.0, 2.0)]


def test_unknown_values_lead_and_ties_go_to_the_first_group(spark, rows):
    month = D(2024, 1, 1)
    facts = [("a", month, "month", "s", "male", "20", None), ("a", month, "month", "s", "female", "20", 9.0),
             ("b", month, "month", "s", "male", "30", 4.0), ("b", month, "month", "s", "female", "40", 4.0)]
    frame = spark.createDataFrame(facts, GOLD_DEMOGRAPHICS)
    places = dim(spark, ("a", "A", None, None), ("b", "B", None, None))
    assert rows(cand.dominant_groups(frame, places), "spatial_label", "dominant_group", "dominant_share") == [
        ("A", "male_20", None), ("B", "female_40", 0.5)]


def test_ranks_without_a_window_per_date_equal_the_window(spark, rows):
    random.seed(1)
    values = [None, 0.0, 0.0, *[float(random.randint(1, 60)) for _ in range(5)]]
    line = [(f"p{i}", D(2024, 1 + i % 2, 1), random.choice(values), random.choice(values)) for i in range(400)]
    base = spark.createDataFrame(line, "spatial_label string, date date, foot_traffic double, sales double")
    columns = ["spatial_label", "date", "ft_rank", "sales_rank", F.round("ft_avg_date", 6), F.round("sales_avg_date", 6)]
    whole = Window.partitionBy("date")
    windowed = base.withColumns({
        f"{s}_{what}": column
        for c, s in cand.SHORT.items()
        for what, column in (("avg_date", F.avg(c).over(whole)), ("rank", F.rank().over(whole.orderBy(F.col(c).desc_nulls_last()))))
    })
    assert rows(cand.with_date_columns(base, base), *columns) == rows(windowed, *columns)


def test_two_types_of_a_label_are_lagged_in_order_of_type(spark, rows):
    facts = activity(spark, *[(k, D(2024, m, 1), "s", float(10 * m + n), None) for m in (1, 2) for n, k in enumerate(("k", "l"))])
    data = gold(spark, facts, dim(spark, ("k", "same", "emd", None), ("l", "same", "sig", None)))
    assert rows(cand.candidates(data, "norm"), "date", "foot_traffic", "ft_prev") == sorted([
        (D(2024, 1, 1), 10.0, None), (D(2024, 1, 1), 11.0, 10.0), (D(2024, 2, 1), 20.0, 11.0), (D(2024, 2, 1), 21.0, 20.0)], key=repr)
    assert rows(cand.candidates(data, "emd"), "foot_traffic", "ft_prev") == [(10.0, None), (20.0, 10.0)]


def test_rankings_are_not_cut_and_years_are_looked_up_on_the_level(spark, rows):
    facts = activity(spark, *[(f"k{i:03}", D(2024, 3, 1), "s", None, float(i)) for i in range(150)], ("x", D(2024, 2, 1), "s", None, 7.0))
    data = gold(spark, facts, dim(spark, ("x", "X", "emd", None)))
    assert tools.rankings(data, "sales", "2024", 500, "norm").count() == 150
    assert rows(tools.rankings(data, "sales", "2024", 5, "emd"), "spatial_label", "value") == [("X", 7.0)]
    assert tools.time_series(data, "trend", "emd").count() == tools.rankings(data, "sales", "2024-02", 5, "emd").count() == 1


def test_tools_check_their_parameters(spark, rows):
    facts = activity(spark, ("a", D(2024, 1, 1), "s", 1.0, 4.0), ("a", D(2024, 2, 1), "s", 2.0, 5.0), ("b", D(2024, 2, 1), "s", None, None))
    data = gold(spark, facts, dim(spark))
    for call in (
        lambda: tools.rankings(data, "price", "2024"), lambda: tools.rankings(data, "sales", "2024", 0),
        lambda: tools.rankings(data, "sales", "soon"), lambda: tools.rankings(data, "sales", "2024", level="city"),
        lambda: tools.compare_domains(data, ["weather"]), lambda: tools.detect_anomaly(data, "sales", z_threshold=0),
    ):
        with pytest.raises(ValueError):
            call()
    assert rows(tools.rankings(data, "sales", "2024", level="norm"), "spatial_label", "value") == [("a", 5.0), ("b", None)]
    got = rows(tools.compare_domains(data, ["population", "sales"], region="a", level="norm"), "domain", "trend", "change_rate", "signal")
    assert got == [("population", "up", 1.0, "strong_change"), ("sales", "up", 0.25, "strong_change")]
    missing = tools.compare_domains(data, ["sales"], region="nowhere", level="norm")
    assert rows(missing, "trend", "change_rate", "signal") == [("flat", None, "insufficient_data")]
    nothing = tools.detect_anomaly(data, "population", "a", "2031-01", level="norm")
    assert rows(nothing, "value", "zscore", "is_anomaly") == [(None, None, False)]


def test_views_filter_by_label_through_the_dimension(spark, rows):
    facts = activity(spark, ("a", D(2024, 1, 1), "s", 1.0, None), ("b", D(2024, 1, 1), "s", 2.0, None))
    data = gold(spark, facts, dim(spark, ("a", "A", "emd", None), ("b", "B", None, None)))
    assert rows(tools.time_series(data, "yoy", spatial_label="A"), "spatial_key") == [("a",)]
    assert rows(tools.time_series(data, "trend", spatial_label="B"), "foot_traffic") == [(2.0,)]
    assert rows(rollups.trend(data, "emd"), "spatial_label") == [("A",)]


def test_payload_extremes_take_the_earliest_of_equals(spark, rows):
    facts = activity(spark, *[("a", D(2024, m, 1), "s", v, v) for m, v in enumerate([1.0, 2.0, 4.0, 2.0, 4.0], 1)])
    data = gold(spark, facts, dim(spark))
    payload = payloads.region_payload(cand.candidates(data, "norm"), ["spatial_label"])
    assert rows(payload, "highlights.sales_mom_max.date", "highlights.sales_mom_min.date") == [(D(2024, 2, 1), D(2024, 4, 1))]


def test_global_baseline_of_a_short_series(spark, rows):
    facts = activity(spark, ("a", D(2024, 1, 1), "s", 10.0, None), ("a", D(2024, 2, 1), "s", 10.1, None))
    got = rows(profile.global_baseline(facts), "domain", "trend", "first_value", "last_value")
    assert got == [("foot_traffic", "flat", 10.0, 10.1), ("sales", None, None, None)]
