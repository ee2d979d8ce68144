import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from areapulse.functions.numbers import parse_number
from areapulse.functions.text import region_name
from areapulse.operators import insight, records as rec, series

METRICS = "source string, spatial_key string, time_key string, baseline double, current double, time_unit string, uplift double, rate_of_change double, volatility double"


def make(spark, *rows):
    """Records from (place, time, source, foot traffic, sales, demographics)."""
    frame = spark.createDataFrame(rows, "p string, t string, s string, ft double, sales double, demo map<string,double>")
    return rec.build_records(
        frame, F.col("s"), spatial_key=F.col("p"), time_key=F.col("t"),
        population=rec.population(F.col("ft"), F.col("demo")), economic=rec.economic(F.col("sales"), F.lit(None)))


def test_insight_layers_of_a_known_case(spark):
    records = make(
        spark, ("강남구", "2025-01", "sales", 100.0, 200.0, {"20s": 1.0}), ("강남구", "2025-02", "sales", 120.0, 220.0, {"20s": 1.0}),
        ("강남구", "2025-03", "sales", 150.0, 260.0, {"30s": 1.0}))
    metrics = spark.createDataFrame([
        ("sales", "강남구", "2025-01", None, 200.0, "month", 0.3, None, None),
        ("sales", "강남구", "2025-02", 200.0, 220.0, "month", 0.25, 0.1, 0.05),
        ("sales", "강남구", "2025-03", 210.0, 260.0, "month", 0.24, 0.18, 0.08)], METRICS)
    latest = insight.insights(records, metrics).where("time_key = '2025-03'").first()
    assert (latest["direction"], latest["temporal_unit"], latest["dominant_group"], latest["classification"]) == ("increase", "month", "30s", "high")
    assert latest["narrative"] == (
        "강남구 @ 2025-03: trend=increase, traffic-sales correlation=1.00 (strong), impact=high, leading demographic=30s, metrics=sales Δ=0.18/vol=0.08.")


def test_sales_record_of_a_known_case(spark):
    raw = spark.createDataFrame(
        [("202506", "강남구", "카페", "1000", "500", "10", "5")],
        "STD_YM string, SGG_NAME string, SCLS_NM string, MAN_SALE_AMT_10G string, WMAN_SALE_AMT_20G string, MAN_APV_CNT_10G string, WMAN_APV_CNT_40G string")
    got = rec.sales_records(raw).first()
    assert (got["time_key"], got["spatial_key"], got["economic"]["sales"], got["economic"]["sales_count"]) == ("202506", "강남구", 1500.0, 15.0)
    assert got["economic"]["category"]["small"] == got["economic"]["sector"] == "카페"


def test_defaults_and_required_fields(spark):
    got = rec.normalise(make(spark, ("강남", "202501", None, None, None, None))).first()
    assert (got["spatial_key"], got["time_key"], got["source"], got["population"]["foot_traffic"], got["events"]) == ("강남구", "2025-01", "unknown", 0.0, [])
    with pytest.raises(ValueError, match="economic"):
        rec.validate(make(spark, ("a", "202501", "sales", 1.0, 1.0, None)).drop("economic"))


def test_baseline_needs_a_full_window(spark, rows):
    records = make(spark, *[("a", f"2025-0{i}", "sales", None, float(i), None) for i in range(1, 6)])
    got = rows(series.domain_metrics(rec.normalise(records)), "time_key", "baseline", "uplift", "rate_of_change")
    assert [r[1] for r in got] == [None, None, None, 2.0, 3.0]
    assert got[3][2] == 1.0 and got[0][3] is None and got[1][3] == 1.0


def test_series_are_ordered_by_date_and_equal_times_are_one_point(spark, rows):
    records = make(spark, ("a", "2025-01", "sales", None, 1.0, None), ("a", "2025-01", "sales", None, 2.0, None), ("a", "20250102", "sales", None, 9.0, None))
    got = rows(series.domain_metrics(rec.normalise(records)), "time_key", "current", "rate_of_change")
    assert got == [("2025-01", 3.0, None), ("2025-01-02", 9.0, 2.0)]


def test_dynamic_baseline_follows_the_duration(spark, rows):
    frame = series.domain_series(rec.normalise(make(spark, *[("a", f"2025-01-0{i}", "telco", float(i * i), None, None) for i in range(1, 6)])))
    got = rows(series.dynamic_baseline(frame.withColumn("duration", F.lit(2)), "duration"), "current", "baseline")
    assert got == sorted([(1.0, None), (4.0, None), (9.0, 2.5), (16.0, 6.5), (25.0, 12.5)], key=repr)
    alone = series.dynamic_baseline(frame.where("current = 1").withColumn("duration", F.lit(1)), "duration")
    assert rows(alone, "baseline") == [(1.0,)]


def test_long_series_are_several_tasks_work(spark, rows):
    import random
    import statistics

    random.seed(6)
    values = [random.uniform(1, 9) + 1e6 for _ in range(900)]
    line = [("sales", place, dt.date(2020, 1, 1) + dt.timedelta(days=n), f"{n:04}", v, 1 + n * 7 % 300) for place in ("a", None) for n, v in enumerate(values)]
    frame = spark.createDataFrame(line, "source string, spatial_key string, _date date, time_key string, current double, n long").repartition(5)
    blocks = series.blocks_of(frame, before=3, rows=100)
    assert blocks.where("not _halo").count() == 1800 and blocks.select("spatial_key", "_block").distinct().count() >= 16
    got = series.volatility(blocks, "current").withColumn("baseline", series.trailing_mean("current", 3)).where("not _halo")
    for place in ("a", None):
        mine = sorted((r for r in got.collect() if r["spatial_key"] == place), key=lambda r: r["time_key"])
        assert [r["volatility"] for r in mine[:1]] == [None]
        for n in (1, 2, 99, 100, 101, 350, 899):
            assert mine[n]["volatility"] == pytest.approx(statistics.pstdev(values[: n + 1]) / statistics.fmean(values[: n + 1]), rel=1e-5)
            assert mine[n]["baseline"] == (pytest.approx(statistics.fmean(values[n - 3 : n])) if n >= 3 else None)
        durations = sorted((r for r in series.dynamic_baseline(frame, "n").collect() if r["spatial_key"] == place), key=lambda r: r["time_key"])
        for n, r in enumerate(durations):
            size = 1 + n * 7 % 300
            assert r["baseline"] == (pytest.approx(statistics.fmean(values[n - size : n])) if n >= size else values[0] if n == 0 else None)
    trends = series.trend(frame, "current", ["spatial_key"], "time_key", block_rows=50)
    assert rows(trends, "time_key", "slope") == rows(series.trend(frame, "current", ["spatial_key"], "time_key"), "time_key", "slope")


def test_volatility_of_zero_mean_is_unknown(spark, rows):
    records = make(spark, ("a", "2025-01", "sales", None, 0.0, None), ("a", "2025-02", "sales", None, 0.0, None))
    assert rows(series.domain_metrics(rec.normalise(records)), "volatility") == [(None,), (None,)]


def test_trend_words(spark, rows):
    frame = spark.createDataFrame([("a", "2025-01", 1.0), ("a", "2025-02", 1.0), ("a", "2025-03", 5.0), ("a", "2025-04", 1.0), ("a", "2025-05", -9.0)], "p string, t string, v double")
    assert [r[1] for r in rows(series.trend(frame, "v", ["p"], "t"), "t", "direction")] == [None, "stable", "increase", "stable", "decrease"]


def test_impact_needs_two_domains_for_a_joint_score(spark, rows):
    metrics = spark.createDataFrame([
        ("sales", "a", "t", None, 1.0, "month", 0.1, None, None), ("telco", "a", "t", None, 1.0, "day", 0.3, None, None),
        ("sales", "b", "t", None, 1.0, "month", 0.05, None, None), ("sales", "c", "t", None, 1.0, "month", None, None, None)], METRICS)
    got = rows(insight.impact(metrics), "spatial_key", "classification", "cross_domain_score")
    assert got == [("a", "high", 0.2), ("b", "moderate", None), ("c", None, None)]


def test_correlation_needs_three_points_and_two_varying_sides(spark, rows):
    points = {"few": [(1.0, 1.0), (2.0, 2.0)], "flat": [(1.0, 1.0), (1.0, 2.0), (1.0, 3.0)], "good": [(1.0, 3.0), (2.0, 2.0), (3.0, 1.0)]}
    frame = spark.createDataFrame([(p, f"t{i}", *v) for p, vs in points.items() for i, v in enumerate(vs)], "spatial_key string, time_key string, foot_traffic double, sales double")
    want = [("few", 2, None, None), ("flat", 3, None, None), ("good", 3, -1.0, "strong")]
    assert rows(insight.place_correlation(frame), "spatial_key", "sample_size", "correlation", "interpretation") == want
    assert rows(insight.with_correlation(frame).select("spatial_key", "sample_size", "correlation", "interpretation").distinct()) == want


def test_measures_of_a_crowded_bucket_read_all_its_records(spark):
    groups = [*[("telco", {"aaa": 1.0})] * 200, *[("telco", {"zzz": 1.0})] * 800]
    records = rec.normalise(make(spark, *[("a", "2025-01", source, 1.0, None, group) for source, group in groups]))
    got = insight.bucket_summary(records).first()
    assert (got["foot_traffic"], len(got["demographics"]), got["source"]) == (1000.0, 1000, "telco")
    assert len(insight.bucket_summary(records, limit=200).first()["demographics"]) == 200
    leading = insight.leading_groups(records).first()
    assert (leading["dominant_group"], leading["dominant_share"], len(leading["top_groups"])) == ("zzz", 0.8, 2)


def test_an_unknown_value_has_no_trend_and_is_no_point_of_one(spark, rows):
    frame = spark.createDataFrame([("a", f"2024-0{m}", v) for m, v in enumerate((1.0, 2.0, None, 3.0, None, 9.0), 1)], "k string, t string, v double")
    assert rows(series.trend(frame, "v", ["k"], "t"), "t", "direction", "slope") == [
        ("2024-01", None, None), ("2024-02", "increase", 1.0), ("2024-03", None, None), ("2024-04", "increase", 1.0),
        ("2024-05", None, None), ("2024-06", "increase", 3.5)]


def test_a_baseline_keeps_its_digits_after_large_values(spark, rows):
    frame = spark.createDataFrame([("s", "a", dt.date(2024, 1, d), str(d), v, 2) for d, v in enumerate((1e17, 0.5, 0.25, 7.0), 1)], "source string, spatial_key string, _date date, time_key string, current double, n long")
    assert rows(series.dynamic_baseline(frame, "n"), "time_key", "baseline")[3] == ("4", 0.375)


def test_bad_cells_never_fail(spark, rows):
    assert rows(spark.createDataFrame([("9" * 60,), ("1e100",), ("1E-100",), ("1e999",), ("5",)], "t string").select(parse_number(F.col("t")).alias("n")), "n") == sorted(
        [(1e60,), (1e100,), (1e-100,), (None,), (5.0,)], key=repr)
    assert rows(spark.createDataFrame([("9" * 60,)], "t string").select(region_name(F.col("t")).alias("n")), "n") == [(None,)]


def test_sources_are_named_in_order(spark, rows):
    records = make(spark, ("a", "t", "telco", 1.0, None, None), ("a", "t", "sales", None, 2.0, None), ("a", "t", "telco", 1.0, None, None))
    fused = rec.fuse(records)
    assert rows(fused, rec.source_label(F.col("sources")), "foot_traffic", F.size("by_source")) == [("sales+telco", 2.0, 2)]


def test_composition_shift_and_elasticity(spark, rows):
    before, after = (spark.createDataFrame(r, "k string, v double") for r in ([("a", 2.0), ("b", 0.0), ("c", 1.0)], [("a", 3.0), ("b", 1.0)]))
    assert rows(series.composition_shift(before, after, ["k"], "v")) == [("a", 0.5), ("b", None), ("c", None)]
    frame = spark.createDataFrame([(0.2, 0.1), (0.0, 0.1), (None, 0.1)], "t double, s double")
    assert rows(frame.select(series.elasticity(F.col("t"), F.col("s")))) == [(0.5,), (None,), (None,)]


def test_dynamic_baselines_meet_in_bounded_tasks_and_never_in_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(series, "CHUNK_ROWS", 8)
    monkeypatch.setattr(series, "PARTS_AT_ONCE", 64)
    values = [(s, i, float((i * 37) % 101), 1 + (i * 13) % 41) for s in ("a", None) for i in range(120)]
    frame = spark.createDataFrame([("sales", s, f"{i:04}", dt.date(2024, 1, 1) + dt.timedelta(days=i), v, d) for s, i, v, d in values],
                                  "source string, spatial_key string, time_key string, _date date, current double, duration long")
    found = series.dynamic_baseline(frame, "duration")
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    got = {(r["spatial_key"], int(r["time_key"])): r["baseline"] for r in found.collect()}
    by = {(s, i): v for s, i, v, _ in values}
    for s, i, v, d in values:
        want = v if i == 0 and d == 1 else sum(by[s, n] for n in range(i - d, i)) / d if i >= d else None
        assert got[s, i] == (want if want is None else pytest.approx(want))


def test_grid_records_are_made_by_code_that_is_small_enough_to_compile(spark, tmp_path, capsys):
    names = ["CRTR_YMD", "CRTR_YM", "SM_LC_CD", "COORD_X", "COORD_Y", "VST_ML_PPLTN_CNT_20_24", "VST_FM_PPLTN_CNT_20_24"]
    rows = [("20240105", "202401", "7", "127", "37.5", "1", "2"), ("", "202401", "", "x", "37.5", "1", "2"), ("", "202401", "", "127", "37.5", "1", "2"),
            ("", "", "7", "127", "37.5", "1", "2"), ("x", "202401", "7", None, "37.5", "1", "2")]
    spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names)).write.parquet(str(tmp_path / "grid"))
    found = rec.telco_grid_records(spark.read.parquet(str(tmp_path / "grid")))
    assert sorted((r["spatial_key"], r["time_key"]) for r in found.collect()) == sorted([
        ("37.50000,127.00000 (7)", "2024-01-05"), ("37.50000,127.00000", "2024-01-01"), ("7", "x")])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rec.telco_grid_records(spark.read.parquet(str(tmp_path / "grid"))).explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    # the JVM never compiles a method beyond 8000 bytes
    assert sizes and max(sizes) < 8000
