import datetime as dt

import pytest
from pyspark.sql import functions as F

from areapulse.plans import declarative as dq

SCHEMA = (
    "spatial string, time string, population struct<foot_traffic:double,demographics:map<string,double>>, economic struct<sales:double>, "
    "analysis struct<demographics:struct<dominant_group:string,dominant_share:double>>"
)


@pytest.fixture(scope="module")
def insights(spark):
    def row(place, time, traffic, sales, group=None, ages=None):
        return (place, time, (traffic, ages), (sales,), ((group, 0.5 if group else None),))

    return spark.createDataFrame([
        row("a", "2024-01-06", 1.0, 10.0, "female_20_29"), row("a", "2024-02-06", 2.0, None), row("b", "2024-02-10", 3.0, 30.0, None, {"30s": 1.0}),
        row("b", "2023-02-10", float("nan"), 5.0), row("c", "someday", 7.0, 1.0), row("c", None, 8.0, 2.0)], SCHEMA)


@pytest.mark.parametrize("query", [
    {}, {"target": 1}, {"target": "x", "limit": 3}, {"target": "x", "aggregations": ["mode"]}, {"target": "x", "filters": {"time": {"month": 13}}},
    {"target": "x", "filters": {"time": {"day": 1}}}, {"target": "x", "filters": {"time": {"weekdays": ["MO"]}}},
    {"target": "x", "filters": {"demographics": {"gender": ["other"]}}}, {"target": "x", "compare": {}}, {"target": "x", "compare": {"type": "qoq"}},
])
def test_wrong_queries_are_rejected(query):
    with pytest.raises(ValueError):
        dq.validate_query(query)


def test_extra_filters_are_allowed():
    query = {"target": "x", "filters": {"top_n": 3}}
    assert dq.validate_query(query) is query


def test_unreadable_times_pass_time_filters(insights, rows):
    got = dq.apply_filters(insights, {"time": {"start": "2024-02-01", "end": "2024-12-31", "weekdays": ["SAT"]}})
    assert rows(got, "spatial", "time") == [("b", "2024-02-10"), ("c", "someday"), ("c", None)]
    assert rows(dq.apply_filters(insights, {"time": {"start": "not a date", "month": 1}}), "time") == [("2024-01-06",), ("someday",), (None,)]


def test_demographic_filters_need_a_match_in_every_list(insights, rows):
    def matches(wanted):
        return rows(dq.apply_filters(insights, {"demographics": wanted}), "spatial", "time")

    first = ("a", "2024-01-06")
    assert matches({"gender": ["female"], "age": ["20s"]}) == [first]
    assert matches({"gender": ["male"], "age": ["20s"]}) == []
    assert matches({"age": ["30s"]}) == [("b", "2024-02-10")]
    assert matches({"gender": [], "age": ["dominant_share"]}) == [first]
    assert matches({"gender": []}) == [first, ("b", "2024-02-10")]


def test_missing_values_come_last_in_both_orders(insights):
    for order, first in (("asc", 1.0), ("desc", 30.0)):
        got = dq.apply_top_n(insights, {"top_n": {"count": 10, "sort_by": "economic.sales", "order": order}}, "x").select("economic.sales").collect()
        assert got[0][0] == first and got[-1][0] is None
    assert dq.apply_top_n(insights, {"top_n": 0}, "economic.sales").count() == 6
    assert dq.apply_top_n(insights, {"top_n": 2}, "economic.sales").count() == 2


def test_aggregates_skip_nan_text_and_missing_paths(insights, rows):
    every = dq.AGGREGATIONS
    assert rows(dq.aggregate(insights, "population.foot_traffic", every)) == [(6, 21.0, 4.2, 1.0, 8.0, 3.0, 5)]
    assert rows(dq.aggregate(insights, "spatial", every)) == [(6, *[None] * 6)]
    assert rows(dq.aggregate(insights, "no.such.path", ["sum", "count"])) == [(6, None, None)]


def test_groups_count_rows_and_values(insights, rows):
    got = dq.aggregate(insights, "economic.sales", ["median", "count"], ["spatial", "analysis.demographics.dominant_group"])
    assert rows(got) == [("a", "None", 1, None, None), ("a", "female_20_29", 1, 10.0, 1), ("b", "None", 2, 17.5, 2), ("c", "None", 2, 1.5, 2)]


@pytest.mark.parametrize("compare, want", [
    ({"type": "yoy"}, ("2023-02-28", "2023-03-31")), ({"type": "mom"}, ("2024-01-29", "2024-02-29")), ({"type": "dod"}, ("2024-02-28", "2024-03-30")),
    ({"type": "custom", "interval": "2w"}, ("2024-02-15", "2024-03-17")), ({"type": "custom", "interval": "m"}, ("2024-01-29", "2024-02-29")),
    ({"type": "custom", "interval": "1y"}, ("2023-02-28", "2023-03-31")), ({"type": "custom"}, None),
])
def test_shifted_periods(compare, want):
    got = dq.shifted_period({"start": "2024-02-29", "end": "2024-03-31"}, compare)
    assert got == (want and {"start": want[0], "end": want[1]})


def test_comparison_needs_a_full_period_and_earlier_rows(insights, rows):
    query = {"target": "economic.sales", "aggregations": ["sum"], "filters": {"spatial": ["b"], "time": {"start": "2024-02-01", "end": "2024-02-28"}}, "compare": {"type": "yoy"}}
    assert rows(dq.compare_periods(insights, query)) == [("sum", 30.0, 5.0, 25.0)]
    query["filters"]["spatial"] = ["a"]
    assert rows(dq.compare_periods(insights, query)) == []
    assert dq.compare_periods(insights, {**query, "filters": {"time": {"start": "2024-01-01"}}}) is None


def test_summary_compares_before_the_top_n(insights, rows):
    query = {
        "target": "economic.sales", "aggregations": ["count"], "group_by": ["spatial"], "compare": {"type": "yoy"},
        "filters": {"spatial": ["a", "b"], "time": {"start": "2024-01-01", "end": "2024-12-31"}, "top_n": 1}}
    got = dq.summarize(insights, query)
    assert rows(got.aggregations) == [(1, 1)] and rows(got.groups) == [("b", 1, 1)]
    assert rows(got.comparison) == [("count", 2.0, 1.0, 1.0)]
    assert rows(got.records, "spatial", "target.path", "target.value") == [("b", "economic.sales", 30.0)]


def test_newest_stored_batch(spark, rows):
    stored = spark.createDataFrame([(dt.datetime(2024, 1, 1), '{"spatial":"old"}'), (dt.datetime(2024, 1, 2), '{"spatial":"new"}')], "generated_at timestamp, payload string")
    schema = spark.createDataFrame([], "spatial string").schema
    assert rows(dq.latest_batch(stored, schema)) == [("new",)]


def test_result_document(spark, rows, tmp_path):
    (tmp_path / "r.json").write_text('{"generated_at": "x",\n "insights": [{"spatial": "a"}, {"spatial": "b"}]}')
    schema = spark.createDataFrame([], "spatial string").schema
    assert rows(dq.read_results(spark, str(tmp_path / "r.json"), schema, single_document=True)) == [("a",), ("b",)]
