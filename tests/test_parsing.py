import datetime as dt

import pytest
from pyspark.sql import functions as F

from areapulse.functions import numbers, text
from areapulse.functions.periods import period_range, single_period

D = dt.date


def one(spark, expression, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expression(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("value, want", [
    ("12", 12.0), (" 1.5 ", 1.5), ("-3e2", -300.0), (".5", 0.5), ("7.", 7.0),
    ("", 0.0), (None, 0.0), ("abc", 0.0), ("NaN", 0.0), ("1d", 0.0), ("1,000", 0.0), ("inf", 0.0),
])
def test_numbers_that_are_not_numbers_count_as_zero(spark, value, want):
    assert one(spark, numbers.to_number, value) == want


@pytest.mark.parametrize("value, want", [
    ("202406", D(2024, 6, 1)), ("2024-06", D(2024, 6, 1)), ("2024-02-29", D(2024, 2, 29)), ("20240229", D(2024, 2, 29)),
    ("2024-06-05T10:00:00", D(2024, 6, 5)), (" 202406 ", D(2024, 6, 1)),
    ("2023-02-29", None), ("202413", None), ("nan", None), ("", None), (None, None), ("2024", None), ("2024-6-5", None),
])
def test_dates(spark, value, want):
    assert one(spark, text.parse_date, value) == want


def test_month_bucket(spark):
    assert one(spark, text.bucket_date, "2024-06-17") == D(2024, 6, 1)
    assert one(spark, lambda c: text.bucket_date(c, "day"), "2024-06-17") == D(2024, 6, 17)


def test_day_or_month_prefers_a_day_and_passes_malformed_text(spark, rows):
    df = spark.createDataFrame(
        [("20240105", "202401"), ("", "202401"), (None, "202402.0"), ("odd", "202401"), ("nan", ""), ("2024-01-06", None)],
        "d string, m string",
    )
    got = [r["t"] for r in df.select(text.day_or_month(F.col("d"), F.col("m")).alias("t")).collect()]
    assert got == ["2024-01-05", "2024-01-01", "2024-02-01", "odd", "", "2024-01-06"]


@pytest.mark.parametrize("value, want", [
    ("37.50000,127.00000 (1234)", (37.5, 127.0, "1234", "coord")),
    ("37.5,127.0", (37.5, 127.0, None, "coord")),
    ("11680", (None, None, None, None)),
])
def test_coordinate_labels(spark, value, want):
    assert tuple(one(spark, text.coord_label_parts, value)) == want


def test_coordinate_format(spark):
    df = spark.createDataFrame([("12", 127.0, 37.5), ("", 127.0, 37.5), ("12", None, 37.5), (None, None, None)], "c string, x double, y double")
    got = [r[0] for r in df.select(text.coord_label(F.col("c"), F.col("x"), F.col("y"))).collect()]
    assert got == ["37.50000,127.00000 (12)", "37.50000,127.00000", "12", ""]


@pytest.mark.parametrize("value, want", [
    ("m_0009", ("male", "0009")), (" W_70U ", ("female", "70u")), ("x_1", (None, None)), ("m_", (None, None)), ("", (None, None)), (None, (None, None)),
])
def test_sex_age_tokens(spark, value, want):
    assert tuple(one(spark, text.sex_age, value)) == want


@pytest.mark.parametrize("value, want", [
    ("44270", "당진시"), ("44270.0", "당진시"), ("99999", "99999"), ("서울 강남구", "강남구"), ("강남", "강남구"), ("홍성군", "홍성군"), (None, None),
])
def test_region_names(spark, value, want):
    assert one(spark, text.region_name, value) == want


def test_time_and_age_labels(spark):
    assert one(spark, text.time_label, "202506") == "2025-06"
    assert one(spark, text.time_label, "2025-06-02") == "2025-06-02"
    assert one(spark, text.time_label, "soon") is None
    assert one(spark, text.age_label, 37, "int") == "30s"
    assert one(spark, lambda c: text.age_label(c, F.lit("female")), 8, "int") == "00s_female"


@pytest.mark.parametrize("value, want", [(8.125, "8.12"), (0.375, "0.38"), (61.045, "61.05"), (-0.001, "-0.00"), (2.0, "2.00")])
def test_fixed_point_rounds_the_exact_value(spark, value, want):
    assert one(spark, lambda c: numbers.fixed_point(c, 2), value, "double") == want


def test_first_non_empty_skips_texts_for_nothing(spark):
    df = spark.createDataFrame([("nan", " ", "c"), (None, "None", "")], "a string, b string, c string")
    assert [r[0] for r in df.select(text.first_non_empty(["a", "b", "c"])).collect()] == ["c", None]


def test_periods(spark):
    df = spark.createDataFrame([("2024", "2024"), ("2024-05", "2023"), ("x", "2024-03-09")], "a string, b string")
    start, end = period_range(F.col("a"), F.col("b"))
    got = [tuple(r) for r in df.select(start, end, single_period(F.col("a"), F.col("b"))).collect()]
    assert got == [
        (D(2024, 1, 1), D(2024, 12, 31), D(2024, 1, 1)),
        (D(2023, 12, 31), D(2024, 5, 1), D(2023, 1, 1)),
        (None, D(2024, 3, 9), D(2024, 3, 1)),
    ]
