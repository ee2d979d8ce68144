"""Tags of request texts: what a question asks for, as columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from areapulse.functions.text import parse_date

# Patterns and words the tags are read from.
ISO_DATE = r"\d{4}-\d{2}(?:-\d{2})?"
KOREAN_MONTH = r"(\d{4})\s*년?\s*(\d{1,2})\s*월"
KOREAN_YEAR = r"(\d{4})\s*년"
LONG_NUMBER = r"(?U)\b\d{10,}\b"
PROVINCE_AND_PLACE = r"([가-힣]+(?:도|특별시|광역시))\s*([가-힣]+(?:시|군|구|읍|면|동))"
PLACE = r"([가-힣]+(?:시|군|구|읍|면|동))"
DECADE = r"(\d{2})대"
MONTH = r"(\d{1,2})월"
FILTER_WORDS = ["주말", "평일", "날씨", "이벤트", "축제", "공휴일"]
SEX_WORDS = {"female": ["여성", "여자"], "male": ["남성", "남자"]}
LEVEL_WORDS = {"sido": ["도별", "시도"], "sig": ["시별", "군별", "구별", "시군구"]}
CLASS_WORDS = {"yoy": ["전년", "yoy"], "demographics": ["비중", "demographic", "연령", "성별"]}
VIEWS = {
    "sido": "v_activity_monthly_trend_sido",
    "sig": "v_activity_monthly_trend_sig",
}
DEFAULT_VIEW = "v_activity_monthly_trend_norm"
KNOWN_VIEWS = [*VIEWS.values(), DEFAULT_VIEW, "v_activity_yoy", "v_demographics_share"]
TARGET_WORDS = {
    "economic.sales": (["경제", "매출"], ["sales"]),
    "population.foot_traffic": (["인구", "유동"], ["foot"]),
    "metrics.uplift": ([], ["uplift"]),
}
AGGREGATION_WORDS = {"sum": (["총", "합계"], ["sum"]), "max": (["최대"], ["max"]), "min": (["최소"], ["min"])}
WEEKDAY_WORDS = {"주말": ["SAT", "SUN"], "평일": ["MON", "TUE", "WED", "THU", "FRI"]}


def contains_any(text: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(w) for w in words], F.lit(False))


def first_match(text: Column, pattern: str, group: int = 0) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def pick(text: Column, choices: dict[str, list[str]], default: str | None) -> Column:
    """The first choice one of whose words occurs in the text."""
    choice = F.lit(default).cast("string")
    for value, words in reversed(choices.items()):
        choice = F.when(contains_any(text, words), value).otherwise(choice)
    return choice


def with_date_range(requests: DataFrame, text: Column) -> DataFrame:
    """First and last date of a text: ISO dates, else Korean months, else a Korean year.

    Each pattern is searched once, in a step of its own that later steps refer to.
    """
    found = requests.withColumns({
        "_iso": F.regexp_extract_all(text, F.lit(ISO_DATE), F.lit(0)),
        "_years": F.regexp_extract_all(text, F.lit(KOREAN_MONTH), F.lit(1)),
        "_months": F.regexp_extract_all(text, F.lit(KOREAN_MONTH), F.lit(2)),
        "_year": first_match(text, KOREAN_YEAR, 1),
    })
    korean = F.zip_with("_years", "_months", lambda y, m: F.concat(y, F.lit("-"), F.lpad(m, 2, "0")))
    year = F.when(F.col("_year").isNotNull(), F.array(
        F.concat("_year", F.lit("-01-01")), F.concat("_year", F.lit("-12-31"))
    ))
    tokens = F.when(F.size("_iso") > 0, F.col("_iso")).when(F.size("_years") > 0, korean).otherwise(year)
    with_tokens = found.withColumn("_tokens", tokens)
    ends = with_tokens.withColumns({
        "_first": F.try_element_at("_tokens", F.lit(1)),
        "_last": F.coalesce(F.try_element_at("_tokens", F.lit(2)), F.try_element_at("_tokens", F.lit(1))),
    })
    return ends.withColumns({
        "_text_start": parse_date(F.col("_first")), "_text_end": parse_date(F.col("_last")),
    }).drop("_iso", "_years", "_months", "_year", "_tokens", "_first", "_last")


def place_label(text: Column) -> Column:
    province, place = (first_match(text, PROVINCE_AND_PLACE, g) for g in (1, 2))
    return F.coalesce(F.concat(province, F.lit(" "), place), first_match(text, PLACE, 1))


def tag_requests(requests: DataFrame, text: str = "text", prior: DataFrame | None = None, key: str | None = None) -> DataFrame:
    """Requests with their dates, place, sex, age, level, class, view and flags.

    ``prior`` holds mappings known from elsewhere by ``key``; its values win over
    what the text says. Of several rows of a key, the smallest known value of
    each field counts, so a request stays one row.
    """
    fields = ["qtype", "level", "spatial_label", "spatial_key", "date_start", "date_end", "view"]
    rows = requests
    if prior is not None:
        known = prior.select(key, *[
            (F.col(f) if f in prior.columns else F.lit(None)).cast("string").alias(f"_{f}") for f in fields
        ])
        known = known.groupBy(key).agg(*[F.min(f"_{f}").alias(f"_{f}") for f in fields])
        rows = rows.join(known, key, "left")
    else:
        rows = rows.withColumns({f"_{f}": F.lit(None).cast("string") for f in fields})
    t = F.col(text)
    age = first_match(t, DECADE, 1)
    tagged = with_date_range(rows, t).withColumns({
        "qtype": F.coalesce("_qtype", pick(t, CLASS_WORDS, "trend")),
        "level": F.coalesce("_level", pick(t, LEVEL_WORDS, "emd")),
        "spatial_label": F.coalesce("_spatial_label", place_label(t)),
        "spatial_key": F.coalesce("_spatial_key", first_match(t, LONG_NUMBER)),
        "sex": pick(t, SEX_WORDS, None),
        "age_like": F.concat(age, F.lit("_%")),
        "has_filter_words": contains_any(t, FILTER_WORDS),
        "_start": parse_date(F.col("_date_start")),
        "_end": parse_date(F.col("_date_end")),
    })
    untold = F.col("_start").isNull() & F.col("_end").isNull()
    view = F.coalesce(*[F.when(F.col("level") == lv, v) for lv, v in VIEWS.items()], F.lit(DEFAULT_VIEW))
    tagged = tagged.withColumns({
        "date_start": F.when(untold, F.col("_text_start")).otherwise(F.col("_start")),
        "date_end": F.when(untold, F.col("_text_end")).otherwise(F.col("_end")),
        "view": F.when(F.col("_view").isin(KNOWN_VIEWS), F.col("_view")).otherwise(view),
    })
    specific = ["spatial_label", "spatial_key", "date_start", "date_end", "sex", "age_like"]
    nothing = reduce(lambda a, b: a & b, [F.col(c).isNull() for c in specific])
    return tagged.withColumn("is_global", nothing & ~F.col("has_filter_words")).drop(
        *[f"_{f}" for f in fields], "_start", "_end", "_text_start", "_text_end"
    )


def query_fields(requests: DataFrame, text: str = "text") -> DataFrame:
    """Target, aggregation, month and weekdays a request asks for, and the query as JSON."""
    t, lowered = F.col(text), F.lower(F.col(text))

    def by_words(choices: dict, default: str) -> Column:
        choice = F.lit(default)
        for value, (words, plain) in reversed(choices.items()):
            choice = F.when(contains_any(t, words) | contains_any(lowered, plain), value).otherwise(choice)
        return choice

    month = first_match(t, MONTH, 1).cast("int")
    weekdays = F.lit(None).cast("array<string>")
    for word, days in reversed(WEEKDAY_WORDS.items()):
        weekdays = F.when(t.contains(word), F.array(*[F.lit(x) for x in days])).otherwise(weekdays)
    fields = requests.withColumns({
        "target": by_words(TARGET_WORDS, "population.foot_traffic"),
        "aggregation": by_words(AGGREGATION_WORDS, "avg"),
        "month": F.when(month.isNotNull(), F.least(F.greatest(month, F.lit(1)), F.lit(12))),
        "weekdays": weekdays,
    })
    time = F.when(F.col("month").isNotNull() | F.col("weekdays").isNotNull(), F.struct("month", "weekdays"))
    query = F.struct(
        "target", F.array("aggregation").alias("aggregations"),
        F.when(time.isNotNull(), F.struct(time.alias("time"))).alias("filters"),
    )
    return fields.withColumn("query_json", F.to_json(query))


def fingerprint(*parts: Column) -> Column:
    """SHA-256 of the parts written one after another."""
    return F.sha2(F.concat(*[F.coalesce(p.cast("string"), F.lit("None")) for p in parts]), 256)
