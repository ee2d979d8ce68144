"""Parsing and formatting of keys, dates and labels held as text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from areapulse.functions.numbers import fixed_point, parse_number

# Texts that mean "no value" in the raw files.
EMPTY_TEXTS = ["", "nan", "None"]

# Five-digit district code to district name.
DISTRICT_NAMES = {
    "44270": "당진시",
    "44230": "논산시",
    "44250": "계룡시",
    "44200": "아산시",
    "44150": "공주시",
    "44180": "보령시",
    "44130": "천안시",
    "44131": "천안시동남구",
    "44133": "천안시서북구",
    "44140": "홍성군",
    "44160": "예산군",
    "44190": "서천군",
    "44210": "서산시",
    "44213": "서산시대산읍",
    "44240": "금산군",
    "46110": "목포시",
    "46130": "여수시",
    "46150": "순천시",
    "46170": "나주시",
    "46230": "광양시",
}

# Two-digit province code to province name.
PROVINCE_NAMES = {
    "11": "서울특별시",
    "26": "부산광역시",
    "27": "대구광역시",
    "28": "인천광역시",
    "29": "광주광역시",
    "30": "대전광역시",
    "31": "울산광역시",
    "36": "세종특별자치시",
    "41": "경기도",
    "42": "강원도",
    "43": "충청북도",
    "44": "충청남도",
    "45": "전라북도",
    "46": "전라남도",
    "47": "경상북도",
    "48": "경상남도",
    "50": "제주특별자치도",
    "51": "강원특별자치도",
    "52": "전북특별자치도",
}

COORD_LABEL = r"^\s*([0-9.]+),([0-9.]+)\s*(?:\(([^)]+)\))?$"


def lookup(mapping: dict[str, str], key: Column) -> Column:
    """Value of a fixed dictionary, NULL when the key is absent."""
    pairs = [F.lit(item) for pair in mapping.items() for item in pair]
    return F.try_element_at(F.create_map(*pairs), key)


def clean(text: Column) -> Column:
    """Trimmed text, NULL for the texts that mean "no value"."""
    trimmed = F.trim(text.cast("string"))
    return F.when(~trimmed.isin(EMPTY_TEXTS), trimmed)


def first_non_empty(columns: list[str]) -> Column:
    if not columns:
        return F.lit(None).cast("string")
    return F.coalesce(*[clean(F.col(f"`{c}`")) for c in columns])


def parse_date(text: Column) -> Column:
    """``YYYYMM``, ``YYYY-MM``, ``YYYY-MM-DD`` (time allowed) or ``YYYYMMDD`` to a date."""
    # One pass that names its input once: the mark in front keeps other texts from
    # being read as dates, and a month gets the day that is cut off everywhere else.
    marked = F.concat(F.lit("!"), F.trim(text.cast("string")))
    pattern = r"^!(\d{4})(-?)(\d{2})(?:\2(\d{2})(?:[T ].*)?)?$"
    iso = F.concat(F.regexp_replace(marked, pattern, "$1-$3-$4"), F.lit("01"))
    return F.substring(iso, 1, 10).try_cast("date")


def month_start(date: Column) -> Column:
    return F.trunc(date, "month")


def bucket_date(text: Column, granularity: str = "month") -> Column:
    parsed = parse_date(text)
    return month_start(parsed) if granularity == "month" else parsed


def _digits(text: Column) -> Column:
    plain = F.replace(F.replace(F.coalesce(text.cast("string"), F.lit("")), F.lit("-")), F.lit(".0"))
    return F.trim(plain)


def _given(text: Column) -> Column:
    digits = _digits(text)
    return F.when(~digits.isin("", "nan"), digits)


def day_or_month(day: Column, month: Column | None = None) -> Column:
    """An 8-digit day as ISO date, else a 6-digit month as its first day, else ''.

    Text that is present but malformed is passed through, as a marker that the
    row has no usable time.
    """
    iso_day = F.regexp_replace(_given(day), r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
    if month is None:
        return F.coalesce(iso_day, F.lit(""))
    iso_month = F.regexp_replace(_given(month), r"^(\d{4})(\d{2})$", "$1-$2-01")
    return F.coalesce(iso_day, iso_month, F.lit(""))


def day_or_month_text(day: Column, month: Column | None = None) -> Column:
    """The text :func:`day_or_month` formats, which :func:`parse_date` reads as it is."""
    return _given(day) if month is None else F.coalesce(_given(day), _given(month))


def coord_label_parts(label: Column) -> Column:
    """``lat,lon`` or ``lat,lon (code)`` to struct(lat, lon, code, spatial_type)."""
    lat = F.nullif(F.regexp_extract(label, COORD_LABEL, 1), F.lit("")).try_cast("double")
    lon = F.nullif(F.regexp_extract(label, COORD_LABEL, 2), F.lit("")).try_cast("double")
    code = F.nullif(F.regexp_extract(label, COORD_LABEL, 3), F.lit(""))
    kind = F.when(lat.isNotNull() & lon.isNotNull(), F.lit("coord"))
    return F.struct(lat.alias("lat"), lon.alias("lon"), code.alias("code"), kind.alias("spatial_type"))


def coord_label(code: Column, lon: Column, lat: Column) -> Column:
    """``lat,lon (code)`` with five decimals where coordinates exist, else the code."""
    # Every input is named once or twice, and a concat with a NULL is NULL: an input
    # may be a long expression, and repeated it makes code that is too large to compile.
    text = F.concat(fixed_point(lat, 5), F.lit(","), fixed_point(lon, 5))
    mark = F.concat(F.lit(" ("), F.nullif(code, F.lit("")), F.lit(")"))
    return F.coalesce(F.concat(text, F.coalesce(mark, F.lit(""))), code, F.lit(""))


def sex_age(token: Column) -> Column:
    """``m_0009`` to struct(sex, age_group); both NULL when the token is invalid."""
    t = F.lower(F.trim(token.cast("string")))
    sex = F.when(t.startswith("m_"), F.lit("male")).when(t.startswith("w_"), F.lit("female"))
    age = F.nullif(F.trim(F.substr(t, F.lit(3))), F.lit(""))
    valid = sex.isNotNull() & age.isNotNull()
    return F.struct(F.when(valid, sex).alias("sex"), F.when(valid, age).alias("age_group"))


def strip_prefix(column: str, prefix: str) -> str | None:
    """Age label of a prefixed measure column, case-insensitively."""
    if not column.upper().startswith(prefix.upper()):
        return None
    return column[len(prefix):].strip()


def region_name(value: Column) -> Column:
    """District code or name to the common district name."""
    text = F.trim(value.cast("string"))
    whole = text.rlike(r"^[+-]?\d+(\.0*)?$")
    code = F.when(whole, text.try_cast("decimal(38,0)").cast("string"))
    name = F.trim(F.replace(text, F.lit("서울")))
    full = F.when(name.rlike("(구|시|군)$"), name).otherwise(F.concat(name, F.lit("구")))
    return F.when(whole, F.coalesce(lookup(DISTRICT_NAMES, code), code)).otherwise(full)


def age_label(age: Column, sex: Column | None = None) -> Column:
    """37 to ``30s``; with a sex, ``30s_female``."""
    decade = F.concat(F.floor(age.cast("int") / 10).cast("string"), F.lit("0s"))
    return decade if sex is None else F.when(sex.isNull() | (sex == ""), decade).otherwise(F.concat(decade, F.lit("_"), sex))


def time_label(value: Column) -> Column:
    """``YYYY-MM`` for the first of a month, else ``YYYY-MM-DD``; NULL if unreadable."""
    d = parse_date(value)
    return F.when(F.dayofmonth(d) == 1, F.date_format(d, "yyyy-MM")).otherwise(F.date_format(d, "yyyy-MM-dd"))
