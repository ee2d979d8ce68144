"""Normalisers, file sources, lake layers, upserts and incremental ingest."""

from pyspark.sql import functions as F

from areapulse.checks.registry import check
from areapulse.checks.sqltext import GOLD, statement
from areapulse.functions.numbers import sum_columns
from areapulse.functions.text import bucket_date, coord_label, coord_label_parts, day_or_month, first_non_empty, parse_date, sex_age
from areapulse.operators import normalize as norm
from areapulse.operators.domains import CITY_SOURCES
from areapulse.session import new_folder
from areapulse.sources import files, lake, upserts
from areapulse.sources.ingest import IngestStore
from areapulse.sources.rawdata import raw_frame, raw_sql
from areapulse.sources.staging import gold, table
from areapulse.streaming.ingest import stream_files


def num(*columns: str) -> str:
    """Text measures added up, anything but a finite number counted as 0."""
    return " + ".join(
        f"coalesce(CASE WHEN isfinite(TRY_CAST({c} AS DOUBLE)) THEN TRY_CAST({c} AS DOUBLE) END, 0)" for c in columns
    )


def text(column: str) -> str:
    return f"CASE WHEN trim({column}) NOT IN ('', 'nan', 'None') THEN trim({column}) END"


def month(column: str) -> str:
    return f"CAST(try_strptime({column} || '01', '%Y%m%d') AS DATE)"


def facts(domain: str, source: str, key: str, date: str, where: str = "true", **measures: str) -> str:
    """SQL for the activity rows of a domain."""
    sums = ", ".join(f"sum({measures[m]}) AS {m}" if m in measures else f"CAST(NULL AS DOUBLE) AS {m}"
                     for m in ("foot_traffic", "sales", "sales_count"))
    return (f"SELECT {key} AS spatial_key, {date} AS date, 'month' AS granularity, '{source}' AS source, {sums} "
            f"FROM ({raw_sql(domain)}) WHERE {key} IS NOT NULL AND {date} IS NOT NULL AND {where} GROUP BY 1, 2, 3, 4")


def long(domain: str, source: str, key: str, date: str, columns: dict) -> str:
    """SQL for the demographic rows of a wide domain."""
    parts = [
        f"SELECT {key} AS spatial_key, {date} AS date, 'month' AS granularity, '{source}' AS source, '{sex}' AS sex, "
        f"'{age}' AS age_group, sum({num(column)}) AS value FROM ({raw_sql(domain)}) "
        f"WHERE {key} IS NOT NULL AND {date} IS NOT NULL GROUP BY 1, 2"
        for column, (sex, age) in columns.items()
    ]
    return " UNION ALL ".join(parts)


KEYS = "spatial_key date granularity source"
MEASURES = "foot_traffic sales sales_count"
SALES_KEY = f"coalesce({text('SGG_NAME')}, {text('LDONG_NAME')}, {text('SGG_CODE')})"
SALES_AMOUNTS = ["MAN_SALE_AMT_10G", "MAN_SALE_AMT_20G", "WMAN_SALE_AMT_10G", "WMAN_SALE_AMT_20G"]
SALES_COUNTS = ["MAN_APV_CNT_10G", "WMAN_APV_CNT_20G"]
DAY = "coalesce(CASE WHEN CRTR_YMD <> '' THEN CRTR_YMD END, CRTR_YM || '01')"
GRID_DATE = f"CAST(date_trunc('month', try_strptime({DAY}, '%Y%m%d')) AS DATE)"
SEX = "CASE left(lower(trim(SEX_AGE)), 2) WHEN 'm_' THEN 'male' WHEN 'w_' THEN 'female' END"
POPULATION = num("H_POP", "W_POP", "V_POP")

ACTIVITY_SQL = {
    "sales": facts("sales", "sales", SALES_KEY, month("STD_YM"), sales=num(*SALES_AMOUNTS), sales_count=num(*SALES_COUNTS)),
    "telco": facts("telco", "telco", text("VST_SGG_CD"), month("CRTR_YM"),
                   foot_traffic=num("ML_VST_PPLTN_10", "ML_VST_PPLTN_20", "FM_VST_PPLTN_10")),
    "telco_grid": facts("telco_grid", "telco_grid", "SM_LC_CD", GRID_DATE, foot_traffic=num(
        "VST_ML_PPLTN_CNT_20_24", "VST_ML_PPLTN_CNT_70_ABV", "VST_FM_PPLTN_CNT_20_24")),
    "inflow": facts("inflow", CITY_SOURCES["inflow"], "HCODE", month("STD_YM"), foot_traffic=POPULATION),
    "sex_age": facts("sex_age", CITY_SOURCES["sex_age"], "HCODE", month("STD_YM"), f"{SEX} IS NOT NULL", foot_traffic=POPULATION),
    "pcell_sex_age": facts("pcell_sex_age", CITY_SOURCES["pcell_sex_age"], "HCODE", month("STD_YM"),
                           foot_traffic=num("M_0009", "m_1019", "W_0009")),
    "pcell": facts("pcell", CITY_SOURCES["pcell"], "HCODE", month("STD_YM"), foot_traffic=num("TIME_00", "TIME_01", "TIME_23")),
    "unique": facts("unique", CITY_SOURCES["unique"], "SGNG_CD", month("STD_YM"), foot_traffic=num("M_0009", "W_70U")),
}
DEMOGRAPHICS_SQL = {
    "telco_grid": long("telco_grid", "telco_grid", "SM_LC_CD", GRID_DATE, {
        "VST_ML_PPLTN_CNT_20_24": ("male", "20_24"), "VST_ML_PPLTN_CNT_70_ABV": ("male", "70_ABV"),
        "VST_FM_PPLTN_CNT_20_24": ("female", "20_24")}),
    "sex_age": f"SELECT HCODE AS spatial_key, {month('STD_YM')} AS date, 'month' AS granularity, '{CITY_SOURCES['sex_age']}' AS source, "
               f"{SEX} AS sex, substr(lower(trim(SEX_AGE)), 3) AS age_group, sum({POPULATION}) AS value "
               f"FROM ({raw_sql('sex_age')}) WHERE {SEX} IS NOT NULL GROUP BY 1, 2, 5, 6",
    "pcell_sex_age": long("pcell_sex_age", CITY_SOURCES["pcell_sex_age"], "HCODE", month("STD_YM"), {
        "M_0009": ("male", "0009"), "m_1019": ("male", "1019"), "W_0009": ("female", "0009")}),
    "unique": long("unique", CITY_SOURCES["unique"], "SGNG_CD", month("STD_YM"), {
        "M_0009": ("male", "0009"), "W_70U": ("female", "70U")}),
}
IDS = {"sales": "n4", "telco": "n5", "telco_grid": "n6", "inflow": "n7", "sex_age": "n8", "pcell_sex_age": "n9", "pcell": "n10", "unique": "n11"}

for _domain, _id in IDS.items():
    check(f"{_id}_{_domain}", statement(ACTIVITY_SQL[_domain], KEYS, MEASURES, ""))(
        lambda spark, sf, domain=_domain: norm.NORMALISERS[domain](raw_frame(spark, sf, domain)).activity)
    if _domain in DEMOGRAPHICS_SQL:
        check(f"{_id}_{_domain}_demographics", statement(DEMOGRAPHICS_SQL[_domain], KEYS + " sex age_group", "value", ""))(
            lambda spark, sf, domain=_domain: norm.NORMALISERS[domain](raw_frame(spark, sf, domain)).demographics)

for _domain, _id, _key, _x, _y in (("telco_grid", "n6", "SM_LC_CD", "COORD_X", "COORD_Y"), ("pcell", "n10", "HCODE", "X_COORD", "Y_COORD")):
    _known = f"isfinite(TRY_CAST({_x} AS DOUBLE)) AND isfinite(TRY_CAST({_y} AS DOUBLE))"
    check(f"{_id}_{_domain}_places", statement(
        f"SELECT {_key} AS spatial_key, {_key} AS spatial_label, CASE WHEN bool_or({_known}) THEN 'coord' END AS spatial_type, "
        f"{_key} AS code, max(CASE WHEN {_known} THEN CAST({_y} AS DOUBLE) END) AS lat, "
        f"max(CASE WHEN {_known} THEN CAST({_x} AS DOUBLE) END) AS lon "
        f"FROM ({raw_sql(_domain)}) GROUP BY 1".replace(f"CAST({_y} AS DOUBLE)", f"TRY_CAST({_y} AS DOUBLE)").replace(
            f"CAST({_x} AS DOUBLE) END", f"TRY_CAST({_x} AS DOUBLE) END").replace("TRY_TRY_", "TRY_"),
        "spatial_key spatial_label spatial_type code", "lat lon", "",
    ))(lambda spark, sf, domain=_domain: norm.NORMALISERS[domain](raw_frame(spark, sf, domain)).spatial)

check("n1_prefix_sums", statement(
    f"SELECT STD_YM, SGG_CODE, {num(*SALES_AMOUNTS)} AS amount, {num(*SALES_COUNTS)} AS n FROM ({raw_sql('sales')})",
    "STD_YM SGG_CODE", "amount n", ""))(lambda spark, sf: raw_frame(spark, sf, "sales").select(
        "STD_YM", "SGG_CODE", sum_columns(SALES_AMOUNTS).alias("amount"), sum_columns(SALES_COUNTS).alias("n")))

check("n2_first_non_empty", f"SELECT SGG_NAME, LDONG_NAME, SGG_CODE, {SALES_KEY} AS spatial_key FROM ({raw_sql('sales')})")(
    lambda spark, sf: raw_frame(spark, sf, "sales").select(
        "SGG_NAME", "LDONG_NAME", "SGG_CODE", first_non_empty(["SGG_NAME", "LDONG_NAME", "SGG_CODE"]).alias("spatial_key")))

DATES = """SELECT o_orderkey, CASE substr(o_orderpriority, 1, 1)
  WHEN '1' THEN CAST(year(o_orderdate) * 100 + month(o_orderdate) AS STRING)
  WHEN '2' THEN CAST(year(o_orderdate) AS STRING) || '-' || lpad(CAST(month(o_orderdate) AS STRING), 2, '0')
  WHEN '3' THEN CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS STRING)
  WHEN '4' THEN CASE o_orderstatus WHEN 'F' THEN 'nan' WHEN 'O' THEN '2024-13-01' ELSE ' 199502 ' END
  ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) || CASE WHEN o_orderstatus = 'P' THEN 'T10:00:00' ELSE '' END END AS t FROM {orders}"""
_T = "trim(t)"
DATE_SQL = f"""CASE WHEN regexp_full_match({_T}, '\\d{{6}}') THEN CAST(try_strptime({_T} || '01', '%Y%m%d') AS DATE)
  WHEN regexp_full_match({_T}, '\\d{{4}}-\\d{{2}}') THEN CAST(try_strptime({_T} || '-01', '%Y-%m-%d') AS DATE)
  WHEN regexp_full_match({_T}, '\\d{{8}}') THEN CAST(try_strptime({_T}, '%Y%m%d') AS DATE)
  WHEN regexp_full_match({_T}, '\\d{{4}}-\\d{{2}}-\\d{{2}}([T ].*)?') THEN CAST(try_strptime(left({_T}, 10), '%Y-%m-%d') AS DATE) END"""
check("n3_dates", f"SELECT o_orderkey, t, {DATE_SQL} AS date, CAST(date_trunc('month', {DATE_SQL}) AS DATE) AS month FROM ({DATES.format(orders='orders')})")(
    lambda spark, sf: spark.sql(DATES, orders=table(spark, sf, "orders")).select(
        "o_orderkey", "t", parse_date(F.col("t")).alias("date"), bucket_date(F.col("t")).alias("month")))

NAMES = """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'data/sungnam_service_inflow_pop_202401.csv'
  WHEN 'O' THEN 'SUNGNAM_SERVICE_PCELL_SEX_AGE_POP_1.CSV' ELSE 'sungnam_service_' || o_orderpriority || '.csv' END AS f FROM {orders}"""
check("n12_file_routing", f"""SELECT o_orderkey, CASE WHEN lower(f) LIKE '%sungnam_service_inflow_pop%' THEN 'inflow'
  WHEN lower(f) LIKE '%sungnam_service_sex_age_pop%' THEN 'sex_age' WHEN lower(f) LIKE '%sungnam_service_pcell_sex_age_pop%' THEN 'pcell_sex_age'
  WHEN lower(f) LIKE '%sungnam_service_pcell_pop%' THEN 'pcell' WHEN lower(f) LIKE '%sungnam_unique_pop%' THEN 'unique' END AS domain
  FROM ({NAMES.format(orders='orders')})""")(lambda spark, sf: spark.sql(NAMES, orders=table(spark, sf, "orders")).select(
    "o_orderkey", norm.detect_table(F.col("f")).alias("domain")))

check("n13_wide_to_long", statement(DEMOGRAPHICS_SQL["unique"], "spatial_key date sex age_group", "value", ""))(
    lambda spark, sf: norm.long_demographics(norm.wide_demographics(
        norm.complete(norm._city_rows(raw_frame(spark, sf, "unique"), "SGNG_CD", "month")), {"M_0009": "0009"}, {"W_70U": "70U"})))

LABELS = """SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN s_name
  ELSE CAST(33 + s_nationkey AS STRING) || '.25,' || CAST(126 + s_nationkey AS STRING) || '.5' ||
       CASE WHEN s_acctbal > 5000 THEN ' (' || CAST(s_suppkey AS STRING) || ')' ELSE '' END END AS label FROM {supplier}"""
check("n14_coordinate_labels", statement(
    """SELECT s_suppkey, label, TRY_CAST(nullif(regexp_extract(label, '^\\s*([0-9.]+),([0-9.]+)', 1), '') AS DOUBLE) AS lat,
      TRY_CAST(nullif(regexp_extract(label, '^\\s*([0-9.]+),([0-9.]+)', 2), '') AS DOUBLE) AS lon,
      nullif(regexp_extract(label, '\\(([^)]+)\\)$', 1), '') AS code,
      CASE WHEN regexp_matches(label, '^\\s*[0-9.]+,[0-9.]+') THEN 'coord' END AS spatial_type
    FROM (""" + LABELS.format(supplier="supplier") + ")", "s_suppkey label code spatial_type", "lat lon", "",
))(lambda spark, sf: spark.sql(LABELS, supplier=table(spark, sf, "supplier")).withColumn(
    "p", coord_label_parts(F.col("label"))).select("s_suppkey", "label", "p.*"))

check("n15_coordinate_format",
      """SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN CAST(s_suppkey AS VARCHAR) ELSE
      printf('%.5f,%.5f', CAST(33 + s_nationkey * 0.25 AS DOUBLE), CAST(126 + s_nationkey * 0.5 AS DOUBLE)) ||
      CASE WHEN s_acctbal > 5000 THEN '' ELSE ' (' || CAST(s_suppkey AS VARCHAR) || ')' END END AS label FROM supplier""")(
    lambda spark, sf: table(spark, sf, "supplier").select("s_suppkey", coord_label(
        F.when(~F.col("s_acctbal").between(5000.000001, 1e12), F.col("s_suppkey").cast("string")),
        F.when(F.col("s_acctbal") >= 0, 126 + F.col("s_nationkey") * 0.5),
        33 + F.col("s_nationkey") * 0.25).alias("label")))

check("n16_day_or_month", f"""SELECT CRTR_YMD, CRTR_YM,
  CASE WHEN regexp_full_match(CRTR_YMD, '\\d{{8}}') THEN left(CRTR_YMD, 4) || '-' || substr(CRTR_YMD, 5, 2) || '-' || right(CRTR_YMD, 2)
       WHEN CRTR_YMD <> '' THEN CRTR_YMD ELSE left(CRTR_YM, 4) || '-' || right(CRTR_YM, 2) || '-01' END AS time_key
  FROM ({raw_sql('telco_grid')})""")(lambda spark, sf: raw_frame(spark, sf, "telco_grid").select(
    "CRTR_YMD", "CRTR_YM", day_or_month(F.col("CRTR_YMD"), F.col("CRTR_YM")).alias("time_key")))

check("n24_sex_age_tokens", f"""SELECT SEX_AGE, count(*) AS n, CASE WHEN {SEX} IS NOT NULL THEN {SEX} END AS sex,
  CASE WHEN {SEX} IS NOT NULL THEN substr(lower(trim(SEX_AGE)), 3) END AS age_group FROM ({raw_sql('sex_age')}) GROUP BY 1""")(
    lambda spark, sf: raw_frame(spark, sf, "sex_age").groupBy("SEX_AGE").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "t", sex_age(F.col("SEX_AGE"))).select("SEX_AGE", "n", "t.*"))

# Files ---------------------------------------------------------------------------------------


def dump(spark, sf, domain, name, sep=",", where=None):
    """Write a raw frame as CSV files below the shared folder."""
    path = new_folder(spark, name)
    raw = raw_frame(spark, sf, domain)
    (raw.where(where) if where else raw).write.option("header", True).option("sep", sep).csv(path)
    return path


@check("d1_csv_scan", statement(ACTIVITY_SQL["sales"], KEYS, MEASURES, ""))
def csv_scan(spark, sf):
    folders = [dump(spark, sf, "sales", "sales", "|", f"STD_YM {test} '199801'") for test in ("<", ">=")]
    paths = files.collect_files(spark, [*folders, f"{folders[0]}-absent"], ["part-*.csv"])
    return norm.sales(files.read_csv(spark, paths)).activity


@check("d2_header_and_delimiter", "SELECT ',' AS sep, CAST(13 AS BIGINT) AS n, count(*) AS rows FROM orders")
def header(spark, sf):
    path = dump(spark, sf, "sales", "header")
    found = files.layouts(files.list_files(spark, [path], "*.csv"))
    rows = files.read_directory(spark, path).agg(F.count(F.lit(1)).alias("rows"))
    return found.select("sep", F.size("columns").cast("long").alias("n")).distinct().crossJoin(rows)


def mixed_drops(spark, sf):
    """Four drops of one source: commas, bars, columns turned round, and one column more."""
    raw, tests = raw_frame(spark, sf, "telco"), ["< '199401'", "BETWEEN '199401' AND '199512'", "BETWEEN '199601' AND '199712'", "> '199712'"]
    out = []
    for n, (test, sep) in enumerate(zip(tests, [",", "|", ",", ";"])):
        part = raw.where(f"CRTR_YM {test}")
        part = part.select(*reversed(part.columns)) if n == 2 else part.withColumn("EXTRA", F.lit("x")) if n == 3 else part
        out.append(new_folder(spark, f"mixed{n}"))
        part.write.option("header", True).option("sep", sep).csv(out[-1])
    return out


check("d1_mixed_layouts", statement(ACTIVITY_SQL["telco"], KEYS, MEASURES, ""))(
    lambda spark, sf: norm.telco(files.read_csv(spark, files.collect_files(spark, mixed_drops(spark, sf), ["*.csv"]))).activity)


LAYOUT_SQL = " UNION ALL ".join(
    f"SELECT {n} AS drop, '{sep}' AS sep, CAST({more} AS BIGINT) AS extra, '{first}' AS first FROM (SELECT count(*) AS c FROM orders) WHERE c > 0"
    for n, sep, more, first in ((0, ",", 0, "CRTR_YM"), (1, "|", 0, "CRTR_YM"), (2, ",", 0, "last"), (3, ";", 1, "CRTR_YM")))


@check("d2_layout_per_file", LAYOUT_SQL)
def layout_per_file(spark, sf):
    drops, width = mixed_drops(spark, sf), len(raw_frame(spark, sf, "telco").columns)
    found = files.layouts(files.list_files(spark, drops, "*.csv"))
    return found.select(
        F.regexp_extract("path", r"mixed(\d)", 1).cast("int").alias("drop"), "sep", (F.size("columns") - width).cast("long").alias("extra"),
        F.when(F.col("columns")[0] == "CRTR_YM", "CRTR_YM").otherwise("last").alias("first")).distinct()


@check("d3_mixed_layouts", statement(ACTIVITY_SQL["telco"], KEYS, MEASURES, ""))
def mixed_ingest(spark, sf):
    store = IngestStore(spark, new_folder(spark, "store"))
    store.ingest("telco", mixed_drops(spark, sf), "*.csv")
    return store.activity()


@check("d3_incremental_ingest", statement(ACTIVITY_SQL["telco"], KEYS, MEASURES, ""))
def incremental(spark, sf):
    """Two drops, each offered again with the next run."""
    store = IngestStore(spark, new_folder(spark, "store"))
    early, late = (dump(spark, sf, "telco", "telco", ",", f"CRTR_YM {test} '199801'") for test in ("<", ">="))
    store.ingest("telco", [early], "*.csv")
    store.ingest("telco", [early, late], "*.csv")
    store.ingest("telco", [early, late], "*.csv")
    return store.activity()


def streamed(spark, sf, domain):
    """A store filled by a stream, then offered the same files with the old and with a fresh checkpoint."""
    drop, state, store = dump(spark, sf, domain, domain), new_folder(spark, "state"), IngestStore(spark, new_folder(spark, "store"))
    for checkpoint in (state, state, new_folder(spark, "state")):
        stream_files(store, domain, drop, "*.csv", checkpoint).awaitTermination()
    return store


check("d3_streaming_ingest", statement(ACTIVITY_SQL["inflow"], KEYS, MEASURES, ""))(
    lambda spark, sf: streamed(spark, sf, "inflow").activity())
check("d3_streaming_demographics", statement(DEMOGRAPHICS_SQL["unique"], KEYS + " sex age_group", "value", ""))(
    lambda spark, sf: streamed(spark, sf, "unique").demographics())
check("d3_streaming_spatial", statement(
    f"SELECT DISTINCT spatial_key, spatial_key AS spatial_label FROM ({ACTIVITY_SQL['inflow']})", "spatial_key spatial_label", "", ""))(
    lambda spark, sf: streamed(spark, sf, "inflow").spatial().select("spatial_key", "spatial_label"))

check("d4_pruned_scan", f"SELECT VST_SGG_CD, count(*) AS n FROM ({raw_sql('telco')}) GROUP BY 1")(
    lambda spark, sf: files.read_csv(
        spark, files.collect_files(spark, [dump(spark, sf, "telco", "pruned")], ["*.csv"]), columns=["VST_SGG_CD"],
    ).groupBy("VST_SGG_CD").agg(F.count(F.lit(1)).alias("n")))


@check("d5_lake_layers", statement(f"""
  SELECT 'bronze' AS layer, {month('CRTR_YM')} AS dt, count(*) AS n, NULL AS foot_traffic FROM ({raw_sql('telco')}) GROUP BY 2
  UNION ALL SELECT 'silver', {month('CRTR_YM')}, count(*), sum({num('ML_VST_PPLTN_10', 'ML_VST_PPLTN_20', 'FM_VST_PPLTN_10')})
  FROM ({raw_sql('telco')}) WHERE {text('VST_SGG_CD')} IS NOT NULL GROUP BY 2""", "layer dt n", "foot_traffic", ""))
def lake_layers(spark, sf):
    root, raw = new_folder(spark, "lake"), raw_frame(spark, sf, "telco")
    lake.write_layer(norm.bronze(raw, F.col("CRTR_YM")), root, "bronze", "telco")
    lake.write_layer(norm.silver(norm.telco_rows(raw)), root, "silver", "telco")
    n = F.count(F.lit(1)).alias("n")
    return (
        lake.read_layer(spark, root, "bronze", "telco").groupBy("dt").agg(n)
        .select(F.lit("bronze").alias("layer"), "dt", "n", F.lit(None).cast("double").alias("foot_traffic"))
        .unionByName(lake.read_layer(spark, root, "silver", "telco").groupBy("dt").agg(n, F.sum("foot_traffic").alias("foot_traffic"))
                     .select(F.lit("silver").alias("layer"), "dt", "n", "foot_traffic"))
    )


# Upserts -------------------------------------------------------------------------------------

check("d6_add_activity", statement(
    f"SELECT spatial_key, date, granularity, source, sum(foot_traffic) AS foot_traffic, sum(sales) AS sales, sum(sales_count) AS sales_count "
    f"FROM (SELECT * FROM gold_activity UNION ALL SELECT * FROM gold_activity WHERE source = 'sales' UNION ALL {ACTIVITY_SQL['unique']}) "
    f"GROUP BY 1, 2, 3, 4", KEYS, MEASURES))(lambda spark, sf: upserts.add_activity(
        upserts.add_activity(gold(spark, sf).activity, gold(spark, sf).activity.where("source = 'sales'")),
        norm.city_unique(raw_frame(spark, sf, "unique")).activity))

check("d7_add_demographics", statement(
    f"SELECT spatial_key, date, granularity, source, sex, age_group, sum(value) AS value FROM (SELECT * FROM gold_demographics "
    f"UNION ALL SELECT * FROM gold_demographics WHERE sex = 'male' UNION ALL {DEMOGRAPHICS_SQL['unique']}) GROUP BY ALL",
    KEYS + " sex age_group", "value"))(lambda spark, sf: upserts.add_demographics(
        upserts.add_demographics(gold(spark, sf).demographics, gold(spark, sf).demographics.where("sex = 'male'")),
        norm.city_unique(raw_frame(spark, sf, "unique")).demographics))


def refreshed(spark, sf, domain):
    """A store refreshed after each of two drops that share months, and offered files of a third that it has not added up yet."""
    store = IngestStore(spark, new_folder(spark, "store"))
    for n, where in enumerate(["STD_YM < '199601' AND HCODE < '4444444410'", "STD_YM < '199601' AND HCODE >= '4444444410'", "STD_YM >= '199601'"]):
        store.ingest(domain, [dump(spark, sf, domain, domain, ",", where)], "*.csv")
        if n < 2:
            store.refresh()
    return store


check("d6_refreshed_activity", statement(ACTIVITY_SQL["pcell_sex_age"], KEYS, MEASURES, ""))(
    lambda spark, sf: refreshed(spark, sf, "pcell_sex_age").activity())
check("d7_refreshed_demographics", statement(DEMOGRAPHICS_SQL["pcell_sex_age"], KEYS + " sex age_group", "value", ""))(
    lambda spark, sf: refreshed(spark, sf, "pcell_sex_age").demographics())

BATCH = """SELECT lpad(CAST(c_nationkey AS STRING), 5, '0') || '_' || CASE WHEN c_acctbal < 0 THEN 'NEW' ELSE c_mktsegment END AS spatial_key,
  c_name AS spatial_label, CASE WHEN c_acctbal > 100 THEN 'coord' END AS spatial_type, CAST(c_custkey AS STRING) AS code,
  c_acctbal AS lat, c_acctbal + 1 AS lon, c_custkey AS pos FROM {customer}"""
check("d8_fill_spatial", statement(
    f"""SELECT spatial_key, coalesce(d.spatial_label, b.spatial_label) AS spatial_label, coalesce(d.spatial_type, b.spatial_type) AS spatial_type,
      coalesce(d.code, b.code) AS code, coalesce(d.lat, b.lat) AS lat, coalesce(d.lon, b.lon) AS lon
    FROM dim_spatial d FULL JOIN (SELECT * FROM ({BATCH.format(customer='customer')})
      QUALIFY row_number() OVER (PARTITION BY spatial_key ORDER BY pos DESC) = 1) b USING (spatial_key)""",
    "spatial_key spatial_label spatial_type code", "lat lon",
))(lambda spark, sf: upserts.fill_spatial(gold(spark, sf).dim, upserts.last_per_key(
    spark.sql(BATCH, customer=table(spark, sf, "customer")), "pos")).select(
        "spatial_key", "spatial_label", "spatial_type", "code", "lat", "lon"))

U2_SQL = f"SELECT STD_YM, count(*) AS n, count(H_POP) AS h, count(TIME_00) AS t FROM (SELECT STD_YM, H_POP, NULL AS TIME_00 FROM ({raw_sql('inflow')}) " \
         f"UNION ALL SELECT STD_YM, NULL, TIME_00 FROM ({raw_sql('pcell')})) GROUP BY 1"
check("u2_concat", U2_SQL)(lambda spark, sf: files.concat([raw_frame(spark, sf, "inflow"), raw_frame(spark, sf, "pcell")]).groupBy("STD_YM").agg(
    F.count(F.lit(1)).alias("n"), F.count("H_POP").alias("h"), F.count("TIME_00").alias("t")))

check("u4_distinct_provinces", "WITH " + GOLD + "SELECT DISTINCT sido_code, sido_name FROM admin_sig")(
    lambda spark, sf: gold(spark, sf).admin_sig.select("sido_code", "sido_name").distinct())

check("j12_files_not_logged", f"SELECT CRTR_YM AS month, count(*) AS n FROM ({raw_sql('telco')}) WHERE CRTR_YM >= '199801' GROUP BY 1")(
    lambda spark, sf: _unlogged(spark, sf))


def _unlogged(spark, sf):
    """Rows of the files an ingest still has to read after the first drop."""
    store = IngestStore(spark, new_folder(spark, "store"))
    early, late = (dump(spark, sf, "telco", "telco", ",", f"CRTR_YM {test} '199801'") for test in ("<", ">="))
    store.ingest("telco", [early], "*.csv")
    paths = [r["read_path"] for r in store.new_files("telco", [early, late], "*.csv").select("read_path").toLocalIterator()]
    return files.read_csv(spark, paths).groupBy(F.col("CRTR_YM").alias("month")).agg(F.count(F.lit(1)).alias("n"))
