"""Raw wide text frames of every domain, derived from the order tables.

The statements run on Spark and, with plain table names filled in, elsewhere too.
They spread blanks, words and missing values over the measure and key columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from areapulse.sources.staging import table

TABLES = ["orders", "customer", "nation", "lineitem", "supplier"]


def _month(day: str) -> str:
    return f"CAST(year({day}) * 100 + month({day}) AS STRING)"


_LINES = """(SELECT *, CAST(year(l_shipdate) * 100 + month(l_shipdate) AS STRING) AS ym,
    CAST(l_quantity AS STRING) AS quantity, CAST(l_linenumber AS STRING) AS line,
    lpad(CAST(s_nationkey AS STRING), 10, '4') AS hcode,
    CASE WHEN s_acctbal < 0 THEN 'x' ELSE CAST(126 + s_nationkey * 0.25 AS STRING) END AS x,
    CAST(33 + s_nationkey * 0.5 AS STRING) AS y
  FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey)"""

STATEMENTS = {
    "sales": f"""
      SELECT {_month('o_orderdate')} AS STD_YM,
        CASE c_mktsegment WHEN 'FURNITURE' THEN '' WHEN 'MACHINERY' THEN 'nan' ELSE n_name END AS SGG_NAME,
        CASE WHEN c_mktsegment = 'MACHINERY' THEN ' LANE ' ELSE 'None' END AS LDONG_NAME,
        lpad(CAST(c_nationkey AS STRING), 5, '0') AS SGG_CODE,
        CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_mktsegment ELSE '' END AS LCLS_NM,
        CASE WHEN o_orderstatus = 'O' THEN ' retail ' ELSE 'NaN' END AS MCLS_NM,
        CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS SCLS_NM,
        CASE WHEN o_orderstatus = 'O' THEN CAST(o_totalprice AS STRING) ELSE 'N/A' END AS MAN_SALE_AMT_10G,
        CASE WHEN o_orderstatus = 'P' THEN CAST(o_totalprice AS STRING) ELSE '' END AS MAN_SALE_AMT_20G,
        CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS STRING) END AS WMAN_SALE_AMT_10G,
        CAST(c_acctbal AS STRING) AS WMAN_SALE_AMT_20G,
        '1' AS MAN_APV_CNT_10G,
        CASE WHEN o_orderpriority = '1-URGENT' THEN '2' ELSE 'NaN' END AS WMAN_APV_CNT_20G
      FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey JOIN {{nation}} ON c_nationkey = n_nationkey""",
    "telco": f"""
      SELECT ym AS CRTR_YM, CAST(day(l_shipdate) AS STRING) AS DAY_CNT,
        CASE WHEN s_acctbal < 0 THEN 'nan' ELSE CAST(s_nationkey AS STRING) END AS VST_SGG_CD,
        CASE WHEN l_linestatus = 'F' THEN quantity ELSE 'x' END AS ML_VST_PPLTN_10,
        line AS ML_VST_PPLTN_20,
        CASE WHEN l_linestatus = 'O' THEN quantity ELSE '' END AS FM_VST_PPLTN_10
      FROM {_LINES} AS l""",
    "telco_grid": f"""
      SELECT CASE l_returnflag WHEN 'A' THEN CAST(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS STRING)
                               WHEN 'R' THEN '' ELSE CASE WHEN l_linenumber = 1 THEN 'unknown' END END AS CRTR_YMD,
        ym AS CRTR_YM, CAST(l_suppkey AS STRING) AS SM_LC_CD, x AS COORD_X, y AS COORD_Y,
        quantity AS VST_ML_PPLTN_CNT_20_24,
        CASE WHEN l_linestatus = 'F' THEN line ELSE '-' END AS VST_ML_PPLTN_CNT_70_ABV,
        CASE WHEN l_linestatus = 'O' THEN quantity END AS VST_FM_PPLTN_CNT_20_24
      FROM {_LINES} AS l""",
    "inflow": f"""
      SELECT ym AS STD_YM, l_returnflag AS INFLOW_CD, hcode AS HCODE, line AS TIME,
        quantity AS H_POP, line AS W_POP, CASE WHEN l_linestatus = 'F' THEN line ELSE 'none' END AS V_POP
      FROM {_LINES} AS l""",
    "sex_age": f"""
      SELECT ym AS STD_YM, hcode AS HCODE, line AS TIME,
        CASE l_returnflag WHEN 'A' THEN 'm_0009' WHEN 'R' THEN ' W_1019' ELSE CASE l_linestatus WHEN 'F' THEN 'x_1' ELSE 'w_70u' END END
          AS SEX_AGE,
        quantity AS H_POP, line AS W_POP, '' AS V_POP
      FROM {_LINES} AS l""",
    "pcell_sex_age": f"""
      SELECT ym AS STD_YM, hcode AS HCODE, x AS X_COORD, y AS Y_COORD,
        quantity AS M_0009, CASE WHEN l_linestatus = 'F' THEN line ELSE 'x' END AS m_1019, line AS W_0009
      FROM {_LINES} AS l""",
    "pcell": f"""
      SELECT ym AS STD_YM, hcode AS HCODE, x AS X_COORD, y AS Y_COORD,
        quantity AS TIME_00, CASE WHEN l_linestatus = 'F' THEN line ELSE '' END AS TIME_01, line AS TIME_23
      FROM {_LINES} AS l""",
    "unique": f"""
      SELECT ym AS STD_YM, lpad(CAST(s_nationkey AS STRING), 5, '4') AS SGNG_CD, l_returnflag AS INFLOW_CD,
        quantity AS M_0009, CASE WHEN l_linestatus = 'F' THEN line ELSE 'x' END AS W_70U
      FROM {_LINES} AS l""",
}


def raw_frame(spark: SparkSession, sf_dir: str, domain: str) -> DataFrame:
    return spark.sql(STATEMENTS[domain], **{name: table(spark, sf_dir, name) for name in TABLES})


def raw_sql(domain: str) -> str:
    return STATEMENTS[domain].format(**{name: name for name in TABLES})
