"""Column names and file patterns of the raw files, by domain."""

from __future__ import annotations

# File patterns per domain, in ingest order.
FILE_PATTERNS = {
    "sales": "JN_SALES_AGE_YM_*.CSV",
    "telco": "DJ_SKT_SGG_SX_STY_DAY_CNT_*.csv",
    "telco_grid": "GJ_SKT_SERVICE_SEX_AGE_PCELL_POP_*.csv",
    "inflow": "sungnam_service_inflow_pop_*.csv",
    "sex_age": "sungnam_service_sex_age_pop_*.csv",
    "pcell_sex_age": "sungnam_service_pcell_sex_age_pop_*.csv",
    "pcell": "sungnam_service_pcell_pop_*.csv",
    "unique": "sungnam_unique_pop_*.csv",
}

# Name parts that tell the city tables apart.
CITY_FILE_MARKS = {
    "sungnam_service_inflow_pop": "inflow",
    "sungnam_service_sex_age_pop": "sex_age",
    "sungnam_service_pcell_sex_age_pop": "pcell_sex_age",
    "sungnam_service_pcell_pop": "pcell",
    "sungnam_unique_pop": "unique",
}

# Source tag of each city table in the fact tables.
CITY_SOURCES = {
    "inflow": "sungnam_inflow",
    "sex_age": "sungnam_sex_age",
    "pcell_sex_age": "sungnam_pcell_sex_age",
    "pcell": "sungnam_pcell",
    "unique": "sungnam_unique",
}

# Columns of the raw files.
SALES = {
    "time": "STD_YM",
    "places": ["SGG_NAME", "LDONG_NAME", "LDONG", "SGG_CODE"],
    "categories": {"large": "LCLS_NM", "medium": "MCLS_NM", "small": "SCLS_NM"},
    "category": "SCLS_NM",
    "amounts": ["MAN_SALE_AMT_", "WMAN_SALE_AMT_"],
    "counts": ["MAN_APV_CNT_", "WMAN_APV_CNT_"],
}
TELCO = {"time": "CRTR_YM", "day": "DAY_CNT", "place": "VST_SGG_CD", "male": "ML_VST_PPLTN_", "female": "FM_VST_PPLTN_"}
TELCO_GRID = {
    "day": "CRTR_YMD", "month": "CRTR_YM", "place": "SM_LC_CD", "x": "COORD_X", "y": "COORD_Y",
    "male": "VST_ML_PPLTN_CNT_", "female": "VST_FM_PPLTN_CNT_",
}
CITY_TIME = "STD_YM"
CITY_PLACE = "HCODE"
CITY_POPULATION = ["H_POP", "W_POP", "V_POP"]
CITY_SEX_AGE = "SEX_AGE"
CITY_X, CITY_Y = "X_COORD", "Y_COORD"
CITY_HOUR_PREFIX = "TIME_"
CITY_MALE, CITY_FEMALE = "M_", "W_"
CITY_UNIQUE_PLACE = "SGNG_CD"
