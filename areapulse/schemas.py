"""Schemas of the shared tables, as they are stored."""

from pyspark.sql import types as T

_S, _D, _L, _DATE = T.StringType(), T.DoubleType(), T.LongType(), T.DateType()


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


ACTIVITY_KEY = ["spatial_key", "date", "granularity", "source"]
DEMOGRAPHICS_KEY = [*ACTIVITY_KEY, "sex", "age_group"]
MEASURES = ["foot_traffic", "sales", "sales_count"]
ADMIN_COLUMNS = ["emd_code", "emd_name", "sig_code", "sig_name", "sido_code", "sido_name"]
SPATIAL_COLUMNS = ["spatial_label", "spatial_type", "code", "lat", "lon"]

GOLD_ACTIVITY = _table(
    spatial_key=_S, date=_DATE, granularity=_S, source=_S,
    foot_traffic=_D, sales=_D, sales_count=_D,
)
GOLD_DEMOGRAPHICS = _table(
    spatial_key=_S, date=_DATE, granularity=_S, source=_S, sex=_S, age_group=_S, value=_D,
)
DIM_SPATIAL = _table(
    spatial_key=_S, spatial_label=_S, spatial_type=_S, code=_S, lat=_D, lon=_D,
    emd_code=_S, emd_name=_S, sig_code=_S, sig_name=_S, sido_code=_S, sido_name=_S,
)
ADMIN_SIG = _table(sig_code=_S, sig_name=_S, sido_code=_S, sido_name=_S)
ADMIN_SIDO = _table(sido_code=_S, sido_name=_S)
INGEST_LOG = _table(source=_S, path=_S, mtime=_L, size=_L, batch_id=_S, ingested_at=T.TimestampType())
REQUEST_VECTORS = T.StructType([
    T.StructField("request_hash", _S),
    T.StructField("request_text", _S),
    T.StructField("parser_model", _S),
    T.StructField("template_hash", _S),
    T.StructField("cache_version", _S),
    T.StructField("query_json", _S),
    T.StructField("embedding", T.ArrayType(T.FloatType())),
])
# Declared tables that no operator reads; kept so that a lake can hold them.
DIM_EVENT = _table(
    event_id=_L, event_name=_S, event_type=_S, start_date=_DATE, end_date=_DATE,
    center_lat=_D, center_lon=_D, radius_m=T.IntegerType(), metadata=_S,
)
DIM_WEATHER = _table(weather_id=_L, weather_code=_S, description=_S)
FACT_WEATHER = _table(
    spatial_key=_S, date=_DATE, weather_code=_S,
    temperature_c=_D, precipitation_mm=_D, wind_speed=_D,
)
