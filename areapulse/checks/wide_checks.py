"""The same operators where a date has thousands of labels, a bucket thousands of records, a group many vectors.

Customers are the places here: their orders by month are the facts, without a
dimension, so labels are keys. Some sums are unknown and order counts tie.
"""

from pyspark.sql import functions as F

from areapulse.checks.dimension_checks import vectors_of
from areapulse.checks.record_checks import RECORDS, normal_records
from areapulse.checks.registry import check
from areapulse.checks.sqltext import LEADERS, TREND_NORM, candidate, statement
from areapulse.functions.numbers import parse_number
from areapulse.functions.text import month_start
from areapulse.operators import candidates as cand, dimension, insight, vectors
from areapulse.plans import tools
from areapulse.schemas import DIM_SPATIAL, GOLD_DEMOGRAPHICS
from areapulse.session import stage
from areapulse.sources.staging import Gold, admin_sido, admin_sig, gold, table

WIDE = """
dim_spatial AS (SELECT '' AS spatial_key, '' AS spatial_label, '' AS spatial_type WHERE false),
gold_demographics AS (SELECT '' AS spatial_key, DATE '2000-01-01' AS date, 'month' AS granularity, '' AS sex, '' AS age_group,
  CAST(0 AS DOUBLE) AS value WHERE false),
gold_activity AS (SELECT CAST(o_custkey AS VARCHAR) AS spatial_key, CAST(date_trunc('month', o_orderdate) AS DATE) AS date, 'month' AS granularity,
  CAST(count(*) AS DOUBLE) AS foot_traffic, CASE WHEN o_custkey % 7 <> 0 THEN sum(o_totalprice) END AS sales, CAST(NULL AS DOUBLE) AS sales_count
  FROM orders GROUP BY o_custkey, 2),
"""
VIEWS = WIDE + ",".join([TREND_NORM, LEADERS, candidate("norm")])
_built = {}


def wide_gold(spark, sf):
    key = (spark.sparkContext.applicationId, sf)
    if key not in _built:
        sums = table(spark, sf, "orders").groupBy("o_custkey", month_start(F.col("o_orderdate").cast("date")).alias("date")).agg(
            F.count(F.lit(1)).cast("double").alias("foot_traffic"), F.sum("o_totalprice").alias("_sales"))
        facts = sums.select(
            F.col("o_custkey").cast("string").alias("spatial_key"), "date", F.lit("month").alias("granularity"), F.lit("orders").alias("source"),
            "foot_traffic", F.when(F.col("o_custkey") % 7 != 0, F.col("_sales")).alias("sales"), F.lit(None).cast("double").alias("sales_count"))
        _built[key] = Gold(
            activity=stage(spark, facts, "wide_activity", ("date",)), demographics=spark.createDataFrame([], GOLD_DEMOGRAPHICS),
            dim=spark.createDataFrame([], DIM_SPATIAL), admin_sig=admin_sig(spark, sf), admin_sido=admin_sido(spark, sf))
    return _built[key]


KEEP = "spatial_label date ft_rank sales_rank dominant_group"
check("w7_candidates_wide", statement(
    "SELECT * FROM candidate_norm", KEEP, " ".join(c for c in cand.COLUMNS if c not in KEEP.split()), VIEWS,
))(lambda spark, sf: cand.candidates(wide_gold(spark, sf), "norm"))

check("k1_rankings_wide", statement(
    "SELECT spatial_label, date, 'sales' AS metric, sales AS value FROM trend_norm WHERE date = (SELECT max(date) FROM trend_norm WHERE year(date) = 1997) "
    "ORDER BY sales DESC NULLS LAST, spatial_label LIMIT 500", "spatial_label date metric", "value", WIDE + TREND_NORM,
))(lambda spark, sf: tools.rankings(wide_gold(spark, sf), "sales", "1997", 500, "norm"))

check("a24_leading_groups_crowded", statement(
    "SELECT month, arg_min(event_type, (-value, event_type)) AS dominant_group, max(value) / nullif(sum(value), 0) AS dominant_share, "
    "string_agg(event_type, ',' ORDER BY value DESC, event_type) AS top_groups FROM "
    "(SELECT strftime(d, '%Y-%m') AS month, event_type, sum(value) AS value FROM rec WHERE source <> 'sales' GROUP BY 1, 2) GROUP BY 1",
    "month dominant_group top_groups", "dominant_share", RECORDS,
))(lambda spark, sf: insight.leading_groups(
    normal_records(spark, sf).withColumns({"spatial_key": F.lit("all"), "time_key": F.substring("time_key", 1, 7)}),
).select(
    F.col("time_key").alias("month"), "dominant_group", "dominant_share",
    F.array_join(F.transform("top_groups", lambda g: g["group"]), ",").alias("top_groups")))

check("g5_backfill_wide", statement(
    "SELECT 'o' || CAST(o_orderkey AS VARCHAR) AS spatial_key, CASE WHEN o_orderkey % 3 > 0 THEN '99' || CAST(o_orderkey % 10 AS VARCHAR) END AS sig_code, "
    "CASE WHEN o_orderkey % 3 > 0 THEN 'K' END AS sig_name FROM orders", "spatial_key sig_code sig_name", "", "",
))(lambda spark, sf: _backfilled(spark, sf).select("spatial_key", "sig_code", "sig_name"))


def _backfilled(spark, sf):
    """A place per order, two thirds of them with an answer."""
    key = F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("spatial_key")
    fixed = {"spatial_key": key, "lat": F.lit(1.0), "lon": F.lit(2.0)}
    orders = table(spark, sf, "orders")
    dim = orders.select(*[fixed.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in DIM_SPATIAL.fields])
    answers = orders.where("o_orderkey % 3 > 0").select(
        key, F.concat(F.lit("99"), (F.col("o_orderkey") % 10).cast("string")).alias("sig_cd"), F.lit("K").alias("sig_kor_nm"), F.lit("P q").alias("full_nm"))
    return dimension.backfill(dim, answers, gold(spark, sf).admin_sig)


check("n1_large_exponents", """SELECT o_orderkey,
  CAST(CAST(1 + o_orderkey % 9 AS VARCHAR) || CASE WHEN o_orderkey % 2 = 0 THEN 'e' ELSE 'E-' END || CAST(o_orderkey % 250 AS VARCHAR) AS DOUBLE) > 1 AS large FROM orders""")(
    lambda spark, sf: table(spark, sf, "orders").select("o_orderkey", (parse_number(F.concat(
        (1 + F.col("o_orderkey") % 9).cast("string"), F.when(F.col("o_orderkey") % 2 == 0, "e").otherwise("E-"),
        (F.col("o_orderkey") % 250).cast("string"))) > 1).alias("large")))

check("k7_vector_lookup_split", statement("""
  SELECT query_id, match_id, similarity, place FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, match_id) AS INTEGER) AS place
    FROM (SELECT q.vec_id AS query_id, c.vec_id AS match_id, list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(c.embedding AS DOUBLE[])) AS similarity
          FROM embeddings q JOIN embeddings c ON c.label = q.label) WHERE similarity >= 0.3) WHERE place <= 5""",
    "query_id match_id place", "similarity", ""))(
    lambda spark, sf: vectors.nearest_stored(
        vectors_of(spark, sf), vectors_of(spark, sf), ["label"], threshold=0.3, pivots=4, block_rows=24))
