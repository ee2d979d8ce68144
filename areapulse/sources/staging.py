"""The shared tables derived from the order, customer and line item tables.

Places are nation and market segment pairs, districts are nations, provinces are
regions. Sales come from orders by order month; visitors and their demographics
come from line item quantities by ship month. The facts are aggregated once per
session and folder and kept as tables in the shared folder, the way a lake keeps
its aggregated layer; the analytics read those tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from areapulse.functions.text import month_start
from areapulse.schemas import DIM_SPATIAL, MEASURES
from areapulse.session import stage


@dataclass
class Gold:
    """The shared tables an analysis reads.

    ``dedupe=False`` makes every roll-up to districts and provinces repeat facts
    per source, as a self join on key and date does.
    """

    activity: DataFrame
    demographics: DataFrame
    dim: DataFrame
    admin_sig: DataFrame
    admin_sido: DataFrame
    dedupe: bool = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def place_key() -> Column:
    return F.concat(F.lpad(F.col("c_nationkey").cast("string"), 5, "0"), F.lit("_"), F.col("c_mktsegment"))


def admin_sig(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        F.lpad(F.col("n_nationkey").cast("string"), 5, "0").alias("sig_code"),
        F.col("n_name").alias("sig_name"),
        F.lpad(F.col("r_regionkey").cast("string"), 2, "0").alias("sido_code"),
        F.col("r_name").alias("sido_name"),
    )


def admin_sido(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select(
        F.lpad(F.col("r_regionkey").cast("string"), 2, "0").alias("sido_code"), F.col("r_name").alias("sido_name")
    )


def dim_spatial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per nation and segment seen among customers.

    Segments differ in what is known about them, so that every fall-back of the
    name look-ups is used: BUILDING and HOUSEHOLD have codes, MACHINERY is known
    by district name only, AUTOMOBILE by its own label only, FURNITURE lacks
    coordinates.
    """
    places = table(spark, sf_dir, "customer").select("c_nationkey", "c_mktsegment").distinct()
    nation = table(spark, sf_dir, "nation")
    segment = F.col("c_mktsegment")
    has_code = segment.isin("BUILDING", "HOUSEHOLD", "FURNITURE")
    derived = {
        "spatial_key": place_key(),
        "spatial_label": F.when(segment == "MACHINERY", F.col("n_name")).otherwise(
            F.concat("n_name", F.lit(" "), segment)
        ),
        "spatial_type": F.when(segment != "AUTOMOBILE", F.lit("emd")),
        "code": F.when(has_code, F.concat(F.lpad(F.col("c_nationkey").cast("string"), 5, "0"), F.lit("00000"))),
        "lat": F.when(segment != "FURNITURE", 33 + F.col("c_nationkey") * 0.25 + F.length(segment) * 0.01),
        "lon": F.when(segment != "FURNITURE", 126 + F.col("n_regionkey") * 0.5 + F.length(segment) * 0.01),
    }
    empty = {f.name: F.lit(None).cast(f.dataType) for f in DIM_SPATIAL.fields if f.name not in derived}
    joined = places.join(nation, places["c_nationkey"] == nation["n_nationkey"])
    return joined.select(*[{**derived, **empty}[f.name].alias(f.name) for f in DIM_SPATIAL.fields])


def orders_by_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    placed = orders.join(customer, orders["o_custkey"] == customer["c_custkey"])
    return placed.select("o_orderkey", "o_orderpriority", "o_orderdate", "o_totalprice", place_key().alias("spatial_key"))


def _fact(df: DataFrame, source: str, **measures: Column) -> DataFrame:
    columns = [measures.get(m, F.lit(None).cast("double")).cast("double").alias(m) for m in MEASURES]
    return df.select(
        "spatial_key", "date", F.lit("month").alias("granularity"), F.lit(source).alias("source"), *columns
    )


def gold_demographics(spark: SparkSession, sf_dir: str, placed: DataFrame) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_linestatus", "l_shipdate")
    orders = placed.select("o_orderkey", "o_orderpriority", "spatial_key")
    decade = F.substring("o_orderpriority", 1, 1)
    return (
        lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
        .groupBy(
            "spatial_key",
            month_start(F.col("l_shipdate").cast("date")).alias("date"),
            F.lit("month").alias("granularity"),
            F.lit("telco").alias("source"),
            F.when(F.col("l_linestatus") == "F", "female").otherwise("male").alias("sex"),
            F.concat(decade, F.lit("0_"), decade, F.lit("9")).alias("age_group"),
        )
        .agg(F.sum("l_quantity").alias("value"))
    )


def gold_activity(placed: DataFrame, demographics: DataFrame) -> DataFrame:
    """Sales from orders; foot traffic as the sum of the demographic values."""
    sales = (
        placed.groupBy("spatial_key", month_start(F.col("o_orderdate").cast("date")).alias("date"))
        .agg(F.sum("o_totalprice").alias("_sales"), F.count(F.lit(1)).alias("_count"))
    )
    visits = demographics.groupBy("spatial_key", "date").agg(F.sum("value").alias("_visits"))
    return _fact(sales, "sales", sales=F.col("_sales"), sales_count=F.col("_count")).unionByName(
        _fact(visits, "telco", foot_traffic=F.col("_visits"))
    )


_built: dict[tuple[str, str], Gold] = {}


def gold(spark: SparkSession, sf_dir: str) -> Gold:
    """The shared tables of a folder, written once per Spark application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _built:
        placed = stage(spark, orders_by_place(spark, sf_dir), "orders_by_place")
        demographics = stage(spark, gold_demographics(spark, sf_dir, placed), "gold_demographics", ("date",))
        _built[key] = Gold(
            activity=stage(spark, gold_activity(placed, demographics), "gold_activity", ("date",)),
            demographics=demographics,
            dim=stage(spark, dim_spatial(spark, sf_dir), "dim_spatial"),
            admin_sig=admin_sig(spark, sf_dir),
            admin_sido=admin_sido(spark, sf_dir),
        )
    return _built[key]

