"""Upkeep of the spatial dimension and the administrative hierarchy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from areapulse.functions.text import PROVINCE_NAMES, lookup
from areapulse.schemas import DIM_SPATIAL

HIERARCHY = ["sig_code", "sig_name", "sido_code", "sido_name"]


def zero_fill(text: Column, size: int) -> Column:
    """Left zeros up to ``size``; longer text is kept."""
    return F.when(F.length(text) < size, F.lpad(text, size, "0")).otherwise(text)


def admin_from_boundaries(boundaries: DataFrame, code: str, name: str) -> DataFrame:
    """Districts with their province from boundary attributes; one row per code."""
    sig_code = zero_fill(F.trim(F.col(code).cast("string")), 5)
    province = F.substring("sig_code", 1, 2)
    return (
        boundaries.where(F.col(code).isNotNull() & F.col(name).isNotNull())
        .select(sig_code.alias("sig_code"), F.trim(F.col(name).cast("string")).alias("sig_name"))
        .where(F.col("sig_code").rlike(r"^\d+$"))
        .groupBy("sig_code")
        .agg(F.max("sig_name").alias("sig_name"))
        .select(
            "sig_code", "sig_name", province.alias("sido_code"),
            F.coalesce(lookup(PROVINCE_NAMES, province), province).alias("sido_name"),
        )
    )


def provinces(admin_sig: DataFrame) -> DataFrame:
    return admin_sig.select("sido_code", "sido_name").distinct()


def replace_by_key(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of both; the new row replaces an old one of the same key."""
    return old.join(new.select(key), key, "left_anti").select(*old.columns).unionByName(new.select(*old.columns))


def match_admin(dim: DataFrame, admin_sig: DataFrame) -> DataFrame:
    """District of each place: by emd code, else by code, else by equal label.

    Three equality joins in order of preference instead of one join with an OR,
    which could only compare every place with every district.
    """
    def side(key: str, prefix: str) -> DataFrame:
        ordered = admin_sig.where(F.col(key).isNotNull())
        return ordered.groupBy(F.col(key).alias(f"{prefix}_key")).agg(
            F.min_by(F.struct(*HIERARCHY), "sig_code").alias(prefix)
        )

    by_emd, by_code, by_name = side("sig_code", "_emd"), side("sig_code", "_code"), side("sig_name", "_name")
    return (
        dim.join(by_emd, F.substring("emd_code", 1, 5) == F.col("_emd_key"), "left")
        .join(by_code, F.substring("code", 1, 5) == F.col("_code_key"), "left")
        .join(by_name, F.col("spatial_label") == F.col("_name_key"), "left")
        .select(*dim.columns, F.coalesce("_emd", "_code", "_name").alias("matched"))
    )


def fill_hierarchy(dim: DataFrame, admin_sig: DataFrame) -> DataFrame:
    """District and province of each place; what the dimension already has wins."""
    filled = {c: F.coalesce(F.col(c), F.col(f"matched.{c}")) for c in HIERARCHY}
    return match_admin(dim, admin_sig).withColumns(filled).select(*dim.columns)


def full_labels(dim: DataFrame) -> DataFrame:
    """Label rebuilt as province, district and unit where any of them is known."""
    names = ["sido_name", "sig_name", "emd_name"]
    known = F.coalesce(*names).isNotNull()
    full = F.trim(F.concat_ws(" ", *[F.nullif(F.col(n), F.lit("")) for n in names]))
    return dim.withColumn("spatial_label", F.when(known, full).otherwise(F.col("spatial_label")))


def backfill_targets(dim: DataFrame, limit: int | None = None) -> DataFrame:
    """The places with coordinates and no district or province; with ``limit``, the first by key."""
    missing = F.col("sig_name").isNull() | F.col("sido_name").isNull()
    placed = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    targets = dim.where(placed & missing).select("spatial_key", "lat", "lon")
    return targets if limit is None else targets.orderBy("spatial_key").limit(limit)


def backfill(dim: DataFrame, geocoded: DataFrame, admin_sig: DataFrame, limit: int | None = None) -> DataFrame:
    """Fill places from a table of geocoding answers (spatial_key, sig_cd, sig_kor_nm, full_nm).

    Names of the administrative table win over the answer, and both over the
    dimension. The province of an answer is the first word of its full name.
    """
    first_word = F.nullif(F.regexp_extract("full_nm", r"^\s*(\S+)", 1), F.lit(""))
    admin = admin_sig.select("sig_code", F.col("sig_name").alias("_sig"), F.col("sido_name").alias("_sido"))
    answers = (
        geocoded.join(backfill_targets(dim, limit), "spatial_key", "left_semi")
        .join(admin, F.col("sig_cd") == F.col("sig_code"), "left")
        .select(
            "spatial_key",
            F.col("sig_cd").alias("new_sig_code"),
            F.coalesce("_sig", "sig_kor_nm").alias("new_sig_name"),
            F.substring("sig_cd", 1, 2).alias("new_sido_code"),
            F.coalesce("_sido", first_word).alias("new_sido_name"),
        )
    )
    joined = dim.join(answers, "spatial_key", "left")
    return joined.withColumns({c: F.coalesce(f"new_{c}", c) for c in HIERARCHY}).select(*DIM_SPATIAL.names)
